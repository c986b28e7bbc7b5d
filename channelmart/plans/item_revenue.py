"""Item revenue per property, day, channel group and item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from channelmart.functions.dates import resolve_range
from channelmart.functions.exprs import compact_to_iso
from channelmart.operators.summary import day_summary
from channelmart.session import kept, stage, staged_run
from channelmart.sinks.writers import write_partitions

# The output columns, in order.
OUTPUT_COLUMNS = ["property_name", "property_type", "data_date", "session_default_channel_group",
                  "item_name", "item_revenue", "items_purchased"]


def item_revenue(report: DataFrame, properties: DataFrame) -> DataFrame:
    """S1 rows (date, channel group, item | revenue, items) of every property
    -> output rows; only rows with revenue > 0 or items > 0 are kept (F1)."""
    df = report.where((F.col("item_revenue") > 0) | (F.col("items_purchased") > 0))
    j = df.join(properties.select("property_name", "property_type"), "property_name", "left")
    return j.select(
        "property_name",
        F.coalesce(F.col("property_type"), F.col("property_name")).alias("property_type"),
        compact_to_iso("date").alias("data_date"),
        F.col("channel").alias("session_default_channel_group"),
        "item_name",
        F.col("item_revenue").cast("double").alias("item_revenue"),
        F.col("items_purchased").cast("long").alias("items_purchased"),
    )


def run_item_revenue(report: DataFrame, properties: DataFrame, path: str, as_of: str,
                     start: str | None = None, end: str | None = None) -> DataFrame:
    """K2 + A7 for the run's range (D1-D3: an explicit range, else month to
    date): write the days present (an empty result writes nothing and leaves
    every partition intact) and return the summary of exactly these rows."""
    start, end = resolve_range(start, end, as_of)
    rows = item_revenue(report, properties).where(F.col("data_date").between(F.lit(start), F.lit(end)))
    with staged_run(report.sparkSession, "item-revenue-run"):
        df = stage(rows, "item-revenue")
        write_partitions(df, path, ["data_date"])
        return kept(day_summary(df, {"item_revenue": "item_revenue"}, exact_places=12))
