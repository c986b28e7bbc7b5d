"""Run summaries (A7, A8, A9): per-day figures plus a grand-total row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_summary(df: DataFrame, sums: dict[str, str], day: str = "data_date",
                exact_places: int | None = None) -> DataFrame:
    """Rows and the given sums per day, and a grand-total row (day = NULL)
    that also counts the days. The rows are first aggregated to one row per
    day (map-side partial sums, one shuffle of partial aggregates); the
    rollup then runs over those few rows, so no input row is expanded for the
    grouping sets or for a distinct count. ``exact_places``: the values are
    exact decimals of that scale held in doubles; they are summed as decimals
    so the totals are order-independent."""
    per_day = []
    for name, src in sums.items():
        v = F.col(src)
        if exact_places is not None:
            v = v.cast(f"decimal(38,{exact_places})")
        per_day.append(F.sum(v).alias(name))
    daily = df.groupBy(day).agg(F.count(F.lit(1)).alias("row_count"), *per_day)
    return daily.rollup(day).agg(
        F.sum("row_count").alias("row_count"),
        F.count(day).alias("days"),                       # distinct non-null days
        *[F.sum(name).cast("double").alias(name) for name in sums])


def snapshot_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per property/table/day."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
