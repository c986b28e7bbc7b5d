"""Analytics report responses landed as JSON.

Layout: ``<root>/property_name=<name>/*.json``, each file one response
``{"rows": [{"dimensionValues": [{"value": ..}], "metricValues": [..]}]}``.
Values are positional strings; ``rows`` may be missing (empty report). The
reader keeps the report order as ``pos`` (page number, row index), which the
last-row-wins and first-appearance rules need. A malformed page fails, and so
does a report that does not hold the rows it declares (``rowCount``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from channelmart.functions.exprs import metric_or_zero
from channelmart.sources.chains import require_reports
from channelmart.sources.pages import other_columns, position, read_pages

_VALUES = ArrayType(StructType([StructField("value", StringType(), True)]))
REPORT_SCHEMA = StructType([
    StructField("rows", ArrayType(StructType([
        StructField("dimensionValues", _VALUES, True),
        StructField("metricValues", _VALUES, True),
    ])), True),
])

_ADS = [("cost", "money"), ("clicks", "long"), ("impressions", "long")]
_AN = [("revenue", "money"), ("conversions", "money"), ("sessions", "long")]
# report -> (dimension columns in response order, (metric, kind) in order).
REPORT_SPECS: dict[str, tuple[list[str], list[tuple[str, str]]]] = {
    "range_ads": (["campaign", "ad_group"], _ADS),
    "range_analytics": (["campaign", "ad_group", "channel", "medium"], _AN),
    "day_campaign_ads": (["date", "campaign"], _ADS),
    "day_campaign_analytics": (["date", "campaign", "channel", "medium"], _AN),
    "day_adgroup_ads": (["date", "campaign", "ad_group"], _ADS),
    "day_adgroup_analytics": (["date", "campaign", "ad_group", "channel", "medium"], _AN),
    "item_revenue": (["date", "channel", "item_name"], [("item_revenue", "money"), ("items_purchased", "long")]),
}


def parse_report(pages: DataFrame, dims: Sequence[str], metrics: Sequence[tuple[str, str]]) -> DataFrame:
    """Positional values -> named, typed columns (N2; P8: a missing metric is 0)."""
    keep = other_columns(pages)
    parsed = pages.select(*keep, "page", F.from_json("value", REPORT_SCHEMA, {"mode": "FAILFAST"}).alias("p"))
    rows = parsed.select(*keep, "page", F.posexplode("p.rows").alias("_idx", "r"))
    dim_cols = [F.try_element_at("r.dimensionValues", F.lit(i + 1))["value"].alias(d) for i, d in enumerate(dims)]
    met_cols = [metric_or_zero(F.try_element_at("r.metricValues", F.lit(i + 1))["value"], kind).alias(m)
                for i, (m, kind) in enumerate(metrics)]
    return rows.select(*keep, *dim_cols, *met_cols, position())


def read_report(spark: SparkSession, path: str, dims: Sequence[str],
                metrics: Sequence[tuple[str, str]], check: bool = True, expected: DataFrame | None = None) -> DataFrame:
    """The rows of whole reports: one cut at the request's limit, or with
    another number of rows than it declares, fails (``check``), and so does an
    ``expected`` property without a response."""
    pages = read_pages(spark, path)
    if check:
        require_reports(pages, f"reports below {path}", expected=expected)
    return parse_report(pages, dims, metrics)


def read_named_report(spark: SparkSession, root: str, name: str, expected: DataFrame | None = None) -> DataFrame:
    dims, metrics = REPORT_SPECS[name]
    return read_report(spark, f"{root.rstrip('/')}/{name}", dims, metrics, expected=expected)


def read_ads_reports(spark: SparkSession, root: str, expected: DataFrame | None = None) -> dict[str, DataFrame]:
    """The six reports the ads job reconciles, from ``<root>/<report>/``."""
    return {n: read_named_report(spark, root, n, expected) for n in REPORT_SPECS if n != "item_revenue"}
