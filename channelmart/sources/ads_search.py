"""Ads-platform search responses (campaign or ad-group level) landed as
JSON pages: ``<root>/<level>/property_name=<name>/page-*.json``, each
``{"results": [{segments: {date}, campaign: {name}, adGroup: {name},
metrics: {costMicros, clicks, impressions, conversions, conversionsValue}}],
"nextPageToken": ..}``. All pages are read at once (U2), ordered by page
number; any object or leaf may be absent; a malformed page fails, and so does
a landing whose chain of tokens is not whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from channelmart.functions.exprs import NAME_DEFAULT, metric_or_zero, micros_to_money, to_money
from channelmart.sources.chains import require_chains, search_chain
from channelmart.sources.pages import other_columns, position, read_pages


def _obj(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


SEARCH_SCHEMA = StructType([
    StructField("results", ArrayType(StructType([
        StructField("segments", _obj("date"), True),
        StructField("campaign", _obj("name"), True),
        StructField("adGroup", _obj("name"), True),
        StructField("metrics", _obj("costMicros", "clicks", "impressions", "conversions",
                                    "conversionsValue"), True),
    ])), True),
    StructField("nextPageToken", StringType(), True),
])


def parse_ads_search(pages: DataFrame, level: str) -> DataFrame:
    """``level`` 'campaign' or 'ad_group'. P7: cost = micros / 1e6 (exact);
    P8: missing metrics are 0; P9/N3: missing names are 'N/A'."""
    keep = other_columns(pages)
    parsed = pages.select(*keep, "page", F.from_json("value", SEARCH_SCHEMA, {"mode": "FAILFAST"}).alias("p"))
    rows = parsed.select(*keep, "page", F.posexplode("p.results").alias("_idx", "r"))
    cols = [
        *keep,
        F.col("r.segments.date").alias("data_date"),
        F.coalesce(F.col("r.campaign.name"), F.lit(NAME_DEFAULT)).alias("campaign"),
    ]
    if level == "ad_group":
        cols.append(F.coalesce(F.col("r.adGroup.name"), F.lit(NAME_DEFAULT)).alias("ad_group"))
    cols += [
        micros_to_money("r.metrics.costMicros").alias("cost"),
        metric_or_zero("r.metrics.clicks", "long").alias("clicks"),
        metric_or_zero("r.metrics.impressions", "long").alias("impressions"),
        to_money("r.metrics.conversions").alias("conversions"),
        to_money("r.metrics.conversionsValue").alias("revenue"),
        position(),
    ]
    return rows.select(*cols)


def read_ads_search(spark: SparkSession, path: str, level: str, check: bool = True, first: int | None = None,
                    expected: DataFrame | None = None) -> DataFrame:
    """The rows of a whole landing: a page that is missing or doubled fails
    (``check``), and with ``first``, the number of each first page, one behind
    the last, too; so does an ``expected`` property without pages."""
    pages = read_pages(spark, path)
    if check:
        require_chains(search_chain(pages), f"ads search pages below {path}", first, first is not None, expected)
    return parse_ads_search(pages, level)
