"""Overlay of analytics and ads-platform rows (J2-J4) with last-row-wins (A1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from channelmart.functions.exprs import (MONEY, PAID_MEDIUM, compact_to_iso,
                                         default_channel, is_named_campaign)

ADS_METRICS = ("cost", "clicks", "impressions")
AN_METRICS = ("revenue", "conversions", "sessions")
ALL_METRICS = ADS_METRICS + AN_METRICS
METRIC_TYPES = {"cost": MONEY, "revenue": MONEY, "conversions": MONEY,
                "clicks": "long", "impressions": "long", "sessions": "long"}


def zero(metric: str) -> Column:
    return F.lit(0).cast(METRIC_TYPES[metric])

TARGET_KEYS = ["property_name", "campaign", "ad_group", "channel", "medium"]
CAMPAIGN_DAY_KEYS = ["property_name", "data_date", "campaign", "channel", "medium"]
ADGROUP_DAY_KEYS = ["property_name", "data_date", "campaign", "ad_group", "channel", "medium"]


def last_row_wins(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                  order: str = "pos") -> DataFrame:
    """A1: one row per key carrying the values of its last row in report
    order, plus the key's first position (for first-appearance ties).
    Partial aggregation runs map-side, so duplicates never cross the shuffle."""
    last = F.max_by(F.struct(*[F.col(v) for v in values]), F.col(order)).alias("_last")
    return (df.groupBy(*keys).agg(last, F.min(order).alias("first_pos"))
              .select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values], "first_pos"))


def with_iso_date(df: DataFrame) -> DataFrame:
    """P10 on report frames that carry the raw 'YYYYMMDD' date."""
    if "date" in df.columns and "data_date" not in df.columns:
        return df.withColumn("data_date", compact_to_iso("date")).drop("date")
    return df


def overlay(analytics: DataFrame, ads: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge analytics rows (revenue, conversions, sessions per key incl.
    channel/medium) with ads rows (cost, clicks, impressions) that take the
    campaign's default channel and medium 'cpc'. Missing side = 0; each side
    keeps its own metrics; a duplicated key keeps its last row."""
    keys = list(keys)
    an = last_row_wins(with_iso_date(analytics), keys, AN_METRICS).withColumnRenamed("first_pos", "an_pos")
    ads = (with_iso_date(ads).withColumn("channel", default_channel("campaign"))
           .withColumn("medium", F.lit(PAID_MEDIUM)))
    ad = last_row_wins(ads, keys, ADS_METRICS).withColumnRenamed("first_pos", "ad_pos")
    j = an.join(ad, keys, "full_outer")
    seen = F.least(F.when(F.col("an_pos").isNotNull(), F.struct(F.lit(0).alias("side"), F.col("an_pos").alias("pos"))),
                   F.when(F.col("ad_pos").isNotNull(), F.struct(F.lit(1).alias("side"), F.col("ad_pos").alias("pos"))))
    return j.select(*keys, *[F.coalesce(F.col(m), zero(m)).alias(m) for m in ALL_METRICS],
                    seen.alias("seen"))


def targets(range_analytics: DataFrame, range_ads: DataFrame) -> DataFrame:
    """J2 + F2 over the range reports: one row per (property, campaign, ad
    group, channel, medium) with six target metrics and ``first_seen``, the
    first appearance of the (campaign, ad group): analytics rows first, then
    ads rows, each in report order (W5). The window holds one (campaign, ad
    group)'s target rows, one per channel and medium: bounded, not data-sized."""
    from pyspark.sql import Window
    named_an = range_analytics.where(is_named_campaign("campaign"))
    named_ad = range_ads.where(is_named_campaign("campaign"))
    t = overlay(named_an, named_ad, TARGET_KEYS)
    w = Window.partitionBy("property_name", "campaign", "ad_group")
    return t.withColumn("first_seen", F.min("seen").over(w)).drop("seen")


def campaign_day(analytics: DataFrame, ads: DataFrame) -> DataFrame:
    """(property, date, campaign, channel, medium) rows."""
    return overlay(analytics, ads, CAMPAIGN_DAY_KEYS).drop("seen")


def adgroup_day(analytics: DataFrame, ads: DataFrame) -> DataFrame:
    """(property, date, campaign, ad group, channel, medium) rows."""
    return overlay(analytics, ads, ADGROUP_DAY_KEYS).drop("seen")
