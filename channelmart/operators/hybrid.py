"""Ads-platform rows at ad-group level where they exist, else campaign level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from channelmart.functions.exprs import CAMPAIGN_LEVEL
from channelmart.operators.overlay import last_row_wins

NATIVE_METRICS = ["cost", "clicks", "impressions", "conversions", "revenue"]
DAY_CAMPAIGN = ["property_name", "data_date", "campaign"]


def native_hybrid(campaign_rows: DataFrame, adgroup_rows: DataFrame) -> DataFrame:
    """For each (property, day, campaign) of the campaign report (last row
    wins): all its ad-group rows (kept as they are, duplicates included) if it
    has any, else one row with ad group '(campaign level)'. Ad-group rows
    whose campaign-day is absent from the campaign report are dropped."""
    camp = last_row_wins(campaign_rows, DAY_CAMPAIGN, NATIVE_METRICS).drop("first_pos")
    adg = adgroup_rows.select(*DAY_CAMPAIGN, "ad_group", *NATIVE_METRICS)
    # One left join from the campaign rows gives both branches: a campaign-day
    # with ad-group rows yields those, one without yields itself. Rows meet on
    # (property, day, campaign), which holds one campaign's ad groups of a day.
    detail = F.struct("ad_group", *NATIVE_METRICS)
    j = camp.join(adg.select(*DAY_CAMPAIGN, detail.alias("detail")), DAY_CAMPAIGN, "left")
    level = F.struct(F.lit(CAMPAIGN_LEVEL).alias("ad_group"), *NATIVE_METRICS)
    return j.select(*DAY_CAMPAIGN, F.coalesce("detail", level).alias("row")).select(*DAY_CAMPAIGN, "row.*")
