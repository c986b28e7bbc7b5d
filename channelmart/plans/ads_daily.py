"""C4: the blended daily ads table (reconcile + blend + ratios + write)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from channelmart.functions.dates import resolve_range
from channelmart.operators.blend import blend, derive_metrics
from channelmart.operators.hybrid import native_hybrid
from channelmart.operators.overlay import ADGROUP_DAY_KEYS, adgroup_day, campaign_day, targets, with_iso_date
from channelmart.operators.reconcile import reconcile_daily
from channelmart.operators.summary import day_summary
from channelmart.session import kept, stage, stage_bucketed, staged_run
from channelmart.sinks.writers import write_partitions

REPORTS = ("range_ads", "range_analytics", "day_campaign_ads", "day_campaign_analytics",
           "day_adgroup_ads", "day_adgroup_analytics")


def _in_range(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """inclusive day range on the ISO date (pushed to the scan when the
    frame comes straight from a table)."""
    if start and end:
        return df.where(F.col("data_date").between(F.lit(start), F.lit(end)))
    return df


def overlays(reports: dict[str, DataFrame], start: str | None = None,
             end: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """J2-J4 once each. Targets feed four consumers and the ad-group-day
    overlay three; each consumer prunes different columns, so Spark would
    otherwise rebuild (re-shuffle) the same overlay per consumer; they are
    staged in the shared folder, the ad-group days bucketed by their key, which
    the distributed rows share."""
    t = targets(reports["range_analytics"], reports["range_ads"])
    cd = campaign_day(_in_range(with_iso_date(reports["day_campaign_analytics"]), start, end),
                      _in_range(with_iso_date(reports["day_campaign_ads"]), start, end))
    ad = adgroup_day(_in_range(with_iso_date(reports["day_adgroup_analytics"]), start, end),
                     _in_range(with_iso_date(reports["day_adgroup_ads"]), start, end))
    return stage(t, "targets"), stage(cd, "campaign-day"), stage_bucketed(ad, "adgroup-day", ADGROUP_DAY_KEYS)


def reconciled(reports: dict[str, DataFrame], start: str | None = None,
               end: str | None = None) -> DataFrame:
    """C1 over the six analytics reports of every property."""
    return reconcile_daily(*overlays(reports, start, end))


def ads_daily(reports: dict[str, DataFrame], native: dict[str, DataFrame], properties: DataFrame,
              start: str | None = None, end: str | None = None) -> DataFrame:
    """One row per property, day, campaign, ad group, channel and medium."""
    return ads_daily_from(overlays(reports, start, end), native, properties, start, end)


def ads_daily_from(built_overlays: tuple[DataFrame, DataFrame, DataFrame], native: dict[str, DataFrame],
                   properties: DataFrame, start: str | None = None, end: str | None = None,
                   shares: DataFrame | None = None, totals: DataFrame | None = None) -> DataFrame:
    """C4 from already built (staged) overlays (and period shares, and day
    totals)."""
    rec = reconcile_daily(*built_overlays, shares=shares, totals=totals)
    nat = native_hybrid(_in_range(native["campaign"], start, end),
                        _in_range(native["ad_group"], start, end))
    return derive_metrics(blend(nat, rec, properties))


def run_ads_daily(reports, native, properties, path: str, as_of: str,
                  start: str | None = None, end: str | None = None) -> DataFrame:
    """K1 + A8 for the run's range (D1-D3: an explicit range, else month to
    date): write the days present in the result (others untouched) and return
    the per-day summary of exactly these rows, an empty one if there are none."""
    start, end = resolve_range(start, end, as_of)
    with staged_run(properties.sparkSession, "ads-daily-run"):
        df = stage(ads_daily(reports, native, properties, start, end), "ads-daily")
        write_partitions(df, path, ["data_date"])
        return kept(day_summary(df, {"cost": "cost", "clicks": "clicks"}, exact_places=12))
