"""C4 month to date without rebuilding the month.

The daily overlays (J3, J4) and the day totals (A3) of a day depend on that day's reports alone. They are kept as
day-partitioned tables below one folder (``campaign_day``, ``adgroup_day``, ``day_totals``), and a run adds or replaces the days
whose pages it has; what depends on the whole range (targets, shares, the distribution) is computed from the stored days, of
which the scan reads the range's partitions only.

``days`` names the days that are stored whole. A day leaves it before its rows are touched and comes back after they are
written, so a run that stops in between is noticed, and a day without rows differs from one never stored.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from channelmart.functions.dates import resolve_range
from channelmart.operators.overlay import ADGROUP_DAY_KEYS, adgroup_day, campaign_day, targets, with_iso_date
from channelmart.operators.reconcile import day_totals
from channelmart.operators.summary import day_summary
from channelmart.plans.ads_daily import _in_range, ads_daily_from
from channelmart.session import delete_folder, kept, stage, stage_bucketed, staged_run
from channelmart.sinks.writers import read_partitions, write_partitions

PARTS = ("campaign_day", "adgroup_day", "day_totals")
LEDGER = "days"


def days_between(start: str, end: str) -> list[str]:
    first, last = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    return [(first + _dt.timedelta(days=k)).isoformat() for k in range((last - first).days + 1)]


def store_days(spark: SparkSession, reports: dict[str, DataFrame], store: str, start: str, end: str) -> None:
    """Stores the days start..end of the daily reports, replacing what is there of these days, also by nothing."""
    days = days_between(start, end)
    for part in (LEDGER, *PARTS):
        for day in days:
            delete_folder(spark, f"{store}/{part}/data_date={day}")
    with staged_run(spark, "store-days"):
        cd = campaign_day(_in_range(with_iso_date(reports["day_campaign_analytics"]), start, end),
                          _in_range(with_iso_date(reports["day_campaign_ads"]), start, end))
        ad = stage(adgroup_day(_in_range(with_iso_date(reports["day_adgroup_analytics"]), start, end),
                               _in_range(with_iso_date(reports["day_adgroup_ads"]), start, end)), "adgroup-day")
        for part, df in zip(PARTS, (cd, ad, day_totals(ad))):
            write_partitions(df, f"{store}/{part}", ["data_date"])
    ledger = spark.createDataFrame([(day, True) for day in days], "data_date string, stored boolean")
    write_partitions(ledger.coalesce(1), f"{store}/{LEDGER}", ["data_date"], rebalance=False)


def stored_days(spark: SparkSession, store: str, start: str, end: str) -> dict[str, DataFrame]:
    """The stored tables of the range; fails, naming the days, if some are not stored."""
    ledger = read_partitions(spark, f"{store}/{LEDGER}", "data_date string, stored boolean")
    have = {r["data_date"] for r in ledger.where(F.col("data_date").between(start, end)).select("data_date").collect()}
    missing = [day for day in days_between(start, end) if day not in have]
    if missing:
        raise ValueError(f"days not stored in {store}: {', '.join(missing)}")
    return {part: read_partitions(spark, f"{store}/{part}").where(F.col("data_date").between(start, end)) for part in PARTS}


def ads_daily_from_stored(spark: SparkSession, range_reports: dict[str, DataFrame], native: dict[str, DataFrame], properties: DataFrame,
                          store: str, start: str, end: str) -> DataFrame:
    """C4 of the range from its stored days and the range's own reports."""
    parts = stored_days(spark, store, start, end)
    t = stage(targets(range_reports["range_analytics"], range_reports["range_ads"]), "targets")
    ad = stage_bucketed(parts["adgroup_day"], "adgroup-day", ADGROUP_DAY_KEYS)
    return ads_daily_from((t, parts["campaign_day"], ad), native, properties, start, end, totals=parts["day_totals"])


def run_ads_daily_stored(spark: SparkSession, new_days: dict[str, DataFrame], range_reports: dict[str, DataFrame], native: dict[str, DataFrame],
                         properties: DataFrame, path: str, store: str, as_of: str, new_range: Sequence[str] | None = None) -> DataFrame:
    """C4 + K1 + A8 month to date: stores the new days (yesterday, or ``new_range``) from their reports, then writes the days of the
    month from the stored ones and returns the summary of exactly these rows."""
    start, end = resolve_range(None, None, as_of)
    store_days(spark, new_days, store, *(new_range or (end, end)))
    with staged_run(spark, "ads-daily-run"):
        df = stage(ads_daily_from_stored(spark, range_reports, native, properties, store, start, end), "ads-daily")
        write_partitions(df, path, ["data_date"])
        return kept(day_summary(df, {"cost": "cost", "clicks": "clicks"}, exact_places=12))
