"""The jobs from landed responses: verified whole, parsed, run, written.

Layout below ``root``: ``reports/<report>/property_name=<name>/``, ``search/<level>/property_name=<name>/``,
``reservations/property_id=<id>/``, ``rates/``. Every configured property must have landed, every chain of pages must run
from page ``first`` to its end, and every report must hold the rows it declares; else the run fails before it writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from channelmart.plans.ads_daily import run_ads_daily
from channelmart.plans.item_revenue import run_item_revenue
from channelmart.plans.reservations import run_export_reservations
from channelmart.sources.ads_search import read_ads_search
from channelmart.sources.reports import read_ads_reports, read_named_report
from channelmart.sources.reservations import read_daily_rates, read_reservations

LEVELS = ("campaign", "ad_group")


def ads_daily_landed(spark: SparkSession, root: str, properties: DataFrame, path: str, as_of: str,
                     start: str | None = None, end: str | None = None, first: int = 0) -> DataFrame:
    """C4 from the six reports and both search levels."""
    reports = read_ads_reports(spark, f"{root}/reports", properties)
    native = {level: read_ads_search(spark, f"{root}/search/{level}", level, first=first, expected=properties) for level in LEVELS}
    return run_ads_daily(reports, native, properties, path, as_of, start, end)


def item_revenue_landed(spark: SparkSession, root: str, properties: DataFrame, path: str, as_of: str,
                        start: str | None = None, end: str | None = None) -> DataFrame:
    """C5 from the item revenue report."""
    report = read_named_report(spark, f"{root}/reports", "item_revenue", properties)
    return run_item_revenue(report, properties, path, as_of, start, end)


def reservations_landed(spark: SparkSession, root: str, properties: DataFrame, path: str, as_of: str,
                        start: str | None = None, end: str | None = None, first: int = 0) -> DataFrame:
    """C7 from reservation and rate pages. Rate pages answer one batch of
    reservation ids each and form no chain."""
    res = read_reservations(spark, f"{root}/reservations", first=first, expected=properties)
    return run_export_reservations(res, read_daily_rates(spark, f"{root}/rates"), properties, path, as_of, start, end)
