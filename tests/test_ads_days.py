"""Month to date from stored days."""

import os

import pytest
from pyspark.sql import functions as F

from channelmart.plans.ads_daily import ads_daily
from channelmart.plans.ads_days import ads_daily_from_stored, run_ads_daily_stored, store_days, stored_days
from channelmart.sinks.writers import read_partitions
from channelmart.sources import standins as si

SF = "/root/testdata/sf0.001"
START, END = "1998-03-01", "1998-03-10"


@pytest.fixture(scope="module")
def fine(spark):
    return si.ads_fine(spark, SF)


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_new_day_reads_its_own_reports_and_the_stored_days(spark, scratch, fine):
    store, path = os.path.join(scratch, "store"), os.path.join(scratch, "out")
    store_days(spark, si.ads_reports(fine.where(F.col("data_date") < END)), store, START, "1998-03-09")
    only = si.ads_reports(fine.where(F.col("data_date") == END))
    asked = si.ads_reports(fine, START, END)
    summary = run_ads_daily_stored(spark, only, asked, si.native_reports(fine), si.ads_properties(spark), path, store, "1998-03-11")
    whole = ads_daily(asked, si.native_reports(fine), si.ads_properties(spark), START, END)
    written = read_partitions(spark, path)
    assert rows(written.select(*whole.columns)) == rows(whole) and written.count() > 0
    assert summary.where("data_date is null").first().row_count == written.count()
    plan = stored_days(spark, store, END, END)["adgroup_day"]._jdf.queryExecution().executedPlan().toString()
    assert "data_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_days_that_are_not_stored_fail(spark, scratch, fine):
    store = os.path.join(scratch, "store")
    store_days(spark, si.ads_reports(fine), store, START, "1998-03-02")
    store_days(spark, si.ads_reports(fine), store, "1998-03-04", "1998-03-04")
    with pytest.raises(ValueError, match="1998-03-03, 1998-03-05"):
        stored_days(spark, store, START, "1998-03-05")


def test_a_day_is_replaced_also_by_nothing(spark, scratch, fine):
    store = os.path.join(scratch, "store")
    store_days(spark, si.ads_reports(fine), store, START, "1998-03-03")
    before = rows(stored_days(spark, store, START, START)["campaign_day"])
    other = fine.withColumn("qty", F.col("qty") + 1).where(F.col("data_date") != "1998-03-03")
    store_days(spark, si.ads_reports(other), store, "1998-03-02", "1998-03-03")
    found = stored_days(spark, store, START, "1998-03-03")
    assert rows(found["campaign_day"].where(F.col("data_date") == START)) == before
    assert found["campaign_day"].where("data_date = '1998-03-03'").count() == 0           # stored, without rows
    again = ads_daily_from_stored(spark, si.ads_reports(other, START, "1998-03-03"), si.native_reports(other), si.ads_properties(spark), store, "1998-03-02", "1998-03-03")
    assert {r.data_date for r in again.select("data_date").distinct().collect()} == {"1998-03-02"}
