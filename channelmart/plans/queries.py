"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the stand-in views of that scale factor. Names match the oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from channelmart.sources import standins as si

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ events
@register("flatten_events")
def q_flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    from channelmart.plans.events import flatten_events
    flat = flatten_events(si.events(spark, sf_dir), si.EVENT_PROPERTY_ID, si.EVENT_PROPERTY_NAME)
    # The kept map is compared by its size and values.
    return (flat.withColumn("n_params", F.size("event_params")).withColumn("param_k", F.col("event_params")["k"]["int_value"])
            .withColumn("param_value", F.col("event_params")["value"]["double_value"])
            .withColumn("param_type", F.col("event_params")["type"]["string_value"]).drop("event_params"))


@register("events_join_key")
def q_events_join_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    from channelmart.plans.events import tag_events
    tagged = tag_events(si.events(spark, sf_dir), si.EVENT_PROPERTY_ID, si.EVENT_PROPERTY_NAME)
    return tagged.select("event_id", "event_name", "event_timestamp", "user_pseudo_id", "join_key")


@register("flatten_event_arrays")
def q_flatten_event_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N1 over an array of parameters: repeated keys stay, in their order."""
    from channelmart.plans.events import flatten_events
    flat = flatten_events(si.event_arrays(spark, sf_dir), si.EVENT_PROPERTY_ID, si.EVENT_PROPERTY_NAME)
    return flat.select("event_id", "join_key", "event_date", F.size("event_params").alias("n_params"), "param_pos", "key",
                       "string_value", "int_value", "float_value", "double_value")


@register("events_two_days_back")
def q_events_two_days_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job of two days before the run, from a table
    that the library wrote by (property, event day) and from the catalog's
    daily tables ``<table>_<YYYYMMDD>``; each writes its rows, which are read
    back."""
    import uuid
    from channelmart.functions.dates import table_suffix
    from channelmart.plans.events import run_events_day, write_events
    from channelmart.session import new_folder
    from channelmart.sinks.writers import read_partitions, save_daily_table
    root, prefix = new_folder(spark, "event-days"), f"events_{uuid.uuid4().hex}"
    write_events(si.events(spark, sf_dir).withColumn("property_id", F.lit(si.EVENT_PROPERTY_ID)), f"{root}/events")
    suffixes = [table_suffix(si.EVENTS_AS_OF, lag) for lag in (1, 2, 3)]
    for day in suffixes:
        whole = spark.read.parquet(f"{root}/events")
        save_daily_table(whole.where(F.col("event_date") == day), prefix, day, f"{root}/tables")
    run_events_day(spark, f"{root}/events", si.EVENT_PROPERTY_ID, si.EVENT_PROPERTY_NAME, f"{root}/partitions", si.EVENTS_AS_OF)
    run_events_day(spark, prefix, si.EVENT_PROPERTY_ID, si.EVENT_PROPERTY_NAME, f"{root}/suffix", si.EVENTS_AS_OF, partitioned=False)
    for day in suffixes:
        spark.sql(f"DROP TABLE {prefix}_{day}")
    columns = ["event_id", "event_name", "event_timestamp", "user_pseudo_id", "event_date", "property_id", "property_name", "join_key", "key",
               "string_value", "int_value", "float_value", "double_value"]
    return reduce(DataFrame.unionByName, [read_partitions(spark, f"{root}/{via}").select(F.lit(via).alias("via"), *columns) for via in ("partitions", "suffix")])


# --------------------------------------------------------------------- ads
def round_out(c, places: int = 6):
    """Output rounding that both engines compute identically: scale by an
    exact power of ten (IEEE multiply), round half away from zero to an
    integer, scale back (IEEE divide). Spark's round(x, 6) decides ties on the
    decimal form, DuckDB's on the binary value; this form avoids the mismatch.
    Adding 0.0 turns a negative zero into 0.0 on both sides."""
    m = F.lit(float(10 ** places))
    return F.round(c.cast("double") * m, 0) / m + F.lit(0.0)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles and decimals as doubles rounded to ``places`` (both engines)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType, DecimalType)):
            cols.append(round_out(F.col(f.name), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


@register("native_hybrid")
def q_native_hybrid(spark, sf_dir):
    from channelmart.operators.hybrid import native_hybrid
    nat = si.native_reports(si.ads_fine(spark, sf_dir))
    return rounded(native_hybrid(nat["campaign"], nat["ad_group"]))


@register("default_channel")
def q_default_channel(spark, sf_dir):
    from channelmart.functions.exprs import default_channel
    rep = si.ads_reports(si.ads_fine(spark, sf_dir))["day_campaign_ads"]
    return (rep.select("property_name", "campaign").distinct()
            .withColumn("default_channel", default_channel("campaign")))


def _targets(reports):
    from channelmart.operators.overlay import targets
    return targets(reports["range_analytics"], reports["range_ads"])


def _campaign_day(reports):
    from channelmart.operators.overlay import campaign_day
    return campaign_day(reports["day_campaign_analytics"], reports["day_campaign_ads"])


def _adgroup_day(reports):
    from channelmart.operators.overlay import adgroup_day
    return adgroup_day(reports["day_adgroup_analytics"], reports["day_adgroup_ads"])


def _reports(spark, sf_dir):
    return si.ads_reports(si.ads_fine(spark, sf_dir))


@register("targets_overlay")
def q_targets_overlay(spark, sf_dir):
    t = _targets(_reports(spark, sf_dir))
    return rounded(t.withColumn("first_seen_side", F.col("first_seen.side")).drop("first_seen"))


@register("campaign_day_overlay")
def q_campaign_day_overlay(spark, sf_dir):
    return rounded(_campaign_day(_reports(spark, sf_dir)))


@register("adgroup_day_overlay")
def q_adgroup_day_overlay(spark, sf_dir):
    return rounded(_adgroup_day(_reports(spark, sf_dir)))


@register("discrepancy_weights")
def q_discrepancy_weights(spark, sf_dir):
    from channelmart.operators.reconcile import discrepancy_weights, real_targets
    rep = _reports(spark, sf_dir)
    return rounded(discrepancy_weights(real_targets(_targets(rep)), _adgroup_day(rep)).drop("first_seen"))


@register("campaign_level_rows")
def q_campaign_level_rows(spark, sf_dir):
    from channelmart.operators.reconcile import active_campaign_days, campaign_level_rows, real_targets
    rep = _reports(spark, sf_dir)
    return rounded(campaign_level_rows(active_campaign_days(_campaign_day(rep)), real_targets(_targets(rep))))


def gap_and_shares(spark, sf_dir):
    """The daily gaps and the period shares of the stand-in reports."""
    from channelmart.operators.reconcile import active_campaign_days, daily_gap, period_shares
    from channelmart.plans.ads_daily import overlays
    targets, campaign_day, adgroup_day = overlays(_reports(spark, sf_dir))
    shares = period_shares(targets, adgroup_day)
    return daily_gap(active_campaign_days(campaign_day), shares, adgroup_day), shares


@register("daily_gap")
def q_daily_gap(spark, sf_dir):
    from channelmart.operators.reconcile import active_campaign_days, daily_gap, real_targets
    rep = _reports(spark, sf_dir)
    return rounded(daily_gap(active_campaign_days(_campaign_day(rep)), real_targets(_targets(rep)), _adgroup_day(rep)))


@register("distribute_revenue")
def q_distribute_revenue(spark, sf_dir):
    from channelmart.operators.reconcile import distribute_money
    from channelmart.session import stage
    gap, shares = gap_and_shares(spark, sf_dir)
    return rounded(distribute_money(stage(gap, "daily-gap"), shares))


@register("distribute_sessions_carry")
def q_distribute_sessions_carry(spark, sf_dir):
    from channelmart.operators.reconcile import distribute_sessions
    from channelmart.session import stage
    gap, shares = gap_and_shares(spark, sf_dir)
    return distribute_sessions(stage(gap, "daily-gap"), shares)


@register("reconciled_daily")
def q_reconciled_daily(spark, sf_dir):
    from channelmart.plans.ads_daily import reconciled
    return rounded(reconciled(_reports(spark, sf_dir)))


@register("session_share")
def q_session_share(spark, sf_dir):
    from channelmart.operators.blend import session_share
    from channelmart.plans.ads_daily import reconciled
    return rounded(session_share(reconciled(_reports(spark, sf_dir))))


@register("blended_ads")
def q_blended_ads(spark, sf_dir):
    from channelmart.operators.blend import blend
    from channelmart.operators.hybrid import native_hybrid
    from channelmart.plans.ads_daily import reconciled
    fine = si.ads_fine(spark, sf_dir)
    nat = si.native_reports(fine)
    return rounded(blend(native_hybrid(nat["campaign"], nat["ad_group"]), reconciled(si.ads_reports(fine)),
                         si.ads_properties(spark)))


def ads_table(spark, sf_dir, start=None, end=None):
    """C4 over the stand-in reports, of all days or of a range."""
    from channelmart.plans.ads_daily import ads_daily
    fine = si.ads_fine(spark, sf_dir)
    return ads_daily(si.ads_reports(fine, start, end), si.native_reports(fine), si.ads_properties(spark), start, end)


@register("ads_metrics")
def q_ads_metrics(spark, sf_dir):
    return rounded(ads_table(spark, sf_dir))


@register("ads_metrics_range")
def q_ads_metrics_range(spark, sf_dir):
    return rounded(ads_table(spark, sf_dir, *si.ADS_RANGE))


@register("ads_metrics_stored_days")
def q_ads_metrics_stored_days(spark, sf_dir):
    """C4 of a range whose days were stored by earlier runs, but for the last
    one: the run of that day reads its reports and the stored days."""
    from channelmart.plans.ads_days import ads_daily_from_stored, store_days
    from channelmart.session import new_folder
    fine, store = si.ads_fine(spark, sf_dir), new_folder(spark, "stored-days")
    start, end = si.ADS_RANGE
    earlier, last = fine.where(F.col("data_date") < end), fine.where(F.col("data_date") == end)
    store_days(spark, si.ads_reports(earlier), store, start, si.ADS_LAST_STORED)
    store_days(spark, si.ads_reports(last), store, end, end)
    return rounded(ads_daily_from_stored(spark, si.ads_reports(fine, start, end), si.native_reports(fine), si.ads_properties(spark), store, start, end))


@register("ads_daily_summary")
def q_ads_daily_summary(spark, sf_dir):
    from channelmart.operators.summary import day_summary
    df = rounded(ads_table(spark, sf_dir))
    return rounded(day_summary(df, {"cost": "cost", "clicks": "clicks"}, exact_places=6))


# ------------------------------------------------------------ item revenue
@register("item_revenue")
def q_item_revenue(spark, sf_dir):
    from channelmart.plans.item_revenue import item_revenue
    return rounded(item_revenue(si.item_revenue_report(spark, sf_dir), si.ads_properties(spark)))


@register("item_revenue_summary")
def q_item_revenue_summary(spark, sf_dir):
    from channelmart.operators.summary import day_summary
    from channelmart.plans.item_revenue import item_revenue
    df = item_revenue(si.item_revenue_report(spark, sf_dir), si.ads_properties(spark))
    return rounded(day_summary(df, {"item_revenue": "item_revenue"}, exact_places=6))


# ------------------------------------------------------------------ search
def _snapshots(spark, sf_dir):
    from channelmart.plans.search import search_snapshot
    return search_snapshot(si.search_tables(spark, sf_dir), si.EXPORT_LOG, si.search_projects(spark),
                           si.EVENTS_AS_OF, tie_breakers=("event_id",))


@register("search_window")
def q_search_window(spark, sf_dir):
    from channelmart.operators.summary import snapshot_counts
    snaps = _snapshots(spark, sf_dir)
    parts = [df.select("property_name", F.lit(name).alias("table_name"), "date") for name, df in snaps.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return snapshot_counts(union, ["property_name", "table_name", "date"])


@register("search_days")
def q_search_days(spark, sf_dir):
    """S6 + F7: the rows of both search tables."""
    snaps = _snapshots(spark, sf_dir)
    return reduce(DataFrame.unionByName, [
        snaps[name].select(F.lit(name).alias("table_name"), "property_name", "date", "event_id", "user_id", "query", "impressions")
        for name in si.SEARCH_TABLES])


@register("snapshot_kept_days")
def q_snapshot_kept_days(spark, sf_dir):
    """Two overlapping runs write their snapshots; in the second the
    tables have a column more and one day no rows. What is read back: days of
    the first run alone and the day without rows as the first run left them,
    the new column null in them."""
    from channelmart.plans.search import run_search_snapshot
    from channelmart.session import new_folder
    from channelmart.sinks.writers import read_partitions
    root, projects = new_folder(spark, "snapshots"), si.search_projects(spark)
    run_search_snapshot(si.search_tables(spark, sf_dir), si.EXPORT_LOG, projects, root, si.SNAPSHOT_FIRST)
    run_search_snapshot(si.later_search_tables(spark, sf_dir), si.EXPORT_LOG, projects, root, si.EVENTS_AS_OF)
    return reduce(DataFrame.unionByName, [
        read_partitions(spark, f"{root}/{name}", merge=True)
        .select(F.lit(name).alias("table_name"), "property_name", "date", "event_id", "query", "impressions", "position")
        for name in si.SEARCH_TABLES])


@register("export_log_top100")
def q_export_log_top100(spark, sf_dir):
    snap = _snapshots(spark, sf_dir)[si.EXPORT_LOG]
    return snap.select("property_name", "date", "event_id", "table_name",
                       F.unix_micros("publish_time").alias("publish_time_us"))


# ------------------------------------------------------------ reservations
RES_START, RES_END = "1994-12-31", "2001-12-31"   # every creation day of the orders table


@register("reservations_normalised")
def q_reservations_normalised(spark, sf_dir):
    from channelmart.plans.reservations import COLUMNS, creation_window, normalize_reservations
    norm = normalize_reservations(creation_window(si.reservations(spark, sf_dir), RES_START, RES_END))
    kept = norm.where(F.col("created_date_utc").between(RES_START, RES_END))
    return kept.join(si.reservation_properties(spark), "property_id").select(
        *[c for c in COLUMNS if c != "rate"])


@register("reservation_rates")
def q_reservation_rates(spark, sf_dir):
    from channelmart.plans.reservations import export_reservations
    return export_reservations(si.reservations(spark, sf_dir), si.daily_rates(spark, sf_dir),
                               si.reservation_properties(spark), RES_START, RES_END)


# ------------------------------------------------------------ landed pages
@register("landed_reports")
def q_landed_reports(spark, sf_dir):
    """Last row of each key in report order, beside the
    number of rows and their sum."""
    from channelmart.operators.overlay import last_row_wins
    from channelmart.sources.reports import REPORT_SPECS, parse_report
    rows = parse_report(si.report_pages(spark, sf_dir), *REPORT_SPECS["item_revenue"])
    keys = ["property_name", "channel", "item_name"]
    last = last_row_wins(rows, keys, ["date", "item_revenue", "items_purchased"]).drop("first_pos")
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("item_revenue").alias("sum_revenue"), F.sum("items_purchased").alias("sum_items"))
    return rounded(last.join(sums, keys))


@register("landed_searches")
def q_landed_searches(spark, sf_dir):
    """Every row of the search pages."""
    from channelmart.sources.ads_search import parse_ads_search
    rows = parse_ads_search(si.search_pages(spark, sf_dir), "ad_group")
    exact = (F.col("conversions") * 1000000000).cast("long").alias("conversions_e9")
    return rounded(rows.select("data_date", "campaign", "ad_group", "cost", "clicks", "impressions", exact, "revenue", F.col("pos.page").alias("page")))


@register("landed_reservations")
def q_landed_reservations(spark, sf_dir):
    """S3: the objects of every page shape."""
    from channelmart.sources.reservations import RESERVATION_FIELDS, parse_envelope
    rows = parse_envelope(si.reservation_pages(spark, sf_dir), RESERVATION_FIELDS)
    return rows.select(F.col("pos.page").alias("page"), "id", "status", "bookingSourceName", F.get_json_object("primaryGuest", "$.lastName").alias("last_name"))


@register("landed_rates")
def q_landed_rates(spark, sf_dir):
    """Sums of the complete rate rows."""
    from channelmart.sources.reservations import parse_daily_rates
    rows = parse_daily_rates(si.rate_pages(spark, sf_dir)).where("reservationId is not null and totalRateAmount is not null and stayDate is not null")
    return rounded(rows.groupBy(F.col("reservationId").cast("long").alias("reservation_id")).agg(F.sum("totalRateAmount").alias("rate_sum"), F.max("stayDate").alias("last_stay")))


@register("landed_report_specs")
def q_landed_report_specs(spark, sf_dir):
    """Every report shape, its rows counted and summed."""
    from channelmart.sources.reports import REPORT_SPECS, parse_report
    dims = ("campaign", "channel", "ad_group", "medium", "item_name", "date")
    metrics = ("cost", "clicks", "impressions", "revenue", "conversions", "sessions", "item_revenue", "items_purchased")
    parts = []
    for name, (own, measured) in REPORT_SPECS.items():
        rows = parse_report(si.spec_pages(spark, sf_dir, own, measured), own, measured)
        have = {*own, *(m for m, _ in measured)}
        rows = rows.select("property_name", *[(F.col(d) if d in have else F.lit(None).cast("string")).alias(d) for d in dims],
                           *[(F.col(m).cast(DecimalType(30, 6)) if m in have else F.lit(None).cast(DecimalType(30, 6))).alias(m) for m in metrics])
        parts.append(rows.groupBy(F.lit(name).alias("report"), "property_name", "campaign", "channel").agg(
            F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.max("ad_group").alias("last_ad_group"),
            F.max("medium").alias("last_medium"), F.max("item_name").alias("last_item"), *[F.sum(m).alias(f"sum_{m}") for m in metrics]))
    return rounded(reduce(DataFrame.unionByName, parts))


@register("landed_search_campaigns")
def q_landed_search_campaigns(spark, sf_dir):
    """S2 at campaign level: the rows of the same pages without ad groups."""
    from channelmart.sources.ads_search import parse_ads_search
    rows = parse_ads_search(si.search_pages(spark, sf_dir), "campaign")
    exact = (F.col("conversions") * 1000000000).cast("long").alias("conversions_e9")
    return rounded(rows.select("data_date", "campaign", "cost", "clicks", "impressions", exact, "revenue", F.col("pos.page").alias("page")))


@register("landed_page_gaps")
def q_landed_page_gaps(spark, sf_dir):
    """The pages that two landings lack, have twice, or have behind their
    end (tokens of the ads search, full pages of the reservation search); one
    expected property has no pages."""
    from channelmart.sources.chains import chain_faults, list_chain, search_chain
    chains = {"ads search": search_chain(si.lossy_search_pages(spark, sf_dir)),
              "reservations": list_chain(si.lossy_reservation_pages(spark, sf_dir), si.PAGE_ORDERS)}
    expected = spark.createDataFrame([(p,) for p in (*si.CHAIN_PROPERTIES[:2], "west-ferry")], "property_name string")
    return reduce(DataFrame.unionByName, [chain_faults(c, 0, True, expected).select(F.lit(k).alias("landing"), "property_name", "page", "fault") for k, c in chains.items()])


@register("landed_cut_reports")
def q_landed_cut_reports(spark, sf_dir):
    """Reports with other numbers of rows than they declare, and those
    that declare none and hold as many rows as requests give."""
    from channelmart.sources.chains import report_faults
    return report_faults(si.cut_reports(spark, sf_dir), limit=si.REPORT_ROWS)


@register("landed_properties")
def q_landed_properties(spark, sf_dir):
    """Property lists, one file each, as JSON over several lines."""
    from channelmart.session import new_folder
    from channelmart.sources.properties import read_properties
    path = new_folder(spark, "property-lists")
    si.property_lists(spark, sf_dir).write.option("maxRecordsPerFile", 1).text(path)
    return read_properties(spark, path)


# ------------------------------------------------------------- writes again
def _written(df: DataFrame, job: str, amount, units) -> DataFrame:
    """Days of a written table: rows and exact sums."""
    exact = DecimalType(38, 6)
    return df.groupBy("data_date").agg(F.count(F.lit(1)).alias("row_count"), F.sum(round_out(amount).cast(exact)).alias("amount"),
                                       F.sum(round_out(units).cast(exact)).alias("units")).withColumn("job", F.lit(job))


@register("rewritten_days")
def q_rewritten_days(spark, sf_dir):
    """K1, K2, K5: of each job two overlapping runs write, then one without
    rows, and the days are read back: those of the first run alone survive,
    shared days are the second's (and the first's where the second has no
    rows), and the empty run changes nothing."""
    from channelmart.plans.ads_daily import run_ads_daily
    from channelmart.plans.item_revenue import run_item_revenue
    from channelmart.plans.reservations import run_export_reservations
    from channelmart.session import new_folder
    from channelmart.sinks.writers import read_partitions
    root, props, as_of = new_folder(spark, "rewritten-days"), si.ads_properties(spark), "1999-01-01"
    fine = si.ads_fine(spark, sf_dir)
    for run in (si.FIRST_RUN, si.SECOND_RUN, si.EMPTY_RUN):
        run_ads_daily(si.ads_reports(fine, *run), si.native_reports(fine), props, f"{root}/ads", as_of, *run)
    report = si.landed_item_report(spark, sf_dir)
    for rows, run in ((report, si.ITEM_FIRST), (si.restated(report), si.ITEM_SECOND), (report, si.EMPTY_RUN)):
        run_item_revenue(rows, props, f"{root}/items", as_of, *run)
    res, rates, stays = si.reservations(spark, sf_dir), si.daily_rates(spark, sf_dir), si.reservation_properties(spark)
    for rows, run in ((res, si.STAY_FIRST), (res.where(F.col("property_id") == si.LATER_PROPERTY), si.STAY_SECOND), (res, si.EMPTY_RUN)):
        run_export_reservations(rows, rates, stays, f"{root}/stays", as_of, *run)
    parts = [_written(read_partitions(spark, f"{root}/ads"), "ads", F.col("revenue_ga4"), F.col("clicks")),
             _written(read_partitions(spark, f"{root}/items"), "items", F.col("item_revenue"), F.col("items_purchased")),
             _written(read_partitions(spark, f"{root}/stays"), "stays", F.col("rate").cast(DecimalType(20, 2)), F.col("res_no"))]
    return rounded(reduce(DataFrame.unionByName, parts))


# ------------------------------------------------------------- date rules
@register("month_to_date")
def q_month_to_date(spark, sf_dir):
    """D1+D2 for every ship day d as the day before ``as_of``: the
    month-to-date window [first of d's month, d] and its quantity/lines.
    Daily partial aggregates, then a running sum within each month."""
    from pyspark.sql import Window
    from channelmart.functions.dates import range_bounds_col
    li = si.table(spark, sf_dir, "lineitem")
    daily = (li.groupBy(F.to_date("l_shipdate").alias("day"))
             .agg(F.sum(F.col("l_quantity").cast("long")).alias("qty"), F.count(F.lit(1)).alias("lines")))
    as_of = F.date_add("day", 1)
    start, end = range_bounds_col(as_of)
    w = Window.partitionBy(F.trunc("day", "MM")).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        F.date_format(as_of, "yyyy-MM-dd").alias("as_of"),
        F.date_format(start, "yyyy-MM-dd").alias("range_start"),
        F.date_format(end, "yyyy-MM-dd").alias("range_end"),
        F.sum("qty").over(w).alias("mtd_quantity"),
        F.sum("lines").over(w).alias("mtd_lines"),
    )
