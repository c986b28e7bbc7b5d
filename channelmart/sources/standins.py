"""Stand-in inputs derived from the driver's tables (FIXTURES.md section 2).

The production inputs are landed API responses (see ``reports``,
``ads_search``, ``reservations``) and event/search tables. For tests and the
bench the same typed frames are derived from the TPC-H-like tables, so every
query reads the given tables and its work grows with them. Every view keeps a
``property_name`` (or ``property_id``) column: all properties run in one plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from channelmart.functions.exprs import MONEY, NOT_SET, PAID_MEDIUM, default_channel
from channelmart.session import stage

# Stand-in run parameters. The report views cover all of lineitem; this is
# the range of the one query that asks for a range.
ADS_RANGE = ("1998-01-01", "1998-03-31")
ADS_LAST_STORED = "1998-03-30"         # the day before the range's last
EVENTS_AS_OF = "2024-01-31"            # search window = 2024-01-24 .. 2024-01-30
EVENT_PROPERTY_ID, EVENT_PROPERTY_NAME = "100001", "north-lounges"

# Invented property dimension; the second property reports analytics revenue in
# another currency than its ads account (FX divisor 1.3492).
ADS_PROPERTIES = [
    {"property_name": "north-lounges", "fx_divisor": 1.0},
    {"property_name": "south-stays", "fx_divisor": 1.3492},
]
RESERVATION_PROPERTIES = [
    {"propertyId": 1, "clientName": "Harbour View", "location": "Sydney"},
    {"propertyId": 2, "clientName": "Airport Inn", "location": "Manchester"},
    {"propertyId": 3, "clientName": "Old Mill"},           # no location -> ''
]
SEARCH_PROJECTS = [
    {"project_id": "proj-lounge", "property_name": "north-lounges"},
    {"project_id": "proj-stays", "property_name": "south-stays"},
    {"project_id": "  ", "property_name": "ghost-site"},  # blank id: skipped
    {"project_id": "proj-parking", "property_name": "east-parking"},
]
SEARCH_TABLES = ("searchdata_site_impression", "searchdata_url_impression")
EXPORT_LOG = "ExportLog"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(sf_dir, name))


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def _dec(c: str, p: int = 12, s: int = 2) -> Column:
    return F.col(c).cast(DecimalType(p, s))


# ----------------------------------------------------------------- ads views
def ads_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of lineitem x part with the campaign/ad group/channel rules of
    FIXTURES 2."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    brand_no = F.substring_index("p_brand", "#", -1).try_cast("int")
    campaign = (F.when(F.col("p_brand") == "Brand#25", F.lit(NOT_SET))
                .when(brand_no % 5 == 0, F.concat(F.lit("PMax "), F.col("p_brand")))
                .otherwise(F.col("p_brand")))
    names = [p["property_name"] for p in ADS_PROPERTIES]
    df = (li.join(part, li.l_partkey == part.p_partkey)
          .withColumn("property_name", F.when(F.col("l_suppkey") % 2 == 0, F.lit(names[0])).otherwise(F.lit(names[1])))
          .withColumn("campaign", campaign))
    ad_group = (F.when(F.col("campaign").startswith("PMax "), F.lit(NOT_SET))
                .when(F.col("p_size") <= 3, F.lit(NOT_SET))
                .otherwise(F.col("p_type")))
    channel = (F.when(F.col("l_returnflag") == "R", default_channel("campaign"))
               .when(F.col("l_returnflag") == "A", F.lit("Organic Search"))
               .when(F.col("l_returnflag") == "N", F.lit("Direct")))
    medium = (F.when(F.col("l_returnflag") == "R", F.lit(PAID_MEDIUM))
              .when(F.col("l_linestatus") == "F", F.lit("referral"))
              .when(F.col("l_linestatus") == "O", F.lit("organic")))
    qty = F.col("l_quantity").cast("long")
    return df.select(
        "property_name", "campaign",
        ad_group.alias("ad_group"), channel.alias("channel"), medium.alias("medium"),
        F.translate(F.to_date("l_shipdate").cast("string"), "-", "").alias("date"),
        F.to_date("l_shipdate").cast("string").alias("data_date"),
        qty.alias("qty"),
        (qty * F.col("p_size")).alias("qty_size"),
        (_dec("l_extendedprice") * (F.lit(1) - _dec("l_discount", 4, 2))).alias("net"),
        (_dec("l_extendedprice") * _dec("l_tax", 4, 2)).alias("tax_amt"),
    )


def _pos(*cols: str) -> Column:
    # Report order of the stand-ins: dense order of (campaign, ad group).
    return F.struct(*[F.col(c) for c in cols]).alias("pos")


FINE_KEYS = ["property_name", "date", "data_date", "campaign", "ad_group", "channel", "medium"]


def ads_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base rolled up to its finest report grain; every report view
    re-aggregates this. It stands for the landed report files, so a query
    stages it once: each view prunes different columns and pushes different
    filters, which would otherwise rescan lineitem x part once per view."""
    fine = ads_base(spark, sf_dir).groupBy(*FINE_KEYS).agg(
        F.sum("tax_amt").alias("tax_amt"), F.sum("qty").alias("qty"), F.sum("qty_size").alias("qty_size"),
        F.sum("net").alias("net"), F.count(F.lit(1)).alias("lines"))
    return stage(fine, "ads-fine")


def _ads_metrics() -> list[Column]:
    return [F.sum("tax_amt").cast(MONEY).alias("cost"),
            F.sum("qty").alias("clicks"),
            F.sum("qty_size").alias("impressions")]


def _an_metrics() -> list[Column]:
    return [F.sum("net").cast(MONEY).alias("revenue"),
            F.sum("lines").cast(MONEY).alias("conversions"),
            F.sum("qty").alias("sessions")]


def ads_reports(b: DataFrame, start: str | None = None, end: str | None = None) -> dict[str, DataFrame]:
    """The six analytics report frames of ``ads_fine`` rows, typed as
    ``sources.reports`` returns them. The range reports are asked for a range
    of days; the daily reports hold every day."""
    asked = b.where(F.col("data_date").between(start, end)) if start and end else b
    out = {
        "range_ads": asked.groupBy("property_name", "campaign", "ad_group").agg(*_ads_metrics()),
        "range_analytics": asked.groupBy("property_name", "campaign", "ad_group", "channel", "medium").agg(*_an_metrics()),
        "day_campaign_ads": b.groupBy("property_name", "date", "campaign").agg(*_ads_metrics()),
        "day_campaign_analytics": b.groupBy("property_name", "date", "campaign", "channel", "medium").agg(*_an_metrics()),
        "day_adgroup_ads": b.groupBy("property_name", "date", "campaign", "ad_group").agg(*_ads_metrics()),
        # Thresholding: small ad-group rows vanish from the daily analytics report.
        "day_adgroup_analytics": (b.groupBy("property_name", "date", "campaign", "ad_group", "channel", "medium")
                                  .agg(*_an_metrics()).where(F.col("sessions") >= 10)),
    }
    for name, df in out.items():
        keys = ["campaign", "ad_group"] if "ad_group" in df.columns else ["campaign"]
        out[name] = df.withColumn("pos", _pos(*keys))
    return out


def native_reports(b: DataFrame) -> dict[str, DataFrame]:
    """Ads-platform rows of ``ads_fine`` rows at campaign and ad-group level
    (``sources.ads_search`` shape). The ad-group level leaves out PMax
    campaigns; the rows of every 13th of a month have no day (F11)."""
    b = b.withColumn("data_date", F.when(~F.col("data_date").endswith("-13"), F.col("data_date")))
    m = [(F.sum("tax_amt") * F.lit(1000000)).cast("long").alias("cost_micros"),
         F.sum("qty").alias("clicks"), F.sum("qty_size").alias("impressions"),
         F.sum("lines").cast(MONEY).alias("conversions"),
         F.sum("net").cast(MONEY).alias("revenue")]
    camp = b.groupBy("property_name", "data_date", "campaign").agg(*m)
    adg = (b.where(~F.col("campaign").startswith("PMax "))
           .groupBy("property_name", "data_date", "campaign", "ad_group").agg(*m))
    def typed(df: DataFrame) -> DataFrame:
        keys = ["campaign", "ad_group"] if "ad_group" in df.columns else ["campaign"]
        return (df.withColumn("cost", (F.col("cost_micros").cast(MONEY) / F.lit(1000000)).cast(MONEY))
                .drop("cost_micros").withColumn("pos", _pos(*keys)))
    return {"campaign": typed(camp), "ad_group": typed(adg)}


def ads_properties(spark: SparkSession) -> DataFrame:
    from channelmart.sources.properties import properties_dim
    return properties_dim(spark, ADS_PROPERTIES)


# ---------------------------------------------------------------- events view
EVENT_PARAM_TYPE = ("struct<string_value:string,int_value:bigint,"
                    "float_value:double,double_value:double>")


def _param(string_value=None, int_value=None, double_value=None) -> Column:
    return F.struct(
        (string_value if string_value is not None else F.lit(None)).cast("string").alias("string_value"),
        (int_value if int_value is not None else F.lit(None)).cast("bigint").alias("int_value"),
        F.lit(None).cast("double").alias("float_value"),
        (double_value if double_value is not None else F.lit(None)).cast("double").alias("double_value"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analytics-export shaped events: name, micros timestamp, pseudo user
    (null every 7th id), yyyyMMdd date and a parameter map (empty for errors)."""
    e = table(spark, sf_dir, "events")
    params = F.create_map(
        F.lit("k"), _param(int_value=F.get_json_object("props", "$.k").try_cast("bigint")),
        F.lit("value"), _param(double_value=F.col("value")),
        F.lit("type"), _param(string_value=F.col("event_type")),
    )
    empty = F.create_map().cast(f"map<string,{EVENT_PARAM_TYPE}>")
    return e.select(
        "event_id",
        F.col("event_type").alias("event_name"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("event_timestamp"),
        F.when(F.col("event_id") % 7 != 0, F.col("user_id").cast("string")).alias("user_pseudo_id"),
        F.translate(F.to_date("ts").cast("string"), "-", "").alias("event_date"),
        F.when(F.col("event_type") == "error", empty).otherwise(params).alias("event_params"),
    )


# ---------------------------------------------------------- item revenue view
def item_revenue_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item revenue report rows (date, channel group, item name | revenue,
    items); returned lines (flag R) report zero."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    names = [p["property_name"] for p in ADS_PROPERTIES]
    returned = F.col("l_returnflag") == "R"
    net = _dec("l_extendedprice") * (F.lit(1) - _dec("l_discount", 4, 2))
    df = li.join(part, li.l_partkey == part.p_partkey).select(
        F.when(F.col("l_suppkey") % 2 == 0, F.lit(names[0])).otherwise(F.lit(names[1])).alias("property_name"),
        F.translate(F.to_date("l_shipdate").cast("string"), "-", "").alias("date"),
        F.when(F.col("l_linestatus") == "F", F.lit("Organic Search")).otherwise(F.lit("Paid Search")).alias("channel"),
        F.col("p_name").alias("item_name"),
        F.when(returned, F.lit(0)).otherwise(net).alias("net"),
        F.when(returned, F.lit(0)).otherwise(F.col("l_quantity").cast("long")).alias("qty"),
    )
    return (df.groupBy("property_name", "date", "channel", "item_name")
            .agg(F.sum("net").cast(MONEY).alias("item_revenue"), F.sum("qty").alias("items_purchased"))
            .withColumn("pos", _pos("date", "channel", "item_name")))


def landed_item_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item revenue report as landed files: staged once for runs that read
    it several times, which would each join lineitem and part again."""
    return stage(item_revenue_report(spark, sf_dir), "item-report")


# ---------------------------------------------------------- reservation views
def reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservation objects as the landed JSON reader returns them (wide,
    every field nullable), one per order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    df = o.join(c, o.o_custkey == c.c_custkey)
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    created_ts = F.col("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int"))
    order_day = F.to_date("o_orderdate").cast("string")
    created_text = created_ts.cast("string")          # 'yyyy-MM-dd HH:mm:ss'
    created = (F.when(key % 50 == 0, F.concat(order_day, F.lit(" 99:99:99")))
               .when(key % 7 == 0, F.date_format(created_ts, "yyyy-M-d H:m:s"))        # unpadded
               .when(key % 2 == 0, created_text)
               .otherwise(F.translate(created_text, " ", "T")))
    source = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Sleepover Direct"))
              .when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
              .otherwise(F.col("o_orderpriority")))
    creator = F.element_at(F.array(F.lit("176"), F.lit("176.9"), F.lit("12"), F.lit("x")),
                           (cust % 4 + 1).cast("int"))
    room = F.concat(F.lit("Room-"), (F.col("c_nationkey") % 5).cast("string"))
    guest_alt = cust % 3 == 0
    status = (F.when(F.col("o_orderstatus") == "F", F.lit("Departed"))
              .when(F.col("o_orderstatus") == "O", F.lit("Confirmed"))
              .otherwise(F.lit("Cancelled")))
    null_s = F.lit(None).cast("string")
    # Landed pages are files; the view is staged like them, so that filters on
    # its fields do not re-derive every field.
    return stage(df.select(
        (F.lit(1) + F.col("c_nationkey") % 3).cast("int").alias("property_id"),
        key.alias("id"),
        F.lit(None).cast("bigint").alias("reservationId"),
        F.when(key % 3 != 0, F.concat(F.lit("OC"), key.cast("string"))).otherwise(F.lit("")).alias("onlineConfirmationId"),
        F.when(key % 4 != 1, created).alias("dateCreated"),
        F.when(key % 4 == 1, created).alias("createdDate"),
        F.concat(order_day, F.lit("T00:00:00")).alias("arrivalDate"),
        null_s.alias("arriveDate"),
        F.concat(F.date_add(F.col("o_orderdate").cast("date"), 60).cast("string"), F.lit(" 00:00:00")).alias("departureDate"),
        null_s.alias("departDate"),
        F.when(F.col("o_orderstatus") == "P", (created_ts + F.make_dt_interval(days=F.lit(1))).cast("string")).alias("dateCancelled"),
        null_s.alias("cancelledDate"),
        F.when(cust % 2 == 0, source).alias("bookingSourceName"),
        F.struct(F.when(cust % 2 == 1, source).alias("name")).alias("bookingSource"),
        creator.alias("createdById"),
        null_s.alias("travelAgentName"),
        F.struct(F.when(F.col("o_orderpriority") == "5-LOW",
                        F.concat(F.lit("Agent-"), F.col("c_nationkey").cast("string"))).alias("name")).alias("travelAgent"),
        null_s.alias("guestSurname"),
        null_s.alias("guestGiven"),
        (F.when(cust % 11 == 0, F.lit('{"id": 7}'))                                  # there, but without names
         .when(~guest_alt, F.to_json(F.struct(F.col("c_name").alias("lastName"), F.col("c_mktsegment").alias("firstName"))))
         .when(cust % 2 == 0, F.lit("{}"))).alias("primaryGuest"),
        F.when(guest_alt | (cust % 11 == 0), F.to_json(F.struct(F.col("c_name").alias("surname"), F.col("c_mktsegment").alias("given")))).alias("guest"),
        F.when(key % 2 == 0, room).alias("categoryName"),
        F.struct(F.when(key % 2 == 1, room).alias("name")).alias("category"),
        status.alias("status"),
        F.when(cust % 5 == 0, F.lit("")).when(F.col("c_nationkey") % 2 == 0, F.lit("GBP")).alias("currency"),
        F.when((F.col("c_nationkey") % 2 == 1) & (cust % 5 != 0), F.lit("AUD")).alias("currencyCode"),
    ), "reservations")


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate rows: one per line item (reservation = order, stay = ship day),
    with amounts of three decimals."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("reservationId"),
        (F.col("l_extendedprice").cast(DecimalType(18, 2)) + F.col("l_linenumber").cast(DecimalType(3, 0)) * F.lit("0.003").cast(DecimalType(4, 3))).alias("totalRateAmount"),
        F.to_date("l_shipdate").cast("string").alias("stayDate"),
    )


def reservation_properties(spark: SparkSession) -> DataFrame:
    from channelmart.sources.properties import reservation_properties_dim
    return reservation_properties_dim(spark, RESERVATION_PROPERTIES)


# --------------------------------------------------------------- search views
def search_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Per-project search tables with a DATE ``data_date``, plus the export log
    with ``publish_time``; ``project_id`` says which project owns a row."""
    e = table(spark, sf_dir, "events")
    ids = F.array(*[F.lit(p["project_id"]) for p in SEARCH_PROJECTS])
    base = e.select(
        F.element_at(ids, (F.col("user_id") % len(SEARCH_PROJECTS) + 1).cast("int")).alias("project_id"),
        "event_id", "user_id", F.col("event_type").alias("query"), F.col("value").alias("impressions"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.to_date("ts").alias("data_date"),
    )
    return {
        SEARCH_TABLES[0]: base.where(F.col("query") != "error").drop("ts"),
        SEARCH_TABLES[1]: base.drop("ts"),
        EXPORT_LOG: base.select("project_id", "event_id", F.col("query").alias("table_name"),
                                F.col("ts").alias("publish_time")),
    }


def search_projects(spark: SparkSession) -> DataFrame:
    from channelmart.sources.properties import search_projects_dim
    return search_projects_dim(spark, SEARCH_PROJECTS)


# ---------------------------------------------------------------- landed pages
PAGE_ORDERS = 100     # orders of a page, so a page is bounded


def _listed(rows: DataFrame, key: str, order: list[str], item: Column) -> DataFrame:
    """Pages of PAGE_ORDERS keys each (``page``, ``rows``: the items in order)."""
    # The fields are built below the grouping, whose own arguments are evaluated row by row without generated code.
    fields = F.struct(*[F.col(c) for c in order], item.alias("item"))
    lines = rows.select(F.floor(F.col(key) / PAGE_ORDERS).alias("page"), fields.alias("fields"))
    return lines.groupBy("page").agg(F.sort_array(F.collect_list("fields")).alias("rows")).select("page", F.col("rows.item").alias("rows"))


def _pages(rows: DataFrame, key: str, order: list[str], item: Column, wrap) -> DataFrame:
    """Pages (``page``, ``value``) of JSON text: the items of PAGE_ORDERS keys
    each, in order, as ``wrap`` puts the array into a page."""
    return _listed(rows, key, order, item).select("page", wrap(F.col("rows")).alias("value"))


def _value(c: Column) -> Column:
    return F.struct(c.cast("string").alias("value"))


def report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item revenue responses of the lines, one page per 100 orders: values by
    position, the second metric missing on every seventh line, every tenth
    page without rows, property by page."""
    li = table(spark, sf_dir, "lineitem")
    revenue = _value(_dec("l_extendedprice"))
    metrics = F.when(F.col("l_linenumber") == 7, F.array(revenue)).otherwise(F.array(revenue, _value(F.col("l_quantity").cast("long"))))
    item = F.struct(F.array(_value(F.translate(F.to_date("l_shipdate").cast("string"), "-", "")), _value(F.col("l_returnflag")),
                            _value(F.concat(F.lit("item-"), (F.col("l_suppkey") % 10).cast("string")))).alias("dimensionValues"),
                    metrics.alias("metricValues"))

    def wrap(items: Column) -> Column:
        return F.when(F.col("page") % 10 == 9, F.lit('{"kind": "empty report"}')).otherwise(F.to_json(F.struct(items.alias("rows"))))

    pages = _pages(li, "l_orderkey", ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"], item, wrap)
    return pages.withColumn("property_name", F.when(F.col("page") % 2 == 0, F.lit("north-lounges")).otherwise(F.lit("south-stays")))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads search responses of the lines: the campaign missing on second
    lines, the ad group's name on third ones, impressions on fourth ones."""
    li = table(spark, sf_dir, "lineitem")
    line = F.col("l_linenumber")
    conversions = _dec("l_tax", 4, 2) + F.lit("0.123456789").cast(DecimalType(10, 9))
    item = F.struct(
        F.struct(F.to_date("l_shipdate").cast("string").alias("date")).alias("segments"),
        F.when(line != 2, F.struct(F.concat(F.lit("camp-"), (F.col("l_partkey") % 9).cast("string")).alias("name"))).alias("campaign"),
        F.struct(F.when(line != 3, F.concat(F.lit("group-"), (F.col("l_suppkey") % 9).cast("string"))).alias("name")).alias("adGroup"),
        F.struct((_dec("l_extendedprice") * 1000000).cast("long").cast("string").alias("costMicros"),
                 F.col("l_quantity").cast("long").cast("string").alias("clicks"),
                 F.when(line != 4, F.col("l_orderkey") + F.lit(9007199254740993)).cast("string").alias("impressions"),
                 conversions.cast("string").alias("conversions"), _dec("l_discount", 4, 2).cast("string").alias("conversionsValue")).alias("metrics"))
    return _pages(li, "l_orderkey", ["l_orderkey", "l_linenumber"], item, lambda items: F.to_json(F.struct(items.alias("results"))))


def reservation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservation responses of the orders in the five page shapes (by page
    number): a list with elements that are no objects and one with a list of
    its own, the three envelopes, and a single object."""
    orders = table(spark, sf_dir, "orders")
    item = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).alias("bookingSourceName"),
                    F.when(F.col("o_orderkey") % 3 == 0, F.struct(F.col("o_custkey").alias("lastName"))).alias("primaryGuest"))

    def wrap(items: Column) -> Column:
        text = F.to_json(items)
        inner = F.substring(text, F.lit(2), F.length(text) - 2)
        shapes = [F.concat(F.lit(' [3, null, "x", '), inner, F.lit(', {"id": -1, "data": [{"id": -2}]}]')),
                  F.concat(F.lit('{"items": [7, '), inner, F.lit('], "total": 1}')), F.concat(F.lit('{"results": ['), inner, F.lit("]}")),
                  F.concat(F.lit('{"data": ['), inner, F.lit("]}")), F.to_json(items[0])]
        return F.element_at(F.array(*shapes), (F.col("page") % 5 + 1).cast("int"))

    return _pages(orders, "o_orderkey", ["o_orderkey"], item, wrap)


def rate_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate responses of the lines; amounts missing on fifth lines, stay days
    on sixth ones (F8)."""
    li = table(spark, sf_dir, "lineitem")
    item = F.struct(F.col("l_orderkey").alias("reservationId"),
                    F.when(F.col("l_linenumber") != 5, _dec("l_extendedprice")).alias("totalRateAmount"),
                    F.when(F.col("l_linenumber") != 6, F.to_date("l_shipdate").cast("string")).alias("stayDate"))
    return _pages(li, "l_orderkey", ["l_orderkey", "l_linenumber"], item, lambda items: F.to_json(F.struct(items.alias("data"))))


# ----------------------------------------------- landings with pages lost
REPORT_ROWS = 10      # rows that a stand-in report request asks for
CHAIN_PROPERTIES = ("north-lounges", "south-stays", "east-parking")


def _lossy(pages: DataFrame, properties: tuple[str, ...]) -> DataFrame:
    """Pages dealt to properties, numbered from 0 in each (``last``: the
    number of a property's last one), with every page 3 of 7 lost, one
    property's last page lost, and every page 5 of 11 landed twice."""
    n = len(properties)
    named = pages.select(F.element_at(F.array(*[F.lit(p) for p in properties]), (F.col("page") % n + 1).cast("int")).alias("property_name"),
                         F.floor(F.col("page") / n).alias("page"), "value")
    lasts = named.groupBy("property_name").agg(F.max("page").alias("last"))
    # One row per property goes to the pages: joined by an exchange on the property, all its pages would meet in one task.
    rows = named.join(F.broadcast(lasts), "property_name")
    lost = (F.col("page") % 7 == 3) | ((F.col("property_name") == properties[1]) & (F.col("page") == F.col("last")))
    copies = F.when(F.col("page") % 11 == 5, 2).otherwise(1)
    return rows.where(~lost).withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")


def lossy_search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ads search pages with tokens; the token of every page 6 of 13 is empty,
    as if the page were the last."""
    rows = _lossy(search_pages(spark, sf_dir), CHAIN_PROPERTIES)
    token = (F.when(F.col("page") == F.col("last"), F.lit("}"))
             .when(F.col("page") % 13 == 6, F.lit(', "nextPageToken": ""}'))
             .otherwise(F.concat(F.lit(', "nextPageToken": "t'), F.col("page").cast("string"), F.lit('"}'))))
    whole = F.concat(F.expr("left(value, length(value) - 1)"), token)
    return rows.select("property_name", "page", whole.alias("value"))


def lossy_reservation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservation pages asked for by PAGE_ORDERS; every fifth one is a single
    object, so a short page with others behind it."""
    return _lossy(reservation_pages(spark, sf_dir), CHAIN_PROPERTIES[:2]).select("property_name", "page", "value")


def cut_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item revenue responses that declare their rows: every page 4 of 9
    declares some more than it holds, every page 5 of 9 none at all, every page
    7 of 9 less. Each response is its own report (``report``)."""
    rows = report_pages(spark, sf_dir)
    n = F.coalesce(F.json_array_length(F.get_json_object("value", "$.rows")), F.lit(0))
    declared = (F.when(F.col("page") % 9 == 4, n + F.col("page") % 3).when(F.col("page") % 9 == 7, F.greatest(n - 1, F.lit(0)))
                .when(F.col("page") % 9 != 5, n))
    count = F.coalesce(F.concat(F.lit(', "rowCount": '), declared.cast("string"), F.lit("}")), F.lit("}"))
    return rows.select("property_name", F.col("page").alias("report"), "page", F.concat(F.expr("left(value, length(value) - 1)"), count).alias("value"))


# --------------------------------------------- responses of every report shape
def spec_pages(spark: SparkSession, sf_dir: str, dims: list[str], metrics: list[tuple[str, str]]) -> DataFrame:
    """Responses of the lines in the shape of any report, one page per 100
    orders: what a dimension or metric holds follows from its name. The lines
    are grouped with the texts of all names, so that every shape has the same
    exchange (Spark makes it once) and only puts its texts together."""
    li = table(spark, sf_dir, "lineitem")
    values = {"date": F.translate(F.to_date("l_shipdate").cast("string"), "-", ""),
              "campaign": F.concat(F.lit("camp-"), (F.col("l_partkey") % 9).cast("string")),
              "ad_group": F.concat(F.lit("group-"), (F.col("l_suppkey") % 7).cast("string")),
              "channel": F.col("l_returnflag"), "medium": F.col("l_linestatus"),
              "item_name": F.concat(F.lit("item-"), (F.col("l_suppkey") % 10).cast("string")),
              "cost": _dec("l_extendedprice"), "revenue": _dec("l_extendedprice") * 2, "item_revenue": _dec("l_extendedprice") * 3,
              "clicks": F.col("l_quantity").cast("long"), "sessions": F.col("l_quantity").cast("long") + 1,
              "items_purchased": F.col("l_quantity").cast("long") + 2, "impressions": F.col("l_linenumber").cast("long") * 10,
              "conversions": _dec("l_tax", 4, 2)}
    texts = F.struct(*[F.to_json(_value(c)).alias(name) for name, c in values.items()])
    pages = _listed(li, "l_orderkey", ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"], texts)

    def item(line: Column) -> Column:
        return F.concat(F.lit('{"dimensionValues":['), *_commas([line[d] for d in dims]),
                        F.lit('],"metricValues":['), *_commas([line[m] for m, _ in metrics]), F.lit("]}"))

    value = F.concat(F.lit('{"rows":['), F.array_join(F.transform("rows", item), ","), F.lit("]}"))
    return pages.select("page", value.alias("value"), F.when(F.col("page") % 2 == 0, F.lit("north-lounges")).otherwise(F.lit("south-stays")).alias("property_name"))


def _commas(texts: list[Column]) -> list[Column]:
    return [part for text in texts for part in (F.lit(","), text)][1:]


# ------------------------------------------------------ runs that write again
FIRST_RUN, SECOND_RUN, EMPTY_RUN = ("1998-01-01", "1998-02-15"), ("1998-02-01", "1998-03-31"), ("1980-01-01", "1980-01-31")
ITEM_FIRST, ITEM_SECOND = ("1992-01-01", "1996-12-31"), ("1996-01-01", "1998-12-31")
STAY_FIRST, STAY_SECOND = ("1994-12-31", "1996-12-31"), ("1996-06-01", "2001-12-31")
LATER_PROPERTY = 2                     # the reservation property whose landing the second run has
SNAPSHOT_FIRST, LOST_DAY = "2024-01-29", "2024-01-26"


def restated(report: DataFrame) -> DataFrame:
    """A later delivery of the item revenue report: one item more in each row."""
    return report.withColumn("items_purchased", F.col("items_purchased") + 1)


def later_search_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The search tables some days later: with one more column, and without
    the rows of one day."""
    tables = search_tables(spark, sf_dir)
    return {name: df if name == EXPORT_LOG else df.withColumn("position", F.col("impressions") * 2).where(F.col("data_date") != F.to_date(F.lit(LOST_DAY)))
            for name, df in tables.items()}


def event_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with their parameters as exported, an array of {key, value}
    in which the key ``k`` comes twice; null for every eleventh event."""
    e = events(spark, sf_dir)
    fields = [f.split(":")[0] for f in EVENT_PARAM_TYPE[len("struct<"):-1].split(",")]
    known = F.transform(F.map_entries("event_params"), lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value")))
    k = F.col("event_params")["k"]
    again = F.array(F.struct(F.lit("k").alias("key"), F.struct(*[(k[f] + 1 if f == "int_value" else k[f]).alias(f) for f in fields]).alias("value")))
    params = F.when(F.col("event_id") % 11 != 0, F.when(F.size("event_params") > 0, F.concat(known, again)).otherwise(known))
    return e.withColumn("event_params", params)


def property_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration lists (``value``), one for each nation's suppliers: ids as
    numbers and as text, locations missing for some."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    location = F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit(', "location": "Pier '), (F.col("s_suppkey") % 50).cast("string"), F.lit('"')))
    item = F.concat(F.lit('{"propertyId": '), F.when(F.col("s_suppkey") % 2 == 0, key).otherwise(F.concat(F.lit('"'), key, F.lit('"'))),
                    F.lit(', "clientName": "'), F.col("s_name"), F.lit('"'), F.coalesce(location, F.lit("")), F.lit("}"))
    return s.groupBy("s_nationkey").agg(F.concat(F.lit("["), F.array_join(F.collect_list(item), ", "), F.lit("]")).alias("value")).select("value")
