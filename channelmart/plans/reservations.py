"""Normalise reservations, keep those created on the target day(s) after
the fixed -3 h shift, and add their stay-window rates."""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from channelmart.functions.dates import resolve_range, stay_limit
from channelmart.functions.exprs import (booking_agent, date_prefix, first_non_empty,
                                         money_text, parse_and_shift)
from channelmart.session import kept, stage, staged_run
from channelmart.sinks.writers import write_partitions

# Fixed values of the export: defaults, output columns in order, source fields.
CONFIRMATION_DEFAULT = "REST API"
CURRENCY_DEFAULT = "USD"
DATE_PAID = "N/A"
SHIFT_HOURS = -3

COLUMNS = [
    "res_no", "rms_conf_no", "date_made_utc", "arrive", "depart", "reservation_agent",
    "surname", "given", "accommodation", "rate", "date_paid", "property_id", "property_name",
    "location", "status", "booking_source_name", "currency", "created_date_utc",
    "cancelled_date_utc",
]
GUEST_FIELDS = ("lastName", "surname", "firstName", "given")


def _field(df: DataFrame, path: str) -> Column:
    """Column for a (possibly nested) field; a path absent from the schema is null."""
    node = df.schema
    for part in path.split("."):
        names = {f.name: f for f in node.fields} if hasattr(node, "fields") else {}
        if part not in names:
            return F.lit(None).cast("string")
        node = names[part].dataType
    return F.col(path)


def _chosen_guest(df: DataFrame) -> Column:
    """The primary guest unless missing or empty ({} falls through), else
    the guest. Both are JSON objects as text, so an object that holds none of
    the four names (an id alone) still counts as there."""
    primary, other = _field(df, "primaryGuest"), _field(df, "guest")
    chosen = F.when(F.regexp_replace(F.coalesce(primary, F.lit("")), r"\s", "").isin("", "{}", "null"), other).otherwise(primary)
    return F.from_json(chosen, ", ".join(f"{f} string" for f in GUEST_FIELDS))


def normalize_reservations(res: DataFrame) -> DataFrame:
    """The 19-column projection (rate filled in later), plus
    ``property_id`` for the dimension join. Two projections: the picked raw
    texts first, then the parsed days once each (Catalyst keeps an expensive
    expression in its own projection rather than inlining it per use)."""
    f = lambda p: _field(res, p)
    guest = _chosen_guest(res)
    picked = res.select(
        F.col("property_id").cast("int").alias("property_id"),
        first_non_empty(f("id"), f("reservationId"), default=None).cast("long").alias("res_no"),
        first_non_empty(f("onlineConfirmationId"), default=CONFIRMATION_DEFAULT).alias("rms_conf_no"),
        first_non_empty(f("dateCreated"), f("createdDate"), default="").alias("_created"),
        first_non_empty(f("dateCancelled"), f("cancelledDate"), default="").alias("_cancelled"),
        date_prefix(first_non_empty(f("arrivalDate"), f("arriveDate"))).alias("arrive"),
        date_prefix(first_non_empty(f("departureDate"), f("departDate"))).alias("depart"),
        first_non_empty(f("bookingSourceName"), f("bookingSource.name"), default="").alias("booking_source_name"),
        f("createdById").cast("string").alias("_creator"),
        first_non_empty(f("travelAgentName"), f("travelAgent.name")).alias("_agent"),
        first_non_empty(f("guestSurname"), guest["lastName"], guest["surname"]).alias("surname"),
        first_non_empty(f("guestGiven"), guest["firstName"], guest["given"]).alias("given"),
        first_non_empty(f("categoryName"), f("category.name")).alias("accommodation"),
        F.lit(DATE_PAID).alias("date_paid"),
        first_non_empty(f("status")).alias("status"),
        first_non_empty(f("currency"), f("currencyCode"), default=CURRENCY_DEFAULT).alias("currency"),
        *([F.col("pos")] if "pos" in res.columns else []),
    )
    return (picked
            .withColumn("created_date_utc", parse_and_shift("_created", SHIFT_HOURS))
            .withColumn("cancelled_date_utc", parse_and_shift("_cancelled", SHIFT_HOURS))
            .withColumn("date_made_utc", F.col("created_date_utc"))
            .withColumn("reservation_agent",
                        booking_agent(F.col("booking_source_name"), F.col("_creator"), F.col("_agent")))
            .drop("_created", "_cancelled", "_creator", "_agent"))


MONTHS_NAMED = 24        # of a creation window that is pruned by month; a longer one by year


def _may_be_created(text: Column, lo: str, hi: str) -> Column:
    """True for every text whose day, parsed or by its first ten characters,
    lies in [lo, hi], and for few others; made of comparisons and prefixes of
    the raw text, which Parquet scans use to skip row groups. A time starts
    with its year and month (the month may lack its zero); what is no time is
    compared as text; either may follow spaces."""
    first, last = _dt.date.fromisoformat(lo), _dt.date.fromisoformat(hi)
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    if len(months) <= MONTHS_NAMED:
        dated = [text.startswith(f"{m // 12:04}-{spelt}-") for m in months for spelt in dict.fromkeys((f"{m % 12 + 1:02}", str(m % 12 + 1)))]
    else:
        dated = [text.between(f"{first.year:04}-", f"{last.year:04}-:")]       # ':' comes after the digits
    return reduce(or_, dated, text.between(lo, hi + "\U0010ffff") | text.startswith(" "))


def creation_window(res: DataFrame, start: str, end: str) -> DataFrame:
    """creation day within [start-1, end+1] (whole days), as the service
    selects on the real timestamp: the text is parsed first, so unpadded
    fields count; only a text that is no time is taken by its first ten
    characters, as F5 takes it. Before that a condition on the raw texts that
    every such row meets reaches the scan."""
    lo = (_dt.date.fromisoformat(start) - _dt.timedelta(days=1)).isoformat()
    hi = (_dt.date.fromisoformat(end) + _dt.timedelta(days=1)).isoformat()
    texts = [_field(res, p) for p in ("dateCreated", "createdDate")]
    day = parse_and_shift(first_non_empty(*texts, default=""), 0)
    near = reduce(or_, [_may_be_created(t, lo, hi) for t in texts])
    return res.where(near).where(day.between(F.lit(lo), F.lit(hi)))


def stay_rates(export: DataFrame, rates: DataFrame) -> DataFrame:
    """F8 + A1 + D6 + F6 + J11 + A6: per reservation id the sum of rate amounts
    (at full scale; P23 rounds the sum once) whose stay day lies in
    [arrive, depart + 1]; the dates of the id's last export row apply."""
    complete = rates.where(F.col("reservationId").isNotNull() & F.col("totalRateAmount").isNotNull()
                           & F.col("stayDate").isNotNull())
    # Landed rows carry their report position; without one every row of an
    # id is equally "last" (ids are unique in practice).
    order = F.col("pos") if "pos" in export.columns else F.lit(0)
    dates = (export.withColumn("_ord", order)
             .groupBy("res_no").agg(F.max_by(F.struct("arrive", "depart"), "_ord").alias("d"))
             .select("res_no", F.col("d.arrive").alias("arrive"), stay_limit(F.col("d.depart")).alias("limit")))
    stay = date_prefix(F.col("stayDate"))
    j = complete.join(dates, complete.reservationId.cast("long") == dates.res_no)
    return (j.where((stay >= F.substring("arrive", 1, 10)) & (stay <= F.col("limit")))
             .groupBy("res_no").agg(F.sum("totalRateAmount").alias("rate_sum")))


def export_reservations(res: DataFrame, rates: DataFrame, properties: DataFrame,
                        start: str, end: str | None = None) -> DataFrame:
    """C7 for target days start..end (the job default is one day: yesterday).
    Output: the 19 columns; ``created_date_utc`` is the target day."""
    end = end or start
    norm = normalize_reservations(creation_window(res, start, end))
    due = norm.where(F.col("created_date_utc").between(F.lit(start), F.lit(end)))      # F5
    tagged = due.join(properties, "property_id")                                       # J14
    rated = tagged.join(stay_rates(tagged, rates), "res_no", "left")                    # J13
    return rated.withColumn("rate", money_text("rate_sum")).select(*COLUMNS)


def write_reservations(df: DataFrame, path: str) -> None:
    """K5: one folder per target day, replaced; no rows -> nothing written."""
    write_partitions(df.withColumn("data_date", F.col("created_date_utc")), path, ["data_date"])


def run_export_reservations(res: DataFrame, rates: DataFrame, properties: DataFrame, path: str, as_of: str,
                            start: str | None = None, end: str | None = None) -> DataFrame:
    """C7 + K5 for an explicit range of target days, else yesterday.
    Returns the rows of the run per target day."""
    start, end = resolve_range(start, end, as_of, default="yesterday")
    with staged_run(res.sparkSession, "reservations-run"):
        df = stage(export_reservations(res, rates, properties, start, end), "reservations")
        write_reservations(df, path)
        return kept(df.groupBy(F.col("created_date_utc").alias("data_date")).agg(F.count(F.lit(1)).alias("row_count")))
