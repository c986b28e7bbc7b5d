"""Reservation and daily-rate responses landed as JSON pages.

A page may be a bare list, an object whose ``items``, ``results`` or
``data`` is a list, or a single object; rows that are no objects are dropped,
the objects beside them are kept, and a page that is no JSON fails. Layout:
``<root>/property_id=<id>/page-<n>.json`` for reservations. Every leaf is read
as text (nullable) and typed by the normaliser; the guests stay JSON text, as
the rule that picks one asks whether the object is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from channelmart.functions.exprs import MONEY
from channelmart.sources.chains import RESERVATION_LIMIT, list_chain, require_chains
from channelmart.sources.pages import other_columns, position, read_pages

_S = StringType()


def _obj(*names: str) -> StructType:
    return StructType([StructField(n, _S, True) for n in names])


RESERVATION_FIELDS = StructType(
    [StructField(n, _S, True) for n in (
        "id", "reservationId", "onlineConfirmationId", "dateCreated", "createdDate", "arrivalDate",
        "arriveDate", "departureDate", "departDate", "dateCancelled", "cancelledDate",
        "bookingSourceName", "createdById", "travelAgentName", "guestSurname", "guestGiven",
        "categoryName", "status", "currency", "currencyCode", "primaryGuest", "guest")]
    + [StructField("bookingSource", _obj("name"), True), StructField("travelAgent", _obj("name"), True),
       StructField("category", _obj("name"), True)])
RATE_FIELDS = _obj("reservationId", "totalRateAmount", "stayDate")


def _outer(value: str) -> Column:
    return F.substring(F.regexp_replace(value, r"^\s+", ""), 1, 1)


def _elements(outer: Column, v: Column, item: str = "variant") -> Column:
    lists = [F.try_variant_get(v, f"$.{k}", f"array<{item}>") for k in ("items", "results", "data")]
    alone = F.array(v if item == "variant" else F.try_variant_get(v, "$", item))
    return F.when(outer == "[", F.try_variant_get(v, "$", f"array<{item}>")).when(outer == "{", F.coalesce(*lists, alone))


def elements(value: str) -> Column:
    """The elements of a page as variants: the outer value decides (a list
    stands for its elements, an object for the first of its lists named items,
    results or data, else for itself)."""
    return _elements(_outer(value), F.parse_json(value))


def _exploded(pages: DataFrame, item: str) -> DataFrame:
    """One row (``_idx``, ``e``) per element of the pages, as ``item``: null
    if it is no such value."""
    keep = other_columns(pages)
    return (pages.select(*keep, "page", _outer("value").alias("outer"), F.parse_json("value").alias("v"))
            .select(*keep, "page", F.posexplode(_elements(F.col("outer"), F.col("v"), item)).alias("_idx", "e")))


def parse_envelope(pages: DataFrame, fields: StructType) -> DataFrame:
    """One row per object whatever the page shape: the objects among the
    page's ``elements``. ``pos`` is (page number, place in the list)."""
    keep = other_columns(pages)
    rows = (_exploded(pages, "variant")
            .select(*keep, "page", "_idx", F.to_json("e").alias("text"))
            .where(F.col("text").startswith("{")))
    return (rows.select(*keep, F.from_json("text", fields).alias("r"), position())
            .select(*keep, "r.*", "pos"))


def read_reservations(spark: SparkSession, path: str, check: bool = True, first: int | None = None,
                      limit: int = RESERVATION_LIMIT, expected: DataFrame | None = None) -> DataFrame:
    """The objects of a whole landing: pages follow each other while they hold
    ``limit`` elements; one that is missing or doubled fails (``check``), and
    with ``first``, the number of each first page, one behind the last, too;
    so does an ``expected`` property without pages."""
    pages = read_pages(spark, path)
    if check:
        require_chains(list_chain(pages, limit), f"reservation pages below {path}", first, first is not None, expected)
    return parse_envelope(pages, RESERVATION_FIELDS)


def parse_daily_rates(pages: DataFrame) -> DataFrame:
    """(reservationId, totalRateAmount, stayDate) rows; amounts exact. The
    three fields are read from the parsed page, without the detour of
    ``parse_envelope`` over each object's text: rates are the many rows."""
    rows = _exploded(pages, RATE_FIELDS.simpleString()).where(F.col("e").isNotNull())
    return (rows.select(*other_columns(pages), "e.*", position())
            .withColumn("totalRateAmount", F.col("totalRateAmount").try_cast(MONEY)))


def read_daily_rates(spark: SparkSession, path: str) -> DataFrame:
    return parse_daily_rates(read_pages(spark, path))
