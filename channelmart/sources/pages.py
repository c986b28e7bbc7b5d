"""Landed response pages: one JSON document per file, read as text.

A page is found by its number, the last digits of the file name
(``page-2.json`` comes before ``page-10.json``); a name without a number is
refused, since rows of a later page overwrite those of an earlier one.
Parsing is apart from reading (``parse_*`` of the source modules), so any
frame with the columns ``value`` (the text), ``page`` and partition columns
can be parsed. A page that is no JSON fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_COLUMNS = ("value", "page")


def page_number(file_name: Column) -> Column:
    digits = F.regexp_extract(file_name, r"(\d+)\D*$", 1).try_cast("long")
    refused = F.raise_error(F.concat(F.lit("page file without a number: "), file_name)).cast("long")
    return F.coalesce(digits, refused)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``value``, ``page`` and the partition columns."""
    raw = spark.read.option("wholetext", True).text(path)
    others = [c for c in raw.columns if c != "value"]
    return raw.select(*others, "value", page_number(F.col("_metadata.file_name")).alias("page"))


def other_columns(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c not in PAGE_COLUMNS]


def position(idx: str = "_idx") -> Column:
    """Report order: page number, then place in the page."""
    return F.struct("page", F.col(idx).alias("idx")).alias("pos")
