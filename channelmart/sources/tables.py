"""Table scans (S5, S6): daily event tables and day slices of search tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events_day(spark: SparkSession, source: str, day_suffix: str,
                    partitioned: bool = True) -> DataFrame:
    """S5. ``partitioned``: ``source`` is a Parquet folder partitioned by
    ``event_date`` (the day filter prunes partitions). Otherwise ``source`` is
    a catalog table prefix and the daily table ``<source>_<YYYYMMDD>`` is read."""
    if partitioned:
        return spark.read.parquet(source).where(F.col("event_date") == F.lit(day_suffix))
    return spark.read.table(f"{source.strip()}_{day_suffix}")


def read_search_table(spark: SparkSession, path: str) -> DataFrame:
    """A search table landed as ``<path>/project_id=<project>/..``. The
    project is the dataset that was read, not a column of the table, so it
    comes from the folder."""
    return spark.read.parquet(path)


def read_search_days(df: DataFrame, dates: Sequence[str], date_col: str = "data_date") -> DataFrame:
    """All columns of a search table for the given days; on a date
    partition column this is partition pruning, on a file a pushed filter."""
    return df.where(F.col(date_col).isin([F.to_date(F.lit(d)) for d in dates]))
