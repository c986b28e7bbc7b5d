"""Flatten analytics events to one row per event parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from channelmart.functions.dates import table_suffix
from channelmart.sinks.writers import write_partitions
from channelmart.sources.tables import read_events_day

VALUE_FIELDS = ("string_value", "int_value", "float_value", "double_value")


def tag_events(df: DataFrame, property_id: str, property_name: str) -> DataFrame:
    """P1 + P2: property tags and the event join key. ``concat_ws`` skips
    nulls, so a missing user gives ``name_ts``."""
    return (df.withColumn("property_id", F.lit(property_id))
              .withColumn("property_name", F.lit(property_name))
              .withColumn("join_key", F.concat_ws(
                  "_", F.col("event_name"), F.col("event_timestamp").cast("string"),
                  F.col("user_pseudo_id"))))


def _explode_params(tagged: DataFrame) -> DataFrame:
    if isinstance(tagged.schema["event_params"].dataType, ArrayType):
        # As exported: an array of {key, value}, where a key may come again.
        rows = F.transform("event_params", lambda p, i: F.struct(
            i.alias("param_pos"), p["key"].alias("key"), *[p["value"][f].alias(f) for f in VALUE_FIELDS]))
        return tagged.select("*", F.inline(rows))
    exploded = tagged.select("*", F.explode("event_params").alias("param_key", "param_value"))
    return (exploded
            .select(*tagged.columns, F.col("param_key").alias("key"),
                    *[F.col(f"param_value.{f}").alias(f) for f in VALUE_FIELDS]))


def flatten_events(df: DataFrame, property_id: str, property_name: str) -> DataFrame:
    """N1 + P3 + P4: every source column (the parameters included), the tags,
    the parameter key and its four typed values. The parameters are a map, or
    an array of ``{key, value}``; an array's rows carry ``param_pos``, their
    place in it, and keep repeated keys. ``explode`` and ``inline`` (not
    ``_outer``): events without parameters produce no rows. Narrow: no
    shuffle."""
    return _explode_params(tag_events(df, property_id, property_name))


def write_events(df: DataFrame, path: str) -> None:
    """K3 for already flattened rows: partitioned by property and event day,
    dynamic overwrite, snappy."""
    write_partitions(df, path, ["property_id", "event_date"])


def run_flatten_events(df: DataFrame, property_id: str, property_name: str, path: str) -> None:
    """C6 + K3. The events are balanced on the output partition keys *before*
    the explode: every flattened row repeats all event columns (the parameter
    map included), so shuffling events instead of flattened rows moves each
    event once rather than once per parameter. The explode then runs after
    the shuffle, where the rows are written, and no second shuffle follows."""
    tagged = tag_events(df, property_id, property_name).hint("rebalance", "property_id", "event_date")
    write_partitions(_explode_params(tagged), path, ["property_id", "event_date"], rebalance=False)


def run_events_day(spark: SparkSession, source: str, property_id: str, property_name: str, path: str, as_of: str,
                   partitioned: bool = True) -> None:
    """C6 for the daily event table of two days before ``as_of``."""
    day = read_events_day(spark, source, table_suffix(as_of), partitioned)
    run_flatten_events(day, property_id, property_name, path)
