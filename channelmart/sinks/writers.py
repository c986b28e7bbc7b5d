"""Day-partitioned Parquet writer shared by every job (K1-K5).

Only partitions present in the result are replaced, so writing twice changes
nothing and days the run did not produce survive; an empty result touches no
partition at all. Rows are rebalanced on the partition keys first: AQE splits
a hot day (or property) into several files instead of funnelling it through
one task, and merges tiny partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_partitions(df: DataFrame, path: str, partition_cols: Sequence[str],
                     compression: str = "snappy", rebalance: bool = True) -> None:
    """``rebalance=False``: the caller already balanced the rows on the
    partition keys earlier in the plan (where they were smaller)."""
    cols = list(partition_cols)
    if rebalance:
        df = df.hint("rebalance", *cols)
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("compression", compression)
       .partitionBy(*cols)
       .parquet(path))


def read_partitions(spark, path: str, schema=None, merge: bool = False) -> DataFrame:
    """Read back a day-partitioned folder keeping partition values as text.

    Days written at different times may differ in columns. With ``schema`` (the
    columns wanted, partition columns included) a column that a day does not
    have is null in it, and no file is opened to find out; with ``merge`` the
    columns of all files are united, for which Spark reads every footer. With
    neither, some file's columns count."""
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", merge)
    return reader.parquet(path)


def save_daily_table(df: DataFrame, table: str, suffix: str, path: str) -> None:
    """One day as the catalog table ``<table>_<suffix>`` over files in ``path``."""
    df.write.mode("overwrite").option("path", f"{path.rstrip('/')}/{suffix}").saveAsTable(f"{table.strip()}_{suffix}")
