"""Rolling 7-day snapshot of search-performance tables per property."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from channelmart.functions.dates import last_n_days
from channelmart.operators.summary import snapshot_counts
from channelmart.session import kept, stage, staged_run
from channelmart.sinks.writers import write_partitions
from channelmart.sources.tables import read_search_days

LOG_BUCKETS = 64  # parts of a project that are ranked apart first
LOG_LIMIT = 100   # newest export-log rows kept per project (fixed by the source job)


def _tagged(rows: DataFrame, projects: DataFrame) -> DataFrame:
    """The owning property; the project says which dataset a row was read
    from and is not one of the table's own columns."""
    return rows.join(projects, "project_id").drop("project_id")


def day_slices(table: DataFrame, projects: DataFrame, dates: Sequence[str]) -> DataFrame:
    """D4 + S6 + F7 + J14: all columns of the table for the window's days,
    tagged with the owning property (blank projects are not in the map)."""
    return _tagged(read_search_days(table, dates), projects).withColumn("date", F.date_format("data_date", "yyyy-MM-dd"))


def log_snapshot(log: DataFrame, projects: DataFrame, dates: Sequence[str],
                 order: str = "publish_time", tie_breakers: Sequence[str] = (),
                 limit: int = LOG_LIMIT) -> DataFrame:
    """O1: newest ``limit`` rows per project (not filtered by day), the same
    snapshot repeated for every day of the window. Rows of one time are taken
    by ``tie_breakers`` (descending), or by a hash of the whole row. The newest
    rows of each of ``LOG_BUCKETS`` parts of a project are found first, so a
    project with most of the rows is sorted by many tasks and the last task
    gets a bounded number of rows."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in log.columns])
    ranked = [F.col(order).desc(), *[F.col(c).desc() for c in tie_breakers], F.col("_hash").desc()]
    rows = log.withColumn("_hash", whole).withColumn("_part", F.pmod("_hash", F.lit(LOG_BUCKETS)))
    top = rows.where(F.col("project_id").isNotNull())
    for keys in (["project_id", "_part"], ["project_id"]):
        w = Window.partitionBy(*keys).orderBy(*ranked)
        top = top.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")
    day_list = F.array(*[F.lit(d) for d in dates])
    return _tagged(top.drop("_hash", "_part"), projects).withColumn("date", F.explode(day_list))


def search_snapshot(tables: dict[str, DataFrame], log_name: str, projects: DataFrame,
                    as_of: str, n_days: int = 7, tie_breakers: Sequence[str] = ()) -> dict[str, DataFrame]:
    """One DataFrame per table, each with ``property_name`` and ``date``."""
    dates = last_n_days(as_of, n_days)
    return {name: log_snapshot(df, projects, dates, tie_breakers=tie_breakers) if name == log_name
            else day_slices(df, projects, dates) for name, df in tables.items()}


def write_snapshots(snapshots: dict[str, DataFrame], root: str) -> None:
    """K4: ``<root>/<table>/property_name=../date=..``; a day with no rows
    keeps its old partition (only produced partitions are replaced)."""
    for name, df in snapshots.items():
        write_partitions(df, f"{root.rstrip('/')}/{name}", ["property_name", "date"])


def run_search_snapshot(tables: dict[str, DataFrame], log_name: str, projects: DataFrame, root: str,
                        as_of: str, n_days: int = 7) -> DataFrame:
    """C8 + K4 + A9 for the ``n_days`` before ``as_of`` (D4): the rows written
    per property, table and day."""
    with staged_run(projects.sparkSession, "search-run"):
        snaps = {name: stage(df, f"search-{name}") for name, df in search_snapshot(tables, log_name, projects, as_of, n_days).items()}
        write_snapshots(snaps, root)
        tagged = [df.select("property_name", F.lit(name).alias("table_name"), "date") for name, df in snaps.items()]
        return kept(snapshot_counts(reduce(DataFrame.unionByName, tagged), ["property_name", "table_name", "date"]))
