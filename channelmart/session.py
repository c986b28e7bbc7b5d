"""Session settings shared by every job."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Context-level settings a cluster should also start with (they cannot be
# changed on a running session): delete a reliable checkpoint once nothing
# references it, so daily runs do not fill the shared checkpoint folder.
CLUSTER_CONF = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Settings every job relies on. Dynamic partition overwrite is mandatory:
# the Spark default (STATIC) would wipe days a run did not produce.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition (one hot key) even when that costs an
    # extra shuffle downstream: a key may hold a large share of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the job settings to an existing session (idempotent)."""
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "channelmart") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CHANNELMART_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**CLUSTER_CONF, **JOB_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only a local-mode session (tests, the bench)
    with the setting unset gets a folder of its own; a cluster session
    without it is an error, since a machine-local folder would not survive
    the loss of the executor that wrote it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (for example on "
                               "the cluster's distributed file system) for lineage cuts")
        configured = tempfile.mkdtemp(prefix="channelmart-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def new_folder(spark: SparkSession, label: str) -> str:
    """A name of its own for staged files: below the folder of the current
    run, or else below the shared checkpoint folder."""
    root = _run_folder.get() or ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any store that Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staged_run(spark: SparkSession, label: str = "run") -> Iterator[str]:
    """What is staged inside goes below one folder, which is deleted at the
    end, also if the run fails. Frames over staged files end with it; a run
    that is lost with its driver leaves one folder of a telling name."""
    folder = new_folder(spark, label)
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        delete_folder(spark, folder)


def kept(rows: DataFrame) -> DataFrame:
    """A run's summary (a row for each day and, at most, property and table)
    as a frame of its own, so that the staged files it came from can go."""
    return rows.sparkSession.createDataFrame(rows.collect(), rows.schema)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write the frame once as Parquet below the shared
    checkpoint folder and go on from its files. Later plans are short, read
    only the columns they need, push filters to the scan, and a lost executor
    never replays the upstream plan."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Staged as ``stage`` does, dealt and sorted by ``keys`` into as many
    buckets as there are shuffle partitions, one file each. Frames staged by
    the same keys join on them, and aggregate by them, without an exchange.
    Only for keys that no value of which holds many rows: a bucketed scan is
    not split by AQE."""
    spark = df.sparkSession
    path, table = new_folder(spark, label), f"staged_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
       .option("path", path).saveAsTable(table))
    staged = spark.table(table)
    spark.sql(f"DROP TABLE {table}")          # its entry alone: the files are the run's
    return staged


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, for sessions that were not
    started with it (``--py-files``, PYTHONPATH or an installed package)."""
    import shutil
    from pyspark import SparkFiles
    here = os.path.dirname(os.path.abspath(__file__))
    # in the driver's folder for files that it serves, which ends with the session
    archive = f"{tempfile.mkdtemp(dir=SparkFiles.getRootDirectory())}/{os.path.basename(here)}"
    spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(here), os.path.basename(here)))
