"""C6 driven by Structured Streaming: pick up only event files not seen by
earlier runs, flatten them, append them to a day-partitioned table, stop.

``trigger(availableNow=True)`` processes everything landed so far and ends,
so a scheduler can start it once a day like the batch job. The source's
progress log and the file sink's commit log (``_spark_metadata`` in the
output folder) make each file count exactly once: a failed or retried
micro-batch is rewritten, never doubled, and a day whose files land across
several runs keeps the rows of every run (each run appends its own files).
The output folder is a streaming sink table: read it with
``spark.read.parquet(path)`` (which follows the commit log) and do not mix it
with the batch writer's dynamic overwrites. No shuffle: the flattening is
narrow and every task writes the (property, day) partitions it holds.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from channelmart.plans.events import flatten_events

MAX_FILES_PER_BATCH = 1000


def flatten_new_events(spark: SparkSession, source_dir: str, schema: StructType, target_path: str,
                       property_id: str, property_name: str, checkpoint_location: str,
                       max_files_per_trigger: int | None = MAX_FILES_PER_BATCH) -> None:
    """Flatten every event file landed since the last run, in micro-batches
    of at most ``max_files_per_trigger`` files (a backlog is drained in
    several bounded batches, so a failed batch reruns only its own files).
    ``checkpoint_location`` holds the progress and must be the same folder in
    every run of this target: the target's commit log counts batches by it."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    flat = flatten_events(reader.parquet(source_dir), property_id, property_name)
    query = (flat.writeStream.format("parquet")
             .outputMode("append")
             .partitionBy("property_id", "event_date")
             .option("compression", "snappy")
             .option("path", target_path)
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True).start())
    query.awaitTermination()
