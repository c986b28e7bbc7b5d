"""Writers (K1-K5): one idempotent dynamic-partition-overwrite helper."""

from channelmart.sinks.writers import write_partitions  # noqa: F401
