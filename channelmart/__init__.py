"""channelmart: day-partitioned web and advertising performance tables on Spark.

Every job is a DataFrame plan over all properties at once; a ``property_name``
column replaces per-property loops, and every write is an idempotent
dynamic partition overwrite.
"""

__all__ = ["session"]
