"""DuckDB formulations of every registered query (the correctness oracle).

Written independently of the Spark code, straight from the semantics, over
the raw driver tables (pre-registered views in the checker).
"""

from channelmart.oracle.sql import oracle_queries  # noqa: F401
