"""Property dimensions (S7, S8, search projects).

They come from configuration lists, whose size in bytes Spark knows (a local
relation): it broadcasts them within its own limit and shuffles them beyond.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, StringType, StructField,
                               StructType)

ADS_PROPERTY_SCHEMA = StructType([
    StructField("property_name", StringType(), False),
    StructField("property_type", StringType(), True),
    StructField("fx_divisor", DoubleType(), True),
])

RESERVATION_PROPERTY_SCHEMA = StructType([
    StructField("propertyId", StringType(), True),
    StructField("clientName", StringType(), True),
    StructField("location", StringType(), True),
])

PROJECT_SCHEMA = StructType([
    StructField("project_id", StringType(), True),
    StructField("property_name", StringType(), True),
])


def properties_dim(spark: SparkSession, props: list[dict]) -> DataFrame:
    """Property name, type and the FX divisor applied to analytics revenue
    (default 1.0 = same currency as the ads account)."""
    rows = [(p["property_name"], p.get("property_type", p["property_name"]),
             float(p.get("fx_divisor", 1.0))) for p in props]
    return spark.createDataFrame(rows, ADS_PROPERTY_SCHEMA)


def _reservation_props(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("propertyId").cast(IntegerType()).alias("property_id"),   # must be an integer
        F.col("clientName").cast("string").alias("property_name"),
        F.coalesce(F.col("location").cast("string"), F.lit("")).alias("location"),
    )


def reservation_properties_dim(spark: SparkSession, props: list[dict]) -> DataFrame:
    rows = [(str(p["propertyId"]), str(p["clientName"]), p.get("location")) for p in props]
    return _reservation_props(spark.createDataFrame(rows, RESERVATION_PROPERTY_SCHEMA))


def read_properties(spark: SparkSession, path: str) -> DataFrame:
    """JSON config list [{propertyId, clientName, location?}, ...]."""
    df = spark.read.schema(RESERVATION_PROPERTY_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return _reservation_props(df)


def search_projects_dim(spark: SparkSession, projects: list[dict]) -> DataFrame:
    """Project -> property map; blank project ids are skipped."""
    rows = [(p["project_id"], p["property_name"]) for p in projects]
    df = spark.createDataFrame(rows, PROJECT_SCHEMA).where(F.trim("project_id") != "")
    return df.withColumn("project_id", F.trim("project_id"))
