"""Named tables in one session, their freshness and previews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.functions.times import instant
from shelfledger.schemas import STORES

# The store dimension that a new warehouse starts with.
SEED_STORES = (
    ("hamilton_01", "Fresh Market Hamilton", "Hamilton", "Waikato"),
    ("hamilton_02", "Value Foods Hamilton", "Hamilton", "Waikato"),
    ("auckland_01", "Fresh Market Auckland", "Auckland", "Auckland"),
    ("wellington_01", "Value Foods Wellington", "Wellington", "Wellington"),
    ("christchurch_01", "Southern Grocery", "Christchurch", "Canterbury"),
)


def seed_stores(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """Store table with the seed rows put in where their id is absent."""
    seed = spark.createDataFrame(list(SEED_STORES), STORES)
    if existing is None:
        return seed
    return existing.unionByName(seed.join(existing.select("store_id"), "store_id", "left_anti"))


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Make the tables of both tiers available to ``spark.sql`` under their names."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name.replace(".", "_"))


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name.replace(".", "_"))


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of) -> DataFrame:
    """Newest load time of each table and its age in seconds at ``as_of``."""
    parts = [frame.agg(F.max(field).cast("timestamp").alias("max_loaded_at"))
             .select(F.lit(name).alias("source"), "max_loaded_at")
             for name, (frame, field) in tables.items()]
    every = reduce(DataFrame.unionByName, parts)
    return every.withColumn("age_seconds", F.unix_timestamp(instant(as_of))
                            - F.unix_timestamp("max_loaded_at"))


def preview(df: DataFrame, n: int = 20) -> int:
    """Show the first rows and return the row count."""
    df.show(n, truncate=False)
    rows = df.count()
    print(f"Rows: {rows}")
    return rows
