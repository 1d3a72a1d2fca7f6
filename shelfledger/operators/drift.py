"""Published figures against recomputed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drift(published: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Metrics whose published value differs, is missing, or has nothing behind it.

    Both sides hold (metric, value); the result (metric, published, recomputed, state).
    """
    left = published.select("metric", F.col("value").alias("published"), F.lit(True).alias("_p"))
    right = recomputed.select("metric", F.col("value").alias("recomputed"), F.lit(True).alias("_r"))
    state = (F.when(F.col("_p").isNull(), "missing").when(F.col("_r").isNull(), "extra")
             .otherwise("stale"))
    agree = (F.col("published").eqNullSafe(F.col("recomputed"))
             & F.col("_p").isNotNull() & F.col("_r").isNotNull())
    return (left.join(right, "metric", "full_outer").filter(~agree)
            .select("metric", "published", "recomputed", state.alias("state")))
