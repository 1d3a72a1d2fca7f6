"""Joins that stay even when one key holds a large part of the rows.

Nothing here drops or caps rows: a hot key is spread over more partitions, never shortened.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_SALTS = 1 << 16
#: Copies of a lookup table that is too large to broadcast.
COPIES = 16
HOT_ROWS = 2_000_000
#: Places whose marks are one row, as a power of two.
CHUNK_BITS = 15


def planner_bytes(df: DataFrame) -> int:
    """Size that the optimizer assumes for ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def salt(spread: Sequence[str], salts: int) -> Column:
    """Salt from columns that identify the row, so that a task retry repeats it."""
    return F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")


def may_broadcast(lookup: DataFrame) -> bool:
    """Whether the planner takes a table for small enough to send it to every task."""
    limit = lookup.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return planner_bytes(lookup) <= limit


def join_lookup(facts: DataFrame, lookup: DataFrame, key: str, how: str, spread: Sequence[str],
                salts: int = NULL_SALTS, copies: int = COPIES, small: bool | None = None) -> DataFrame:
    """Left or anti join of a fact table to a table with one row per ``key``.

    A lookup that the planner takes for small enough to broadcast is joined as it is. Any other is repeated
    ``copies`` times under numbers, and a fact row looks for the copy of its number: the rows of one
    key go to as many tasks, whether or not the adaptive plan would split them. Rows with a
    null key match nothing and would all meet in one task; they are dealt as well, by ``spread``, columns that
    identify a fact row. No job runs while the plan is built. ``small`` tells what the planner can't, as it takes a
    table behind a join for as large as both sides multiplied.
    """
    if how not in ("left", "left_anti"):
        raise ValueError(f"join_lookup does not join {how}")
    own_key = F.concat(F.lit("\0"), salt(spread, salts).cast("string"))
    dealt = facts.withColumn("_key", F.coalesce(F.col(key), own_key))
    found = lookup.withColumnRenamed(key, "_found")
    # the second condition keeps a dealt row from a lookup row that should be named like its key
    same = (F.col("_key") == F.col("_found")) & F.col(key).isNotNull()
    if small:
        found = F.broadcast(found)
    elif not may_broadcast(lookup):
        dealt = dealt.withColumn("_copy", salt(spread, copies))
        found = found.withColumn("_number", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        same &= F.col("_copy") == F.col("_number")
    return dealt.join(found, same, how).drop("_key", "_found", "_copy", "_number")


def mark_known(facts: DataFrame, lookup: DataFrame, key: str, marker: str, spread: Sequence[str], stage_keys=None) -> DataFrame:
    """Facts with ``marker``, true where ``lookup`` has their ``key`` and null elsewhere.

    A lookup that is too large to broadcast is met by the facts' keys alone, each once. ``stage_keys`` writes those that it
    doesn't have under a name and reads them back; if they are few enough for the planner to broadcast, no fact row is shuffled.
    """
    if stage_keys is not None and not may_broadcast(lookup):
        keys = facts.filter(F.col(key).isNotNull()).select(key).distinct()
        absent = stage_keys(keys.join(lookup.select(key), key, "left_anti"), f"absent_{key}")
        if may_broadcast(absent):
            known = F.when(F.col("_absent").isNull() & F.col(key).isNotNull(), F.lit(True))
            return (facts.join(F.broadcast(absent.withColumn("_absent", F.lit(True))), key, "left")
                    .select(*facts.columns, known.alias(marker)))
    return join_lookup(facts, lookup.select(key, F.lit(True).alias(marker)), key, "left", spread)


def place_marks(places: DataFrame, place: str) -> DataFrame:
    """Which places occur in a table of places, whole numbers, as a bit for each in 32-bit words: ``_words`` of every ``_chunk``."""
    words = F.transform(F.sequence(F.lit(0), F.lit((1 << CHUNK_BITS) // 32 - 1)), lambda i: F.conv(
        F.hex(F.substring(F.col("_bits"), i * 4 + 1, F.lit(4))), 16, 10).cast("long"))
    return (places.select(F.shiftright(place, CHUNK_BITS).alias("_chunk"), F.col(place).bitwiseAND(F.lit((1 << CHUNK_BITS) - 1)).alias("_at"))
            .repartition("_chunk").groupBy("_chunk").agg(F.bitmap_construct_agg("_at").alias("_bits"))
            .select("_chunk", words.alias("_words")))


def join_marks(facts: DataFrame, marks: DataFrame, place: str, name: str) -> DataFrame:
    """Facts with ``name``: whether their place is marked. The marks are broadcast, a bit for each fact row and no more."""
    at = F.col(place).bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    word = F.get("_words", F.shiftright(at, 5).cast("int"))
    # the bytes of a word come first to last, the bits of a byte last to first
    shift = (24 - at.bitwiseAND(F.lit(24)) + at.bitwiseAND(F.lit(7))).cast("int")
    bit = F.call_function("shiftright", word, shift).bitwiseAND(F.lit(1)) == 1
    return (facts.join(F.broadcast(marks), F.shiftright(place, CHUNK_BITS) == F.col("_chunk"), "left")
            .select(*facts.columns, F.coalesce(bit, F.lit(False)).alias(name)))


def join_counted(facts: DataFrame, groups: DataFrame, key: str, count: str, spread: Sequence[str],
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join a fact table to per-key results derived from it, which may be as many as its rows.

    ``groups`` has one row per key and the number of fact rows behind it. Keys with at least
    ``hot_rows`` rows number at most ``rows / hot_rows`` whatever the data, so these are broadcast,
    and their fact rows, like those without a key, are spread by ``spread`` in the shuffle on the
    key, a text or binary. ``spread`` names columns that identify a fact row.
    """
    columns = [c for c in groups.columns if c != key]
    hot = groups.filter(F.col(count) >= hot_rows).select(
        key, F.struct(*columns).alias("_hot"))
    cold = groups.filter(F.col(count) < hot_rows).select(
        F.col(key).alias("_key"), F.struct(*columns).alias("_cold"))
    # a row set apart gets a key of its own; should that ever equal a real one, what it finds
    # there is ignored
    apart = F.col("_hot").isNotNull() | F.col(key).isNull()
    own_key = F.concat(F.lit("\0"), salt(spread, 1 << 30).cast("string")).cast(dict(facts.dtypes)[key])
    joined = (facts.join(F.broadcast(hot), key, "left")
              .withColumn("_apart", apart)
              .withColumn("_key", F.when(F.col("_apart"), own_key).otherwise(F.col(key)))
              .join(cold, "_key", "left"))
    found = F.when(F.col("_apart"), F.col("_hot")).otherwise(F.col("_cold"))
    return (joined.withColumn("_found", found)
            .select(*facts.columns, *[F.col(f"_found.{c}").alias(c) for c in columns]))
