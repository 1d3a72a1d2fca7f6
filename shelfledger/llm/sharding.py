"""Sharding along a Hilbert curve over several metadata dimensions, for multidimensional file pruning.

Every dimension is quantised to the same number of levels: numbers by their own quantiles, text by
hash. Rows are ordered by the curve index of their cell, then by the checksum of the text, so that
rows near each other in all dimensions, and equal texts of a cell, stand together; the order is cut
into runs whose row counts differ by at most one. DataFrame functions only.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfledger.session import stage

BITS = 4
SHARDS = 24
#: Relative rank error of the quantiles that cut the numeric dimensions.
QUANTILE_ERROR = 0.01


def hilbert_index(levels: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a cell given by one level per dimension (0 to 2**bits - 1).

    From the highest bit down, the curve's orientation in each sub-cube is undone (a reflection where
    the bit is set, an exchange with the first dimension where it is not), then the coordinates are
    Gray-decoded and their bits interleaved, the first dimension leading.
    """
    n = len(levels)
    at = lambda x, i: F.element_at(x, i + 1)

    def put(x: Column, values: dict[int, Column]) -> Column:
        return F.array(*[values.get(i, at(x, i)) for i in range(n)])

    def undo(bit: int, i: int, x: Column) -> Column:
        low = F.lit((1 << bit) - 1)
        swapped = at(x, 0).bitwiseXOR(at(x, i)).bitwiseAND(low)
        is_set = at(x, i).bitwiseAND(F.lit(1 << bit)) != 0
        if i == 0:
            return put(x, {0: F.when(is_set, at(x, 0).bitwiseXOR(low)).otherwise(at(x, 0))})
        return put(x, {0: F.when(is_set, at(x, 0).bitwiseXOR(low)).otherwise(at(x, 0).bitwiseXOR(swapped)),
                       i: F.when(is_set, at(x, i)).otherwise(at(x, i).bitwiseXOR(swapped))})

    def decode(i: int, x: Column) -> Column:
        return put(x, {i: at(x, i).bitwiseXOR(at(x, i - 1))})

    def gray(x: Column) -> Column:
        flip = F.lit(0)
        for bit in range(bits - 1, 0, -1):
            flip = flip.bitwiseXOR(F.when(at(x, n - 1).bitwiseAND(F.lit(1 << bit)) != 0,
                                          F.lit((1 << bit) - 1)).otherwise(F.lit(0)))
        return F.array(*[at(x, i).bitwiseXOR(flip) for i in range(n)])

    # a one-element array carried through transform() holds each step's value once, without repeating it
    held = F.array(F.array(*[x.cast("int") for x in levels]))
    for bit in range(bits - 1, 0, -1):
        for i in range(n):
            held = F.transform(held, partial(undo, bit, i))
    for i in range(1, n):
        held = F.transform(held, partial(decode, i))
    held = F.transform(held, gray)

    def interleave(x: Column) -> Column:
        bits_of = [F.shiftleft(F.shiftright(at(x, i), bit).bitwiseAND(F.lit(1)).cast("long"), bit * n + n - 1 - i)
                   for bit in range(bits) for i in range(n)]
        total = bits_of[0]
        for one in bits_of[1:]:
            total = total.bitwiseOR(one)
        return total

    return F.element_at(F.transform(held, interleave), 1)


def number_level(value: Column, cuts: list[float]) -> Column:
    """How many cuts are at most the value; null is level 0."""
    level = F.lit(0)
    for cut in cuts:
        level = level + (F.coalesce(value, F.lit(float("-inf"))) >= F.lit(cut)).cast("int")
    return level


def text_level(value: Column, bits: int = BITS) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(value, F.lit(""))), F.lit(1 << bits)).cast("int")


def shard(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, curve, shard, slot, under the law of equal row counts.

    ``size`` is the text's UTF-8 bytes plus 8; a null text has no bytes and the checksum of no bytes.
    Null ids and metadata have their own place in the order; repeated rows each take a slot; an empty
    table gives no rows. Dimensions: size, source and language; other columns are not read. The rows'
    few numbers are written once, dealt by ranges of the order; a row's rank is the count of the
    ranges before its own plus its place in it, so no task holds more than a range.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"),
                       text_level(F.col("source"), bits).alias("source_level"),
                       text_level(F.col("lang"), bits).alias("lang_level"))
    steps = 1 << bits
    cuts = sorted(set(docs.select(F.octet_length(text).cast("double").alias("n")).approxQuantile(
        "n", [k / steps for k in range(1, steps)], QUANTILE_ERROR)))
    curve = hilbert_index([number_level(F.col("size") - 8, cuts), F.col("source_level"),
                           F.col("lang_level")], bits)
    order = ["curve", "text_crc32", "doc_id", "size"]
    placed = stage(rows.withColumn("curve", curve).drop("source_level", "lang_level").repartitionByRange(
        *order, F.monotonically_increasing_id()).withColumn("range", F.spark_partition_id()), "curve")
    counts = placed.groupBy("range").count().orderBy("range").collect()  # one row per partition
    total, before, starts = sum(r["count"] for r in counts), 0, []
    for r in counts:
        starts.append((r["range"], before))
        before += r["count"]
    offsets = F.broadcast(spark.createDataFrame(starts, "range int, before long"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    # the first `longer` shards have one row more than the others
    each, longer = divmod(total, shards)
    rank = placed.withColumn("place", place).join(offsets, "range").withColumn(
        "rank", F.col("before") + F.col("place") - 1)
    early = F.col("rank") < longer * (each + 1)
    later = F.col("rank") - longer * (each + 1)
    return rank.select(
        "doc_id", "size", "text_crc32", "curve",
        F.when(early, F.floor(F.col("rank") / (each + 1))).otherwise(
            longer + F.floor(later / max(each, 1))).cast("int").alias("shard"),
        F.when(early, F.pmod("rank", F.lit(each + 1))).otherwise(
            F.pmod(later, F.lit(max(each, 1)))).cast("long").alias("slot"))


def query(spark, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")
