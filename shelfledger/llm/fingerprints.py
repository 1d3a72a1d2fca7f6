"""Document fingerprints: one-permutation MinHash, densified, of packed low-order bits.

Every word shingle is hashed once; the top bits of the hash choose a bin and a bin keeps its least hash. An
empty bin takes the value of a bin that a second hash of its own number picks, so the same bin
in any two texts looks in the same order. Eight low bits of each bin are stored, eight bins to a long; the
share of equal bins, less what chance makes equal, estimates the Jaccard similarity. DataFrame
functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
#: Low-order bits kept of each bin.
BITS = 8
#: Bins that an empty bin tries by hash; after them it takes the next full one in circular order.
TRIES = 12
#: Rows that a run of the id order aims at.
RUN_ROWS = 2_000
_REST = 64 - BIN_BITS
_MOST = (1 << _REST) - 1


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, wherever ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bin(x: Column) -> Column:
    return F.shiftright(x, _REST)


def _empty(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_MOST)) == _MOST


def _least_per_bin(hashes: Column) -> Column:
    """The least hash of each bin in the order of the bins; an empty bin has its greatest value."""
    last = F.array(*[F.lit(_signed(((k << _REST) & ((1 << 64) - 1)) | _MOST)) for k in range(-BINS // 2, BINS // 2)])
    return let(F.sort_array(F.concat(hashes, last)), lambda v: F.filter(
        v, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(v, i - 1)))))


def _densify(bins: Column) -> Column:
    numbers = F.sequence(F.lit(1), F.lit(TRIES))
    around = F.sequence(F.lit(1), F.lit(BINS - 1))

    def borrowed(v: Column, i: Column) -> Column:
        by_hash = F.filter(F.transform(numbers, lambda t: F.get(v, F.pmod(F.xxhash64(i, t), F.lit(BINS)).cast("int"))),
                           lambda x: ~_empty(x))
        by_turn = F.filter(F.transform(around, lambda t: F.get(v, F.pmod(i + t, F.lit(BINS)))), lambda x: ~_empty(x))
        return F.coalesce(F.get(by_hash, F.lit(0)), F.get(by_turn, F.lit(0)))
    full = lambda v: F.transform(v, lambda x, i: F.when(_empty(x), borrowed(v, i)).otherwise(x))
    return let(bins, lambda v: F.when(F.exists(v, _empty), full(v)).otherwise(v))


def _pack(bins: Column) -> Column:
    per_long = 64 // BITS

    def packed(v: Column, k: Column) -> Column:
        out = None
        for j in range(per_long):
            part = F.shiftleft(F.get(v, k * per_long + j).bitwiseAND(F.lit((1 << BITS) - 1)), BITS * j)
            out = part if out is None else out.bitwiseOR(part)
        return out
    return let(bins, lambda v: F.transform(F.sequence(F.lit(0), F.lit(BINS // per_long - 1)), lambda k: packed(v, k)))


def fingerprint(text: Column) -> Column:
    """Packed bins as an array of longs; empty for a text without words (a null one too). A text of up to
    five words is one shingle."""
    def hashes(words: Column) -> Column:
        return F.when(F.size(words) < SHINGLE, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.transform(
            F.sequence(F.lit(0), F.size(words) - SHINGLE),
            lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)])))
    split = F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")
    return let(split, lambda words: F.when(F.size(words) == 0, F.array().cast("array<long>")).otherwise(
        _pack(_densify(_least_per_bin(hashes(words))))))


def as_text(packed: Column) -> Column:
    """A fingerprint as hexadecimal digits."""
    return F.lower(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity: the share of equal bins, corrected for the bits that agree by chance.
    Two texts without words are alike, a text with and one without are not."""
    def folded(d: Column, mask: int, by: int) -> Column:
        return d.bitwiseOR(F.shiftrightunsigned(d.bitwiseAND(F.lit(_signed(mask * 0x0101010101010101))), by))

    def equal_bytes(x: Column, y: Column) -> Column:
        # the bits of each byte of the difference are folded into its lowest bit
        odd = let(x.bitwiseXOR(y), lambda d: let(folded(d, 0xF0, 4), lambda d: let(
            folded(d, 0x0C, 2), lambda d: folded(d, 0x02, 1).bitwiseAND(F.lit(0x0101010101010101)))))
        return F.lit(64 // BITS) - F.bit_count(odd)
    same = F.aggregate(F.zip_with(a, b, equal_bytes), F.lit(0), lambda total, x: total + x)
    chance = 2.0 ** -BITS
    share = (same / F.lit(float(BINS)) - chance) / (1 - chance)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(
        F.greatest(F.lit(0.0), share))


def _run_of(order: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most the value, found in two steps."""
    width = max(1, math.isqrt(len(bounds)))
    parts = [bounds[k:k + width] for k in range(0, len(bounds), width)]
    if not parts:
        return F.lit(0)
    lead = F.array(*[F.lit(p[0]) for p in parts])
    inner = F.array(*[F.array(*[F.lit(x) for x in p]) for p in parts])
    return let(F.size(F.filter(lead, lambda x: x <= order)), lambda k: F.when(k == 0, F.lit(0)).otherwise(
        (k - 1) * width + F.size(F.filter(F.get(inner, k - 1), lambda x: x <= order))))


def with_next(docs: DataFrame, columns: list[str], run_rows: int = RUN_ROWS) -> DataFrame:
    """Each row with ``next_<column>`` of the row that follows by doc_id; the first follows the last.

    Rows are dealt in runs of neighbouring ids and each run also gets the first row of the run after it,
    so no task sees more than a run. Null ids come first; rows with one id follow each other by a hash of their text.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    runs = max(64, docs.count() // run_rows)
    bounds = sorted({int(x) for x in docs.select(order.cast("double").alias("n")).approxQuantile(
        "n", [k / runs for k in range(1, runs)], 1 / (4 * runs))})
    dealt = docs.withColumns({"_order": order, "_run": _run_of(order, bounds)})
    heads = sorted((r["_run"], r["head"]) for r in dealt.groupBy("_run").agg(F.min("_order").alias("head")).collect())
    if not heads:
        return dealt.select(*docs.columns, *[F.col(c).alias(f"next_{c}") for c in columns])
    before = [(head, heads[k - 1][0], k == 0) for k, (_, head) in enumerate(heads)]
    also = spark.createDataFrame(before, "_order long, _earlier int, _wraps boolean")  # a row per run
    places = F.array(F.struct(F.col("_run").alias("run"), F.lit(False).alias("wraps"), F.lit(True).alias("own")),
                     F.struct(F.col("_earlier").alias("run"), F.col("_wraps").alias("wraps"), F.lit(False).alias("own")))
    spread = dealt.join(F.broadcast(also), "_order", "left").withColumn("_place", F.explode(
        F.when(F.col("_earlier").isNull(), F.slice(places, 1, 1)).otherwise(places)))
    window = Window.partitionBy("_place.run").orderBy(
        "_place.wraps", "_order", F.xxhash64("text"), F.col("_place.own").desc())
    return spread.withColumns({f"next_{c}": F.lead(c).over(window) for c in columns}).filter("_place.own").select(
        *docs.columns, *[f"next_{c}" for c in columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    printed = with_next(docs.withColumn("print", fingerprint(F.col("text"))), ["text", "print"])
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    with_edited = printed.select("doc_id", n.cast("long").alias("n_chars"), "print", "next_print", edited.alias("edited"))
    both = with_edited.select("doc_id", "n_chars", "print", "next_print", F.sha2("edited", 256).alias("edited_sha256"),
                              fingerprint(F.col("edited")).alias("edited_print"))
    return both.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("print")).alias("fingerprint"),
                       as_text(F.col("edited_print")).alias("edited_fingerprint"),
                       likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
                       likeness(F.col("print"), F.col("next_print")).alias("near_next"))
