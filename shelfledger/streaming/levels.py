"""Tables that a stream keeps besides its output, written by levels.

A batch adds one part to level 0; as soon as a level has ``fanout`` parts of a range of batches, they are merged into one part of
the next level. Which parts are live follows from the number of batches alone, like the digits of a number, so there is no list of
files to keep, and a batch that is run again writes the same parts again. A row is written once per level: what a batch
writes follows the batches, and not the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfledger.session import remove

FANOUT, BUCKETS = 8, 8
#: Ids per 64-bit word of an id log's bits, of which each sets two.
IDS_PER_WORD = 4


@dataclass(frozen=True)
class Levels:
    """Parts below ``path``, each in folders by the hash of ``keys``; ``merge`` reduces what several parts hold."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    merge: Callable[[DataFrame], DataFrame]
    fanout: int = FANOUT
    buckets: int = BUCKETS

    def live(self, batches: int) -> list[tuple[int, int]]:
        """Level and first batch of the parts that hold what the first ``batches`` batches added."""
        size, level, first, parts = 1, 0, 0, []
        while size * self.fanout <= batches:
            size, level = size * self.fanout, level + 1
        while level >= 0:
            while batches - first >= size:
                parts.append((level, first))
                first += size
            size, level = size // self.fanout, level - 1
        return parts

    def part(self, level: int, first: int) -> str:
        return f"{self.path}/level={level}/first={first}"

    def bucket(self, *values: Column | str) -> Column:
        return F.pmod(F.xxhash64(*values), F.lit(self.buckets)).cast("int")

    def _parts(self, parts: Sequence[tuple[int, int]]) -> DataFrame:
        own = T.StructType([*self.schema.fields, *[T.StructField(n, T.IntegerType()) for n in ("level", "first", "bucket")]])
        if not parts:
            return self.spark.createDataFrame([], own)
        return self.spark.read.schema(own).option("basePath", self.path).parquet(*[self.part(*p) for p in parts])

    def rows(self, batches: int) -> DataFrame:
        """All rows of the live parts, with their level, first batch and bucket, not merged."""
        return self._parts(self.live(batches))

    def read(self, batches: int, **key) -> DataFrame:
        """The table after so many batches; with values for all keys only their folders are read."""
        rows = self.rows(batches)
        if key:
            types = {f.name: f.dataType for f in self.schema}
            values = [F.lit(key[k]).cast(types[k]) for k in self.keys]
            rows = rows.filter(F.col("bucket") == self.spark.range(1).select(self.bucket(*values).alias("b")).first()["b"])
            for k, v in zip(self.keys, values):
                rows = rows.filter(F.col(k) == v)
        return self.merge(rows.select(*self.schema.fieldNames()))

    def _write(self, rows: DataFrame, level: int, first: int) -> None:
        (rows.select(*self.schema.fieldNames()).withColumn("bucket", self.bucket(*self.keys))
         .repartition("bucket", *self.keys).write.mode("overwrite").partitionBy("bucket").parquet(self.part(level, first)))

    def due(self, batch: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
        """The merges that the end of this batch brings: level, first batch, and the parts that go in."""
        found, size, level = [], 1, 1
        while (batch + 1) % (size * self.fanout) == 0:
            first = batch + 1 - size * self.fanout
            found.append((level, first, [(level - 1, first + k * size) for k in range(self.fanout)]))
            size, level = size * self.fanout, level + 1
        return found

    def append(self, batch: int, rows: DataFrame) -> list[tuple[int, int]]:
        """Write the part of a batch, and the merges that are due; returns what was written. Parts that
        went into an older merge are removed ``fanout`` batches later, when no reader uses them any more."""
        self._write(rows, 0, batch)
        written = [(0, batch)]
        for level, first, parts in self.due(batch):
            self._write(self.merge(self._parts(parts).select(*self.schema.fieldNames())), level, first)
            written.append((level, first))
        for _, _, parts in self.due(batch - self.fanout) if batch >= self.fanout else []:
            for p in parts:
                remove(self.spark, self.part(*p))
        return written


IDS = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("event_time", T.TimestampType())])
_BITS = T.StructType([T.StructField("word", T.LongType()), T.StructField("bits", T.LongType())])


def _hash() -> Column:
    return F.xxhash64("event_id", F.lit("bits"))


def _mask(hashed: Column) -> Column:
    one = F.lit(1).cast("long")
    at = lambda shift: F.pmod(F.shiftright(hashed, shift), F.lit(64)).cast("int")
    return F.call_function("shiftleft", one, at(40)).bitwiseOR(F.call_function("shiftleft", one, at(50)))


class IdLog:
    """All event ids so far. Each part has a table of bits, two for each id in one word of 64 (a Bloom filter). An id is looked
    up in the bits first; only the folders that may hold one are read and compared."""

    def __init__(self, spark: SparkSession, path: str, keep: Column | None = None, **sizes):
        self.spark, self.bits = spark, f"{path}/bits"
        # parts hold different ids, so a merge only puts them together; ``keep`` lets old ones go
        self.log = Levels(spark, f"{path}/ids", IDS, ("event_id",), (lambda r: r.filter(keep)) if keep is not None else (lambda r: r), **sizes)

    def _words(self, level: int, first: int) -> str:
        return f"{self.bits}/level={level}/first={first}"

    def append(self, batch: int, ids: DataFrame) -> None:
        for level, first in self.log.append(batch, ids):
            rows = self.log._parts([(level, first)])
            words = max(1, rows.count() // IDS_PER_WORD)
            (rows.groupBy(F.pmod(_hash(), F.lit(words)).alias("word")).agg(F.bit_or(_mask(_hash())).alias("bits"))
             .withColumn("words", F.lit(words)).write.mode("overwrite").partitionBy("words").parquet(self._words(level, first)))
        for _, _, parts in self.log.due(batch - self.log.fanout) if batch >= self.log.fanout else []:
            for p in parts:
                remove(self.spark, self._words(*p))

    def candidates(self, batches: int, ids: DataFrame) -> DataFrame:
        """(event_id, level, first) where the bits don't rule out that the part holds the id."""
        parts = self.log.live(batches)
        own = T.StructType([*_BITS.fields, *[T.StructField(n, T.IntegerType()) for n in ("level", "first")], T.StructField("words", T.LongType())])
        bits = self.spark.read.schema(own).option("basePath", self.bits).parquet(*[self._words(*p) for p in parts])
        sizes = bits.select("level", "first", "words").distinct().collect()  # a row per part, from the folders' names
        each = F.explode(F.array(*[F.struct(*[F.lit(r[n]).alias(n) for n in ("level", "first", "words")]) for r in sizes]))
        asked = ids.select("event_id", each.alias("part")).select("event_id", "part.*").withColumn("word", F.pmod(_hash(), F.col("words")))
        return asked.join(bits, ["level", "first", "words", "word"]).filter(
            F.col("bits").bitwiseAND(_mask(_hash())) == _mask(_hash())).select("event_id", "level", "first")

    def known(self, batches: int, ids: DataFrame) -> DataFrame:
        """The rows (event_id, event_time) of the log for these ids, which are distinct and not null."""
        if not batches:
            return self.spark.createDataFrame([], IDS)
        found = self.candidates(batches, ids).withColumn("bucket", self.log.bucket("event_id"))
        folders = [tuple(r) for r in found.select("level", "first", "bucket").distinct().collect()]  # parts x buckets at most
        if not folders:
            return self.spark.createDataFrame([], IDS)
        inside = F.struct("level", "first", "bucket").isin([F.struct(*map(F.lit, f)) for f in folders])
        rows = self.log.rows(batches).filter(F.col("bucket").isin(sorted({f[2] for f in folders}))).filter(inside)
        return rows.join(found.select("event_id").distinct(), "event_id", "left_semi").select(*IDS.fieldNames())
