"""What the operators share: column choice, Arrow text as bytes, words and their hashes in numpy."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfledger.operators.skew import planner_bytes
from shelfledger.session import configure, remove, scratch_dir, stage

#: Bytes of text that one numpy pass handles; it bounds a worker's memory. A longer text is a pass of its own.
SLICE = 1 << 19
#: Bytes of a staged frame for which one task writes what is derived from it.
TASK_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_2 = 0xC2B2AE3D27D4EB4F


def fold(doc_id: str | Column, parts: int) -> Column:
    """The part of a row by the checksum of its id as text; an id that is null falls in part 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(parts)), F.lit(0))


def configured(function: Callable) -> Callable:
    """The function of a session, with the engine's settings (bounded Arrow batches above all) applied first."""
    @wraps(function)
    def run(spark, *arguments):
        return function(configure(spark), *arguments)
    return run


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """Id, text and named columns alone, so that other columns may have any name."""
    return docs.select("doc_id", "text", *more)


def written(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """A frame written to the shared storage and read back, and what removes it there."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), lambda: remove(spark, path)


def tasks_of(df: DataFrame) -> int:
    """A task for every TASK_BYTES of a staged frame, and two for each core at least: for tables of numbers that are derived
    from it. The number grows with the frame, whatever the shuffle partitions and file splits are."""
    return max(-(-planner_bytes(df) // TASK_BYTES), 2 * df.sparkSession.sparkContext.defaultParallelism)


def release(spark) -> None:
    """Let Spark drop the shuffle files of steps whose results are written: it does so once their plans are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _forget(now: int) -> None:
    """Let go what this worker kept for stages before the last two."""
    store = sys.__dict__.setdefault("_llm_kept", {})
    if store.get("stage") != now:
        for old in [k for k, v in store.items() if k != "stage" and v[1] not in (store["stage"], now)]:
            del store[old]
        store["stage"] = now


def kept_in_worker(key: str, build: Callable):
    """A value that a Python worker builds once and keeps for its later tasks. A worker serves many stages; a value
    that none of the last two stages asked for is let go."""
    task = TaskContext.get()
    now = task.stageId() if task else -1
    _forget(now)
    store = sys.__dict__["_llm_kept"]
    value = store[key][0] if key in store else build()
    store[key] = value, now
    return value


def give_back() -> None:
    """Return what this process has freed to the system: the allocators of Arrow and of C keep it for themselves otherwise,
    and the workers of an executor, idle ones too, add up."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def frugal(function: Callable) -> Callable:
    """The function for ``mapInArrow``; at the end of a task its worker lets go what later tasks don't need."""
    @wraps(function)
    def run(batches):
        try:
            yield from function(batches)
        finally:
            task = TaskContext.get()
            _forget(task.stageId() if task else -1)
            give_back()
    return run


def tokenizer(path: str):
    """A tokenizer of the ``tokenizers`` library, on one thread."""
    def load():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        return Tokenizer.from_file(path)
    return kept_in_worker(f"tokenizer {path}", load)


def byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for themselves,
    the others for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(plain))}


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows one after another, and the offsets of the rows; null is empty."""
    column = pc.fill_null(column, "")
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def text_slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``limit`` bytes: first row, end row, bytes, offsets."""
    data, offsets = text_bytes(column)
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: Bytes between words: the ASCII white space.
SPACE = _table(b" \t\n\v\f\r")
#: Bytes between words of letters and digits: all of ASCII but letters and digits.
PUNCTUATION = _table(bytes(b for b in range(128) if not chr(b).isalnum()))
#: ASCII capitals to small letters.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte bounds of the words of a slice and, per document, the index of its first word."""
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    inside = np.concatenate([~separators[data], [False]])
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | first))
    ends = np.flatnonzero(before & (~inside | first))
    return starts, ends, np.searchsorted(starts, offsets)


class _Powers:
    """The longest powers of a base so far."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n < len(self.up):
            return self.up, self.down
        size = 1 << max(12, (n + 1).bit_length())
        up, down = np.full(size, self.base, np.uint64), np.full(size, pow(self.base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        np.cumprod(up, out=up)
        np.cumprod(down, out=down)
        if size <= 16 * SLICE:  # those of one very long text are not kept
            self.up, self.down = up, down
        return up, down


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64, at least to the n-th."""
    return kept_in_worker(f"powers {base}", lambda: _Powers(base)).of(n)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hashes of runs of values by one prefix sum; equal runs have equal hashes wherever they stand."""
    up, down = powers(len(values), base)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:len(values)], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths * np.uint64(_BASE_2))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words given as bytes. A sum of powers modulo 2**64 is the same for some long words of two letters
    (Thue-Morse strings), whatever the base, so words of more than 64 bytes are hashed by another function."""
    hashed = run_hashes(data, starts, ends)
    for k in np.flatnonzero(ends - starts > 64).tolist():
        hashed[k] = xxhash.xxh3_64_intdigest(data[starts[k]:ends[k]].tobytes())
    return hashed


def second_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return run_hashes(values, starts, ends, _BASE_2)


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of given lengths: the group of every element and its place in the group."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return owner, np.arange(len(owner)) - first[owner]


def running(rows: DataFrame, key: str, order: list[Column], totals: dict[str, tuple[str, Column]]) -> DataFrame:
    """The rows, written, with running totals in each ``key`` by ``order``, the row itself included.

    ``totals`` has by name the kind, ``sum`` or ``bit_xor``, and the value. Rows are dealt by ranges of key and
    order, so that those of one key may lie in many partitions; what the partitions before hold of a key is added
    to each. Only the keys that lie in several partitions, at most two for each partition, are broadcast.
    """
    kinds = {"sum": (F.sum, lambda a, b: a + b), "bit_xor": (F.bit_xor, lambda a, b: a.bitwiseXOR(b))}
    dealt = rows.repartitionByRange(F.col(key), *order).withColumn("_part", F.spark_partition_id())
    own = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = stage(dealt.withColumns({name: kinds[kind][0](value).over(own) for name, (kind, value) in totals.items()}
                                     | {f"_{name}": value for name, (_, value) in totals.items()}), "running")
    parts = inside.groupBy(key, "_part").agg(*[kinds[kind][0](f"_{name}").alias(f"_{name}") for name, (kind, _) in totals.items()])
    several = parts.groupBy(key).agg(F.min("_part").alias("lo"), F.max("_part").alias("hi")).filter("lo < hi").select(key)
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.join(several, key, "left_semi").select(
        key, "_part", *[kinds[kind][0](f"_{name}").over(earlier).alias(f"_{name}") for name, (kind, _) in totals.items()])
    joined = inside.drop(*[f"_{name}" for name in totals]).join(F.broadcast(before), [key, "_part"], "left")
    return joined.select(*rows.columns, *[kinds[kind][1](F.col(name), F.coalesce(f"_{name}", F.lit(0))).alias(name)
                                          for name, (kind, _) in totals.items()])
