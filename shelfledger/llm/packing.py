"""Packing: shortest-pack-first over the histogram of lengths.

Texts become token ids in the workers and are cut at the sequence length; only lengths and checksums
leave them. The histogram has a bounded number of bins, so the packing is planned from counts alone:
lengths are placed longest first into the pattern with the least room that they still fit, and a
pattern carries how many sequences follow it. Pieces get their place by the rank among pieces of
their length: the ranks of a length are laid over the patterns that use it.
"""

from __future__ import annotations

import bisect
import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfledger.llm.common import byte_letters, frugal, kept_in_worker, texts, tokenizer
from shelfledger.session import stage

LENGTH = 4096
#: Bytes of words and ids that a worker remembers; beyond it the memory starts anew. Bytes of a text handled at a time.
REMEMBERED, RUN = 64 << 20, 1 << 20
#: Rows that one rank group aims at, and the most groups besides one per length.
RANK_ROWS = 500
RANK_GROUPS = 20_000
PIECES = "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long"


#: Words of small Latin letters are one pre-token each, so the merges alone give their ids.
_SIMPLE = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: Where a blank changes nothing: the vocabulary parts letters and digits from the marks after them.
_BEFORE_MARK = re.compile(rb"([A-Za-z0-9])(?=[!-/:-@\[-`{-~])")
_SPACE = re.compile(rb"[\t-\r ]")
#: What keeps a text in its own case: letters outside Latin-1, signs of its first half, strings of special tokens. Without
#: these no letter is composed with what follows, and each capital becomes one small letter, byte by byte.
_OWN_CASE = re.compile(rb"[\xc0-\xc2\xc4-\xff]|<\|")
_SMALL = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9e and b != 0x97 else b for b in range(256))


class _Known(dict):
    """Ids of a word as little-endian bytes, found when it is first asked for."""

    def __init__(self, path: str):
        super().__init__()
        self.size = 0
        self.model, self.letters = tokenizer(path), byte_letters()
        self.merges = self.model.model

    def __missing__(self, word: bytes) -> bytes:
        small = word.lower()  # ASCII only, which comes to the same where all other letters are small and composed
        if _SIMPLE.fullmatch(small):
            plain = small.decode() if small.isascii() else small.decode("latin-1").translate(self.letters)
            found = [t.id for t in self.merges.tokenize(plain)]
        else:
            # in its own case: special strings are matched, and letters composed, before capitals become small
            found = self.model.encode(word.decode(), add_special_tokens=False).ids
        ids = self[word] = array("I", found).tobytes()
        self.size += len(word) + len(ids) + 150
        return ids


class _Words:
    """Ids of a text as little-endian bytes; the vocabulary never merges over ASCII white space."""

    def __init__(self, path: str):
        self.known = _Known(path)

    def of(self, text: bytes) -> bytes:
        """The ids of a text, a run of whole words at a time."""
        parts, at = [], 0
        while at < len(text):
            cut = _SPACE.search(text, at + RUN) if len(text) - at > RUN else None
            end = cut.start() if cut else len(text)
            parts.append(self._run(text[at:end]))
            at = end
        return parts[0] if len(parts) == 1 else b"".join(parts)

    def _run(self, text: bytes) -> bytes:
        known = self.known
        if known.size > REMEMBERED:
            known.clear()
            known.size = 0
        if not _OWN_CASE.search(text):
            text = text.translate(_SMALL)
        # a special token's string must stay in one word
        words = text.split() if b"<|" in text else _BEFORE_MARK.sub(rb"\1 ", text).split()
        return b"".join(map(known.__getitem__, words))


def _pieces(path: str, end_id: int, length: int):
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        known = kept_in_worker(f"words {path}", lambda: _Words(path))
        for batch in batches:
            out = [[], [], [], [], [], []]
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(),
                       batch.column("text").cast(pa.binary()).to_pylist())
            for doc_id, row, text in rows:
                ids = known.of(text or b"") + end
                total = len(ids) // 4
                for start in range(0, total, length):
                    part = ids[4 * start:4 * (start + length)]
                    for column, value in zip(out, (doc_id, row, start, len(part) // 4,
                                                   zlib.crc32(part), total)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in out],
                ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"])
    return cut


def token_pieces(docs: DataFrame, path: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """A row per piece of at most ``length`` ids; ``row`` tells rows with the same id apart."""
    rows = texts(docs).withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(frugal(_pieces(path, end_id, length)), PIECES)


@dataclass(frozen=True)
class Pattern:
    """``count`` sequences with pieces of these lengths, longest first."""
    lengths: tuple[int, ...]
    count: int


def pack_histogram(histogram: dict[int, int], length: int = LENGTH) -> list[Pattern]:
    """Shortest-pack-first: each length, longest first, goes where the least room is left over.

    Patterns are kept by their free room. As many sequences of a pattern as there are pieces of the
    length take one piece each, so the work follows the number of bins and patterns, not of pieces.
    """
    by_room: dict[int, dict[tuple[int, ...], int]] = {}
    rooms: list[int] = []

    def add(room: int, lengths: tuple[int, ...], count: int) -> None:
        if room not in by_room:
            by_room[room] = {}
            bisect.insort(rooms, room)
        by_room[room][lengths] = by_room[room].get(lengths, 0) + count

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):  # no pattern has room: open sequences that hold as many as fit
                each = min(left, length // size)
                count = left // each
                add(length - each * size, (size,) * each, count)
                left -= count * each
                continue
            room = rooms[at]
            lengths, count = by_room[room].popitem()
            if not by_room[room]:
                del by_room[room], rooms[at]
            each = min(room // size, left)
            used = min(count, left // each)
            add(room - each * size, lengths + (size,) * each, used)
            if count > used:
                add(room, lengths, count - used)
            left -= used * each
    return [Pattern(lengths, count) for room in sorted(by_room)
            for lengths, count in sorted(by_room[room].items())]


def _intervals(patterns: list[Pattern]) -> dict[int, list[np.ndarray]]:
    """Per length: first rank, first sequence, slots per sequence and first offset of every interval."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern in patterns:
        offset, at = 0, 0
        while at < len(pattern.lengths):
            size = pattern.lengths[at]
            slots = pattern.lengths.count(size)
            rank = ranks.get(size, 0)
            found.setdefault(size, []).append((rank, sequence, slots, offset))
            ranks[size] = rank + pattern.count * slots
            offset += size * slots
            at += slots
        sequence += pattern.count
    return {size: list(np.array(rows, np.int64).T) for size, rows in found.items()}


def _place(intervals: dict[int, list[np.ndarray]]):
    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                first, base, slots, begin = intervals[int(length[rows[0]])]
                at = np.searchsorted(first, rank[rows], "right") - 1
                inside = rank[rows] - first[at]
                sequence[rows] = base[at] + inside // slots[at]
                offset[rows] = begin[at] + inside % slots[at] * length[rows]
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
    return place


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``rank`` of each piece among those of its length, from 0; a length of many pieces is dealt
    over several groups by its row, whose sizes are summed up first."""
    spark = pieces.sparkSession
    aim = max(RANK_ROWS, sum(histogram.values()) // RANK_GROUPS)
    groups = spark.createDataFrame([(k, v // aim + 1) for k, v in histogram.items()], "length long, parts long")
    dealt = pieces.join(F.broadcast(groups), "length").withColumn(
        "part", F.pmod(F.xxhash64("row", "start"), "parts")).drop("parts")
    sizes = dealt.groupBy("length", "part").count()
    before = sizes.select("length", "part", F.coalesce(F.sum("count").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("before"))  # at most one row per length and RANK_GROUPS more
    place = F.row_number().over(Window.partitionBy("length", "part").orderBy("row", "start"))
    return dealt.withColumn("place", place).join(F.broadcast(before), ["length", "part"]).withColumn(
        "rank", F.col("before") + F.col("place") - 1)


def pack(docs: DataFrame, path: str, end_id: int, length: int = LENGTH) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is the end id alone. Repeated rows and null ids keep pieces of their own;
    an empty table gives no rows; other columns are not read. Pieces are written to the shared
    folder first, so that a lost executor can't deal ranks anew.
    """
    spark = docs.sparkSession
    pieces = stage(token_pieces(docs, path, end_id, length), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # <= length rows
    intervals = _intervals(pack_histogram(histogram, length))
    if not histogram:
        return spark.createDataFrame(
            [], "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return ranked(pieces, histogram).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        frugal(_place(intervals)), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                public_tokenizers.path("word_bpe_49k.json"), end_id=2)
