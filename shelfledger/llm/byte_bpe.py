"""Byte-level BPE by merge replay over the distinct words of a run of documents.

A task gathers its documents in chunks. A chunk's distinct pre-tokens are laid out as one array of symbols, and an
inverted index names, for every pair of symbols that the vocabulary can merge, the positions where it stands. Merges
are then applied in the order of their ranks, each at all its positions at once; only the pairs to the left and
right of a merged position change, and they enter the index under their new rank. A word is merged once, however
often the chunk has it; its ids are then copied to the places where it stands. Words don't depend on each
other, so no row is shuffled and a lost task is repeated from its own input.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from shelfledger.llm.common import kept_in_worker, ragged, text_bytes, texts

#: Bytes of text that a chunk aims at: it bounds a worker's memory. A longer text is a chunk of its own.
CHUNK_BYTES = 24 << 20
#: Characters that one search of the pattern covers, words or ids that one copy handles, bytes of an output batch.
WINDOW, RUN, BATCH = 1 << 18, 1 << 20, 4 << 20
NONE = np.int32(2**31 - 1)
PATTERN = public_tokenizers.PATTERN
#: Before a blank that follows a non-blank no match of the pattern goes on, so a text can be cut there.
_CUT = regex.compile(r"(?<=\S)\s")


class Vocabulary:
    """Ranks of a ``.tiktoken`` file and all pairs of tokens that are a token together."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has all 256 bytes")
        self.pieces = {rank: piece for piece, rank in ranks.items()}
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for piece, rank in ranks.items():
            for k in range(1, len(piece)):
                left, right = ranks.get(piece[:k]), ranks.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.merges = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()] + [NONE], np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of every pair, NONE where it is no token."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.searchsorted(self.keys, keys)
        hit = at < len(self.keys)
        hit[hit] = self.keys[at[hit]] == keys[hit]
        return np.where(hit, self.ranks[at], NONE)


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary at ``path``, once per worker."""
    def load():
        with open(path, "rb") as lines:
            return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})
    return kept_in_worker(f"vocabulary {path}", load)


def merged_alone(word: bytes, own: Vocabulary) -> list[int]:
    """The ids of one word, merging the pair of least rank, the leftmost of several, until there is none."""
    symbol = own.of_byte[list(word)].tolist()
    n = len(symbol)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    found = lambda k: own.merges.get(symbol[k] << 32 | symbol[after[k]]) if after[k] < n else None
    waiting = [(r, k) for k in range(n) if (r := found(k)) is not None]
    heapq.heapify(waiting)
    while waiting:
        rank, k = heapq.heappop(waiting)
        if symbol[k] < 0 or found(k) != rank:
            continue
        gone = after[k]
        symbol[k], symbol[gone], after[k] = rank, -1, after[gone]
        if after[k] < n:
            before[after[k]] = k
        for x in (k, before[k]):
            if x >= 0 and (r := found(x)) is not None:
                heapq.heappush(waiting, (r, x))
    return [s for s in symbol if s >= 0]


def replay(data: np.ndarray, offsets: np.ndarray, own: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words given as bytes one after another: all ids, and the offsets of the words among them."""
    n = len(data)
    symbol = np.append(own.of_byte[data], np.int32(-1))
    after = np.arange(1, n + 2, dtype=np.int32)
    before = np.arange(-1, n, dtype=np.int32)
    ends, starts = offsets[1:][np.diff(offsets) > 0], offsets[:-1][np.diff(offsets) > 0]
    after[ends - 1], before[starts] = n, n  # n stands for no neighbour
    rank = own.rank(symbol, symbol[after.clip(max=n)])
    rank[ends - 1] = rank[n] = NONE
    index = np.argsort(rank[:n], kind="stable").astype(np.int32)
    index = index[:np.searchsorted(rank[index], NONE)]
    cuts = np.flatnonzero(np.diff(rank[index], prepend=-1))
    groups = dict(zip(rank[index[cuts]].tolist(), zip(cuts.tolist(), [*cuts[1:].tolist(), len(index)])))
    more: dict[int, list[int]] = defaultdict(list)
    heap, marked, odd = sorted(groups), np.zeros(n + 1, bool), []
    while heap:
        now = heapq.heappop(heap)
        lo, hi = groups.pop(now, (0, 0))
        at = index[lo:hi]
        if now in more:
            at = np.sort(np.concatenate([at, np.array(more.pop(now), np.int32)]))
        at = at[rank[at] == now]
        if not len(at):
            continue
        if len(at) > 1:  # of pairs that overlap every second one is merged, from the left
            linked = after[at[:-1]] == at[1:]
            if linked.any():
                first = np.concatenate([[True], ~linked])
                place = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
                at = at[place % 2 == 0]
        gone = after[at]
        follows = after[gone]
        beside = at[:-1][follows[:-1] == at[1:]]
        if len(beside):  # one by one, the left of two neighbours would meet the right one's first symbol for a while
            met = own.rank(np.full(len(beside), now), symbol[after[after[beside]]])
            if (met < now).any():
                odd.append(beside[met < now])
        symbol[at], symbol[gone], rank[gone] = now, -1, NONE
        after[at], before[follows] = follows, at
        marked[at] = True
        left = before[at]
        left = left[(left < n) & ~marked[left]]
        marked[at] = False
        touched = np.concatenate([at, left])
        new = own.rank(symbol[touched], symbol[after[touched]])
        rank[touched] = new
        if (new < now).any():
            odd.append(touched[new < now])
        can = new != NONE
        for r, k in zip(new[can].tolist(), touched[can].tolist()):
            if r not in more and r not in groups:
                heapq.heappush(heap, r)
            more[r].append(k)
    alive = np.flatnonzero(symbol[:n] >= 0)
    ids, bounds = symbol[alive], np.searchsorted(alive, offsets)
    if odd:  # a merge made a pair of lower rank, which goes before the word's other merges: these words are done alone
        words = np.unique(np.searchsorted(offsets, np.concatenate(odd), "right") - 1)
        parts = np.split(ids, bounds[1:-1])
        for w in words.tolist():
            parts[w] = np.array(merged_alone(data[offsets[w]:offsets[w + 1]].tobytes(), own), np.int32)
        ids, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return ids, bounds


def pretokens(text: str, pattern: str = PATTERN) -> Iterator[list[str]]:
    """The matches of the pattern, a window of text at a time."""
    find = kept_in_worker(f"pattern {pattern}", lambda: regex.compile(pattern)).findall
    at = 0
    while at < len(text):
        cut = _CUT.search(text, at + WINDOW) if len(text) - at > WINDOW else None
        end = cut.start() if cut else len(text)
        yield find(text, pos=at, endpos=end)
        at = end


class _Chunk:
    """Documents as numbers of words, and the words."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.words: list[np.ndarray] = []
        self.number: dict[str, int] = defaultdict(count().__next__)
        self.size = 0

    def add(self, row: tuple, text: str, size: int) -> None:
        number = self.number.__getitem__
        parts = [np.fromiter(map(number, found), np.int32, len(found)) for found in pretokens(text)]
        self.rows.append(row)
        self.words.append(np.concatenate(parts) if parts else np.zeros(0, np.int32))
        self.size += size

    def encoded(self, own: Vocabulary) -> Iterator[tuple[list[tuple], list[bytes]]]:
        """Rows with their ids as little-endian 32-bit integers, in batches bounded by bytes."""
        joined = [w.encode() for w in self.number]
        offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined)))])
        data = np.frombuffer(b"".join(joined), np.uint8)
        self.number.clear()
        joined.clear()
        ids, bounds = replay(data, offsets, own)
        lengths, ids = np.diff(bounds), ids.astype("<u4")
        rows, packed, held = [], [], 0
        for row, words in zip(self.rows, self.words):
            parts = []
            for lo in range(0, len(words), RUN):
                run = words[lo:lo + RUN]
                owner, place = ragged(lengths[run])
                parts.append(ids[bounds[run][owner] + place].tobytes())
            rows.append(row)
            packed.append(b"".join(parts))
            held += len(packed[-1])
            if held >= BATCH:
                yield rows, packed
                rows, packed, held = [], [], 0
        if rows:
            yield rows, packed


def _encode(path: str):
    def encode_rows(batches):
        own = vocabulary(path)

        def done(chunk):
            for rows, packed in chunk.encoded(own):
                ids, sizes = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                                                  pa.array(packed, pa.binary())], ["doc_id", "n_bytes", "ids"])
        chunk = _Chunk()
        for batch in batches:
            sizes = np.diff(text_bytes(batch.column("text"))[1]).tolist()
            for doc_id, text, size in zip(batch.column("doc_id").to_pylist(), batch.column("text"), sizes):
                if chunk.rows and chunk.size + size > CHUNK_BYTES:
                    yield from done(chunk)
                    chunk = _Chunk()
                chunk.add((doc_id, size), text.as_py() or "", size)
        if chunk.rows:
            yield from done(chunk)
    return encode_rows


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, n_bytes of the text (UTF-8) and ids, its token ids as little-endian unsigned 32-bit integers.

    ``path`` is a file of ranks that every worker can read. No special token is known: their strings are ordinary text.
    A null or empty text has no ids; repeated rows and null ids stay rows of their own; an empty table gives no
    rows; other columns are not read. A text that is longer than a chunk is one of its own: memory follows the longest
    text, and the longest run without a blank in it.
    """
    return texts(docs).mapInArrow(_encode(path), "doc_id long, n_bytes long, ids binary")


def _decode(path: str):
    def decode_rows(batches):
        piece = vocabulary(path).pieces.__getitem__
        for batch in batches:
            out = []
            for packed in batch.column("ids"):
                ids = np.frombuffer(packed.as_py() or b"", "<u4")
                out.append(b"".join(b"".join(map(piece, ids[lo:lo + RUN].tolist())) for lo in range(0, len(ids), RUN)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])
    return decode_rows


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with ``decoded``, the bytes that their ``ids`` stand for; null ids give none. An id that the vocabulary
    doesn't have is an error. ``encoded`` has no column of the name ``decoded``."""
    return encoded.mapInArrow(_decode(path), StructType([*encoded.schema.fields, StructField("decoded", BinaryType())]))


def query(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and n_bytes of every document."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path), path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), "n_bytes")
