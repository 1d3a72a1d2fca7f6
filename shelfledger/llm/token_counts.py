"""Token counts: pieces are counted once per distinct pre-token, and summed by frequency.

Merges never cross a pre-token, so a text has as many tokens as its pre-tokens have pieces. Each
chunk of documents gives one row per distinct pre-token and keeps its postings (document,
frequency) packed in one head row. Rows of one pre-token meet in one sorted run, where its pieces are
counted once; the counts go back to their chunk, where they are joined to the postings and summed.
No token ids are kept and no row exists per occurrence.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from itertools import count

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import byte_letters, kept_in_worker, text_bytes, texts, tokenizer

#: A chunk ends at so many bytes of text or documents, whichever comes first: it bounds a worker's memory.
CHUNK_BYTES = 32 << 20
CHUNK_DOCS = 1 << 15
_MOST = (1 << 16) - 1  # larger frequencies are cut in several postings

#: The published pre-token pattern of the byte-level vocabulary and its special token.
PATTERN = public_tokenizers.PATTERN
SPECIAL = "<|endoftext|>"


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text; the special string is one of its own."""
    find = kept_in_worker("pretokens", lambda: regex.compile(PATTERN)).findall
    if SPECIAL not in text:
        return find(text)
    first, *rest = text.split(SPECIAL)
    found = find(first)
    for part in rest:
        found += [SPECIAL, *find(part)]
    return found


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after another, each compressed, after their sizes."""
    parts = [pa.compress(x.tobytes(), codec="zstd", asbytes=True) for x in arrays]
    sizes = np.array([[len(p), x.nbytes] for p, x in zip(parts, arrays)], "<i8")
    return b"".join([sizes.tobytes(), *parts])


def _unpack(packed: bytes, *types: str) -> list[np.ndarray]:
    sizes = np.frombuffer(packed, "<i8", 2 * len(types)).reshape(-1, 2)
    at, out = 16 * len(types), []
    for kind, (short, full) in zip(types, sizes.tolist()):
        out.append(np.frombuffer(pa.decompress(packed[at:at + short], full, "zstd", asbytes=True), kind))
        at += short
    return out


def _rows(chunk: int, ids: list, sizes: list, vocabulary: dict, words: list, counts: list) -> pa.RecordBatch:
    """A head row with the documents and all postings, then a row per distinct pre-token."""
    word, freq = np.concatenate(words), np.concatenate(counts)
    doc = np.repeat(np.arange(len(words)), [len(x) for x in words])
    while (over := freq > _MOST).any():
        word, doc = np.concatenate([word, word[over]]), np.concatenate([doc, doc[over]])
        freq = np.concatenate([np.where(over, _MOST, freq), freq[over] - _MOST])
    order = np.argsort(word, kind="stable")
    head = _pack(np.array([i is not None for i in ids], "u1"), np.array([i or 0 for i in ids], "<i8"),
                 np.array(sizes, "<i8"), np.bincount(word, minlength=len(vocabulary)).astype("<u4"),
                 doc[order].astype("<u2"), freq[order].astype("<u2"))
    n = len(vocabulary)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n + 1, chunk, np.int64)), pa.array(np.arange(-1, n, dtype=np.int32)),
        pa.array([None, *vocabulary], pa.string()), pa.array([head] + [None] * n, pa.binary())],
        ["chunk", "word", "token", "postings"])


def _postings(batches):
    """Chunks of a partition. Their names follow from partition and place, so a repeated task repeats them."""
    part, number = TaskContext.get().partitionId(), count()

    def fresh():
        return [], [], defaultdict(count().__next__), [], []
    held, size = fresh(), 0
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        lengths = np.diff(offsets)
        for row, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(),
                                                 batch.column("text").to_pylist())):
            ids, sizes, vocabulary, words, counts = held
            found = Counter(pretokens(text or ""))
            ids.append(doc_id)
            sizes.append(int(lengths[row]))
            words.append(np.fromiter(map(vocabulary.__getitem__, found), np.int64, len(found)))
            counts.append(np.fromiter(found.values(), np.int64, len(found)))
            size += sizes[-1]
            if size >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                yield _rows((part << 32) + next(number), *held)
                held, size = fresh(), 0
    if held[0]:
        yield _rows((part << 32) + next(number), *held)


def _counter(path: str):
    """The number of pieces of a pre-token: the merges alone are run, on its bytes as letters."""
    merges, letters = tokenizer(path).model, byte_letters()

    def count_of(token: str) -> int:
        if token == SPECIAL:
            return 1
        return len(merges.tokenize(token.encode().decode("latin-1").translate(letters)))
    return count_of


def _count_pieces(path: str):
    def count_rows(batches):
        count_of, last, pieces = _counter(path), None, 0
        for batch in batches:
            tokens = batch.column("token").to_pylist()
            # sorted input: equal pre-tokens follow each other, over the end of a batch too
            distinct = [t for t in dict.fromkeys(tokens) if t is not None and t != last]
            known = dict(zip(distinct, map(count_of, distinct)))
            known |= {last: pieces, None: 0}
            values = [known[t] for t in tokens]
            last, pieces = tokens[-1], values[-1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), batch.column("word"), batch.column("postings"),
                 pa.array(values, pa.int32())], ["chunk", "word", "postings", "pieces"])
    return count_rows


def _sum(table: pa.Table) -> pa.Table:
    word, pieces = table.column("word").to_numpy(), table.column("pieces").to_numpy()
    head = table.column("postings")[int(np.flatnonzero(word < 0)[0])].as_py()
    valid, ids, sizes, docs, doc, freq = _unpack(head, "u1", "<i8", "<i8", "<u4", "<u2", "<u2")
    of_word = np.zeros(len(docs) + 1)
    of_word[word] = pieces  # the head's -1 is the last place, which no word has
    total = np.bincount(doc, np.repeat(of_word[:-1], docs) * freq, len(ids))
    return pa.table({"doc_id": pa.array(ids, mask=valid == 0), "n_bytes": sizes,
                     "n_tokens": total.astype(np.int64)})


def token_counts(docs: DataFrame, path: str, partitions: int | None = None) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8) and n_tokens of the vocabulary file at ``path``.

    A null or empty text has 0 of both; repeated rows stay apart; a null id stays null; an empty
    table gives no rows; other columns are not read. ``docs`` should be a table scan (rows in a
    fixed order), so that a repeated task forms the same chunks.
    """
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts(docs).mapInArrow(_postings, "chunk long, word int, token string, postings binary")
    counted = rows.repartition(n, F.coalesce("token", F.col("chunk").cast("string"))).sortWithinPartitions(
        "token").mapInArrow(_count_pieces(path), "chunk long, word int, postings binary, pieces int")
    return counted.groupBy("chunk").applyInArrow(_sum, "doc_id long, n_bytes long, n_tokens long")


def query(spark, sf_dir: str) -> DataFrame:
    counts = token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)
