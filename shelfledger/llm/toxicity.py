"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Only documents are labelled, so the words to learn from are labelled first: a word of a toxic document
is toxic where one of its features occurs in far more toxic than clean documents than chance allows.
The field has one weight per hashed feature (the word and its beginnings) and four transitions, trained by
gradient ascent of the likelihood. Forward-backward marginals are summed up per document; a logistic
curve over the sums, fitted on the same labelled documents, is the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import LOWER, PUNCTUATION, fold, run_hashes, text_slices, word_bounds

BUCKETS = 1 << 18
#: Beginnings of a word, in bytes, that are features besides the whole word.
PREFIXES = (4, 5, 6, 7)
#: Most labelled documents per class that the field is fitted on, and the longest of them in bytes.
FIT_DOCS = 1_500
FIT_BYTES = 20_000
#: A feature marks toxic words from this log-likelihood ratio and share of toxic documents on.
LEAST_RATIO = 20.0
LEAST_PURITY = 0.8
STEPS = 40
RATE = 0.5
DECAY = 1e-4
TOXIC_AT = 0.7
#: Bytes of text that are tagged together.
TOGETHER = 3 << 20


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets (a row per kind of feature; -1 where a word is too short for a beginning), byte bounds of
    the words, first word per document."""
    starts, ends, first = word_bounds(data, offsets, PUNCTUATION)
    low = LOWER[data]
    follows = np.concatenate([[False], data[:-1] == 0xC3])
    low[follows & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 0x20
    shift = np.uint64(64 - 18)
    rows = [(run_hashes(low, starts, ends) >> shift).astype(np.int64)]
    for k in PREFIXES:
        cut = np.minimum(starts + k, ends)
        hashed = (run_hashes(low, starts, cut) * np.uint64(2 * k + 1) >> shift).astype(np.int64)
        rows.append(np.where(ends - starts > k, hashed, -1))
    return np.stack(rows), starts, ends, first


@dataclass(frozen=True)
class Field:
    weights: np.ndarray  # per bucket; the last one is the bias
    moves: np.ndarray    # log weights of background/toxic to background/toxic
    curve: np.ndarray    # logistic weights of the document sums


def emissions(field: Field, buckets: np.ndarray) -> np.ndarray:
    """Log odds of toxic for every word by itself."""
    padded = np.concatenate([field.weights[:BUCKETS], [0.0]])  # -1 is the zero at the end
    return np.clip(sum(padded[row] for row in buckets) + field.weights[BUCKETS], -30, 30)


def marginals(e: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of toxic per word, and the forward and backward ratios, all documents at a time.

    The ratios toxic : background follow one another from word to word; documents are stepped
    together, longest first, so each step touches those that still have words.
    """
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = first[:-1][order], lengths[order]
    a = np.exp(moves)
    x = np.exp(e)
    forward, backward = np.empty_like(x), np.ones_like(x)
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), "right")
    for t in range(longest):
        at = starts[:active[t]] + t
        if t == 0:
            forward[at] = x[at]
        else:
            f = forward[at - 1]
            forward[at] = x[at] * (a[0, 1] + a[1, 1] * f) / (a[0, 0] + a[1, 0] * f)
    for t in range(longest - 2, -1, -1):
        at = starts[:active[t + 1]] + t
        after = x[at + 1] * backward[at + 1]
        backward[at] = (a[1, 0] + a[1, 1] * after) / (a[0, 0] + a[0, 1] * after)
    both = forward * backward
    return both / (1 + both), forward, backward


def _sums(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per document: 1, log of one more than the expected toxic words, the highest marginal, and the
    expected share of toxic words, drawn to 0 in short documents."""
    lengths = np.diff(first)
    out = np.zeros((len(lengths), 4))
    out[:, 0] = 1
    some = np.flatnonzero(lengths)
    if len(some):
        expected = np.add.reduceat(p, first[some])
        out[some, 1] = np.log1p(expected)
        out[some, 2] = np.maximum.reduceat(p, first[some])
        out[some, 3] = expected / (lengths[some] + 20)
    return out


def word_labels(buckets: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which words are toxic: those of toxic documents with a feature that toxic documents prefer."""
    doc = np.repeat(np.arange(len(toxic)), np.diff(first))
    counts = np.zeros((2, BUCKETS))
    for row in buckets:
        seen = np.unique(doc * (BUCKETS + 1) + row + 1)  # a document counts once per feature
        bucket, owner = seen % (BUCKETS + 1) - 1, seen // (BUCKETS + 1)
        for label in (0, 1):
            counts[label] += np.bincount(bucket[(bucket >= 0) & (toxic[owner] == label)], minlength=BUCKETS)
    sizes = np.maximum(np.bincount(toxic, minlength=2), 1)[:, None]
    share = counts / sizes
    pooled = np.clip(counts.sum(0) / sizes.sum(), 1e-9, 1 - 1e-9)

    def likelihood(q):
        q = np.clip(q, 1e-9, 1 - 1e-9)
        return (counts * np.log(q) + (sizes - counts) * np.log(1 - q)).sum(0)
    ratio = 2 * (likelihood(share) - likelihood(pooled))
    purity = share[1] / np.maximum(share.sum(0), 1e-12)
    marks = np.concatenate([(ratio >= LEAST_RATIO) & (purity >= LEAST_PURITY), [False]])
    return np.any([marks[row] for row in buckets], 0) & (toxic[doc] == 1)


def train(buckets: np.ndarray, first: np.ndarray, toxic: np.ndarray, share: float = 0.5,
          steps: int = STEPS) -> Field:
    """Gradient ascent (with a step size per weight) of the labelled words' likelihood under the chain."""
    y = word_labels(buckets, first, toxic).astype(np.float64)
    field = Field(np.zeros(BUCKETS + 1), np.zeros((2, 2)), np.zeros(4))
    weights, moves = field.weights, field.moves
    inner = np.ones(len(y), bool)  # words with a word after them in their document
    inner[first[1:][np.diff(first) > 0] - 1] = False
    at = np.flatnonzero(inner)
    seen_moves = np.array([[np.sum((y[at] == i) & (y[at + 1] == j)) for j in (0, 1)] for i in (0, 1)], float)
    squares, move_squares = np.full(BUCKETS + 1, 1e-8), np.full((2, 2), 1e-8)
    for _ in range(steps):
        e = emissions(field, buckets)
        p, forward, backward = marginals(e, first, moves)
        miss = y - p
        gradient = np.zeros(BUCKETS + 1)
        for row in buckets:
            gradient[:BUCKETS] += np.bincount(row[row >= 0], miss[row >= 0], BUCKETS)
        gradient[BUCKETS] = miss.sum()
        gradient -= DECAY * len(first) * weights
        a, after = np.exp(moves), np.exp(e[at + 1]) * backward[at + 1]
        pairs = np.stack([np.full(len(at), a[0, 0]), a[0, 1] * after, a[1, 0] * forward[at],
                          a[1, 1] * forward[at] * after])
        move_gradient = seen_moves - (pairs / pairs.sum(0)).sum(1).reshape(2, 2)
        squares += gradient ** 2
        move_squares += move_gradient ** 2
        weights += RATE * gradient / np.sqrt(squares)
        moves += RATE * move_gradient / np.sqrt(move_squares)
        moves -= moves[0, 0]
    x = _sums(marginals(emissions(field, buckets), first, moves)[0], first)
    return Field(weights, moves, _logistic(x, toxic.astype(float), share))


def _logistic(x: np.ndarray, y: np.ndarray, share: float, penalty: float = 1e-2) -> np.ndarray:
    """Newton's steps; the classes weigh as they do among all labels, of which ``share`` are toxic."""
    own = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    weight = np.where(y == 1, share / own, (1 - share) / (1 - own))
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        w = w + np.linalg.solve(hessian, gradient)
    return w


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, fit_bytes: int = FIT_BYTES) -> Field | None:
    """The field from about ``fit_docs`` labelled documents per class, each of at most ``fit_bytes``,
    chosen by a hash of their id. A document that is labelled twice is toxic if one label says so."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    share = F.when(F.col("toxic") == 1, F.lit(min(1.0, fit_docs / sizes[1]))).otherwise(
        F.lit(min(1.0, fit_docs / sizes[0])))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    # about 2 * fit_docs ids, whatever the size of the tables
    table = docs.select("doc_id", "text").filter(F.octet_length("text") <= fit_bytes).join(
        F.broadcast(chosen), "doc_id").select("text", "toxic").toArrow()
    toxic = table.column("toxic").to_numpy().astype(np.int64)
    if len(set(toxic.tolist())) < 2:
        return None
    parts = [features(data, offsets) for _, _, data, offsets in
             text_slices(table.column("text").combine_chunks())]
    sizes_of = np.concatenate([np.diff(part[3]) for part in parts])
    first = np.concatenate([[0], np.cumsum(sizes_of)])
    return train(np.concatenate([part[0] for part in parts], 1), first, toxic,
                 sizes[1] / sum(sizes.values()))


def _score(field: Field):
    def score(batches):
        for batch in batches:
            scores, spans = [], []
            for lo, hi, data, offsets in text_slices(batch.column("text"), TOGETHER):
                buckets, starts, ends, first = features(data, offsets)
                p, _, _ = marginals(emissions(field, buckets), first, field.moves)
                z = _sums(p, first) @ field.curve
                scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
                found = [[] for _ in range(hi - lo)]
                hot = np.flatnonzero(p >= 0.5)
                owner = np.searchsorted(first, hot, "right") - 1
                before = None
                for word, doc in zip(hot.tolist(), owner.tolist()):
                    begin, end = int(starts[word] - offsets[doc]), int(ends[word] - offsets[doc])
                    if before == (word - 1, doc):
                        found[doc][-1]["end"] = end
                    else:
                        found[doc].append({"start": begin, "end": end})
                    before = (word, doc)
                spans += found
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "score", "spans"])
    return score


def toxicity(docs: DataFrame, field: Field | None) -> DataFrame:
    """Per row: doc_id, score (0 to 1) and spans: byte offsets of runs of words that are likelier toxic.

    A null or empty text has no words and the score of none. Without labels of both classes all scores
    are 0. Rows are judged by their text alone, so repeated rows agree; an empty table gives no rows;
    other columns are not read.
    """
    schema = "doc_id long, score double, spans array<struct<start: long, end: long>>"
    if field is None:
        return docs.selectExpr("doc_id", "0D AS score", "CAST(array() AS array<struct<start: long, end: long>>) AS spans")
    return docs.select("doc_id", "text").mapInArrow(_score(field), schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold("doc_id", 3) != 1)
    return toxicity(docs, fit(docs, labels)).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), "spans")
