"""Language identification as a mixture: which languages does a document hold, and how much of each?

Every word has a likelihood under each language from its byte trigrams. Expectation-maximisation
estimates the document's proportions; the languages are then added in the order of these proportions
as long as the penalised likelihood (each language costs half a log word count) rises. The answer is the
language with the largest share in the chosen set.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import LOWER, PUNCTUATION, SPACE, fold, frugal, ragged, text_slices, word_bounds

BUCKETS = 1 << 18
#: Labelled documents per language, about, that the trigram tables are fitted on.
FIT_DOCS = 3_000
STEPS = 12
#: The share that a language must have in the first estimate to be tried at all.
LEAST_SHARE = 0.02
UNKNOWN = "und"


def _folded(data: np.ndarray) -> np.ndarray:
    """Small letters: ASCII, and the two-byte Latin letters next to it; separators become blanks."""
    low = LOWER[data]
    follows = np.concatenate([[False], data[:-1] == 0xC3])
    low[follows & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 0x20
    low[PUNCTUATION[data] | SPACE[data]] = 0x20
    return low


def word_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram bucket of every byte of a word (with the bytes beside it), first gram of every word,
    first word of every document. Words of ASCII digits alone tell nothing and are left out."""
    starts, ends, _ = word_bounds(data, offsets, PUNCTUATION)
    digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
    told = digits[ends] - digits[starts] < ends - starts
    starts, ends = starts[told], ends[told]
    word, place = ragged(ends - starts)
    at = starts[word] + place
    low = np.concatenate([[0x20], _folded(data), [0x20]]).astype(np.uint32)
    before = np.where(place == 0, 0x20, low[at])
    after = np.where(at + 1 == ends[word], 0x20, low[at + 2])
    gram = (before << 16) | (low[at + 1] << 8) | after
    bucket = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 18)).astype(np.int64)
    return bucket, np.cumsum(ends - starts) - (ends - starts), np.searchsorted(starts, offsets)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_p: np.ndarray  # float32, a row per language and a column per bucket


def _count_grams(batches):
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        lang = batch.column("lang")
        for value in pa.compute.unique(lang).to_pylist():
            text = batch.column("text").filter(pa.compute.equal(lang, value))
            for _, _, data, offsets in text_slices(text):
                counts = np.bincount(word_grams(data, offsets)[0], minlength=BUCKETS)
                total[value] = total.get(value, 0) + counts
    for value, counts in total.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([value] * len(used), pa.string()), pa.array(used), pa.array(counts[used])],
            ["lang", "bucket", "n"])


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS) -> Model | None:
    """Trigram tables of the labelled documents given, from about ``fit_docs`` per language, chosen by
    a hash of the text. What comes to the driver is bounded by languages and buckets."""
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, fit_docs / n))).otherwise(share)
    chosen = labelled.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share * (1 << 20))
    counts = chosen.mapInArrow(frugal(_count_grams), "lang string, bucket long, n long").groupBy(
        "lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(sizes)
    table = np.full((len(languages), BUCKETS), 0.5)
    row = np.array([languages.index(x) for x in counts.column("lang").to_pylist()], np.int64)
    np.add.at(table, (row, counts.column("bucket").to_numpy()), counts.column("n").to_numpy())
    return Model(languages, np.log(table / table.sum(1, keepdims=True)).astype(np.float32))


def _expect(p: np.ndarray, shares: np.ndarray, doc: np.ndarray, first: np.ndarray, steps: int = STEPS
            ) -> tuple[np.ndarray, np.ndarray]:
    """Shares after some steps of expectation-maximisation, and the documents' log likelihood."""
    size = np.bincount(doc, minlength=len(shares))[:, None]
    for _ in range(steps):
        q = p * shares[doc]
        q /= q.sum(1, keepdims=True)
        shares = np.add.reduceat(q, first, 0) / size
    return shares, np.add.reduceat(np.log((p * shares[doc]).sum(1)), first)


def mixtures(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: chosen language (-1 without a word), its share, and the shares of all languages
    in the chosen set."""
    n, languages = len(offsets) - 1, len(model.languages)
    best, score, chosen_shares = np.full(n, -1), np.zeros(n), np.zeros((n, languages))
    grams, first_gram, first_word = word_grams(data, offsets)
    words = np.diff(first_word)
    docs = np.flatnonzero(words)
    if not len(docs):
        return best, score, chosen_shares
    ll = np.stack([np.add.reduceat(table[grams], first_gram) for table in model.log_p], 1)
    top = ll.max(1, keepdims=True)
    p = np.maximum(np.exp(ll - top), 1e-30)
    words = words[docs]
    doc, first = np.repeat(np.arange(len(docs)), words), np.cumsum(words) - words
    start = np.full((len(docs), languages), 1 / languages)
    full, _ = _expect(p, start, doc, first)
    order = np.argsort(-full, 1, kind="stable")
    penalty = 0.5 * np.log(words + 1)
    # one language: the likelihood needs no estimate
    single = np.add.reduceat(np.log(p), first, 0)
    lead = single.argmax(1)
    value = single[np.arange(len(docs)), lead] - penalty
    shares = np.eye(languages)[lead]
    active = np.arange(len(docs))
    for k in range(2, languages + 1):
        active = active[full[active, order[active, k - 1]] >= LEAST_SHARE]
        if not len(active):
            break
        inside = np.zeros((len(active), languages))
        np.put_along_axis(inside, order[active, :k], 1 / k, 1)
        sizes = words[active]
        own, place = ragged(sizes)
        tried, likelihood = _expect(p[first[active][own] + place], inside, own, np.cumsum(sizes) - sizes)
        likelihood = likelihood - k * penalty[active]
        rises = likelihood > value[active]
        active = active[rises]
        value[active], shares[active] = likelihood[rises], tried[rises]
    best[docs] = shares.argmax(1)
    score[docs] = np.minimum(shares.max(1), full[np.arange(len(docs)), shares.argmax(1)])
    chosen_shares[docs] = shares
    return best, score, chosen_shares


def _predict(model: Model, columns: list[str]):
    def predict(batches):
        for batch in batches:
            text = batch.column("text")
            names, scores, mixed = [], [], []
            for lo, hi, data, offsets in text_slices(text):
                best, score, shares = mixtures(model, data, offsets)
                letter = np.concatenate([[0], np.cumsum(_letters(data))])
                plain = letter[offsets[1:]] > letter[offsets[:-1]]
                for i in range(hi - lo):
                    known = best[i] >= 0 and (plain[i] or any(map(str.isalpha, text[lo + i].as_py() or "")))
                    names.append(model.languages[best[i]] if known else UNKNOWN)
                    scores.append(min(1.0, float(score[i])) if known else 0.0)
                    mixed.append([{"lang": model.languages[k], "share": float(shares[i, k])}
                                  for k in np.flatnonzero(shares[i])] if known else [])
            kept = [batch.column(name) for name in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(mixed, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                [*columns, "lang_pred", "score", "mixture"])
    return predict


def _letters(data: np.ndarray) -> np.ndarray:
    return ((data | 0x20) >= 97) & ((data | 0x20) <= 122)


def identify(docs: DataFrame, model: Model | None, *more: str) -> DataFrame:
    """Per row: doc_id, the columns in ``more``, lang_pred, score and mixture (languages, shares).

    A null text, one without a letter, and every text when nothing was labelled are ``und`` with score
    0. Each row is judged by its text alone, so repeated rows agree; an empty table gives no rows.
    Columns that are not named are not read.
    """
    from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType
    columns = ["doc_id", *more]
    rows = docs.select(*dict.fromkeys(["doc_id", "text", *more]))
    mixture = ArrayType(StructType([StructField("lang", StringType()), StructField("share", DoubleType())]))
    if model is None:
        return rows.select(*columns, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.array().cast(mixture).alias("mixture"))
    schema = StructType([*rows.select(*columns).schema.fields, StructField("lang_pred", StringType()),
                         StructField("score", DoubleType()), StructField("mixture", mixture)])
    return rows.mapInArrow(frugal(_predict(model, columns)), schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.filter(fold("doc_id", 5) != 0))
    return identify(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "mixture")


def stage_languages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told, with all their columns; ``lang`` becomes the language that was told.

    Those without one go: a null or empty text, one without a letter, and, where no row is labelled, those are all
    there are to go, since nothing can be told then and ``lang`` stays as it was. Repeated rows, null ids and long
    texts are judged like any other; an empty table gives no rows; columns besides those of documents are not kept.
    """
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    model = fit(docs)
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}")).select(columns)
    found = identify(docs, model, *columns[1:])
    return found.filter(F.col("lang_pred") != UNKNOWN).select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")
