"""Removal of passages that occur more than once: every window of words whose sequence also starts elsewhere.

Each window is filed under its minimiser, the window's least hash of a few words, so equal windows are in
one file wherever they stand. A run of windows with one minimiser is a segment. Where all segments of a minimiser
are equal, and there are several, all their windows repeat. The distinct segments of the others are
the reference: each minimiser's shard gets a suffix automaton that counts how often every word
sequence occurs, and the segments are streamed through it; where the longest repeated suffix reaches
the window's length, the window repeats. Shards with very many distinct segments, as at the ends of a very common
passage, are not gathered: their windows are counted one by one, which adds up before it is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import frugal, run_hashes, tasks_of, text_slices, word_bounds, word_hashes
from shelfledger.session import stage

WINDOW = 35
#: Words of the minimiser; a window has WINDOW - GRAM + 1 of them to choose from.
GRAM = 8
#: Most distinct segments of a shard that an automaton is built for.
SHARD = 128
#: Rows of an output batch of cut segments.
ROWS = 4096
#: Stands for a null id in joins.
NO_ID = -(1 << 63)


def minimiser_runs(words: np.ndarray, first: np.ndarray, window: int = WINDOW, gram: int = GRAM
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimiser: its hash, the hash of the run's words, the document, the first
    window's place in the document and the number of windows. ``words`` are hashes of the words."""
    span = window - gram + 1
    lengths = np.diff(first)
    total = len(words)
    none = np.zeros(0, np.int64)
    if not len(lengths) or lengths.max() < window:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    starts = np.arange(total - gram + 1)
    grams = run_hashes(words, starts, starts + gram)
    # the least of `span` neighbours, leftmost on ties, from the least of powers of two
    least, at, width = grams, starts, 1
    while width * 2 <= span:
        left = least[:-width] <= least[width:]
        least, at = np.where(left, least[:-width], least[width:]), np.where(left, at[:-width], at[width:])
        width *= 2
    if width < span:
        shift = span - width
        left = least[:-shift] <= least[shift:]
        at = np.where(left, at[:-shift], at[shift:])
    owner = np.repeat(np.arange(len(lengths)), lengths)[:len(at)]
    window_at = np.arange(len(at))
    valid = window_at + window <= first[owner + 1]
    window_at, at, owner = window_at[valid], at[valid], owner[valid]
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    run = np.flatnonzero(new)
    count = np.diff(np.append(run, len(at)))
    begin = window_at[run]
    return (grams[at[run]], run_hashes(words, begin, begin + count + window - 1), owner[run],
            begin - first[owner[run]], count)


def _file(batches):
    for batch in batches:
        ids = batch.column("id").to_numpy()
        keys = batch.column("key").to_numpy()
        for lo, _, data, offsets in text_slices(batch.column("text")):
            starts, ends, first = word_bounds(data, offsets)
            minimiser, segment, doc, at, count = minimiser_runs(word_hashes(data, starts, ends), first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (minimiser.view(np.int64), segment.view(np.int64), ids[lo + doc], keys[lo + doc],
                                       at.astype(np.int32), count.astype(np.int32))],
                ["minimiser", "segment", "id", "key", "at", "windows"])


def _cut(window: int = WINDOW):
    """The words of reference segments, or of a crowded shard's segments the hashes of the windows."""
    def done(out):
        return pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
             pa.array(out[3], pa.binary()), pa.array(out[4], pa.int32()), pa.array(out[5], pa.int64())],
            ["minimiser", "segment", "n", "words", "bit", "window"])

    def cut(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for text, wanted in zip(batch.column("text"), batch.column("wanted")):
                words = text.as_py().encode().split()
                joined = b"".join(words)
                data = np.frombuffer(joined, np.uint8)
                ends = np.cumsum([len(w) for w in words])
                hashed = None
                for want in wanted.as_py():
                    begin, size = want["at"], want["windows"] + window - 1
                    if want["crowded"]:
                        if hashed is None:
                            hashed = word_hashes(data, np.concatenate([[0], ends[:-1]]), ends)
                        places = np.arange(want["windows"])
                        part = hashed[begin:begin + size]
                        found = run_hashes(part, places, places + window).view(np.int64).tolist()
                        rows = [(None, bit, value) for bit, value in enumerate(found)]
                    else:
                        rows = [(b" ".join(words[begin:begin + size]), None, None)]
                    for row in rows:
                        for column, value in zip(out, (want["minimiser"], want["segment"], want["n"], *row)):
                            column.append(value)
                    if len(out[0]) >= ROWS:
                        yield done(out)
                        out = [[], [], [], [], [], []]
            yield done(out)
    return cut


class SuffixAutomaton:
    """All word sequences of several texts, with how often each occurs in all of them."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, after: dict, link: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, word) -> int:
        copy = self._state(self.length[p] + 1, self.next[q].copy(), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word)
        here = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = here
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[here] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
        return here

    def add(self, words: list, times: int) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)
            self.count[last] += times

    def close(self) -> None:
        """Counts go to all shorter suffixes; then each state knows its longest suffix that repeats."""
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        for state in reversed(order):
            self.count[self.link[state]] += self.count[state]
        self.repeats = [0] * len(self.next)
        for state in order:
            self.repeats[state] = self.length[state] if self.count[state] > 1 else self.repeats[self.link[state]]

    def statistics(self, words: list) -> list[int]:
        """For each word of a text that was added: the length of the longest repeated sequence that ends there."""
        state, out = 0, []
        for k, word in enumerate(words, 1):
            state = self.next[state][word]
            out.append(min(k, self.repeats[state]))
        return out


def repeated_windows(texts: list[tuple[list, int]], window: int = WINDOW) -> list[int]:
    """Per text (words, how often it occurs): a bit for each of its windows that occurs more than once."""
    automaton = SuffixAutomaton()
    for words, times in texts:
        automaton.add(words, times)
    automaton.close()
    return [sum(1 << k for k, length in enumerate(automaton.statistics(words)[window - 1:]) if length >= window)
            for words, _ in texts]


def _match(batches):
    """Shards arrive sorted by minimiser; each is matched when the next begins."""
    held: list[tuple] = []

    def done():
        masks = repeated_windows([(row[2].split(b" "), row[3]) for row in held])
        found = [(row[0], row[1], mask) for row, mask in zip(held, masks) if mask]
        return pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int32()))],
            ["minimiser", "segment", "mask"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("minimiser", "segment", "words", "n"))):
            if held and held[0][0] != row[0]:
                yield done()
                held = []
            held.append(row)
    if held:
        yield done()


def repeats(docs: DataFrame, scale: int | None = None) -> DataFrame:
    """Per text, named by ``id`` and ``key``, that has repeated windows: ``runs`` with the first window's
    place and a bit for each of the windows from there that repeats. ``docs`` has id, key and text."""
    n = scale or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    filed = stage(docs.mapInArrow(
        frugal(_file), "minimiser long, segment long, id long, key long, at int, windows int"), "windows")
    kinds = filed.groupBy("minimiser").agg(
        F.count("*").alias("n"), F.min("segment").alias("lo"), F.max("segment").alias("hi")).filter("n > 1")
    several = stage(filed.join(kinds, "minimiser").withColumn("uniform", F.expr("lo = hi")).drop("n", "lo", "hi"),
                    "repeated")
    mixed = several.filter("NOT uniform").groupBy("minimiser", "segment").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("id", "key", "at", "windows")])
    mixed = stage(mixed, "segments")
    # written, so that the join deals both sides anew and can split a minimiser of very many segments
    crowded = stage(mixed.groupBy("minimiser").count().filter(F.col("count") > SHARD).select("minimiser"), "crowded", tasks=tasks_of(mixed))
    marked = mixed.join(crowded.withColumn("many", F.lit(True)), "minimiser", "left").withColumn(
        "crowded", F.coalesce("many", F.lit(False)))
    wanted = marked.groupBy("id", "key").agg(F.collect_list(
        F.struct("minimiser", "segment", "n", "at", "windows", "crowded")).alias("wanted"))
    parts = stage(docs.join(wanted, ["id", "key"]).dropDuplicates(["id", "key"]).select("text", "wanted").mapInArrow(
        frugal(_cut()), "minimiser long, segment long, n long, words binary, bit int, window long"), "reference")
    shards = parts.filter("words IS NOT NULL").select("minimiser", "segment", "n", "words")
    matched = shards.repartition(n, "minimiser").sortWithinPartitions("minimiser").mapInArrow(
        frugal(_match), "minimiser long, segment long, mask int")
    windows = parts.filter("words IS NULL").select("minimiser", "segment", "n", "bit", "window")
    twice = windows.groupBy("minimiser", "window").agg(F.sum("n").alias("times")).filter("times > 1")
    counted = windows.join(twice, ["minimiser", "window"]).groupBy("minimiser", "segment").agg(
        F.bit_or(F.expr("shiftleft(1, bit)")).alias("mask"))
    masks = matched.unionByName(counted)
    runs = several.filter("NOT uniform").join(masks, ["minimiser", "segment"]).select("id", "key", "at", "mask")
    whole = several.filter("uniform").select("id", "key", "at", F.expr(
        "CAST(shiftleft(1L, windows) - 1 AS int)").alias("mask"))
    return runs.unionByName(whole).groupBy("id", "key").agg(F.collect_list(F.struct("at", "mask")).alias("runs"))


def _remove(columns: list[str], window: int = WINDOW):
    def remove(batches):
        for batch in batches:
            kept_text, n_words, n_removed = [], [], []
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                words = (text.as_py() or "").encode().split()
                runs = runs.as_py()
                if runs:
                    cover = np.zeros(len(words) + 1, np.int64)
                    for run in runs:
                        for bit in range(run["mask"].bit_length()):
                            if run["mask"] >> bit & 1:
                                cover[run["at"] + bit] += 1
                                cover[run["at"] + bit + window] -= 1
                    stays = np.cumsum(cover[:-1]) == 0
                    kept = [w for w, stay in zip(words, stays) if stay]
                else:
                    kept = words
                kept_text.append(b" ".join(kept).decode())
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(kept_text, pa.string()),
                 pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                [*columns, "kept_text", "n_words", "n_removed"])
    return remove


def remove_repeats(docs: DataFrame, *more: str) -> DataFrame:
    """Per row: doc_id, the columns in ``more``, kept_text (kept words joined by blanks), n_words, n_removed.

    Words are runs of bytes other than ASCII white space. Every copy of a repeated window goes, the first
    too; rows that repeat an id and text count as copies of each other. A null text is empty; a text of
    fewer words than a window stays whole; null ids are kept; an empty table gives no rows; columns
    that are not named are not read.
    """
    columns = ["doc_id", *more]
    named = docs.select(*dict.fromkeys(["doc_id", "text", *more])).withColumns({
        "id": F.coalesce("doc_id", F.lit(NO_ID)), "key": F.xxhash64(F.coalesce("text", F.lit("")))})
    found = repeats(named.select("id", "key", F.coalesce("text", F.lit("")).alias("text")))
    out = named.join(found, ["id", "key"], "left").select(*dict.fromkeys(["text", *columns]), "runs")
    schema = out.select(*columns).schema.add("kept_text", "string").add("n_words", "long").add("n_removed", "long")
    return out.mapInArrow(frugal(_remove(columns)), schema)


def query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT doc_id, b, array_to_string(w[b:b + 34], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS b FROM words)),
repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(b, b + 35)) AS place FROM windows WHERE s IN (FROM repeated)),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words)
    ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


def stage_substrings(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated passages; a text that loses nothing stays as it was, a null one too.

    All rows stay, those that lose every word with an empty text; of repeated rows each loses what they share. Null ids are kept;
    an empty table gives no rows; columns besides those of documents are not kept."""
    kept = remove_repeats(docs, "text", "lang", "source", "n_chars")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return kept.select("doc_id", text.alias("text"), "lang", "source", F.when(
        F.col("n_removed") > 0, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))
