"""Phrase collocations from an FM-index per shard over word ids.

A shard is a bounded run of one language's pieces, as ids of its own words. Words are counted over all shards first;
those too rare to stand in any candidate become separators in the shards, so an index holds what can still matter.
An index has, for the text and for its reverse, the symbol before every suffix (the BWT), the suffixes being sorted
as deep as phrases are long. A phrase is a pair of intervals, one in each order. All phrases of a length are
extended at once: the symbols in a phrase's interval are counted, each is an extension to the left (in the text's
order) or to the right (in the reverse), and its intervals follow from the counts. Counts of all shards are summed. Longer
phrases are only counted where their parts can be frequent, by a table of bits that lets some others pass.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfledger.llm.common import mix, release, text_bytes, written
from shelfledger.session import stage

LEAST = 10
LONGEST = 3
SHARE = 50
TOP = 2000
#: Words of a shard, and of all shards that a task holds open; it bounds a worker's memory.
SHARD_WORDS, OPEN_WORDS = 1_500_000, 3_000_000
#: Bytes of text split at a time, n-grams of an output batch, and bits of the table of frequent pairs.
WINDOW, BATCH, BITS = 1 << 20, 1 << 16, 1 << 26
#: A key with more than this share of the weight is joined by broadcast; there are fewer of them.
HOT_SHARE = 4096

_SMALL = bytes(c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
_BREAK = re.compile(rb"[\t-\r .,;:!?]")


def words(text: bytes, window: int = WINDOW):
    """Lists of words, a window of text at a time; b"." stands between pieces."""
    at = 0
    while at < len(text):
        end = at + window
        if end < len(text):
            cut = _BREAK.search(text, end)
            end = cut.end() if cut else len(text)
        # split at blanks only: a word may hold any other byte
        yield [w for w in text[at:end].translate(_SMALL).replace(b".", b" . ").split(b" ") if w]
        at = end


def _pack(array: np.ndarray) -> bytes:
    """A non-empty array of 32-bit integers, compressed, after its length."""
    return len(array).to_bytes(8, "little") + pa.compress(array.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    return np.frombuffer(pa.decompress(packed[8:], 4 * n, "zstd", asbytes=True), "<i4")


class _Shard:
    def __init__(self, number: int, lang: str):
        self.number, self.lang, self.size, self.ids = number, lang, 0, []
        self.word: dict[bytes, int] = defaultdict(count().__next__)
        self.word[b"."]  # noqa: B018  the separator is 0

    def add(self, text: bytes, window: int) -> None:
        for found in words(text, window):
            self.ids.append(np.fromiter(map(self.word.__getitem__, found), np.int32, len(found)))
            self.size += len(found)
        self.ids.append(np.zeros(1, np.int32))

    def row(self) -> pa.RecordBatch:
        """A head row with the ids, then a row per word with its count."""
        ids = np.concatenate(self.ids)
        n, counts = len(self.word), np.bincount(ids, minlength=len(self.word))
        counts[0] = len(ids) - counts[0]  # the head's is the number of words
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, self.number)), pa.array([self.lang] * n), pa.array(np.arange(n)),
             pa.array([None, *list(self.word)[1:]], pa.binary()), pa.array(counts), pa.array([_pack(ids)] + [None] * (n - 1), pa.binary())],
            ["shard", "lang", "place", "word", "n", "ids"])


def _shards(shard_words: int, open_words: int, window: int):
    def cut(batches):
        """Shards are named by partition and number, so a repeated task repeats them."""
        part, number, held = TaskContext.get().partitionId(), count(), {}
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for lang, lo, hi in zip(batch.column("lang").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                if lang not in held:
                    held[lang] = _Shard((part << 32) + next(number), lang)
                held[lang].add(data[lo:hi].tobytes(), window)
                if held[lang].size >= shard_words:
                    yield held.pop(lang).row()
                elif sum(s.size for s in held.values()) > open_words:  # many languages at once
                    yield held.pop(max(held, key=lambda x: held[x].size)).row()
        while held:
            yield held.popitem()[1].row()
    return cut


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The places of a text by the ``depth`` symbols from there on, equal ones as they stand; it ends as in 0."""
    padded = np.concatenate([text, np.zeros(depth, text.dtype)])
    return np.lexsort([padded[k:k + len(text)] for k in reversed(range(depth))])


def build_index(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbol before each suffix, by suffix: of the text and of its reverse. The text starts and ends with 0."""
    back = text[::-1]
    return text[suffix_order(text, depth) - 1], back[suffix_order(back, depth) - 1]


def _extended(bwt: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All extensions of phrases by the symbols in their intervals of ``bwt``, separators left out: phrase, symbol, count,
    first place of the new interval in this order, and its distance from the phrase's in the other order."""
    lengths = hi - lo
    owner = np.repeat(np.arange(len(lo)), lengths)
    rows = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + lo[owner]
    step = np.empty(len(bwt), np.int64)  # where a suffix goes when its preceding symbol is put before it
    step[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    symbol = bwt[rows]
    order = np.argsort(owner * (int(symbol.max(initial=0)) + 1) + symbol, kind="stable")
    owner, symbol, rows = owner[order], symbol[order], rows[order]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])])) if len(owner) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(owner)))
    begin = (np.cumsum(lengths) - lengths)[owner[first]]
    kept = symbol[first] != 0
    at = first[kept]
    return owner[at], symbol[at], counts[kept], step[rows[at]], at - begin[kept]


def pairs(left: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """All phrases of two symbols: first, second, count, and where their interval starts in the reverse order. ``sizes``
    is how often each symbol stands in the text; both orders hold a symbol's suffixes at the same places."""
    hi = np.cumsum(sizes)
    lo = hi - sizes
    owner, symbol, n, _, shift = _extended(left, lo[1:], hi[1:])
    return symbol, owner + 1, n, lo[1:][owner] + shift


def triples(right: np.ndarray, first: np.ndarray, second: np.ndarray, n: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, ...]:
    """All phrases that go on from these pairs by one symbol to the right, and their counts."""
    owner, symbol, counts, _, _ = _extended(right, lo, lo + n)
    return first[owner], second[owner], symbol, counts


def _index(depth: int):
    """One shard: its head row and the frequent ones of its words."""
    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        place, gid = table.column("place").to_numpy(), table.column("gid").to_numpy()
        ids = _unpack(table.column("ids")[int(np.flatnonzero(place == 0)[0])].as_py())
        rank = np.argsort(gid, kind="stable")  # the head's gid is -1: its place stays 0
        new = np.zeros(int(max(ids.max(), place.max())) + 1, np.int32)
        new[place[rank]] = np.arange(len(rank))
        text = np.concatenate([[0], new[ids]]).astype(np.int32)
        text = np.append(text[np.concatenate([[True], (text[1:] != 0) | (text[:-1] != 0)])], np.int32(0))
        left, right = build_index(text, depth)
        row = [table.column("shard")[0].as_py(), gid[rank][1:].tolist(), np.bincount(text, minlength=len(rank)).tolist(), _pack(left), _pack(right)]
        return pa.table([[x] for x in row], schema=pa.schema([("shard", pa.int64()), ("gids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                                                              ("left", pa.binary()), ("right", pa.binary())]))
    return build


def _out(columns: list[np.ndarray], names: list[str]):
    for lo in range(0, len(columns[0]), BATCH):
        yield pa.RecordBatch.from_arrays([pa.array(c[lo:lo + BATCH].astype(np.int64)) for c in columns], names)


def _rows(batches):
    for batch in batches:
        for row in batch.to_pylist():
            gids, sizes = np.array([-1, *row["gids"]], np.int64), np.array(row["sizes"], np.int64)
            yield gids, sizes, row


def _count_pairs(batches):
    for gids, sizes, row in _rows(batches):
        first, second, n, _ = pairs(_unpack(row["left"]), sizes)
        yield from _out([gids[first], gids[second], n], ["g1", "g2", "n"])


def pair_bits(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (mix(mix(first.astype(np.uint64)) + second.astype(np.uint64)) % np.uint64(BITS)).astype(np.int64)


def _bits_of(batches):
    """The table's words that the pairs of a partition set: word, bits."""
    table = np.zeros(BITS // 64, np.uint64)
    for batch in batches:
        at = pair_bits(batch.column("g1").to_numpy(), batch.column("g2").to_numpy())
        np.bitwise_or.at(table, at // 64, np.uint64(1) << (at % 64).astype(np.uint64))
    used = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(table[used].view(np.int64))], ["word", "bits"])


def _count_triples(sieve):
    """Triples of which both pairs are in the table of bits."""
    def count_rows(batches):
        table = np.frombuffer(sieve.value, np.uint64)
        held = lambda a, b: (table[(at := pair_bits(a, b)) // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1
        for gids, sizes, row in _rows(batches):
            found = pairs(_unpack(row["left"]), sizes)
            can = held(gids[found[0]], gids[found[1]])
            a, b, c, n = triples(_unpack(row["right"]), *(x[can] for x in found))
            can = held(gids[b], gids[c])
            yield from _out([gids[x[can]] for x in (a, b, c)] + [n[can]], ["g1", "g2", "g3", "n"])
    return count_rows


def _sieve(found: DataFrame):
    """A broadcast table of BITS bits, whatever the number of pairs."""
    bits = np.zeros(BITS // 64, np.int64)
    rows = found.mapInArrow(_bits_of, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return found.sparkSession.sparkContext.broadcast(bits.tobytes())


def _with(facts: DataFrame, groups: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """Inner join to one row per key, whose ``weight`` bounds the key's facts. Keys above a share of the total are
    broadcast, being few; the others have few facts each."""
    most = max(64, total // HOT_SHARE)
    hot = groups.filter(F.col(weight) > most)
    return facts.join(F.broadcast(hot), on).unionByName(
        facts.join(F.broadcast(hot.select(on)), on, "left_anti").join(groups.filter(F.col(weight) <= most), on))


def _score(a: Column, l: Column, r: Column) -> Column:
    wide = lambda c: c.cast("decimal(19,0)")
    return F.floor(F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (wide(a) * wide(a)).cast("decimal(31,0)"),
                                   wide(l) * wide(r))).cast("long")


def _indexes(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The shards' indexes, the frequent words (lang, word, gid, f), words per language (lang, n), and words in all.

    A word's gid is the least row number of its rows, one for each shard that has it; only that row keeps the word."""
    texts = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    shards, drop = written(texts.mapInArrow(_shards(SHARD_WORDS, OPEN_WORDS, WINDOW),
                                            "shard long, lang string, place long, word binary, n long, ids binary"), "shards")
    sizes = stage(shards.filter("place = 0").groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    alike, first = Window.partitionBy("lang", "word"), F.col("gid") == F.col("row")
    own = stage(shards.filter("place > 0").select("shard", "place", "lang", "word", "n", F.monotonically_increasing_id().alias("row"))
                .withColumns({"f": F.sum("n").over(alike), "gid": F.min("row").over(alike)}).filter(F.col("f") >= least)
                .select("shard", "place", "gid", "f", *[F.when(first, F.col(c)).alias(c) for c in ("lang", "word")]), "words")
    release(docs.sparkSession)
    heads = shards.filter("place = 0").select("shard", "place", F.lit(-1).cast("long").alias("gid"), "ids")
    index = stage(heads.unionByName(own.select("shard", "place", "gid", F.lit(None).cast("binary").alias("ids"))).groupBy("shard").applyInArrow(
        _index(LONGEST - 1), "shard long, gids array<long>, sizes array<long>, left binary, right binary"), "index")
    drop()
    release(docs.sparkSession)
    return index, own.filter("word IS NOT NULL").select("lang", "word", "gid", "f"), sizes, total


def phrases(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """The first ``top`` collocations of two or three words per language: lang, rank, phrase, a, l, r, n, score.

    Capitals A-Z are small letters; pieces end at ``. , ; : ! ?`` and line ends, words at blanks and tabs. A phrase
    counts within a piece, a times; it is a candidate from ``least`` on. l and r are the counts of its parts at the cut of
    the lowest score 10^6 a a / (l r), floored; the first of equal ones. A candidate goes if it is part of a longer one that
    has at least ``share`` percent of its count. n is the number of words of the language. A null language is ``und``, a
    null text is empty; repeated rows count again; languages without a phrase give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    index, known, sizes, total = _indexes(docs, least)
    two = stage(index.select("gids", "sizes", "left").mapInArrow(_count_pairs, "g1 long, g2 long, n long").groupBy("g1", "g2").agg(
        F.sum("n").alias("a")).filter(F.col("a") >= least), "pairs")
    release(spark)
    sieve = _sieve(two)
    three = stage(index.mapInArrow(_count_triples(sieve), "g1 long, g2 long, g3 long, n long").groupBy("g1", "g2", "g3").agg(
        F.sum("n").alias("a")).filter(F.col("a") >= least), "triples")
    release(spark)
    word = lambda k: known.select(F.col("gid").alias(f"g{k}"), F.col("f").alias(f"f{k}"))
    pair = lambda x, y, name: two.select(F.col("g1").alias(x), F.col("g2").alias(y), F.col("a").alias(name))
    scored_two = _with(_with(two, word(1), ["g1"], "f1", total), word(2), ["g2"], "f2", total).withColumns(
        {"l": F.col("f1"), "r": F.col("f2"), "score": _score(F.col("a"), F.col("f1"), F.col("f2"))})
    longer = three.select("g1", "g2", "a").unionByName(three.select(F.col("g2").alias("g1"), F.col("g3").alias("g2"), "a")).groupBy(
        "g1", "g2").agg(F.max("a").alias("more"))
    kept_two = scored_two.join(longer, ["g1", "g2"], "left").filter(
        F.col("more").isNull() | (F.col("more") * 100 < F.col("a") * share)).select(
        "g1", "g2", F.lit(None).cast("long").alias("g3"), "a", "l", "r", "score")
    both = _with(_with(three, word(1), ["g1"], "f1", total), word(3), ["g3"], "f3", total)
    both = _with(_with(both, pair("g1", "g2", "f12"), ["g1", "g2"], "f12", total), pair("g2", "g3", "f23"), ["g2", "g3"], "f23", total)
    cuts = both.withColumns({"s1": _score(F.col("a"), F.col("f1"), F.col("f23")), "s2": _score(F.col("a"), F.col("f12"), F.col("f3"))})
    one = F.col("s1") <= F.col("s2")
    kept_three = cuts.select("g1", "g2", "g3", "a", F.when(one, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                             F.when(one, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    every = stage(kept_two.unionByName(kept_three), "phrases")
    lang_of = known.select(F.col("gid").alias("g1"), "lang", F.col("word").alias("w1"), "f")
    named = _with(every, lang_of, ["g1"], "f", total)
    # only what the ties of the last rank leave needs its words
    best = named.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc()))).filter(
        F.col("place") <= top)
    for k in (2, 3):
        text = known.select(F.col("gid").alias(f"g{k}"), F.col("word").alias(f"w{k}"))
        best = best.join(text, f"g{k}", "left")
    blank = F.lit(b" ")
    spelt = best.withColumn("bytes", F.when(F.col("g3").isNull(), F.concat("w1", blank, "w2")).otherwise(
        F.concat("w1", blank, "w2", blank, "w3")))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("bytes"))
    ranked = spelt.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), F.decode("bytes", "UTF-8").alias("phrase"),
                                             "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The query in DuckDB's SQL.
SQL = r"""
WITH pieces AS (
    SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)),
w AS (
    SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS p FROM pieces),
g AS (
    SELECT lang, w1, lead(w1) OVER s AS w2, lead(w1, 2) OVER s AS w3 FROM w WINDOW s AS (PARTITION BY lang, id ORDER BY p)),
f1 AS (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
three AS (
    SELECT t.lang, t.w1, t.w2, t.w3, t.f AS a, x.f AS l1, yz.f AS r1, xy.f AS l2, z.f AS r2,
        (1000000::HUGEINT * t.f * t.f) // (x.f::HUGEINT * yz.f) AS s1, (1000000::HUGEINT * t.f * t.f) // (xy.f::HUGEINT * z.f) AS s2
    FROM f3 AS t JOIN f1 AS x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f1 AS z ON z.lang = t.lang AND z.w1 = t.w3
    JOIN f2 AS xy ON xy.lang = t.lang AND xy.w1 = t.w1 AND xy.w2 = t.w2 JOIN f2 AS yz ON yz.lang = t.lang AND yz.w1 = t.w2 AND yz.w2 = t.w3
    WHERE t.f >= 10),
longer AS (
    SELECT lang, w1, w2, max(a) AS a FROM (SELECT lang, w1, w2, a FROM three UNION ALL SELECT lang, w2, w3, a FROM three) GROUP BY ALL),
scored AS (
    SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.f AS a, x.f AS l, y.f AS r, (1000000::HUGEINT * t.f * t.f) // (x.f::HUGEINT * y.f) AS score
    FROM f2 AS t JOIN f1 AS x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f1 AS y ON y.lang = t.lang AND y.w1 = t.w2
    LEFT JOIN longer AS o ON o.lang = t.lang AND o.w1 = t.w1 AND o.w2 = t.w2
    WHERE t.f >= 10 AND NOT coalesce(100 * o.a >= 50 * t.f, false)
    UNION ALL
    SELECT lang, w1 || ' ' || w2 || ' ' || w3, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
    FROM three)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank FROM scored)
JOIN total USING (lang) WHERE rank <= 2000
"""
