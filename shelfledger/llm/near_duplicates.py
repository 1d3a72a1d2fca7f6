"""Near duplicates by ProbMinHash sketches of weighted word shingles, banding and verification.

A shingle's weight is how often a text has it. Its arrivals are a Poisson process with that rate, each
falling on a random register; a register keeps its earliest arrival. A shingle stops as soon as its
next arrival is later than all registers. Two registers agree with the probability Jaccard of the
texts. Equal texts are one. Texts that agree in a band are in one bucket, where each meets the bucket's
first; what meets is compared exactly, and the links are closed to classes. To begin with a text meets only
one of these firsts, which is enough for most; then, where a bucket still holds several classes, its texts are
compared across them: pair by pair if they are few, and what larger buckets hold is compared in full, block by block. So
every pair of texts that agrees in a band is either of one class or compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import frugal, mix, powers, ragged, run_hashes, tasks_of, text_bytes, text_slices, word_bounds, word_hashes
from shelfledger.llm.components import components
from shelfledger.operators.skew import join_counted
from shelfledger.session import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: Texts of a bucket that are all compared with each other, where they are not of one class yet.
FEW = 32
#: Texts and bytes that a block of a large bucket aims at; a longer text is a block of its own.
BLOCK, BLOCK_BYTES = 2048, 2 << 20
#: Shingles of two blocks that one matrix product covers, and pairs that rarer shingles make at a time. A shingle goes
#: into the product where it makes more than one in SPARSE of the pairs.
COLUMNS, PAIRS, SPARSE = 1 << 9, 1 << 20, 128
#: Most longs of the table of bits that keeps texts from being shuffled needlessly.
SIEVE = 1 << 20
#: Stands for a null id in joins.
NO_ID = -(1 << 63)
#: What finds the row that stands for a text.
KEY = ["id", "text_key"]
#: A class with more than one in HOT_SHARE of the texts is joined by broadcast; there can't be more of them.
HOT_SHARE = 4096


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of a slice: document, hash, and how often the document has it, by document. A text of fewer words
    is one shingle; one without words has none."""
    starts, ends, first = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    lengths = np.diff(first)
    counts = np.where(lengths == 0, 0, np.maximum(lengths - size + 1, 1))
    doc, place = ragged(counts)
    begin = first[doc] + place
    end = np.minimum(begin + size, first[doc + 1])
    hashed = run_hashes(words, begin, end)
    order = np.lexsort((hashed, doc))
    doc, hashed = doc[order], hashed[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashed[1:] != hashed[:-1])
    at = np.flatnonzero(new)
    return doc[at], hashed[at], np.diff(np.append(at, len(doc)))


def sketch(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int,
           registers: int = REGISTERS) -> np.ndarray:
    """A row of registers per document: the element of the earliest arrival (0 in a document of none)."""
    earliest = np.full(docs * registers, np.inf)
    kept = np.zeros(docs * registers, np.uint64)
    time, turn = np.zeros(len(doc)), 0
    while len(doc):
        turn += 1
        drawn = mix(element + np.uint64((turn * 0xD6E8FEB86659FD93) & ((1 << 64) - 1)))
        time = time - np.log(((drawn >> np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0 ** -53) / weight
        slot = doc * registers + (mix(drawn) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, slot, time)
        won = earliest[slot] == time
        kept[slot[won]] = element[won]
        latest = earliest.reshape(docs, registers).max(1)
        going = time < latest[doc]
        doc, element, weight, time = doc[going], element[going], weight[going], time[going]
    return kept.reshape(docs, registers)


def band_hashes(sketches: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A hash per document and band; the band is part of it."""
    rows = sketches.shape[1] // bands
    up, _ = powers(rows + 1)
    parts = sketches.reshape(len(sketches), bands, rows)
    return mix((parts * up[1:rows + 1]).sum(2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)


def _sketch_rows(batches):
    for batch in batches:
        bands, (_, begin) = [], text_bytes(batch.column("text"))
        for lo, hi, data, offsets in text_slices(batch.column("text")):
            doc, element, weight = shingles(data, offsets)
            own = band_hashes(sketch(doc, element, weight, hi - lo))
            none = np.bincount(doc, minlength=hi - lo) == 0
            bands += [None if empty else row for row, empty in zip(own, none)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(bands, pa.list_(pa.int64())),
             pa.array(np.diff(begin))], ["doc_id", "text_key", "bands", "bytes"])


def probability_jaccard(a: np.ndarray, a_weight: np.ndarray, b: np.ndarray, b_weight: np.ndarray) -> float:
    """Sum over common elements of 1 / sum over all elements of the larger ratio of weights. Elements are
    distinct and sorted. Common elements with the same two weights have the same term."""
    common, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    every = np.union1d(a, b)
    wa, wb = np.zeros(len(every)), np.zeros(len(every))
    wa[np.searchsorted(every, a)], wb[np.searchsorted(every, b)] = a_weight, b_weight
    pairs, counts = np.unique(np.stack([a_weight[in_a], b_weight[in_b]]), axis=1, return_counts=True)
    kinds, size = np.unique(np.stack([wa, wb]), axis=1, return_counts=True)
    ratio = np.maximum(kinds[0][:, None] / pairs[0], kinds[1][:, None] / pairs[1])
    return float((counts / (ratio * size[:, None]).sum(0)).sum())


def _distinct(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), np.uint8)
    _, element, weight = shingles(data, np.array([0, len(data)]))
    return element, weight


def _compare(batches):
    for batch in batches:
        similar, last, left = [], None, None
        for a, b in zip(batch.column("a_text"), batch.column("b_text")):
            a, b = a.as_py() or "", b.as_py() or ""
            if last is None or a != last:
                last, left = a, _distinct(a)
            similar.append(probability_jaccard(*left, *_distinct(b)))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(similar, pa.float64())],
                                         ["a", "b", "similarity"])


def _sieved(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows with these keys and some others, so that the join that follows shuffles few texts.

    Keys set bits of a table of at most SIEVE longs, which is all that is broadcast.
    """
    words = min(SIEVE, 1 << max(10, wanted.count().bit_length()))
    hashed = F.xxhash64(*KEY)
    word, bit = F.pmod(hashed, F.lit(words)), F.pmod(F.shiftright(hashed, 32), F.lit(64)).cast("int")
    bits = wanted.groupBy(word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    return rows.withColumns({"word": word, "bit": bit}).join(F.broadcast(bits), "word").filter(
        F.call_function("getbit", "bits", "bit") == 1).drop("word", "bit", "bits")


def _once(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """KEY and text of these keys (and some others), each once however often the row is repeated."""
    return _sieved(rows.select(*KEY, "text"), wanted).groupBy(*KEY).agg(F.max("text").alias("text"))


def verify(rows: DataFrame, texts: DataFrame, pairs: DataFrame, least: float = SIMILARITY,
           tasks: int | None = None) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are at least so similar, with their similarity.

    ``texts`` names the row (KEY) that stands for a node; ``tasks`` is the most tasks that write what is needed."""
    needs = pairs.select(F.col("a").alias("node"), "a", "b").unionByName(
        pairs.select(F.col("b").alias("node"), "a", "b"))
    keyed = stage(needs.join(texts.select("node", *KEY), "node"), "needs", tasks=tasks)
    both = keyed.join(_once(rows, keyed), KEY).groupBy("a", "b").agg(
        F.max(F.when(F.col("node") == F.col("a"), F.col("text"))).alias("a_text"),
        F.max(F.when(F.col("node") == F.col("b"), F.col("text"))).alias("b_text"))
    return both.mapInArrow(frugal(_compare), "a long, b long, similarity double").filter(F.col("similarity") >= least)


def _meetings(buckets: DataFrame, once: bool = False) -> DataFrame:
    """Pairs of every text of a bucket with the bucket's first by ``place``, or with ``once`` only with the
    first of all firsts that the text meets; fewer rows than texts, whatever the size of the bucket."""
    ends = buckets.groupBy("band").agg(F.min("place").alias("first"))
    met = buckets.join(ends, "band").filter("node != first.node")
    if once:
        met = met.groupBy("node").agg(F.min("first").alias("first"))
    return met.select(F.least("node", "first.node").alias("a"),
                      F.greatest("node", "first.node").alias("b")).distinct()


def _open(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """The texts of buckets that hold several classes, each with its class and the size n of the bucket."""
    held = buckets.join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    sizes = held.groupBy("band").agg(F.count("*").alias("n"), F.min("component").alias("lo"),
                                     F.max("component").alias("hi")).filter("lo < hi").select("band", "n")
    return held.join(sizes, "band")


def _pairs_of_few(inside: DataFrame) -> DataFrame:
    """All pairs of texts of different classes in buckets of at most FEW texts."""
    members = inside.groupBy("band").agg(F.collect_list(F.struct("node", "component")).alias("m"))
    pairs = F.flatten(F.transform("m", lambda x: F.transform(
        F.filter("m", lambda y: (x["node"] < y["node"]) & (x["component"] != y["component"])),
        lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))))
    return members.select(F.explode(pairs).alias("p")).select("p.a", "p.b").distinct()


def _groups_of_blocks(inside: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts (band, node, component, bytes) with the group and block they are dealt to, and the groups with
    their number of blocks. A class that fills a block has a group of its own in a bucket; the others share one."""
    key = ["band", "own", "kind"]
    sizes = inside.groupBy("band", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).withColumns(
        {"own": F.col("n") >= BLOCK, "kind": F.when(F.col("n") >= BLOCK, F.col("component")).otherwise(F.lit(0))})
    groups = sizes.groupBy(*key).agg(F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).alias("parts"))
    dealt = inside.join(sizes.select("band", "component", "own", "kind"), ["band", "component"]).join(groups, key).withColumn(
        "block", F.pmod(F.xxhash64("node"), "parts")).drop("parts")
    return dealt, groups


def _tasks(groups: DataFrame) -> DataFrame:
    """Pairs of blocks of a bucket that can hold texts of different classes, numbered."""
    a, b = (F.struct("own", "kind", "parts").alias(x) for x in "ab")
    pairs = groups.select("band", a).join(groups.select("band", b), "band").filter("a < b OR a = b AND NOT a.own")
    blocks = lambda x: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{x}.parts") - 1)).alias(f"{x}_block")
    both = pairs.select("*", blocks("a")).select("*", blocks("b")).filter("a < b OR a_block <= b_block")
    return both.withColumn("task", F.monotonically_increasing_id())


def _joint_shares(left: list[np.ndarray], right: list[np.ndarray], shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of texts of two blocks of shingles (document, element, weight), the share of either text's weight that
    lies in common elements. Elements of many texts are summed by a matrix product, the others pair by pair."""
    common = np.intersect1d(left[1], right[1])

    def rows(side, docs):
        at = np.minimum(np.searchsorted(common, side[1]), max(len(common) - 1, 0))
        hit = common[at] == side[1] if len(common) else np.zeros(len(at), bool)
        total = np.bincount(side[0], side[2], docs)
        doc, at, part = side[0][hit], at[hit], side[2][hit] / total[side[0][hit]]
        order = np.argsort(at, kind="stable")
        return doc[order], at[order], part[order]
    held = [rows(side, docs) for side, docs in zip((left, right), shape)]
    counts = [np.bincount(at, minlength=len(common)) for _, at, _ in held]
    many = counts[0] * counts[1] * SPARSE > shape[0] * shape[1]
    p, q = np.zeros(shape), np.zeros(shape)
    column = np.cumsum(many) - 1
    for lo in range(0, int(many.sum()), COLUMNS):
        width = min(COLUMNS, int(many.sum()) - lo)
        share = []
        for (doc, at, part), docs in zip(held, shape):
            own = many[at] & (column[at] >= lo) & (column[at] < lo + width)
            share.append(np.zeros((docs, width)))
            share[-1][doc[own], column[at[own]] - lo] = part[own]
        p += share[0] @ (share[1] > 0).T
        q += (share[0] > 0).astype(float) @ share[1].T
    (doc_a, at_a, part_a), (doc_b, at_b, part_b) = ([x[~many[side[1]]] for x in side] for side in held)
    n_b = np.bincount(at_b, minlength=len(common))
    first_b, fan = np.cumsum(n_b) - n_b, n_b[at_a]
    ends = np.cumsum(fan)
    lo = 0
    while lo < len(at_a):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS, "right")))
        owner, place = ragged(fan[lo:hi])
        a, b = lo + owner, first_b[at_a[lo:hi]][owner] + place
        pair = doc_a[a] * shape[1] + doc_b[b]
        for total, part in ((p, part_a[a]), (q, part_b[b])):
            total += np.bincount(pair, part, shape[0] * shape[1]).reshape(shape)
        lo = hi
    return p, q


def _similar(left: list[np.ndarray], right: list[np.ndarray], asked: np.ndarray, kinds: list[np.ndarray], least: float
             ) -> list[tuple[int, int, float]]:
    """Of the asked pairs of two blocks of shingles (document, element, weight; by document) that are at least so
    similar, as many as connect the classes (``kinds``) that all of them connect, with their similarity.

    With the shares p and q of two texts that lie in common elements, the similarity is at most
    pq / (p + q - pq), and just that where all weights are 1; only pairs that reach ``least`` by it are compared."""
    p, q = _joint_shares(left, right, asked.shape)
    most = p * q / np.maximum(p + q - p * q, 1e-300)
    cut = [np.searchsorted(side[0], np.arange(docs + 1)) for side, docs in zip((left, right), asked.shape)]
    one = lambda side, k, x: (side[1][cut[k][x]:cut[k][x + 1]], side[2][cut[k][x]:cut[k][x + 1]])
    x, y = np.nonzero(asked & (most >= least - 1e-9))
    order = np.argsort(-most[x, y], kind="stable")
    parent: dict[int, int] = {}

    def root(k: int) -> int:
        while (up := parent.setdefault(k, k)) != k:
            parent[k] = k = parent[up]
        return k
    found = []
    for a, b in zip(x[order].tolist(), y[order].tolist()):
        u, v = root(int(kinds[0][a])), root(int(kinds[1][b]))
        if u != v:
            similarity = probability_jaccard(*one(left, 0, a), *one(right, 1, b))
            if similarity >= least:
                parent[max(u, v)] = min(u, v)
                found.append((a, b, similarity))
    return found


def _compare_blocks(least: float):
    """Links between the two blocks of a task, or within its one block. A pair is compared in the first bucket that it shares."""
    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        parts = [table.filter(pa.array(side == k)) for k in (0, 1)]
        if not len(parts[1]):
            parts[1] = parts[0]
        ids, kinds, bands, blocks = [], [], [], []
        for part in parts:
            part = part.combine_chunks()
            ids.append(part.column("node").to_numpy())
            kinds.append(part.column("component").to_numpy())
            bands.append(pa.concat_arrays(part.column("bands").chunks).flatten().to_numpy().reshape(len(part), BANDS)
                         if len(part) else np.zeros((0, BANDS), np.int64))
            blocks.append(shingles(*text_bytes(pa.concat_arrays(part.column("text").chunks)))
                          if len(part) else [np.zeros(0, np.int64)] * 3)
        asked = kinds[0][:, None] != kinds[1][None, :]
        if parts[0] is parts[1]:
            asked &= ids[0][:, None] < ids[1][None, :]
        band = table.column("band")[0].as_py()
        shared = np.zeros(asked.shape, bool)  # a band before this one
        for k in range(BANDS):
            here = bands[0][:, k] == band, bands[1][:, k] == band
            equal = bands[0][:, k, None] == bands[1][None, :, k]
            asked &= ~(here[0][:, None] & here[1][None, :] & shared)
            shared |= equal
        asked &= (bands[0] == band).any(1)[:, None] & (bands[1] == band).any(1)[None, :]
        found = _similar(blocks[0], blocks[1], asked, kinds, least) if asked.any() else []
        x, y = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
        return pa.table({"a": ids[0][x], "b": ids[1][y], "a_class": kinds[0][x], "b_class": kinds[1][y],
                         "similarity": pa.array([f[2] for f in found], pa.float64())})
    return compare


def _links_of_many(rows: DataFrame, inside: DataFrame, texts: DataFrame, least: float = SIMILARITY,
                   most: int | None = None) -> DataFrame:
    """Links (a, b, a_class, b_class, similarity) between different classes of these buckets, enough to connect
    all classes that links connect.

    The texts of a bucket are dealt into blocks and every pair of blocks is a task, so the size of a
    bucket decides how many tasks there are and not how large one is; no row is made per pair. ``most`` is the most
    tasks that write a table of numbers.
    """
    dealt, groups = (stage(x, "blocks", tasks=most) for x in _groups_of_blocks(inside))
    tasks = stage(_tasks(groups), "tasks", tasks=most)
    sides = [tasks.select("task", "band", f"{x}.own", f"{x}.kind", F.col(f"{x}_block").alias("block"), F.lit(k).alias("side"))
             for k, x in ((0, "a"), (1, "b"))]
    alone = F.expr("a = b AND a_block = b_block")
    sides[1] = sides[1].join(tasks.filter(alone).select("task"), "task", "left_anti")
    needs = sides[0].unionByName(sides[1]).join(dealt, ["band", "own", "kind", "block"]).select(
        "task", "band", "side", "node", "component")
    keyed = stage(texts.join(dealt.select("node").distinct(), "node").select("node", *KEY, "bands"), "needs", tasks=most)
    with_bands = _once(rows, keyed).join(keyed, KEY).select("node", "text", "bands")
    return needs.join(with_bands, "node").groupBy("task").applyInArrow(
        _compare_blocks(least), "a long, b long, a_class long, b_class long, similarity double")


def _merged(found: DataFrame, links: DataFrame, tasks: int | None = None) -> DataFrame:
    """The classes after further links (a, b, a_class, b_class): only the classes they join are closed anew."""
    joined = components(links.select(F.col("a_class").alias("u"), F.col("b_class").alias("v")), tasks).toDF("component", "new")
    alone = joined.select(F.col("component").alias("node"), "component").join(
        found.select(F.col("component")).distinct(), "component", "left_anti")
    every = found.unionByName(alone.select("node", "component"))
    return every.join(joined, "component", "left").select("node", F.coalesce("new", "component").alias("component"))


def _classified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, text_key) and the distinct texts: text_key, the least id of the class, and the row (id, text_key)
    that stands for it."""
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.unhex(F.md5("text")))
    sketched = stage(rows.select("doc_id", "text_key", "text").mapInArrow(
        frugal(_sketch_rows), "doc_id long, text_key binary, bands array<long>, bytes long"), "sketches")
    # what follows holds no texts: few tasks write it, whatever the number of shuffle partitions
    few = tasks_of(sketched)
    # a text is a node of the graph, whatever ids its rows have; the number is fixed by writing it
    texts = stage(sketched.groupBy("text_key").agg(
        F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"), F.first("bytes").alias("bytes")).withColumns(
        {"id": F.coalesce("doc_id", F.lit(NO_ID)), "node": F.monotonically_increasing_id()}), "texts", tasks=few)
    banded = texts.select("node", "bytes", F.explode(F.array_distinct("bands")).alias("band"))
    crowded = banded.groupBy("band").count().filter("count > 1").select("band")
    buckets = stage(banded.join(crowded, "band"), "buckets", tasks=few)
    place = lambda salt: F.struct(F.xxhash64("node", F.lit(salt)).alias("h"), "node")
    tested = stage(_meetings(buckets.withColumn("place", place(0)), once=True), "pairs", tasks=few)
    links = stage(verify(rows, texts, tested, tasks=few), "links").select(F.col("a").alias("u"), F.col("b").alias("v"))
    found = stage(components(links, few), "classes", tasks=few)
    inside = stage(_open(buckets, found), "buckets", tasks=few)
    apart = _pairs_of_few(inside.filter(F.col("n") <= FEW)).join(found.toDF("a", "a_class"), "a", "left").join(
        found.toDF("b", "b_class"), "b", "left").withColumns(
        {"a_class": F.coalesce("a_class", "a"), "b_class": F.coalesce("b_class", "b")}).filter("a_class != b_class")
    apart = stage(apart.distinct().join(tested, ["a", "b"], "left_anti"), "pairs", tasks=few)
    new = stage(verify(rows, texts, apart.select("a", "b"), tasks=few).join(apart, ["a", "b"]), "links")
    if not new.isEmpty():
        found = stage(_merged(found, new, few), "classes", tasks=few)
    # what buckets of more texts still hold of several classes
    inside = stage(_open(inside.filter(F.col("n") > FEW).select("node", "bytes", "band"), found), "buckets", tasks=few)
    if not inside.isEmpty():
        left = stage(_links_of_many(rows, inside, texts, most=few), "links")
        found = stage(_merged(found, left, few), "classes", tasks=few)
    # what the texts of one class have in common
    members = stage(texts.select("node", "doc_id", *KEY).join(found, "node").withColumn(
        "component", F.col("component").cast("string")), "classes", tasks=few)
    own = F.struct(F.col("doc_id").isNull().alias("none"), *KEY)
    named = members.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.min(own).alias("first"), F.count("*").alias("n"))
    named = join_counted(members.select("component", "node", "text_key"), named, "component", "n", ["node"],
                         max(1, members.count() // HOT_SHARE))
    of_text = named.select("text_key", "class_id", "first.id", F.col("first.text_key").alias("class_key")).unionByName(
        texts.join(found, "node", "left_anti").select("text_key", F.col("doc_id").alias("class_id"), "id",
                                                      F.col("text_key").alias("class_key")))
    return sketched.select("doc_id", "text_key"), stage(of_text, "classes", tasks=few)


def classes(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_key (a digest of the text), class_id, the least id of its class of near
    duplicates, and class_key, the digest of the text that stands for the class.

    Equal texts are of one class, null being empty. A text without words is like its copies alone; one of up
    to five words is one shingle. Texts are linked whatever ids they have: a row without an id gets the class of its
    text, whose id is null only if no row of the class has one. Texts under one id are classes of their own unless they
    are similar; then class_key tells classes with one class_id apart. Other columns are not read; an empty table gives no rows.
    """
    rows, of_text = _classified(docs)
    return rows.join(of_text, "text_key").select("doc_id", "text_key", "class_id", "class_key")


def query(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id")


def stage_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id, of every class, once. One without an id stays only where its class has no other; of
    several with that id or without one the least text digest decides."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    _, of_text = _classified(docs)
    first = of_text.select("id", F.col("class_key").alias("text_key")).distinct()
    keyed = docs.select(*columns, F.coalesce("doc_id", F.lit(NO_ID)).alias("id"),
                        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key"))
    return keyed.join(first, KEY, "left_semi").dropDuplicates(KEY).select(columns)
