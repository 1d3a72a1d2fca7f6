"""The prefix trie of conversations by hashing blocks of turns.

A conversation is cut into blocks of a fixed number of turns. A block's digest joins those of its turns, each
with its depth, and the digests of all blocks up to one name the whole prefix that ends there. Conversations are
grouped by these names, block after block; a prefix of which all continuations are one block needs no more:
each turn of it is a node with the block's members. Only where a prefix goes on in several blocks are the distinct
blocks, not the conversations, taken apart into turns and grouped again at every turn.

A node is named by its smallest member and its depth: the members of a node hold those of the nodes below it, so
the nodes with one smallest member are a chain, the end of that conversation's path. What is summed over a subtree
is then the node's own chain from it on, and whole chains that leave the path below it; each chain is added once
to every node above it, and the sums combine before they are shuffled.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfledger.llm.common import running
from shelfledger.operators.skew import join_counted
from shelfledger.session import stage

#: Turns of a block.
BLOCK = 4
#: A key with more than this share of the rows is joined by broadcast; there can be no more such keys than that.
HOT_SHARE = 4096
#: Ids that are joined to one piece of text before it is hashed.
ENDS = 1 << 14
#: Most turns that the query takes over from another conversation.
BORROWED = 8
ROOT = "0-0"


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, digest, n_bytes) of every turn, depth from 1 by turn, null first.

    Null role and text are empty. Rows with the same turn are ordered by the SHA-256 of role and text; repeated
    rows are turns of their own. A null conv_id names no conversation; its rows give nothing.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    return running(rows, "conv_id", order, {"depth": ("sum", F.lit(1).cast("long"))}).select("conv_id", "depth", "digest", "n_bytes")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations in which the first h turns are those of conversation c - c % 5, with h = crc32(c) % 9, and
    their ids. ``%`` has the sign of c, as in SQL."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (BORROWED + 1)
    lengths = own.groupBy("conv_id").agg(F.max("depth").alias("length"))
    convs = lengths.select("conv_id", "length", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    lent = own.filter(F.col("depth") <= BORROWED).withColumnRenamed("conv_id", "base")
    taken = convs.select("conv_id", "h", "base").join(lent, "base").filter("depth <= h")
    short = convs.select("conv_id", "length", "h", "base").join(
        lengths.toDF("base", "base_length"), "base", "left").select(
        F.col("conv_id").cast("string").alias("id"), "length",
        (F.least("h", F.coalesce("base_length", F.lit(0))) - F.col("h")).alias("shift")).filter("shift < 0 AND length > 0")
    rest = join_counted(own.filter(F.col("depth") > h).withColumn("id", F.col("conv_id").cast("string")), short, "id", "length",
                        ["conv_id", "depth"], _hot(own))
    kept = rest.select("conv_id", (F.col("depth") + F.coalesce("shift", F.lit(0))).alias("depth"), "digest", "n_bytes")
    return taken.select("conv_id", "depth", "digest", "n_bytes").unionByName(kept), convs.select("conv_id")


def _hot(rows: DataFrame) -> int:
    return max(64, rows.count() // HOT_SHARE)


def _key(a: Column, b: Column) -> Column:
    return F.concat(F.hex(a), F.lit("-"), F.hex(b))


def _prefixes() -> Column:
    """For each turn of a block: depth, n_bytes, the key of the prefix that ends there, and of the one before."""
    upto = lambda lane, n: F.aggregate(F.slice("turns", 1, n), F.col(f"start_{lane}"), lambda x, t: x.bitwiseXOR(t[lane]))
    return F.transform("turns", lambda t, i: F.struct(
        t["depth"].alias("depth"), t["n_bytes"].alias("n_bytes"), _key(upto("a", i + 1), upto("b", i + 1)).alias("key"),
        _key(upto("a", i), upto("b", i)).alias("parent")))


def blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, block, turns, start_a, start_b, end_a, end_b): blocks with the name of the prefix before and with them."""
    lane = lambda n: F.xxhash64(F.lit(n), "depth", "digest")  # noqa: E731  digests are SHA-256, so two lanes are 128 even bits
    number = F.floor((F.col("depth") - 1) / BLOCK)
    turn = F.struct("depth", "a", "b", "n_bytes")
    cut = rows.withColumns({"a": lane(1), "b": lane(2), "block": number}).groupBy("conv_id", "block").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    named = running(cut, "conv_id", [F.col("block")], {"end_a": ("bit_xor", F.col("a")), "end_b": ("bit_xor", F.col("b"))})
    return named.select("conv_id", "block", "turns", "end_a", "end_b", F.col("end_a").bitwiseXOR(F.col("a")).alias("start_a"),
                        F.col("end_b").bitwiseXOR(F.col("b")).alias("start_b"))


def nodes(named: DataFrame, convs: DataFrame) -> DataFrame:
    """(key, parent, depth, n_bytes, n, c): every node with its number of members and the smallest one."""
    ends = ["start_a", "start_b", "end_a", "end_b"]
    distinct = stage(named.groupBy(*ends).agg(F.count("*").alias("n"), F.min("conv_id").alias("c"), F.first("turns").alias("turns"))
                     .withColumn("start", _key(F.col("start_a"), F.col("start_b"))), "blocks")
    siblings = distinct.groupBy("start").agg(F.count("*").alias("siblings"))
    found = join_counted(distinct, siblings, "start", "siblings", ["end_a", "end_b"], _hot(distinct))
    turn = found.select("n", "c", "siblings", F.explode(_prefixes()).alias("t")).select("n", "c", "siblings", "t.*")
    straight = turn.filter("siblings = 1").select("key", "parent", "depth", "n_bytes", "n", "c")
    apart = turn.filter("siblings > 1").groupBy("key", "parent", "depth", "n_bytes").agg(
        F.sum("n").alias("n"), F.min("c").alias("c"))
    root = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("c")).filter("n > 0").select(
        F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("n_bytes"), "n", "c")
    return straight.unionByName(apart).unionByName(root)


def _joined_ids(batches):
    """Runs of ids of one key as text: sorted input, so a run goes on until the key changes or enough are there."""
    last, first, ids = None, None, []
    for batch in batches:
        keys, values, texts = [], [], []
        for key, conv_id in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (key != last or len(ids) >= ENDS):
                keys.append(last), values.append(first), texts.append(",".join(ids))
                ids = []
            if not ids:
                last, first = key, conv_id
            ids.append(str(conv_id))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(values, pa.int64()), pa.array(texts, pa.string())],
                                         ["key", "first", "ids"])
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([first], pa.int64()), pa.array([",".join(ids)])],
                                         ["key", "first", "ids"])


def _hashed_ids(batches):
    """One SHA-256 per key, fed run after run: sorted input."""
    last, state = None, None
    for batch in batches:
        keys, digests = [], []
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if key != last:
                if last is not None:
                    keys.append(last), digests.append(state.hexdigest())
                last, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(digests, pa.string())], ["key", "ends_sha256"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def _ends(named: DataFrame, convs: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes where conversations end. Ids are dealt by ranges and joined to runs of text where
    they lie; only the runs of a node meet."""
    last = named.groupBy("conv_id").agg(F.max(F.struct("block", "end_a", "end_b")).alias("e")).select(
        "conv_id", _key(F.col("e.end_a"), F.col("e.end_b")).alias("key"))
    ends = convs.join(last, "conv_id", "left").select(F.coalesce("key", F.lit(ROOT)).alias("key"), "conv_id")
    runs = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        _joined_ids, "key string, first long, ids string")
    return runs.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed_ids, "key string, ends_sha256 string")


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of conversations given as turns (conv_id, depth, digest, n_bytes) and ids; see the query for the columns.

    An id without turns is a member of the root alone; without any id there is no node, not even a root.
    """
    named = blocks(rows)
    bare = stage(nodes(named, convs), "nodes")
    children = bare.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    every = bare.join(children, "key", "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0).cast("long")), "s": (F.col("n") - 1) * F.col("n_bytes")})
    every = every.withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
    # from the end of a chain up: what the chain has from a node on
    summed = stage(running(every, "c", [F.col("depth").desc()], {"own_s": ("sum", F.col("s")), "own_leaves": ("sum", F.col("leaf"))}), "nodes")
    hot = _hot(summed)
    chains = stage(summed.groupBy("c").agg(F.min(F.struct("depth", "key", "parent")).alias("top"), F.max("depth").alias("bottom"),
                                           F.sum("s").alias("s"), F.sum("leaf").alias("leaves")).filter("top.parent IS NOT NULL"), "chains")
    owners = summed.select("key", F.col("c").alias("parent_conv_id"), "n_children")
    tops = join_counted(chains.select(F.col("top.key").alias("own"), F.col("top.parent").alias("key")), owners, "key", "n_children",
                        ["own"], hot).select(F.col("own").alias("key"), "parent_conv_id")
    path = join_counted(named.withColumn("id", F.col("conv_id").cast("string")), chains.select(
        F.col("c").cast("string").alias("id"), F.col("top.depth").alias("top"), F.floor(F.col("bottom") / BLOCK + 1).alias("n_blocks"), "s", "leaves"),
        "id", "n_blocks", ["conv_id", "block"], hot)
    above = path.filter(F.col("block") * BLOCK + 1 < F.col("top")).select(
        F.explode(_prefixes()).alias("t"), "top", "s", "leaves").filter("t.depth < top").select("t.key", "s", "leaves")
    above = above.unionByName(chains.select(F.lit(ROOT).alias("key"), "s", "leaves"))
    below = above.groupBy("key").agg(F.sum("s").alias("more_s"), F.sum("leaves").alias("more_leaves"))
    found = summed.join(tops, "key", "left").join(below, "key", "left").join(_ends(named, convs), "key", "left")
    none = hashlib.sha256(b"").hexdigest()
    return found.select(
        F.col("c").alias("conv_id"), "depth", F.when(F.col("parent").isNotNull(), F.coalesce("parent_conv_id", "c")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children", (F.col("own_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
        (F.col("own_s") + F.coalesce("more_s", F.lit(0))).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, turn, role, text) as they are; other columns are not read."""
    own = turns(conversations)
    return trie(own, own.select("conv_id").distinct())


def query(spark, sf_dir: str) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    return trie(*rebuilt(turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


#: The query in DuckDB's SQL. The checksum is taken bit by bit: 256 stands for a step, other values are bytes.
SQL = """
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (
    SELECT conv_id, max(p) AS len, conv_id - conv_id % 5 AS base, xor(4294967295::UBIGINT, list_reduce(
        [4294967295::UBIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''),
            lambda x: [ascii(x)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256])),
        lambda a, x: CASE WHEN x < 256 THEN xor(a, x) ELSE xor(a >> 1, 3988292384::UBIGINT * (a & 1)) END))::BIGINT % 9 AS h
    FROM t GROUP BY conv_id),
r AS (
    SELECT c.conv_id, t.p AS depth, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.p <= c.h
    UNION ALL
    SELECT t.conv_id, t.p - c.h + least(c.h, coalesce(b.len, 0)), t.role, t.text
    FROM t JOIN c USING (conv_id) LEFT JOIN c AS b ON b.conv_id = c.base WHERE t.p > c.h),
k AS (
    SELECT conv_id, depth, strlen(text) AS n_bytes, sha256(string_agg(sha256(length(role)::VARCHAR || ':' || role || text), '')
        OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM r
    UNION ALL SELECT conv_id, 0, 0, 'root' FROM c),
path AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM k),
n AS (
    SELECT key, depth, parent, n_bytes, count(*) AS n, min(conv_id) AS c FROM path GROUP BY key, depth, parent, n_bytes),
w AS (
    SELECT n.*, (SELECT count(*) FROM n AS x WHERE x.parent = n.key) AS n_children FROM n),
below AS (
    SELECT p.key, count(*) FILTER (w.n_children = 0) AS n_leaves, sum((w.n - 1) * w.n_bytes) AS saved
    FROM w JOIN path AS p ON p.conv_id = w.c AND p.depth <= w.depth GROUP BY p.key),
ends AS (
    SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
    FROM (SELECT conv_id, arg_max(key, depth) AS key FROM path GROUP BY conv_id) GROUP BY key)
SELECT w.c AS conv_id, w.depth::BIGINT AS depth, u.c AS parent_conv_id, w.n::BIGINT AS n_convs, w.n_children::BIGINT AS n_children,
    b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM w JOIN below AS b USING (key) LEFT JOIN ends AS e USING (key) LEFT JOIN n AS u ON u.key = w.parent
"""
