"""Byte-level BPE, the conversation trie and collocations, against the library and brute force, and on small frames."""
import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import compare
from shelfledger.llm import byte_bpe, collocations, conversation_trie, registry
from shelfledger.llm.common import running

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, words int, gid long"  # the last two clash with names inside


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# -- byte-level BPE ------------------------------------------------------------------------------

def replayed(texts):
    chunk = byte_bpe._Chunk()
    for text in texts:
        chunk.add((0, 0), text, len(text.encode()))
    return [np.frombuffer(p, "<u4").tolist() for _, packed in chunk.encoded(byte_bpe.vocabulary(PATH)) for p in packed]


def test_replay_equals_the_library_on_random_texts(library, monkeypatch):
    pick = random.Random(5)
    parts = ["a", "ab", "aaa", " ", "  ", "\n", "\t", "the", "é", "漢", "🙂", "'s", "'S", "1", "22", "<|endoftext|>", "\x1c", "̈", "T", "=="]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 50))) for _ in range(20_000)]
    texts += ["", "a" * 5000, "=" * 3001 + " x", " " * 999, "ab" * 2000]
    want = [library.encode_ordinary(t) for t in texts]
    assert replayed(texts) == want
    monkeypatch.setattr(byte_bpe, "WINDOW", 7)  # texts cut at blanks
    monkeypatch.setattr(byte_bpe, "RUN", 3)
    monkeypatch.setattr(byte_bpe, "BATCH", 100)
    assert replayed(texts[:3000] + texts[-5:]) == want[:3000] + want[-5:]


def test_a_merge_that_makes_a_pair_of_lower_rank():
    """A vocabulary that was not made by training: "bcd" comes before "cd", so merges don't go up in rank."""
    ranks = {bytes([b]): b for b in range(256)} | {b"cd": 300, b"bcd": 280, b"cdc": 270, b"aa": 310, b"aab": 290, b"dcd": 260}
    own = byte_bpe.Vocabulary(ranks)
    pick = random.Random(2)
    words = ["".join(pick.choice("abcd") for _ in range(pick.randint(1, 12))).encode() for _ in range(3000)]
    offsets = np.cumsum([0, *map(len, words)])
    ids, bounds = byte_bpe.replay(np.frombuffer(b"".join(words), np.uint8), offsets, own)

    def by_steps(word):
        parts = [word[k:k + 1] for k in range(len(word))]
        while True:
            found = [(ranks[parts[k] + parts[k + 1]], k) for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in ranks]
            if not found:
                return [ranks[p] for p in parts]
            k = min(found)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
    assert [ids[lo:hi].tolist() for lo, hi in zip(bounds, bounds[1:])] == [by_steps(w) for w in words]
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({b"a": 0})


def test_bpe_query(spark, library):
    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").text
    got = registry.queries()["op11_byte_bpe"](spark, SF).toPandas()
    assert sorted(got.doc_id) == sorted(docs.index)
    for r in got.itertuples():
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.n_bytes) == (len(ids), len(docs[r.doc_id].encode()))
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_bpe_of_nulls_long_texts_and_no_rows(spark, library, monkeypatch):
    long = "long words and more " * 120_000  # 2.4 MB: several windows and runs
    rows = [(1, None, None, 0, 0), (None, "x y", "en", 0, 0), (2, "", "en", 0, 0), (2, "a  b", None, 0, 0), (2, "a  b", None, 0, 0), (3, long, "en", 0, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = byte_bpe.decode(byte_bpe.encode(docs, PATH), PATH).collect()
    have = Counter((r["doc_id"], bytes(r["decoded"]).decode(), tuple(np.frombuffer(r["ids"], "<u4"))) for r in got)
    assert have == Counter((i, t or "", tuple(library.encode_ordinary(t or ""))) for i, t, *_ in rows)
    assert byte_bpe.encode(docs.limit(0), PATH).count() == 0


# -- running totals ------------------------------------------------------------------------------

def test_running_totals_of_a_hot_key(spark):
    rows = [("a", k, k % 7) for k in range(500)] + [("b", 1, 5), ("c", 2, 6)]
    df = spark.createDataFrame(rows, "key string, at int, v long").repartition(6)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = running(df, "key", [F.col("at")], {"n": ("sum", F.lit(1)), "s": ("sum", F.col("v")), "x": ("bit_xor", F.col("v"))}).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    s = x = 0
    for n, r in enumerate(sorted((r for r in got if r["key"] == "a"), key=lambda r: r["at"]), 1):
        s, x = s + r["v"], x ^ r["v"]
        assert (r["n"], r["s"], r["x"]) == (n, s, x)
    assert len(got) == 502


# -- the trie of conversations -------------------------------------------------------------------

def crc(c):
    return zlib.crc32(str(c).encode()) % 9


def tree(convs):
    """Nodes of conversations given as lists of (role, text), straight from the definition."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    out = {}
    for p, own in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = sorted(c for c in own if len(convs[c]) == len(p))
        out[min(own), len(p)] = (
            min(members[p[:-1]]) if p else None, len(own), children[p], sum(not children[q] for q in below),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def turns_of(rows):
    """Turns by conversation, with the order of ties as documented."""
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        role, text = role or "", text or ""
        if c is not None:
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            convs[c].append(((turn is not None, turn or 0), tie, (role, text)))
    return {c: [t[2] for t in sorted(x)] for c, x in convs.items()}


def rebuilt(convs):
    return {c: convs.get(c - c % 5, [])[:crc(c)] + own[crc(c):] for c, own in convs.items()}


def nodes(df):
    return {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
            for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, key string, block int")


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_brute_force(spark, seed):
    pick = random.Random(seed)
    rows = [(c, t if pick.random() > 0.05 else None, pick.choice(["u", "a", None]), pick.choice(["x", "yé", "", None]), "k", 1)
            for c in pick.sample(range(40), 25) for t in range(pick.choice([1, 2, 3, 5, 9, 14]))]
    rows += rows[:7] + [(None, 1, "u", "x", "k", 1)]  # repeated turns, and a turn of no conversation
    convs = turns_of(rows)
    assert nodes(conversation_trie.conversation_trie(frame(spark, rows))) == tree(convs)
    assert nodes(conversation_trie.trie(*conversation_trie.rebuilt(conversation_trie.turns(frame(spark, rows))))) == tree(rebuilt(convs))


def test_trie_of_a_large_group_and_of_no_rows(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "ENDS", 7)  # many runs of ids in one node
    rows = [(c, t, "u", "same" if c % 3 else f"own {t}", "k", 1) for c in range(60) for t in range(3)]
    rows += [(100, t, "u", f"{t}" * 30, "k", 1) for t in range(50)] + [(101, t, "u", f"{t}" * 30, "k", 1) for t in range(49)]
    assert nodes(conversation_trie.conversation_trie(frame(spark, rows))) == tree(turns_of(rows))
    assert nodes(conversation_trie.conversation_trie(frame(spark, []))) == {}
    assert nodes(conversation_trie.trie(*conversation_trie.rebuilt(conversation_trie.turns(frame(spark, []))))) == {}


def test_trie_query_equals_brute_force_and_sql(spark):
    table = pd.read_parquet(f"{SF}/conversations.parquet")
    got = registry.queries()["op12_conversation_trie"](spark, SF)
    assert nodes(got) == tree(rebuilt(turns_of(table.itertuples(index=False))))


# -- collocations --------------------------------------------------------------------------------

def best(rows, least=10, share=50, top=2000):
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(small)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                f[lang or "und"].update(tuple(w[k:k + n]) for k in range(len(w) - n + 1))
    out = set()
    for lang, c in f.items():
        held = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        n, found = sum(a for p, a in c.items() if len(p) == 1), []
        for p, a in held.items():
            if any(len(q) > len(p) and 100 * b >= share * a and p in (q[:2], q[1:]) for q, b in held.items()):
                continue
            score, k = min(((10**6 * a * a) // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n, -score))
    return out


def rows_of(df):
    return {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_phrases_equal_brute_force(spark, monkeypatch, seed):
    pick = random.Random(seed)
    vocabulary = ["a", "b", "B", "c", "über", "x\x1cy", "d"] + [f"r{k}" for k in range(40)]
    def text():
        return "".join(pick.choice(vocabulary[:7] if pick.random() < 0.8 else vocabulary) + pick.choice([" ", " ", "  ", "\t", ". ", ",", "\n"])
                       for _ in range(pick.randint(0, 60)))
    rows = [(k, pick.choice([text(), text(), None, ""]), pick.choice(["en", "de", None, "und"]), 1, 2) for k in range(120)]
    rows += rows[:20]
    if seed:  # shards end often, and long texts are cut
        for name, size in (("SHARD_WORDS", 90), ("OPEN_WORDS", 150), ("WINDOW", 11)):
            monkeypatch.setattr(collocations, name, size)
    got = collocations.phrases(spark.createDataFrame(rows, DOCS).repartition(3), least=4, top=30)
    assert rows_of(got) == best([(r[2], r[1]) for r in rows], least=4, top=30)


def test_phrases_of_a_long_text_and_of_none(spark):
    long = "one two three, four " * 150_000  # 3 MB
    docs = spark.createDataFrame([(1, long, "en", 1, 2), (2, None, None, 1, 2)], DOCS)
    assert rows_of(collocations.phrases(docs)) == best([("en", long), (None, None)])
    assert rows_of(collocations.phrases(docs.limit(0))) == set()
    assert rows_of(collocations.phrases(docs.filter("doc_id = 2"))) == set()


def test_scores_do_not_overflow(spark):
    big = 4_000_000_000_000
    df = spark.createDataFrame([(big, big + 1, 2 * big)], "a long, l long, r long")
    got = df.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 10**6 * big * big // ((big + 1) * 2 * big)


def test_intervals_are_counts():
    pick = np.random.default_rng(1)
    text = np.concatenate([[0], pick.integers(0, 6, 400), [0]]).astype(np.int32)
    left, right = collocations.build_index(text, 2)
    first, second, n, lo = collocations.pairs(left, np.bincount(text, minlength=6))
    t = text.tolist()
    want = Counter((a, b) for a, b in zip(t, t[1:]) if a and b)
    assert dict(zip(zip(first.tolist(), second.tolist()), n.tolist())) == want
    a, b, c, n = collocations.triples(right, first, second, n, lo)
    want = Counter(x for x in zip(t, t[1:], t[2:]) if 0 not in x)
    assert dict(zip(zip(a.tolist(), b.tolist(), c.tolist()), n.tolist())) == want


def test_phrases_query_equals_brute_force(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert rows_of(registry.queries()["op13_collocations"](spark, SF)) == best(zip(docs.lang, docs.text))
