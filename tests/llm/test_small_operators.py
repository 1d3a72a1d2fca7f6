"""Each operator on a few rows: nulls, empty and long texts, ties, repeated rows, empty tables, other columns."""
import hashlib
import random
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfledger import session
from shelfledger.llm import (common, decontamination, extraction, fingerprints, languages, near_duplicates, packing,
                             sharding, substrings, token_counts, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, `at` int, words string"
WORDS = ["tree", "river", "stone", "cloud", "bread", "lamp", "glass", "paper", "wheel", "north", "green", "seven"]


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, 12, n), rng.integers(0, 40, n)))


def rows(*pairs):
    return [(i, t, "en", "s", len(t or ""), 7, "k", 1, "w") for i, t in pairs]


@pytest.fixture(scope="module")
def texts():
    a, b = prose(1, 300), prose(2, 90)
    near = " ".join("changed" if k == 150 else w for k, w in enumerate(a.split()))
    return [(1, a), (2, b), (3, a), (4, near), (5, None), (6, ""), (7, " \n\t "), (8, "one"), (8, "one"),
            (9, "it's 3.5 km, isn't it? <|endoftext|>x  é ü"), (None, prose(3, 60)), (10, b + "\n" + prose(4, 40)),
            (11, prose(5, 40_000)), (12, "spam " * 500), (13, "日本語 " * 40)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(rows(*texts), SCHEMA).coalesce(2)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_counts_equal_the_tokenizer(docs, empty, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs, path).collect())
    want = Counter((i, len((t or "").encode()), len(model.encode(t or "", add_special_tokens=False))) for i, t in texts)
    assert got == want
    assert token_counts.token_counts(empty, path).count() == 0


def test_frequencies_beyond_the_posting_width(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "a" + " a" * 140_000
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert token_counts.token_counts(frame, path).first().n_tokens == 140_001


def test_packing_covers_every_id_once(docs, empty, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    got = packing.pack(docs, path, 2).toPandas()
    own = {i: [*model.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts}
    for doc_id, part in got[got.doc_id.notna()].groupby("doc_id"):
        ids = own[int(doc_id)]
        copies = sum(i == doc_id for i, _ in texts)
        assert part.length.sum() == copies * len(ids)
        for r in part.itertuples():
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert list(part.offset) == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= 4096
    assert sorted(got.sequence_id.unique()) == list(range(got.sequence_id.nunique()))
    assert packing.pack(empty, path, 2).count() == 0


def test_a_word_is_encoded_once_whatever_its_case():
    path = public_tokenizers.path("word_bpe_49k.json")
    words, model = packing._Words(path), Tokenizer.from_file(path)
    text = "Stra\u00dfe STRA\u00dfE stra\u00dfe, \u00c9t\u00e9 \u00e9t\u00e9 \u00c9T\u00c9"
    own_case = ["T\u0308 t\u0308", "<|ENDOFTEXT|> <|endoftext|>", "\u0130 \u00b0C \u212a", "3\u00d74 \u00f7 \u00de"]
    for t in (text, *own_case):
        assert np.frombuffer(words.of(t.encode()), "<u4").tolist() == model.encode(t, add_special_tokens=False).ids
    alone = packing._Words(path)
    alone.of(text.encode())
    assert len(alone.known) == 3


def test_histogram_packing_places_all_and_wastes_little():
    rng = np.random.default_rng(0)
    histogram = dict(Counter(rng.integers(1, 4097, 5000).tolist()) | Counter(rng.integers(1, 300, 9000).tolist()))
    patterns = packing.pack_histogram(histogram)
    placed = Counter()
    for p in patterns:
        assert sum(p.lengths) <= 4096 and p.count > 0
        for size in p.lengths:
            placed[size] += p.count
    assert placed == Counter(histogram)
    used = sum(k * v for k, v in histogram.items())
    assert sum(p.count for p in patterns) <= used / 4096 * 1.02 + 1


def test_shards_differ_by_one_row(docs, empty, texts):
    got = sharding.shard(docs, 4).toPandas()
    counts = got.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert len(got) == len(texts) and counts["count"].max() - counts["count"].min() <= 1
    assert (counts["count"] == counts["max"] + 1).all() and (counts["count"] == counts["nunique"]).all()
    own = {i: t for i, t in texts}
    for r in got[got.doc_id.notna()].itertuples():
        data = (own[int(r.doc_id)] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
    assert sharding.shard(empty).count() == 0


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 4)])
def test_curve_visits_neighbouring_cells(spark, dims, bits):
    cells = spark.range(1 << dims * bits).select(*[
        F.shiftright("id", bits * k).bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias(f"d{k}") for k in range(dims)])
    walk = cells.withColumn("h", sharding.hilbert_index([F.col(f"d{k}") for k in range(dims)], bits)).orderBy("h").collect()
    assert [r.h for r in walk] == list(range(1 << dims * bits))
    assert all(sum(abs(a[k] - b[k]) for k in range(dims)) == 1 for a, b in zip(walk, walk[1:]))


def test_removed_windows_equal_brute_force(docs, empty, texts, monkeypatch):
    def words(text):
        return (text or "").encode().split()
    counts = Counter(tuple(w[k:k + 35]) for w in (words(t) for _, t in texts) for k in range(len(w) - 34))
    want = Counter()
    for i, t in texts:
        w = words(t)
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 34):
            if counts[tuple(w[k:k + 35])] > 1:
                gone[k:k + 35] = True
        want[i, len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g).decode()] += 1
    for most in (substrings.SHARD, 0):  # by automata, and by counts of the windows
        monkeypatch.setattr(substrings, "SHARD", most)
        got = substrings.remove_repeats(docs)
        assert Counter(tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_text").collect()) == want
    assert substrings.remove_repeats(empty).count() == 0


def test_automaton_counts_equal_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(200):
        parts = [(rng.integers(0, 2, rng.integers(4, 14)).tolist(), int(rng.integers(1, 3))) for _ in range(3)]
        seen = Counter()
        for words, times in parts:
            for k in range(len(words) - 3):
                seen[tuple(words[k:k + 4])] += times
        want = [sum(1 << k for k in range(len(w) - 3) if seen[tuple(w[k:k + 4])] > 1) for w, _ in parts]
        assert substrings.repeated_windows(parts, 4) == want


def test_classes_of_near_duplicates(docs, empty):
    got = {r.doc_id: r.class_id for r in near_duplicates.classes(docs).collect()}
    assert got == {1: 1, 3: 1, 4: 1, 2: 2, 5: 5, 6: 5, 7: 7, 8: 8, 9: 9, None: None, 10: 10, 11: 11, 12: 12, 13: 13}
    assert near_duplicates.classes(empty).count() == 0
    kept = near_duplicates.stage_near_duplicates(docs.sparkSession, docs, "")
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 5, 7, 8, 9, None, 10, 11, 12, 13])


def test_near_copies_without_an_id_or_under_one_id(spark):
    base, other = prose(31, 200), prose(32, 200)
    near = base.replace(base.split()[3], "changed", 1)
    frame = spark.createDataFrame(
        [(None, near, None, None, 1), (1, base, None, None, 1), (5, base, None, None, 1), (5, other, None, None, 1), (None, prose(33, 50), "x", None, 1),
         (None, prose(34, 50), None, None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {(r.doc_id, r.text_key): (r.class_id, r.class_key) for r in near_duplicates.classes(frame).collect()}
    key = lambda text: hashlib.md5(text.encode()).digest()
    assert got[None, key(near)] == got[1, key(base)] == got[5, key(base)] == (1, key(base))
    assert got[5, key(other)] == (5, key(other))
    assert got[None, key(prose(33, 50))] == (None, key(prose(33, 50))) and len(got) == 6
    kept = near_duplicates.stage_near_duplicates(spark, frame, "").collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(
        [(1, base), (5, other), (None, prose(33, 50)), (None, prose(34, 50))])


def test_probability_jaccard_is_its_definition():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 12, 8)).astype(np.uint64) for _ in range(2))
        wa, wb = rng.integers(1, 4, len(a)), rng.integers(1, 4, len(b))
        da, db = dict(zip(a.tolist(), wa.tolist())), dict(zip(b.tolist(), wb.tolist()))
        want = sum(1 / sum(max(da.get(e, 0) / da[d], db.get(e, 0) / db[d]) for e in {**da, **db}) for d in da if d in db)
        assert near_duplicates.probability_jaccard(a, wa, b, wb) == pytest.approx(want)


def test_sketches_estimate_the_similarity():
    rng = np.random.default_rng(2)
    agree, exact = [], []
    for _ in range(40):
        pool = rng.integers(0, 1 << 62, 120).astype(np.uint64)
        a, b = np.sort(pool[:100]), np.sort(pool[20:])
        wa = wb = rng.integers(1, 3, 100)
        exact.append(near_duplicates.probability_jaccard(a, wa, b, wb))
        s = near_duplicates.sketch(np.repeat([0, 1], 100), np.concatenate([a, b]), np.concatenate([wa, wb]), 2, 240)
        agree.append((s[0] == s[1]).mean())
    assert np.mean(agree) == pytest.approx(np.mean(exact), abs=0.02)


def test_large_group_of_near_copies_is_one_class(spark):
    base = prose(9, 200).split()
    many = [(k, " ".join(f"v{k}" if j == k % 200 else w for j, w in enumerate(base))) for k in range(400)]
    frame = spark.createDataFrame(many, "doc_id long, text string")
    assert {r.class_id for r in near_duplicates.classes(frame).collect()} == {0}


def linked_by_brute_force(texts):
    """The least id of each text's class, from all pairs."""
    weights = [near_duplicates._distinct(t) for t in texts]
    own = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if own[a] != own[b] and near_duplicates.probability_jaccard(*weights[a], *weights[b]) >= 0.8:
                low, high = sorted((own[a], own[b]))
                own = [low if x == high else x for x in own]
    return dict(enumerate(own))


def family(seed, copies, edits, words):
    """Near copies of one base by edits of their own."""
    rng = np.random.default_rng(seed)
    base = prose(seed, words).split()
    out = []
    for k in range(copies):
        at = set(rng.choice(words, edits, replace=False).tolist())
        out.append(" ".join(f"v{k}x{j}" if j in at else w for j, w in enumerate(base)))
    return out


@pytest.mark.parametrize("words", [255, 275])
def test_large_family_around_the_threshold_equals_brute_force(spark, words):
    many = family(21, 160, 4, words)
    frame = spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")
    want = linked_by_brute_force(many)
    assert 1 < len(set(want.values())) < len(many)
    assert {r.doc_id: r.class_id for r in near_duplicates.classes(frame).collect()} == want


def test_meetings_without_a_link_end_nothing(spark, monkeypatch):
    meetings = near_duplicates._meetings
    monkeypatch.setattr(near_duplicates, "_meetings", lambda buckets, once=False: meetings(buckets, once).limit(0))
    monkeypatch.setattr(near_duplicates, "FEW", 0)
    many = family(21, 40, 4, 265)
    want = linked_by_brute_force(many)
    assert 1 < len(set(want.values())) < len(many)
    frame = spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_duplicates.classes(frame).collect()} == want


@pytest.mark.parametrize("sparse", [1, 8, 10**9])
def test_block_pairs_equal_brute_force(monkeypatch, sparse):
    """Whether shingles go into the product or are paired one by one, the links join what all links would join."""
    monkeypatch.setattr(near_duplicates, "SPARSE", sparse)
    monkeypatch.setattr(near_duplicates, "COLUMNS", 3)
    monkeypatch.setattr(near_duplicates, "PAIRS", 50)
    rng = np.random.default_rng(6)
    for _ in range(20):
        texts = [" ".join(f"w{x}" for x in rng.integers(0, 3, rng.integers(8, 40))) for _ in range(12)] + ["", "one"]
        weights = [near_duplicates._distinct(t) for t in texts]
        joined = [np.concatenate([np.repeat(np.arange(14), [len(w[0]) for w in weights])]),
                  np.concatenate([w[0] for w in weights]), np.concatenate([w[1] for w in weights])]
        asked, kinds = rng.random((14, 14)) < 0.8, [rng.integers(0, 6, 14), rng.integers(4, 9, 14)]
        asked &= kinds[0][:, None] != kinds[1][None, :]
        p, q = near_duplicates._joint_shares(joined, joined, (14, 14))
        for x, y in zip(*np.nonzero(asked)):
            both = np.isin(weights[x][0], weights[y][0])
            assert p[x, y] == pytest.approx(weights[x][1][both].sum() / max(1, weights[x][1].sum()))
            assert q[x, y] == pytest.approx(p[y, x])
        want = {(x, y): near_duplicates.probability_jaccard(*weights[x], *weights[y]) for x, y in zip(*np.nonzero(asked))}
        got = near_duplicates._similar(joined, joined, asked, kinds, 0.3)
        assert all(s == pytest.approx(want[x, y]) and s >= 0.3 for x, y, s in got)

        def joins(pairs):
            parent = {k: k for k in range(9)}
            for x, y in pairs:
                u, v = kinds[0][x], kinds[1][y]
                parent = {k: parent[v] if r == parent[u] else r for k, r in parent.items()}
            return {frozenset(k for k in parent if parent[k] == r) for r in parent.values()}
        assert joins([(x, y) for x, y, _ in got]) == joins([k for k, v in want.items() if v >= 0.3])


def test_chain_of_links_is_one_class(spark):
    words = prose(10, 400).split()
    chain = [(k, " ".join(words[12 * k:12 * k + 200])) for k in range(8)]  # each like the next, not like the one after
    frame = spark.createDataFrame(chain, "doc_id long, text string")
    assert {r.class_id for r in near_duplicates.classes(frame).collect()} == {0}


def test_fingerprints_follow_the_similarity(spark, docs, empty, texts):
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("print", fingerprints.fingerprint(F.col("text")))
    got = {r.text: fingerprint for r, fingerprint in ((r, tuple(r.print)) for r in own.collect())}
    assert got[""] == () and got[" \n\t "] == () and len(got["one"]) == 16
    pairs = spark.createDataFrame([(texts[0][1], texts[3][1]), (texts[0][1], texts[1][1]), ("", " "), ("", "x"), ("x", "x")],
                                  "a string, b string")
    like = [r[0] for r in pairs.select(fingerprints.likeness(
        fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b")))).collect()]
    assert like[0] > 0.9 and like[1] < 0.1 and like[2:] == [1.0, 0.0, 1.0]
    followed = fingerprints.with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["text"], run_rows=1).collect()
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0))
    after = {order[k][0]: order[(k + 1) % len(order)][1] or "" for k in range(len(order))}
    for r in followed:
        assert r.next_text == (after[r.doc_id] if r.doc_id != 8 else r.next_text)
    assert len(followed) == len(texts)
    assert fingerprints.with_next(empty.select("doc_id", "text"), ["text"]).count() == 0


def test_languages(spark, docs, empty):
    sample = {"en": "the house with the garden and this other thing that was there", "de": "das haus mit dem garten und auch der schöne weg zum fluss",
              "fr": "la maison avec le jardin et aussi une très belle rivière"}
    labelled = [(k, t, lang) for k in range(20) for lang, t in sample.items()]
    model = languages.fit(spark.createDataFrame(labelled, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(1, sample["de"].upper()), (2, "the garden with this house"), (3, None), (4, "12 — 34 ..."), (5, ""),
                                   (6, sample["en"] + " " + sample["fr"])], "doc_id long, text string")
    got = {r.doc_id: r for r in languages.identify(asked, model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 4, 5)] == ["de", "en", "und", "und", "und"]
    assert {m.lang for m in got[6].mixture} == {"en", "fr"} and sum(m.share for m in got[6].mixture) == pytest.approx(1)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert languages.fit(empty) is None
    assert {r.lang_pred for r in languages.identify(docs, None).collect()} == {"und"}
    assert languages.identify(empty, model).count() == 0


def test_toxicity(spark, docs, empty):
    rng = np.random.default_rng(0)
    train, labels = [], []
    for k in range(300):
        words = prose(100 + k, 60).split()
        if k % 3 == 0:
            words[rng.integers(0, 60)] = words[rng.integers(0, 60)] = ["vile", "rotten"][k % 2]
        train.append((k, " ".join(words)))
        labels.append((k, 1, int(k % 3 == 0)))
    train, labels = (spark.createDataFrame(x, s) for x, s in ((train, "doc_id long, text string"), (labels + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")))
    field = toxicity.fit(train, labels)
    asked = spark.createDataFrame([(1, prose(7, 50) + " VILE, " + prose(8, 30)), (2, prose(7, 80)), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.toxicity(asked, field).collect()}
    assert got[1].score >= 0.7 and max(got[k].score for k in (2, 3, 4)) < 0.3
    text = asked.first().text.encode()
    assert [text[s.start:s.end] for s in got[1].spans] == [b"VILE"]
    assert toxicity.toxicity(docs, field).count() == docs.count() and toxicity.toxicity(empty, field).count() == 0
    assert toxicity.fit(empty, labels) is None and toxicity.toxicity(docs, None).agg(F.max("score")).first()[0] == 0


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    e, moves = rng.normal(size=6), rng.normal(size=(2, 2))
    p = np.zeros(6)
    total = 0.0
    for state in range(64):
        y = [(state >> k) & 1 for k in range(6)]
        weight = np.exp(sum(e[k] * y[k] for k in range(6)) + sum(moves[y[k], y[k + 1]] for k in range(5)))
        p += weight * np.array(y)
        total += weight
    assert toxicity.marginals(np.concatenate([[0.3], e]), np.array([0, 1, 1, 7]), moves)[0][1:] == pytest.approx(p / total)


def test_templates_match_other_numbers_and_names(spark, docs, empty):
    item = "Now Tom gave Anna 5 apples and then she ate 3 apples of the 5 which he had."
    asked = [(1, "Before. " + item + " After."), (2, item.replace("Tom", "Jack").replace("5", "17").replace("3", "2.5")),
             (3, "Now Jack gave Maria 17 apples and then she ate 2 apples of the 9 which he had."), (4, None), (5, ""),
             (6, "some other words that have nothing to do with it at all"), (None, item), (1, "Before. " + item + " After.")]
    asked = spark.createDataFrame(rows(*asked), SCHEMA)
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "a b")], "item_id long, text string")
    got = Counter((r.id, r.item_id) for r in decontamination.contaminated(asked, bench).collect())
    assert got == {(1, 7): 1, (2, 7): 1, (None, 7): 1}
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.contaminated(empty, bench).count() == 0


def test_short_items_inside_long_documents(spark, empty):
    short, eight = "Which colour has the old bridge?", "Why does the green river run so slowly?"
    before = "there was much to say about the town and then someone asked them all the same thing again: "
    asked = [(1, before + short + " nobody knew it and so they went on to the next one of the long list"),
             (2, before[:-2] + " " + eight + " nobody knew"), (3, before + "Which colour has the new bridge? nobody knew"),
             (4, before[:-2] + " Anna does the green river run so slowly? nobody knew"), (5, short), (6, before)]
    bench = spark.createDataFrame([(7, short), (8, eight)], "item_id long, text string")
    got = Counter((r.id, r.item_id) for r in decontamination.contaminated(spark.createDataFrame(rows(*asked), SCHEMA), bench).collect())
    assert got == {(1, 7): 1, (2, 8): 1, (5, 7): 1}


def test_extraction():
    tree = extraction.fit()
    page = ("<html><head><title>T</title><style>p{}</style></head><body><header><p>Site name</p></header><nav><ul><li><a href=/a>Home</a>"
            "</ul></nav><div class='cookie-notice'>We use cookies.</div><article><h1>Head &amp; line</h1><p>First  <b>bold</b>\nwords &copy;"
            "<p>Two<br>lines<script>var x='</p>';</script></p><aside>See also</aside><form><p>Mail</p></form><div class=\"comments\"><p>Nice!"
            "</p></div><p>x</article><div class=sidebar><p>Popular</p></div><footer>&copy; me</footer>")
    assert extraction.main_text(page, tree) == "Head & line\nFirst bold words ©\nTwo lines\nx"
    assert extraction.main_text(None, tree) == extraction.main_text("", tree) == extraction.main_text("<p></p>", tree) == ""
    table = np.array(extraction.LABELLED, float)
    assert (extraction.classify(tree, table[:, :-1]) == (table[:, -1] == 1)).all()


PROSE = "Some plain words about the river and the old town that run on for a while."


@pytest.mark.parametrize("part, want", [
    # sections of an article whose names could be furniture's
    (f'<section id="related-work"><h2>Related work</h2><p>{PROSE}</p></section>', ["Related work", PROSE]),
    ('<section id="discussion"><h2>Discussion</h2><p>We found it so.</p></section>', ["Discussion", "We found it so."]),
    (f'<section id="menu-planning"><h2>Menu planning</h2><p>{PROSE}</p></section>', ["Menu planning", PROSE]),
    (f'<div id="legal-framework"><p>{PROSE}</p></div>', [PROSE]),
    ("<blockquote class='comment'>A short remark of the author.</blockquote>", ["A short remark of the author."]),
    ("<div class='search-results'>Eleven hits were seen.</div>", ["Eleven hits were seen."]),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> hold.</p>", ["Let x=1 hold."]),
    ("<ul><li>First thing<li>Second <a href=1>thing</a> too<li>Third</ul>", ["First thing", "Second thing too", "Third"]),
    ("<p><a href=1>Read the report</a></p>", ["Read the report"]),
    ("<table><tr><th>Year</th><th>Sum</th></tr><tr><td>2001</td><td>5</td></tr></table>", ["Year", "Sum", "2001", "5"]),
    # furniture inside it
    ("<ul><li><a href=1>More news</a><li><a href=2>Sports</a><li><a href=3>Weather</a></ul>", []),
    ("<div class='related-posts'><h3>Related posts</h3><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></div>", []),
    ("<div class='share-buttons'>Share this on the web</div>", []),
    (f"<section id='comments'><h3>2 comments</h3><div class='comment'><p>{PROSE}</p></div></section>", []),
    (f"<ol><li class='comment'><p>{PROSE}</p></li></ol>", []),
    (f"<article class='comment'><p>{PROSE}</p></article>", []),
    ("<p class='advert'>Buy now and save a lot.</p>", []),
    ("<div class='notice'>This site will be down tonight for a while, sorry for that.</div>", []),
    ("<form><label>Mail</label><p>Enter your mail.</p></form>", [])])
def test_extraction_inside_articles(part, want):
    page = (f"<body><nav><a href=/>Home</a></nav><article><h1>Title here</h1><p>{PROSE}</p>{part}<p>{PROSE}</p></article>"
            "<footer>c 2020</footer></body>")
    assert extraction.main_text(page, extraction.fit()).split("\n") == ["Title here", PROSE, *want, PROSE]


def test_extraction_without_articles():
    tree = extraction.fit()
    assert extraction.main_text("<body><h1>A short heading</h1><p>One short line.</p><p>Another one.</p></body>", tree) == (
        "A short heading\nOne short line.\nAnother one.")
    page = (f"<body><div class=nav><a href=1>Home</a> <a href=2>News</a></div><h1>A short heading</h1><p>One line.</p><p>{PROSE}</p>"
            "<div>Copyright 2020 by me</div></body>")
    assert extraction.main_text(page, tree) == f"A short heading\nOne line.\n{PROSE}"
    # a form around the whole page, a heading inside main
    assert extraction.main_text(f"<form id=f><div id=main><article><h1>T</h1><p>{PROSE}</p></article></div></form>", tree) == f"T\n{PROSE}"
    assert extraction.main_text(f"<main><header><h1>T</h1></header><p>{PROSE}</p></main>", tree) == f"T\n{PROSE}"
    # nothing decides but the blocks themselves
    # the tree asks the blocks and their neighbours, not only where they stand
    assert {"link_density", "words", "density_before", "words_after", "density_after"} <= set(_features(tree))


def _features(tree):
    if tree.left is not None:
        yield extraction.FEATURES[tree.feature]
        yield from _features(tree.left)
        yield from _features(tree.right)


def test_extraction_of_frames(spark):
    page = "<article><p>Body</p></article><footer>f</footer>"
    frame = spark.createDataFrame([(1, "u", page, 5), (1, "u", page, 5), (None, None, None, None)], "page_id long, url string, html string, text int")
    assert Counter(tuple(r) for r in extraction.extract(frame).collect()) == {(1, "u", "Body"): 2, (None, None, ""): 1}
    assert extraction.extract(frame.limit(0)).count() == 0


def test_ids_of_texts_with_special_strings_and_marks(monkeypatch):
    """20,000 random texts with special strings in any case, combining marks and further blanks: the tokenizer's ids."""
    path = public_tokenizers.path("word_bpe_49k.json")
    model, words, pick = Tokenizer.from_file(path), packing._Words(path), random.Random(3)
    parts = ["a", "B", "Tür", "ÜBER", "T\u0308", "a\u0327\u0308", "é", "e\u0329", "<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>",
             "<|startoftext|>", "<|", "|>", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\u00a0", "漢字", "🙂", "don't", "DON'T", "12", "3.5",
             "--", "_", "S", "İ", "ß", "ẞ", "ǅ", "A\u030a", "ﬁ", "\x85", "\u3000"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 12))) for _ in range(20_000)]
    ids = lambda t: np.frombuffer(words.of(t.encode()), "<u4").tolist()
    assert [t for t in texts if ids(t) != model.encode(t, add_special_tokens=False).ids] == []
    monkeypatch.setattr(packing, "RUN", 5)
    monkeypatch.setattr(packing, "REMEMBERED", 1000)
    assert [t for t in texts[:2000] if ids(t) != model.encode(t, add_special_tokens=False).ids] == []


def test_words_that_collide_under_any_base_stay_apart(spark):
    """Two words of 1024 letters, of which one is the other with a and b changed: sums of powers modulo 2**64 are equal."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(1024))
    two = one.translate(str.maketrans("ab", "ba"))
    words = [f"w{k}" for k in range(34)]
    rows = [(1, " ".join([*words, one])), (2, " ".join([*words, two])), (3, " ".join([*words, one, "x"]))]
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 35, 2: 0, 3: 35}


def question(pick, names, numbers, frame):
    """A word problem: names at sentence starts and inside, numbers, units."""
    a, b = names
    x, y, z = numbers
    things, place, verb, unit = frame
    return (f"{a} buys {x} {things} at the {place} for {y} dollars. {b} {verb} {z} {unit} to meet {a} there. "
            f"How many {things} does {b} carry home if {a} keeps {x} of them near the {place}?")


def test_questions_come_back_under_other_names_and_numbers(spark, monkeypatch):
    """500 questions with new names, numbers and units inside other text: found, and no others."""
    monkeypatch.setattr(decontamination, "BLOCK", 500)  # several blocks
    pick = random.Random(11)
    people = ["Tom", "Anna", "Maria", "Pedro", "Li", "Ingrid", "Omar", "Zoe", "Kofi", "Elena"]
    frames = [(f"thing{k}s", f"shop{k}", f"walks{k % 7}", "miles") for k in range(500)]
    draw = lambda: (pick.sample(people, 2), pick.sample(range(2, 900), 3))
    bench = [(k, question(pick, *draw(), f)) for k, f in enumerate(frames)]
    units = ["km", "yards", "miles"]
    asked = [(k, f"{prose(k, 30)}. {question(pick, *draw(), (*f[:3], pick.choice(units)))} {prose(k + 1000, 30)}") for k, f in enumerate(frames)]
    clean = [(1000 + k, f"{prose(k + 5000, 40)}. {pick.choice(people)} met {pick.choice(people)}. How many {prose(k + 9000, 20)}?") for k in range(300)]
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.id, r.item_id) for r in decontamination.contaminated(spark.createDataFrame(rows(*asked, *clean), SCHEMA), items).collect()}
    right = {(k, k) for k in range(500)}
    assert len(got & right) >= 0.95 * 500 and len(got - right) <= 0.02 * len(got)


def test_items_with_few_plain_words_are_matched_word_by_word(spark):
    items = spark.createDataFrame([(1, "What is 12 + 5?"), (2, "3 4 5 6 7 8 9 10 11 12"), (3, "Ann: 7 km")], "item_id long, text string")
    asked = [(1, "So what is 12 + 5? I wonder"), (2, "What is 13 + 5?"), (3, "1 2 3 4 5 6 7 8 9 10 11 12 13"), (4, "ann 7 km away"), (5, "Bob: 7 km")]
    got = {(r.id, r.item_id) for r in decontamination.contaminated(spark.createDataFrame(rows(*asked), SCHEMA), items).collect()}
    assert got == {(1, 1), (3, 2), (4, 3)}


def test_a_window_that_all_items_share_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "HOT_WINDOW", 20)
    start = "read the following short passage and then answer the question below "
    bench = [(k, start + prose(k, 12)) for k in range(60)]
    asked = [(k, f"{prose(k + 100, 9)} {start}{prose(k, 12)}") for k in range(0, 60, 7)]
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = {(r.id, r.item_id): r.coverage for r in decontamination.contaminated(spark.createDataFrame(rows(*asked), SCHEMA), items).collect()}
    assert {k for k, v in got.items() if v == 1} == {(k, k) for k, _ in asked}


def test_stages_on_nulls_repeats_and_no_rows(spark, docs, texts, empty, tmp_path):
    """Every stage of the pipeline on rows of all kinds: which rows stay, with which columns."""
    spark.createDataFrame([(1, prose(77, 30)), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf, columns = str(tmp_path), ["doc_id", "text", "lang", "source", "n_chars"]
    stages = {"languages": languages.stage_languages, "substrings": substrings.stage_substrings,
              "decontamination": decontamination.stage_decontamination, "near_duplicates": near_duplicates.stage_near_duplicates}
    for stage in stages.values():
        got = stage(spark, empty, sf)
        assert got.columns == columns and got.count() == 0
    count = lambda df: Counter((r.doc_id, r.text) for r in df.collect())
    every = Counter((i, t) for i, t in texts)
    letters = Counter((i, t) for i, t in texts if t and any(map(str.isalpha, t)))
    got = stages["languages"](spark, docs, sf)
    assert count(got) == letters and {r.lang for r in got.collect()} == {"en"}
    assert count(stages["languages"](spark, docs.withColumn("lang", F.lit(None).cast("string")), sf)) == letters
    assert count(stages["decontamination"](spark, docs, sf)) == every
    held = spark.createDataFrame(rows((1, prose(77, 30)), (1, prose(77, 30)), (None, "x " + prose(77, 30)), (2, None)), SCHEMA)
    assert count(stages["decontamination"](spark, held, sf)) == Counter([(2, None)])
    got = stages["substrings"](spark, docs, sf)
    assert Counter(r.doc_id for r in got.collect()) == Counter(i for i, _ in texts)
    assert {r.text for r in got.filter("doc_id = 5").collect()} == {None}


def test_pipeline_packs_nothing_of_an_empty_table(spark, empty, tmp_path):
    import corpus_pipeline
    empty.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_worker_gives_back_what_a_task_used():
    def resident():
        return int(open("/proc/self/statm").read().split()[1]) * 4096

    def hold(batches):
        for batch in batches:
            # freed pieces between pieces that stay: the allocator would keep them all
            pieces = [np.ones(100_000, np.uint8) for _ in range(2000)]
            pins.extend(pieces[::100])
            yield batch

    pins, store = [], sys.__dict__.setdefault("_llm_kept", {})
    store["old table"] = np.ones(1), -7
    store["stage"] = -5
    before = resident()
    assert list(common.frugal(hold)([1, 2])) == [1, 2]
    assert resident() - before < 40e6  # of 200 MB; 4 MB are pinned
    assert "old table" not in store


@pytest.fixture
def many_partitions(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_tables_of_numbers_are_written_by_few_tasks(spark, many_partitions, monkeypatch):
    """Hadoop starts processes for every file that is written; the number of shuffle partitions must not multiply them."""
    near = [(k, " ".join("changed" if w == 40 + 7 * (k % 5) else x for w, x in enumerate(prose(k // 5, 200).split())))
            for k in range(200)]
    docs = spark.createDataFrame(rows(*near), SCHEMA).repartition(4)
    seen = {}

    def counted(df, name="stage", **more):
        out = session.stage(df, name, **more)
        seen.setdefault(name, []).append(len([f for f in out.inputFiles() if "/part-" in f]))
        return out

    for module in (near_duplicates, sys.modules["shelfledger.llm.components"]):
        monkeypatch.setattr(module, "stage", counted)
    got = {r.doc_id: r.class_id for r in near_duplicates.classes(docs).collect()}
    assert got == {k: k - k % 5 for k in range(200)}
    most = 2 * spark.sparkContext.defaultParallelism
    numbers = {name: max(n) for name, n in seen.items() if name not in ("sketches", "links")}
    assert {"texts", "buckets", "pairs", "needs", "edges", "classes"} <= set(numbers)
    assert max(numbers.values()) <= most, numbers


def test_a_workers_passes_and_batches_are_small(spark, docs):
    """What a Python worker holds of a pass over texts and of a batch is a share of an executor that has two of them."""
    import pyarrow as pa
    spans = [(hi - lo, len(data)) for lo, hi, data, _ in common.text_slices(pa.array(["x" * 4000] * 1000))]
    assert sum(n for n, _ in spans) == 1000 and max(size for _, size in spans) <= 1 << 19
    assert int(session.RUNTIME_CONF["spark.sql.execution.arrow.maxBytesPerBatch"]) <= 4 << 20


def test_the_tasks_of_a_table_grow_with_what_it_is_derived_from(spark, monkeypatch):
    small, large = (session.stage(spark.range(0, n, 1, 2).selectExpr("xxhash64(id) AS x"), "rows") for n in (10_000, 200_000))
    monkeypatch.setattr(common, "TASK_BYTES", 1 << 14)
    least = 2 * spark.sparkContext.defaultParallelism
    assert least <= common.tasks_of(small) <= max(least, 10)
    assert 8 * 200_000 / (1 << 14) <= common.tasks_of(large) <= 2 * 8 * 200_000 / (1 << 14)
