"""The operators' queries over whole tables, against brute force, the tokenizers, or held-out labels."""
import hashlib
import html
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import compare
import corpus_pipeline
from shelfledger.llm import registry
from shelfledger.llm.substrings import repeated_windows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id").reset_index(drop=True)


@pytest.fixture(scope="module")
def result(spark):
    held = {}

    def of(name):
        if name not in held:
            held[name] = registry.queries()[name](spark, SF).toPandas()
        return held[name]
    return of


def shingles(text, n=5):
    words = text.split()
    return Counter(tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))) if words else Counter()


def crc_fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert set(registry.queries()) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))


def test_fingerprints(result, docs):
    got = result("op1_minhash_fingerprints").sort_values("doc_id").reset_index(drop=True)
    texts, errors = list(docs.text), []
    for k, r in enumerate(got.itertuples()):
        after, half = texts[(k + 1) % len(texts)], len(texts[k]) // 2
        edited = texts[k][:len(texts[k]) - half] + after[:half]
        assert r.n_chars == len(texts[k]) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = set(shingles(texts[k])), set(shingles(edited))
        errors.append(r.near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.015 and np.abs(errors).max() < 0.2
    by_text = got.assign(text=docs.text).groupby("text").fingerprint.nunique()
    assert (by_text == 1).all()


def test_extraction(result):
    pages = pd.read_parquet(f"{SF}/pages.parquet").set_index("page_id").html
    for r in result("op2_extract_pages").itertuples():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)
        parts = re.split(r"</?(?:p|h1)>|<br>", re.sub(r"</?b>", "", article[1]))
        want = "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert r.text == want and r.n_chars == len(want)


def test_shards(result, docs):
    got = result("op3_hilbert_shards")
    counts = got.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert set(got.shard) == set(range(24)) and len(got) == len(docs)
    assert counts["count"].max() - counts["count"].min() <= 1 and (counts["max"] + 1 == counts["nunique"]).all()
    for r in got.merge(docs, on="doc_id").itertuples():
        data = r.text.encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "rows")


def test_languages_are_found_where_none_was_learnt(result, docs):
    got = result("op4_language_mixture").merge(docs, on="doc_id")
    assert [crc_fold(i, 5) == 0 for i in got.doc_id] == list(got.held_out)
    held = got[got.held_out]
    assert len(held) and (held.lang == held.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()


def test_token_counts(result, docs):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: (len(t.encode()), len(model.encode(t, add_special_tokens=False))) for i, t in zip(docs.doc_id, docs.text)}
    for r in result("op5_token_counts").itertuples():
        assert (r.n_bytes, r.n_tokens) == want[r.doc_id] and r.over_limit == (r.n_tokens > 512)


def test_toxic_documents_are_found_where_none_was_learnt(spark):
    sf = "/root/testdata/sf0.1"
    got = registry.queries()["op6_toxic_spans"](spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    assert [crc_fold(i, 3) == 1 for i in got.doc_id] == list(got.held_out)
    held = got[got.held_out]
    found = (held.predicted == 1) & (held.toxic == 1)
    assert found.sum() / (held.toxic == 1).sum() > 0.9 and found.sum() / (held.predicted == 1).sum() > 0.85


def test_benchmark_passages(result, docs):
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    want = {(i, k) for i, t in zip(docs.doc_id, docs.text) for k, item in zip(bench.item_id, bench.text) if item in t}
    assert want and set(zip(*[result("op7_benchmark_templates")[c] for c in ("doc_id", "item_id")])) == want


def test_near_duplicates(result, docs):
    own = {i: shingles(t) for i, t in zip(docs.doc_id, docs.text)}
    parent = {i: i for i in own}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def similarity(a, b):
        every = set(a) | set(b)
        return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in every) for d in set(a) & set(b))
    for a in own:
        for b in own:
            if a < b and 2 * len(own[a].keys() & own[b].keys()) > len(own[a]) and similarity(own[a], own[b]) >= 0.8:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert {r.doc_id: r.class_id for r in result("op8_near_duplicates").itertuples()} == {i: root(i) for i in own}


def removed(texts):
    """Words that stay, and how many go, per text, from all windows of 35 words at once."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[k:k + 35]) for w in words for k in range(len(w) - 34))
    out = []
    for w in words:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 34):
            if seen[tuple(w[k:k + 35])] > 1:
                gone[k:k + 35] = True
        out.append(([x for x, g in zip(w, gone) if not g], int(gone.sum()), len(w)))
    return out


def test_repeated_substrings(result, docs):
    want = {i: (n, gone, hashlib.sha256(" ".join(kept).encode()).hexdigest())
            for i, (kept, gone, n) in zip(docs.doc_id, removed(docs.text))}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in result("op9_repeated_substrings").itertuples()}
    assert got == want and sum(gone for _, gone, _ in want.values())


def test_sql_of_repeated_substrings(spark):
    connection = compare.connect(SF)
    for name, sql in registry.oracle_sql().items():
        assert compare.sql_rows(connection, sql) == compare.spark_rows(registry.queries()[name](spark, SF))


def check_packing(got, texts):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert set(got.doc_id) == set(texts)
    for doc_id, part in got.groupby("doc_id"):
        ids, at = [*model.encode(texts[doc_id], add_special_tokens=False).ids, 2], 0
        for r in part.sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for _, part in got.groupby("sequence_id"):
        part = part.sort_values("offset")
        assert list(part.offset) == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= 4096
    assert got.length.sum() / (4096 * got.sequence_id.nunique()) > 0.97


def test_packing(result, docs):
    check_packing(result("op10_pack_sequences"), dict(zip(docs.doc_id, docs.text)))


def test_pipeline_equals_its_stages_by_brute_force(spark, result, docs):
    first = set(result("op8_near_duplicates").class_id)  # every document here has a letter
    left = docs[docs.doc_id.isin(first)]
    cut = [" ".join(kept) if gone else text for text, (kept, gone, _) in zip(left.text, removed(left.text))]
    bench = list(pd.read_parquet(f"{SF}/benchmark.parquet").text)
    texts = {i: t for i, t in zip(left.doc_id, cut) if not any(" ".join(b.split()) in " ".join(t.split()) for b in bench)}
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert len(corpus_pipeline.STAGES) == 5
    check_packing(got, texts)


def test_automaton_on_a_longer_window():
    words = [str(k) for k in range(60)]
    other = ["x", *words[10:50], "y"]
    assert repeated_windows([(words, 1), (other, 1)], 35) == [0b111111 << 10, 0b111111 << 1]
