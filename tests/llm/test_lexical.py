"""Ranked search against a plain scan of all documents, and against SQL."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from seriesforge.llm import bytesplit as B
from seriesforge.llm import lexical as X

SF = "/root/testdata/sf0.01"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    tf = [(doc, Counter(terms(t)), len(terms(t))) for doc, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in tf), sum(n for *_, n in tf)
    df = Counter(t for _, c, _ in tf for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c, n in tf:
            if n:
                m = 25 + 75 * n * n_docs // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
                found.append((-s, doc is None, doc or 0, doc))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(f for f in found if f[0] < 0)[:top])]
    return sorted(out, key=str)


def result(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, item int, id string").repartition(3)
    return d, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, score int")


def case(seed, n=400):
    """Words of very different frequency, copies, ties, nulls and repeated ids."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "日本", "Ab", "aB", "x9"]
    chances = [1 / (i + 1) for i in range(len(words))]
    text = lambda k: " ".join(rng.choices(words, chances, k=k))
    docs = [(i * 7 % 1000 + (1 << 55) * (i % 2), text(rng.choice([1, 3, 10, 40, 200]))) for i in range(n)]
    docs += [(5000 + i, docs[3][1]) for i in range(40)] + [(3, "w50 w51"), (3, "w50 w51"), (None, "w50 w51 w52"), (None, None), (900, None), (901, ""), (902, "-- ,;")]
    items = [(i, text(rng.choice([1, 2, 5, 12, 30]))) for i in range(25)] + [(100, docs[3][1]), (101, None), (102, ""), (103, "unseen words"), (104, "w50 w51 w52"), (104, "W50-w50"), (None, "é É ab AB")]
    return docs, items


@pytest.mark.parametrize("seed, bucket, query_bytes, first_of", [(1, 16, 8 << 20, 4), (2, 1024, 300, 16), (3, 5, 8 << 20, 1000)])
def test_brute_force(spark, seed, bucket, query_bytes, first_of):
    docs, items = case(seed)
    got = result(X.search(*tables(spark, docs, items), bucket=bucket, query_bytes=query_bytes, first_of=first_of))
    assert got == brute(docs, items) and len(got) > 150


def test_empty_and_long(spark):
    docs, items = [(1, "a b"), (2, "x " * 300_000 + "rare")], [(1, "rare a")]
    assert result(X.search(*tables(spark, docs, items))) == brute(docs, items)
    assert result(X.search(*tables(spark, [], items))) == []
    assert result(X.search(*tables(spark, docs, []))) == []
    assert result(X.search(*tables(spark, [(1, None)], [(1, None)]))) == []


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "q w"), ("a", "q w"), (None, "q w"), ("c", "e")], "name string, body string")
    got = X.search(docs, spark.createDataFrame([("i", "q")], "k string, t string"), doc_id="name", text="body", item_id="k", item_text="t")
    assert [(r.item_id, r.doc_id) for r in sorted(got.collect(), key=lambda r: r["rank"])] == [("i", "a"), ("i", "b"), ("i", None)]


def bucket_of(rng, n, n_terms, weight):
    sizes = rng.integers(1, n_terms, n)
    rows = [np.sort(rng.choice(n_terms, s, replace=False)) for s in sizes]
    import pyarrow as pa
    return X.Bucket(pa.array(range(n)), sizes, np.concatenate(rows), rng.integers(1, 1_000_000, sizes.sum()), weight)


def test_bounds_lose_nothing_and_prune():
    """Any threshold gives every document at or above it; high ones skip work."""
    rng = np.random.default_rng(7)
    weight = rng.integers(0, 20_000, 40)
    skipped = 0
    for _ in range(60):
        one = bucket_of(rng, 50, 40, weight)
        query = X.Query({int(t): int(rng.integers(1, 4)) for t in rng.choice(40, 6, replace=False)}, weight)
        docs, scores = one.search(query, 0)
        dense = np.zeros((50, 40), np.int64)
        dense[np.repeat(np.arange(50), np.diff(one.start)), one.terms] = one.impacts
        want = dense[:, query.terms] @ query.weights
        assert dict(zip(docs.tolist(), scores.tolist())) == {i: int(s) for i, s in enumerate(want) if s > 0}
        for threshold in sorted(set(want.tolist()))[::5] + [int(want.max()), int(want.max()) + 1]:
            docs, scores = one.search(query, threshold)
            assert dict(zip(docs.tolist(), scores.tolist())) == {i: int(s) for i, s in enumerate(want) if s >= max(threshold, 1)}
        skipped += not len(one.search(query, int(query.length * one.longest) + 10 ** 6)[0])
    assert skipped == 60


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(B, "word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    v = X.Vocabulary([b"aa", b"ab", b"b"])
    data = np.frombuffer(b"ab b aa ba c", np.uint8)
    starts, ends, _ = B.words(data, np.array([0, len(data)]), X.BETWEEN)
    assert v.find(data, starts, ends).tolist() == [1, 2, 0, -1, -1]


def test_sql(spark):
    from oracle_harness import compare
    assert compare(spark, "op13", X.op13_ranked_lexical_search, X.ORACLE_SQL, SF) == []
