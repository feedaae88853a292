"""Naive Bayes against a plain count of n-grams, and held-out accuracy."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesforge.llm import bytesplit as B
from seriesforge.llm import langid as L

SF = "/root/testdata/sf0.01"
TEXTS = {"en": ["The cat sat on the mat.", "Where is the house of the king?", "It was the best of times"],
         "de": ["Die Katze saß auf der Matte.", "Wo ist das Haus des Königs?", "ÄÖÜ über alles schön"],
         "ja": ["猫はマットの上に座った", "王の家はどこですか"], "": ["zzz qqq xxx"]}
ODD = [(None, None), ("", None), ("12 34 -- !", None), ("é", None), ("The the THE", None), ("Katze 5 x Haus", None), ("猫", None), ("ß", None)]


def bucket(gram):
    h = 0
    for c in gram:
        h = ((h ^ ord(c)) * 0x9FB21C651E98DF25) & (2 ** 64 - 1)
        h ^= h >> 32
    return int(B.mix(np.array([h ^ len(gram)], np.uint64))[0] >> np.uint64(64 - L.BITS))


def grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()  # the fixture has no combining marks
    plain = " " + " ".join(words) + " "
    return [bucket(plain[i:i + n]) for n in L.ORDERS for i in range(len(plain) - n + 1)] if words else []


def brute(train, texts):
    counts, n = {}, {}
    for text, label in train:
        if label is not None and text and grams(text):
            n[label] = n.get(label, 0) + 1
            for g in grams(text):
                counts.setdefault(label, {})
                counts[label][g] = counts[label].get(g, 0) + 1
    out = []
    for text in texts:
        found = grams(text or "")
        if not found or not n:
            out.append(("und", 0.0))
            continue
        logs = {}
        for label in sorted(n, key=lambda x: x.encode()):
            total = sum(counts[label].values()) + L.ALPHA * L.BUCKETS
            logs[label] = math.log(n[label] / sum(n.values())) + sum(math.log((counts[label].get(g, 0) + L.ALPHA) / total) for g in found)
        best = max(logs, key=logs.get)
        out.append((best, 1 / sum(math.exp(v - logs[best]) for v in logs.values())))
    return out


def rows():
    return [(t, label) for label, ts in TEXTS.items() for t in ts] + ODD + [("The cat sat on the mat.", "en"), (None, "en"), ("99", "de")]


@pytest.mark.parametrize("languages_a_pass", [128, 1, 3])
def test_brute_force(spark, languages_a_pass):
    data = rows()
    df = spark.createDataFrame([(i, t, la, 7, "s", "z") for i, (t, la) in enumerate(data)], "doc_id bigint, text string, lang string, body int, score string, lang_pred string").repartition(3)
    model = L.train(df)
    got = {r.doc_id: r for r in L.predict(df, model, languages_a_pass=languages_a_pass).collect()}
    want = brute(data, [t for t, _ in data])
    assert [got[i].lang_pred for i in range(len(data))] == [w for w, _ in want]
    assert all(abs(got[i].score - s) < 1e-3 for i, (_, s) in enumerate(want))
    assert got[0].body == 7 and set(got[0].asDict()) == {"doc_id", "text", "lang", "body", "lang_pred", "score"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    some = spark.createDataFrame([(1, "The cat", "en"), (None, None, None)], none.schema)
    assert [(r.lang_pred, r.score) for r in L.predict(some, L.train(none)).collect()] == [("und", 0.0)] * 2
    assert L.predict(none, L.train(some)).collect() == []
    assert {(r.lang_pred, r.score) for r in L.predict(some, L.train(some)).collect()} == {("und", 0.0), ("en", 1.0)}


def test_long_texts_count_whole(spark, monkeypatch):
    """Pieces of a long text give the n-grams of the whole, at any cut."""
    import pyarrow as pa
    text = ("Straße größer 猫は " * 400).strip()
    letter, plain = L.prepared(pa.array([text, "a", text]))
    want = np.bincount(np.concatenate([f for _, p, b, own in L._pieces(plain) for f, _ in L.buckets(p, b, own)]), minlength=L.BUCKETS)
    for size in (64, 101, 1000):
        monkeypatch.setattr(B, "BLOCK_BYTES", size)
        monkeypatch.setattr(B.blocks, "__defaults__", (size,))
        found = [f for _, p, b, own in L._pieces(plain) for f, _ in L.buckets(p, b, own)]
        assert len(found) > 3 * len(L.ORDERS) and (np.bincount(np.concatenate(found), minlength=L.BUCKETS) == want).all()


def test_held_out_accuracy(spark):
    got = L.op12_language_id(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(docs) and {r.doc_id for r in got} == set(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    some = {d: bool(re.search(r"[^\W\d_]", x.text or "")) for d, x in docs.items()}
    assert all((r.lang_pred == "und") == (not some[r.doc_id]) for r in got)
    judged = [r for r in got if r.held_out and docs[r.doc_id].lang is not None and some[r.doc_id]]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in judged)
    assert len(judged) > 150 and right / len(judged) > 0.95, (right, len(judged))


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    other = docs.withColumn("lang", F.when(L.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, L.train(d.where(~L.held_out())).collect())) for d in (docs, other))
    assert a == b and "xx" not in {r[0] for r in a}
