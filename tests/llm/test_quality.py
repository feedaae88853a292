"""Base rules against plain Python, the classifier on held-out labels."""

import random
import re

import numpy as np
import pytest

from seriesforge.llm import bytesplit as B
from seriesforge.llm import quality as Q
from seriesforge.llm.common import read_table

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count = {g: grams.count(g) for g in set(grams)} if len(grams) < 300 else __import__("collections").Counter(grams)
    repeated = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 20 or 100 * len(repeated) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_documents(spark):
    rows = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    out = Q.op1_quality_rules(spark, SF)
    assert out.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert counts(r) == brute(rows[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept) and 0 <= r.probability <= 1


def test_held_out_accuracy(spark):
    """Trained on half of the labelled documents, right on the other half."""
    sf = "/root/testdata/sf0.1"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    model = Q.train(docs, labels.where("doc_id % 2 = 0"), sample=400)
    out = Q.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = [r for r in out if r.quality == 1], [r for r in out if r.quality == 0]
    assert np.mean([r.probability >= Q.KEEP_AT for r in good]) > 0.97
    assert np.mean([not r.kept for r in bad]) > 0.9
    # calibrated: the mean probability is near the share of good documents
    assert abs(np.mean([r.probability for r in out]) - len(good) / len(out)) < 0.05


def test_edge_cases(docs_of):
    rng = random.Random(6)
    line = " ".join(f"w{i}" for i in range(9))
    texts = [None, "", " \n\t", "one", "a\n\na\na \n b\nb", line + "\n" + line, f"{line} {line} {line}", "é#*" * 50, " ".join("xyz"[rng.randrange(3)] for _ in range(500)), "a " * 50_000, "    x\x85y", "\n" * 40 + "z", line]
    out = {r.doc_id: r for r in Q.score(docs_of(texts), None).collect()}
    for i, t in enumerate(texts):
        assert counts(out[i]) == brute(t), t
        assert out[i].probability is None and out[i].kept == (not out[i].base_failed)
    assert Q.score(docs_of([]), None).collect() == []


def test_repeated_rows_and_null_ids(docs_of):
    out = Q.score(docs_of([(None, "a b"), (1, "c"), (1, "c")]), None).collect()
    assert sorted(str(r.doc_id) for r in out) == ["1", "1", "None"]


def test_one_class_gives_no_model(spark, docs_of):
    labels = spark.createDataFrame([(0, 1, 0), (None, 0, 0), (1, None, 0)], "doc_id bigint, quality int, toxic int")
    assert Q.train(docs_of(["text one", "two"]), labels) is None


@pytest.mark.parametrize("texts", [["", "ab cd", "é"], ["x"], ["  "], ["a b c d e f", "日本 語"]])
def test_margins_equal_features(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    weights = np.random.default_rng(0).normal(size=2 << Q.BITS)
    made = Q.features(data, off)
    assert np.allclose(Q.margins(data, off, weights), [weights[i] @ v for i, v in made])
    assert all((np.diff(i) > 0).all() for i, _ in made) and B.blocks


def test_one_row_of_an_id_trains(spark, docs_of, monkeypatch):
    """A doc_id on very many rows is one row of the sample, and always the same."""
    good, bad = "plain words in a calm sentence that says a thing well " * 3, "$$$ buy *** now |||| click <<< " * 5
    rows = [(i, f"{good} {i}") for i in range(12)] + [(100 + i, f"{bad} {i}") for i in range(12)] + [(3, f"{good} copy {i}") for i in range(300)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(12)] + [(100 + i, 0, 0) for i in range(12)], "doc_id bigint, quality int, toxic int")
    seen = []
    real = Q.stored
    monkeypatch.setattr(Q, "stored", lambda df, label: seen.append((label, real(df, label))) or seen[-1][1])
    a = Q.train(docs_of(rows).repartition(5), labels)
    made = dict(seen)["quality-features"]
    assert made.count() == 24
    b = Q.train(docs_of(rows).repartition(3), labels, sample=5)
    assert dict(seen)["quality-features"].count() == 10
    again = Q.train(docs_of(rows[::-1]), labels)
    assert (a.weights == again.weights).all() and b is not None
    out = {r.doc_id: r.probability for r in Q.score(docs_of([(1, good), (2, bad)]), a).collect()}
    assert out[1] > out[2]


def test_minimum():
    """The fitted weights have no slope left: the regularised loss is at its minimum."""
    rng = np.random.default_rng(5)
    dense = rng.normal(size=(80, 6)) * (rng.random((80, 6)) < 0.5)
    label = (dense[:, 0] - dense[:, 1] + rng.normal(size=80) > 0).astype(float)
    row, index = np.nonzero(dense)
    w, b = Q.fit(row, index, dense[row, index], label, 6)
    sd = dense.std(axis=0, ddof=1)
    r = 1 / (1 + np.exp(-(dense @ w + b))) - label
    assert np.abs((dense / sd).T @ r / 80 + Q.PENALTY * w * sd).max() < 1e-3 and abs(r.mean()) < 1e-3
