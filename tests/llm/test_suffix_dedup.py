"""Removed bytes against brute force over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np

from seriesforge.llm import suffix_dedup as S
from seriesforge.llm.common import read_table

SF = "/root/testdata/sf0.01"


def brute(rows, match=200):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(hash(t[i:i + match]) for t in texts for i in range(len(t) - match + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        reach = 0
        for i in range(len(t) - match + 1):
            if count[hash(t[i:i + match])] > 1:
                lo = max(i, reach)
                reach = i + match
                gone[lo:reach] = b"\x01" * (reach - lo)
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_documents_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    out = S.op8_suffix_dedup(spark, SF)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert result(out) == brute(rows)


def test_hard_cases(docs_of):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(60)
    rows = [(None, None), (1, ""), (2, "a" * 199), (3, "b" * 200), (4, "c" * 201), (5, "ab" * 300), (6, prose(3)),
            (7, "d" * 5000 + prose(9)), (8, prose(20000)), (9, "x"), (9, "y" * 300)]
    rows += [(20 + i, prose(30) + " " + passage + " " + prose(30)) for i in range(60)]  # one passage, sixty different edges
    rows += [(100 + i, prose(30) + " " + passage[i:] + prose(2)) for i in range(40)]  # shorter and shorter
    rows += [(200, prose(50) + passage * 3), (300, passage), (300, passage), (301, passage + "!"), (None, passage), (None, "n" * 150)]
    assert result(S.deduplicate(docs_of(rows))) == brute(rows)


def test_kept_text_and_spans(docs_of):
    shared = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(150))
    rows = [(1, "left " + shared + " right"), (2, shared + "!"), (3, "alone " * 3)]
    out = {r.doc_id: r for r in S.deduplicate(docs_of(rows)).collect()}
    assert bytes(out[1].kept_text) == b"left  right" and out[1].removed == [5, 5 + len(shared)]
    assert bytes(out[2].kept_text) == b"!" and out[3].kept_text is None and out[3].removed == []


def test_empty_table(docs_of):
    assert S.deduplicate(docs_of([])).collect() == []


def test_suffix_sort_orders_and_survives_hash_collisions(monkeypatch):
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    starts = rng.integers(0, 3900, 900)
    for broken in (False, True):
        if broken:  # every comparison of four bytes or more claims equality
            right = S.Suffixes.common
            monkeypatch.setattr(S.Suffixes, "common", lambda self, a, b: np.where((n := right(self, a, b)) >= 4, self.match, n))
        sorted_ = S.Suffixes(data, starts, np.zeros(900, np.uint64), 20)
        number = sorted_.groups()
        parts = [data[s:s + 20].tobytes() for s in starts]
        assert all((parts[i] == parts[j]) == (number[i] == number[j]) for i in range(0, 900, 7) for j in range(900))
        if not broken:
            assert [parts[i] for i in sorted_.order] == sorted(parts)


def test_texts_and_places_with_colliding_short_hashes_stay_apart(spark, docs_of, monkeypatch):
    """Places of different runs may share a hash: nothing is merged by it."""
    shared, other = "s" * 3 + "".join(chr(97 + i * 7 % 26) + str(i) for i in range(120)), "".join(chr(98 + i * 5 % 23) + str(i * 3) for i in range(120))
    rows = [(1, "a " + shared), (2, "b " + shared), (3, "c " + other), (4, "d " + other), (5, "alone " * 60), (6, "z" + "".join(str(i * i) for i in range(200)))]
    found = docs_of(rows).selectExpr("doc_id as tid", "cast(doc_id * 0 as bigint) as tid2", "doc_id as run", "doc_id as anchor", "doc_id as content")
    twin = found.withColumn("anchor", found["anchor"] % 2).withColumn("content", found["content"] % 2)
    real = S.F.xxhash64
    monkeypatch.setattr(S.F, "xxhash64", lambda *c: real(*c) % 3)
    judged = S._narrowed(twin, "test").collect()
    assert sorted(r.tid for r in judged) == [1, 2, 3, 4, 5, 6]
    monkeypatch.undo()
    assert result(S.deduplicate(docs_of(rows))) == brute(rows)
