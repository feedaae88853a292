"""Chunks of passages: one row for many passages, each passage in one chunk."""

import random

import pyarrow as pa
import pytest

from seriesforge.llm import passages as P


def chunks(texts, own):
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array([t.encode() for t in texts], pa.binary())], names=["doc_id", "doc_hash", "text"])
    units = next(P._units(iter([batch]))).column(3)
    batch = pa.RecordBatch.from_arrays([*batch.columns, units, pa.array([own] * len(texts))], names=["doc_id", "doc_hash", "text", "starts", "own"])
    return next(P._chunks(iter([batch]))).to_pylist()


@pytest.mark.parametrize("own", [True, False])
def test_a_chunk_is_one_row_and_every_passage_is_in_one(own):
    rng = random.Random(2)
    prose = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    passage = prose(70)
    texts = [prose(40) + " " + passage + " " + prose(30) + " " + passage, "same " * 200, "", "a b", passage.upper(), prose(500)]
    want = {(d, i): tuple(t.lower().split()[i:i + 50]) for d, t in enumerate(texts) for i in range(len(t.split()) - 49)}
    got = {}
    for r in chunks(texts, own):
        for i in range(r["n"]):
            assert (r["doc_id"], r["start"] + i) not in got
            got[r["doc_id"], r["start"] + i] = r["h1"] and (r["h1"][i], r["h2"][i])
    assert set(got) == set(want)
    hashed = {want[k]: h for k, h in got.items() if h}
    assert len(set(hashed.values())) == len(hashed) and all(h in (None, hashed[want[k]]) for k, h in got.items())
    again = [k for k, h in got.items() if not h]
    assert all((hashed[want[k]] and k[0] in (0, 1)) for k in again) and (len(again) >= 150 if own else not again)


def test_copies_make_few_rows():
    rng = random.Random(4)
    text = " ".join(f"w{rng.randrange(900)}" for _ in range(2000))
    rows = chunks([text, "same " * 2000], True)
    assert sum(r["n"] for r in rows) == 2 * 1951 and len(rows) < 2 * 1951 / 8 and len([r for r in rows if r["doc_id"] == 1]) == 2
