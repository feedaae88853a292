"""Token ids, pieces and sequences."""

import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from seriesforge.llm import packing as P
from seriesforge.llm.common import read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.public_tokenizer())


def check(rows, out, tokenizer, capacity=2048):
    """Every contract of pieces and sequences; returns the number of sequences."""
    want = []
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want += [(doc, k, lo, len(ids[lo:lo + capacity]), zlib.crc32(np.array(ids[lo:lo + capacity], "<u4").tobytes())) for k, lo in enumerate(range(0, len(ids), capacity))]
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=key) == sorted(want, key=key)
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_documents(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    out = P.op9_best_fit_packing(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = out.collect()
    n = check(rows, got, tokenizer)
    assert n <= 1.005 * sum(r.length for r in got) / 2048 + 1  # no packing has fewer than the quotient


def test_hard_texts(docs_of, tokenizer):
    rng = random.Random(4)
    odd = ["a.", "a..", "É.", "é.", "×.", "÷,", "J̌ ǰ", "<|endoftext|>", "<|ENDOFTEXT|> x", "x<|endoftext|>.", "don't. DON'T, we'll", "Σίσυφος. ΣΣ", "İI ıi.", "a b c\x85d", "\x1c\x1d x",
           "日本語、テスト。", "👩‍👩‍👧 ok.", "...a.", "1.2,3.", "ﬁ.", "ﬃ, Ä.", "́", " ́x", "a\x00b"]
    rows = [(i, t) for i, t in enumerate(odd)] + [(50, None), (51, ""), (52, " \n"), (53, "word " * 9000), (54, " ".join(odd * 30)), (None, "same"), (7, "same"), (7, "same")]
    rows += [(100 + i, " ".join(rng.choice(odd) for _ in range(rng.randrange(400)))) for i in range(60)]
    check(rows, P.pack(P.token_pieces(docs_of(rows), P.public_tokenizer())).collect(), tokenizer)


def test_sequences_hold_the_ids(docs_of, tokenizer):
    rows = [(i, f"text {i} " * (i * 40)) for i in range(30)]
    packed = P.pack(P.token_pieces(docs_of(rows), P.public_tokenizer(), with_ids=True))
    whole = {r.sequence_id: r.ids for r in P.sequences(packed).collect()}
    for r in packed.collect():
        ids = tokenizer.encode(dict(rows)[r.doc_id], add_special_tokens=False).ids + [0]
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == ids[r.start:r.start + r.length]


def test_empty_table(docs_of):
    assert P.pack(P.token_pieces(docs_of([]), P.public_tokenizer())).collect() == []


def best_fit_decreasing(lengths, capacity):
    free = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= x]
        if fits:
            free[min(fits, key=free.__getitem__)] -= x
        else:
            free.append(capacity - x)
    return len(free)


def fill(plan, capacity):
    bins = defaultdict(list)
    ranks = defaultdict(set)
    for length, first, n, each, sequence, offset in plan.runs:
        for i in range(n):
            bins[sequence + i // each].append((offset + i % each * length, length))
            assert first + i not in ranks[length]
            ranks[length].add(first + i)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return bins, {x: len(r) for x, r in ranks.items()}


def optimum(lengths, capacity):
    """Fewest sequences, by search over the states of all bins."""
    from functools import lru_cache

    @lru_cache(None)
    def go(rest):
        if not rest:
            return 0
        best = len(rest)
        first, others = rest[0], rest[1:]
        subsets = {()}
        for i in range(len(others)):
            for s in list(subsets):
                if first + sum(others[j] for j in s) + others[i] <= capacity:
                    subsets.add(s + (i,))
        for s in subsets:
            best = min(best, 1 + go(tuple(x for j, x in enumerate(others) if j not in s)))
        return best

    return go(tuple(sorted(lengths, reverse=True)))


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_complete_and_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([20, 100, 512])
    lengths = [rng.choice([rng.randint(1, capacity), rng.randint(1, capacity // 4), capacity // 3 + 1, 7]) for _ in range(rng.randrange(1, 2000))]
    counts = {x: lengths.count(x) for x in set(lengths)}
    plan = P.Plan(counts, capacity)
    bins, placed = fill(plan, capacity)
    assert placed == counts and len(bins) == plan.sequences
    assert plan.sequences <= best_fit_decreasing(lengths, capacity)


@pytest.mark.parametrize("seed", range(30))
def test_reduction_keeps_the_optimum(seed):
    """What the reduction fixes, and the best packing of what it leaves, is optimal."""
    rng = random.Random(seed)
    lengths = [rng.randint(1, 20) for _ in range(9)]
    plan = P.Plan.__new__(P.Plan)
    plan.capacity, plan.left, plan.used, plan.sequences, plan.runs, plan.fixed = 20, [0] * 22, [0] * 22, 0, [], 0
    for x in lengths:
        plan.left[x] += 1
    plan._reduce()
    rest = [x for x in range(21) for _ in range(plan.left[x])]
    assert plan.sequences + optimum(rest, 20) == optimum(lengths, 20)


def test_rows_equal_in_every_column_are_dealt_apart(spark):
    pieces = spark.range(0, 6000, 1, 7).selectExpr("cast(null as bigint) as doc_id", "0 as piece", "0L as start", "700L as length", "5L as ids_crc32")
    packed = P.pack(pieces)
    rows = packed.collect()
    assert packed.columns == [*pieces.columns, "sequence_id", "offset"] and len(rows) == 6000
    assert len({(r.sequence_id, r.offset) for r in rows}) == 6000 and len({r.sequence_id for r in rows}) == 3000
    assert "xxhash64(_row" in packed._jdf.queryExecution().executedPlan().toString()


def test_words_are_learned_once_and_found_again(tokenizer, monkeypatch):
    """Over several growths of the table, in one thread, and after it was emptied."""
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    rng = random.Random(8)
    made = P.WordIds(P.public_tokenizer(), 0)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    syllables = ["ab", "É", "ño", "ß", "x1", "##", "ü", "tion", "ÿ", "'s"]
    texts = ["  ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 9))) for _ in range(9000)) + " Σ, <x>." for _ in range(9)]
    encoded, learn = [], made._encoded
    monkeypatch.setattr(made, "_encoded", lambda words, plain: encoded.append(len(words)) or learn(words, plain))
    for again in (False, True):
        for text in texts:
            data = np.frombuffer(text.encode(), np.uint8)
            ids, at = made.encode(data, np.array([0, len(data)]))
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0] and at.tolist() == [0, len(ids)]
        assert len(encoded) == 9 and sum(encoded) == made.known == np.count_nonzero(made.keys) and 2 * made.known <= len(made.keys) > 1 << 16
    monkeypatch.setattr(P, "CACHED_WORDS", 100)
    ids, _ = made.encode(data, np.array([0, len(data)]))
    assert ids.tolist() == tokenizer.encode(texts[-1], add_special_tokens=False).ids + [0] and made.known < sum(encoded)
