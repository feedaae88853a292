"""Near duplicates against brute force over all pairs."""

import random
import re

import numpy as np

from seriesforge.llm import near_dup as N
from seriesforge.llm.common import read_table

SF = "/root/testdata/sf0.01"


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = {}
    for i, s in enumerate(sets):
        common = {}
        for g in s:
            for j in seen.get(g, ()):
                common[j] = common.get(j, 0) + 1
            seen.setdefault(g, []).append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return {doc: (len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows)}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_documents_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    out = N.op5_minhash_near_dup(spark, SF)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(out) == brute(rows)


def test_sql(spark):
    from oracle_harness import compare
    assert compare(spark, "op5", N.op5_minhash_near_dup, N.ORACLE_SQL, SF) == []


def test_large_group_that_straddles_the_threshold(docs_of):
    """Copies with one to four changed words: some pairs link, some don't, one bucket holds them all."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(9999)}" for _ in range(160)]
    texts = []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(160), rng.choice([1, 2, 3, 4])):
            words[at] = f"x{rng.randrange(99999)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    assert result(N.near_duplicates(docs_of(texts))) == brute(rows)


def test_edge_cases(docs_of):
    long = " ".join(f"a{i}" for i in range(60_000))
    rows = [(5, None), (6, ""), (7, " \n\t"), (1, "one two"), (2, "ONE\ttwo"), (3, "one two three"), (9, long), (8, long + " z"), (4, "a b c d e"), (10, "a b c d e"), (10, "a b c d e"), (None, "a b c d e"), (None, "only here now and then")]
    out = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(docs_of(rows)).collect()]
    want = [(5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (9, 59_996, 8, False), (8, 59_997, 8, True),
            (4, 1, 4, True), (10, 1, 4, False), (10, 1, 4, False), (None, 1, 4, False), (None, 1, None, True)]
    key = lambda r: str(r)
    assert sorted(out, key=key) == sorted(want, key=key)


def test_empty_table(docs_of):
    assert N.near_duplicates(docs_of([])).collect() == []


def one(items, t=N.T):
    return N.sketches(np.sort(items), np.array([0, len(items)]), t)[0]


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 7, 60, 500)]
    for x in sets:
        assert not (one(x) == N.EMPTY).any() and not (one(x, 30) == N.EMPTY).any()
    # together as alone, an empty set between them
    bounds = np.cumsum([0, 1, 0, 2, 7, 60, 500])
    both = N.sketches(np.concatenate(sets), bounds)
    assert (both[1] == N.EMPTY).all() and all((both[i] == one(x)).all() for i, x in zip((0, 2, 3, 4, 5), sets))
    assert len(set(N.digests(np.concatenate(sets), bounds))) == 6
    agree = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 300).astype(np.uint64)
        y = np.concatenate([x[:270], rng.integers(0, 2**63, 30).astype(np.uint64)])
        agree.append((one(x) == one(y)).mean())
    assert abs(np.mean(agree) - 270 / 330) < 0.03


def test_one_row_of_each_group_stays(docs_of):
    """Rows loaded twice, near copies under one id, copies without ids."""
    words = lambda k: " ".join(f"{k}{i}" for i in range(60))
    rows = [(1, words("a")), (1, words("a")), (1, words("a")), (2, words("a")), (3, words("b")), (3, words("b") + " end"), (4, words("b")),
            (None, words("c")), (None, words("c")), (None, words("c") + " end"), (None, words("d")), (9, words("d")), (5, None), (6, ""), (6, ""), (7, words("e"))]
    out = N.without_near_duplicates(docs_of(rows))
    assert out.columns == docs_of(rows).columns
    got = sorted((str(r.doc_id), (r.text or "")[:1]) for r in out.collect())
    assert got == [("1", "a"), ("3", "b"), ("5", ""), ("6", ""), ("6", ""), ("7", "e"), ("9", "d"), ("None", "c")]
