"""Merkle manifest against plain trees built in Python, and against SQL."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from seriesforge.llm import merkle as M

SF = "/root/testdata/sf0.001"
KINDS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, pos int"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(level):
    """Per node of ``level`` its steps (left sibling or None, right sibling or None); and the root."""
    steps, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, a in enumerate(at):
            pair = level[a // 2 * 2:a // 2 * 2 + 2]
            steps[i].append((pair[:a % 2], pair[a % 2 + 1:]))
        level = [sha("".join(level[j:j + 2])) for j in range(0, len(level), 2)]
        at = [a // 2 for a in at]
    return steps, level[0] if level else None


def brute(rows):
    trees = {}
    for doc_id, text, lang, source, n_chars in rows:
        trees.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf(doc_id, text, lang, source, n_chars), (doc_id, text, lang, source, n_chars)))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    inner = {x: climb([r[2] for r in sorted(trees[x])]) for x in names}
    outer, root = climb([inner[x][1] for x in names])
    out = []
    for x, above in zip(names, outer):
        for (_, _, h, (doc_id, text, lang, source, n)), steps in zip(sorted(trees[x], key=lambda r: r[:3]), inner[x][0]):
            steps = steps + above
            got = h
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
                got = leaf(doc_id, text, lang, source, None if n is None else n + 1)
            for before, after in steps:
                got = sha("".join([*before, got, *after]))
            out.append((doc_id, h, inner[x][1], root, sha("".join(y for b, a in steps for y in b + a)), got, got == root))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(spark, rows, levels):
    df = spark.createDataFrame([(i, t, la, s, n, "x", 1) for i, t, la, s, n in rows], KINDS).repartition(3)
    plain = [F.col(c) for c in M.FIELDS]
    more = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in M.FIELDS]
    return M.manifest(df, M.leaf_hash(plain), presented=F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, M.leaf_hash(more)), levels=levels)


def rows_of(n, langs):
    return [(i * 3 + (1 << 60) * (i % 2), f"text {i} é" if i % 11 else None, langs[i % len(langs)], "s" if i % 5 else None, i if i % 4 else None) for i in range(n)]


@pytest.mark.parametrize("rows, levels", [
    (rows_of(150, ["en"]), 2),  # one tree, several rounds of superblocks
    (rows_of(90, ["en", "de", None, "", "é", "z"]), 1),  # trees in a tree of trees
    (rows_of(33, ["en"] * 9 + ["de", None]) + [(None, "t", "en", None, 1)] * 5 + [(7, "t", "en", None, 1)] * 4 + [(None, None, None, None, None)] * 3, 2),
    (rows_of(1, ["en"]), 12),
    (rows_of(40, [f"l{i}" for i in range(40)]), 2),  # lone leaves
    (rows_of(64, ["en"]), 3),
])
def test_brute_force(spark, rows, levels):
    got = result(made(spark, rows, levels))
    assert got == brute(rows)
    assert {r[6] for r in got} <= {True, False} and all(r[2] is not None for r in got)


def test_superblock_size_does_not_matter(spark):
    rows = rows_of(77, ["en", "de"])
    assert result(made(spark, rows, 1)) == result(made(spark, rows, 3)) == result(made(spark, rows, 12))


def test_tampering_is_found(spark):
    rows = [(i, "t", "en", "s", None if i % 2 else i) for i in range(300)]
    for r in made(spark, rows, 4).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0 or r.doc_id % 2 == 1)


def test_empty(spark):
    df = made(spark, [], 2)
    assert df.collect() == [] and df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_long_text_and_other_keys(spark):
    df = spark.createDataFrame([("b", "x" * 3_000_000), ("a", "y"), (None, "y")], "id string, body string").withColumn("g", F.lit(5))
    got = {r.id: r for r in M.manifest(df, M.leaf_hash([F.col("id"), F.col("body")]), tree="g", key="id", levels=1).collect()}
    h = {"b": sha("1:b3000000:" + "x" * 3_000_000), "a": sha("1:a1:y"), None: sha("-1:y")}
    assert {k: r.leaf for k, r in got.items()} == h
    assert {r.root for r in got.values()} == {sha(sha(h[None] + h["a"]) + sha(h["b"]))} and all(r.verified for r in got.values())


def test_sql(spark):
    from oracle_harness import compare
    assert compare(spark, "op11", M.op11_merkle_manifest, M.ORACLE_SQL, SF) == []


def test_no_window_or_task_over_a_tree(spark):
    plan = M.op11_merkle_manifest(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "SinglePartition" not in plan and "CartesianProduct" not in plan
