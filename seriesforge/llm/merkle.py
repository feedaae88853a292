"""Merkle manifest of a table by cogrouped subtree exchange (operator 11).

Every row is a leaf, the sha256 of its fields. The leaves of a tree (one for each
value of a column) are put in order by range partitions and counts, so that every
leaf knows its place without a window over the tree. ``2**LEVELS`` leaves in a row
are a superblock. Superblocks are reduced to one node each; these nodes are the
leaves of a smaller tree, which is treated in the same way, until a tree is one
node. On the way back the nodes of a superblock are cogrouped with the one row of
outer nodes on its path (the siblings above it, and the roots), and
``applyInPandas`` finishes there: it reduces the superblock again, joins each
leaf's inner siblings to the outer ones, hashes the proof and folds the presented
leaf up to the root.

A task holds superblocks, one after the other, whatever the size of a tree: a
tree with a third of all rows, or with all of them, is as many superblocks as it
takes. The shuffles carry hashes and keys, never texts.

Rows that are equal in tree, key and leaf are leaves of their own, side by side;
null keys come first in their tree, the null tree is the first tree. An empty
table gives an empty manifest. Columns that are not asked for do not matter.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesforge.llm.common import read_table, stored

LEVELS = 12  # a superblock is 4096 nodes
MOST_STARTS = 200_000  # rows (range partitions and trees) that may be broadcast
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(fields: list[Column]) -> Column:
    """sha256 over the fields: ``-`` for null, else byte count, ``:`` and the value."""
    def said(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*map(said, fields)).cast("binary"), 256)


def parents(nodes: list[str]) -> list[str]:
    return [digest(nodes[i] + nodes[i + 1] if i + 1 < len(nodes) else nodes[i]) for i in range(0, len(nodes), 2)]


def reduced(nodes: list[str], whole: bool, levels: int) -> list[list[str]]:
    """The levels of a superblock from its nodes up to its one top node. A block
    that is the whole tree ends where one node is left, any other after ``levels``."""
    out = [nodes]
    while len(out[-1]) > 1 if whole else len(out) <= levels:
        out.append(parents(out[-1]))
    return out


def siblings(table: list[list[str]], i: int) -> list[str]:
    """For each level below the top what node i's ancestor is hashed with: ``<``
    and the left sibling, ``>`` and the right one, or '' for none."""
    out = []
    for level in table[:-1]:
        j = i ^ 1
        out.append("" if j >= len(level) else ("<" if j < i else ">") + level[j])
        i >>= 1
    return out


def fold(leaf: str, path: list[str]) -> str:
    for step in path:
        leaf = digest(step[1:] + leaf if step[:1] == "<" else leaf + step[1:])
    return leaf


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, ...) with pos, the place from 0 inside the tree in the given
    order, and size, the tree's rows. The order must be total. Range partitions are
    sorted, and what lies before a partition in its tree is added."""
    by = ["tree", *order]
    sorted_ = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("id", F.monotonically_increasing_id())
    sorted_ = stored(sorted_.withColumn("part", F.shiftright("id", 33)).withColumn("nth", F.expr("id & 8589934591L")).drop("id"), "merkle-order")
    counts = sorted_.groupBy("tree", "part").agg(F.min("nth").alias("first"), F.count("*").alias("n"))
    one = Window.partitionBy("tree")  # a row for each range partition that the tree has rows in
    before = F.sum("n").over(one.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = stored(counts.select("tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(one).alias("size")), "merkle-starts")
    if starts.count() <= MOST_STARTS:
        starts = F.broadcast(starts)
    return sorted_.join(starts, ["tree", "part"]).withColumn("pos", F.col("nth") + F.col("shift")).drop("part", "nth", "shift")


def _tops(levels: int) -> callable:
    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        size = int(block["size"].iat[0])
        top = reduced(block["h"].tolist(), size <= 1 << levels, levels)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "size": [-(-size >> levels)], "h": [top]})
    return run


def _paths(levels: int) -> callable:
    """The way from each node of a superblock to the root."""
    def run(key: tuple, block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        table = reduced(block["h"].tolist(), int(block["size"].iat[0]) <= 1 << levels, levels)
        above = list(outer["path"].iat[0])
        return pd.DataFrame({"tree": key[0], "pos": block["pos"], "path": [siblings(table, i) + above for i in range(len(block))],
                             "subroot": outer["subroot"].iat[0], "root": outer["root"].iat[0]})
    return run


def _proofs(levels: int) -> callable:
    """What the manifest says of each leaf of a superblock."""
    def run(key: tuple, block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        leaves = block["h"].tolist()
        table = reduced(leaves, int(block["size"].iat[0]) <= 1 << levels, levels)
        above = list(outer["path"].iat[0])
        proofs, folded = [], []
        for i, (leaf, presented) in enumerate(zip(leaves, block["presented"])):
            path = siblings(table, i) + above
            proofs.append(digest("".join(step[1:] for step in path)))
            folded.append(fold(presented or leaf, path))
        return pd.DataFrame({"key": block["key"], "leaf": leaves, "subroot": outer["subroot"].iat[0], "root": outer["root"].iat[0],
                             "proof_sha256": proofs, "folded_root": folded})
    return run


def _blocked(nodes: DataFrame, levels: int):
    return nodes.withColumn("block", F.shiftright("pos", levels)).groupBy("tree", "block")


def _outer(nodes: DataFrame, levels: int, top: callable) -> DataFrame:
    """(tree, pos, path, subroot, root) of the superblocks of ``nodes`` (tree, pos,
    size, h), pos being the superblock's number. ``top`` says it of whole trees."""
    tops = _blocked(nodes.select("tree", "pos", "size", "h"), levels).applyInPandas(_tops(levels), "tree string, pos bigint, size bigint, h string")
    tops = stored(tops, "merkle-tops")
    if (tops.agg(F.max("size").alias("n")).first()["n"] or 1) == 1:
        return top(tops)
    above = _outer(tops, levels, top)
    return stored(_exchanged(tops, above, levels, _paths, "tree string, pos bigint, path array<string>, subroot string, root string"), "merkle-outer")


def _exchanged(nodes: DataFrame, outer: DataFrame, levels: int, what: callable, schema: str) -> DataFrame:
    return _blocked(nodes, levels).cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInPandas(what(levels), schema)


def _lone(tops: DataFrame) -> DataFrame:
    return tops.select("tree", "pos", F.expr("cast(array() as array<string>)").alias("path"), F.col("h").alias("subroot"), F.col("h").alias("root"))


def _joined(levels: int) -> callable:
    """Subroots in the order of their trees are the leaves of the last tree."""
    def top(subroots: DataFrame) -> DataFrame:
        nodes = stored(positions(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "h"), ["name"]), "merkle-subroots")
        way = _exchanged(nodes, _outer(nodes, levels, _lone), levels, _paths, "tree string, pos bigint, path array<string>, subroot string, root string")
        way = nodes.select("pos", F.col("name").alias("tree"), F.col("h").alias("subroot")).join(way.select("pos", "path", "root"), "pos")
        return stored(way.select("tree", F.lit(0).cast("bigint").alias("pos"), "path", "subroot", "root"), "merkle-top")
    return top


def manifest(rows: DataFrame, leaf: Column, tree: str = "lang", key: str = "doc_id", presented: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """A row for each row of ``rows``: the key, leaf, subroot (of the row's tree),
    root, proof_sha256 (the siblings on the way to the root, one after the other),
    folded_root and verified. The leaves of a tree ascend by ``key``, then by
    themselves; trees ascend by their name's bytes. Two nodes in a row become their
    hash, a last one alone the hash of itself; a tree of one leaf is that leaf.
    ``presented`` is the leaf that a holder of the row computes, null for the
    same: folded_root folds it with the row's siblings and verified says whether
    the root came out."""
    # null before every name, '' included, and distinct from it
    name = F.coalesce(F.concat(F.lit("+"), F.col(f"`{tree}`").cast("string")), F.lit(""))
    given = F.lit(None).cast("string") if presented is None else presented
    leaves = rows.select(name.alias("tree"), F.col(f"`{key}`").alias("key"), leaf.alias("h"), given.alias("presented"))
    leaves = stored(leaves.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    kind = leaves.schema["key"].dataType
    # as text: pandas would make floats of integers beside nulls
    placed = stored(positions(leaves, ["key", "h", "row"]).withColumn("key", F.col("key").cast("string")).drop("row"), "merkle-placed")
    outer = _outer(placed, levels, _joined(levels))
    proved = _exchanged(placed, outer, levels, _proofs, "key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return proved.select(F.col("key").cast(kind).alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of documents, a tree for each lang; where 7 divides the crc32 of
    the doc_id the presented row says one character more."""
    docs = read_table(spark, sf_dir, "documents")
    plain = [F.col(c) for c in FIELDS]
    more = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    return manifest(docs, leaf_hash(plain), presented=F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf_hash(more)))


#: Level by level in recursive queries; crc32 bit by bit.
ORACLE_SQL = r"""
WITH RECURSIVE
said AS (
  SELECT *, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::BIGINT),
      lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN crc % 7 = 0 THEN sha256(head || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || tail) END AS tampered
  FROM said),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
nodes AS (
  SELECT lang, 0 AS lvl, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
subroots AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 2, n),
inner_steps AS (
  SELECT l.lang, l.pos, s.lvl, coalesce((CASE WHEN o.pos < s.pos THEN '<' ELSE '>' END) || o.h, '') AS step
  FROM leaves l JOIN nodes s ON l.lang IS NOT DISTINCT FROM s.lang AND s.pos = l.pos >> s.lvl AND s.n > 1
  LEFT JOIN nodes o ON o.lang IS NOT DISTINCT FROM s.lang AND o.lvl = s.lvl AND o.pos = xor(s.pos, 1)),
inner_paths AS (SELECT lang, pos, list(step ORDER BY lvl) AS path FROM inner_steps GROUP BY lang, pos),
outer_steps AS (
  SELECT r.lang, s.lvl, coalesce((CASE WHEN o.pos < s.pos THEN '<' ELSE '>' END) || o.h, '') AS step
  FROM subroots r JOIN tops s ON s.pos = r.pos >> s.lvl AND s.n > 1
  LEFT JOIN tops o ON o.lvl = s.lvl AND o.pos = xor(s.pos, 1)),
outer_paths AS (SELECT lang, list(step ORDER BY lvl) AS path FROM outer_steps GROUP BY lang),
proved AS (
  SELECT l.doc_id, l.leaf, l.tampered, r.subroot, (SELECT h FROM tops WHERE n = 1) AS root, coalesce(i.path, []) || coalesce(u.path, []) AS path
  FROM leaves l JOIN subroots r ON l.lang IS NOT DISTINCT FROM r.lang
  LEFT JOIN inner_paths i ON i.lang IS NOT DISTINCT FROM l.lang AND i.pos = l.pos
  LEFT JOIN outer_paths u ON u.lang IS NOT DISTINCT FROM l.lang),
folded AS (
  SELECT doc_id, leaf, subroot, root, sha256(coalesce(list_aggregate(list_transform(path, lambda s: s[2:]), 'string_agg', ''), '')) AS proof_sha256,
    list_reduce([coalesce(tampered, leaf)] || path, lambda a, s: sha256(CASE WHEN s[1] = '<' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root
  FROM proved)
SELECT *, folded_root = root AS verified FROM folded
"""
