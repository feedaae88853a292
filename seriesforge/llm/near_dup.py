"""MinHash near-duplicate detection with fast similarity sketches (operator 5).

Every document becomes the set of its distinct five-word shingles. A sketch of
``T`` coordinates is filled by rounds of hashed bin placement: in round i every
shingle falls into one bin and offers the value (i, hash) there, and a bin keeps
the smallest. Rounds T..2T-1 place every shingle into bin i - T, so after 2T
rounds at the latest every coordinate is filled, usually after the first one.
Coordinates of two sets agree with the probability of their Jaccard similarity,
with the concentration of independent ones. Bands of ``ROWS`` coordinates
propose candidates, and a link counts only after both full sets were compared.

Work on a group of copies of any size:

* documents with equal sets are collapsed first (one aggregation with map-side
  combination); all that follows sees each set once;
* inside a bucket all members are compared with one pivot, the member that
  shares most buckets, and after that only what is not yet connected;
* what is still apart inside a bucket is compared exactly in blocks: the members
  outside the bucket's largest component against all blocks of the bucket.
  Rows are blocks of at most about ``BLOCK`` sets; pairs exist only as matrix
  cells inside a task. No candidate is dropped or capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.llm import bytesplit as B
from seriesforge.llm.common import batches_of, drop_stored, hidden, read_table, release, stored, utf8
from seriesforge.llm.components import components

T = 130  # coordinates of a sketch
ROWS = 5  # coordinates in a band: at similarity 0.85 all 26 bands miss with probability 2.4e-7
SHINGLE = 5
PERCENT = 85
BLOCK = 64
PAIRS = 32  # pairs of blocks in a batch
U64 = np.uint64
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
SALTS = B.mix(np.arange(2 * T, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(0x632BE59BD9B4E019))


def sketches(values: np.ndarray, bounds: np.ndarray, t: int = T) -> np.ndarray:
    """Fast similarity sketch of each of several sets of 64-bit hashes, a row
    each; the row of an empty set stays ``EMPTY``."""
    size = np.diff(bounds)
    out = np.full((len(size), t), EMPTY)
    flat = out.ravel()
    items, row = values, np.repeat(np.arange(len(size)), size)
    for i in range(2 * t):
        if not len(items):
            break
        h = B.mix(items ^ SALTS[i])
        # from round t on the bin is the round's own
        bins = ((h >> U64(40)) * U64(t) >> U64(24)).astype(np.int64) if i < t else i - t
        np.minimum.at(flat, row * t + bins, U64(i << 40) | (h & U64((1 << 40) - 1)))
        open_ = (out == EMPTY).any(axis=1)[row]
        items, row = items[open_], row[open_]
    return out


def band_keys(sketches_: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of each sketch (a row); the band's number is part of it."""
    table = sketches_.reshape(len(sketches_), sketches_.shape[1] // rows, rows)
    key = np.broadcast_to(np.arange(1, table.shape[1] + 1, dtype=U64) * U64(0xD6E8FEB86659FD93), table.shape[:2])
    for j in range(rows):
        key = B.mix(key ^ table[:, :, j])
    return key


def digests(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """128-bit digest of each set: two sums of mixed members. Sets of equal digest
    count as equal."""
    sums = []
    for salt in (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3):
        total = np.zeros(len(values) + 1, U64)
        np.cumsum(B.mix(values ^ U64(salt)), out=total[1:])
        sums.append(B.mix((total[bounds[1:]] - total[bounds[:-1]]) ^ np.diff(bounds).astype(U64)))
    packed = np.stack(sums, axis=1).tobytes()
    return [packed[i:i + 16] for i in range(0, len(packed), 16)]


def _lists(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(np.ascontiguousarray(flat).view(np.int64)))


def _sketched(keep: int, t: int = T, rows: int = ROWS, fewest_words: int = 1, empty: bool = True) -> callable:
    """Keeps the first ``keep`` columns; the next one is the text. A text of fewer
    than ``fewest_words`` words has no set; with ``empty`` it has a row all the same."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, off in B.blocks(batch.column(keep)):
                values, bounds = B.shingle_sets(data, off, SHINGLE, fewest_words)
                rest, full = batch.slice(at, len(off) - 1), np.diff(bounds) > 0
                ids = digests(values, bounds)
                if not empty:
                    rest, ids = rest.filter(pa.array(full)), [d for d, f in zip(ids, full.tolist()) if f]
                    bounds = np.append(bounds[:-1][full], bounds[-1])
                    full = np.ones(len(ids), bool)
                keys = band_keys(sketches(values, bounds, t)[full], rows)
                places = np.concatenate(([0], np.cumsum(full))) * (t // rows)
                yield pa.RecordBatch.from_arrays(
                    [*(rest.column(i) for i in range(keep)), pa.array(np.diff(bounds).astype(np.int64)),
                     pa.array([d if f else None for d, f in zip(ids, full.tolist())], pa.binary()), _lists(keys.ravel(), places)],
                    names=[*rest.schema.names[:keep], "n_shingles", "set_id", "bands"])
    return run


def _only_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, data, off in B.blocks(batch.column(1)):
            values, bounds = B.shingle_sets(data, off, SHINGLE)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(off) - 1), _lists(values, bounds)], names=["set_id", "items"])


def _block_links(percent: int) -> callable:
    """Links between the sets of two blocks that share a bucket, as matrices."""
    def matrix(items: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
        flat = np.concatenate(others)
        order = np.argsort(flat, kind="stable")
        values, owner = flat[order], np.repeat(np.arange(len(others)), [len(x) for x in others])[order]
        out = np.zeros((len(items), len(others)), np.int64)
        for i, x in enumerate(items):
            lo, hi = np.searchsorted(values, x, "left"), np.searchsorted(values, x, "right")
            n = hi - lo
            total = int(n.sum())
            if total:
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(total)
                out[i] = np.bincount(owner[at], minlength=len(others))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for row in range(batch.num_rows):
                mine, theirs = batch.column(0)[row].values, batch.column(1)[row].values
                a, b = mine.field("set_id").to_pylist(), theirs.field("set_id").to_pylist()
                ra, rb = mine.field("root").to_pylist(), theirs.field("root").to_pylist()
                xs = [np.asarray(v.values) for v in mine.field("items")]
                ys = [np.asarray(v.values) for v in theirs.field("items")]
                both = matrix(xs, ys)
                na, nb = np.array([len(x) for x in xs])[:, None], np.array([len(y) for y in ys])[None, :]
                for i, j in zip(*np.nonzero(100 * both >= percent * (na + nb - both))):
                    if ra[i] != rb[j]:
                        left.append(a[i])
                        right.append(b[j])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])
    return run


def _rooted(nodes: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``nodes`` with the root of each set_id so far (itself if it has no link)."""
    if roots is None:
        return nodes.withColumn("root", F.col("set_id"))
    named = roots.select(F.col("node").alias("set_id"), F.col("root").alias("r"))
    return nodes.join(named, "set_id", "left").withColumn("root", F.coalesce("r", "set_id")).drop("r")


def linked_sets(rows: DataFrame, sets_of: DataFrame, texts: callable, percent: int = PERCENT, pivot_rounds: int = 1) -> DataFrame:
    """(node, root) over set_ids that have a verified link.

    ``rows`` (set_id, bands) may hold a set any number of times; ``sets_of``
    (set_id, n_shingles) holds it once. ``texts`` gives (set_id, text bytes) for a
    table of wanted set_ids. Bands travel with 64 bits of the set_id; what they
    propose is looked up by them again, so equal ones only propose more."""
    spark, sid = rows.sparkSession, F.xxhash64("set_id").alias("sid")
    keyed = rows.select(sid, "bands").select("sid", F.explode("bands").alias("key"))  # one hash a row, not one a band
    buckets = keyed.groupBy("key").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo <> hi").select("key")
    buckets = stored(buckets, "nd-buckets")
    release(spark)
    found = stored(keyed.join(buckets, "key"), "nd-found")
    release(spark)
    shared = stored(found.distinct(), "nd-shared")
    drop_stored(found)
    # sets that agree in several bands share buckets: one of equal members is enough
    unlike = shared.groupBy("key").agg(F.bit_xor("sid").alias("a"), F.bit_xor(F.xxhash64("sid")).alias("b"), F.count("*").alias("members"))
    unlike = stored(unlike.groupBy("a", "b", "members").agg(F.min("key").alias("key")).select("key", "members"), "nd-unlike")
    members = shared.join(unlike, "key").join(sets_of.select(sid, "set_id", "n_shingles"), "sid").drop("sid")
    members = stored(members, "nd-members")
    drop_stored(shared)
    release(spark)
    score = stored(members.groupBy("set_id").agg(F.sum("members").alias("score")), "nd-score")
    members = stored(members.join(score, "set_id"), "nd-scored")
    sets = texts(score.select("set_id")).select("set_id", "text").mapInArrow(_only_sets, "set_id binary, items array<bigint>")
    sets = stored(sets.groupBy("set_id").agg(F.first("items").alias("items")), "nd-sets")  # a repeated row gives its set twice
    release(spark)
    close = f"100 * least(n_shingles, n) >= {percent} * greatest(n_shingles, n)"
    links, roots, apart = [], None, members.withColumn("root", F.col("set_id"))
    for turn in range(pivot_rounds):
        # the pivot: the member in most company, other members in later rounds
        rank = F.struct("score", "set_id") if turn == 0 else F.struct(F.xxhash64("set_id", F.lit(turn)).alias("score"), "set_id")
        pivots = stored(apart.groupBy("key").agg(F.max_by(F.struct("set_id", "n_shingles", "root"), rank).alias("p"))
                        .select("key", F.col("p.set_id").alias("pivot"), F.col("p.n_shingles").alias("n"), F.col("p.root").alias("pivot_root")), "nd-pivots")
        pairs = stored(apart.join(pivots, "key").where("root <> pivot_root").where(close).select("set_id", "pivot").distinct(), "nd-pairs")
        a = sets.select("set_id", F.col("items").alias("x"))
        b = sets.select(F.col("set_id").alias("pivot"), F.col("items").alias("y"))
        verified = (pairs.join(b, "pivot").join(a, "set_id")
                    .withColumn("both", F.size(F.array_intersect("x", "y")).cast("long"))
                    .where(f"100 * both >= {percent} * (size(x) + size(y) - both)"))
        links.append(stored(verified.select(F.col("set_id").alias("a"), F.col("pivot").alias("b")), "nd-links"))
        release(spark)
        roots = _all_components(links)
        apart = _still_apart(members, roots)
    # what remains apart, exactly
    # the largest component of each bucket needs no comparison inside itself
    sizes = stored(apart.groupBy("key", "root").agg(F.count("*").alias("c")), "nd-sizes")
    largest = stored(sizes.groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("m")), "nd-largest")
    dealt = (apart.select("key", "set_id", "root").join(largest, "key")
             .withColumn("block", F.pmod(F.xxhash64("set_id"), F.ceil(F.col("m") / BLOCK)).cast("long"))
             .withColumn("outside", F.col("root") != F.col("main")))
    dealt = stored(dealt.join(sets, "set_id").select("key", "block", "outside", "set_id", "root", "items"), "nd-dealt")
    release(spark)
    entry = F.collect_list(F.struct("set_id", "root", "items"))
    some = stored(dealt.where("outside").groupBy("key", "block").agg(entry.alias("some")).drop("block"), "nd-some")
    every = stored(dealt.groupBy("key", "block").agg(entry.alias("every")).drop("block"), "nd-every")
    found = some.join(every, "key").select("some", "every").mapInArrow(_block_links(percent), "a binary, b binary")
    with batches_of(spark, PAIRS):
        links.append(stored(found, "nd-links"))
    drop_stored(members, sets, dealt, some, every)
    release(spark)
    return _all_components(links)


def _all_components(links: list[DataFrame]) -> DataFrame:
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return components(out)


def _still_apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that still hold two components or more."""
    rooted = stored(_rooted(members, roots), "nd-rooted")
    mixed = stored(rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key"), "nd-mixed")
    return stored(rooted.join(mixed, "key"), "nd-apart")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash), a row for each row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Documents
    with 100 * |intersection| >= percent * |union| of their shingle sets are
    linked; component_id is the smallest doc_id reachable over links, kept tells
    whether the row has it. A text of one to four words has its whole sequence
    as its only shingle. Null or empty texts (no words) have an empty set and
    are linked with nothing. A null doc_id never names a component (a component
    of nothing else has component_id null and marks all its rows kept). Rows of equal
    doc_id that carry the component's smallest doc_id are all marked kept. text_hash is
    xxhash64 of the text's bytes.
    """
    rows = _labelled(docs, doc_id, text, percent)
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"), "text_hash")


def _labelled(docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """(doc_id, n_shingles, text_hash, component_id, root): root is the same for all
    rows of a component, of null ids too, and null for an empty set."""
    base = docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("text")).withColumn("text_hash", F.xxhash64("text")).select("doc_id", "text_hash", "text")
    kind = base.schema["doc_id"].dataType.simpleString()
    rows = stored(base.mapInArrow(_sketched(2), f"doc_id {kind}, text_hash bigint, n_shingles bigint, set_id binary, bands array<bigint>"), "nd-sketch")
    one = F.min(F.struct("doc_id", "text_hash")).alias("one")
    groups = rows.where("n_shingles > 0").groupBy("set_id").agg(one, F.min("doc_id").alias("smallest"), F.max("n_shingles").alias("n_shingles"))
    groups = stored(groups.select("set_id", "smallest", F.col("one.doc_id").alias("of_id"), F.col("one.text_hash").alias("of_hash"), "n_shingles"), "nd-groups")

    def texts(wanted: DataFrame) -> DataFrame:
        of = groups.select("set_id", "of_id", "of_hash").join(wanted, "set_id", "left_semi")
        return base.join(of, F.expr("text_hash = of_hash and doc_id <=> of_id")).select("set_id", "text")

    roots = linked_sets(rows.select("set_id", "bands"), groups, texts, percent)
    named = stored(_rooted(groups.select("set_id", "smallest"), roots), "nd-named")
    smallest = stored(named.groupBy("root").agg(F.min("smallest").alias("component_id")), "nd-smallest")
    labels = stored(named.join(smallest, "root").select("set_id", "component_id", "root"), "nd-labels")
    return rows.select("doc_id", "n_shingles", "set_id", "text_hash").join(labels, "set_id", "left").select(
        "doc_id", "n_shingles", "text_hash", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "root")


def without_near_duplicates(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` (doc_id, text, ...) for each component, all its columns: of
    the smallest (doc_id, text hash), null ids last; of rows equal in both any one.
    Rows without words are in no component and all stay."""
    rows = stored(_labelled(docs, "doc_id", text, percent), "nd-labelled")
    copies = rows.where("n_shingles > 0").groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    least = copies.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n")).alias("one")).select("one.doc_id", "one.text_hash", "one.n")
    empty = rows.where("n_shingles = 0").select("doc_id", "text_hash", F.lit(1).cast("long").alias("n")).distinct()
    kept = stored(least.unionByName(empty), "nd-kept")

    def of(keys: DataFrame) -> DataFrame:
        return docs.alias("a").join(keys.alias("b"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.xxhash64(utf8(f"a.{text}")) == F.col("b.text_hash")), "left_semi")

    repeated = kept.where("n > 1")
    if repeated.isEmpty():
        return of(kept)
    mark = hidden(docs, "text_hash")
    one = of(repeated).withColumn(mark, F.xxhash64(utf8(text))).dropDuplicates(["doc_id", mark]).drop(mark)
    return of(kept.where("n = 1")).unionByName(one)


def op5_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_hash")


#: The same by a join of all shingles and a walk from every document.
ORACLE_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(g) AS n FROM t LEFT JOIN s USING (doc_id) GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.b, reach.root FROM reach JOIN l ON reach.doc_id = l.a)
SELECT n.doc_id, n.n AS n_shingles, min(root) AS component_id, min(root) = n.doc_id AS kept FROM n JOIN reach USING (doc_id) GROUP BY n.doc_id, n.n
"""
