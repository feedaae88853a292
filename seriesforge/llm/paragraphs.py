"""Repeated paragraphs by MinHash banding (operator 2).

A paragraph is a line of a text with at least ``FEWEST_WORDS`` words. Paragraphs
are sets of five-word shingles; equal sets are one class from the start, and the
bands of short sketches propose which others to compare. Bands are tuned for
recall: with ``ROWS`` coordinates in a band, as many bands as it takes to miss
pairs at the threshold with a probability of at most ``MISS``. Colliding
paragraphs are joined and verified by exact Jaccard similarity, and clusters are
the components of the verified links. Every cluster keeps its first paragraph,
the one of the smallest (doc_id, line); the others are removed. Shorter lines
are joined with their neighbours and removed where equal words came before. In what is left,
runs of words repeated inside longer or across shorter lines are found as passages
(see ``passages``); all but the first place of each are cut. Apart from what goes,
every text is told which of its words stand in a passage of another text too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.llm import bytesplit as B
from seriesforge.llm.common import drop_stored, hashed_joins, read_table, release, stored
from seriesforge.llm.near_dup import _sketched, linked_sets
from seriesforge.llm.passages import PASSAGE, cut, repeated_and_shared, repeated_passages

FEWEST_WORDS = 10
PERCENT = 80
ROWS = 3
MISS = 1e-3


def tuned_bands(percent: int = PERCENT, rows: int = ROWS, miss: float = MISS) -> int:
    """The fewest bands that miss a pair at the threshold with at most ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each text, with the line break that ends them, and their numbers."""
    for batch in batches:
        for at, data, off in B.blocks(batch.column(2)):
            begins = np.flatnonzero(data == 10) + 1
            size = np.diff(np.searchsorted(begins, off, "right")) + 1
            owner = np.repeat(np.arange(len(size)), size)
            line = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            bounds = np.append(np.sort(np.concatenate((off[:-1], begins))), off[-1]).astype(np.int32)
            rows, texts = batch.slice(at, len(size)), pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*(rows.column(i).take(pa.array(owner)) for i in range(2)), pa.array(line.astype(np.int32)), texts], names=["doc_id", "doc_hash", "line", "text"])


def repeated_paragraphs(docs: DataFrame, percent: int = PERCENT, fewest_words: int = FEWEST_WORDS) -> DataFrame:
    """(doc_id, doc_hash, line, class_doc, class_line): every paragraph of a
    cluster of two or more, with the cluster's first paragraph. doc_hash is of the
    text; rows equal in doc_id and text stand for one document here. Null ids
    come first, so a paragraph of a document without an id is kept before others."""
    hashed = docs.where(F.octet_length("text") >= 2 * fewest_words - 1).select("doc_id", F.xxhash64("text").alias("doc_hash"), F.col("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    bands = tuned_bands(percent)
    sketched = _sketched(3, bands * ROWS, ROWS, fewest_words, False)
    rows = hashed.withColumn("text", F.col("text").cast("binary")).mapInArrow(lambda batches: sketched(_lines(batches)), f"doc_id {kind}, doc_hash bigint, line int, n_shingles bigint, set_id binary, bands array<bigint>")
    rows = stored(rows, "para-sketch")
    place = F.struct("doc_id", "line", "doc_hash")
    groups = rows.groupBy("set_id").agg(F.min(place).alias("one"), F.max(place).alias("last"), F.max("n_shingles").alias("n_shingles"))
    groups = stored(groups, "para-groups")

    def texts(wanted: DataFrame) -> DataFrame:
        of = groups.join(wanted, "set_id", "left_semi").select("set_id", F.col("one.doc_id").alias("of_id"), F.col("one.doc_hash").alias("of_hash"), F.col("one.line").alias("of_line"))
        # whole texts meet the wanted lines: rows of all lines would be many times as many
        near = hashed.join(of, F.expr("doc_hash = of_hash and doc_id <=> of_id"))
        return near.select("set_id", F.expr("cast(substring_index(substring_index(text, '\n', of_line + 1), '\n', -1) as binary)").alias("text"))

    roots = linked_sets(rows.select("set_id", "bands"), groups, texts, percent)
    # a set with one place and without a link is no cluster
    named = groups.select("set_id", "one", "last").join(roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left")
    named = named.where("root is not null or one <> last or (one.doc_id is null) <> (last.doc_id is null)").withColumn("root", F.coalesce("root", "set_id"))
    named = stored(named, "para-named")
    first = named.groupBy("root").agg(F.min("one").alias("first"), F.max("last").alias("last")).where("first <> last or (first.doc_id is null) <> (last.doc_id is null)")
    first = stored(first.drop("last"), "para-first")
    labels = stored(named.join(first, "root").select("set_id", "first"), "para-labels")
    drop_stored(groups, named, first)
    found = rows.select("doc_id", "doc_hash", "line", "set_id").join(labels, "set_id").select(
        "doc_id", "doc_hash", "line", F.col("first.doc_id").alias("class_doc"), F.col("first.line").alias("class_line"), F.col("first.doc_hash").alias("class_hash"))
    found = stored(found, "para-found")
    drop_stored(rows, labels)
    return found


def _removed(found: DataFrame) -> DataFrame:
    """Of each document the paragraphs in clusters, and of them the removed ones."""
    own = F.col("doc_id").eqNullSafe(F.col("class_doc")) & (F.col("line") == F.col("class_line")) & (F.col("doc_hash") == F.col("class_hash"))
    one = F.struct("line", "class_doc", "class_line", (~own).alias("removed"))
    return stored(found.distinct().groupBy("doc_id", "doc_hash").agg(F.array_sort(F.collect_list(one)).alias("found")), "para-removed")  # bounded by the text


def _short(fewest_words: int) -> callable:
    """Short paragraphs of each text: consecutive lines of fewer words, joined until
    they have ``fewest_words``; blank lines between them do not count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lines, words = [], [], []
            for row, text in enumerate(batch.column(2)):
                at, have = [], []
                for i, line in enumerate([*text.as_py().split(b"\n"), None]):
                    # more pieces than this is a longer line, which ends the paragraph
                    w = line.split(None, fewest_words) if line is not None else []
                    long = line is None or len(w) >= fewest_words
                    if w and not long:
                        at.append(i)
                        have += w
                    if at and (long or len(have) >= fewest_words):
                        rows.append(row)
                        lines.append(at)
                        words.append(b" ".join(have).lower())
                        at, have = [], []
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(rows, pa.int64())) for i in range(2)), pa.array(lines, pa.list_(pa.int32())), pa.array(words, pa.binary())],
                                             names=["doc_id", "doc_hash", "lines", "words"])
    return run


def _short_removed(docs: DataFrame, fewest_words: int) -> DataFrame:
    """(d, h, short): of each document the lines of the short paragraphs whose words
    have their first place elsewhere."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.where(F.octet_length("text") > 0).select("doc_id", F.xxhash64("text").alias("doc_hash"), F.col("text").cast("binary").alias("text"))
    rows = stored(texts.mapInArrow(_short(fewest_words), f"doc_id {kind}, doc_hash bigint, lines array<int>, words binary"), "para-short")
    place = F.struct("doc_id", F.get("lines", F.lit(0)).alias("line"), "doc_hash")
    first = stored(rows.groupBy("words").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("not (first <=> last)").drop("last"), "para-short-first")
    later = rows.join(first, "words").where(~place.eqNullSafe(F.col("first")))
    gone = later.groupBy("doc_id", "doc_hash").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("lines")))).alias("short"))  # bounded by the text
    out = stored(gone.withColumnsRenamed({"doc_id": "d", "doc_hash": "h"}), "para-short-removed")
    drop_stored(rows, first)
    return out


def _gone(found: DataFrame) -> DataFrame:
    """(d, h, gone): the lines of the removed paragraphs."""
    gone = F.transform(F.filter("found", lambda p: p["removed"]), lambda p: p["line"])
    return found.select(F.col("doc_id").alias("d"), F.col("doc_hash").alias("h"), gone.alias("gone")).where(F.size("gone") > 0)


def _rest(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) and doc_hash, the removed paragraphs (lines ``gone``) cut out of the texts."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("doc_hash")).join(_gone(found), F.expr("doc_hash = h and doc_id <=> d"), "left")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("gone", i))
    return rows.select("doc_id", "doc_hash", F.when(F.size("gone") > 0, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text"), "gone")


def _long(texts: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, text: bytes) of the texts that may hold a passage."""
    return texts.where(F.octet_length("text") >= 2 * PASSAGE - 1).select("doc_id", "doc_hash", F.col("text").cast("binary").alias("text"))


def _passages(rest: DataFrame) -> DataFrame:
    """(d, h, runs): the repeated passages of what is left of the texts."""
    return repeated_passages(_long(rest)).withColumnsRenamed({"doc_id": "d", "doc_hash": "h"})


def _spans(runs: str) -> Column:
    """The pairs (lo, hi) of a column of runs, null if there are none."""
    pairs = F.transform(F.sequence(F.lit(0), F.size(runs) - 2, F.lit(2)), lambda i: F.struct(F.get(runs, i).alias("lo"), F.get(runs, i + 1).alias("hi")))
    return F.when(F.size(runs) > 0, pairs)


def _number(spans: str) -> Column:
    return F.coalesce(F.size(spans), F.lit(0)).cast("long")


def _n_words(spans: str) -> Column:
    return F.coalesce(F.aggregate(spans, F.lit(0).cast("long"), lambda n, r: n + r["hi"] - r["lo"]), F.lit(0).cast("long"))


def _listed(spans: str) -> Column:
    return F.coalesce(F.array_join(F.transform(spans, lambda r: F.concat_ws(":", r["lo"].cast("string"), r["hi"].cast("string"))), ","), F.lit(""))


def deduplicate(docs: DataFrame, percent: int = PERCENT, fewest_words: int = FEWEST_WORDS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_lines, n_repeated (paragraphs in
    clusters), n_removed, and the lists removed (line numbers from 0) and classes
    (doc_id:line of the first paragraph of each repeated one, in order of lines);
    then n_passages, n_cut and passages: the runs of words (from:to, from 0, in the
    text without its removed lines) that lie in repeated passages and are cut, their
    number and their words; n_short and short, the removed lines of fewer words
    (see ``_short``: equal words only); and n_shared, n_shared_words and shared: the
    runs of words (from:to, in the whole text) that lie in passages which another
    document holds too, the first document's included. A null or empty text has no
    paragraphs."""
    with hashed_joins(docs.sparkSession):
        found = _removed(repeated_paragraphs(docs, percent, fewest_words))
        release(docs.sparkSession)
        short = _short_removed(docs, fewest_words)
        runs, shared = repeated_and_shared(_long(docs.select("doc_id", "text", F.xxhash64("text").alias("doc_hash"))), _gone(found))
    rows = docs.select("doc_id", F.xxhash64("text").alias("doc_hash"), F.coalesce(F.expr("octet_length(text) - octet_length(replace(text, '\n', '')) + 1"), F.lit(0)).cast("long").alias("n_lines"))
    for more in (found, short.withColumnsRenamed({"d": "doc_id", "h": "doc_hash"}), runs, shared.withColumnRenamed("runs", "shared")):
        rows = rows.join(more.withColumnsRenamed({"doc_id": "d", "doc_hash": "h"}), F.expr("doc_hash = h and doc_id <=> d"), "left").drop("d", "h")
    gone = F.filter("found", lambda p: p["removed"])
    rows = rows.withColumns({"runs": _spans("runs"), "shared": _spans("shared")})
    return rows.select(
        "doc_id", "n_lines", F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_repeated"), F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.transform(gone, lambda p: p["line"].cast("string")), ","), F.lit("")).alias("removed"),
        F.coalesce(F.array_join(F.transform("found", lambda p: F.concat_ws(":", p["class_doc"].cast("string"), p["class_line"].cast("string"))), ","), F.lit("")).alias("classes"),
        _number("runs").alias("n_passages"), _n_words("runs").alias("n_cut"), _listed("runs").alias("passages"),
        F.coalesce(F.size("short"), F.lit(0)).cast("long").alias("n_short"), F.coalesce(F.array_join(F.col("short").cast("array<string>"), ","), F.lit("")).alias("short"),
        _number("shared").alias("n_shared"), _n_words("shared").alias("n_shared_words"), _listed("shared").alias("shared"))


def without_repeats(docs: DataFrame, percent: int = PERCENT, fewest_words: int = FEWEST_WORDS) -> DataFrame:
    """``docs`` (doc_id, text) with the removed paragraphs, and then the repeated
    passages of the rest, cut out of the texts."""
    found = _removed(repeated_paragraphs(docs, percent, fewest_words))
    rest = stored(_rest(docs, found), "para-rest")
    rows = rest
    for more in (_passages(rest), _short_removed(docs, fewest_words)):
        rows = rows.join(more, F.expr("doc_hash = h and doc_id <=> d"), "left").drop("d", "h")
    kind = docs.schema["doc_id"].dataType.simpleString()
    moved = F.expr("transform(short, l -> cast(l - size(filter(coalesce(gone, array()), g -> g < l)) as int))")
    cuts = rows.select("doc_id", F.col("text").cast("binary").alias("text"), "runs", moved.alias("lines")).mapInArrow(cut(1), f"doc_id {kind}, text binary")
    return cuts.withColumn("text", F.col("text").cast("string"))


def op2_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
