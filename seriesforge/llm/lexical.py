"""Ranked lexical search with norm buckets, after LEMP (operator 13).

The k best of all documents for every query, by an integer relevance score: the
product of the query's vector (term weight times repeats) with a document's vector
of impacts. Work on it:

* one pass over the texts finds, in whole Arrow batches, the terms of the queries
  in every document (by hash, then byte for byte), and counts all terms;
* number of documents, of terms and of documents for each term follow from that
  table and give the weights and the impacts. Both vectors are scaled by the square
  root of the weights, which leaves their product as it is and makes a document's
  length speak for its rare terms;
* the vectors are put in order by length (range partitions, ties spread) and cut
  into buckets of about ``BUCKET`` documents, a row each;
* some buckets of all lengths are searched first: the k-th best score there is a
  threshold for the others. A bucket is pruned for a query when, by Cauchy-Schwarz,
  the product of the lengths stays below the threshold. Inside a bucket the
  threshold bounds every coordinate of the normalised vectors; documents beyond a
  bound are filtered, survivors are rescored exactly in 64-bit integers. Bounds are
  taken with a slack for rounding, equal scores are never pruned;
* every task keeps the k best of its own for each query, a window over these rows
  (k for each task and query) gives the result.

Queries go out by blocks of at most ``QUERY_BYTES`` of text (one query may be
longer), which bounds what is broadcast; every block searches all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesforge.llm import bytesplit as B
from seriesforge.llm.common import drop_stored, read_table, stored

TOP = 10
BUCKET = 1024  # documents, or fewer with ENTRIES coordinates
ENTRIES = 1 << 18
FIRST_OF = 16  # one bucket in so many gives the thresholds
QUERY_BYTES = 8 << 20
SLACK = 1e-9
#: not part of a term: ASCII but for digits and letters
BETWEEN = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
NORMAL = bytes(c + 32 if 65 <= c <= 90 else 32 if BETWEEN[c] else c for c in range(256))


class Vocabulary:
    """The terms of the queries, found in blocks of texts."""

    def __init__(self, terms: list[bytes]):
        off = np.concatenate(([0], np.cumsum([len(t) for t in terms]))).astype(np.int64)
        data = np.frombuffer(b"".join(terms), np.uint8)
        hashes = B.word_hashes(data, off[:-1], off[1:]) if terms else np.empty(0, np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes, self.data, self.start, self.size = hashes[self.order], data, off[:-1], np.diff(off)
        self.equal = int(np.unique(hashes, return_counts=True)[1].max()) if terms else 0  # 1 unless hashes collide

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word among the terms, or -1."""
        out = np.full(len(starts), -1, np.int64)
        if not self.equal or not len(starts):
            return out
        hashed = B.word_hashes(data, starts, ends)
        first = np.searchsorted(self.hashes, hashed)
        for k in range(self.equal):
            at = np.minimum(first + k, len(self.hashes) - 1)
            term = self.order[at]
            words = np.flatnonzero((self.hashes[at] == hashed) & (self.size[term] == ends - starts))
            if len(words):
                term, size = term[words], (ends - starts)[words]
                inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                differs = data[np.repeat(starts[words], size) + inside] != self.data[np.repeat(self.start[term], size) + inside]
                same = np.add.reduceat(differs, np.cumsum(size) - size, dtype=np.int64) == 0
                out[words[same]] = term[same]
        return out


def _lists(flat: np.ndarray, bounds: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat.astype(kind)))


def _found(shared) -> callable:
    """(id, text) to (id, n, terms, tf): the number of all terms, those of the queries and how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        lower = np.frombuffer(NORMAL, np.uint8)
        for batch in batches:
            for at, data, off in B.blocks(batch.column(1)):
                data = lower[data]
                starts, ends, first = B.words(data, off, BETWEEN)
                term = vocabulary.find(data, starts, ends)
                words = np.flatnonzero(term >= 0)
                key = np.repeat(np.arange(len(off) - 1), np.diff(first))[words] << 32 | term[words]
                key, tf = np.unique(key, return_counts=True)
                bounds = np.searchsorted(key >> 32, np.arange(len(off)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(off) - 1), pa.array(np.diff(first).astype(np.int64)),
                     _lists(key & 0xFFFFFFFF, bounds, np.int32), _lists(tf, bounds, np.int32)], names=["id", "n", "terms", "tf"])
    return run


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Impact of each of the ``tf`` in documents of ``n`` terms (integers)."""
    if 75 * int(n.max(initial=0)) * documents < 1 << 63:
        share = 75 * n * documents // terms
    else:
        share = np.array([75 * int(x) * documents // terms for x in n], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * (25 + share))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and sizes of a list column."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _lengths(shared, documents: int, terms: int) -> callable:
    """(id, n, terms, tf) to (id, terms, impacts, length)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        for batch in batches:
            term, size = _flat(batch.column(2))
            impact = impacts(_flat(batch.column(3))[0], np.repeat(batch.column(1).to_numpy(zero_copy_only=False), size), documents, terms)
            bounds = np.concatenate(([0], np.cumsum(size)))
            total = np.concatenate(([0], np.cumsum(weight[term] * impact.astype(float) ** 2)))
            # sums by difference, so the same vector may differ in the last digits: it only orders
            length = np.sqrt(np.maximum(total[bounds[1:]] - total[bounds[:-1]], 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(term, bounds, np.int32), _lists(impact, bounds, np.int32), pa.array(length)], names=["id", "terms", "impacts", "length"])
    return run


def _bucketed(bucket: int, entries: int) -> callable:
    """Rows in order of length to one row for each bucket: ids, sizes, terms and impacts
    of its documents, one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            reach = np.cumsum(size)
            lo = 0
            while lo < batch.num_rows:
                hi = int(np.searchsorted(reach, (reach[lo - 1] if lo else 0) + entries, "right"))
                hi = min(max(hi, lo + 1), lo + bucket, batch.num_rows)
                ids, term, impact = (batch.column(i).slice(lo, hi - lo) for i in range(3))
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                yield pa.RecordBatch.from_arrays([one(pa.concat_arrays([ids])), one(pa.array(size[lo:hi].astype(np.int32))), one(term.flatten()), one(impact.flatten())], names=["ids", "sizes", "terms", "impacts"])
                lo = hi
    return run


class Bucket:
    """Documents of about one length, by document and by term."""

    def __init__(self, ids: pa.Array, sizes: np.ndarray, terms: np.ndarray, impacts_: np.ndarray, weight: np.ndarray):
        self.ids, self.n = ids, len(sizes)
        self.start = np.concatenate(([0], np.cumsum(sizes)))
        self.terms, self.impacts = terms, impacts_
        doc = np.repeat(np.arange(self.n), sizes)
        scaled = np.sqrt(weight[terms]) * impacts_
        length = np.sqrt(np.bincount(doc, scaled * scaled, minlength=self.n))
        self.longest = float(length.max(initial=0.0))
        order = np.argsort(terms, kind="stable")
        self.by_term, self.doc, self.by_impact = terms[order], doc[order], impacts_[order]
        self.unit = scaled[order] / np.maximum(length, 1e-300)[self.doc]
        self._keys = None

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Order of the documents by id: null last, then the ids."""
        if self._keys is None:
            values = self.ids.to_pylist()
            null = np.array([v is None for v in values], bool)
            filled = next((v for v in values if v is not None), 0)
            self._keys = null, np.array([filled if v is None else v for v in values])
        return self._keys

    def search(self, query: "Query", threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, among them all of a score of at least ``threshold`` (and above 0)."""
        nothing = np.empty(0, np.int64), np.empty(0, np.int64)
        reach = query.length * self.longest
        if reach * (1 + SLACK) < threshold or not reach:
            return nothing  # Cauchy-Schwarz
        lo, hi = np.searchsorted(self.by_term, query.terms), np.searchsorted(self.by_term, query.terms, "right")
        # a cosine of at least t needs t <= q p + sqrt(1 - q^2) sqrt(1 - p^2) at each coordinate
        t = min(1.0, threshold / reach)
        middle, spread = query.unit * t, np.sqrt(np.maximum((1 - t * t) * (1 - query.unit ** 2), 0))
        least, most = middle - spread - SLACK, np.where(query.unit >= t, 1.0, middle + spread) + SLACK
        must = np.flatnonzero(least > 0)
        if len(must):
            must = must[np.argsort((hi - lo)[must], kind="stable")]  # the rarest first
            alive = None
            for f in must:
                inside = slice(lo[f], hi[f])
                good = self.doc[inside][(self.unit[inside] >= least[f]) & (self.unit[inside] <= most[f])]
                alive = good if alive is None else alive[np.isin(alive, good, assume_unique=True)]
                if not len(alive):
                    return nothing
            docs, size = np.sort(alive), np.diff(self.start)
            size = size[docs]
            at = np.arange(size.sum()) + np.repeat(self.start[docs] - (np.cumsum(size) - size), size)
            own, term, impact = np.repeat(np.arange(len(docs)), size), self.terms[at], self.impacts[at]
            place = np.minimum(np.searchsorted(query.terms, term), len(query.terms) - 1)
            hit = query.terms[place] == term
            scores = np.zeros(len(docs), np.int64)
            np.add.at(scores, own[hit], query.weights[place[hit]] * impact[hit])
        else:
            size = hi - lo
            at = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
            f, doc = np.repeat(np.arange(len(size)), size), self.doc[at]
            alive = np.ones(self.n, bool)
            alive[doc[self.unit[at] > most[f]]] = False
            left = alive[doc]
            total = np.zeros(self.n, np.int64)
            np.add.at(total, doc[left], query.weights[f[left]] * self.by_impact[at[left]])
            docs = np.flatnonzero(alive)
            scores = total[docs]
        good = scores >= max(threshold, 1)
        return docs[good], scores[good]


class Query:
    def __init__(self, counts: dict[int, int], weight: np.ndarray):
        self.terms = np.array(sorted(t for t in counts if weight[t] > 0), np.int64)
        repeats = np.array([counts[t] for t in self.terms.tolist()], np.int64)
        self.weights = repeats * weight[self.terms]
        scaled = repeats * np.sqrt(weight[self.terms])
        self.length = float(np.sqrt((scaled * scaled).sum()))
        self.unit = scaled / max(self.length, 1e-300)


def _searched(shared, top: int) -> callable:
    """Buckets to (item, id, score): the best ``top`` of the task for each query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, thresholds, weight = shared.value
        queries = {item: Query(counts, weight) for item, counts in queries.items()}
        best: dict[int, list] = {}  # item: scores, whether null, ids; in order
        kind = None
        for batch in batches:
            kind = batch.column(0).type.value_type
            for row in range(batch.num_rows):
                ids, sizes, terms, impacts_ = (batch.column(i)[row].values for i in range(4))
                one = Bucket(ids, *(x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (sizes, terms, impacts_)), weight)
                for item, query in queries.items():
                    have = best.get(item)
                    threshold = max(thresholds.get(item, 0), int(have[0][top - 1]) if have and len(have[0]) >= top else 0)
                    docs, scores = one.search(query, threshold)
                    if not len(docs):
                        continue
                    null, keys = (x[docs] for x in one.keys())
                    if have:
                        scores, null, keys = np.concatenate((have[0], scores)), np.concatenate((have[1], null)), np.concatenate((have[2], keys))
                    order = np.lexsort((keys, null, -scores))[:top]
                    best[item] = [scores[order], null[order], keys[order]]
        for item, (scores, null, keys) in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(scores), pa.int64()), pa.array([None if x else k for x, k in zip(null.tolist(), keys.tolist())], kind), pa.array(scores)], names=["item", "id", "score"])
    return run


def _terms(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def _blocks(items: DataFrame, most: int) -> Iterator[dict[int, list[bytes]]]:
    """The terms of the queries (item, text), in blocks of about ``most`` bytes."""
    block, size = {}, 0
    for r in items.toLocalIterator():
        if block and size + len(r["text"]) > most:
            yield block
            block, size = {}, 0
        block[r["item"]] = _terms(bytes(r["text"]))
        size += len(r["text"])
    yield block


def _best(rows: DataFrame, top: int) -> DataFrame:
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)


def _search_block(texts: DataFrame, block: dict[int, list[bytes]], top: int, bucket: int, first_of: int) -> DataFrame | None:
    """(item, id, score, rank) of one block of queries, stored."""
    spark = texts.sparkSession
    names = sorted({t for terms in block.values() for t in terms})
    number = {t: i for i, t in enumerate(names)}
    counts = {item: dict(Counter(number[t] for t in terms)) for item, terms in block.items() if terms}
    kind = texts.schema["id"].dataType.simpleString()
    send = spark.sparkContext.broadcast
    found = stored(texts.mapInArrow(_found(send(Vocabulary(names))), f"id {kind}, n bigint, terms array<int>, tf array<int>"), "lexical-terms")
    total = found.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    documents, terms = total["documents"], total["terms"] or 0
    weight = np.zeros(len(names), np.int64)
    for r in found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toLocalIterator():  # terms of the block at most
        weight[r["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r["df"] + 1)))
    vectors = found.where(F.size("terms") > 0).mapInArrow(_lengths(send(weight), documents, terms), f"id {kind}, terms array<int>, impacts array<int>, length double")
    vectors = stored(vectors.where("length > 0").withColumn("row", F.monotonically_increasing_id()), "lexical-vectors")
    drop_stored(found)
    # the row number spreads vectors of one length over the range partitions
    ordered = vectors.repartitionByRange(F.desc("length"), F.col("row")).sortWithinPartitions(F.desc("length"), "row").select("id", "terms", "impacts")
    buckets = ordered.mapInArrow(_bucketed(bucket, ENTRIES), f"ids array<{kind}>, sizes array<int>, terms array<int>, impacts array<int>")
    # numbered inside their partitions: the first of each, and so on, are searched first
    buckets = stored(buckets.withColumn("nth", F.expr(f"(monotonically_increasing_id() & 8589934591L) % {first_of}")), "lexical-buckets")
    drop_stored(vectors)
    schema, thresholds, parts = f"item bigint, id {kind}, score bigint", {}, []
    for chosen in (F.col("nth") == 0, F.col("nth") > 0):
        rows = buckets.where(chosen).drop("nth").mapInArrow(_searched(send((counts, thresholds, weight)), top), schema)
        parts.append(stored(_best(rows, top).drop("rank"), "lexical-best"))
        if len(parts) == 1:  # a row for each query of the block
            thresholds = {r["item"]: r["score"] for r in _best(parts[0], top).where(F.col("rank") == top).collect()}
    out = stored(_best(parts[0].unionByName(parts[1]), top), "lexical-ranked")
    drop_stored(buckets, *parts)
    return out


def search(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
           query_bytes: int = QUERY_BYTES, bucket: int = BUCKET, first_of: int = FIRST_OF) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` its ``top`` rows of
    ``docs`` of highest score above 0, equal scores by ascending id, null last. Terms
    are runs of ASCII digits and letters (A-Z as a-z) and of characters beyond ASCII;
    null and empty texts have none and are found by nothing. Rows that repeat an id or
    a text count and rank on their own, as do queries that repeat an item_id. Empty
    tables give no rows. Other columns do not matter."""
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.make_valid_utf8(F.col(f"`{text}`").cast("string")).cast("binary"), F.lit(b"")).alias("text"))
    numbered = stored(items.select(F.col(f"`{item_id}`").alias("name"), F.coalesce(F.make_valid_utf8(F.col(f"`{item_text}`").cast("string")).cast("binary"), F.lit(b"")).alias("text"))
                      .withColumn("item", F.monotonically_increasing_id()), "lexical-items")
    out = None
    for block in _blocks(numbered.select("item", "text"), query_bytes):
        found = _search_block(texts, block, top, bucket, first_of)
        out = found if out is None else out.unionByName(found)
    return numbered.select("item", "name").join(out, "item").select(F.col("name").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: Every document's score by a join on terms.
ORACLE_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
item AS (
  SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
total AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc),
tf AS (SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM doc) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term),
query AS (SELECT item, item_id, term, count(*) AS repeats FROM item GROUP BY ALL),
scored AS (
  SELECT item, item_id, row, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM query JOIN weight USING (term) JOIN tf USING (term), total GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""
