"""Language identification by multinomial naive Bayes over hashed character n-grams (operator 12).

A text is lower-cased, every run of other characters than letters and their
marks is one space, and one space stands before and behind it. Its features are
the n-grams of ``ORDERS`` code points, hashed into ``2**BITS`` buckets.

Training counts the n-grams of all labelled rows: each task sums its rows into
one array a language, and only these sums are shuffled (language, bucket, count),
so a language or a source with a third of all rows costs no more than another.
A model is a table with a row for each language: its name, its number of rows and
the logarithms of its smoothed shares, one 32-bit integer a bucket (units of
``1 / UNIT``), so that sums do not depend on the order in which they are added.

Prediction broadcasts the matrix of at most ``LANGUAGES_A_PASS`` languages
(32 MB) and sums its entries for the n-grams of whole Arrow batches in numpy; with
more languages the rows take one pass for each such share, and the best language
and the sum of all likelihoods are carried on, so the result is that of one matrix.
Texts are read whole, long ones in pieces that overlap by an n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.llm import bytesplit as B
from seriesforge.llm.common import hidden, read_table, stored

BITS = 16
ORDERS = (1, 2, 3, 4)
ALPHA = 0.1  # added to every count
UNIT = 65536
LANGUAGES_A_PASS = 128
LANGUAGES_A_TASK = 128  # counted at a time, 512 kB each
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
U64 = np.uint64
BUCKETS = 1 << BITS


def prepared(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Whether each text has a letter, and the texts as they are counted (binary,
    empty without a letter)."""
    texts = pc.fill_null(texts, "")
    letter = pc.match_substring_regex(texts, r"\p{L}")
    plain = pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+", " "), " ")
    plain = pc.binary_join_element_wise(" ", plain, " ", "")
    return letter, pc.if_else(letter, plain, "").cast(pa.binary())


def _pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first row, code points, bounds of the texts in them, how many code points
    may begin an n-gram here). A text beyond a block comes in several pieces, each
    with the points behind it that its last n-grams need."""
    ahead = 4 * max(ORDERS)
    for at, data, off in B.blocks(column):
        cuts = [0]
        while len(off) == 2 and len(data) - cuts[-1] > 2 * B.BLOCK_BYTES:
            cut = cuts[-1] + B.BLOCK_BYTES
            while data[cut] & 0xC0 == 0x80:
                cut += 1
            cuts.append(cut)
        for lo, hi in zip(cuts, [*cuts[1:], len(data)]):
            end = min(len(data), hi + ahead)
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end += 1
            piece = data[lo:end]
            points = np.frombuffer(piece.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(U64)
            if len(cuts) > 1:
                yield at, points, np.array([0, len(points)]), int(((data[lo:hi] & 0xC0) != 0x80).sum())
            else:
                yield at, points, np.concatenate(([0], np.cumsum((piece & 0xC0) != 0x80)))[off], len(points)


def buckets(points: np.ndarray, bounds: np.ndarray, own: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the bucket of every n-gram, and the bounds of the texts in them."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    h = np.zeros(len(points), U64)
    for n in range(1, max(ORDERS) + 1):
        size = max(0, len(points) - n + 1)
        h = (h[:size] ^ points[n - 1:]) * U64(0x9FB21C651E98DF25)
        h ^= h >> U64(32)
        if n in ORDERS:
            inside = np.flatnonzero(text[:size] == text[n - 1:])
            inside = inside[inside < own]
            found = (B.mix(h[inside] ^ U64(n)) >> U64(64 - BITS)).astype(np.int64)
            yield found, np.searchsorted(inside, bounds)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to (label, bucket, n); bucket -1 has the number of texts."""
    sums: dict[str, np.ndarray] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for label, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array((at - 1).astype(np.int32)), pa.array(total[at])], names=["label", "bucket", "n"])
        sums.clear()

    for batch in batches:
        letter, texts = prepared(batch.column(1))
        for label in pc.unique(batch.column(0)).to_pylist():
            if label not in sums and len(sums) >= LANGUAGES_A_TASK:
                yield from flushed()
            total = sums.setdefault(label, np.zeros(BUCKETS + 1, np.int64))
            mine = pc.and_(pc.equal(batch.column(0), label), letter)
            total[0] += pc.sum(mine).as_py() or 0
            for _, points, bounds, own in _pieces(texts.filter(mine)):
                for found, _ in buckets(points, bounds, own):
                    total[1:] += np.bincount(found, minlength=BUCKETS)
    yield from flushed()


def _row(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
    """The model's row of one language: at most a count a bucket comes in."""
    total = np.zeros(BUCKETS + 1)
    total[counts["bucket"].to_numpy() + 1] = counts["n"].to_numpy()
    share = np.log(total[1:] + ALPHA) - np.log(total[1:].sum() + ALPHA * BUCKETS)
    return pd.DataFrame({"label": [key[0]], "n_texts": [int(total[0])], "logs": [np.round(share * UNIT).astype(np.int32).tobytes()]})


def train(rows: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """The stored model (label, n_texts, logs) of all rows with a label and a letter
    in their text. A label is any string, '' too. Rows without any give an empty
    model."""
    some = rows.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    some = some.select(F.col(f"`{label}`").cast("string").alias("label"), F.make_valid_utf8(F.col(f"`{text}`").cast("string")).alias("text"))
    counts = some.mapInArrow(_counted, "label string, bucket int, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    model = counts.groupBy("label").applyInPandas(_row, "label string, n_texts bigint, logs binary")
    return stored(model.where("n_texts > 0"), "langid-model")


def _scored(shared, at: int) -> callable:
    """Columns at (text), at + 1 .. at + 3: the best language so far, its
    log-likelihood, and the logarithm of the sum of all likelihoods so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, priors, logs = shared.value
        for batch in batches:
            letter, texts = prepared(batch.column(at))
            n = batch.num_rows
            sums = np.repeat(priors[:, None], n, axis=1)
            for first, points, bounds, own in _pieces(texts):
                rows = slice(first, first + len(bounds) - 1)
                for found, edges in buckets(points, bounds, own):
                    for k in range(len(labels)):
                        total = np.concatenate(([0], np.cumsum(logs[k][found], dtype=np.int64)))
                        sums[k, rows] += total[edges[1:]] - total[edges[:-1]]
            best = sums.argmax(axis=0)  # the first of equals; labels are sorted
            top = sums[best, np.arange(n)] / UNIT
            whole = top + np.log(np.exp(sums / UNIT - top).sum(axis=0))
            before = batch.column(at + 2).to_numpy(zero_copy_only=False)
            better = top > before  # labels ascend over the passes too
            names = np.where(better, np.array(labels, object)[best], batch.column(at + 1).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(at + 1)), pc.if_else(letter, pa.array(names, pa.string()), pa.nulls(n, pa.string())),
                 pa.array(np.maximum(top, before)), pa.array(np.logaddexp(whole, batch.column(at + 3).to_numpy(zero_copy_only=False)))], names=batch.schema.names)
    return run


def predict(rows: DataFrame, model: DataFrame, text: str = "text", languages_a_pass: int = LANGUAGES_A_PASS) -> DataFrame:
    """The rows, all columns but those named lang_pred or score, with lang_pred and
    score: the most probable language of the whole text and its probability, given
    the counts of its n-grams and the languages' shares of the training rows. Equal
    probabilities: the first name by its bytes. A text that is null or has no letter,
    or any text under an empty model, has ``und`` and 0. Reads nothing but the text."""
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c.lower() not in ("lang_pred", "score")]
    body, name, top, whole = (hidden(rows, c) for c in ("body", "name", "top", "whole"))
    nothing = F.lit(float("-inf"))
    out = rows.select(*(F.col(f"`{c}`") for c in kept), F.make_valid_utf8(F.col(f"`{text}`").cast("string")).alias(body),
                      F.lit(None).cast("string").alias(name), nothing.alias(top), nothing.alias(whole))
    labels = [r["label"] for r in model.select("label").collect()]  # a row for each language
    labels.sort(key=lambda x: x.encode())
    texts = (model.agg(F.sum("n_texts").alias("n")).first()["n"] or 0) if labels else 0
    for k in range(0, len(labels), languages_a_pass):
        share = labels[k:k + languages_a_pass]
        found = {r["label"]: r for r in model.where(F.col("label").isin(share)).collect()}  # at most a pass's matrix
        priors = np.array([round(float(np.log(found[x]["n_texts"] / texts)) * UNIT) for x in share], np.int64)
        matrix = np.stack([np.frombuffer(found[x]["logs"], np.int32) for x in share])
        out = out.mapInArrow(_scored(spark.sparkContext.broadcast((share, priors, matrix)), len(kept)), out.schema)
    certain = F.when(F.col(name).isNull(), F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.exp(F.col(top) - F.col(whole))))
    return out.select(*(F.col(f"`{c}`") for c in kept), F.coalesce(F.col(name), F.lit(UNKNOWN)).alias("lang_pred"), certain.alias("score"))


def held_out(doc_id: str = "doc_id"):
    """Whether the crc32 of the id as text leaves 2 when divided by 4; a null id is
    not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model of the documents that are not held out predicts the language of every document."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
