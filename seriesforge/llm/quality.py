"""Quality rules: fixed base rules and a calibrated n-gram classifier (operator 1).

The classifier is a logistic regression over hashed word n-grams and hashed
character n-grams, each as shares of the text's n-grams. It is trained on a bounded
sample of the labelled rows, ``sample`` of each class, the smallest hashes of
doc_id and one row of each id; a quarter of them is held out to calibrate the margin
to a probability (Platt scaling, weighted to the classes' shares among all labels;
on the training rows where too few are left to hold any out). The sample's sparse
features, at most ``2 * sample`` rows, are gathered in one task, which minimises the
regularised loss by L-BFGS. Documents are scored in Arrow batches, a document is
read once; what is sent to the tasks is the weight vector, ``2**BITS`` floats for
each kind of n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.llm import bytesplit as B
from seriesforge.llm.common import read_table, stored, utf8

BITS = 16
WORD_N = (1, 2)
CHAR_N = (2, 3, 4)
SCALE = 100.0  # shares are in per cent
SAMPLE = 2000  # labelled rows of each class
STEPS = 60  # of L-BFGS
PENALTY = 0.01  # on the weights of features scaled to variance 1
KEEP_AT = 0.5  # calibrated probability of good quality
FEWEST_WORDS = 20
REPEAT_PERCENT = 30
REPEAT_N = 8
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
U64 = np.uint64


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether it occurs twice or more, and whether it did before."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    twice, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    later[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return twice, later


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the texts of a block."""
    starts, ends, first = B.words(data, off)
    texts = len(off) - 1
    hashed = B.word_hashes(data, starts, ends) if len(starts) else np.empty(0, U64)
    chars = ((data & 0xC0) != 0x80) & ~B.SPACES[data]
    # lines: one more than line feeds in each text
    feed = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([off[:-1], feed + 1]), kind="stable")
    line_text = np.sort(np.concatenate([np.arange(texts), np.searchsorted(off, feed, "right") - 1]), kind="stable")
    line_end = np.append(line_start[1:], off[-1])
    line_end = line_end - ((np.append(line_text[1:], -1) == line_text) & (line_end > line_start))
    filled = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, line_text = line_start[filled], line_end[filled], line_text[filled]
    by_text = B.mix(np.arange(texts, dtype=U64) + U64(1))
    dup_lines = np.zeros(texts, np.int64)
    if len(line_start):
        _, later = _repeated(B.mix(B.word_hashes(data, line_start, line_end) ^ by_text[line_text]))
        dup_lines = np.bincount(line_text[later], minlength=texts)
    n_words = np.diff(first)
    covered = np.zeros(len(hashed), np.int64)
    windows = B.shingle_hashes(hashed, REPEAT_N)
    if len(windows):
        word_text = np.repeat(np.arange(texts), n_words)
        whole = np.flatnonzero(word_text[:len(windows)] == word_text[REPEAT_N - 1:])
        twice, _ = _repeated(B.mix(windows[whole] ^ by_text[word_text[whole]]))
        edges = np.zeros(len(hashed) + 1, np.int64)
        edges[whole[twice]] += 1
        edges[whole[twice] + REPEAT_N] -= 1
        covered = (np.cumsum(edges)[:-1] > 0).astype(np.int64)
    return {"n_words": n_words, "word_chars": _per_text(chars, off), "n_symbols": _per_text(SYMBOLS[data], off), "n_dup_lines": dup_lines, "n_repeat_words": _per_text(covered, first)}


def _ngrams(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, feature of each n-gram, bounds of the texts), kind 0 words, 1 characters."""
    starts, ends, first = B.words(data, off)
    hashed = B.word_hashes(data, starts, ends) if len(starts) else np.empty(0, U64)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(U64)
    at = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[off]
    for kind, units, bounds, orders in ((0, hashed, first, WORD_N), (1, points, at, CHAR_N)):
        for n in orders:
            grams = max(0, len(units) - n + 1)
            h = np.full(grams, U64(n * 0x9E3779B1))
            for j in range(n):
                h = (h ^ units[j:j + grams]) * U64(0x9FB21C651E98DF25)
                h ^= h >> U64(32)
            size = np.diff(bounds)
            text = np.repeat(np.arange(len(size)), size)
            inside = text[:grams] == text[n - 1:] if n > 1 else slice(None)
            yield kind, ((h & U64((1 << BITS) - 1)) + U64(kind << BITS)).astype(np.int64)[inside], np.concatenate(([0], np.cumsum(np.maximum(size - n + 1, 0))))


def features(data: np.ndarray, off: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted indices and values of each text: per cent of its word or character n-grams."""
    parts = list(_ngrams(data, off))
    out = []
    for i in range(len(off) - 1):
        indices, values = [], []
        for kind in (0, 1):
            own = np.concatenate([f[b[i]:b[i + 1]] for k, f, b in parts if k == kind])
            index, count = np.unique(own, return_counts=True)
            indices.append(index)
            values.append(count * (SCALE / max(1, len(own))))
        out.append((np.concatenate(indices), np.concatenate(values)))
    return out


def margins(data: np.ndarray, off: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The product of weights and features of each text, without building them."""
    total, count = np.zeros((2, len(off) - 1)), np.zeros((2, len(off) - 1))
    for kind, feature, bounds in _ngrams(data, off):
        total[kind] += _per_text(weights[feature], bounds)
        count[kind] += np.diff(bounds)
    return (SCALE * total / np.maximum(count, 1)).sum(axis=0)


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    slope: float  # probability = 1 / (1 + exp(-(slope * margin + offset)))
    offset: float


def _one_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows (doc_id, text hash, ...) of a task one for each of the sample's
    ids, that of the smallest hash: as many as the sample has at most."""
    best: dict = {}
    for batch in batches:
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if key[0] not in best or key[1] < best[key[0]][0]:
                best[key[0]] = key[1], pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(i, 1)]) for c in batch.columns], schema=batch.schema)
    for _, row in best.values():
        yield row


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, data, off in B.blocks(batch.column(0)):
            made = features(data, off)
            n = len(made)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).slice(at, n) for i in (1, 2, 3)), pa.array([x[0] for x in made], pa.list_(pa.int32())), pa.array([x[1].astype(np.float32) for x in made], pa.list_(pa.float32()))],
                names=["label", "weight", "held_out", "indices", "values"])


def minimised(value_and_slope: callable, x: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """The minimum of a smooth convex function by L-BFGS with backtracking."""
    value, slope = value_and_slope(x)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        way, alphas = slope.copy(), []
        for s, y, r in reversed(moves):
            alphas.append(r * (s @ way))
            way -= alphas[-1] * y
        if moves:
            s, y, _ = moves[-1]
            way *= (s @ y) / (y @ y)
        for (s, y, r), alpha in zip(moves, reversed(alphas)):
            way += s * (alpha - r * (y @ way))
        down, length = slope @ way, 1.0 if moves else 1.0 / max(1e-12, np.abs(slope).sum())
        for _ in range(30):
            at = x - length * way
            there, steep = value_and_slope(at)
            if there <= value - 1e-4 * length * down:
                break
            length /= 2
        else:
            break
        s, y = at - x, steep - slope
        if s @ y > 1e-12:
            moves = [*moves[1 - memory:], (s, y, 1 / (s @ y))]
        done = value - there < 1e-9 * max(1.0, abs(value))
        x, value, slope = at, there, steep
        if done:
            break
    return x


def _logistic(z: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted loss, and its slope in z."""
    return float(weight @ (np.logaddexp(0, z) - label * z)), weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - label)


def fit(row: np.ndarray, index: np.ndarray, value: np.ndarray, label: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and bias from sparse features (row, index, value) of labelled rows."""
    n = len(label)
    mean, square = np.bincount(index, value, size) / n, np.bincount(index, value * value, size) / n
    spread = np.sqrt(np.maximum(square - mean * mean, 0) * n / max(1, n - 1))
    scale = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1), 0.0)
    value, each = value * scale[index], np.full(n, 1 / n)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(row, value * x[index], n) + x[-1]
        total, slope = _logistic(z, label, each)
        down = np.append(np.bincount(index, value * slope[row], size) + PENALTY * x[:-1], slope.sum())
        return total + 0.5 * PENALTY * float(x[:-1] @ x[:-1]), down

    share = label.mean()
    x = minimised(loss, np.append(np.zeros(size), np.log(share / (1 - share))), STEPS)
    return x[:-1] * scale, float(x[-1])


def _fitted(rows: pa.Table) -> pa.Table:
    """The model of the sample, one row, or none if a class is missing."""
    rows = rows.sort_by([("id", "ascending")])
    label, weight = rows.column("label").to_numpy().astype(float), rows.column("weight").to_numpy()
    held = rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
    names, kinds = ["weights", "bias", "slope", "offset"], [pa.binary(), pa.float64(), pa.float64(), pa.float64()]
    if set(label[~held]) != {0.0, 1.0}:
        return pa.table([pa.array([], k) for k in kinds], names=names)
    lists = rows.column("indices").combine_chunks()
    row = np.repeat(np.arange(len(label)), lists.value_lengths().to_numpy(zero_copy_only=False))
    index, value = lists.flatten().to_numpy(), rows.column("values").combine_chunks().flatten().to_numpy().astype(float)
    train = ~held[row]
    place = np.cumsum(~held) - 1
    weights, bias = fit(place[row[train]], index[train], value[train], label[~held], 2 << BITS)
    weights = weights.astype(np.float32)
    margin = np.bincount(row, value * weights[index], len(label)) + bias
    if set(label[held]) != {0.0, 1.0}:
        held = np.ones(len(label), bool)
    m, y, w = margin[held], label[held], weight[held] / weight[held].sum()

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        total, slope = _logistic(x[0] * m + x[1], y, w)
        return total + 0.5e-4 * x[0] ** 2, np.array([slope @ m + 1e-4 * x[0], slope.sum()])

    slope, offset = minimised(loss, np.array([1.0, 0.0]), 200)
    return pa.table([pa.array([weights.tobytes()]), *(pa.array([float(v)]) for v in (bias, slope, offset))], names=names)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel | None:
    """A model from ``labels`` (doc_id, quality 0 or 1) of ``docs`` (doc_id, text);
    None if a class has no labelled document. At most ``sample`` documents of each
    class train; of rows that repeat a doc_id that with the smallest hash of its text.
    A doc_id with several labels has the lowest."""
    known = stored(labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("label")), "quality-labels")
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return None
    chosen = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).withColumn("weight", F.lit(n / min(n, sample) / sum(totals.values()))) for k, n in totals.items()]
    rows = chosen[0].unionByName(chosen[1]).withColumn("held_out", F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(4)) == 0)
    # at most 2 * sample rows of four small columns: bounded, so it may be broadcast
    texts = docs.select(F.col("doc_id"), utf8("text").alias("text")).join(F.broadcast(rows), "doc_id")
    texts = texts.select("doc_id", F.xxhash64("text").alias("hash"), "text", "label", "weight", "held_out")
    # one row of an id, however many there are: of each task, then of all
    texts = texts.mapInArrow(_one_each, texts.schema).groupBy("doc_id").agg(F.min_by(F.struct("text", "label", "weight", "held_out"), "hash").alias("row"))
    made = texts.select("row.text", "row.label", "row.weight", "row.held_out").mapInArrow(_feature_rows, "label int, weight double, held_out boolean, indices array<int>, values array<float>")
    made = stored(made.withColumn("id", F.xxhash64("label", "indices", "values")), "quality-features")
    model = made.withColumn("one", F.lit(True)).groupBy("one").applyInArrow(_fitted, "weights binary, bias double, slope double, offset double").first()
    if model is None:
        return None
    return QualityModel(np.frombuffer(model["weights"], np.float32), model["bias"], model["slope"], model["offset"])


def _verdict(model: QualityModel | None, data: np.ndarray, off: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray | None, np.ndarray]:
    """Counts, base_failed, probability and kept of the texts of a block."""
    counts = base_counts(data, off)
    failed = (counts["n_words"] < FEWEST_WORDS) | (100 * counts["n_repeat_words"] > REPEAT_PERCENT * counts["n_words"])
    if model is None:
        return counts, failed, None, ~failed
    z = model.slope * (margins(data, off, model.weights) + model.bias) + model.offset
    p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    return counts, failed, p, ~failed & (p >= KEEP_AT)


def _scored(shared, at: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, off in B.blocks(batch.column(at)):
                n = len(off) - 1
                counts, failed, p, good = _verdict(shared.value, data, off)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(first, n) for i in range(at)), *(pa.array(counts[c].astype(np.int64)) for c in COUNTS), pa.array(failed), pa.array(good),
                     pa.nulls(n, pa.float64()) if p is None else pa.array(p)],
                    names=[*batch.schema.names[:at], *COUNTS, "base_failed", "kept", "probability"])
    return run


def _accepting(shared, at: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, off in B.blocks(batch.column(at).fill_null(b"")):
                good = _verdict(shared.value, data, off)[3]
                yield batch.slice(first, len(good)).filter(pa.array(good))
    return run


def accepted(docs: DataFrame, model: QualityModel | None, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, that :func:`score` would keep."""
    flat = docs.withColumn(text, F.col(f"`{text}`").cast("binary"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return flat.mapInArrow(_accepting(shared, docs.columns.index(text)), flat.schema).withColumn(text, F.col(f"`{text}`").cast("string"))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def score(docs: DataFrame, model: QualityModel | None, keep: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, probability), a row for each row. A null or empty text has
    no words and fails the base rules. Without a model the base rules alone decide
    and probability is null. Words, lines and windows are compared by 64-bit hashes."""
    base = docs.select(F.col(keep).alias("doc_id"), utf8(text).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return base.mapInArrow(_scored(shared, 1), f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean, probability double")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels")))
