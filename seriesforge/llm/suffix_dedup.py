"""Exact substring deduplication by hash-compared suffix sorting (operator 8).

A byte is removed if a ``match``-byte string that covers it starts anywhere else
too. All suffixes of a corpus cannot be shuffled, so equal strings are first
brought together by what any two of them share:

1. Anchors. Every ``match``-byte window has an anchor, the ``GRAM``-byte string
   in it with the smallest hash (the leftmost of equals). Equal windows have
   equal anchors at equal distance. Consecutive windows with one anchor are a
   run, one row. Runs whose anchor occurs nowhere else hold nothing repeated;
   runs whose whole content occurs elsewhere are repeated altogether.
2. What is left, mostly the edges of shared passages, is cut into pieces of
   ``PIECE`` windows by their distance to the anchor, and asked the same: the
   bytes common to all windows of a piece take the anchor's place.
3. What is still left is decided window by window, against each other and one
   piece of each repeated content. Each task sorts the suffixes of its windows:
   mergesort inside each class of equal anchor and distance, two suffixes
   compared by a binary search for their common extension over prefix polynomial
   hashes. Neighbours that agree in ``match`` bytes are verified byte by byte; a
   class with a hash collision is sorted again by its bytes. One window of each
   kind leaves the task with a 128-bit hash, and an aggregation merges the tasks'
   sorted lists.

No step gathers a key in one task: whether something occurs at two places is the
smallest and the largest place, which combine map-side, and the joins back read
stored tables, whose hot partitions adaptive execution splits. Only each text's
own spans are collected, by text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.llm import bytesplit as B
from seriesforge.llm.common import drop_stored, read_table, release, stored, utf8

MATCH = 200
GRAM = 32
PIECE = 16
U64 = np.uint64
#: A text's identity in every table: 128 bits of its SHA-256.
TID = ["tid", "tid2"]
BLOCK = 512 << 10
BASE2 = U64(0xD1342543DE82EF95)
BASE2_INV = U64(pow(int(BASE2), -1, 1 << 64))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """prefix[i] = sum of (byte + 1) * BASE**j for j < i, modulo 2**64."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * B.powers(len(data)), out=out[1:])
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def runs(data: np.ndarray, off: np.ndarray, match: int = MATCH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """text, first window, windows, anchor hash, content hash of the runs of a
    block; the first window counts from the text's start."""
    n = len(data)
    if n < match:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    prefix, inverse = prefix_hashes(data), B.powers(n + 1, inverse=True)
    grams = B.mix((prefix[gram:] - prefix[:-gram]) * inverse[:n - gram + 1])
    place = (grams & ~U64((1 << 28) - 1)) | np.arange(len(grams), dtype=U64)
    anchor = (sliding_min(place, match - gram + 1) & U64((1 << 28) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))[:len(anchor)]
    starts = np.flatnonzero(np.arange(len(anchor)) + match <= off[1:][text])
    if not len(starts):
        return tuple(np.empty(0, np.int64) for _ in range(5))
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (np.diff(anchor[starts]) != 0) | (np.diff(text[starts]) != 0)
    lo = np.flatnonzero(new)
    count = np.diff(np.append(lo, len(starts)))
    first = starts[lo]
    end = first + count - 1 + match
    content = B.mix(((prefix[end] - prefix[first]) * inverse[first]) ^ (count.astype(U64) << U64(40)))
    which = text[first]
    return which, first - off[which], count, grams[anchor[first]].view(np.int64), content.view(np.int64)


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)])


def _out(ids: np.ndarray, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids[0]), pa.array(ids[1]), *(pa.array(c) if isinstance(c, np.ndarray) else c for c in columns.values())], names=[*TID, *columns])


def _run_rows(match: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch)
            for at, data, off in B.blocks(batch.column(2), BLOCK):
                which, first, count, anchor, content = runs(data, off, match)
                yield _out(ids[:, at + which], run=first * (match + 1) + count, anchor=anchor, content=content)
    return run


class Suffixes:
    """Suffixes of one block at given starts, sorted by their first ``match`` bytes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, classes: np.ndarray, match: int = MATCH):
        self.data, self.starts, self.match = data, starts, match
        self.prefix, self.inverse = prefix_hashes(data), B.powers(len(data) + 1, inverse=True)
        self.order = np.argsort(classes, kind="stable")
        sorted_classes = classes[self.order]
        self.new = np.ones(len(starts), bool)
        self.new[1:] = sorted_classes[1:] != sorted_classes[:-1]
        self._mergesort()

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes starting at a and b, at
        most ``match``: binary search, the hash of a part found from the prefix sums."""
        length = np.zeros(len(a), np.int64)
        step = 1 << (self.match.bit_length() - 1)
        while step:
            p, q = a + length, b + length
            can = length + step <= self.match
            p, q = np.where(can, p, 0), np.where(can, q, 0)
            same = (self.prefix[p + step] - self.prefix[p]) * self.inverse[p] == (self.prefix[q + step] - self.prefix[q]) * self.inverse[q]
            length += step * (can & same)
            step >>= 1
        return length

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.common(a, b)
        at = np.minimum(n, self.match - 1)
        x, y = self.data[a + at], self.data[b + at]
        return np.where(n == self.match, or_equal, x < y)

    def _mergesort(self) -> None:
        """Bottom-up, all classes at once: an element's place after a merge is its
        place in its own half plus its rank in the other, by binary search."""
        n = len(self.order)
        if not n:
            return
        begin = np.flatnonzero(self.new)
        size = np.diff(np.append(begin, n))
        width = 1
        while width < size.max():
            big = np.flatnonzero(size > width)
            element = _ranges(begin[big], size[big])
            home = np.repeat(begin[big], size[big])
            last = home + np.repeat(size[big], size[big])
            nth = (element - home) // width
            other = np.where(nth % 2 == 0, nth + 1, nth - 1) * width + home
            lo, hi = np.minimum(other, last), np.minimum(other + width, last)
            base, mine = lo.copy(), self.starts[self.order[element]]
            second = nth % 2 == 1  # of equals, the first half's stay first
            for _ in range(int(width).bit_length()):
                open_ = lo < hi
                mid = np.where(open_, (lo + hi) // 2, 0)
                # does the other half's middle come before mine?
                theirs = self.starts[self.order[mid]]
                before = self.less(theirs, mine, second)
                lo = np.where(open_ & before, mid + 1, lo)
                hi = np.where(open_ & ~before, mid, hi)
            pair = home + nth // 2 * 2 * width
            target = pair + (element - home) % width + (lo - base)
            order = self.order.copy()
            order[target] = self.order[element]
            self.order = order
            width *= 2

    def groups(self) -> np.ndarray:
        """A number for each start; equal for starts with equal strings."""
        n = len(self.order)
        head = self.new.copy()
        where = np.flatnonzero(~head)
        a, b = self.starts[self.order[where - 1]], self.starts[self.order[where]]
        same = self.common(a, b) == self.match
        wrong = [where[same][i:i + 4096][~self._equal_bytes(a[same][i:i + 4096], b[same][i:i + 4096])] for i in range(0, int(same.sum()), 4096)]
        head[where[~same]] = True
        for at in np.concatenate(wrong) if wrong else ():
            self._by_bytes(int(at), head)
        number = np.empty(n, np.int64)
        number[self.order] = np.cumsum(head) - 1
        return number

    def _equal_bytes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        reach = np.arange(self.match)
        return (self.data[a[:, None] + reach] == self.data[b[:, None] + reach]).all(axis=1)

    def _by_bytes(self, at: int, head: np.ndarray) -> None:
        """A hash collision: the class around ``at`` again, by its bytes."""
        begin = np.flatnonzero(self.new[:at + 1])[-1]
        ends = np.flatnonzero(self.new[at + 1:])
        end = at + 1 + ends[0] if len(ends) else len(self.order)
        content = self.data.tobytes()
        part = lambda i: content[self.starts[i]:self.starts[i] + self.match]
        self.order[begin:end] = sorted(self.order[begin:end].tolist(), key=part)
        head[begin + 1:end] = [part(x) != part(y) for x, y in zip(self.order[begin:end - 1], self.order[begin + 1:end])]


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... of each of several ranges."""
    return np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())


def _todo(batch: pa.RecordBatch, limit: int, match: int) -> Iterator[tuple[np.ndarray, ...]]:
    """TID, text, todo -> ids, bytes, offsets, and text, first byte and number of windows of each run to do."""
    ids, todo = _ids(batch), batch.column(3)
    for at, data, off in B.blocks(batch.column(2), limit):
        own = [np.asarray(todo[at + i].values) for i in range(len(off) - 1)]
        text = np.repeat(np.arange(len(own)), [len(x) for x in own])
        packed = np.concatenate(own).astype(np.int64)
        if len(packed):
            yield ids[:, at:at + len(own)], data, off, text, packed // (match + 1) + off[text], packed % (match + 1)


def _piece_rows(match: int, gram: int, piece: int) -> callable:
    """Pieces of runs, as runs: TID, run, hash of the bytes that all windows of a
    piece share (with its distance to the anchor), hash of all its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, off, text, first, count in _todo(batch, 2 * BLOCK, match):
                prefix, inverse = prefix_hashes(data), B.powers(len(data) + 1, inverse=True)
                anchors = _anchors(prefix, inverse, first, count, match, gram)
                nearest, farthest = (anchors - first - count + 1) // piece, (anchors - first) // piece
                number = farthest - nearest + 1
                which = np.repeat(np.arange(len(first)), number)
                anchor, nth = anchors[which], _ranges(nearest, number)
                lo = np.maximum(first[which], anchor - (nth + 1) * piece + 1)
                hi = np.minimum(first[which] + count[which] - 1, anchor - nth * piece)  # first and last window
                at, end = anchor - nth * piece, anchor - (nth + 1) * piece + 1 + match
                shared = B.mix(((prefix[end] - prefix[at]) * inverse[at]) ^ nth.astype(U64))
                whole = B.mix(((prefix[hi + match] - prefix[lo]) * inverse[lo]) ^ ((anchor - lo).astype(U64) << U64(40)))
                yield _out(ids[:, text[which]], run=(lo - off[text[which]]) * (match + 1) + hi - lo + 1, anchor=shared.view(np.int64), content=whole.view(np.int64))
    return run


def _window_rows(match: int, gram: int) -> callable:
    """(TID, run, hi, lo): a window of each kind in a block, as a run of one, with
    its hash. Those found twice in the block also come as runs without a hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, off, text, first, count in _todo(batch, 2 * BLOCK, match):
                starts, text = _ranges(first, count), np.repeat(text, count)
                # equal windows have equal anchors at equal distance: classes to sort in
                prefix, inverse = prefix_hashes(data), B.powers(len(data) + 1, inverse=True)
                anchor = np.repeat(_anchors(prefix, inverse, first, count, match, gram), count)
                grams = (prefix[anchor + gram] - prefix[anchor]) * inverse[anchor]
                classes = B.mix(grams ^ B.mix((anchor - starts).astype(U64)))
                number = Suffixes(data, starts, classes, match).groups()
                one = np.unique(number, return_index=True)[1]
                s = starts[one]
                hi = B.mix((prefix[s + match] - prefix[s]) * inverse[s])
                prefix2 = np.zeros(len(data) + 1, U64)
                np.cumsum((data.astype(U64) + U64(1)) * _powers2(len(data)), out=prefix2[1:])
                lo = B.mix((prefix2[s + match] - prefix2[s]) * _powers2(len(data) + 1, True)[s])
                yield _out(ids[:, text[one]], run=(s - off[text[one]]) * (match + 1) + 1, hi=hi.view(np.int64), lo=lo.view(np.int64))
                again = np.flatnonzero(np.bincount(number)[number] > 1)
                again = again[np.argsort(starts[again])]
                if len(again):
                    s, t = starts[again], text[again]
                    head = np.flatnonzero(np.concatenate(([True], (np.diff(s) > 1) | (np.diff(t) != 0) | (np.arange(1, len(s)) % match == 0))))
                    size = s[np.append(head[1:], len(s)) - 1] - s[head] + 1
                    none = pa.nulls(len(head), pa.int64())
                    yield _out(ids[:, t[head]], run=(s[head] - off[t[head]]) * (match + 1) + size, hi=none, lo=none)
    return run


def _anchors(prefix: np.ndarray, inverse: np.ndarray, first: np.ndarray, count: np.ndarray, match: int, gram: int) -> np.ndarray:
    """The anchor of each run: the smallest hash in its first window."""
    width = match - gram + 1
    out = np.empty(len(first), np.int64)
    for i in range(0, len(first), 4096):
        p = first[i:i + 4096, None] + np.arange(width)
        out[i:i + 4096] = first[i:i + 4096] + np.argmin(B.mix((prefix[p + gram] - prefix[p]) * inverse[p]) >> U64(28), axis=1)
    return out


_second: dict[bool, np.ndarray] = {}


def _powers2(n: int, inverse: bool = False) -> np.ndarray:
    have = _second.get(inverse)
    if have is None or len(have) < n:
        base, out = BASE2_INV if inverse else BASE2, np.full(max(n, 8 * BLOCK), U64(1))
        out[1:] = base
        _second[inverse] = have = np.multiply.accumulate(out)
    return have[:n]


def _cut(match: int) -> callable:
    """TID, text, runs of repeated windows -> TID, n_removed, removed, kept_sha256, kept_text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, spans, sha = [], [], [], []
            for value, own in zip(batch.column(2), batch.column(3)):
                text, packed = value.as_py(), np.asarray(own.values)
                lo = packed // (match + 1)
                hi = lo + packed % (match + 1) - 1 + match
                order = np.argsort(lo, kind="stable")
                lo, reach = lo[order], np.maximum.accumulate(hi[order])
                new = np.ones(len(lo), bool)
                new[1:] = lo[1:] > reach[:-1]
                begin = lo[new].tolist()
                end = reach[np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)].tolist()
                kept.append(b"".join(text[a:b] for a, b in zip([0, *end], [*begin, len(text)])))
                removed.append(sum(end) - sum(begin))
                spans.append([x for s in zip(begin, end) for x in s])
                sha.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
                                             names=[*TID, "n_removed", "removed", "kept_sha256", "kept_text"])

    return run


def _twice(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur at two places or more, with the smallest place p. A place is
    a hash, but only places of one key are told apart by it."""
    return df.groupBy(*key).agg(F.min("place").alias("p"), F.max("place").alias("q")).where("p <> q").select(*key, "p")


def _narrowed(found: DataFrame, label: str) -> DataFrame:
    """Judges runs (TID, run, anchor, content): those whose anchor occurs at one
    place are left out; the others come as (TID, run, whole, todo). whole: its
    content occurs at two places or more. todo: its windows are still to be
    looked at, as runs that are not whole, or, for comparison with those of its
    anchor, as one run of each repeated content."""
    found = stored(found, f"sd-{label}-runs")
    spark = found.sparkSession
    placed = found.withColumn("place", F.xxhash64(*TID, "run"))
    anchors = stored(_twice(placed, "anchor").select("anchor"), f"sd-{label}-anchors")
    release(spark)
    # copies of a text give the same runs; equal (TID, run) is one
    maybe = placed.join(anchors, "anchor").groupBy(*TID, "run").agg(*(F.first(c).alias(c) for c in ("place", "anchor", "content")))
    maybe = stored(maybe, f"sd-{label}-maybe")
    drop_stored(found, anchors)
    release(spark)
    contents = stored(_twice(maybe, "content", "anchor"), f"sd-{label}-contents")
    judged = maybe.join(contents, ["content", "anchor"], "left").select(*TID, "run", "anchor", F.col("p").isNotNull().alias("whole"), (F.col("p") == F.col("place")).alias("one_of_kind"))
    judged = stored(judged, f"sd-{label}-judged")
    open_ = stored(judged.where("not whole").select("anchor").distinct().withColumn("open", F.lit(True)), f"sd-{label}-open")
    out = judged.join(open_, "anchor", "left").withColumn("todo", ~F.col("whole") | F.coalesce(F.col("one_of_kind") & F.col("open"), F.lit(False)))
    out = stored(out.select(*TID, "run", "whole", "todo"), f"sd-{label}-todo")
    drop_stored(maybe, contents, judged, open_)
    release(spark)
    return out


def deduplicate(docs: DataFrame, match: int = MATCH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, removed (from, to, ... of the maximal removed runs, in bytes)
    and kept_text (UTF-8 bytes; null where nothing was removed, that is the text
    itself). A null text is empty. Texts shorter than ``match`` bytes lose
    nothing. Of rows with equal texts of at least ``match`` bytes nothing stays,
    also if they share a doc_id. A cut may fall inside a character, so what is
    kept is bytes.

    Rows of equal text are one text to the search; 128 bits of its SHA-256 tell
    texts apart, so that equal ids are not to be expected at any size."""
    base = docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("text")).withColumn("sha", F.sha2("text", 256))
    halves = (F.conv(F.substring("sha", 1 + 16 * i, 16), 16, -10).cast("long").alias(t) for i, t in enumerate(TID))
    base = base.select("doc_id", "text", "sha", *halves)
    rows = stored(base.select("doc_id", *TID, F.octet_length("text").cast("long").alias("n_bytes"), "sha"), "sd-rows")
    groups = stored(rows.where(f"n_bytes >= {match}").groupBy(*TID).agg(F.min("doc_id").alias("one"), (F.count("*") > 1).alias("copied")), "sd-groups")
    ids = ", ".join(f"{t} bigint" for t in TID)
    kinds = f"{ids}, run bigint, anchor bigint, content bigint"
    runs_ = _narrowed(base.where(F.octet_length("text") >= match).select(*TID, "text").mapInArrow(_run_rows(match), kinds), "run")
    todo = runs_.groupBy(*TID).agg(F.collect_list(F.when(F.col("todo"), F.col("run"))).alias("todo"))  # bounded by the text
    wanted = stored(todo.join(groups, TID).where("size(todo) > 0 or not copied"), "sd-wanted")
    named = base.withColumnsRenamed({"tid": "t", "tid2": "t2"})
    texts = named.join(wanted, F.expr("t = tid and t2 = tid2 and doc_id <=> one")).select(*TID, "copied", "todo", "text")
    texts = stored(texts, "sd-texts")
    release(docs.sparkSession)
    pieces = _narrowed(texts.where("size(todo) > 0").select(*TID, "text", "todo").mapInArrow(_piece_rows(match, GRAM, PIECE), kinds), "piece")
    todo = stored(pieces.where("todo").groupBy(*TID).agg(F.collect_list("run").alias("todo")), "sd-todo")
    windows = texts.select(*TID, "text").join(todo, TID).select(*TID, "text", "todo").mapInArrow(_window_rows(match, GRAM), f"{ids}, run bigint, hi bigint, lo bigint")
    windows = stored(windows, "sd-windows")
    release(docs.sparkSession)
    hashed = windows.where("hi is not null").withColumn("place", F.xxhash64(*TID, "run"))
    twice = stored(_twice(hashed, "hi", "lo").select("hi", "lo"), "sd-twice")
    again = hashed.join(twice, ["hi", "lo"]).select(*TID, "run").unionByName(windows.where("hi is null").select(*TID, "run"))
    repeated = runs_.where("whole").select(*TID, "run").unionByName(pieces.where("whole").select(*TID, "run")).unionByName(again)
    spans = stored(repeated.groupBy(*TID).agg(F.collect_list("run").alias("runs")), "sd-spans")
    release(docs.sparkSession)
    cut = texts.where("not copied").select(*TID, "text").join(spans, TID).mapInArrow(_cut(match), f"{ids}, n_removed bigint, removed array<bigint>, kept_sha256 string, kept_text binary")
    parts = stored(cut.dropDuplicates(TID), "sd-cut")
    copied = groups.where("copied").select(*TID, F.lit(True).alias("copied"))
    out = rows.join(stored(parts.join(copied, TID, "full"), "sd-parts"), TID, "left")
    none = F.expr("cast(array() as array<bigint>)")
    removed = F.when(F.col("copied"), F.array(F.lit(0).cast("long"), F.col("n_bytes"))).otherwise(F.coalesce("removed", none))
    return out.select(
        "doc_id", "n_bytes", F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        (F.size(removed) / 2).cast("long").alias("n_spans"),
        F.when(F.col("copied"), F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        removed.alias("removed"), F.when(F.col("copied"), F.lit(b"")).otherwise(F.col("kept_text")).alias("kept_text"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read_table(spark, sf_dir, "documents")).drop("removed", "kept_text")
