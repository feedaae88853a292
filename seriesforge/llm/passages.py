"""Repeated passages of words, wherever lines begin and end (operator 2).

A passage is a run of ``PASSAGE`` words of a text. Of the starts in it that leave
room for a unit of ``UNIT`` words the one with the lowest hash of its next five
words is an anchor (winnowing), so equal passages have an anchor at the same place
and therefore an equal unit there. Only passages whose anchor starts a unit that occurs
more than once are hashed. Neighbours with the same anchor are a chunk; equal chunks
hold equal passages, so chunks are compared first and passages only of one chunk of
each kind. No repeated passage is missed; chunks and passages of equal 128-bit hash
count as equal.

``repeated_passages`` gives what can be cut, all places of a passage but the first.
``repeated_and_shared`` gives that of the texts without some of their lines, and every
place of the passages of the whole texts that stand in other documents too, the first
included; each text is read once for both, to find the anchors and to hash chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm import bytesplit as B
from seriesforge.llm.common import drop_stored, release, stored

PASSAGE = 50
UNIT = 25
U64 = np.uint64


def _lowest(x: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each ``n`` consecutive entries."""
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:len(x) - (n - width)], x[n - width:])


def _lowest_at(x: np.ndarray, n: int) -> np.ndarray:
    """The place of the last smallest of each ``n`` consecutive entries."""
    def lower(a: int, b: int | None) -> tuple[np.ndarray, np.ndarray]:
        right = x[a:] <= x[:b]
        return np.where(right, x[a:], x[:b]), np.where(right, at[a:], at[:b])

    at, width = np.arange(len(x)), 1
    while 2 * width <= n:
        x, at = lower(width, -width)
        width *= 2
    return lower(n - width, len(x) - (n - width))[1]


def anchors(hashed: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The words of a block where a unit starts; ``text`` is the text of each word."""
    n, span = len(hashed) - PASSAGE + 1, PASSAGE - UNIT + 1
    if n <= 0:
        return np.empty(0, np.int64)
    value = B.shingle_hashes(hashed, 5)
    lowest = np.where(text[:n] == text[PASSAGE - 1:], _lowest(value, span)[:n], U64(0))
    around = np.zeros(span - 1, U64)
    # of all passages that reach a start the highest of their lowest: its own value if it is the lowest of one
    highest = ~_lowest(~np.concatenate((around, lowest, around)), span)
    return np.flatnonzero((highest == value[:n + span - 1]) & (highest > 0))


def _sums(hashed: np.ndarray) -> np.ndarray:
    """Prefix sums of the words as a polynomial modulo 2**64."""
    total = np.zeros(len(hashed) + 1, U64)
    np.cumsum(hashed * B.powers(len(hashed)), out=total[1:])
    return total


def _hashes(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the words of each run from ``lo`` to ``hi``."""
    return B.mix((sums[hi] - sums[lo]) * B.powers(len(sums), inverse=True)[lo] + B.mix((hi - lo).astype(U64))).view(np.int64)


def _words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of each word of a block, first word of each text, first byte of each word."""
    data = B.LOWER[data]
    starts, ends, first = B.words(data, off)
    return B.word_hashes(data, starts, ends), np.repeat(np.arange(len(off) - 1), np.diff(first)), first, starts


def _outside(data: np.ndarray, off: np.ndarray, starts: np.ndarray, text: np.ndarray, gone: pa.ListArray) -> np.ndarray:
    """Whether each word of a block lies outside the lines ``gone`` of its text."""
    breaks = np.zeros(len(data) + 1, np.int32)
    np.cumsum(data == 10, out=breaks[1:])
    line = np.zeros(int(breaks[-1]) + len(off), bool)  # all lines of the block; a text begins a new one
    owner = np.repeat(np.arange(len(off) - 1), np.diff(np.asarray(gone.offsets)))
    line[breaks[off[owner]] + owner + np.asarray(gone.flatten())] = True
    return ~line[breaks[starts] + text]


def _lists(found: np.ndarray, first: np.ndarray, text: np.ndarray, hashed: np.ndarray, mask: np.ndarray | None = None) -> list[pa.Array]:
    """The units and the starts of the anchors ``found``, a list for each text."""
    bounds, none = pa.array(np.searchsorted(found, first).astype(np.int32)), None if mask is None else pa.array(mask)
    return [pa.ListArray.from_arrays(bounds, pa.array(_hashes(_sums(hashed), found, found + UNIT)), mask=none),
            pa.ListArray.from_arrays(bounds, pa.array((found - first[text[found]]).astype(np.int32)), mask=none)]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, data, off in B.blocks(batch.column(2)):
            hashed, text, first, _ = _words(data, off)
            rows = batch.slice(at, len(off) - 1)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *_lists(anchors(hashed, text), first, text, hashed)], names=["doc_id", "doc_hash", "unit", "start"])


def _sequence_hashes(hashed: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of all words of each text in their order."""
    place = np.arange(len(hashed)) - np.repeat(first[:-1], np.diff(first))
    total = np.zeros(len(hashed) + 1, U64)
    np.cumsum(B.mix(hashed + B.mix(place.astype(U64))), out=total[1:])
    return B.mix(total[first[1:]] - total[first[:-1]])


def _both_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the texts that hold a passage: the number of words and a 128-bit hash of all
    of them, the units as ``_units`` has them, and those of the text without the lines
    in column 3, null where there are no such lines."""
    for batch in batches:
        for at, data, off in B.blocks(batch.column(2)):
            hashed, text, first, starts = _words(data, off)
            rows, size = batch.slice(at, len(off) - 1), np.diff(first)
            gone = rows.column(3)
            less = np.diff(np.asarray(gone.offsets)) > 0
            left = np.flatnonzero(less[text] & _outside(data, off, starts, text, gone))
            lefthash, lefttext = hashed[left], text[left]
            sequences = (_sequence_hashes(x, first).view(np.int64) for x in (hashed, B.mix(hashed ^ U64(0x8EBC6AF09C88C6E3))))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(size.astype(np.int32)), *map(pa.array, sequences), *_lists(anchors(hashed, text), first, text, hashed),
                 *_lists(anchors(lefthash, lefttext), np.searchsorted(lefttext, np.arange(len(off))), lefttext, lefthash, ~less)],
                names=["doc_id", "doc_hash", "n_words", "s1", "s2", "unit", "start", "left_unit", "left_start"]).filter(pa.array(size >= PASSAGE))


def _first_in_text(text: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
    """Whether each chunk is the first of its kind in its text."""
    order = np.lexsort((c2, c1, text))
    same = np.zeros(len(order), bool)
    same[order[1:]] = np.logical_and.reduce([x[order[1:]] == x[order[:-1]] for x in (text, c1, c2)])
    return ~same


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks whose anchor is one of the places in column 3: their first passage,
    the number of their passages, a 128-bit hash of all their words, and one of each
    of their passages. Column 4 tells whether those that stand in the text before come
    without hashes, neighbours as one; column 5, if there is one, has lines that the
    text is taken without."""
    for batch in batches:
        for at, data, off in B.blocks(batch.column(2)):
            hashed, text, first, begin = _words(data, off)
            rows = batch.slice(at, len(off) - 1)
            if batch.num_columns > 5:
                left = np.flatnonzero(_outside(data, off, begin, text, rows.column(5)))
                hashed, text = hashed[left], text[left]
                first = np.searchsorted(text, np.arange(len(off)))
            once, n = rows.column(4).to_numpy(zero_copy_only=False), max(0, len(hashed) - PASSAGE + 1)
            lists = rows.column(3)
            units = np.asarray(lists.flatten()) + np.repeat(first[:-1], np.diff(np.asarray(lists.offsets)))
            wanted = np.zeros(len(hashed) + 1, bool)
            wanted[units] = True
            lowest = _lowest_at(B.shingle_hashes(hashed, 5), PASSAGE - UNIT + 1)[:n] if n else np.empty(0, np.int64)
            starts = np.flatnonzero((text[:n] == text[PASSAGE - 1:]) & wanted[lowest])
            # the anchors of consecutive passages never go back: equal ones are neighbours
            new = np.ones(len(starts), bool)
            new[1:] = lowest[starts[1:]] != lowest[starts[:-1]]
            bounds = np.append(np.flatnonzero(new), len(starts))
            lo, hi = starts[bounds[:-1]], starts[bounds[1:] - 1] + PASSAGE
            sums = [_sums(x) for x in (hashed, B.mix(hashed ^ U64(0x8EBC6AF09C88C6E3)))]
            c1, c2 = (_hashes(x, lo, hi) for x in sums)
            head = _first_in_text(text[lo], c1, c2) | ~once[text[lo]]
            # a chunk without hashes goes on in the next one if that has none either
            begins = head.copy()
            begins[:1] = True
            begins[1:] |= head[:-1] | (lo[1:] != hi[:-1] - PASSAGE + 1) | (text[lo[1:]] != text[lo[:-1]])
            begin = np.flatnonzero(begins)
            n = np.add.reduceat(np.diff(bounds), begin) if len(begin) else np.empty(0, np.int64)
            kept = np.repeat(head, np.diff(bounds))
            lo, head = lo[begin], head[begin]
            none, lists = pa.array(~head), np.append(0, np.cumsum(np.where(head, n, 0))).astype(np.int32)
            row, places = pa.array(text[lo]), starts[kept]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(row), rows.column(1).take(row), pa.array((lo - first[text[lo]]).astype(np.int32)), pa.array(n.astype(np.int32)),
                 *(pa.array(x[begin], mask=~head) for x in (c1, c2)),
                 *(pa.ListArray.from_arrays(pa.array(lists), pa.array(_hashes(x, places, places + PASSAGE)), mask=none) for x in sums), rows.column(4).take(row)],
                names=["doc_id", "doc_hash", "start", "n", "c1", "c2", "h1", "h2", "own"])


def _each(chunks: DataFrame, *columns: str) -> DataFrame:
    """A row (start, h1, h2) for each passage of the chunks whose hashes are kept."""
    places = F.sequence(F.col("start"), F.col("start") + F.col("n") - 1).alias("start")
    return chunks.where("h1 is not null").select(*columns, F.inline(F.arrays_zip(places, "h1", "h2")))


def repeated_passages(texts: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, runs): of each document the words, as runs from, to, ... in
    order, that lie in a passage whose first place is another. Places are ordered by
    (doc_id, start, doc_hash). ``texts`` (doc_id, doc_hash, text: bytes) is a stored
    table without nulls in text; rows equal in doc_id and doc_hash are one document."""
    units = stored(texts.mapInArrow(_units, f"doc_id {_kind(texts)}, doc_hash bigint, unit array<bigint>, start array<int>"), "para-units")
    places = _places(units, True)
    drop_stored(units)
    chunks = _chunks_at(texts, places)
    out = _repeated(chunks)
    drop_stored(chunks)
    return out


def repeated_and_shared(texts: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables (doc_id, doc_hash, runs): the repeated passages as in
    :func:`repeated_passages`, of the texts without the lines ``gone`` (d, h, gone: a
    row for each document that has some, words counted without them), and of the whole
    texts the words that lie in a passage which another document holds too, whichever
    is first. Of documents with the same words one is searched for the latter; the
    others share all they have."""
    spark, none = texts.sparkSession, F.array().cast("array<int>")
    units = texts.join(gone, F.expr("doc_hash = h and doc_id <=> d"), "left").select("doc_id", "doc_hash", "text", F.coalesce("gone", none).alias("gone"))
    units = units.mapInArrow(_both_units, f"doc_id {_kind(texts)}, doc_hash bigint, n_words int, s1 bigint, s2 bigint, unit array<bigint>, start array<int>, left_unit array<bigint>, left_start array<int>")
    document = F.xxhash64("doc_id", "doc_hash")
    units = stored(units.withColumn("document", document), "para-all-units")
    release(spark)
    copies = stored(units.groupBy("s1", "s2").agg(F.min("document").alias("one"), F.max("document").alias("last")).where("one <> last").drop("last"), "para-copies")
    searched = units.join(copies, ["s1", "s2"], "left").where("one is null or document = one").select("doc_id", "doc_hash", "unit", "start")
    searched = stored(searched, "para-searched")
    whole = stored(units.join(copies, ["s1", "s2"], "left_semi").select("doc_id", "doc_hash", F.array(F.lit(0), "n_words").alias("runs")).distinct(), "para-whole")
    drop_stored(copies)
    release(spark)
    places = _places(searched, False)
    drop_stored(searched)
    # the places in whole texts, and those in texts without the lines
    left = _places(units.select("doc_id", "doc_hash", F.coalesce("left_unit", "unit").alias("unit"), F.coalesce("left_start", "start").alias("start")), True)
    drop_stored(units)
    less = gone.select(F.col("d").alias("a"), F.col("h").alias("b"), "gone")
    wanted = left.join(less, F.expr("h = b and d <=> a"), "left").select("d", "h", "starts", "own", F.coalesce("gone", none).alias("gone"))
    chunks = _chunks_at(texts, wanted.unionAll(places.select("d", "h", "starts", "own", none.alias("gone"))))
    drop_stored(places, left)
    out = _repeated(chunks.where("own")), _shared(chunks.where("not own"), whole)
    drop_stored(chunks, whole)
    return out


def _kind(texts: DataFrame) -> str:
    return texts.schema["doc_id"].dataType.simpleString()


def _repeated(chunks: DataFrame) -> DataFrame:
    spark = chunks.sparkSession
    place = F.struct("doc_id", "start", "doc_hash")
    first = stored(chunks.where("c1 is not null").groupBy("c1", "c2").agg(F.min(place).alias("first")), "para-chunk-firsts")
    # all passages of a chunk that has its first place elsewhere have theirs there or before
    head = place.eqNullSafe(F.col("first"))
    found = chunks.join(first, ["c1", "c2"]).select("doc_id", "doc_hash", "start", "n", *(F.when(head, F.col(x)).alias(x) for x in ("h1", "h2")))
    found = stored(found.unionByName(chunks.where("c1 is null").drop("c1", "c2", "own")), "para-found-chunks")
    drop_stored(first)
    release(spark)
    passages = _each(found, "doc_id", "doc_hash")
    first = passages.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("not (first <=> last)").drop("last")
    first = stored(first, "para-firsts")
    later = passages.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first"))).select("doc_id", "doc_hash", "start", F.lit(1).alias("n"))
    out = stored(_joined(later.unionAll(found.where("h1 is null").select("doc_id", "doc_hash", "start", "n"))), "para-runs")
    drop_stored(found, first)
    release(spark)
    return out


def _shared(chunks: DataFrame, whole: DataFrame) -> DataFrame:
    spark, document = chunks.sparkSession, F.xxhash64("doc_id", "doc_hash")
    holders = stored(chunks.groupBy("c1", "c2").agg(F.min(document).alias("one"), F.max(document).alias("last")), "para-holders")
    # one document of each chunk is asked for its passages
    found = chunks.join(holders, ["c1", "c2"]).select("doc_id", "doc_hash", "start", "n", "one", "last", *(F.when(document == F.col("one"), F.col(x)).alias(x) for x in ("h1", "h2")))
    found = stored(found, "para-held-chunks")
    drop_stored(holders)
    release(spark)
    passages = _each(found, "one", "last").groupBy("h1", "h2").agg(F.min("one").alias("one"), F.max("last").alias("last"), F.max(F.expr("one = last")).alias("open"))
    passages = stored(passages.where("one <> last and open").select("h1", "h2"), "para-shared")
    more = _each(found.where("one = last"), "doc_id", "doc_hash").join(passages, ["h1", "h2"]).select("doc_id", "doc_hash", "start", F.lit(1).alias("n"))
    runs = _joined(more.unionAll(found.where("one <> last").select("doc_id", "doc_hash", "start", "n")))
    copied = whole.select(F.col("doc_id").alias("d"), F.col("doc_hash").alias("h"))
    out = stored(runs.join(copied, F.expr("doc_hash = h and doc_id <=> d"), "left_anti").unionAll(whole), "para-shared-runs")
    drop_stored(found, passages)
    release(spark)
    return out


def _places(units: DataFrame, own: bool) -> DataFrame:
    """(d, h, starts, own): of each document the places of units that occur more than
    once, stored. With ``own`` a second time in one document counts, otherwise units of
    two documents do. ``units`` (doc_id, doc_hash, unit, start) comes from a stored table."""
    spark = units.sparkSession
    again = stored(units.select(F.explode("unit" if own else F.array_distinct("unit")).alias("unit")).groupBy("unit").agg(F.count("*").alias("n")).where("n > 1").select("unit"), "para-again")
    release(spark)
    places = units.select("doc_id", "doc_hash", F.posexplode("unit").alias("i", "unit"), "start").select("doc_id", "doc_hash", "unit", F.get("start", "i").alias("start")).join(again, "unit").groupBy("doc_id", "doc_hash").agg(F.collect_set("start").alias("starts"))
    places = stored(places.select(F.col("doc_id").alias("d"), F.col("doc_hash").alias("h"), "starts", F.lit(own).alias("own")), "para-places")  # bounded by the text
    drop_stored(again)
    release(spark)
    return places


def _chunks_at(texts: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, start, n, c1, c2, h1, h2, own): the chunks at ``places`` (d, h,
    starts, own and perhaps gone), stored. With ``own`` what stands in the same document
    before comes without hashes."""
    near = texts.join(places, F.expr("doc_hash = h and doc_id <=> d")).select("doc_id", "doc_hash", "text", *places.columns[2:])
    kinds = f"doc_id {_kind(texts)}, doc_hash bigint, start int, n int, c1 bigint, c2 bigint, h1 array<bigint>, h2 array<bigint>, own boolean"
    found = stored(near.mapInArrow(_chunks, kinds), "para-chunks", "own")
    release(texts.sparkSession)
    return found


def _joined(starts: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, runs) of the ``n`` passages from each ``start`` on."""
    kind = starts.schema["doc_id"].dataType.simpleString()
    lists = starts.groupBy("doc_id", "doc_hash").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("starts"))  # bounded by the text
    return lists.mapInArrow(_runs, f"doc_id {kind}, doc_hash bigint, runs array<int>")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for starts in batch.column(2):
            s = np.asarray(starts.values.field("start"))
            end = s + np.asarray(starts.values.field("n")) - 1 + PASSAGE
            gap = np.flatnonzero(s[1:] > end[:-1])
            out.append(np.stack([s[np.append(0, gap + 1)], end[np.append(gap, len(s) - 1)]], axis=1).ravel())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], names=["doc_id", "doc_hash", "runs"])


def cut(at: int) -> callable:
    """Cuts the runs of words in column at + 1 and the lines in column at + 2, if any,
    out of the text in column ``at``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, runs, lines in zip(batch.column(at), batch.column(at + 1), batch.column(at + 2)):
                body, places, gone = text.as_py(), runs.as_py() or [], lines.as_py() or []
                if places or gone:
                    starts, ends, _ = B.words(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
                    spans = [(int(starts[lo]), int(ends[hi - 1])) for lo, hi in zip(places[::2], places[1::2])]
                    breaks = [-1, *(i for i, c in enumerate(body) if c == 10), len(body)] if gone else []
                    spans += [(breaks[i] + 1, min(breaks[i + 1] + 1, len(body))) for i in gone]
                    pieces, last = [], 0
                    for lo, hi in sorted(spans):
                        pieces.append(body[last:max(lo, last)])
                        last = max(hi, last)
                    body = b"".join([*pieces, body[last:]])
                texts.append(body)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(at)), pa.array(texts, pa.binary())], names=batch.schema.names[:at + 1])
    return run
