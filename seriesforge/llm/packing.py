"""Best-fit packing with Martello-Toth dominance reduction (operator 9).

Documents become token ids (a public tokenizer's, then one id that ends the
document); only documents longer than a sequence are cut. How to pack depends on
nothing but how many pieces have each length, a table of at most ``capacity``
rows however many documents there are. On that histogram the plan is made:

* reduction: for the longest pieces left, a set of at most three pieces that
  dominates every other set with that length (each piece of any other feasible
  set fits in the place of one of its pieces) is fixed for good, as many times
  at once as there are pieces;
* the remainder goes by best fit, longest first, again whole runs at once.

The plan is a list of runs (length, first rank, pieces, pieces in a sequence,
first sequence, offset). It has at most a few rows for each pair of lengths: a
bound by the capacity, not by the data. Pieces of equal length are numbered by
Spark (counts of hash buckets, running sums over buckets, row numbers inside a
bucket), so no length is ever gathered in one task, and each piece finds its
place from its number.
"""

from __future__ import annotations

import math
import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesforge.llm import bytesplit as B
from seriesforge.llm.common import hidden, read_table, stored, utf8

CAPACITY = 2048
END_ID = 0
CACHED_WORDS = 2_000_000  # of one Python worker, about 100 MB
U64 = np.uint64
ASCII_LETTERS = np.zeros(256, bool)
ASCII_LETTERS[list(range(65, 91)) + list(range(97, 123))] = True
#: Byte-level pieces write a byte that is no printable Latin-1 character as one
#: from U+0100 on, in order.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
PIECE_CHARS = np.arange(256, dtype="<u4")
PIECE_CHARS[sorted(set(range(256)) - _PRINTABLE)] = 256 + np.arange(256 - len(_PRINTABLE))
PIECE_CHARS[ord(" ")] = ord(" ")  # separates the words


class WordIds:
    """Token ids of words that white space separates, each encoded once a worker.

    For tokenizers that drop white space, split at it and mark the end of a word,
    with byte-level pieces and lower case. Whole blocks of texts are cut into words
    and looked up by 64-bit hashes with array operations; only words not met
    before go to the tokenizer. A word that ends in a letter and one '.' or ','
    is looked up as the word and the mark, and A-Z equal a-z in plain words: of
    ASCII and the letters of Latin-1 that are one character (nothing there
    composes), and without '<', which may begin a special token."""

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads for a few words only wait
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.end = end
        self.clear()

    def clear(self) -> None:
        self.keys, self.slots, self.known = np.zeros(1 << 16, U64), np.zeros(1 << 16, np.int32), 0  # open addressing by hash, key 0 is free
        self.starts, self.lengths, self.ids = array("q"), array("q"), array("I")
        self._add([[self.end], *(e.ids for e in self.tokenizer.encode_batch([".", ","], add_special_tokens=False))])  # slots 0, 1, 2

    def _add(self, lists: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        self.starts.frombytes((len(self.ids) + np.cumsum(lengths) - lengths).tobytes())
        self.lengths.frombytes(lengths.tobytes())
        self.ids.frombytes(np.fromiter(chain.from_iterable(lists), np.uint32, int(lengths.sum())).tobytes())

    def _slots(self, hashed: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 if there is none."""
        last = len(self.keys) - 1
        at = (hashed & U64(last)).astype(np.int64)
        key = self.keys[at]
        hit = key == hashed
        out = np.where(hit, self.slots[at], -1)
        rest = np.flatnonzero(~hit & (key != 0))
        at = at[rest]
        while len(rest):
            at = at + 1 & last
            key = self.keys[at]
            hit = key == hashed[rest]
            out[rest[hit]] = self.slots[at[hit]]
            more = ~hit & (key != 0)
            rest, at = rest[more], at[more]
        return out

    def _keep(self, hashed: np.ndarray, slots: np.ndarray) -> None:
        """Enters hashes that differ and have no slot yet."""
        self.known += len(hashed)
        if 2 * self.known > len(self.keys):
            used = np.flatnonzero(self.keys)
            hashed, slots = np.concatenate((self.keys[used], hashed)), np.concatenate((self.slots[used], slots))
            size = 1 << (2 * self.known).bit_length()
            self.keys, self.slots = np.zeros(size, U64), np.zeros(size, np.int32)
        last = len(self.keys) - 1
        at = (hashed & U64(last)).astype(np.int64)
        while len(hashed):
            free = self.keys[at] == 0
            self.keys[at[free]] = hashed[free]  # of several for one place one stays
            put = self.keys[at] == hashed
            self.slots[at[put]] = slots[put]
            hashed, slots, at = hashed[~put], slots[~put], at[~put] + 1 & last

    def _encoded(self, words: list[bytes], plain: list[bool]) -> list[list[int]]:
        """Ids of words. Plain words of letters alone are one piece, so the
        tokenizer's merges can be asked directly."""
        out: list = [None] * len(words)
        some = [i for i, x in enumerate(plain) if x]
        text = b" ".join([words[i] for i in some]).decode("utf-8", "replace").lower()
        pieces = PIECE_CHARS[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
        tokenize = self.model.tokenize
        for i, word, piece in zip(some, text.split(" "), pieces.split(" ")):
            if word.isalpha():
                out[i] = [t.id for t in tokenize(piece)]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for at in range(0, len(rest), 4096):
            some = rest[at:at + 4096]
            for i, e in zip(some, self.tokenizer.encode_batch_fast([words[i].decode("utf-8", "replace") for i in some], add_special_tokens=False)):
                out[i] = e.ids
        return out

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a block, each text's followed by ``end``, and the offsets of the texts."""
        starts, ends, first = B.words(data, off)
        n = len(starts)
        mark = np.zeros(n, np.int64)
        slot = np.empty(0, np.int64)
        if n:
            odd = (data >= 0x80) & (data != 0xC3) | (data == ord("<"))
            odd[1:] &= (data[:-1] != 0xC3) | (data[1:] == ord("<"))
            plain = np.ones(n, bool)
            plain[np.searchsorted(starts, np.flatnonzero(odd), "right") - 1] = False
            last, size = data[ends - 1], ends - starts
            prev, third = data[np.maximum(ends - 2, 0)], data[np.maximum(ends - 3, 0)]
            letter = (size > 1) & ASCII_LETTERS[prev] | (size > 2) & (third == 0xC3) & (prev >= 0x80) & (prev != 0x97) & (prev != 0xB7)
            mark = np.where(plain & letter, (last == ord(".")) + 2 * (last == ord(",")), 0)
            core = ends - (mark > 0)
            hashed = B.word_hashes(B.LOWER[data], starts, core)
            other = np.flatnonzero(~plain)
            if len(other):
                hashed[other] = B.mix(B.word_hashes(data, starts[other], ends[other]) ^ U64(1))
            hashed = np.maximum(hashed, U64(1))
            if self.known > CACHED_WORDS:
                self.clear()
            slot = self._slots(hashed)
            new = np.flatnonzero(slot < 0)
            if len(new):
                unique, where, inverse = np.unique(hashed[new], return_index=True, return_inverse=True)
                content, which = data.tobytes(), new[where]
                made = self._encoded([content[x:y] for x, y in zip(starts[which].tolist(), core[which].tolist())], plain[which].tolist())
                slots = np.arange(len(self.starts), len(self.starts) + len(made))
                self._keep(unique, slots)
                self._add(made)
                slot[new] = slots[inverse]
        # words, their marks and the texts' ends, all in order
        texts = len(off) - 1
        marks = np.concatenate(([0], np.cumsum(mark > 0)))
        place = np.arange(n) + marks[:-1] + np.repeat(np.arange(texts), np.diff(first))
        end = first[1:] + marks[first[1:]] + np.arange(texts)
        units = np.zeros(n + int(marks[-1]) + texts, np.int64)  # slot 0: the end
        units[place] = slot
        units[place[mark > 0] + 1] = mark[mark > 0]
        lengths = np.frombuffer(self.lengths, np.int64)[units]
        at_id = np.concatenate(([0], np.cumsum(lengths)))
        shift = np.frombuffer(self.starts, np.int64)[units] - at_id[:-1]
        ids = np.frombuffer(self.ids, np.uint32)[np.repeat(shift, lengths) + np.arange(at_id[-1])]
        return ids, np.concatenate(([0], at_id[end + 1]))


_encoders: dict[tuple[str, int], WordIds] = {}


def _pieces(path: str, capacity: int, end: int, with_ids: bool) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get((path, end)) or WordIds(path, end)
        _encoders[path, end] = encoder  # the next task of this worker knows the words
        for batch in batches:
            for at, data, off in B.blocks(batch.column(1)):
                ids, at_id = encoder.encode(data, off)
                ids = ids.astype("<u4")
                row, piece, start, length, crc, lists = [], [], [], [], [], []
                for i, (a, b) in enumerate(zip(at_id[:-1].tolist(), at_id[1:].tolist())):
                    for k, lo in enumerate(range(a, b, capacity)):
                        hi = min(b, lo + capacity)
                        row.append(at + i)
                        piece.append(k)
                        start.append(lo - a)
                        length.append(hi - lo)
                        crc.append(zlib.crc32(ids[lo:hi].tobytes()))
                        if with_ids:
                            lists.append(ids[lo:hi].astype(np.int32))
                columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(lists, pa.list_(pa.int32()))] if with_ids else []), names=names + ["ids"] * with_ids)
    return run


def token_pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and
    ``end``, cut every ``capacity`` ids. A null or empty text is ``end`` alone."""
    base = docs.select(F.col(doc_id).alias("doc_id"), utf8(text).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(_pieces(tokenizer, capacity, end, with_ids), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)


class Plan:
    """Runs of places for a histogram of lengths."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = [0] * (capacity + 2)
        for length, n in counts.items():
            if not 1 <= length <= capacity:
                raise ValueError(f"a piece of {length} tokens fits in no sequence of {capacity}")
            self.left[length] = n
        self.used = [0] * (capacity + 2)  # ranks given out
        self.sequences = 0
        #: length, first rank, pieces, pieces in a sequence, first sequence, offset
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.fixed = 0
        self._reduce()
        self._best_fit()

    def _place(self, length: int, sequences: int, each: int, first: int, offset: int, pieces: int | None = None) -> None:
        n = sequences * each if pieces is None else pieces
        self.runs.append((length, self.used[length], n, each, first, offset))
        self.used[length] += n
        self.left[length] -= n

    def _fix(self, *lengths: int) -> None:
        """Makes this set sequences of its own, as often as there are pieces."""
        times = min(self.left[x] // lengths.count(x) for x in lengths)
        offset = 0
        for x in sorted(set(lengths), reverse=True):
            each = lengths.count(x)
            self._place(x, times, each, self.sequences, offset)
            offset += x * each
        self.sequences += times
        self.fixed += times * len(lengths)

    def _smallest(self, n: int, without: int) -> list[int]:
        """The ``n`` smallest lengths left besides one piece of ``without``."""
        out: list[int] = []
        for x in self.present:
            out += [x] * min(n, self.left[x] - (x == without))
            if len(out) >= n:
                break
        return out[:n]

    def _largest(self, most: int, without: tuple[int, ...]) -> int:
        """The largest length of at most ``most`` besides the pieces ``without``, 0 if there is none."""
        for x in range(min(most, self.capacity), 0, -1):
            if self.left[x] > without.count(x):
                return x
        return 0

    def _reduce(self) -> None:
        for j in range(self.capacity, 0, -1):
            while self.left[j]:
                self.present = [x for x in range(1, self.capacity + 1) if self.left[x]]
                room = self.capacity - j
                low = self._smallest(3, j)
                if not low or low[0] > room:  # nothing else fits: alone
                    self._fix(j)
                    continue
                k = self._largest(room, (j,))
                if k == room or len(low) < 2 or low[0] + low[1] > room:
                    self._fix(j, k)  # fills up, or no two others fit: the largest partner dominates
                    continue
                b = self._largest(room - k, (j, k))
                if b and (len(low) < 3 or sum(low) > room) and not self._better_second(room, b, j):
                    self._fix(j, k, b)  # no three others fit, none of a pair is larger
                    continue
                break

    def _better_second(self, room: int, b: int, j: int) -> bool:
        """Whether two others fit whose smaller one is longer than ``b``."""
        for y in range(room // 2, b, -1):
            if self.left[y] > (y == j):
                if self.left[y] - (y == j) >= 2 or any(self.left[x] > (x == j) for x in range(y + 1, room - y + 1)):
                    return True
        return False

    def _best_fit(self) -> None:
        room: list[list[tuple[int, int]]] = [[] for _ in range(self.capacity + 1)]  # by tokens free: runs of sequences
        for x in range(self.capacity, 0, -1):
            r = x
            while self.left[x]:
                while r < self.capacity and not room[r]:
                    r += 1
                if r == self.capacity:
                    each = self.capacity // x
                    first, n = self.sequences, -(-self.left[x] // each)
                    self.sequences += n
                    room[r].append((first, n))
                first, n = room[r].pop()
                each = r // x
                full = min(n, self.left[x] // each)
                if full:
                    self._place(x, full, each, first, self.capacity - r)
                    room[r - each * x].append((first, full))
                if full < n:
                    some = self.left[x]  # fewer than fill one more sequence
                    if some:
                        self._place(x, 1, each, first + full, self.capacity - r, some)
                        room[r - some * x].append((first + full, 1))
                        full += 1
                    if full < n:
                        room[r].append((first + full, n - full))


def _places(shared) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        keys = (runs[:, 0] << 44) + runs[:, 1]
        for batch in batches:
            names = batch.schema.names
            length, rank = (batch.column(names.index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            found = runs[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            nth = rank - found[:, 1]
            each = found[:, 3]
            keep = [n for n in names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(n)) for n in keep), pa.array(found[:, 4] + nth // each), pa.array(found[:, 5] + nth % each * length)], names=[*keep, "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset:
    sequences of at most ``capacity`` tokens, gapless from offset 0. Rows with a
    null doc_id or equal (doc_id, piece) are pieces like any other."""
    spark = pieces.sparkSession
    # rows are dealt by a stored number: hashes of their columns would bring equal rows together
    columns, row = pieces.columns, hidden(pieces, "row")
    pieces = stored(pieces.withColumn(row, F.monotonically_increasing_id()), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(sorted(Plan(histogram, capacity).runs), np.int64).reshape(-1, 6)
    total = sum(histogram.values())
    buckets = -(-total // max(256, math.isqrt(total)))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64(row), F.lit(max(1, buckets))))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")).select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    counts = stored(counts, "pack-counts")
    nth = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(row)) - 1
    ranked = dealt.withColumn("nth", nth).join(counts, ["length", "bucket"]).withColumn("rank", (F.col("earlier") + F.col("nth")).cast("long")).select(*columns, "rank")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*columns).schema.fields)
    return ranked.mapInArrow(_places(spark.sparkContext.broadcast(runs)), f"{kinds}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed with their ids, each at its offset."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))  # at most capacity ids
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def public_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_pieces(read_table(spark, sf_dir, "documents"), public_tokenizer()))
