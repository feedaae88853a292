"""Benchmark decontamination with a generalised suffix automaton (operator 3).

The normalised words of all test items go into one suffix automaton. Every
document's words are streamed through it: the state is the longest suffix of the
words so far that occurs in some item, with its length. A word is hit if it lies
in ``window`` consecutive item words (length limit), or in all the words of an
item that has fewer (coverage limit). A document is read once, from left to
right; memory is the automaton and one document.

The automaton is sent to every task, so its size is checked: the items are dealt
into as many automata of at most about ``most_words`` words as that takes, and
the documents pass them one after the other. Nothing is left out beyond that
size, it takes one more pass for each automaton.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.llm.common import hidden, read_table, stored, utf8

WINDOW = 10
MOST_WORDS = 2_000_000  # of the items in one automaton (about 1 GB at the very most)
#: A-Z lower-cased, every other ASCII character but digits and letters a space
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(rb"[^ ]+")


class Automaton:
    """Suffix automaton of several word sequences, marked with what ends a hit."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, seq in items:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        #: for each state: (words of the hit, items) of the window and of each
        #: short item that ends there
        marks: list[dict[int, set[str]]] = [{} for _ in self.next]
        for item, seq in items:
            state = 0
            for i, w in enumerate(seq, 1):
                state = self.next[state][w]  # the prefix itself, so always there
                n = window if len(seq) >= window else len(seq)
                if i >= n:
                    u = state
                    while self.length[self.link[u]] >= n:
                        u = self.link[u]
                    marks[u].setdefault(n, set()).add(item)
        #: own marks and those of all shorter suffixes
        self.marks: list[list[tuple[int, frozenset[str]]] | None] = [None] * len(marks)
        for u in sorted(range(1, len(marks)), key=self.length.__getitem__):
            own = [(n, frozenset(x)) for n, x in marks[u].items()]
            self.marks[u] = (own + (self.marks[self.link[u]] or [])) or None

    def _extend(self, last: int, w: bytes) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: bytes, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = c
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs [from, to) of hit words, and the items that occur."""
        nxt, link, length, marks = self.next, self.link, self.length, self.marks
        runs: list[tuple[int, int]] = []
        found: set[str] = set()
        state = matched = 0
        for i, w in enumerate(words):
            to = nxt[state].get(w)
            if to is None:
                while state and to is None:
                    state = link[state]
                    to = nxt[state].get(w)
                if to is None:
                    matched = 0
                    continue
                matched = length[state]
            state = to
            matched += 1
            here = marks[state]
            if here:
                longest = 0
                for n, items in here:
                    if n <= matched:
                        found |= items
                        longest = max(longest, n)
                if longest:
                    start = i + 1 - longest
                    while runs and runs[-1][1] >= start:
                        start = min(start, runs.pop()[0])
                    runs.append((start, i + 1))
        return runs, found


def _merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted([*a, *b]):
        if out and out[-1][1] >= lo:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def automata(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW, most_words: int = MOST_WORDS) -> Iterator[Automaton]:
    """One automaton for each share of the items. An item without words has no
    window. Equal ids count as one item; a null id counts as the id ''."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), utf8(text).alias("text"))
    size = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    shares = max(1, -(-size // (2 * most_words)))  # a word takes two bytes at least
    rows = rows.withColumn("share", F.pmod(F.xxhash64("item", "text"), F.lit(shares)))
    for k in range(shares):
        share = [(r["item"], bytes(r["text"]).translate(NORMAL).split()) for r in rows.where(F.col("share") == k).select("item", "text").toLocalIterator()]
        yield Automaton([x for x in share if x[1]], window)


def _scan(auto: Automaton, at: int) -> callable:
    """Adds to the columns runs and items what this automaton finds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs0, items0 = (batch.column(i) for i in range(at, at + 3))
            n_words, runs, items = [], [], []
            for k in range(batch.num_rows):
                words = texts[k].as_py().translate(NORMAL).split()
                hit, found = auto.hits(words)
                n_words.append(len(words))
                before = runs0[k].as_py()
                runs.append([x for r in _merged(hit, list(zip(before[::2], before[1::2]))) for x in r])
                items.append(sorted(found | set(items0[k].as_py())))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(at + 1)), pa.array(runs, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string())), pa.array(n_words, pa.int64())],
                names=[*batch.schema.names[:at + 3], "n_words"])
    return run


def scan(docs: DataFrame, keep: list[str], text: str, parts: list[Automaton]) -> DataFrame:
    """``keep`` columns, the text's bytes (content), runs (from, to of each
    maximal run of hit words, flat), items (sorted ids) and n_words."""
    out = docs.select(*keep, utf8(text).alias("content"), F.expr("cast(array() as array<bigint>)").alias("runs"), F.expr("cast(array() as array<string>)").alias("items"))
    for k, auto in enumerate(parts):
        if k:  # one automaton at a time in memory
            out = stored(out.drop("n_words"), "decontaminate")
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)
        out = out.mapInArrow(_scan(auto, len(keep)), f"{kinds}, n_words bigint")
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, most_words: int = MOST_WORDS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit, n_items,
    items_sha256 (of the sorted ids, comma-joined; of '' without any),
    contaminated, and runs: the maximal runs of hit words as from, to, ... Null
    and empty texts have no words and are clean; with no items all is clean."""
    rows = scan(docs.select(F.col("doc_id"), F.col("text")), ["doc_id"], "text", list(automata(items, window=window, most_words=most_words)))
    n_hit = F.aggregate("runs", F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-1).cast("bigint").alias("sign")),
                        lambda acc, x: F.struct((acc["sum"] + acc["sign"] * x).alias("sum"), (-acc["sign"]).alias("sign")), lambda acc: acc["sum"])
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("runs") > 0).alias("contaminated"),
                       F.array_join(F.col("runs").cast("array<string>"), ",").alias("runs"))


def _cut(content: bytes, runs: list[tuple[int, int]]) -> bytes:
    """``content`` with a newline in place of each of the runs of words."""
    spans = [m.span() for m in WORD.finditer(content.translate(NORMAL))]
    pieces, last = [], 0
    for lo, hi in runs:
        pieces.append(content[last:spans[lo][0]])
        last = spans[hi - 1][1]
    return b"\n".join([*pieces, content[last:]])


def _remover(auto: Automaton, at: int) -> callable:
    """Rewrites the text in column ``at`` until no hit of the one automaton is left;
    column at + 1 is whether it has been cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, hits = [], []
            for value, before in zip(batch.column(at), batch.column(at + 1)):
                text, hit = value.as_py(), before.as_py()
                while text is not None and (runs := auto.hits(text.translate(NORMAL).split())[0]):
                    text, hit = _cut(text, runs), True
                texts.append(text)
                hits.append(hit)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(at)), pa.array(texts, pa.binary()), pa.array(hits, pa.bool_())], names=batch.schema.names)
    return run


def _gather(auto: Automaton, at: int) -> callable:
    """Adds to the runs in column at + 2 the hits in the text in column ``at``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, before in zip(batch.column(at), batch.column(at + 2)):
                text, runs = value.as_py(), before.as_py()
                hits = [] if text is None else auto.hits(text.translate(NORMAL).split())[0]
                out.append([x for r in _merged(hits, list(zip(runs[::2], runs[1::2]))) for x in r])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(at + 2)), pa.array(out, pa.list_(pa.int64()))], names=batch.schema.names)
    return run


def _cutter(at: int) -> callable:
    """Cuts the gathered runs; the text is marked as cut if there are any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, hits = [], []
            for value, before, found in zip(batch.column(at), batch.column(at + 1), batch.column(at + 2)):
                runs = found.as_py()
                texts.append(_cut(value.as_py(), list(zip(runs[::2], runs[1::2]))) if runs else value.as_py())
                hits.append(before.as_py() or bool(runs))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(at)), pa.array(texts, pa.binary()), pa.array(hits, pa.bool_())], names=batch.schema.names[:at + 2])
    return run


def without_benchmark(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, most_words: int = MOST_WORDS) -> DataFrame:
    """``docs`` with every hit run of words cut out of its text (a newline in its
    place), again until none is left; documents of which no word is left go.
    All other documents, null and empty ones too, stay as they are. If there is
    an integer column n_chars it is set to the new number of code points.

    With several automata the hits of all of them are gathered on the same text and
    cut together, round by round until a round finds none, as one automaton would."""
    if text not in docs.columns:
        raise ValueError(f"no column {text}")
    body, flag, found = hidden(docs, "body"), hidden(docs, "hit"), hidden(docs, "found")
    rest = [c for c in docs.columns if c != text]
    at = len(rest)
    flat = docs.select(*rest, F.col(text).cast("binary").alias(body), F.lit(False).alias(flag))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema.fields)
    parts = list(automata(items, window=window, most_words=most_words))
    if len(parts) == 1:
        out = flat.mapInArrow(_remover(parts[0], at), kinds)
    else:
        out, done = None, []
        while True:
            runs = flat.withColumn(found, F.expr("cast(array() as array<bigint>)"))
            for auto in parts:
                runs = stored(runs.mapInArrow(_gather(auto, at), f"{kinds}, `{found}` array<bigint>"), "decontaminate")
            # documents without a hit of any share are done, the others are cut and looked at again
            done.append(runs.where(F.size(found) == 0).drop(found))
            hit = runs.where(F.size(found) > 0)
            if hit.isEmpty():
                break
            flat = stored(hit.mapInArrow(_cutter(at), kinds), "decontaminate")
        for one in done:
            out = one if out is None else out.unionByName(one)
    # a document that had no hit stays, with or without words
    out = out.withColumn(body, F.col(body).cast("string"))
    some = F.length(F.regexp_replace(body, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", "")) > 0
    out = out.where(~F.col(flag) | some).withColumnRenamed(body, text).select(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(text).isNull(), F.col("n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType))
    return out


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: The same by n-gram joins.
ORACLE_SQL = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM item WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM lowered, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT DISTINCT doc_id, i, grams.n, item_id FROM grams JOIN windows ON grams.n = windows.n AND grams.g = windows.g),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::varchar)), ',') AS ids FROM found GROUP BY doc_id),
places AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM found),
spans AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM places),
runs AS (SELECT doc_id, run, min(p) - 1 AS lo, max(p) AS hi FROM spans GROUP BY doc_id, run),
joined AS (SELECT doc_id, sum(hi - lo) AS n_hit, string_agg(lo || ',' || hi, ',' ORDER BY lo) AS runs FROM runs GROUP BY doc_id)
SELECT doc_id, len(w)::bigint AS n_words, coalesce(n_hit, 0)::bigint AS n_hit, coalesce(n_items, 0)::bigint AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(runs, '') AS runs
FROM lowered LEFT JOIN items USING (doc_id) LEFT JOIN joined USING (doc_id)
"""
