"""Suffix automaton against plain window search."""

import hashlib
import random
import re

import pytest

from seriesforge.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    want = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1) if n else ():
            want.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    sizes = {len(k) for k in want}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in want:
                    hit.update(range(i, i + n))
                    found |= want[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def items_of(spark):
    return lambda rows: spark.createDataFrame([(*r, 1) for r in rows], "item_id bigint, text string, doc_id int")


def test_sql(spark):
    from oracle_harness import compare
    assert compare(spark, "op3", D.op3_benchmark_decontamination, D.ORACLE_SQL, SF) == []


def case(seed):
    """Small alphabets, so that items overlap, repeat and contain each other."""
    rng = random.Random(seed)
    text = lambda n, k: " ".join(rng.choice("ABCDEFGHIJ"[:k]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 5, 9, 10, 11, 25]), 3)) for i in range(4, 30)] + [(1, None), (2, ""), (3, "--- ,"), (4, "a a a"), (None, "é ü ß 日本 x1"), (None, text(12, 2))]
    docs = [(i, text(rng.randrange(60), 4)) for i in range(60)] + [(100, None), (101, ""), (102, "É É-ü. ß/日本 X1 é ü SS ß 日本 x1"), (103, items[5][1] + "!" + items[6][1]), (7, "a b"), (7, "a b"), (None, items[3][1])]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(docs_of, items_of, seed):
    docs, items = case(seed)
    assert result(D.contamination(docs_of(docs), items_of(items))) == brute(docs, items)


def test_several_automata_give_the_same(docs_of, items_of):
    docs, items = case(3)
    assert len(list(D.automata(items_of(items), most_words=40))) > 3
    assert result(D.contamination(docs_of(docs), items_of(items), most_words=40)) == brute(docs, items)


def test_long_text_and_no_items(docs_of, items_of):
    rng = random.Random(1)
    long = " ".join(rng.choice("abcdefgh") for _ in range(200_000))
    item = " ".join("abcdefghab")
    docs = [(1, long + " " + item), (2, "x")]
    assert result(D.contamination(docs_of(docs), items_of([(5, item)]))) == brute(docs, [(5, item)])
    assert [r.contaminated for r in D.contamination(docs_of(docs), items_of([])).collect()] == [False, False]
    assert D.contamination(docs_of([]), items_of([(5, item)])).collect() == []


def test_removal_leaves_nothing(docs_of, items_of):
    item = "one two three four five six seven eight nine ten eleven twelve"
    w = item.split()
    nested = " ".join(w[:6]) + " " + item + " " + " ".join(w[6:])  # cutting the middle joins another
    docs = [(1, f"Keep, this! {item.upper()}; and that."), (2, item), (3, nested), (4, "clean"), (5, None), (6, ""), (7, "short item"), (8, "a short item b"), (9, "!!!")]
    items = [(1, item), (2, "short item")]
    out = D.without_benchmark(docs_of(docs), items_of(items))
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == docs_of(docs).columns
    assert got[1].text == "Keep, this! \n; and that." and got[8].text == "a \n b" and got[4].text == "clean" and got[5].text is None and got[6].text == ""
    assert 2 not in got and 7 not in got and got[9].text == "!!!" and got[1].n_chars == len(got[1].text)
    assert all(not r.contaminated for r in D.contamination(out, items_of(items)).collect())


def test_removal_with_several_automata_is_that_of_one(docs_of, items_of):
    """Items that share a question or an answer, dealt to different automata."""
    question, answers = " ".join(f"q{i}" for i in range(12)), [" ".join(f"a{k}x{i}" for i in range(8)) for k in range(8)]
    items = [(k, f"{question} {a}") for k, a in enumerate(answers)]
    docs = [(k, f"before it {question} {a} after it") for k, a in enumerate(answers)]
    # a cut by one share joins words into an item of another
    w, inner = answers[0].split() + answers[1].split(), " ".join(f"n{i}" for i in range(11))
    items += [(20, " ".join(w)), (21, inner)]
    docs += [(20, f"keep {' '.join(w[:7])} {inner} {' '.join(w[7:])} keep"), (21, " ".join(w[:7]) + " " + inner + " " + " ".join(w[7:])), (22, "clean"), (23, None), (24, "!!!")]
    assert len(list(D.automata(items_of(items), most_words=40))) > 3
    one, several = ({r.doc_id: (r.text, r.n_chars) for r in D.without_benchmark(docs_of(docs), items_of(items), most_words=n).collect()} for n in (D.MOST_WORDS, 40))
    assert one == several
    assert several[3][0].split() == ["before", "it", "after", "it"] and several[20][0].split() == ["keep", "keep"] and 21 not in several and several[24][0] == "!!!"
