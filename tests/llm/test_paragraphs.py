"""Paragraph clusters against brute force over all pairs."""

import random

import pyarrow as pa
import pytest
from test_near_dup import shingles

from seriesforge.llm import near_dup, passages
from seriesforge.llm import paragraphs as P
from seriesforge.llm.common import read_table

SF = "/root/testdata/sf0.01"


def brute(rows, percent=80, fewest=10):
    paras = [(doc, i, line) for doc, text in rows for i, line in enumerate((text or "").split("\n")) if len(line.split()) >= fewest]
    parent, seen, sets = list(range(len(paras))), {}, [shingles(p[2]) for p in paras]

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        common = {}
        for g in s:
            for j in seen.get(g, ()):
                common[j] = common.get(j, 0) + 1
            seen.setdefault(g, []).append(i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    groups = {}
    for i, p in enumerate(paras):
        groups.setdefault(find(i), []).append(p[:2])
    out = {doc: [0, [], []] for doc, _ in rows}
    for group in groups.values():
        if len(group) > 1:
            for doc, line in sorted(group):
                out[doc][0] += 1
                out[doc][2].append((line, min(group)))
                if (doc, line) != min(group):
                    out[doc][1].append(line)
    return {doc: (n, ",".join(map(str, sorted(gone))), ",".join(f"{a}:{b}" for _, (a, b) in sorted(classes))) for doc, (n, gone, classes) in out.items()}


def result(df):
    return {r.doc_id: (r.n_repeated, r.removed, r.classes) for r in df.collect()}


def test_documents_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    out = P.op2_paragraph_dedup(spark, SF)
    assert result(out) == brute(rows)


def test_planted_passages(docs_of):
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    passage = prose(60)
    changed = passage.replace(passage.split()[30], "other", 1)
    rows = [(i, "\n".join([prose(30), changed if i % 3 == 0 else passage, prose(25)])) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, " ".join(["same"] * 40)), (204, "short line\nshort line"), (205, prose(8000)), (206, passage + "\n" + passage)]
    out = result(P.deduplicate(docs_of(rows)))
    assert out == brute(rows)
    assert out[0][0] == 1 and out[0][1] == "" and out[5][1] == "1" and out[206][1] == "0,1"
    kept = {r.doc_id: r.text for r in P.without_repeats(docs_of(rows)).collect()}
    assert kept[0] == rows[0][1] and kept[5] == "\n".join(rows[5][1].split("\n")[::2]) and kept[206] == "" and kept[200] is None


def test_null_ids_and_repeated_rows(docs_of):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(None, text), (1, text), (1, text), (2, text), (2, "x\n" + text)]
    out = sorted((str(r.doc_id), r.n_lines, r.n_repeated, r.removed) for r in P.deduplicate(docs_of(rows)).collect())
    assert out == [("1", 1, 1, "0"), ("1", 1, 1, "0"), ("2", 1, 1, "0"), ("2", 2, 1, "1"), ("None", 1, 1, "")]


def test_empty_table(docs_of):
    assert P.deduplicate(docs_of([])).collect() == []


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_bands_reach_the_recall(percent):
    b = P.tuned_bands(percent)
    assert (1 - (percent / 100) ** P.ROWS) ** b <= P.MISS < (1 - (percent / 100) ** P.ROWS) ** (b - 1)


def passages_brute(rows, n=50):
    """{doc: words that lie in a run of n words whose first place is another}"""
    first, words = {}, {doc: text.lower().split() for doc, text in rows}
    for doc in sorted(words):
        for i in range(len(words[doc]) - n + 1):
            first.setdefault(tuple(words[doc][i:i + n]), (doc, i))
    return {doc: {p for i in range(len(w) - n + 1) if first[tuple(w[i:i + n])] != (doc, i) for p in range(i, i + n)} for doc, w in words.items()}


def test_passages_inside_longer_lines(docs_of):
    """60 words in the middle of lines of 150 with other surroundings."""
    rng = random.Random(5)
    prose = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    passage, shorter, words = prose(60), prose(49), prose(55).split()
    rows = [(i, prose(45) + " " + (passage if i % 2 else passage.upper()) + " " + prose(45)) for i in range(30)]
    rows += [(40 + i, prose(20) + " " + shorter + " " + prose(20)) for i in range(3)]
    rows += [(50, " ".join(["same"] * 120)), (51, prose(700) + " " + passage[:-1]), (52, " ".join(words) + " " + prose(9) + " " + " ".join(words)), (53, passage.replace(" ", "\n"))]
    out = {r.doc_id: r for r in P.deduplicate(docs_of(rows)).collect()}
    want = passages_brute(rows)
    for doc, r in out.items():
        runs = [tuple(map(int, x.split(":"))) for x in r.passages.split(",") if x]
        assert {p for lo, hi in runs for p in range(lo, hi)} == want[doc] and r.n_cut == len(want[doc]) and r.n_passages == len(runs), doc
    assert out[7].passages == "45:105" and out[0].n_cut == out[41].n_cut == 0 and out[53].n_cut == 60 and out[52].passages == "64:119"
    kept = {r.doc_id: r.text for r in P.without_repeats(docs_of(rows)).collect()}
    assert kept[0] == rows[0][1] and kept[7].split() == rows[7][1].split()[:45] + rows[7][1].split()[105:] and kept[53] == ""


def test_short_lines(docs_of):
    """Equal short lines, alone and joined, and 60 words broken into lines of 6."""
    rng = random.Random(9)
    prose = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    nine, broken = prose(9), "\n".join(prose(6) for _ in range(10))
    rows = [(i, prose(20) + "\n" + (nine.upper() if i == 2 else nine) + "\n\n" + prose(20)) for i in range(4)]
    rows += [(10, prose(15) + "\n" + broken + "\n" + prose(15)), (11, prose(12) + "\n" + broken + "\n" + prose(12)), (12, prose(12) + "\nodd one\n" + broken), (13, ""), (14, None)]
    out = {r.doc_id: r for r in P.deduplicate(docs_of(rows)).collect()}
    assert [out[i].short for i in range(4)] == ["", "1", "1", "1"] and out[10].short == "" and out[10].n_cut == 0
    assert out[11].short == "1,2,3,4,5,6,7,8,9,10" and out[13].n_short == out[14].n_short == 0
    assert all(r.n_repeated == 0 for r in out.values())
    kept = {r.doc_id: r.text for r in P.without_repeats(docs_of(rows)).collect()}
    assert kept[0] == rows[0][1] and kept[10] == rows[4][1] and kept[2].split() == rows[2][1].split()[:20] + rows[2][1].split()[29:]
    assert not set(broken.split("\n")) & set(kept[11].split("\n")) and not set(broken.split("\n")) & set(kept[12].split("\n"))


def shared_brute(rows, n=50):
    """{doc: words that lie in a run of n words that another document holds too}"""
    holders, words = {}, {doc: (text or "").encode().lower().split() for doc, text in rows}  # bytes: A-Z and ASCII spaces alone
    for doc, w in words.items():
        for i in range(len(w) - n + 1):
            holders.setdefault(tuple(w[i:i + n]), set()).add(doc)
    return {doc: {p for i in range(len(w) - n + 1) if len(holders[tuple(w[i:i + n])]) > 1 for p in range(i, i + n)} for doc, w in words.items()}


def shared_words(rows):
    out = {r.doc_id: {p for x in r.shared.split(",") if x for p in range(*map(int, x.split(":")))} for r in rows}
    assert all(r.n_shared_words == len(out[r.doc_id]) and r.n_shared == r.shared.count(":") for r in rows)
    return out


def test_every_place_of_a_shared_passage_is_reported(docs_of):
    """Also the first place, and places in lines that are removed as paragraphs."""
    rng = random.Random(11)
    prose = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    passage, line, copied, edge, own = prose(60), prose(70), prose(200), prose(50), prose(55)
    rows = [(1, prose(40) + " " + passage + " " + prose(40)), (2, prose(30) + " " + passage.upper() + " " + prose(10)),
            (3, prose(20) + "\n" + line + "\n" + prose(20)), (4, line + "\n" + prose(30)),
            (5, copied), (6, copied.replace(" ", "\n")), (7, copied), (8, prose(20) + " " + " ".join(copied.split()[100:160])),
            (9, own + " " + prose(9) + " " + own), (10, prose(9) + " " + edge), (11, edge + " " + prose(9)), (12, " ".join(edge.split()[:49]) + " " + prose(9)),
            (13, None), (14, ""), (15, prose(300)), (16, "short")]
    out = P.deduplicate(docs_of(rows + rows[-2:])).collect()
    got = shared_words(out)
    assert got == shared_brute(rows)
    by = {r.doc_id: r for r in out}
    assert by[1].shared == "40:100" and by[1].n_passages == 0 and by[3].shared == "20:90" and by[4].n_passages == 0 and by[4].n_shared == 1
    assert by[5].n_shared_words == 200 and by[9].n_shared == by[12].n_shared == 0 and by[10].n_shared == by[11].n_shared == 1


def test_shared_passages_of_rows_without_ids(docs_of):
    text, other = " ".join(f"a{i}" for i in range(70)), " ".join(f"b{i}" for i in range(70))
    out = P.deduplicate(docs_of([(None, text), (1, text), (2, "x " + text), (2, "x " + text), (None, other), (3, other + "\nx"), (4, "y")])).collect()
    assert sorted((str(r.doc_id), r.shared) for r in out) == [("1", "0:70"), ("2", "1:71"), ("2", "1:71"), ("3", "0:70"), ("4", ""), ("None", "0:70"), ("None", "0:70")]


def test_documents_share_what_brute_force_finds(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    assert shared_words(P.op2_paragraph_dedup(spark, SF).collect()) == shared_brute(rows)


def test_lines_of_a_batch():
    """A line is cut out of the bytes of its text, in Python: no row for each line goes there."""
    texts = ["a b\nc", "", "\n", "x\n\ny\n", "one", "\n\nz"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(range(10, 16)), pa.array([t.encode() for t in texts], pa.binary())], names=["doc_id", "doc_hash", "text"])
    for part in (batch, batch.slice(2, 3)):
        got = [(r["doc_id"], r["doc_hash"], r["line"], r["text"].decode().removesuffix("\n")) for b in P._lines(iter([part])) for r in b.to_pylist()]
        assert got == [(d, d + 10, i, line) for d in part.column(0).to_pylist() for i, line in enumerate(texts[d].split("\n"))]


def test_texts_are_stored_by_no_step(docs_of, monkeypatch):
    """Passages are searched in whole texts and in what is left of them at once; what is
    left is not written, and no step reads a row for each line."""
    rng, written = random.Random(13), []
    prose = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    line, passage = prose(20), prose(60)
    rows = [(1, line + "\n" + prose(20) + " " + passage), (2, prose(30) + "\n" + line + "\n" + passage + " " + prose(9)), (3, prose(70))]
    for module in (P, passages, near_dup):
        put = module.stored
        monkeypatch.setattr(module, "stored", lambda df, label, *by, put=put: written.append((label, df.columns)) or put(df, label, *by))
    out = {r.doc_id: r for r in P.deduplicate(docs_of(rows)).collect()}
    assert written and not [x for x in written if "text" in x[1]]
    # passages count words without the removed line, shared with it
    assert out[2].removed == "1" and out[2].passages == "30:90" and out[2].shared == "50:110" and out[1].shared == "40:100"
