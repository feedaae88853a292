"""Base spans against the documented patterns, and what the classifier adds."""

import hashlib
import re

from pyspark.sql import functions as F

from seriesforge.llm import pii as P
from seriesforge.llm.common import read_table

SF = "/root/testdata/sf0.01"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def check(rows, out):
    want = {}
    for doc, text in rows:
        want.setdefault(doc, []).append(brute(text))
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append(r)
    assert want.keys() == got.keys()
    for doc, spans in want.items():
        key = lambda s: ",".join(f"{k}:{a}:{b}" for k, a, b in s)
        assert sorted(hashlib.sha256(key(s).encode()).hexdigest() for s in spans) == sorted(r.base_sha256 for r in got[doc])
        if len(spans) == 1:
            r = got[doc][0]
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans[0]) for k in P.KINDS]
            assert {f"{k}:{a}:{b}" for k, a, b in spans[0]} <= set(r.spans.split(","))  or not spans[0]


def query(docs):
    found = P.personal_data(docs.select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("pii", lambda c: c["base"])
    return found.select("doc_id", *(P._number(k).alias(f"n_{k}") for k in P.KINDS), F.sha2(P._listed(base), 256).alias("base_sha256"), P._listed(F.col("pii")).alias("spans")).collect()


def test_documents_against_the_patterns(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF, "documents").collect()]
    out = P.op10_weak_supervision_pii(spark, SF)
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    check(rows, out.collect())


def test_hard_texts(docs_of):
    card = "4111 1111-1111 1111"
    texts = [None, "", "a@b.c_d@e.f @x.y z@w", "é😀 me@x.org.", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3.0000255 99999999999999999999.1.1.1", f"x{card} 4111111111111112 {card}1",
             "1" * 5000, "a" * 100_000, "1." * 60_000, "+1 (640) 555-0953, +12 +123 +1234567 8 ().-9( +44.20.7946.0958.", "a.b@" * 20_000, "x@y" + ".z" * 50_000, "+" + "1 " * 50_000,
             "a@b.co " * 800, "1-2 3--4 5 - 6", "+1+2@3.4.5.6", "0.0.0.0 255.255.255.255", "me@x.y,me@x.y;" + "4" * 16]
    rows = list(enumerate(texts)) + [(3, "twice@id.com"), (None, "no@id.net"), (77, "x"), (77, "x")]
    check(rows, query(docs_of(rows)))


def test_empty_table_and_no_candidates(docs_of):
    assert query(docs_of([])) == []
    assert [r.spans for r in query(docs_of(["nothing here"]))] == [""]


def test_em_finds_the_unreliable_labeler(spark):
    """Four labelers are right nine times in ten, one half the time."""
    import random
    rng = random.Random(2)
    rows = {}
    for _ in range(4000):
        y = 1 if rng.random() < 0.6 else -1
        votes = tuple(y * (1 if rng.random() < a else -1) for a in (0.9, 0.9, 0.9, 0.9, 0.5))
        rows[votes] = rows.get(votes, 0) + 1
    out = {tuple(r.votes): r.y for r in P.posteriors(spark.createDataFrame([(list(v), n) for v, n in rows.items()], "votes array<int>, n bigint")).collect()}
    assert out[1, 1, 1, 1, -1] > 0.99 and out[-1, -1, -1, -1, 1] < 0.01
    assert abs(out[1, 1, -1, -1, 1] - out[1, 1, -1, -1, -1]) < 0.1


def test_adds_close_candidates_and_masks(docs_of):
    good = [(i, f"call me: +1 ({600 + i}) 555-01{i:02d} or mail: u{i}@site{i}.com from host 10.1.2.{i}") for i in range(90)]
    near = [(500, "phone: (640) 555-0953 please"), (501, "mail: joe (at) site (dot) com now"), (502, "version 1.2.3.999 of 4111111111111112x")]
    docs = docs_of(good + near)
    spans = {r.doc_id: r.spans for r in query(docs)}
    assert spans[500] == "phone:7:21" and spans[501] == "email:6:29" and spans[502] == ""
    out = {r.doc_id: r for r in P.masked(docs).collect()}
    assert out[0].text == "call me: <PHONE> or mail: <EMAIL> from host <IP>" and out[500].text == "phone: <PHONE> please"
    assert out[502].text == near[2][1] and out[0].n_chars == len(out[0].text) and out[502].n_chars is None
    assert list(out[0].asDict()) == docs.columns


def masked_by_hand(text, spans):
    out, at = "", 0
    for start, end, kind in sorted((int(s[1]), int(s[2]), P.KINDS.index(s[0])) for s in spans):
        if start >= at:
            out += text[at:start] + f"<{P.KINDS[kind].upper()}>"
        at = max(at, end)
    return out + text[at:]


def test_masking_of_many_and_touching_spans(docs_of):
    texts = [" ".join(f"u{i}@s{i}.com é +1 (640) 555-{i % 10000:04d} 10.0.{i % 256}.1" for i in range(n)) for n in (1, 2, 7, 40, 300)]
    texts += ["+1 4111111111111111 x", "a@1.2.3.4 1.2.3.4@b.com", "a@b.co", "a@b.coc@d.ee,+12345678901+12345678902", "+4111111111111111 4111111111111111@x.org"]
    docs = docs_of(texts)
    spans = {r.doc_id: [s.split(":") for s in r.spans.split(",") if s] for r in query(docs)}
    got = {r.doc_id: r.text for r in P.masked(docs).collect()}
    assert got == {i: masked_by_hand(t, spans[i]) for i, t in enumerate(texts)}


def test_candidates_beside_base_spans_against_all_pairs(docs_of):
    texts = ["mail: joe (at) site (dot) com a@b.com " * 60, "1.2.3.4:5:6:7:8 ::1 2001:db8::1 tel (640) 555-0953 +1 (640) 555-0953 " * 50, "4111111111111111, 378282246310005; " * 40]
    docs = docs_of(texts)
    every = {r.doc_id: r.c for r in P.candidates(docs, "text", "c").collect()}
    for spans in every.values():
        base = [s for s in spans if s.base]
        assert base and all(not any(b.start < s.end and s.start < b.end for b in base) for s in spans if not s.base)
    # those that touch nothing are all still there
    assert [sum(not s.base and s.kind == k for s in every[i]) for i, k in ((0, 0), (1, 3), (2, 2))] == [60, 50, 40]


def test_many_spans_cost_little(docs_of):
    import time
    seconds = []
    for n in (2000, 16000):
        docs = docs_of([" ".join(f"u{i}@s{i}.com and some words" for i in range(n))])
        begin = time.time()
        assert P.masked(docs).collect()[0].text.count("<EMAIL>") == n
        seconds.append(time.time() - begin)
    assert seconds[1] < seconds[0] + 12, seconds
