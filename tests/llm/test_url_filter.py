"""List entries in time."""

import datetime as dt

from seriesforge.llm import url_filter as U

SF = "/root/testdata/sf0.01"


def d(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_sql(spark):
    from oracle_harness import compare
    assert compare(spark, "op6", U.op6_url_filters, U.ORACLE_SQL, SF) == []


def test_intervals(spark):
    rows = [("l", "k", d(1), 0, True), ("l", "k", d(5), 0, False), ("l", "k", d(5), 1, True), ("l", "k", d(9), 3, True), ("l", "k", d(9), 3, False), ("l", "k", d(12), 0, True),
            (None, "k", d(1), 0, True), ("l", None, d(1), 0, True), ("l", "k", None, 0, True), ("l", "q", d(3), 0, False)]
    out = U.intervals(spark.createDataFrame(rows, "list string, key string, day date, seq int, added boolean")).collect()
    assert sorted((r.valid_from, r.valid_to) for r in out) == [(d(1), d(5)), (d(5), d(9)), (d(12), dt.date(9999, 12, 31))]


def test_captures(spark):
    events = spark.createDataFrame([
        ("a", "host:x.example.org", d(10), 0, True), ("a", "host:x.example.org", d(20), 0, False), ("b", "domain:example.org", d(15), 0, True),
        ("c", "path:y.net/a/b", d(0), 0, True), ("c", "domain:net", d(50), 0, True)], "list string, key string, day date, seq int, added boolean")
    rows = [(1, "http://X.example.org:80/p?q", d(9)), (2, "https://u:p@x.example.org", d(10)), (3, "http://x.example.org/#f", d(19)), (4, "http://x.example.org/", d(20)),
            (5, "http://y.net/a/b/c?d", d(3)), (6, "http://y.net//a//bb", d(3)), (7, "http://y.net/a", d(60)), (8, None, d(3)), (9, "no url", d(99)), (10, "http://y.net/a/b", None),
            (11, "http://y.net/" + "a/" * 3000, d(1)), (2, "https://u:p@x.example.org", d(10)), (None, "http://net", d(70)), (12, "", d(1))]
    out = U.judge(spark.createDataFrame([(*r, "old", 1) for r in rows], "page_id bigint, url string, fetched date, lists string, key int"), events)
    got = sorted(((str(r.page_id), r.n_active, r.lists, r.blocked) for r in out.collect()))
    want = [(1, 0, ""), (2, 1, "a"), (3, 2, "a,b"), (4, 1, "b"), (5, 1, "c"), (6, 0, ""), (7, 1, "c"), (8, 0, ""), (9, 0, ""), (10, 0, ""), (11, 0, ""), (2, 1, "a"), (None, 1, "c"), (12, 0, "")]
    assert got == sorted((str(a), n, l, n > 0) for a, n, l in want)


def test_empty(spark):
    captures = spark.createDataFrame([(1, "http://a.b", d(1))], "page_id bigint, url string, fetched date")
    events = spark.createDataFrame([], "list string, key string, day date, seq int, added boolean")
    assert [r.blocked for r in U.judge(captures, events).collect()] == [False]
    assert U.judge(captures.limit(0), events).collect() == []


def test_other_columns_stay_and_odd_hosts(spark):
    events = spark.createDataFrame([("a", "domain:b.com", d(0), 0, True), ("b", "host:[::1]", d(0), 0, True), ("c", "path:b.com/x", d(0), 0, True)], "list string, key string, day date, seq int, added boolean")
    rows = [("http://A.B.com./", "a"), ("http://[::1]/q", "b"), ("http://[::1]:80", "b"), ("http://b.com../x", "a,c"), ("http://[::2]/", ""), ("http://.../", "")]
    captures = spark.createDataFrame([(u, d(1), "mine", 7, i) for i, (u, _) in enumerate(rows)], "url string, fetched date, u string, t int, _url int")
    out = U.judge(captures, events)
    assert out.columns == ["url", "fetched", "u", "t", "_url", "n_active", "lists", "blocked"]
    assert [(r.u, r.t, r.lists) for r in sorted(out.collect(), key=lambda r: r["_url"])] == [("mine", 7, lists) for _, lists in rows]
