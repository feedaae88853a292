"""URL filter lists in time (operator 6).

List entries come as dated events: an entry is added, removed, added again. The
last event of a day counts; each entry's days become validity intervals
[valid_from, valid_to). A capture is judged against the entries active on the
day it was fetched, an as-of join: among the keys of its URL (host, every parent
domain, host with leading path segments) an interval must hold the day.

Captures are judged once for each distinct (url, day); the join is an equi-join
on the key with the day as a condition. Both of its sides are shuffled by the
key, so a host that holds a third of all captures is split by adaptive
execution. No side is hinted for broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesforge.llm.common import hidden, read_table, stored

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)"
OPEN = "9999-12-31"


def host_of(url: str) -> Column:
    """The host in lower case, without the dots of a full name at its end; an address
    in brackets keeps them."""
    return F.lower(F.regexp_replace(F.regexp_extract(F.col(f"`{url}`"), _HOST, 1), r"\.+$", ""))


def segments_of(url: str) -> Column:
    return F.filter(F.split(F.regexp_extract(F.col(f"`{url}`"), _PATH, 1), "/"), lambda s: s != "")


def keys_of(url: str, deepest: int) -> Column:
    """host:h, domain:d for h and its parents, path:h/a, path:h/a/b ... down to
    ``deepest`` segments. A URL without a host has no keys."""
    host, labels, segments = host_of(url), F.split(host_of(url), r"\."), segments_of(url)
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    depth = F.least(F.size(segments), F.lit(deepest))
    paths = F.when(depth > 0, F.transform(F.sequence(F.lit(1), depth), lambda i: F.concat(F.lit("path:"), host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")))).otherwise(F.expr("cast(array() as array<string>)"))
    return F.when(host != "", F.concat(F.array(F.concat(F.lit("host:"), host)), domains, paths)).otherwise(F.expr("cast(array() as array<string>)"))


def intervals(events: DataFrame) -> DataFrame:
    """(list, key, valid_from, valid_to) from events (list, key, day, seq, added).

    Of several events of an entry on one day the largest seq counts, and of equal
    ones the removal. Events without a list, key, day or verdict are left out. A
    window holds one entry's days."""
    day = events.where("list is not null and key is not null and day is not null and added is not null")
    last = day.groupBy("list", "key", "day").agg(F.max_by(F.col("added"), F.struct("seq", (~F.col("added")).alias("out"))).alias("added"))
    after = F.lead("day").over(Window.partitionBy("list", "key").orderBy("day"))
    return last.withColumn("valid_to", F.coalesce(after, F.lit(OPEN).cast("date"))).where("added").select("list", "key", F.col("day").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, events: DataFrame, url: str = "url", day: str = "fetched") -> DataFrame:
    """``captures`` with n_active (active entries that match), lists (their lists,
    sorted, comma-joined) and blocked. A capture without a URL, a host or a day
    matches nothing. Columns of these names are replaced, all others stay."""
    active = stored(intervals(events), "url-intervals")
    depth = active.where("key like 'path:%'").agg(F.max(F.size(F.split("key", "/")) - 1).alias("n")).first()["n"] or 0
    distinct = captures.select(F.col(f"`{url}`").alias("u"), F.col(f"`{day}`").cast("date").alias("t")).where("u is not null and t is not null").distinct()
    keyed = distinct.select("u", "t", F.explode(F.array_distinct(keys_of("u", depth))).alias("key"))
    hits = keyed.join(active, "key").where("valid_from <= t and t < valid_to")
    own_url, own_day = hidden(captures, "url"), hidden(captures, "day")
    verdict = hits.groupBy(F.col("u").alias(own_url), F.col("t").alias(own_day)).agg(F.count("*").alias("n_active"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"))
    verdict = stored(verdict, "url-verdicts")
    rest = captures.drop("n_active", "lists", "blocked")
    out = rest.join(verdict, (rest[url] == verdict[own_url]) & (rest[day].cast("date") == verdict[own_day]), "left").drop(own_url, own_day)
    return out.withColumns({"n_active": F.coalesce("n_active", F.lit(0)).cast("long"), "lists": F.coalesce("lists", F.lit("")), "blocked": F.coalesce(F.col("n_active") > 0, F.lit(False))})


def derived_lists(pages: DataFrame) -> DataFrame:
    """Dated events of three lists, derived from the pages' own hosts, domains and
    first path segments (the tables hold no lists): entries come and go on days
    given by the smallest page_id that has the key."""
    first = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("m") % 200).cast("int"))
    host, segments = host_of("url"), segments_of("url")
    named = pages.where("url is not null and page_id is not null").select("page_id", host.alias("h"), segments.alias("s")).where("h <> ''")
    keys = named.select("page_id", F.inline(F.array(
        F.struct(F.lit("hosts").alias("list"), F.concat(F.lit("host:"), "h").alias("key"), F.lit(3).alias("every"), F.lit(60).alias("days")),
        F.struct(F.lit("domains").alias("list"), F.concat(F.lit("domain:"), F.substring_index("h", ".", -3)).alias("key"), F.lit(4).alias("every"), F.lit(20).alias("days")),
        F.struct(F.lit("paths").alias("list"), F.when(F.size("s") > 0, F.concat(F.lit("path:"), "h", F.lit("/"), F.element_at(F.col("s"), F.when(F.size("s") > 0, 1).otherwise(None)))).alias("key"), F.lit(5).alias("every"), F.lit(30).alias("days")))))
    entries = keys.where("key is not null").groupBy("list", "key", "every", "days").agg(F.min("page_id").alias("m")).where("m % every <> 0")
    return entries.select("list", "key", F.inline(F.array(
        F.struct(first.alias("day"), F.lit(0).alias("seq"), F.lit(True).alias("added")),
        F.struct(F.date_add(first, F.col("days")).alias("day"), F.lit(0).alias("seq"), F.lit(False).alias("added")),
        F.struct(F.date_add(first, F.col("days") * 2).alias("day"), F.lit(0).alias("seq"), F.lit(True).alias("added")),
        F.struct(F.date_add(first, F.col("days") * 3).alias("day"), F.lit(0).alias("seq"), F.lit(True).alias("added")),
        F.struct(F.date_add(first, F.col("days") * 3).alias("day"), F.lit(1).alias("seq"), F.lit(False).alias("added")))))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")))
    return judge(captures, derived_lists(pages)).select("page_id", "fetched", "n_active", "lists", "blocked")


ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + (page_id % 365)::int AS fetched, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS h,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1), '/'), lambda s: s <> '') AS s FROM pages),
k AS (
  SELECT page_id, 'hosts' AS list, 'host:' || h AS key, 3 AS every, 60 AS days FROM p WHERE h <> ''
  UNION ALL SELECT page_id, 'domains', 'domain:' || array_to_string(list_slice(string_split(h, '.'), greatest(1, len(string_split(h, '.')) - 2), len(string_split(h, '.'))), '.'), 4, 20 FROM p WHERE h <> ''
  UNION ALL SELECT page_id, 'paths', 'path:' || h || '/' || s[1], 5, 30 FROM p WHERE h <> '' AND len(s) > 0),
e AS (SELECT list, key, days, min(page_id) AS m FROM k GROUP BY list, key, every, days HAVING min(page_id) % every <> 0),
v AS (
  SELECT list, key, DATE '2024-01-01' + (m % 200)::int AS a, DATE '2024-01-01' + (m % 200)::int + days::int AS b FROM e
  UNION ALL SELECT list, key, DATE '2024-01-01' + (m % 200)::int + 2 * days::int, DATE '2024-01-01' + (m % 200)::int + 3 * days::int FROM e),
q AS (
  SELECT DISTINCT page_id, fetched, key FROM (
    SELECT page_id, fetched, 'host:' || h AS key FROM p WHERE h <> ''
    UNION ALL SELECT page_id, fetched, 'domain:' || array_to_string(list_slice(l, i, len(l)), '.') FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM (SELECT *, string_split(h, '.') AS l FROM p WHERE h <> ''))
    UNION ALL SELECT page_id, fetched, 'path:' || h || '/' || s[1] FROM p WHERE h <> '' AND len(s) > 0)),
j AS (SELECT page_id, count(*) AS n, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists FROM q JOIN v USING (key) WHERE a <= fetched AND fetched < b GROUP BY page_id)
SELECT page_id, fetched, coalesce(n, 0)::bigint AS n_active, coalesce(lists, '') AS lists, n IS NOT NULL AS blocked FROM p LEFT JOIN j USING (page_id)
"""
