"""WARC: revisit records resolved by an as-of join.

A not-modified revisit carries no payload; it stands for the latest earlier full response of its canonical URL,
if the validators agree. The join is a window over (URL, block of captures) for what lies in the same block, and
a second one over a row per block for what earlier blocks hand on, so that a URL with a third of all records is
spread over its blocks and no task holds it whole.

Of two responses at one time the one of the larger record id counts as later; a response at the time of the
revisit itself is not earlier. Validators: a payload digest on both sides must agree; else a strong ETag on both
sides; else Last-Modified; where nothing can be compared the revisit is unverified. Headers: those of the stored
response, with the ones that a not-modified answer may update taken from the revisit.

Defined results: a record with a null URL or time is kept as unresolved; repeated rows resolve alike; an empty table gives no rows; a
null header map is an empty one; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: Headers that a not-modified answer may update; all else stays as stored.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: Blocks of time that the captures are cut into, by quantiles; it only sets how finely one URL is dealt out.
BLOCKS = 64


def canonical_url(url: Column) -> Column:
    """Lower-case host without www. and default port; no scheme, no fragment, no trailing slash or index page, no tracking parameters, the rest sorted.

    What has no scheme has no host to tell either: but for its fragment it stays as it is.
    """
    bare = F.regexp_replace(F.btrim(url), "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1), r"(/index\.html?)?/*$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(r"^(utm_\w+|ref|sessionid|sid|fbclid|gclid)(=|$)")))
    whole = F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    return F.when(bare.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), whole).otherwise(bare)


def _bounds(records: DataFrame, blocks: int) -> list[int]:
    """Times that cut the captures into blocks of about as many each, so that no far-off time makes the others share one."""
    shares = [k / blocks for k in range(1, blocks)]
    if not shares:
        return []
    return sorted(set(records.agg(F.percentile_approx("at", shares)).first()[0] or []))


def resolve(records: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """One row for each revisit: record_id, key, status, target (the response's record_id) and merged headers.

    records: record_id, type ('response' or 'revisit'), url, at (long), digest, headers (map, lower-case names).
    status: 'resolved', 'unverified', 'mismatch' (target null, headers the revisit's own) or 'missing'.
    """
    rows = records.select(
        "record_id", "type", "at", "digest", canonical_url(F.col("url")).alias("key"),
        F.coalesce(F.array_sort(F.map_entries("headers")), F.expr("cast(array() as array<struct<key:string,value:string>>)")).alias("headers"),
    )
    bounds, odd = _bounds(records, blocks), F.col("key").isNull() | F.col("at").isNull()
    span = F.size(F.filter(F.array(*[F.lit(x) for x in bounds]), lambda x: x <= F.col("at"))) if bounds else F.lit(0)
    rows = rows.withColumn("span", F.when(odd, -1 - F.pmod(F.xxhash64("record_id"), F.lit(blocks))).otherwise(span))  # what can't resolve is spread
    full = (F.col("type") == "response") & F.col("key").isNotNull() & F.col("at").isNotNull()
    rows = rows.withColumn("stored", F.when(full, F.struct("at", "record_id", "digest", "headers")))
    latest = rows.filter(full).groupBy("key", "span").agg(F.max("stored").alias("last"))
    before = Window.partitionBy("key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.select("key", "span").distinct().join(latest, ["key", "span"], "left")
    carried = spans.select("key", "span", F.max("last").over(before).alias("carried")).filter(F.col("carried").isNotNull())
    near = Window.partitionBy("key", "span").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    here = rows.withColumn("near", F.max("stored").over(near)).filter(F.col("type") == "revisit")
    found = here.join(carried, ["key", "span"], "left").withColumn("hit", F.coalesce("near", "carried"))
    return found.select("record_id", "key", *_judged())


def _judged() -> list[Column]:
    own, old = F.map_from_entries("headers"), F.map_from_entries(F.col("hit.headers"))
    header = lambda m, name: F.element_at(m, F.lit(name))
    strong = lambda m: F.when(~F.startswith(header(m, "etag"), F.lit("W/")), header(m, "etag"))
    checks = (
        (F.col("digest"), F.col("hit.digest")),
        (strong(own), strong(old)),
        (header(own, "last-modified"), header(old, "last-modified")),
    )
    status = F.lit("unverified")
    for ours, theirs in reversed(checks):
        status = F.when(ours.isNotNull() & theirs.isNotNull(), F.when(ours == theirs, "resolved").otherwise("mismatch")).otherwise(status)
    status = F.when(F.col("hit").isNull(), "missing").otherwise(status)
    taken = status.isin("resolved", "unverified")
    fresh = F.map_filter(own, lambda k, v: k.isin(list(PERMITTED)))
    kept = F.map_filter(old, lambda k, v: ~F.map_contains_key(fresh, k))
    merged = F.when(taken, F.map_concat(kept, fresh)).otherwise(own)
    return [status.alias("status"), F.when(taken, F.col("hit.record_id")).alias("target"), merged.alias("headers")]


def records_of_pages(pages: DataFrame) -> DataFrame:
    """A capture log over the pages: each page as a full response, and a not-modified revisit of it later on.

    Some revisits lack a digest, some have one that disagrees, and some come no later than the response.
    """
    digest = F.md5(F.coalesce("html", F.lit("")))
    n = F.col("page_id")
    response = pages.select(
        (n * 2).alias("record_id"), F.lit("response").alias("type"), "url", n.alias("at"), digest.alias("digest"),
        F.create_map(F.lit("etag"), F.substring(digest, 1, 8), F.lit("content-type"), F.lit("text/html"), F.lit("date"), n.cast("string")).alias("headers"),
    )
    revisit = pages.select(
        (n * 2 + 1).alias("record_id"), F.lit("revisit").alias("type"), F.concat("url", F.lit("#again")).alias("url"),
        F.when(n % 11 == 0, n).otherwise(n + 1000).alias("at"),
        F.when(n % 5 == 0, None).when(n % 7 == 0, F.concat(F.lit("0"), digest)).otherwise(digest).alias("digest"),
        F.create_map(F.lit("etag"), F.substring(digest, 1, 8), F.lit("x-trace"), F.lit("1"), F.lit("date"), (n + 1000).cast("string")).alias("headers"),
    )
    return response.unionByName(revisit)


def query(spark, sf_dir: str) -> DataFrame:
    out = resolve(records_of_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return out.select("record_id", "key", "status", "target", F.array_join(lines, "\n").alias("headers"))


_KEY_SQL = r"""(
  SELECT CASE WHEN NOT regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN u ELSE h || CASE WHEN p = '' THEN '/' ELSE p END || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END FROM (SELECT
    regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g') AS h,
    regexp_replace(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '(/index\.html?)?/*$', '') AS p,
    list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_\w+|ref|sessionid|sid|fbclid|gclid)(=|$)'))) AS q))"""
SQL = rf"""
WITH p AS (
  SELECT page_id AS n, md5(coalesce(html, '')) AS d, regexp_replace(trim(url), '#.*$', '') AS u FROM pages WHERE url IS NOT NULL
), k AS (SELECT *, {_KEY_SQL} AS key FROM p
), resp AS (
  SELECT key, n AS at, max(n * 2) AS id, arg_max(d, n) AS d FROM k GROUP BY key, n
), rev AS (
  SELECT n * 2 + 1 AS record_id, key, CASE WHEN n % 11 = 0 THEN n ELSE n + 1000 END AS at, n,
    CASE WHEN n % 5 = 0 THEN NULL WHEN n % 7 = 0 THEN '0' || d ELSE d END AS dig, substring(d, 1, 8) AS etag FROM k
), j AS (
  SELECT v.*, s.id, s.d AS old, s.at AS old_at FROM rev v ASOF LEFT JOIN resp s ON v.key = s.key AND v.at > s.at
), g AS (
  SELECT *, CASE WHEN id IS NULL THEN 'missing' WHEN dig IS NOT NULL THEN CASE WHEN dig = old THEN 'resolved' ELSE 'mismatch' END
    WHEN etag = substring(old, 1, 8) THEN 'resolved' ELSE 'mismatch' END AS status FROM j
)
SELECT record_id, key, status, CASE WHEN status = 'resolved' THEN id END AS target,
  CASE WHEN status = 'resolved' THEN 'content-type: text/html' || chr(10) || 'date: ' || (n + 1000) || chr(10) || 'etag: ' || etag
    ELSE 'date: ' || (n + 1000) || chr(10) || 'etag: ' || etag || chr(10) || 'x-trace: 1' END AS headers
FROM g
"""
