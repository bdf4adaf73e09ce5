"""Not-modified revisits in web archives: each gets the body and headers of the response that it confirms.

A revisit (304) has no body. Its response is the latest earlier full response of the same canonical URL; where both
name a validator (entity tag, else modification date), the validators must agree. The merged headers are the response's, overlaid
with those that a 304 may carry. The as-of search goes by ranges of time that hold about equally many captures: within
a range by a window, and across ranges by each range's last response, so a URL that a third of all captures have is
dealt over many tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.archives import scan_archives, write_archive
from .common import materialize, range_cuts, range_of, read_table, scratch_root

#: Headers that a 304 response may carry and that replace the stored ones.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
RANGES = 256
#: Bytes of a split of archives: small, as those made of the pages are.
ARCHIVE_SPLIT = 1 << 20


def canonical_url(url: str | Column) -> Column:
    """Host in lower case without user, default port and leading www.; path without a last slash; query without
    tracking parameters, sorted; no scheme and no fragment. Path and query keep their case."""
    c = F.trim(F.col(url) if isinstance(url, str) else url)
    bare = F.regexp_replace(F.regexp_replace(c, r"#.*$", ""), r"(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^.*@|:(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"(?i)^(utm_[a-z]*|ref)(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def header_entries(headers: str | Column) -> Column:
    """Headers as sorted (name, value) entries: names in lower case, values that aren't null; of one name's values the greatest."""
    h = F.col(headers) if isinstance(headers, str) else headers
    pairs = F.transform(F.map_entries(h), lambda e: F.struct(F.lower(e["key"]).alias("name"), e["value"].alias("value")))
    ordered = F.array_sort(F.filter(pairs, lambda e: e["value"].isNotNull()))
    return F.coalesce(F.filter(ordered, lambda e, i: ~F.get(ordered, i + 1)["name"].eqNullSafe(e["name"])), F.array().cast("array<struct<name:string,value:string>>"))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Every revisit with the response that it confirms.

    captures: record_id, url, captured_at (timestamp), kind ('response' or 'revisit'), etag, last_modified (strings or
    null) and headers (map of strings); all other columns are ignored. A response with a null time or URL answers
    nothing, and a revisit with one stays unresolved. Responses at the revisit's own time are not earlier. Of several
    latest responses the one with the greatest record_id is taken, null being the least; of several with that record_id
    too, the one with the greatest entity tag, modification date and headers, in this order. A response without validators, and a revisit without
    any, agree with all. Header names are compared and given in lower case. Returns record_id, url_key, captured_at,
    status ('resolved', 'validator mismatch' or 'no earlier response'), response_id and headers (null unless resolved).
    Rows that repeat a record_id, and rows with a null one, are resolved each on its own. An empty table gives no rows.
    captures must read the same each time.
    """
    own = F.filter(header_entries("headers"), lambda e: e["name"].isin(*PERMITTED))
    thin = captures.select("record_id", canonical_url("url").alias("url_key"), "captured_at", "kind", "etag", "last_modified", F.when(F.col("kind") == "revisit", own).alias("own"))
    placed = F.col("url_key").isNotNull() & F.col("captured_at").isNotNull()
    thin = materialize(thin.filter("kind in ('response', 'revisit')").withColumn("micros", F.when(placed, F.unix_micros("captured_at"))), "captures")
    lost = thin.filter("kind = 'revisit' and micros is null").withColumn("hit", F.lit(None).cast("struct<captured_at:timestamp,record_id:long,etag:string,last_modified:string>"))
    rows = thin.filter("micros is not null").withColumn("part", range_of(F.col("micros"), range_cuts(thin, "micros", RANGES)))
    rows = rows.withColumn("full", F.when(F.col("kind") == "response", F.struct("captured_at", F.col("record_id").cast("long").alias("record_id"), "etag", "last_modified")))
    lasts = rows.filter("full is not null").groupBy("url_key", "part").agg(F.max("full").alias("tail"))
    revisits = rows.filter("kind = 'revisit'")
    marks = revisits.select("url_key", "part").distinct().join(lasts, ["url_key", "part"], "full_outer")
    before = Window.partitionBy("url_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("carried", F.last("tail", ignorenulls=True).over(before)).select("url_key", "part", "carried")
    # Of equal times the revisits come first; the greatest response so far is the latest earlier one.
    inside = Window.partitionBy("url_key", "part").orderBy("captured_at", F.when(F.col("kind") == "revisit", 0).otherwise(1)).rowsBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("inner", F.max("full").over(inside)).filter("kind = 'revisit'")
    found = near.join(carried, ["url_key", "part"], "left").withColumn("hit", F.coalesce("inner", "carried"))
    columns = ["record_id", "url_key", "captured_at", "etag", "last_modified", "own", "hit"]
    found = found.select(*columns).unionByName(lost.select(*columns))
    same = F.when(F.col("etag").isNotNull() & F.col("hit.etag").isNotNull(), F.regexp_replace("etag", "^W/", "") == F.regexp_replace("hit.etag", "^W/", "")).when(
        F.col("last_modified").isNotNull() & F.col("hit.last_modified").isNotNull(), F.col("last_modified") == F.col("hit.last_modified")
    ).otherwise(F.lit(True))
    status = F.when(F.col("hit").isNull(), "no earlier response").when(same, "resolved").otherwise("validator mismatch")
    found = found.withColumn("status", status).withColumn("answer", F.when(F.col("status") == "resolved", F.struct("url_key", "hit")))
    # A response's time, URL, id and validators name it; of responses that agree in all, the greatest headers are taken.
    key = F.struct(canonical_url("url").alias("url_key"), F.struct("captured_at", F.col("record_id").cast("long").alias("record_id"), "etag", "last_modified").alias("hit"))
    stored = captures.filter("kind = 'response'").groupBy(key.alias("answer")).agg(F.max(header_entries("headers")).alias("stored"))
    merged = found.join(stored, "answer", "left")
    names = F.transform("own", lambda e: e["name"])
    headers = F.concat(F.filter("stored", lambda e: ~F.array_contains(names, e["name"])), F.col("own"))
    return merged.select("record_id", "url_key", "captured_at", "status", F.col("answer.hit.record_id").alias("response_id"), F.when(F.col("status") == "resolved", F.map_from_entries(headers)).alias("headers"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Captures made of `pages`: each page is a response, and each odd page is asked for again a while later.

    A page's entity tag follows its html. Every fifth page's second request names a tag that no response has.
    """
    tag = F.substring(F.sha2(F.coalesce("html", F.lit("")), 256), 1, 16)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60)
    first = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", at.alias("captured_at"), F.lit("response").alias("kind"), tag.alias("etag"), F.lit(None).cast("string").alias("last_modified"),
        F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("etag"), tag, F.lit("cache-control"), F.lit("max-age=60")).alias("headers"),
    )
    asked = F.when(F.col("page_id") % 5 == 0, F.lit("stale")).otherwise(tag)
    again = pages.filter("page_id % 2 = 1").select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", (at + F.expr("INTERVAL 12 HOURS")).alias("captured_at"), F.lit("revisit").alias("kind"), asked.alias("etag"), F.lit(None).cast("string").alias("last_modified"),
        F.create_map(F.lit("etag"), asked, F.lit("cache-control"), F.lit("max-age=90"), F.lit("set-cookie"), F.lit("a=b")).alias("headers"),
    )
    return first.unionByName(again)


def _report(out: DataFrame) -> DataFrame:
    headers = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return out.select("record_id", "url_key", F.unix_seconds("captured_at").alias("captured_s"), "status", "response_id", headers.alias("headers"))


def revisit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(resolve_revisits(page_captures(read_table(spark, sf_dir, "pages"))))


def archive_captures(members: DataFrame) -> DataFrame:
    """Captures of the records of an archive, as sources.archives reads them: responses, and revisits whose status is 304.

    The number at the end of a record's id is its record_id, else a hash of it. Records that can't be read are left out; so are
    those of other kinds. A date that is none is null, and its capture comes before all others.
    """
    number = F.coalesce(F.regexp_extract("record_id", r"(\d+)>?$", 1).try_cast("long"), F.xxhash64("record_id"))
    kept = members.filter("error is null and (kind = 'response' or (kind = 'revisit' and status = 304))")
    return kept.select(
        number.alias("record_id"), "url", F.try_to_timestamp("captured_at", F.lit("yyyy-MM-dd'T'HH:mm:ssX")).alias("captured_at"), "kind", F.element_at("headers", "etag").alias("etag"), F.element_at("headers", "last-modified").alias("last_modified"), "headers",
    )


def archive_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """revisit_report() of the same captures, written to a web archive and read back by splits of its files."""
    pages = read_table(spark, sf_dir, "pages")
    bodies = pages.select((F.col("page_id") * 2).alias("record_id"), F.encode("html", "UTF-8").alias("body"))
    captures = page_captures(pages).join(bodies, "record_id", "left").select(
        "kind", "url", F.date_format("captured_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured_at"), F.concat(F.lit("urn:capture:"), F.col("record_id").cast("string")).alias("record_id"),
        F.when(F.col("kind") == "revisit", 304).otherwise(200).alias("status"), "headers", "body",
    )
    path = f"{scratch_root(spark)}/archive-{uuid.uuid4().hex}"
    write_archive(captures, path)
    return _report(resolve_revisits(archive_captures(scan_archives(spark, path, ARCHIVE_SPLIT))))


#: DuckDB SQL for revisit_report over `pages`.
REPORT_SQL = r"""
WITH cut AS (
  SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', '') AS bare FROM pages),
parts AS (
  SELECT page_id, html,
    regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^.*@|:(80|443)$', '', 'g'), '^www\.', '') AS host,
    regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]*|ref)(=|$)', 'i'))) AS q
  FROM cut),
keyed AS (
  SELECT page_id, host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url_key,
         substr(sha256(coalesce(html, '')), 1, 16) AS tag, 1700000000 + page_id * 60 AS s FROM parts),
asked AS (
  SELECT page_id * 2 + 1 AS record_id, url_key, s + 43200 AS captured_s, CASE WHEN page_id % 5 = 0 THEN 'stale' ELSE tag END AS etag
  FROM keyed WHERE page_id % 2 = 1),
hits AS (
  SELECT a.*, r.page_id * 2 AS hit, r.tag,
         row_number() OVER (PARTITION BY a.record_id ORDER BY r.s DESC NULLS LAST, r.page_id DESC) AS n
  FROM asked a LEFT JOIN keyed r ON r.url_key = a.url_key AND r.s < a.captured_s)
SELECT record_id, url_key, captured_s,
  CASE WHEN hit IS NULL THEN 'no earlier response' WHEN etag = tag THEN 'resolved' ELSE 'validator mismatch' END AS status,
  CASE WHEN etag = tag THEN hit END AS response_id,
  CASE WHEN etag = tag THEN 'cache-control: max-age=90' || chr(10) || 'content-type: text/html' || chr(10) || 'etag: ' || etag END AS headers
FROM hits WHERE n = 1
"""
