"""Queries over column functions that no other query shows: URLs, VINs, numbers, overlays and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, records, text, urls
from .base import query, table

_PARTED = r"SELECT page_id, url, regexp_replace(url, '#.*$', '') AS bare, regexp_extract(url, '^([a-z]+)://', 1) AS s, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS h, regexp_extract(regexp_replace(url, '#.*$', ''), '^[a-z]+://[^/?]*([^?]*)', 1) AS p FROM pages"


@query(
    "f_page_urls",
    rf"""WITH u AS ({_PARTED}) SELECT page_id, p = '/en' OR starts_with(p, '/en/') AS in_scope, nullif(regexp_extract(p, '^/([^/]+)', 1), '') AS brand,
len(list_filter(string_split(p, '/'), lambda x: x <> '')) > 1 AS landed, [s || '://' || h || '/x', 'http://c.d/e'] AS links,
CASE WHEN s = 'https' AND ends_with(h, '.com') AND starts_with(p, '/en/') THEN 'https://' || h || p || CASE WHEN contains(bare, 'page=2') THEN '?page=2&ref=x' ELSE '' END END AS public, CASE WHEN s <> 'https' THEN 'scheme' WHEN NOT ends_with(h, '.com') THEN 'host' WHEN NOT starts_with(p, '/en/') THEN 'path' END AS error FROM u""",
)
def f_page_urls(spark: SparkSession, d: str) -> DataFrame:
    """Scope, brand, landing, links and public form of page URLs."""
    pages = table(spark, d, "pages")
    root = F.regexp_extract("url", r"^([a-z]+://[^/?#]*)", 1)
    links = urls.resolve_links("url", F.array(*(F.lit(x) for x in ("/x", "#a", "mailto:b", "HTTP://C.d:80/e#f", "/x", "javascript:y"))))
    public = urls.public_url("url", r"\.com$", "^/en/", ["page", "ref"])
    return pages.select(
        "page_id", urls.in_scope("url", F.concat(root, F.lit("/en/"))).alias("in_scope"), urls.brand_from_url("url").alias("brand"), urls.landing_redirect("url", F.concat(root, F.lit("/"), urls.brand_from_url("url"))).alias("landed"),
        links.alias("links"), public["value"].alias("public"), public["error"].alias("error"),
    )


@query("f12_unit_urls", "SELECT p_partkey, p_partkey % 4 = 0 AS canonical FROM part")
def f12(spark: SparkSession, d: str) -> DataFrame:
    """Which unit URLs are a unit's own: another number, a second one and another path are not."""
    k = F.col("p_partkey")
    tail = F.when(k % 4 == 1, F.concat((k + 1).cast("string"), F.lit(""))).when(k % 4 == 2, F.concat(k.cast("string"), F.lit("&uid="), k.cast("string"))).otherwise(k.cast("string"))
    url = F.concat(F.when(k % 4 == 3, "https://a.b/v?uid=").otherwise("https://a.b/u?uid="), tail)
    return table(spark, d, "part").select("p_partkey", urls.canonical_unit_url(url, k, r"https://a\.b/u\?uid=\d+(?:&uid=\d+)?").alias("canonical"))


_RAW_VIN = "CASE p_partkey % 4 WHEN 0 THEN ' ' || lower(substr(md5(p_name), 1, 17)) WHEN 1 THEN 'O' || upper(substr(md5(p_name), 1, 16)) WHEN 2 THEN upper(substr(md5(p_name), 1, 16)) ELSE upper(substr(md5(p_name), 1, 17)) END"


@query(
    "f_vins",
    f"""WITH v AS (SELECT p_partkey, p_type, p_size, p_brand, {_RAW_VIN} AS raw FROM part), n AS (SELECT *, CASE WHEN p_partkey % 4 IN (0, 3) THEN upper(trim(raw)) END AS vin FROM v)
SELECT p_partkey, p_partkey % 4 = 3 AS is_vin, vin, 'vin:' || sha256(vin) AS source_key, CASE p_size WHEN 1 THEN 'ENGINE' WHEN 2 THEN 'BODY' ELSE 'CATEGORY ' || p_size END AS category, 'https://a.b/s?q=' || upper(replace(p_brand, ' ', '')) AS link, string_split(p_type, ' ')[1] AS main, string_split(p_type, ' ')[3] AS small,
upper(regexp_replace(regexp_replace('  ' || p_brand || ' (' || p_type || ')', '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS header, CASE WHEN p_partkey % 2 <> 0 THEN [] WHEN p_size = 11 THEN [11] ELSE [p_size, 11] END AS codes, starts_with(p_brand, 'Brand#1') AS matched FROM n""",
)
def f_vins(spark: SparkSession, d: str) -> DataFrame:
    """VINs, keys, codes and names made of parts."""
    k, digest = F.col("p_partkey"), F.md5("p_name")
    raw = F.when(k % 4 == 0, F.concat(F.lit(" "), F.lower(F.substring(digest, 1, 17)))).when(k % 4 == 1, F.concat(F.lit("O"), F.upper(F.substring(digest, 1, 16)))).when(k % 4 == 2, F.upper(F.substring(digest, 1, 16))).otherwise(F.upper(F.substring(digest, 1, 17)))
    vin = text.normalize_vin(raw)
    codes = F.concat(F.when(k % 2 == 0, F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(", 11,x"))).otherwise("none"), F.lit(" - 77"))
    level = text.split_path(F.replace("p_type", F.lit(" "), F.lit(" > ")))
    return table(spark, d, "part").select(
        "p_partkey", text.is_vin(raw).alias("is_vin"), vin.alias("vin"), text.vin_source_key(vin).alias("source_key"), text.category_name("p_size", {1: "ENGINE", 2: "BODY"}).alias("category"), text.part_link(text.part_key("p_brand"), "https://a.b/s?q=%s").alias("link"),
        level["main"].alias("main"), level["small"].alias("small"), text.header_key(F.concat(F.lit("  "), "p_brand", F.lit(" ("), "p_type", F.lit(")"))).alias("header"), text.error_codes(codes).alias("codes"), text.matches("p_brand", "Brand#1", prefix=True).alias("matched"),
    )


@query(
    "d_years",
    "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 AND p_size BETWEEN 1 AND 9998 THEN p_size END AS model_year, CASE WHEN p_partkey % 4 = 0 THEN 'given' WHEN p_partkey % 4 = 1 THEN '2001 - ' || 2001 + p_size WHEN p_partkey % 4 = 2 THEN '- 2009' END AS period, CASE WHEN p_partkey % 2 = 0 THEN 'month' ELSE 'unknown' END AS precision FROM part",
)
def d_years(spark: SparkSession, d: str) -> DataFrame:
    """Model years, periods made of years, and precision."""
    k, size = F.col("p_partkey"), F.col("p_size")
    raw = F.when(k % 3 == 0, F.concat(size.cast("string"), F.lit("x"))).when(k % 3 == 1, size.cast("string")).otherwise("9999")
    period = dates.period_text(F.when(k % 4 == 0, " given ").otherwise(" "), F.when(k % 4 == 1, 2001), F.when(k % 4 == 1, 2001 + size).when(k % 4 == 2, 2009))
    return table(spark, d, "part").select("p_partkey", dates.model_year(raw).alias("model_year"), period.alias("period"), dates.precision(F.when(k % 2 == 0, "2001-01"), F.lit(None).cast("string")).alias("precision"))


@query(
    "j_overlays",
    """WITH e AS (SELECT event_id, CAST(props->>'$.k' AS INT) AS k, event_type AS t FROM events) SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'k=' || k || ',t=' || t WHEN 1 THEN 'k=null,t=' || t ELSE 'k=' || k || ',n=1,t=' || t END AS merged, CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'k=null' ELSE 'n=1' END AS diff FROM e""",
)
def j_overlays(spark: SparkSession, d: str) -> DataFrame:
    """Overrides merged over a source, an explicit null included, and what an edit changes."""
    e = table(spark, d, "events")
    k = records.json_text("props", "k")
    source = F.create_map(F.lit("k"), k, F.lit("t"), F.col("event_type"))
    edit = F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("k"), k)).when(F.col("event_id") % 3 == 1, F.create_map(F.lit("k"), F.lit(None).cast("string"))).otherwise(F.create_map(F.lit("n"), F.lit("1"), F.lit("k"), k))
    shown = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda x: F.concat(x["key"], F.lit("="), F.coalesce(x["value"], F.lit("null")))), ",")
    return e.select("event_id", shown(records.overlay(source, edit)).alias("merged"), shown(records.overlay_diff(source, edit)).alias("diff"))


@query(
    "h_keys",
    """SELECT p_partkey, sha256(strlen(p_brand) || ':' || p_brand || strlen(p_name) || ':' || p_name || '0:') AS identity, sha256(length(trim(p_brand)) || ':' || upper(trim(p_brand)) || length(trim(p_name)) || ':' || upper(trim(p_name))) AS entry, sha256('["' || p_brand || '",null,"' || p_size || '"]') AS fingerprint FROM part""",
)
def h_keys(spark: SparkSession, d: str) -> DataFrame:
    """Identity, entry and content keys (H3, H4, H5)."""
    part = table(spark, d, "part").withColumn("none", F.lit(None).cast("string"))
    return part.select("p_partkey", records.identity_hash(["p_brand", "p_name", "none"]).alias("identity"), records.entry_key([F.concat(F.lit(" "), "p_brand"), "p_name"]).alias("entry"), records.content_fingerprint(["p_brand", "none", "p_size"]).alias("fingerprint"))
