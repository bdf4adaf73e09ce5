"""Queries over the classification rules: challenges, page kinds, decodes, secrets, ranges and vehicle names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, records, text
from ..sources.pages import BODIES, BRAND_ALIASES, BRANDS, STYLES, TWO_WORD_BRANDS, parse_pages, parse_vehicle_name
from .base import query, table

_WHITE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@query("f1_clean_text", rf"SELECT doc_id, sha256(coalesce(nullif(trim(regexp_replace(t, '{_WHITE}', ' ', 'g')), ''), '')) AS digest FROM (SELECT doc_id, replace(text, ' of ', chr(160) || 'of' || chr(8195) || chr(31)) AS t FROM documents)")
def f1(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned texts, as digests; some blanks are made the wider ones that Unicode has (F1)."""
    wide = F.replace("text", F.lit(" of "), F.lit("\u00a0of\u2003\x1f"))
    return table(spark, d, "documents").select("doc_id", F.sha2(F.coalesce(text.clean_text(wide), F.lit("")), 256).alias("digest"))


#: Responses made of pages: statuses, servers and marked bodies in turn.
_RESPONSES = """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 403 WHEN 1 THEN 200 ELSE 503 END AS status, CASE WHEN page_id % 3 = 0 THEN 'Cloudflare-x' ELSE 'nginx' END AS server,
  CASE WHEN page_id % 11 = 0 THEN 'Challenge' ELSE 'none' END AS mitigated,
  html || CASE page_id % 7 WHEN 0 THEN ' Just A moment' WHEN 1 THEN ' <p>ACCESS denied</p>' WHEN 2 THEN ' x/cdn-cgi/challenge-platform/y' WHEN 3 THEN ' captcha' ELSE '' END AS body FROM pages"""


@query(
    "c1_challenges",
    f"""WITH r AS ({_RESPONSES}), m AS (SELECT *, lower(substr(body, 1, 1000000)) AS t, contains(lower(server), 'cloudflare') AS g FROM r),
k AS (SELECT *, contains(t, 'just a moment') OR contains(t, 'enable javascript and cookies to continue') OR contains(t, '/cdn-cgi/challenge-platform/') OR contains(t, 'managed challenge') OR contains(t, 'cf-chl-') AS marked FROM m),
z AS (SELECT page_id, CASE WHEN lower(mitigated) = 'challenge' THEN 'cloudflare_challenge' WHEN marked AND g THEN 'cloudflare_challenge' WHEN marked THEN 'access_denied' WHEN status = 403 AND (g OR contains(t, 'access denied')) THEN 'access_denied' END AS reason,
  contains(substr(body, 1, 8000), 'Just a moment') OR contains(substr(body, 1, 8000), '請稍候') OR contains(substr(body, 1, 8000), 'cf_chl') AS short FROM k)
SELECT page_id, reason IS NOT NULL AS flag, reason, short FROM z""",
)
def c1(spark: SparkSession, d: str) -> DataFrame:
    """Which responses are challenge pages, and why."""
    i = F.col("page_id")
    tail = F.when(i % 7 == 0, " Just A moment").when(i % 7 == 1, " <p>ACCESS denied</p>").when(i % 7 == 2, " x/cdn-cgi/challenge-platform/y").when(i % 7 == 3, " captcha").otherwise("")
    headers = F.create_map(F.lit("Server"), F.when(i % 3 == 0, "Cloudflare-x").otherwise("nginx"), F.lit("CF-Mitigated"), F.when(i % 11 == 0, "Challenge").otherwise("none"))
    status = F.when(i % 4 == 0, 403).when(i % 4 == 1, 200).otherwise(503)
    rows = table(spark, d, "pages").select("page_id", status.alias("status"), headers.alias("headers"), F.concat("html", tail).alias("body"))
    found = rows.select("page_id", records.detect_challenge(F.col("status"), F.col("headers"), F.col("body")).alias("c"), records.starts_as_challenge(F.col("body")).alias("short"))
    return found.select("page_id", "c.flag", "c.reason", "short")


#: URLs made of pages' own: paths that name a kind, and some that don't.
_URLS = r"""SELECT page_id, html || CASE page_id % 5 WHEN 0 THEN '<table><tr><th>Part <b>Number</b></th></tr></table>' WHEN 1 THEN '<h2>Diagram 4</h2>' WHEN 2 THEN '<th>Engine</th>' ELSE '' END AS html,
  CASE page_id % 9 WHEN 0 THEN 'https://a.b/x/unit/?q=1' WHEN 1 THEN 'https://a.b/sitemap-1' WHEN 2 THEN 'https://a.b/robots.txt' WHEN 3 THEN 'https://a.b/en/search/all?q=x' WHEN 4 THEN 'https://a.b/en/catalog/genuine/' WHEN 5 THEN 'https://a.b/m.xml.gz' ELSE url END AS url FROM pages"""


@query(
    "c2_page_kinds",
    rf"""WITH u AS ({_URLS}), p AS (SELECT page_id, html, regexp_replace(url, '#.*$', '') AS bare FROM u),
q AS (SELECT *, regexp_extract(bare, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?]*)?([^?]*)', 1) AS path,
  lower(regexp_replace(array_to_string(regexp_extract_all(html, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1), ' ') || ' ' || array_to_string(regexp_extract_all(html, '(?is)<h2\b[^>]*>(.*?)</h2\s*>', 1), ' ') || ' ' || array_to_string(regexp_extract_all(html, '(?is)<th\b[^>]*>(.*?)</th\s*>', 1), ' '), '<[^>]*>', ' ', 'g')) AS raw FROM p),
r AS (SELECT *, regexp_replace(path, '/+$', '') AS cut, raw AS l FROM q),
s AS (SELECT *, regexp_extract(cut, '([^/]*)$', 1) AS route FROM r)
SELECT page_id, CASE WHEN ends_with(path, '.xml') OR ends_with(path, '.xml.gz') OR contains(path, 'sitemap') THEN 'sitemap' WHEN path = '/robots.txt' THEN 'robots' WHEN path = '/en/search/all' THEN 'search'
  WHEN route IN ('locate', 'pick', 'vehicle', 'groups', 'unit', 'parts', 'diagram') THEN route WHEN trim(html) = '' THEN 'unknown'
  WHEN contains(l, 'part number') OR contains(l, 'callout') AND contains(l, 'quantity') THEN 'parts' WHEN contains(l, 'diagram') AND NOT contains(l, 'model') THEN 'diagram'
  WHEN contains(l, 'prod period') OR contains(l, 'sales code') OR contains(l, 'chassis') OR contains(l, 'engine') THEN 'vehicle'
  WHEN regexp_matches(bare, '[?&]q=[^&]') THEN 'search' WHEN cut = '/en/catalog/genuine' THEN 'genuine_root' ELSE 'generic' END AS kind FROM s""",
)
def c2(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of pages."""
    i = F.col("page_id")
    html = F.concat("html", F.when(i % 5 == 0, "<table><tr><th>Part <b>Number</b></th></tr></table>").when(i % 5 == 1, "<h2>Diagram 4</h2>").when(i % 5 == 2, "<th>Engine</th>").otherwise(""))
    made = ["https://a.b/x/unit/?q=1", "https://a.b/sitemap-1", "https://a.b/robots.txt", "https://a.b/en/search/all?q=x", "https://a.b/en/catalog/genuine/", "https://a.b/m.xml.gz"]
    url = F.coalesce(*(F.when(i % 9 == k, F.lit(u)) for k, u in enumerate(made)), F.col("url"))
    return table(spark, d, "pages").select("page_id", records.classify_page(url, html).alias("kind"))


#: Decodes made of parts: makes, years, codes, models, engines and trims, some blank.
_DECODES = """SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN ' ' ELSE p_brand END AS make, CASE WHEN p_size % 5 = 0 THEN NULL ELSE '2012' END AS year,
  CASE p_partkey % 8 WHEN 0 THEN '0' WHEN 1 THEN '7, 8 - no' WHEN 2 THEN '8-x' WHEN 3 THEN '1,11, 400 - bad' WHEN 4 THEN '1,5' WHEN 5 THEN NULL WHEN 6 THEN 'a, 8' ELSE '0 - clean' END AS code,
  CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END AS model, CASE WHEN p_size % 7 = 0 THEN ' ' ELSE p_type END AS engine, CASE WHEN p_size % 11 = 0 THEN NULL ELSE p_type END AS trim_name, p_type AS suggested FROM part"""


@query(
    "c3_undecodable",
    f"""WITH d AS ({_DECODES}), n AS (SELECT *, list_filter(list_transform(string_split(split_part(trim(coalesce(code, '')), '-', 1), ','), lambda x: trim(x)), lambda x: regexp_matches(x, '^[0-9]+$')) AS c FROM d),
k AS (SELECT *, CASE WHEN trim(make) <> '' AND trim(coalesce(year, '')) <> '' THEN NULL WHEN list_contains(c, '7') THEN 'nhtsa_unregistered' WHEN list_contains(c, '8') THEN 'no_detail_data' WHEN len(c) > 0 AND len(list_filter(c, lambda x: x NOT IN ('1', '11', '400'))) = 0 THEN 'invalid_vin' ELSE 'no_detail_data' END AS kind FROM n)
SELECT p_partkey, kind, CASE WHEN kind IS NOT NULL THEN substr('NHTSA reports no usable decode (' || kind || ')' || CASE WHEN trim(coalesce(code, '')) <> '' THEN '; ErrorCode=''' || substr(trim(code), 1, 120) || '''' ELSE '' END || CASE WHEN trim(suggested) <> '' THEN '; SuggestedVIN=''' || substr(trim(suggested), 1, 32) || '''' ELSE '' END, 1, 400) END AS note FROM k""",
)
def c3(spark: SparkSession, d: str) -> DataFrame:
    """Why decodes are of no use, and the note that says so."""
    kind = records.undecodable_kind("code", "make", "year")
    rows = _decodes(spark, d).withColumn("kind", kind)
    return rows.select("p_partkey", "kind", records.undecodable_note(F.col("kind"), F.col("code"), F.col("suggested")).alias("note"))


def _decodes(spark: SparkSession, d: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    codes = ["0", "7, 8 - no", "8-x", "1,11, 400 - bad", "1,5", None, "a, 8"]
    code = F.when(k % 8 == 7, "0 - clean").otherwise(F.coalesce(*(F.when(k % 8 == i, F.lit(c)) for i, c in enumerate(codes) if c)))
    return table(spark, d, "part").select(
        "p_partkey", F.when(size % 4 == 0, " ").otherwise(F.col("p_brand")).alias("make"), F.when(size % 5 != 0, "2012").alias("year"), code.alias("code"), F.when(size % 3 == 0, "").otherwise(F.col("p_name")).alias("model"),
        F.when(size % 7 == 0, " ").otherwise(F.col("p_type")).alias("engine"), F.when(size % 11 != 0, F.col("p_type")).alias("trim_name"), F.col("p_type").alias("suggested"),
    )


@query(
    "c4_decode_status",
    f"""WITH d AS ({_DECODES}) SELECT p_partkey, CASE WHEN code = '0' THEN 'decoded' ELSE 'decoded_with_warning' END AS status,
CASE WHEN list_contains(string_split(replace(split_part(coalesce(code, ''), '-', 1), ' ', ''), ','), '8') THEN 'partial_no_detail_data' WHEN trim(model) = '' THEN 'partial_missing_model'
  WHEN trim(engine) = '' OR trim(coalesce(trim_name, '')) = '' THEN 'partial_missing_powertrain_or_trim' WHEN code = '0' THEN 'decoded_complete' ELSE 'decoded_complete_with_warning' END AS completeness FROM d""",
)
def c4(spark: SparkSession, d: str) -> DataFrame:
    """Status and completeness of decodes (C4)."""
    full = records.decode_completeness(F.col("code"), F.col("model"), F.col("engine"), F.col("trim_name"))
    return _decodes(spark, d).select("p_partkey", records.decode_status("code").alias("status"), full.alias("completeness"))


@query(
    "c5_fitment_verdict",
    """WITH w AS (SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m') AS a, CASE WHEN l_linenumber = 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m') END AS b, o_orderstatus = 'F' AS published FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, coalesce(NOT coalesce(a > b, false) AND published, false) AS is_verified, CASE WHEN a > b THEN 'invalid_date_intersection' WHEN published THEN 'verified_current_catalog' ELSE 'normalized_unpublished' END AS derivation, CAST(CASE WHEN a > b THEN 0 WHEN published THEN 1 ELSE 0.5 END AS DOUBLE) AS confidence FROM w""",
)
def c5(spark: SparkSession, d: str) -> DataFrame:
    """What a fitment's window and its publication say of it."""
    lines = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    until = F.when(F.col("l_linenumber") != 3, F.date_format("o_orderdate", "yyyy-MM"))
    v = records.fitment_verdict(F.date_format("l_shipdate", "yyyy-MM"), until, F.col("o_orderstatus") == "F")
    return lines.select("l_orderkey", "l_linenumber", v.alias("v")).select("l_orderkey", "l_linenumber", "v.is_verified", "v.derivation", F.col("v.confidence").cast("double").alias("confidence"))


_ESCAPED = "CASE doc_id % 6 WHEN 0 THEN ' ssd=abc' WHEN 1 THEN ' ssd%3Dx' WHEN 2 THEN ' ss%2564%253Dq' WHEN 3 THEN ' %50HPSESSID 100% sure' WHEN 4 THEN ' ssd= &x' ELSE '' END"


@query(
    "c6_secrets",
    rf"""WITH r AS (SELECT doc_id, text || {_ESCAPED} AS a FROM documents),
b AS (SELECT *, url_decode(regexp_replace(a, '%([^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|[0-9A-Fa-f]?$)', '\1', 'g')) AS b FROM r), c AS (SELECT *, url_decode(b) AS c FROM b), e AS (SELECT doc_id, a || chr(10) || b || chr(10) || c AS t FROM c)
SELECT doc_id, regexp_matches(t, '(?i)\bssd\s*=\s*[^&#\s"''<>]+|\b(?:cf_clearance|phpsessid|set-cookie|authorization)\b|__cf_chl_[A-Za-z0-9_-]+') AS secret FROM e""",
)
def c6(spark: SparkSession, d: str) -> DataFrame:
    """Texts that hold secret material, plain or escaped up to three times."""
    i = F.col("doc_id")
    tails = [" ssd=abc", " ssd%3Dx", " ss%2564%253Dq", " %50HPSESSID 100% sure", " ssd= &x"]
    tail = F.coalesce(*(F.when(i % 6 == k, F.lit(t)) for k, t in enumerate(tails)), F.lit(""))
    return table(spark, d, "documents").select("doc_id", records.has_secret(F.concat("text", tail)).alias("secret"))


@query(
    "d1_ranges",
    """WITH o AS (SELECT o_orderkey, o_orderkey % 11 AS k, strftime(o_orderdate, '%Y-%m') AS ym, strftime(o_orderdate, '%Y') AS y FROM orders)
SELECT o_orderkey, CASE k WHEN 0 THEN ym WHEN 1 THEN ym WHEN 2 THEN ym WHEN 3 THEN ym WHEN 4 THEN ym WHEN 6 THEN y || '-01' WHEN 7 THEN y || '-01' WHEN 9 THEN y || '-01' END AS start,
CASE k WHEN 0 THEN '2030-05' WHEN 2 THEN ym WHEN 3 THEN '2031-12' WHEN 5 THEN ym WHEN 6 THEN '2035-12' WHEN 8 THEN y || '-12' WHEN 9 THEN y || '-12' END AS "end",
CASE WHEN k <= 5 THEN 'month' WHEN k <= 9 THEN 'year' ELSE 'unknown' END AS precision, CASE WHEN k = 10 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS confidence, CASE WHEN k BETWEEN 3 AND 9 THEN 'site' ELSE 'generic' END AS parser FROM o""",
)
def d1(spark: SparkSession, d: str) -> DataFrame:
    """Production ranges in all their forms."""
    ym, my, y = (F.date_format("o_orderdate", f) for f in ("yyyy-MM", "MM.yyyy", "yyyy"))
    forms = [
        F.concat(ym, F.lit("-07 ～ 2030-05")), F.concat(ym, F.lit(" ~")), ym, F.concat(my, F.lit(" -  12.2031")), F.concat(my, F.lit("-")), F.concat(F.lit("- "), my), F.concat(y, F.lit("-2035")),
        F.concat(F.lit(" "), y, F.lit(" -")), F.concat(F.lit("-"), y), y, F.concat(y, F.lit(" - 1885")),
    ]
    raw = F.coalesce(*(F.when(F.col("o_orderkey") % 11 == k, f) for k, f in enumerate(forms)))
    return table(spark, d, "orders").select("o_orderkey", dates.parse_range(raw).alias("r")).select("o_orderkey", "r.*")


_IN = lambda words: ", ".join(f"'{w}'" for w in words)
_CASES = lambda c, pairs: "CASE " + " ".join(f"WHEN regexp_matches({c}, '{p.replace('(?U)', '')}') THEN '{label}'" for p, label in pairs) + " END"
_NAMES = """SELECT p_partkey, trim(CASE p_partkey % 6 WHEN 0 THEN 'Land rover ' WHEN 1 THEN 'BENZ ' WHEN 2 THEN 'mercedes benz ' WHEN 3 THEN 'toyota ' WHEN 4 THEN '' ELSE p_brand || ' ' END || p_name || '  ' || p_size * 100 || CASE WHEN p_size % 3 = 0 THEN 'cc' ELSE '' END
  || CASE WHEN p_size % 2 = 0 THEN ' 3-D 5d' ELSE ' cvt MT' END || CASE WHEN p_size % 5 = 0 THEN ' 1800 Turbo xEV hybrid suv' ELSE ' van' END) AS name FROM part"""


@query(
    "p17_vehicle_names",
    rf"""WITH n AS ({_NAMES}), w AS (SELECT p_partkey, regexp_replace(name, ' +', ' ', 'g') AS t FROM n), s AS (SELECT *, string_split(t, ' ') AS w FROM w),
b AS (SELECT *, upper(w[1]) AS f, upper(w[1] || ' ' || coalesce(w[2], '')) IN ({_IN(TWO_WORD_BRANDS)}) AS two FROM s),
r AS (SELECT *, CASE WHEN two THEN w[3:] ELSE w[2:] END AS rest, CASE WHEN two THEN upper(w[1] || ' ' || w[2]) WHEN f IN ({_IN(BRANDS)}, {_IN(BRAND_ALIASES)}) THEN f ELSE w[1] END AS named FROM b),
u AS (SELECT p_partkey, t, named, rest, unnest(rest) AS x, unnest(range(len(rest))) AS i FROM r),
k AS (SELECT *, regexp_matches(x, '(?i)^[2-7][-~]?D$') AS door, regexp_matches(x, '(?i)^[1-9]\d{{3}}(C\.?C\.?|㏄)$') AS unit, coalesce(regexp_matches(x, '^[1-9]\d{{2,3}}$') AND try_cast(x AS INT) BETWEEN 600 AND 7000, false) AS bare,
  {_CASES("upper(x)", STYLES)} AS style, CASE WHEN regexp_matches(x, '(?i)\bCVT\b') THEN 'CVT' WHEN regexp_matches(x, '(?i)\bDCT\b') THEN 'DCT' WHEN regexp_matches(x, '(?i)\bAMT\b') THEN 'AMT' WHEN regexp_matches(x, '(?i)(^|[^A-Za-z])AT($|[^A-Za-z])') THEN 'AT' WHEN regexp_matches(x, '(?i)(^|[^A-Za-z])MT($|[^A-Za-z])') THEN 'MT' END AS box FROM u),
c AS (SELECT *, min(CASE WHEN unit OR bare THEN i END) OVER (PARTITION BY p_partkey) AS cc FROM k),
m AS (SELECT *, CASE WHEN door THEN 'door' WHEN unit OR i = cc THEN 'cc' WHEN style IS NOT NULL THEN 'style' WHEN box IS NOT NULL THEN 'box' ELSE 'model' END AS kind FROM c)
SELECT p_partkey, CASE any_value(named) WHEN 'BENZ' THEN 'MERCEDES-BENZ' WHEN 'MERCEDES' THEN 'MERCEDES-BENZ' WHEN 'MERCEDES BENZ' THEN 'MERCEDES-BENZ' ELSE any_value(named) END AS brand, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (kind = 'model'), '') AS model_raw,
  CAST(regexp_extract(max(x) FILTER (i = cc), '^(\d+)', 1) AS INT) AS displacement_cc, {_CASES("upper(any_value(t))", BODIES)} AS body_rule, arg_min(box, i) FILTER (kind = 'box') AS transmission, CAST(substr(arg_max(x, i) FILTER (kind = 'door'), 1, 1) AS INT) AS doors, string_agg(style, ' ' ORDER BY i) FILTER (kind = 'style') AS style FROM m GROUP BY p_partkey""",
)
def p17(spark: SparkSession, d: str) -> DataFrame:
    """Vehicle names taken apart by token rules."""
    k, size = F.col("p_partkey"), F.col("p_size")
    brand = F.when(k % 6 == 0, "Land rover ").when(k % 6 == 1, "BENZ ").when(k % 6 == 2, "mercedes benz ").when(k % 6 == 3, "toyota ").when(k % 6 == 4, "").otherwise(F.concat("p_brand", F.lit(" ")))
    name = F.concat(
        brand, "p_name", F.lit("  "), (size * 100).cast("string"), F.when(size % 3 == 0, "cc").otherwise(""), F.when(size % 2 == 0, " 3-D 5d").otherwise(" cvt MT"), F.when(size % 5 == 0, " 1800 Turbo xEV hybrid suv").otherwise(" van"),
    )
    return table(spark, d, "part").select("p_partkey", parse_vehicle_name(name).alias("v")).select("p_partkey", "v.*")


@query(
    "p8_page_structure",
    r"""WITH p AS (SELECT page_id, html FROM pages), t AS (SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS heading, CAST(len(regexp_extract_all(html, '(?i)<table\b')) AS INT) AS n_tables, CAST(len(regexp_extract_all(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '(?i)<a\s')) AS INT) AS n_links FROM p)
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(title, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#x27;?', chr(39), 'g'), '&amp;?', '&', 'g') AS title, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(heading, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#x27;?', chr(39), 'g'), '&amp;?', '&', 'g') AS heading, n_tables, n_links FROM t""",
)
def p8(spark: SparkSession, d: str) -> DataFrame:
    """Pages parsed to nested rows: title, heading, tables and links (P8, P11; literal pages test the table forms). References of HTML's old names need no semicolon."""
    tidy = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    return parse_pages(table(spark, d, "pages")).select("page_id", tidy("title").alias("title"), tidy("heading").alias("heading"), F.size("tables").alias("n_tables"), F.size("anchors").alias("n_links"))
