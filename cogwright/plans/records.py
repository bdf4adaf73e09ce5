"""Queries over pages, texts and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import records, text, urls
from ..functions.canonical import with_record_sha256
from .base import query, table

_ABS = r"'^[A-Za-z][A-Za-z0-9+.-]*://'"


@query("f6_normalize_url", r"WITH b AS (SELECT page_id, regexp_replace(trim(url), '#.*$', '') AS u FROM pages), p AS (SELECT page_id, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS s, lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)) AS h, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*(.*)$', 1) AS r FROM b) SELECT page_id, s || '://' || CASE s WHEN 'http' THEN regexp_replace(h, ':80$', '') WHEN 'https' THEN regexp_replace(h, ':443$', '') ELSE h END || CASE WHEN starts_with(r, '/') THEN r ELSE '/' || r END AS url FROM p")
def f6(spark: SparkSession, d: str) -> DataFrame:
    """Normalised URLs."""
    return table(spark, d, "pages").select("page_id", urls.normalize_url("url").alias("url"))


@query("f11_query_params", r"SELECT page_id, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages")
def f11(spark: SparkSession, d: str) -> DataFrame:
    """Query values of URLs."""
    return table(spark, d, "pages").select("page_id", urls.query_param("url", "ref").alias("ref"), urls.query_param("url", "page").alias("page"))


@query("f9_redact_url", r"SELECT page_id, regexp_replace(regexp_replace(url, '([?&]ref=)[^&#]*', '\1[REDACTED]', 'g'), '([?&]page=)[^&#]*', '\1[REDACTED]', 'g') AS url FROM pages")
def f9(spark: SparkSession, d: str) -> DataFrame:
    """URLs with sensitive query values replaced."""
    return table(spark, d, "pages").select("page_id", urls.redact_url("url", ["ref", "page"]).alias("url"))


@query("p14_links", r"""WITH l AS (SELECT page_id, list_distinct(regexp_extract_all(html, '(?i)\s(?:href|data-href|data-url|action)\s*=\s*["'']([^"'']*)["'']', 1)) AS x FROM pages) SELECT page_id, unnest(x) AS link FROM l""")
def p14(spark: SparkSession, d: str) -> DataFrame:
    """Links that pages have, each once (P14, T1's input)."""
    return table(spark, d, "pages").select("page_id", F.explode(urls.page_links("html")).alias("link"))


@query("p18_scrub", r"SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS html FROM pages")
def p18(spark: SparkSession, d: str) -> DataFrame:
    """Pages without scripts and comments (P18, native form)."""
    return table(spark, d, "pages").select("page_id", F.regexp_replace(F.regexp_replace("html", r"(?is)<script\b.*?</script>", ""), r"(?s)<!--.*?-->", "").alias("html"))


_TAIL = """<META name="x"><input type="hidden" name="ssd" value="q"><a ONclick="x('y')" href="/u?ssd=Abc&k=1">a</a><a href="/u?ssd=A">b</a><a href="/u?ssd=Abc">c</a>"""


@query(
    "p18_sanitize",
    rf"""WITH p AS (SELECT page_id, html || '{_TAIL.replace("'", "''")}' AS h FROM pages), s AS (SELECT page_id, h, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(h, '(?is)<script\b.*?</script\s*>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '(?is)<meta\b[^>]*>', '', 'g'), '<input type="hidden" name="ssd" value="q">', '', 'g'), '(?i)\sonclick="[^"]*"', '', 'g') AS c FROM p),
r AS (SELECT page_id, h, replace(replace(replace(c, 'ssd=Abc', 'ssd=__REDACTED__'), 'ssd=A"', 'ssd=__REDACTED_2__"'), '', '') AS c FROM s) SELECT page_id, sha256(c) AS sha256, CAST(strlen(h) AS INT) AS bytes, CAST(strlen(c) AS INT) AS scrubbed_bytes FROM r""",
)
def p18_sanitize(spark: SparkSession, d: str) -> DataFrame:
    """Pages without scripts, secrets and tokens, with digest and sizes."""
    return table(spark, d, "pages").select("page_id", records.scrub(F.concat("html", F.lit(_TAIL))).alias("s")).select("page_id", "s.sha256", "s.bytes", "s.scrubbed_bytes")


@query("h1_record_digest", """SELECT p_partkey, sha256('{"p_brand":"' || p_brand || '","p_partkey":"' || p_partkey || '","p_type":"' || p_type || '"}') AS digest, p_brand || chr(31) || p_type AS natural_key FROM part""")
def h1(spark: SparkSession, d: str) -> DataFrame:
    """Canonical record digests and natural keys (H1, H2)."""
    return table(spark, d, "part").select("p_partkey", records.record_digest(["p_partkey", "p_brand", "p_type"]).alias("digest"), records.natural_key(["p_brand", "p_type"]).alias("natural_key"))


@query("s6_document_rows", "SELECT conv_id, count(*) AS turns, count(*) FILTER (role = 'user') AS asked, CAST(max(turn) + 1 AS BIGINT) = count(*) AS complete FROM conversations GROUP BY 1")
def s6(spark: SparkSession, d: str) -> DataFrame:
    """Elements of a document against the number it declares."""
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.count_if(F.col("role") == "user").alias("asked"), (F.max("turn") + 1 == F.count("*")).alias("complete"))


@query("k1_csv_cells", "SELECT p_partkey, CASE WHEN substr(x, 1, 1) IN ('=', '+', '-', '@') THEN '''' || x ELSE x END AS cell FROM (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN '=' WHEN 1 THEN '-' WHEN 2 THEN '@' ELSE '' END || p_name AS x FROM part)")
def k1(spark: SparkSession, d: str) -> DataFrame:
    """Cells made safe for spreadsheets (K1)."""
    mark = F.when(F.col("p_size") % 5 == 0, "=").when(F.col("p_size") % 5 == 1, "-").when(F.col("p_size") % 5 == 2, "@").otherwise("")
    return table(spark, d, "part").select("p_partkey", text.csv_safe(F.concat(mark, F.col("p_name"))).alias("cell"))


@query("a9_counters", "SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1, 2")
def a9_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters by two keys in one aggregation."""
    return table(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


_MIXED_SQL = "SELECT doc_id, replace(lang, 'e', 'é' ) AS lang, text, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE doc_id / 4 END AS score FROM documents"


@query("h1_canonical_json", f"""SELECT doc_id, sha256('{{"doc_id":' || doc_id || ',"lang":' || coalesce(CAST(to_json(nfc_normalize(lang)) AS VARCHAR), 'null') || ',"score":' || coalesce(CAST(score AS VARCHAR), 'null') || ',"text":' || coalesce(CAST(to_json(nfc_normalize(text)) AS VARCHAR), 'null') || '}}') AS record_sha256 FROM ({_MIXED_SQL})""")
def h1_json(spark: SparkSession, d: str) -> DataFrame:
    """Digests of documents as JSON in one form: composed text, sorted keys, numbers as numbers (H1)."""
    score = F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") / 4)
    rows = table(spark, d, "documents").select("doc_id", F.replace("lang", F.lit("e"), F.lit("e\u0301")).alias("lang"), "text", score.alias("score"))
    return with_record_sha256(rows, ["doc_id", "lang", "text", "score"]).select("doc_id", "record_sha256")
