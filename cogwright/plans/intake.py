"""Readers, sinks and streams over files that are made of the fixture tables: what comes back is held against the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import export, publish
from ..operators.scratch import scratch_path, written
from ..sources import bulk, documents, links
from ..sources.datasets import DATASETS
from ..sources.pages import parse_pages
from ..streaming import jobs
from .base import query, table

SITE = "catalog.example"


def _file(df: DataFrame, column: str, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.select(F.col(column).alias("value")).write.text(path)
    return path


@query("s1_quoted_rows", "SELECT CAST(p_partkey AS VARCHAR) AS make, CASE p_partkey % 5 WHEN 0 THEN p_name || ', \"' || p_type || '\"' WHEN 1 THEN p_name || ' 6\" x' WHEN 2 THEN p_name || chr(10) || p_type ELSE p_name END AS model, 2000 + p_partkey % 20 AS model_year, p_brand AS summary FROM part WHERE p_partkey % 7 <> 4")
def s1(spark: SparkSession, d: str) -> DataFrame:
    """Ratings in headed files: quoted fields with delimiters, quotes and line breaks, stray quotes, and rows without a field that become rejects."""
    q = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    name = F.col("p_name")
    model = F.when(F.col("p_partkey") % 5 == 0, q(F.concat(name, F.lit(', "'), "p_type", F.lit('"')))).when(F.col("p_partkey") % 5 == 1, F.concat(name, F.lit(' 6" x'))).when(F.col("p_partkey") % 5 == 2, q(F.concat(name, F.lit("\n"), "p_type"))).otherwise(name)
    year = (2000 + F.col("p_partkey") % 20).cast("string")
    spec = DATASETS["safety_ratings"]
    identity = [c for c in spec.identity if c not in ("MAKE", "MODEL", "MODEL_YR")]
    whole = F.concat_ws(",", F.col("p_partkey").cast("string"), model, year, "p_brand", *(F.lit("") for _ in identity))
    line = F.when(F.col("p_partkey") % 7 == 4, F.lit("cut,short")).otherwise(whole)
    # Three files, each with its header line.
    head = ",".join(["Make", "Model", "Model Yr", "Roll Safety Concern", *identity])
    files = table(spark, d, "part").select(line.alias("value"), F.pmod("p_partkey", F.lit(3)).alias("k")).groupBy("k").agg(F.concat_ws("\n", F.lit(head), F.collect_list("value")).alias("value"))
    path = scratch_path(spark, "ratings")
    files.write.partitionBy("k").text(path)
    rows = bulk.normalised(bulk.read_dataset(spark, path, spec)[0], spec)
    return rows.select(F.col("make_name").alias("make"), F.col("model_name").alias("model"), "model_year", F.col("summary_text").alias("summary"))


@query("s1_rejects", "SELECT 'field_count' AS error_type, 'cut,short' AS raw_text, count(*) AS n FROM part WHERE p_partkey % 7 = 4 HAVING count(*) > 0")
def s1_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a wrong number of fields in tab-separated files."""
    spec = DATASETS["investigations"]
    line = F.when(F.col("p_partkey") % 7 == 4, F.lit("cut,short")).otherwise(F.concat_ws("\t", F.col("p_partkey").cast("string"), *(F.lit(f"f{i}") for i in range(len(spec.fields) - 1))))
    _, rejects = bulk.read_dataset(spark, _file(table(spark, d, "part").select(line.alias("value")), "value", "investigations"), spec)
    return rejects.groupBy("error_type", "raw_text").agg(F.count("*").alias("n"))


@query("s6_json_documents", "SELECT 'n' || s_nationkey AS source, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, 'ctx' AS extra FROM supplier WHERE s_nationkey % 4 <> 1 AND s_suppkey % 6 <> 2")
def s6_documents(spark: SparkSession, d: str) -> DataFrame:
    """Elements of documents whose declared count is right, without those that lack a field, with a column of the context."""
    s = table(spark, d, "supplier").withColumn("e", F.create_map(F.lit("id"), F.col("s_suppkey").cast("string"), F.lit("name"), F.when(F.col("s_suppkey") % 6 == 2, F.lit("")).otherwise(F.col("s_name"))))
    texts = s.groupBy(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("source"), "s_nationkey").agg(F.collect_list("e").alias("Results"))
    value = F.to_json(F.struct((F.size("Results") + F.when(F.col("s_nationkey") % 4 == 1, 1).otherwise(0)).alias("Count"), "Results"))
    records, _ = documents.json_documents(texts.select("source", value.alias("value")), ["id", "name"], {"extra": "ctx"})
    return records.select("source", *(F.element_at("payload", c).alias(c) for c in ("id", "name", "extra")))


@query("s9_sitemaps", "SELECT DISTINCT 'http://s/' || page_id AS url FROM pages WHERE page_id % 5 <> 3")
def s9(spark: SparkSession, d: str) -> DataFrame:
    """Pages that sitemaps lead to, through indexes."""
    pages = table(spark, d, "pages").select("page_id", (F.col("page_id") % 10).alias("k"))
    loc = lambda c: F.concat(F.lit("<url><loc> "), c, F.lit(" </loc></url>"))
    maps = pages.groupBy("k").agg(F.concat(F.lit('<urlset xmlns="http://x">'), F.concat_ws("", F.collect_list(loc(F.concat(F.lit("http://s/"), F.col("page_id").cast("string"))))), F.lit("</urlset>")).alias("value")).withColumn("source", F.concat(F.lit("map"), F.col("k").cast("string")))
    index = spark.createDataFrame([("root", '<sitemapindex xmlns="http://x">' + "".join(f"<sitemap><loc>map{k}</loc></sitemap>" for k in range(10) if k % 5 != 3) + "</sitemapindex>")], "source string, value string")
    return documents.nested_sitemaps(documents.sitemap_urls(index), maps.select("source", "value"))


@query("k2_jsonl", "SELECT doc_id, text, lang FROM documents")
def k2(spark: SparkSession, d: str) -> DataFrame:
    """Documents written as JSON lines and read again (K2)."""
    docs, path = table(spark, d, "documents").select("doc_id", "text", "lang"), scratch_path(spark, "jsonl")
    export.write_jsonl(docs, path)
    return documents.read_jsonl(spark, path, "doc_id long, text string, lang string")


@query("k3_published", "SELECT o_orderkey, 2 AS run_id, o_totalprice + 1 AS price FROM (SELECT o_orderkey, min(o_totalprice) AS o_totalprice FROM orders GROUP BY 1)")
def k3(spark: SparkSession, d: str) -> DataFrame:
    """The current snapshot after two full runs and one that its gate refused."""
    root = scratch_path(spark, "published")
    orders = table(spark, d, "orders").groupBy("o_orderkey").agg(F.min("o_totalprice").alias("price"))
    run = lambda n: written(orders.select("o_orderkey", F.lit(n).alias("run_id"), (F.col("price") + (n - 1)).alias("price")), "snapshot")
    total = orders.count()
    for n in (1, 2):
        publish.publish_full(run(n), root, n, {"free": F.col("price") < 0}, "o_orderkey", total, True)
    try:
        publish.publish_full(run(3), root, 3, {"dear": F.col("price") > 0}, "o_orderkey", total, True)
    except publish.GateError:
        pass  # nothing was written
    return publish.current(spark, root, "o_orderkey long, run_id int, price double")


def _events(spark: SparkSession, d: str, name: str, *columns) -> tuple[str, str]:
    """(path, schema) of events in three drops."""
    path = scratch_path(spark, name)
    rows = table(spark, d, "events").select("event_id", *columns)
    for k in range(3):
        rows.filter(F.col("event_id") % 3 == k).write.mode("append").parquet(path)
    return path, ", ".join(f"{c} {t}" for c, t in rows.dtypes)


@query("t2_first_records", "SELECT DISTINCT user_id, event_type FROM events")
def t2(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose key a stream has not put into the table yet, twice over."""
    path, _ = _events(spark, d, "stream-in", "user_id", "event_type")
    out = scratch_path(spark, "stream-out")
    for n in range(2):
        jobs.stream_insert_new(spark, path, out, f"{out}-check-{n}", "user_id long, event_type string", ["user_id", "event_type"]).awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(out)


@query("t3_upserts", "SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def t3(spark: SparkSession, d: str) -> DataFrame:
    """The last event of each user in a table that a stream upserts."""
    path, schema = _events(spark, d, "stream-in", "user_id", "event_type")
    out = scratch_path(spark, "stream-out")
    jobs.stream_upsert(spark, path, out, f"{out}-check", schema, ["user_id"], ["event_id"]).awaitTermination()
    # Drops may come in one batch or in several; the order decides within and across them.
    return spark.read.parquet(out).groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type"), "event_id").alias("r")).select("user_id", "r.event_id", "r.event_type")


@query("t4_counters", "SELECT user_id AS run_id, event_type AS status, count(*) AS count FROM events GROUP BY 1, 2")
def t4(spark: SparkSession, d: str) -> DataFrame:
    """Counters by run and status, kept by a stream (T4)."""
    path, _ = _events(spark, d, "stream-in", F.col("user_id").alias("run_id"), F.col("event_type").alias("status"))
    out = scratch_path(spark, "stream-out")
    jobs.stream_counters(spark, path, out, f"{out}-check").awaitTermination()
    return jobs.counters(spark, out)


@query("t5_late_captures", "SELECT user_id AS job_id, CAST(event_id AS VARCHAR) AS url, user_id % 4 <> 1 AND ts >= TIMESTAMP '2024-01-02' AND ts <= TIMESTAMP '2024-01-20 00:05:00' AS accepted FROM events")
def t5(spark: SparkSession, d: str) -> DataFrame:
    """Captures in a stream that are in their job's time or late; those of unknown jobs are late (T5)."""
    path, _ = _events(spark, d, "stream-in", F.col("user_id").alias("job_id"), F.col("event_id").cast("string").alias("url"), F.col("ts").cast("timestamp").alias("fetched_at"))
    known = table(spark, d, "events").filter("user_id % 4 <> 1").select(F.col("user_id").alias("job_id")).distinct().withColumns({"started_at": F.lit("2024-01-02").cast("timestamp"), "finished_at": F.lit("2024-01-20").cast("timestamp")})
    out = scratch_path(spark, "stream-out")
    jobs.stream_late_captures(spark, path, known, out, f"{out}-check").awaitTermination()
    return spark.read.parquet(out).select("job_id", "url", "accepted")


def _link_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page for twenty suppliers: links to brands, models, categories and groups, of which some are foreign, nameless or malformed."""
    s = table(spark, d, "supplier").select((F.col("s_suppkey") / 20).cast("long").alias("page_id"), F.col("s_suppkey").alias("k"), F.col("s_suppkey").cast("string").alias("t"), "s_name")
    at = lambda n: F.col("k") % 7 == n
    link = lambda href, text: F.concat(F.lit('<a href="'), href, F.lit('">'), text, F.lit("</a>"))
    host = F.when(at(1), f"https://{SITE}").when(at(2), "https://elsewhere.example").otherwise("")
    text = lambda c: F.when(at(3), F.lit("<img>")).otherwise(c)
    brand = link(F.concat(host, F.lit(links.LOCATE), F.when(at(4), F.lit("?x=1")).otherwise(F.concat(F.lit("?c=B"), "t"))), text(F.when(at(6), F.lit("same")).otherwise(F.col("s_name"))))
    brand = F.when(at(5), brand).otherwise(F.concat(F.lit("<ul><li>"), brand, F.lit("</ul>")))
    of_page = F.concat(F.lit("c="), F.when(at(5), F.lit("Foreign")).otherwise(F.lit("Own")))
    model = link(F.concat(host, F.lit(links.PICK), F.lit("?"), of_page, F.lit("&amp;model=m"), "t", F.lit("&amp;ssd=z")), text(F.col("s_name")))
    vehicle = F.concat(of_page, F.lit("&amp;vid="), F.when(at(6), F.lit("8")).otherwise(F.lit("7")), F.lit("&amp;cid="), "t")
    category = link(F.concat(host, F.lit(links.VEHICLE), F.lit("?"), vehicle, F.when(at(4), F.lit("&amp;cname=Named+so")).otherwise(F.lit(""))), text(F.col("s_name")))
    group = link(F.concat(host, F.lit(links.UNIT), F.lit("?"), vehicle, F.lit("&amp;uid=u"), "t"), text(F.when(at(4), F.lit("no code")).otherwise(F.concat(F.lit("0901: "), "s_name"))))
    html = F.concat(brand, model, category, group)
    return s.groupBy("page_id").agg(F.concat_ws("", F.array_sort(F.collect_list(F.struct("k", html.alias("h"))))["h"]).alias("html"))


def _context(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.lit("Own").alias("brand"), F.lit("7").alias("page_vid"), F.lit(None).cast("string").alias("page_cid"))


_PAGE = "CAST(floor(s_suppkey / 20) AS BIGINT) AS page_id"


@query("p1_brands", f"WITH b AS (SELECT {_PAGE}, CASE WHEN s_suppkey % 7 = 6 THEN 'same' ELSE s_name END AS brand, CASE WHEN s_suppkey % 7 = 1 THEN 'https://{SITE}' ELSE '' END || '{links.LOCATE}?c=B' || s_suppkey AS url, s_suppkey FROM supplier WHERE s_suppkey % 7 IN (0, 1, 6)) SELECT page_id, brand, arg_min(url, s_suppkey) AS url FROM b GROUP BY 1, 2")
def p1(spark: SparkSession, d: str) -> DataFrame:
    """Brands of the pages' lists."""
    return links.extract_brands(parse_pages(_link_pages(spark, d)), SITE)[0]


@query("p2_models", f"SELECT {_PAGE}, s_name AS model, 'z' AS ssd FROM supplier WHERE s_suppkey % 7 NOT IN (2, 3, 5)")
def p2(spark: SparkSession, d: str) -> DataFrame:
    """Models of the pages' own brand."""
    pages = _link_pages(spark, d)
    return links.extract_models(parse_pages(pages), _context(pages), SITE)[0].select("page_id", "model", "ssd")


@query("p4_categories", f"SELECT {_PAGE}, CAST(s_suppkey AS VARCHAR) AS cid, CASE WHEN s_suppkey % 7 = 4 THEN 'Named so' ELSE s_name END AS name FROM supplier WHERE s_suppkey % 7 IN (0, 1, 4)")
def p4(spark: SparkSession, d: str) -> DataFrame:
    """Categories of the pages' own vehicle."""
    pages = _link_pages(spark, d)
    return links.extract_categories(parse_pages(pages), _context(pages), SITE)[0].select("page_id", "cid", "name")


@query("p5_groups", f"SELECT {_PAGE}, CAST(s_suppkey AS VARCHAR) AS cid, CASE WHEN s_suppkey % 7 = 3 THEN '' ELSE '0901' END AS code, 'u' || s_suppkey AS uid, CASE WHEN s_suppkey % 7 = 3 THEN '' ELSE s_name END AS name FROM supplier WHERE s_suppkey % 7 IN (0, 1, 3)")
def p5(spark: SparkSession, d: str) -> DataFrame:
    """Part groups of the pages' own vehicle; image links have no code (P5)."""
    pages = _link_pages(spark, d)
    return links.extract_groups(parse_pages(pages), _context(pages), SITE)[0].select("page_id", "cid", "code", "uid", "name")


@query("p5_diagnostics", f"SELECT {_PAGE}, count(*) FILTER (s_suppkey % 7 = 4) AS malformed, count(*) FILTER (s_suppkey % 7 IN (5, 6)) AS skipped, count(*) FILTER (s_suppkey % 7 = 3) AS image_only FROM supplier WHERE s_suppkey % 7 <> 2 GROUP BY 1")
def p5_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    """What of each page's group links is malformed, passed over or without text (P5)."""
    pages = _link_pages(spark, d)
    return links.extract_groups(parse_pages(pages), _context(pages), SITE)[1]
