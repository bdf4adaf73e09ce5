"""Reports, lists and ledgers over the fixture tables, and the streaming form of URL discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import gates, merge, paging
from ..operators.scratch import scratch_path
from ..sources.pages import parse_pages, parse_vehicle_name, taxonomy
from ..streaming import discovery
from .base import query, table


@query("n3_current_versions", "WITH ptr AS (SELECT l_returnflag AS dataset, max(l_orderkey) AS artifact FROM lineitem GROUP BY 1) SELECT dataset, l_linenumber, l_partkey, p_name FROM ptr JOIN lineitem ON l_returnflag = dataset AND l_orderkey = artifact JOIN part ON l_partkey = p_partkey")
def n3(spark: SparkSession, d: str) -> DataFrame:
    """Records of each dataset's current artifact: a pointer of one row a dataset, then equi joins."""
    lines = table(spark, d, "lineitem")
    ptr = lines.groupBy(F.col("l_returnflag").alias("dataset")).agg(F.max("l_orderkey").alias("artifact"))
    j = lines.join(ptr, (F.col("l_returnflag") == F.col("dataset")) & (F.col("l_orderkey") == F.col("artifact")))
    return j.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select("dataset", "l_linenumber", "l_partkey", "p_name")


@query("n14_export", "SELECT l_orderkey, l_linenumber, p_name, p_brand, s_name, n_name, o_orderstatus, c_name, string_split(p_type, ' ')[1] AS main, string_split(p_type, ' ')[2] AS middle FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey < 3 LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 WHERE o_orderstatus = 'F'")
def n14(spark: SparkSession, d: str) -> DataFrame:
    """An export over inner and left joins; the verified-only filter reaches the scan."""
    orders = table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_custkey")
    nation = table(spark, d, "nation").filter("n_regionkey < 3").select("n_nationkey", "n_name")
    customer = table(spark, d, "customer").filter("c_acctbal > 0").select("c_custkey", "c_name")
    j = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    j = j.join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    parts = F.split("p_type", " ")
    return j.select("l_orderkey", "l_linenumber", "p_name", "p_brand", "s_name", "n_name", "o_orderstatus", "c_name", F.get(parts, F.lit(0)).alias("main"), F.get(parts, F.lit(1)).alias("middle"))


@query("n17_receipts", "WITH r AS (SELECT o_orderkey AS g, o_custkey % 4 AS claimed FROM orders), m AS (SELECT l_orderkey AS g, count(*) AS members, sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS accepted FROM lineitem GROUP BY 1) SELECT g, claimed, coalesce(members, 0) AS members, CAST(coalesce(accepted, 0) AS BIGINT) AS accepted, claimed = coalesce(accepted, 0) AS agrees FROM r LEFT JOIN m USING (g)")
def n17(spark: SparkSession, d: str) -> DataFrame:
    """Receipts against what their groups hold."""
    r = table(spark, d, "orders").select(F.col("o_orderkey").alias("g"), (F.col("o_custkey") % 4).alias("claimed"))
    m = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("g")).agg(F.count("*").alias("members"), F.count_if(F.col("l_returnflag") == "A").alias("accepted"))
    zero = F.lit(0)
    return r.join(m, "g", "left").select("g", "claimed", F.coalesce("members", zero).alias("members"), F.coalesce("accepted", zero).alias("accepted"), (F.col("claimed") == F.coalesce("accepted", zero)).alias("agrees"))


@query("n19_labels", "SELECT DISTINCT e.event_type AS name, coalesce(l.label, 'none') AS label FROM events e LEFT JOIN (SELECT DISTINCT event_type, 'L' || length(event_type) AS label FROM events WHERE event_type < 'n') l ON coalesce(e.event_type, '') = coalesce(l.event_type, '')")
def n19(spark: SparkSession, d: str) -> DataFrame:
    """Labels attached on nullable keys."""
    names = table(spark, d, "events").select(F.col("event_type").alias("name")).distinct()
    labels = names.filter("name < 'n'").select("name", F.concat(F.lit("L"), F.length("name")).alias("label"))
    return names.alias("e").join(labels.alias("l"), F.col("e.name").eqNullSafe(F.col("l.name")), "left").select("e.name", F.coalesce("l.label", F.lit("none")).alias("label"))


@query("n22_latest_run", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey = (SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)")
def n22(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the latest run."""
    last = table(spark, d, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(1).select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, d, "lineitem").join(F.broadcast(last), "l_orderkey").select("l_orderkey", "l_linenumber")


@query("n23_diagram_choice", "WITH d AS (SELECT p_brand AS page, p_size AS code, min(p_partkey) AS diagram FROM part GROUP BY 1, 2), n AS (SELECT page, count(*) AS k, min(diagram) AS only_one FROM d GROUP BY 1) SELECT p_partkey, coalesce(d.diagram, CASE WHEN k = 1 THEN only_one END) AS diagram FROM part LEFT JOIN d ON d.page = p_brand AND d.code = p_size + 40 LEFT JOIN n ON n.page = p_brand")
def n23(spark: SparkSession, d: str) -> DataFrame:
    """A part's diagram by code, else the only one of its page."""
    part = table(spark, d, "part")
    dia = part.groupBy(F.col("p_brand").alias("page"), F.col("p_size").alias("code")).agg(F.min("p_partkey").alias("diagram"))
    only = dia.groupBy("page").agg(F.count("*").alias("k"), F.min("diagram").alias("only_one"))
    j = part.withColumnRenamed("p_brand", "page").withColumn("code", F.col("p_size") + 40).join(dia, ["page", "code"], "left").join(only, "page", "left")
    return j.select("p_partkey", F.coalesce("diagram", F.when(F.col("k") == 1, F.col("only_one"))).alias("diagram"))


@query("m11_progress", "WITH s AS (SELECT user_id AS scope, event_id, event_type FROM events) SELECT scope, CASE WHEN bool_or(event_type = 'purchase') THEN 'done' WHEN bool_or(event_type = 'click') THEN 'error' ELSE 'pending' END AS status, count(*) AS seen FROM s GROUP BY 1")
def m11(spark: SparkSession, d: str) -> DataFrame:
    """Progress by scope: done clears an error, an error is not taken back to pending."""
    e = table(spark, d, "events")
    is_ = lambda t: F.bool_or(F.col("event_type") == t)
    return e.groupBy(F.col("user_id").alias("scope")).agg(F.when(is_("purchase"), "done").when(is_("click"), "error").otherwise("pending").alias("status"), F.count("*").alias("seen"))


@query("m14_supersede", "SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) > 1 AS superseded FROM events")
def m14(spark: SparkSession, d: str) -> DataFrame:
    """Of the captures of one URL and context the newest counts."""
    w = Window.partitionBy("user_id", "event_type").orderBy(F.desc("ts"), F.desc("event_id"))
    return table(spark, d, "events").select("event_id", (F.row_number().over(w) > 1).alias("superseded"))


@query("m17_bodies", "SELECT sha256(coalesce(text, '')) AS body_sha256, min(doc_id) AS first_doc, count(*) AS captures, max(strlen(text)) AS size FROM documents GROUP BY 1")
def m17(spark: SparkSession, d: str) -> DataFrame:
    """Bodies by content, each kept once, with their captures."""
    body = table(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("body_sha256"), F.octet_length("text").alias("n"))
    return body.groupBy("body_sha256").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("captures"), F.max("n").cast("long").alias("size"))


@query("a9_storage", "WITH b AS (SELECT text, count(*) AS n, max(strlen(text)) AS s FROM documents GROUP BY 1) SELECT CAST(sum(n * s) AS BIGINT) AS logical, CAST(sum(s) AS BIGINT) AS stored, round(sum(s) / sum(n * s), 6) AS ratio FROM b")
def a9(spark: SparkSession, d: str) -> DataFrame:
    """Storage totals and what keeping each body once saves (A9); grouped by digest, not by text."""
    b = table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("k")).agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("s"))
    return b.agg(F.sum(F.col("n") * F.col("s")).alias("logical"), F.sum("s").cast("long").alias("stored"), F.round(F.sum("s") / F.sum(F.col("n") * F.col("s")), 6).alias("ratio"))


@query("a15_scorecard", "SELECT count(*) = count(DISTINCT o_orderkey) AS unique_keys, count(*) FILTER (o_custkey IS NULL) = 0 AS all_owned, min(o_totalprice) > 0 AS priced, count(*) = count(DISTINCT o_orderkey) AND count(*) FILTER (o_custkey IS NULL) = 0 AND min(o_totalprice) > 0 AS strict_complete FROM orders")
def a15(spark: SparkSession, d: str) -> DataFrame:
    """A run's completion checks; strict if all hold."""
    s = table(spark, d, "orders").agg((F.count("*") == F.countDistinct("o_orderkey")).alias("unique_keys"), (F.count_if(F.col("o_custkey").isNull()) == 0).alias("all_owned"), (F.min("o_totalprice") > 0).alias("priced"))
    return s.withColumn("strict_complete", F.col("unique_keys") & F.col("all_owned") & F.col("priced"))


@query("w2_first_occurrence", "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id, props ORDER BY event_id) AS n FROM events) WHERE n = 1")
def w2(spark: SparkSession, d: str) -> DataFrame:
    """The first occurrence of each content: an aggregation."""
    return table(spark, d, "events").groupBy("user_id", "props").agg(F.min("event_id").alias("event_id")).select("event_id")


@query("o1_page", "SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20 OFFSET 40")
def o1(spark: SparkSession, d: str) -> DataFrame:
    """A page of a sorted list (O1, O3)."""
    items, _ = paging.page(table(spark, d, "customer"), [F.desc("c_acctbal"), "c_custkey"], 3, 20)
    return items.select("c_custkey", "c_name")


@query("o4_recent", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50")
def o4(spark: SparkSession, d: str) -> DataFrame:
    """The most recent rows."""
    return table(spark, d, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(50).select("o_orderkey", "o_orderdate")


@query("u1_gated_union", "SELECT 'full' AS kind, p_partkey FROM part WHERE (SELECT max(p_size) FROM part) >= 50 UNION ALL SELECT 'bounded', p_partkey FROM part WHERE p_size < 10 AND (SELECT max(p_size) FROM part) < 50")
def u1(spark: SparkSession, d: str) -> DataFrame:
    """Two snapshots of which just one is shown."""
    part = table(spark, d, "part")
    full = part.agg((F.max("p_size") >= 50).alias("ok"))
    a = gates.gated(part.select(F.lit("full").alias("kind"), "p_partkey"), full)
    return a.unionByName(gates.gated(part.filter("p_size < 10").select(F.lit("bounded").alias("kind"), "p_partkey"), full.select((~F.col("ok")).alias("ok"))))


@query("q3_release", "SELECT o_orderkey, CASE WHEN coalesce(trim(o_orderpriority), '') = '' OR o_totalprice < 5000 OR year(o_orderdate) < 1993 THEN NULL ELSE 1 END AS run_id FROM orders")
def q3(spark: SparkSession, d: str) -> DataFrame:
    """Rows that break a rule lose their run marker."""
    bad = (F.coalesce(F.trim("o_orderpriority"), F.lit("")) == "") | (F.col("o_totalprice") < 5000) | (F.year("o_orderdate") < 1993)
    return table(spark, d, "orders").select("o_orderkey", F.when(~bad, 1).alias("run_id"))


@query("e16_quarantine_summary", "SELECT l_returnflag AS reason, l_linestatus = 'F' AS resolved, count(*) AS n, max(l_shipdate) AS updated FROM lineitem WHERE l_quantity < 5 GROUP BY 1, 2")
def e16(spark: SparkSession, d: str) -> DataFrame:
    """Quarantine by reason and state."""
    return table(spark, d, "lineitem").filter("l_quantity < 5").groupBy(F.col("l_returnflag").alias("reason"), (F.col("l_linestatus") == "F").alias("resolved")).agg(F.count("*").alias("n"), F.max("l_shipdate").alias("updated"))


@query("e17_status_report", "SELECT e.event_type AS dataset, e.n, e.users, coalesce(p.n, 0) AS recent FROM (SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1) e LEFT JOIN (SELECT event_type, count(*) AS n FROM events WHERE value > 50 GROUP BY 1) p USING (event_type)")
def e17(spark: SparkSession, d: str) -> DataFrame:
    """Rows by dataset with correlated counts as one aggregation."""
    return table(spark, d, "events").groupBy(F.col("event_type").alias("dataset")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.count_if(F.col("value") > 50).alias("recent"))


@query("e21_capacity", "SELECT round(count(*) FILTER (o_orderstatus <> 'F') / (count(*) FILTER (o_orderstatus = 'F') / 7.0), 6) AS days_left FROM orders")
def e21(spark: SparkSession, d: str) -> DataFrame:
    """Work that is left over the rate."""
    done = F.count_if(F.col("o_orderstatus") == "F")
    return table(spark, d, "orders").agg(F.round(F.count_if(F.col("o_orderstatus") != "F") / (done / F.lit(7.0)), 6).alias("days_left"))


@query("p10_taxonomy", "WITH t AS (SELECT p_partkey, string_split(p_type, ' ') AS w FROM part) SELECT p_partkey AS page_id, i - 1 AS depth, w[i] AS name, array_to_string(w[1:i], ' > ') AS path, CASE WHEN i > 1 THEN array_to_string(w[1:i - 1], ' > ') END AS parent_path FROM (SELECT p_partkey, w, unnest(generate_series(1, len(w))) AS i FROM t)")
def p10(spark: SparkSession, d: str) -> DataFrame:
    """One node for each depth of a path (P10)."""
    out = taxonomy(table(spark, d, "part").select(F.col("p_partkey").alias("page_id"), F.split("p_type", " ").alias("breadcrumb")))
    return out.withColumn("depth", F.col("depth").cast("long"))


@query("m10_provenance", "SELECT DISTINCT lang, source FROM documents WHERE (lang, source) NOT IN (SELECT (lang, source) FROM documents WHERE doc_id % 50 = 0)")
def m10(spark: SparkSession, d: str) -> DataFrame:
    """Edges that the table does not have yet, null-safe."""
    docs = table(spark, d, "documents")
    return merge.insert_new(docs.filter("doc_id % 50 = 0").select("lang", "source"), docs.select("lang", "source"), ["lang", "source"])


#: The URLs of `pages` as normalize_url() has them.
PAGE_URLS_SQL = r"SELECT page_id, s || '://' || h || CASE WHEN starts_with(r, '/') THEN r ELSE '/' || r END AS url FROM (SELECT page_id, lower(regexp_extract(u, '^([A-Za-z]+)://', 1)) AS s, lower(regexp_extract(u, '^[A-Za-z]+://([^/?]*)', 1)) AS h, regexp_extract(u, '^[A-Za-z]+://[^/?]*(.*)$', 1) AS r FROM (SELECT page_id, regexp_replace(url, '#.*$', '') AS u FROM pages))"


def _discovered_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages as a stream of discoveries in three runs, each page found by a parent and one of two methods, through the state of each run."""
    root = scratch_path(spark, "discovered")
    rows = spark.readStream.schema("page_id long, url string, html string").parquet(f"{d}/pages*")
    asked = rows.select((F.col("page_id") % 3).alias("run_id"), "url", F.concat(F.lit("parent"), (F.col("page_id") % 7).cast("string")).alias("parent"), F.when(F.col("page_id") % 2 == 0, "html").otherwise("sitemap").alias("method"), F.timestamp_seconds(F.lit(1_700_000_000) - F.col("page_id")).alias("seen_at"))
    discovery.write_discovered(discovery.discovered(asked), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(discovery.FOUND).parquet(f"{root}/out")


@query("t1_discovered", f"SELECT DISTINCT page_id % 3 AS run_id, url FROM ({PAGE_URLS_SQL})")
def t1(spark: SparkSession, d: str) -> DataFrame:
    """Each URL once a run, as a stream over the pages with a checkpoint."""
    return _discovered_pages(spark, d).filter("kind = 'url'").select("run_id", "url")


@query("t1_edges", f"SELECT DISTINCT page_id % 3 AS run_id, 'parent' || page_id % 7 AS parent, url, CASE WHEN page_id % 2 = 0 THEN 'html' ELSE 'sitemap' END AS method FROM ({PAGE_URLS_SQL})")
def t1_edges(spark: SparkSession, d: str) -> DataFrame:
    """What leads to each URL of a run, each edge once."""
    return _discovered_pages(spark, d).filter("kind = 'edge'").select("run_id", "parent", "url", "method")
