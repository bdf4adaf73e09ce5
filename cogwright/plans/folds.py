"""Edits and progress events folded in their order, and ids that stay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import edits, ingest
from ..operators.scratch import written
from .base import once, query, table


@query(
    "m13_edit_chains",
    """WITH RECURSIVE req AS (SELECT l_partkey AS k, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 10 + l_linenumber) AS n, CASE WHEN l_linenumber < 5 THEN 'update' WHEN l_linenumber = 5 THEN 'retire' ELSE 'restore' END AS action, CAST(l_quantity AS BIGINT) AS size FROM (SELECT l_partkey, l_orderkey, l_linenumber, min(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL)),
f AS (SELECT p_partkey AS k, CAST(p_size AS BIGINT) AS source, CAST(0 AS BIGINT) AS n, 0 AS rev, 'active' AS status, CAST(NULL AS BIGINT) AS size FROM part
  UNION ALL SELECT f.k, source, r.n, CASE WHEN (r.n - 1) % 4 = rev AND (action = 'update' OR (action = 'restore') = (status = 'retired')) THEN rev + 1 ELSE rev END,
    CASE WHEN (r.n - 1) % 4 = rev AND action <> 'update' AND (action = 'restore') = (status = 'retired') THEN CASE action WHEN 'retire' THEN 'retired' ELSE 'active' END ELSE status END,
    CASE WHEN (r.n - 1) % 4 = rev AND action = 'update' THEN nullif(r.size, source) ELSE f.size END
  FROM f JOIN req r ON r.k = f.k AND r.n = f.n + 1),
ends AS (SELECT k, arg_max(rev, n) AS rev, arg_max(status, n) AS status, arg_max({'s': size}, n).s AS size FROM f GROUP BY k)
SELECT k AS p_partkey, CAST(rev AS BIGINT) AS revision, status, CASE WHEN size IS NULL THEN '{}' ELSE '{"p_size":' || size || '}' END AS payload FROM ends WHERE rev > 0""",
)
def m13(spark: SparkSession, d: str) -> DataFrame:
    """Heads after all edits of a batch, several of a key one after the other."""
    json = lambda c: F.concat(F.lit('{"p_size":'), F.col(c).cast("long").cast("string"), F.lit("}"))
    source = table(spark, d, "part").select("p_partkey", json("p_size").alias("payload"))
    lines = table(spark, d, "lineitem").groupBy("l_partkey", "l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("l_quantity")).select(F.col("l_partkey").alias("p_partkey"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("request_id"), "l_linenumber", "l_quantity")
    counted = lines.withColumn("n", F.expr("row_number() over (partition by p_partkey order by request_id)"))
    action = F.when(F.col("l_linenumber") < 5, "update").when(F.col("l_linenumber") == 5, "retire").otherwise("restore")
    requests = counted.select("p_partkey", "request_id", action.alias("action"), F.when(action == "update", json("l_quantity")).alias("payload"), ((F.col("n") - 1) % 4).alias("expected_revision"))
    requests = requests.join(source.select("p_partkey", F.sha2("payload", 256).alias("expected_base_sha256")), "p_partkey")
    heads = spark.createDataFrame([], "p_partkey long, revision long, payload string, status string")
    out = edits.fold_edits(heads, requests, source, ["p_partkey"])
    return out.filter("kind = 'head'").select("p_partkey", "revision", "status", "payload")


@query(
    "m11_progress_fold",
    """WITH e AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'click' THEN 'error' ELSE 'pending' END AS status FROM events),
l AS (SELECT user_id, arg_max(status, (ts, event_id)) FILTER (status <> 'pending') AS status, arg_max(CAST(event_id AS VARCHAR), (ts, event_id)) FILTER (status <> 'pending') AS event FROM e GROUP BY 1),
old AS (SELECT c_custkey AS user_id, CASE WHEN c_custkey % 2 = 0 THEN 'done' ELSE 'error' END AS status, CASE WHEN c_custkey % 2 = 1 THEN 'before' END AS error FROM customer WHERE c_custkey % 3 = 0)
SELECT user_id AS scope, coalesce(l.status, old.status, 'pending') AS status, CASE WHEN l.status = 'error' THEN event WHEN l.status IS NULL THEN old.error END AS error FROM l FULL JOIN old USING (user_id)""",
)
def m11(spark: SparkSession, d: str) -> DataFrame:
    """Progress by scope after its events in their order, over the state of before."""
    status = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "click", "error").otherwise("pending")
    events = table(spark, d, "events").select(F.col("user_id").alias("scope"), status.alias("status"), F.col("event_id").cast("string").alias("error"), "ts", "event_id")
    even = F.col("c_custkey") % 2 == 0
    old = table(spark, d, "customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("scope"), F.when(even, "done").otherwise("error").alias("status"), F.when(~even, "before").alias("error"))
    return edits.fold_progress(events, old, ["scope"], ["ts", "event_id"])


#: Lines by their order and number, which name several rows of the table here and there.
_ONCE = "(SELECT l_orderkey, l_linenumber, min(l_suppkey) AS l_suppkey, min(l_partkey) AS l_partkey, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus, min(l_quantity) AS l_quantity FROM {lineitem} GROUP BY l_orderkey, l_linenumber) AS lines"
#: Records of pages, a page a supplier, as both engines read them: vehicles, taxonomies, diagrams, parts, hints and relations.
_PAGES = {
    "vehicles": "SELECT CAST(s_suppkey AS BIGINT) AS page_id, CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE 'b' || s_nationkey END AS catalog_brand, 'x' || s_suppkey % 30 AS external_id, 'm' || s_nationkey % 3 AS model, CAST(NULL AS STRING) AS prod_period, s_name AS name, 'u' || s_suppkey % 40 AS source_url FROM {supplier} WHERE s_suppkey % 7 <> 6",
    "parts": "SELECT CAST(l_suppkey AS BIGINT) AS page_id, l_orderkey * 10 + l_linenumber AS place, CASE WHEN l_linenumber = 3 THEN 'own' END AS brand, 'N-' || l_partkey AS number, CAST(NULL AS STRING) AS name, CASE WHEN l_linenumber < 3 THEN l_returnflag END AS diagram_code, CASE WHEN l_linenumber = 4 THEN 'name ' || l_returnflag END AS diagram_name, CAST(l_linenumber AS STRING) AS callout, CAST(CAST(l_quantity AS BIGINT) % 5 AS STRING) AS quantity, CAST(NULL AS STRING) AS range, CAST(NULL AS STRING) AS condition, CAST(NULL AS STRING) AS note, 'u' || l_suppkey % 40 AS source_url FROM {lines}",
    "diagrams": "SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS page_id, ascii(l_returnflag) AS place, l_returnflag AS code, 'name ' || l_returnflag AS name, CAST(NULL AS STRING) AS range, CAST(NULL AS STRING) AS path, 'u' || l_suppkey % 40 AS source_url FROM {lines} WHERE l_suppkey % 3 > 0 OR l_returnflag = 'N'",
    "hints": "SELECT CAST(l_suppkey AS BIGINT) AS page_id, l_orderkey * 10 + l_linenumber AS place, 'hb' AS brand, 'N-' || l_partkey AS number, l_linestatus AS text, 'u' || l_suppkey % 40 AS source_url FROM {lines} WHERE l_linenumber = 5",
    "relations": "SELECT CAST(l_suppkey AS BIGINT) AS page_id, l_orderkey * 10 + l_linenumber AS place, 'N-' || l_partkey AS number, 'N-' || (l_partkey + 1) AS to_number, l_returnflag AS relation_type, 'u' || l_suppkey % 40 AS source_url FROM {lines} WHERE l_linenumber = 6",
}


def _page_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    lines = once(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_partkey", "l_returnflag", "l_linestatus", "l_quantity"])
    views = {"supplier": table(spark, d, "supplier"), "lines": written(lines, "lines")}
    made = {k: spark.sql(v, **{n: t for n, t in views.items() if "{" + n + "}" in v}) for k, v in _PAGES.items()}
    made["diagrams"] = made["diagrams"].withColumn("path", F.lit(None).cast("array<string>"))
    made["taxonomies"] = spark.createDataFrame([], "page_id long, place int, path array<string>, source_url string")
    return made


_P = {k: v.replace("{lines}", _ONCE).replace("{supplier}", "supplier").replace("{lineitem}", "lineitem") for k, v in _PAGES.items()}


@query(
    "m10_ingest",
    f"""WITH v AS ({_P["vehicles"]}), p AS ({_P["parts"]}), g AS ({_P["diagrams"]}), h AS ({_P["hints"]}), r AS ({_P["relations"]}),
vi AS (SELECT catalog_brand, external_id, model, source_url, row_number() OVER (ORDER BY min((page_id % 2, page_id))) AS id FROM v GROUP BY ALL),
vp AS (SELECT v.page_id, v.catalog_brand, vi.id AS vehicle_id FROM v JOIN vi ON vi.catalog_brand IS NOT DISTINCT FROM v.catalog_brand AND vi.external_id = v.external_id AND vi.model = v.model AND vi.source_url = v.source_url),
gv AS (SELECT g.*, vehicle_id FROM g JOIN vp USING (page_id)),
gi AS (SELECT vehicle_id, code, source_url, row_number() OVER (ORDER BY min((page_id % 2, page_id, place))) AS id FROM gv GROUP BY ALL),
gp AS (SELECT gv.page_id, gv.code, gv.name, gi.id FROM gv JOIN gi USING (vehicle_id, code, source_url)),
one AS (SELECT page_id, min(id) AS id FROM gp GROUP BY 1 HAVING count(DISTINCT id) = 1),
n AS (SELECT page_id, 0 AS step, place, coalesce(brand, catalog_brand) AS brand, number FROM p LEFT JOIN vp USING (page_id) UNION ALL SELECT page_id, 1, place, brand, number FROM h UNION ALL SELECT page_id, 2, place, NULL, number FROM r),
ni AS (SELECT brand, number, row_number() OVER (ORDER BY min((page_id % 2, page_id, step, place))) AS id FROM n GROUP BY ALL),
used AS (SELECT p.page_id, p.place, ni.id AS part_id, vp.vehicle_id, coalesce(c.id, m.id, one.id) AS diagram_id, callout, quantity, p.source_url
  FROM p JOIN vp USING (page_id) JOIN ni ON ni.number = p.number AND ni.brand IS NOT DISTINCT FROM coalesce(p.brand, vp.catalog_brand)
  LEFT JOIN gp c ON c.page_id = p.page_id AND c.code = p.diagram_code LEFT JOIN gp m ON m.page_id = p.page_id AND m.name = p.diagram_name LEFT JOIN one ON one.page_id = p.page_id)
SELECT row_number() OVER (ORDER BY min((page_id % 2, page_id, place))) AS id, part_id, diagram_id, arg_min(vehicle_id, (page_id % 2, page_id, place)) AS vehicle_id, callout, quantity, source_url FROM used WHERE diagram_id IS NOT NULL GROUP BY part_id, diagram_id, callout, quantity, source_url""",
)
def m10(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences of parts after the even pages and then all pages went into the store, with the ids of their parents."""
    pages = _page_tables(spark, d)
    store, _ = ingest.ingest_pages({k: v.filter("page_id % 2 = 0") for k, v in pages.items()}, ingest.empty_store(spark), "p1", False, "page")
    store, _ = ingest.ingest_pages(pages, store, "p1", False, "page")
    return store["part_occurrence"].select("id", "part_id", "diagram_id", "vehicle_id", "callout", "quantity", "source_url")
