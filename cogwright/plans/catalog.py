"""Catalog queries: the flattened hierarchy, its rollups, searches, closures and publishing gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import gates, overlay, pagestore, paging
from ..operators.scratch import scratch_path
from .base import FLAT_SQL, flat_catalog, query, table


@query("n1_flat_catalog", f"WITH {FLAT_SQL} SELECT * FROM flat")
def n1(spark: SparkSession, d: str) -> DataFrame:
    """The hierarchy joined into one wide row a part line."""
    return flat_catalog(spark, d)


@query("e6_part_search", f"WITH {FLAT_SQL} SELECT part_number, part_id, part_name, brand, model, vehicle, month FROM flat WHERE starts_with(part_number, 'BRAND#1') ORDER BY part_number, vehicle_id, order_id, line LIMIT 200 OFFSET 200")
def e6(spark: SparkSession, d: str) -> DataFrame:
    """The second page of a part-number search; the filter is on the part side, below the joins."""
    found = paging.search(flat_catalog(spark, d), "BRAND#1", prefix=["part_number"])
    return found.orderBy("part_number", "vehicle_id", "order_id", "line").offset(200).limit(200).select("part_number", "part_id", "part_name", "brand", "model", "vehicle", "month")


_FORMS_SQL = "SELECT 'current' AS form, * FROM flat UNION ALL SELECT 'bounded', * FROM flat WHERE group_code = 'R' UNION ALL SELECT 'sample', * FROM flat WHERE part_id % 10 = 3"


@query("e6_list_pages", f"""WITH {FLAT_SQL}, once AS (SELECT form, part_number, vehicle_id, order_id, line, min(part_name) AS part_name FROM ({_FORMS_SQL}) GROUP BY ALL), placed AS (SELECT *, row_number() OVER (PARTITION BY form ORDER BY part_number, vehicle_id, order_id, line) AS place, count(*) OVER (PARTITION BY form) AS total FROM once),
asked AS (SELECT *, least(5, greatest(1, (total + 199) // 200)) AS page FROM placed)
SELECT form, part_number, vehicle_id, order_id, line, CASE WHEN vehicle_id % 4 = 1 THEN 'edited' ELSE part_name END AS part_name FROM asked WHERE place > (page - 1) * 200 AND place <= page * 200 AND vehicle_id % 5 <> 2""")
def e6_pages(spark: SparkSession, d: str) -> DataFrame:
    """Page 5 of the current, the bounded and the sample list, each laid out by its order, with the edits of its vehicles."""
    order = ["part_number", "vehicle_id", "order_id", "line"]
    flat = flat_catalog(spark, d).groupBy(*order, "group_code", "part_id").agg(F.min("part_name").alias("part_name"))
    heads = table(spark, d, "supplier").select(F.col("s_suppkey").alias("vehicle_id"), F.when(F.col("s_suppkey") % 4 == 1, '{"part_name":"edited"}').otherwise("{}").alias("payload"), F.when(F.col("s_suppkey") % 5 == 2, "retired").otherwise("active").alias("status"))
    pages = []
    for form, rule in (("current", "true"), ("bounded", "group_code = 'R'"), ("sample", "part_id % 10 = 3")):
        rows = flat.filter(rule).groupBy(*order).agg(F.min("part_name").alias("part_name"))
        path = scratch_path(spark, f"list-{form}")
        pagestore.write_list(rows, path, order)
        items, _ = pagestore.PagedList(spark, path, rows.schema, order).page(5, 200)
        pages.append(overlay.effective(items, heads, "vehicle_id", ["part_name"]).select(F.lit(form).alias("form"), *order, "part_name"))
    return reduce(DataFrame.unionByName, pages)


@query("n2_orphans", "SELECT 'lineitem.l_partkey' AS rule, count(*) AS n_bad FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) UNION ALL SELECT 'lineitem.l_suppkey', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) UNION ALL SELECT 'supplier.s_nationkey', count(*) FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey > 0)")
def n2(spark: SparkSession, d: str) -> DataFrame:
    """References to levels that a filter has unpublished."""
    t = {"lineitem": table(spark, d, "lineitem"), "supplier": table(spark, d, "supplier"), "part": table(spark, d, "part").filter("p_size > 5"), "good_supplier": table(spark, d, "supplier").filter("s_acctbal > 0"), "nation": table(spark, d, "nation").filter("n_regionkey > 0")}
    return gates.foreign_keys(t, [("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "good_supplier", "s_suppkey"), ("supplier", "s_nationkey", "nation", "n_nationkey")])


@query("n9_never_ordered", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def n9(spark: SparkSession, d: str) -> DataFrame:
    """Anti join: customers without an order."""
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(orders, "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("n21_smallest_part", "SELECT p_type, min(p_partkey) AS part_id, count(*) AS n FROM part GROUP BY 1")
def n21(spark: SparkSession, d: str) -> DataFrame:
    """The smallest part id of each name (a scalar sub-query as one aggregation)."""
    return table(spark, d, "part").groupBy("p_type").agg(F.min("p_partkey").alias("part_id"), F.count("*").alias("n"))


@query("n24_part_closure", "SELECT coalesce(a.k, b.k) AS part_id, coalesce(a.n, 0) AS seen, coalesce(b.n, 0) AS accepted FROM (SELECT l_partkey k, count(*) n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) a FULL JOIN (SELECT p_partkey k, count(*) n FROM part WHERE p_size <= 25 GROUP BY 1) b ON a.k = b.k WHERE coalesce(a.n, 0) = 0 OR coalesce(b.n, 0) <> 1")
def n24(spark: SparkSession, d: str) -> DataFrame:
    """Seen against accepted parts: what is not one to one."""
    seen = table(spark, d, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("part_id")).agg(F.count("*").alias("seen"))
    accepted = table(spark, d, "part").filter("p_size <= 25").groupBy(F.col("p_partkey").alias("part_id")).agg(F.count("*").alias("accepted"))
    j = seen.join(accepted, "part_id", "full_outer").select("part_id", F.coalesce("seen", F.lit(0)).alias("seen"), F.coalesce("accepted", F.lit(0)).alias("accepted"))
    return j.filter("seen = 0 or accepted <> 1")


@query("a1_group_counts", f"WITH {FLAT_SQL} SELECT brand, group_code, count(*) AS n_parts, count(DISTINCT part_id) AS n_distinct FROM flat GROUP BY 1, 2")
def a1(spark: SparkSession, d: str) -> DataFrame:
    """Parts in each group."""
    return flat_catalog(spark, d).groupBy("brand", "group_code").agg(F.count("*").alias("n_parts"), F.countDistinct("part_id").alias("n_distinct"))


@query("a2_conditional", "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS done, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS done_customers FROM orders GROUP BY 1")
def a2(spark: SparkSession, d: str) -> DataFrame:
    """Conditional sums and distinct counts (A2, A3)."""
    done = F.col("o_orderstatus") == "F"
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count_if(done).alias("done"), F.sum(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).alias("open"), F.countDistinct(F.when(done, F.col("o_custkey"))).alias("done_customers"))


@query("a8_rollup", f"WITH {FLAT_SQL} SELECT brand, model, vehicle_id, min(vehicle) AS vehicle, min(month) AS first_month, max(month) AS last_month, count(*) AS n FROM flat GROUP BY 1, 2, 3")
def a8(spark: SparkSession, d: str) -> DataFrame:
    """A vehicle's representative row from the snapshot."""
    return flat_catalog(spark, d).groupBy("brand", "model", "vehicle_id").agg(F.min("vehicle").alias("vehicle"), F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.count("*").alias("n"))


@query("a10_conflicting_keys", "SELECT l_partkey, l_suppkey, count(*) AS n, count(DISTINCT l_returnflag) AS versions FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 AND count(DISTINCT l_returnflag) > 1")
def a10(spark: SparkSession, d: str) -> DataFrame:
    """Natural keys that several artifacts have in differing versions (A10)."""
    return table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"), F.countDistinct("l_returnflag").alias("versions")).filter("n > 1 and versions > 1")


@query("a11_unique_backfill", "WITH u AS (SELECT p_type, min(p_brand) AS only_brand FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) = 1) SELECT p_partkey, coalesce(CASE WHEN p_size > 10 THEN p_brand END, only_brand) AS brand FROM part LEFT JOIN u USING (p_type)")
def a11(spark: SparkSession, d: str) -> DataFrame:
    """Blank brands filled where the type has one candidate only."""
    part = table(spark, d, "part")
    one = part.groupBy("p_type").agg(F.min("p_brand").alias("only_brand"), F.countDistinct("p_brand").alias("n")).filter("n = 1").drop("n")
    return part.join(one, "p_type", "left").select("p_partkey", F.coalesce(F.when(F.col("p_size") > 10, F.col("p_brand")), "only_brand").alias("brand"))


@query("w3_latest_order", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def w3(spark: SparkSession, d: str) -> DataFrame:
    """The latest row of each entity: an aggregation, which combines before it shuffles, and no window."""
    best = F.max_by(F.struct("o_orderkey", "o_totalprice"), F.struct("o_orderdate", "o_orderkey"))
    return table(spark, d, "orders").groupBy("o_custkey").agg(best.alias("b")).select("o_custkey", "b.o_orderkey", "b.o_totalprice")


@query("w4_high_water", "WITH n AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2), p AS (SELECT *, max(n) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM n) SELECT user_id, day, n, high, coalesce(high >= 3 AND n < 0.5 * high, false) AS shrunk FROM p")
def w4(spark: SparkSession, d: str) -> DataFrame:
    """High-water marks and the shrink detector."""
    n = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    high = F.max("n").over(Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1))
    return n.withColumn("high", high).withColumn("shrunk", F.coalesce((F.col("high") >= 3) & (F.col("n") < 0.5 * F.col("high")), F.lit(False)))


@query("w6_quota", "WITH n AS (SELECT l_suppkey AS g, count(*) AS n FROM lineitem GROUP BY 1), c AS (SELECT *, CAST(sum(n) OVER (ORDER BY g ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM n) SELECT g, n, CASE WHEN upto <= 20000 THEN n ELSE greatest(0, 20000 - (upto - n)) END AS accepted, CASE WHEN upto <= 20000 THEN 'done' WHEN upto - n < 20000 THEN 'partial' ELSE 'pending' END AS status FROM c")
def w6(spark: SparkSession, d: str) -> DataFrame:
    """Quota of the first 20,000 parts in group order: running sums of group counts, not a rank of every row."""
    n = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("g")).agg(F.count("*").alias("n"))
    c = paging.running_sum(n, "g", "n", "upto")
    room = F.lit(20000) - (F.col("upto") - F.col("n"))
    return c.select("g", "n", F.when(F.col("upto") <= 20000, F.col("n")).otherwise(F.greatest(F.lit(0), room)).alias("accepted"), F.when(F.col("upto") <= 20000, "done").when(room > 0, "partial").otherwise("pending").alias("status"))


@query("o2_keyset_page", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 100")
def o2(spark: SparkSession, d: str) -> DataFrame:
    """Keyset paging."""
    return paging.keyset_page(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 5000, 100)


@query("o5_truncated", "SELECT *, (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING') > 50 AS truncated FROM (SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey LIMIT 50)")
def o5(spark: SparkSession, d: str) -> DataFrame:
    """A fan-out cut at 50 rows, with a flag."""
    return paging.truncated(table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name"), ["c_custkey"], 50)


@query("u2_tree", "SELECT n_nationkey * 2 AS id, CAST(NULL AS BIGINT) AS parent_id, n_name AS name, 1 AS depth FROM nation UNION ALL SELECT s_suppkey * 2 + 1, s_nationkey * 2, s_name, 2 FROM supplier")
def u2(spark: SparkSession, d: str) -> DataFrame:
    """Two levels with disjoint ids as one tree."""
    top = table(spark, d, "nation").select(text.tree_id("n_nationkey", 0).alias("id"), F.lit(None).cast("long").alias("parent_id"), F.col("n_name").alias("name"), F.lit(1).alias("depth"))
    return top.unionByName(table(spark, d, "supplier").select(text.tree_id("s_suppkey", 1).alias("id"), text.tree_id("s_nationkey", 0).alias("parent_id"), F.col("s_name").alias("name"), F.lit(2).alias("depth")))


@query("u3_categories", "SELECT p_type AS name, 'source' AS status FROM part UNION SELECT event_type, 'event' FROM events UNION SELECT o_orderpriority, 'order' FROM orders")
def u3(spark: SparkSession, d: str) -> DataFrame:
    """Distinct union of three sources with a status."""
    a = table(spark, d, "part").select(F.col("p_type").alias("name"), F.lit("source").alias("status"))
    b = table(spark, d, "events").select(F.col("event_type").alias("name"), F.lit("event").alias("status"))
    return a.unionByName(b).unionByName(table(spark, d, "orders").select(F.col("o_orderpriority").alias("name"), F.lit("order").alias("status"))).distinct()


@query("u6_not_seen", "SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def u6(spark: SparkSession, d: str) -> DataFrame:
    """Known identities that the run has not seen."""
    seen = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return gates.closure(table(spark, d, "orders"), seen, ["o_orderkey"])


@query("v6_identity_closure", "WITH k AS (SELECT l_partkey AS uid, list(DISTINCT l_returnflag) AS k FROM lineitem GROUP BY 1), p AS (SELECT l_partkey AS uid, list(DISTINCT CASE WHEN l_linestatus = 'O' THEN '' ELSE l_returnflag END) AS p FROM lineitem WHERE l_quantity > 40 GROUP BY 1) SELECT k.uid, p IS NULL AS missing, array_to_string(list_sort(list_filter(k, lambda x: NOT list_contains(coalesce(p, []), x))), ',') AS missing_codes, coalesce(p IS NOT NULL AND len(list_filter(p, lambda x: x <> '')) = 0, false) AS downgraded FROM k LEFT JOIN p USING (uid)")
def v6(spark: SparkSession, d: str) -> DataFrame:
    """Known codes of each uid against what was parsed: gone, missing codes, downgraded to an image link."""
    lines = table(spark, d, "lineitem").withColumn("uid", F.col("l_partkey"))
    parsed = lines.filter("l_quantity > 40").select("uid", F.when(F.col("l_linestatus") == "O", "").otherwise(F.col("l_returnflag")).alias("code"))
    out = gates.identity_closure(lines.select("uid", F.col("l_returnflag").alias("code")), parsed, "uid", "code")
    return out.withColumn("missing_codes", F.array_join("missing_codes", ","))


@query("d3_fitment_window", "SELECT l_orderkey, l_linenumber, greatest(strftime(o_orderdate, '%Y-%m'), '1995-03') AS first, least(strftime(l_shipdate, '%Y-%m'), '1997-06') AS last, strftime(o_orderdate, '%Y-%m') <= '1997-06' AND strftime(l_shipdate, '%Y-%m') >= '1995-03' AS overlaps FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def d3(spark: SparkSession, d: str) -> DataFrame:
    """Months that two ranges share."""
    j = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    a, b = F.date_format("o_orderdate", "yyyy-MM"), F.date_format("l_shipdate", "yyyy-MM")
    first, last = dates.fitment_window(a, b, F.lit("1995-03"), F.lit("1997-06"))
    return j.select("l_orderkey", "l_linenumber", first.alias("first"), last.alias("last"), dates.ranges_overlap(a, b, F.lit("1995-03"), F.lit("1997-06")).alias("overlaps"))


_RULES_SQL = "SELECT * FROM (SELECT 'bad_price' AS rule, count(*) FILTER (o_totalprice < 1000) AS n_bad, min(CASE WHEN o_totalprice < 1000 THEN CAST(o_orderkey AS VARCHAR) END) AS sample_key FROM orders UNION ALL SELECT 'early', count(*) FILTER (o_orderdate < TIMESTAMP '1993-01-01'), min(CASE WHEN o_orderdate < TIMESTAMP '1993-01-01' THEN CAST(o_orderkey AS VARCHAR) END) FROM orders UNION ALL SELECT 'no_status', count(*) FILTER (coalesce(trim(o_orderstatus), '') = ''), min(CASE WHEN coalesce(trim(o_orderstatus), '') = '' THEN CAST(o_orderkey AS VARCHAR) END) FROM orders)"


@query("q1_required_fields", _RULES_SQL)
def q1(spark: SparkSession, d: str) -> DataFrame:
    """A gate's rules over a table, counted in one pass (Q1, V5)."""
    return gates.check(table(spark, d, "orders"), {"bad_price": F.col("o_totalprice") < 1000, "early": F.col("o_orderdate") < F.lit("1993-01-01").cast("timestamp"), "no_status": text.is_blank("o_orderstatus")}, "o_orderkey")


@query("v13_gated_view", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND (SELECT count(*) FROM orders WHERE o_totalprice < 0) = 0 AND (SELECT count(DISTINCT l_linestatus) FROM lineitem) = 2")
def v13(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a snapshot, or none, as its gates decide (V13): one plan with one-row flags."""
    orders = table(spark, d, "orders")
    ok = orders.agg((F.count_if(F.col("o_totalprice") < 0) == 0).alias("ok")).unionByName(table(spark, d, "lineitem").agg((F.countDistinct("l_linestatus") == 2).alias("ok")))
    return gates.gated(orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"), ok)


@query("a5_quality_vector", "SELECT count(*) AS n, count(*) FILTER (coalesce(trim(text), '') = '') AS blank_text, count(*) FILTER (coalesce(trim(lang), '') = '') AS blank_lang, count(DISTINCT source) AS sources, count(*) FILTER (n_chars <> length(text)) AS wrong_length, count(*) FILTER (strlen(text) <> length(text)) AS with_non_ascii FROM documents")
def a5(spark: SparkSession, d: str) -> DataFrame:
    """A table's quality counters in one pass."""
    return table(spark, d, "documents").agg(
        F.count("*").alias("n"), F.count_if(text.is_blank("text")).alias("blank_text"), F.count_if(text.is_blank("lang")).alias("blank_lang"), F.countDistinct("source").alias("sources"),
        F.count_if(F.col("n_chars") != F.char_length("text")).alias("wrong_length"), F.count_if(text.non_ascii("text")).alias("with_non_ascii"),
    )


@query("e7_part_fitments", f"WITH {FLAT_SQL} SELECT part_number, vehicle_id, min(month) AS first_month, max(month) AS last_month FROM flat GROUP BY 1, 2")
def e7(spark: SparkSession, d: str) -> DataFrame:
    """What a part fits."""
    return flat_catalog(spark, d).groupBy("part_number", "vehicle_id").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"))


@query("a16_readiness", "SELECT CASE WHEN (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') > 0 THEN 'open orders' ELSE '' END || ';' || CASE WHEN (SELECT count(*) FROM orders WHERE o_totalprice < 0) > 0 THEN 'negative price' ELSE '' END AS reasons, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') = 0 AS ready")
def a16(spark: SparkSession, d: str) -> DataFrame:
    """Blocking reasons from flags."""
    s = table(spark, d, "orders").agg(F.count_if(F.col("o_orderstatus") == "O").alias("open"), F.count_if(F.col("o_totalprice") < 0).alias("negative"))
    return s.select(F.concat_ws(";", F.when(F.col("open") > 0, "open orders").otherwise(""), F.when(F.col("negative") > 0, "negative price").otherwise("")).alias("reasons"), ((F.col("open") == 0) & (F.col("negative") == 0)).alias("ready"))
