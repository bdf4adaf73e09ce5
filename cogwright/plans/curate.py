"""Merges, versions, quarantine, matching, overlays and digests over the fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, records, text
from ..operators import gates, merge, overlay, vin
from .base import query, table


def _batches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Events as an old table (ids not divisible by three) and a batch (even ids), with a changed value in the batch."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return e.filter("event_id % 3 <> 0"), e.filter("event_id % 2 = 0").withColumn("value", F.when(F.col("event_id") % 4 == 0, F.col("value") + 1).otherwise(F.col("value")))


_OLD_NEW = "old AS (SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 3 <> 0), new AS (SELECT event_id, user_id, event_type, CASE WHEN event_id % 4 = 0 THEN value + 1 ELSE value END AS value FROM events WHERE event_id % 2 = 0)"


@query("m1_merge", f"WITH {_OLD_NEW} SELECT coalesce(o.event_id, n.event_id) AS event_id, coalesce(n.user_id, o.user_id) AS user_id, coalesce(n.event_type, o.event_type) AS event_type, coalesce(n.value, o.value) AS value, CASE WHEN n.event_id IS NULL THEN 'kept' WHEN o.event_id IS NULL THEN 'inserted' WHEN o.value IS DISTINCT FROM n.value THEN 'updated' ELSE 'same' END AS change FROM old o FULL JOIN new n ON o.event_id = n.event_id")
def m1(spark: SparkSession, d: str) -> DataFrame:
    """Upsert with change detection and a count of new rows (M1, K5)."""
    old, new = _batches(spark, d)
    return merge.merge(old, new, ["event_id"]).withColumnRenamed("_change", "change")


@query("m2_stale_membership", "SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_orderkey % 2 = 0 AND (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_quantity >= 10) THEN NULL ELSE 7 END AS run_id FROM lineitem")
def m2(spark: SparkSession, d: str) -> DataFrame:
    """Rows of complete groups that the payload lacks lose their run marker; groups that a quota cut keep theirs."""
    members = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.lit(7).alias("run_id"))
    payload = table(spark, d, "lineitem").filter("l_quantity >= 10").select("l_orderkey", "l_linenumber")
    complete = table(spark, d, "lineitem").filter("l_orderkey % 2 = 0").select("l_orderkey")
    return merge.clear_stale(members, payload, "l_orderkey", ["l_orderkey", "l_linenumber"], complete, "run_id")


@query("m5_group_upgrade", "WITH r AS (SELECT l_suppkey AS category, l_partkey AS uid, CASE WHEN l_linestatus = 'O' THEN '' ELSE l_returnflag END AS code FROM lineitem), t AS (SELECT *, max(CASE WHEN code <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY category, uid) AS has_text FROM r) SELECT DISTINCT category, uid, code FROM t WHERE code <> '' OR has_text = 0")
def m5(spark: SparkSession, d: str) -> DataFrame:
    """Image links give way to text links of the same uid (M5, P5)."""
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("category"), F.col("l_partkey").alias("uid"), F.when(F.col("l_linestatus") == "O", "").otherwise(F.col("l_returnflag")).alias("code"), "l_orderkey")
    old, new = rows.filter("l_orderkey % 2 = 0").drop("l_orderkey"), rows.filter("l_orderkey % 2 = 1").drop("l_orderkey")
    return merge.upgrade_groups(old, new, "category", "uid", "code")


@query("m8_new_versions", "WITH v AS (SELECT DISTINCT l_partkey AS natural_key, sha256(l_returnflag || '|' || l_linestatus) AS record_sha256 FROM lineitem WHERE l_orderkey % 2 = 0), n AS (SELECT DISTINCT l_partkey AS natural_key, sha256(l_returnflag || '|' || l_linestatus) AS record_sha256 FROM lineitem WHERE l_orderkey % 2 = 1) SELECT natural_key, record_sha256 FROM n ANTI JOIN v USING (natural_key, record_sha256)")
def m8(spark: SparkSession, d: str) -> DataFrame:
    """Record versions that are new: insert-ignore on key and digest."""
    v = table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("natural_key"), F.sha2(F.concat_ws("|", "l_returnflag", "l_linestatus"), 256).alias("record_sha256"))
    old, new = v.filter("l_orderkey % 2 = 0").drop("l_orderkey"), v.filter("l_orderkey % 2 = 1").drop("l_orderkey")
    return merge.insert_new(old, new, ["natural_key", "record_sha256"])


@query("m9_conditional_key", "WITH k AS (SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN 'V' || user_id END, sha256(event_type || ':' || CAST(user_id % 50 AS VARCHAR))) AS merge_key FROM events) SELECT merge_key, max(event_id) AS event_id FROM k GROUP BY 1")
def m9(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a code merge by it, others by their content; the last row of a batch wins."""
    code = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("V"), F.col("user_id").cast("string")))
    key = F.coalesce(code, F.sha2(F.concat(F.col("event_type"), F.lit(":"), (F.col("user_id") % 50).cast("string")), 256))
    return merge.last_per_key(table(spark, d, "events").select(key.alias("merge_key"), "event_id"), ["merge_key"], ["event_id"])


@query("m6_quarantine", "WITH q AS (SELECT l_partkey AS part_id, min(l_orderkey) AS first_seen, bool_or(l_returnflag = 'A') AS resolved FROM lineitem WHERE l_quantity < 3 GROUP BY 1), s AS (SELECT DISTINCT l_partkey AS part_id FROM lineitem WHERE l_discount > 0.09) SELECT coalesce(q.part_id, s.part_id) AS part_id, first_seen, CASE WHEN s.part_id IS NOT NULL THEN false ELSE resolved END AS resolved, CASE WHEN q.part_id IS NULL THEN 'new' WHEN s.part_id IS NOT NULL AND resolved THEN 'reopened' ELSE 'unchanged' END AS change FROM q FULL JOIN s ON q.part_id = s.part_id")
def m6(spark: SparkSession, d: str) -> DataFrame:
    """Quarantined parts that are seen again are reopened (M6, K6)."""
    lines = table(spark, d, "lineitem").withColumnRenamed("l_partkey", "part_id")
    q = lines.filter("l_quantity < 3").groupBy("part_id").agg(F.min("l_orderkey").alias("first_seen"), F.bool_or(F.col("l_returnflag") == "A").alias("was"), F.lit(True).alias("old"))
    s = lines.filter("l_discount > 0.09").select("part_id").distinct().withColumn("again", F.lit(True))
    j = q.join(s, "part_id", "full_outer")
    change = F.when(F.col("old").isNull(), "new").when(F.col("again").isNotNull() & F.col("was"), "reopened").otherwise("unchanged")
    return j.select("part_id", "first_seen", F.when(F.col("again").isNotNull(), False).otherwise(F.col("was")).alias("resolved"), change.alias("change"))


@query("m13_edit_requests", "WITH h AS (SELECT p_partkey AS k, p_size % 3 AS revision FROM part WHERE p_partkey % 2 = 0), r AS (SELECT event_id AS request_id, user_id AS k, event_id % 3 AS expected, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) SELECT k AS part_id, request_id, coalesce(revision, 0) + 1 AS revision FROM r LEFT JOIN h USING (k) WHERE n = 1 AND expected = coalesce(revision, 0)")
def m13(spark: SparkSession, d: str) -> DataFrame:
    """Edits with an expected revision: those that are accepted."""
    heads = table(spark, d, "part").filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("part_id"), (F.col("p_size") % 3).alias("revision"), F.lit("{}").alias("payload"), F.lit("active").alias("status"))
    asked = table(spark, d, "events").select(F.col("user_id").alias("part_id"), F.col("event_id").alias("request_id"), (F.col("event_id") % 3).alias("expected_revision"), F.lit("set").alias("action"), F.col("props").alias("payload"))
    _, events, _ = merge.apply_requests(heads, asked, ["part_id"])
    return events.select("part_id", "request_id", F.col("revision").cast("long").alias("revision"))


@query("m16_typed_projection", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) BETWEEN 10 AND 80 THEN NULL ELSE 'k out of range' END AS error FROM events")
def m16(spark: SparkSession, d: str) -> DataFrame:
    """JSON fields as typed columns, with a reject reason."""
    k = records.json_number("props", "k", "int")
    return table(spark, d, "events").select("event_id", k.alias("k"), F.when(~F.coalesce(k.between(10, 80), F.lit(False)), "k out of range").alias("error"))


def _vehicles(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders as decodes and parts as catalog vehicles, with year bounds."""
    orders = table(spark, d, "orders")
    decodes = orders.select(F.concat(F.lit("VIN"), F.col("o_orderkey")).alias("vin"), F.concat(F.lit("brand#1"), F.col("o_custkey") % 5).alias("make"), F.concat(F.lit("m "), F.col("o_custkey") % 7).alias("model"), F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("e-"), F.col("o_orderkey") % 4)).alias("engine"), F.when(F.col("o_orderkey") % 5 > 0, F.concat(F.lit("T"), F.col("o_orderkey") % 2)).alias("trim"), F.year("o_orderdate").alias("model_year"))
    vehicles = table(spark, d, "supplier").select(F.col("s_suppkey").alias("vehicle_id"), F.concat(F.lit("BRAND 1"), F.col("s_suppkey") % 5).alias("make"), F.concat(F.lit("M-"), F.col("s_suppkey") % 7).alias("model"), F.when(F.col("s_suppkey") % 4 > 0, F.concat(F.lit("E"), F.col("s_suppkey") % 4)).alias("engine"), F.concat(F.lit("t "), F.col("s_suppkey") % 2).alias("trim"), F.when(F.col("s_suppkey") % 3 > 0, F.lit("1993-05")).alias("production_from"), F.when(F.col("s_suppkey") % 2 > 0, F.lit("1996-09")).alias("production_to"))
    return decodes, vehicles


_VEHICLES = """dec AS (SELECT 'VIN' || o_orderkey AS vin, 'BRAND1' || (o_custkey % 5) AS make, 'M' || (o_custkey % 7) AS model, CASE WHEN o_orderkey % 3 > 0 THEN 'E' || (o_orderkey % 4) ELSE '' END AS engine, CASE WHEN o_orderkey % 5 > 0 THEN 'T' || (o_orderkey % 2) ELSE '' END AS trim, year(o_orderdate) AS y FROM orders),
veh AS (SELECT s_suppkey AS vehicle_id, 'BRAND1' || (s_suppkey % 5) AS make, 'M' || (s_suppkey % 7) AS model, CASE WHEN s_suppkey % 4 > 0 THEN 'E' || (s_suppkey % 4) ELSE '' END AS engine, 'T' || (s_suppkey % 2) AS trim, CASE WHEN s_suppkey % 3 > 0 THEN 1993 END AS f, CASE WHEN s_suppkey % 2 > 0 THEN 1996 END AS t FROM supplier),
cand AS (SELECT vin, vehicle_id, d.engine = v.engine AND d.trim = v.trim AND d.engine <> '' AND d.trim <> '' AS strict FROM dec d JOIN veh v ON d.make = v.make AND d.model = v.model AND (f IS NULL OR y >= f) AND (t IS NULL OR y <= t) AND (d.engine = '' OR v.engine = '' OR d.engine = v.engine))"""


@query("n4_vin_candidates", f"WITH {_VEHICLES} SELECT * FROM cand")
def n4(spark: SparkSession, d: str) -> DataFrame:
    """Strict and loose catalog candidates of decoded vehicles (N4, N5): equi keys with a year range as residual."""
    return vin.candidates(*_vehicles(spark, d))


@query("w1_best_candidates", f"WITH {_VEHICLES}, one AS (SELECT vin, vehicle_id, bool_or(strict) AS strict FROM cand GROUP BY 1, 2) SELECT *, CASE WHEN strict AND sum(CASE WHEN strict THEN 1 ELSE 0 END) OVER (PARTITION BY vin) = 1 THEN 'exact' WHEN strict THEN 'ambiguous' ELSE 'review' END AS status FROM one")
def w1(spark: SparkSession, d: str) -> DataFrame:
    """Candidates by vehicle with exact, ambiguous or review."""
    return vin.best_candidates_of(*_vehicles(spark, d))


@query("a12_strict_counts", f"WITH {_VEHICLES} SELECT vin, count(DISTINCT vehicle_id) AS strict_count FROM cand WHERE strict GROUP BY 1")
def a12(spark: SparkSession, d: str) -> DataFrame:
    """Strict candidates counted once for each vehicle."""
    return vin.strict_counts_of(*_vehicles(spark, d))


def _mappings(spark: SparkSession, d: str) -> DataFrame:
    policy = F.when(F.col("o_orderkey") % 4 == 0, "sparse_override").when(F.col("o_orderkey") % 4 == 1, "name_override").otherwise("strict")
    return table(spark, d, "orders").select(F.concat(F.lit("VIN"), F.col("o_orderkey") + F.when(F.col("o_orderkey") % 11 == 0, 10**9).otherwise(0)).alias("vin"), (F.col("o_custkey") % 120 + 1).alias("vehicle_id"), policy.alias("policy"))


_MAPPINGS = "map AS (SELECT 'VIN' || (o_orderkey + CASE WHEN o_orderkey % 11 = 0 THEN 1000000000 ELSE 0 END) AS vin, o_custkey % 120 + 1 AS vehicle_id, CASE o_orderkey % 4 WHEN 0 THEN 'sparse_override' WHEN 1 THEN 'name_override' ELSE 'strict' END AS policy FROM orders)"


@query("n6_vin_fitments", f"WITH {_VEHICLES}, {_MAPPINGS}, cnt AS (SELECT vin, count(DISTINCT vehicle_id) AS n FROM cand WHERE strict GROUP BY 1), live AS (SELECT m.vin, m.vehicle_id, d.y, m.policy FROM map m JOIN dec d ON m.vin = d.vin LEFT JOIN cnt ON cnt.vin = m.vin LEFT JOIN (SELECT DISTINCT vin, vehicle_id FROM cand WHERE strict) s ON s.vin = m.vin AND s.vehicle_id = m.vehicle_id WHERE CASE m.policy WHEN 'sparse_override' THEN d.engine = '' AND d.trim = '' WHEN 'name_override' THEN NOT (d.engine = '' AND d.trim = '') ELSE cnt.n = 1 AND s.vin IS NOT NULL END), part_rows AS (SELECT DISTINCT l_suppkey AS vehicle_id, l_partkey AS part_id, strftime(date_trunc('year', l_shipdate), '%Y') AS py FROM lineitem) SELECT live.vin, live.vehicle_id, part_id, policy, count(*) AS n FROM live JOIN part_rows p ON p.vehicle_id = live.vehicle_id AND live.y = CAST(py AS INTEGER) GROUP BY 1, 2, 3, 4")
def n6(spark: SparkSession, d: str) -> DataFrame:
    """Parts that fit mapped vehicles, by the mapping's policy."""
    decodes, vehicles = _vehicles(spark, d)
    year = F.date_format("l_shipdate", "yyyy")
    parts = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("vehicle_id"), F.col("l_partkey").alias("part_id"), F.concat(year, F.lit("-01")).alias("part_from"), F.concat(year, F.lit("-12")).alias("part_to")).distinct()
    return vin.fitment_counts(_mappings(spark, d), decodes, vehicles, parts)


@query("n7_mapping_status", f"WITH {_VEHICLES}, {_MAPPINGS} SELECT m.vin, m.vehicle_id, CASE WHEN d.vin IS NULL THEN 'decode_missing' WHEN v.vehicle_id IS NULL THEN 'vehicle_unpublished' WHEN m.policy = 'strict' AND s.vin IS NULL OR m.policy = 'name_override' AND d.engine = '' AND d.trim = '' OR m.policy = 'sparse_override' AND NOT (d.engine = '' AND d.trim = '') THEN 'stale' ELSE 'confirmed' END AS status FROM map m LEFT JOIN dec d ON d.vin = m.vin LEFT JOIN veh v ON v.vehicle_id = m.vehicle_id LEFT JOIN (SELECT DISTINCT vin, vehicle_id FROM cand WHERE strict) s ON s.vin = m.vin AND s.vehicle_id = m.vehicle_id")
def n7(spark: SparkSession, d: str) -> DataFrame:
    """Whether mappings still hold."""
    decodes, vehicles = _vehicles(spark, d)
    return vin.mapping_status(_mappings(spark, d), decodes, vehicles)


@query("e5_effective_parts", "SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'name ' || p_partkey ELSE p_name END AS p_name, p_brand, p_partkey % 7 = 0 OR p_partkey % 7 = 1 AS overridden FROM part WHERE p_partkey % 7 <> 2")
def e5(spark: SparkSession, d: str) -> DataFrame:
    """Parts with manual edits applied: an override, a null override, a retired row."""
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    edited = part.filter("p_partkey % 7 < 3")
    payload = F.when(F.col("p_partkey") % 7 == 0, F.to_json(F.struct(F.concat(F.lit("name "), F.col("p_partkey")).alias("p_name")))).otherwise(F.lit('{"p_name": null}'))
    heads = edited.select("p_partkey", payload.alias("payload"), F.when(F.col("p_partkey") % 7 == 2, "retired").otherwise("active").alias("status"))
    return overlay.effective(part, heads, "p_partkey", ["p_name"])


@query("u5_listing", "SELECT 'source' AS kind, p_partkey, p_name FROM part WHERE p_partkey % 5 > 1 UNION ALL SELECT 'overridden', p_partkey, 'edited' FROM part WHERE p_partkey % 5 = 0 UNION ALL SELECT 'manual', -s_suppkey, s_name FROM supplier")
def u5(spark: SparkSession, d: str) -> DataFrame:
    """Source, overridden and manual rows as one list."""
    part = table(spark, d, "part").select("p_partkey", "p_name")
    heads = part.filter("p_partkey % 5 < 2").select("p_partkey", F.lit('{"p_name":"edited"}').alias("payload"), F.when(F.col("p_partkey") % 5 == 1, "retired").otherwise("active").alias("status"))
    manual = table(spark, d, "supplier").select((-F.col("s_suppkey")).alias("p_partkey"), F.col("s_name").alias("p_name"))
    return overlay.listing(part, heads, manual, "p_partkey", ["p_name"])


@query("v1_publish_gate", "WITH r AS (SELECT l_orderkey AS artifact, count(*) AS parsed, count(*) FILTER (l_discount > 0.09) AS rejected FROM lineitem GROUP BY 1) SELECT 'rejects' AS rule, count(*) FILTER (rejected > 0) AS n_bad, min(CASE WHEN rejected > 0 THEN CAST(artifact AS VARCHAR) END) AS sample_key FROM r UNION ALL SELECT 'too_many_rows', count(*) FILTER (parsed > 6), min(CASE WHEN parsed > 6 THEN CAST(artifact AS VARCHAR) END) FROM r")
def v1(spark: SparkSession, d: str) -> DataFrame:
    """Rules that a bulk publish must not break (V1, V2, V4)."""
    r = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("artifact")).agg(F.count("*").alias("parsed"), F.count_if(F.col("l_discount") > 0.09).alias("rejected"))
    return gates.check(r, {"rejects": F.col("rejected") > 0, "too_many_rows": F.col("parsed") > 6}, "artifact")


@query("v8_evidence_chain", "WITH e AS (SELECT l_orderkey * 10 + l_linenumber AS digest, CASE WHEN l_linenumber > 1 THEN l_orderkey * 10 + l_linenumber - 1 END AS parent FROM lineitem WHERE l_quantity > 5) SELECT digest, parent FROM e WHERE parent IS NOT NULL AND parent NOT IN (SELECT digest FROM e)")
def v8(spark: SparkSession, d: str) -> DataFrame:
    """Evidence records whose parent is missing (V8)."""
    digest = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    e = table(spark, d, "lineitem").filter("l_quantity > 5").select(digest.alias("digest"), F.when(F.col("l_linenumber") > 1, digest - 1).alias("parent"))
    return gates.orphans(e, e.select(F.col("digest").alias("id")), {"parent": "id"})


@query("v9_payload_check", "SELECT p_partkey, sha256(CAST(octet_length(CAST(p_name AS BLOB)) AS VARCHAR) || ':' || p_name || CAST(octet_length(CAST(p_brand AS BLOB)) AS VARCHAR) || ':' || p_brand) AS identity, p_size > 40 AS tampered FROM part")
def v9(spark: SparkSession, d: str) -> DataFrame:
    """Digests of rows made anew and held against stored ones."""
    part = table(spark, d, "part")
    stored = part.select("p_partkey", records.identity_hash(["p_name", F.when(F.col("p_size") > 40, F.lit("x")).otherwise(F.col("p_brand"))]).alias("stored"))
    return part.select("p_partkey", records.identity_hash(["p_name", "p_brand"]).alias("identity")).join(stored, "p_partkey").select("p_partkey", "identity", (F.col("identity") != F.col("stored")).alias("tampered"))


@query(
    "a13_dataset_digest",
    """WITH l AS (SELECT sha256(string_agg(strlen(x) || ':' || x, '' ORDER BY i)) AS h FROM (SELECT p_partkey, unnest([CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type]) AS x, unnest([1, 2, 3, 4]) AS i FROM part) GROUP BY p_partkey),
s AS (SELECT count(*) AS n, sum(CAST('0x' || substr(h, 1, 15) AS HUGEINT)) AS a, sum(CAST('0x' || substr(h, 16, 15) AS HUGEINT)) AS b, sum(CAST('0x' || substr(h, 31, 15) AS HUGEINT)) AS c, sum(CAST('0x' || substr(h, 46, 15) AS HUGEINT)) AS e FROM l)
SELECT n AS n_rows, sha256(n || ':' || a || ':' || b || ':' || c || ':' || e) AS digest FROM s""",
)
def a13(spark: SparkSession, d: str) -> DataFrame:
    """A digest of a table that does not depend on row order."""
    return gates.dataset_digest(table(spark, d, "part"), ["p_partkey", "p_name", "p_brand", "p_type"])


@query("n16_capture_window", "SELECT o_orderkey, l_linenumber, l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 60 DAY + INTERVAL 5 MINUTE AS in_time FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def n16(spark: SparkSession, d: str) -> DataFrame:
    """Captures within their run's time, with five minutes of grace."""
    j = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.select("o_orderkey", "l_linenumber", ((F.col("l_shipdate") >= F.col("o_orderdate")) & (F.col("l_shipdate") <= F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS") + F.expr("INTERVAL 5 MINUTES"))).alias("in_time"))


@query("d5_year_window", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' OR year(o_orderdate) >= 1998 - 3")
def d5(spark: SparkSession, d: str) -> DataFrame:
    """A rolling age filter; an unknown end passes."""
    end = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM"))
    return table(spark, d, "orders").filter(dates.in_year_window(end, 3, F.lit("1998-01-01").cast("date"))).select("o_orderkey")


@query("e13_dashboard", "SELECT 'part' AS entity, count(*) AS source, count(*) FILTER (p_size < 5) AS overridden FROM part UNION ALL SELECT 'supplier', count(*), count(*) FILTER (s_acctbal < 0) FROM supplier UNION ALL SELECT 'customer', count(*), count(*) FILTER (c_acctbal < 0) FROM customer")
def e13(spark: SparkSession, d: str) -> DataFrame:
    """Counts by entity."""
    def one(name: str, cond) -> DataFrame:
        return table(spark, d, name).agg(F.count("*").alias("source"), F.count_if(cond).alias("overridden")).select(F.lit(name).alias("entity"), "source", "overridden")

    return one("part", F.col("p_size") < 5).unionByName(one("supplier", F.col("s_acctbal") < 0)).unionByName(one("customer", F.col("c_acctbal") < 0))


@query("f_identifiers", "SELECT p_partkey, regexp_replace(upper(p_name), '[^A-Z0-9]', '', 'g') AS name_key, CAST(('0x' || substr(sha256(p_name), 1, 15)) AS BIGINT) AS surrogate, substr(p_name, 1, 3) || '**********' || right(p_name, 4) AS masked, CAST(p_partkey AS BIGINT) * 4294967296 + p_size AS pair, regexp_matches(p_name, '(?i)\\b(ASSY|ASSEMBLY|SUB-ASSY)\\b') AS is_assembly FROM part")
def f_identifiers(spark: SparkSession, d: str) -> DataFrame:
    """Keys, surrogates and masks over part names."""
    return table(spark, d, "part").select("p_partkey", text.alnum_key("p_name").alias("name_key"), text.vin_surrogate("p_name").alias("surrogate"), text.mask_vin("p_name").alias("masked"), text.pair_id("p_partkey", "p_size").alias("pair"), text.assembly_flag("p_name")["flag"].alias("is_assembly"))
