"""Queries over evidence and curation. The tables are made of the fixture tables by SQL that both engines read alike."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import curation, evidence, publish
from ..operators.scratch import written
from .base import once, query, table

#: Snapshot rows, parsed records, captures, jobs and receipts of one run: a group is a supplier, a part is a line.
_LINES = "SELECT min(l_suppkey) AS l_suppkey, min(l_returnflag) AS l_returnflag, l_linenumber, min(l_quantity) AS l_quantity, l_orderkey * 10 + l_linenumber AS part_id, md5(CAST(l_orderkey * 10 + l_linenumber AS STRING)) AS sha FROM {lineitem} GROUP BY l_orderkey, l_linenumber"
_PARTS = "SELECT CAST(1 AS BIGINT) AS run_id, l_suppkey AS group_id, part_id, sha AS evidence_record_sha256, l_quantity AS quantity FROM ({lines}) AS x WHERE l_returnflag = 'R'"
_RECORDS = """SELECT CAST(1 AS BIGINT) AS run_id, l_suppkey AS artifact_id, CASE WHEN l_linenumber = 7 AND l_returnflag <> 'R' THEN 'quarantine_part' ELSE 'part' END AS record_type, l_returnflag = 'R' AS accepted, part_id, sha AS record_sha256
FROM ({lines}) AS x WHERE l_returnflag = 'R' OR l_linenumber = 7 OR (l_suppkey % 4 = 0 AND l_returnflag = 'A' AND l_linenumber = 1)"""
_COUNTED = """SELECT artifact_id, CAST(sum(CASE WHEN record_type = 'part' THEN 1 ELSE 0 END) AS BIGINT) AS parsed, CAST(sum(CASE WHEN record_type = 'part' AND accepted THEN 1 ELSE 0 END) AS BIGINT) AS accepted,
CAST(sum(CASE WHEN record_type = 'part' THEN 0 ELSE 1 END) AS BIGINT) AS skipped FROM ({records}) AS r GROUP BY artifact_id"""
_ARTIFACTS = """SELECT CAST(1 AS BIGINT) AS run_id, artifact_id, CASE WHEN artifact_id % 10 = 0 THEN 2 ELSE 1 END AS job_id, 'live_http' AS capture_kind,
  CASE WHEN artifact_id % 13 = {late} THEN TIMESTAMP '2000-01-02 00:06:00' WHEN artifact_id % 13 = 2 THEN TIMESTAMP '2000-01-02 00:04:00' ELSE TIMESTAMP '2000-01-01 06:00:00' END AS fetched_at, page_type, 'parse_parts' AS parser_name,
  'verified' AS verification_status, 200 AS http_status, false AS challenge_detected, 'Text/HTML; charset=utf-8' AS content_type, CASE WHEN artifact_id % 11 = {broken} THEN 1 ELSE 0 END AS malformed_row_count, TIMESTAMP '2000-01-03 00:00:00' AS verified_at,
  parsed + skipped AS parsed_record_count, accepted AS accepted_record_count, skipped AS skipped_record_count, md5(CAST(artifact_id AS STRING)) AS body_sha256
FROM (SELECT artifact_id, parsed, accepted, skipped, 'unit' AS page_type FROM ({counted}) AS c UNION ALL SELECT CAST(1000000000 + n_nationkey AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), 'page' || CAST(n_nationkey AS STRING) FROM {nation} WHERE n_nationkey < 5) AS a"""
_RECEIPTS = """SELECT CAST(1 AS BIGINT) AS run_id, artifact_id AS group_id, artifact_id AS source_artifact_id, CASE WHEN parsed = accepted THEN 'done' ELSE 'partial' END AS status, parsed AS parsed_part_count,
accepted + CASE WHEN artifact_id % 7 = {off} THEN 1 ELSE 0 END AS accepted_part_count, skipped AS skipped_record_count FROM ({counted}) AS c WHERE accepted > 0"""
_JOBS = """SELECT * FROM (VALUES (1, 'catalog', 'daemon', 'completed', 0, TIMESTAMP '2000-01-01 00:00:00', TIMESTAMP '2000-01-02 00:00:00'), (2, 'catalog', 'daemon', 'failed', 3, TIMESTAMP '2000-01-01 00:00:00', TIMESTAMP '2000-01-02 00:00:00'))
AS j(job_id, job_name, trigger_mode, status, exit_code, started_at, finished_at)"""


def _texts(late: int = -1, broken: int = -1, off: int = -1) -> dict[str, str]:
    """The fixtures' SQL with the names of tables left open; -1 leaves a kind of fault out."""
    return _texts_over(_LINES, None, late, broken, off)


def _texts_over(lines: str, counted: str | None, late: int = -1, broken: int = -1, off: int = -1) -> dict[str, str]:
    """The same over lines and counts that are made elsewhere."""
    records = _RECORDS.replace("{lines}", lines)
    counted = counted or _COUNTED.replace("{records}", records)
    artifacts = _ARTIFACTS.replace("{counted}", counted).replace("{late}", str(late)).replace("{broken}", str(broken))
    return {"parts": _PARTS.replace("{lines}", lines), "records": records, "artifacts": artifacts, "receipts": _RECEIPTS.replace("{counted}", counted).replace("{off}", str(off)), "jobs": _JOBS}


def _ctes(**faults: int) -> str:
    return ", ".join(f"{k} AS ({v.replace('{lineitem}', 'lineitem').replace('{nation}', 'nation')})" for k, v in _texts(**faults).items())


def _tables(spark: SparkSession, d: str, **faults: int) -> dict[str, DataFrame]:
    """The fixtures. Lines are taken together once and counted once, since every table and check reads them."""
    lines = once(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_returnflag", "l_quantity"])
    part = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    views = {"nation": table(spark, d, "nation"), "once": written(lines.select("l_suppkey", "l_returnflag", "l_linenumber", "l_quantity", part.alias("part_id"), F.md5(part.cast("string")).alias("sha")), "lines")}
    made = "SELECT * FROM {once}"
    views["counts"] = written(spark.sql(_COUNTED.replace("{records}", _RECORDS.replace("{lines}", made)), once=views["once"]), "counts")
    return {k: spark.sql(v, **{n: t for n, t in views.items() if "{" + n + "}" in v}) for k, v in _texts_over(made, "SELECT * FROM {counts}", **faults).items()}


def _run(spark: SparkSession, target: int, totals: DataFrame | None = None) -> DataFrame:
    """One run that ended well, with what its evidence should add up to."""
    run = spark.sql(
        """SELECT CAST(1 AS BIGINT) AS run_id, 1 AS run_job_id, TIMESTAMP '2000-01-01 00:00:00' AS run_started_at, 'bounded' AS dataset_kind, 'bounded_success' AS status, TIMESTAMP '2000-01-02 00:00:00' AS finished_at, CAST(NULL AS STRING) AS error_msg,
        'verified' AS evidence_status, TIMESTAMP '2000-01-03 00:00:00' AS evidence_verified_at, sha2('m', 256) AS evidence_manifest_sha256, sha2('d', 256) AS evidence_dataset_sha256, 'B' AS scope_brand, 'M' AS scope_model, 2000 AS scope_vehicle_year_floor"""
    ).withColumns({"target_parts": F.lit(target), "parts_ok": F.lit(target), "evidence_record_count": F.lit(target)})
    if totals is None:
        return run
    return run.crossJoin(totals.select(F.col("artifact_count").alias("evidence_artifact_count"), F.col("original_bytes").alias("evidence_original_bytes"), F.col("stored_bytes").alias("evidence_stored_bytes")))


@query(
    "q4_live_captures",
    f"""WITH {_ctes(late=1, broken=5)} SELECT artifact_id, coalesce(capture_kind = 'live_http' AND a.fetched_at >= TIMESTAMP '2000-01-01' AND a.fetched_at <= j.finished_at + INTERVAL 5 MINUTE
AND CASE WHEN a.job_id = 1 THEN j.status = 'completed' AND exit_code = 0 ELSE j.status = 'failed' AND exit_code <> 0 END AND http_status = 200 AND NOT challenge_detected AND lower(content_type) LIKE 'text/html%' AND malformed_row_count = 0, false) AS live
FROM artifacts a LEFT JOIN jobs j USING (job_id)""",
)
def q4(spark: SparkSession, d: str) -> DataFrame:
    """Captures that count as live evidence."""
    t = _tables(spark, d, late=1, broken=5)
    return evidence.live_captures(t["artifacts"], _run(spark, 1), t["jobs"]).select("artifact_id", "live")


_INTEGRITY = """n AS (SELECT group_id, count(*) AS snapshot_part_count FROM parts GROUP BY 1),
k AS (SELECT artifact_id AS group_id, count(*) FILTER (record_type = 'part') AS parsed, count(*) FILTER (record_type = 'part' AND accepted) AS accepted, count(*) FILTER (record_type = 'quarantine_part') AS skipped FROM records GROUP BY 1),
m AS (SELECT r.artifact_id AS group_id, count(DISTINCT r.part_id) AS members FROM records r JOIN parts p ON p.group_id = r.artifact_id AND p.part_id = r.part_id AND p.evidence_record_sha256 = r.record_sha256 WHERE r.record_type = 'part' AND r.accepted GROUP BY 1),
integrity AS (SELECT n.group_id, snapshot_part_count, coalesce(a.malformed_row_count = 0 AND k.parsed = parsed_part_count AND k.accepted = accepted_part_count AND k.skipped = skipped_record_count_r AND a.parsed_record_count = parsed_part_count + skipped_record_count_r
  AND a.accepted_record_count = accepted_part_count AND members = accepted_part_count AND snapshot_part_count = accepted_part_count AND (status = 'done' AND accepted_part_count = parsed_part_count OR status = 'partial' AND accepted_part_count > 0 AND accepted_part_count < parsed_part_count), false) AS is_verified
  FROM n LEFT JOIN (SELECT group_id, status, parsed_part_count, accepted_part_count, skipped_record_count AS skipped_record_count_r FROM receipts) r USING (group_id) LEFT JOIN artifacts a ON a.artifact_id = n.group_id LEFT JOIN k ON k.group_id = n.group_id LEFT JOIN m ON m.group_id = n.group_id)"""


@query("a4_receipt_integrity", f"WITH {_ctes(broken=5, off=3)}, {_INTEGRITY} SELECT group_id, snapshot_part_count, is_verified FROM integrity")
def a4(spark: SparkSession, d: str) -> DataFrame:
    """Whether receipts, captures, records and rows of each group agree."""
    t = _tables(spark, d, broken=5, off=3)
    return evidence.receipt_integrity(t["parts"], t["receipts"], t["artifacts"], t["records"]).drop("run_id")


@query(
    "v13_current_catalog",
    f"WITH {_ctes()}, {_INTEGRITY} SELECT 'bounded' AS dataset_scope, run_id, group_id, part_id, quantity FROM parts WHERE (SELECT bool_and(is_verified) FROM integrity) AND (SELECT count(DISTINCT page_type) FROM artifacts) = 6 AND (SELECT bool_and(fetched_at <= TIMESTAMP '2000-01-02 00:05:00') FROM artifacts)",
)
def v13(spark: SparkSession, d: str) -> DataFrame:
    """The rows to show when all evidence agrees, or none."""
    t = _tables(spark, d)
    bodies = t["artifacts"].select("body_sha256", F.lit(100).alias("original_bytes"), F.lit(40).alias("stored_bytes"))
    target = t["parts"].count()
    run = _run(spark, target, evidence.evidence_totals(t["artifacts"], _run(spark, target), t["jobs"], bodies))
    scope = spark.sql("SELECT 'B' AS scope_brand, 'M' AS scope_model, 2000 AS scope_vehicle_year_floor")
    return evidence.current_catalog(t["parts"], t["parts"].limit(0), run, t["jobs"], scope, t["artifacts"], bodies, t["records"], t["receipts"], target)


@query("v14_compatible", f"WITH {_ctes()} SELECT group_id, part_id, quantity FROM parts")
def v14(spark: SparkSession, d: str) -> DataFrame:
    """The current catalog as older readers see it."""
    return evidence.compatible(v13(spark, d))


@query(
    "a14_manifest",
    """WITH r AS (SELECT o_orderkey, sha256(len(CAST(o_orderkey AS VARCHAR)) || ':' || CAST(o_orderkey AS VARCHAR) || len(o_orderstatus) || ':' || o_orderstatus) AS line, CAST('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) AS pos FROM orders),
g AS (SELECT pos >> 26 AS range, count(*) AS n, sha256(string_agg(line, '' ORDER BY pos, o_orderkey, line)) AS d FROM r GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, sha256(string_agg(n || ':' || d, chr(10) ORDER BY range)) AS digest FROM g""",
)
def a14(spark: SparkSession, d: str) -> DataFrame:
    """A digest of rows in their order."""
    return evidence.manifest_digest(table(spark, d, "orders"), ["o_orderkey"], ["o_orderkey", "o_orderstatus"])


@query(
    "p20_bodies",
    "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'digest' WHEN 2 THEN 'broken' WHEN 3 THEN 'size' ELSE 'compression' END AS error, CASE WHEN doc_id % 5 IN (0, 1, 3) THEN CAST(strlen(text) AS BIGINT) END AS size FROM documents WHERE strlen(text) > 0",
)
def p20(spark: SparkSession, d: str) -> DataFrame:
    """Stored bodies unpacked and held against their key and size; some are damaged on purpose (P20)."""

    def pack(batches):
        for pdf in batches:
            raw = [zlib.compress(t.encode()) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "body": [b[: len(b) // 2] if i % 5 == 2 else b for i, b in zip(pdf["doc_id"], raw, strict=True)]})

    docs = table(spark, d, "documents").filter(F.octet_length("text") > 0)
    k = F.col("doc_id") % 5
    packed = docs.select("doc_id", "text").mapInPandas(pack, "doc_id long, body binary")
    meta = docs.select("doc_id", F.when(k == 1, F.sha2("text", 224)).otherwise(F.sha2("text", 256)).alias("sha"), F.when(k == 4, "gzip").otherwise("zlib").alias("compression"), (F.octet_length("text") + F.when(k == 3, 1).otherwise(0)).alias("original_bytes"))
    rows = packed.join(meta, "doc_id").select("doc_id", F.col("sha").alias("body_sha256"), "compression", "body", "original_bytes")
    return evidence.restored_bodies(rows, keep=["doc_id"]).drop("body_sha256")


@query(
    "e22_resumable",
    "SELECT o_orderkey AS run_id FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate + INTERVAL 120 DAY + INTERVAL 5 MINUTE) ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1",
)
def e22(spark: SparkSession, d: str) -> DataFrame:
    """The latest run that may be continued (E22): orders as runs, lines as their captures."""
    o, line = table(spark, d, "orders"), table(spark, d, "lineitem")
    status = F.when(F.col("o_orderstatus") == "O", "failed").otherwise("success")
    runs = o.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderkey").alias("run_job_id"), F.col("o_orderdate").alias("run_started_at"), status.alias("status"), F.col("o_orderpriority").alias("scope_brand"), F.lit("m").alias("scope_model"), F.lit(2000).alias("scope_vehicle_year_floor"), F.lit(10).alias("target_parts"), F.lit(3).alias("parts_ok"))
    jobs = o.select(F.col("o_orderkey").alias("job_id"), (F.col("o_orderdate") + F.expr("INTERVAL 120 DAYS")).alias("finished_at"))
    artifacts = line.select(F.col("l_orderkey").alias("run_id"), F.col("l_shipdate").alias("fetched_at"), (F.col("l_returnflag") == "A").alias("challenge_detected"), F.lit("verified").alias("verification_status"))
    return evidence.resumable_run(runs, jobs, artifacts, "1-URGENT", "m", 2000, 10).select("run_id")


_OLD_CATEGORIES = "SELECT min(p_partkey) AS id, CAST(p_size AS BIGINT) AS vehicle_id, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_type END AS cid, p_type AS name FROM {part} GROUP BY p_size, p_type"
_NEW_CATEGORIES = "SELECT CAST(p_size + p_partkey % 2 AS BIGINT) AS vehicle_id, CASE WHEN p_size % 5 = 0 THEN ' ' ELSE p_type END AS cid, CASE WHEN p_size % 5 = 0 THEN p_type ELSE p_type || ' new' END AS name, p_partkey AS position FROM {part} WHERE p_partkey % 3 < 2"


@query(
    "m4_categories",
    f"""WITH old AS ({_OLD_CATEGORIES.replace('{part}', 'part')}), raw AS (SELECT *, nullif(trim(cid), '') AS c FROM ({_NEW_CATEGORIES.replace('{part}', 'part')})),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id, coalesce('c:' || c, 'n:' || name) ORDER BY position DESC) AS n FROM raw) WHERE n = 1),
m AS (SELECT b.*, CASE WHEN c IS NOT NULL THEN o.id ELSE (SELECT min(id) FROM old x WHERE x.vehicle_id = b.vehicle_id AND x.name = b.name) END AS id FROM b LEFT JOIN old o ON o.vehicle_id = b.vehicle_id AND o.cid = b.c),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY position DESC) AS r FROM m WHERE id IS NOT NULL) WHERE r = 1)
SELECT o.id, o.vehicle_id, CASE WHEN k.id IS NOT NULL THEN k.c ELSE o.cid END AS cid, coalesce(k.name, o.name) AS name FROM old o LEFT JOIN k ON k.id = o.id UNION ALL SELECT id, vehicle_id, c, name FROM m WHERE id IS NULL""",
)
def m4(spark: SparkSession, d: str) -> DataFrame:
    """Categories by their id, else by their name (M4)."""
    part = table(spark, d, "part")
    return curation.upsert_categories(spark.sql(_OLD_CATEGORIES, part=part), spark.sql(_NEW_CATEGORIES, part=part))


_GROUPS = "SELECT o_orderkey AS group_id, o_custkey AS vehicle_id, CASE WHEN o_orderkey % 4 = 0 THEN 'run9' WHEN o_orderkey % 4 = 1 THEN 'run8' END AS fetched_run_key, CASE WHEN o_orderkey % 4 < 2 THEN 'done' END AS fetched_status, CASE WHEN o_orderkey % 4 < 2 THEN CAST(3 AS BIGINT) END AS fetched_row_count, CAST(3 AS BIGINT) AS verified_row_count FROM {orders}"
_GROUP_RECEIPTS = "SELECT l_orderkey AS group_id, 'run9' AS run_key, CASE l_returnflag WHEN 'R' THEN 'done' WHEN 'A' THEN 'partial' ELSE 'not_found' END AS status, CAST(l_quantity AS BIGINT) AS row_count, l_linenumber AS position FROM {lineitem} WHERE l_orderkey % 3 = 0"


@query(
    "m12_receipts",
    f"""WITH g AS ({_GROUPS.replace('{orders}', 'orders')}), r AS ({_GROUP_RECEIPTS.replace('{lineitem}', 'lineitem')}), t AS (SELECT group_id, max({{'p': position, 'k': run_key, 's': status, 'n': row_count}}) AS m, max(row_count) FILTER (status = 'done') AS high FROM r GROUP BY 1), l AS (SELECT group_id, m.k AS k, m.s AS s, m.n AS n, high FROM t)
SELECT g.group_id, vehicle_id, coalesce(k, fetched_run_key) AS fetched_run_key, coalesce(s, fetched_status) AS fetched_status, coalesce(n, fetched_row_count) AS fetched_row_count, greatest(verified_row_count, high) AS verified_row_count FROM g LEFT JOIN l USING (group_id)""",
)
def m12(spark: SparkSession, d: str) -> DataFrame:
    """Receipts with a high-water mark that only finished groups raise."""
    return curation.record_receipts(spark.sql(_GROUPS, orders=table(spark, d, "orders")), spark.sql(_GROUP_RECEIPTS, lineitem=table(spark, d, "lineitem")))


@query(
    "m12_not_found",
    f"""WITH g AS ({_GROUPS.replace('{orders}', 'orders')}) SELECT g.group_id, CASE WHEN c.c_custkey IS NOT NULL AND fetched_run_key IS DISTINCT FROM 'run9' THEN 'not_found' ELSE fetched_status END AS fetched_status, CASE WHEN c.c_custkey IS NOT NULL AND fetched_run_key IS DISTINCT FROM 'run9' THEN 0 ELSE fetched_row_count END AS fetched_row_count,
(SELECT count(*) FROM lineitem WHERE l_orderkey = g.group_id AND NOT (l_returnflag = 'R' AND c.c_custkey IS NOT NULL) AND l_returnflag <> 'N') AS seen FROM g LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') c ON c.c_custkey = g.vehicle_id""",
)
def m12_gone(spark: SparkSession, d: str) -> DataFrame:
    """Vehicles that are gone: their groups end, and their parts leave the run."""
    seen = F.when(F.col("l_returnflag") == "R", 9).when(F.col("l_returnflag") == "A", 8)
    parts = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("part_id"), F.col("l_orderkey").alias("group_id"), seen.alias("seen_run_id"))
    gone = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("vehicle_id"))
    groups, left = curation.vehicles_not_found(spark.sql(_GROUPS, orders=table(spark, d, "orders")), parts, gone, "run9", 9)
    counted = left.filter("seen_run_id is not null").groupBy("group_id").agg(F.count("*").alias("seen"))
    return groups.join(counted, "group_id", "left").select("group_id", "fetched_status", "fetched_row_count", F.coalesce("seen", F.lit(0)).alias("seen"))


@query(
    "m19_reset",
    f"WITH g AS ({_GROUPS.replace('{orders}', 'orders')}) SELECT group_id, CASE WHEN fetched_run_key = 'run9' THEN NULL ELSE fetched_run_key END AS fetched_run_key, CASE WHEN fetched_run_key = 'run9' THEN NULL ELSE fetched_status END AS fetched_status, verified_row_count, (SELECT count(*) FROM lineitem WHERE l_orderkey = g.group_id AND l_returnflag = 'A') AS seen FROM g",
)
def m19(spark: SparkSession, d: str) -> DataFrame:
    """A run taken back: its receipts and markers are null."""
    line = table(spark, d, "lineitem")
    parts = line.select(F.col("l_orderkey").alias("group_id"), F.when(F.col("l_returnflag") == "R", 9).when(F.col("l_returnflag") == "A", 8).alias("seen_run_id"))
    groups, left, _ = curation.reset_run(spark.sql(_GROUPS, orders=table(spark, d, "orders")), parts, line.selectExpr("'run9' as run_key", "'s' as scope"), "run9", 9)
    counted = left.filter("seen_run_id is not null").groupBy("group_id").agg(F.count("*").alias("seen"))
    return groups.join(counted, "group_id", "left").select("group_id", "fetched_run_key", "fetched_status", "verified_row_count", F.coalesce("seen", F.lit(0)).alias("seen"))


@query(
    "m20_resolutions",
    """WITH o AS (SELECT user_id AS vin, event_type AS resolved_uid, min(event_id) AS vehicle_id, 'old' AS status, 'r1' AS source_run_key, TIMESTAMP '2000-01-01' AS crawled_at FROM events WHERE event_id % 3 = 0 GROUP BY 1, 2),
n AS (SELECT user_id AS vin, event_type AS resolved_uid, arg_max(event_id, ts + to_microseconds(event_id)) AS vehicle_id, max(ts + to_microseconds(event_id)) AS crawled_at FROM events WHERE event_id % 3 <> 0 GROUP BY 1, 2)
SELECT coalesce(n.vin, o.vin) AS vin, coalesce(n.resolved_uid, o.resolved_uid) AS resolved_uid, coalesce(n.vehicle_id, o.vehicle_id) AS vehicle_id, CASE WHEN n.vin IS NULL THEN 'old' ELSE 'new' END AS status, CASE WHEN o.vin IS NULL THEN 'r2' ELSE 'r1' END AS source_run_key FROM o FULL JOIN n ON o.vin = n.vin AND o.resolved_uid = n.resolved_uid""",
)
def m20(spark: SparkSession, d: str) -> DataFrame:
    """VIN resolutions upserted by VIN and unit."""
    e = table(spark, d, "events").select(F.col("user_id").alias("vin"), F.col("event_type").alias("resolved_uid"), "event_id", (F.col("ts") + F.make_dt_interval(secs=F.col("event_id") / 1e6)).alias("crawled_at"))
    old = e.filter("event_id % 3 = 0").groupBy("vin", "resolved_uid").agg(F.min("event_id").alias("vehicle_id"), F.lit("old").alias("status"), F.lit("r1").alias("source_run_key"), F.to_timestamp(F.lit("2000-01-01")).alias("crawled_at"))
    new = e.filter("event_id % 3 <> 0").select("vin", "resolved_uid", F.col("event_id").alias("vehicle_id"), F.lit("new").alias("status"), F.lit("r2").alias("source_run_key"), "crawled_at")
    return curation.resolve_vins(old, new).drop("crawled_at")


@query("e20_problem_urls", "SELECT page_id AS id, url, CASE page_id % 6 WHEN 0 THEN 'failed' WHEN 1 THEN 'challenged' WHEN 2 THEN 'skipped_robots' ELSE 'parse_failed' END AS status, CASE WHEN page_id % 6 IN (0, 1) THEN 'pending' ELSE CASE page_id % 6 WHEN 2 THEN 'skipped_robots' ELSE 'parse_failed' END END AS requeued FROM pages WHERE page_id % 6 < 4")
def e20(spark: SparkSession, d: str) -> DataFrame:
    """URLs that went wrong, and what a requeue of failed and challenged ones makes of them."""
    status = F.when(F.col("page_id") % 6 == 0, "failed").when(F.col("page_id") % 6 == 1, "challenged").when(F.col("page_id") % 6 == 2, "skipped_robots").when(F.col("page_id") % 6 == 3, "parse_failed").otherwise("done")
    queue = table(spark, d, "pages").select(F.col("page_id").alias("id"), "url", F.lit("r").alias("run_key"), status.alias("status"), F.lit("e").alias("last_error"), F.current_timestamp().alias("finished_at"))
    again = curation.requeue(queue, "r", ("failed", "challenged")).select("id", F.col("status").alias("requeued"))
    return curation.problem_urls(queue, "r").select("id", "url", "status").join(again, "id")


@query(
    "v2_artifacts",
    "WITH k AS (SELECT p_brand, p_type, max(p_partkey) AS id, arg_max(CASE WHEN p_size < 10 THEN 'quarantined' ELSE 'imported' END, p_partkey) AS s FROM part WHERE p_partkey % 2 = 0 GROUP BY 1, 2) SELECT p_partkey, CASE s WHEN 'imported' THEN 'reuse' WHEN 'quarantined' THEN 'refuse' ELSE 'import' END AS action, CASE WHEN s = 'imported' THEN id END AS known_id FROM part LEFT JOIN k USING (p_brand, p_type) WHERE p_partkey % 2 = 1",
)
def v2(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of files by content that is known already (V2)."""
    rows = table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("dataset_name"), F.col("p_type").alias("source_key"), F.lit("s").alias("sha256"), F.lit(1).alias("parser_version"), publish.artifact_status(F.greatest(F.lit(0), F.lit(10) - F.col("p_size"))).alias("status"))
    known = rows.filter("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "artifact_id")
    return publish.reuse(rows.filter("p_partkey % 2 = 1"), known).select("p_partkey", "action", "known_id")


@query("v3_schema_drift", "WITH c AS (SELECT p_brand, p_type, min(p_size) AS was FROM part WHERE p_partkey % 2 = 0 GROUP BY 1, 2), n AS (SELECT p_brand, p_type, min(p_size) AS now FROM part WHERE p_partkey % 2 = 1 GROUP BY 1, 2) SELECT p_brand AS dataset_name, p_type AS source_key, CAST(was AS VARCHAR) AS was, CAST(now AS VARCHAR) AS now FROM n JOIN c USING (p_brand, p_type) WHERE was <> now")
def v3(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose field list is another than the current one's (V3, H6)."""
    of = lambda rest: table(spark, d, "part").filter(f"p_partkey % 2 = {rest}").groupBy(F.col("p_brand").alias("dataset_name"), F.col("p_type").alias("source_key")).agg(F.min("p_size").cast("string").alias("schema_sha256"))
    return publish.schema_drift(of(1), of(0))


@query("v4_malformed", "SELECT event_type AS kind, records, malformed, CAST(floor(records * 0.1) AS BIGINT) AS allowed FROM (SELECT event_type || CAST(user_id % 50 AS VARCHAR) AS event_type, count(*) AS records, count(*) FILTER (value < 12) AS malformed FROM events GROUP BY 1) WHERE malformed > floor(records * 0.1)")
def v4(spark: SparkSession, d: str) -> DataFrame:
    """Kinds with too many malformed rows (V4)."""
    counts = table(spark, d, "events").groupBy(F.concat("event_type", (F.col("user_id") % 50).cast("string")).alias("kind")).agg(F.count("*").alias("records"), F.count_if(F.col("value") < 12).alias("malformed"))
    return publish.malformed_gate(counts)


@query(
    "m15_confirm",
    """WITH r AS (SELECT o_orderkey AS id, o_custkey AS vin, o_orderkey % 7 AS v, o_orderkey % 2 = 0 AS ov, CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE 'ref' END AS ref FROM orders), d AS (SELECT c_custkey AS vin, c_custkey % 5 <> 0 AS whole, CAST(1995 + c_nationkey % 3 AS INT) AS y, c_mktsegment AS model FROM customer WHERE c_custkey % 4 <> 0),
j AS (SELECT r.*, d.vin IS NOT NULL AS dec, whole, y, model, CASE WHEN v = 1 THEN 'exact' WHEN v IN (2, 3) THEN 'review' END AS best, v IN (1, 2, 3, 4) AND y <> 1997 AS listed FROM r LEFT JOIN d USING (vin)),
e AS (SELECT *, CASE WHEN ov AND ref = ' ' THEN 'reference_missing' WHEN NOT dec THEN 'not_decoded' WHEN NOT whole AND NOT ov THEN 'decode_sparse' WHEN coalesce(best, '') <> 'exact' AND NOT ov THEN CASE WHEN best IS NULL THEN 'no_candidate' ELSE 'needs_review' END WHEN best IS NULL AND NOT listed THEN 'not_published' END AS error FROM j),
f AS (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY error IS NOT NULL, id) AS n FROM e)
SELECT id, coalesce(error, CASE WHEN n > 1 THEN 'already_mapped' END, CASE WHEN NOT whole THEN 'manual-sparse-override' WHEN coalesce(best, '') <> 'exact' THEN 'manual-name-override' ELSE 'manual-confirmed' END) AS outcome, CASE WHEN error IS NULL AND n = 1 THEN CASE WHEN NOT whole AND coalesce(best, '') <> 'exact' THEN 'E' || v WHEN whole THEN 'eng' END END AS engine FROM f""",
)
def m15(spark: SparkSession, d: str) -> DataFrame:
    """Requests to map VINs to vehicles: what each becomes."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    requests = o.select(F.col("o_orderkey").alias("request_id"), F.col("o_custkey").cast("string").alias("vin"), (F.col("o_orderkey") % 7).alias("vehicle_id"), (F.col("o_orderkey") % 2 == 0).alias("override"), F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise("ref").alias("reference"))
    decodes = c.filter("c_custkey % 4 <> 0").select(F.col("c_custkey").cast("string").alias("vin"), F.lit("mk").alias("make"), F.col("c_mktsegment").alias("model"), (F.lit(1995) + F.col("c_nationkey") % 3).alias("model_year"), F.when(F.col("c_custkey") % 5 != 0, "eng").alias("engine"), F.lit("t").alias("trim"))
    best = requests.filter("vehicle_id in (1, 2, 3)").select("vin", "vehicle_id", F.when(F.col("vehicle_id") == 1, "exact").otherwise("review").alias("status")).distinct()
    catalog = o.select((F.col("o_orderkey") % 7).alias("vehicle_id")).distinct().filter("vehicle_id in (1, 2, 3, 4)").select("vehicle_id", F.lit("mk").alias("make"), F.lit("md").alias("model"), F.concat(F.lit("E"), F.col("vehicle_id").cast("string")).alias("engine"), F.lit("tr").alias("trim"), F.lit(None).cast("int").alias("year_from"), F.lit(1996).alias("year_to"))
    made, refused = curation.confirm_mappings(requests, decodes, best, catalog, decodes.select("vin").limit(0))
    done = made.join(requests.select("vin", "vehicle_id", "request_id"), ["vin", "vehicle_id"]).join(refused.select("request_id"), "request_id", "left_anti")
    return done.select(F.col("request_id").alias("id"), F.col("source_name").alias("outcome"), "engine").unionByName(refused.select(F.col("request_id").alias("id"), F.col("error").alias("outcome"), F.lit(None).cast("string").alias("engine")))
