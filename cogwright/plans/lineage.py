"""Ancestors of evidence records, and whole runs verified by merges. The records are made of the fixture tables by SQL that both engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ancestry, fullrun
from ..operators.scratch import written
from .base import ROWS_PER_TASK, query, table
from .evidence import _ctes, _tables

KINDS = ("brand", "model", "vehicle", "category", "group", "part")
#: Region, nation, supplier, supplier and flag, the same and line number, and line, with parents that are gone, of a wrong kind or their own.
_LINES = "SELECT l_orderkey, l_linenumber, min(l_suppkey) AS s, min(l_returnflag) AS f, min(l_quantity) AS q FROM {lineitem} GROUP BY l_orderkey, l_linenumber"
_RECORDS = """SELECT 'brand' AS kind, 'b' || r_regionkey AS key, CAST(NULL AS STRING) AS parent, CAST(NULL AS BIGINT) AS part_id, CAST(NULL AS STRING) AS record_sha256, CAST(NULL AS STRING) AS source_url, false AS accepted FROM {region}
UNION ALL SELECT 'model', 'm' || n_nationkey, CASE WHEN n_nationkey % 7 = 3 THEN 'gone' ELSE 'b' || n_regionkey END, NULL, NULL, NULL, false FROM {nation}
UNION ALL SELECT 'vehicle', 'v' || s_suppkey, CASE WHEN s_suppkey % 11 = 5 THEN 'v' || s_suppkey WHEN s_suppkey % 13 = 4 THEN 'b0' WHEN s_suppkey % 17 = 2 THEN NULL ELSE 'm' || s_nationkey END, NULL, NULL, NULL, false FROM {supplier}
UNION ALL SELECT DISTINCT 'category', 'c' || s || f, 'v' || s, NULL, NULL, NULL, false FROM ({lines}) AS x
UNION ALL SELECT DISTINCT 'group', 'g' || s || f || l_linenumber, 'c' || s || f, NULL, NULL, NULL, false FROM ({lines}) AS y
UNION ALL SELECT 'part', 'p' || l_orderkey || '-' || l_linenumber, 'g' || s || f || l_linenumber, l_orderkey * 10 + l_linenumber, md5(CAST(CASE WHEN l_orderkey % 19 = 1 THEN 0 ELSE l_orderkey END AS STRING)), 'https://x/' || CASE WHEN l_orderkey % 23 = 1 THEN 'other' ELSE CAST(s AS STRING) END, true FROM ({lines}) AS z WHERE l_orderkey % 29 <> 1"""
_PARTS = "SELECT l_orderkey * 10 + l_linenumber AS part_id, 'p' || l_orderkey || '-' || l_linenumber AS key, 'g' || s || f || CASE WHEN l_orderkey % 31 = 1 THEN 9 ELSE l_linenumber END AS group_key, md5(CAST(l_orderkey AS STRING)) AS record_sha256, 'https://x/' || s AS source_url FROM ({lines}) AS w"
_PART_ID = "l_orderkey * 10 + l_linenumber"
_TABLES = ("lineitem", "region", "nation", "supplier")


def _filled(text: str) -> str:
    return text.replace("{lines}", _LINES)


def _plain(text: str) -> str:
    text = _filled(text)
    for t in _TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def _made(spark: SparkSession, d: str, text: str) -> DataFrame:
    return spark.sql(text, **{t: table(spark, d, t) for t in _TABLES if "{" + t + "}" in text})


def _of_lines(spark: SparkSession, d: str, *texts: str) -> list[DataFrame]:
    """What the texts say, made of _LINES that are taken together once and stored by part_id.

    What is made of lines is wide and meets by that key, so it isn't shuffled. Categories and groups are made of distinct values.
    """
    lines = table(spark, d, "lineitem")
    buckets, part_id = max(1, -(-lines.count() // ROWS_PER_TASK)), F.expr(_PART_ID)
    dealt = lines.select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag").repartition(buckets, part_id)
    one = dealt.groupBy(part_id.alias("part_id"), "l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("s"), F.min("l_returnflag").alias("f"))
    views = {t: table(spark, d, t) for t in _TABLES if t != "lineitem"} | {"lines": fullrun.stored_by(one, "part_id", buckets, "lines")}
    views["groups"] = written(views["lines"].select("s", "f", "l_linenumber").distinct(), "groups")
    made = [t.replace(_PART_ID, "part_id").replace("({lines}) AS x", "({groups}) AS x").replace("({lines}) AS y", "({groups}) AS y") for t in texts]
    return [spark.sql(t, **{n: v for n, v in views.items() if "{" + n + "}" in t}) for t in made]


_STEPS = "".join(f" LEFT JOIN r AS r{i} ON r{i}.key = r{i - 1}.parent" for i in range(1, 6))
_WRONG = " ".join(f"WHEN r{i - 1}.parent IS NULL THEN 'no_parent' WHEN r{i}.key IS NULL THEN 'missing_parent' WHEN r{i}.kind <> '{KINDS[5 - i]}' THEN 'wrong_type'" for i in range(1, 6))


@query(
    "v9_ancestors",
    f"""WITH r AS ({_plain(_RECORDS)}), p AS ({_plain(_PARTS)}),
j AS (SELECT p.part_id, r0.key AS rk, CASE WHEN r0.key IS NULL THEN 'no_record' WHEN r0.parent <> p.group_key THEN 'parent' WHEN r0.record_sha256 <> p.record_sha256 THEN 'payload' WHEN r0.source_url <> p.source_url THEN 'url' {_WRONG} END AS defect,
  concat_ws('>', r1.key, r2.key, r3.key, r4.key, r5.key) AS chain FROM p LEFT JOIN r AS r0 ON r0.part_id = p.part_id{_STEPS})
SELECT part_id, CASE WHEN defect IS NULL THEN chain END AS ancestors, defect FROM j""",
)
def v9_ancestors(spark: SparkSession, d: str) -> DataFrame:
    """Each part's five ancestors, or what is wrong with its evidence (V8, V9)."""
    parts, records = _of_lines(spark, d, _PARTS, _RECORDS)
    out = ancestry.part_evidence(parts, records, KINDS)
    return out.select("part_id", F.array_join("ancestors", ">").alias("ancestors"), "defect")


#: Lines of an order follow each other; in some orders the first follows the last, in others one's parent is gone.
_CHAIN = """SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_linenumber > 1 AND l_orderkey % 9 = 2 AND l_linenumber % 4 = 0 THEN l_orderkey * 10 + 9 WHEN l_linenumber > 1 THEN l_orderkey * 10 + l_linenumber - 1
WHEN l_orderkey % 5 = 1 THEN l_orderkey * 10 + max(l_linenumber) OVER (PARTITION BY l_orderkey) END AS parent FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem}) AS x"""


@query(
    "v8_chains",
    f"""WITH RECURSIVE c AS ({_plain(_CHAIN)}),
up AS (SELECT id, id AS place, 0 AS depth FROM c UNION ALL SELECT up.id, c.parent, depth + 1 FROM up JOIN c ON c.id = up.place WHERE c.parent IS NOT NULL AND depth < 10),
ends AS (SELECT id, arg_max(place, depth) AS place, max(depth) AS depth FROM up GROUP BY id)
SELECT e.id, CASE WHEN depth < 10 AND c.id IS NOT NULL THEN place END AS root, CASE WHEN depth >= 10 THEN 'cycle' WHEN c.id IS NULL THEN 'missing_parent' END AS defect FROM ends e LEFT JOIN c ON c.id = e.place""",
)
def v8_chains(spark: SparkSession, d: str) -> DataFrame:
    """The root of each record's chain, chains that go round, and those that end nowhere (V8)."""
    return ancestry.resolve_chains(_made(spark, d, _CHAIN), "id", "parent").select("id", "root", "defect")


_LINE_SQL = "sha256(strlen(k) || ':' || k || strlen(t) || ':' || t || strlen(a) || ':' || a || strlen(s) || ':' || s)"


@query(
    "v10_full_run",
    f"""WITH {_ctes(off=3)}, h AS (SELECT artifact_id, accepted, record_type, {_LINE_SQL} AS l FROM (SELECT *, CAST(coalesce(part_id, 0) AS VARCHAR) AS k, record_type AS t, CAST(accepted AS VARCHAR) AS a, coalesce(record_sha256, '') AS s FROM records)),
per AS (SELECT artifact_id, count(*) AS parsed, count(*) FILTER (accepted) AS accepted, count(*) FILTER (starts_with(record_type, 'quarantine')) AS skipped, sum(CAST('0x' || substr(l, 1, 15) AS HUGEINT)) AS sum0, sum(CAST('0x' || substr(l, 16, 15) AS HUGEINT)) AS sum1 FROM h GROUP BY 1),
lines AS (SELECT a.artifact_id, coalesce(parsed, 0) AS parsed, coalesce(accepted, 0) AS accepted, coalesce(skipped, 0) AS skipped, coalesce(sum0, 0) AS sum0, coalesce(sum1, 0) AS sum1, a.parsed_record_count = coalesce(parsed, 0) AND a.accepted_record_count = coalesce(accepted, 0) AND a.skipped_record_count = coalesce(skipped, 0) AS ok FROM artifacts a LEFT JOIN per USING (artifact_id)),
texts AS (SELECT artifact_id, unnest([CAST(artifact_id AS VARCHAR), CAST(parsed AS VARCHAR), CAST(accepted AS VARCHAR), CAST(skipped AS VARCHAR), CAST(sum0 AS VARCHAR), CAST(sum1 AS VARCHAR)]) AS x, unnest([1, 2, 3, 4, 5, 6]) AS i FROM lines),
dl AS (SELECT sha256(string_agg(strlen(x) || ':' || x, '' ORDER BY i)) AS h FROM texts GROUP BY artifact_id),
ds AS (SELECT count(*) AS n, sum(CAST('0x' || substr(h, 1, 15) AS HUGEINT)) AS a, sum(CAST('0x' || substr(h, 16, 15) AS HUGEINT)) AS b, sum(CAST('0x' || substr(h, 31, 15) AS HUGEINT)) AS c, sum(CAST('0x' || substr(h, 46, 15) AS HUGEINT)) AS e FROM dl),
snap AS (SELECT part_id + CASE WHEN part_id % 41 = 1 THEN 5 ELSE 0 END AS part_id, CASE WHEN part_id % 37 = 1 THEN 'x' ELSE evidence_record_sha256 END AS sha FROM parts),
pp AS (SELECT part_id, count(*) AS n, min(sha) AS sha FROM snap GROUP BY 1), rr AS (SELECT part_id, count(*) AS n, min(record_sha256) AS sha FROM records WHERE accepted AND record_type = 'part' GROUP BY 1),
d AS (SELECT CASE WHEN rr.n IS NULL THEN 'missing_record' WHEN pp.n IS NULL THEN 'missing_part' WHEN pp.n > 1 OR rr.n > 1 THEN 'repeated' WHEN pp.sha IS DISTINCT FROM rr.sha THEN 'digest' END AS defect FROM pp FULL JOIN rr USING (part_id))
SELECT (SELECT count(*) FROM lines) AS artifact_count, (SELECT CAST(sum(parsed) AS BIGINT) FROM lines) AS record_count, (SELECT CAST(sum(accepted) AS BIGINT) FROM lines) AS accepted_count, (SELECT count(*) FILTER (NOT ok) FROM lines) AS artifacts_off, (SELECT count(*) FROM d) AS part_count,
  (SELECT count(*) FILTER (defect = 'missing_record') FROM d) AS missing_record, (SELECT count(*) FILTER (defect = 'missing_part') FROM d) AS missing_part, (SELECT count(*) FILTER (defect = 'repeated') FROM d) AS repeated, (SELECT count(*) FILTER (defect = 'digest') FROM d) AS digest,
  (SELECT sha256(n || ':' || a || ':' || b || ':' || c || ':' || e) FROM ds) AS manifest_sha256""",
)
def v10(spark: SparkSession, d: str) -> DataFrame:
    """A full run verified by merges of bucketed tables."""
    t = _tables(spark, d, off=3)
    rows = t["records"].withColumns({"k": F.coalesce("part_id", F.lit(0)).cast("string"), "a": F.col("accepted").cast("string")})
    parts = t["parts"].select((F.col("part_id") + F.when(F.col("part_id") % 41 == 1, 5).otherwise(0)).alias("part_id"), F.when(F.col("part_id") % 37 == 1, "x").otherwise(F.col("evidence_record_sha256")).alias("evidence_record_sha256"))
    return fullrun.verify_full_run(t["artifacts"], rows, parts, ["k", "record_type", "a", "record_sha256"], buckets=8)
