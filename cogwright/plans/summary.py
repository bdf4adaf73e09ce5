"""Counters of three datasets, kept by artifact while artifacts come, are replaced and go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import summaries
from ..operators.scratch import written
from .base import query, table

#: Counters as conditions that both engines read alike.
COUNTERS = {
    "blank_number": "trim(part_number) = ''", "blank_name": "trim(part_name) = ''", "short_name": "length(part_name) < 12", "long_name": "length(part_name) > 30", "no_month": "month IS NULL", "early_month": "month < '1993-01'", "late_month": "month > '1997-12'",
    "group_r": "group_code = 'R'", "group_a": "group_code = 'A'", "group_n": "group_code = 'N'", "odd_part": "part_id % 2 = 1", "orphan_part": "part_id % 50 = 7", "no_vehicle": "vehicle_id IS NULL", "name_mismatch": "part_name <> lower(part_name)", "number_mismatch": "part_number NOT LIKE 'BRAND%'",
    "many": "quantity >= 40", "few": "quantity < 5", "line_one": "line = 1", "high_line": "line > 5", "unlinked": "order_id % 9 = 4",
}
_ROWS = """SELECT s_suppkey AS vehicle_id, l_returnflag AS group_code, p_partkey AS part_id, p_name AS part_name, CASE WHEN p_partkey % 40 = 1 THEN ' ' ELSE upper(p_brand) || p_partkey END AS part_number, l_orderkey AS order_id, l_linenumber AS line, l_quantity + {bump} AS quantity,
  CASE WHEN l_orderkey % 12 > 0 THEN substr(CAST(l_shipdate AS STRING), 1, 7) END AS month FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {part} ON l_partkey = p_partkey"""
_FORMS = "SELECT 'full' AS dataset, vehicle_id AS artifact, x.* FROM ({rows}) AS x UNION ALL SELECT 'bounded', vehicle_id, y.* FROM ({rows}) AS y WHERE group_code = 'R' UNION ALL SELECT 'sample', vehicle_id, z.* FROM ({rows}) AS z WHERE part_id % 10 = 3"
#: What the datasets are in the end: artifacts of the one kind were replaced by rows with greater quantities, those of the other are gone.
_END = "SELECT * FROM ({old}) AS o WHERE artifact % 4 <> 1 AND artifact % 11 <> 3 UNION ALL SELECT * FROM ({new}) AS n WHERE artifact % 4 = 1 AND artifact % 11 <> 3"


def _text(bump: int) -> str:
    return _FORMS.replace("{rows}", _ROWS.replace("{bump}", str(bump)))


def _plain(text: str) -> str:
    for t in ("lineitem", "supplier", "part"):
        text = text.replace("{" + t + "}", t)
    return text


def _sums(spark: SparkSession, d: str, bump: int) -> DataFrame:
    rows = spark.sql(_text(bump), lineitem=table(spark, d, "lineitem"), supplier=table(spark, d, "supplier"), part=table(spark, d, "part"))
    return written(summaries.partial_sums(rows, {n: F.expr(c) for n, c in COUNTERS.items()}, ["month", "quantity"]), "partial-sums")


def _kept(spark: SparkSession, d: str) -> DataFrame:
    old, new = _sums(spark, d, 0), _sums(spark, d, 3)
    kept = summaries.put(old.filter("artifact % 2 = 0"), old.filter("artifact % 2 = 1"))  # two inserts
    kept = summaries.put(written(kept, "summaries"), new.filter("artifact % 4 = 1"))  # a replacement
    return summaries.withdraw(written(kept, "summaries"), new.filter("artifact % 11 = 3"))


_END_SQL = _plain(_END.replace("{old}", _text(0)).replace("{new}", _text(3)))
_COUNTED = ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in COUNTERS.items())


@query("a5_counters_kept", f"SELECT dataset, count(DISTINCT artifact) AS artifacts, count(*) AS n_rows, {_COUNTED}, min(month) AS min_month, max(month) AS max_month, min(quantity) AS min_quantity, max(quantity) AS max_quantity FROM ({_END_SQL}) AS e GROUP BY dataset")
def a5_kept(spark: SparkSession, d: str) -> DataFrame:
    """Twenty counters of three datasets after inserts, a replacement and a withdrawal, from partial sums."""
    return summaries.totals(_kept(spark, d))


_BLOCKING = {"numbers": ["blank_number", "number_mismatch"], "months": ["no_month"], "links": ["no_vehicle"]}


@query("e12_readiness", f"SELECT dataset, false AS ready, list_filter([CASE WHEN count(*) FILTER ({COUNTERS['blank_number']}) + count(*) FILTER ({COUNTERS['number_mismatch']}) > 0 THEN 'numbers' END, CASE WHEN count(*) FILTER (month IS NULL) > 0 THEN 'months' END, CASE WHEN count(*) FILTER (vehicle_id IS NULL) > 0 THEN 'links' END], lambda x: x IS NOT NULL).array_to_string(',') AS reasons FROM ({_END_SQL}) AS e GROUP BY dataset")
def e12_readiness(spark: SparkSession, d: str) -> DataFrame:
    """Whether each dataset is ready to be shown, and why not."""
    out = summaries.readiness(summaries.totals(_kept(spark, d)), _BLOCKING)
    return out.select("dataset", "ready", F.array_join("reasons", ",").alias("reasons"))
