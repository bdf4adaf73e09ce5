"""What the registered queries read: the fixture tables, re-shaped as a parts catalog."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: Repeated rows are taken together by tasks of about this many rows.
ROWS_PER_TASK = 100_000


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where there is any."""

    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows by their keys, of repeated ones each column's least.

    They are counted first (from the footers, if df reads files) and dealt over as many tasks as they need, before they are sorted:
    the least of texts takes a sort, whose memory would grow with the table where the number of tasks is fixed.
    """
    tasks = max(1, -(-df.count() // ROWS_PER_TASK))
    return df.select(*keys, *columns).repartition(tasks, *keys).groupBy(*keys).agg(*(F.min(c).alias(c) for c in columns))


def flat_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Region, nation, supplier, line and part as brand, model, vehicle, group and part: one wide row a line.

    The upper levels have fixed sizes (5 and 25 rows) or are small beside the lines; joins are plain equi joins, and
    the planner broadcasts what is small.
    """
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    suppliers = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", text.part_key(F.concat_ws("-", "p_brand", "p_partkey")).alias("part_number"))
    wide = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return wide.select(
        F.col("r_name").alias("brand"), F.col("n_name").alias("model"), F.col("s_suppkey").alias("vehicle_id"), F.col("s_name").alias("vehicle"), F.col("l_returnflag").alias("group_code"),
        F.col("p_partkey").alias("part_id"), F.col("p_name").alias("part_name"), "part_number", F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.date_format("l_shipdate", "yyyy-MM").alias("month"),
    )


#: The same as a common table expression named `flat`.
FLAT_SQL = """flat AS (
  SELECT r_name AS brand, n_name AS model, s_suppkey AS vehicle_id, s_name AS vehicle, l_returnflag AS group_code, p_partkey AS part_id, p_name AS part_name,
         upper(regexp_replace(p_brand || '-' || p_partkey, '[\\s-]+', '', 'g')) AS part_number, l_orderkey AS order_id, l_linenumber AS line, strftime(l_shipdate, '%Y-%m') AS month
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""
