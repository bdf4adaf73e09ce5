"""Queries on tables with what the smallest fixtures lack: receipts at one position, references without a semicolon."""

import duckdb
import pytest
from pyspark.sql import functions as F

from cogwright import plans


def _against_sql(spark, folder, name, tables):
    c = duckdb.connect()
    for t, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    df = plans.queries()[name](spark, str(folder))
    got = sorted(map(repr, (tuple(r) for r in df.collect())))
    assert got == sorted(map(repr, c.execute(f"select {', '.join(df.columns)} from ({plans.oracle_sql()[name]})").fetchall()))
    return df


def test_receipts_at_one_position(spark, sf_dir, tmp_path):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    tables = {"orders": spark.read.parquet(f"{sf_dir}/orders.parquet"), "lineitem": lines.withColumn("l_linenumber", F.lit(1)).orderBy(F.rand(7))}
    _against_sql(spark, tmp_path, "m12_receipts", tables)


@pytest.mark.parametrize("end", ["&amp", "&lt", "&quot", "&#x27", "&amp;"])
def test_references_without_semicolon(spark, tmp_path, end):
    pages = spark.createDataFrame([(1, f"<html><title>a &amp; b{end}</title><h1>c {end}</h1></html>")], "page_id long, html string")
    df = _against_sql(spark, tmp_path, "p8_page_structure", {"pages": pages})
    assert df.first()["title"] == "a & b" + {"&lt": "<", "&quot": '"', "&#x27": "'"}.get(end, "&")
