"""Ordered pages and searches: one scan with a bounded top, never a collected table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import range_cuts, range_of


def page(df: DataFrame, order: Sequence[Column | str], number: int, size: int) -> tuple[DataFrame, DataFrame]:
    """(items, meta): a page's rows, the page number being kept within what there is, and one row (total, pages, page)."""
    total = df.count()
    pages = max(1, -(-total // size))
    number = min(max(1, number), pages)
    items = df.orderBy(*order).offset((number - 1) * size).limit(size)
    meta = df.sparkSession.range(1).select(F.lit(total).alias("total"), F.lit(pages).alias("pages"), F.lit(number).alias("page"))
    return items, meta


def keyset_page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """The next rows after a key: the filter reaches the scan, and only `size` rows are sorted out."""
    return (df if after is None else df.filter(F.col(key) > F.lit(after))).orderBy(key).limit(size)


def truncated(df: DataFrame, order: Sequence[Column | str], size: int) -> DataFrame:
    """The first `size` rows with a flag that tells whether there were more; fetches one row beyond."""
    more = df.orderBy(*order).limit(size + 1)
    n = more.agg((F.count("*") > size).alias("truncated"))
    return more.orderBy(*order).limit(size).join(F.broadcast(n), F.lit(True))


def search(df: DataFrame, query: str, prefix: Sequence[str] = (), contains: Sequence[str] = ()) -> DataFrame:
    """Rows of which a field starts with, or contains, the query; an empty query finds all."""
    if not query:
        return df
    found = F.lit(False)
    for c in prefix:
        found = found | F.coalesce(F.col(c).startswith(query), F.lit(False))
    for c in contains:
        found = found | F.coalesce(F.col(c).contains(query), F.lit(False))
    return df.filter(found)


def running_sum(df: DataFrame, order: str, value: str, name: str, ranges: int = 64) -> DataFrame:
    """df with the sum of `value` up to and with each row, in the order of a unique column.

    Rows go by ranges of about equal size (approximate quantiles of the order); the ranges before are one sum each.
    """
    rows = df.withColumn("_part", range_of(F.col(order), range_cuts(df, order, ranges)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # at most `ranges` rows
    sums = rows.groupBy("_part").agg(F.sum(value).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(F.broadcast(sums), "_part").withColumn(name, F.col("_before") + F.sum(value).over(inside)).drop("_part", "_before")
