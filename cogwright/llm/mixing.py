"""Mixing sources to target weights by systematic sampling, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import key_or_null, key_or_sentinel, range_cuts, range_of, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
#: Ranges of doc_id, by quantiles, within which documents of one source and size are ranked; their counts are summed first.
RANGES = 256


def word_count(text: str = "text") -> Column:
    """The number of words: runs other than space, tab, LF, VT, FF, CR."""
    return F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _source_key(source: str) -> Column:
    """Sorts as the sources do by code point, null last, and is never null."""
    return F.when(F.col(source).isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), F.col(source)))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(_key, source_size, target) of each source, from rows of (_key, _size).

    The sources by code point (null last) weigh `weights`, repeating, and share the sum of all sizes; no target
    exceeds `cap` times its source's size, and the excess goes to the others by weight. Filling them in the order of
    cap over weight gives the level at which that ends. One row a source: this is the only step in one task.
    """
    per = sizes.groupBy("_key").agg(F.sum("_size").alias("source_size"))
    place = F.row_number().over(Window.orderBy("_key")) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * cap)
    per = per.withColumn("_level", F.col("_cap") / F.col("_weight"))
    before = Window.orderBy("_level", "_key").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_level", "_key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    share = F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    per = per.withColumn("_fill", left / share)
    per = per.withColumn("_end", F.max(F.when(F.col("_fill") <= F.col("_level"), F.col("_fill"))).over(whole))
    target = F.least(F.col("_cap").cast("double"), F.col("_end") * F.col("_weight"))
    return per.select("_key", "source_size", target.alias("target"))


def with_copies(docs: DataFrame, sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP, seed: int = 0) -> DataFrame:
    """docs with _size, source_size, target and _copies: how often the mix takes each document.

    docs: rows with _key, _id, _size, _tie and others, read anew from a stable table; sizes: the first three alone. Within
    its source a document's expected copies are target / source_size. They are summed in the order of (size, doc_id, _tie),
    a random offset of the source is added, and a document is taken once for each whole number that is crossed. As
    the order is by size, a source's words differ from its target by little more than its longest document has.
    The sums go by ranges: counts of (source, size, range of ids) are summed, and rows are ranked within them alone.
    """
    part = range_of(F.col("_id"), range_cuts(sizes, "_id", RANGES))
    counts = sizes.withColumn("_part", part).groupBy("_key", "_size", "_part").agg(F.count("*").alias("_n"))
    of_size = counts.groupBy("_key", "_size").agg(F.sum("_n").alias("_n"))
    earlier_sizes = F.coalesce(F.sum("_n").over(Window.partitionBy("_key").orderBy("_size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    earlier_parts = F.coalesce(F.sum("_n").over(Window.partitionBy("_key", "_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("_key", "_size", "_part", earlier_parts.alias("_in_size")).join(of_size.select("_key", "_size", earlier_sizes.alias("_before")), ["_key", "_size"])
    starts = starts.join(F.broadcast(source_targets(sizes, weights, cap)) if _few_sources(sizes) else source_targets(sizes, weights, cap), "_key")
    inside = Window.partitionBy("_key", "_size", "_part").orderBy("_id", "_tie")
    ranked = docs.withColumn("_part", part).withColumn("_place", F.row_number().over(inside)).join(starts, ["_key", "_size", "_part"])
    rank = (F.col("_before") + F.col("_in_size") + F.col("_place")).cast("double")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("_key"))), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    copies = F.floor(rate * rank + offset) - F.floor(rate * (rank - 1) + offset)
    return ranked.withColumn("_copies", copies.cast("long")).drop("_part", "_place", "_before", "_in_size", "_tie")


def _few_sources(sizes: DataFrame) -> bool:
    """Whether the table of sources is small enough to send to all executors: at most 10,000 rows of some 50 bytes."""
    return len(sizes.select("_key").distinct().limit(10_001).collect()) <= 10_000


def keyed(docs: DataFrame) -> DataFrame:
    """(_row, _key, _id, _size, _tie): each row as a struct, so that its columns clash with none here; _tie is a hash of the text."""
    return docs.select(F.struct("*").alias("_row"), _source_key("source").alias("_key"), key_or_sentinel("doc_id").alias("_id"), word_count("text").alias("_size"), F.xxhash64(text_or_empty()).alias("_tie"))


def mix_report(thin: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken for rows of (_key, _id, _size, _tie), one each; see mix_documents."""
    out = with_copies(thin, thin.select("_key", "_id", "_size"), weights, cap, seed)
    return out.select(key_or_null("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", (F.col("_copies") * F.col("_size")).alias("taken"))


def mix_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP, seed: int = 0) -> DataFrame:
    """The rows of docs, each as often as the mix takes it (0 to `cap` times), with its own columns only.

    docs needs doc_id, text and source and must read the same each time. A null text has no words; a null source is a
    source of its own, after all others; a null doc_id sorts first. Rows that repeat a doc_id count each on its own, in
    the order of a hash of their texts where source and size are equal too; rows with the same text stand for each
    other. If no document has words, nothing is taken; an empty table gives no rows. Reruns agree.
    """
    rows = keyed(docs)
    taken = with_copies(rows, rows.select("_key", "_id", "_size"), weights, cap, seed).filter("_copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")


#: DuckDB SQL for mix_report over `documents` with the parameters above.
REPORT_SQL = """
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
per AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY k),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY k) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
         source_size * 3 AS cap FROM per),
levels AS (SELECT *, cap / w AS level FROM weighed),
fills AS (
  SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) - coalesce(CAST(sum(cap) OVER b AS BIGINT), 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS fill
  FROM levels WINDOW b AS (ORDER BY level, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ends AS (SELECT *, max(CASE WHEN fill <= level THEN fill END) OVER () AS stop FROM fills),
targets AS (SELECT k, source_size, least(CAST(cap AS DOUBLE), stop * w) AS target FROM ends),
ranked AS (
  SELECT doc_id, size, source_size, target,
         CAST(row_number() OVER (PARTITION BY k ORDER BY size, doc_id) AS DOUBLE) AS r,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         CAST(CAST('0x' || substr(md5('0:' || k), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE AS u
  FROM sized JOIN targets USING (k))
SELECT doc_id, size, source_size, target,
       CAST(floor(rate * r + u) - floor(rate * (r - 1) + u) AS BIGINT) * size AS taken
FROM ranked
"""
