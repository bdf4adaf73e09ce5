"""Manual edits over source rows: effective values, effective keys and what a list shows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.records import json_text
from ..functions.text import part_key


def effective(source: DataFrame, heads: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Source rows with each field replaced by the head's value where it has one; rows that a head retires are left out.

    heads: key, payload (JSON object), status.
    """
    h = heads.select(F.col(key), F.col("payload").alias("_payload"), F.col("status").alias("_status"))
    j = source.join(h, key, "left").filter(F.coalesce("_status", F.lit("active")) != "retired")
    out = [F.coalesce(json_text("_payload", c), F.col(c).cast("string")).alias(c) if c in fields else F.col(c) for c in source.columns]
    return j.select(*out, F.col("_payload").isNotNull().alias("overridden"))


def listing(source: DataFrame, heads: DataFrame, manual: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Plain source rows, overridden rows and manual rows as one list with their kind."""
    rows = effective(source, heads, key, fields)
    kinds = rows.withColumn("kind", F.when(F.col("overridden"), "overridden").otherwise("source")).drop("overridden")
    return kinds.unionByName(manual.select(*source.columns).withColumn("kind", F.lit("manual")))


def search_effective(source: DataFrame, heads: DataFrame, key: str, number: str, wanted: str) -> DataFrame:
    """Source rows whose effective number is the wanted one: the active head's where it has one, else the row's own.

    heads: key, override (a normalised number or null), status. `wanted` is normalised here.
    """
    h = heads.filter("status = 'active'").select(key, F.col("override").alias("_override"))
    return source.join(h, key, "left").filter(F.coalesce("_override", number) == part_key(F.lit(wanted))).drop("_override")


def entity_counts(source: DataFrame, manual: DataFrame, heads: DataFrame) -> DataFrame:
    """(entity, source, manual, overridden, retired): rows of each kind; heads: entity, status; the others: entity."""
    marked = source.select("entity", F.lit("source").alias("_k")).unionByName(manual.select("entity", F.lit("manual").alias("_k"))).unionByName(heads.select("entity", F.when(F.col("status") == "retired", "retired").otherwise("overridden").alias("_k")))
    return marked.groupBy("entity").agg(*(F.count_if(F.col("_k") == k).alias(k) for k in ("source", "manual", "overridden", "retired")))


def history(heads: DataFrame, events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """heads with their events as a list in the order of revisions."""
    listed = events.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("revision", "action", "request_id", "payload"))).alias("events"))
    return heads.join(listed, list(keys), "left")


CATEGORY = ("category_main", "category_group", "category_small")


def category_list(published: DataFrame, sampled: DataFrame, labels: DataFrame) -> DataFrame:
    """Categories with where each comes from, whether its third level has a source, and its label.

    published, sampled: category_main, category_group (null: none); labels: the three levels ('' where one is none), label; one row a category.
    A category of several origins has a row for each. Labels meet all three levels, a missing one as ''; a null first level has no label.
    """
    of = lambda df, status: df.select("category_main", F.coalesce("category_group", F.lit("")).alias("category_group"), F.lit(None).cast("string").alias("category_small"), F.lit(status).alias("dataset_status"))
    by_hand = labels.select("category_main", "category_group", F.nullif("category_small", F.lit("")).alias("category_small"), F.lit("manual_only").alias("dataset_status"))
    every = of(published, "verified_bounded").unionByName(of(sampled, "sample_not_published")).unionByName(by_hand).distinct()
    source = F.when(F.col("category_small").isNull(), "unavailable_in_current_hierarchy").otherwise("manual_only")
    every = every.withColumns({"small_source_status": source, "_small": F.coalesce("category_small", F.lit(""))})
    named = labels.select("category_main", "category_group", F.col("category_small").alias("_small"), "label")
    return every.join(named, ["category_main", "category_group", "_small"], "left").select("dataset_status", *CATEGORY, "small_source_status", "label")
