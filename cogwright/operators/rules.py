"""Rules that a candidate snapshot, or a run that claims to be complete, must meet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ranges_overlap
from ..functions.text import is_blank, part_key
from ..functions.urls import canonical_unit_url

#: Fields of a snapshot row that must not be blank.
REQUIRED = ("part_number", "part_name", "code", "brand", "model", "vehicle_name", "vehicle_code", "vehicle_vid", "category_cid", "category_name", "group_name", "group_code", "group_uid", "source_url")
#: Parent ids that must be there, from the group up to the brand.
PARENTS = ("group_id", "category_id", "vehicle_id", "model_id", "brand_id")


def snapshot_rules(url_grammar: str) -> dict[str, Column]:
    """What is wrong with a candidate row, by rule: a parent is missing, a field is blank, the URL is not the unit's own, no month is known, or months don't overlap."""
    months = [F.col(c) for c in ("production_from", "production_to", "part_from", "part_to")]
    out = {f"{c}_missing": F.col(c).isNull() for c in PARENTS}
    out |= {f"{c}_blank": is_blank(c) for c in REQUIRED}
    out["part_number_empty"] = ~is_blank("part_number") & (F.coalesce(part_key("part_number"), F.lit("")) == "")
    out["url_not_canonical"] = ~is_blank("source_url") & ~F.coalesce(canonical_unit_url("source_url", F.col("group_uid"), url_grammar), F.lit(False))
    out["no_month"] = reduce(lambda a, b: a & b, [m.isNull() for m in months])
    out["months_apart"] = ~ranges_overlap(*months)
    return out


def is_bad(rules: dict[str, Column]) -> Column:
    """Whether a row breaks any of the rules."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in rules.values()])


def released(df: DataFrame, rules: dict[str, Column], marker: str) -> DataFrame:
    """df with the run marker taken from rows that break a rule (they leave the run and stay in the table)."""
    return df.withColumn(marker, F.when(~is_bad(rules), F.col(marker)))


def completion_checks(queue: DataFrame, responses: DataFrame, records: DataFrame, sources: DataFrame, broken_keys: DataFrame) -> DataFrame:
    """One row of seven checks of a run, and strict_complete, which is all of them.

    queue: status; responses: challenged; records and sources: record_type, record_id; broken_keys: rows of foreign keys
    that point nowhere.
    """
    of = lambda s: F.count_if(F.col("status") == s)
    q = queue.agg(*(of(s).alias(s) for s in ("pending", "in_progress", "failed", "challenged", "skipped_robots", "parse_failed")))
    r = responses.agg(F.count_if("challenged").alias("_challenged"))
    without = records.select("record_type", "record_id").join(sources.select("record_type", "record_id").distinct(), ["record_type", "record_id"], "left_anti").agg(F.count("*").alias("_without"))
    broken = broken_keys.agg(F.count("*").alias("_broken"))
    one = q.crossJoin(F.broadcast(r)).crossJoin(F.broadcast(without)).crossJoin(F.broadcast(broken))  # one row each
    checks = {
        "queue_exhausted": (F.col("pending") == 0) & (F.col("in_progress") == 0), "no_failed_pages": F.col("failed") == 0, "no_challenges": (F.col("challenged") == 0) & (F.col("_challenged") == 0),
        "no_robots_skips": F.col("skipped_robots") == 0, "no_parse_failures": F.col("parse_failed") == 0, "provenance_complete": F.col("_without") == 0, "foreign_keys_valid": F.col("_broken") == 0,
    }
    return one.select(*(c.alias(k) for k, c in checks.items()), reduce(lambda a, b: a & b, checks.values()).alias("strict_complete"))
