"""Snapshots: written to a path of their own, checked, and made current by a pointer; never changed in place."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .gates import GateError, check, dataset_digest, require_empty

_POINTER = "run_id long, rows long, digest string, previous long, path string, at timestamp"


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    """All that was ever published; no rows if nothing was."""
    try:
        return spark.read.schema(_POINTER).parquet(f"{root}/pointer")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], _POINTER)
        raise


def _latest(spark: SparkSession, root: str):
    return (_pointers(spark, root).orderBy(F.desc("at"), F.desc("run_id")).limit(1).collect() or [None])[0]


def publish(snapshot: DataFrame, root: str, run_id: int, rules: Mapping[str, Column], key: str, expected_rows: int | None = None, retain: bool = True) -> int:
    """Check, write, recount and point to a run's snapshot; returns its rows. A failed gate leaves all as it was.

    Each attempt has a path of its own, which nothing reads before the pointer names it, so a run that failed can be
    tried again. A run that is published already is never changed: the same rows again are no error, other rows are.
    The pointer keeps the run before, if it is to be retained.
    """
    spark = snapshot.sparkSession
    require_empty(check(snapshot, rules, key))
    path = f"{root}/run-{run_id}-{uuid.uuid4().hex}"
    snapshot.write.parquet(path)
    written = spark.read.schema(snapshot.schema).parquet(path)
    found = dataset_digest(written, sorted(written.columns)).first()
    if expected_rows is not None and found["n_rows"] != expected_rows:
        raise GateError(f"rows: {found['n_rows']} written, {expected_rows} expected")
    before = _pointers(spark, root).filter(F.col("run_id") == run_id).limit(1).collect()
    if before:
        if before[0]["digest"] != found["digest"]:
            raise GateError(f"run {run_id} is published with other rows")
        return found["n_rows"]
    last = _latest(spark, root)
    row = (run_id, found["n_rows"], found["digest"], last["run_id"] if last and retain else None, path)
    spark.createDataFrame([row], "run_id long, rows long, digest string, previous long, path string").withColumn("at", F.current_timestamp()).write.mode("append").parquet(f"{root}/pointer")
    return found["n_rows"]


def current_run(spark: SparkSession, root: str) -> int | None:
    row = _latest(spark, root)
    return row["run_id"] if row else None


def current(spark: SparkSession, root: str, schema: str, run_id: int | None = None) -> DataFrame:
    """The current snapshot, or that of a run that is kept; no rows if there is none."""
    rows = [_latest(spark, root)] if run_id is None else _pointers(spark, root).filter(F.col("run_id") == run_id).limit(1).collect()
    return spark.read.schema(schema).parquet(rows[0]["path"]) if rows and rows[0] else spark.createDataFrame([], schema)


def publish_full(snapshot: DataFrame, root: str, run_id: int, rules: Mapping[str, Column], key: str, candidates: int, qualified: bool) -> int:
    """A whole archive: the join of the levels must have as many rows as there are candidates, each key once, of this run alone.

    The run before is kept only if it is qualified, which means that it is of a single run that ended well.
    """
    shape = snapshot.agg(F.count("*").alias("n"), F.countDistinct(key).alias("keys"), F.min("run_id").alias("lo"), F.max("run_id").alias("hi"), F.count("run_id").alias("known")).first()
    if shape["n"] != candidates or shape["keys"] != shape["n"]:
        raise GateError(f"identity: {shape['n']} rows with {shape['keys']} keys for {candidates} candidates")
    if shape["n"] and (shape["known"] != shape["n"] or (shape["lo"], shape["hi"]) != (run_id, run_id)):
        raise GateError("rows of other runs")
    return publish(snapshot, root, run_id, rules, key, expected_rows=candidates, retain=qualified)


def in_scope(df: DataFrame, brand: str, model: str, year_floor: int) -> DataFrame:
    """Rows of a brand and model (trimmed, in lower case) whose production ended in the floor's year or later, or at a time unknown."""
    same = (F.lower(F.trim("brand")) == brand.strip().lower()) & (F.lower(F.trim("model")) == model.strip().lower())
    end = F.substring("production_to", 1, 4).try_cast("int")
    return df.filter(same & (end.isNull() | (end >= year_floor)))


def publish_bounded(snapshot: DataFrame, root: str, run_id: int, rules: Mapping[str, Column], key: str, target: int, scope: tuple[str, str, int], desired: tuple[str, str, int]) -> int:
    """A bounded set: exactly `target` rows, all within the scope, which must be the desired one to the letter."""
    if scope != desired:
        raise GateError(f"scope {scope} is not the desired {desired}")
    n, inside = snapshot.count(), in_scope(snapshot, *scope).count()
    if n != target or inside != n:
        raise GateError(f"scope: {inside} of {n} rows inside, {target} wanted")
    return publish(snapshot, root, run_id, rules, key, expected_rows=target)


def artifact_status(rejects: Column) -> Column:
    """What becomes of a file by its rejects."""
    return F.when(rejects > 0, "quarantined").otherwise("imported")


def reuse(incoming: DataFrame, known: DataFrame) -> DataFrame:
    """incoming with `action`: reuse what the same parser imported from the same content, refuse what it quarantined, import the rest."""
    key = ["dataset_name", "source_key", "sha256", "parser_version"]
    had = known.groupBy(*key).agg(F.max_by("status", "artifact_id").alias("_status"), F.max("artifact_id").alias("known_id"))
    j = incoming.join(had, key, "left")
    action = F.when(F.col("_status") == "imported", "reuse").when(F.col("_status") == "quarantined", "refuse").otherwise("import")
    return j.select(*incoming.columns, action.alias("action"), F.when(action == "reuse", F.col("known_id")).alias("known_id"))


def schema_drift(members: DataFrame, current_members: DataFrame) -> DataFrame:
    """(dataset_name, source_key, was, now): sources whose field list is another than the current one's; new sources are none."""
    key = ["dataset_name", "source_key"]
    j = members.join(current_members.select(*key, F.col("schema_sha256").alias("was")), key)
    return j.filter("was <> schema_sha256").select(*key, "was", F.col("schema_sha256").alias("now"))


def malformed_gate(counts: DataFrame, ratio: float = 0.1) -> DataFrame:
    """(kind, records, malformed, allowed): kinds with more malformed rows than the ratio of their records allows."""
    allowed = F.floor(F.col("records") * F.lit(ratio))
    return counts.withColumn("allowed", allowed).filter("malformed > allowed")
