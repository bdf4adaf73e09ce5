"""Verification of a full run as merges of tables that are stored by one key: no run is held by one task, and no join shuffles."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.records import length_prefixed
from .gates import dataset_digest
from .scratch import scratch_path

#: Of each artifact's line in the manifest, beside its own columns.
COUNTS = ("parsed", "accepted", "skipped")


def stored_by(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """df as a table bucketed and sorted by `key`, so that what is joined or grouped by it later is only merged."""
    table = f"{name}_{uuid.uuid4().hex}"
    # One task writes one bucket: a bucket is one sorted file.
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", scratch_path(df.sparkSession, table)).saveAsTable(table)
    return df.sparkSession.table(table)


def _sums(columns: Sequence[str]) -> list:
    """Two sums of line hashes: they tell sets of records apart whatever their order, and combine like any sum."""
    line = F.sha2(length_prefixed(columns), 256)
    return [F.sum(F.conv(F.substring(line, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).alias(f"sum{i}") for i in range(2)]


def artifact_lines(artifacts: DataFrame, records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """artifacts (artifact_id, ...) with the counts and the sums of their records, and whether they are as declared.

    Both are stored_by artifact_id. artifacts have parsed_record_count, accepted_record_count and skipped_record_count; an artifact
    without records has a line too. records: artifact_id, record_type, accepted and the columns that are summed.
    """
    skipped = F.col("record_type").startswith("quarantine")
    per = records.groupBy("artifact_id").agg(F.count("*").alias("parsed"), F.count_if("accepted").alias("accepted"), F.count_if(skipped).alias("skipped"), *_sums(columns))
    j = artifacts.join(per, "artifact_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in (*COUNTS, "sum0", "sum1")})
    ok = (F.col("parsed") == F.col("parsed_record_count")) & (F.col("accepted") == F.col("accepted_record_count")) & (F.col("skipped") == F.col("skipped_record_count"))
    return j.withColumn("as_declared", F.coalesce(ok, F.lit(False)))


def part_lines(parts: DataFrame, accepted: DataFrame) -> DataFrame:
    """(part_id, defect) of all parts and accepted records, stored_by part_id both: missing_record, missing_part, repeated, digest or null."""
    p = parts.groupBy("part_id").agg(F.count("*").alias("_p"), F.min("evidence_record_sha256").alias("_a"))
    r = accepted.groupBy("part_id").agg(F.count("*").alias("_r"), F.min("record_sha256").alias("_b"))
    j = p.join(r, "part_id", "full_outer")
    defect = F.when(F.col("_r").isNull(), "missing_record").when(F.col("_p").isNull(), "missing_part").when((F.col("_p") > 1) | (F.col("_r") > 1), "repeated").when(~F.col("_a").eqNullSafe(F.col("_b")), "digest")
    return j.select("part_id", defect.alias("defect"))


def verify_full_run(artifacts: DataFrame, records: DataFrame, parts: DataFrame, columns: Sequence[str], buckets: int = 200) -> DataFrame:
    """One row: counts, what is wrong, and the digest of the manifest of a run's artifacts.

    artifacts, records and parts are of one run. Rows go to their buckets once; all that follows is merged bucket by
    bucket, and only counts and sums leave a task. The manifest has a line for each artifact: its id, counts and sums of records.
    """
    a, r = stored_by(artifacts, "artifact_id", buckets, "run_artifacts"), stored_by(records, "artifact_id", buckets, "run_records")
    taken = records.filter(F.col("accepted") & (F.col("record_type") == "part"))
    p, t = stored_by(parts.select("part_id", "evidence_record_sha256"), "part_id", buckets, "run_parts"), stored_by(taken.select("part_id", "record_sha256"), "part_id", buckets, "run_accepted")
    lines = artifact_lines(a, r, columns)
    totals = lines.agg(F.count("*").alias("artifact_count"), F.sum("parsed").alias("record_count"), F.sum("accepted").alias("accepted_count"), F.count_if(~F.col("as_declared")).alias("artifacts_off"))
    wrong = part_lines(p, t).agg(F.count("*").alias("part_count"), *(F.count_if(F.col("defect") == x).alias(x) for x in ("missing_record", "missing_part", "repeated", "digest")))
    digest = dataset_digest(lines, ["artifact_id", *COUNTS, "sum0", "sum1"]).select(F.col("digest").alias("manifest_sha256"))
    return totals.crossJoin(wrong).crossJoin(digest)
