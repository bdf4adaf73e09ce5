"""Evidence behind a snapshot: which captures count, whether receipts, records and rows agree, and what may be shown."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import length_prefixed
from .gates import gated

#: Kinds of pages that a complete run has captures of.
PAGE_TYPES = 6
GRACE = "INTERVAL 5 MINUTES"
_DIGEST = "^[0-9a-f]{64}$"


def is_html_page(a: str = "") -> Column:
    """A verified answer that is a page, no challenge, and parsed without malformed rows."""
    c = lambda name: F.col(a + name)
    return (c("http_status") == 200) & ~c("challenge_detected") & F.lower(c("content_type")).startswith("text/html") & (c("malformed_row_count") == 0) & c("verified_at").isNotNull()


def live_captures(artifacts: DataFrame, runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """artifacts with `live`: fetched by the run's own completed job, or by an earlier failed one, within its time.

    artifacts: run_id, job_id, capture_kind, fetched_at and the columns of is_html_page; runs: run_id, run_job_id,
    run_started_at; jobs: job_id, job_name, trigger_mode, status, exit_code, started_at, finished_at.
    """
    j = artifacts.join(runs.select("run_id", "run_job_id", "run_started_at"), "run_id", "left").join(jobs.select("job_id", *(F.col(c).alias(f"_{c}") for c in ("job_name", "trigger_mode", "status", "exit_code", "started_at", "finished_at"))), "job_id", "left")
    own = F.col("job_id") == F.col("run_job_id")
    ended = F.when(own, (F.col("_status") == "completed") & (F.col("_exit_code") == 0)).otherwise((F.col("_status") == "failed") & (F.col("_exit_code") != 0))
    timely = (F.col("fetched_at") >= F.col("run_started_at")) & (F.col("fetched_at") >= F.col("_started_at")) & (F.col("fetched_at") <= F.col("_finished_at") + F.expr(GRACE))
    live = (F.col("capture_kind") == "live_http") & (F.col("_job_name") == "catalog") & (F.col("_trigger_mode") == "daemon") & timely & ended & is_html_page()
    return j.select(*artifacts.columns, F.coalesce(live, F.lit(False)).alias("live"))


def evidence_totals(artifacts: DataFrame, runs: DataFrame, jobs: DataFrame, bodies: DataFrame) -> DataFrame:
    """Of each run's verified captures: how many, how many live, page types, accepted records, and bytes as got and as stored."""
    j = live_captures(artifacts.filter("verification_status = 'verified'"), runs, jobs).join(bodies.select("body_sha256", "original_bytes", "stored_bytes"), "body_sha256")
    return j.groupBy("run_id").agg(
        F.count("*").alias("artifact_count"), F.count_if("live").alias("live_artifact_count"), F.countDistinct("page_type").alias("page_type_count"), F.sum("accepted_record_count").alias("accepted_record_count"),
        F.sum("original_bytes").alias("original_bytes"), F.sum("stored_bytes").alias("stored_bytes"),
    )


def record_totals(records: DataFrame, artifacts: DataFrame, snapshot: DataFrame) -> DataFrame:
    """(run_id, accepted_record_count, accepted_part_count): accepted part records of verified live captures that a snapshot row has with the same digest."""
    r = records.filter("accepted and record_type = 'part'")
    a = artifacts.filter("verification_status = 'verified' and capture_kind = 'live_http'").select("run_id", "artifact_id")
    s = snapshot.select("run_id", "part_id", F.col("evidence_record_sha256").alias("record_sha256"))
    j = r.join(a, ["run_id", "artifact_id"]).join(s, ["run_id", "part_id", "record_sha256"])
    return j.groupBy("run_id").agg(F.count("*").alias("accepted_record_count"), F.countDistinct("part_id").alias("accepted_part_count"))


def receipt_integrity(snapshot: DataFrame, receipts: DataFrame, artifacts: DataFrame, records: DataFrame) -> DataFrame:
    """(run_id, group_id, snapshot_part_count, is_verified): whether receipt, capture, records and snapshot of a group agree.

    receipts: run_id, group_id, source_artifact_id, status, parsed_part_count, accepted_part_count,
    skipped_record_count. Each input is counted before it is joined, so a group costs one row in the joins.
    """
    key = ["run_id", "group_id"]
    groups = snapshot.groupBy(*key).agg(F.count("*").alias("snapshot_part_count"))
    of = receipts.select(*key, F.col("source_artifact_id").alias("artifact_id"))
    part, kept = F.col("record_type") == "part", F.col("record_type").eqNullSafe("part") & F.col("accepted")
    named = records.join(of, ["run_id", "artifact_id"])
    counts = named.groupBy(*key).agg(
        F.count_if(part).alias("_parsed"), F.count_if(kept).alias("_accepted"), F.countDistinct(F.when(kept, F.col("part_id"))).alias("_parts"), F.count_if(F.col("record_type") == "quarantine_part").alias("_skipped"),
    )
    rows = snapshot.select(*key, "part_id", F.col("evidence_record_sha256").alias("record_sha256"))
    members = named.filter(kept).join(rows, [*key, "part_id", "record_sha256"]).groupBy(*key).agg(F.countDistinct("part_id").alias("_members"))
    a = artifacts.select("run_id", F.col("artifact_id").alias("source_artifact_id"), "capture_kind", "page_type", "parser_name", "verification_status", "http_status", "challenge_detected", "content_type", "malformed_row_count", "verified_at", F.col("parsed_record_count").alias("_a_parsed"), F.col("accepted_record_count").alias("_a_accepted"), F.col("skipped_record_count").alias("_a_skipped"))
    j = groups.join(receipts, key, "left").join(a, ["run_id", "source_artifact_id"], "left").join(counts, key, "left").join(members, key, "left")
    parsed, accepted, skipped = F.col("parsed_part_count"), F.col("accepted_part_count"), F.col("skipped_record_count")
    agree = [
        F.col("capture_kind") == "live_http", F.col("page_type") == "unit", F.col("parser_name") == "parse_parts", F.col("verification_status") == "verified", is_html_page(),
        F.col("_parsed") == parsed, F.col("_accepted") == accepted, F.col("_parts") == accepted, F.col("_skipped") == skipped, F.col("_a_parsed") == parsed + skipped, F.col("_a_accepted") == accepted,
        F.col("_a_skipped") == skipped, F.col("_members") == accepted, F.col("snapshot_part_count") == accepted,
        ((F.col("status") == "done") & (accepted == parsed)) | ((F.col("status") == "partial") & (accepted > 0) & (accepted < parsed)),
    ]
    return j.select(*key, "snapshot_part_count", F.coalesce(reduce(lambda x, y: x & y, agree), F.lit(False)).alias("is_verified"))


def receipt_totals(integrity: DataFrame) -> DataFrame:
    """Groups and parts of each run, and how many of both are verified."""
    n = F.col("snapshot_part_count")
    return integrity.groupBy("run_id").agg(F.count("*").alias("group_count"), F.sum(n).alias("part_count"), F.count_if("is_verified").alias("verified_group_count"), F.sum(F.when(F.col("is_verified"), n).otherwise(0)).alias("verified_part_count"))


def _finished(runs: DataFrame, jobs: DataFrame, kind: str, status: str) -> DataFrame:
    """Runs of a kind that ended well with verified evidence, by a job of their own that did, too."""
    good = (
        (F.col("dataset_kind") == kind) & (F.col("status") == status) & F.col("finished_at").isNotNull() & F.col("error_msg").isNull() & (F.col("evidence_status") == "verified") & F.col("evidence_verified_at").isNotNull()
        & F.col("evidence_manifest_sha256").rlike(_DIGEST) & F.col("evidence_dataset_sha256").rlike(_DIGEST)
    )
    ended = (F.col("job_name") == "catalog") & (F.col("trigger_mode") == "daemon") & (F.col("status") == "completed") & F.col("finished_at").isNotNull() & (F.col("exit_code") == 0)
    own = runs.groupBy("run_job_id").agg(F.count("*").alias("_runs")).filter("_runs = 1").select("run_job_id")
    return runs.filter(good).join(own, "run_job_id", "left_semi").join(jobs.filter(ended).select(F.col("job_id").alias("run_job_id")), "run_job_id", "left_semi")


def _single_run(snapshot: DataFrame) -> DataFrame:
    """The one run that all rows are of, with their number; no row if there are several, or rows without a run."""
    one = snapshot.agg(F.count("*").alias("row_count"), F.count("run_id").alias("with_run"), F.min("run_id").alias("run_id"), F.max("run_id").alias("last_run"))
    return one.filter("row_count > 0 and with_run = row_count and run_id = last_run").select("run_id", "row_count")


def full_ready(full: DataFrame, runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """One row (ok): whether the full snapshot is of a single run without a target that ended well."""
    good = _finished(runs, jobs, "full", "success").filter("target_parts is null")
    return _single_run(full).join(good.select("run_id"), "run_id", "left_semi").agg((F.count("*") > 0).alias("ok"))


def bounded_ready(bounded: DataFrame, runs: DataFrame, jobs: DataFrame, scope: DataFrame, artifacts: DataFrame, bodies: DataFrame, records: DataFrame, receipts: DataFrame, target: int) -> DataFrame:
    """One row (ok): whether evidence, records, receipts, scope and run of a bounded snapshot of `target` rows all agree.

    scope: the desired (scope_brand, scope_model, scope_vehicle_year_floor), compared byte by byte.
    """
    run = _finished(runs, jobs, "bounded", "bounded_success").filter((F.col("target_parts") == target) & (F.col("parts_ok") == target) & (F.col("evidence_record_count") == target) & (F.col("evidence_artifact_count") > 0) & (F.col("evidence_original_bytes") > 0) & (F.col("evidence_stored_bytes") > 0))
    run = run.join(_single_run(bounded).filter(F.col("row_count") == target).select("run_id"), "run_id", "left_semi").join(scope, ["scope_brand", "scope_model", "scope_vehicle_year_floor"], "left_semi")
    e, r, g = evidence_totals(artifacts, runs, jobs, bodies).alias("e"), record_totals(records, artifacts, bounded).alias("r"), receipt_totals(receipt_integrity(bounded, receipts, artifacts, records)).alias("g")
    j = run.alias("u").join(e, "run_id").join(r, "run_id").join(g, "run_id")
    agree = [
        F.col("e.artifact_count") == F.col("u.evidence_artifact_count"), F.col("e.live_artifact_count") == F.col("e.artifact_count"), F.col("e.page_type_count") == PAGE_TYPES, F.col("e.accepted_record_count") == target,
        F.col("e.original_bytes") == F.col("u.evidence_original_bytes"), F.col("e.stored_bytes") == F.col("u.evidence_stored_bytes"), F.col("r.accepted_record_count") == target, F.col("r.accepted_part_count") == target,
        F.col("g.part_count") == target, F.col("g.verified_group_count") == F.col("g.group_count"), F.col("g.verified_part_count") == F.col("g.part_count"),
    ]
    return j.filter(reduce(lambda x, y: x & y, agree)).agg((F.count("*") > 0).alias("ok"))


def current_catalog(bounded: DataFrame, full: DataFrame, runs: DataFrame, jobs: DataFrame, scope: DataFrame, artifacts: DataFrame, bodies: DataFrame, records: DataFrame, receipts: DataFrame, target: int) -> DataFrame:
    """The rows to show, with dataset_scope: the full snapshot if it is ready, else the bounded one if all of it agrees, else none.

    One plan: every gate is a frame of one row that is joined in.
    """
    whole = full_ready(full, runs, jobs)
    only = bounded_ready(bounded, runs, jobs, scope, artifacts, bodies, records, receipts, target).unionByName(whole.select((~F.col("ok")).alias("ok")))
    shown = lambda df, name: df.select(F.lit(name).alias("dataset_scope"), *(c for c in bounded.columns if c != "evidence_record_sha256"))
    return gated(shown(bounded, "bounded"), only).unionByName(gated(shown(full, "full"), whole))


def compatible(rows: DataFrame, hidden: Sequence[str] = ("dataset_scope", "run_id", "part_number_normalized", "snapshot_at")) -> DataFrame:
    """The current catalog for older readers: without the columns that came later."""
    return rows.drop(*hidden)


def manifest_digest(artifacts: DataFrame, order: Sequence[str], columns: Sequence[str], ranges: int = 64) -> DataFrame:
    """One row (n_rows, digest): a digest of rows in their order.

    Rows are sorted into ranges of the order; each range is a digest of its rows' digests, and the whole is the digest
    of the ranges' digests in order, with the number of rows of each. Ranges start where the hash of the first order
    column changes its leading bits, so the result does not depend on how many tasks there are.
    """
    bits = max(1, (ranges - 1).bit_length())
    line = F.sha2(length_prefixed(list(columns)), 256)
    rows = artifacts.select(F.conv(F.substring(F.sha2(F.coalesce(F.col(order[0]).cast("string"), F.lit("")), 256), 1, 8), 16, 10).cast("long").alias("_at"), F.struct(*order).alias("_order"), line.alias("_line"))
    rows = rows.withColumn("_range", F.shiftright("_at", 32 - bits))
    each = rows.groupBy("_range").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("_at", "_order", "_line"))).alias("s"))
    each = each.select("_range", "n", F.sha2(F.array_join(F.transform("s", lambda x: x["_line"]), ""), 256).alias("d"))
    parts = F.sort_array(F.collect_list(F.struct("_range", "n", "d")))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.sha2(F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x["n"].cast("string"), x["d"])), "\n"), 256).alias("digest"))


def restored_bodies(bodies: DataFrame, max_bytes: int = 8 * 1024 * 1024, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, body_sha256, size, error): stored bodies unpacked and held against their key and size.

    bodies: body_sha256, compression, body (binary), original_bytes. error is null for a sound body, else compression,
    too_large, broken, size or digest. No more than max_bytes of a body are unpacked.
    """

    def look(sha: str, compression: str, body: bytes | None, size: float | None) -> tuple[int | None, str | None]:
        if compression != "zlib":
            return None, "compression"
        if size is None or not 0 < size <= max_bytes:
            return None, "too_large" if size and size > max_bytes else "size"
        d = zlib.decompressobj()
        try:
            raw = d.decompress(body or b"", max_bytes + 1)
        except zlib.error:
            return None, "broken"
        if len(raw) > max_bytes or d.unconsumed_tail:
            return len(raw), "too_large"
        if not d.eof or d.unused_data:
            return None, "broken"
        if len(raw) != size:
            return len(raw), "size"
        return len(raw), None if hashlib.sha256(raw).hexdigest() == sha else "digest"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            size = [None if pd.isna(x) else x for x in pdf["original_bytes"]]
            found = [look(*x) for x in zip(pdf["body_sha256"], pdf["compression"], pdf["body"], size, strict=True)]
            yield pdf[[*keep, "body_sha256"]].assign(size=pd.array([n for n, _ in found], dtype="Int64"), error=[e for _, e in found])

    kept = "".join(f"`{c}` {bodies.schema[c].dataType.simpleString()}, " for c in keep)
    return bodies.select(*keep, "body_sha256", "compression", "body", "original_bytes").mapInPandas(run, f"{kept}body_sha256 string, size long, error string")


def resumable_run(runs: DataFrame, jobs: DataFrame, artifacts: DataFrame, brand: str, model: str, year_floor: int, target: int) -> DataFrame:
    """The latest run of this scope and target that may be continued, or no row.

    It failed or was paused, is not published, its job ended, its last attempt is no older than those of its captures,
    and none of its captures is a challenge or unverified.
    """
    scope = (F.col("scope_brand") == brand) & (F.col("scope_model") == model) & (F.col("scope_vehicle_year_floor") == year_floor) & (F.col("target_parts") == target)
    open_runs = runs.filter(scope & F.col("status").isin("failed", "paused") & (F.coalesce("parts_ok", F.lit(0)) < target))
    ended = jobs.filter("finished_at is not null").select(F.col("job_id").alias("run_job_id"), F.col("finished_at").alias("_job_end"))
    bad = artifacts.filter(F.col("challenge_detected") | (F.col("verification_status") != "verified")).select("run_id").distinct()
    late = artifacts.groupBy("run_id").agg(F.max("fetched_at").alias("_last"))
    fit = open_runs.join(ended, "run_job_id").join(bad, "run_id", "left_anti").join(late, "run_id", "left").filter(F.col("_last").isNull() | (F.col("_last") <= F.col("_job_end") + F.expr(GRACE)))
    return fit.orderBy(F.desc("run_started_at"), F.desc("run_id")).limit(1).drop("_job_end", "_last")


#: Response headers whose values are not stored (fixed values).
SECRET_HEADERS = ("authorization", "cookie", "proxy-authorization", "set-cookie")


def redact_headers(headers: Column) -> Column:
    """Headers with sensitive values replaced, whatever the case of their names."""
    return F.transform_values(headers, lambda k, v: F.when(F.lower(k).isin(*SECRET_HEADERS), F.lit("[REDACTED]")).otherwise(v))


def record_captures(captures: DataFrame, stored: DataFrame, order: str) -> DataFrame:
    """captures with `stores_body` (the first of its body, which is not stored yet) and headers without secrets.

    captures: body_sha256, headers, and an order column; stored: body_sha256 of what is stored.
    """
    fresh = captures.select("body_sha256", order).join(stored.select("body_sha256"), "body_sha256", "left_anti").groupBy("body_sha256").agg(F.min(order).alias("_first"))
    j = captures.join(fresh, "body_sha256", "left")
    return j.select(*(c for c in captures.columns if c != "headers"), redact_headers(F.col("headers")).alias("headers"), F.coalesce(F.col("_first") == F.col(order), F.lit(False)).alias("stores_body"))


def within_budget(bodies: DataFrame, max_bytes: int, max_rows: int) -> DataFrame:
    """One row (n_rows, stored_bytes, ok): whether a run's bodies stay within its storage budget."""
    return bodies.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum("stored_bytes"), F.lit(0)).alias("stored_bytes")).withColumn("ok", (F.col("n_rows") <= max_rows) & (F.col("stored_bytes") <= max_bytes))
