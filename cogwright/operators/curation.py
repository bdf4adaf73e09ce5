"""Curation of catalog levels as batches: categories, receipts, resets, VIN resolutions and confirmations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import vehicle_identity
from ..functions.text import is_blank
from .merge import last_per_key


def upsert_categories(old: DataFrame, new: DataFrame) -> DataFrame:
    """Categories after a batch: by (vehicle, cid), or by (vehicle, name) where a row has no cid.

    old: id, vehicle_id, cid, name; new: vehicle_id, cid, name, position. The last row of a key by position counts. A
    row without a cid goes to the least id of that name, whose cid it clears; a row that meets none is new, with a null
    id for the caller to fill.
    """
    key = F.coalesce(F.concat(F.lit("c:"), F.nullif(F.trim("cid"), F.lit(""))), F.concat(F.lit("n:"), F.coalesce("name", F.lit(""))))
    batch = last_per_key(new.withColumn("_k", key).withColumn("cid", F.nullif(F.trim("cid"), F.lit(""))), ["vehicle_id", "_k"], ["position"])
    by_cid = old.filter("cid is not null").select("vehicle_id", F.concat(F.lit("c:"), "cid").alias("_k"), "id")
    by_name = old.groupBy("vehicle_id", F.concat(F.lit("n:"), F.coalesce("name", F.lit(""))).alias("_k")).agg(F.min("id").alias("id"))
    met = batch.join(by_cid.unionByName(by_name), ["vehicle_id", "_k"], "left")
    # Rows with and without a cid can meet the same category; the later one counts.
    known = last_per_key(met.filter("id is not null"), ["id"], ["position"]).select("id", F.lit(True).alias("_met"), F.col("cid").alias("_cid"), F.col("name").alias("_name"))
    kept = old.join(known, "id", "left").select("id", "vehicle_id", F.when(F.col("_met"), F.col("_cid")).otherwise(F.col("cid")).alias("cid"), F.coalesce("_name", "name").alias("name"))
    return kept.unionByName(met.filter("id is null").select("id", "vehicle_id", "cid", "name"))


def upsert_vehicles(old: DataFrame, new: DataFrame) -> DataFrame:
    """Vehicles after a batch, by the hash of what makes them (see vehicle_identity): tokens, links and months are the new ones, the rest stays.

    Both have the columns of VEHICLE_IDENTITY and ssd, vid, url, production_from, production_to; old has an id, which is
    null for new vehicles, and new a position, by which the last row of a vehicle counts. A token that a batch lacks stays.
    """
    batch = last_per_key(new.withColumn("identity_hash", vehicle_identity()), ["identity_hash"], ["position"]).drop("position").withColumn("id", F.lit(None).cast(old.schema["id"].dataType))
    o, n = old.withColumn("identity_hash", vehicle_identity()).alias("o"), batch.withColumn("_new", F.lit(True)).alias("n")
    j = o.join(n, "identity_hash", "full_outer")
    pick = {c: F.coalesce(f"n.{c}", f"o.{c}") for c in ("ssd", "vid")} | {c: F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) for c in ("url", "production_from", "production_to")}
    return j.select("identity_hash", F.col("o.id").alias("id"), *(pick.get(c, F.coalesce(f"o.{c}", f"n.{c}")).alias(c) for c in old.columns if c != "id"))


def record_receipts(groups: DataFrame, receipts: DataFrame) -> DataFrame:
    """Groups with their last receipt; the high-water mark of verified rows rises with status done only.

    groups: group_id, vehicle_id, fetched_run_key, fetched_status, fetched_row_count, verified_row_count; receipts:
    group_id, run_key, status (done, not_found, partial), row_count, position. Of receipts at one position the greatest
    run_key, then status, then row_count counts, and gives all three.
    """
    last = last_per_key(receipts, ["group_id"], ["position", "run_key", "status", "row_count"]).select("group_id", F.col("run_key").alias("_run"), F.col("status").alias("_status"), F.col("row_count").alias("_rows"))
    high = receipts.filter("status = 'done'").groupBy("group_id").agg(F.max("row_count").alias("_high"))
    j = groups.join(last, "group_id", "left").join(high, "group_id", "left")
    return j.select("group_id", "vehicle_id", F.coalesce("_run", "fetched_run_key").alias("fetched_run_key"), F.coalesce("_status", "fetched_status").alias("fetched_status"), F.coalesce("_rows", "fetched_row_count").alias("fetched_row_count"), F.greatest("verified_row_count", "_high").alias("verified_row_count"))


def vehicles_not_found(groups: DataFrame, parts: DataFrame, gone: DataFrame, run_key: str, run_id: int) -> tuple[DataFrame, DataFrame]:
    """(groups, parts) after vehicles turned out to be gone: their groups end as not_found and their parts leave the run.

    gone: vehicle_id. Groups that already have a receipt of this run keep it; parts: part_id, group_id, seen_run_id.
    """
    hit = groups.join(gone.select("vehicle_id").distinct().withColumn("_gone", F.lit(True)), "vehicle_id", "left")
    ends = F.coalesce("_gone", F.lit(False)) & ~F.coalesce(F.col("fetched_run_key") == run_key, F.lit(False))
    out = hit.select(
        "group_id", "vehicle_id", F.when(ends, F.lit(run_key)).otherwise(F.col("fetched_run_key")).alias("fetched_run_key"), F.when(ends, "not_found").otherwise(F.col("fetched_status")).alias("fetched_status"),
        F.when(ends, 0).otherwise(F.col("fetched_row_count")).alias("fetched_row_count"), "verified_row_count",
    )
    dead = hit.filter("_gone").select("group_id", F.lit(True).alias("_dead"))
    left = parts.join(dead, "group_id", "left").withColumn("seen_run_id", F.when(~(F.coalesce("_dead", F.lit(False)) & (F.col("seen_run_id") == run_id)), F.col("seen_run_id")))
    return out, left.select(*parts.columns)


def reset_run(groups: DataFrame, parts: DataFrame, progress: DataFrame, run_key: str, run_id: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups, parts, progress) as if a run had not been: its receipts and markers are null and its progress is gone."""
    mine = F.coalesce(F.col("fetched_run_key") == run_key, F.lit(False))
    cleared = groups.withColumns({c: F.when(~mine, F.col(c)) for c in ("fetched_run_key", "fetched_status", "fetched_row_count")})
    return cleared, parts.withColumn("seen_run_id", F.when(F.col("seen_run_id") != run_id, F.col("seen_run_id"))), progress.filter(~F.col("run_key").eqNullSafe(run_key))


def reset_scope(progress: DataFrame, scope: str) -> DataFrame:
    """Progress without that of a scope."""
    return progress.filter(~F.col("scope").eqNullSafe(scope))


def resolve_vins(old: DataFrame, new: DataFrame) -> DataFrame:
    """VIN resolutions by (vin, resolved_uid): status, vehicle and time are the new ones, all else stays as first recorded."""
    key = ["vin", "resolved_uid"]
    last = last_per_key(new, key, ["crawled_at"]).select(*key, *(F.col(c).alias(f"_{c}") for c in new.columns if c not in key))
    j = old.join(last, key, "full_outer")
    fresh = {"status", "vehicle_id", "crawled_at"}
    had = F.col("source_run_key").isNotNull() | F.col("status").isNotNull()
    pick = lambda c: F.when(F.col("_status").isNotNull() & had, F.col(f"_{c}") if c in fresh else F.col(c)).otherwise(F.coalesce(c, f"_{c}"))
    return j.select(*key, *(pick(c).alias(c) for c in old.columns if c not in key))


def confirm_mappings(requests: DataFrame, decodes: DataFrame, best: DataFrame, catalog: DataFrame, mappings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new mappings, refused requests with an error) for requests to map a VIN to a vehicle.

    requests: request_id, vin, vehicle_id, override, reference; decodes: vin, make, model, model_year, engine, trim; best:
    vin, vehicle_id, status (exact, ambiguous, review); catalog: vehicle_id, make, model, engine, trim, year_from,
    year_to of what is published. An exact candidate needs no override; an override needs a reference and a published
    vehicle of the model year, and with a complete decode counts as one by name. Of a sparse decode, what it lacks is
    taken from the vehicle. A VIN is mapped once: the first request by request_id, and none if it has a mapping.
    """
    d = decodes.select("vin", *(F.col(c).alias(f"d_{c}") for c in ("make", "model", "model_year", "engine", "trim")))
    c = catalog.select("vehicle_id", *(F.col(x).alias(f"c_{x}") for x in ("make", "model", "engine", "trim", "year_from", "year_to")))
    j = requests.join(d.withColumn("_decoded", F.lit(True)), "vin", "left").join(best.select("vin", "vehicle_id", F.col("status").alias("_best")), ["vin", "vehicle_id"], "left").join(c.withColumn("_listed", F.lit(True)), "vehicle_id", "left")
    j = j.join(mappings.select("vin").distinct().withColumn("_mapped", F.lit(True)), "vin", "left")
    sparse = is_blank("d_make") | is_blank("d_model") | F.col("d_model_year").isNull() | is_blank("d_engine") | is_blank("d_trim")
    exact = F.coalesce(F.col("_best") == "exact", F.lit(False))
    in_years = (F.col("c_year_from").isNull() | (F.col("d_model_year") >= F.col("c_year_from"))) & (F.col("c_year_to").isNull() | (F.col("d_model_year") <= F.col("c_year_to")))
    listed = F.coalesce("_listed", F.lit(False)) & (F.col("d_model_year").isNull() | in_years)
    error = (
        F.when(F.col("override") & is_blank("reference"), "reference_missing").when(F.col("_decoded").isNull(), "not_decoded").when(sparse & ~F.col("override"), "decode_sparse")
        .when(~exact & ~F.col("override"), F.when(F.col("_best").isNull(), "no_candidate").otherwise("needs_review")).when(~exact & F.col("_best").isNull() & ~listed, "not_published").when(F.col("_mapped"), "already_mapped")
    )
    j = j.withColumn("error", error)
    first = F.row_number().over(Window.partitionBy("vin").orderBy(F.col("error").isNotNull(), "request_id"))
    j = j.withColumn("error", F.when(F.col("error").isNull() & (first > 1), "already_mapped").otherwise(F.col("error")))
    fill = lambda mine, theirs: F.when(sparse & ~exact, F.coalesce(F.nullif(F.trim(mine), F.lit("")), F.col(theirs))).otherwise(F.col(mine))
    source = F.when(sparse, "manual-sparse-override").when(~exact, "manual-name-override").otherwise("manual-confirmed")
    made = j.filter("error is null").select(
        F.substring("vin", 1, 11).alias("vin_prefix"), "vin", "vehicle_id", F.col("d_make").alias("make"), fill("d_model", "c_model").alias("model"), F.col("d_model_year").alias("model_year"),
        F.nullif(fill("d_engine", "c_engine"), F.lit("")).alias("engine"), fill("d_trim", "c_trim").alias("trim"), source.alias("source_name"), F.nullif(F.trim("reference"), F.lit("")).alias("source_reference"),
    )
    return made, j.filter("error is not null").select("request_id", "vin", "vehicle_id", "error")


def problem_urls(queue: DataFrame, run_key: str, statuses: tuple[str, ...] = ("failed", "challenged", "skipped_robots", "parse_failed")) -> DataFrame:
    """A run's URLs that went wrong, in the order of the queue."""
    return queue.filter((F.col("run_key") == run_key) & F.col("status").isin(*statuses)).orderBy("id")


def requeue(queue: DataFrame, run_key: str, statuses: tuple[str, ...]) -> DataFrame:
    """The queue after a run's URLs with these statuses went back to pending; robots' refusals can't."""
    wrong = set(statuses) - {"failed", "parse_failed", "challenged"}
    if wrong:
        raise ValueError(f"statuses that can't be requeued: {sorted(wrong)}")
    hit = F.coalesce((F.col("run_key") == run_key) & F.col("status").isin(*statuses), F.lit(False))
    return queue.withColumn("last_error", F.when(~hit, F.col("last_error"))).withColumn("finished_at", F.when(~hit, F.col("finished_at"))).withColumn("status", F.when(hit, "pending").otherwise(F.col("status")))
