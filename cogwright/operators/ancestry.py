"""Chains of parents, followed to their roots by pointer doubling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written


def _wrong(kind: Column, up: Column, there: Column, above: Column, order: Sequence[str]) -> Column:
    """What is wrong between a record and its parent, if anything: whether that is there, and of which kind."""
    bad = F.when(up.isNotNull() & there.isNull(), "missing_parent")
    if order:
        place = F.array_position(F.array(*map(F.lit, order)), kind)
        wanted = F.get(F.array(*map(F.lit, order)), (place - 2).cast("int"))
        bad = F.when(F.coalesce(place, F.lit(0)) == 0, "wrong_type").when(up.isNull() & (place > 1), "no_parent").otherwise(bad)
        bad = F.coalesce(bad, F.when(up.isNotNull() & ~above.eqNullSafe(wanted), "wrong_type"))
    return bad


def _moved(rows: DataFrame, by: DataFrame) -> DataFrame:
    """Open rows, each after taking over what the record that it points to has found."""
    jump = by.select(F.col("k").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("ancestors").alias("_more"), F.col("root").alias("_root"), F.col("defect").alias("_defect"))
    return rows.join(jump, "up").select("k", "kind", F.col("_up").alias("up"), (F.col("depth") + F.col("_depth")).alias("depth"), F.concat("ancestors", "_more").alias("ancestors"), F.col("_root").alias("root"), F.col("_defect").alias("defect"))


def resolve_chains(records: DataFrame, key: str, parent: str, kind: str | None = None, order: Sequence[str] = ()) -> DataFrame:
    """(key, kind, root, depth, ancestors, defect) for every record: its whole chain, or the first thing that is wrong with it.

    In each round every open record that others point to takes over what the record that it points to points to, so a chain of n steps takes
    log2(n) rounds, each a join on the pointer that is written to shared scratch. Without an `order` of kinds any chain goes;
    ancestors is then empty. With one, a record's parent must be of the kind before its own, and ancestors has the keys from the
    nearest on. defect, the nearest on the way up: missing_parent, no_parent (of a kind that has one), wrong_type, or cycle
    (on the way to one, too); root is then null. Null keys are left out; of records that repeat a key the least counts.
    """
    of_kind = F.col(kind) if kind else F.lit(None).cast("string")
    rows = records.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.min(F.struct(of_kind.alias("kind"), F.col(parent).alias("up"))).alias("r")).select("k", "r.kind", "r.up")
    rows = written(rows, "chains")
    above = rows.select(F.col("k").alias("up"), F.col("kind").alias("_kind"), F.lit(True).alias("_there"))
    j = rows.join(above, "up", "left")
    bad = _wrong(F.col("kind"), F.col("up"), F.col("_there"), F.col("_kind"), order)
    up = F.when(F.col("_bad").isNull(), F.col("up"))
    path = F.when(up.isNotNull(), F.array("up")) if order else None
    empty = F.array().cast(f"array<{dict(rows.dtypes)['k']}>")
    state = j.withColumn("_bad", bad).select(
        "k", "kind", up.alias("up"), F.when(up.isNotNull(), 1).otherwise(0).cast("long").alias("depth"), (F.coalesce(path, empty) if order else empty).alias("ancestors"), F.when(F.col("_bad").isNull() & up.isNull(), F.col("k")).alias("root"), F.col("_bad").alias("defect"),
    )
    state = written(state, "chains")
    # Only what others point to is followed by rounds; the rest, often most records, takes over its parent's answer at the end.
    asked = state.filter("up is not null").select(F.col("up").alias("k")).distinct()
    still = written(state.filter("up is not null").join(asked, "k", "left_semi"), "chains")
    ends = state.filter("up is null")
    followed, left = ends, max(still.count(), 1).bit_length() + 1
    while left and not still.isEmpty():
        left -= 1
        moved = written(_moved(still, followed.unionByName(still)), "chains")
        # Records whose chain is known are written once and only read after that.
        followed, still = followed.unionByName(moved.filter("up is null")), moved.filter("up is not null")
    inner = followed.unionByName(still)
    leaves = state.filter("up is not null").join(asked, "k", "left_anti")
    state = inner.unionByName(_moved(leaves, inner))
    # More rounds than the logarithm of all records that are pointed to: what is still open goes round.
    return state.select(F.col("k").alias(key), "kind", "root", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"), F.when(F.col("defect").isNull() & F.col("up").isNull(), F.col("ancestors")).alias("ancestors"), F.coalesce("defect", F.when(F.col("up").isNotNull(), "cycle")).alias("defect"))


def _shared_keys(records: DataFrame, last: Column) -> DataFrame:
    """(_shared): hashes of keys that a record of the last kind shares with another record or that a record points to.

    Only hashes are shuffled. Two keys with one hash are both taken for shared, which costs a longer way and changes nothing.
    """
    named = records.filter("key is not null").select(F.xxhash64("key").alias("_shared"), last.alias("_last"))
    asked = records.filter("parent is not null").select(F.xxhash64("parent").alias("_shared"), F.lit(False).alias("_last"))
    return written(named.unionByName(asked).groupBy("_shared").agg(F.count("*").alias("_n"), F.bool_or("_last").alias("_any")).filter("_n > 1 and _any").select("_shared"), "shared")


def part_evidence(parts: DataFrame, records: DataFrame, order: Sequence[str]) -> DataFrame:
    """(part_id, ancestors, defect): whether a part's accepted record, its five ancestors, payload and source agree with the part.

    parts: part_id, key and group_key (of the part and its group as the row gives them), record_sha256 and source_url; records: key,
    parent, kind, accepted, part_id, record_sha256, source_url (all kinds of the run). defect is the first of no_record,
    several_records, key, parent, payload, url, and those of resolve_chains().

    Records of the last kind are by far the most. They are followed like the others only where their key is shared or pointed to;
    a part whose record has its key to itself takes over its parent's chain, and goes there without what has been compared.
    Parts and records that are stored by part_id meet without a shuffle.
    """
    last = F.coalesce(F.col("kind") == order[-1], F.lit(False))
    shared = _shared_keys(records, last)
    followed = records.filter(~last).unionByName(records.filter(last).join(shared, F.xxhash64("key") == F.col("_shared"), "left_semi"))
    chains = resolve_chains(followed, "key", "parent", "kind", order)
    mine = records.filter(F.col("accepted") & last).groupBy("part_id").agg(F.count("*").alias("_n"), F.min(F.struct("key", "parent", "record_sha256", "source_url")).alias("r"))
    differs = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    own = (
        F.when(F.col("_n").isNull(), "no_record").when(F.col("_n") > 1, "several_records").when(differs("r.key", "key"), "key").when(differs("r.parent", "group_key"), "parent")
        .when(differs("r.record_sha256", "record_sha256"), "payload").when(differs("r.source_url", "source_url"), "url")
    )
    j = parts.join(mine, "part_id", "left").select("part_id", own.alias("_own"), F.col("r.key").alias("_key"), F.col("r.parent").alias("_parent"))
    j = j.join(shared, F.xxhash64("_key") == F.col("_shared"), "left").withColumn("_alone", F.col("_key").isNotNull() & F.col("_shared").isNull())
    above = chains.select(F.col("key").alias("_by"), F.col("kind").alias("_kind"), F.col("ancestors").alias("_more"), F.col("defect").alias("_above"), F.lit(True).alias("_there"))
    j = j.select("part_id", "_own", "_alone", F.when(F.col("_alone"), F.col("_parent")).otherwise(F.col("_key")).alias("_by")).join(above, "_by", "left")
    defect = F.coalesce("_own", F.when(F.col("_alone"), _wrong(F.lit(order[-1]), F.col("_by"), F.col("_there"), F.col("_kind"), order)), "_above")
    path = F.when(~F.col("_alone"), F.col("_more")).when(F.col("_by").isNull(), F.array().cast(dict(chains.dtypes)["ancestors"])).otherwise(F.concat(F.array("_by"), "_more"))
    return j.select("part_id", F.when(defect.isNull(), path).alias("ancestors"), defect.alias("defect"))
