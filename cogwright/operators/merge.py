"""Merges of a batch into a table: one shuffle on the keys, and the counts of what happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row of each key in the given order (null keys are equal)."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) if isinstance(c, str) else c.desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def merge(old: DataFrame, new: DataFrame, keys: Sequence[str], *, update: Sequence[str] | None = None, keep: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """Rows of the merged table with `_change`: inserted, updated, same or kept.

    update: columns that take the new value (default: all but the keys and `keep`); keep: columns that hold the old
    value once there is one. order: within a batch the last row of a key by these columns wins. Keys compare null-safe.
    Running a merge twice inserts nothing the second time.
    """
    if order:
        new = last_per_key(new, keys, order)
    update = [c for c in new.columns if c not in keys and c not in keep] if update is None else list(update)
    o, n = old.withColumn("_old", F.lit(True)).alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
    joined = o.join(n, on, "full_outer")
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    out = []
    differs = F.lit(False)
    for c in old.columns:
        if c in keys:
            out.append(F.when(has_old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
        elif c in update and c in new.columns:
            out.append(F.when(has_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
            differs = differs | ~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
        elif c in new.columns:
            out.append(F.when(has_old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
        else:
            out.append(F.col(f"o.{c}").alias(c))
    change = F.when(~has_new, "kept").when(~has_old, "inserted").when(differs, "updated").otherwise("same")
    return joined.select(*out, change.alias("_change"))


def insert_new(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows of `new` whose key is in neither `old` nor an earlier row of `new`: insert-ignore, null-safe."""
    new = first_per_key(new, keys, order) if order else new.dropDuplicates(list(keys))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
    return new.alias("n").join(old.alias("o"), on, "left_anti")


def clear_stale(members: DataFrame, payload: DataFrame, group: str, keys: Sequence[str], complete: DataFrame, marker: str) -> DataFrame:
    """Members of complete groups that the payload lacks lose their marker; groups that a quota cut keep theirs."""
    seen = payload.select(*keys).distinct().withColumn("_seen", F.lit(True))
    done = complete.select(group).distinct().withColumn("_done", F.lit(True))
    joined = members.join(seen, list(keys), "left").join(done, group, "left")
    stale = F.col("_done").isNotNull() & F.col("_seen").isNull()
    return joined.withColumn(marker, F.when(~stale, F.col(marker))).select(*members.columns)


def upgrade_groups(existing: DataFrame, incoming: DataFrame, category: str, uid: str, code: str) -> DataFrame:
    """Groups after an image link (empty code) gives way to a text link of the same uid.

    Within (category, uid) rows with an empty code go as soon as one has a code; the first row of each code stays.
    """
    rows = existing.withColumn("_at", F.lit(0)).unionByName(incoming.withColumn("_at", F.lit(1)))
    per = Window.partitionBy(category, uid)
    rows = rows.withColumn("_text", F.max((F.col(code) != "").cast("int")).over(per))
    rows = rows.filter((F.col(code) != "") | (F.col("_text") == 0))
    return first_per_key(rows, [category, uid, code], ["_at"]).drop("_at", "_text")


def apply_requests(heads: DataFrame, requests: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edits against revisions: (heads, events, conflicts).

    requests: keys, request_id, expected_revision, action (set, retire, restore) and payload. A request is accepted if
    its expected revision is the head's (0 where there is none); of several for one key the first by request_id is.
    """
    r = requests.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy("request_id")))
    joined = r.join(heads.select(*keys, F.col("revision").alias("_revision"), F.col("payload").alias("_payload"), F.col("status").alias("_status")), list(keys), "left")
    joined = joined.withColumn("_ok", (F.col("_rn") == 1) & (F.col("expected_revision") == F.coalesce("_revision", F.lit(0))))
    accepted = joined.filter("_ok")
    status = F.when(F.col("action") == "retire", "retired").when(F.col("action") == "restore", "active").otherwise(F.coalesce("_status", F.lit("active")))
    body = F.when(F.col("action") == "set", F.col("payload")).otherwise(F.col("_payload"))
    changed = accepted.select(*keys, (F.coalesce("_revision", F.lit(0)) + 1).alias("revision"), body.alias("payload"), status.alias("status"))
    events = accepted.select(*keys, "request_id", "action", (F.coalesce("_revision", F.lit(0)) + 1).alias("revision"), "payload")
    conflicts = joined.filter("not _ok").select(*keys, "request_id", "expected_revision", F.coalesce("_revision", F.lit(0)).alias("revision"))
    kept = heads.join(changed.select(*keys), list(keys), "left_anti").select(*keys, "revision", "payload", "status")
    return kept.unionByName(changed), events, conflicts
