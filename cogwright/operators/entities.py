"""Views of the catalog's entities: of the working tables, of the gated snapshot, and of the last sample run.

Those of the snapshot are one aggregation each over its wide rows, by the entity's id; every column is the least of its group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import fitment_window
from ..functions.records import fitment_verdict
from ..functions.text import tree_id

_OPEN = {"ignoreNullFields": "false"}


def _object(fields: Mapping[str, Column | str]) -> Column:
    """A JSON object that keeps nulls."""
    return F.to_json(F.struct(*((F.col(c) if isinstance(c, str) else c).alias(k) for k, c in fields.items())), _OPEN)


def _diagram() -> list[Column]:
    meta = _object({"category_id": "category_id", "category_cid": "cid", "group_uid": "uid"})
    return [F.col("group_id").alias("id"), F.col("vehicle_id"), tree_id("group_id", 1).alias("taxonomy_node_id"), F.col("code").alias("diagram_code_raw"), F.coalesce("name", F.lit("")).alias("diagram_name_raw"), meta.alias("metadata_json"), F.col("url").alias("source_url")]


def diagrams(groups: DataFrame, categories: DataFrame) -> DataFrame:
    """Groups as diagrams. groups: group_id, category_id, code, name, uid, url; categories: category_id, vehicle_id, cid."""
    return groups.join(categories.select("category_id", "vehicle_id", "cid"), "category_id").select(*_diagram())


def occurrences(parts: DataFrame, groups: DataFrame, categories: DataFrame) -> DataFrame:
    """Part rows as occurrences in diagrams. parts: part_id, group_id, code, quantity, range, part_from, part_to, note, url; the others as in diagrams()."""
    g = groups.select("group_id", "category_id", F.col("code").alias("group_code"), F.col("uid").alias("group_uid"), F.col("url").alias("_group_url")).join(categories.select("category_id", "vehicle_id", "cid"), "category_id")
    return parts.join(g, "group_id").select(
        F.col("part_id").alias("id"), F.col("part_id").alias("part_number_id"), F.col("group_id").alias("diagram_id"), "vehicle_id", F.col("code").alias("callout_raw"), F.col("quantity").alias("quantity_raw"), F.col("range").alias("part_range_raw"), "part_from", "part_to",
        F.col("note").alias("note_raw"), _object({"category_id": "category_id", "category_cid": "cid", "group_code": "group_code", "group_uid": "group_uid"}).alias("row_metadata_json"), F.coalesce("url", "_group_url").alias("source_url"),
    )


def of_last_sample(view: DataFrame, seen: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of a view whose part the last sample run saw. seen: id, run_id; runs: run_id, status, started_at; the later run is the one with the greater id."""
    last = runs.filter("status = 'sample'").agg(F.max(F.struct("started_at", "run_id"))["run_id"].alias("run_id"))
    return view.join(seen.join(F.broadcast(last), "run_id").select("id"), "id", "left_semi")  # one row


def _least(snapshot: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return snapshot.groupBy(key).agg(*(F.min(c).alias(c) for c in columns))


def formal_vehicles(snapshot: DataFrame) -> DataFrame:
    """The snapshot's vehicles, with the months from the first start to the last end."""
    v = snapshot.groupBy("vehicle_id").agg(*(F.min(c).alias(c) for c in ("model_id", "brand", "vehicle_name", "model", "prod_period", "production_from", "vehicle_code", "vehicle_vid", "engine", "trim_name", "source_url")), F.max("production_to").alias("production_to"), F.min("snapshot_at").alias("created_at"), F.max("snapshot_at").alias("updated_at"))
    return v.select(
        F.col("vehicle_id").alias("id"), F.col("model_id").alias("catalog_model_id"), F.col("brand").alias("brand_raw"), F.upper(F.trim("brand")).alias("brand_normalized"), F.col("vehicle_name").alias("name_raw"), F.col("model").alias("model_raw"),
        F.col("prod_period").alias("prod_period_raw"), "production_from", "production_to", F.when(F.col("production_from").isNotNull() | F.col("production_to").isNotNull(), "month").alias("production_precision"),
        F.col("vehicle_code").alias("catalog_code"), F.col("vehicle_vid").alias("vehicle_external_id"), _object({"model_id": "model_id", "engine": "engine", "trim_name": "trim_name"}).alias("metadata_json"), "source_url", "created_at", "updated_at",
    )


def formal_taxonomy(snapshot: DataFrame) -> DataFrame:
    """The snapshot's categories and groups as one tree with disjoint ids."""
    top = _least(snapshot, "category_id", ("vehicle_id", "category_cid", "category_main", "source_url")).select(
        tree_id("category_id", 0).alias("id"), "vehicle_id", F.lit(None).cast("long").alias("parent_id"), F.lit(1).alias("depth"), F.coalesce("category_cid", F.lit("")).alias("code_raw"), F.col("category_main").alias("name_raw"), F.col("category_main").alias("path_raw"), "source_url",
    )
    path = F.concat("category_main", F.lit(" / "), F.coalesce("category_group", "group_code"))
    return top.unionByName(_least(snapshot, "group_id", ("vehicle_id", "category_id", "category_main", "category_group", "group_code", "source_url")).select(
        tree_id("group_id", 1).alias("id"), "vehicle_id", tree_id("category_id", 0).alias("parent_id"), F.lit(2).alias("depth"), F.col("group_code").alias("code_raw"), F.coalesce("category_group", F.lit("")).alias("name_raw"), path.alias("path_raw"), "source_url",
    ))


def formal_diagrams(snapshot: DataFrame) -> DataFrame:
    """The snapshot's groups as diagrams."""
    g = _least(snapshot, "group_id", ("vehicle_id", "group_code", "category_group", "category_id", "category_cid", "group_uid", "source_url"))
    names = {"group_code": "code", "category_group": "name", "group_uid": "uid", "source_url": "url", "category_cid": "cid"}
    return g.withColumnsRenamed(names).select(*_diagram())


def formal_fitments(snapshot: DataFrame) -> DataFrame:
    """The snapshot's part rows as fitments: months that part and vehicle share, and the verdict."""
    first, last = fitment_window(F.col("production_from"), F.col("production_to"), F.col("part_from"), F.col("part_to"))
    j = snapshot.withColumns({"effective_from": first, "effective_to": last})
    verdict = fitment_verdict(F.col("effective_from"), F.col("effective_to"), F.lit(True))
    return j.select(F.col("part_id").alias("id"), "vehicle_id", F.col("group_id").alias("diagram_id"), verdict.alias("_v"), "effective_from", "effective_to", "source_url").select("id", "vehicle_id", "diagram_id", "_v.*", "effective_from", "effective_to", "source_url")
