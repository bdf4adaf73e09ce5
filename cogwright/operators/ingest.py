"""Records of parsed pages put into a normalised store: each once by its natural key, with ids that are dense and stay.

A record that the store has keeps its id; new ones follow the greatest, in the order in which the pages have them. Numbers are
given out by ranges of that order whose counts are summed first, so no task sees all new records. Where nothing is new a table stays as it is. Parents come before
their children, whose keys hold the parents' ids.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ranges import range_cuts, range_of
from ..functions.text import assembly_flag, part_key
from .scratch import written

#: New records are numbered by ranges of their order, of about this many rows; very many go into RANGES larger ones, which spill.
RANGES, ROWS_PER_RANGE = 256, 200_000
#: Vehicles and diagrams are looked up in each task, if they are counted to be no more than this; beyond it, the joins shuffle.
BROADCAST_ROWS = 1_000_000
#: The natural key and the other columns of each type of record, parents first (fixed values).
TYPES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "vehicle": (("catalog_brand", "external_id", "model", "prod_period", "source_url"), ("name",)),
    "taxonomy_node": (("vehicle_id", "path"), ("parent_path", "depth", "name", "source_url")),
    "diagram": (("vehicle_id", "code", "name", "range", "source_url"), ("taxonomy_id",)),
    "part_number": (("brand", "number"), ("number_normalized", "name", "is_assembly", "source_url")),
    "part_occurrence": (("part_id", "diagram_id", "callout", "quantity", "range", "condition", "note", "source_url"), ("vehicle_id",)),
    "fitment": (("occurrence_id", "derivation"), ("part_id", "vehicle_id", "diagram_id", "is_verified", "confidence", "source_url")),
    "compatibility_hint": (("part_id", "text", "source_url"), ()),
    "part_relation": (("part_id", "to_number", "relation_type", "source_url"), ("to_number_normalized",)),
}
_STRINGS = {"is_assembly": "boolean", "is_verified": "boolean", "confidence": "double", "depth": "int"}


def _schema(kind: str) -> str:
    keys, others = TYPES[kind]
    return "id long, " + ", ".join(f"`{c}` " + (_STRINGS.get(c) or ("long" if c.endswith("_id") and c != "external_id" else "string")) for c in (*keys, *others))


def empty_store(spark: SparkSession) -> dict[str, DataFrame]:
    """A store without records: a table for each type, and the edges to the pages that they come from."""
    return {**{k: spark.createDataFrame([], _schema(k)) for k in TYPES}, "record_source": spark.createDataFrame([], "record_type string, record_id long, page_id long, parser string")}


def get_or_create(store: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str], derived: Mapping[str, Column] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table, resolved, created): the store with the new records, rows with their ids, and the new records alone.

    store: id, keys and others; rows: keys, others and the order columns, of which the first is a long. Keys compare null-safe; of rows
    with one key the first in order gives the others. derived: others that are computed of a new record and not of each row. A hash
    leads the keys, so that sorts tell them apart by a number; the keys themselves decide.
    """
    derived = derived or {}
    others = [c for c in store.columns if c not in ("id", *keys)]
    given = [c for c in others if c not in derived]
    same = ["_hash", "_key"]
    key = F.struct(*keys)
    keyed = lambda df, *more: df.select(*more, key.alias("_key")).withColumn("_hash", F.xxhash64("_key"))
    typed = rows.withColumns({c: F.col(c).cast(store.schema[c].dataType) for c in keys if rows.schema[c].dataType != store.schema[c].dataType})  # equal keys have equal hashes
    first = keyed(typed, F.struct(*order).alias("_order"), F.struct(*(given or [F.lit(0).alias("_")])).alias("_given"))
    first = first.groupBy(*same).agg(F.min("_order").alias("_at"), F.min_by("_given", "_order").alias("_rest"))
    last = store.agg(F.max("id")).first()[0]
    found = first.withColumn("_id", F.lit(None).cast("long")) if last is None else first.join(keyed(store, F.col("id").alias("_id")), same, "left")
    found = written(found, "found-records")
    new = found.filter("_id is null")
    known = found.filter("_id is not null").select("_id", *same)
    with_ids = lambda ids: keyed(typed, *(c for c in rows.columns if c not in keys)).join(ids.withColumnRenamed("_id", "id"), same).select(*(F.col(f"_key.{c}").alias(c) if c in keys else F.col(c) for c in rows.columns), "id")
    count = new.count()
    if not count:
        return store, with_ids(known), store.filter("false")
    ranges = min(RANGES, -(-count // ROWS_PER_RANGE))
    place = F.col(f"_at.{order[0]}")
    cuts = range_cuts(new.select(place.alias("_place")), "_place", ranges) if ranges > 1 else []
    new = new.withColumn("_part", range_of(place, cuts))
    counts = new.groupBy("_part").agg(F.count("*").alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("_part").orderBy(*(F.col(f"_at.{c}") for c in order), "_hash")
    numbered = new.withColumn("_rank", F.row_number().over(inside)).join(F.broadcast(starts), "_part")
    numbered = numbered.select((F.lit(last or 0) + F.col("_ahead") + F.col("_rank")).alias("id"), *(F.col(f"_key.{c}").alias(c) for c in keys), *(F.col(f"_rest.{c}").alias(c) for c in given))
    created = written(numbered.withColumns(dict(derived)).select(*store.columns) if derived else numbered.select(*store.columns), "created-records")
    ids = keyed(created, F.col("id").alias("_id"))
    return created if last is None else store.unionByName(created), with_ids(ids if last is None else known.unionByName(ids)), created


def _small(df: DataFrame) -> DataFrame:
    """df, broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _chosen(parts: DataFrame, diagrams: DataFrame) -> DataFrame:
    """parts with diagram_id: that of the page which has the part's code, else its name, else the only one."""
    few = F.broadcast if diagrams.count() <= BROADCAST_ROWS else lambda df: df
    last = lambda by: few(diagrams.filter(F.col(by).isNotNull()).groupBy("page_id", by).agg(F.max_by("id", "place").alias(f"_by_{by}")).withColumnRenamed(by, f"diagram_{by}"))
    only = diagrams.groupBy("page_id").agg(F.count_distinct("id").alias("_n"), F.min("id").alias("_only"))
    j = parts.join(last("code"), ["page_id", "diagram_code"], "left").join(last("name"), ["page_id", "diagram_name"], "left").join(few(only), "page_id", "left")
    return j.withColumn("diagram_id", F.coalesce("_by_code", "_by_name", F.when(F.col("_n") == 1, F.col("_only")))).drop("_by_code", "_by_name", "_n", "_only")


def ingest_pages(pages: Mapping[str, DataFrame], store: Mapping[str, DataFrame], parser: str, verified: bool, derivation: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """(store, created): the store with the records of these pages and the edges to them, and (record_type, created) counts.

    pages: vehicles (page_id, catalog_brand, external_id, model, prod_period, name, source_url; one a page), taxonomies (page_id, place, path as an
    array, source_url), diagrams (page_id, place, code, name, range, path, source_url), parts (page_id, place, brand, number, name, diagram_code,
    diagram_name, callout, quantity, range, condition, note, source_url), hints (page_id, place, brand, number, text, source_url) and relations (page_id,
    place, number, to_number, relation_type, source_url); a place is unique in its page and table. Run again, it creates nothing and changes no id. A diagram belongs to the node of its path,
    or the page's only one. A part without a brand has its vehicle's; without a vehicle or a diagram it is a number and no occurrence.
    """
    out: dict[str, DataFrame] = {}
    edges: list[DataFrame] = []
    new: list[DataFrame] = []
    whole_tables: set[str] = set()  # written as they are

    def put(kind: str, rows: DataFrame, order: Sequence[str], needed: Sequence[str], derived: Mapping[str, Column] | None = None) -> DataFrame:
        """Put rows into the store; (page_id, id, needed) of each."""
        out[kind], resolved, created = get_or_create(store[kind], rows, TYPES[kind][0], order, derived)
        if out[kind] is created:
            whole_tables.add(kind)
        resolved = written(resolved.select("page_id", "id", *needed), kind)
        edges.append(resolved.select(F.lit(kind).alias("record_type"), F.col("id").alias("record_id"), "page_id", F.lit(parser).alias("parser")))
        new.append(created.agg(F.count("*").alias("created")).select(F.lit(kind).alias("record_type"), "created"))
        return resolved

    vehicles = put("vehicle", pages["vehicles"], ["page_id"], ["catalog_brand"])
    of_page = _small(vehicles.select("page_id", F.col("id").alias("vehicle_id"), "catalog_brand"))
    nodes = pages["taxonomies"].withColumnRenamed("path", "_path").join(of_page.select("page_id", "vehicle_id"), "page_id").select("*", F.posexplode("_path").alias("depth", "_name"))
    nodes = nodes.select(
        "page_id", "place", "depth", "vehicle_id", "source_url", F.col("_name").alias("name"), F.array_join(F.slice("_path", F.lit(1), F.col("depth") + 1), " > ").alias("path"),
        F.when(F.col("depth") > 0, F.array_join(F.slice("_path", F.lit(1), F.greatest("depth", F.lit(1))), " > ")).alias("parent_path"),
    )
    nodes = put("taxonomy_node", nodes, ["page_id", "place", "depth"], ["path"])
    per_page = nodes.groupBy("page_id").agg(F.count_distinct("id").alias("_n"), F.min("id").alias("_only"))
    named = nodes.groupBy("page_id", "path").agg(F.min("id").alias("_node"))
    diagrams = pages["diagrams"].join(of_page.select("page_id", "vehicle_id"), "page_id").withColumn("path", F.array_join("path", " > ")).join(named, ["page_id", "path"], "left").join(per_page, "page_id", "left")
    diagrams = put("diagram", diagrams.withColumn("taxonomy_id", F.coalesce("_node", F.when(F.col("_n") == 1, F.col("_only")))).drop("_node", "_n", "_only", "path"), ["page_id", "place"], ["place", "code", "name"])

    # Numbers take along what their rows are about, so that nothing is joined back by its place.
    none, about = F.lit(None).cast("string"), lambda name, *columns: F.struct(*columns).alias(name)
    parts, hints, relations = _chosen(pages["parts"].join(of_page, "page_id", "left"), diagrams), pages["hints"], pages["relations"]
    numbers = [
        parts.select("page_id", F.lit(0).alias("step"), "place", F.coalesce("brand", "catalog_brand").alias("brand"), "number", "name", "source_url", about("_part", "vehicle_id", "diagram_id", "callout", "quantity", "range", "condition", "note")),
        hints.select("page_id", F.lit(1).alias("step"), "place", "brand", "number", none.alias("name"), "source_url", about("_hint", "text")),
        relations.select("page_id", F.lit(2).alias("step"), "place", none.alias("brand"), "number", none.alias("name"), "source_url", about("_relation", "to_number", "relation_type")),
    ]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbers)
    if diagrams.count() > BROADCAST_ROWS:
        every = written(every, "numbers")  # read twice, with joins that shuffle
    whole = {"number_normalized": part_key("number"), "is_assembly": F.coalesce(assembly_flag("name")["flag"], F.lit(False))}
    every = put("part_number", every, ["page_id", "step", "place"], ["step", "place", "source_url", "_part", "_hint", "_relation"], whole)
    of_step = lambda step, name: every.filter(F.col("step") == step).select("page_id", "place", F.col("id").alias("part_id"), "source_url", f"{name}.*")

    occurrences = put("part_occurrence", of_step(0, "_part").filter("vehicle_id is not null and diagram_id is not null"), ["page_id", "place"], ["place", "part_id", "vehicle_id", "diagram_id", "source_url"])
    sure: Column = F.lit(1.0 if verified else 0.7)
    fits = occurrences.select("page_id", "place", F.col("id").alias("occurrence_id"), "part_id", "vehicle_id", "diagram_id", "source_url", F.lit(derivation).alias("derivation"), F.lit(verified).alias("is_verified"), sure.alias("confidence"))
    put("fitment", fits, ["page_id", "place"], [])
    put("compatibility_hint", of_step(1, "_hint"), ["page_id", "place"], [])
    put("part_relation", of_step(2, "_relation"), ["page_id", "place"], [], {"to_number_normalized": part_key("to_number")})
    ends = ["record_id", "page_id", "record_type", "parser"]  # first what tells most rows apart
    every_edge, before = reduce(DataFrame.unionByName, edges).select(*ends).distinct().select("record_type", "record_id", "page_id", "parser"), store["record_source"]
    out["record_source"] = every_edge if before.isEmpty() else before.unionByName(every_edge.join(before, ends, "left_anti"))
    kept = {k for k in out if out[k] is store[k] or k in whole_tables}
    return {k: v if k in kept else written(v, "store") for k, v in out.items()}, reduce(DataFrame.unionByName, new)
