"""Deliveries: the archive export's columns, CSV that spreadsheets read safely, and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import csv_safe, split_path


def with_category_levels(df: DataFrame, path: str = "category_path") -> DataFrame:
    """main, middle and small from a category path."""
    return df.withColumn("_l", split_path(path)).select("*", F.col("_l.main").alias("category_main"), F.col("_l.middle").alias("category_middle"), F.col("_l.small").alias("category_small")).drop("_l")


def export(fitments: DataFrame, occurrences: DataFrame, vehicles: DataFrame, hints: DataFrame | None = None, *, unverified: bool = False) -> DataFrame:
    """Fitments with their occurrence and vehicle, verified ones only unless asked; hints follow as rows of their own.

    fitments: occurrence_id, vehicle_id, is_verified; occurrences: occurrence_id, part_number, part_name, category_path;
    vehicles: vehicle_id, brand, model; hints: occurrence_id, hint.
    """
    rows = fitments if unverified else fitments.filter("is_verified")
    wide = rows.join(occurrences, "occurrence_id").join(vehicles, "vehicle_id").withColumn("hint", F.lit(None).cast("string"))
    wide = with_category_levels(wide)
    if hints is None:
        return wide
    extra = with_category_levels(hints.join(occurrences, "occurrence_id"))
    return wide.unionByName(extra, allowMissingColumns=True)


#: The columns of the archive export, in order (fixed values).
ARCHIVE_COLUMNS = (
    "Brand", "Name", "Model", "Prod period", "Production from", "Production to", "產品英文名稱", "Number", "零件大分類", "零件中分類", "零件小分類", "Category path", "Range", "Part range from", "Part range to", "Diagram range",
    "Condition", "Description", "Options", "Diagram code", "Diagram name", "Callout", "Quantity", "Note", "Source URL", "Source mode", "Archive source", "Captured at", "Archive truncation", "Response ID", "Response SHA-256",
    "Confidence", "Derivation", "Verified fitment",
)


def archive_export(fitments: DataFrame, occurrences: DataFrame, numbers: DataFrame, vehicles: DataFrame, diagrams: DataFrame, taxonomy: DataFrame, sources: DataFrame, responses: DataFrame, archives: DataFrame, *, unverified: bool = False) -> DataFrame:
    """Fitments with all that is known of them, under ARCHIVE_COLUMNS; verified ones only unless asked.

    Inner joins to the occurrence, number, vehicle, diagram, source and response, left ones to taxonomy and archive: a
    fitment whose response has no capture in an archive was fetched live. Each table has an id; fitments name
    occurrence_id, number_id, vehicle_id and diagram_id, diagrams taxonomy_id, sources (record_id, response_id), and
    archives response_id.
    """
    f = (fitments if unverified else fitments.filter("is_verified")).alias("f")
    by = lambda df, name, column: (df.alias(name), F.col(column) == F.col(f"{name}.id"))
    j = f
    for df, name, column in ((occurrences, "po", "f.occurrence_id"), (numbers, "pn", "f.number_id"), (vehicles, "v", "f.vehicle_id"), (diagrams, "d", "f.diagram_id")):
        j = j.join(*by(df, name, column))
    j = j.join(*by(taxonomy, "tn", "d.taxonomy_id"), "left").join(sources.alias("rs"), F.col("rs.record_id") == F.col("f.id")).join(*by(responses, "hr", "rs.response_id")).join(archives.alias("ac"), F.col("ac.response_id") == F.col("hr.id"), "left")
    level = split_path("tn.path_raw")
    values = [
        "v.brand", "v.name_raw", "v.model_raw", "v.prod_period_raw", "v.production_from", "v.production_to", "pn.name_en_raw", "pn.number_raw", level["main"], level["middle"], level["small"], "tn.path_raw", "po.part_range_raw", "po.part_from", "po.part_to",
        "d.diagram_range_raw", "po.part_condition_raw", "v.description_raw", "v.options_raw", "d.diagram_code_raw", "d.diagram_name_raw", "po.callout_raw", "po.quantity_raw", "po.note_raw", "f.source_url",
        F.when(F.col("ac.response_id").isNull(), "live_http").otherwise("historical_archive"), "ac.archive_source", "ac.captured_at", "ac.truncation_reason", "rs.response_id", "hr.body_sha256", "f.confidence", "f.derivation", "f.is_verified",
    ]
    return j.select(*((F.col(v) if isinstance(v, str) else v).alias(c) for c, v in zip(ARCHIVE_COLUMNS, values, strict=True)))


def write_csv(df: DataFrame, path: str) -> None:
    """Headed UTF-8 CSV without a byte-order mark; text cells that look like formulas are marked."""
    text = {c for c, t in df.dtypes if t == "string"}
    df.select(*(csv_safe(c).alias(c) if c in text else F.col(c) for c in df.columns)).write.option("header", True).option("escape", '"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines; characters beyond ASCII stay as they are."""
    df.write.json(path)
