"""Delimited bulk files as typed rows and rejects."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import model_year
from ..functions.records import canonical_json, natural_key, record_digest
from ..functions.text import cp1252_from_latin1, header_key
from ..operators.scratch import written
from .quoted import block_states, quoted_records


@dataclass(frozen=True)
class DatasetSpec:
    """How one dataset is laid out: a new dataset is a new spec, not new code.

    roles names the columns that stand for make, model, model_year, campaign, component, summary and external_id.
    """

    name: str
    fields: tuple[str, ...]
    identity: tuple[str, ...]
    delimiter: str = "\t"
    header: bool = False
    quote: str = ""
    required: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict)


def header_names(fields: Sequence[str], required: tuple[str, ...] = ()) -> list[str]:
    """Normalised names of a header's fields; blank or repeated names and missing required ones are errors."""
    names = [re.sub("[^A-Za-z0-9]+", "_", x.lstrip("\ufeffï»¿").strip()).strip("_").upper() for x in fields]
    if any(not n for n in names) or len(set(names)) < len(names):
        raise ValueError(f"blank or repeated column names: {names}")
    if missing := set(required) - set(names):
        raise ValueError(f"missing columns: {sorted(missing)}")
    return names


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of text files read as ISO-8859-1, with line numbers from 1 in each file.

    Rows are numbered within their read partition; partitions are counted and the counts summed per file.
    """
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")  # the bytes as they are in the file
    raw = spark.read.text(path).select(latin.alias("value"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_id"))
    raw = raw.withColumns({"_part": F.shiftright("_id", 33), "_row": F.col("_id").bitwiseAND(F.lit(2**33 - 1))})
    parts = raw.groupBy("file", "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("file", "_part", "_first", before.alias("_before"))
    return raw.join(parts, ["file", "_part"]).select("file", (F.col("_row") - F.col("_first") + F.col("_before") + 1).alias("line"), cp1252_from_latin1("value").alias("value"))


def _checked(rows: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of (file, line, value, _n, the spec's fields); _n is the number of fields, null where a record is too long to be split."""
    rows = rows.withColumn("natural_key", natural_key(list(spec.identity)))
    missing = F.lit(False)
    for c in spec.required:
        missing = missing | (F.coalesce(F.trim(F.col(c)), F.lit("")) == "")
    error = F.when(F.col("_n").isNull(), "too_long").when(F.col("_n") != len(spec.fields), "field_count").when(F.col("natural_key").isNull(), "empty_identity").when(missing, "missing_field")
    rows = rows.withColumn("error_type", error)
    rejects = rows.filter("error_type is not null").select("file", "line", F.sha2("value", 256).alias("raw_sha256"), "error_type", F.col("value").alias("raw_text"))
    records = rows.filter("error_type is null").select(*spec.fields, "file", "line", "natural_key", F.sha2("natural_key", 256).alias("natural_key_sha256"))
    return records, rejects


def split_rows(lines: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of (file, line, value) without quoting: a wrong number of fields or an empty identity is a reject.

    Blank lines are passed over. Records have the spec's fields, file, line, natural_key and its sha256.
    """
    rows = lines.filter(F.col("value").rlike(r"\S")).withColumn("_s", F.split("value", re.escape(spec.delimiter), -1))
    return _checked(rows.select("file", "line", "value", F.size("_s").alias("_n"), *(F.get("_s", F.lit(i)).alias(c) for i, c in enumerate(spec.fields))), spec)


def normalised(records: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Records in the one shape of all datasets: keys, digest, the role columns, and the payload as JSON."""
    role = lambda r: F.nullif(F.trim(F.col(spec.roles[r])), F.lit("")) if r in spec.roles else F.lit(None).cast("string")
    fields = [c for c in records.columns if c not in ("file", "line", "natural_key", "natural_key_sha256")]
    return records.select(
        F.lit(spec.name).alias("dataset_name"), "natural_key_sha256", record_digest(fields).alias("record_sha256"), F.col("natural_key").alias("natural_key_text"), role("external_id").alias("external_id"),
        role("make").alias("make_name"), role("model").alias("model_name"), model_year(role("model_year")).alias("model_year"), role("campaign").alias("campaign_number"), role("component").alias("component_name"), role("summary").alias("summary_text"),
        canonical_json(fields).alias("payload_json"), F.col("file").alias("member_name"), F.col("line").alias("source_line"),
    )


#: Column layouts of a dataset's files that are looked at; files of one dataset have few.
LAYOUTS = 1000


def read_dataset(spark: SparkSession, path: str, spec: DatasetSpec) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of the files below a path.

    Quoted fields may hold line breaks and delimiters, and stray, doubled and unclosed quotes mean what they mean to
    `csv.reader`; line is then a record's last line. A record of over quoted.RECORD_CHARS characters is a reject without its text.
    If the dataset has header lines, each file's first record is checked against the required fields and names that
    file's fields; files with other columns than the rest have nulls in those they lack.
    """
    if not spec.quote:
        return split_rows(numbered_lines(spark, path), spec)
    states = block_states(spark, path, spec.delimiter, spec.quote)
    layouts = [tuple(spec.fields)]
    if spec.header:
        heads = [r["head"] for r in states.filter("block = 0").select("head").distinct().limit(LAYOUTS + 1).collect()]
        if len(heads) > LAYOUTS or None in heads:
            raise ValueError("too many column layouts, or a first record that is too long")
        named = [header_names(h, spec.required) for h in heads]
        layouts = sorted(set(map(tuple, named)))
        numbers = spark.createDataFrame([(h, layouts.index(tuple(n))) for h, n in zip(heads, named, strict=True)], "head array<string>, layout int")
        states = states.join(F.broadcast(numbers), "head").drop("head")
    else:
        states = states.drop("head").withColumn("layout", F.lit(0))
    found = quoted_records(spark, path, written(states, "block-states"), spec.delimiter, spec.quote)
    if spec.header:
        first = found.groupBy("file").agg(F.min("line").alias("line"))
        found = found.join(first, ["file", "line"], "left_anti")
    rows = found.select("file", "line", "layout", "fields", F.array_join("fields", spec.delimiter).alias("value"), F.when(F.col("fields").isNotNull(), F.size("fields")).alias("_n"))
    split = []
    for i, names in enumerate(layouts):
        of_layout = rows.filter(F.col("layout") == i)
        split.append(_checked(of_layout.select("file", "line", "value", "_n", *(F.get("fields", F.lit(k)).alias(c) for k, c in enumerate(names))), replace(spec, fields=names)))
    union = lambda parts: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return (union([r for r, _ in split]), union([x for _, x in split])) if split else split_rows(spark.createDataFrame([], "file string, line long, value string"), spec)


def member_fields(members: DataFrame, spec: DatasetSpec) -> DataFrame:
    """members with `fields` and `schema_sha256`: the names in a headed member's first line, or the spec's own, and their digest."""
    first = F.regexp_replace(F.regexp_extract(F.decode(F.substring("content", 1, 1_000_000), "ISO-8859-1"), r"^([^\r\n]*)", 1), "^(?:\ufeff|ï»¿)", "")
    names = F.transform(F.split(first, re.escape(spec.delimiter)), lambda x: header_key(F.regexp_replace(x, spec.quote or "$^", ""))) if spec.header else F.array(*(F.lit(f) for f in spec.fields))
    listed = F.when(F.col("content").isNotNull(), names)
    return members.withColumn("fields", listed).withColumn("schema_sha256", F.sha2(F.to_json("fields"), 256))


def archive_members(spark: SparkSession, path: str, expected: str) -> DataFrame:
    """(file, member, size, packed_size, crc_ok, error, content) of zip archives: each must have just the expected member."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path_, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        infos = z.infolist()
                        if len(infos) != 1 or infos[0].filename != expected:
                            out.append((path_, None, None, None, None, "members", None))
                            continue
                        bad = z.testzip()
                        out.append((path_, infos[0].filename, infos[0].file_size, infos[0].compress_size, bad is None, None if bad is None else "crc", z.read(infos[0]) if bad is None else None))
                except zipfile.BadZipFile:
                    out.append((path_, None, None, None, False, "archive", None))
            yield pd.DataFrame(out, columns=["file", "member", "size", "packed_size", "crc_ok", "error", "content"]).astype({"size": "Int64", "packed_size": "Int64", "crc_ok": "boolean"})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, member string, size long, packed_size long, crc_ok boolean, error string, content binary")
