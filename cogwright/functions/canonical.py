"""Records as JSON in one form, so that equal records have equal digests in any language: normalised text, sorted keys, no spaces."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Types whose values have one form as to_json writes them, if the text is plain.
_PLAIN = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "double")

#: Batches are rewritten in slices of about this many characters.
SLICE_CHARS = 1 << 20


def _normal(x: object) -> object:
    if isinstance(x, str):
        return unicodedata.normalize("NFC", x)
    if isinstance(x, list):
        return [_normal(v) for v in x]
    if isinstance(x, dict):
        return {_normal(k): _normal(v) for k, v in x.items()}
    return x


def canonical(x: object) -> str:
    """JSON of a value with normalised text (NFC), sorted keys and no spaces; a number that is none is an error."""
    return json.dumps(_normal(x), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def _rewrite(texts: pa.Array) -> pa.Array:
    """Texts in their one form. Only one slice of a batch is held as Python objects at a time."""
    done: list[pa.Array] = []
    part: list[str | None] = []
    size = 0
    for t in texts:
        x = t.as_py()
        part.append(None if x is None else canonical(json.loads(x)))
        size += len(x or "")
        if size >= SLICE_CHARS:
            done.append(pa.array(part, texts.type))
            part, size = [], 0
    return pa.concat_arrays([*done, pa.array(part, texts.type)])


def with_canonical_json(df: DataFrame, columns: Sequence[str], name: str = "canonical") -> DataFrame:
    """df with `name`: its columns as one JSON object, keys sorted at every depth, numbers as numbers and nulls as null.

    Rows of plain values (ASCII text without control characters, whole numbers) are written by Spark alone; the others, and all
    rows where a column is nested, are rewritten in batches by Python. A float or double that is not a finite number fails the
    query. Decimals, dates and timestamps are written as text; floats as the double that they are.
    """
    types = dict(df.dtypes)
    values: list[Column] = []
    plain = F.lit(True)
    for c in sorted(columns):
        kind, v = types[c], F.col(f"`{c}`")
        if kind in ("float", "double"):
            v = v.cast("double")
            v = F.when(v.isNull() | (~F.isnan(v) & (F.abs(v) != float("inf"))), v).otherwise(F.raise_error(F.lit(f"{c}: no finite number")).cast("double"))
            plain = plain & F.coalesce((v == F.floor(v)) & (F.abs(v) < 1e7), F.lit(True))
        elif kind.startswith("decimal") or kind in ("date", "timestamp", "timestamp_ntz"):
            v = v.cast("string")
        elif kind not in _PLAIN:
            plain = F.lit(False)
        values.append(v.alias(c))
    text = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
    rows = df.select("*", text.alias("_json"), plain.alias("_plain"))
    # What is escaped by a number is a control character, whose digits differ.
    easy = F.col("_plain") & F.col("_json").rlike(r"^[\x20-\x7E]*$") & ~F.contains("_json", F.lit("\\u00"))
    rewritten = F.arrow_udf(_rewrite, "string")(F.when(~F.col("_easy"), F.col("_json")))
    return rows.withColumn("_easy", easy).withColumn(name, F.when(F.col("_easy"), F.col("_json")).otherwise(rewritten)).drop("_json", "_plain", "_easy")


def with_record_sha256(df: DataFrame, columns: Sequence[str], name: str = "record_sha256") -> DataFrame:
    """df with the sha256 of its canonical JSON."""
    return with_canonical_json(df, columns, name).withColumn(name, F.sha2(name, 256))
