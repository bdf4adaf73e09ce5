"""JSON documents, capture indexes, sitemaps, register grids and stored pages."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank


def json_documents(texts: DataFrame, required: Sequence[str] = (), context: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of (source, value): objects with Results and Count, whose length must equal Count.

    Each element is a map of texts; one without a required field is a reject, and so is a whole document whose count
    is wrong or that is no such object. Context columns are put into each payload.
    """
    doc = texts.withColumn("d", F.from_json("value", "struct<Count:int,Message:string,Results:array<map<string,string>>>"))
    bad = F.when(F.col("d.Results").isNull(), "not_a_document").when(~F.col("d.Count").eqNullSafe(F.size("d.Results")), "count_mismatch")
    doc = doc.withColumn("error", bad)
    rows = doc.filter("error is null").select("source", F.posexplode("d.Results").alias("position", "payload"))
    extra = F.create_map(*(F.lit(x) for kv in (context or {}).items() for x in kv)) if context else None
    if extra is not None:
        names = list(context or {})
        rows = rows.withColumn("payload", F.map_concat(F.map_filter("payload", lambda k, v: ~k.isin(*names)), extra))
    missing = F.lit(False)
    for c in required:
        missing = missing | is_blank(F.element_at("payload", c))
    rows = rows.withColumn("error", F.when(F.col("payload").isNull(), "not_an_object").when(missing, "missing_field"))
    rejects = doc.filter("error is not null").select("source", F.lit(None).cast("int").alias("position"), "error").unionByName(rows.filter("error is not null").select("source", "position", "error"))
    return rows.filter("error is null").select("source", "position", "payload"), rejects


def capture_index(lines: DataFrame, host: str, path: str, vin_keys: Sequence[str] = ("vin",)) -> DataFrame:
    """Captures of one host and path from index lines (file, line, value of JSON), without those whose query carries a VIN.

    Of several lines for one place (filename, offset, length) the first is kept.
    """
    fields = "struct<url:string,status:string,digest:string,timestamp:string,filename:string,offset:string,length:string>"
    rows = lines.withColumn("r", F.from_json("value", fields)).select("file", "line", "r.*").filter("url is not null")
    rows = rows.filter((F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#:]+)", 1)) == host) & F.regexp_extract("url", r"^[A-Za-z]+://[^/?#]+([^?#]*)", 1).rlike(path))
    rows = rows.filter(~F.lower("url").rlike(r"[?&](" + "|".join(vin_keys) + ")="))
    rows = rows.withColumn("collection", F.regexp_extract("filename", r"crawl-data/([^/]+)/", 1))
    w = Window.partitionBy("filename", "offset", "length").orderBy("file", "line")
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def sitemap_urls(texts: DataFrame) -> DataFrame:
    """(source, kind, url) of (source, value): page URLs of sitemaps and nested sitemaps of indexes."""
    kind = F.when(F.xpath_string("value", F.lit("local-name(/*)")) == "sitemapindex", "sitemap").otherwise("page")
    urls = F.xpath("value", F.lit("//*[local-name()='loc']/text()"))
    return texts.select("source", kind.alias("kind"), F.explode(urls).alias("url")).withColumn("url", F.trim("url")).filter("url <> ''")


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """(source, kind, url) of sitemap files, gzipped or not; a file that can't be unpacked has no rows."""

    def run(batches):
        for pdf in batches:
            out = []
            for source, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    raw = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                except (OSError, EOFError, zlib.error):
                    continue
                out.append((source, raw.decode("utf-8", "replace")))
            yield pd.DataFrame(out, columns=["source", "value"])

    return sitemap_urls(spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "source string, value string"))


def nested_sitemaps(found: DataFrame, texts: DataFrame, depth: int = 3) -> DataFrame:
    """(url) of all pages that sitemaps lead to, indexes followed up to `depth` levels among the texts at hand.

    found: rows of sitemap_urls to start from; texts: (source, value) of nested sitemaps by their URL.
    """
    pages = found.filter("kind = 'page'").select("url")
    todo = found.filter("kind = 'sitemap'").select(F.col("url").alias("source")).distinct()
    for _ in range(depth):
        inner = sitemap_urls(texts.join(todo, "source", "left_semi"))
        pages = pages.unionByName(inner.filter("kind = 'page'").select("url"))
        todo = inner.filter("kind = 'sitemap'").select(F.col("url").alias("source")).distinct()
    return pages.distinct()


def stored_pages(responses: DataFrame, bodies: DataFrame, max_status: int = 400) -> DataFrame:
    """Responses with their bodies by content hash, without errors and challenges."""
    return responses.filter((F.col("status") < max_status) & ~F.coalesce(F.col("challenged"), F.lit(False))).join(bodies, "body_sha256")


def grid_rows(rows: DataFrame, column: str, required: Sequence[str]) -> DataFrame:
    """Rows of name-to-value maps with their required columns; fails on the driver if the first row lacks one."""
    first = rows.select(F.map_keys(column).alias("k")).limit(1).collect()
    if first and (missing := set(required) - set(first[0]["k"] or [])):
        raise ValueError(f"missing columns: {sorted(missing)}")
    return rows.select("*", *(F.element_at(column, c).alias(c) for c in required))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
