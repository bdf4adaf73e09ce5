"""Web archives made from the pages, read whole by splits and capture by capture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scratch import scratch_path, written
from ..sources.archives import index_lines, read_captures, scan_archives, write_archive
from ..sources.documents import capture_index
from .base import query, table

#: Small, so that archives of the fixture's size are dealt over several tasks too.
SPLIT = 256 << 10
HOST_SQL = "lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1))"


def page_archive(spark: SparkSession, d: str) -> str:
    """The path of an archive that has each page as a response."""
    path = scratch_path(spark, "archive")
    pages = table(spark, d, "pages").select(
        F.lit("response").alias("kind"), "url", F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured_at"),
        F.concat(F.lit("urn:page:"), F.col("page_id").cast("string")).alias("record_id"), F.lit(200).alias("status"), F.create_map(F.lit("content-type"), F.lit("text/html")).alias("headers"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("body"),
    )
    write_archive(pages.repartition(4, "url"), path)
    return path


def _shape(members: DataFrame) -> DataFrame:
    page = F.regexp_extract("record_id", r"(\d+)>$", 1).cast("long")
    return members.select(page.alias("page_id"), "url", "captured_at", "status", F.octet_length("body").cast("long").alias("n_bytes"), F.sha2("body", 256).alias("body_sha256"), "error")


PAGES_SQL = "SELECT page_id, url, strftime(to_timestamp(1700000000 + page_id) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS captured_at, 200 AS status, strlen(coalesce(html, '')) AS n_bytes, sha256(coalesce(html, '')) AS body_sha256, CAST(NULL AS VARCHAR) AS error FROM pages"


@query("s8_archive_scan", PAGES_SQL)
def s8(spark: SparkSession, d: str) -> DataFrame:
    """Records of archives that are read by splits of bytes."""
    return _shape(scan_archives(spark, page_archive(spark, d), SPLIT))


@query("s4_archive_ranges", PAGES_SQL)
def s4(spark: SparkSession, d: str) -> DataFrame:
    """Each capture by its own bytes, from the places that an index of the archive has."""
    members = scan_archives(spark, page_archive(spark, d), SPLIT)
    index = written(members.filter("error is null").select(F.col("file").alias("filename"), "offset", "length"), "archive-index")
    return _shape(read_captures(index))


@query("s7_capture_index", f"WITH first AS (SELECT min({HOST_SQL}) AS host FROM pages) SELECT url, '200' AS status, count(*) AS n FROM pages, first WHERE {HOST_SQL} = host AND NOT regexp_matches(lower(url), '[?&](vin|q)=') GROUP BY url")
def s7(spark: SparkSession, d: str) -> DataFrame:
    """Captures of one host from index lines, each line twice, those of one place once, without vehicle numbers."""
    lines = written(index_lines(scan_archives(spark, page_archive(spark, d), SPLIT)), "archive-index")
    host = table(spark, d, "pages").agg(F.min(F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#:]+)", 1)))).first()[0] or ""
    return capture_index(lines.unionByName(lines), host, "", ("vin", "q")).groupBy("url", "status").agg(F.count("*").alias("n"))
