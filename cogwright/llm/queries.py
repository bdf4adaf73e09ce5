"""The registered queries of the training-data operators: thin digests over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chroma, convtrie, divergence, hyperminhash, licenses, linededup, mixing, packing, quality, revisits, simhash, suffixdedup, tokenfiles
from .common import materialize, read_table


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of an edited copy, with their likeness."""
    return simhash.near_report(read_table(spark, sf_dir, "documents"), simhash.NEAR_RADIUS)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents the quality classifier keeps, with the rates of their sites."""
    return quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated strings of 100 bytes take away from each document."""
    return suffixdedup.remove_repeats(read_table(spark, sf_dir, "documents"), min_bytes=100).drop("kept")


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which response each not-modified capture of the pages confirms."""
    return revisits.revisit_report(spark, sf_dir)


def warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5_revisits over captures that went through the files of a web archive."""
    return revisits.archive_report(spark, sf_dir)


def op6_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 % of their three-word shingles."""
    return hyperminhash.near_duplicates(read_table(spark, sf_dir, "documents"), width=3, percent=85)


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of the sources by weights 5, 2, 1 takes of each document."""
    thin = mixing.keyed(read_table(spark, sf_dir, "documents")).select("_key", "_id", "_size", "_tie")
    return mixing.mix_report(materialize(thin, "sizes"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families that the paragraphs of each document name."""
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op9_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chroma fingerprints of the melodies that the embeddings stand for, and which sound alike."""
    vectors = read_table(spark, sf_dir, "embeddings").selectExpr("vec_id as rec_id", "embedding as vector")
    return chroma.recording_report(vectors)


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated runs of lines take away from each document."""
    return linededup.line_report(read_table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ in their words."""
    return divergence.divergence_report(read_table(spark, sf_dir, "documents"))


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document's ids stand in the token files, with their checksum, from the files."""
    return tokenfiles.token_report(read_table(spark, sf_dir, "documents"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return convtrie.conversation_trie(read_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pack": op1_pack,
        "op2_simhash": op2_simhash,
        "op3_quality": op3_quality,
        "op4_repeats": op4_repeats,
        "op5_revisits": op5_revisits,
        "op6_near": op6_near,
        "op7_mix": op7_mix,
        "op8_licenses": op8_licenses,
        "op9_chroma": op9_chroma,
        "op10_lines": op10_lines,
        "op11_divergence": op11_divergence,
        "op12_tokens": op12_tokens,
        "op13_trie": op13_trie,
        "warc_revisits": warc_revisits,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_revisits": revisits.REPORT_SQL, "op7_mix": mixing.REPORT_SQL, "op10_lines": linededup.REPORT_SQL, "op11_divergence": divergence.REPORT_SQL, "op13_trie": convtrie.REPORT_SQL, "warc_revisits": revisits.REPORT_SQL}
