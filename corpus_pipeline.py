"""A training corpus from `documents`: quality filter, line dedup, near-dedup, mixing and packing, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cogwright.llm import hyperminhash, linededup, mixing, packing, quality
from cogwright.llm.common import key_or_sentinel, materialize, read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, with their own columns.

    A null text is an empty one; null ids, sources or languages and repeated rows are judged each on its own, and rows that agree fall or
    stay together. Where nothing is labelled nothing is rejected.
    """
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated runs of lines, with their own columns.

    A document that loses all its lines goes; null and empty texts have none to lose and stay. A null id comes before all
    others, and of rows with one id the first in the order of a hash keeps its lines; rows that agree in both stay or go together.
    """
    return linededup.remove_lines(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five words a shingle, similarity 0.8. It is the one with the least id.

    Documents without words are in no group and stay. Rows that share an id, null ids too, are one document here: they stay or go together.
    """
    groups = hyperminhash.near_duplicates(docs, width=5, percent=80)
    gone = groups.filter("not kept").select(key_or_sentinel("doc_id").alias("_id")).distinct()
    return docs.select(F.struct("*").alias("_row"), key_or_sentinel("doc_id").alias("_id")).join(gone, "_id", "left_anti").select("_row.*")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: no row, or up to three copies of it.

    A null source is one of its own. Texts without words have no size and take no part. Ties go by a hash of the text, so reruns agree.
    """
    return mixing.mix_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every copy of every document, in sequences of 1024 tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are an end id alone; long ones are cut. Copies and rows with one id, or none, are packed each on its own.
    """
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("line dedup", lines_stage),
    ("near dedup", near_stage),
    ("mixing", mix_stage),
    ("packing", pack_stage),
]

#: The trained classifier and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; each result is written to shared scratch and read again.

    An empty table gives no rows. Further columns of documents, whatever they are called, go through all stages but the last.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
