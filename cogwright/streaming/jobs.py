"""Incremental jobs over file drops, each resumable from its checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import insert_new, last_per_key


def _read(spark: SparkSession, in_dir: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(in_dir)


def stream_insert_new(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: str, keys: Sequence[str]) -> StreamingQuery:
    """Rows whose key is not in the output yet (records of captures, versions of records); a batch that is run again adds nothing."""

    def put(batch: DataFrame, epoch: int) -> None:
        try:
            old = batch.sparkSession.read.schema(schema).parquet(out_dir)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            old = batch.sparkSession.createDataFrame([], schema)
        insert_new(old, batch, keys).select(*batch.columns).write.mode("append").parquet(out_dir)

    return _read(spark, in_dir, schema).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_upsert(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: str, keys: Sequence[str], order: Sequence[str]) -> StreamingQuery:
    """Upserts in versions: each batch's last row by key is appended with its epoch; latest() reads the table."""

    def put(batch: DataFrame, epoch: int) -> None:
        last_per_key(batch, keys, order).withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(f"{out_dir}/batch={epoch}")

    return _read(spark, in_dir, schema).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, out_dir: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return last_per_key(spark.read.parquet(out_dir), keys, ["epoch", *order])


def stream_counters(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str) -> StreamingQuery:
    """Running page counters by run and status: counters that changed go to a folder of their batch; counters() reads them."""
    counts = _read(spark, in_dir, "run_id long, status string").groupBy("run_id", "status").count()

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")

    return counts.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counters(spark: SparkSession, out_dir: str) -> DataFrame:
    """(run_id, status, count): the last value of each counter."""
    return spark.read.parquet(out_dir).groupBy("run_id", "status").agg(F.max_by("count", "epoch").alias("count"))


def stream_late_captures(spark: SparkSession, in_dir: str, jobs: DataFrame, out_dir: str, checkpoint: str) -> StreamingQuery:
    """Captures with `accepted`: fetched within their job's time and five minutes of grace; the rest go to a partition of their own, none are dropped."""
    rows = _read(spark, in_dir, "job_id long, url string, fetched_at timestamp")
    j = rows.join(jobs, "job_id", "left")
    ok = (F.col("fetched_at") >= F.col("started_at")) & (F.col("fetched_at") <= F.col("finished_at") + F.expr("INTERVAL 5 MINUTES"))
    accepted = F.coalesce(ok, F.lit(False))
    # A partition column comes back as text, so the flag stays a column of the rows.
    out = j.select("job_id", "url", "fetched_at", accepted.alias("accepted"), F.when(accepted, "accepted").otherwise("late").alias("side"))
    return out.writeStream.partitionBy("side").format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
