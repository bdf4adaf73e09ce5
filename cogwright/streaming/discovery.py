"""URLs that a crawl run discovers: each once a run, however late or often they are seen, and the edges they were found by.

What a run has seen is keyed state that lives as long as the run: no watermark and no clock decides what is dropped. A run that
ends frees its state; what arrives for it afterwards is handed on as late.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.urls import normalize_url

#: Parts of a run's URLs, by hash, each of which has its own state: a run is dealt over as many tasks.
PARTS = 64
FOUND = "kind string, run_id long, url string, parent string, method string, seen_at timestamp"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _key(*parts: str) -> str:
    return hashlib.sha256("\x1f".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


class FirstSeen(StatefulProcessor):
    """First rows of a part of a run: kinds `url` and `edge`, and `late` for rows of a run that has ended.

    An edge is (parent, url, method); one without a parent is no repetition of another, as null keys equal none.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getMapState("seen", "key string", "n int")
        self._over = handle.getValueState("over", "at timestamp")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer_values: object) -> Iterator[pd.DataFrame]:  # noqa: N802
        over, ends = self._over.exists(), None
        for pdf in rows:
            last = pdf.loc[pdf["url"].isna(), "seen_at"].max()
            ends = last if ends is None or (pd.notna(last) and last > ends) else ends
            asked = pdf[pdf["url"].notna()].sort_values(["seen_at", "url"], kind="stable")
            out = []
            for url, parent, method, seen_at in asked[["url", "parent", "method", "seen_at"]].itertuples(index=False, name=None):
                row = (key[0], url, None if pd.isna(parent) else parent, None if pd.isna(method) else method, seen_at)
                if over:
                    out.append(("late", *row))
                    continue
                if self._first(_key("u", url)):
                    out.append(("url", *row))
                if row[2] is None or self._first(_key("e", row[2], url, row[3] or "")):
                    out.append(("edge", *row))
            if out:
                yield pd.DataFrame(out, columns=["kind", "run_id", "url", "parent", "method", "seen_at"])
        if ends is not None and pd.notna(ends) and not over:
            self._seen.clear()
            self._over.update((ends.to_pydatetime(),))

    def _first(self, key: str) -> bool:
        if self._seen.containsKey((key,)):
            return False
        self._seen.updateValue((key,), (1,))
        return True

    def close(self) -> None:
        pass


def discovered(rows: DataFrame, ends: DataFrame | None = None) -> DataFrame:
    """(kind, run_id, url, parent, method, seen_at) of a stream of the same without kind, and of ends (run_id, ended_at).

    URLs are normalised, and those that are none are left out. Within a run each URL gives one row of kind `url`, the first
    that arrives, and each edge one of kind `edge`. An end counts after the rows that arrive with it.
    """
    asked = rows.select("run_id", normalize_url("url").alias("url"), "parent", "method", "seen_at").filter("url is not null")
    asked = asked.withColumn("part", F.pmod(F.xxhash64("url"), F.lit(PARTS)).cast("int"))
    if ends is not None:
        none = F.lit(None).cast("string")
        over = ends.select("run_id", none.alias("url"), none.alias("parent"), none.alias("method"), F.col("ended_at").alias("seen_at"), F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
        asked = asked.unionByName(over)
    return asked.groupBy("run_id", "part").transformWithStateInPandas(statefulProcessor=FirstSeen(), outputStructType=FOUND, outputMode="Append", timeMode="None")


def write_discovered(found: DataFrame, out_dir: str, checkpoint: str) -> StreamingQuery:
    """All that has arrived, appended as Parquet by kind. The state is kept in RocksDB below the checkpoint."""
    conf, name = found.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, STATE_STORE)  # a query takes its settings when it starts
    try:
        return found.writeStream.partitionBy("kind").format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            conf.unset(name)
        else:
            conf.set(name, before)


def stream_discovered(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, ends_dir: str | None = None) -> StreamingQuery:
    """discovered() over files of (run_id, url, parent, method, seen_at), and of (run_id, ended_at)."""
    rows = spark.readStream.schema("run_id long, url string, parent string, method string, seen_at timestamp").parquet(in_dir)
    ends = spark.readStream.schema("run_id long, ended_at timestamp").parquet(ends_dir) if ends_dir else None
    return write_discovered(discovered(rows, ends), out_dir, checkpoint)
