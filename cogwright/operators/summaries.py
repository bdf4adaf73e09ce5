"""Summaries kept by increments: one row of partial sums for each artifact, put in, replaced and withdrawn without a recount.

Counts add, extremes compare and sketches of distinct values unite, so totals come from the artifacts' rows, which are few
beside the rows they stand for. What can't be subtracted, such as an extreme, need not be: an artifact's row goes with it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("dataset", "artifact")


def partial_sums(rows: DataFrame, counters: Mapping[str, Column], extremes: Sequence[str] = (), distinct: Sequence[str] = ()) -> DataFrame:
    """(dataset, artifact, n_rows, a column for each counter, min_ and max_ of the extremes, sketch_ of distinct columns) of rows with dataset and artifact.

    A counter counts the rows for which its condition holds; unknown is no. Sketches leave nulls out.
    """
    aggs = [F.count("*").alias("n_rows"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counters.items())]
    aggs += [f(c).alias(f"{p}_{c}") for c in extremes for p, f in (("min", F.min), ("max", F.max))]
    aggs += [F.hll_sketch_agg(F.col(c).cast("string")).alias(f"sketch_{c}") for c in distinct]
    return rows.groupBy(*KEYS).agg(*aggs)


def put(kept: DataFrame, new: DataFrame) -> DataFrame:
    """kept with the partial sums of new artifacts, in place of those that they had. Putting the same again changes nothing."""
    return kept.join(new.select(*KEYS), list(KEYS), "left_anti").unionByName(new)


def withdraw(kept: DataFrame, artifacts: DataFrame) -> DataFrame:
    """kept without these artifacts (dataset, artifact)."""
    return kept.join(artifacts.select(*KEYS).distinct(), list(KEYS), "left_anti")


def totals(kept: DataFrame) -> DataFrame:
    """(dataset, artifacts, the sums, extremes and distinct_ estimates) over the partial sums."""
    aggs = [F.count("*").alias("artifacts")]
    for c in kept.columns:
        if c in KEYS:
            continue
        if c.startswith("sketch_"):
            aggs.append(F.hll_sketch_estimate(F.hll_union_agg(c)).alias("distinct_" + c.removeprefix("sketch_")))
        elif c.startswith(("min_", "max_")):
            aggs.append((F.min if c.startswith("min_") else F.max)(c).alias(c))
        else:
            aggs.append(F.sum(c).alias(c))
    return kept.groupBy("dataset").agg(*aggs)


def readiness(sums: DataFrame, blocking: Mapping[str, Sequence[str]]) -> DataFrame:
    """(dataset, ready, reasons): a dataset is ready if it has rows and none of the counters that block it; reasons name those that do.

    blocking: reason to counters, any of which gives it.
    """
    found = [F.when(sum((F.coalesce(F.col(c), F.lit(0)) for c in columns), F.lit(0)) > 0, F.lit(r)) for r, columns in blocking.items()]
    reasons = F.array_compact(F.array(F.when(F.col("n_rows") == 0, F.lit("empty")), *found))
    return sums.select("dataset", (F.size(reasons) == 0).alias("ready"), reasons.alias("reasons"))
