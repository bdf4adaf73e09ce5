"""Partial sums by artifact against full recounts."""

from pyspark.sql import functions as F

from cogwright.operators import summaries

SCHEMA = "dataset string, artifact long, k string, v int"


def test_put_replace_withdraw(spark):
    old = [("a", i % 7, f"k{i % 40}", i) for i in range(500)] + [("b", 1, None, None)]
    new = [("a", 3, f"k{i}", -i) for i in range(60)]
    sums = lambda rows: summaries.partial_sums(spark.createDataFrame(rows, SCHEMA), {"odd": F.col("v") % 2 == 1, "none": F.col("v").isNull()}, ["v"], ["k"])
    kept = summaries.put(summaries.put(sums(old), sums(new)), sums(new))
    kept = summaries.withdraw(kept, spark.createDataFrame([("a", 5), ("a", 99)], "dataset string, artifact long"))
    end = [r for r in old if not (r[0] == "a" and r[1] in (3, 5))] + new
    got = {r.dataset: r for r in summaries.totals(kept).collect()}
    a = [r for r in end if r[0] == "a"]
    assert (got["a"].artifacts, got["a"].n_rows, got["a"].odd, got["a"].min_v, got["a"].max_v) == (6, len(a), sum(r[3] % 2 for r in a if r[3] > 0), -59, 499)
    assert abs(got["a"].distinct_k - len({r[2] for r in a})) <= 2
    assert (got["b"].none, got["b"].odd, got["b"].min_v, got["b"].distinct_k) == (1, 0, None, 0)
    ready = {r.dataset: (r.ready, r.reasons) for r in summaries.readiness(summaries.totals(kept), {"gaps": ["none"], "odd": ["odd"]}).collect()}
    assert ready == {"a": (False, ["odd"]), "b": (False, ["gaps"])}
    assert summaries.totals(summaries.withdraw(kept, kept)).collect() == []
