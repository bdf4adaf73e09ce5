"""Gates: rules over a table, counted in one pass, and what must be empty before anything is published."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """A gate did not pass; nothing was written."""


def check(df: DataFrame, rules: Mapping[str, Column], key: str | Column) -> DataFrame:
    """(rule, n_bad, sample_key): for each rule the rows that break it, and the least key among them. One aggregation."""
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    aggs = []
    for name, bad in rules.items():
        broken = F.coalesce(bad, F.lit(False))
        aggs += [F.count_if(broken).alias(f"{name}__n"), F.min(F.when(broken, k)).alias(f"{name}__k")]
    if not rules:
        return df.sparkSession.createDataFrame([], "rule string, n_bad long, sample_key string")
    one = df.agg(*aggs)
    rows = F.array(*(F.struct(F.lit(n).alias("rule"), F.coalesce(F.col(f"{n}__n"), F.lit(0)).alias("n_bad"), F.col(f"{n}__k").alias("sample_key")) for n in rules))
    return one.select(F.explode(rows).alias("r")).select("r.*")


def require_empty(violations: DataFrame) -> None:
    """Raise if a rule is broken; at most twenty rules are named."""
    bad = violations.filter("n_bad > 0").limit(20).collect()
    if bad:
        raise GateError("; ".join(f"{r['rule']}: {r['n_bad']} (such as {r['sample_key']})" for r in bad))


def gated(df: DataFrame, flag: DataFrame) -> DataFrame:
    """All rows of df if the one-row frame `flag` (ok boolean) holds true, else none: fail closed, one plan."""
    ok = flag.agg(F.coalesce(F.bool_and("ok"), F.lit(False)).alias("_ok"))
    return df.join(F.broadcast(ok), F.lit(True)).filter("_ok").drop("_ok")


def orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of child with a key that parent lacks; a null key is no reference."""
    condition = reduce(lambda a, b: a & b, [F.col(f"c.{c}") == F.col(f"p.{p}") for c, p in on.items()])
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    return child.filter(whole).alias("c").join(parent.alias("p"), condition, "left_anti")


def foreign_keys(tables: Mapping[str, DataFrame], keys: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """(rule, n_bad) for each (child, column, parent, column)."""
    parts = [orphans(tables[c], tables[p], {cc: pc}).agg(F.count("*").alias("n_bad")).select(F.lit(f"{c}.{cc}").alias("rule"), "n_bad") for c, cc, p, pc in keys]
    return reduce(DataFrame.unionByName, parts)


def closure(known: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Known identities that a run has not seen."""
    return known.select(*keys).distinct().join(seen.select(*keys).distinct(), list(keys), "left_anti")


def identity_closure(known: DataFrame, parsed: DataFrame, uid: str, code: str) -> DataFrame:
    """(uid, missing, missing_codes, downgraded): uids that are gone, codes that are gone, and uids left with an empty code only."""
    k = known.groupBy(uid).agg(F.collect_set(code).alias("_known"))
    p = parsed.groupBy(uid).agg(F.collect_set(code).alias("_parsed"))
    j = k.join(p, uid, "left")
    empty = F.array(F.lit(""))
    gone = F.array_sort(F.array_except(F.array_except("_known", F.coalesce("_parsed", F.array().cast("array<string>"))), empty))
    return j.select(uid, F.col("_parsed").isNull().alias("missing"), gone.alias("missing_codes"), (F.col("_parsed").isNotNull() & (F.size(F.array_except("_parsed", empty)) == 0) & (F.size(F.array_except("_known", empty)) > 0)).alias("downgraded"))


def dataset_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (n_rows, digest) that does not depend on the order of rows; repeated rows count.

    Rows are length-prefixed lines. Four parts of each line's sha256 are summed as numbers, and the digest is that of
    the sums and the number of rows: sums combine before they are shuffled, so no task holds more than one row of them.
    """
    from ..functions.records import length_prefixed

    lines = df.select(F.sha2(length_prefixed(columns), 256).alias("h"))
    sums = [F.sum(F.conv(F.substring("h", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).cast("string").alias(f"s{i}") for i in range(4)]
    one = lines.agg(F.count("*").alias("n_rows"), *sums)
    return one.select("n_rows", F.sha2(F.concat_ws(":", F.col("n_rows").cast("string"), *(F.coalesce(f"s{i}", F.lit("0")) for i in range(4))), 256).alias("digest"))
