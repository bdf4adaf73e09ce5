"""How the sources of each language differ in their words: exact shares of terms, compared pair by pair.

A document's vector is a count of its terms, sparse and exact. Vectors are summed by language and source where they are made,
then by term over all tasks, and a language's vocabulary is what enough of its documents have: the steps of a
CountVectorizer with a minimum of documents and no limit of size, fitted for each language, but in one pass over all of
them and with the vocabulary in a table instead of the driver. Pairs of sources are compared by blocks of the
vocabulary, in which a term costs as many steps as there are sources that have it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

MIN_DOCUMENTS = 3
UNIT = 1_000_000_000
TOP_TERMS = 200
#: Terms of one language that are compared in one group.
BLOCK_TERMS = 1 << 12
#: Bytes of a text that are turned into terms at a time, and terms of all groups that a task sums before it hands them on.
SLICE_BYTES = 4_000_000
HELD_TERMS = 400_000

_LETTERS = np.full(256, 32, dtype=np.uint8)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_TABLE = _LETTERS.tobytes()


def document_vector(text: bytes) -> Counter[bytes]:
    """How often each term stands in a text: runs of the letters A-Z, in lower case, a-z and bytes beyond ASCII."""
    letters, vector, start = text.translate(_TABLE), Counter(), 0
    while start < len(letters):
        end = letters.find(b" ", start + SLICE_BYTES)
        vector.update(letters[start : end if end >= 0 else len(letters)].split())
        start = end + 1 if end >= 0 else len(letters)
    return vector


def summed_vectors(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df) summed over the documents' vectors as far as tasks can: n occurrences in df documents.

    Each group also has a row whose term is null, so that groups without terms are known.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "source", "term", "n", "df"]
        sums: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}

        def frame() -> pa.RecordBatch:
            sizes = [len(n) + 1 for n, _ in sums.values()]
            keys = [pa.array(np.repeat(np.array([k[i] for k in sums], dtype=object), sizes), pa.binary()).cast(pa.string()) for i in (0, 1)]
            terms = pa.array([t for n, _ in sums.values() for t in (*n, None)], pa.binary()).cast(pa.string())
            counts = [pa.array([x for pair in sums.values() for x in (*pair[i].values(), 0)], pa.int64()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([*keys, terms, *counts], names)

        held = 0
        for batch in batches:
            columns = [batch.column(c).cast(pa.binary()).to_pylist() for c in ("lang", "source", "text")]
            for lang, source, text in zip(*columns, strict=True):
                vector = document_vector(text)
                n, df = sums.setdefault((lang, source), (Counter(), Counter()))
                held -= len(n)
                n.update(vector)
                df.update(vector.keys())  # in the order of n: a term is new to both at once
                held += len(n)
                if held > HELD_TERMS:
                    yield frame()
                    sums, held = {}, 0
        if sums:
            yield frame()

    thin = docs.select(*(text_or_empty(c).alias(c) for c in ("lang", "source", "text")))
    return thin.mapInArrow(run, "lang string, source string, term string, n long, df long")


def kept_counts(sums: DataFrame) -> DataFrame:
    """(lang, source, term, n, everywhere, first) of the terms that enough documents of their language have.

    everywhere counts the term in the whole language; first is true for one of its rows. One shuffle by language and term.
    """
    dealt = sums.filter("term is not null").repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    of_term = Window.partitionBy("lang", "term")
    rows = dealt.withColumns({"everywhere": F.sum("n").over(of_term), "documents": F.sum("df").over(of_term), "first": F.col("source") == F.min("source").over(of_term)})
    return rows.filter(F.col("documents") >= MIN_DOCUMENTS).select("lang", "source", "term", "n", "everywhere", "first")


def _share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + size)), exact for counts of any size."""
    return 1 + F.call_function("div", (n + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), (total + size).cast("decimal(20,0)"))


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _floor_ratio(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _compare_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums over a block's terms for each pair of sources. Rows without a term give each source's share of a term it doesn't have."""
    marks = pdf[pdf["term"].isna()].sort_values("source")
    names, absent = marks["source"].to_numpy(), marks["p"].to_numpy()
    rows = pdf[pdf["term"].notna()]
    term, terms = pd.factorize(rows["term"])
    source, q = np.searchsorted(names, rows["source"].to_numpy()), rows["p"].to_numpy()
    order = np.argsort(source, kind="stable")
    term, source, q = term[order], source[order], q[order]
    edges = np.searchsorted(source, np.arange(len(names) + 1))
    full, starts = edges[:-1][edges[1:] > edges[:-1]], np.flatnonzero(edges[1:] > edges[:-1])
    out = []
    for g in range(len(names)):
        mine = slice(edges[g], edges[g + 1])
        p = np.full(len(terms), absent[g])
        p[term[mine]] = q[mine]
        # All terms as if the other source had none of them; then those it has, put right.
        kinds, times = np.unique(p, return_counts=True)
        sums = (_floor_ratio(kinds[:, None], absent[None, :]) * times[:, None]).sum(axis=0)
        right = _floor_ratio(p[term], q) - _floor_ratio(p[term], absent[source])
        if len(right):
            sums[starts] += np.add.reduceat(right, full)
        out.append(pd.DataFrame({"source": names[g], "item": names, "value": sums}))
    both = pd.concat(out, ignore_index=True)
    both.insert(0, "lang", pdf["lang"].iloc[0])
    return both[both["source"] != both["item"]]


def divergence_report(docs: DataFrame, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from each other one, and the terms it has more of.

    Each (lang, source) that occurs is a group, and each language is one too, for part `term`. Languages keep the terms in
    MIN_DOCUMENTS of their documents at least. A group's share of a term is p = 1 + floor(UNIT * (n + 1) / (N + V)); what it has
    beyond another's share q is floor((p - q)^2 / q), which part `pair` sums over all V terms (0 where there are none) and ranks, and
    part `term` gives for terms with n > 0 and p > q against the language, up to rank `top_terms`. Values descend, equal ones ascend by
    item. Null text, lang or source is empty; repeated rows count each; ids are not looked at. An empty table gives no rows.
    """
    summed = materialize(summed_vectors(docs), "vectors")
    counts = materialize(kept_counts(summed), "kept-counts")
    sizes = counts.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("all"))
    zero = F.lit(0).cast("long")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = summed.filter("term is null").select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = materialize(groups.select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("total", "v", "all"))), "groups")
    share = _share(F.col("n"), F.col("total"), F.col("v"))
    shares = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", share.alias("p"), _share(F.col("everywhere"), F.col("all"), F.col("v")).alias("q"), "v")

    # As many blocks as a language's vocabulary asks for; every source takes part in each of them.
    blocks = F.ceil(F.col("v") / BLOCK_TERMS)
    known = shares.select("lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), "term", "source", "p")
    absent = groups.filter("v > 0").select("lang", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), F.lit(None).cast("string").alias("term"), "source", _share(zero, F.col("total"), F.col("v")).alias("p"))
    sums = known.unionByName(absent).groupBy("lang", "block").applyInPandas(_compare_block, "lang string, source string, item string, value long")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(others, "lang").filter("source <> item").join(sums, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value"))
    ranking = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(ranking))

    more = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _excess(F.col("p"), F.col("q")).alias("value"))
    more = more.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= top_terms)
    return pairs.unionByName(more)


#: DuckDB SQL for divergence_report over `documents`.
REPORT_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
words AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT g.lang, g.source, coalesce(any_value(v), 0) AS v, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN sizes USING (lang) LEFT JOIN counts USING (lang, source) GROUP BY g.lang, g.source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + (1000000000 * CAST(coalesce(n, 0) + 1 AS HUGEINT)) // CAST(total + v AS HUGEINT) AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts USING (lang, source, term)),
usual AS (
  SELECT lang, term, 1 + (1000000000 * CAST(sum(n) + 1 AS HUGEINT)) // CAST(any_value(t.total + t.v) AS HUGEINT) AS q
  FROM counts JOIN (SELECT lang, sum(total) AS total, max(v) AS v FROM groups GROUP BY lang) t USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
             FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
more AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM shares JOIN usual USING (lang, term) WHERE n > 0 AND p > q),
both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL SELECT * FROM (SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM more) WHERE rank <= 200)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM both_parts
"""
