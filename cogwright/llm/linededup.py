"""Removal of repeated runs of lines by winnowing, in DataFrame operations only.

Lines that hold only separators are passed over. Each window of `run` consecutive lines has a minimum, the first of its
least line hashes; the lines that are the minimum of some window are a document's fingerprints, and only they become
rows. Equal windows have equal minima at the same place in them, so every run of `run` lines that stands at two places
is guaranteed to have an equal fingerprint at both. Fingerprints are joined with those that stand at several places,
and each that does is extended both ways over the neighbouring lines that its row carries: to the windows whose minimum
it is. A window whose lines stand at an earlier place is a later copy, and chains of such windows are the repeated
runs. Matches are made with a content's first place and not with each other, so a line that very many documents share
is never expanded into pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import key_or_sentinel, materialize, text_or_empty

#: Lines that a repeated run has at least.
RUN_LINES = 2
#: A line of more words than this is a window of its own.
LONG_WORDS = 50


def _lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n", -1)


def _worded(lines: Column) -> Column:
    """(place, line) of the lines that hold more than separators."""
    return F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(r"[^\x20\x09-\x0D]"))


def _longer(line: Column, n: int) -> Column:
    """Whether a line has more than n words; possessive, so that each line is read once."""
    return line.rlike(rf"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){{{n}}}[^\x20\x09-\x0D]")


def fingerprints(docs: DataFrame, run: int, long_words: int | None = None) -> DataFrame:
    """(_id, _sub, at, mark, from, around, wins): the winnowed lines, with what they can be extended over.

    at, mark: a line's number among those with words, and its hash; around: the hashes of the lines from number `from`
    on that its windows reach to; wins: first line and length of the windows whose minimum it is. Windows are `run`
    lines, and each line of more than long_words words, if given.
    """
    lines = docs.select("_id", "_sub", _worded(_lines()).alias("x"))
    hashes = lines.select("_id", "_sub", F.transform("x", lambda s: F.xxhash64(s["x"])).alias("h"), *([] if long_words is None else [F.transform("x", lambda s: _longer(s["x"], long_words)).alias("long")]))
    hashes = hashes.filter(F.size("h") >= (run if long_words is None else 1))
    starts = F.filter(F.sequence(F.lit(0), F.size("h") - 1), lambda k: k <= F.size("h") - run)

    def least(k: Column) -> Column:
        w = F.slice("h", k + 1, run)
        return (k + F.array_position(w, F.array_min(w)) - 1).cast("int")

    owned = hashes.select("*", F.transform(starts, lambda k: F.struct(least(k).alias("at"), k.cast("int").alias("k"), F.lit(run).alias("n"))).alias("o"))
    if long_words is not None and run > 1:
        alone = F.transform(F.filter(F.sequence(F.lit(0), F.size("h") - 1), lambda i: F.get(F.col("long"), i)), lambda i: F.struct(i.cast("int").alias("at"), i.cast("int").alias("k"), F.lit(1).alias("n")))
        owned = owned.withColumn("o", F.array_sort(F.concat("o", alone)))
    # Windows are in the order of their minima, so a fingerprint's windows are neighbours: at most `run` and one more.
    first = F.filter(F.transform("o", lambda w, i: F.struct(w["at"].alias("at"), i.alias("i"))), lambda p: (p["i"] == 0) | (F.get(F.col("o"), p["i"] - 1)["at"] != p["at"]))

    def print_of(p: Column) -> Column:
        low = F.greatest(p["at"] - (run - 1), F.lit(0))
        wins = F.filter(F.slice("o", p["i"] + 1, run + 1), lambda w: w["at"] == p["at"])
        return F.struct(
            p["at"].alias("at"), F.get(F.col("h"), p["at"]).alias("mark"), low.alias("from"), F.slice("h", low + 1, p["at"] - low + run).alias("around"),
            F.transform(wins, lambda w: F.struct(w["k"].alias("k"), w["n"].alias("n"))).alias("wins"),
        )

    owned = owned.select("_id", "_sub", "h", "o", first.alias("first"))
    return owned.select("_id", "_sub", F.explode(F.transform("first", print_of)).alias("p")).select("_id", "_sub", "p.*")


def repeated_runs(docs: DataFrame, run: int = RUN_LINES, long_words: int | None = None) -> DataFrame:
    """(_id, _sub, first, last): maximal runs of lines that later windows cover."""
    prints = materialize(fingerprints(docs, run, long_words), "fingerprints")
    marks = prints.groupBy("mark").agg(F.min(F.struct("_id", "_sub", "at")).alias("lo"), F.max(F.struct("_id", "_sub", "at")).alias("hi")).filter("lo <> hi").select("mark")
    likely = prints.join(marks, "mark").select("_id", "_sub", "from", "around", F.explode("wins").alias("w"))
    content = F.xxhash64(F.slice("around", F.col("w.k") - F.col("from") + 1, F.col("w.n")))
    reached = materialize(likely.select("_id", "_sub", F.col("w.k").alias("k"), F.col("w.n").alias("n"), content.alias("content")), "windows")
    place = F.struct("_id", "_sub", "k")
    firsts = reached.groupBy("content").agg(F.min(place).alias("first"), F.count("*").alias("places")).filter("places > 1").select("content", "first")
    later = reached.join(firsts, "content").filter(place > F.col("first")).select("_id", "_sub", "k", (F.col("k") + F.col("n") - 1).alias("end"))
    by_doc = Window.partitionBy("_id", "_sub").orderBy("k", "end")
    fresh = F.when(F.col("k") > F.max("end").over(by_doc.rowsBetween(Window.unboundedPreceding, -1)) + 1, 1).otherwise(0)
    chained = later.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)))
    return chained.groupBy("_id", "_sub", "_run").agg(F.min("k").alias("first"), F.max("end").alias("last")).drop("_run")


def drop_repeated_lines(docs: DataFrame, run: int = RUN_LINES, long_words: int | None = None) -> DataFrame:
    """Each row of docs as the struct _row, with _kept (the text without later copies of repeated runs), _n_lines, _n_removed and _n_runs.

    A window of `run` lines is a later copy if its lines stand, in this order, at an earlier place: in a document of
    smaller doc_id, or further up in the same one. With long_words, a line of more words is a window of its own. All lines of later copies go; lines that hold only separators count
    as no lines and stay. A null text is empty; a null doc_id comes first. Several texts with one doc_id are separate
    documents in the order of a hash; rows that repeat both are one document, and each gets its result. An empty table
    gives no rows. docs must read the same each time.
    """
    rows = docs.select(F.struct("*").alias("_row"), key_or_sentinel("doc_id").alias("_id"), text_or_empty().alias("_text"))
    repeats = not rows.groupBy("_id").count().filter("count > 1").isEmpty()
    rows = rows.withColumn("_sub", F.xxhash64("_text") if repeats else F.lit(0).cast("long"))
    runs = repeated_runs(rows.select("_id", "_sub", F.col("_text").alias("text")), run, long_words)
    runs = runs.groupBy("_id", "_sub").agg(F.collect_list(F.sequence("first", "last")).alias("_runs"))
    joined = rows.join(runs, ["_id", "_sub"], "left")
    lines = _lines("_text")
    worded = F.transform(_worded(lines), lambda s: s["i"])
    gone = F.transform(F.flatten("_runs"), lambda k: F.get(F.col("_worded"), k))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    joined = joined.withColumn("_worded", worded).withColumn("_gone", gone)
    kept = F.when(F.col("_runs").isNull(), F.col("_text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get(F.col("_all"), i)), "\n"))
    none = F.col("_runs").isNull()
    return joined.withColumn("_all", lines).select(
        "_row",
        F.size("_worded").cast("long").alias("_n_lines"),
        F.when(none, 0).otherwise(F.size("_gone")).cast("long").alias("_n_removed"),
        F.when(none, 0).otherwise(F.size("_runs")).cast("long").alias("_n_runs"),
        kept.alias("_kept"),
    )


def line_report(docs: DataFrame, run: int = RUN_LINES, long_words: int | None = LONG_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs, kept_sha256 of every document."""
    out = drop_repeated_lines(docs.select("doc_id", "text"), run, long_words)
    return out.select("_row.doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), F.col("_n_runs").alias("n_runs"), F.sha2("_kept", 256).alias("kept_sha256"))


def remove_lines(docs: DataFrame, run: int = RUN_LINES, long_words: int | None = LONG_WORDS) -> DataFrame:
    """docs with the repeated runs and repeated long lines taken out of text; documents of which no line is left are dropped, if they had any.

    n_chars, where docs has it, follows the new text.
    """
    out = drop_repeated_lines(docs, run, long_words).filter("_n_removed = 0 or _n_removed < _n_lines")
    changed = F.col("_n_removed") > 0
    new = {"text": F.when(changed, F.col("_kept")).otherwise(F.col("_row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.char_length("_kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars"))
    return out.select(*(new.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


#: DuckDB SQL for line_report over `documents`, for runs of two lines, lines of over 50 words, and unique ids.
REPORT_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
worded AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS k
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
wins AS (
  SELECT doc_id, k, line AS a, lead(line) OVER (PARTITION BY doc_id ORDER BY k) AS b FROM worded),
later AS (
  SELECT doc_id, k FROM (
    SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, k) AS n FROM wins WHERE b IS NOT NULL) WHERE n > 1),
long AS (
  SELECT doc_id, k FROM (
    SELECT doc_id, k, row_number() OVER (PARTITION BY a ORDER BY doc_id, k) AS n FROM wins
    WHERE len(regexp_extract_all(a, '[^\\x20\\x09-\\x0D]+')) > 50) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, k FROM later UNION ALL SELECT doc_id, k + 1 FROM later UNION ALL SELECT doc_id, k FROM long)),
flagged AS (
  SELECT w.doc_id, w.k, w.i, g.k IS NOT NULL AS g FROM worded w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.k = g.k),
counted AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (g) AS n_removed, count(*) FILTER (g AND NOT p) AS n_runs
  FROM (SELECT *, coalesce(lag(g) OVER (PARTITION BY doc_id ORDER BY k), false) AS p FROM flagged) GROUP BY doc_id),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS kept
  FROM lines l LEFT JOIN flagged f ON l.doc_id = f.doc_id AND l.i = f.i WHERE NOT coalesce(f.g, false) GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
