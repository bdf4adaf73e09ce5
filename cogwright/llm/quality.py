"""Quality filter: document classifiers, combined with what their sites are like (hierarchical empirical Bayes).

Two logistic regressions (low quality, toxic) read hashed words and a few shape measures of a whole text. Their
rejection probabilities, or labels where there are any, are summed by host and by path. Host rates shrink towards the
global rate and path rates towards their host's, each by a beta prior whose strength is estimated from how much the
rates vary. A document's odds, its label's or else its classifiers', are then moved by how its path's odds differ from
the global odds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SpanHasher, batch_buffer, key_or_null, key_or_sentinel, materialize, slices, text_or_empty

#: Bits of a hashed feature; two words seldom have the same.
FEATURE_BITS = 48
#: Labelled documents that the classifiers are fitted on, at most: those with the least hashes of their ids.
TRAIN_ROWS = 6000
#: Newton steps, at most.
ROUNDS = 40
#: Hashed features of each classifier: texts that have one at least, standard errors that it must tell by, how many there are at most, and the penalty on weights.
LEAST_TEXTS = 3
CERTAIN = 4.0
WORDS = 1000
RIDGE = 0.1
#: How probable a label is to be right: it takes the place of the classifiers' odds for its document.
LABEL_TRUST = 0.99
PREFIX = 5
SHAPES = 8
HEADS = ("low_quality", "toxic")

_LETTER = np.zeros(256, dtype=bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def features(texts: list) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct hashed words and word prefixes of each text, and its shape measures; a text without words has none."""
    data, offsets = batch_buffer(texts, lower=False)
    lower = np.where(_UPPER[data], data + 32, data).astype(np.uint8)
    mask = np.zeros(len(data) + 2, dtype=np.int8)
    mask[1:-1] = _LETTER[data]
    edge = np.diff(mask)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.searchsorted(starts, offsets)
    hasher = SpanHasher(lower)
    words = hasher.spans(starts, ends)
    drop = np.uint64(64 - FEATURE_BITS)
    prefixes = hasher.spans(starts, np.minimum(ends, starts + PREFIX)) ^ np.uint64(0x5851F42D4C957F2D)
    long_enough = ends - starts > PREFIX
    sums = {}
    for name, table in (("upper", _UPPER), ("letter", _LETTER), ("space", _SPACE)):
        sums[name] = np.concatenate(([0], np.cumsum(table[data], dtype=np.int64)))
    bars = np.concatenate(([0], np.cumsum(data == 124, dtype=np.int64)))
    ids, shapes = [], np.zeros((len(texts), SHAPES), dtype=np.float64)
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        lo, hi = offsets[i], offsets[i + 1] - 1
        w = words[a:b]
        if not len(w):
            ids.append(np.zeros(0, dtype=np.int64))
            continue
        distinct = np.unique(w)
        more = prefixes[a:b][long_enough[a:b]]
        ids.append(np.unique(np.concatenate([distinct, more]) >> drop).astype(np.int64))
        n, letters = len(w), max(1, sums["letter"][hi] - sums["letter"][lo])
        odd = (hi - lo) - letters - (sums["space"][hi] - sums["space"][lo])
        again = float((w[1:] == w[:-1]).mean()) if n > 1 else 0.0
        shapes[i] = (1.0, (sums["upper"][hi] - sums["upper"][lo]) / letters, odd / n, (bars[hi] - bars[lo]) / n, 1 - len(distinct) / n, again, np.log1p(n) / 8, letters / n / 8)
    return ids, shapes


@dataclass
class Model:
    """Weights of both heads over the hashed features that tell (in order), and over standardised shapes."""

    used: np.ndarray
    hashed: np.ndarray  # (2, features)
    shaped: np.ndarray  # (2, SHAPES)
    mean: np.ndarray
    scale: np.ndarray

    def logits(self, ids: list[np.ndarray], shapes: np.ndarray) -> np.ndarray:
        """(texts, 2)"""
        z = ((shapes - self.mean) / self.scale) @ self.shaped.T
        row, at = _places(ids, self.used)
        for h in range(2):
            z[:, h] += np.bincount(row, weights=self.hashed[h, at], minlength=len(ids))
        return z


def _places(ids: list[np.ndarray], used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which texts have which of the features in `used`, as pairs of text and place."""
    flat = np.concatenate([*ids, np.zeros(0, dtype=np.int64)])
    row = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    if not len(used):
        return row[:0], row[:0]
    at = np.minimum(np.searchsorted(used, flat), len(used) - 1)
    hit = used[at] == flat
    return row[hit], at[hit]


def _telling(words: np.ndarray, texts: np.ndarray, hits: np.ndarray, n: int, bad: int) -> np.ndarray:
    """The hashed features that texts to be rejected have much more often than others, in order.

    words: the features, with the number of texts that have each and how many of those are to be rejected, of n texts
    of which `bad` are. At least CERTAIN standard errors, and the strongest WORDS of them.
    """
    if not 0 < bad < n:
        return np.zeros(0, dtype=np.int64)
    share = (texts + 1) / (n + 2)
    z = (hits / bad - (texts - hits) / (n - bad)) / np.sqrt(share * (1 - share) * (1 / bad + 1 / (n - bad)))
    z[texts < LEAST_TEXTS] = 0
    best = np.lexsort((words, -z))[:WORDS]
    return np.sort(words[best[z[best] >= CERTAIN]])


def telling(ids: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
    """For both heads, the features of these texts that tell."""
    words, at = np.unique(np.concatenate([*ids, np.zeros(0, dtype=np.int64)]), return_inverse=True)
    row = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    texts = np.bincount(at, minlength=len(words))
    return [_telling(words, texts, np.bincount(at, weights=y[row], minlength=len(words)), len(y), int(y.sum())) for y in labels.T]


def fit(ids: list[np.ndarray], shapes: np.ndarray, labels: np.ndarray, words: list[np.ndarray] | None = None, rounds: int = ROUNDS) -> Model:
    """Both regressions by Newton's method with a ridge penalty; labels: (texts, 2) of 0 or 1.

    Of the hashed features only those are used that tell by themselves (words, if given): a regression on all of them
    would learn its few thousand texts by heart.
    """
    words = telling(ids, labels) if words is None else words
    mean, scale = shapes.mean(axis=0), shapes.std(axis=0) + 1e-6
    mean[0], scale[0] = 0.0, 1.0
    model = Model(np.union1d(*words), np.zeros((2, 0)), np.zeros((2, SHAPES)), mean, scale)
    model.hashed = np.zeros((2, len(model.used)))
    for h in range(2):
        y = labels[:, h].astype(np.float64)
        x = np.zeros((len(ids), SHAPES + len(words[h])))
        x[:, :SHAPES] = (shapes - mean) / scale
        row, at = _places(ids, words[h])
        x[row, SHAPES + at] = 1.0
        ridge = np.full(x.shape[1], RIDGE)
        ridge[0] = 1e-3
        w = np.zeros(x.shape[1])

        def loss(w: np.ndarray) -> float:
            z = x @ w  # noqa: B023
            return float(np.logaddexp(0, z).sum() - y @ z + (ridge * w * w).sum() / 2)  # noqa: B023

        now = loss(w)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
            size = 1.0
            while size > 1e-4 and loss(w - size * step) > now:
                size /= 2
            w = w - size * step
            before, now = now, loss(w)
            if before - now < 1e-6 * (1 + abs(now)):
                break
        model.shaped[h] = w[:SHAPES]
        model.hashed[h, np.searchsorted(model.used, words[h])] = w[SHAPES:]
    return model


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | None:
    """A model from a bounded sample of labelled documents; None if there are none.

    At most train_rows labels are used, each with one text: of several texts with a label's doc_id the least.
    """
    chosen = labels.filter("doc_id is not null and quality is not null and toxic is not null").select(F.col("doc_id").alias("_id"), "quality", "toxic")
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id", "quality", "toxic").limit(train_rows).withColumn("_label", F.monotonically_increasing_id())
    rows = docs.select(F.col("doc_id").alias("_id"), text_or_empty().alias("text")).join(F.broadcast(chosen), "_id")
    rows = rows.groupBy("_label").agg(F.min("text").alias("text"), F.first("quality").alias("quality"), F.first("toxic").alias("toxic"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, shapes = features(pdf["text"].tolist())
            yield pd.DataFrame({"bad": (pdf["quality"] == 0).astype("int32"), "toxic": (pdf["toxic"] == 1).astype("int32"), "ids": ids, "shapes": list(shapes)})

    texts = materialize(rows.mapInPandas(run, "bad int, toxic int, ids array<long>, shapes array<double>"), "training")
    total = texts.agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), F.sum("toxic").alias("toxic")).first()
    if not total["n"]:
        return None
    # Features are counted by the executors; the driver gets counts of at most train_rows texts, and what tells of each text.
    found = texts.select("bad", "toxic", F.explode("ids").alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"), F.sum("toxic").alias("toxic"))
    found = found.filter(F.col("n") >= LEAST_TEXTS).toPandas()
    words = [_telling(found["word"].to_numpy(), found["n"].to_numpy(), found[h].to_numpy(), total["n"], total[h]) for h in ("bad", "toxic")]
    used = np.union1d(*words)

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(ids=[x[np.isin(x, used)] for x in pdf["ids"]])

    got = texts.mapInPandas(short, texts.schema).toPandas()
    return fit([np.asarray(x, dtype=np.int64) for x in got["ids"]], np.array(got["shapes"].tolist()), got[["bad", "toxic"]].to_numpy(), words)


def url_site(url: str | Column) -> tuple[Column, Column]:
    """Host and path level of a URL, for judge: the lower-case host, and the host with the first part of the path."""
    c = F.col(url) if isinstance(url, str) else url
    host = F.lower(F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return host, F.concat(host, F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*(/[^/?#]*)", 1))


def score(docs: DataFrame, model: Model | None, keys: list[str]) -> DataFrame:
    """(keys, logit): the log odds that a text is to be rejected by either head; 0 without words or model."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            parts = []
            for lo, hi in slices(texts, 1_000_000):
                ids, shapes = features(texts[lo:hi])
                z = np.clip(model.logits(ids, shapes), -30, 30) if model else np.zeros((hi - lo, 2))
                p = 1 - np.prod(1 / (1 + np.exp(z)), axis=1)
                p = np.clip(p, 1e-9, 1 - 1e-9)
                none = np.array([not len(x) for x in ids]) | (model is None)
                parts.append(np.where(none, np.nan, np.log(p) - np.log1p(-p)))
            out = pdf.drop(columns="text")
            out["logit"] = np.concatenate(parts) if parts else np.zeros(0)
            yield out

    schema = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    scored = docs.select(*keys, text_or_empty().alias("text")).mapInPandas(run, f"{schema}, logit double")
    return scored.withColumn("logit", F.when(F.isnan("logit"), F.lit(None)).otherwise(F.col("logit")))


def _strength(sites: DataFrame, n: str, s: str, centre: Column) -> float:
    """The strength of the beta prior: how many documents it weighs, from the spread of site rates (method of moments)."""
    rate = F.col(s) / F.col(n)
    x = sites.agg(F.sum(n).alias("n"), F.sum(F.col(n) * F.col(n)).alias("nn"), F.count("*").alias("k"), F.sum(F.col(n) * (rate - centre) * (rate - centre)).alias("spread"), F.sum(F.col(n) * centre * (1 - centre)).alias("noise")).first()
    if not x["n"]:
        return 1.0
    within = x["noise"] / x["n"]
    room = x["n"] - x["nn"] / x["n"]
    between = max(0.0, x["spread"] - (x["k"] - 1) * within) / room if room > 0 else 0.0
    return float(min(1e6, max(1.0, within / between - 1))) if between > 0 else 1e6


def site_rates(evidence: DataFrame) -> tuple[DataFrame, float]:
    """(host, path, documents, host_rate, path_rate) and the global rate, from rows of (host, path, p).

    Sums are made by path first and then by host, so a host that has a third of all documents is a few rows by then.
    """
    paths = materialize(evidence.groupBy("host", "path").agg(F.count("p").alias("n"), F.coalesce(F.sum("p"), F.lit(0.0)).alias("s"), F.count("*").alias("documents")), "paths")
    hosts = materialize(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s")), "hosts")
    total = hosts.agg(F.sum("host_n"), F.sum("host_s")).first()
    rate = (total[1] + 0.5) / (total[0] + 1.0) if total[0] else 0.5
    strength = _strength(hosts.filter("host_n > 0"), "host_n", "host_s", F.lit(rate))
    host_rate = (F.lit(strength * rate) + F.col("host_s")) / (F.lit(strength) + F.col("host_n"))
    both = materialize(paths.join(hosts.withColumn("host_rate", host_rate), "host"), "sites")
    inner = _strength(both.filter("n > 0"), "n", "s", F.col("host_rate"))
    path_rate = (F.lit(inner) * F.col("host_rate") + F.col("s")) / (F.lit(inner) + F.col("n"))
    return both.select("host", "path", "documents", "host_rate", path_rate.alias("path_rate")), rate


def judge(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, threshold: float = 0.5, keys: list[str] | None = None) -> DataFrame:
    """(keys, host, path, doc_score, host_rate, path_rate, reject_probability, kept) for every row of docs.

    docs: doc_id, text and the columns that host and path are made of (here source and lang); labels: doc_id, quality,
    toxic, of which several rows for a document count as the mean. A document without words has no evidence of its own
    and gets its path's rate (doc_score is null). A null host or path is a site of its own, other than an empty one.
    Without labels everything is kept. A null doc_id has no label, and a label with a null doc_id belongs to nothing;
    rows that repeat a doc_id are judged each by its text. Empty tables give no rows. docs must read the same each
    time; for rows with a URL, see url_site.
    """
    keys = keys or ["doc_id"]
    host = F.col("source") if host is None else host
    # A null part is told from an empty one by the sign before it.
    path = F.concat(*(F.coalesce(F.concat(F.lit(sign), F.col(c)), F.lit("?")) for sign, c in (("", "source"), ("/", "lang")))) if path is None else path
    model = train(docs, labels)
    named = docs.select(*keys, *(F.coalesce(F.concat(F.lit("="), c), F.lit("")).alias(name) for name, c in (("host", host), ("path", path))), "text")
    rows = named.withColumn("doc_id", key_or_sentinel("doc_id"))
    scored = score(rows, model, [*keys, "host", "path"])
    given = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.avg(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1.0).otherwise(0.0)).alias("label"))
    scored = materialize(scored.join(given, "doc_id", "left"), "scores")
    sites, rate = site_rates(scored.select("host", "path", F.coalesce("label", 1 / (1 + F.exp(-F.col("logit")))).alias("p")))
    odds = F.log(F.col("path_rate") / (1 - F.col("path_rate"))) - F.lit(float(np.log(rate / (1 - rate))))
    told = F.when(F.col("label").isNotNull(), F.least(F.greatest(F.col("label"), F.lit(1 - LABEL_TRUST)), F.lit(LABEL_TRUST)))
    base = F.coalesce(F.log(told / (1 - told)), F.col("logit"), F.lit(float(np.log(rate / (1 - rate)))))
    p = 1 / (1 + F.exp(-(base + odds)))
    out = scored.join(sites, ["host", "path"]).withColumn("reject_probability", p if model else F.lit(0.0))
    shown = [F.when(F.col(c) != "", F.expr(f"substring({c}, 2)")).alias(c) for c in ("host", "path")]
    return out.withColumn("doc_id", key_or_null("doc_id")).select(*keys, *shown, F.col("logit").alias("doc_score"), "host_rate", "path_rate", "reject_probability", (F.col("reject_probability") < threshold).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text, source, lang, ...) that are not rejected, with their columns."""
    mark = F.xxhash64(text_or_empty(), *(F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in ("source", "lang")))
    rows = docs.select(F.struct("*").alias("_row"), key_or_sentinel("doc_id").alias("_id"), mark.alias("_mark"))
    thin = docs.select("doc_id", "text", "source", "lang", mark.alias("_mark"))
    rejected = judge(thin, labels, keys=["doc_id", "_mark"]).filter("not kept").select(key_or_sentinel("doc_id").alias("_id"), "_mark").distinct()
    return rows.join(rejected, ["_id", "_mark"], "left_anti").select("_row.*")
