"""Chroma fingerprints of recordings and the search for recordings that sound alike.

Frames of a recording become energies of twelve pitch classes. Filters over areas of that image, read from an integral
image, compare neighbouring areas; each gives two bits, and sixteen of them make a 32-bit integer for each position.
Recordings with equal fingerprints are one class. Classes are found by keys of their windows: each key reads some bits
of the signs that the filters have over twelve positions, which differ half the time between unrelated recordings and
seldom between like ones. Equal keys vote for a difference of positions; the votes make a histogram of offsets, and
every offset with votes is confirmed by the share of bits that differ along it. Chance matches of a key are as rare as
its bits make them, so the candidates grow with the links and not with the pairs.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import key_or_null, key_or_sentinel, materialize

RATE = 2048
FRAME = 512
HOP = 256
SPAN = 8
QUERY_EVERY = 50
#: Share of bits that may differ along an alignment, and positions that it covers at least.
BIT_ERRORS = 0.15
LEAST_POSITIONS = 12
#: Windows of the index: every STRIDE-th one and the last have TABLES keys of KEY_BITS bits; queries probe with all of theirs.
STRIDE = 4
TABLES = 12
KEY_BITS = 28
#: Alignments of few positions lie at the ends of both recordings: the first and last windows have more, wider keys.
EDGE_TABLES = 32
EDGE_BITS = 24
#: Queries that are looked up together, about; and parts into which the rows of every key are dealt.
BLOCK = 200
SALTS = 16
#: Filters: (kind, first pitch class, classes, first frame, frames); the kind tells which halves are compared.
FILTERS = [(kind, low, high, 0, SPAN) for kind in ("time", "pitch") for low, high in ((0, 12), (0, 6), (6, 6), (0, 4), (4, 4), (8, 4), (2, 8), (3, 6))]
CUTS = (-0.2, 0.0, 0.2)


def chroma(pcm: np.ndarray, rate: int = RATE) -> np.ndarray:
    """(frames, 12) pitch-class energies, each frame scaled to unit length; silent frames are zero."""
    if len(pcm) < FRAME:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(pcm, FRAME)[::HOP] * np.hanning(FRAME)
    power = np.abs(np.fft.rfft(frames, axis=1)) ** 2
    hz = np.fft.rfftfreq(FRAME, 1 / rate)
    use = (hz > 60) & (hz < rate / 2)
    pitch = np.round(12 * np.log2(hz[use] / 440.0)).astype(int) % 12
    out = power[:, use] @ np.eye(12)[pitch]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.where(norm > 1e-9, out / np.maximum(norm, 1e-9), 0.0)


def fingerprint(image: np.ndarray) -> np.ndarray:
    """One unsigned 32-bit integer for each position of the window of SPAN frames."""
    n = len(image) - SPAN + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint32)
    integral = np.zeros((len(image) + 1, 13))
    integral[1:, 1:] = image.cumsum(axis=0).cumsum(axis=1)
    at = np.arange(n)

    def area(t0: int, t1: int, c0: int, c1: int) -> np.ndarray:
        return integral[at + t1, c1] - integral[at + t0, c1] - integral[at + t1, c0] + integral[at + t0, c0]

    code = np.zeros(n, dtype=np.uint32)
    for kind, low, classes, t0, frames in FILTERS:
        if kind == "time":
            a, b = area(t0, t0 + frames // 2, low, low + classes), area(t0 + frames // 2, t0 + frames, low, low + classes)
        else:
            half = low + classes // 2
            a, b = area(t0, t0 + frames, low, half), area(t0, t0 + frames, half, low + classes)
        x = np.log((a + 1e-3) / (b + 1e-3))
        level = np.searchsorted(CUTS, x).astype(np.uint32)
        code = (code << np.uint32(2)) | (level ^ (level >> np.uint32(1)))  # neighbouring levels differ in one bit
    return code


def recording_of(vector: np.ndarray) -> np.ndarray:
    """A melody that a vector stands for: each value a note of an eighth of a second, after its place in the range."""
    v = np.nan_to_num(np.asarray(vector, dtype=np.float64))
    if not len(v):
        return np.zeros(0)
    note = np.floor((np.tanh(3 * v) + 1) * 11.99).astype(int)
    t = np.arange(RATE // 8) / RATE
    tones = np.sin(2 * np.pi * (220.0 * 2.0 ** (np.arange(25)[:, None] / 12)) * t)
    return tones[np.clip(note, 0, 24)].reshape(-1)


def fingerprint_rows(vectors: DataFrame) -> DataFrame:
    """(rec_id, codes array<long>) of rows (rec_id, vector) with ids that aren't null; a null vector gives no codes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes = [fingerprint(chroma(recording_of([] if v is None else v))).astype(np.int64) for v in pdf["vector"]]
            yield pd.DataFrame({"rec_id": pdf["rec_id"], "codes": codes})

    return vectors.mapInPandas(run, "rec_id long, codes array<long>")


@functools.cache
def _readers() -> tuple[np.ndarray, np.ndarray]:
    """For the inner tables and those of the ends: weights (signs of a window, tables) that read each table's bits as one number."""
    rng = np.random.Generator(np.random.PCG64(11))
    out = []
    for tables, bits in ((TABLES, KEY_BITS), (EDGE_TABLES, EDGE_BITS)):
        weights = np.zeros((LEAST_POSITIONS * len(FILTERS), tables))
        for t in range(tables):
            weights[rng.choice(len(weights), bits, replace=False), t] = 2.0 ** np.arange(bits)
        out.append(weights)
    return out[0], out[1]


def window_keys(codes: np.ndarray, asked: bool) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a recording's windows and where they start: those of the index, or those that a query probes it with."""
    count = len(codes) - LEAST_POSITIONS + 1
    if count < 1:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
    # The first of a filter's two bits tells which half has more energy.
    signs = (codes.astype(np.int64)[:, None] >> np.arange(2 * len(FILTERS) - 1, 0, -2)) & 1
    windows = np.lib.stride_tricks.sliding_window_view(signs, LEAST_POSITIONS, axis=0).transpose(0, 2, 1).reshape(count, -1).astype(np.float64)
    inner, ends = _readers()
    at = np.arange(count)
    keys, places = [], []

    def put(where: np.ndarray, weights: np.ndarray, first_table: int) -> None:
        table = np.arange(first_table, first_table + weights.shape[1], dtype=np.int64) << 32
        keys.append((table + (windows[where] @ weights).astype(np.int64)).reshape(-1))
        places.append(np.repeat(where, weights.shape[1]).astype(np.int32))

    put(at if asked else at[(at % STRIDE == 0) | (at == count - 1)], inner, 0)
    # What begins near a query's end may be a recording's first window, and the other way round.
    put(at[-STRIDE:] if asked else at[:1], ends, TABLES)
    put(at[:STRIDE] if asked else at[-1:], ends, TABLES + EDGE_TABLES)
    return np.concatenate(keys), np.concatenate(places)


def _keyed(classes: DataFrame, asked: bool) -> DataFrame:
    """(class_id, key, at) of the windows of rows (class_id, codes)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [window_keys(np.asarray(c, dtype=np.int64), asked) for c in pdf["codes"]]
            yield pd.DataFrame({"class_id": pdf["class_id"], "keys": [k for k, _ in found], "ats": [a for _, a in found]})

    rows = classes.select("class_id", "codes").mapInPandas(run, "class_id long, keys array<long>, ats array<int>")
    return rows.select("class_id", F.explode(F.arrays_zip("keys", "ats")).alias("x")).select("class_id", F.col("x.keys").alias("key"), F.col("x.ats").alias("at"))


def _shifts(hits: DataFrame) -> DataFrame:
    """(q, c, shifts) of rows (c, qs, q_ats, c_ats): offsets in the order of their votes, from lists of queries with their places."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out: dict[str, list] = {"q": [], "c": [], "shifts": []}
            for c, qs, q_ats, c_ats in zip(pdf["c"], pdf["qs"], pdf["q_ats"], pdf["c_ats"], strict=True):
                q = np.concatenate(list(qs))
                shift = np.concatenate(list(q_ats)).astype(np.int64) - np.repeat(np.asarray(c_ats, dtype=np.int64), [len(x) for x in qs])
                ids, q = np.unique(q, return_inverse=True)
                low = int(shift.min())
                width = int(shift.max()) - low + 1
                cell, votes = np.unique(q * width + (shift - low), return_counts=True)
                who, shift = cell // width, cell % width + low
                by = np.lexsort((shift, np.abs(shift), -votes, who))
                cuts = np.searchsorted(who[by], np.arange(len(ids) + 1))
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if ids[i] != c:
                        out["q"].append(ids[i])
                        out["c"].append(c)
                        out["shifts"].append(shift[by[a:b]].astype(np.int32))
            yield pd.DataFrame(out)

    return hits.mapInPandas(run, "q long, c long, shifts array<int>")


def _alignments(candidates: DataFrame) -> DataFrame:
    """The first alignment of (q, c, shifts, q_codes, c_codes) that is long enough and has few bit errors, if there is one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for q, c, shifts, a, b in zip(pdf["q"], pdf["c"], pdf["shifts"], pdf["q_codes"], pdf["c_codes"], strict=True):
                a, b = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)
                for shift in map(int, shifts):
                    i = max(0, shift)
                    n = min(len(a) - i, len(b) - (i - shift))
                    if n < LEAST_POSITIONS:
                        continue
                    errors = float(np.bitwise_count(a[i : i + n] ^ b[i - shift : i - shift + n]).sum()) / (32 * n)
                    if errors <= BIT_ERRORS:
                        out.append((q, c, shift, errors, n))
                        break
            yield pd.DataFrame(out, columns=["q", "c", "shift", "bit_errors", "covered"])

    return candidates.mapInPandas(run, "q long, c long, shift int, bit_errors double, covered long")


def alike(prints: DataFrame, query_every: int = QUERY_EVERY) -> DataFrame:
    """(q, c, shift, bit_errors, covered): classes that sound like a class with a queried recording, itself left out.

    prints: (rec_id, class_id, codes). Of the offsets of a pair that have votes, the first in their order that covers
    LEAST_POSITIONS with at most BIT_ERRORS is given. Every class is in the index, and every key is followed, however
    many classes have it: queries go in blocks, so what meets in one row is bounded by a block's queries.
    """
    classes = prints.groupBy("class_id").agg(F.first("codes").alias("codes"), F.max(F.coalesce(F.col("rec_id") % query_every == 0, F.lit(False))).alias("asked"))
    classes = materialize(classes.filter(F.size("codes") >= LEAST_POSITIONS), "classes")
    asked = classes.filter("asked")
    blocks = asked.count() // BLOCK + 1
    block = F.pmod(F.xxhash64("class_id"), F.lit(blocks)).alias("block")
    q = _keyed(asked, True).groupBy("key", block).agg(F.collect_list(F.struct("class_id", "at")).alias("asks"))
    q = q.select("key", "block", F.col("asks.class_id").alias("q"), F.col("asks.at").alias("q_at"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    c = _keyed(classes, False).select(F.col("class_id").alias("c"), "key", F.col("at").alias("c_at"), F.pmod(F.xxhash64("class_id"), F.lit(SALTS)).cast("int").alias("salt"))
    hits = c.join(q, ["key", "salt"]).groupBy("c", "block").agg(F.collect_list(F.struct("q", "q_at", "c_at")).alias("hits"))
    shifts = _shifts(hits.select("c", F.col("hits.q").alias("qs"), F.col("hits.q_at").alias("q_ats"), F.col("hits.c_at").alias("c_ats")))
    codes = classes.select("class_id", "codes")
    both = shifts.join(codes.select(F.col("class_id").alias("q"), F.col("codes").alias("q_codes")), "q").join(codes.select(F.col("class_id").alias("c"), F.col("codes").alias("c_codes")), "c")
    return _alignments(both)


def recording_report(vectors: DataFrame) -> DataFrame:
    """rec_id, n_codes, fingerprint_sha256, class_id (least rec_id with the same fingerprint), n_links.

    n_links counts the other recordings that sound alike, for those whose id is divisible by QUERY_EVERY; others have
    null. A null, empty or very short vector has no codes: such recordings are one class and have no links. Rows that
    repeat an id count each. An empty table gives no rows.
    """
    rows = materialize(fingerprint_rows(vectors.select(key_or_sentinel("rec_id").alias("rec_id"), "vector")), "prints")
    digest = F.sha2(F.array_join(F.transform("codes", lambda c: c.cast("string")), ","), 256)
    rows = rows.withColumn("fingerprint_sha256", digest)
    classes = materialize(rows.groupBy("fingerprint_sha256").agg(F.min("rec_id").alias("class_id"), F.count("*").alias("members")), "class-sizes")
    prints = materialize(rows.join(classes, "fingerprint_sha256"), "labelled")
    links = alike(prints).join(classes.select(F.col("class_id").alias("c"), "members"), "c").groupBy(F.col("q").alias("class_id")).agg(F.sum("members").alias("others"))
    out = prints.join(links, "class_id", "left")
    own = F.when(F.size("codes") > 0, F.col("members") - 1).otherwise(F.lit(0))
    n_links = F.when(F.col("rec_id") % QUERY_EVERY == 0, F.coalesce("others", F.lit(0)) + own)
    return out.select(key_or_null("rec_id").alias("rec_id"), F.size("codes").cast("long").alias("n_codes"), "fingerprint_sha256", key_or_null("class_id").alias("class_id"), n_links.alias("n_links"))
