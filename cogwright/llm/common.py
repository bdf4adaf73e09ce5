"""Shared helpers of the training-data operators: scratch tables, table access and array kernels."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranges import range_cuts, range_of  # noqa: F401  (the operators have them from here)

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: The same separators as a regular expression for JVM functions.
SPACE_RE = r"[\x20\x09-\x0D]+"
#: Stand-in for a null document id inside an operator, so that joins and ordering work; nulls come back in results.
NULL_ID = -(2**63)

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MULT_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**64 - 1, size=256, dtype=np.uint64)


_OWN_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; only a local session without one gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_ROOTS:
            _OWN_ROOTS[app] = tempfile.mkdtemp(prefix="spark-scratch-")
        root = _OWN_ROOTS[app]
    return root.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def key_or_sentinel(c: str | Column) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("long"), F.lit(NULL_ID))


def key_or_null(c: str | Column) -> Column:
    return F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(NULL_ID))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), in place on a copy."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def powers(mult: np.uint64, n: int) -> np.ndarray:
    """mult**0 .. mult**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    done = 1
    with np.errstate(over="ignore"):
        step = np.uint64(mult)
        while done < n:
            m = min(done, n - done)
            out[done : done + m] = out[:m] * step
            step = step * step
            done += m
    return out[:n]


class SpanHasher:
    """Hashes of many byte spans of one buffer: a polynomial prefix sum over random byte codes, then a finaliser."""

    _pow = np.ones(1, dtype=np.uint64)
    _inv = np.ones(1, dtype=np.uint64)

    def __init__(self, data: np.ndarray) -> None:
        n = len(data) + 1
        cls = SpanHasher
        if len(cls._pow) < n:
            cls._pow, cls._inv = powers(_MULT, 2 * n), powers(_MULT_INV, 2 * n)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(n, dtype=np.uint64)
            np.cumsum(_TABLE[data] * cls._pow[: n - 1], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (self.sums[ends] - self.sums[starts]) * SpanHasher._inv[starts]
            x += (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return mix64(x)


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte buffer; words are runs without the six separators."""
    edge = np.empty(len(data) + 2, dtype=np.int8)
    edge[0] = edge[-1] = 0
    edge[1:-1] = ~_IS_SPACE[data]
    d = np.diff(edge)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def batch_buffer(texts: list, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """One byte buffer for many texts, each followed by a line feed; offsets has one more entry than texts."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(b) + 1 for b in raw], out=offsets[1:])
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8) if raw else np.zeros(0, dtype=np.uint8)
    return (_LOWER[data] if lower else data), offsets


def slices(texts: list, limit: int = 4_000_000) -> list[tuple[int, int]]:
    """Index ranges of a batch such that each has about `limit` characters or one long text."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > limit:
            out.append((start, i))
            start, size = i, 0
        size += n
    if start < len(texts):
        out.append((start, len(texts)))
    return out
