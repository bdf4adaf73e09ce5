"""Near-duplicate classes by HyperMinHash sketches: compressed registers are banded, estimated, and then verified.

Each register keeps the leading-zero count and ten mantissa bits of a bucket's least hash (16 bits). A bucket has a
permutation of its own, so that short texts fill all registers. Four registers make a 64-bit band. Texts with equal
sets are one class from the start, so a group of copies costs one row in all that follows. Within a band's bucket a
class is first held against the bucket's most central class only (the one whose bands most others share); pairs
inside the bucket are looked at only where those links left it in several components, and only between its largest
component and the rest, and within the rest, so no bucket is expanded into its pairs. A parity sketch (which elements' hashed places are hit an odd number of
times) bounds the symmetric difference from below and keeps all but likely links from the confirmation on full sets.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import key_or_null, key_or_sentinel, materialize, mix64, slices, text_or_empty
from .components import connected_components
from .shingles import shingle_sets

BANDS = 24
ROWS = 4
REGISTERS = BANDS * ROWS
MANTISSA_BITS = 10
#: Standard errors that an estimate may lie below the threshold before a pair is given up.
MARGIN = 6.0
BAND_COLUMNS = [f"b{i}" for i in range(BANDS)]
PARITY_BITS = 1024
PARITY_COLUMNS = [f"p{i}" for i in range(PARITY_BITS // 64)]
SKETCH_COLUMNS = [*BAND_COLUMNS, *PARITY_COLUMNS]
#: Ids that are sent to all executors, at most (1.6 MB); more are joined by a shuffle.
BROADCAST_IDS = 200_000
#: Rows of one bucket that are compared with each other in one task, at most.
BLOCK = 20_000
#: Groups of so many rows are compared side by side; larger ones row by row.
FEW = 64


@functools.cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(7))
    flips = rng.integers(0, 2**64 - 1, size=REGISTERS, dtype=np.uint64)
    return flips, rng.integers(0, 2**64 - 1, size=REGISTERS, dtype=np.uint64) | np.uint64(1)


def compress(minima: np.ndarray) -> np.ndarray:
    """Leading-zero count and the mantissa bits after the leading one, as 16 bits."""
    bits = np.zeros(minima.shape, dtype=np.uint64)
    x = minima.copy()
    for step in (32, 16, 8, 4, 2, 1):
        high = x >= (np.uint64(1) << np.uint64(step))
        bits += np.where(high, np.uint64(step), np.uint64(0))
        x = np.where(high, x >> np.uint64(step), x)
    zeros = np.uint64(63) - bits
    aligned = minima << zeros  # the leading one at the top
    mantissa = (aligned >> np.uint64(63 - MANTISSA_BITS)) & np.uint64(2**MANTISSA_BITS - 1)
    return (zeros << np.uint64(MANTISSA_BITS)) | mantissa


def sketch_bands(sets: list[np.ndarray]) -> np.ndarray:
    """One row of packed bands for each non-empty set."""
    flips, odd = _permutations()
    joined = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1])).astype(np.int64)
    registers = np.empty((len(sets), REGISTERS), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(REGISTERS):
            registers[:, j] = np.minimum.reduceat((joined ^ flips[j]) * odd[j], starts)
    packed = compress(registers).reshape(len(sets), BANDS, ROWS)
    shifts = np.array([48, 32, 16, 0], dtype=np.uint64)
    return np.bitwise_or.reduce(packed << shifts, axis=2)


@functools.cache
def collision_rate(n_a: int, n_b: int) -> float:
    """The chance that registers of disjoint sets of these sizes agree: it is subtracted from the share that agrees."""
    k = np.arange(0, 63, dtype=float)[:, None]
    m = np.arange(0, 2**MANTISSA_BITS, dtype=float)[None, :]
    low = 2.0 ** -(k + 1) * (1 + m / 2**MANTISSA_BITS)
    high = 2.0 ** -(k + 1) * (1 + (m + 1) / 2**MANTISSA_BITS)
    p = [np.exp(n * np.log1p(-low)) - np.exp(n * np.log1p(-np.minimum(high, 1 - 1e-16))) for n in (n_a, n_b)]
    return float((p[0] * p[1]).sum())


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """128 bits for each set, whatever the order: two sums of mixed hashes."""
    out = np.zeros((2, len(sets)), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i, s in enumerate(sets):
            if len(s):
                out[0, i] = np.add.reduce(mix64(s))
                out[1, i] = np.add.reduce(mix64(s ^ np.uint64(0x5851F42D4C957F2D)))
    return out.view(np.int64)


def _by_batch(docs: DataFrame, width: int, schema: str, more) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["doc_id"].to_numpy()
            for lo, hi in slices(texts, 1_000_000):
                sets = shingle_sets(texts[lo:hi], width)
                sig = signatures(sets)
                base = {"doc_id": ids[lo:hi], "n": [len(s) for s in sets], "sig_a": sig[0], "sig_b": sig[1]}
                yield pd.DataFrame(base | more(sets))

    return docs.mapInPandas(run, f"doc_id long, n long, sig_a long, sig_b long, {schema}")


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, sig_a, sig_b, b0..b23): set size, 128 bits that identify the set, and the bands (zero for empty sets)."""

    def more(sets: list[np.ndarray]) -> dict:
        bands = np.zeros((len(sets), BANDS), dtype=np.uint64)
        if full := [i for i, s in enumerate(sets) if len(s)]:
            bands[full] = sketch_bands([sets[i] for i in full])
        columns = [*np.ascontiguousarray(bands.T).view(np.int64), *parities(sets).T]
        return dict(zip(SKETCH_COLUMNS, columns, strict=True))

    return _by_batch(docs, width, ", ".join(f"{c} long" for c in SKETCH_COLUMNS), more)


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, which of PARITY_BITS places an odd number of its elements hash to, as longs."""
    out = np.zeros((len(sets), PARITY_BITS), dtype=np.uint8)
    for i, s in enumerate(sets):
        if len(s):
            out[i] = np.bincount((s & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(out, axis=1).view(np.int64)


def set_rows(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, sig_a, sig_b, set) with the distinct shingle hashes."""
    return _by_batch(docs, width, "set array<long>", lambda sets: {"set": [s.view(np.int64) for s in sets]})


def agreeing(left: str, right: str) -> Column:
    """How many of the registers of two rows agree, from their packed bands."""
    total = None
    for c in BAND_COLUMNS:
        x = F.col(f"{left}.{c}").bitwiseXOR(F.col(f"{right}.{c}"))
        for shift in (0, 16, 32, 48):
            mask = 0xFFFF << shift
            other = (x.bitwiseAND(F.lit(mask - 2**64 if mask >= 2**63 else mask).cast("long")) != 0).cast("int")
            total = other if total is None else total + other
    return F.lit(REGISTERS) - total


def differing(left: str, right: str) -> Column:
    """Places where two parity sketches differ: never more than the symmetric difference has elements."""
    total = F.lit(0)
    for c in PARITY_COLUMNS:
        total = total + F.bit_count(F.col(f"{left}.{c}").bitwiseXOR(F.col(f"{right}.{c}")))
    return total


def _most_differing(n: str, percent: int) -> Column:
    """How many places may differ between similar enough sets, the larger of which has `n` elements.

    That is the symmetric difference which the threshold allows, or MARGIN standard errors above the places that so
    many elements are expected to leave odd, if that is less. It grows with n.
    """
    most = 2 * F.col(n) * F.lit((100 - percent) / (100 + percent))
    m = float(PARITY_BITS)
    expected = F.lit(m / 2) * (1 - F.exp(-2 * most / m))
    return F.floor(F.least(most + 1e-9, expected + F.lit(MARGIN) * F.sqrt(F.lit(m / 4) * (1 - F.exp(-4 * most / m))) + 1))


def _least_agreeing(threshold: float) -> int:
    """Registers that must agree: the corrected estimate may lie MARGIN standard errors below the threshold."""
    floor = threshold - MARGIN * (threshold * (1 - threshold) / REGISTERS) ** 0.5
    c = collision_rate(1000, 1000)
    return int(np.floor((floor * (1 - c) + c) * REGISTERS))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents whose shingle sets have 100 * intersection >= percent * union.

    Words are runs other than space, tab, LF, VT, FF, CR, after lower-casing A-Z; a text of fewer than `width` words
    is one shingle; one without words (or null) has an empty set and links with nothing. Every link is confirmed on
    the full sets. Returns for each row of docs: doc_id, n_shingles, component_id (the least doc_id reachable), kept
    (doc_id = component_id). Rows that repeat a doc_id get their own text's result; a null doc_id counts as the least
    id and comes back as null. An empty table gives no rows; columns besides doc_id and text are ignored.
    """
    docs = docs.select(key_or_sentinel("doc_id").alias("doc_id"), text_or_empty().alias("text"))
    sketch = materialize(sketches(docs, width), "sketches")
    key = ["sig_a", "sig_b", "n"]
    classes = sketch.filter("n > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"), *(F.first(c).alias(c) for c in SKETCH_COLUMNS))
    # A doc_id with several texts could stand for several classes: a class is named by its least id and its signature.
    classes = materialize(classes.withColumn("cls", F.xxhash64("rep", *key)), "classes")
    component = _components(docs, classes, width, percent)
    # cls is a hash; the least doc_id of each component is wanted.
    named = component.join(classes.select(F.col("cls").alias("node"), "rep"), "node")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = classes.select(*key, "rep", F.col("cls").alias("node")).join(component, "node", "left").join(least, "component", "left")
    of_class = of_class.select(*key, F.coalesce("component_id", "rep").alias("component_id"))
    out = sketch.select("doc_id", *key).join(of_class, key, "left")
    comp = F.coalesce("component_id", "doc_id")
    return out.select(key_or_null("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), key_or_null(comp).alias("component_id"), (F.col("doc_id") == comp).alias("kept"))


def _components(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, component) of the classes that have a confirmed link."""
    need = _least_agreeing(percent / 100)
    # Different sets can be similar enough only from a size on: one shingle of n + 1 may differ.
    banded = classes.filter(F.col("n") * (100 - percent) >= percent).select("cls", F.posexplode(F.array(*BAND_COLUMNS)).alias("band", "value"))
    banded = banded.select("cls", "band", F.xxhash64("band", "value").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    members = materialize(banded.join(sizes, "bucket"), "members")
    central = members.groupBy("cls").agg(F.sum("members").alias("weight"))
    leaders = members.join(central, "cls").groupBy("bucket").agg(F.max_by("cls", F.struct("weight", "cls")).alias("leader"))
    stars = members.join(leaders, "bucket").filter("cls <> leader").select(F.col("cls").alias("a"), F.col("leader").alias("b")).distinct()
    slim = classes.select("cls", "n", _most_differing("n", percent).alias("most"), *SKETCH_COLUMNS)

    def fits(a: str, b: str) -> Column:
        small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
        return (100 * small >= percent * large) & (differing(a, b) <= F.greatest(f"{a}.most", f"{b}.most"))

    stars = stars.join(slim.alias("x"), F.col("a") == F.col("x.cls")).join(slim.alias("y"), F.col("b") == F.col("y.cls"))
    stars = materialize(stars.filter(fits("x", "y") & (agreeing("x", "y") >= need)).select("a", "b"), "stars")
    sets = materialize(_sets_of(docs, classes, stars.select(F.col("a").alias("cls")).union(stars.select("b")).distinct(), width), "sets")
    found = materialize(_confirmed(stars, sets, percent), "confirmed")
    component = connected_components(found)

    # What the stars left in several components within one bucket: first a class's most promising pair with each other
    # component, which joins most of what belongs together, and then every pair of what is still apart.
    for best in (True, False):
        labelled = members.join(component.withColumnRenamed("node", "cls"), "cls", "left").select("bucket", "band", "cls", F.coalesce("component", "cls").alias("component"))
        apart = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("bucket")
        open_rows = materialize(labelled.join(apart, "bucket").join(slim, "cls"), "open")
        pairs = materialize(_pairs_apart(open_rows, percent, need, best).distinct(), "pairs")
        if pairs.isEmpty():
            return component
        more = materialize(_sets_of(docs, classes, pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct(), width), "sets")
        links = materialize(_confirmed(pairs, more, percent), "confirmed")
        # Each class's link to its component's least class stands for all links found before.
        component = connected_components(component.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links))
    return component


def _deal(rows: DataFrame) -> DataFrame:
    """rows with (bucket, lo, hi, own), in copies: which two blocks of its bucket meet where, and which of them a row is of.

    A bucket's largest component is not compared with itself, so its rows (own -1, lo below 0) meet blocks of the other
    rows only; those (own 0 and up) meet each other, too. Blocks have BLOCK rows at most; as a rule the other rows are
    one block, and nothing is copied but them.
    """
    sizes = rows.groupBy("bucket", "component").agg(F.count("*").alias("_n"))
    sizes = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("_n", "component")).alias("_main"), F.max("_n").alias("_m"), (F.sum("_n") - F.max("_n")).alias("_r"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    placed = rows.join(sizes.select("bucket", "_main", blocks("_m").alias("_mains"), blocks("_r").alias("_rests")), "bucket")
    of = lambda n: F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")
    main, rest = placed.filter("component = _main"), placed.filter("component <> _main")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    parts = [
        main.withColumn("hi", upto("_rests")).withColumns({"lo": -1 - of("_mains"), "own": F.lit(-1)}),
        rest.withColumn("lo", upto("_mains")).withColumns({"lo": -1 - F.col("lo"), "hi": of("_rests"), "own": F.lit(0)}),
        rest.withColumn("_other", upto("_rests")).withColumn("own", of("_rests")).withColumns({"lo": F.least("own", "_other"), "hi": F.greatest("own", "_other")}),
    ]
    columns = ["bucket", "lo", "hi", "own", "band", "cls", "component", "n", "most", *SKETCH_COLUMNS]
    return functools.reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def _pairs_apart(rows: DataFrame, percent: int, need: int, best: bool) -> DataFrame:
    """(a, b): classes in one bucket, in different components, whose sketches allow a link.

    best: of a large group only each class's pair with the most registers in common with each other component. Pairs
    are compared in arrays and leave the task only if they may be links; a task holds two blocks of a bucket at most.
    """
    sorted_rows = _deal(rows).repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")

    def near(g: dict, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs of rows i, j may be links."""
        ok = (g["component"][i] != g["component"][j]) & ((g["lo"][i] == g["hi"][i]) | (g["own"][i] != g["own"][j]))
        ok &= 100 * np.minimum(g["n"][i], g["n"][j]) >= percent * np.maximum(g["n"][i], g["n"][j])
        x, y = i[ok], j[ok]
        if len(x):
            ok = np.bitwise_count(g["parity"][x] ^ g["parity"][y]).sum(axis=1, dtype=np.int64) <= np.maximum(g["most"][x], g["most"][y])
            x, y = x[ok], y[ok]
        if len(x):
            ok = (g["registers"][x] == g["registers"][y]).sum(axis=1) >= need
            x, y = x[ok], y[ok]
        return x, y

    def fresh(g: dict, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that no earlier band has, which would give them again."""
        new = (g["bands"][x] == g["bands"][y]).argmax(axis=1) == g["band"][x]
        return x[new], y[new]

    def small_groups(g: dict, group: np.ndarray) -> list[np.ndarray]:
        """Rows of many groups side by side: each with the one `step` places on."""
        found, step, i = [], 1, np.arange(len(group) - 1)
        while len(i):
            i = i[group[i] == group[i + step]]
            x, y = near(g, i, i + step)
            if len(x):
                x, y = fresh(g, x, y)
                found.append(np.stack([g["cls"][x], g["cls"][y]], axis=1))
            step += 1
            i = i[i + step < len(group)]
        return found

    def large_group(g: dict, at: np.ndarray) -> list[np.ndarray]:
        """Rows of one group: those outside its largest component, each with all rows before it."""
        _, inverse, counts = np.unique(g["component"][at], return_inverse=True, return_counts=True)
        at = at[np.lexsort((inverse, -counts[inverse], g["own"][at] >= 0))]
        across = g["lo"][at[0]] < 0
        first = int((g["own"][at] < 0).sum()) if across else int(counts.max())
        found = []
        for k in range(first, len(at)):
            x, y = near(g, np.full(first if across else k, at[k]), at[: first if across else k])
            if not len(x):
                continue
            if best:
                agree = (g["registers"][x] == g["registers"][y]).sum(axis=1)
                by = np.lexsort((y, -agree))
                x, y = x[by], y[by]
                keep = np.unique(g["component"][y], return_index=True)[1]
                x, y = x[keep], y[keep]
            else:
                x, y = fresh(g, x, y)
            found.append(np.stack([g["cls"][x], g["cls"][y]], axis=1))
        return found

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        g = {c: pdf[c].to_numpy() for c in ("bucket", "lo", "hi", "own", "band", "cls", "component", "n", "most")}
        g["parity"], g["bands"] = pdf[PARITY_COLUMNS].to_numpy().view(np.uint64), np.ascontiguousarray(pdf[BAND_COLUMNS].to_numpy())
        g["registers"] = g["bands"].view(np.uint16)
        key = np.stack([g["bucket"], g["lo"], g["hi"]], axis=1)
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))) if len(key) else np.zeros(0, dtype=np.int64)
        sizes = np.diff(np.append(starts, len(key)))
        group = np.repeat(np.arange(len(starts)), sizes)
        few = np.repeat(sizes <= FEW, sizes)
        found = small_groups({c: v[few] for c, v in g.items()}, group[few])
        for start, size in zip(starts[sizes > FEW], sizes[sizes > FEW], strict=True):
            found += large_group(g, np.arange(start, start + size))
        out = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
        return pd.DataFrame({"a": out.min(axis=1) if len(out) else out[:, 0], "b": out.max(axis=1) if len(out) else out[:, 1]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of the group that may go on
        for pdf in batches:
            if not len(pdf):
                continue
            key = pdf[["bucket", "lo", "hi"]].to_numpy()
            last = np.flatnonzero((key != key[-1]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut == 0 and held and tuple(held[-1][["bucket", "lo", "hi"]].iloc[-1]) == tuple(key[0]):
                held.append(pdf)
                continue
            yield compare(pd.concat([*held, pdf.iloc[:cut]], ignore_index=True))
            held = [pdf.iloc[cut:]]
        if held:
            yield compare(pd.concat(held, ignore_index=True))

    return sorted_rows.mapInPandas(run, "a long, b long")


def _sets_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cls, set) of the classes in `wanted`, from their representatives' whole texts."""
    reps = classes.select("cls", F.col("rep").alias("doc_id"), "n", "sig_a", "sig_b").join(wanted, "cls")
    ids = materialize(reps.select("doc_id").distinct(), "ids")
    texts = docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_semi")
    # The signature tells which text it was, should a doc_id have several.
    return set_rows(texts, width).join(reps, ["doc_id", "n", "sig_a", "sig_b"]).select("cls", "set")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("set").alias("s")), "a").join(sets.select(F.col("cls").alias("b"), F.col("set").alias("t")), "b")
    shared = F.size(F.array_intersect("s", "t"))
    return both.withColumn("_shared", shared).filter(100 * F.col("_shared") >= percent * (F.size("s") + F.size("t") - F.col("_shared"))).select("a", "b")
