"""Best-fit packing of tokenised documents into fixed-length sequences, after dominance reduction.

The packing problem depends on piece lengths alone, so it is solved on the histogram of lengths (at most `capacity`
counts, whatever the corpus): dominance reduction first fixes sets that provably belong to some optimal packing,
then best-fit decreasing packs what is left. The result is a list of runs "this set of lengths, this many times",
of which there are a few thousand at most; pieces find their place in it by their rank among pieces of equal length.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import key_or_null, key_or_sentinel, materialize, text_or_empty

CAPACITY = 1024
END_ID = 2
#: Groups of equal length are ranked in this many parts, so that a length that a third of the pieces have is no hot spot.
RANK_PARTS = 64
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@functools.lru_cache(maxsize=2)
def _encoder(name: str):
    """The encoder of a vocabulary of the installed tokenizer files: byte_bpe_50k.json's ids.

    tiktoken reads the same vocabulary as ranks and gives the ids of the `tokenizers` library several times faster
    (a test holds the two against each other); the special token that the json file declares is split off first.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    specials = {t.content: i for i, t in Tokenizer.from_file(path).get_added_tokens_decoder().items() if t.special}
    ranks_path = os.path.splitext(path)[0] + ".tiktoken"
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    enc = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=specials)
    return enc, set(specials)


def encode(texts: list[str], vocabulary: str) -> list[list[int]]:
    enc, specials = _encoder(vocabulary)
    return [enc.encode(t, allowed_special=specials) if any(s in t for s in specials) else enc.encode_ordinary(t) for t in texts]


def tokenize_pieces(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most `capacity` ids of every document; of a longer document the first piece takes the remainder.

    A null doc_id is NULL_ID here; place_pieces gives it back.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = np.array([*encode([text], vocabulary)[0], end_id], dtype="<u4")
                first = len(ids) % capacity or capacity
                start, k = 0, 0
                while start < len(ids):
                    n = first if k == 0 else capacity
                    rows.append((doc_id, k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
                    start, k = start + n, k + 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"piece": "int32"})

    return docs.select(key_or_sentinel("doc_id").alias("doc_id"), text_or_empty().alias("text")).mapInPandas(run, PIECES)


@dataclass
class Run:
    """`times` sequences that each hold pieces of these lengths, in this order."""

    lengths: tuple[int, ...]
    times: int


def _dominates(lengths: np.ndarray, counts: np.ndarray, j: int, room: int, capacity: int) -> tuple[int, ...] | None:
    """Pieces that may join one piece of length `j` in some optimal packing, if at most three pieces need be looked at.

    `lengths` ascend; `counts` has what is left of each, without that one piece. None: nothing is proved.
    """
    left = counts > 0
    have = lengths[left]
    have = have[have <= room]
    if not len(have):
        return ()
    best = int(have[-1])
    if best == room:
        return (best,)
    n = counts[left][: len(have)]
    smallest = np.repeat(have[:3], np.minimum(n[:3], 3))[:3]
    if len(smallest) < 2 or smallest[:2].sum() > room:
        return (best,)
    # Largest partner of each length, among those that fit beside it; a length alone pairs with itself only if there are two.
    at = np.searchsorted(have, room - have, side="right") - 1
    same = (at == np.arange(len(have))) & (n < 2)
    at = np.where(same, at - 1, at)
    ok = (at >= 0) & (at <= np.arange(len(have)))
    big, small = have[ok], have[at[ok]]
    sums = big + small
    at_most_two = len(smallest) < 3 or smallest.sum() > room
    if not at_most_two:
        return None
    if not len(sums) or sums.max() <= best:
        return (best,)
    # {best, b} with the largest b that fits beside best: it dominates pairs (c, d) with d <= b or c + d <= best.
    rest = np.flatnonzero(have <= room - best)
    rest = rest[(rest < len(have) - 1) | (n[rest] > 1)]
    if not len(rest):
        return None
    b = int(have[rest[-1]])
    lows = np.arange(len(have))
    lows = lows[have > b]
    for i in lows:  # pairs whose smaller piece is longer than b
        k = np.searchsorted(have, room - have[i], side="right") - 1
        if k >= i and (k > i or n[i] > 1) and have[i] + have[k] > best:
            return None
    return (best, b)


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Runs that pack every length of `histogram`, and how many sequences dominance reduction fixed."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    axis = np.arange(capacity + 1)
    runs: list[Run] = []
    again = True
    while again:  # a fixed set shrinks the instance, and then more sets may dominate
        again = False
        for j in range(capacity, 0, -1):
            while counts[j]:
                counts[j] -= 1
                found = _dominates(axis, counts, j, capacity - j, capacity)
                counts[j] += 1
                if found is None:
                    break
                pattern = (j, *found)
                need = {x: pattern.count(x) for x in pattern}
                times = int(min(counts[x] // k for x, k in need.items()))
                for x, k in need.items():
                    counts[x] -= k * times
                runs.append(Run(pattern, times))
                again = True
    fixed = sum(r.times for r in runs)
    return runs + _best_fit(counts, capacity), fixed


def _best_fit(counts: np.ndarray, capacity: int) -> list[Run]:
    """Best-fit decreasing, on classes of equally filled sequences."""
    open_by_room: dict[int, list[Run]] = {}
    done: list[Run] = []

    def put(run: Run, room: int) -> None:
        if room:
            open_by_room.setdefault(room, []).append(run)
        else:
            done.append(run)

    for length in range(capacity, 0, -1):
        n = int(counts[length])
        while n:
            fits = [r for r in open_by_room if r >= length]
            room = min(fits, default=capacity)
            if fits:
                run = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
            else:
                run = Run((), n)  # as many new sequences as could be needed
            each = room // length
            full = min(run.times, n // each)
            if full:
                put(Run(run.lengths + (length,) * each, full), room - each * length)
                n -= full * each
            spare = run.times - full
            if spare and 0 < n < each:
                put(Run(run.lengths + (length,) * n, 1), room - n * length)
                n, spare = 0, spare - 1
            if spare and run.lengths:
                put(Run(run.lengths, spare), room)
    return done + [r for rs in open_by_room.values() for r in rs]


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece a sequence_id and its offset there. `pieces` (see tokenize_pieces) is read three times: pass a written table."""
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(RANK_PARTS)).cast("int")
    sized = pieces.withColumn("_part", part)
    counts = sized.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    rows = counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # one row a length: at most `capacity` rows
    runs, _ = plan_packing({r["length"]: r["n"] for r in rows}, capacity)
    lengths, first_rank, offset, sequence = [], [], [], []
    seen = np.zeros(capacity + 1, dtype=np.int64)
    base = 0
    for run in runs:
        at = 0
        for x in run.lengths:
            lengths.append(x)
            first_rank.append(int(seen[x]))
            offset.append(at)
            sequence.append(base)
            seen[x] += run.times
            at += x
        base += run.times
    order = np.lexsort((first_rank, lengths)) if lengths else []
    slot_length, slot_rank, slot_offset, slot_sequence = (np.array(x, dtype=np.int64)[order] for x in (lengths, first_rank, offset, sequence))
    # One sorted key of length and rank; ranks stay far below 2**52.
    slot_key = slot_length * 2**52 + slot_rank

    ahead = F.sum("_n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("length", "_part", F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = sized.withColumn("_rank", F.row_number().over(inside) - 1).join(starts, ["length", "_part"]).withColumn("_rank", F.col("_rank") + F.col("_ahead"))

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            i = np.searchsorted(slot_key, pdf["length"].to_numpy() * 2**52 + pdf["_rank"].to_numpy(), side="right") - 1
            pdf["sequence_id"] = slot_sequence[i] + pdf.pop("_rank").to_numpy() - slot_rank[i]
            pdf["offset"] = slot_offset[i]
            yield pdf

    out = f"{PIECES}, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank").mapInPandas(locate, out).withColumn("doc_id", key_or_null("doc_id"))


def pack_documents(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack every document of (doc_id, text) into sequences of at most `capacity` ids.

    A document is its ids and then `end_id`; a null or empty text is `end_id` alone. Only documents of more ids are
    cut: into pieces of `capacity` ids, of which the first takes the remainder. Repeated rows and rows with a null or
    repeated doc_id are packed each on its own. An empty table gives no rows. Columns besides doc_id and text are ignored.
    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset; a sequence's pieces lie without gaps from 0.
    """
    return place_pieces(materialize(tokenize_pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)
