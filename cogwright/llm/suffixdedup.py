"""Exact removal of repeated byte strings, by suffix arrays over shards of what can repeat at all.

A byte string of `min_bytes` bytes is anchored at its least k-gram hash (the leftmost such k-gram). Consecutive
strings with one anchor make a segment, so equal strings lie in segments with equal anchor hashes. Segments of equal
content are collapsed by an aggregation, which combines before it shuffles: all but the first are repeats as a whole.
Only anchors that have several contents are left to compare byte by byte: their first occurrences go to shards, where
a suffix array (Larsson-Sadakane refinement) and Kasai's common prefixes find equal strings. An anchor with more
content than a shard may hold is dealt over several shards; their sorted runs are cut at common splitters by binary
search and merged range by range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _TABLE, SpanHasher, key_or_null, key_or_sentinel, materialize, mix64, slices, text_or_empty

GRAM = 16
#: Bytes of segments that one shard's suffix array holds.
SHARD_BYTES = 4_000_000
#: Bytes of text that are handled at once; positions inside need 24 bits.
BUFFER = 2_000_000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position on, by doubling; the last positions read what they can."""
    h = _TABLE[data]
    width = 1
    with np.errstate(over="ignore"):
        for odd in _ODD:
            if len(h) > width:
                h[:-width] = h[:-width] * odd + h[width:]
            width *= 2
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def _window_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive entries."""
    m, have = x, 1
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    if have < width:
        m = np.minimum(m[: len(m) - (width - have)], m[width - have :])
    return m


def segments(data: np.ndarray, bounds: np.ndarray, min_bytes: int) -> tuple[np.ndarray, ...]:
    """(text index, first start, number of starts, anchor hash, content hash) of the segments of texts in one buffer.

    bounds: where each text begins, and the end of the last. Starts and lengths are in bytes of the buffer.
    """
    none = (np.zeros(0, dtype=np.int64),) * 5
    if len(data) < min_bytes:
        return none
    h = _gram_hashes(data)
    window = min_bytes - GRAM + 1
    low = np.uint64(2**24 - 1)
    placed = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    least = _window_least(placed[: len(data) - GRAM + 1], window)  # one for each start of a whole string
    counts = bounds[1:] - bounds[:-1] - min_bytes + 1
    own = np.flatnonzero(counts > 0)
    if not len(own):
        return none
    inside = np.zeros(len(least), dtype=bool)
    edges = np.zeros(len(least) + 1, dtype=np.int32)
    np.add.at(edges, bounds[own], 1)
    np.add.at(edges, bounds[own] + counts[own], -1)
    inside = np.cumsum(edges[:-1]) > 0
    new = np.empty(len(least), dtype=bool)
    new[0] = True
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[bounds[own]] = True
    new[1:] |= inside[1:] != inside[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(least)))
    keep = inside[first]
    first, size = first[keep], size[keep]
    anchor = h[(least[first] & low).astype(np.int64)]
    content = SpanHasher(data).spans(first, first + size + min_bytes - 1)
    text = np.searchsorted(bounds, first, side="right") - 1
    return text, first, size, anchor.view(np.int64), content.view(np.int64)


def _pieces(raw: list[bytes], min_bytes: int) -> Iterator[tuple[list[tuple[int, int]], np.ndarray, np.ndarray]]:
    """Texts gathered to buffers of at most BUFFER bytes or so; longer texts come in parts that share min_bytes - 1 bytes."""
    held: list[bytes] = []
    origin: list[tuple[int, int]] = []
    size = 0

    def flush():
        bounds = np.zeros(len(held) + 1, dtype=np.int64)
        np.cumsum([len(b) for b in held], out=bounds[1:])
        return origin[:], np.frombuffer(b"".join(held), dtype=np.uint8), bounds

    for i, b in enumerate(raw):
        for at in range(0, max(len(b) - min_bytes + 1, 0), BUFFER):
            part = b[at : at + BUFFER + min_bytes - 1]
            if size and size + len(part) > BUFFER:
                yield flush()
                held, origin, size = [], [], 0
            held.append(part)
            origin.append((i, at))
            size += len(part)
    if held:
        yield flush()


def _segments_of(pdf: pd.DataFrame, min_bytes: int) -> Iterator[tuple]:
    raw = [t.encode("utf-8", "surrogatepass") for t in pdf["text"]]
    for origin, data, bounds in _pieces(raw, min_bytes):
        text, first, size, anchor, content = segments(data, bounds, min_bytes)
        if len(first):
            which, at = np.array(origin, dtype=np.int64).T
            yield which[text], first - bounds[text] + at[text], size, anchor, content


def repeated_anchors(docs: DataFrame, min_bytes: int) -> DataFrame:
    """(anchor) of the anchors that stand at several places."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, _, _, anchor, _ in _segments_of(pdf, min_bytes):
                values, n = np.unique(anchor, return_counts=True)
                yield pd.DataFrame({"anchor": values, "n": n.astype(np.int32)})

    return docs.select("text").mapInPandas(run, "anchor long, n int").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor")


def segment_rows(docs: DataFrame, min_bytes: int) -> DataFrame:
    """(anchor, content, size, doc_id, sub, start) of every segment of every text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids, subs = pdf["doc_id"].to_numpy(), pdf["sub"].to_numpy()
            for which, start, size, anchor, content in _segments_of(pdf, min_bytes):
                yield pd.DataFrame({"anchor": anchor, "content": content, "size": size.astype(np.int32), "doc_id": ids[which], "sub": subs[which], "start": start})

    return docs.mapInPandas(run, "anchor long, content long, size int, doc_id long, sub long, start long")


#: Symbols of nine bits that fit a word.
PACK = 7


def _packed(symbols: np.ndarray) -> np.ndarray:
    """The PACK symbols from each place on as one number, zeros after the end."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(PACK, dtype=np.uint64)])
    out = np.zeros(n, dtype=np.uint64)
    for k in range(PACK):
        out = (out << np.uint64(9)) | padded[k : k + n]
    return out


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and their ranks, by Larsson-Sadakane refinement.

    Ranks start from the first symbols; each round doubles the sorted depth and sorts only groups not yet settled.
    """
    n = len(symbols)
    if n == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    width = PACK
    first = _packed(symbols)
    order = np.argsort(first)
    sorted_keys = first[order]
    new = np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))
    heads = np.flatnonzero(new)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))  # a group's rank is its first place
    # Places of groups that are not settled, and where each of those groups begins among them.
    alone = new & np.append(new[1:], True)
    places = np.flatnonzero(~alone)
    h = width
    while len(places):
        members = order[places]
        ahead = members + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = (rank[members].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        by = np.argsort(key)
        members, key = members[by], key[by]
        order[places] = members
        new = np.concatenate(([True], key[1:] != key[:-1]))
        # Groups stay apart: places of a group are neighbours, and its rank is part of the key.
        rank[members] = np.repeat(places[new], np.diff(np.append(np.flatnonzero(new), len(places))))
        alone = new & np.append(new[1:], True)
        places = places[~alone]
        h *= 2
    return order, rank


def kasai(symbols: np.ndarray, order: np.ndarray, lane_starts: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes, up to `cap`, of each suffix in the order with the one before it, by Kasai's method.

    Kasai's walk follows the text, and a prefix is at most one shorter than the one found a position earlier. Here it
    walks the lanes of the text (the segments) side by side, and a prefix grows by whole words first.
    """
    n = len(symbols)
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    lcp = np.zeros(n, dtype=np.int32)
    padded = np.concatenate([symbols, np.zeros(cap + 1, dtype=symbols.dtype)])
    words = _packed(symbols)
    ends = np.append(lane_starts[1:], n)
    at, have = lane_starts.copy(), np.zeros(len(lane_starts), dtype=np.int64)
    live = np.arange(len(lane_starts))
    while len(live):
        pos = at[live]
        k = np.maximum(have[live] - 1, 0)
        p = place[pos]
        other = order[np.maximum(p - 1, 0)]
        growing = np.flatnonzero(p > 0)
        k[p == 0] = 0
        leaping = growing
        while len(leaping):
            far = k[leaping] + PACK
            leaping = leaping[(far <= cap) & (np.maximum(pos[leaping], other[leaping]) + far <= n)]
            leaping = leaping[words[pos[leaping] + k[leaping]] == words[other[leaping] + k[leaping]]]
            k[leaping] += PACK
        while len(growing):
            same = (k[growing] < cap) & (padded[pos[growing] + k[growing]] == padded[other[growing] + k[growing]]) & (np.maximum(pos[growing], other[growing]) + k[growing] < n)
            growing = growing[same]
            k[growing] += 1
        lcp[p] = k
        have[live] = k
        at[live] += 1
        live = live[at[live] < ends[live]]
    return lcp


def _grams(texts: list[bytes], sizes: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole strings of a shard in sorted order: (segment, offset in it, group), a group being equal strings."""
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    # A zero symbol ends each segment; bytes count from one.
    lanes = starts + np.arange(len(texts))
    symbols = np.zeros(len(raw) + len(texts), dtype=np.int16)
    inside = np.ones(len(symbols), dtype=bool)
    inside[lanes + lengths] = False
    symbols[inside] = raw.astype(np.int16) + 1
    order, _ = suffix_array(symbols)
    lcp = kasai(symbols, order, lanes, min_bytes)
    segment = np.repeat(np.arange(len(texts)), lengths + 1)[order]
    offset = order - lanes[segment]
    whole = offset < sizes[segment]
    # Equal strings are neighbours; what stands between whole strings can't part them, so the least prefix counts.
    breaks = np.cumsum(lcp < min_bytes)
    return segment[whole], offset[whole], breaks[whole]


def _runs(segment: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive offsets within segments, as (segment, first offset, number)."""
    by = np.lexsort((offset, segment))
    segment, offset = segment[by], offset[by]
    new = np.ones(len(segment), dtype=bool)
    new[1:] = (segment[1:] != segment[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    return segment[first], offset[first], np.diff(np.append(first, len(segment)))


def _later(segment: np.ndarray, offset: np.ndarray, group: np.ndarray, rank: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which strings are not the first of their group; rank: the order of each segment's document."""
    by = np.lexsort((start[segment] + offset, rank[segment], group))
    g = group[by]
    out = np.ones(len(g), dtype=bool)
    out[by[np.concatenate(([True], g[1:] != g[:-1]))]] = False
    return out


_REPEATS = "doc_id long, sub long, start long, size long"


def _doc_rank(pdf: pd.DataFrame) -> np.ndarray:
    return np.unique(pdf[["doc_id", "sub"]].to_numpy(), axis=0, return_inverse=True)[1].reshape(-1)


def shard_repeats(variants: DataFrame, min_bytes: int) -> DataFrame:
    """Later strings of the shards that need no merging. variants: (shard, anchor, doc_id, sub, start, size, bytes)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["size"].to_numpy()
        segment, offset, group = _grams([bytes(b) for b in pdf["bytes"]], sizes, min_bytes)
        later = _later(segment, offset, group, _doc_rank(pdf), pdf["start"].to_numpy())
        seg, first, n = _runs(segment[later], offset[later])
        at = pdf.iloc[seg]
        return pd.DataFrame({"doc_id": at["doc_id"].to_numpy(), "sub": at["sub"].to_numpy(), "start": at["start"].to_numpy() + first, "size": n})

    return variants.groupBy("shard").applyInPandas(run, _REPEATS)


def merged_repeats(variants: DataFrame, min_bytes: int, shard_bytes: int) -> DataFrame:
    """Later strings of anchors that have more content than one shard may hold.

    Their segments are dealt over shards by content. Each shard sorts its distinct strings by its suffix array; the
    sorted runs are cut by binary search at splitters (a bounded sample of strings), and each range is merged. A shard
    sends the first place of each string alone, so one that all shards have meets as many rows as there are shards.
    """
    rows = max(1, shard_bytes // (4 * min_bytes))
    total = variants.agg(F.sum("size")).first()[0] or 0
    wanted = min(4096, max(1, -(-total // rows)))
    # A bounded sample of at most 8 * 4096 strings fixes the cuts; whatever they are, the result is whole.
    share = min(1.0, 8.0 * wanted / max(1, variants.count()))
    drawn = variants.filter(F.pmod(F.xxhash64("doc_id", "sub", "start"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1))
    sample = sorted(bytes(r[0]) for r in drawn.select(F.expr(f"substring(bytes, 1 + size div 2, {min_bytes})")).limit(8 * 4096).collect())
    cuts = np.array(sample[:: max(1, len(sample) // wanted)], dtype=f"S{min_bytes}") if sample else np.zeros(0, dtype=f"S{min_bytes}")

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["size"].to_numpy()
        texts = [bytes(b) for b in pdf["bytes"]]
        segment, offset, group = _grams(texts, sizes, min_bytes)
        later = _later(segment, offset, group, _doc_rank(pdf), pdf["start"].to_numpy())
        ids, subs, starts = (pdf[c].to_numpy() for c in ("doc_id", "sub", "start"))
        seg, first, n = _runs(segment[later], offset[later])
        known = pd.DataFrame({"range": -1, "gram": None, "doc_id": ids[seg], "sub": subs[seg], "start": starts[seg] + first, "size": n})
        segment, offset = segment[~later], offset[~later]
        gram = [texts[s][o : o + min_bytes] for s, o in zip(segment, offset, strict=True)]
        # Splitters lie where they would be inserted into this shard's sorted run.
        run = np.array(gram, dtype=f"S{min_bytes}")
        where = np.searchsorted(run, cuts, side="left")
        part = np.zeros(len(run), dtype=np.int32)
        np.add.at(part, where[where < len(run)], 1)
        firsts = pd.DataFrame({"range": np.cumsum(part), "gram": gram, "doc_id": ids[segment], "sub": subs[segment], "start": starts[segment] + offset, "size": 1})
        return pd.concat([known, firsts], ignore_index=True)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["gram", "doc_id", "sub", "start"], kind="stable")
        return pdf.loc[pdf["gram"].duplicated().to_numpy(), ["doc_id", "sub", "start", "size"]]

    sharded = variants.withColumn("shard", F.pmod(F.xxhash64("doc_id", "sub", "start"), F.lit(max(1, int(variants.agg(F.sum(F.length("bytes"))).first()[0] or 0) // shard_bytes + 1))))
    runs = materialize(sharded.groupBy("shard").applyInPandas(cut, f"range int, gram binary, {_REPEATS}"), "runs")
    merged = runs.filter("range >= 0").groupBy("range").applyInPandas(merge, _REPEATS)
    return merged.union(runs.filter("range < 0").select("doc_id", "sub", "start", "size"))


def segment_texts(docs: DataFrame, wanted: DataFrame, min_bytes: int) -> DataFrame:
    """The bytes of the wanted segments (anchor, doc_id, sub, start, size), from the texts they lie in."""
    lists = wanted.groupBy("doc_id", "sub").agg(F.collect_list(F.struct("anchor", "start", "size")).alias("at"))
    joined = docs.join(lists, ["doc_id", "sub"]).withColumn("raw", F.encode("text", "UTF-8")).select("doc_id", "sub", "raw", F.explode("at").alias("a"))
    return joined.select("doc_id", "sub", "a.*", F.expr(f"substring(raw, cast(a.start + 1 as int), a.size + {min_bytes - 1})").alias("bytes"))


def repeated_strings(docs: DataFrame, min_bytes: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, sub, start, size): starts, in runs of `size`, of strings of min_bytes bytes that start earlier too."""
    repeated = materialize(repeated_anchors(docs, min_bytes), "repeated")
    rows = materialize(segment_rows(docs, min_bytes).join(repeated.hint("merge"), "anchor", "left_semi"), "segments")
    place = F.struct("doc_id", "sub", "start")
    # Contents are told apart by two hashes of 64 bits, of a part and of the whole, and by their length.
    same = ["anchor", "content", "size"]
    contents = materialize(rows.groupBy(*same).agg(F.min(place).alias("first"), F.count("*").alias("n")), "contents")
    copied = contents.filter("n > 1").select(*same, "first")
    copies = rows.join(copied, same).filter(place != F.col("first")).select("doc_id", "sub", "start", F.col("size").cast("long").alias("size"))

    weight = F.sum(F.col("size") + F.lit(min_bytes - 1))
    anchors = contents.groupBy("anchor").agg(F.count("*").alias("kinds"), weight.alias("bytes")).filter("kinds > 1")
    anchors = materialize(anchors, "anchors")
    size = anchors.agg(F.sum("bytes"), F.max("bytes")).first()
    if size[0] is None:
        return copies
    shards = int(size[0]) // shard_bytes + 1
    picked = contents.join(anchors.select("anchor", (F.col("bytes") > shard_bytes).alias("heavy")), "anchor")
    picked = picked.select("anchor", "heavy", "size", "first.*")
    light = segment_texts(docs, picked.drop("heavy") if size[1] <= shard_bytes else picked.filter("not heavy").drop("heavy"), min_bytes)
    light = light.withColumn("shard", F.pmod("anchor", F.lit(4 * shards)))
    found = copies.union(shard_repeats(light, min_bytes))
    if size[1] > shard_bytes:
        heavy = materialize(segment_texts(docs, picked.filter("heavy").drop("heavy"), min_bytes), "heavy")
        found = found.union(merged_repeats(heavy, min_bytes, shard_bytes))
    return found


def remove_repeats(docs: DataFrame, min_bytes: int = 100, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Remove every byte that a string of `min_bytes` bytes covers which also starts earlier.

    Earlier is a smaller doc_id, or the same document and a smaller start; overlaps count; strings are judged on the
    input. A null text is empty; a null doc_id comes before all others. Different texts with one doc_id are separate
    documents in the order of a hash; rows that repeat both are one document, and each of them gets its result.
    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and kept (the bytes that stay).
    An empty table gives no rows; columns besides doc_id and text are ignored.
    """
    docs = docs.select(key_or_sentinel("doc_id").alias("doc_id"), text_or_empty().alias("text"))
    repeats = not docs.groupBy("doc_id").count().filter("count > 1").isEmpty()
    docs = docs.withColumn("sub", F.xxhash64("text") if repeats else F.lit(0).cast("long"))
    one = materialize(docs.dropDuplicates(["doc_id", "sub"]), "one") if repeats else docs
    found = repeated_strings(one, min_bytes, shard_bytes)
    spans = found.groupBy("doc_id", "sub").agg(F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text, starts, sizes in zip(pdf["doc_id"], pdf["text"], pdf["starts"], pdf["sizes"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                if starts is None:
                    out.append((doc_id, len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw))
                    continue
                edges = np.zeros(len(raw) + 1, dtype=np.int64)
                starts = np.asarray(starts, dtype=np.int64)
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + np.asarray(sizes, dtype=np.int64) + min_bytes - 1, -1)
                gone = np.cumsum(edges[:-1]) > 0
                kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                out.append((doc_id, len(raw), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = docs.join(spans, ["doc_id", "sub"], "left").select("doc_id", "text", "starts", "sizes")
    out = joined.mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumn("doc_id", key_or_null("doc_id"))
