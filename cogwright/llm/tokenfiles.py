"""Token ids in binary files of patched frame-of-reference blocks, written and read by Spark.

A file is a row of segments, each of whole documents and followed by a line feed. Little-endian, a segment has

    "PFR1", bytes of the segment u64, documents u32, ids u64, blocks u32, exceptions u32
    document ids i64[documents], token counts u64[documents]
    block starts u64[blocks + 1], block minima u32[blocks], exceptions of each block u8[blocks], widths u8[blocks]
    exception places u8[exceptions], exception values u32[exceptions] (the bits above the block's width)
    packed blocks: 128 values less the minimum, `width` bits each, the first in the lowest bits of words of 64

A block's width is what the 90th percentile of its values needs; longer values keep their low bits in place and have the
rest in the exception list. The last block is filled up with its minimum. A document that is longer than a segment should be
has one of its own. Null document ids are stored as the least long.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import key_or_null, key_or_sentinel, materialize, scratch_root, slices, text_or_empty

END_ID = 2
BLOCK = 128
#: Share of a block's values, in percent, that its width must hold.
PERCENTILE = 90
#: Ids after which a segment ends, and segments in a file: some 30 MB.
SEGMENT_IDS = 1 << 18
SEGMENTS_PER_FILE = 64
#: Pieces of text whose ids a task remembers, words and characters of texts that are encoded together, and blocks that are unpacked at a time.
REMEMBERED = 1_500_000
LINES = 64
TEXT_CHARS = 500_000
UNPACKED_BLOCKS = 1 << 12
MAGIC = b"PFR1"
_HEAD = struct.Struct("<4sQIQII")

_LATIN, _ASCII, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"\x00-&(-@\[-`{-\x7f", r"!-&(-@\[-`{-~"
#: Pieces of a text at whose ends the byte-level pattern ends a word whatever follows: Latin letters with a space before
#: them, or what stands between such words. Apostrophes begin contractions and other letters go on a word, so neither ends a
#: piece; nor does white space of two characters or more, of which the pattern gives the last to what follows.
_PIECE = re.compile(rf" ?[{_LATIN}]++(?=[{_ASCII}]|\Z)|(?s:.)+?(?=\Z|(?<=[{_ASCII}]) [{_LATIN}]|(?<=[{_MARKS}])[{_LATIN}]|(?<=\S\n)[{_LATIN}]|(?<=\S) (?=\S))")
_WORD = re.compile(rf" ?[{_LATIN}]+")


class _Places(dict):
    """Numbers of pieces, in the order in which they are first asked for; `new` has those that came since."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = n = len(self)
        return n


class WordEncoder:
    """Ids of texts by the `tokenizers` library, which sees each distinct piece of text once.

    The byte-level pattern ends a word at each end of a piece, so pieces can be encoded by themselves. A text with a special
    token's name in it is encoded whole. A test holds the ids against those of whole texts.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self._named = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        (self._line_feed,) = self._tokenizer.encode("\n", add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self._place = _Places()
        self._flat, self._starts, self._used, self._known = np.empty(1 << 16, dtype=np.uint32), np.zeros(1 << 16, dtype=np.int64), 0, 0

    def _learn(self) -> None:
        new, self._place.new = self._place.new, []
        # Words of Latin letters go together, a line each: a line feed between them is a word of the pattern by itself.
        words = [p for p in new if _WORD.fullmatch(p)]
        others = [p for p in new if not _WORD.fullmatch(p)]
        found = {p: e.ids for p, e in zip(others, self._tokenizer.encode_batch(others, add_special_tokens=False), strict=True)}
        for i in range(0, len(words), LINES):
            ids = self._tokenizer.encode("\n".join(words[i : i + LINES]), add_special_tokens=False).ids
            ids.append(self._line_feed)
            begin = 0
            for p in words[i : i + LINES]:
                end = ids.index(self._line_feed, begin)
                found[p] = ids[begin:end]
                begin = end + 1
        ids = np.fromiter((i for p in new for i in found[p]), dtype=np.uint32)
        n = self._known
        while len(self._flat) < self._used + len(ids):
            self._flat = np.concatenate([self._flat, np.empty_like(self._flat)])
        while len(self._starts) < n + len(new) + 1:
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
        self._flat[self._used : self._used + len(ids)] = ids
        self._starts[n + 1 : n + 1 + len(new)] = self._used + np.cumsum([len(found[p]) for p in new])
        self._used, self._known = self._used + len(ids), n + len(new)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, as unsigned 32-bit integers, and how many each text has."""
        if len(self._place) > REMEMBERED:
            self._forget()
        pieces = [[t] if any(name in t for name in self._named) else _PIECE.findall(t) for t in texts]
        counts = np.array([len(p) for p in pieces], dtype=np.int64)
        at = np.fromiter(map(self._place.__getitem__, chain.from_iterable(pieces)), dtype=np.int64, count=counts.sum())
        if self._place.new:
            self._learn()
        starts = self._starts[at]
        lengths = self._starts[at + 1] - starts
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self._flat[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str) -> WordEncoder:
    return WordEncoder(vocabulary)


def _bits_of(x: np.ndarray) -> np.ndarray:
    """The number of bits that each non-negative value needs."""
    return np.frexp(x.astype(np.float64))[1]


def _shifts(width: int) -> Iterator[tuple[int, int, int]]:
    """(place, word, bit) of a block's values in words of 64 bits, low bits first."""
    return ((i, *divmod(i * width, 64)) for i in range(BLOCK))


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values as rows of 16 * width bytes. All rows' values of one place are moved at a time."""
    columns, words = values.T.astype(np.uint64), np.zeros((2 * width, len(values)), dtype=np.uint64)
    for i, word, bit in _shifts(width):
        words[word] |= columns[i] << np.uint64(bit)
        if bit + width > 64:
            words[word + 1] |= columns[i] >> np.uint64(64 - bit)
    return np.ascontiguousarray(words.T).astype("<u8", copy=False).view(np.uint8)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    words, mask = np.ascontiguousarray(packed.view("<u8").T), np.uint64((1 << width) - 1)
    columns = np.empty((BLOCK, len(packed)), dtype=np.uint32)
    for i, word, bit in _shifts(width):
        x = words[word] >> np.uint64(bit)
        if bit + width > 64:
            x |= words[word + 1] << np.uint64(64 - bit)
        columns[i] = x & mask
    return columns.T


def encode_segment(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment of documents with these lengths; `ids` are all their ids."""
    blocks = -(-len(ids) // BLOCK)
    rows = np.empty((blocks, BLOCK), dtype=np.uint32)
    flat = rows.reshape(-1)
    flat[: len(ids)] = ids
    if blocks:
        flat[len(ids) :] = ids[(blocks - 1) * BLOCK :].min()
    low = rows.min(axis=1) if blocks else np.zeros(0, dtype=np.uint32)
    rows -= low[:, None]
    rank = -(-BLOCK * PERCENTILE // 100) - 1
    widths = _bits_of(np.partition(rows, rank, axis=1)[:, rank]).astype(np.uint8) if blocks else np.zeros(0, dtype=np.uint8)
    high = rows >> widths[:, None].astype(np.uint32)
    block_of, place = np.nonzero(high)
    exceptions = np.bincount(block_of, minlength=blocks).astype(np.uint8)
    starts = np.zeros(blocks + 1, dtype=np.uint64)
    np.cumsum(widths.astype(np.uint64) * np.uint64(BLOCK // 8), out=starts[1:])
    payload = np.empty(int(starts[-1]), dtype=np.uint8)
    for w in np.unique(widths):
        if not w:
            continue
        of_width = np.flatnonzero(widths == w)
        for some in np.array_split(of_width, -(-len(of_width) // UNPACKED_BLOCKS)):
            payload[starts[some].astype(np.int64)[:, None] + np.arange(BLOCK // 8 * int(w))] = _pack(rows[some] & np.uint32((1 << int(w)) - 1), int(w))
    parts = [
        doc_ids.astype("<i8"), lengths.astype("<u8"), starts.astype("<u8"), low.astype("<u4"), exceptions, widths, place.astype(np.uint8), high[block_of, place].astype("<u4"), payload,
    ]
    size = _HEAD.size + sum(p.nbytes for p in parts)
    return b"".join([_HEAD.pack(MAGIC, size, len(doc_ids), len(ids), blocks, len(place)), *(p.tobytes() for p in parts)])


class Segment:
    """A segment of a file, of which any run of ids can be read by its blocks alone."""

    def __init__(self, raw: memoryview, at: int = 0) -> None:
        magic, self.size, docs, self.n_ids, blocks, exceptions = _HEAD.unpack_from(raw, at)
        if magic != MAGIC:
            raise ValueError("no segment of token ids")
        at += _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.doc_ids, self.lengths = take("<i8", docs), take("<u8", docs).astype(np.int64)
        self._starts, self._low, self._exceptions, self._widths = take("<u8", blocks + 1).astype(np.int64), take("<u4", blocks), take("u1", blocks), take("u1", blocks)
        self._places, self._high = take("u1", exceptions), take("<u4", exceptions)
        self._payload = take("u1", int(self._starts[-1]))
        self._first = np.concatenate([[0], np.cumsum(self._exceptions, dtype=np.int64)])

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop-1 of the segment, from the blocks that hold them."""
        first, last = start // BLOCK, -(-stop // BLOCK)
        out = np.empty((max(last - first, 0), BLOCK), dtype=np.uint32)
        for begin in range(first, last, UNPACKED_BLOCKS):
            end = min(begin + UNPACKED_BLOCKS, last)
            rows, widths = np.zeros((end - begin, BLOCK), dtype=np.uint32), self._widths[begin:end]
            for w in np.unique(widths):
                if w:
                    some = np.flatnonzero(widths == w)
                    rows[some] = _unpack(self._payload[self._starts[begin + some][:, None] + np.arange(BLOCK // 8 * int(w))], int(w))
            a, b = self._first[begin], self._first[end]
            of = np.repeat(np.arange(end - begin), self._exceptions[begin:end])
            rows[of, self._places[a:b]] |= self._high[a:b] << widths[of].astype(np.uint32)
            out[begin - first : end - first] = rows + self._low[begin:end, None]
        return out.reshape(-1)[start - first * BLOCK : stop - first * BLOCK]


def segments(raw: bytes) -> Iterator[Segment]:
    """The segments of a file's bytes."""
    view, at = memoryview(raw), 0
    while at < len(raw):
        segment = Segment(view, at)
        yield segment
        at += segment.size
        if bytes(view[at : at + 1]) != b"\n":
            raise ValueError("a segment has no end")
        at += 1


def write_token_files(docs: DataFrame, path: str, vocabulary: str = "byte_bpe_50k.json", end_id: int = END_ID) -> None:
    """Write the ids of all documents of (doc_id, text) below `path`, in ascending order of doc_id over the files' names.

    A document is its ids and then `end_id`; a null text is empty. A null doc_id comes first; rows with one doc_id follow
    each other in the order of a hash of their texts. Each partition writes files of its own through Spark's committer, so a
    task that is run again leaves one copy. An empty table gives no segments.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = encoder(vocabulary)
        docs_, lengths, parts, held = [], [], [], 0

        def segment() -> pd.DataFrame:
            return pd.DataFrame({"segment": [encode_segment(np.array(docs_), np.array(lengths), np.concatenate(parts))]})

        for pdf in batches:
            numbers, texts = pdf["_id"].tolist(), pdf["_text"].tolist()
            for a, b in slices(texts, TEXT_CHARS):
                ids, counts = known.encode_all(texts[a:b])
                # Each document's end id goes in after its ids.
                ids = np.insert(ids, np.cumsum(counts), end_id)
                begin = 0
                for doc_id, n in zip(numbers[a:b], (counts + 1).tolist(), strict=True):
                    if held and held + n > SEGMENT_IDS:
                        yield segment()
                        docs_, lengths, parts, held = [], [], [], 0
                    docs_.append(doc_id)
                    lengths.append(n)
                    parts.append(ids[begin : begin + n])
                    begin, held = begin + n, held + n
        if docs_:
            yield segment()

    rows = docs.select(key_or_sentinel("doc_id").alias("_id"), text_or_empty().alias("_text")).withColumn("_tie", F.xxhash64("_text"))
    ordered = rows.repartitionByRange("_id", "_tie").sortWithinPartitions("_id", "_tie")
    packed = ordered.select("_id", "_text").mapInPandas(run, "segment binary")
    # The text sink writes the bytes of a string as they are, and one line feed after each.
    packed.select(F.col("segment").cast("string").alias("value")).write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).option("compression", "none").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files below `path`; start counts the ids before it in all files.

    ids_crc32 is the unsigned checksum of the ids as little-endian unsigned 32-bit integers. A null doc_id comes back as null.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, raw in zip(pdf["_file"], pdf["content"], strict=True):
                before = 0
                for segment in segments(raw):
                    ends = np.cumsum(segment.lengths)
                    starts = ends - segment.lengths
                    # Some documents at a time: as many as a segment should have, or one long one.
                    sums, i = [], 0
                    while i < len(ends):
                        j = max(int(np.searchsorted(ends, starts[i] + SEGMENT_IDS, side="right")), i + 1)
                        ids = segment.ids(int(starts[i]), int(ends[j - 1])).astype("<u4", copy=False)
                        sums += [zlib.crc32(ids[a:b]) for a, b in zip(starts[i:j] - starts[i], ends[i:j] - starts[i], strict=True)]
                        i = j
                    yield pd.DataFrame({"_file": file, "doc_id": segment.doc_ids, "_in_file": before + starts, "n_tokens": segment.lengths, "ids_crc32": np.array(sums, dtype=np.int64)})
                    before += segment.n_ids

    # The names of files that one task wrote: part-<task>-...-c<number>.
    name = F.substring_index("path", "/", -1)
    number = F.regexp_extract(name, r"^part-(\d+)", 1).cast("long") * 1_000_000 + F.coalesce(F.regexp_extract(name, r"-c(\d+)", 1).try_cast("long"), F.lit(0))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(number.alias("_file"), "content")
    found = materialize(files.mapInPandas(run, "_file long, doc_id long, _in_file long, n_tokens long, ids_crc32 long"), "token-documents")
    # Running sums by thousands of files, so that no task gets a row of each file.
    sizes = found.groupBy("_file").agg(F.sum("n_tokens").alias("_n")).withColumn("_group", F.floor(F.col("_file") / 1_000_000_000))
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy("_group").agg(F.sum("_n").alias("_all")).select("_group", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_group").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(groups, "_group").select("_file", (F.col("_base") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_before"))
    out = found.join(starts, "_file")
    return out.select(key_or_null("doc_id").alias("doc_id"), (F.col("_before") + F.col("_in_file")).alias("start"), "n_tokens", "ids_crc32")


def token_report(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = END_ID) -> DataFrame:
    """Token files of all documents, written to shared scratch and read back: doc_id, start, n_tokens, ids_crc32.

    One row for each row of docs: repeated ids and rows count each on their own. An empty table gives no rows. Columns
    besides doc_id and text are ignored.
    """
    spark = docs.sparkSession
    path = f"{scratch_root(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, path, vocabulary, end_id)
    return read_documents(spark, path)
