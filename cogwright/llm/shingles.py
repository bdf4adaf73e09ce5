"""Hashed sets of word shingles, for whole batches of texts at a time."""

from __future__ import annotations

import numpy as np

from .common import SpanHasher, batch_buffer, mix64, word_spans

_STEP = np.uint64(0x9FB21C651E98DF25)
_SHORT = np.uint64(0xA0761D6478BD642F)


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, lower-cased in A-Z, and each text's first word (one more entry at the end)."""
    data, offsets = batch_buffer(texts)
    starts, ends = word_spans(data)
    return SpanHasher(data).spans(starts, ends), np.searchsorted(starts, offsets)


def shingle_sets(texts: list, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: of `width` words, or of all words where there are fewer."""
    words, first = word_hashes(texts)
    n = len(words)
    with np.errstate(over="ignore"):
        joined = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
        for k in range(width):
            joined = joined * _STEP + words[k : k + len(joined)]
        joined = mix64(joined)
        out = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= width:
                h = np.sort(joined[a : b - width + 1])
                out.append(h[np.concatenate(([True], h[1:] != h[:-1]))])
            elif b > a:
                x = _SHORT * np.uint64(b - a)
                for w in words[a:b]:
                    x = x * _STEP + w
                out.append(mix64(np.array([x], dtype=np.uint64)))
            else:
                out.append(words[:0])
    return out
