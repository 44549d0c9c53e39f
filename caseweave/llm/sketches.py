"""Hashes of five-word shingles and the smallest of them under several mixings, which near
copies share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from caseweave.llm.words import words_of

WORDS = 5
_A, _B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def shingle_hashes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Hashes of all shingles, how many each text has, and a digest of each text's words."""
    words = words_of(lowered(texts))
    h = words.hashes()[words.at]
    code = np.zeros(len(h), np.uint64)
    for k in range(WORDS):
        shifted = np.concatenate([h[k:], np.zeros(min(k, len(h)), np.uint64)])
        code = (code ^ shifted) * np.uint64(_A)
        code ^= code >> np.uint64(29)
    some = words.counts > 0
    counts = np.where(some, np.maximum(words.counts - WORDS + 1, 1), 0)
    starts = np.repeat(words.first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    # a text under five words has one shingle, which must not take in the words after it
    found = code[starts] if len(starts) else code[:0]
    short = np.flatnonzero(some & (words.counts < WORDS))
    data, edges = h.tobytes(), np.cumsum(words.counts) * 8
    begins = edges - words.counts * 8
    spans = list(zip(begins.tolist(), edges.tolist()))
    at = np.cumsum(counts) - counts
    for i in short.tolist():
        found[at[i]] = xxhash.xxh64_intdigest(data[spans[i][0] : spans[i][1]])
    return found, counts, [xxhash.xxh3_128_digest(data[a:b]) for a, b in spans]


def lowered(texts: pa.StringArray) -> pa.StringArray:
    """A-Z lower-cased in the bytes."""
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    upper = (data >= 65) & (data <= 90)
    return pa.StringArray.from_buffers(
        len(texts), texts.buffers()[1], pa.py_buffer(np.where(upper, data + 32, data).astype(np.uint8)), None, 0, texts.offset
    )


def smallest(code: np.ndarray, counts: np.ndarray, places: int) -> np.ndarray:
    """For each text and place the smallest of its shingles' hashes under the place's mixing."""
    out = np.zeros((len(counts), places), np.uint64)
    some = np.flatnonzero(counts)
    heads = (np.cumsum(counts) - counts)[some]
    for k in range(places if len(some) else 0):
        mixed = (code ^ np.uint64((2 * k + 1) * _B % 2**64)) * np.uint64(((k + 3) * _A | 1) % 2**64)
        mixed ^= mixed >> np.uint64(32)
        out[some, k] = np.minimum.reduceat(mixed, heads)
    return out
