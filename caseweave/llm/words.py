"""Words of many texts at once, as places in their list of distinct words."""

from __future__ import annotations

import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


@dataclass
class Words:
    """``at`` has the place in ``distinct`` of each word; text i has ``counts[i]`` of them."""

    distinct: pa.StringArray
    at: np.ndarray
    counts: np.ndarray

    @property
    def first(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """64 bits for each distinct word."""
        found = map(xxhash.xxh64_intdigest, self.distinct.cast(pa.binary()).to_pylist())
        return np.fromiter(found, np.uint64, len(self.distinct))

    def sums(self, of_distinct: np.ndarray) -> np.ndarray:
        """A value of the distinct words, added up over each text."""
        return per_text(of_distinct[self.at], self.counts)


def per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive ``counts`` values."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def words_of(texts: pa.StringArray) -> Words:
    """Runs of anything but space and 0x09-0x0D."""
    parts = pc.ascii_split_whitespace(texts)
    ends = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    real = (pc.binary_length(coded.dictionary).to_numpy() > 0)[at]
    ends = np.concatenate([[0], np.cumsum(real)])[ends - ends[0]]
    return Words(coded.dictionary, at[real], np.diff(ends))


def release() -> None:
    """Give freed memory back to the system: Python workers live on after a task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch, text: int, most: int = 8 << 20):
    """Parts of a batch of about ``most`` bytes of text."""
    size = np.cumsum(pc.binary_length(batch.column(text)).to_numpy())
    at = 0
    while at < batch.num_rows:
        used = size[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(size, used + most)))
        yield batch.slice(at, stop - at)
        at = stop
    release()
