"""Simple-8b words: as many ids as fit are packed in the 60 low bits of a 64-bit word.

The four high bits, the selector, say how many ids of how many bits there are: the widest run
of ids that fits is taken. ``ESCAPE`` holds one id of any size up to 60 bits. Ids are packed in
blocks of ``BLOCK``; no word crosses a block, and the place of each block's first word is kept,
so blocks are decoded side by side and any of them by itself.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
#: (ids, bits of each) by selector
LAYOUT = [(1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8), (8, 7), (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1)]
ESCAPE = 0
_COUNT = np.array([c for c, _ in LAYOUT] + [0, 0], np.int64)
_MARGIN = 60
_TOGETHER = 4096


def _encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blocks = -(-len(ids) // BLOCK)
    padded = np.zeros((blocks, BLOCK + _MARGIN), np.uint64)
    lengths = np.full(blocks, BLOCK)
    lengths[-1] = len(ids) - (blocks - 1) * BLOCK
    padded[:-1, :BLOCK] = ids[: (blocks - 1) * BLOCK].reshape(-1, BLOCK)
    padded[-1, : lengths[-1]] = ids[(blocks - 1) * BLOCK :]
    width = np.frexp(padded.astype(np.float64))[1].astype(np.uint8)
    # widest[c]: the most bits among an id and the c - 1 after it
    flat = np.concatenate([width.ravel(), np.zeros(_MARGIN, np.uint8)])
    n = width.size
    select = np.zeros(n, np.uint8)
    widest, have = flat, 1
    for selector, (count, bits) in enumerate(LAYOUT):
        step = count - have
        if step:
            widest = np.maximum(widest, np.concatenate([widest[step:], np.zeros(step, np.uint8)]))
            have = count
        if selector:
            select[widest[:n] <= bits] = selector
    at, row = np.zeros(blocks, np.int64), np.arange(blocks)
    taken = []
    while len(row):
        place = row * (BLOCK + _MARGIN) + at
        taken.append(place)
        at = at + _COUNT[select[place]]
        more = at < lengths[row]
        row, at = row[more], at[more]
    place = np.sort(np.concatenate(taken))
    chosen = select[place]
    words = chosen.astype(np.uint64) << np.uint64(60)
    flat_ids = padded.ravel()
    for selector, (count, bits) in enumerate(LAYOUT):
        of = np.flatnonzero(chosen == selector)
        if len(of):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            values = flat_ids[place[of][:, None] + np.arange(count)] << shifts
            words[of] |= np.bitwise_or.reduce(values, axis=1)
    return words, np.bincount(place // (BLOCK + _MARGIN), minlength=blocks)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and how many of them each block has."""
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if int(ids.max()) >= 1 << 60:
        raise ValueError("ids of 60 bits at most")
    done = [_encode(ids[i : i + BLOCK * _TOGETHER]) for i in range(0, len(ids), BLOCK * _TOGETHER)]
    return np.concatenate([x for x, _ in done]), np.concatenate([x for _, x in done])


def decode(words: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of whole blocks; ``counts`` holds the words of each block."""
    blocks = len(counts)
    out = np.zeros((blocks, BLOCK + _MARGIN), np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    taken = _COUNT[selector]
    before = np.cumsum(taken) - taken
    block = np.repeat(np.arange(blocks), counts)
    first = np.cumsum(counts) - counts
    place = before - before[first][block] + block * (BLOCK + _MARGIN) if len(words) else before
    flat = out.ravel()
    for k, (count, bits) in enumerate(LAYOUT):
        of = np.flatnonzero(selector == k)
        if len(of):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            values = (words[of][:, None] >> shifts) & np.uint64((1 << bits) - 1)
            flat[place[of][:, None] + np.arange(count)] = values
    return out[:, :BLOCK].ravel()[:n]
