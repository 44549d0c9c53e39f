"""Texts cut where the byte-level tokenizer always cuts, and the ids of the pieces.

The tokenizer never lets a token reach over a single space between two characters that are not
white space: the space opens the next pre-token. A text cut before each such space (a *unit*
is what lies between two cuts) therefore has the ids of its units one after the other. Units
repeat, so each distinct one of a batch is looked up once and encoded only if the task does
not know it; the library gets many new ones in one text, cut by the same rule, and the byte
lengths of the tokens tell where each unit ends.
"""

from __future__ import annotations

import os
import re
from functools import cache
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core

FILE = "byte_bpe_50k.json"
_CUT = re.compile(r"(?<=\S)(?= \S)")
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
#: Pieces between two spaces that are no unit by themselves.
_ODD = f"^$|^{_SPACE}|{_SPACE}$"
_OTHER = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_PLAIN = f"(?s)^ {_OTHER}$|^ {_OTHER}.*{_OTHER}$"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(FILE)


def units(text: str) -> list[str]:
    return _CUT.split(text) if text else []


def strings(array: pa.StringArray) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def cut(texts: pa.StringArray, lead: str = "") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Units, their places in the texts one after the other, and units a text.

    ``lead`` is put before every text. All spaces are taken as cuts first. Texts where one of them is none are cut again.
    A unit is named up to three times: as a piece, as the head of a text, and by texts cut again.
    """
    pieces = pc.split_pattern(texts, " ")
    ends = pieces.offsets.to_numpy().astype(np.int64)
    coded = pieces.flatten().dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = coded.dictionary
    odd = pc.match_substring_regex(distinct, _ODD).to_numpy(zero_copy_only=False)
    ends -= ends[0]
    first, last, n = ends[:-1], ends[1:] - 1, len(texts)
    strange = np.add.reduceat(odd[at], first) > 0 if n else np.zeros(0, bool)
    names = strings(pc.binary_join_element_wise("", distinct, " "))
    number: dict[str, int] = {}
    heads = strings(distinct.take(pa.array(at[first]))) if n else []
    head = np.fromiter((number.setdefault(lead + x, len(number)) for x in heads), np.int64, n)
    at[first] = len(names) + head
    names += number
    counts = np.diff(ends)
    if strange.any():
        parts, number = [], {}
        bounds = np.flatnonzero(strange)
        done = 0
        for i in bounds.tolist():
            parts.append(at[done : first[i]])
            own = units(lead + texts[i].as_py())
            parts.append(
                np.fromiter((len(names) + number.setdefault(x, len(number)) for x in own), np.int64, len(own))
            )
            counts[i] = len(own)
            done = ends[i + 1]
        parts.append(at[done:])
        at = np.concatenate(parts)
        names += number
    return names, at, counts


def are_plain(some: list[str]) -> np.ndarray:
    """Whether units can be put before and after them without another cut."""
    return pc.match_substring_regex(pa.array(some, pa.string()), _PLAIN).to_numpy(zero_copy_only=False)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` whole numbers from each of ``starts``."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


class Encoder:
    """Ids of units by the library, remembered for ``most`` distinct units at a time.

    A unit is known by its place among ``counts``, and its ids lie in ``flat`` one unit after the
    other. When there are too many, those that were not seen again since last time are forgotten.
    """

    def __init__(self, path: str, most: int = 800_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder()
        self.length = np.zeros(size, np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.length[i] = len(added[i].content.encode()) if i in added else len(token)
        self.most = most
        self.known: dict[str, int] = {}
        self.flat, self.counts, self.seen = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, bool)

    def encode(self, wanted: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units one after the other, and how many each has."""
        plain = are_plain(wanted)
        some = list(compress(wanted, plain.tolist()))
        texts = ["".join(some[i : i + 128]) for i in range(0, len(some), 128)]
        ids = np.fromiter(chain.from_iterable(self._ids(texts)), np.uint32)
        stops = np.cumsum(np.fromiter(map(len, map(str.encode, some)), np.int64, len(some)))
        ends = np.cumsum(self.length[ids])
        last = np.searchsorted(ends, stops)
        if len(stops) and not np.array_equal(ends[last], stops):
            raise ValueError("the tokenizer joined two units")
        counts = np.zeros(len(wanted), np.int64)
        counts[plain] = np.diff(last + 1, prepend=0)
        if not plain.all():
            alone = self._ids([wanted[i] for i in np.flatnonzero(~plain).tolist()])
            counts[~plain] = [len(x) for x in alone]
            flat = np.empty(counts.sum(), np.uint32)
            of_plain = np.repeat(plain, counts)
            flat[of_plain], flat[~of_plain] = ids, [*chain.from_iterable(alone)]
            ids = flat
        return ids, counts

    def _ids(self, texts: list[str]) -> list[list[int]]:
        steps = (texts[i : i + 256] for i in range(0, len(texts), 256))  # the library keeps much of a token
        return [x.ids for some in steps for x in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]

    def ids(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``; units not known yet are learnt, each once however often it is named."""
        place = np.array(list(map(self.known.get, names, repeat(-1))), np.int64)
        new = place < 0
        self.seen[place[~new]] = True
        if new.any():
            unknown = list(compress(names, new.tolist()))
            fresh = list(dict.fromkeys(unknown))
            n = len(self.counts)
            ids, counts = self.encode(fresh)
            self.known.update(zip(fresh, range(n, n + len(fresh))))
            place[new] = list(map(self.known.__getitem__, unknown))
            self.flat, self.counts = np.concatenate([self.flat, ids]), np.concatenate([self.counts, counts])
            self.seen = np.concatenate([self.seen, np.zeros(len(fresh), bool)])
        counts = self.counts[place]
        found = self.flat[_ranges((np.cumsum(self.counts) - self.counts)[place], counts)]
        if len(self.counts) > self.most:
            self._forget(place)
        return found, counts

    def _forget(self, last: np.ndarray) -> None:
        """Keep the units seen again, or just learnt; the newest half if those are too many."""
        self.seen[last] = True
        kept = np.flatnonzero(self.seen)[-self.most // 2 :]
        keep = np.zeros(len(self.seen), bool)
        keep[kept] = True
        self.known = dict(zip(compress(self.known, keep.tolist()), range(len(kept))))
        self.flat, self.counts = self.flat[np.repeat(keep, self.counts)], self.counts[keep]
        self.seen = np.zeros(len(kept), bool)

    def texts(self, texts: pa.StringArray, lead: str = "") -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after the other, and how many each has; ``lead`` (a space or
        nothing) is put before each."""
        names, at, units_of = cut(texts, lead)
        flat, counts = self.ids(names)
        start = np.cumsum(counts) - counts
        n = counts[at]
        total = np.cumsum(n)
        source = _ranges(start[at], n)
        edges = np.concatenate([[0], np.cumsum(units_of)])
        summed = np.concatenate([[0], total])[edges]
        return flat[source], np.diff(summed)


@cache
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)
