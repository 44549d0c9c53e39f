"""Tokens of two tokenizers of the same text, linked where their ends meet.

A is the byte-level tokenizer, given a space and the text; B is the piece tokenizer, which adds
that space itself. Byte offsets where tokens of both end cut the tokens into groups, and every A
token of a group is linked to every B token of it.

Documents are tokenised whole. A shared end after which both sides go on with a token that
begins with a space is an anchor; the anchors cut a document into windows of token ids. Windows
repeat (most are a word), so each is a row of ids (how many are of A, these, those of B) that is
numbered within a block of documents, and the groups, links and digest text are worked out once
for each distinct row of ids and remembered for all places of the block that have it.

A block is written as one row: its documents, their windows by number, and the links of the
distinct windows. Distinct pairs of ids with the documents of the block that hold them are dealt
by A id, packed, a row for each block and bucket. A bucket adds them up to the corpus-wide
counts, sees the highest count of each of its A ids, and sends each block the counts of the
pairs it sent. A pair is one entry of a block however often its documents repeat it. Rows are as
many as blocks times buckets at most, and buckets as many as the shuffle partitions, which the
session sizes with its data.

Defined results: texts that are null, empty, or not spelt by their tokens (U+2581, which B takes
for a space) have no tokens, zeros and the digest ''. Rows that repeat a doc_id, or have none,
are documents of their own. Strings of special tokens are plain text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import id_and_text, table
from caseweave.llm.units import Encoder, tokenizer_path
from caseweave.llm.words import release, slices
from caseweave.workspace import written

PIECES = "piece_bpe_32k.model"
#: Bytes of text of a block.
BLOCK = 2 << 20
#: Groups with more links than this are linked by their distinct ids.
WIDE = 4096

_BLOCKS = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, digests array<string>, doc_windows binary, codes binary, links binary, "
    "pairs binary, times binary, keys array<long>, docs array<long>"
)
_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)
_ZSTD = pa.Codec("zstd")


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


def _byte_level() -> dict[str, int]:
    """The bytes that the characters of byte-level tokens stand for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Ids of both sides and the bytes of each id."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor

        self.a = Encoder(a_path)
        self.a.tokenizer.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_path)
        byte = _byte_level()
        self.a_bytes = [b""] * len(self.a.length)
        for token, i in self.a.tokenizer.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes(byte[c] for c in token)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_table, self.b_table = (pa.array(x, pa.large_binary()) for x in (self.a_bytes, self.b_bytes))
        self.a_lengths, self.b_lengths = (
            np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes)
        )
        self.a_spaces, self.b_spaces = (
            np.fromiter((y[:1] == b" " for y in x), bool, len(x)) for x in (self.a_bytes, self.b_bytes)
        )
        self.shown = pa.array(
            [f"{i}{end}" for tokens, ends in ((self.a_bytes, ",|"), (self.b_bytes, (",", ";", ""))) for end in ends for i in range(len(tokens))],
            pa.large_string(),
        )

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of B, a few texts at a time, as the library gives lists."""
        parts, counts = [], []
        for at in range(0, len(texts), 64):
            some = self.b.encode(texts[at : at + 64], num_threads=1)
            counts += map(len, some)
            parts.append(np.fromiter(chain.from_iterable(some), np.int64))
        return np.concatenate([*parts, np.zeros(0, np.int64)]), np.array(counts, np.int64)

    def encoded(self, texts: pa.StringArray) -> tuple[np.ndarray, ...]:
        """Ids of A and how many each text has, the same of B; none for a text not spelt by both."""
        a, n_a = self.a.texts(texts, lead=" ")
        b, n_b = self._pieces(texts.to_pylist())
        a, n_a = a.astype(np.int64), n_a.astype(np.int64)
        text = pc.binary_join_element_wise("", texts, " ").cast(pa.large_binary())
        good = pc.binary_length(text).to_numpy() > 1
        good &= _spelt(text, self.a_table, a, n_a) & _spelt(text, self.b_table, b, n_b)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        return a, np.where(good, n_a, 0), b, np.where(good, n_b, 0)


def _spelt(texts: pa.LargeBinaryArray, table: pa.LargeBinaryArray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether the bytes of a text's tokens are the text."""
    joined = table.take(pa.array(ids))
    edges, data = joined.buffers()[1:]
    edges = np.frombuffer(edges, np.int64)[np.concatenate([[0], np.cumsum(counts)])] if len(joined) else np.zeros(len(counts) + 1, np.int64)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(edges), data or pa.py_buffer(b"")])
    return pc.equal(found, texts).to_numpy(zero_copy_only=False)


@cache
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """One pair for each Python worker."""
    return Tokenizers(a_path, b_path)


def cut_windows(tools: Tokenizers, a, n_a, b, n_b) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The windows of all documents one after the other, and how many each has."""
    a_ends, b_ends = np.cumsum(tools.a_lengths[a]), np.cumsum(tools.b_lengths[b])
    shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
    i, j = np.searchsorted(a_ends, shared), np.searchsorted(b_ends, shared)
    last = np.zeros(len(a), bool)
    last[np.cumsum(n_a)[n_a > 0] - 1] = True
    after_a, after_b = np.minimum(i + 1, len(a) - 1), np.minimum(j + 1, len(b) - 1)
    anchor = last[i] | tools.a_spaces[a[after_a]] & tools.b_spaces[b[after_b]]
    i, j = i[anchor], j[anchor]
    of_a, of_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
    ends = np.cumsum(1 + of_a + of_b)
    begins = ends - (1 + of_a + of_b)
    flat = np.empty(ends[-1] if len(ends) else 0, np.int32)
    flat[begins] = of_a
    flat[_ranges(begins + 1, of_a)] = a
    flat[_ranges(begins + 1 + of_a, of_b)] = b
    edges = np.concatenate([[0], ends]) * 4
    buffers = [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(flat)]
    windows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), buffers)
    count = np.diff(np.searchsorted(i, np.concatenate([[0], np.cumsum(n_a)])))
    return windows, count


class Windows:
    """Groups and links of windows, worked out together."""

    def __init__(self, tools: Tokenizers, windows: pa.LargeBinaryArray):
        n = len(windows)
        edges, data = windows.buffers()[1:]
        edges = np.frombuffer(edges, np.int64)[windows.offset : windows.offset + n + 1] // 4 if n else np.zeros(1, np.int64)
        flat = np.frombuffer(data, np.int32).astype(np.int64) if n else np.zeros(0, np.int64)
        of_a = flat[edges[:-1]]
        of_b = np.diff(edges) - 1 - of_a
        a = flat[_ranges(edges[:-1] + 1, of_a)]
        b = flat[_ranges(edges[:-1] + 1 + of_a, of_b)]
        # windows one after the other are texts again: ends of groups are shared ends
        a_ends, b_ends = np.cumsum(tools.a_lengths[a]), np.cumsum(tools.b_lengths[b])
        shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
        i, j = np.searchsorted(a_ends, shared), np.searchsorted(b_ends, shared)
        n_a, n_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
        window = np.repeat(np.arange(n), of_a)[i]
        self.groups = np.bincount(window, minlength=n)
        self.links = np.zeros(n, np.int64)
        np.add.at(self.links, window, n_a * n_b)
        self.shown = self._shown(tools, a, b, n_a, n_b, window, n)
        self._pair(a, b, i - n_a + 1, j - n_b + 1, n_a, n_b, window, n)

    @staticmethod
    def _shown(tools: Tokenizers, a, b, n_a, n_b, window, n: int) -> list[str]:
        """The ids of each window's groups as text."""
        first = np.cumsum(n_a + n_b) - n_a - n_b
        size_a, size_b = len(tools.a_bytes), len(tools.b_bytes)
        out = np.empty(len(a) + len(b), np.int64)
        out[_ranges(first, n_a)] = a
        out[_ranges(first + n_a, n_b)] = b + 2 * size_a
        out[first + n_a - 1] += size_a  # the last of A in a group
        ends = first + n_a + n_b - 1
        last = np.append(window[1:] != window[:-1], True) if len(window) else np.zeros(0, bool)
        out[ends] += np.where(last, 2 * size_b, size_b)
        tokens = np.zeros(n, np.int64)
        np.add.at(tokens, window, n_a + n_b)
        text = tools.shown.take(pa.array(out))
        edges, data = text.buffers()[1:]
        edges = np.frombuffer(edges, np.int64)[np.concatenate([[0], np.cumsum(tokens)])] if n else np.zeros(1, np.int64)
        return pa.LargeStringArray.from_buffers(n, pa.py_buffer(edges), data).to_pylist()

    def _pair(self, a, b, first_a, first_b, n_a, n_b, window, n: int) -> None:
        """Distinct pairs of ids of each window, and how often they are linked there."""
        narrow = n_a * n_b <= WIDE
        g = np.flatnonzero(narrow)
        at_a = _ranges(first_a[g], n_a[g])
        times_b = np.repeat(n_b[g], n_a[g])
        left = np.repeat(a[at_a], times_b)
        right = b[_ranges(np.repeat(first_b[g], n_a[g]), times_b)]
        of = np.repeat(np.repeat(window[g], n_a[g]), times_b)
        keys, weights = [left << 32 | right], [np.ones(len(left), np.int64)]
        windows = [of]
        for k in np.flatnonzero(~narrow).tolist():
            x, often_x = np.unique(a[first_a[k] : first_a[k] + n_a[k]], return_counts=True)
            y, often_y = np.unique(b[first_b[k] : first_b[k] + n_b[k]], return_counts=True)
            keys.append((x[:, None] << 32 | y).ravel())
            weights.append((often_x[:, None] * often_y).ravel())
            windows.append(np.full(len(keys[-1]), window[k]))
        self.keys, code = np.unique(np.concatenate(keys), return_inverse=True)
        size = max(len(self.keys), 1)
        found, place = np.unique(np.concatenate(windows) * size + code, return_inverse=True)
        self.times = np.zeros(len(found), np.int64)
        np.add.at(self.times, place, np.concatenate(weights))
        self.pair = found % size
        self.pairs = np.bincount(found // size, minlength=n)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` whole numbers from each of ``starts``."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(total[np.concatenate([[0], np.cumsum(counts)])])


def _packed(values: np.ndarray, kind: str) -> bytes:
    return _ZSTD.compress(values.astype(kind).tobytes(), asbytes=True)


def _unpacked(data: bytes, items: int, kind: str) -> np.ndarray:
    size = items * np.dtype(kind).itemsize
    return np.frombuffer(_ZSTD.decompress(data, size, asbytes=True), kind).astype(np.int64)


def _block(tools: Tokenizers, number: int, ids: pa.Array, texts: pa.StringArray) -> dict:
    a, n_a, b, n_b = tools.encoded(texts)
    windows, count = cut_windows(tools, a, n_a, b, n_b)
    coded = windows.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    found = Windows(tools, coded.dictionary)
    shown = [*map(found.shown.__getitem__, codes.tolist())]
    stops = np.cumsum(count).tolist()
    digests = [
        hashlib.sha256(";".join(shown[i:j]).encode()).hexdigest() if j > i else ""
        for i, j in zip([0, *stops], stops)
    ]
    # documents that hold a pair: by distinct windows of a document first
    doc = np.repeat(np.arange(len(count)), count)
    size = max(len(found.links), 1)
    held = _distinct(doc * size + codes)
    doc, code = held // size, held % size
    n = found.pairs[code]
    at = _ranges((np.cumsum(found.pairs) - found.pairs)[code], n)
    size = max(len(found.keys), 1)
    held = _distinct(np.repeat(doc, n) * size + found.pair[at])
    docs = np.bincount(held % size, minlength=len(found.keys))
    return {
        "block": number,
        "doc_ids": ids.to_pylist(),
        "n_a": n_a.tolist(),
        "n_b": n_b.tolist(),
        "n_groups": _sums(found.groups[codes], count).tolist(),
        "n_links": _sums(found.links[codes], count).tolist(),
        "digests": digests,
        "doc_windows": _packed(count, "<u4"),
        "codes": _packed(codes, "<u4"),
        "links": found.pairs.astype("<u4").tobytes(),
        "pairs": _packed(found.pair, "<u4"),
        "times": _packed(found.times, "<u8"),
        "keys": found.keys,
        "docs": docs,
    }


_DEALT = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("docs", pa.binary())])
_KINDS = pa.schema(
    [("block", pa.int64()), ("doc_ids", pa.list_(pa.int64()))]
    + [(x, pa.list_(pa.int64())) for x in ("n_a", "n_b", "n_groups", "n_links")]
    + [("digests", pa.list_(pa.string()))]
    + [(x, pa.binary()) for x in ("doc_windows", "codes", "links", "pairs", "times")]
    + [("keys", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))]
)


def _blocks(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = tokenizers(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, 1, BLOCK):
                yield pa.RecordBatch.from_pylist([_block(tools, number, *part.columns)], schema=_KINDS)
                number += 1
                release()

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {x: batch.column(x)[k] for x in batch.schema.names}
            known = row["known"].values.flatten() if row["known"].is_valid else [pa.array([], pa.binary())] * 3
            keys, counts, best = (
                np.frombuffer(b"".join(x.to_pylist()), kind) for x, kind in zip(known, (np.int64, np.int64, bool))
            )
            order = np.argsort(keys)
            counts, best = counts[order], best[order].astype(np.int64)
            links = np.frombuffer(row["links"].as_py(), "<u4").astype(np.int64)
            pair = _unpacked(row["pairs"].as_py(), int(links.sum()), "<u4")
            times = _unpacked(row["times"].as_py(), len(pair), "<u8")
            count = _unpacked(row["doc_windows"].as_py(), len(row["doc_ids"]), "<u4")
            codes = _unpacked(row["codes"].as_py(), int(count.sum()), "<u4")
            n_best = _sums(_sums(times * best[pair], links)[codes], count)
            count_sum = _sums(_sums(times * counts[pair], links)[codes], count)
            columns = [row[x].values for x in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
            columns += [pa.array(n_best), pa.array(count_sum), row["digests"].values]
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            yield pa.record_batch(columns, names=names)


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """The blocks of documents (``_BLOCKS``), written once."""
    run = _blocks(a_path or tokenizer_path(), b_path or pieces_path())
    return written(id_and_text(docs).mapInArrow(run, _BLOCKS), "alignments")


def _dealt(buckets: int):
    """The pairs of a block, packed by bucket of their A id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, docs in zip(*batch.columns):
                keys, docs = (x.values.to_numpy().astype(np.int64) for x in (keys, docs))
                bucket = (keys >> 32) % buckets
                order = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
                rows = [
                    {"bucket": bucket[some[0]], "block": block.as_py(), "keys": keys[some].tobytes(), "docs": docs[some].astype("<u4").tobytes()}
                    for some in (order[i:j] for i, j in zip(edges[:-1], edges[1:]))
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=_DEALT)

    return run


def _counted(bucket: pa.Table) -> pa.Table:
    """For each block, the corpus-wide counts of the pairs it sent, and whether no other pair of
    the same A id is in more documents."""
    sent = [np.frombuffer(x, np.int64) for x in bucket["keys"].to_pylist()]
    docs = np.concatenate([np.frombuffer(x, "<u4") for x in bucket["docs"].to_pylist()])
    keys, place = np.unique(np.concatenate(sent), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, place, docs)
    a, of = np.unique(keys >> 32, return_inverse=True)
    highest = np.zeros(len(a), np.int64)
    np.maximum.at(highest, of, counts)
    best = counts == highest[of]
    parts = np.split(place, np.cumsum([len(x) for x in sent])[:-1])
    found = [pa.array([y[x].tobytes() for x in parts], pa.binary()) for y in (counts, best)]
    return pa.table([bucket["block"], bucket["keys"], *found], names=["block", "keys", "counts", "best"])


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(block, keys, counts, best), packed: how many documents of the corpus hold each pair of a
    block linked, and whether no other pair of its A id is in more; a key is the A id, shifted by
    32 bits, and the B id."""
    buckets = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.select("block", "keys", "docs").mapInArrow(_dealt(buckets), "bucket long, block long, keys binary, docs binary")
    return dealt.groupBy("bucket").applyInArrow(_counted, "block long, keys binary, counts binary, best binary")


def alignments(docs: DataFrame) -> DataFrame:
    """The counts and the digest of every row."""
    blocks = aligned(docs)
    known = pair_counts(blocks).groupBy("block").agg(F.collect_list(F.struct("keys", "counts", "best")).alias("known"))
    rows = blocks.drop("keys", "docs").join(known, "block", "left")
    return rows.mapInArrow(_totals, _RESULT)


def op13_alignment(spark, folder: str) -> DataFrame:
    return alignments(table(spark, folder, "documents"))
