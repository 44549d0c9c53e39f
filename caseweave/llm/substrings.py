"""Words in runs that occur elsewhere are removed, by suffix automata of reference shards.

The corpus is its own reference, so automata of all of it can neither be held nor be sent to
every document: that grows with the square of the input. Each block of documents instead gets
the passages of the reference that it can match, and builds their automata in shards of
``SHARD`` words:

1. Every block of documents sends the hashes of its windows of ``WINDOW`` words, each once, to
   bins by hash.
2. A bin finds hashes that several blocks have, or one block more than once. One of these blocks
   is asked to send the window to all others, another to send it to that one, and a block that has
   it more than once to keep it for itself. Blocks are drawn by hash of the block and the smallest
   hash of the next ``REACH`` windows, which neighbours mostly share: no block sends all windows,
   and windows that follow each other have the same sender.
3. Blocks send runs of such windows as passages. A window shared by any number of documents
   reaches a block once.
4. Blocks build the automata of the passages they got and stream their documents against them;
   spans with a matching statistic of a window or more are removed.

Hashes only decide which passages travel; what is removed is decided by the words. A window is
missed only if its ``BITS``-bit hash is that of another window of its bin, which has a chance of
about one in 10^8 whatever the size of the corpus, as bins grow in number, not in size. Blocks
and bins are as many as the shuffle partitions, which the session sizes with its data. Documents
go to blocks by hash of doc_id, so copies and frequent passages are spread.

Defined results: null and empty texts have no words; texts shorter than a window are kept; of
equal texts all are emptied, as each window occurs elsewhere; so are rows that repeat a doc_id
with the same text. Every row of the input gets a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.automaton import SuffixAutomaton
from caseweave.llm.common import id_and_text, table
from caseweave.llm.words import Words, per_text, words_of

WINDOW = 35
SHARD = 100_000
BITS = 48
REACH = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(words: Words, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Where windows start among all words, and a hash of each."""
    n, text = len(words.at), words.text
    starts = np.flatnonzero(text[size - 1 :] == text[: n - size + 1]) if n >= size else np.zeros(0, np.int64)
    piece, length, code, done = words.hashes()[words.at] * _ODD, 1, np.zeros(n, np.uint64), 0
    factor = int(_ODD)
    while length <= size:
        if size & length:  # append the next ``length`` words
            shifted = np.concatenate([piece[done:], np.zeros(done, np.uint64)])
            code = code * np.uint64(factor) + shifted
            done += length
        piece = piece * np.uint64(factor) + np.concatenate([piece[length:], np.zeros(length, np.uint64)])
        factor = factor * factor % 2**64
        length *= 2
    code ^= code >> np.uint64(32)
    code *= np.uint64(0xD6E8FEB86659FD93)
    code ^= code >> np.uint64(32)
    return starts, code[starts]


def _places(code: np.ndarray) -> np.ndarray:
    """A byte for each window from the smallest hash of the ``REACH`` windows that it begins."""
    least, length = code.copy(), 1
    while length < min(REACH, len(code)):
        least[:-length] = np.minimum(least[:-length], least[length:])
        length *= 2
    return (least * _ODD >> np.uint64(56)).astype(np.uint8)


def _bins(code: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    return code % np.uint64(bins), code >> np.uint64(64 - BITS)


def _packed(low: np.ndarray) -> bytes:
    return low.astype(np.uint32).tobytes() + (low >> np.uint64(32)).astype(np.uint16).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    n = len(data) // 6
    low = np.frombuffer(data, np.uint32, n).astype(np.uint64)
    return low | np.frombuffer(data, np.uint16, n, 4 * n).astype(np.uint64) << np.uint64(32)


def _cuts(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of equal neighbours."""
    edges = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])) if len(values) else [0]
    return zip(edges[:-1], edges[1:])


def _tabled(rows: list, names: list[str], kinds: list) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.Table.from_arrays([pa.array(list(x), t) for x, t in zip(columns, kinds)], names=names)


def _texts(group: pa.Table) -> pa.StringArray:
    return pa.concat_arrays(group["text"].chunks) if group.num_rows else pa.array([], pa.string())


def _sent(bins: int):
    def run(docs: pa.Table) -> pa.Table:
        code = window_hashes(words_of(_texts(docs)))[1]
        near = _places(code)
        code, first, times = np.unique(code, return_index=True, return_counts=True)
        place, low = _bins(code, bins)
        order = np.lexsort((low, place))
        place, low, times, near = place[order], low[order], times[order], near[first][order]
        block = docs["block"][0].as_py()
        rows = [
            [int(place[a]), block, _packed(low[a:b]), np.packbits(times[a:b] > 1).tobytes(), near[a:b].tobytes()]
            for a, b in _cuts(place)
        ]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return _tabled(rows, ["bin", "block", "hashes", "twice", "near"], kinds)

    return run


def _asked(group: pa.Table) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda x: x["block"])
    parts = [_unpacked(x["hashes"]) for x in rows]
    low = np.concatenate(parts)
    block = np.repeat([x["block"] for x in rows], [len(x) for x in parts])
    twice = np.concatenate(
        [np.unpackbits(np.frombuffer(x["twice"], np.uint8), count=len(y)) for x, y in zip(rows, parts)]
    ).astype(bool)
    near = np.concatenate([np.frombuffer(x["near"], np.uint8) for x in rows])
    order = np.argsort(low, kind="stable")
    low, block, twice, near = low[order], block[order], twice[order], near[order]
    first = np.concatenate([[True], low[1:] != low[:-1]])
    head = np.flatnonzero(first)
    # the holder that sends a window is drawn by hash, so that no block sends them all; holders
    # differ in what is near a window at the end of what they share, so one of these is taken
    near = np.minimum.reduceat(near, head)[np.cumsum(first) - 1].astype(np.uint64)
    drawn = (block.astype(np.uint64) * _ODD ^ near * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xD6E8FEB86659FD93)
    drawn = (drawn ^ drawn >> np.uint64(32)) * _ODD
    order = np.lexsort((drawn, low))
    block, twice = block[order], twice[order]
    of = np.cumsum(first) - 1
    size = np.diff(np.concatenate([head, [len(low)]]))
    others = np.flatnonzero(~first & (block != block[head][of]))
    several = others[np.concatenate([[True], of[others][1:] != of[others][:-1]])] if len(others) else others
    alone = np.flatnonzero(twice)
    sender = np.concatenate([block[head][of[others]], block[several], block[alone]])
    target = np.concatenate([block[others], block[head][of[several]], block[alone]])
    which = np.concatenate([low[others], low[several], low[alone]])
    order = np.lexsort((which, target, sender))
    sender, target, which = sender[order], target[order], which[order]
    bin_, out = group["bin"][0].as_py(), []
    for a, b in _cuts(sender):
        out.append([int(sender[a]), bin_, _packed(which[a:b]), target[a:b].astype(np.uint32).tobytes()])
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return _tabled(out, ["block", "bin", "hashes", "targets"], kinds)


def _passages(bins: int):
    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        """Runs of the windows asked for, to each block that asked for them."""
        kinds = [pa.int64(), pa.string()]
        if not asked.num_rows:
            return _tabled([], ["block", "passage"], kinds)
        words = words_of(_texts(docs))
        starts, code = window_hashes(words)
        code, first = np.unique(code, return_index=True)
        place, low = _bins(code, bins)
        order = np.lexsort((low, place))
        place, low, start = place[order], low[order], starts[first][order]
        edge = {int(place[a]): (a, b) for a, b in _cuts(place)}
        targets, wanted = [], []
        for row in asked.to_pylist():
            a, b = edge[row["bin"]]
            hashes = _unpacked(row["hashes"])
            target = np.frombuffer(row["targets"], np.uint32)
            left = a + np.searchsorted(low[a:b], hashes)
            right = a + np.searchsorted(low[a:b], hashes, side="right")
            n = right - left  # more than one only if hashes collide in the block
            at = np.repeat(left - np.cumsum(n) + n, n) + np.arange(n.sum())
            targets.append(np.repeat(target, n))
            wanted.append(start[at])
        target, wanted = np.concatenate(targets).astype(np.int64), np.concatenate(wanted)
        order = np.lexsort((wanted, target))
        target, wanted = target[order], wanted[order]
        text = words.text
        new = np.concatenate(
            [[True], (target[1:] != target[:-1]) | (wanted[1:] != wanted[:-1] + 1) | (text[wanted[1:]] != text[wanted[:-1]])]
        )
        head = np.flatnonzero(new)
        tail = np.concatenate([head[1:], [len(wanted)]]) - 1
        n = wanted[tail] + WINDOW - wanted[head]
        at = np.repeat(wanted[head] - np.cumsum(n) + n, n) + np.arange(n.sum())
        edges = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        lists = pa.ListArray.from_arrays(edges, words.distinct.take(pa.array(words.at[at])))
        return pa.table({"block": target[head], "passage": pc.binary_join(lists, " ")})

    return run


def covered_words(words: Words, n_texts: int, shard: int = SHARD, size: int = WINDOW) -> np.ndarray:
    """Which words of the first ``n_texts`` texts lie in a window that the other texts have."""
    own = int(words.counts[:n_texts].sum())
    starts, code = window_hashes(words, size)
    mine = starts < own
    theirs, known = starts[~mine], code[~mine]
    covered = np.zeros(own, bool)
    if not len(known):
        return covered
    # shards: passages one after the other, up to ``shard`` words
    counts = words.counts[n_texts:]
    number = (np.cumsum(counts) - counts) // shard
    shard_of_window = number[words.text[theirs] - n_texts]
    known, first = np.unique(known, return_index=True)
    shard_of_window = shard_of_window[first]
    place = np.minimum(np.searchsorted(known, code[mine]), len(known) - 1)
    hit = known[place] == code[mine]
    begin, shard_of = starts[mine][hit], shard_of_window[place[hit]]
    text = words.text
    new = np.concatenate([[True], (begin[1:] != begin[:-1] + 1) | (text[begin[1:]] != text[begin[:-1]])])
    head = np.flatnonzero(new)
    at = words.at.astype(np.int32)
    segments: dict[bytes, tuple[set, list]] = {}
    for a, b in zip(head.tolist(), [*head[1:].tolist(), len(begin)]):
        if a < b:
            i, j = int(begin[a]), int(begin[b - 1]) + size
            shards, places = segments.setdefault(at[i:j].tobytes(), (set(), []))
            shards.update(shard_of[a:b].tolist())
            places.append(i)
    by_shard: dict[int, list[bytes]] = {}
    for segment, (shards, _) in segments.items():
        for k in shards:
            by_shard.setdefault(k, []).append(segment)
    ends = np.cumsum(words.counts)
    for k, some in by_shard.items():
        texts = np.flatnonzero(number == k) + n_texts
        machine = SuffixAutomaton(at[ends[i] - words.counts[i] : ends[i]].tolist() for i in texts.tolist())
        for segment in some:
            found = np.array(machine.matches(np.frombuffer(segment, np.int32).tolist()))
            last = np.flatnonzero(found >= size)
            if len(last):
                marks = np.zeros(len(found) + 1, np.int64)
                np.add.at(marks, last - size + 1, 1)
                np.add.at(marks, last + 1, -1)
                inside = np.cumsum(marks[:-1]) > 0
                for i in segments[segment][1]:
                    covered[i : i + len(inside)] |= inside
    return covered


def _kept(docs: pa.Table, passages: pa.Table) -> pa.Table:
    texts, n = _texts(docs), docs.num_rows
    if passages.num_rows:
        words = words_of(pa.concat_arrays([texts, *passages["passage"].chunks]))
    else:
        words = words_of(texts)
    covered = covered_words(words, n)
    counts, own = words.counts[:n], len(covered)
    removed = per_text(covered, counts)
    edges = np.concatenate([[0], np.cumsum(counts - removed)])
    rest = words.distinct.take(pa.array(words.at[:own][~covered]))
    kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rest), " ")
    return pa.table(
        {"doc_id": docs["doc_id"], "n_words": counts.astype(np.int64), "n_removed": removed.astype(np.int64), "kept": kept}
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words left of every row, joined by spaces."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(parts))
    docs = id_and_text(docs).withColumn("block", block.cast("long")).groupBy("block")
    hashes = docs.applyInArrow(_sent(parts), "bin long, block long, hashes binary, twice binary, near binary")
    asked = hashes.groupBy("bin").applyInArrow(_asked, "block long, bin long, hashes binary, targets binary")
    passages = docs.cogroup(asked.groupBy("block")).applyInArrow(_passages(parts), "block long, passage string")
    return docs.cogroup(passages.groupBy("block")).applyInArrow(
        _kept, "doc_id long, n_words long, n_removed long, kept string"
    )


def op5_substrings(spark, folder: str) -> DataFrame:
    kept = without_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), windows AS (
    SELECT row, pos, array_to_string(w[pos:pos + 34], ' ') AS words
    FROM (SELECT row, w, unnest(range(1, greatest(len(w) - 33, 1))) AS pos FROM docs)
), repeated AS (
    SELECT row, pos FROM (SELECT row, pos, count(*) OVER (PARTITION BY words) AS times FROM windows)
    WHERE times > 1
), marked AS (
    SELECT w.row, w.pos, w.word, max(r.pos) OVER (
        PARTITION BY w.row ORDER BY w.pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW
    ) IS NOT NULL AS gone
    FROM (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs) w
    LEFT JOIN repeated r ON r.row = w.row AND r.pos = w.pos
), left_over AS (
    SELECT row, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept
    FROM marked GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN left_over USING (row)
"""
