"""Token counts of documents without token ids.

A pre-token here is the text between two places where the tokenizer always cuts (see
``units``). Each block of documents (a batch of a task) is reduced to its distinct pre-tokens
with the documents that hold them and how often. These entries are dealt by pre-token: a task
counts the pieces of each of its distinct pre-tokens once and multiplies the frequencies by
them; the products, summed for each document, go back to the block, which adds up what all
tasks have found. Texts are not shuffled, and neither are ids, which are never kept.

Entries travel packed, a row for each block and bucket. A pre-token that most documents of a
block hold is dealt to ``SALTS`` buckets, by block, so a frequent one is counted that many
times at most and its entries do not meet in one task. The number of buckets is that of the
shuffle partitions, which the session sizes with its data.

Blocks are told apart by partition and batch, so ``docs`` must give the same rows in the same
order when read again: a table, not the outcome of a shuffle. Defined results: a null text is
empty and has no tokens; rows that repeat a doc_id, or have none, each get a row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import id_and_text, table
from caseweave.llm.units import cut, encoder, tokenizer_path

LIMIT = 1024
SALTS = 16
_ROWS = pa.schema(
    [
        ("bucket", pa.int64()),
        ("block", pa.int64()),
        ("names", pa.binary()),
        ("sizes", pa.binary()),
        ("docs", pa.binary()),
        ("times", pa.binary()),
    ]
)
_SQL_ROWS = "bucket long, block long, names binary, sizes binary, docs binary, times binary"


def entries_of_block(block: int, ids: list, texts: pa.StringArray, buckets: int) -> list[list]:
    """Rows: the documents of the block once, then its entries by bucket."""
    units, flat, parts = cut(texts)
    n = len(ids)
    pairs, times = np.unique(flat * n + np.repeat(np.arange(n), parts), return_counts=True)
    word, doc = pairs // n, pairs % n
    held = np.bincount(word, minlength=len(units))
    names = [x.encode() for x in units]
    salt = np.where(held * 2 > n, block % SALTS, 0)
    place = np.fromiter(map(zlib.crc32, names), np.int64, len(names))
    place = (place + salt * 7919) % buckets
    first = np.cumsum(held) - held
    known = np.array([x is not None for x in ids])
    rows = [
        [
            block % buckets,
            block,
            None,
            np.where(known, np.array([x or 0 for x in ids], np.int64), 0).tobytes() + known.tobytes(),
            pc.binary_length(texts).to_numpy().astype(np.int64).tobytes(),
            None,
        ]
    ]
    order = np.argsort(np.where(held > 0, place, -1), kind="stable")
    order = order[np.count_nonzero(held == 0) :]  # pieces that are no unit
    cuts = np.flatnonzero(np.diff(place[order], prepend=-1, append=-1))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        chosen = order[a:b]
        at = np.repeat(first[chosen] - np.cumsum(held[chosen]) + held[chosen], held[chosen])
        at += np.arange(len(at))
        some = [names[i] for i in chosen.tolist()]
        shape = np.stack([np.fromiter(map(len, some), np.uint32), held[chosen].astype(np.uint32)])
        wide = np.uint16 if n < 1 << 16 else np.uint32
        often = times[at]
        rows.append(
            [
                int(place[chosen[0]]),
                block,
                b"".join(some),
                shape.tobytes(),
                doc[at].astype(wide).tobytes(),
                often.astype(np.uint8 if often.max() < 256 else np.uint32).tobytes(),
            ]
        )
    return rows


def _blocks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(batches):
            if batch.num_rows:
                block = (part << 24) + k
                rows = entries_of_block(
                    block, batch.column(0).to_pylist(), batch.column(1), buckets
                )
                yield pa.record_batch([pa.array(x, t.type) for x, t in zip(zip(*rows), _ROWS)], schema=_ROWS)

    return run


def _unpacked(data: bytes, items: int, sizes: tuple) -> np.ndarray:
    return np.frombuffer(data, sizes[0] if len(data) == items * sizes[0]().itemsize else sizes[1])


def _products(path: str):
    def run(group: pa.Table) -> pa.Table:
        """For a bucket: each pre-token counted once, then sums for each document of a block."""
        out, parts, number = [], [], {}
        for row in group.to_pylist():
            if row["names"] is None:
                out.append([-1, row["block"], None, row["sizes"], row["docs"], None])
                continue
            lengths, held = np.frombuffer(row["sizes"], np.uint32).reshape(2, -1).astype(np.int64)
            ends = np.cumsum(lengths).tolist()
            names = [row["names"][a:b] for a, b in zip([0, *ends], ends)]
            at = np.fromiter((number.setdefault(x, len(number)) for x in names), np.int64, len(names))
            items = int(held.sum())
            wide = _unpacked(row["docs"], items, (np.uint16, np.uint32))
            times = _unpacked(row["times"], items, (np.uint8, np.uint32))
            parts.append((row["block"], np.repeat(at, held), wide, times))
        pieces = encoder(path).encode([x.decode() for x in number])[1]
        for block, at, doc, times in parts:
            sums = np.bincount(doc, pieces[at] * times.astype(np.int64)).astype(np.int64)
            touched = np.flatnonzero(sums)
            out.append([-1, block, b"", None, touched.astype(np.uint32).tobytes(), sums[touched].tobytes()])
        return pa.Table.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*out), _ROWS)], schema=_ROWS)

    return run


def _totals(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    head = next(x for x in rows if x["names"] is None)
    size = np.frombuffer(head["docs"], np.int64)
    n = len(size)
    ids = np.frombuffer(head["sizes"][: 8 * n], np.int64)
    known = np.frombuffer(head["sizes"][8 * n :], bool)
    total = np.zeros(n, np.int64)
    for x in rows:
        if x["names"] is not None:
            total[np.frombuffer(x["docs"], np.uint32)] += np.frombuffer(x["times"], np.int64)
    return pa.table({"doc_id": pa.array(ids, mask=~known), "n_bytes": size, "n_tokens": total})


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = id_and_text(docs).mapInArrow(_blocks(buckets), _SQL_ROWS)
    products = entries.groupBy("bucket").applyInArrow(_products(path or tokenizer_path()), _SQL_ROWS)
    return products.groupBy("block").applyInArrow(_totals, "doc_id long, n_bytes long, n_tokens long")


def op2_token_counts(spark, folder: str) -> DataFrame:
    counts = token_counts(table(spark, folder, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
