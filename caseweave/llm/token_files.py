"""Token ids of documents in binary files, in ascending order of doc_id.

The documents are dealt by ranges of doc_id and sorted, so each task writes one file of a
contiguous range, and files follow each other by name. A file holds *frames* of about
``FRAME`` ids: the ids of whole documents, each closed by the end id, as Simple-8b words (see
``simple8b``), the number of words of each block of 256 ids, and the documents with their
numbers of ids. A document is never cut, so a frame has more ids only if one document has.
Files are Parquet, so that Spark commits them whole, whatever executors are lost.

A frame knows how many ids its file holds before it. Read back, only the sums of the files (a
row each) have to be added up for the place of every document in the stream of all ids.

Defined results: a null text is empty, a document of the end id only; rows that repeat a
doc_id follow each other in the order of their texts; rows without doc_id come first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseweave.llm import simple8b
from caseweave.llm.common import id_and_text, table
from caseweave.llm.units import encoder, tokenizer_path
from caseweave.llm.words import release
from caseweave.workspace import new_folder

END = 2
FRAME = 1 << 18
#: Bytes of text encoded at a time.
_STEP = 4 << 20
_SCHEMA = (
    "file long, before long, n_ids long, doc_ids array<long>, doc_lengths array<long>, "
    "block_words binary, words binary"
)


def _frame(file: int, before: int, ids: list, lengths: np.ndarray, flat: np.ndarray) -> pa.RecordBatch:
    words, counts = simple8b.encode(flat)
    return pa.record_batch(
        [
            pa.array([file], pa.int64()),
            pa.array([before], pa.int64()),
            pa.array([len(flat)], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([lengths], pa.list_(pa.int64())),
            pa.array([counts.astype("<u2").tobytes()], pa.binary()),
            pa.array([words.astype("<u8").tobytes()], pa.binary()),
        ],
        names=["file", "before", "n_ids", "doc_ids", "doc_lengths", "block_words", "words"],
    )


def _with_end(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.insert(flat, np.cumsum(lengths), END)


def _steps(batch: pa.RecordBatch) -> Iterator[tuple[list, pa.StringArray]]:
    """Parts of a batch of about ``_STEP`` bytes, for bounded memory."""
    size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy())
    at = 0
    while at < batch.num_rows:
        used = size[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(size, used + _STEP)))
        yield batch.column(0)[at:stop].to_pylist(), batch.column(1)[at:stop]
        at = stop


def _frames(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, before = TaskContext.get().partitionId(), 0
        tool = encoder(path)
        ids, lengths, held = [], [], 0
        waiting: list[np.ndarray] = []
        for batch in batches:
            for some, texts in _steps(batch):
                flat, n = tool.texts(texts)
                flat, n = _with_end(flat, n), n + 1
                ends = np.cumsum(n)
                at = 0
                while at < len(some):
                    begin = ends[at - 1] if at else 0
                    stop = min(len(some), int(np.searchsorted(ends, begin + FRAME - held)) + 1)
                    ids += some[at:stop]
                    lengths.append(n[at:stop])
                    waiting.append(flat[begin : ends[stop - 1]])
                    held += int(ends[stop - 1] - begin)
                    if held >= FRAME:
                        yield _frame(file, before, ids, np.concatenate(lengths), np.concatenate(waiting))
                        before += held
                        ids, lengths, waiting, held = [], [], [], 0
                    at = stop
        if ids:
            yield _frame(file, before, ids, np.concatenate(lengths), np.concatenate(waiting))
        release()

    return run


def write_tokens(docs: DataFrame, folder: str, path: str | None = None) -> str:
    """Write the files of ``docs`` to ``folder``; gives back the folder."""
    dealt = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    frames = dealt.mapInArrow(_frames(path or tokenizer_path()), _SCHEMA)
    # ids are packed as far as they go
    frames.write.option("compression", "none").parquet(folder)
    return folder


def _ids_of(row: dict) -> np.ndarray:
    counts = np.frombuffer(row["block_words"], "<u2").astype(np.int64)
    return simple8b.decode(np.frombuffer(row["words"], "<u8"), counts, row["n_ids"])


def _documents(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = _ids_of(row).astype("<u4")
                n = np.array(row["doc_lengths"], np.int64)
                stops = np.cumsum(n)
                begins = stops - n
                data = memoryview(ids).cast("B")
                cuts = list(zip((begins * 4).tolist(), (stops * 4).tolist()))
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["start"] + begins),
                    pa.array(n),
                    pa.array([zlib.crc32(data[a:b]) for a, b in cuts], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    edges = pa.array(np.concatenate([[0], stops]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(edges, pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)

    return run


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files."""
    frames = spark.read.schema(_SCHEMA).parquet(folder)
    # a row for each file: as many as the range partitions that wrote them
    files = frames.groupBy("file").agg(F.sum("n_ids").alias("n"))
    files = files.select(
        "file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before_file")
    )
    frames = frames.join(F.broadcast(files), "file")
    frames = frames.withColumn("start", F.col("before_file") + F.col("before"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return frames.mapInArrow(_documents(with_ids), schema)


def op9_token_files(spark, folder: str) -> DataFrame:
    files = write_tokens(table(spark, folder, "documents"), new_folder(spark, "tokens"))
    return read_tokens(spark, files, with_ids=False)
