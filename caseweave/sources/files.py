"""Readers and writers for files."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseweave.functions.text import strip
from caseweave.schemas import CASE_FIELDS, CASE_LINE_SCHEMA, EVALUATION_FIELDS, KB_SCHEMA, SUMMARY_SCHEMA
from caseweave.workspace import file_system, written


#: Malformed input ends the job instead of turning into nulls or nothing.
STRICT = {"mode": "FAILFAST"}
#: White space between the values of JSON.
_BLANK = " \t\r\n"


class _Scanned(NamedTuple):
    """What a line of a JSON array does to the depth of brackets, strings left out."""

    change: int
    lowest: int


_STRUCTURE = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]{},]|"')


def _scan(line: str) -> _Scanned:
    """A string can't go over the end of a line, so every line can be read on its own."""
    depth = lowest = 0
    for mark in _STRUCTURE.findall(line):
        if mark == '"':
            raise ValueError(f"a string is not closed: {line[:80]}")
        depth += (mark in "[{") - (mark in "]}")
        lowest = min(lowest, depth)
    return _Scanned(depth, lowest)


def _pieces(line: str, depth: int) -> list[str]:
    """A line cut at the commas between the items of the outer array, without its brackets."""
    out, begin = [], 0 if depth else None
    for mark in _STRUCTURE.finditer(line):
        kind = mark.group()
        opened = depth
        depth += (kind in "[{") - (kind in "]}")
        if opened == 0:
            if kind != "[" or line[: mark.start()].strip(_BLANK):
                raise ValueError(f"not an array: {line[:80]}")
            begin = mark.end()
        elif kind == "," and depth == 1 or depth == 0:
            out.append(line[begin : mark.start()])
            begin = mark.end() if depth else None
            if not depth and (kind != "]" or line[mark.end() :].strip(_BLANK)):
                raise ValueError(f"the array has another end: {line[-80:]}")
    if begin is None:
        if not out and line.strip(_BLANK):
            raise ValueError(f"text outside of the array: {line[:80]}")
        return out
    return [*out, line[begin:]]


def _scanned_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [_scan(x) for x in batch.column("value").to_pylist()]
        more = [pa.array([x[i] for x in found], pa.int64()) for i in range(2)]
        yield pa.record_batch([*batch.columns, *more], names=[*batch.schema.names, "change", "lowest"])


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, line, cuts, opened, pieces): how many cuts between items a line makes, and whether
    the outer array begins there."""
    for batch in batches:
        depths = batch.column("depth").to_pylist()
        pieces = [_pieces(*x) for x in zip(batch.column("value").to_pylist(), depths)]
        columns = [batch.column("block"), batch.column("line")]
        columns.append(pa.array([max(len(x) - 1, 0) for x in pieces], pa.int64()))
        columns.append(pa.array([bool(x) and not d for x, d in zip(pieces, depths)], pa.bool_()))
        columns.append(pa.array(pieces, pa.list_(pa.string())))
        yield pa.record_batch(columns, names=["block", "line", "cuts", "opened", "pieces"])


def _before(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over all lines before: within a block by its lines, and over the
    blocks, a row each, by their sums."""
    lines = Window.partitionBy("block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    blocks = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("block").agg(F.sum(value).alias("total"))
    sums = sums.select("block", F.coalesce(F.sum("total").over(blocks), F.lit(0)).alias("blocks_before"))
    inside = F.coalesce(F.sum(value).over(lines), F.lit(0))
    rows = rows.withColumn(name, inside).join(sums, "block")
    return rows.withColumn(name, F.col(name) + F.col("blocks_before")).drop("blocks_before")


def _json_array(spark: SparkSession, path: str, fields: T.StructType, position: str) -> DataFrame:
    """The items of one JSON array with their positions, whatever lines they are on.

    Lines are read in parallel. The depth of brackets before a line, and the number of items
    before it, are sums over the lines before, taken by block of the file first; the pieces of
    an item then meet by its number. A file whose items are all on one line is one task's work.
    """
    lines = spark.read.text(path)
    if len(lines.inputFiles()) != 1:
        raise ValueError(f"positions need one file with one array: {path}")
    block = F.col("_metadata.file_block_start").alias("block")
    lines = lines.select(block, F.monotonically_increasing_id().alias("line"), "value")
    schema = "block long, line long, value string, change long, lowest long"
    lines = written(lines.mapInArrow(_scanned_lines, schema), "lines")
    lines = written(_before(lines, "change", "depth"), "depths")
    total, lowest = lines.agg(F.sum("change"), F.min(F.col("depth") + F.col("lowest"))).first()
    if total or (lowest or 0) < 0:
        raise ValueError(f"brackets of the array don't match: {path}")
    schema = "block long, line long, cuts long, opened boolean, pieces array<string>"
    cut = lines.select("block", "line", "value", "depth").mapInArrow(_cut_lines, schema)
    cut = written(cut, "pieces")
    if cut.filter("opened").count() > 1:
        raise ValueError(f"more than one array: {path}")
    cut = _before(cut, "cuts", "items")
    pieces = cut.select("block", "line", "items", F.posexplode("pieces").alias("place", "piece"))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "piece")))
    items = pieces.groupBy((F.col("items") + F.col("place")).alias(position)).agg(
        F.array_join(F.transform(parts, lambda x: x["piece"]), "\n").alias("text")
    )
    blank = F.regexp_like("text", F.lit(r"^[ \t\r\n]*$"))
    items = written(items.withColumn("blank", blank), "items")
    if items.filter("blank").count() and items.count() > 1:
        raise ValueError(f"an item of the array is empty: {path}")
    return items.filter("not blank").select(position, F.from_json("text", fields, STRICT).alias("item")).select(
        position, "item.*"
    )


def read_kb(spark: SparkSession, path: str) -> DataFrame:
    """Knowledge base from one JSON array file; ``kb_id`` is the position in the array."""
    return _json_array(spark, path, CASE_FIELDS, "kb_id")


def read_kb_lines(spark: SparkSession, path: str) -> DataFrame:
    """Knowledge base from JSON lines with a ``kb_id`` per item."""
    return spark.read.schema(KB_SCHEMA).options(**STRICT).json(path)


def parse_kb(lines: DataFrame, column: str = "value") -> DataFrame:
    """Knowledge base from a column of JSON objects with a ``kb_id`` each."""
    return lines.select(F.from_json(column, KB_SCHEMA, STRICT).alias("item")).select("item.*")


def with_case_defaults(cases: DataFrame) -> DataFrame:
    """Defaults of absent evaluation fields."""

    def default(name: str, value: Column) -> Column:
        return F.coalesce(name, value).alias(name)

    empty = F.lit("")
    return cases.withColumns(
        {
            "environment": default("environment", empty),
            "assignment_context": default("assignment_context", empty),
            "code_snippet": default("code_snippet", empty),
            "expected_focus": default("expected_focus", F.array().cast("array<string>")),
            "retrieval_method": default("retrieval_method", F.lit("tfidf")),
        }
    )


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation cases from one JSON array file; ``report_id`` is the position."""
    return with_case_defaults(_json_array(spark, path, EVALUATION_FIELDS, "report_id"))


def parse_cases(lines: DataFrame, column: str = "value") -> DataFrame:
    """Evaluation cases from a column of JSON objects with a ``report_id`` each."""
    items = F.from_json(column, CASE_LINE_SCHEMA, STRICT)
    return with_case_defaults(lines.select(items.alias("item")).select("item.*"))


def read_case_lines(spark: SparkSession, path: str) -> DataFrame:
    """Evaluation cases from JSON lines with a ``report_id`` each."""
    return with_case_defaults(spark.read.schema(CASE_LINE_SCHEMA).options(**STRICT).json(path))


def read_templates(spark: SparkSession, folder: str) -> DataFrame:
    """(mode, system_prompt) from the files ``<mode>_prompt.txt`` of a folder."""
    mode = F.regexp_extract("_metadata.file_name", r"\A(.+)_prompt\.txt\z", 1)
    return (
        spark.read.text(folder, wholetext=True, pathGlobFilter="*_prompt.txt")
        .select(mode.alias("mode"), strip(F.col("value")).alias("system_prompt"))
        .filter("mode != ''")
    )


RUNS, PUBLISHED = "runs", "published"


class Published(NamedTuple):
    """A stored evaluation: its number, its name, and when it was published (milliseconds)."""

    number: int
    run: str
    time: int


def _published(spark: SparkSession, folder: str) -> list[Published]:
    """All published evaluations, the last one at the end."""
    files, place = file_system(spark, f"{folder}/{PUBLISHED}")
    if not files.exists(place):
        return []
    found = []
    for status in files.listStatus(place):
        number, _, run = status.getPath().getName().partition("-")
        if number.isdigit():  # not a checksum file
            found.append(Published(int(number), run, status.getModificationTime()))
    return sorted(found)


def write_evaluation(summary: DataFrame, case_results: DataFrame, folder: str) -> str:
    """Persist an evaluation as JSON lines below ``folder``; gives back the name of the run.

    A run has a folder of its own that is never changed. An empty file named after it, which
    is made last and at once, publishes it; the name with the highest number is the current
    run. So a reader sees a whole evaluation at any time, the old one or the new one.
    """
    spark, run = summary.sparkSession, uuid.uuid4().hex
    case_results.write.option("ignoreNullFields", "false").json(f"{folder}/{RUNS}/{run}/cases")
    named = summary.withColumn("run", F.lit(run)).coalesce(1)
    named.write.option("ignoreNullFields", "false").json(f"{folder}/{RUNS}/{run}/summary")
    number = max((x.number for x in _published(spark, folder)), default=0) + 1
    files, place = file_system(spark, f"{folder}/{PUBLISHED}/{number:012d}-{run}")
    if not files.createNewFile(place):
        raise FileExistsError(str(place))
    return run


def current_evaluation(spark: SparkSession, folder: str) -> str | None:
    """The name of the current run; what is read by it stays whole while others are written."""
    found = _published(spark, folder)
    return found[-1].run if found else None


def read_summary(spark: SparkSession, folder: str, run: str | None = None) -> DataFrame | None:
    """The summary of a run, the current one if none is named, or None where there is none."""
    run = run or current_evaluation(spark, folder)
    if run is None:
        return None
    path = f"{folder}/{RUNS}/{run}/summary"
    return spark.read.schema(SUMMARY_SCHEMA).options(**STRICT).json(path).drop("run")


def read_case_results(
    spark: SparkSession, folder: str, schema: T.StructType, run: str | None = None
) -> DataFrame | None:
    """The cases of a run, the current one if none is named."""
    run = run or current_evaluation(spark, folder)
    return None if run is None else spark.read.schema(schema).options(**STRICT).json(f"{folder}/{RUNS}/{run}/cases")


def expire_evaluations(spark: SparkSession, folder: str, days: float, now: float | None = None) -> list[str]:
    """Remove runs that were replaced, or never published, more than ``days`` ago; gives their names.

    A run counts as replaced when the next one was published, so whoever read its name has
    that long to read the rest. The current run always stays.
    """
    before = ((time.time() if now is None else now) - days * 86_400) * 1000
    published = _published(spark, folder)
    replaced = [a for a, b in zip(published, published[1:]) if b.time < before]
    files, runs = file_system(spark, f"{folder}/{RUNS}")
    known = {x.run for x in published}
    gone = [x.run for x in replaced]
    if files.exists(runs):
        for status in files.listStatus(runs):
            if status.getPath().getName() not in known and status.getModificationTime() < before:
                gone.append(status.getPath().getName())
    for entry in replaced:  # first what leads to them
        files.delete(file_system(spark, f"{folder}/{PUBLISHED}/{entry.number:012d}-{entry.run}")[1], False)
    for run in gone:
        files.delete(file_system(spark, f"{folder}/{RUNS}/{run}")[1], True)
    return gone
