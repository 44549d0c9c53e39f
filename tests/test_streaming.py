import time
from pathlib import Path

import pytest

from caseweave import workspace
from caseweave.operators.vectors import NO_VECTOR
from caseweave.plans.run import debug_run
from caseweave.schemas import KB_SCHEMA, REPORT_SCHEMA
from caseweave.streaming.intake import answer_reports
from tests.corpus import corpus
from tests.direct import frame, report


def test_batches_equal_one_run(spark, tmp_path):
    kb, reports = corpus(11, 40)
    reports = reports[:6]
    source, results = str(tmp_path / "in"), str(tmp_path / "out")
    kb_df = frame(spark, kb, KB_SCHEMA)
    for part in (reports[:3], reports[3:]):
        frame(spark, part, REPORT_SCHEMA, 1).write.mode("append").json(source)
    stream = (
        spark.readStream.schema(REPORT_SCHEMA).option("maxFilesPerTrigger", 1).json(source)
    )
    query = answer_reports(stream, kb_df, results, str(tmp_path / "checkpoint"))
    query.awaitTermination(240)
    assert query.exception() is None
    found = spark.read.parquet(f"{results}/results")
    assert found.select("batch").distinct().count() == 2
    whole = debug_run(frame(spark, reports, REPORT_SCHEMA), kb_df)
    assert sorted(found.select(whole.columns).collect()) == sorted(whole.collect())


def files_below(folder):
    return sorted(p for p in Path(folder).rglob("*") if p.is_file())


def test_a_report_without_vectors_is_listed_and_nothing_stays(spark, tmp_path):
    kb, _ = corpus(11, 12)
    reports = [report(i, "alpha beta", method="embeddings" if i % 2 else "tfidf") for i in range(4)]
    vectors = spark.createDataFrame([(c["kb_id"], [1.0, float(c["kb_id"])]) for c in kb], "kb_id long, embedding array<float>")
    asked = spark.createDataFrame([(1, [1.0, 1.0])], "report_id long, embedding array<float>")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (reports[:2], reports[2:]):
        frame(spark, part, REPORT_SCHEMA, 1).write.mode("append").json(source)
    stream = spark.readStream.schema(REPORT_SCHEMA).option("maxFilesPerTrigger", 1).json(source)
    kb_df, shared = frame(spark, kb, KB_SCHEMA), workspace.shared_folder(spark).removeprefix("file:")
    before = files_below(shared)
    query = answer_reports(
        stream, kb_df, out, str(tmp_path / "checkpoint"), report_vectors=asked, kb_vectors=vectors
    )
    query.awaitTermination(240)
    assert query.exception() is None
    listed = spark.read.parquet(f"{out}/unanswered").collect()
    assert {(r.report_id, r.reason) for r in listed} == {(3, NO_VECTOR)}
    results = {r.report_id: r.retrieved_examples for r in spark.read.parquet(f"{out}/results").collect()}
    assert sorted(results) == [0, 1, 2, 3] and [bool(results[i]) for i in range(4)] == [True, True, True, False]
    for _ in range(100):  # the listener is told a little later
        if files_below(shared) == before:
            break
        time.sleep(0.1)
    assert files_below(shared) == before


def test_a_scope_removes_what_was_written_in_it(spark):
    outside = workspace.written(spark.range(3), "outside")
    with pytest.raises(RuntimeError), workspace.scope(spark) as own:
        inside = workspace.written(spark.range(2), "inside")
        assert inside.count() == 2 and len(own.folders) == 1
        raise RuntimeError
    assert outside.count() == 3 and not own.folders
    with pytest.raises(Exception, match="does not exist"):
        inside.collect()
