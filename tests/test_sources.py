import json
import random
import time

import pytest

from caseweave import workspace
from caseweave.operators.evaluation import eval_summary
from caseweave.sources import files
from tests.direct import case


def test_kb_array_keeps_positions(spark, tmp_path):
    items = [{k: v for k, v in case(0, f"e{i}").items() if k != "kb_id"} for i in range(5)]
    del items[2]["platform"], items[2]["tags"]
    path = tmp_path / "kb.json"
    path.write_text(json.dumps(items, indent=2), encoding="utf-8")
    rows = {r.kb_id: r for r in files.read_kb(spark, str(path)).collect()}
    assert [rows[i].error for i in range(5)] == [f"e{i}" for i in range(5)]
    assert rows[2].platform is None and rows[2].tags is None


def test_kb_lines(spark, tmp_path):
    path = tmp_path / "kb.jsonl"
    path.write_text("\n".join(json.dumps(case(i, f"e{i}")) for i in range(3)), encoding="utf-8")
    read = files.read_kb_lines(spark, str(path)).collect()
    parsed = files.parse_kb(spark.read.text(str(path))).collect()
    assert sorted(read) == sorted(parsed) and len(read) == 3


def test_case_defaults(spark, tmp_path):
    path = tmp_path / "cases.json"
    path.write_text(json.dumps([{"id": "a", "error_message": "x"}]), encoding="utf-8")
    row = files.read_cases(spark, str(path)).first()
    assert (row.report_id, row.id, row.environment, row.code_snippet) == (0, "a", "", "")
    assert (row.expected_focus, row.retrieval_method) == ([], "tfidf")


def test_templates(spark, tmp_path):
    (tmp_path / "rag_prompt.txt").write_text("\n one\ntwo \n", encoding="utf-8")
    (tmp_path / "notes.txt").write_text("no", encoding="utf-8")
    rows = files.read_templates(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("rag", "one\ntwo")]


def summary_of(spark, cases):
    schema = "retrieval_score double, rag_score double, baseline_score double, score_delta double"
    return eval_summary(spark.createDataFrame(cases, schema))


def test_summary_round_trip(spark, tmp_path):
    folder = str(tmp_path / "evaluation")
    assert files.read_summary(spark, folder) is None
    assert files.read_case_results(spark, folder, spark.range(1).schema) is None
    files.write_evaluation(summary_of(spark, [(0.5, 0.5, 0.25, 0.25)]), spark.range(3), folder)
    assert files.read_summary(spark, folder).first().average_rag_score == 0.5
    files.write_evaluation(summary_of(spark, []), spark.range(2), folder)
    row = files.read_summary(spark, folder).first()
    assert (row.num_cases, row.average_rag_score, len(row)) == (0, None, 8)
    # the cases that are read are those of the summary
    assert files.read_case_results(spark, folder, spark.range(1).schema).count() == 2


def test_unreadable_summary_is_no_missing_summary(spark, tmp_path):
    folder = str(tmp_path / "evaluation")
    run = files.write_evaluation(summary_of(spark, []), spark.range(3), folder)
    for part in (tmp_path / "evaluation" / "runs" / run / "summary").glob("*part-*"):
        part.unlink()
    (tmp_path / "evaluation" / "runs" / run / "summary" / "part.json").write_text("{broken", encoding="utf-8")
    with pytest.raises(Exception):
        files.read_summary(spark, folder).collect()


def test_readers_see_whole_evaluations_between_all_steps(spark, tmp_path, monkeypatch):
    folder, schema, seen = str(tmp_path / "evaluation"), spark.range(1).schema, []

    def read():
        run = files.current_evaluation(spark, folder)
        if run is None:
            return None
        score = files.read_summary(spark, folder, run).first().average_rag_score
        return score, files.read_case_results(spark, folder, schema, run).count()

    files.write_evaluation(summary_of(spark, [(0.5, 0.5, 0.5, 0.0)]), spark.range(1), folder)
    steps = iter(range(100))
    writer = type(spark.range(1).write)
    plain, system = writer.json, files.file_system

    def json(self, *a, **b):
        seen.append((next(steps), read()))
        plain(self, *a, **b)
        seen.append((next(steps), read()))

    monkeypatch.setattr(writer, "json", json)
    monkeypatch.setattr(files, "file_system", lambda *a: (next(steps), system(*a))[1])
    files.write_evaluation(summary_of(spark, [(0.25, 0.25, 0.25, 0.0)] * 2), spark.range(2), folder)
    assert len(seen) == 4 and {x for _, x in seen} == {(0.5, 1)}
    assert read() == (0.25, 2)


def test_old_evaluations_expire(spark, tmp_path):
    folder, day = str(tmp_path / "evaluation"), 86_400
    runs = [files.write_evaluation(summary_of(spark, []), spark.range(i), folder) for i in range(3)]
    left = tmp_path / "evaluation" / "runs" / "crashed"
    left.mkdir()
    assert files.expire_evaluations(spark, folder, 1) == []
    assert sorted(files.expire_evaluations(spark, folder, 1, time.time() + 2 * day)) == sorted([*runs[:2], "crashed"])
    assert files.current_evaluation(spark, folder) == runs[2]
    assert files.read_case_results(spark, folder, spark.range(1).schema).count() == 2
    assert [x.name for x in (tmp_path / "evaluation" / "runs").iterdir() if x.is_dir()] == [runs[2]]


@pytest.mark.parametrize("indent, item_lines", [(None, False), (2, False), (None, True), ("\t", True)])
def test_an_array_is_read_by_several_tasks(spark, tmp_path, indent, item_lines):
    rng = random.Random(4)
    odd = ['a "quoted" [x], {y}', "back\\slash\\", "line\nend, ]", "é日本", "", "}{", "\\\""]
    items = [
        {"error": rng.choice(odd) + str(i), "tags": rng.choices(odd, k=rng.randint(0, 3)), "platform": None}
        for i in range(300)
    ]
    if item_lines:
        text = "\n[\n" + " ,\r\n".join(json.dumps(x, indent=indent) for x in items) + "\n\n]\n"
    else:
        text = json.dumps(items, indent=indent)
    path = tmp_path / "kb.json"
    path.write_bytes(text.encode())
    settings = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 5
        rows = sorted(files.read_kb(spark, str(path)).collect(), key=lambda r: r.kb_id)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert [(r.kb_id, r.error, r.tags, r.platform) for r in rows] == [
        (i, x["error"], x["tags"], None) for i, x in enumerate(items)
    ]


@pytest.mark.parametrize("content, items", [("[]", 0), (" [\n ] \n", 0), ('[{"error": "x"},\nnull]', 2), ("", 0), ("\n\n", 0)])
def test_small_arrays(spark, tmp_path, content, items):
    path = tmp_path / "kb.json"
    path.write_text(content, encoding="utf-8")
    assert files.read_kb(spark, str(path)).count() == items


@pytest.mark.parametrize("content", [
        '[{"error": "x"}, {"err', "not json", '{"error": 1', '[{"error": "x"},]', '[{"error": "x"},,{}]', "[1]",
        '[{"error": "x"}]\n[{"error": "y"}]', '[{"error": "x"}] more', '[{"error": "x"}\n]]', '[[{"error": "x"}]', '[{"error": x}]',
    ])
def test_malformed_array_fails(spark, tmp_path, content):
    path = tmp_path / "kb.json"
    path.write_text(content, encoding="utf-8")
    with pytest.raises(Exception):
        files.read_kb(spark, str(path)).collect()


def test_malformed_line_fails(spark, tmp_path):
    path = tmp_path / "kb.jsonl"
    path.write_text('{"kb_id": 1, "error": "x"}\n{"kb_id": 2, "err\n', encoding="utf-8")
    with pytest.raises(Exception):
        files.read_kb_lines(spark, str(path)).collect()
    lines = spark.createDataFrame([('{"kb_id": 1',)], "value string")
    with pytest.raises(Exception):
        files.parse_kb(lines).collect()
    with pytest.raises(Exception):
        files.parse_cases(lines).collect()


def test_two_arrays_have_no_positions(spark, tmp_path):
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text('[{"error": "x"}]', encoding="utf-8")
    with pytest.raises(ValueError, match="one file"):
        files.read_kb(spark, str(tmp_path))


def test_case_lines(spark, tmp_path):
    path = tmp_path / "cases.jsonl"
    path.write_text('{"report_id": 7, "id": "a", "error_message": "x"}\n', encoding="utf-8")
    row = files.read_case_lines(spark, str(path)).first()
    assert (row.report_id, row.environment, row.expected_focus, row.retrieval_method) == (7, "", [], "tfidf")


def test_shared_folder_prefers_the_session_setting(spark, tmp_path):
    class Context:
        master = "spark://cluster"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        workspace.shared_folder(Session())
    Session.conf = {"spark.checkpoint.dir": "hdfs:///shared"}
    assert workspace.shared_folder(Session()) == "hdfs:///shared"
