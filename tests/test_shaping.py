import pytest
from pyspark.sql import functions as F

from caseweave.operators import evaluation, prompts, sections, shaping
from caseweave.operators.inputs import kb_document, report_text, valid_reports
from caseweave.schemas import EVALUATION_FIELDS, KB_SCHEMA, REPORT_SCHEMA, RETRIEVED_SCHEMA
from tests.direct import case, case_text, frame, report
from tests.direct import report_text as direct_report_text


@pytest.fixture(scope="module")
def tables(spark):
    kb = [
        case(1, "E one", "Py", "ctx", ["a"], "cause one", ["step A", "step B"]),
        case(2, "E two", None, "ctx two", None, "cause two", []),
    ]
    kb[1].update(tags=None, source_type=None, source_url=None, fix_steps=None, common_mistakes=["m1", "m2"])
    reports = [report(1, " boom\n", "Py"), report(2, "bang", None), report(3, "  ")]
    retrieved = [
        dict(report_id=1, rank=2, kb_id=2, score=0.0625),
        dict(report_id=1, rank=1, kb_id=1, score=0.45),
        dict(report_id=2, rank=1, kb_id=2, score=0.2),
    ]
    return (
        frame(spark, reports, REPORT_SCHEMA),
        frame(spark, retrieved, RETRIEVED_SCHEMA),
        frame(spark, kb, KB_SCHEMA),
    )


def by_id(df, key="report_id"):
    return {row[key]: row for row in df.collect()}


def test_texts(spark, tables):
    reports, _, kb = tables
    for row in report_text(reports).collect():
        assert row.report_text == direct_report_text(row.asDict())
    for row in kb_document(kb).collect():
        assert row.document == case_text(row.asDict())
    assert {r.report_id for r in valid_reports(reports).collect()} == {1, 2}


def test_confidence_and_metrics(tables):
    reports, retrieved, _ = tables
    labels = {k: r.retrieval_confidence for k, r in by_id(shaping.confidence(reports, retrieved)).items()}
    assert labels == {1: "high", 2: "medium", 3: "low"}
    metrics = by_id(shaping.run_metrics(reports, retrieved))
    assert (metrics[1].evidence_count, metrics[1].top_score, metrics[1].notice) == (2, 0.45, None)
    assert metrics[2].notice == shaping.MEDIUM_NOTICE
    assert (metrics[3].evidence_count, metrics[3].top_score) == (0, 0.0)
    assert metrics[3].notice == shaping.LOW_NOTICE


def test_evidence(tables):
    texts = {k: r.evidence for k, r in by_id(shaping.evidence_context(*tables)).items()}
    assert texts[1] == "\n\n".join(
        [
            "Retrieval confidence: high",
            "Example 1\nScore: 0.450\nError: E one\nPlatform: Py\nQuoted root cause: \"cause one\"\n"
            'Explanation: \nQuoted fix steps: "step A" | "step B"\nCommon mistakes: \n'
            "Source: docs - doc://1",
            "Example 2\nScore: 0.062\nError: E two\nPlatform: ctx two\n"
            'Quoted root cause: "cause two"\nExplanation: \nQuoted fix steps: \n'
            "Common mistakes: m1 | m2\nSource: Unknown - N/A",
        ]
    )
    assert texts[3] == "No relevant examples found."


def test_primary_evidence_and_listing(tables):
    _, retrieved, kb = tables
    best = by_id(shaping.primary_evidence(retrieved, kb))
    assert set(best) == {1, 2}
    assert (best[1].fix_step, best[1].retrieval_confidence) == ("step A", "high")
    assert (best[2].fix_step, best[2].source_url) == ("No fix step available.", "N/A")
    listing = {(r.report_id, r["rank"]): r for r in shaping.top_retrievals(retrieved, kb).collect()}
    assert (listing[1, 2].platform, listing[1, 2].shown_platform) == ("", "ctx two")
    assert listing[1, 2].score == 0.062


def test_prompts(spark, tables):
    reports, retrieved, kb = tables
    evidence = shaping.evidence_context(reports, retrieved, kb)
    given = spark.createDataFrame([("rag", "my template")], "mode string, system_prompt string")
    rows = {
        (r.report_id, r.mode): r
        for r in prompts.prompt_requests(reports, evidence, given).collect()
    }
    assert len(rows) == 6
    assert rows[3, "rag"].system_prompt == "my template"
    assert rows[3, "baseline"].system_prompt == prompts.FALLBACK_TEMPLATES["baseline"]
    assert rows[3, "rag"].user_prompt == (
        "Error message: Not provided\nEnvironment: Not provided\n"
        "Assignment context: Not provided\nCode snippet:\nNot provided\n\n"
        "Retrieved examples from the debugging knowledge base:\nNo relevant examples found.\n\n"
        + prompts.RAG_INSTRUCTION
    )
    assert rows[1, "baseline"].user_prompt == (
        "Error message: boom\nCode snippet:\nNot provided\n\n" + prompts.BASELINE_INSTRUCTION
    )
    only_rag = prompts.prompt_requests(reports, evidence, include_baseline=False)
    assert {r.mode for r in only_rag.collect()} == {"rag"}


def test_responses_and_run(spark, tables):
    reports, retrieved, kb = tables
    responses = spark.createDataFrame(
        [(1, "rag", "yes"), (1, "baseline", None), (9, "rag", "nobody")],
        "report_id long, mode string, text string",
    )
    rows = by_id(prompts.run_results(reports, retrieved, kb, responses, placeholder="none"))
    assert (rows[1].rag_response, rows[1].baseline_response) == ("yes", "none")
    assert (rows[3].rag_response, rows[3].retrieval_confidence) == ("none", "low")
    assert rows[1].error_message == "boom"
    short = prompts.run_results(reports, retrieved, kb, include_baseline=False)
    assert "baseline_response" not in short.columns


SECTIONS = {
    "": [],
    " \n\t": [],
    "intro\n1. A\nx\n## 2. B\ny": [("Response", "intro"), ("A", "x"), ("B", "y")],
    "1. A\n2. B\ny": [("B", "y")],
    "1. A\n\n2. B\ny": [("A", ""), ("B", "y")],
    "\n1. A\nx": [("Response", ""), ("A", "x")],
    "1. A\nx\n2. B": [("A", "x")],
    "1. A\r\nx\r\n 2.  B  \r\ny\r\n": [("A", "x"), ("B", "y")],
    "  ###3. Title here \nbody\nmore": [("Title here", "body\nmore")],
    "1.no space\nx": [("Response", "1.no space\nx")],
    "١. Digit\nx": [("Digit", "x")],
}


def test_sections(spark):
    texts = list(SECTIONS)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "response_id long, text string")
    rows = sections.response_sections(df).collect()
    for i, text in enumerate(texts):
        mine = sorted((r.section_no, r.title, r.body) for r in rows if r.response_id == i)
        assert mine == [(n + 1, *s) for n, s in enumerate(SECTIONS[text])], text


def test_evaluation(spark, tables):
    reports, retrieved, kb = tables
    focus = {1: ["STEP b", "cause two", "step B E", "absent"], 2: [], 3: ["x"]}
    cases = reports.join(
        spark.createDataFrame(list(focus.items()), "report_id long, expected_focus array<string>"),
        "report_id",
    ).withColumn("id", F.col("report_id").cast("string"))
    hits = evaluation.retrieval_hit(cases, retrieved, kb)
    # the third keyword spans the border of two matches
    assert {k: r.retrieval_score for k, r in by_id(hits).items()} == {1: 0.75, 2: 0.0, 3: 0.0}
    responses = spark.createDataFrame(
        [(1, "rag", "Absent step b"), (3, "baseline", "XX")],
        "report_id long, mode string, text string",
    )
    results = prompts.run_results(cases, retrieved, kb, responses, placeholder="-")
    scored = evaluation.evaluate_cases(cases, results, hits)
    rows = by_id(scored)
    assert (rows[1].rag_score, rows[1].baseline_score, rows[1].score_delta) == (0.5, 0.0, 0.5)
    assert rows[3].score_delta == -1.0
    summary = evaluation.eval_summary(scored).first()
    assert (summary.num_cases, summary.average_retrieval_score) == (3, 0.25)
    assert (summary.average_rag_score, summary.average_score_delta) == (0.167, -0.167)
    assert (summary.rag_better_cases, summary.tied_cases, summary.baseline_better_cases) == (1, 1, 1)
    none = evaluation.eval_summary(scored.limit(0)).first()
    assert (none.num_cases, none.average_rag_score) == (0, None)


def test_negative_scores_keep_their_sign(spark, tables):
    reports, _, kb = tables
    rows = [dict(report_id=1, rank=1, kb_id=1, score=-0.0004), dict(report_id=2, rank=1, kb_id=2, score=-0.25)]
    texts = {k: r.evidence for k, r in by_id(shaping.evidence_context(reports, frame(spark, rows, RETRIEVED_SCHEMA), kb)).items()}
    assert "Score: -0.000\n" in texts[1] and "Score: -0.250\n" in texts[2]


def test_null_keywords_score_zero(spark):
    rows = spark.createDataFrame([("a text", None), ("a text", ["A", None])], "text string, expected_focus array<string>")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            assert [r.coverage for r in evaluation.keyword_coverage(rows).collect()] == [0.0, 0.5]
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_requests_of_reports_without_evidence(spark, tables):
    reports, _, _ = tables
    evidence = spark.createDataFrame([(1, "E")], "report_id long, evidence string")
    rows = prompts.prompt_requests(reports, evidence).collect()
    assert sorted((r.report_id, r.mode) for r in rows) == [(i, m) for i in (1, 2, 3) for m in ("baseline", "rag")]
    text = next(r.user_prompt for r in rows if (r.report_id, r.mode) == (2, "rag"))
    assert shaping.NO_EVIDENCE in text


def test_two_templates_or_responses_fail(spark, tables):
    reports, _, _ = tables
    evidence = spark.createDataFrame([(1, "E")], "report_id long, evidence string")
    templates = spark.createDataFrame([("rag", "one"), ("rag", "two")], "mode string, system_prompt string")
    with pytest.raises(Exception, match="more than one template"):
        prompts.prompt_requests(reports, evidence, templates).collect()
    answers = spark.createDataFrame([(1, "rag", "x"), (1, "rag", "y")], "report_id long, mode string, text string")
    with pytest.raises(Exception, match="more than one response"):
        prompts.response_join(reports, answers).collect()


def test_results_hold_examples_and_metrics(spark, tables):
    reports, retrieved, kb = tables
    rows = by_id(prompts.run_results(reports, retrieved, kb))
    assert [(e.rank, e.kb_id, e.score, e.error) for e in rows[1].retrieved_examples] == [
        (1, 1, 0.45, "E one"),
        (2, 2, 0.0625, "E two"),
    ]
    assert rows[1].retrieved_examples[0].fix_steps == ["step A", "step B"]
    assert (rows[1].evidence_count, rows[1].top_score, rows[1].retrieval_confidence) == (2, 0.45, "high")
    assert rows[3].retrieved_examples == [] and rows[3].evidence == shaping.NO_EVIDENCE
    assert (rows[3].evidence_count, rows[3].top_score, rows[3].notice) == (0, 0.0, shaping.LOW_NOTICE)


def test_average_of_a_tie_does_not_depend_on_the_order(spark):
    schema = "retrieval_score double, rag_score double, baseline_score double, score_delta double"
    values = [0.1, 0.2, 0.3, 0.002] * 50
    found = set()
    for rows in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([(v, v, v, 0.0) for v in rows], schema).repartition(3)
        found.add(evaluation.eval_summary(df).first().average_rag_score)
    assert len(found) == 1
