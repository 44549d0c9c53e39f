"""Whole runs composed from the operators."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from caseweave.operators.evaluation import evaluate_cases, retrieval_hit
from caseweave.operators.prompts import NO_RESPONSE, run_results
from caseweave.operators.retrieve import retrieve, retrieve_answers
from caseweave.operators.tfidf import CaseIndex, GroupStatistics
from caseweave.workspace import written

EVALUATION_TOP_K = 3


class Run(NamedTuple):
    """``results``: one row per report; ``unanswered``: (report_id, reason) of the reports that
    could not be searched for, whose results have no matches."""

    results: DataFrame
    unanswered: DataFrame


def answered_run(
    reports: DataFrame,
    kb: DataFrame,
    responses: DataFrame | None = None,
    report_vectors: DataFrame | None = None,
    kb_vectors: DataFrame | None = None,
    top_k: int = 3,
    lexical: str = "tfidf",
    placeholder: str = NO_RESPONSE,
    include_baseline: bool = True,
    index: CaseIndex | None = None,
    known: GroupStatistics | None = None,
) -> Run:
    """As ``debug_run``; reports that can't be searched for are listed and don't end the job."""
    answers = retrieve_answers(reports, kb, top_k, report_vectors, kb_vectors, lexical, index, known)
    retrieved = written(answers.matches, "retrieved")
    results = run_results(reports, retrieved, kb, responses, placeholder, include_baseline)
    return Run(results, answers.unanswered)


def debug_run(
    reports: DataFrame,
    kb: DataFrame,
    responses: DataFrame | None = None,
    report_vectors: DataFrame | None = None,
    kb_vectors: DataFrame | None = None,
    top_k: int = 3,
    lexical: str = "tfidf",
    placeholder: str = NO_RESPONSE,
    include_baseline: bool = True,
    index: CaseIndex | None = None,
) -> DataFrame:
    """Retrieve, label, assemble the evidence and attach the responses of every report."""
    retrieved = written(
        retrieve(reports, kb, top_k, report_vectors, kb_vectors, lexical, index), "retrieved"
    )
    return run_results(reports, retrieved, kb, responses, placeholder, include_baseline)


def evaluation_run(
    cases: DataFrame,
    kb: DataFrame,
    responses: DataFrame | None = None,
    report_vectors: DataFrame | None = None,
    kb_vectors: DataFrame | None = None,
    lexical: str = "tfidf",
    placeholder: str = NO_RESPONSE,
) -> DataFrame:
    """Run all evaluation cases as one batch and score them."""
    retrieved = written(
        retrieve(cases, kb, EVALUATION_TOP_K, report_vectors, kb_vectors, lexical), "retrieved"
    )
    results = run_results(cases, retrieved, kb, responses, placeholder)
    return evaluate_cases(cases, results, retrieval_hit(cases, retrieved, kb))
