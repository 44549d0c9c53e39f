"""Route every report to the retrieval method it asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.operators.candidates import facets
from caseweave.operators.overlap import overlap_topk
from caseweave.operators.terms import asked_groups
from caseweave.operators.tfidf import CaseIndex, GroupStatistics, case_index, tfidf_topk
from caseweave.operators.vectors import Answers, embedding_answers

LEXICAL = ("tfidf", "overlap")
NO_TABLES = "no vector tables"


def by_vector():
    """Whether a report asks for vectors: ``embeddings`` in any case."""
    return F.lower(F.coalesce("retrieval_method", F.lit("tfidf"))) == "embeddings"


def retrieve_answers(
    reports: DataFrame,
    kb: DataFrame,
    top_k: int = 3,
    report_vectors: DataFrame | None = None,
    kb_vectors: DataFrame | None = None,
    lexical: str = "tfidf",
    index: CaseIndex | None = None,
    known: GroupStatistics | None = None,
) -> Answers:
    """The matches of all reports that can be answered, and the others with the reason.

    ``embeddings`` in any case selects the vectors, any other method the ``lexical`` one. The
    candidate groups are found once for all methods.
    """
    if lexical not in LEXICAL:
        raise ValueError(f"lexical must be one of {LEXICAL}")
    if lexical == "tfidf":
        index = index or case_index(kb)
    asked = asked_groups(reports, index.facets if index else facets(kb))
    texts = asked.only(~by_vector())
    if lexical == "overlap":
        matches = overlap_topk(None, kb, top_k, texts)
    else:
        matches = tfidf_topk(None, kb, top_k, index=index, asked=texts, known=known)
    vectors = asked.only(by_vector())
    if report_vectors is None or kb_vectors is None:
        return Answers(matches, vectors.reports.select("report_id", F.lit(NO_TABLES).alias("reason")))
    answers = embedding_answers(None, kb, report_vectors, kb_vectors, top_k, vectors)
    return Answers(matches.unionByName(answers.matches), answers.unanswered)


def retrieve(
    reports: DataFrame,
    kb: DataFrame,
    top_k: int = 3,
    report_vectors: DataFrame | None = None,
    kb_vectors: DataFrame | None = None,
    lexical: str = "tfidf",
    index: CaseIndex | None = None,
) -> DataFrame:
    """The matches alone.

    Without vector tables, a report that asks for embeddings fails the job;
    ``retrieve_answers`` lists it instead.
    """
    if report_vectors is None or kb_vectors is None:
        failed = F.raise_error(F.lit("embedding retrieval needs vector tables"))
        reports = reports.filter(F.when(by_vector(), failed).isNull())
    return retrieve_answers(reports, kb, top_k, report_vectors, kb_vectors, lexical, index).matches
