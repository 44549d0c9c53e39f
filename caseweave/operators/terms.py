"""Term tables and the statistics of TF-IDF weighting.

A report is weighted as if the model had been fitted on its candidates plus the report
itself: n counts one more document, and a term of the report has one more document that
contains it. Both follow in closed form from the statistics of the candidates alone, so
these are computed once per candidate group and shared by all its reports.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.functions.text import (
    bag_entries,
    english_stop_words,
    fingerprint,
    term_frequencies,
    with_term_bag,
    with_term_lists,
)
from caseweave.operators.candidates import (
    assign_groups,
    environment_matches,
    facet_columns,
    facets,
    first_matches,
    group_facets,
    shared_groups,
    with_facet,
)
from caseweave.operators.inputs import kb_document, report_text
from caseweave.workspace import written


def terms(df: DataFrame, key: str, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """(key, term, tf) for the words of a text column."""
    stop_words = english_stop_words() if stop_words is None else stop_words
    bags = with_term_bag(df.select(key, text), F.col(text), stop_words)
    return bag_entries(bags, key)


def idf(candidates: Column, documents_with_term: Column) -> Column:
    """Smooth idf over the candidates and the report (``candidates`` + 1 documents)."""
    return F.log((candidates + 2.0) / (documents_with_term + 1.0)) + 1.0


def case_profiles(kb: DataFrame, stop_words: list[str]) -> DataFrame:
    """(kb_id, facet_id, the facet's texts, digest, terms, tfs); copies of a case share their digest."""
    documents = with_facet(kb_document(kb)).select(
        "kb_id",
        "facet_id",
        *facet_columns(),
        fingerprint(F.col("facet_id"), F.col("document")).alias("digest"),
        "document",
    )
    return with_term_lists(documents, F.col("document"), stop_words).drop("document")


def report_queries(reports: DataFrame, named: DataFrame) -> DataFrame:
    """Reports with their group, scored text and ``query_key``.

    Reports with the same text and group share the key and are scored once.
    """
    return assign_groups(report_text(reports), named).withColumn(
        "query_key", fingerprint(F.col("candidate_group"), F.col("report_text"))
    )


class Asked(NamedTuple):
    """The reports of a batch by candidate group, for every retrieval method.

    ``reports``: (report_id, query_key, candidate_group, report_text and, where the reports have
    it, retrieval_method); ``members``: (candidate_group, facet_id) of every group with reports.
    """

    reports: DataFrame
    members: DataFrame

    def only(self, condition: Column) -> Asked:
        """The part with the reports that fulfil a condition."""
        some = self.reports.filter(condition)
        groups = some.select("candidate_group").distinct()
        return Asked(some, self.members.join(groups, "candidate_group", "left_semi"))


def asked_groups(reports: DataFrame, case_facets: DataFrame) -> Asked:
    """Find the groups of the reports once; ``case_facets`` as ``candidates.facets`` gives it."""
    matches = written(environment_matches(reports, case_facets), "matches")
    named = written(shared_groups(matches, case_facets), "groups")
    columns = ["report_id", "query_key", "candidate_group", "report_text"]
    columns += [x for x in reports.columns if x == "retrieval_method"]
    keyed = written(report_queries(reports, named).select(*columns), "reports")
    return Asked(keyed, written(group_facets(first_matches(matches, named), case_facets, keyed), "members"))


def distinct_queries(keyed_reports: DataFrame) -> DataFrame:
    return keyed_reports.groupBy("query_key").agg(
        F.min("candidate_group").alias("candidate_group"),
        F.min("report_text").alias("report_text"),
    )


def facet_sizes(cases: DataFrame) -> DataFrame:
    """(facet_id, cases)."""
    return cases.groupBy("facet_id").agg(F.count(F.lit(1)).alias("cases"))


def facet_frequencies(profiles: DataFrame) -> DataFrame:
    """(facet_id, term, df): how many cases of a facet hold a term."""
    return term_frequencies(profiles, "facet_id")


def group_sizes(sizes: DataFrame, members: DataFrame) -> DataFrame:
    """(candidate_group, candidates) from the sizes of facets."""
    whole = sizes.join(members, "facet_id").groupBy("candidate_group")
    return whole.agg(F.sum("cases").alias("candidates"))


def group_document_frequencies(frequencies: DataFrame, members: DataFrame) -> DataFrame:
    """(candidate_group, term, df), summed up from the counts of facets."""
    whole = frequencies.join(members, "facet_id").groupBy("candidate_group", "term")
    return whole.agg(F.sum("df").alias("df"))


def query_terms(
    queries: DataFrame, frequencies: DataFrame, sizes: DataFrame, stop_words: list[str]
) -> DataFrame:
    """(query_key, candidate_group, term, tf, df, candidates); df counts candidates only."""
    bags = with_term_bag(queries, F.col("report_text"), stop_words)
    return (
        bag_entries(bags, "query_key", "candidate_group")
        .join(frequencies, ["candidate_group", "term"], "left")
        .withColumn("df", F.coalesce("df", F.lit(0)))
        .join(sizes, "candidate_group")
    )


def term_stats(
    reports: DataFrame, kb: DataFrame, stop_words: list[str] | None = None
) -> DataFrame:
    """The weighted terms of every report.

    ``df`` and ``documents`` include the report; ``weight`` has unit length per report.
    """
    stop_words = english_stop_words() if stop_words is None else stop_words
    keyed, members = asked_groups(reports, facets(kb))
    profiles = written(case_profiles(kb, stop_words), "profiles")
    weighted = query_terms(
        distinct_queries(keyed),
        group_document_frequencies(facet_frequencies(profiles), members),
        written(group_sizes(facet_sizes(profiles), members), "sizes"),
        stop_words,
    ).withColumn("idf", idf(F.col("candidates"), F.col("df") + 1))
    norms = weighted.groupBy("query_key").agg(
        F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2))).alias("norm")
    )
    return (
        keyed.select("report_id", "query_key")
        .join(weighted.join(norms, "query_key"), "query_key")
        .select(
            "report_id",
            "term",
            "tf",
            (F.col("df") + 1).alias("df"),
            (F.col("candidates") + 1).alias("documents"),
            F.round("idf", 9).alias("idf"),
            F.round(F.col("tf") * F.col("idf") / F.col("norm"), 9).alias("weight"),
        )
    )
