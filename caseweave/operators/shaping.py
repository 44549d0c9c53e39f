"""From ranked cases to labels, metrics and evidence text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.functions.text import fixed_point, joined, round_half_even, text_or_empty
from caseweave.operators.inputs import shown_platform
from caseweave.schemas import CASE_FIELDS

# Labels and texts that are part of the results.
HIGH_SCORE = 0.45
MEDIUM_SCORE = 0.2
NO_EVIDENCE = "No relevant examples found."
NO_FIX_STEP = "No fix step available."
LOW_NOTICE = (
    "Low-confidence retrieval: the retrieved matches are weak, so the response may rely more "
    "on general model reasoning than domain-specific evidence."
)
MEDIUM_NOTICE = (
    "Medium-confidence retrieval: the answer uses relevant evidence, but the match is not "
    "highly specific."
)


def confidence_label(top_score: Column) -> Column:
    """A report without matches has a null score and gets ``low``."""
    return (
        F.when(top_score >= HIGH_SCORE, "high").when(top_score >= MEDIUM_SCORE, "medium").otherwise("low")
    )


def matched_cases(retrieved: DataFrame, kb: DataFrame, *columns) -> DataFrame:
    """Retrieved rows with columns of their case.

    The knowledge base is first reduced to the cases that occur, so only their texts move.
    """
    winners = kb.join(retrieved.select("kb_id").distinct(), "kb_id", "left_semi")
    return retrieved.join(winners.select("kb_id", *columns), "kb_id")


def confidence(reports: DataFrame, retrieved: DataFrame) -> DataFrame:
    """(report_id, retrieval_confidence) for every report."""
    top = retrieved.filter("rank = 1").select("report_id", "score")
    return (
        reports.select("report_id")
        .join(top, "report_id", "left")
        .select("report_id", confidence_label(F.col("score")).alias("retrieval_confidence"))
    )


def run_metrics(reports: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Method, confidence, number of matches, top score and notice per report."""
    counts = retrieved.groupBy("report_id").agg(
        F.count(F.lit(1)).alias("evidence_count"), F.max("score").alias("top_score")
    )
    joined_counts = reports.select("report_id", "retrieval_method").join(counts, "report_id", "left")
    return joined_counts.select("report_id", "retrieval_method", *metric_columns())


def metric_columns() -> list[Column]:
    """Confidence, number of matches, top score and notice, from the counts of a report."""
    label = confidence_label(F.col("top_score"))
    return [
        label.alias("retrieval_confidence"),
        F.coalesce("evidence_count", F.lit(0)).alias("evidence_count"),
        F.coalesce("top_score", F.lit(0.0)).alias("top_score"),
        F.when(label == "low", LOW_NOTICE).when(label == "medium", MEDIUM_NOTICE).alias("notice"),
    ]


def _example_text() -> Column:
    quoted_steps = F.transform("fix_steps", lambda step: F.concat(F.lit('"'), step, F.lit('"')))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Example "), F.col("rank").cast("string")),
        F.concat(F.lit("Score: "), fixed_point(F.col("score"))),
        F.concat(F.lit("Error: "), text_or_empty(F.col("error"))),
        F.concat(F.lit("Platform: "), shown_platform()),
        F.concat(F.lit('Quoted root cause: "'), text_or_empty(F.col("root_cause")), F.lit('"')),
        F.concat(F.lit("Explanation: "), text_or_empty(F.col("explanation"))),
        F.concat(F.lit("Quoted fix steps: "), joined(quoted_steps, " | ")),
        F.concat(F.lit("Common mistakes: "), joined(F.col("common_mistakes"), " | ")),
        F.concat(
            F.lit("Source: "),
            F.coalesce("source_type", F.lit("Unknown")),
            F.lit(" - "),
            F.coalesce("source_url", F.lit("N/A")),
        ),
    )


def in_rank_order(value: str) -> Column:
    """Aggregate the values of a report into an array by rank (at most k of them)."""
    return F.transform(F.array_sort(F.collect_list(F.struct("rank", value))), lambda e: e[value])


def examples_of(retrieved: DataFrame, kb: DataFrame) -> DataFrame:
    """(report_id, retrieved_examples, evidence_count, top_score, evidence): the matches of a
    report with the fields of their cases, in rank order, and the same as one text."""
    fields = [field.name for field in CASE_FIELDS]
    example = F.struct("rank", "kb_id", "score", *fields)
    found = (
        matched_cases(retrieved, kb, *fields)
        .select("report_id", "rank", "score", example.alias("case"), _example_text().alias("example"))
        .groupBy("report_id")
        .agg(
            in_rank_order("case").alias("retrieved_examples"),
            in_rank_order("example").alias("examples"),
            F.count(F.lit(1)).alias("evidence_count"),
            F.max("score").alias("top_score"),
        )
    )
    heading = F.concat(F.lit("Retrieval confidence: "), confidence_label(F.col("top_score")))
    text = F.array_join(F.concat(F.array(heading), "examples"), "\n\n")
    return found.withColumn("evidence", text).drop("examples")


def listed_examples(examples: Column) -> Column:
    """Examples as an evaluation lists them: scores of three places, no case positions."""
    return F.transform(
        examples,
        lambda e: F.struct(
            text_or_empty(e["error"]).alias("error"),
            text_or_empty(e["platform"]).alias("platform"),
            round_half_even(e["score"]).alias("score"),
            text_or_empty(e["root_cause"]).alias("root_cause"),
            F.coalesce(e["fix_steps"], F.array().cast("array<string>")).alias("fix_steps"),
            F.coalesce(e["source_url"], F.lit("N/A")).alias("source_url"),
        ),
    )


def evidence_context(reports: DataFrame, retrieved: DataFrame, kb: DataFrame) -> DataFrame:
    """(report_id, evidence): the matches of a report as one text block."""
    return (
        reports.select("report_id")
        .join(examples_of(retrieved, kb).select("report_id", "evidence"), "report_id", "left")
        .select("report_id", F.coalesce("evidence", F.lit(NO_EVIDENCE)).alias("evidence"))
    )


def primary_evidence(retrieved: DataFrame, kb: DataFrame) -> DataFrame:
    """The best match of every report that has one."""
    return matched_cases(
        retrieved.filter("rank = 1"), kb, "error", "root_cause", "fix_steps", "source_url"
    ).select(
        "report_id",
        F.coalesce("error", F.lit("Unknown")).alias("error"),
        round_half_even(F.col("score")).alias("score"),
        confidence_label(F.col("score")).alias("retrieval_confidence"),
        text_or_empty(F.col("root_cause")).alias("root_cause"),
        F.coalesce(F.get("fix_steps", F.lit(0)), F.lit(NO_FIX_STEP)).alias("fix_step"),
        F.coalesce("source_url", F.lit("N/A")).alias("source_url"),
    )


def top_retrievals(retrieved: DataFrame, kb: DataFrame) -> DataFrame:
    """One row per match with the columns that listings show.

    ``platform`` is the plain one, ``shown_platform`` falls back to the context.
    """
    return matched_cases(
        retrieved,
        kb,
        "error",
        "platform",
        "context",
        "explanation",
        "root_cause",
        "fix_steps",
        "source_type",
        "source_url",
    ).select(
        "report_id",
        "rank",
        "kb_id",
        text_or_empty(F.col("error")).alias("error"),
        text_or_empty(F.col("platform")).alias("platform"),
        shown_platform().alias("shown_platform"),
        round_half_even(F.col("score")).alias("score"),
        text_or_empty(F.col("explanation")).alias("explanation"),
        text_or_empty(F.col("root_cause")).alias("root_cause"),
        joined(F.col("fix_steps"), "\n").alias("fix_steps"),
        F.coalesce("source_type", F.lit("Unknown")).alias("source_type"),
        F.coalesce("source_url", F.lit("N/A")).alias("source_url"),
    )
