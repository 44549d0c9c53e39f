"""Scores of responses and retrievals against expected keywords."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseweave.functions.text import joined, text_or_empty
from caseweave.operators.shaping import in_rank_order, listed_examples, matched_cases


def keyword_share(text: Column, focus: Column) -> Column:
    """Share of the keywords that occur in the text, ignoring case; none expected gives 0.

    The text is the element of a list of its own, so that it is lower-cased once and not for
    each keyword; so are the keywords.
    """
    focus = F.transform(F.coalesce(focus, F.array().cast("array<string>")), F.lower)
    once = F.array(F.lower(text_or_empty(text)))
    hits = F.transform(once, lambda t: F.size(F.filter(focus, lambda keyword: F.contains(t, keyword))))
    return F.get(hits, F.lit(0)) / F.greatest(F.size(focus), F.lit(1))


def keyword_coverage(
    texts: DataFrame, text: str = "text", focus: str = "expected_focus", name: str = "coverage"
) -> DataFrame:
    """Add the keyword share of a text column."""
    return texts.withColumn(name, keyword_share(F.col(text), F.col(focus)))


def retrieved_texts(retrieved: DataFrame, kb: DataFrame) -> DataFrame:
    """(report_id, retrieved_text): errors, causes and fixes of the matches by rank."""
    text = F.concat_ws(
        " ",
        text_or_empty(F.col("error")),
        text_or_empty(F.col("root_cause")),
        joined(F.col("fix_steps")),
    )
    return (
        matched_cases(retrieved, kb, "error", "root_cause", "fix_steps")
        .select("report_id", "rank", text.alias("match_text"))
        .groupBy("report_id")
        .agg(F.array_join(in_rank_order("match_text"), " ").alias("retrieved_text"))
    )


def retrieval_hit(cases: DataFrame, retrieved: DataFrame, kb: DataFrame) -> DataFrame:
    """(report_id, retrieval_score): keyword share over all matches of a case."""
    return (
        cases.select("report_id", "expected_focus")
        .join(retrieved_texts(retrieved, kb), "report_id", "left")
        .select(
            "report_id",
            keyword_share(F.col("retrieved_text"), F.col("expected_focus")).alias(
                "retrieval_score"
            ),
        )
    )


def evaluate_cases(cases: DataFrame, results: DataFrame, hits: DataFrame) -> DataFrame:
    """One scored row per evaluation case from the run results and retrieval scores."""
    rag = keyword_share(F.col("rag_response"), F.col("expected_focus"))
    baseline = keyword_share(F.col("baseline_response"), F.col("expected_focus"))
    return (
        cases.select(
            "report_id",
            "id",
            "error_message",
            F.coalesce("environment", F.lit("")).alias("environment"),
            "expected_focus",
            "retrieval_method",
        )
        .join(
            results.select(
                "report_id",
                "retrieval_confidence",
                "rag_response",
                "baseline_response",
                listed_examples(F.col("retrieved_examples")).alias("top_retrievals"),
            ),
            "report_id",
        )
        .join(hits, "report_id")
        .withColumn("rag_score", rag)
        .withColumn("baseline_score", baseline)
        .withColumn("score_delta", F.col("rag_score") - F.col("baseline_score"))
    )


METRICS = ["retrieval_score", "rag_score", "baseline_score", "score_delta"]


def _exact_mean(parts):
    """Mean of scores, rounded once: (keywords, score, times) for each distinct score.

    A score is a whole number of hits over the number of keywords, which is what is added up;
    without that number its binary value is.
    """
    total, count = Fraction(0), 0
    for keywords, score, times in parts:
        exact = Fraction(round(score * keywords), keywords) if keywords else Fraction(score)
        total += exact * times
        count += times
    return round(float(total / count), 3) if count else None


exact_mean = F.udf(_exact_mean, T.DoubleType())


def eval_summary(case_results: DataFrame) -> DataFrame:
    """One row of counts and averages; averages of no cases are null.

    Cases are counted by number of keywords and score, of which there are few, and the averages
    are exact, whatever the partitions.
    """
    given = "expected_focus" in case_results.columns
    keywords = F.greatest(F.size("expected_focus"), F.lit(1)) if given else F.lit(None).cast("int")
    scores = F.array(*[F.struct(F.lit(x).alias("metric"), F.col(x).alias("score")) for x in METRICS])
    counted = (
        case_results.select(keywords.alias("keywords"), F.explode(scores).alias("x"))
        .filter("x.score is not null")
        .groupBy("x.metric", "keywords", "x.score")
        .agg(F.count(F.lit(1)).alias("times"))
        .groupBy("metric")
        .agg(exact_mean(F.collect_list(F.struct("keywords", "score", "times"))).alias("mean"))
    )
    means = counted.agg(
        *[F.max(F.when(F.col("metric") == x, F.col("mean"))).alias(f"average_{x}") for x in METRICS]
    )
    delta = F.col("score_delta")
    counts = case_results.agg(
        F.count(F.lit(1)).alias("num_cases"),
        F.count_if(delta > 0).alias("rag_better_cases"),
        F.count_if(delta == 0).alias("tied_cases"),
        F.count_if(delta < 0).alias("baseline_better_cases"),
    )
    return counts.crossJoin(F.broadcast(means)).select(  # one row each
        "num_cases",
        *[f"average_{x}" for x in METRICS],
        "rag_better_cases",
        "tied_cases",
        "baseline_better_cases",
    )
