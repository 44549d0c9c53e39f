"""The ranking rule shared by all retrieval methods, and its helpers.

Scores are rounded to nine places before ranking, because the order in which a cluster
adds doubles up varies; equal scores rank by ``kb_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCORE_PLACES = 9


def check_top_k(top_k: int) -> int:
    if top_k < 1:
        raise ValueError("top_k must be at least 1")
    return top_k


def best(scored: DataFrame, key: str, item: str, top_k: int) -> DataFrame:
    """The ``top_k`` rows per key by score, then by item; adds ``rank``.

    row_number() <= k lets Spark drop rows before the shuffle (WindowGroupLimit), so a
    key with very many rows costs at most k rows per map task.
    """
    order = Window.partitionBy(key).orderBy(F.desc("score"), F.asc(item))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_k)


def first_members(rows: DataFrame, key: str, top_k: int) -> DataFrame:
    """The ``top_k`` smallest kb_id per key."""
    order = Window.partitionBy(key).orderBy("kb_id")
    return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= top_k).drop("_n")


def first_candidates(case_keys: DataFrame, members: DataFrame, top_k: int) -> DataFrame:
    """(candidate_group, kb_id): the first ``top_k`` cases of every group."""
    per_facet = first_members(case_keys.select("facet_id", "kb_id"), "facet_id", top_k)
    return first_members(
        per_facet.join(members, "facet_id").select("candidate_group", "kb_id"),
        "candidate_group",
        top_k,
    )


def with_copies(
    scored: DataFrame, classes: DataFrame, profiles: DataFrame, top_k: int
) -> DataFrame:
    """Replace each distinct case by the first k of its copies.

    ``classes`` maps class_id to the digest that ``profiles`` holds per kb_id.
    """
    winners = scored.join(classes.select("class_id", "digest"), "class_id")
    copies = first_members(
        profiles.select("digest", "kb_id").join(winners.select("digest"), "digest", "left_semi"),
        "digest",
        top_k,
    )
    return winners.join(copies, "digest").select("query_key", "kb_id", "score")


def ranked_reports(
    keyed_reports: DataFrame, scored: DataFrame, fill: DataFrame | None, top_k: int
) -> DataFrame:
    """Final ranking: fill up with zero scores, rank per query, hand out to the reports.

    ``scored`` holds (query_key, kb_id, score). With fewer than k positive scores the first
    cases of the group follow with score 0; its first k always suffice.
    """
    if fill is not None:
        zeros = (
            keyed_reports.select("query_key", "candidate_group")
            .distinct()
            .join(fill, "candidate_group")
            .select("query_key", "kb_id", F.lit(0.0).alias("score"))
        )
        scored = (
            scored.select("query_key", "kb_id", "score")
            .unionByName(zeros)
            .groupBy("query_key", "kb_id")
            .agg(F.max("score").alias("score"))
        )
    top = best(scored, "query_key", "kb_id", top_k)
    return (
        keyed_reports.select("report_id", "query_key")
        .join(top, "query_key")
        .select("report_id", "rank", "kb_id", "score")
    )
