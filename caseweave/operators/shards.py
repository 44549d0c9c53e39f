"""Queries that visit shards of postings.

The postings of a candidate group are dealt to shards by case, so a term that every case holds
is spread over all of them. Every query of the group visits each shard as one row; queries are
cut into blocks, so a task is bounded on both sides. A shard returns its best cases only, and
pairs of a query and a case are never rows of a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.workspace import written

GROUP = "candidate_group"
POSTINGS_PER_SHARD = 1 << 18
QUERIES_PER_BLOCK = 1 << 12


def visit_shards(
    queries: DataFrame, postings: DataFrame, case: str, scorer: Callable, result: str
) -> DataFrame:
    """``scorer(queries, postings)`` on every shard; both tables have ``candidate_group``.

    ``queries`` has a row for a ``query_key``; ``case`` names the id that deals the postings.
    """
    queries, postings = written(queries, "queries"), written(postings, "postings")
    shape = postings.groupBy(GROUP).agg(_parts(POSTINGS_PER_SHARD, "shards"))
    shape = shape.join(queries.groupBy(GROUP).agg(_parts(QUERIES_PER_BLOCK, "blocks")), GROUP)
    shape = written(shape, "shape")
    asks = queries.join(shape, GROUP).withColumn("shard", _every("shards"))
    asks = asks.withColumn("block", _dealt("query_key", "blocks")).drop("shards", "blocks")
    lists = postings.join(shape, GROUP).withColumn("shard", _dealt(case, "shards"))
    lists = lists.withColumn("block", _every("blocks")).drop("shards", "blocks")
    keys = [GROUP, "shard", "block"]
    return asks.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInArrow(scorer, result)


def visit_packed(queries: DataFrame, lists: DataFrame, scorer: Callable, result: str) -> DataFrame:
    """As ``visit_shards``, on shards that are there: ``lists`` has one row for a group and shard."""
    queries = written(queries, "queries")
    blocks = written(queries.groupBy(GROUP).agg(_parts(QUERIES_PER_BLOCK, "blocks")), "shape")
    asks = queries.join(blocks, GROUP).withColumn("block", _dealt("query_key", "blocks")).drop("blocks")
    asks = asks.join(lists.select(F.col(GROUP).alias(GROUP), F.col("shard").alias("shard")), GROUP)
    lists = lists.join(blocks, GROUP).withColumn("block", _every("blocks")).drop("blocks")
    keys = [GROUP, "shard", "block"]
    return asks.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInArrow(scorer, result)


def _parts(most: int, name: str):
    return F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name)


def _every(name: str):
    return F.explode(F.sequence(F.lit(0), F.col(name) - 1))


def _dealt(key: str, name: str):
    return F.pmod(F.xxhash64(key), F.col(name)).cast("int")
