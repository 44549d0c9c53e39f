"""Token-overlap top-k: the share of the report's distinct tokens that a case contains.

Cases are reduced to the tokens that some report uses, and queries visit shards of them
(``shards``). Within a shard a query's tokens are looked up from the rarest on. A case that was
not met yet can hold the tokens that are left and no others, so as soon as these are fewer than
the k-th best count, no further case is taken up: the frequent tokens are only looked up for the
cases that were met.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.functions.text import bag_entries, with_token_bag
from caseweave.operators.candidates import facets, with_facet
from caseweave.operators.inputs import kb_document
from caseweave.operators.ranking import (
    SCORE_PLACES,
    best,
    check_top_k,
    first_candidates,
    ranked_reports,
)
from caseweave.operators.shards import visit_shards
from caseweave.operators.terms import Asked, asked_groups, distinct_queries
from caseweave.workspace import written

#: A token may occur in most cases, so the lookup of the vocabulary is salted by case.
SALTS = 8


def case_postings(entries: DataFrame, asked: DataFrame, members: DataFrame) -> DataFrame:
    """(candidate_group, kb_id, token) of the tokens that a query of the group has."""
    used = asked.select("candidate_group", "token").distinct()
    salted = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt")
    known = written(entries.withColumn("salt", F.pmod(F.hash("kb_id"), F.lit(SALTS))).join(
        used.select("token").distinct().select("token", salted), ["token", "salt"], "left_semi"
    ), "known")
    wanted = used.join(members, "candidate_group").select("facet_id", "token", "candidate_group", salted)
    return known.join(wanted, ["token", "facet_id", "salt"]).select("candidate_group", "kb_id", "token")


class _Lists:
    """The cases of a shard by token."""

    def __init__(self, table: pa.Table):
        coded = pc.dictionary_encode(table["token"].combine_chunks())
        self.tokens = {token: i for i, token in enumerate(coded.dictionary.to_pylist())}
        token = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.ids, case = np.unique(table["kb_id"].to_numpy(), return_inverse=True)
        order = np.lexsort((case, token))
        self.case = case[order]
        self.edges = np.searchsorted(token[order], np.arange(len(self.tokens) + 1))

    def best(self, tokens: list[str], top_k: int) -> tuple[np.ndarray, np.ndarray]:
        """(kb_id, shared tokens) of the k cases that share most; equal ones by kb_id."""
        known = [self.tokens[x] for x in tokens if x in self.tokens]
        spans = sorted(((self.edges[i], self.edges[i + 1]) for i in known), key=lambda x: x[1] - x[0])
        shared, met, floor = np.zeros(len(self.ids), np.int64), np.zeros(0, np.int64), 0
        for k, (a, b) in enumerate(spans):
            some = self.case[a:b]
            if len(spans) - k < floor:  # whoever was not met has fewer
                place = np.minimum(np.searchsorted(some, met), len(some) - 1)
                shared[met] += some[place] == met
                continue
            shared[some] += 1
            # a floor is worth its search as soon as the tokens left could be below it
            if k + 1 >= len(spans) - k - 1:
                met = np.flatnonzero(shared)
                if len(met) >= top_k:
                    floor = np.partition(shared[met], -top_k)[-top_k]
        met = np.flatnonzero(shared)
        order = np.lexsort((met, -shared[met]))[:top_k]
        return self.ids[met[order]], shared[met[order]]


def _scored(top_k: int):
    def run(queries: pa.Table, postings: pa.Table) -> pa.Table:
        keys, cases, scores = [], [], []
        if queries.num_rows and postings.num_rows:
            lists = _Lists(postings)
            for row in queries.to_pylist():
                found, shared = lists.best(row["tokens"], top_k)
                keys += [row["query_key"]] * len(found)
                cases += found.tolist()
                scores += np.round(shared / len(row["tokens"]), SCORE_PLACES).tolist()
        columns = [pa.array(keys, pa.binary()), pa.array(cases, pa.int64()), pa.array(scores, pa.float64())]
        return pa.table(columns, names=["query_key", "kb_id", "score"])

    return run


def overlap_topk(
    reports: DataFrame | None, kb: DataFrame, top_k: int = 3, asked: Asked | None = None
) -> DataFrame:
    """(report_id, rank, kb_id, score) by token overlap; ``asked`` must come from ``reports``."""
    check_top_k(top_k)
    keyed, members = asked or asked_groups(reports, facets(kb))
    queries = with_token_bag(distinct_queries(keyed), F.col("report_text"))
    tokens = F.transform("bag", lambda x: x["term"]).alias("tokens")
    queries = written(queries.select("query_key", "candidate_group", tokens), "queries")
    wanted = queries.select("candidate_group", F.explode("tokens").alias("token"))
    bags = with_token_bag(with_facet(kb_document(kb)).select("kb_id", "facet_id", "document"), F.col("document"))
    entries = bag_entries(bags, "kb_id", "facet_id").select("kb_id", "facet_id", F.col("term").alias("token"))
    postings = case_postings(entries, wanted, members)
    result = "query_key binary, kb_id long, score double"
    found = visit_shards(queries, postings, "kb_id", _scored(top_k), result)
    scored = best(found, "query_key", "kb_id", top_k).drop("rank")
    case_keys = with_facet(kb).select("kb_id", "facet_id")
    return ranked_reports(keyed, scored, first_candidates(case_keys, members, top_k), top_k)
