"""Exact TF-IDF cosine top-k over shards of the cases.

The model that would be fitted per report follows from the statistics of its candidate group,
so document frequencies and the norms of cases are computed once per group. The cases of a group
are dealt to shards, and a shard is one row from then on: its distinct terms and, as numbers, the
entries of its cases. Large groups share the dealing: their cases are packed together and taken
apart by group. A weight travels once for each term of a shard that more than one case of the group
holds, and an entry is never a row of a table. Queries visit the shards (``shards``), which return their k best cases only.

Within a shard the postings of a term that a query has are a list sorted by impact, the case's
share of a score, in blocks of ``BLOCK``; the first of a block bounds all of it. For every query

1. the first blocks of its terms give cases whose scores set a floor, the k-th best of them;
2. each term is allowed the same part of a score, as much as all terms together can have while
   they stay below the floor. Blocks whose bound is not above that are skipped, and so a case
   that is only in skipped blocks is below the floor;
3. all cases of the other blocks are scored exactly.

Nothing is capped or sampled; skipped cases provably score below the k-th.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseweave.functions.text import bag_entries, english_stop_words, listed_bag
from caseweave.operators import shards
from caseweave.operators.ranking import (
    SCORE_PLACES,
    best,
    check_top_k,
    first_candidates,
    ranked_reports,
    with_copies,
)
from caseweave.operators.shards import GROUP, visit_packed
from caseweave.operators.terms import (
    Asked,
    asked_groups,
    case_profiles,
    distinct_queries,
    facet_frequencies,
    facet_sizes,
    group_document_frequencies,
    group_sizes,
    idf,
    query_terms,
)
from caseweave.workspace import written

BLOCK = 128
TIE_MARGIN = 1e-8
#: Entries of a shard for one posting of ``POSTINGS_PER_SHARD``: reports use some terms only.
ENTRIES = 4
#: A group with this part of all entries is dealt together with others, about so many at a time.
LARGE = 1 / 16
TOGETHER = 8

FACET_TEXTS = ["facet_platform", "facet_context", "facet_tags"]


class CaseIndex(NamedTuple):
    """The part of the work that depends on the knowledge base alone.

    ``profiles``: (kb_id, facet_id, the facet's texts, digest, terms, tfs, bag) of every case, the
    bag made of the two before it where it is read; ``copies``: the kb_id of every case that
    repeats one before it; ``facets``: (facet_id, its texts);
    ``sizes``: (facet_id, cases); ``frequencies``: (facet_id, term, df).
    """

    profiles: DataFrame
    copies: DataFrame
    facets: DataFrame
    sizes: DataFrame
    frequencies: DataFrame


class GroupStatistics(NamedTuple):
    """What the cases of a candidate group have in common with no report in sight.

    ``sizes``: (candidate_group, candidates); ``frequencies``: (candidate_group, term, df);
    ``norms``: (candidate_group, class_id, norm2), over all terms of a case; ``shards``: one row
    for each shard of a group's cases, as ``_PACKED`` has it, with the ``norms`` of ``classes``.
    """

    sizes: DataFrame
    frequencies: DataFrame
    norms: DataFrame
    shards: DataFrame


def later_copies(profiles: DataFrame) -> DataFrame:
    """(kb_id) of every case that repeats one with a smaller kb_id."""
    repeated = (
        profiles.groupBy("digest")
        .agg(F.min("kb_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )
    return (
        profiles.select("digest", "kb_id")
        .join(repeated, "digest")
        .filter(F.col("kb_id") != F.col("first_id"))
        .select("kb_id")
    )


def distinct_cases(index: CaseIndex) -> DataFrame:
    """One row per group of copies: (class_id, digest, facet_id, terms, tfs, bag).

    Copies have equal scores, so they are weighted once; ``class_id`` is the smallest
    kb_id of the group. Only ids are grouped and joined, the bags stay where they are
    unless a large part of the cases are copies.
    """
    first = index.profiles.join(index.copies, "kb_id", "left_anti")
    return first.select(F.col("kb_id").alias("class_id"), "digest", "facet_id", "terms", "tfs", "bag")


def _indexed(profiles: DataFrame, sizes: DataFrame, frequencies: DataFrame) -> CaseIndex:
    return CaseIndex(
        profiles.withColumn("bag", listed_bag()),
        written(later_copies(profiles), "copies"),
        written(profiles.select("facet_id", *FACET_TEXTS).distinct(), "facets"),
        written(sizes, "facet_sizes"),
        written(frequencies, "facet_frequencies"),
    )


def case_index(kb: DataFrame, stop_words: list[str] | None = None) -> CaseIndex:
    """Count the words of every case once, for use with many batches of reports."""
    stop_words = english_stop_words() if stop_words is None else stop_words
    profiles = written(case_profiles(kb, stop_words), "profiles")
    return _indexed(profiles, facet_sizes(profiles), facet_frequencies(profiles))


def updated_index(
    index: CaseIndex, added: DataFrame, removed: DataFrame, stop_words: list[str] | None = None
) -> CaseIndex:
    """The index after the cases ``removed`` (kb_id) went and the cases ``added`` came.

    An added case replaces the one with its kb_id. Only the words of added cases are counted;
    sizes and frequencies are the old ones plus the differences. Statistics of groups belong
    to the index they were computed from.
    """
    stop_words = english_stop_words() if stop_words is None else stop_words
    new = written(case_profiles(added, stop_words), "added")
    ids = removed.select("kb_id").unionByName(new.select("kb_id")).distinct()
    old_profiles = index.profiles.drop("bag")
    gone = written(old_profiles.join(ids, "kb_id", "left_semi"), "gone")
    stay = old_profiles.join(gone.select("kb_id"), "kb_id", "left_anti")
    profiles = written(stay.unionByName(new), "profiles")

    def changed(old: DataFrame, count, key: list[str], name: str) -> DataFrame:
        less = count(gone).withColumn(name, -F.col(name))
        rows = old.unionByName(count(new)).unionByName(less)
        return rows.groupBy(*key).agg(F.sum(name).alias(name)).filter(F.col(name) > 0)

    return _indexed(
        profiles,
        changed(index.sizes, facet_sizes, ["facet_id"], "cases"),
        changed(index.frequencies, facet_frequencies, ["facet_id", "term"], "df"),
    )


_PACKED = (
    "candidate_group string, shard int, classes array<long>, terms string, counts binary, cases binary, tfs binary"
)
_NAMES = ["candidate_group", "shard", "classes", "terms", "counts", "cases", "tfs"]


def _narrow(numbers: np.ndarray) -> bytes:
    most = int(numbers.max()) if len(numbers) else 0
    return numbers.astype(np.min_scalar_type(most)).tobytes()


def _wide(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // max(count, 1) or 1}").astype(np.int64)


def _one(lists: pa.Table, name: str):
    return lists[name].combine_chunks()[0]


def _packed(cases: pa.Table) -> pa.Table:
    """The rows of a shard, one for each group: entries by term and then by the place of the case
    in ``classes``.

    Rows that repeat a class_id are one case with the entries of all.
    """
    cases = cases.sort_by("class_id").combine_chunks()
    classes, of = np.unique(cases["class_id"].to_numpy(), return_inverse=True)
    words = pc.split_pattern(_flat(cases["terms"]), " ")
    coded = words.flatten().dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    names = coded.dictionary.take(order)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    # the place of an entry below its term, so that one sort of numbers keeps their order
    entry = (place[coded.indices.to_numpy()] << 32) | np.arange(len(coded))
    entry.sort()
    term, entry = entry >> 32, entry & 0xFFFFFFFF
    row = np.repeat(np.arange(len(of)), np.diff(words.offsets.to_numpy()))[entry]
    tf = _flat(cases["tfs"]).flatten().to_numpy()[entry]
    sets = _flat(cases["groups"])
    held = pc.list_parent_indices(sets).to_numpy()
    groups = sets.flatten().dictionary_encode()
    rows = []
    for i, group in enumerate(groups.dictionary.to_pylist()):
        mine = np.zeros(len(of), bool)
        mine[held[groups.indices.to_numpy() == i]] = True
        some = mine[row]
        counts = np.bincount(term[some], minlength=len(names))
        there = np.zeros(len(classes), bool)
        there[of[mine]] = True
        rows.append(
            [
                group,
                _one(cases, "shard").as_py(),
                classes[there],
                _text(names.filter(pa.array(counts > 0))),
                _narrow(counts[counts > 0]),
                _narrow((np.cumsum(there) - 1)[of[row[some]]]),
                _narrow(tf[some]),
            ]
        )
    kinds = [pa.string(), pa.int32(), pa.list_(pa.int64()), pa.string(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=_NAMES)


def _text(words: pa.StringArray) -> str:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py()


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _numbers(data: bytes, count: int) -> np.ndarray:
    """As ``_wide``, as narrow as they are stored."""
    return np.frombuffer(data, f"u{len(data) // max(count, 1) or 1}")


def _entries(lists: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Of a packed shard the terms, how many entries each has, and the entries' cases and tf."""
    names = pc.split_pattern(_flat(lists["terms"]), " ").flatten()
    counts = _wide(_one(lists, "counts").as_py(), len(names))
    total = int(counts.sum())
    return names, counts, *(_numbers(_one(lists, x).as_py(), total) for x in ("cases", "tfs"))


def _weighted(lists: pa.Table, weights: pa.Table) -> pa.Table:
    """A packed shard with the norms of its cases."""
    names, counts, case, tf = _entries(lists)
    at, known = pc.index_in(_flat(weights["term"]), value_set=names), weights["idf0"].to_numpy()
    once = at.is_null().to_numpy(zero_copy_only=False)
    idf0 = np.full(len(names), known[once][0])
    idf0[at.drop_null().to_numpy()] = known[~once]
    norm2 = np.bincount(case, (tf * np.repeat(idf0, counts)) ** 2, len(_one(lists, "classes")))
    return lists.append_column("norms", pa.array([norm2], pa.list_(pa.float64())))


def packed_shards(index: CaseIndex, members: DataFrame, frequencies: DataFrame) -> DataFrame:
    """The cases of every group, dealt to shards of equal size; a shard of a group is one row.

    Large groups have the shards that all cases would have, so those of several are packed at
    once, each term read, coded and sorted once for all of them. What a row holds depends on
    the index and its group only.
    """
    most = ENTRIES * shards.POSTINGS_PER_SHARD
    parts = F.ceil(F.col("entries") / most).cast("int")
    whole = index.frequencies.agg(F.sum("df")).scalar()
    sums = frequencies.groupBy(GROUP).agg(F.sum("df").alias("entries"))
    sums = sums.withColumn("all", whole).withColumn("large", F.col("entries") >= F.col("all") * LARGE)
    sums = written(sums, "entries")
    packs = sums.agg(F.ceil(F.count_if("large") / TOGETHER)).scalar()
    pack = F.concat(F.lit("*"), F.pmod(F.xxhash64(GROUP), packs))
    shape = sums.select(
        GROUP,
        F.when(F.col("large"), pack).otherwise(F.col(GROUP)).alias("pack"),
        F.when(F.col("large"), F.ceil(F.col("all") / most).cast("int")).otherwise(parts).alias("shards"),
    )
    sets = members.join(shape, GROUP).groupBy("facet_id", "pack", "shards")
    sets = written(sets.agg(F.sort_array(F.collect_list(GROUP)).alias("groups")), "shards")
    cases = distinct_cases(index).filter(F.col("class_id").isNotNull() & (F.col("terms") != ""))
    shard = F.pmod(F.xxhash64("class_id"), F.col("shards")).cast("int").alias("shard")
    dealt = cases.join(sets, "facet_id").select("pack", shard, "groups", "class_id", "terms", "tfs")
    return dealt.groupBy("pack", "shard").applyInArrow(_packed, _PACKED)


def group_statistics(
    index: CaseIndex, members: DataFrame, known: GroupStatistics | None = None
) -> GroupStatistics:
    """Statistics of the groups of ``members``; those that ``known`` has are not computed again.

    ``known`` must come from the same index. Groups are named by their facets, so their names
    mean the same in every batch.
    """
    if known:
        members = written(members.join(known.sizes, "candidate_group", "left_anti"), "new_members")
    sizes = written(group_sizes(index.sizes, members), "sizes")
    frequencies = written(group_document_frequencies(index.frequencies, members), "frequencies")
    packed = written(packed_shards(index, members, frequencies), "packed")
    # a weight for each distinct term of a shard that several cases hold, and one without a term for the others
    several = frequencies.filter("df > 1").join(sizes, GROUP)
    several = several.select(GROUP, "term", idf(F.col("candidates"), F.col("df")).alias("idf0"))
    held = packed.select(GROUP, "shard", F.explode(F.split("terms", " ")).alias("term"))
    once = packed.select(GROUP, "shard").join(sizes, GROUP)
    no_term = F.lit(None).cast("string").alias("term")
    once = once.select(GROUP, "shard", no_term, idf(F.col("candidates"), F.lit(1)).alias("idf0"))
    weights = held.join(several, [GROUP, "term"]).select(GROUP, "shard", "term", "idf0").unionByName(once)
    weights = weights.select(F.col(GROUP).alias(GROUP), F.col("shard").alias("shard"), "term", "idf0")
    keys = [GROUP, "shard"]
    lists = packed.groupBy(*keys).cogroup(weights.groupBy(*keys))
    lists = written(lists.applyInArrow(_weighted, f"{_PACKED}, norms array<double>"), "lists")
    pairs = F.explode(F.arrays_zip("classes", "norms")).alias("case")
    norms = lists.select(GROUP, pairs).select(
        GROUP, F.col("case.classes").alias("class_id"), F.col("case.norms").alias("norm2")
    )
    fresh = GroupStatistics(sizes, frequencies, norms, lists)
    if not known:
        return fresh
    return GroupStatistics(*[a.unionByName(b) for a, b in zip(known, fresh)])


def query_entries(weighted: DataFrame) -> DataFrame:
    """The terms of every distinct query that occur in its candidates.

    ``norm2`` covers all terms of the query; ``idf0`` leaves the query out, ``idf1`` counts it.
    """
    whole = Window.partitionBy("query_key")
    return (
        weighted.withColumn("idf1", idf(F.col("candidates"), F.col("df") + 1))
        .withColumn("norm2", F.sum(F.pow(F.col("tf") * F.col("idf1"), 2)).over(whole))
        .filter("df > 0")
        .withColumn("idf0", idf(F.col("candidates"), F.col("df")))
        .select("query_key", "candidate_group", "term", "tf", "idf0", "idf1", "norm2")
    )


def case_postings(index: CaseIndex, asked: DataFrame, members: DataFrame, norms: DataFrame) -> DataFrame:
    """(candidate_group, class_id, term, tf, idf0, norm2) of the terms that a query of the group has.

    A row for each entry, to look at and to compare with: searches use the packed shards.
    """
    used = asked.select("candidate_group", "term", "idf0").distinct()
    entries = bag_entries(distinct_cases(index), "facet_id", "class_id")
    return (
        entries.join(used.select("term").distinct(), "term", "left_semi")
        .join(members, "facet_id")
        .join(used, ["term", "candidate_group"])
        .join(norms, ["candidate_group", "class_id"])
        .select("candidate_group", "class_id", "term", "tf", "idf0", "norm2")
    )


class _Postings:
    """The postings of a shard for some terms with their idf: by impact in blocks, and by case."""

    def __init__(self, lists: pa.Table, used: dict[str, float]):
        names, counts, case, tf = _entries(lists)
        at = pc.index_in(pa.array(list(used), pa.string()), value_set=names)
        there = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        at = at.drop_null().to_numpy()
        known = list(used)
        self.terms = {known[j]: i for i, j in enumerate(there.tolist())}
        self.classes = _one(lists, "classes").values.to_numpy()
        self.norm2 = _one(lists, "norms").values.to_numpy()
        n = counts[at]
        self.edges = np.concatenate([[0], np.cumsum(n)])
        place = np.repeat((np.cumsum(counts) - counts)[at] - self.edges[:-1], n) + np.arange(n.sum())
        # entries of a term are in the order of the cases
        self.case, self.tf = case[place].astype(np.int64), tf[place].astype(np.float64)
        term, idf0 = np.repeat(np.arange(len(n)), n), np.array(list(used.values()), float)[there]
        impact = self.tf * idf0[term] / np.sqrt(self.norm2[self.case])
        order = np.lexsort((-impact, term))  # stable, so equal ones stay in the order of the cases
        self.impact, self.heavy = impact[order], self.case[order]

    def best(self, names: list, tf, idf0, idf1, norm2: float, top_k: int) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``classes``, score) of the k best cases of a query."""
        known = [(self.terms[x], *y) for x, *y in zip(names, tf, idf0, idf1) if x in self.terms]
        if not known:
            return np.zeros(0, np.int64), np.zeros(0)
        spans = [(self.edges[x[0]], self.edges[x[0] + 1]) for x in known]
        tf, idf0, idf1 = (np.array(x, float) for x in list(zip(*known))[1:])
        # a case's part of a score is its impact times ``gain`` at most
        gain = tf * idf1 * idf1 / idf0 / np.sqrt(norm2) / (idf1 / idf0).min()
        weights = list(zip(spans, tf * idf1 * idf1, idf1 * idf1 - idf0 * idf0))

        def scores(cases: np.ndarray) -> np.ndarray:
            dot, grown = np.zeros(len(cases)), self.norm2[cases]
            for (a, b), weight, growth in weights:
                at = np.minimum(a + np.searchsorted(self.case[a:b], cases), b - 1)
                held = self.tf[at] * (self.case[at] == cases)
                dot += weight * held
                grown += growth * held * held
            return np.round(dot / np.sqrt(grown * norm2), SCORE_PLACES)

        cases = np.unique(np.concatenate([self.heavy[a : min(a + BLOCK, b)] for a, b in spans]))
        found = scores(cases)
        if sum(b - a for a, b in spans) > len(spans) * BLOCK:
            floor = np.partition(found, -top_k)[-top_k] - TIE_MARGIN if len(found) >= top_k else 0.0
            reach = gain * self.impact[[a for a, _ in spans]]
            allowed = _equal_parts(reach, floor) / gain
            more = []
            for (a, b), least in zip(spans, allowed.tolist()):
                blocks = np.count_nonzero(self.impact[a:b:BLOCK] > least)
                more.append(self.heavy[min(a + BLOCK, b) : min(a + blocks * BLOCK, b)])
            more = np.setdiff1d(np.concatenate(more), cases)
            cases, found = np.concatenate([cases, more]), np.concatenate([found, scores(more)])
        order = np.lexsort((cases, -found))[:top_k]
        return cases[order], found[order]


def _equal_parts(reach: np.ndarray, total: float) -> np.ndarray:
    """The largest equal part that the terms can take, each at most its ``reach``, so that their
    sum stays within ``total``."""
    if reach.sum() <= total:
        return np.full(len(reach), np.inf)
    ordered = np.sort(reach)
    before = np.cumsum(ordered) - ordered
    parts = (max(total, 0.0) - before) / np.arange(len(reach), 0, -1)
    return np.full(len(reach), parts[np.argmax(parts <= ordered)])


def _shard(top_k: int):
    def run(queries: pa.Table, postings: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and postings.num_rows:
            rows = queries.to_pylist()
            lists = _Postings(postings, {x["term"]: x["idf0"] for row in rows for x in row["terms"]})
            for row in rows:
                terms = row["terms"]
                names, numbers = [x["term"] for x in terms], ([x[y] for x in terms] for y in ("tf", "idf0", "idf1"))
                cases, found = lists.best(names, *numbers, row["norm2"], top_k)
                out += [(row["query_key"], i, s) for i, s in zip(lists.classes[cases].tolist(), found.tolist())]
        columns = zip(*out) if out else ((), (), ())
        kinds = [pa.binary(), pa.int64(), pa.float64()]
        return pa.table([pa.array(x, t) for x, t in zip(columns, kinds)], names=["query_key", "class_id", "score"])

    return run


def score_shards(asked: DataFrame, lists: DataFrame, top_k: int) -> DataFrame:
    """(query_key, class_id, score): the k best cases of every query in every shard."""
    queries = asked.groupBy("query_key", "candidate_group").agg(
        F.first("norm2").alias("norm2"), F.collect_list(F.struct("term", "tf", "idf0", "idf1")).alias("terms")
    )
    result = "query_key binary, class_id long, score double"
    return visit_packed(queries, lists, _shard(top_k), result)


def tfidf_topk(
    reports: DataFrame | None,
    kb: DataFrame | None,
    top_k: int = 3,
    stop_words: list[str] | None = None,
    index: CaseIndex | None = None,
    asked: Asked | None = None,
    known: GroupStatistics | None = None,
) -> DataFrame:
    """(report_id, rank, kb_id, score): the best ``top_k`` cases per report.

    ``index`` must come from the same ``kb`` and ``stop_words``, ``asked`` from the same
    ``reports`` and ``known`` from the same index; with an index no text of a case is read.
    """
    check_top_k(top_k)
    stop_words = english_stop_words() if stop_words is None else stop_words
    index = index or case_index(kb, stop_words)
    keyed, members = asked or asked_groups(reports, index.facets)
    statistics = group_statistics(index, members, known)
    terms = query_terms(distinct_queries(keyed), statistics.frequencies, statistics.sizes, stop_words)
    terms = written(query_entries(terms), "asked")
    winners = best(score_shards(terms, statistics.shards, top_k), "query_key", "class_id", top_k).drop("rank")
    scored = with_copies(written(winners, "winners"), distinct_cases(index), index.profiles, top_k)
    return ranked_reports(keyed, scored, first_candidates(index.profiles, members, top_k), top_k)
