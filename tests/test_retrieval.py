import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from caseweave.functions.text import english_stop_words
from caseweave.operators import shards, tfidf
from caseweave.operators.candidates import candidate_filter
from caseweave.operators.overlap import overlap_topk
from caseweave.operators.ranking import best, first_candidates, ranked_reports, with_copies
from caseweave.operators.retrieve import retrieve
from caseweave.operators.shards import visit_shards
from caseweave.operators.terms import asked_groups, term_stats
from caseweave.operators.tfidf import tfidf_topk
from caseweave.operators.vectors import (
    BAD_VECTOR,
    NO_CANDIDATE,
    NO_VECTOR,
    _Search,
    embedding_answers,
    embedding_topk,
    packed_cells,
)
from caseweave.schemas import KB_SCHEMA, REPORT_SCHEMA
from caseweave.workspace import written
from tests.corpus import corpus
from tests.direct import (
    by_report,
    candidates,
    case,
    frame,
    overlap_scores,
    ranking,
    report,
    tfidf_scores,
    vector_scores,
)

VECTORS = "id long, embedding array<float>"


def expected(reports, kb, scores, k):
    found = {}
    for row in reports:
        chosen = candidates(row, kb)
        found[row["report_id"]] = ranking(chosen, scores(row, chosen), k)
    return found


@pytest.mark.parametrize("seed, k", [(1, 3), (2, 1), (3, 60)])
def test_tfidf_equals_direct_scoring(spark, seed, k):
    kb, reports = corpus(seed)
    found = by_report(
        tfidf_topk(frame(spark, reports, REPORT_SCHEMA), frame(spark, kb, KB_SCHEMA, seed), k)
    )
    wanted = expected(reports, kb, tfidf_scores, k)
    assert found == wanted


def test_scores_by_hand(spark):
    """Three cases "disk", "disk disk" and "net", asked for "disk": four documents with the report.

    Of the labels, error is in all four (weight 1) and the ten others in the three cases, as is
    disk with the report: ln(5/4) + 1. Message and net are in one: ln(5/2) + 1.
    """
    few, one = math.log(5 / 4) + 1, math.log(5 / 2) + 1
    asked = 1 + few**2 + one**2
    by_hand = [
        (1 + few**2) / math.sqrt(asked * (1 + 11 * few**2)),
        (1 + 2 * few**2) / math.sqrt(asked * (1 + 14 * few**2)),
        1 / math.sqrt(asked * (1 + 10 * few**2 + one**2)),
    ]
    assert [round(x, 4) for x in by_hand] == [0.2405, 0.3431, 0.0909]
    kb = frame(spark, [case(0, "disk"), case(1, "disk disk"), case(2, "net")], KB_SCHEMA)
    reports = frame(spark, [report(7, "disk")], REPORT_SCHEMA)
    found = by_report(tfidf_topk(reports, kb))
    assert found == {7: [(i, round(by_hand[i], 7)) for i in (1, 0, 2)]}
    assert by_report(overlap_topk(reports, kb)) == {7: [(0, 0.3333333), (1, 0.3333333), (2, 0.0)]}


@pytest.mark.parametrize("seed, k", [(4, 3), (5, 60)])
def test_overlap_equals_direct_scoring(spark, seed, k):
    kb, reports = corpus(seed)
    found = by_report(
        overlap_topk(frame(spark, reports, REPORT_SCHEMA), frame(spark, kb, KB_SCHEMA), k)
    )
    assert found == expected(reports, kb, overlap_scores, k)


@pytest.mark.parametrize("shard, queries", [(30, 3), (1 << 18, 1 << 12)])
def test_overlap_over_shards(spark, monkeypatch, shard, queries):
    monkeypatch.setattr(shards, "POSTINGS_PER_SHARD", shard)
    monkeypatch.setattr(shards, "QUERIES_PER_BLOCK", queries)
    kb, reports = corpus(16, 90)
    found = by_report(overlap_topk(frame(spark, reports, REPORT_SCHEMA), frame(spark, kb, KB_SCHEMA), 2))
    assert found == expected(reports, kb, overlap_scores, 2)


def test_a_token_of_every_case_makes_no_hot_shard(spark, monkeypatch):
    """With merge joins: every case and every report holds the same tokens."""
    monkeypatch.setattr(shards, "POSTINGS_PER_SHARD", 100)
    kb = [case(i, f"error of all cases n{i}") for i in range(600)]
    reports = [report(i, f"error of all cases n{i * 7}") for i in range(40)]
    sizes = []

    def counted(queries, postings, key, scorer, result):
        def sized(a, b):
            out = scorer(a, b)
            return pa.table({"n": [b.num_rows], "out": [out.num_rows]})

        sizes.extend(visit_shards(queries, postings, key, sized, "n long, out long").collect())
        return visit_shards(queries, postings, key, scorer, result)

    monkeypatch.setattr("caseweave.operators.overlap.visit_shards", counted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = by_report(overlap_topk(frame(spark, reports, REPORT_SCHEMA), frame(spark, kb, KB_SCHEMA)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == expected(reports, kb, overlap_scores, 3)
    assert len(sizes) > 20 and max(r.n for r in sizes) < 4 * 100
    assert all(r.out == 40 * 3 for r in sizes if r.n > 40)


def vector_fixture(seed, size=120):
    rng = random.Random(seed)
    kb, reports = corpus(seed, size)
    kb_vectors = {c["kb_id"]: [rng.gauss(0, 1) for _ in range(8)] for c in kb}
    for i in rng.sample(range(size), size // 3):
        kb_vectors[i] = [1.0, 2.0, 0.0, 0.0, -1.0, 0.0, 0.5, 3.0]  # copies
    kb_vectors[3] = [0.0] * 8
    asked = {r["report_id"]: [rng.gauss(0, 1) for _ in range(8)] for r in reports}
    asked[0] = [0.0] * 8
    asked[1] = [-1.0, -2.0, 0.0, 0.0, 1.0, 0.0, -0.5, -3.0]
    return kb, reports, kb_vectors, asked


def vector_frames(spark, kb_vectors, asked):
    return (
        spark.createDataFrame(list(asked.items()), VECTORS).withColumnRenamed("id", "report_id"),
        spark.createDataFrame(list(kb_vectors.items()), VECTORS).withColumnRenamed("id", "kb_id"),
    )


@pytest.mark.parametrize("k", [3, 90])
def test_vectors_equal_direct_scoring(spark, k, monkeypatch):
    # small blocks, so that cells are cut on both sides
    for name, rows in (("BLOCK_BYTES", 7), ("ASK_BYTES", 5), ("PRODUCT_BYTES", 12)):
        monkeypatch.setattr(f"caseweave.operators.vectors.{name}", rows * 8 * 8)
    kb, reports, kb_vectors, asked = vector_fixture(6)
    found = by_report(
        embedding_topk(
            frame(spark, reports, REPORT_SCHEMA),
            frame(spark, kb, KB_SCHEMA),
            *vector_frames(spark, kb_vectors, asked),
            k,
        )
    )
    wanted = expected(
        reports, kb, lambda r, cases: vector_scores(asked[r["report_id"]], cases, kb_vectors), k
    )
    assert found == wanted


def test_unanswered_reports_are_listed(spark):
    kb = [case(i, "x", "a" if i < 4 else "b") for i in range(8)]
    kb_vectors = {i: [1.0, float(i)] for i in range(4)} | {4: None, 5: [1.0, None], 6: []}
    asked = {0: [1.0, 2.0], 1: None, 2: [1.0], 3: [1.0, float("nan")], 4: [0.0, 0.0], 5: [1.0, 1.0]}
    reports = [report(i, "x", "b" if i == 5 else "a") for i in range(7)]
    answers = embedding_answers(
        frame(spark, reports, REPORT_SCHEMA), frame(spark, kb, KB_SCHEMA), *vector_frames(spark, kb_vectors, asked), 2
    )
    assert by_report(answers.matches) == {0: [(2, 1.0), (3, 0.9899495)], 4: [(0, 0.0), (1, 0.0)]}
    found = {r.report_id: r.reason for r in answers.unanswered.collect()}
    assert found == {1: NO_VECTOR, 2: BAD_VECTOR, 3: BAD_VECTOR, 5: NO_CANDIDATE, 6: NO_VECTOR}


def test_no_case_has_a_vector(spark):
    vectors = vector_frames(spark, {0: None}, {0: [1.0, 2.0], 1: None})
    reports = frame(spark, [report(0, "x"), report(1, "x")], REPORT_SCHEMA)
    answers = embedding_answers(reports, frame(spark, [case(0, "x")], KB_SCHEMA), *vectors)
    assert answers.matches.count() == 0
    assert {r.report_id: r.reason for r in answers.unanswered.collect()} == {0: NO_CANDIDATE, 1: NO_VECTOR}


def test_case_vectors_of_different_dimensions_fail(spark):
    vectors = vector_frames(spark, {0: [1.0], 1: [1.0, 2.0]}, {0: [1.0]})
    kb = frame(spark, [case(0, "x"), case(1, "x")], KB_SCHEMA)
    with pytest.raises(ValueError, match="dimensions from 1 to 2"):
        embedding_topk(frame(spark, [report(0, "x")], REPORT_SCHEMA), kb, *vectors)


def test_cases_are_stored_once_whatever_the_environments(spark, monkeypatch):
    kb, reports, kb_vectors, asked = vector_fixture(15, 60)
    stored = {}

    def counted(df, name):
        out = written(df, name)
        if name == "blocks":
            stored.setdefault(len(stored), out.filter("kb_id is not null").count())
        return out

    monkeypatch.setattr("caseweave.operators.vectors.written", counted)
    kb_df, vectors = frame(spark, kb, KB_SCHEMA), vector_frames(spark, kb_vectors, asked)
    embedding_topk(frame(spark, reports[:3], REPORT_SCHEMA), kb_df, *vectors).collect()
    embedding_topk(frame(spark, reports, REPORT_SCHEMA), kb_df, *vectors).collect()
    assert stored == {0: 60, 1: 60}


@pytest.mark.parametrize("many", [0.0, 1 / 8, 1.0])
def test_a_floor_keeps_scores_that_single_precision_confuses(monkeypatch, many):
    """Scores a few billionths apart, and copies, which are told apart by their id."""
    for name, value in (("MANY", many), ("TILE_BYTES", 8 * 200), ("FOUND", 20)):
        monkeypatch.setattr(f"caseweave.operators.vectors.{name}", value)
    rng = np.random.default_rng(5)
    asked = rng.normal(size=(9, 16))
    near = (asked[:, None] + 1e-4 * rng.normal(size=(9, 30, 16))).reshape(-1, 16)
    cases = np.concatenate([near, near[::7], near[::7], rng.normal(size=(80, 16))])
    asked, cases = (x / np.sqrt((x * x).sum(axis=1))[:, None] for x in (asked, cases))
    cases = cases[rng.permutation(len(cases))]
    ids = np.concatenate([np.sort(x) for x in np.array_split(rng.permutation(len(cases)), 7)])
    scores = np.round(asked @ cases.T, 9)
    wanted = [np.lexsort((ids, -x))[:3].tolist() for x in scores]
    floor = np.sort(scores[:, :60], axis=1)[:, -3]
    floor[0] = -np.inf
    search = _Search(asked, floor, cases, ids, 3)
    for cell in np.array_split(np.arange(len(cases)), 7):
        search.visit(np.arange(9), cell[::2])
        search.visit(np.arange(9), cell[1::2])
    row, column, score = search.best()
    assert row.tolist() == [i for i in range(9) for _ in range(3)]
    assert column.reshape(9, 3).tolist() == wanted
    assert score.tolist() == [scores[i, j] for i, j in zip(row, column)]


def test_cells_fill_blocks():
    cells = packed_cells(np.zeros((5, 2)), {0: 3, 1: 25, 2: 4, 3: 6, 5: 1}, 10)
    assert cells.first.tolist() == [0, 1, 4, 4, 4, 5] and cells.parts.tolist() == [1, 3, 1, 1, 1, 1]


def test_retrieve_routes_by_method(spark):
    kb, reports, kb_vectors, asked = vector_fixture(7, 40)
    methods = ["tfidf", "EMBEDDINGS", "nonsense", None]
    for i, row in enumerate(reports):
        row["retrieval_method"] = methods[i % 4]
    report_df, kb_df = frame(spark, reports, REPORT_SCHEMA), frame(spark, kb, KB_SCHEMA)
    found = by_report(retrieve(report_df, kb_df, 3, *vector_frames(spark, kb_vectors, asked)))
    by_vector = [r for r in reports if r["retrieval_method"] == "EMBEDDINGS"]
    by_terms = [r for r in reports if r["retrieval_method"] != "EMBEDDINGS"]
    wanted = expected(by_terms, kb, tfidf_scores, 3) | expected(
        by_vector, kb, lambda r, cases: vector_scores(asked[r["report_id"]], cases, kb_vectors), 3
    )
    assert found == wanted


def test_embeddings_without_vectors_fail(spark):
    reports = frame(spark, [report(1, "x", method="Embeddings")], REPORT_SCHEMA)
    kb = frame(spark, [case(1, "x")], KB_SCHEMA)
    with pytest.raises(PySparkException, match="needs vector tables"):
        retrieve(reports, kb).collect()


def test_top_k_must_be_positive(spark):
    with pytest.raises(ValueError):
        tfidf_topk(None, None, 0)


def test_candidate_filter_is_literal_and_complete(spark):
    kb, reports = corpus(8, 60)
    found = {}
    df = candidate_filter(frame(spark, reports, REPORT_SCHEMA), frame(spark, kb, KB_SCHEMA))
    for row in df.collect():
        found.setdefault(row.candidate_group, []).append(row.kb_id)
    wanted = {}
    for row in reports:
        name = (row["environment"] or "").strip().lower()
        chosen = sorted(c["kb_id"] for c in candidates(row, kb))
        wanted["" if len(chosen) == len(kb) else name] = chosen
    assert {g: sorted(ids) for g, ids in found.items()} == wanted


def test_term_stats_count_the_report(spark):
    kb = [case(0, "disk full"), case(1, "disk broken")]
    rows = term_stats(
        frame(spark, [report(5, "disk disk gone")], REPORT_SCHEMA), frame(spark, kb, KB_SCHEMA)
    ).collect()
    stats = {r.term: (r.tf, r.df, r.documents) for r in rows}
    assert stats["disk"] == (2, 3, 3)
    assert stats["gone"] == (1, 1, 3)
    assert abs(sum(r.weight**2 for r in rows) - 1) < 1e-6


def test_plans_have_no_nested_loops(spark, monkeypatch):
    kb, reports, kb_vectors, asked = vector_fixture(9, 30)
    report_df, kb_df = frame(spark, reports, REPORT_SCHEMA), frame(spark, kb, KB_SCHEMA)
    plans = []

    def record(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())

    def recorded(df, name):
        record(df)
        return written(df, name)

    for module in ["terms", "tfidf", "shards", "overlap", "vectors"]:
        monkeypatch.setattr(f"caseweave.operators.{module}.written", recorded)
    record(candidate_filter(report_df, kb_df))
    record(tfidf_topk(report_df, kb_df))
    record(overlap_topk(report_df, kb_df))
    record(embedding_topk(report_df, kb_df, *vector_frames(spark, kb_vectors, asked)))
    assert len(plans) > 20
    products = 0
    for plan in plans:
        assert "CartesianProduct" not in plan
        # the one product allowed: facets with the single row of the whole knowledge base
        loops = [line for line in plan.splitlines() if "NestedLoop" in line]
        assert all("BuildRight, Cross" in line for line in loops)
        products += len(loops)
    assert products <= 4
    assert "WindowGroupLimit" in plans[-1]


def test_unused_columns_are_not_read(spark, tmp_path):
    kb, reports = corpus(10, 20)
    frame(spark, kb, KB_SCHEMA).write.parquet(str(tmp_path / "kb"))
    stored = spark.read.parquet(str(tmp_path / "kb"))
    df = candidate_filter(frame(spark, reports, REPORT_SCHEMA), stored)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "root_cause" not in plan


def plain_join(index, keyed, members, top_k):
    """Every pair of a report and a case that share a term, from the same stored entries."""
    statistics = tfidf.group_statistics(index, members)
    weighted = tfidf.query_terms(
        tfidf.distinct_queries(keyed), statistics.frequencies, statistics.sizes, english_stop_words()
    )
    asked = tfidf.query_entries(weighted)
    mine = asked.select("query_key", "candidate_group", "term", F.col("tf").alias("q"), "idf1", F.col("norm2").alias("q2"))
    grown = F.max("norm2") + F.sum(F.col("tf") * F.col("tf") * (F.col("idf1") ** 2 - F.col("idf0") ** 2))
    return (
        tfidf.case_postings(index, asked, members, statistics.norms)
        .join(mine, ["candidate_group", "term"])
        .groupBy("query_key", "class_id")
        .agg(F.sum(F.col("q") * F.col("tf") * F.col("idf1") ** 2).alias("dot"), (grown * F.max("q2")).alias("n2"))
        .select("query_key", "class_id", F.round(F.col("dot") / F.sqrt("n2"), 9).alias("score"))
    )


@pytest.mark.parametrize("shard, queries, block", [(40, 3, 2), (1 << 18, 1 << 12, 4), (100, 5, 1)])
def test_skipped_blocks_lose_nothing(spark, monkeypatch, shard, queries, block):
    monkeypatch.setattr(shards, "POSTINGS_PER_SHARD", shard)
    monkeypatch.setattr(shards, "QUERIES_PER_BLOCK", queries)
    monkeypatch.setattr(tfidf, "BLOCK", block)
    kb, reports = corpus(12, 120)
    kb_df, report_df = frame(spark, kb, KB_SCHEMA), frame(spark, reports, REPORT_SCHEMA)
    found = by_report(tfidf_topk(report_df, kb_df, 4))
    assert found == expected(reports, kb, tfidf_scores, 4)
    index = tfidf.case_index(kb_df)
    keyed, members = asked_groups(report_df, index.facets)
    classes = tfidf.distinct_cases(index)
    winners = best(plain_join(index, keyed, members, 4), "query_key", "class_id", 4).drop("rank")
    scored = with_copies(winners, classes, index.profiles, 4)
    joined = ranked_reports(keyed, scored, first_candidates(index.profiles, members, 4), 4)
    assert by_report(joined) == found


def test_equal_parts():
    for seed in range(50):
        rng = np.random.default_rng(seed)
        reach, total = rng.random(6), rng.random() * 3
        part = tfidf._equal_parts(reach, total)
        if reach.sum() <= total:
            assert np.isinf(part).all()
        else:
            assert abs(np.minimum(reach, part).sum() - total) < 1e-9


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_updated_index_is_a_rebuilt_one(spark):
    kb, reports = corpus(13, 90)
    before, after = kb[:60], kb[25:]
    changed = {**after[3], "error": "a term that is new", "platform": "elsewhere"}
    after = [changed, *after[:3], *after[4:]]
    old = tfidf.case_index(frame(spark, before, KB_SCHEMA))
    ids = lambda rows: {c["kb_id"] for c in rows}
    added = [c for c in after if c["kb_id"] not in ids(before)] + [changed]
    gone = spark.createDataFrame([(i,) for i in ids(before) - ids(after)] + [(10**6,)], "kb_id long")
    new = tfidf.updated_index(old, frame(spark, added, KB_SCHEMA), gone)
    whole = tfidf.case_index(frame(spark, after, KB_SCHEMA))
    for name, a, b in zip(whole._fields, new, whole):
        if name == "profiles":
            a, b = (x.withColumn("bag", F.array_sort("bag")) for x in (a, b))
        assert rows_of(a.select(*b.columns)) == rows_of(b), name
    asked = frame(spark, reports, REPORT_SCHEMA)
    assert by_report(tfidf_topk(asked, None, index=new)) == expected(reports, after, tfidf_scores, 3)


def test_known_groups_are_not_computed_again(spark):
    kb, reports = corpus(14, 60)
    index = tfidf.case_index(frame(spark, kb, KB_SCHEMA))
    first, second = frame(spark, reports[:20], REPORT_SCHEMA), frame(spark, reports, REPORT_SCHEMA)
    known = tfidf.group_statistics(index, asked_groups(first, index.facets).members)
    asked = asked_groups(second, index.facets)
    both, alone = tfidf.group_statistics(index, asked.members, known), tfidf.group_statistics(index, asked.members)
    for a, b in zip(both, alone):
        rounded = [F.round(x, 9).alias(x) if x == "norm2" else x for x in b.columns]
        assert rows_of(a.select(rounded)) == rows_of(b.select(rounded))
    assert by_report(tfidf_topk(None, None, index=index, asked=asked, known=known)) == expected(
        reports, kb, tfidf_scores, 3
    )


def test_equal_sets_of_facets_are_one_group(spark):
    kb = [case(i, f"disk {i}", "Azure Synapse" if i % 2 else "Local", "lab") for i in range(12)]
    reports = [report(0, "disk", "azure"), report(1, "disk", "Synapse"), report(2, "disk", "lab"), report(3, "disk", "local")]
    index = tfidf.case_index(frame(spark, kb, KB_SCHEMA))
    keyed, members = asked_groups(frame(spark, reports, REPORT_SCHEMA), index.facets)
    group = {r.report_id: r.candidate_group for r in keyed.collect()}
    assert group[0] == group[1] != group[3] and group[2] == ""
    statistics = tfidf.group_statistics(index, members)
    assert {r.candidate_group: r.candidates for r in statistics.sizes.collect()} == {group[0]: 6, "": 12, group[3]: 6}
    assert by_report(tfidf_topk(None, None, index=index, asked=(keyed, members))) == expected(reports, kb, tfidf_scores, 3)


def test_a_shard_of_cases_is_one_row(spark, monkeypatch):
    """Norms by the plain join; an entry with a large count, and rows that repeat a kb_id."""
    monkeypatch.setattr(shards, "POSTINGS_PER_SHARD", 60)
    kb, reports = corpus(18, 70)
    kb += [case(500, "alpha " * 300), case(501, "gamma"), case(501, "gamma")]
    index = tfidf.case_index(frame(spark, kb, KB_SCHEMA))
    members = asked_groups(frame(spark, reports, REPORT_SCHEMA), index.facets).members
    statistics = tfidf.group_statistics(index, members)
    rows = statistics.shards.collect()
    assert len({(r.candidate_group, r.shard) for r in rows}) == len(rows) > members.select("candidate_group").distinct().count()
    weights = statistics.frequencies.join(statistics.sizes, "candidate_group")
    plain = (
        tfidf.bag_entries(tfidf.distinct_cases(index), "facet_id", "class_id")
        .join(members, "facet_id")
        .join(weights, ["term", "candidate_group"])
        .withColumn("weight", F.col("tf") * tfidf.idf(F.col("candidates"), F.col("df")))
        .groupBy("candidate_group", "class_id")
        .agg(F.sum(F.col("weight") ** 2).alias("norm2"))
    )
    rounded = ["candidate_group", "class_id", F.round("norm2", 6).alias("norm2")]
    assert rows_of(statistics.norms.select(*rounded)) == rows_of(plain.select(*rounded))


def test_large_groups_are_packed_at_once():
    """A case is one row for all large groups; each of them gets the entries of its cases."""
    rows = {
        "pack": ["*0"] * 4,
        "shard": [2] * 4,
        "groups": [["", "A"], [""], ["", "A"], ["", "A"]],
        "class_id": [9, 4, 7, 7],
        "terms": ["alpha beta", "beta delta", "alpha", "alpha"],
        "tfs": [[1, 300], [2, 1], [3], [4]],
    }
    found = tfidf._packed(pa.table(rows))
    entries = {}
    for i, row in enumerate(found.to_pylist()):
        names, counts, case, tf = tfidf._entries(found.slice(i, 1))
        term = np.repeat(names.to_numpy(zero_copy_only=False), counts)
        entries[row["candidate_group"]] = [(t, row["classes"][c], int(n)) for t, c, n in zip(term, case, tf)]
    some = [("alpha", 7, 3), ("alpha", 7, 4), ("alpha", 9, 1)]
    assert entries == {
        "": [*some, ("beta", 4, 2), ("beta", 9, 300), ("delta", 4, 1)],
        "A": [*some, ("beta", 9, 300)],
    }
