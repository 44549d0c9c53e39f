"""The pipeline's stages on a given table, with cases put into it."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseweave.llm import registered, simhash
from caseweave.llm.common import table
from caseweave.workspace import written
from tests.llm import plain

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def planted(spark):
    random.seed(9)
    docs = table(spark, FOLDER, "documents")
    toxic = docs.join(table(spark, FOLDER, "labels").where("toxic = 1"), "doc_id").select(docs.columns)
    clean = [" ".join(random.choice("abcdefgh") + str(random.randrange(3000)) for _ in range(80)) for _ in range(12)]
    copy = clean[0]
    near = " ".join(w if i != 40 else "changed" for i, w in enumerate(clean[1].split()))
    leak = clean[2] + " " + table(spark, FOLDER, "benchmark").first().text
    rows = [(10_000 + i, x) for i, x in enumerate([*clean, copy, near, leak])]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    more = more.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("new").alias("source"), F.length("text").cast("long").alias("n_chars"))
    return written(docs.unionByName(more), "documents"), {r.doc_id for r in toxic.collect()}


def test_stages(spark, planted):
    docs, toxic = planted
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    seen = [ids(docs)]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, FOLDER), "stage")
        seen.append(ids(docs))
        assert seen[-1] <= seen[-2] and docs.count() == len(seen[-1])
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.dtypes == before.dtypes
            assert docs.join(before, docs.columns, "left_anti").count() == 0
    after_toxicity, after_copies, after_leaks, mixed, files = seen[1:]
    assert len(after_toxicity & toxic) < 0.4 * len(toxic)
    # all documents that were put in stay, but for the copies and the leak
    assert set(range(10_000, 10_015)) <= after_toxicity
    assert set(range(10_000, 10_012)) <= after_copies
    # the stage's contract: fingerprints of three words, two bits
    texts = {r.doc_id: r.text for r in planted[0].where("doc_id in (10001, 10013)").collect()}
    apart = (plain.fingerprint(texts[10_001]) ^ plain.fingerprint(texts[10_013])).bit_count()
    assert 10_012 not in after_copies
    assert (10_013 in after_copies) == (apart > simhash.MAX_BITS)
    assert 10_014 in after_copies and 10_014 not in after_leaks
    assert set(range(10_000, 10_012)) <= mixed
    assert files == mixed and len(mixed) < len(after_leaks)
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens


def test_empty_documents(spark):
    docs = table(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), "stage")
        assert docs.count() == 0


def test_run_is_the_stages(spark):
    folder = "/root/testdata/sf0.001"
    result = corpus_pipeline.run(spark, folder)
    docs = table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), "stage")
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_query_equals_sql(spark, name):
    from checks.compare import compare

    same, detail = compare(spark, FOLDER, name)
    assert same, detail


def test_queries_give_the_contracts_columns(spark):
    columns = {
        1: "doc_id n_words n_hit n_items items_sha256 contaminated",
        2: "doc_id n_bytes n_tokens over_limit",
        3: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        5: "doc_id n_words n_removed kept_sha256",
        6: "doc_id n_lines n_dropped kept_sha256",
        8: "doc_id fingerprint component_id",
        9: "doc_id start n_tokens ids_crc32",
        10: "page_id payload_bytes payload_digest record_type refers_to",
        11: "lang source part item value rank",
        12: "doc_id held_out lang_pred score",
        13: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
    }
    found = {int(name[2:].split("_")[0]): f for name, f in registered.queries().items()}
    assert sorted(found) == list(range(1, 14))
    for n, f in found.items():
        df = f(spark, "/root/testdata/sf0.001")
        assert set(columns.get(n, "").split()) <= set(df.columns)
        if n != 11:
            assert df.count() == table(spark, "/root/testdata/sf0.001", "pages" if n == 10 else "documents").count()
