import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as registered
from checks import adapters
from checks.compare import compare, database

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def own(names):
    """Without the queries that the optional subpackage adds, which has tests of its own."""
    return {x for x in names if x != "pipeline" and not re.match(r"op\d+_", x)}


def test_every_query_has_sql():
    assert own(registered.queries()) == own(registered.oracle_sql())


@needs_data
@pytest.mark.parametrize("name", sorted(own(registered.queries())))
def test_query_equals_sql(spark, name):
    same, detail = compare(spark, FOLDER, name)
    assert same, detail


VECTOR_IDS = [*range(1, 46), 61, 80, 1007]


def vector_table(folder):
    """Two labels, and ids of which few are divisible by 20."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(len(VECTOR_IDS), 6)).astype(np.float32).tolist()
    labels = [i % 2 for i in VECTOR_IDS]
    columns = {
        "vec_id": pa.array(VECTOR_IDS, pa.int64()),
        "embedding": pa.array(vectors, pa.list_(pa.float32())),
        "label": pa.array(labels, pa.int32()),
    }
    pq.write_table(pa.table(columns), f"{folder}/embeddings.parquet")
    return str(folder)


def test_vector_queries_ask_with_every_row(spark, tmp_path):
    folder = vector_table(tmp_path)
    for asks in (adapters.vector_reports, adapters.report_vectors):
        assert sorted(r.report_id for r in asks(spark, folder).collect()) == VECTOR_IDS
    assert sorted(r.kb_id for r in adapters.kb_vectors(spark, folder).collect()) == VECTOR_IDS
    found = registered.by_vector(spark, folder).collect()
    assert sorted((r.report_id, r.rank) for r in found) == [(i, k) for i in VECTOR_IDS for k in (1, 2, 3)]


def test_vector_sql_asks_with_every_row(spark, tmp_path):
    folder = vector_table(tmp_path)
    rows = database(folder).execute(registered.oracle_sql()["embedding_topk"]).fetchall()
    assert sorted((report, rank) for report, rank, *_ in rows) == [(i, k) for i in VECTOR_IDS for k in (1, 2, 3)]
    same, detail = compare(spark, folder, "embedding_topk")
    assert same, detail
