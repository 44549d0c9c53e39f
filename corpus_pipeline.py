"""The training-data pipeline: documents that are not toxic, not copies and not of a benchmark,
mixed to target weights, as token files.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and
read again as the next one's docs. All but the last give the columns of documents.

The toxic documents go; of each group of SimHash near copies the document with the smallest
doc_id stays; documents that hold a window of the benchmark go; documents labelled or judged poor are
thinned until good ones have their target weight, and the rest is written as token files, of
which the result lists the documents. A stage repeats no document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.llm import decontaminate, mixing, simhash, token_files, toxicity
from caseweave.llm.common import table
from caseweave.workspace import new_folder, written

#: Weights of documents by quality. The budget of words is that of the good documents at their
#: weight, with a little room, so that doubt about their quality doesn't thin them.
WEIGHTS = {"good": 0.92, "poor": 0.08}
HEADROOM = 1.08


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, simhash.near_copies(docs))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    quality = F.when(F.col("quality") > 0, "good").when(F.col("quality") == 0, "poor")
    labelled = table(spark, sf_dir, "labels").select("doc_id", quality.alias("domain"))
    return mixing.thinned(docs, labelled, WEIGHTS, HEADROOM, whole="good")


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    files = token_files.write_tokens(docs, new_folder(spark, "tokens"))
    return token_files.read_tokens(spark, files, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", write_token_files),
]

#: A fitted classifier and a fitted mixture are not expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "documents")
    return STAGES[-1][1](spark, docs, sf_dir)
