"""What several operators share: input columns, words, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.workspace import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns an operator reads; a null text counts as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def id_and_bytes(docs: DataFrame) -> DataFrame:
    return id_and_text(docs).withColumn("text", F.col("text").cast("binary"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; whole ASCII texts take the short way."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose doc_id and text are those of ``gone`` (doc_id, text_hash)."""
    key = free_name(docs, "text_hash")
    names = [free_name(docs, "gone_id"), free_name(docs, "gone_hash")]
    gone = gone.select(F.col("doc_id").alias(names[0]), F.col("text_hash").alias(names[1])).distinct()
    marked = docs.withColumn(key, F.xxhash64("text"))
    same = marked["doc_id"].eqNullSafe(gone[names[0]]) & (marked[key] == gone[names[1]])
    return marked.join(gone, same, "left_anti").select(*docs.columns)


def smaller_neighbours(edges: DataFrame) -> DataFrame:
    """One round of large-star and small-star over edges (a > b), without repeats.

    Minima are aggregated before the shuffle and joined back, so the neighbours of a node
    never have to meet in one task.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    larger = larger.where("a <> b").distinct()
    lowest = larger.groupBy("a").agg(F.min("b").alias("m"))
    hung = larger.join(lowest, "a")
    return (
        hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(lowest.select("a", F.col("m").alias("b")))
        .where("a <> b")
        .distinct()
    )


def component_roots(edges: DataFrame) -> DataFrame:
    """(a, root): every node of ``edges`` (a, b) with the smallest node it is connected to.

    The stars are alternated until the edges stay as they are. Each round is written to the
    shared folder, which cuts the lineage; only a count and a checksum reach the driver.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.where("a <> b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        edges = written(smaller_neighbours(edges), "edges")
    roots = edges.select("a", F.col("b").alias("root"))
    own = roots.select(F.col("root").alias("a"), "root").distinct()
    return roots.unionByName(own)
