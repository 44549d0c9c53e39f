"""Lines that several documents share are kept in one of them.

Lines are exploded with their places and reduced to 128 bits of hash of their normalised form;
documents are counted once for each hash before the counts meet, so a line that most documents
hold is no hot key there. Lines of shared hashes come back as places to drop, joined by document
with the text, whose other lines are put together again in their order. Only ids, places and
hashes are shuffled besides the one join with the texts.

Defined results: a null or empty text is one empty line; lines whose key is shorter than
``MIN_CHARS`` code points always stay; rows that repeat a doc_id are one document, and each
gets a row; rows without doc_id count as one document that comes after all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import ascii_lower, id_and_text, table
from caseweave.workspace import written

BLANKS = " \t\n\x0b\f\r"
MIN_CHARS = 10
MIN_DOCS = 2


def key_of(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")


def keyed_lines(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, place, h1, h2) of every line that may be dropped."""
    lines = docs.select("doc", "text_hash", F.posexplode(split_lines(F.col("text"))).alias("place", "line"))
    lines = lines.select("doc", "text_hash", "place", key_of(F.col("line")).alias("key"))
    lines = lines.where(F.length("key") >= MIN_CHARS)
    return lines.select(
        "doc",
        "text_hash",
        "place",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
    )


def without_shared_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): lines in ``min_docs`` documents or more stay only in
    the one with the smallest doc_id."""
    last = F.lit((1 << 63) - 1)
    docs = id_and_text(docs).select(
        "doc_id", F.coalesce("doc_id", last).alias("doc"), F.xxhash64("text").alias("text_hash"), "text"
    )
    lines = keyed_lines(docs)
    shared = lines.select("h1", "h2", "doc").distinct().groupBy("h1", "h2")
    shared = shared.agg(F.count("*").alias("docs"), F.min("doc").alias("keeper"))
    # written, so that the planner can split a hash that many lines have
    shared = written(shared.where(F.col("docs") >= min_docs).drop("docs"), "shared_lines")
    dropped = lines.join(shared, ["h1", "h2"]).where("doc <> keeper")
    dropped = dropped.groupBy("doc", "text_hash").agg(F.collect_set("place").alias("dropped"))
    found = docs.join(dropped, ["doc", "text_hash"], "left").select(
        "doc_id",
        split_lines(F.col("text")).alias("lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    kept = F.transform(places, lambda i: F.get("lines", i))
    return found.select(
        "doc_id",
        F.array_join(kept, "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"),
    )


def op6_lines(spark, folder: str) -> DataFrame:
    kept = without_shared_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM line
), shared AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT doc_id, place, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
  FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
