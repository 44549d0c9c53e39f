"""Benchmark decontamination with DataFrame functions only.

A benchmark item gives windows of ten consecutive words (one window of all its words if it has
fewer). The distinct windows are the hash set: a bitmap of their 64-bit hashes, which a scalar
subquery hands to every task, and a table of the windows themselves. Documents are scanned
once: the hashes of their windows are looked up in the bitmap within the row, and only the
places that pass leave it, as text, to be joined with the windows by equality of the words. So
every hit is verified, and whole texts are not shuffled. The bitmap has 64 bits for each
window, up to ``MOST_BITS`` (1 MB); with more windows more places pass, with the same result.
The table is broadcast only up to ``BROADCAST_WINDOWS`` windows; beyond that the planner joins
it by shuffles.

Defined results: null and empty texts have no words and no hits; an item without words has no
window; rows of the benchmark with the same item_id are one item; words of an item without
item_id are hits, but there is no item to count. Rows of documents that repeat a doc_id, or
have none, each get a row. Columns of documents other than doc_id and text are not read by
``contamination`` and pass through the two functions that remove.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import ascii_lower, free_name, table, without_rows

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: Separators in a text that is not lower-cased.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORDS = 10
MOST_BITS = 1 << 23
BROADCAST_WINDOWS = 100_000


def words(text: Column) -> Column:
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS + "+")
    return F.array_remove(parts, "")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(window, n, items): distinct windows, their number of words, the ids of their items."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (WORDS - 1), F.lit(1)))
    windows = F.transform(starts, lambda i: F.slice("w", i, WORDS))
    windows = items.select("item_id", F.explode(windows).alias("w"))
    windows = windows.select(
        "item_id", F.array_join("w", " ").alias("window"), F.size("w").alias("n")
    )
    return windows.groupBy("window", "n").agg(F.collect_set("item_id").alias("items"))


def bitmap(windows: DataFrame, bits: int) -> DataFrame:
    """One row: ``bits`` bits as an array of longs, set where a window hashes to."""
    place = F.xxhash64(F.split("window", " ")).bitwiseAND(F.lit(bits - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    cells = windows.select(F.shiftright(place, 6).alias("cell"), one.alias("mask"))
    empty = windows.sparkSession.range(bits // 64)
    empty = empty.select(F.col("id").alias("cell"), F.lit(0).cast("long").alias("mask"))
    cells = cells.unionByName(empty).groupBy("cell").agg(F.bit_or("mask").alias("mask"))
    return cells.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("cell", "mask"))), lambda x: x["mask"])
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, items, hits) for each row of ``docs``.

    ``hits`` holds (at, n): a window of n words begins at word ``at``, counted from one.
    """
    windows = benchmark_windows(benchmark)
    counted = windows.groupBy("n").count().collect()  # a row for each length, ten at most
    n_windows = sum(row["count"] for row in counted)
    bits = min(MOST_BITS, 1 << max(10, (64 * n_windows).bit_length()))
    bits_of_windows = bitmap(windows, bits).scalar()

    def places(n: int) -> Column:
        def passes(i: Column) -> Column:
            place = F.xxhash64(F.slice("w", i, n)).bitwiseAND(F.lit(bits - 1))
            cell = F.get("cells", F.shiftright(place, 6).cast("int"))
            return F.getbit(cell, place.bitwiseAND(63).cast("int")) == 1

        starts = F.when(F.size("w") >= n, F.sequence(F.lit(1), F.size("w") - (n - 1)))
        starts = F.coalesce(starts, F.array().cast("array<int>"))
        return F.transform(
            F.filter(starts, passes),
            lambda i: F.struct(
                i.alias("at"), F.lit(n).alias("n"), F.array_join(F.slice("w", i, n), " ").alias("window")
            ),
        )

    scanned = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.monotonically_increasing_id().alias("row"),
        words(F.col("text")).alias("w"),
        bits_of_windows.alias("cells"),
    )
    # The row itself is an entry too; its key is no window and spreads rows without a hit.
    own = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("n"), F.concat(F.lit(" "), "row").alias("window")
    )
    found = scanned.select(
        "doc_id",
        "text_hash",
        "row",
        F.size("w").cast("long").alias("n_words"),
        F.explode(F.concat(F.array(own), *[places(row["n"]) for row in counted])).alias("p"),
    ).select("doc_id", "text_hash", "row", "n_words", "p.*")
    known = windows.select("window", "items")
    found = found.join(F.broadcast(known) if n_windows <= BROADCAST_WINDOWS else known, "window", "left")
    hit = F.when(F.col("items").isNotNull(), F.struct("at", "n"))
    found = found.groupBy("row", "doc_id", "text_hash", "n_words").agg(
        F.array_sort(F.collect_list(hit)).alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("after")),
        lambda s, x: F.struct(
            (s["words"] + F.greatest(F.lit(0), x["at"] + x["n"] - F.greatest(s["after"], x["at"]))).alias("words"),
            F.greatest(s["after"], x["at"] + x["n"]).alias("after"),
        ),
        lambda s: s["words"],
    )
    return found.select("doc_id", "text_hash", "n_words", covered.alias("n_hit"), "items", "hits")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    return without_rows(docs, contamination(docs, benchmark).where("n_hit > 0"))


def without_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the hit words, and the separators after them, cut out of the texts."""
    key, at = free_name(docs, "text_hash"), free_name(docs, "hits")
    names = [free_name(docs, "found_id"), free_name(docs, "found_hash")]
    found = contamination(docs, benchmark).where("n_hit > 0").select(
        F.col("doc_id").alias(names[0]), F.col("text_hash").alias(names[1]), F.col("hits").alias(at)
    )
    marked = docs.withColumn(key, F.xxhash64("text"))
    same = marked["doc_id"].eqNullSafe(found[names[0]]) & (marked[key] == found[names[1]])
    joined = marked.join(found.dropDuplicates(names), same, "left")
    pieces = F.regexp_extract_all("text", F.lit(f"(^{GAPS}+|[^{GAPS[1:]}+{GAPS}*)"), F.lit(1))
    lead = F.regexp_extract("text", f"^{GAPS}+", 0)
    skip = F.when(lead == "", 0).otherwise(1)  # words are counted from one
    kept = F.filter(
        pieces,
        lambda _, i: ~F.exists(
            F.col(at), lambda x: (i + 1 - skip >= x["at"]) & (i + 1 - skip < x["at"] + x["n"])
        ),
    )
    text = F.when(F.col(at).isNull(), F.col("text")).otherwise(F.array_join(kept, ""))
    return joined.withColumn("text", text).select(*docs.columns)


def op1_decontaminate(spark, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP1_SQL = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), starts AS (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0
), grams AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS g, least(len(w), 10) AS n FROM starts
), lengths AS (
  SELECT DISTINCT n FROM grams
), places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM split, lengths WHERE len(w) >= n
), hit AS (
  SELECT doc_id, i, p.n, item_id FROM places p JOIN grams
    ON g = array_to_string(w[i:i + p.n - 1], ' ') AND grams.n = p.n
), hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit)
  GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM split LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
