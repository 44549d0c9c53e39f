"""Near copies by SimHash fingerprints, found through an inverted index of byte positions.

A fingerprint has eight bytes. Two fingerprints that differ in at most two bits share at least
``LEAST_SHARED`` = 6 of them in place. A posting of a single position and byte would list one
in 256 of all fingerprints, so postings are split by four more positions: of the four
neighbouring byte pairs two at least are equal, and a list has the fingerprints that agree in
these two pairs (six lists for each fingerprint). Within a list every fingerprint is posted
under each byte of its other four positions. The postings are tallied by pair, a pair that
meets fewer than two times there (six with the list's own four) goes, and the rest are verified
bit by bit.

Equal fingerprints are one entry of the index, so copies never meet in a list. A list of more
than ``LIST`` entries forms no pairs: entries of a list differ only in the 32 bits that its key
leaves open, so two of them are linked exactly if they share a value that is at most one bit
away from each. Every entry is listed under its 33 such values, which hold 33 entries at most.
That way finds the same links and grows in proportion to the entries.

Defined results: a null or empty text has no words and fingerprint zero, linked like any other.
Rows that repeat a doc_id each get a row. A component is named by its smallest doc_id; rows
without a doc_id take part and never name a component unless it holds nothing else (null).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseweave.llm.common import component_roots, free_name, id_and_text, table
from caseweave.workspace import written

SEED = 42
WORDS = 3
MAX_BITS = 2
LEAST_SHARED = 8 - MAX_BITS
#: Lists of more entries take the way without pairs.
LIST = 64
_PIECE = 1 << 18


def fingerprint(text: bytes) -> int:
    """Bits that are set in more than half of the shingle hashes, most significant first."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        starts, ends, line = [0], [None], b" ".join(words)
    else:
        line = b" ".join(words)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(stops[:-WORDS] + 1).tolist()]
        ends = stops[WORDS - 1 :].tolist()
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), _PIECE):
        shingles = [line[i:j] for i, j in zip(starts[at : at + _PIECE], ends[at : at + _PIECE])]
        digests = b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED)))
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(starts)).tobytes(), "big", signed=True)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(x.as_py()) for x in batch.column(2)]
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(prints, pa.int64())],
            names=["doc_id", "text_hash", "fp"],
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of every row."""
    texts = id_and_text(docs)
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary"))
    return texts.mapInArrow(_batches, "doc_id long, text_hash long, fp long")


def links(entries: DataFrame) -> DataFrame:
    """(a, b): distinct fingerprints ``fp`` linked so that components are those of all links."""
    pairs_of_bytes = [0xFFFF << (16 * k) for k in range(4)]
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    masks = [signed(x | y) for x, y in combinations(pairs_of_bytes, 2)]
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("place"), F.col("fp").bitwiseAND(F.lit(m)).alias("value"))
            for i, m in enumerate(masks)
        ]
    )
    index = entries.select("fp", F.explode(keys).alias("k")).select("k.place", "k.value", "fp")
    lengths = index.groupBy("place", "value").count().where("count > 1")
    listed = written(index.join(lengths, ["place", "value"]), "lists")

    # the four bytes of an entry that its list leaves open, with their positions
    free = [[k for k in range(8) if k // 2 not in own] for own in combinations(range(4), 2)]
    byte = lambda k: F.struct(
        F.lit(k).alias("at"), F.shiftrightunsigned("fp", 8 * k).bitwiseAND(F.lit(255)).alias("byte")
    )
    posted = F.element_at(F.array(*[F.array(*map(byte, x)) for x in free]), F.col("place") + 1)
    short = listed.where(F.col("count") <= LIST)
    short = short.select("place", "value", "fp", F.explode(posted).alias("p"))
    where = ["place", "value", "at", "byte"]
    a = short.select("place", "value", "p.at", "p.byte", F.col("fp").alias("a"))
    b = short.select("place", "value", "p.at", "p.byte", F.col("fp").alias("b"))
    tally = a.join(b, where).where("a > b").groupBy("place", "a", "b").agg(F.count("*").alias("met"))
    pairs = tally.where(F.col("met") + 4 >= LEAST_SHARED)
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)

    bits = F.array(*[F.lit(signed(1 << k)) for k in range(64)])
    fixed = F.element_at(F.array(*[F.lit(m) for m in masks]), F.col("place") + 1)
    open_bits = F.filter(bits, lambda x: x.bitwiseAND(fixed) == 0)
    near = F.concat(
        F.array("fp"), F.transform(open_bits, lambda x: F.col("fp").bitwiseXOR(x))
    )
    around = listed.where(F.col("count") > LIST).select("place", "fp", F.explode(near).alias("mid"))
    met = around.groupBy("place", "mid").agg(F.collect_list("fp").alias("members"))
    met = met.where(F.size("members") > 1).select(
        F.array_min("members").alias("b"), F.explode("members").alias("a")
    )
    return pairs.select("a", "b").unionByName(met.where("a > b").select("a", "b")).distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, component, component_id, component_size) of every row; component
    is one of its fingerprints."""
    prints = written(fingerprints(docs), "fingerprints")
    entries = prints.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    entries = written(entries, "entries")
    roots = written(component_roots(links(entries.select("fp"))), "roots")
    named = entries.join(roots.withColumnRenamed("a", "fp"), "fp", "left")
    named = named.withColumn("component", F.coalesce("root", "fp"))
    least = named.groupBy("component").agg(
        F.min("id").alias("component_id"), F.sum("n").alias("component_size")
    )
    named = named.select("fp", "component").join(least, "component")
    return prints.join(named, "fp").select(
        "doc_id", "text_hash", "fp", "component", "component_id", "component_size"
    )


def keep_one(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component of ``found`` (from ``near_copies``).

    That is the row with the smallest doc_id, rows without one last; of rows that share it, the
    first by hash of the text, then of the whole row. Rows that repeat a doc_id with texts of
    different components are all judged by their own component.
    """
    key = [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash"]
    first = F.min(F.struct(*key)).alias("first")
    stay = found.groupBy("component").agg(first).select("first.*").distinct()
    names = {x: free_name(docs, x) for x in ("no_id", "id", "text_hash", "rank")}
    doc_id = F.col("doc_id").cast("long")
    marked = docs.withColumns(
        {
            names["no_id"]: doc_id.isNull(),
            names["id"]: F.coalesce(doc_id, F.lit(0)),
            names["text_hash"]: F.xxhash64(F.coalesce("text", F.lit(""))),
        }
    )
    keys = [names[x] for x in ("no_id", "id", "text_hash")]
    rest = marked.join(stay.toDF(*keys), keys, "left_semi")
    same = Window.partitionBy(*keys).orderBy(F.xxhash64(*docs.columns))
    rest = rest.withColumn(names["rank"], F.row_number().over(same))
    return rest.where(F.col(names["rank"]) == 1).select(*docs.columns)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op8_simhash(spark, folder: str) -> DataFrame:
    found = near_copies(table(spark, folder, "documents"))
    return found.select(
        "doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id", "component_size"
    )
