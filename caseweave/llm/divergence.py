"""How far the sources of a language differ in their terms, by Gustavson's row accumulation.

A term is a run of ASCII letters and non-ASCII characters, A-Z lower-cased. Each language keeps
the ``V`` terms that at least ``LEAST_DOCS`` of its documents hold. A group is a (lang, source);
group or language, with ``N`` occurrences of kept terms, gives a kept term with ``count``
occurrences there ``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))``, and two of these differ by
``f(p, q) = floor((p - q)^2 / (p + q))``. All of it is whole numbers.

``pair`` rows compare a group with every other source of its language, summed over all kept
terms; ``term`` rows list the ``TOP`` terms in which a group exceeds its language most.

The counts are one aggregation of rows that tasks have added up before. The terms of a language
are then dealt by hash to shards of about ``SHARD`` postings, and a shard keeps its part of the
index term-major: for each term the groups that hold it. Within a shard each group in turn
scatters its terms through those postings into one dense accumulator with a place for every
peer, so pairs of postings are never written down. The postings hold counts over zero only;
every other term of the shard starts from a baseline of two zeros, and each side's own terms
move the baseline first: ``f(p, q) - f(p, zero) - f(zero, q) + f(zero, zero)`` is what a shared
term adds. A term has as many postings as there are groups, so no key is longer than the
accumulator.

Defined results: null text, lang and source count as ''. Rows that repeat a doc_id, or have
none, are documents of their own. A group without terms has N = 0; a language without kept terms
gives its pairs value 0. A language of one source has no pairs. Equal values rank by item, in
the order of its UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseweave.llm.common import table
from caseweave.llm.words import slices, words_of
from caseweave.workspace import written

LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
#: Postings of a shard, about.
SHARD = 500_000

#: ASCII letters in lower case, everything else of ASCII a space, other bytes as they are.
_TERM_BYTES = np.array(
    [b if b > 127 else (b | 32 if chr(b).isalpha() else 32) for b in range(256)], np.uint8
)


def _only_terms(texts: pa.StringArray) -> pa.StringArray:
    """The texts with every byte that belongs to no term blanked; lengths stay."""
    edges, data = texts.buffers()[1:]
    plain = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    blanked = pa.py_buffer(_TERM_BYTES[plain])
    return pa.StringArray.from_buffers(len(texts), edges, blanked, offset=texts.offset)


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, term, n, docs) of a batch (lang, source, text of terms only)."""
    names = pc.binary_join_element_wise(batch.column(0), batch.column(1), "\0").dictionary_encode()
    group = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    group_row = np.unique(group, return_index=True)[1]  # a row of each group
    words = words_of(batch.column(2))
    size = max(len(words.distinct), 1)
    held, times = np.unique(words.text * size + words.at, return_counts=True)
    in_group, place = np.unique(group[held // size] * size + held % size, return_inverse=True)
    n = np.bincount(place, times, len(in_group)).astype(np.int64)
    docs = np.bincount(place, minlength=len(in_group))
    of = pa.array(group_row[in_group // size])
    return pa.record_batch(
        [
            batch.column(0).take(of),
            batch.column(1).take(of),
            words.distinct.take(pa.array(in_group % size)),
            pa.array(n),
            pa.array(docs.astype(np.int64)),
        ],
        names=["lang", "source", "term", "n", "docs"],
    )


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        batch = batch.set_column(2, "text", _only_terms(batch.column(2)))
        for part in slices(batch, 2):
            yield _counted(part)


def share(count, total, kept) -> Column:
    """p of a count among ``total`` occurrences of ``kept`` terms, exact."""
    whole = lambda x: x.cast("decimal(19,0)")
    over = whole(F.lit(SCALE)) * whole(count + 2)
    return (1 + F.call_function("div", over, whole(total + 2 * kept))).cast("long")


def difference(p: Column, q: Column) -> Column:
    """f; shares are below 2^30, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def shared_differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def scattered(
    group: np.ndarray, term: np.ndarray, p: np.ndarray, zero: np.ndarray, n_terms: int
) -> Iterator[np.ndarray]:
    """For each group its summed differences from all groups, over ``n_terms`` terms.

    The postings (``group``, ``term``, ``p``) are those with a count; ``zero`` has the share
    that a group gives the other terms.
    """
    f = shared_differences
    order = np.lexsort((group, term))
    peers, q = group[order], p[order]  # the term-major index
    edges = np.searchsorted(term[order], np.arange(n_terms + 1))
    rows = np.argsort(group, kind="stable")
    row_edges = np.searchsorted(group[rows], np.arange(len(zero) + 1))
    # shares repeat within a group: the baselines need each distinct one once
    values = [np.unique(p[rows[a:b]], return_counts=True) for a, b in zip(row_edges, row_edges[1:])]
    for g in range(len(zero)):
        none = f(zero[g], zero)
        own, often = values[g]
        sums = n_terms * none
        for value, times in zip(own.tolist(), often.tolist()):
            sums += times * (f(value, zero) - none)
        for h, (theirs, times) in enumerate(values):
            sums[h] += (times * (f(theirs, zero[g]) - none[h])).sum()
        mine = rows[row_edges[g] : row_edges[g + 1]]
        begin, n = edges[term[mine]], np.diff(edges)[term[mine]]
        at = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
        x, peer, y = np.repeat(p[mine], n), peers[at], q[at]
        np.add.at(sums, peer, f(x, y) - f(x, zero[peer]) - f(zero[g], y) + none[peer])
        yield sums


def _shard(key, postings: pa.Table, peers: pa.Table) -> Iterator[pa.RecordBatch]:
    """Partial sums of every pair of groups of a language, over the terms of a shard."""
    names = peers["source"].combine_chunks()
    group = pc.index_in(postings["source"].combine_chunks(), value_set=names)
    coded = postings["term"].combine_chunks().dictionary_encode()
    rows = scattered(
        group.to_numpy(zero_copy_only=False).astype(np.int64),
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        postings["p"].to_numpy().astype(np.int64),
        peers["zero"].to_numpy().astype(np.int64),
        len(coded.dictionary),
    )
    lang = key[0].as_py()
    for g, sums in enumerate(rows):
        if len(sums) > 1:
            yield pa.record_batch(
                [
                    pa.array([lang] * (len(sums) - 1), pa.string()),
                    pa.array([names[g].as_py()] * (len(sums) - 1), pa.string()),
                    pa.concat_arrays([names[:g], names[g + 1 :]]),
                    pa.array(np.delete(sums, g)),
                ],
                names=["lang", "source", "item", "value"],
            )


def _shards(key, postings: pa.Table, peers: pa.Table) -> pa.Table:
    kinds = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])
    return pa.Table.from_batches(list(_shard(key, postings, peers)), schema=kinds)


def divergences(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group."""
    spoken = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")]
    docs = docs.select(*spoken)
    groups = docs.select("lang", "source").distinct()
    counts = docs.mapInArrow(_batches, "lang string, source string, term string, n long, docs long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = written(counts, "term_counts")

    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = kept.where(F.col("docs") >= LEAST_DOCS).select("lang", "term", "lang_n")
    postings = written(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "postings")
    terms = postings.select("lang", "term", "lang_n").distinct()
    of_lang = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("total"))
    of_group = postings.groupBy("lang", "source").agg(
        F.sum("n").alias("group_total"), F.count("*").alias("group_terms")
    )
    groups = groups.join(of_lang, "lang", "left").join(of_group, ["lang", "source"], "left")
    groups = written(groups.na.fill(0), "groups")

    sizes = groups.groupBy("lang").agg(F.sum("group_terms").alias("postings"))
    shards = F.ceil(F.greatest(F.col("postings"), F.lit(1)) / SHARD).cast("int")
    groups = groups.join(sizes.select("lang", shards.alias("shards")), "lang")
    # V = 0 leaves nothing to divide by
    total = F.when(F.col("v") > 0, F.col("group_total"))
    zero = F.coalesce(share(F.lit(0), total, F.col("v")), F.lit(1))
    peers = groups.select(
        "lang", "source", zero.alias("zero"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    )
    entries = postings.join(groups.select("lang", "source", "group_total", "total", "v", "shards"), ["lang", "source"])
    entries = entries.withColumn("p", share(F.col("n"), F.col("group_total"), F.col("v")))
    dealt = F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard")
    dealt = entries.select("lang", "source", "term", "p", dealt)
    partial = dealt.groupBy("lang", "shard").cogroup(peers.groupBy("lang", "shard"))
    partial = partial.applyInArrow(_shards, "lang string, source string, item string, value long")
    pairs = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    expected = share(F.col("lang_n"), F.col("total"), F.col("v"))
    more = entries.withColumn("q", expected).where("p > q")
    more = more.select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))

    best_first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pairs.withColumns({"part": F.lit("pair"), "rank": F.row_number().over(best_first)})
    more = more.withColumns({"part": F.lit("term"), "rank": F.row_number().over(best_first)})
    return pairs.select(*columns).unionByName(more.where(F.col("rank") <= TOP).select(*columns))


def op11_divergence(spark, folder: str) -> DataFrame:
    return divergences(table(spark, folder, "documents"))


OP11_SQL = r"""
WITH words AS (
    SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (
        SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    )
), kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10
), groups AS (
    SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), counted AS (
    SELECT g.lang, g.source, k.term, count(w.term) AS n
    FROM groups g JOIN kept k ON g.lang = k.lang
    LEFT JOIN words w ON w.lang = g.lang AND w.source = g.source AND w.term = k.term
    GROUP BY g.lang, g.source, k.term
), shares AS (
    SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 2) // (
        sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)
    )::HUGEINT AS p
    FROM counted
), language AS (
    SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2) // (
        sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)
    )::HUGEINT AS q
    FROM kept
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
        FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
        GROUP BY x.lang, x.source, y.source
    ) s ON s.lang = a.lang AND s.source = a.source AND s.other = b.source
), more AS (
    SELECT s.lang, s.source, s.term AS item, (p - q) * (p - q) // (p + q) AS value
    FROM shares s JOIN language l ON s.lang = l.lang AND s.term = l.term
    WHERE s.n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (
    SELECT lang, source, part, item, value,
        row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (
        SELECT lang, source, 'pair' AS part, item, value FROM pairs
        UNION ALL SELECT lang, source, 'term' AS part, item, value FROM more
    )
)
WHERE part = 'pair' OR rank <= 10
"""
