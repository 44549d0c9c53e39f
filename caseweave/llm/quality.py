"""Quality rules: base counts of a text, and a log-likelihood ratio of hashed word n-grams.

Words and pairs of neighbouring words are hashed to ``BUCKETS`` buckets. Two multinomials are
counted over the buckets: that of the raw corpus over all documents, and that of the trusted
target over documents labelled good. A document's score is the sum of
log p_target - log p_raw over its n-grams, divided by their number. Every document whose score
is not below one threshold is kept; nothing is drawn at random.

The trusted documents are all those labelled quality 1. Half of them, by hash of doc_id, are
counted; the threshold is the ``QUANTILE`` of the scores of all the others (documents that pass
the base rules), so it is measured on documents that the target has not seen. Counts of the
buckets are added up within a task before they are shuffled, and only the ``BUCKETS`` sums and
``STEP`` counts at a time of the held-out scores reach the driver.

Defined results: null and empty texts have no words, fail the base rules and have score 0.
Without trusted documents in either half nothing tells good from bad, and only the base rules
decide. Rows that repeat a doc_id each get a row; rows without doc_id are counted and judged
like all others but are never trusted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import id_and_text, table
from caseweave.llm.words import Words, per_text, slices, words_of
from caseweave.workspace import written

BUCKETS = 1 << 16
SMOOTHING = 1.0
QUANTILE = 0.005
PLACES = 9
#: Ranges of scores that are counted at a time to find a quantile.
STEP = 1 << 12
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def ngrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and then of pairs, and the text that each belongs to."""
    h, text = words.hashes()[words.at], words.text
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    inside = text[1:] == text[:-1]
    pairs = ((h[:-1] * _A + h[1:]) * _B)[inside]
    found = np.concatenate([h * _A, pairs]) >> shift
    return found.astype(np.int64), np.concatenate([text, text[1:][inside]])


def repeated_words(words: Words) -> np.ndarray:
    """Words of each text in windows of five words that the text holds twice or more."""
    n, at, text = len(words.at), words.at, words.text
    covered = np.zeros(n, bool)
    if n >= WINDOW:
        starts = np.flatnonzero(text[WINDOW - 1 :] == text[: n - WINDOW + 1])
        code = (text + 1).astype(np.uint64) * _B
        code = code[starts]
        for k in range(WINDOW):
            code = (code ^ at[starts + k].astype(np.uint64)) * _A
            code ^= code >> np.uint64(29)
        order = np.argsort(code, kind="stable")
        same = np.concatenate([[False], code[order][1:] == code[order][:-1], [False]])
        some = starts[order[same[:-1] | same[1:]]]
        if len(some):  # equal hashes are verified word by word
            rows = np.column_stack([text[some], *(at[some + k] for k in range(WINDOW))])
            _, which, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
            some = some[times[which.ravel()] > 1]
            for k in range(WINDOW):
                covered[some + k] = True
    return per_text(covered, words.counts)


def repeated_lines(texts: pa.StringArray) -> np.ndarray:
    """Lines with a word that are equal to an earlier line of the text."""
    parts = pc.split_pattern(texts, "\n")
    ends = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    has_word = pc.match_substring_regex(coded.dictionary, r"[^\x20\x09-\x0D]")
    real = has_word.to_numpy(zero_copy_only=False)[at]
    n = len(texts)
    text = np.repeat(np.arange(n), np.diff(ends))[real]
    distinct = np.unique(text * max(len(coded.dictionary), 1) + at[real]) // max(len(coded.dictionary), 1)
    return np.bincount(text, minlength=n) - np.bincount(distinct, minlength=n)


def base_counts(texts: pa.StringArray, words: Words) -> dict[str, np.ndarray]:
    length = pc.utf8_length(words.distinct).to_numpy().astype(np.int64)
    symbols = pc.count_substring_regex(words.distinct, SYMBOLS).to_numpy().astype(np.int64)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": words.sums(length),
        "n_symbols": words.sums(symbols),
        "n_dup_lines": repeated_lines(texts).astype(np.int64),
        "n_repeat_words": repeated_words(words).astype(np.int64),
    }


def fails_base(counts: dict[str, np.ndarray]) -> np.ndarray:
    n = counts["n_words"]
    return (n < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * n)


@dataclass
class Model:
    weights: np.ndarray
    threshold: float

    def scores(self, words: Words) -> np.ndarray:
        found, text = ngrams(words)
        n = len(words.counts)
        total = np.bincount(text, self.weights[found], minlength=n)
        return np.round(total / np.maximum(np.bincount(text, minlength=n), 1), PLACES)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for whole in batches:
        for batch in slices(whole, 1):
            found, text = ngrams(words_of(batch.column(1)))
            trusted = batch.column(2).to_numpy(zero_copy_only=False)[text]  # counted again, for the target
            raw += np.bincount(found[~trusted], minlength=BUCKETS)
            target += np.bincount(found[trusted], minlength=BUCKETS)
    some = np.flatnonzero(raw + target)
    yield pa.record_batch([some, raw[some], target[some]], names=["bucket", "raw", "target"])


def _held_out(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                words = words_of(batch.column(1))
                good = ~fails_base(base_counts(batch.column(1), words))
                yield pa.record_batch([Model(weights, 0).scores(words)[good]], names=["score"])

    return run


def ranked_score(scores: DataFrame, rank: int) -> float:
    """The score of a rank, from 0 for the smallest; ``STEP`` counts reach the driver at a time."""
    units = scores.select(F.round(F.col("score") * 10**PLACES).cast("long").alias("unit"))
    low, high = units.agg(F.min("unit"), F.max("unit")).first()
    while low < high:
        width = -(-(high - low + 1) // STEP)
        part = F.floor((F.col("unit") - low) / width).cast("long").alias("part")
        counts = units.where(F.col("unit").between(low, high)).groupBy(part).count().collect()
        for part, count in sorted(map(tuple, counts)):
            if rank < count:
                break
            rank -= count
        low, high = low + part * width, min(high, low + (part + 1) * width - 1)
    return low / 10**PLACES


def quantile(scores: DataFrame, share: float) -> float | None:
    """Between the two nearest of all scores, by their distances; None without scores."""
    count = scores.count()
    if not count:
        return None
    place = share * (count - 1)
    rank = int(place)
    low = ranked_score(scores, rank)
    high = ranked_score(scores, rank + 1) if rank + 1 < count else low
    return float(np.quantile([low, high], place - rank))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    docs = id_and_text(docs)
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long")).distinct()
    # the half is known before the join, so a text is shuffled once at most; labels grow with the
    # documents and are never broadcast, so that the cost grows in proportion
    good = written(good, "trusted").hint("merge")
    counted = F.shiftrightunsigned(F.xxhash64("doc_id"), 17) % 2 == 0
    target = docs.where(counted).join(good, "doc_id").select("doc_id", "text", F.lit(True).alias("trusted"))
    counts = docs.withColumn("trusted", F.lit(False)).unionByName(target)
    counts = counts.mapInArrow(_count, "bucket long, raw long, target long")
    counts = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.collect():  # BUCKETS rows at most
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    share = lambda x: np.log((x + SMOOTHING) / (x.sum() + SMOOTHING * BUCKETS))
    weights = share(target) - share(raw)
    scores = docs.where(~counted).join(good, "doc_id")
    scores = scores.select("doc_id", "text").mapInArrow(_held_out(weights), "score double")
    threshold = quantile(written(scores, "scores"), QUANTILE) if target.sum() > 0 else None
    return Model(weights, -np.inf if threshold is None else round(threshold, PLACES))


def _judged(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                words = words_of(batch.column(1))
                counts = base_counts(batch.column(1), words)
                failed, scores = fails_base(counts), model.scores(words)
                columns = [batch.column(0), *counts.values(), failed, scores]
                columns += [~failed & (scores >= model.threshold)]
                names = ["doc_id", *counts, "base_failed", "score", "kept"]
                yield pa.record_batch(columns, names=names)

    return run


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """The base counts, base_failed, score and kept of every row."""
    return id_and_text(docs).mapInArrow(
        _judged(model),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, score double, kept boolean",
    )


def op3_quality(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return judge(docs, fit(docs, table(spark, folder, "labels")))
