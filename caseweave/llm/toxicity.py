"""Severity of toxic language by cumulative-link ordinal regression on sparse word features.

Grades are ordered: P(grade >= k) = sigmoid(w.x - c_k) with one weight vector for all
thresholds c_1 < c_2. x marks which words of a list a text holds, lower-cased and without
punctuation at their ends. The expected severity is the sum of the P(grade >= k); a document is
toxic if P(grade >= 1) is at least one half.

The model is fitted on a bounded sample: the ``SAMPLE`` first labelled documents by hash of
doc_id, less the copies of one before (``ALIKE`` of ``SKETCHES`` min-hash sketches equal), as
copies would make any of their words look like a sign of their label. The list has the words
whose presence goes with the label by ``LEAST_Z`` standard deviations or more, in
``LEAST_DOCS`` documents or more. The labels tell toxic from not; of the toxic ones, those with
``STRONG`` words of the list or more have grade 2, others 1. All documents are then scored in
one pass without a shuffle.

Defined results: null and empty texts have no words, so the severity of an unmarked text. If
the sample has no toxic or no other document there is nothing to learn: severity 0, none toxic.
Rows that repeat a doc_id each get a row; a doc_id that is labelled twice counts as toxic if
one of its labels does; labels without doc_id or without a value are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm.common import free_name, id_and_text, table
from caseweave.llm.sketches import shingle_hashes, smallest
from caseweave.llm.words import slices, words_of

SAMPLE = 20_000
LEAST_Z = 5.0
LEAST_DOCS = 4
STRONG = 4
RIDGE = 1e-5
#: Sketches of five-word shingles by which copies in the sample are known.
SKETCHES = 8
ALIKE = 6
_ROUNDS = 600


def marked_words(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each normalised word, once for each text."""
    words = words_of(texts)
    plain = pc.replace_substring_regex(pc.utf8_lower(words.distinct), r"^\P{L}+|\P{L}+$", "")
    hashes = map(xxhash.xxh64_intdigest, plain.cast(pa.binary()).to_pylist())
    hashes = np.fromiter(hashes, np.uint64, len(plain))
    empty = pc.binary_length(plain).to_numpy() == 0
    distinct, number = np.unique(hashes, return_inverse=True)
    real = ~empty[words.at]
    pairs = np.unique(words.text[real] * max(len(distinct), 1) + number[words.at[real]])
    return pairs // max(len(distinct), 1), distinct[pairs % max(len(distinct), 1)]


class Marks:
    """A matrix of zeros and ones by the places of the ones."""

    def __init__(self, row: np.ndarray, column: np.ndarray, shape: tuple[int, int]):
        self.row, self.column, self.shape = row, column, shape

    def __matmul__(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], minlength=self.shape[0])

    @property
    def T(self) -> Marks:
        return Marks(self.column, self.row, self.shape[::-1])


@dataclass
class Model:
    """``features``: sorted word hashes; ``cuts``: the thresholds c_k."""

    features: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def at_least(self, texts: pa.StringArray) -> np.ndarray:
        """P(grade >= k) for each text and k."""
        if not len(self.features):
            return np.zeros((len(texts), len(self.cuts)))
        text, word = marked_words(texts)
        place = np.minimum(np.searchsorted(self.features, word), len(self.features) - 1)
        found = self.features[place] == word
        drive = np.bincount(text[found], self.weights[place[found]], minlength=len(texts))
        return 1 / (1 + np.exp(self.cuts[None, :] - drive[:, None]))


def fit_ordinal(x: np.ndarray | Marks, grade: np.ndarray, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of greatest penalised likelihood, by Adam on all rows.

    The thresholds are c_1 and positive steps from it, which keeps them in order.
    """
    n, m = x.shape
    weights, steps = np.zeros(m), np.zeros(grades - 1)
    steps[0] = 1.0
    moments = [np.zeros(m + grades - 1) for _ in range(2)]
    onto = lambda z: 1 / (1 + np.exp(-z))
    rows = np.arange(n)
    for k in range(1, _ROUNDS + 1):
        cuts = np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))
        drive = x @ weights
        above = np.column_stack([np.ones(n), onto(drive[:, None] - cuts), np.zeros(n)])
        share = np.maximum(above[rows, grade] - above[rows, grade + 1], 1e-12)
        slope = above * (1 - above)
        upper, lower = slope[rows, grade] / share, slope[rows, grade + 1] / share
        by_cut = np.zeros((n, grades + 1))
        by_cut[rows, grade] += upper
        by_cut[rows, grade + 1] -= lower
        d_cuts = by_cut[:, 1:grades].mean(axis=0)
        tail = np.cumsum(d_cuts[::-1])[::-1]
        d_steps = tail * np.concatenate([[1.0], np.exp(steps[1:])])
        d_steps[1:] += RIDGE * steps[1:]
        d_weights = -(x.T @ (upper - lower)) / n + RIDGE * weights
        gradient = np.concatenate([d_weights, d_steps])
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        change = moments[0] / (1 - 0.9**k) / (np.sqrt(moments[1] / (1 - 0.999**k)) + 1e-9)
        change *= 0.05
        weights, steps = weights - change[:m], steps - change[m:]
    return weights, np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))


def sketches(texts: pa.StringArray) -> np.ndarray:
    """``SKETCHES`` numbers of each text, equal for copies and some of them for near copies."""
    code, counts, _ = shingle_hashes(texts)
    return smallest(code, counts, SKETCHES)


def first_of_copies(prints: np.ndarray) -> np.ndarray:
    """Whether a row is no copy, with ``ALIKE`` of its sketches or more, of a row kept before it.

    Of four pairs of sketches two at least are equal then, which finds the rows to compare.
    """
    kept = np.zeros(len(prints), bool)
    pairs = [(i, i + 1, j, j + 1) for i in range(0, SKETCHES, 2) for j in range(i + 2, SKETCHES, 2)]
    known: dict[tuple, list[int]] = {}
    for i, row in enumerate(prints):
        keys = [(*places, row[list(places)].tobytes()) for places in pairs]
        rivals = list({k for key in keys for k in known.get(key, ())})
        kept[i] = not len(rivals) or (prints[rivals] == row).sum(axis=1).max() < ALIKE
        if kept[i]:
            for key in keys:
                known.setdefault(key, []).append(i)
    return kept


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, 1):
            text, word = marked_words(batch.column(1))
            edges = np.searchsorted(text, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(word.view(np.int64)))
            prints = pa.array(sketches(batch.column(1)).view(np.int64).tolist(), pa.list_(pa.int64()))
            yield pa.record_batch(
                [batch.column(0), batch.column(2), lists, prints], names=["doc_id", "toxic", "words", "prints"]
            )


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    labels = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    labels = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    labels = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = id_and_text(docs).join(F.broadcast(labels), "doc_id").select("doc_id", "text", "toxic")
    rows = rows.mapInArrow(_sampled, "doc_id long, toxic int, words array<long>, prints array<long>")
    rows = rows.toArrow()  # SAMPLE documents at most, unless doc_ids repeat
    rows = rows.sort_by([("doc_id", "ascending")])
    prints = rows["prints"].combine_chunks().flatten().to_numpy().reshape(-1, SKETCHES)
    rows = rows.filter(pa.array(first_of_copies(prints))).combine_chunks()
    toxic = rows["toxic"].to_numpy() > 0
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(2))
    if toxic.all() or not toxic.any():
        return nothing
    lists = rows["words"].combine_chunks()
    ends = lists.offsets.to_numpy()
    doc = np.repeat(np.arange(len(toxic)), np.diff(ends))
    distinct, word = np.unique(lists.values.to_numpy().view(np.uint64)[ends[0] : ends[-1]], return_inverse=True)
    held = np.bincount(word, minlength=len(distinct))
    held_toxic = np.bincount(word[toxic[doc]], minlength=len(distinct))
    p = toxic.mean()
    z = (held_toxic - held * p) / np.sqrt(np.maximum(held, 1) * p * (1 - p))
    listed = np.flatnonzero((z >= LEAST_Z) & (held >= LEAST_DOCS))
    if not len(listed):
        return nothing
    place = np.minimum(np.searchsorted(listed, word), len(listed) - 1)
    found = listed[place] == word
    x = Marks(doc[found], place[found], (len(toxic), len(listed)))
    grade = np.where(toxic, np.where(x @ np.ones(len(listed)) >= STRONG, 2, 1), 0)
    weights, cuts = fit_ordinal(x, grade, 3)
    return Model(distinct[listed], np.round(weights, 6), np.round(cuts, 6))


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                share = model.at_least(batch.column(1))
                columns = [batch.column(0), np.round(share.sum(axis=1), 6), (share >= 0.5).sum(axis=1)]
                columns += [share[:, 0] >= 0.5]
                yield pa.record_batch(columns, names=["doc_id", "expected_severity", "grade", "toxic"])

    return run


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, expected_severity, grade, toxic) of every row."""
    return id_and_text(docs).mapInArrow(
        _scored(model), "doc_id long, expected_severity double, grade long, toxic boolean"
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not toxic, judged where they are."""
    names, n = docs.columns, len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, n):
                stay = model.at_least(batch.column(n))[:, 0] < 0.5
                rest = batch.filter(pa.array(stay))
                yield pa.record_batch(rest.columns[:n], names=names)

    judged = docs.select("*", F.coalesce("text", F.lit("")).alias(free_name(docs, "judged")))
    return judged.mapInArrow(run, docs.schema)


def op7_toxicity(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return severity(docs, fit(docs, table(spark, folder, "labels")))
