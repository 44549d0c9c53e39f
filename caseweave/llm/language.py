"""Language of a text by cross-parsing against labelled text of each language.

Texts are read as symbols: letters in lower case as UTF-8 bytes, and one space for every run of
anything else, also at both ends. A language's reference is labelled text of it, as a suffix
automaton. A text is parsed from left to right into phrases, each the longest that occurs in
the reference (a symbol that the reference doesn't have is a phrase of its own); a phrase costs
the logarithm of the reference's length, so ``phrases * log2(length) / symbols`` is the
cross-parsing entropy, and the language with the smallest wins. Whole texts are parsed, in
stretches of ``STRETCH`` symbols: no phrase goes over the end of one.

The automata are laid out as one table, state by symbol, in which a missing transition already
leads on to the first state of the next phrase. All stretches of a slice of documents and all
languages then take a step each at the same time, whatever the texts say, so a very long text
is as cheap as many short ones, and nothing is shuffled.

The references are a bounded sample. All labelled texts are cut into pieces of ``PIECE``
symbols; of a language's distinct pieces those with the smallest hashes are taken, up to
``REFERENCE`` symbols, fewer if the table of all languages would exceed ``CELLS`` cells. Only
these pieces reach the driver. Documents whose crc32(doc_id as text) leaves 1 on division by 3
are held out: nothing is learnt from them. A missing doc_id counts as empty text there.

Defined results: texts without letters, null and empty ones are ``und`` with score 0, and so is
every text if no language was learnt. Otherwise the score is by what part the winner's entropy
is below the next one's, 1 if no other language was learnt. Of languages with equal entropy the
first by name wins. Rows that repeat a doc_id each get a row. A language that only documents
without letters have is not learnt.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseweave.llm.automaton import SuffixAutomaton
from caseweave.llm.common import table
from caseweave.llm.words import release, slices

REFERENCE = 50_000
PIECE = 500
STRETCH = 2_048
CELLS = 1 << 25
FOLDS, HELD_OUT = 3, 1
UNDECIDED = "und"


def symbols(texts: pa.StringArray) -> pa.BinaryArray:
    letters = pc.replace_substring_regex(texts, r"[^\p{L}\p{M}]+", " ")
    letters = pc.utf8_lower(pc.ascii_trim(letters, " "))
    return pc.binary_join_element_wise(" ", letters, " ", "").cast(pa.binary())


def has_letters(texts: pa.StringArray) -> np.ndarray:
    return pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)


def _hash(piece: bytes) -> int:
    return int.from_bytes(xxhash.xxh64_digest(piece), "big", signed=True)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of a task with the smallest hashes, of each language as many as can be used."""
    most = REFERENCE // PIECE
    found: dict[str, list[tuple[int, bytes]]] = {}
    held: dict[str, set[int]] = {}
    for batch in batches:
        for part in slices(batch, 1):
            letters = has_letters(part.column(1))
            for lang, text, some in zip(part.column(0).to_pylist(), symbols(part.column(1)).to_pylist(), letters):
                if not some:
                    continue
                heap, known = found.setdefault(lang, []), held.setdefault(lang, set())
                for at in range(0, len(text), PIECE):
                    piece = text[at : at + PIECE]
                    code = _hash(piece)
                    if code in known or len(heap) == most and -code <= heap[0][0]:
                        continue
                    known.add(code)
                    heapq.heappush(heap, (-code, piece))
                    if len(heap) > most:
                        known.remove(-heapq.heappop(heap)[0])
    rows = [(lang, -code, piece) for lang, heap in found.items() for code, piece in heap]
    columns = zip(*rows) if rows else ((), (), ())
    kinds = [pa.string(), pa.int64(), pa.binary()]
    yield pa.record_batch(
        [pa.array(list(x), t) for x, t in zip(columns, kinds)], names=["lang", "code", "piece"]
    )


def held_out(doc_id: Column) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % FOLDS == HELD_OUT


def fit(docs: DataFrame) -> dict[str, list[bytes]]:
    """The reference pieces of each language, from the documents that are not held out."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    pieces = labelled.select("lang", "text").mapInArrow(_pieces, "lang string, code long, piece binary")
    first = Window.partitionBy("lang").orderBy("code")
    pieces = pieces.groupBy("lang", "code").agg(F.min("piece").alias("piece"))
    pieces = pieces.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= REFERENCE // PIECE)
    references: dict[str, list[bytes]] = {}
    for row in pieces.orderBy("lang", "code").collect():  # REFERENCE symbols of a language at most
        references.setdefault(row["lang"], []).append(bytes(row["piece"]))
    return references


class CrossParser:
    """The automata of all references as one table of steps."""

    def __init__(self, references: dict[str, list[bytes]]):
        self.languages = sorted(references)
        used = sorted({b for pieces in references.values() for piece in pieces for b in piece})
        self.classes = np.full(256, len(used), np.int64)  # the last class: bytes of no reference
        self.classes[used] = np.arange(len(used))
        width = len(used) + 1
        most = min(REFERENCE, CELLS // (2 * width * max(len(references), 1)))
        parts, self.roots, self.costs, at = [], [], [], 0
        for lang in self.languages:
            text = self._bounded(references[lang], most)
            machine = SuffixAutomaton(self.classes[np.frombuffer(x, np.uint8)].tolist() for x in text)
            n = len(machine.steps)
            state, symbol, after = (
                np.fromiter((x for i, s in enumerate(machine.steps) for x in row(i, s)), np.int64)
                for row in (lambda i, s: [i] * len(s), lambda i, s: s.keys(), lambda i, s: s.values())
            )
            root = at * width
            step = np.full((n, width), ~root, np.int32)
            first = state == 0
            step[0, symbol[first]] = ~(root + after[first] * width)
            step[1:] = step[0]  # no way on: the next phrase starts here
            step[state[~first], symbol[~first]] = root + after[~first] * width
            parts.append(step.ravel())
            self.roots.append(root)
            self.costs.append(math.log2(max(sum(map(len, text)), 2)))
            at += n
        self.steps = np.concatenate(parts) if parts else np.zeros(0, np.int32)

    @staticmethod
    def _bounded(pieces: list[bytes], most: int) -> list[bytes]:
        out = []
        for piece in pieces:
            out.append(piece[:most])
            most -= len(out[-1])
            if most <= 0:
                break
        return out

    def phrases(self, texts: pa.BinaryArray) -> np.ndarray:
        """Phrases of each text in each language; ``texts`` are symbols."""
        edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        coded = self.classes[np.frombuffer(data, np.uint8)] if data else np.zeros(0, np.int64)
        size = np.diff(edges).astype(np.int64)
        parts = -(-size // STRETCH)
        text = np.repeat(np.arange(len(size)), parts)
        number = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = edges[text].astype(np.int64) + number * STRETCH
        length = np.minimum(size[text] - number * STRETCH, STRETCH)
        order = np.argsort(-length, kind="stable")
        begin, length = begin[order], length[order]
        roots = np.array(self.roots, np.int64)[:, None]
        state = np.broadcast_to(roots, (len(roots), len(begin))).copy()
        count = np.zeros(state.shape, np.int32)
        alive = np.searchsorted(-length, -np.arange(STRETCH), side="left")
        for k in range(int(length[0]) if len(length) else 0):
            n = alive[k]
            step = self.steps[state[:, :n] + coded[begin[:n] + k]]
            count[:, :n] -= step >> 31  # below zero: a phrase starts
            state[:, :n] = step ^ (step >> 31)
        total = np.zeros((len(size), len(roots)), np.int64)
        np.add.at(total, text[order], count.T)
        return total


@lru_cache(maxsize=1)
def _parser(references: tuple) -> CrossParser:
    """One for each Python worker."""
    return CrossParser({lang: list(pieces) for lang, pieces in references})


def _judged(references: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(references)
        names = pa.array([*parser.languages, UNDECIDED])
        for batch in batches:
            for part in slices(batch, 2):
                letters = has_letters(part.column(2))
                texts = symbols(part.column(2).filter(pa.array(letters)))
                best = np.full(len(letters), len(names) - 1)
                phrases, score = np.zeros(len(letters), np.int64), np.zeros(len(letters))
                if len(texts) and parser.languages:
                    found = parser.phrases(texts)
                    bits = found * np.array(parser.costs)
                    win = bits.argmin(axis=1)
                    least = bits[np.arange(len(win)), win]
                    bits[np.arange(len(win)), win] = np.inf
                    best[letters], score[letters] = win, 1 - least / bits.min(axis=1)
                    phrases[letters] = found[np.arange(len(win)), win]
                yield pa.record_batch(
                    [part.column(0), part.column(1), names.take(pa.array(best)), pa.array(score), pa.array(phrases)],
                    names=["doc_id", "held_out", "lang_pred", "score", "n_phrases"],
                )
        release()

    return run


def predicted(docs: DataFrame, references: dict[str, list[bytes]]) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_phrases) of every row; only the text is judged."""
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    texts = docs.select(doc_id, held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    known = tuple((lang, tuple(pieces)) for lang, pieces in references.items())
    return texts.mapInArrow(
        _judged(known), "doc_id long, held_out boolean, lang_pred string, score double, n_phrases long"
    )


def op12_language(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return predicted(docs, fit(docs))
