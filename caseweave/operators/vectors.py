"""Exact cosine top-k over embedding vectors.

Case vectors are grouped into cells, about as many as the square root of the cases, whose
centres are fitted to a bounded sample of them. The angle between a report and a case is at
least the difference of their angles to a centre, so a cell whose best possible cosine is below
the report's floor holds no answer and is not visited. The cells that are nearest to a report
and together have k of its candidates are visited first and set that floor.

Cells are packed into blocks of about ``BLOCK_BYTES``, large ones cut into several. Every case is
in one block, whatever the number of candidate groups: a block knows which groups its facets
belong to, and what is no candidate of a report takes no part in the product. A report
visits a block once for all its cells there, and a block returns only the k best of each report.
Where a report has a floor, products in single precision tell which cases can reach it, with a
margin above their largest error; only these are scored.

A report that can't be answered is listed with the reason instead; the others are answered.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.operators.candidates import (
    assign_groups,
    environment_matches,
    facets,
    first_matches,
    group_facets,
    shared_groups,
    with_facet,
)
from caseweave.operators.ranking import (
    SCORE_PLACES,
    best,
    check_top_k,
    first_candidates,
    ranked_reports,
)
from caseweave.operators.terms import Asked
from caseweave.workspace import written

#: The centres are fitted to a sample of this size, the first cases by hash of their id.
SAMPLE_BYTES = 32 << 20
ROUNDS = 8
#: Vectors of a block of cases, and of the reports that meet it in one task.
BLOCK_BYTES = 16 << 20
ASK_BYTES = 32 << 20
#: Visits, or numbers of pairs to be scored, that a task holds at a time.
PRODUCT_BYTES = 32 << 20
#: A product, which should stay in the cache; with this part of it at the floor all of it is scored.
TILE_BYTES = 1 << 20
MANY = 1 / 8
#: Scores that a task holds before it keeps the best of them.
FOUND = 1 << 20
TIE_MARGIN = 1e-8

NO_VECTOR = "no vector"
BAD_VECTOR = "vector of another dimension or with missing values"
NO_CANDIDATE = "no candidate with a vector"


class Answers(NamedTuple):
    """``matches``: (report_id, rank, kb_id, score); ``unanswered``: (report_id, reason)."""

    matches: DataFrame
    unanswered: DataFrame


def _complete(vector: Column) -> Column:
    """Whether a vector has values and none is missing."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~odd, F.lit(False))


def _has_length(vector: Column) -> Column:
    return F.exists(vector, lambda x: x != 0)


def _rows(vectors: pa.Array, dimension: int) -> np.ndarray:
    values = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _unit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one (zero rows stay zero) and the lengths before."""
    lengths = np.sqrt((rows * rows).sum(axis=1))
    return rows / np.where(lengths > 0, lengths, 1.0)[:, None], lengths


def _angles(units: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centres.T, -1.0, 1.0))


def fitted_centres(cases: DataFrame, count: int, dimension: int) -> np.ndarray:
    """Unit centres of cells by k-means on the sphere, about sqrt(count) of them.

    A cell is learnt from eight sampled vectors or more, which bounds their number as well.
    """
    most = max(1, SAMPLE_BYTES // (8 * dimension))
    sample = cases.filter(_has_length("embedding")).orderBy(F.xxhash64("kb_id"), "kb_id").limit(most)
    rows = sample.select("embedding").toArrow()["embedding"]
    if not len(rows):
        return np.zeros((0, dimension))
    units = _unit(_rows(rows, dimension))[0]
    cells = max(1, min(round(math.sqrt(count)), len(units) // 8))
    centres = units[:cells]  # in hash order, so that these are drawn at random
    for _ in range(ROUNDS):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        moved, lengths = _unit(sums)
        centres = np.where(lengths[:, None] > 0, moved, centres)
    return centres


class Cells(NamedTuple):
    """Centres, and the blocks of each cell: ``parts`` from ``first``. Zero vectors have a last
    cell of their own."""

    centres: np.ndarray
    first: np.ndarray
    parts: np.ndarray


def packed_cells(centres: np.ndarray, sizes: dict[int, int], per_block: int) -> Cells:
    """Put cells into blocks of ``per_block`` cases; a larger cell is cut into several."""
    n = len(centres) + 1
    first, parts, block, room = np.zeros(n, np.int64), np.ones(n, np.int64), 0, per_block
    for cell in range(n):
        size = sizes.get(cell, 0)
        if size > room and room < per_block:
            block, room = block + 1, per_block
        first[cell], parts[cell] = block, max(1, -(-size // per_block))
        if size >= per_block:
            block, room = block + int(parts[cell]), per_block
        else:
            room -= size
    return Cells(centres, first, parts)


def _located(centres: np.ndarray, dimension: int) -> Callable:
    """Adds the cell of a case and its angle to the centre."""

    def run(batches):
        for batch in batches:
            units, lengths = _unit(_rows(batch.column("embedding"), dimension))
            cell, angle = np.full(len(units), len(centres)), np.zeros(len(units))
            if len(centres):
                angles = _angles(units, centres)
                some = lengths > 0
                cell[some] = angles[some].argmin(axis=1)
                angle[some] = angles[some].min(axis=1)
            yield pa.record_batch(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(angle)],
                names=[*batch.schema.names, "cell", "angle"],
            )

    return run


def _visits(cells: Cells, dimension: int, top_k: int, first: bool) -> Callable:
    """The blocks that reports of a group visit: first those of the nearest cells, which have
    ``top_k`` candidates, then those of all others that the floor leaves."""

    def run(asks: pa.Table, held: pa.Table) -> pa.Table:
        names = ["query_key", "candidate_group", "embedding", "floor", "block", "cells"]
        kinds = [asks.schema.field(x).type for x in names[:4]] + [pa.int64(), pa.list_(pa.int32())]
        if not (asks.num_rows and held.num_rows):
            return pa.table([pa.array([], t) for t in kinds], names=names)
        number = held["cell"].to_numpy()
        count, near, far = (held[x].to_numpy() for x in ("cases", "nearest", "farthest"))
        real = number < len(cells.centres)
        angles = np.full((asks.num_rows, len(number)), np.pi / 2)
        units = _unit(_rows(asks["embedding"], dimension))[0]
        angles[:, real] = _angles(units, cells.centres[number[real]])
        apart = np.maximum(0.0, np.maximum(angles - far, near - angles))
        apart[:, ~real] = np.pi / 2  # a zero vector has cosine 0 with everything
        reach = np.cos(apart)
        order = np.lexsort((np.broadcast_to(number, reach.shape), -reach))
        before = np.cumsum(count[order], axis=1) - count[order]
        chosen = np.zeros(reach.shape, bool)
        np.put_along_axis(chosen, order, before < top_k, axis=1)
        if not first:
            chosen = ~chosen & (reach >= asks["floor"].to_numpy()[:, None] - TIE_MARGIN)
        row, place = np.nonzero(chosen)
        cell = number[place]
        parts = cells.parts[cell]
        row, cell = np.repeat(row, parts), np.repeat(cell, parts)
        block = np.repeat(cells.first[number[place]] - (np.cumsum(parts) - parts), parts) + np.arange(len(row))
        order = np.lexsort((cell, block, row))
        row, block, cell = row[order], block[order], cell[order]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (block[1:] != block[:-1])])[: len(row)]
        head = np.flatnonzero(new)
        lists = pa.ListArray.from_arrays(
            pa.array(np.append(head, len(row)), pa.int32()), pa.array(cell.astype(np.int32))
        )
        some = asks.select(names[:4]).take(pa.array(row[head]))
        return some.append_column("block", pa.array(block[head])).append_column("cells", lists)

    return run


def _top_columns(scores: np.ndarray, top_k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``top_k`` entries per row; equal scores go to lower columns."""
    k = min(top_k, scores.shape[1])
    smallest = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    rows, columns = np.nonzero(scores >= smallest[:, None])
    order = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < k], columns[place < k]


def _rounded(scores: np.ndarray) -> np.ndarray:
    return np.round(scores, SCORE_PLACES) + 0.0


class _Search:
    """Asks and the cases of a block, and the ``top_k`` best cases of each ask so far."""

    def __init__(self, wanted: np.ndarray, floor: np.ndarray, units: np.ndarray, ids: np.ndarray, top_k: int):
        self.wanted, self.floor, self.units, self.ids, self.top_k = wanted, floor.copy(), units, ids, top_k
        self.rough_wanted, self.rough_units = wanted.astype(np.float32), units.astype(np.float32)
        # the largest error of a product in single precision, twice, whatever the order of its sum
        self.margin = 2 * (wanted.shape[1] + 8) * 2.0**-24 + TIE_MARGIN
        self.found, self.pending = [], 0

    def visit(self, asks: np.ndarray, cases: np.ndarray) -> None:
        """Score what can be among the best of ``asks``; ``cases`` are of one cell, by kb_id."""
        whole = cases[-1] - cases[0] == len(cases) - 1
        place = slice(cases[0], cases[-1] + 1) if whole else cases
        units, rough_units = self.units[place], self.rough_units[place]
        step = max(1, TILE_BYTES // (8 * len(cases)))
        for at in range(0, len(asks), step):
            some = asks[at : at + step]
            floor = self.floor[some]
            if (floor > -np.inf).all():
                low = (floor - self.margin).astype(np.float32)
                row, column = np.nonzero(self.rough_wanted[some] @ rough_units.T >= low[:, None])
                if len(row) <= MANY * len(some) * len(cases):
                    self._pairs(some[row], cases[column])
                    continue
            scores = _rounded(self.wanted[some] @ units.T)
            row, column = _top_columns(scores, self.top_k)
            self._add(some[row], cases[column], scores[row, column])

    def _pairs(self, row: np.ndarray, column: np.ndarray) -> None:
        step = max(1, PRODUCT_BYTES // (16 * self.wanted.shape[1]))
        for at in range(0, len(row), step):
            r, c = row[at : at + step], column[at : at + step]
            self._add(r, c, _rounded(np.einsum("ij,ij->i", self.wanted[r], self.units[c])))

    def _add(self, row: np.ndarray, column: np.ndarray, score: np.ndarray) -> None:
        self.found.append((row, column, score))
        self.pending += len(row)
        if self.pending > max(FOUND, self.top_k * len(self.wanted)):
            self.best()

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ask, case, score): the best so far, by ask. The last of k is a floor."""
        if not self.found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        row, column, score = (np.concatenate(x) for x in zip(*self.found))
        order = np.lexsort((self.ids[column], -score, row))
        row, column, score = row[order], column[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        last = place == self.top_k - 1
        self.floor[row[last]] = np.maximum(self.floor[row[last]], score[last])
        kept = place < self.top_k
        self.found, self.pending = [(row[kept], column[kept], score[kept])], 0
        return self.found[0]


def _scored(dimension: int, top_k: int) -> Callable:
    def run(asks: pa.Table, block: pa.Table) -> pa.Table:
        """The k best candidates in a block of each report that visits it."""
        out = [[], [], []]
        known = pc.is_valid(block["kb_id"])
        cases, facet_rows = block.filter(known), block.filter(pc.invert(known))
        cases = cases.sort_by([("cell", "ascending"), ("kb_id", "ascending")])
        if asks.num_rows and cases.num_rows:
            asks = asks.combine_chunks()
            ids = cases["kb_id"].to_numpy()
            cells, first = np.unique(cases["cell"].to_numpy(), return_index=True)
            end = np.append(first[1:], len(ids))
            facet = pc.index_in(cases["facet_id"], value_set=facet_rows["facet_id"]).to_numpy()
            facets_of = {}
            for place, names in enumerate(facet_rows["groups"].to_pylist()):
                for name in names:
                    facets_of.setdefault(name, []).append(place)
            wanted, units = (_unit(_rows(x["embedding"], dimension))[0] for x in (asks, cases))
            search = _Search(wanted, asks["floor"].to_numpy(), units, ids, top_k)
            groups, lists = asks["candidate_group"].chunk(0).dictionary_encode(), asks["cells"].chunk(0)
            group = groups.indices.to_numpy()
            by_group = np.argsort(group, kind="stable")
            step = max(1, PRODUCT_BYTES // len(cells))
            for at in range(0, len(by_group), step):
                some = by_group[at : at + step]
                mine = lists.take(pa.array(some))
                visits, row = mine.flatten().to_numpy(), pc.list_parent_indices(mine).to_numpy()
                here = np.isin(visits, cells)
                visited = np.zeros((len(cells), len(some)), bool)
                visited[np.searchsorted(cells, visits[here]), row[here]] = True
                starts = np.flatnonzero(np.diff(group[some], prepend=-1))
                for start, stop in zip(starts, np.append(starts[1:], len(some))):
                    name = groups.dictionary[group[some[start]]].as_py()
                    candidate = np.isin(facet, facets_of.get(name, []))
                    asking = visited[:, start:stop]
                    for cell in np.flatnonzero(asking.any(axis=1)):
                        inside = first[cell] + np.flatnonzero(candidate[first[cell] : end[cell]])
                        if len(inside):
                            search.visit(some[start + np.flatnonzero(asking[cell])], inside)
            row, column, score = search.best()
            out = [asks["query_key"].to_numpy()[row], ids[column], score]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(x, t) for x, t in zip(out, kinds)], names=["query_key", "kb_id", "score"])

    return run


def score_blocks(visits: DataFrame, blocks: DataFrame, dimension: int, top_k: int) -> DataFrame:
    """(query_key, kb_id, score): the k best of each visited block.

    ``visits`` holds (query_key, candidate_group, embedding, floor, block, cells); ``blocks`` the
    cases (block, kb_id, facet_id, cell, embedding) and the groups of their facets.
    """
    visits = written(visits, "visits")
    most = max(1, ASK_BYTES // (8 * dimension))
    shape = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("parts"))
    asks = visits.join(shape, "block").withColumn("part", F.pmod(F.xxhash64("query_key"), "parts").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    blocks = blocks.join(shape, "block").withColumn("part", every).drop("parts")
    keys = ["block", "part"]
    pairs = asks.drop("parts").groupBy(*keys).cogroup(blocks.groupBy(*keys))
    return pairs.applyInArrow(_scored(dimension, top_k), "query_key long, kb_id long, score double")


def embedding_answers(
    reports: DataFrame | None,
    kb: DataFrame,
    report_vectors: DataFrame,
    kb_vectors: DataFrame,
    top_k: int = 3,
    asked: Asked | None = None,
) -> Answers:
    """The best cases per report by cosine, and the reports that have no answer.

    Cases without a complete vector are no candidates. Complete vectors of cases must have one
    dimension; a report with another one, or with missing values, is listed as unanswered, as
    are reports without a vector and those none of whose candidates has one. ``asked`` must
    come from ``reports``.
    """
    check_top_k(top_k)
    if asked:
        keyed, all_members = asked
    else:
        case_facets = facets(kb)
        matches = written(environment_matches(reports, case_facets), "matches")
        named = written(shared_groups(matches, case_facets), "groups")
        keyed = assign_groups(reports, named)
        all_members = group_facets(first_matches(matches, named), case_facets, keyed)
    cases = with_facet(kb).select("kb_id", "facet_id").join(
        kb_vectors.filter(_complete(F.col("embedding"))).select("kb_id", "embedding"), "kb_id"
    )
    cases = written(cases, "cases")
    size = F.size("embedding")
    count, dimension, largest = cases.agg(F.count(F.lit(1)), F.min(size), F.max(size)).first()
    if dimension != largest:
        raise ValueError(f"case vectors have dimensions from {dimension} to {largest}")
    dimension = dimension or 1

    given = report_vectors.select("report_id", "embedding")
    other = size != dimension if count else F.lit(False)
    reason = F.when(F.col("embedding").isNull(), NO_VECTOR)
    reason = reason.when(~_complete(F.col("embedding")) | other, BAD_VECTOR)
    if not count:
        reason = reason.otherwise(NO_CANDIDATE)
    judged = written(
        keyed.select("report_id", "candidate_group")
        .join(given, "report_id", "left")
        .select("report_id", F.col("report_id").alias("query_key"), "candidate_group", "embedding", reason.alias("reason")),
        "asks",
    )
    asks = judged.filter("reason is null").drop("reason")
    members = written(all_members, "members")

    centres = fitted_centres(cases, count, dimension)
    kind = cases.schema["embedding"].dataType
    schema = f"kb_id long, facet_id binary, embedding {kind.simpleString()}, cell int, angle double"
    located = cases.select("kb_id", "facet_id", "embedding").mapInArrow(_located(centres, dimension), schema)
    located = written(located, "located")
    by_facet = written(
        located.groupBy("facet_id", "cell").agg(
            F.count(F.lit(1)).alias("cases"), F.min("angle").alias("nearest"), F.max("angle").alias("farthest")
        ),
        "facet_cells",
    )
    held = written(
        by_facet.join(members, "facet_id")
        .groupBy("candidate_group", "cell")
        .agg(F.sum("cases").alias("cases"), F.min("nearest").alias("nearest"), F.max("farthest").alias("farthest")),
        "cells",
    )
    with_cases = held.select("candidate_group").distinct()
    without = asks.join(with_cases, "candidate_group", "left_anti")
    unanswered = (
        judged.filter("reason is not null")
        .select("report_id", "reason")
        .unionByName(without.select("report_id", F.lit(NO_CANDIDATE).alias("reason")))
    )

    # as many rows as there are cells, which the sample bounds
    sizes = {r.cell: r.n for r in by_facet.groupBy("cell").agg(F.sum("cases").alias("n")).collect()}
    cells = packed_cells(centres, sizes, max(1, BLOCK_BYTES // (8 * dimension)))
    first_block, parts = (F.array(*[F.lit(int(x)) for x in y]) for y in (cells.first, cells.parts))
    part = F.pmod(F.xxhash64("kb_id"), F.get(parts, F.col("cell")).cast("long"))
    block = (F.get(first_block, F.col("cell")) + part).cast("long").alias("block")
    dealt = located.select(block, "kb_id", "facet_id", "cell", "embedding")
    groups = members.groupBy("facet_id").agg(F.collect_list("candidate_group").alias("groups"))
    of_facets = dealt.select("block", "facet_id").distinct().join(groups, "facet_id")
    blocks = written(
        dealt.unionByName(of_facets, allowMissingColumns=True), "blocks"
    )

    most = max(1, PRODUCT_BYTES // (16 * (len(centres) + 1)))
    meaningful = asks.filter(_has_length("embedding"))
    kind = asks.schema["embedding"].dataType
    shape = meaningful.groupBy("candidate_group").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("parts"))
    shape = written(shape, "ask_parts")

    def visit(asking: DataFrame, first: bool) -> DataFrame:
        asking = asking.join(shape, "candidate_group")
        asking = asking.withColumn("part", F.pmod(F.xxhash64("query_key"), "parts").cast("int")).drop("parts")
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        groups = held.join(shape, "candidate_group").withColumn("part", every).drop("parts")
        keys = ["candidate_group", "part"]
        visits = asking.groupBy(*keys).cogroup(groups.groupBy(*keys)).applyInArrow(
            _visits(cells, dimension, top_k, first),
            f"query_key long, candidate_group string, embedding {kind.simpleString()}, floor double, block long, cells array<int>",
        )
        return score_blocks(visits, blocks, dimension, top_k)

    near = written(visit(meaningful.withColumn("floor", F.lit(float("-inf"))), True), "near")
    floors = (
        best(near, "query_key", "kb_id", top_k)
        .filter(F.col("rank") == top_k)
        .select("query_key", F.col("score").alias("floor"))
    )
    floored = meaningful.join(floors, "query_key", "left").withColumn("floor", F.coalesce("floor", F.lit(-1.0)))
    scored = near.unionByName(visit(floored, False))

    # the zero vector has score 0 with every case
    pointless = asks.filter(~_has_length("embedding")).select("query_key", "candidate_group")
    zeros = pointless.join(first_candidates(located, members, top_k), "candidate_group").select(
        "query_key", "kb_id", F.lit(0.0).alias("score")
    )
    return Answers(ranked_reports(asks, scored.unionByName(zeros), None, top_k), unanswered)


def embedding_topk(
    reports: DataFrame,
    kb: DataFrame,
    report_vectors: DataFrame,
    kb_vectors: DataFrame,
    top_k: int = 3,
) -> DataFrame:
    """(report_id, rank, kb_id, score) by cosine; ``embedding_answers`` lists the reports left out."""
    return embedding_answers(reports, kb, report_vectors, kb_vectors, top_k).matches
