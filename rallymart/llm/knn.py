"""Exact top-k by inner product as a Voronoi kNN join.

With a component more, sqrt(M - |x|^2) for data and 0 for queries (M the largest squared length), the
highest inner product is the smallest distance. Data and queries belong to the cell of their
nearest pivot. Each cell sums up as its number of rows, and the smallest distances of its data
from its pivot; with the triangle inequality they bound how far the k-th neighbour of any query
of a cell can be. Query cells near each other form groups of some `BLOCK` queries, and a data row is
only sent to the groups with a cell for which it can lie within that bound, once to each. Groups are
cut into blocks of queries and chunks of the data they need, so no task gets a whole hot cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import arrow_pass, sent, stage

K = 5
#: Queries for each pivot, and pivots at most; rows that pivots are chosen from.
QUERIES_PER_PIVOT, MOST_PIVOTS, PIVOT_SAMPLE = 128, 64, 1024
#: Queries in a block and data rows in a chunk, about.
BLOCK, CHUNK = 2048, 4096
#: Whole numbers up to here are exact in floating point.
EXACT = 2.0**53


def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id, x = floor(256 * component) and its squared length, of vectors that are whole."""

    def work():
        def each(batch: pa.RecordBatch) -> dict:
            out = {"vec_id": [], "x": [], "square": []}
            for vec_id, value in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
                if value is None or None in value:
                    continue
                x = np.floor(256 * np.array(value, "float64"))
                if np.isfinite(x).all():
                    out["vec_id"].append(vec_id)
                    out["x"].append(x)
                    out["square"].append(float(x @ x))
            return out

        return each

    source = vectors.select(F.col("vec_id").cast("long"), "embedding")
    return arrow_pass(source, work, "vec_id long, x array<double>, square double")


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The lists as rows; what a shorter one lacks is 0."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


@dataclass
class Cells:
    """Pivots with the component more, and what is known of their cells."""

    width: int
    largest: float  # the largest squared length
    pivots: np.ndarray
    reach: np.ndarray | None = None  # of a query cell: how far from its pivot a neighbour can be
    groups: list[np.ndarray] | None = None  # of query cells
    blocks: np.ndarray | None = None  # of each group
    chunks: np.ndarray | None = None

    def needed(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """For each group the data rows that its queries may need."""
        from_all = self.distances(x, False)
        for cells in self.groups:
            yield np.flatnonzero((from_all[:, cells] <= self.reach[cells]).any(axis=1))

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.largest - (x * x).sum(axis=1)))
        return np.column_stack([x, more])

    def distances(self, x: np.ndarray, query: bool) -> np.ndarray:
        """From each row to each pivot."""
        lifted = self.lifted(x, query)
        square = (lifted**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(0, square))


def _pivots(sample: np.ndarray, number: int) -> np.ndarray:
    """Rows far from each other: each is the farthest from those before."""
    chosen = [0]
    nearest = np.full(len(sample), np.inf)
    while len(chosen) < min(number, len(sample)):
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
        if nearest.max() == 0:
            break
        chosen.append(int(nearest.argmax()))
    return sample[chosen]


def _summaries(rows: DataFrame, cells: Cells, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """For each cell: data rows, queries, the farthest query, and the k + 1 nearest data rows with different vec_ids.

    Each task sends one row for each cell it has met.
    """
    shared = sent(rows.sparkSession, cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared()
        n = len(cells.pivots)
        data, queries, far = np.zeros(n, int), np.zeros(n, int), np.zeros(n)
        near, names = [np.zeros(0)] * n, [np.zeros(0, "int64")] * n
        for batch in batches:
            x = matrix(batch.column("x"), cells.width)
            ids = batch.column("vec_id").to_numpy()
            asked = batch.column("is_query").to_numpy(zero_copy_only=False)
            from_all = cells.distances(x, False)
            cell, nearest = from_all.argmin(axis=1), from_all.min(axis=1)
            data += np.bincount(cell, minlength=n)
            for c in np.unique(cell):
                near[c], names[c] = _nearest(
                    np.append(near[c], nearest[cell == c]), np.append(names[c], ids[cell == c]), k + 1
                )
            if asked.any():
                from_all = cells.distances(x[asked], True)
                cell, nearest = from_all.argmin(axis=1), from_all.min(axis=1)
                queries += np.bincount(cell, minlength=n)
                np.maximum.at(far, cell, nearest)
        met = np.flatnonzero(data + queries)
        yield pa.record_batch(
            {
                "cell": pa.array(met, pa.int32()),
                "data": pa.array(data[met], pa.int64()),
                "queries": pa.array(queries[met], pa.int64()),
                "far": pa.array(far[met]),
                "near": pa.array([near[c] for c in met], pa.list_(pa.float64())),
                "names": pa.array([names[c] for c in met], pa.list_(pa.int64())),
            }
        )

    schema = "cell int, data long, queries long, far double, near array<double>, names array<long>"
    sums = stage(rows.mapInArrow(run, schema), "summaries")
    found = sums.groupBy("cell").agg(
        F.sum("data").alias("data"), F.sum("queries").alias("queries"), F.max("far").alias("far")
    )
    listed = sums.select("cell", F.inline(F.arrays_zip("near", "names")))
    least = listed.groupBy("cell", "names").agg(F.min("near").alias("near"))
    place = F.row_number().over(Window.partitionBy("cell").orderBy("near", "names"))
    least = least.withColumn("place", place).where(F.col("place") <= k + 1)
    n = len(cells.pivots)
    data, queries, far, near = np.zeros(n, int), np.zeros(n, int), np.zeros(n), [[] for _ in range(n)]
    for r in found.collect():  # a row for each pivot
        data[r.cell], queries[r.cell], far[r.cell] = r.data, r.queries, r.far
    for r in least.collect():  # k + 1 rows for each pivot
        near[r.cell].append((r.near, r.names))
    return data, queries, far, near


def _nearest(distances: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest distances of different ids, in order, and their ids."""
    order = np.argsort(distances, kind="stable")
    first = np.sort(np.unique(ids[order], return_index=True)[1])[:most]
    return distances[order][first], ids[order][first]


def _long(row: np.ndarray, other: list[int]) -> int:
    exact = sum(int(a) * b for a, b in zip(row, other, strict=True))
    return max(-(2**63), min(2**63 - 1, exact))


def _solve(group: pa.Table, width: int, k: int) -> pa.Table:
    """The k best data rows of a chunk for each query of a block."""
    group = group.combine_chunks()
    x = matrix(group.column("x").combine_chunks(), width)
    asked = group.column("as_query").to_numpy()
    ids = group.column("vec_id").to_numpy()
    q, d, q_ids, d_ids = x[asked], x[~asked], ids[asked], ids[~asked]
    marks = group.column("mark").to_numpy()[asked]
    once = np.unique(np.stack([q_ids, marks]), axis=1, return_index=True)[1]
    q, q_ids, marks = q[once], q_ids[once], marks[once]
    out: list[tuple[np.ndarray, ...]] = []
    if len(q) and len(d):
        bound = np.sqrt((q * q).sum(axis=1).max()) * np.sqrt((d * d).sum(axis=1).max())
        if bound < EXACT:
            scores = (q @ d.T).astype("int64")
        else:  # very large components: exact whole numbers, kept within what a long can hold
            whole = [[int(v) for v in row] for row in d]
            scores = np.array([[_long(row, other) for other in whole] for row in q], "int64")
        for i in range(len(q)):
            can = np.flatnonzero(d_ids != q_ids[i])
            if len(can) > k:
                own = scores[i, can]
                can = can[own >= np.partition(own, len(own) - k)[len(own) - k]]
            # The bitwise complement turns the order round and, unlike the negative, can't overflow.
            best = can[np.lexsort((d_ids[can], ~scores[i, can]))][:k]
            out.append((np.full(len(best), q_ids[i]), np.full(len(best), marks[i]), d_ids[best], scores[i, best]))
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, "int64")] * 4
    return pa.Table.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], names=["query_id", "mark", "vec_id", "score"]
    )


def _groups(queries: np.ndarray, between: np.ndarray, most: int) -> list[np.ndarray]:
    """The cells with queries, in groups of about `most` queries; each cell follows a near one."""
    left = list(np.flatnonzero(queries))
    groups: list[list[int]] = []
    last, held = None, 0
    while left:
        cell = left[0] if last is None else min(left, key=lambda c: between[last, c])
        left.remove(cell)
        if not groups or held + queries[cell] > most:
            groups.append([])
            held = 0
        groups[-1].append(cell)
        last, held = cell, held + queries[cell]
    return [np.array(g) for g in groups]


def _needed(rows: DataFrame, cells: Cells) -> np.ndarray:
    """How many data rows each group may need."""
    shared = sent(rows.sparkSession, cells)

    def work():
        cells = shared()

        def each(batch: pa.RecordBatch) -> dict:
            needed = [len(n) for n in cells.needed(matrix(batch.column("x"), cells.width))]
            return {"group": np.arange(len(needed)), "n": needed}

        return each

    found = arrow_pass(rows.select("x"), work, "group int, n long").groupBy("group").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(cells.groups), int)
    for r in found.collect():  # a row for each group
        counts[r.group] = r.n
    return counts


DEALT = "vec_id long, x array<double>, mark long, group int, block int, chunk int, as_query boolean"


def _places(batch: pa.RecordBatch, take: list, group: list, block: list, chunk: list, as_query: bool) -> dict:
    empty = [np.zeros(0, int)]
    rows = pa.array(np.concatenate(take or empty).astype("int64"))
    return {
        **{c: batch.column(c).take(rows) for c in ("vec_id", "x", "mark")},
        "group": np.concatenate(group or empty),
        "block": np.concatenate(block or empty),
        "chunk": np.concatenate(chunk or empty),
        "as_query": np.full(len(rows), as_query),
    }


def _dealt_data(rows: DataFrame, cells: Cells) -> DataFrame:
    """Each data row in a chunk of every block that may need it.

    Chunks go by the row's place in its file, so rows that are equal in all columns spread as well.
    """
    shared = sent(rows.sparkSession, cells)

    def work():
        cells, seen = shared(), 0
        part = TaskContext.get().partitionId()

        def each(batch: pa.RecordBatch) -> dict:
            nonlocal seen
            place = np.arange(seen, seen + batch.num_rows).astype("uint64") + (np.uint64(part) << np.uint64(40))
            seen += batch.num_rows
            spread = (place * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            take, group, block, chunk = [], [], [], []
            for g, needed in enumerate(cells.needed(matrix(batch.column("x"), cells.width))):
                for b in range(cells.blocks[g]):
                    take.append(needed)
                    group.append(np.full(len(needed), g))
                    block.append(np.full(len(needed), b))
                    chunk.append((spread[needed] % np.uint64(cells.chunks[g])).astype("int64"))
            return _places(batch, take, group, block, chunk, False)

        return each

    return arrow_pass(rows, work, DEALT)


def _dealt_queries(rows: DataFrame, cells: Cells) -> DataFrame:
    """Each query in one block of its group, beside every chunk of the data that the group needs."""
    shared = sent(rows.sparkSession, cells)

    def work():
        cells = shared()
        group_of = np.zeros(len(cells.pivots), int)
        for g, own in enumerate(cells.groups):
            group_of[own] = g

        def each(batch: pa.RecordBatch) -> dict:
            if not batch.num_rows:
                return _places(batch, [], [], [], [], True)
            at = group_of[cells.distances(matrix(batch.column("x"), cells.width), True).argmin(axis=1)]
            spread = (batch.column("mark").to_numpy().astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            take, group, block, chunk = [], [], [], []
            for g in np.unique(at):
                mine = np.flatnonzero(at == g)
                for c in range(cells.chunks[g]):
                    take.append(mine)
                    group.append(np.full(len(mine), g))
                    block.append((spread[mine] % np.uint64(cells.blocks[g])).astype("int64"))
                    chunk.append(np.full(len(mine), c))
            return _places(batch, take, group, block, chunk, True)

        return each

    return arrow_pass(rows, work, DEALT)


def top_k(vectors: DataFrame, k: int = K, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score: for rows with vec_id divisible by `every` the best k others.

    Score is the inner product of floor(256 * component); of equal scores the smaller vec_id
    counts. Vectors that are null, have null or non-finite components or a null vec_id take no
    part; of vectors of different lengths the shorter one is filled with zeros. Rows with the
    query's vec_id are its own; equal query rows count once; repeated data rows count each. Scores
    beyond a long are cut to its range. Fewer candidates give fewer rows, an empty table none.
    """
    spark = vectors.sparkSession
    rows = scaled(vectors).where("vec_id IS NOT NULL").withColumn("is_query", F.col("vec_id") % every == 0)
    rows = stage(rows, "vectors")
    total = rows.agg(
        F.max("square").alias("largest"), F.max(F.size("x")).alias("width"), F.count_if("is_query").alias("n")
    ).first()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("x").collect()
    width = total.width or 0
    cells = Cells(width, total.largest or 0.0, np.zeros((1, width + 1)))
    if sample:
        known = np.zeros((len(sample), width))
        for i, r in enumerate(sample):
            known[i, : len(r.x)] = r.x
        number = min(MOST_PIVOTS, math.ceil(max(1, total.n) / QUERIES_PER_PIVOT))
        cells.pivots = _pivots(cells.lifted(known, False), number)
    data, queries, far, near = _summaries(rows, cells, k)
    between = np.sqrt(((cells.pivots[:, None] - cells.pivots[None]) ** 2).sum(axis=2))
    n = len(cells.pivots)
    cells.reach = np.full(n, np.inf)
    for i in range(n):
        listed = [(far[i] + between[i, j] + d, name) for j in range(n) for d, name in near[j]]
        upper, _ = _nearest(np.array([d for d, _ in listed]), np.array([name for _, name in listed], "int64"), k + 1)
        # One of k + 1 vec_ids may be the query's own. The slack is far above rounding errors.
        if len(upper) > k:
            cells.reach[i] = (upper[k] + far[i]) * (1 + 1e-9) + 1e-3
    cells.groups = _groups(queries, between, BLOCK)
    asked = np.array([queries[g].sum() for g in cells.groups], int)
    cells.blocks = np.maximum(1, -(-asked // BLOCK))
    cells.chunks = np.maximum(1, -(-_needed(rows, cells) // CHUNK))
    marked = rows.withColumn("mark", F.xxhash64("x"))
    dealt = _dealt_data(marked, cells).union(
        _dealt_queries(marked.where("is_query").dropDuplicates(["vec_id", "mark"]), cells)
    )
    found = dealt.groupBy("group", "block", "chunk").applyInArrow(
        lambda group: _solve(group, width, k), "query_id long, mark long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
