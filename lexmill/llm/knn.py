"""Exact top-k search by inner product, as a Voronoi join.

One more coordinate, sqrt(M^2 - |x|^2) with M the longest vector's length, turns inner product into
distance: the best k of a query are its k nearest. Pivots, a bounded sample, cut the space into
cells. Summaries of the cells (radius, and the k smallest distances to the pivot) bound how far away
the k-th neighbour of any query of a cell can be; a vector goes only to groups of query cells that
it could serve by the triangle inequality. Groups and blocks of vectors meet in bounded tasks, which
compare exactly in integers and keep k for each query, and the blocks' bests are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.texts import bounded_sample
from lexmill.session import materialize

MAX_GROUPS = 1024
COLUMNS_AT_ONCE = 4096
QUERIES_AT_ONCE = 1024


def usable(vector: Column) -> Column:
    """Not null, and no component null or not finite."""
    def finite(x):
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def to_integers(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of float64; shorter ones are filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy()
    return out


@dataclass(frozen=True)
class Cells:
    """Pivots with one more coordinate, and the squared length of the longest vector."""

    pivots: np.ndarray
    longest: float

    @property
    def width(self) -> int:
        return self.pivots.shape[1] - 1

    def lift(self, x: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Points of the extended space; the further coordinate of a query is 0."""
        rest = np.sqrt(np.maximum(self.longest - (x * x).sum(axis=1), 0))
        return np.concatenate((x, np.where(query, 0, rest)[:, None]), axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and distance to its pivot."""
        square = (points * points).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * points @ self.pivots.T
        cell = square.argmin(axis=1)
        return cell, np.sqrt(((points - self.pivots[cell]) ** 2).sum(axis=1))


def _in_cells(vectors: DataFrame, cells: Cells, is_query: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), cells.width)
            cell, d = cells.nearest(cells.lift(x, np.full(len(x), is_query)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(d)], ["id", "v", "cell", "d"]
            )

    return vectors.mapInArrow(run, "id long, v array<long>, cell int, d double")


def limits(pivots: np.ndarray, radius: np.ndarray, nearest: np.ndarray, inner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For query cell i and cell j: the span of distances to pivot j that a neighbour can have.

    `radius[i]` is the farthest query's distance, `nearest[j]` holds the smallest distances of cell
    j (infinite where there are fewer). A query is no candidate of its own, so one more vector than
    k is counted. A little slack covers rounding.
    """
    between = np.sqrt(np.maximum(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2), 0))
    reach = (radius[:, None, None] + between[:, :, None] + nearest[None, :, :]).reshape(len(pivots), -1)
    bound = np.sort(reach, axis=1)[:, k] if reach.shape[1] > k else np.full(len(pivots), np.inf)
    slack = 1e-6 * (1 + between.max(initial=0) + np.where(np.isfinite(bound), bound, 0))
    away = radius + bound + slack
    return np.where(inner[:, None], between - away[:, None], np.inf), np.where(inner[:, None], between + away[:, None], -np.inf)


def group_cells(between: np.ndarray, counts: np.ndarray, groups: int) -> np.ndarray:
    """Group of each query cell: runs of a nearest-neighbour chain with near-equal query counts."""
    left, order = set(np.flatnonzero(counts).tolist()), []
    while left:
        nxt = min(left) if not order else min(left, key=lambda c: (between[order[-1], c], c))
        order.append(nxt)
        left.remove(nxt)
    out = np.full(len(counts), -1)
    done, total, g = 0, max(int(counts.sum()), 1), -1
    for c in order:
        if g < 0 or done * groups >= total * (g + 1):
            g += 1
        out[c] = g
        done += int(counts[c])
    return out


def best(qid, q, cid, c, k: int, exact: bool):
    """Best k for each query among candidates sorted by id: (query row, candidate row, score)."""
    found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    if not exact:
        q, c = q.astype(np.int64), c.astype(np.int64)
    kth = np.full(len(q), -np.inf)
    for at in range(0, len(c), COLUMNS_AT_ONCE):
        block, ids = c[at : at + COLUMNS_AT_ONCE], cid[at : at + COLUMNS_AT_ONCE]
        score = (q @ block.T).astype(np.float64) if exact else q @ block.T
        own = qid[:, None] == ids[None, :]
        floor = kth
        if score.shape[1] > k + 1:  # own row included, the k-th best of the block is among k + 1
            floor = np.maximum(kth, np.partition(score, score.shape[1] - k - 1, axis=1)[:, score.shape[1] - k - 1])
        row, col = np.nonzero((score >= floor[:, None]) & ~own)
        found = [np.concatenate((a, b)) for a, b in zip(found, (row, col + at, score[row, col]), strict=True)]
        order = np.lexsort((found[1], -found[2], found[0]))  # candidates ascend by id
        found = [x[order] for x in found]
        first = np.searchsorted(found[0], np.arange(len(q)))
        keep = np.arange(len(found[0])) - first[found[0]] < k
        found = [x[keep] for x in found]
        size = np.bincount(found[0], minlength=len(q))
        last = np.searchsorted(found[0], np.arange(len(q)), side="right") - 1
        full = size >= k
        kth = np.full(len(q), -np.inf)
        kth[full] = found[2][last[full]]
    return found


def top_k(
    rows: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
    pivots: int = 64,
    queries_per_task: int = 2048,
    vectors_per_task: int = 20_000,
) -> DataFrame:
    """Each query's k best by inner product of floor(scale * x): query_id, rank, vec_id, score.

    Candidates are all rows but those with the query's own id; all of them if fewer than k, ties to
    the smaller id. Rows whose id or vector is null, or whose vector holds a null or non-finite
    component, take no part. A shorter vector counts as filled up with zeros. A query id that occurs
    on several rows is asked once, with the smallest of its vectors; repeated candidates are
    candidates each. An empty table gives no rows. The bounds prune where the data has clusters; where it has none, every group
    of queries sees every vector, block by block.
    """
    spark = rows.sparkSession
    valid = rows.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), to_integers(F.col(vector_col), scale).alias("v"), is_query.alias("asks")
    )
    valid = materialize(valid, "vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = valid.agg(
        F.max(squares).alias("longest"), F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n"),
        F.count_if("asks").alias("asking"),
    ).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not facts["asking"] or not facts["n"]:
        return empty
    width, longest = max(facts["width"], 1), facts["longest"]
    exact = longest < 2**52  # inner products are below the largest squared length
    sample = bounded_sample(valid.select("v"), F.col("v"), pivots).collect()
    sample = sample or valid.select("v").limit(1).collect()
    points = np.array([r["v"] + [0] * (width - len(r["v"])) for r in sample], np.float64).reshape(len(sample), width)
    cells = Cells(np.zeros((0, width + 1)), longest)
    cells = Cells(cells.lift(points, np.zeros(len(points), bool)), longest)

    data = materialize(_in_cells(valid.select("id", "v"), cells, False), "cells")
    asked = valid.where("asks").groupBy("id").agg(F.min("v").alias("v"))
    queries = materialize(_in_cells(asked, cells, True), "query-cells")
    near = Window.partitionBy("cell").orderBy("d")
    # Bounded: k + 1 numbers and a few more for each pivot.
    closest = data.select("cell", "d").withColumn("nth", F.row_number().over(near)).where(F.col("nth") <= k + 1).collect()
    summary = queries.groupBy("cell").agg(F.max("d").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    n_cells = len(points)
    nearest = np.full((n_cells, k + 1), np.inf)
    for r in closest:
        nearest[r["cell"], r["nth"] - 1] = r["d"]
    radius, counts = np.zeros(n_cells), np.zeros(n_cells, np.int64)
    for r in summary:
        radius[r["cell"]], counts[r["cell"]] = r["radius"], r["n"]
    low, high = limits(cells.pivots, radius, nearest, counts > 0, k)

    between = np.sqrt(np.maximum(((cells.pivots[:, None] - cells.pivots[None]) ** 2).sum(axis=2), 0))
    wanted = int(min(MAX_GROUPS, max(1, -(-facts["asking"] // queries_per_task))))
    group = group_cells(between, counts, wanted)
    n_groups = int(group.max()) + 1
    # A group's span is the widest of its cells; a group with many queries is cut into parts.
    low = np.array([low[group == g].min(axis=0) for g in range(n_groups)])
    high = np.array([high[group == g].max(axis=0) for g in range(n_groups)])
    parts = np.array([-(-int(counts[group == g].sum()) // (2 * queries_per_task)) for g in range(n_groups)])
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    blocks = int(max(-(-facts["n"] // vectors_per_task), -(-tasks // int(parts.sum()))))

    def to_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, d = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for g in range(n_groups):
                needed = np.flatnonzero((d >= low[g][cell]) & (d <= high[g][cell]))
                some = batch.take(pa.array(needed))
                for part in range(parts[g]):
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0), some.column(1), pa.array(np.full(len(needed), g, np.int32)), pa.array(np.full(len(needed), part, np.int32))],
                        ["id", "v", "g", "part"],
                    )

    sent = data.mapInArrow(to_groups, "id long, v array<long>, g int, part int")
    sent = sent.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    group_of = F.get(F.array(*[F.lit(int(g)) for g in group]), F.col("cell"))
    parts_of = F.get(F.array(*[F.lit(int(p)) for p in parts]), F.col("g"))
    asking = queries.select("id", "v", group_of.alias("g")).withColumn("part", F.pmod(F.xxhash64("id"), parts_of).cast("int"))
    asking = asking.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        cid = right.column("id").to_numpy()
        order = np.argsort(cid, kind="stable")
        cid, c = cid[order], _rows(right, width)[order]
        all_ids, all_q = left.column("id").to_numpy(), _rows(left, width)
        out = [[], [], []]
        for at in range(0, len(all_ids), QUERIES_AT_ONCE):
            qid = all_ids[at : at + QUERIES_AT_ONCE]
            row, col, score = best(qid, all_q[at : at + QUERIES_AT_ONCE], cid, c, k, exact)
            for x, part in zip(out, (qid[row], cid[col], score.astype(np.int64)), strict=True):
                x.append(part)
        columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        return pa.table([pa.array(x) for x in columns], names=["query_id", "vec_id", "score"])

    keys = ["g", "part", "block"]
    local = asking.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _rows(table: pa.Table, width: int) -> np.ndarray:
    column = table.column("v")
    return matrix(column.chunk(0) if column.num_chunks else pa.array([], pa.list_(pa.int64())), width)
