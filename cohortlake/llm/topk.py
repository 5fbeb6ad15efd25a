"""Exact top-k search by inner product: a Voronoi join of queries with the rows they may need.

Rows and queries are grouped by the nearest of a few pivots. Summaries of the groups (radius,
the distances of the k + 1 rows nearest to the pivot) give each group of queries a score that
its k best rows reach at least. A row goes to a group of queries only if its greatest possible
score with a query of that group is not below that. Groups of queries and the rows that go to
them are split into blocks; each pair of blocks is solved in one task, and the best k of the
blocks are merged. All bounds are used with a margin above rounding, and scores are computed
in whole numbers, so the result is that of comparing all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import cut, ship, table

K = 20
PIVOTS = 16
#: Rows, those with the smallest hashes of their id, that pivots are chosen from.
SAMPLE = 2048
#: Components of a block of rows and of a block of queries, on average.
BLOCK_ROWS = 1 << 22
BLOCK_QUERIES = 1 << 18
#: Scores held at a time in a task.
SCORES = 1 << 22
#: Relative margin of bounds; errors of double sums over 10^4 components are below 10^-11.
MARGIN = 1e-9
#: Whole numbers up to here are exact in doubles.
EXACT = float(2**53)
LONG = 2**63 - 1

PLACED = "row long, id long, is_query boolean, vec array<double>, cell int, dist double, norm double"
PIECE = "grp int, part int, block int, row long, id long, vec array<double>"
BEST = "row long, query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    """Neither null nor with null, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def matrix(column: pa.ListArray | pa.ChunkedArray, width: int) -> np.ndarray:
    """One row per list; shorter lists are filled with zeros, which change no inner product."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def spread_out(points: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different points, each the farthest from those before; the first is the nearest to their mean."""
    if not len(points):
        return points[:0]
    with np.errstate(over="ignore", invalid="ignore"):
        gap = np.linalg.norm(points - points.mean(axis=0), axis=1)
        chosen = [int(np.argmin(gap))]
        nearest = np.linalg.norm(points - points[chosen[0]], axis=1)
        while len(chosen) < min(count, len(points)) and np.nanmax(nearest) > 0:
            chosen.append(int(np.nanargmax(nearest)))
            nearest = np.fmin(nearest, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return points[chosen]


def reached(pivots: np.ndarray, query_radius: np.ndarray, nearest: list[np.ndarray], k: int) -> np.ndarray:
    """For each group of queries a score that at least k rows other than the query itself reach with all its queries.

    A row x at distance d from pivot p and a query q within r of pivot s: q.x = s.p + s.(x-p) + (q-s).x
    is at least s.p - |s| d - r (|p| + d).
    """
    size = np.linalg.norm(pivots, axis=1)
    out = np.full(len(pivots), -np.inf)
    for i, r in enumerate(query_radius):
        least = [pivots[i] @ p - size[i] * d - r * (size[j] + d) for j, (p, d) in enumerate(zip(pivots, nearest, strict=True))]
        least = np.concatenate(least)
        least = np.sort(np.where(np.isfinite(least), least, -np.inf))[::-1]
        if len(least) > k:  # the query may be one of the first k + 1
            out[i] = least[k]
    return out


def best_of(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Places of queries, places of rows and scores of each query's k best rows (more on ties), its own id left out.

    ``ids`` ascend. Scores that do not fit exactly into doubles are computed in Python's
    whole numbers; beyond the range of a long they count as its ends.
    """
    at_query, at_row, scores = [], [], []
    bound = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, queries.shape[1])
    exact = bound < EXACT
    if not exact:
        queries = np.array([[int(x) for x in v] for v in queries], dtype=object).reshape(queries.shape)
        rows = np.array([[int(x) for x in v] for v in rows], dtype=object).reshape(rows.shape)
    step = max(1, SCORES // max(1, len(rows)))
    for first in range(0, len(queries), step):
        part = queries[first : first + step] @ rows.T
        if not exact:
            part = np.minimum(np.maximum(part, -LONG - 1), LONG)
        own_ids = query_ids[first : first + step]
        low, high = np.searchsorted(ids, own_ids, "left"), np.searchsorted(ids, own_ids, "right")
        for i in range(len(part)):
            line = part[i]
            other = np.ones(len(line), dtype=bool)
            other[low[i] : high[i]] = False
            place = np.flatnonzero(other)
            line = line[place]
            if len(line) > k:
                if exact:
                    kth = np.partition(line, len(line) - k)[len(line) - k]
                else:
                    kth = sorted(line)[len(line) - k]
                over = np.flatnonzero(line > kth)
                # Of the rows that tie with the last one only those with the smallest ids can count.
                level = np.flatnonzero(line == kth)[: k - len(over)]
                keep = np.concatenate([over, level])
                place, line = place[keep], line[keep]
            at_query.append(np.full(len(place), first + i))
            at_row.append(place)
            scores.extend(map(int, line))
    none = [np.empty(0, dtype=np.int64)]
    return np.concatenate(at_query or none), np.concatenate(at_row or none), scores


def top_k(
    rows: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vector: str = "embedding", scale: float = 1.0,
    pivots: int = PIVOTS, sample: int = SAMPLE, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank`` (int, from 1), ``vec_id``, ``score`` (long): the k best rows of each query row.

    The score is the inner product of the vectors with every component x taken as
    floor(scale * x); ties go to the smaller id. Rows with the query's own id are left out.
    Rows without an id, and vectors that are null or hold null, NaN or infinite components,
    take no part. Of vectors of unequal length the shorter one is filled with zeros. Query
    rows that repeat are answered each. A query with fewer than k other rows gets all of
    them. Columns of the input beside id and vector do not matter. An empty table gives
    no rows.

    ``pivots`` of ``sample`` rows and one summary of k + 1 distances per pivot are all that
    reaches the driver; they say what goes where, not what is compared. Where a bound
    prunes nothing, each group of queries gets all rows, ``pivots`` times the table.
    """
    spark = rows.sparkSession
    ship(spark)
    frame = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_query"), F.col(f"`{vector}`").cast("array<double>").alias("raw"))
    frame = frame.where(F.col("id").isNotNull() & usable(F.col("raw")))
    whole = F.transform("raw", lambda x: _floored(x * F.lit(float(scale))))
    frame = cut(frame.select(F.monotonically_increasing_id().alias("row"), "id", "is_query", whole.alias("vec")).where(usable(F.col("vec"))))
    width = frame.agg(F.max(F.size("vec"))).first()[0] or 0
    drawn = frame.select("id", "vec").orderBy(F.xxhash64("id"), "id", "row").limit(sample).select("vec").toArrow()
    centres = spread_out(matrix(drawn.column("vec"), width), pivots)
    if not len(centres):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    size = np.linalg.norm(centres, axis=1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = matrix(batch.column("vec"), width)
            gaps = np.stack([np.linalg.norm(found - c, axis=1) for c in centres], axis=1)
            cell = gaps.argmin(axis=1)
            columns = [
                *[batch.column(n) for n in ("row", "id", "is_query", "vec")], pa.array(cell, pa.int32()),
                pa.array(gaps[np.arange(len(found)), cell]), pa.array(np.linalg.norm(found, axis=1)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "is_query", "vec", "cell", "dist", "norm"])

    placed = cut(frame.mapInArrow(place, PLACED))
    nearest_first = Window.partitionBy("cell").orderBy("dist")
    near = placed.select("cell", "dist").withColumn("n", F.row_number().over(nearest_first)).where(f"n <= {k + 1}")
    groups = placed.groupBy("cell").agg(F.count("*").alias("n"), F.count_if("is_query").alias("queries"), F.max(F.when(F.col("is_query"), F.col("dist"))).alias("radius"))
    n_rows, radius, queries = 0, np.zeros(len(centres)), np.zeros(len(centres), dtype=np.int64)
    for r in groups.collect():  # one row per pivot
        n_rows += r["n"]
        radius[r["cell"]], queries[r["cell"]] = r["radius"] or 0.0, r["queries"]
    nearest = [[] for _ in centres]
    for r in near.collect():  # k + 1 rows per pivot
        nearest[r["cell"]].append(r["dist"])
    enough = reached(centres, radius, [np.array(d) for d in nearest], k)
    # Scores outside the range of a long count as its ends, so there they are ties.
    enough = np.where(enough <= -float(LONG), -np.inf, np.minimum(enough, float(LONG)))
    parts = np.maximum(1, -(-queries * width // block_queries))
    blocks = max(1, -(-n_rows * width // block_rows))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = matrix(batch.column("vec"), width)
            norm = batch.column("norm").to_numpy()
            block = spread(batch, blocks)
            for i in np.flatnonzero(queries):
                most = found @ centres[i] + radius[i] * norm
                margin = MARGIN * (size[i] + radius[i] + 1) * (norm + 1)
                need = np.flatnonzero(~(most + margin < enough[i] - MARGIN * abs(enough[i])))
                for part in range(parts[i]):
                    yield piece(batch, need, i, np.full(len(need), part), block[need])

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            part = spread(batch, parts[cell])
            for i in np.unique(cell):
                mine = np.flatnonzero(cell == i)
                for block in range(blocks):
                    yield piece(batch, mine, i, part[mine], np.full(len(mine), block))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by([("id", "ascending"), ("row", "ascending")])
        asked, ids = right.column("id").to_numpy(), left.column("id").to_numpy()
        q, x, scores = best_of(matrix(right.column("vec"), width), asked, matrix(left.column("vec"), width), ids, k)
        columns = [pa.array(right.column("row").to_numpy()[q]), pa.array(asked[q]), pa.array(ids[x]), pa.array(scores, pa.int64())]
        return pa.Table.from_arrays(columns, names=["row", "query_id", "vec_id", "score"])

    keys = ["grp", "part", "block"]
    needed = placed.mapInArrow(replicate, PIECE).groupBy(*keys)
    asking = placed.where("is_query").mapInArrow(scatter, PIECE).groupBy(*keys)
    best = needed.cogroup(asking).applyInArrow(solve, BEST)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}")
    return ranked.select("query_id", "rank", "vec_id", "score")


def _floored(x: Column) -> Column:
    """The next whole number below, as a double; doubles from 2^52 on are whole already."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def spread(batch: pa.RecordBatch, over: int | np.ndarray) -> np.ndarray:
    """A number below ``over`` for each row, from its row number."""
    mixed = batch.column("row").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.asarray(over, dtype=np.uint64)).astype(np.int32)


def piece(batch: pa.RecordBatch, at: np.ndarray, group: int, part: np.ndarray, block: np.ndarray) -> pa.RecordBatch:
    taken = batch.take(pa.array(at))
    columns = [pa.array(np.full(len(at), group), pa.int32()), pa.array(part, pa.int32()), pa.array(block, pa.int32()), *[taken.column(n) for n in ("row", "id", "vec")]]
    return pa.RecordBatch.from_arrays(columns, names=["grp", "part", "block", "row", "id", "vec"])


def op13_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, scale=64.0)


OP13_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, x.vec_id, cast(list_sum(list_transform(list_zip(q.v, x.v, true), lambda z: z[1] * z[2])) as bigint) as score
  from whole q join whole x on q.vec_id <> x.vec_id where q.vec_id % 20 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 20
"""
