"""Sums over blocks of rows, for fitting: means with cross products, and nearest centres.

Rows are held as one array column. Each task reduces its rows to one row of sums with numpy;
those are added up by position on Spark, so what reaches the driver has the size of the
model and not of the data or the number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Moments:
    """Number of rows, means, and the centred cross products of all pairs of positions."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray


def block(column: pa.ListArray, width: int) -> np.ndarray:
    """The arrays of a batch as a matrix; all have ``width`` values, none of them null."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def task_rows(df: DataFrame, column: str, width: int, reduce: Callable[[Iterator[np.ndarray]], list[np.ndarray]], names: list[str]) -> DataFrame:
    """One row of arrays per task: what ``reduce`` makes of the task's blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = reduce(block(batch.column(0), width) for batch in batches if batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array([x.ravel().tolist()], pa.list_(pa.float64())) for x in made], names=names)

    return df.select(column).mapInArrow(run, ", ".join(f"{n} array<double>" for n in names))


def added_up(rows: DataFrame, name: str, size: int) -> np.ndarray:
    """The arrays ``name`` of all rows, added by position; ``size`` numbers reach the driver."""
    sums = rows.select(F.posexplode(name).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    out = np.zeros(size)
    for at, v in sums.collect():
        out[at] = v
    return out


def moments(df: DataFrame, column: str, width: int) -> Moments:
    """Counts, means and cross products in one pass over the rows.

    Each task centres its sums on its own mean. They are brought to the common mean by the
    tasks' rows alone, so large means cost no digits.
    """
    def reduce(blocks: Iterator[np.ndarray]) -> list[np.ndarray]:
        n, mean, scatter = 0, np.zeros(width), np.zeros((width, width))
        for x in blocks:
            m = x.mean(axis=0)
            gap, total = m - mean, n + len(x)
            scatter += (x - m).T @ (x - m) + np.outer(gap, gap) * (n * len(x) / total)
            mean = mean + gap * (len(x) / total)
            n = total
        return [np.array([float(n)]), n * mean, mean, scatter]

    ensure_checkpoint_dir(df.sparkSession)
    rows = task_rows(df, column, width, reduce, ["n", "total", "mean", "scatter"]).where("n[0] > 0").checkpoint()
    n = int(added_up(rows, "n", 1)[0])
    if not n:
        return Moments(0, np.zeros(width), np.zeros((width, width)))
    mean = added_up(rows, "total", width) / n
    centre = F.array(*[F.lit(float(m)) for m in mean])
    gaps = rows.select("n", "scatter", F.zip_with("mean", centre, lambda a, b: a - b).alias("gap"))
    outer = F.flatten(F.transform("gap", lambda a: F.transform("gap", lambda b: a * b * F.col("n")[0])))
    whole = gaps.select(F.zip_with("scatter", outer, lambda a, b: a + b).alias("scatter"))
    return Moments(n, mean, added_up(whole, "scatter", width * width).reshape(width, width))


def dot(array: Column, weights: list[float]) -> Column:
    """Inner product of an array column with fixed weights."""
    products = F.zip_with(array, F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def squared_distance(array: Column, centre: list[float]) -> Column:
    gaps = F.zip_with(array, F.array(*[F.lit(float(c)) for c in centre]), lambda a, b: (a - b) * (a - b))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x)


def nearest_centre(array: Column, centres: list[list[float]]) -> Column:
    """Number of the nearest centre, the first one on ties, as a built-in expression."""
    distances = F.array(*[squared_distance(array, c) for c in centres])
    best = F.array_min(F.transform(distances, lambda d, i: F.struct(d.alias("d"), i.alias("i"))))
    return best["i"].cast("int")


def packed(df: DataFrame, column: str, width: int) -> DataFrame:
    """Rows as ``block``, each a batch of arrays as the bytes of a matrix: read many times, they are converted once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([block(batch.column(0), width).tobytes()], pa.binary())], names=["block"])

    return df.select(column).mapInArrow(run, "block binary")


def centre_sums(blocks: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For starts x k centres: sums and counts of the ``packed`` rows nearest to each, and each start's cost. One job."""
    starts, k, width = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((starts, k * (width + 1) + 1))
        for x in (np.frombuffer(b.as_buffer()).reshape(-1, width) for batch in batches for b in batch.column(0)):
            norms = (x * x).sum(axis=1)
            for s in range(starts):
                far = norms[:, None] - 2 * x @ centres[s].T + (centres[s] ** 2).sum(axis=1)
                near = far.argmin(axis=1)
                mine = np.zeros((len(x), k))
                mine[np.arange(len(x)), near] = 1.0
                out[s, : k * width] += (mine.T @ x).ravel()
                out[s, k * width : -1] += mine.sum(axis=0)
                out[s, -1] += ((x - centres[s][near]) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array([out.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

    size = starts * (k * (width + 1) + 1)
    found = added_up(blocks.mapInArrow(run, "sums array<double>"), "sums", size).reshape(starts, -1)
    return found[:, : k * width].reshape(starts, k, width), found[:, k * width : -1], found[:, -1]
