"""Deep random forests grown and applied in the tasks; their nodes are rows of a table.

Rows are binned once, at thresholds taken from all of them, and packed in blocks. A node of many rows is
split by counts that all tasks add up, one job a level; a node of few rows is finished in one task, which
gets the rows that stand there. The driver holds the few upper nodes of a tree and never a forest.
Counts are whole numbers and draws follow from block, tree and node, so no order of rows changes a tree.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .moments import block

BINS = 32  # of a feature, at most
TASK_DRAWS = 250_000  # draws of a node up to which one task finishes it
ROWS_AT_ONCE = 500_000_000  # rows times trees that are grown together: what is sent to tasks for them is on disk at once
TASK_ROWS = 5_000_000  # rows times trees for a task, about, if there are enough nodes to finish
SENT_BYTES = 8_000_000  # of a piece of a forest on its way to the tasks
VOTE_ROWS = 200_000  # rows a task applies a forest to at once
NODE = "tree int, node long, feature int, threshold double, low long, high long, shares array<double>"
_CELLS = 1_000_000  # counts that are looked through at once
_LOCAL_BITS = 32  # a node made in a task is numbered in the lower bits, the upper ones name the node it began at

#: A row's number of draws into a tree's sample, Poisson with mean 1, by a random 16-bit number.
_DRAWS = np.searchsorted(np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 12)])), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


@dataclass(frozen=True)
class Growth:
    """What all trees of a forest have in common."""

    cuts: list[np.ndarray]  # thresholds of each feature
    weight: np.ndarray  # of a row of each class
    depth: int
    seed: int

    @property
    def bins(self) -> int:
        return max(len(c) for c in self.cuts) + 1

    @property
    def tried(self) -> int:
        """Features that a node may be split by: the square root of all."""
        return int(np.ceil(np.sqrt(len(self.cuts))))


@dataclass
class Top:
    """The upper nodes of a tree; ``feature`` is -1 where a node isn't split."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    low: list[int] = field(default_factory=lambda: [-1])
    level: list[int] = field(default_factory=lambda: [0])
    counts: list[np.ndarray | None] = field(default_factory=lambda: [None])  # by class; not known of a root
    many: list[int] = field(default_factory=list)  # to be split by all tasks
    few: list[int] = field(default_factory=list)  # to be finished in one task

    def standing(self, bins: np.ndarray) -> np.ndarray:
        """The node each row stands at."""
        feature, cut, low = (np.array(x) for x in (self.feature, self.cut, self.low))
        return _ends(feature, cut, low, bins)


def _ends(feature: np.ndarray, threshold: np.ndarray, low: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The node each row of ``x`` ends at; a node's children lie side by side."""
    node, going = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(going):
        at = node[going]
        f = feature[at]
        inner = f >= 0
        going, at, f = going[inner], at[inner], f[inner]
        node[going] = low[at] + (x[going, f] > threshold[at])
    return node


# ---- rows ---------------------------------------------------------------------------

def thresholds(rows: DataFrame, features: str, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Values between which each position of the array ``features`` is cut: least value and quantiles of all rows, without the greatest."""
    shares = F.array(*[F.lit(i / bins) for i in range(bins)])
    at = [F.get(features, i) for i in range(width)]
    found = rows.agg(*[F.percentile_approx(x, shares, F.lit(10_000)).alias(f"q{i}") for i, x in enumerate(at)], *[F.max(x).alias(f"m{i}") for i, x in enumerate(at)]).first()
    cuts = [np.unique(found[f"q{i}"] or []) for i in range(width)]
    return [c[c < found[f"m{i}"]] if len(c) else np.zeros(0) for i, c in enumerate(cuts)]


def binned(rows: DataFrame, features: str, label: str, cuts: list[np.ndarray]) -> DataFrame:
    """``block`` (a number) and ``cells``, the bytes of a matrix: bins by feature and the class of each row. Checkpointed, so that block numbers stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(b for b in batches if b.num_rows):
            x = block(batch.column(0), len(cuts))
            cells = np.column_stack([*[np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], batch.column(1).to_numpy()])
            yield pa.RecordBatch.from_arrays([pa.array([first + i], pa.int64()), pa.array([cells.astype(np.uint8).tobytes()], pa.binary())], names=["block", "cells"])

    ensure_checkpoint_dir(rows.sparkSession)
    return rows.select(features, label).mapInArrow(run, "block long, cells binary").checkpoint()


def _drawn(batches: Iterator[pa.RecordBatch], width: int, seed: int, trees: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every block and tree: the rows that were drawn, and how often each."""
    for batch in batches:
        for number, cells in zip(batch.column(0).to_pylist(), batch.column(1)):
            whole = np.frombuffer(cells.as_buffer(), np.uint8).reshape(-1, width + 1)
            for tree in trees:
                draws = _DRAWS[np.random.default_rng([seed, tree, number]).integers(0, 1 << 16, len(whole), np.uint16)]
                yield tree, whole[draws > 0], draws[draws > 0]


# ---- splits -------------------------------------------------------------------------

def counted(bins: np.ndarray, label: np.ndarray, draws: np.ndarray, slot: np.ndarray, tried: np.ndarray, n_bins: int, classes: int) -> np.ndarray:
    """Draws by node, tried feature, bin and class; a row stands at the node numbered ``slot``, whose features are ``tried[slot]``."""
    out = np.empty((len(tried), tried.shape[1], n_bins, classes))
    rows = np.arange(len(bins))
    for j in range(tried.shape[1]):
        at = (slot * n_bins + bins[rows, tried[slot, j]]) * classes + label
        out[:, j] = np.bincount(at, draws, len(tried) * n_bins * classes).reshape(len(tried), n_bins, classes)
    return out


def best_splits(counts: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each node: which tried feature and which bin, the last of the low side, lessen the Gini impurity most, and by how much."""
    low = counts.cumsum(axis=2)
    high = low[:, :, -1:] - low
    total = low[:, 0, -1] * weight
    purity = np.zeros(low.shape[:3])
    for side in (low, high):
        w = side * weight
        purity += np.divide((w * w).sum(axis=3), n := w.sum(axis=3), out=np.zeros(n.shape), where=n > 0)
    gain = purity / total.sum(axis=1)[:, None, None] - ((total * total).sum(axis=1) / total.sum(axis=1) ** 2)[:, None, None]
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    return best // low.shape[2], best % low.shape[2], flat[np.arange(len(flat)), best]


GAIN = 1e-12  # what is less is rounding


def finished(cells: np.ndarray, draws: np.ndarray, growth: Growth, levels: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """A subtree over the given rows: feature (-1: leaf), bin and low child of each node, and draws by class."""
    bins, label, draws = cells[:, :-1], cells[:, -1].astype(np.int64), draws.astype(float)
    classes, width = len(growth.weight), len(growth.cuts)
    slot, open_, first, made = np.zeros(len(bins), np.int64), 1, 0, []
    for level in range(levels + 1):
        stats = np.bincount(slot * classes + label, draws, open_ * classes).reshape(open_, classes)
        feature, cut, low = np.full(open_, -1), np.zeros(open_, np.int64), np.full(open_, -1)
        made.append((feature, cut, low, stats))
        mixed = np.flatnonzero((stats > 0).sum(axis=1) > 1) if level < levels else np.zeros(0, np.int64)
        first += open_
        if not len(mixed):
            break
        place = np.full(open_, -1)
        place[mixed] = np.arange(len(mixed))
        tried = rng.random((len(mixed), width)).argsort(axis=1)[:, : growth.tried]
        # Rows of a node side by side, so that nodes can be looked through some at a time.
        at = place[slot]
        order = np.argsort(at, kind="stable")[np.count_nonzero(at < 0) :]
        bins, label, draws, slot, at = bins[order], label[order], draws[order], slot[order], at[order]
        step = max(1, _CELLS // (growth.bins * classes))
        for a in range(0, len(mixed), step):
            b = min(len(mixed), a + step)
            s, e = np.searchsorted(at, [a, b])
            counts = counted(bins[s:e], label[s:e], draws[s:e], at[s:e] - a, tried[a:b], growth.bins, classes)
            which, bin_, gain = best_splits(counts, growth.weight)
            split = mixed[a:b][gain > GAIN]
            feature[split] = tried[a:b][np.arange(b - a), which][gain > GAIN]
            cut[split] = bin_[gain > GAIN]
        split = np.flatnonzero(feature >= 0)
        if not len(split):
            break
        low[split] = first + 2 * np.arange(len(split))
        going = feature[slot] >= 0
        bins, label, draws, slot = bins[going], label[going], draws[going], slot[going]
        slot = low[slot] - first + (bins[np.arange(len(bins)), feature[slot]] > cut[slot])
        open_ = 2 * len(split)
    return tuple(np.concatenate(x) for x in zip(*made))


# ---- trees --------------------------------------------------------------------------

def _tried_at(growth: Growth, tree: int, node: int) -> np.ndarray:
    return np.random.default_rng([growth.seed, tree, node]).permutation(len(growth.cuts))[: growth.tried]


def _split_by_all(blocks: DataFrame, growth: Growth, tops: dict[int, Top]) -> None:
    """Split the nodes of many rows, of all trees, in one job; a row per node reaches the driver."""
    width, classes = len(growth.cuts), len(growth.weight)
    open_ = {tree: top for tree, top in tops.items() if top.many}
    tried = {tree: np.array([_tried_at(growth, tree, n) for n in top.many]) for tree, top in open_.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for tree, cells, draws in _drawn(batches, width, growth.seed, list(open_)):
            top = open_[tree]
            place = np.full(len(top.feature), -1)
            place[top.many] = np.arange(len(top.many))
            slot = place[top.standing(cells[:, :-1])]
            here = slot >= 0
            new = counted(cells[here, :-1], cells[here, -1], draws[here], slot[here], tried[tree], growth.bins, classes)
            sums[tree] = sums[tree] + new if tree in sums else new
        for tree, x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["tree", "counts"])

    def best(key: tuple, table: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        counts = sum(np.frombuffer(x.as_buffer()) for x in table["counts"]).reshape(len(tried[tree]), growth.tried, growth.bins, classes)
        which, cut, gain = best_splits(counts, growth.weight)
        feature = np.where(gain > GAIN, tried[tree][np.arange(len(which)), which], -1)
        chosen = counts[np.arange(len(which)), which]
        low = np.array([c[: at + 1].sum(axis=0) for c, at in zip(chosen, cut)])
        high = chosen.sum(axis=1) - low
        return pa.table({
            "tree": pa.array([tree] * len(cut), pa.int32()), "node": pa.array(open_[tree].many, pa.int64()),
            "feature": pa.array(feature, pa.int32()), "cut": pa.array(cut, pa.int32()), "low": low.tolist(), "high": high.tolist(),
        })

    counts = blocks.mapInArrow(count, "tree int, counts binary")
    found = counts.groupBy("tree").applyInArrow(best, "tree int, node long, feature int, cut int, low array<double>, high array<double>")
    splits = sorted(found.collect(), key=lambda r: (r["tree"], r["node"]))
    for top in open_.values():
        top.many = []
    for r in splits:
        top, node = tops[r["tree"]], r["node"]
        top.counts[node] = np.add(r["low"], r["high"])
        if r["feature"] < 0:
            continue
        top.feature[node], top.cut[node], top.low[node] = r["feature"], r["cut"], len(top.feature)
        for side in (r["low"], r["high"]):
            _add(top, np.array(side), top.level[node] + 1, growth.depth)


def _add(top: Top, counts: np.ndarray, level: int, depth: int) -> None:
    """A node that a split made: a leaf, or to be finished, or to be split further."""
    if level < depth and (counts > 0).sum() > 1:
        (top.many if counts.sum() > TASK_DRAWS else top.few).append(len(top.feature))
    for values, new in ((top.feature, -1), (top.cut, 0), (top.low, -1), (top.level, level), (top.counts, counts)):
        values.append(new)


def _node_rows(tree: int, ids: np.ndarray, feature: np.ndarray, cut: np.ndarray, low: np.ndarray, counts: np.ndarray, growth: Growth) -> pa.Table:
    """Nodes as rows of the node table; ``low`` is the id of the low child, the high one's is next."""
    inner = feature >= 0
    weighed = counts * growth.weight
    threshold = [float(growth.cuts[f][c]) if f >= 0 else None for f, c in zip(feature.tolist(), cut.tolist())]
    return pa.table({
        "tree": pa.array([tree] * len(ids), pa.int32()), "node": pa.array(ids, pa.int64()),
        "feature": pa.array(feature, pa.int32(), mask=~inner), "threshold": pa.array(threshold, pa.float64()),
        "low": pa.array(np.where(inner, low, -1), pa.int64()), "high": pa.array(np.where(inner, low + 1, -1), pa.int64()),
        "shares": pa.FixedSizeListArray.from_arrays(pa.array((weighed / weighed.sum(axis=1, keepdims=True)).ravel()), counts.shape[1]).cast(pa.list_(pa.float64())),
    })


def _finish(blocks: DataFrame, growth: Growth, tops: dict[int, Top], tasks: int) -> DataFrame:
    """The nodes below those of few rows, and these themselves: each gets its rows and is finished in one task."""
    width = len(growth.cuts)
    few = {tree: set(top.few) for tree, top in tops.items() if top.few}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, cells, draws in _drawn(batches, width, growth.seed, list(few)):
            at = tops[tree].standing(cells[:, :-1])
            order = np.argsort(at, kind="stable")
            ids, begins = np.unique(at[order], return_index=True)
            parts = zip(ids.tolist(), np.split(np.column_stack([cells, draws])[order], begins[1:]))
            wanted = [(n, part.tobytes()) for n, part in parts if n in few[tree]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * len(wanted), pa.int32()), pa.array([n for n, _ in wanted], pa.int64()), pa.array([p for _, p in wanted], pa.binary())], names=["tree", "node", "rows"]
            )

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        tree, node = (k.as_py() for k in key)
        rows = np.concatenate([np.frombuffer(r.as_buffer(), np.uint8).reshape(-1, width + 2) for r in table["rows"]])
        rng = np.random.default_rng([growth.seed, tree, node, 1])
        feature, cut, low, counts = finished(rows[:, :-1], rows[:, -1], growth, growth.depth - tops[tree].level[node], rng)
        base = (node + 1) << _LOCAL_BITS
        ids = base + np.arange(len(feature))
        ids[0] = node
        return _node_rows(tree, ids, feature, cut, base + low, counts, growth)

    sent = blocks.mapInArrow(send, "tree int, node long, rows binary").repartition(tasks, "tree", "node")
    return sent.groupBy("tree", "node").applyInArrow(finish, NODE)


def grow(blocks: DataFrame, n: int, trees: int, growth: Growth, place: str) -> None:
    """Grow ``trees`` trees over the ``n`` rows of ``blocks``; their nodes become a table of Parquet files at ``place``."""
    spark = blocks.sparkSession
    for group in np.array_split(np.arange(trees), min(trees, -(-n * trees // ROWS_AT_ONCE))):
        tops = {int(tree): Top() for tree in group}
        for top in tops.values():
            (top.many if n > TASK_DRAWS and growth.depth else top.few).append(0)
        while any(top.many for top in tops.values()):
            _split_by_all(blocks, growth, tops)
        upper = [_upper(tree, top, growth) for tree, top in tops.items()]
        spark.createDataFrame(pa.concat_tables(upper), NODE).coalesce(1).write.mode("append").parquet(place)
        to_finish = sum(len(top.few) for top in tops.values())
        if to_finish:
            tasks = min(to_finish, max(spark.sparkContext.defaultParallelism, n * len(group) // TASK_ROWS))
            _finish(blocks, growth, tops, tasks).write.mode("append").parquet(place)


def _upper(tree: int, top: Top, growth: Growth) -> pa.Table:
    """The nodes of a tree that no task finishes."""
    ids = np.setdiff1d(np.arange(len(top.feature)), top.few)
    counts = np.array([top.counts[i] for i in ids]).reshape(len(ids), len(growth.weight))
    return _node_rows(tree, ids, *(np.array(x)[ids] for x in (top.feature, top.cut, top.low)), counts, growth)


# ---- votes --------------------------------------------------------------------------

def pack(nodes: DataFrame, place: str) -> None:
    """Write each tree as one row of matrices, as votes read them: nodes by number, children side by side, leaves numbered by ``low``."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        inner = np.array(table["feature"].is_valid())
        low = np.searchsorted(table["node"].to_numpy(), table["low"].to_numpy())
        low[~inner] = np.arange(np.count_nonzero(~inner))
        shares = table["shares"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(inner), -1)[~inner]
        parts = {
            "feature": table["feature"].fill_null(-1).to_numpy().astype(np.int16), "threshold": table["threshold"].fill_null(0.0).to_numpy(),
            "low": low.astype(np.int32), "shares": shares,
        }
        return pa.table({"tree": pa.array([key[0].as_py()], pa.int32()), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in parts.items()}})

    packed = nodes.groupBy("tree").applyInArrow(run, "tree int, feature binary, threshold binary, low binary, shares binary")
    packed.write.mode("overwrite").parquet(place)


def sent(spark: SparkSession, place: str) -> list[Broadcast]:
    """The packed trees at ``place``, sent to the tasks in pieces; the driver holds one piece at a time, the files of all lie on its disk."""
    table = spark.read.parquet(place)
    size = sum((F.octet_length(c) for c in ("feature", "threshold", "low", "shares")), F.lit(0))
    pieces: list[list[int]] = []
    room = 0
    for tree, n in table.select("tree", size).orderBy("tree").collect():  # one number a tree
        if n > room:
            pieces.append([])
            room = SENT_BYTES
        pieces[-1].append(tree)
        room -= n
    return [spark.sparkContext.broadcast(_matrices(table.where(F.col("tree").isin(p)))) for p in pieces]


def _matrices(trees: DataFrame) -> list[tuple[bytes, ...]]:
    whole = trees.select("feature", "threshold", "low", "shares").toArrow()
    return list(zip(*(c.to_pylist() for c in whole.columns)))


def votes(pieces: list[Broadcast], classes: int) -> Callable[[Column], Column]:
    """A function of an array column of features: the shares of the leaves a row ends at, added up over all trees, by class."""
    def of(x: np.ndarray) -> np.ndarray:
        total = np.zeros((len(x), classes))
        for piece in pieces:
            for feature, threshold, low, shares in piece.value:
                low = np.frombuffer(low, np.int32)
                ends = _ends(np.frombuffer(feature, np.int16), np.frombuffer(threshold), low, x)
                total += np.frombuffer(shares).reshape(-1, classes)[low[ends]]
            if len(pieces) > 1:
                vars(piece).pop("_value", None)  # a task holds one piece at a time
        return total

    @F.arrow_udf("array<double>")
    def vote(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept: list[pa.Array] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                kept.append(batch)
            if kept and (batch is None or sum(map(len, kept)) >= VOTE_ROWS):
                x = np.concatenate([b.flatten().to_numpy(zero_copy_only=False) for b in kept])
                found = of(x.reshape(sum(map(len, kept)), -1))
                for part in np.split(found, np.cumsum([len(b) for b in kept])[:-1]):
                    yield pa.FixedSizeListArray.from_arrays(pa.array(part.ravel()), classes).cast(pa.list_(pa.float64()))
                kept = []

    return vote
