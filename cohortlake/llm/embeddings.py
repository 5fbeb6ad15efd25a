"""Near-duplicate embeddings by a hierarchical navigable small-world graph per shard.

Vectors with the same label are dealt into shards; each shard gets a graph, and every
vector of the label queries every shard with a beam. A beam that comes back full of links
is widened, up to the whole shard, so a large group of copies is found whole. Then some
queries of each block are held against all vectors of the shard; if a link was missed, the
beams of the whole block are widened and it is searched again. Cosines are confirmed in
double precision, links are counted, and of each block's links a spanning forest goes on
to the components.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm.common import components, cut, ship, table
from cohortlake.llm.simhash import forest
from cohortlake.operators.skew import join_one_per_key

COSINE = 0.98
#: Vectors in a shard on average at most; numbers in a block of queries.
SHARD, BLOCK_NUMBERS = 8192, 1 << 21
#: Neighbours of a vector above the ground level (twice as many there), beam while building, first beam of a query.
NEIGHBOURS, BUILD_BEAM, BEAM = 12, 64, 48
#: Vectors added, or searched for, at a time; expanded at a time in each beam.
BATCH, EXPAND = 256, 3
#: Queries of each block that are audited, and the share of them of which every link must have been found.
AUDITED, RECALL = 512, 1.0


class Graph:
    """Layers of neighbour lists over unit vectors; batches are added, and searched for, together."""

    def __init__(self, vectors: np.ndarray, seed: int = 2):
        self.vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        n = len(vectors)
        chance = np.random.default_rng(seed).random(n)
        levels = np.minimum(8, (-np.log(np.maximum(chance, 1e-12)) / np.log(NEIGHBOURS)).astype(int))
        # The highest vectors come first, so the entry point and the coarse layers exist from the start.
        self.order = np.argsort(-levels, kind="stable")
        self.levels = levels
        self.top = int(levels.max()) if n else 0
        self.lists = [np.full((n, NEIGHBOURS * (2 if k == 0 else 1)), -1, dtype=np.int32) for k in range(self.top + 1)]
        at = 0
        while at < n:
            self._add(self.order[at : at + max(1, min(BATCH, at))])
            at += max(1, min(BATCH, at))
        if n:
            self._reach_all()

    def _reach_all(self) -> None:
        """Give vectors that no list leads to from the entry point a place in a list near them."""
        lists, n = self.lists[0], len(self.vectors)
        spare = np.zeros(n, dtype=int)
        extra = np.full((n, NEIGHBOURS), -1, dtype=np.int32)
        reached = np.zeros(n, dtype=bool)
        new = np.array([self.order[0]])
        while len(new):
            while len(new):  # all that can be walked to
                reached[new] = True
                near = np.concatenate([lists[new], extra[new]], axis=1).ravel()
                near = np.unique(near[near >= 0])
                new = near[~reached[near]]
            lost = np.flatnonzero(~reached)
            if not len(lost):
                break
            # Of each part that is cut off at least one vector is hung on: its nearest reached one with room takes it.
            u = int(lost[0])
            room = np.flatnonzero(reached & (spare < NEIGHBOURS))
            v = int(room[np.argmax(self.vectors[room] @ self.vectors[u])])
            extra[v, spare[v]] = u
            spare[v] += 1
            new = np.array([u])
        used = int(spare.max())
        self.lists[0] = np.concatenate([lists, extra[:, :used]], axis=1) if used else lists

    def _chosen(self, own: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
        """Of candidates sorted by similarity: first those nearer to the vector than to any chosen one, then the nearest."""
        c = self.vectors[np.maximum(ids, 0)]
        between = np.einsum("bid,bjd->bij", c, c)
        chosen = np.zeros(ids.shape, dtype=bool)
        shadow = np.full(ids.shape, -2.0, dtype=np.float32)  # nearest chosen one
        for k in range(ids.shape[1]):
            take = (ids[:, k] >= 0) & (sims[:, k] > shadow[:, k]) & (chosen.sum(1) < keep - keep // 3)
            chosen[:, k] = take
            shadow = np.where(take[:, None], np.maximum(shadow, between[:, k, :]), shadow)
        rank = np.where(ids < 0, 2 * ids.shape[1] + np.arange(ids.shape[1]), np.where(chosen, 0, ids.shape[1]) + np.arange(ids.shape[1]))
        best = np.argsort(rank, axis=1, kind="stable")[:, :keep]
        return np.take_along_axis(ids, best, 1)

    def _add(self, new: np.ndarray) -> None:
        queries = self.vectors[new]
        if new[0] == self.order[0]:
            return  # the entry point has no neighbours yet
        entry = np.full(len(new), self.order[0])
        for level in range(self.top, -1, -1):
            mine = self.levels[new] >= level
            ids, sims = self._beam(queries, entry, level, BUILD_BEAM if mine.any() else 1)
            entry = ids[:, 0]
            if not mine.any():
                continue
            own, ids, sims = new[mine], ids[mine], sims[mine]
            # Members of the batch may be each other's neighbours.
            with_each = queries[mine] @ queries[mine].T
            np.fill_diagonal(with_each, -2)
            near = np.argsort(-with_each, axis=1)[:, : self.lists[level].shape[1]]
            ids = np.concatenate([ids, own[near]], axis=1)
            sims = np.concatenate([sims, np.take_along_axis(with_each, near, 1)], axis=1)
            ids[sims <= -2] = -1
            self._connect(own, ids, sims, level)

    def _connect(self, own: np.ndarray, ids: np.ndarray, sims: np.ndarray, level: int) -> None:
        lists = self.lists[level]
        width = lists.shape[1]
        by = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, by, 1), np.take_along_axis(sims, by, 1)
        picked = self._chosen(own, ids, sims, width)
        lists[own, : picked.shape[1]] = picked
        # And back: each neighbour chooses again among its list and those that point to it.
        src, dst = np.repeat(own, picked.shape[1]), picked.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        if not len(src):
            return
        sim = np.einsum("nd,nd->n", self.vectors[src], self.vectors[dst])
        by = np.lexsort((-sim, dst))
        src, dst = src[by], dst[by]
        nodes, first = np.unique(dst, return_index=True)
        place = np.arange(len(dst)) - np.repeat(first, np.diff([*first, len(dst)]))
        come = np.full((len(nodes), width), -1, dtype=np.int32)
        fits = place < width
        come[np.searchsorted(nodes, dst[fits]), place[fits]] = src[fits]
        for at in range(0, len(nodes), BATCH):
            part = nodes[at : at + BATCH]
            both = np.concatenate([lists[part], come[at : at + BATCH]], axis=1)
            both = np.sort(both, axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            s = np.einsum("bd,bkd->bk", self.vectors[part], self.vectors[np.maximum(both, 0)])
            s[both < 0] = -2
            order = np.argsort(-s, axis=1, kind="stable")
            both, s = np.take_along_axis(both, order, 1), np.take_along_axis(s, order, 1)
            lists[part] = self._chosen(part, both, s, width)

    def _beam(self, queries: np.ndarray, entry: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best found from each entry on one layer, best first; -1 where there are fewer."""
        n, lists = len(queries), self.lists[level]
        seen = np.zeros((n, len(self.vectors)), dtype=bool)
        ids = np.full((n, beam), -1, dtype=np.int32)
        sims = np.full((n, beam), -2, dtype=np.float32)
        done = np.ones((n, beam), dtype=bool)
        rows = np.arange(n)
        ids[:, 0], sims[:, 0], done[:, 0] = entry, np.einsum("bd,bd->b", queries, self.vectors[entry]), False
        seen[rows, entry] = True
        active = rows
        while len(active):
            a_ids, a_sims, a_done = ids[active], sims[active], done[active]
            # Beams are sorted, so the first ones not yet expanded are the best.
            order = np.argsort(a_done, axis=1, kind="stable")[:, :EXPAND]
            here = ~np.take_along_axis(a_done, order, 1)
            np.put_along_axis(a_done, order, True, 1)
            near = lists[np.where(here, np.take_along_axis(a_ids, order, 1), 0)]
            near = np.where(here[:, :, None], near, -1).reshape(len(active), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[active[:, None], np.maximum(near, 0)]] = -1
            at, k = np.nonzero(near >= 0)
            seen[active[at], near[at, k]] = True
            s = np.full(near.shape, -2, dtype=np.float32)
            s[at, k] = np.einsum("nd,nd->n", queries[active[at]], self.vectors[near[at, k]])
            all_ids, all_sims = np.concatenate([a_ids, near], 1), np.concatenate([a_sims, s], 1)
            all_done = np.concatenate([a_done, near < 0], 1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[active], sims[active] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_sims, best, 1)
            done[active] = now = np.take_along_axis(all_done, best, 1)
            active = active[~now.all(1)]
        return ids, sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.full(len(queries), self.order[0])
        for level in range(self.top, 0, -1):
            entry = self._beam(queries, entry, level, 1)[0][:, 0]
        return self._beam(queries, entry, 0, beam)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; first scaled by their largest number, so squares stay finite and not zero."""
    scaled = vectors.astype(np.float64)
    scaled = scaled / np.abs(scaled).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def linked(queries: np.ndarray, points: np.ndarray, own: np.ndarray, cosine: float = COSINE, beam: int = BEAM, recall: float = RECALL):
    """Index pairs (query, point) with at least this cosine, in parts, from unit vectors.

    ``own``: for each query the point that is the query itself, or -1. A beam that does not
    find it has lost its way and is widened like a full one.
    """
    graph = Graph(points)
    lean = 1e-5  # single precision finds, double precision decides

    def confirmed(q: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = np.concatenate([np.einsum("nd,nd->n", queries[q[k : k + 65536]], points[p[k : k + 65536]]) >= cosine for k in range(0, len(q), 65536)] or [np.zeros(0, bool)])
        return q[ok], p[ok]

    def scan(q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for k in range(0, len(q), BATCH):
            x, y = np.nonzero(queries[q[k : k + BATCH]] @ points.T >= cosine - lean)
            out.append(confirmed(q[k : k + BATCH][x], y))
        return out

    def walk(q: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
        out, wider = [], []
        if width >= len(points) or (width > beam and 4 * width >= len(points)):
            return scan(q)  # a beam widened to most of the shard takes all of it
        for k in range(0, len(q), BATCH):
            part = q[k : k + BATCH]
            ids, sims = graph.search(queries[part].astype(np.float32), width)
            hit = (sims >= cosine - lean) & (ids >= 0)
            full = hit.all(axis=1) | ((own[part] >= 0) & ~(ids == own[part, None]).any(axis=1))
            wider.append(part[full])
            x, y = np.nonzero(hit & ~full[:, None])
            out.append(confirmed(part[x], ids[x, y]))
        again = np.concatenate(wider) if wider else q[:0]
        return out + (walk(again, 4 * width) if len(again) else [])

    everyone = np.arange(len(queries))
    audit = everyone[:: max(1, len(queries) // AUDITED)]
    of = lambda found: np.bincount(np.concatenate([q for q, _ in found] or [everyone[:0]]), minlength=len(queries))[audit]
    truth = of(scan(audit))
    while True:
        found = walk(everyone, beam)
        if (of(found) >= truth).mean() >= recall:
            return found
        beam *= 2


def usable() -> Column:
    """Whether a row can link: it has an id, a label and a vector of finite numbers that are not all zero."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & some, F.lit(False))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, shard: int = SHARD) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Rows link within a label if their cosine is at least ``cosine``; rows that cannot
    (``usable``) have no links and are their own component. A row without vec_id links
    with nothing, has a null component and is kept. Equal vectors of a label are one node
    with a count, so copies are linked with each other without being listed in pairs; rows
    that repeat an id with another vector share its links and component. Vectors of
    different lengths are not compared. Other columns are left out.
    """
    ship(vectors.sparkSession)
    rows = vectors.select("vec_id", "label", "embedding").withColumn("ok", usable())
    nodes = cut(
        rows.where("ok").groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("m"))
        .withColumn("dim", F.size("embedding"))
    )
    block = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_NUMBERS) / F.col("dim")))
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    sizes = sizes.select("label", "dim", F.ceil(F.col("n") / shard).cast("int").alias("shards"), F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    sized = nodes.join(sizes.hint("rebalance"), ["label", "dim"])
    own = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    base = ["label", "dim", "node", "m", "embedding"]
    cells = (
        sized.select(*base, F.lit(True).alias("point"), own("shards", 1).alias("shard"), every("blocks").alias("block"))
        .union(sized.select(*base, F.lit(False).alias("point"), every("shards").alias("shard"), own("blocks", 2).alias("block")))
    )

    def pairs(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        point = frame["point"].to_numpy(bool)
        data = unit(np.stack(frame["embedding"].to_numpy()))
        node, m = frame["node"].to_numpy(np.int64), frame["m"].to_numpy(np.int64)
        q_node, p_node, p_m = node[~point], node[point], m[point]
        counts = np.zeros(len(q_node), dtype=np.int64)
        a, b = [], []
        if len(q_node) and len(p_node):
            near = np.minimum(np.searchsorted(p_node, q_node), len(p_node) - 1)
            for q, p in linked(data[~point], data[point], np.where(p_node[near] == q_node, near, -1), cosine):
                q, p = q[q_node[q] != p_node[p]], p[q_node[q] != p_node[p]]
                np.add.at(counts, q, p_m[p])
                q, p = forest(q, p, len(q_node))
                a.append(q_node[q])
                b.append(p_node[p])
        some = counts > 0
        u, v = np.concatenate([np.zeros(0, np.int64), *a]), np.concatenate([np.zeros(0, np.int64), *b])
        # Counts first, with no other end; then links.
        return pd.DataFrame({
            "u": np.concatenate([q_node[some], u]),
            "v": pd.array(np.concatenate([np.zeros(some.sum(), np.int64), v]), dtype="Int64").copy(),
            "n": np.concatenate([counts[some], np.zeros(len(u), np.int64)]),
        })

    found = cut(cells.groupBy("label", "dim", "shard", "block").applyInPandas(pairs, "u long, v long, n long"))
    counts = found.where("n > 0").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("linked"))
    roots = components(found.where("n = 0").select("u", "v"))
    named = nodes.select("label", "embedding", "node", "m").join(counts, "node", "left").join(roots, "node", "left")
    named = named.select(
        "label", "embedding", (F.coalesce("linked", F.lit(0)) + F.col("m") - 1).alias("links"), F.coalesce("root", "node").alias("root"),
    )
    joined = rows.alias("r").join(named.hint("rebalance").alias("n"), F.expr("r.ok and r.label = n.label and r.embedding = n.embedding"), "left")
    return joined.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("root", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def op2_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))
