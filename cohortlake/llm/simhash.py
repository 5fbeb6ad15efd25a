"""Near-duplicates by SimHash: fingerprints linked within a Hamming distance, found with vantage-point trees.

A 64-bit fingerprint is seen through bands of bits. Two fingerprints that differ in at most
4 bits differ in at most 1 bit of one of the first two bands or in none of the third, so a
tree for each band with that radius finds every pair, and a small radius in few bits prunes
far better than 4 in 64. Each tree has vantage points that deal fingerprints by their
distance within its band into shards; a query goes down both sides where the triangle
inequality cannot rule one out, hence to every shard its ball overlaps. Inside a shard the
same search goes on for all queries at once, and pairs are confirmed on all 64 bits.

Equal fingerprints are one node. Of the pairs in a shard only a spanning forest leaves the
task, so a large group of near copies never becomes all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from cohortlake.llm.common import ascii_words, components, cut, free_name, local_roots, ship, table
from cohortlake.operators.skew import join_one_per_key

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Bits of each band and its radius: the sum of (radius + 1) must exceed the distance.
BANDS = ((0, 22, 1), (22, 43, 1), (43, 64, 0))
#: Fingerprints in a shard, and queries searched together with it, on average at most.
SHARD, QUERIES = 4096, 1 << 16
#: Vantage points are chosen from so many fingerprints; trees are at most so deep.
SAMPLE, DEPTH = 16_384, 12
#: Searched by comparing all pairs of a query block and a leaf.
LEAF, BLOCK = 64, 8192


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each 1 if set in over half of the XXH64 hashes of all shingles; 0 without words. Null is an empty text.

    Texts with fewer words than a shingle have one shingle, all their words. The hashes
    are counted in blocks, so very long texts need no more memory than their words.
    """
    words = [w for w in ascii_words(text)]
    if not words:
        return 0
    words = b" ".join(words).lower().split(b" ")
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    last = min(shingle, len(words)) - 1
    stops = (ends[last:] - 1).tolist()
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(stops), 1 << 15):
        part = slice(at, at + (1 << 15))
        h = np.array([xxh64_intdigest(whole[i:j], seed) for i, j in zip(starts[part], stops[part], strict=False)], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(stops), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint as a signed long."""
    ship(docs.sparkSession)
    name, body = free_name("fp", list(keep)), free_name("body", list(keep))
    frame = docs.select(*keep, F.col(text).alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(body).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(fps, pa.int64())], names=[*keep, name])

    kinds = [f for f in frame.schema.fields if f.name != body]
    return frame.mapInArrow(run, T.StructType([*kinds, T.StructField(name, T.LongType())]))


def far(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def band_of(fps: np.ndarray, low: int, high: int) -> np.ndarray:
    return (fps >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)


def split_point(seen: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point and the distance that halves these values best; None if no distance parts them."""
    for k in (0, len(seen) // 2, len(seen) - 1):
        d = far(seen, seen[k])
        # The median, moved inside the range of distances so that both sides keep something.
        mu = min(int(np.median(d)), int(d.max()) - 1)
        if mu >= int(d.min()):
            return seen[k], mu
    return None


def grow(sample: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """A complete binary tree in heap order as (vantage point, distance); distance -1: everything goes outside."""
    nodes, level = [], [sample]
    for _ in range(depth):
        below = []
        for part in level:
            at = split_point(part) if len(part) > 1 else None
            nodes.append((int(at[0]), at[1]) if at else (0, -1))
            inside = far(part, at[0]) <= at[1] if at else np.zeros(len(part), dtype=bool)
            below += [part[inside], part[~inside]]
        level = below
    return nodes


def route(values: np.ndarray, nodes: list[tuple[int, int]], depth: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of value, leaf) for every leaf that the ball of ``radius`` about each value overlaps; 0: its home."""
    at, node = np.arange(len(values)), np.zeros(len(values), dtype=np.int64)
    point, mu = np.array([n[0] for n in nodes], dtype=np.uint64), np.array([n[1] for n in nodes])
    for _ in range(depth):
        d, m = far(values[at], point[node]).astype(np.int64), mu[node]
        inside = (d - radius <= m) & (m >= 0)
        outside = (d + radius > m) | (m < 0)
        at = np.concatenate([at[inside], at[outside]])
        node = np.concatenate([2 * node[inside] + 1, 2 * node[outside] + 2])
    return at, node - ((1 << depth) - 1)


def search(queries: np.ndarray, points: np.ndarray, low: int, high: int, radius: int, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between queries and points, as index pairs."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(np.arange(len(queries)), np.arange(len(points)))]
    q_band, p_band = band_of(queries, low, high), band_of(points, low, high)
    while todo:
        q, p = todo.pop()
        if not len(q) or not len(p):
            continue
        at = split_point(p_band[p]) if len(p) > LEAF else None
        if at is None:
            for k in range(0, len(p), LEAF):
                for j in range(0, len(q), BLOCK):
                    x, y = np.nonzero(far(queries[q[j : j + BLOCK], None], points[None, p[k : k + LEAF]]) <= distance)
                    found.append(forest(q[j : j + BLOCK][x], p[k : k + LEAF][y], len(queries)))
            continue
        dq, dp = far(q_band[q], at[0]).astype(np.int64), far(p_band[p], at[0])
        todo += [(q[dq - radius <= at[1]], p[dp <= at[1]]), (q[dq + radius > at[1]], p[dp > at[1]])]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]), len(queries))


def forest(q: np.ndarray, p: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the links q - p, so many that the same are connected: fewer than there are ends."""
    if len(q) < 2:
        return q, p
    ends, at = np.unique(np.concatenate([q, p + shift]), return_inverse=True)
    a, b = at[: len(q)], at[len(q) :]
    root = local_roots(len(ends), a, b)
    # Queries have the smaller indices, so every root is a query; its links with points, and other queries by one point each.
    keep = np.zeros(len(q), dtype=bool)
    done = root == np.arange(len(ends))
    while not done.all():
        open_a, open_b = ~done[a] & done[b], ~done[b] & done[a]
        for new, link in ((a, open_a), (b, open_b)):
            links = np.flatnonzero(link)
            node, one = np.unique(new[links], return_index=True)
            keep[links[one]] = True
            done[node] = True
    return q[keep], p[keep]


def links(nodes: DataFrame, bands=BANDS, distance: int = DISTANCE, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """``u``, ``v``: links between distinct fingerprints ``fp`` that connect exactly what all links would connect.

    Every fingerprint is indexed and is a query. Trees are fitted on at most twice
    ``SAMPLE`` fingerprints; shards above ``shard`` are cut by hash, queries above
    ``QUERIES`` into blocks, so no task holds more than about one shard and one block.
    """
    assert sum(r + 1 for *_, r in bands) > distance
    spark = nodes.sparkSession
    total = nodes.count()
    depth = min(DEPTH, max(0, int(np.ceil(np.log2(max(1, total) / shard)))))
    rate = max(1, total // SAMPLE)
    drawn = nodes.where(F.pmod(F.xxhash64(F.lit(seed), "fp"), F.lit(rate)) == 0).limit(2 * SAMPLE).collect()
    sample = np.sort(np.array([r[0] for r in drawn], dtype=np.int64).view(np.uint64))
    trees = [grow(band_of(sample, low, high), depth) for low, high, _ in bands]

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = frame["fp"].to_numpy(np.int64).view(np.uint64)
            for k, (low, high, radius) in enumerate(bands):
                values = band_of(fps, low, high)
                for home, reach in ((True, 0), (False, radius)):
                    at, leaf = route(values, trees[k], depth, reach)
                    yield pd.DataFrame({"fp": fps[at].view(np.int64), "leaf": leaf * len(bands) + k, "home": home})

    dealt = cut(nodes.select("fp").mapInPandas(deal, "fp long, leaf long, home boolean"))
    sizes = dealt.groupBy("leaf").agg(F.count(F.when(F.col("home"), 1)).alias("n"), F.count(F.when(~F.col("home"), 1)).alias("q"))
    parts, blocks = F.ceil(F.col("n") / (2 * shard)).cast("int"), F.ceil(F.col("q") / QUERIES).cast("int")
    sized = join_one_per_key(dealt, sizes.select("leaf", parts.alias("parts"), blocks.alias("blocks")).where("parts > 0"), "leaf")
    own = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "fp"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cells = (
        sized.where("home and blocks > 0").select("fp", "home", "leaf", own("parts", 1).alias("part"), every("blocks").alias("block"))
        .union(sized.where("not home").select("fp", "home", "leaf", every("parts").alias("part"), own("blocks", 2).alias("block")))
    )

    def pairs(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        fps, home = frame["fp"].to_numpy(np.int64).view(np.uint64), frame["home"].to_numpy(bool)
        low, high, radius = bands[key[0] % len(bands)]
        queries, points = np.sort(fps[~home]), np.sort(fps[home])
        a, b = search(queries, points, low, high, radius, distance)
        u, v = queries[a].view(np.int64), points[b].view(np.int64)
        return pd.DataFrame({"u": u[u != v], "v": v[u != v]})

    return cells.groupBy("leaf", "part", "block").applyInPandas(pairs, "u long, v long")


def near_duplicates(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), distance: int = DISTANCE) -> DataFrame:
    """``keep`` with ``fp`` (long), ``root`` (a fingerprint that names the group) and ``component_id``.

    ``component_id`` is the smallest doc_id reachable through links, of documents that
    have one; it is null only if no document of the group has an id. Null and blank texts
    have fingerprint 0 and are linked like any other. Repeated rows stay. Extra columns
    are left out. An empty table gives no rows.
    """
    rows = cut(fingerprints(docs, text, keep))
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes, distance=distance)).withColumnRenamed("node", "fp")
    # Fingerprints without a link are their own roots.
    named = nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = join_one_per_key(named.select("fp", "root"), least, "root").select("fp", "root", "component_id")
    return join_one_per_key(rows, named, "fp")


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that stay: of each group the one with the smallest doc_id (null last; ties by text), once.

    All columns are kept. Rows equal in id and text stand for one another.
    """
    mark = free_name("text_hash", docs.columns)
    with_hash = docs.withColumn(mark, F.xxhash64(F.col(text)))
    groups = near_duplicates(with_hash, text, ("doc_id", mark))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", mark)).alias("pick")
    picked = groups.groupBy("root").agg(first).select("root", "pick.doc_id", f"pick.{mark}")
    rows = groups.groupBy("root", "doc_id", mark).agg(F.count("*").alias("n"))
    picked = rows.alias("r").join(picked.alias("p"), F.expr(f"r.root = p.root and r.doc_id <=> p.doc_id and r.{mark} = p.{mark}"))
    picked = cut(picked.select("r.doc_id", f"r.{mark}", "n"))
    on = F.expr(f"d.doc_id <=> p.doc_id and d.{mark} = p.{mark}")
    single = with_hash.alias("d").join(picked.where("n = 1").alias("p"), on, "left_semi")
    many = with_hash.alias("d").join(picked.where("n > 1").alias("p"), on, "left_semi").dropDuplicates(["doc_id", mark])
    return single.union(many).drop(mark)


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
