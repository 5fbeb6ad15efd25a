from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from cohortlake.llm import simhash
from cohortlake.llm.common import components, local_roots

SAMPLE = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), seed=42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    fps = np.array([slow_fingerprint(t) for _, t in rows], dtype=np.uint64)
    x, y = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    roots = local_roots(len(rows), x, y)
    least = [min((rows[k][0] for k in np.flatnonzero(roots == r) if rows[k][0] is not None), default=None) for r in roots]
    return sorted(repr((rows[k][0], f"{int(fps[k]):016x}", least[k])) for k in range(len(rows)))


def shown(df):
    return sorted(repr((r["doc_id"], f"{r['fp'] % (1 << 64):016x}", r["component_id"])) for r in df.collect())


ODD = [
    (1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "a b c"), (7, "A B C d"), (8, "É b c d e"), (8, "É b c d e"), (None, "É b c d e"),
    (None, "nobody else says this"), (9, "x " * 40_000), (10, "w\u00a0v u t s"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame([(*r, "f", 1) for r in ODD], "doc_id long, text string, fp string, root int")
    assert shown(simhash.near_duplicates(df)) == brute(ODD)
    assert simhash.near_duplicates(df.where("false")).count() == 0
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(["1", "4", "6", "7", "8", "9", "10", "None"])


@pytest.mark.parametrize("shard", [10, 4096])
def test_sample_against_all_pairs(spark, shard, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (simhash.BANDS, simhash.DISTANCE, shard, simhash.SEED))
    df = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text")
    assert shown(simhash.near_duplicates(df)) == brute([tuple(r) for r in df.collect()])


def test_trees_lose_no_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    near = base[:1000].copy()
    for k in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, 1000).astype(np.uint64)
    fps = np.unique(np.concatenate([base, near]))
    want = np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4, 1))
    met = set()
    for low, high, radius in simhash.BANDS:
        values = simhash.band_of(fps, low, high)
        nodes = simhash.grow(values[::7], 5)
        home = dict(zip(*simhash.route(values, nodes, 5, 0), strict=True))
        at, leaf = simhash.route(values, nodes, 5, radius)
        reached = set(zip(at.tolist(), leaf.tolist(), strict=True))
        met |= {(a, b) for a, b in want.tolist() if (a, home[b]) in reached}
    assert met == {tuple(x) for x in want.tolist()}
    found = np.zeros((0, 2), int)
    for low, high, radius in simhash.BANDS:
        found = np.concatenate([found, np.stack(simhash.search(fps, fps, low, high, radius), 1)])
    x, y = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    assert np.array_equal(local_roots(len(fps), found[:, 0], found[:, 1]), local_roots(len(fps), x, y))


def test_components_of_a_path_a_star_and_a_cycle(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)] + [(900, 901), (901, 902), (902, 900), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 100 for k in range(101, 161)} | {k: 500 for k in range(501, 560)} | {901: 900, 902: 900}
