from __future__ import annotations

import numpy as np
import pytest

from cohortlake.llm import embeddings
from cohortlake.llm.common import local_roots

SAMPLE = "/root/testdata/sf0.001"


def brute(rows):
    """(n_links, component_id) by comparing all pairs."""
    data = [(i, lab, None if v is None else np.array([np.nan if x is None else x for x in v], float)) for i, lab, v in rows]
    ok = [i is not None and lab is not None and v is not None and len(v) > 0 and np.isfinite(v).all() and v.any() for i, lab, v in data]
    a, b = [], []
    for x in range(len(data)):
        for y in range(len(data)):
            if x != y and ok[x] and ok[y] and data[x][1] == data[y][1] and len(data[x][2]) == len(data[y][2]):
                u, w = data[x][2], data[y][2]
                if u @ w / np.sqrt((u @ u) * (w @ w)) >= 0.98:
                    a.append(x)
                    b.append(y)
    roots = local_roots(len(data), np.array(a, int), np.array(b, int))
    ids = [min((data[k][0] for k in range(len(data)) if roots[k] == r and data[k][0] is not None), default=None) for r in roots]
    return sorted(map(repr, zip([d[0] for d in data], np.bincount(np.array(a, int), minlength=len(data)).tolist(), ids, strict=True)))


def test_odd_rows(spark):
    rows = [
        (1, 1, [1.0, 0.0]), (2, 1, [1.0, 0.0]), (3, 1, [1.0, 0.01]), (4, 2, [1.0, 0.0]), (5, 1, None), (6, 1, [0.0, 0.0]), (7, 1, [float("nan"), 1.0]),
        (8, 1, [1.0, None]), (9, None, [1.0, 0.0]), (None, 1, [1.0, 0.0]), (10, 1, [1e-30, 0.0]), (11, 1, []), (12, 1, [float("inf"), 1.0]), (13, 1, [1.0, 0.0, 0.0]),
        (2, 1, [1.0, 0.0]), (14, 1, [3e38, 3e38]), (15, 1, [2e38, 2e38]),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, node string, kept int")
    got = embeddings.near_duplicates(df).collect()
    assert sorted(repr((r[0], r[1], r[2])) for r in got) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in got)
    assert embeddings.near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize("shard", [40, 8192])
def test_sample_against_all_pairs(spark, shard):
    df = spark.read.parquet(f"{SAMPLE}/embeddings.parquet")
    got = embeddings.near_duplicates(df, shard=shard).collect()
    want = brute([(r["vec_id"], r["label"], r["embedding"]) for r in df.collect()])
    assert sorted(repr((r[0], r[1], r[2])) for r in got) == want


def test_thousands_of_one_label_through_the_graph(spark):
    """Groups of copies and of near vectors among vectors apart, in several shards; no beam is as wide as a shard."""
    rng = np.random.default_rng(3)
    apart, middles = rng.standard_normal((1500, 32)), rng.standard_normal((60, 32))
    near = (middles[:, None] + 0.03 * rng.standard_normal((60, 10, 32))).reshape(-1, 32)
    data = np.concatenate([apart, near, np.repeat(apart[:3], 40, axis=0)]).astype(np.float32)
    order = rng.permutation(len(data))
    rows = [(int(k), 7, data[i].tolist()) for k, i in enumerate(order)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(df, shard=700).collect()}
    unit = embeddings.unit(data[order])
    x, y = np.nonzero(np.triu(unit @ unit.T >= 0.98, 1))
    roots = local_roots(len(data), x, y)
    links = np.bincount(np.concatenate([x, y]), minlength=len(data))
    assert got == {k: (int(links[k]), int(roots[k])) for k in range(len(data))}


def test_graph_finds_large_groups_and_neighbours():
    rng = np.random.default_rng(0)
    apart, middle = rng.standard_normal((1500, 32)), rng.standard_normal(32)
    data = embeddings.unit(np.concatenate([apart, middle + 0.02 * rng.standard_normal((500, 32))]))
    found = set()
    for q, p in embeddings.linked(data, data, np.arange(len(data))):
        found |= set(zip(q.tolist(), p.tolist(), strict=True))
    x, y = np.nonzero(data @ data.T >= 0.98)
    assert found == set(zip(x.tolist(), y.tolist(), strict=True))
    ids, _ = embeddings.Graph(data[:1500]).search(data[:1500].astype(np.float32), 64)
    near = np.argsort(-(data[:1500] @ data[:1500].T), axis=1)[:, :10]
    assert np.mean([len(set(a[:64]) & set(b)) / 10 for a, b in zip(ids, near, strict=True)]) >= 0.9
