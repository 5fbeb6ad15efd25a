"""The manifest against trees built in plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cohortlake.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, tree string, idx int, sha string, up int"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row, text):
    fields = (row[0], row[1], row[2], row[3], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels(leaves, arity):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def brute(rows, arity, change=lambda t: t):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    trees = []
    for s in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        placed = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees.append((placed, levels([leaf(r, r[4]) for r in placed], arity)))
    top = levels([t[1][-1][0] for t in trees], arity) if trees else []
    out = []
    for k, (placed, tree) in enumerate(trees):
        for i, r in enumerate(placed):
            h, proof = leaf(r, change(r[4])), ""
            for part, at in ((tree, i), (top, k)):
                for level in part[:-1]:
                    run, slot = level[at // arity * arity : at // arity * arity + arity], at % arity
                    proof += "".join(run[:slot] + run[slot + 1 :])
                    h = sha("".join([*run[:slot], h, *run[slot + 1 :]]))
                    at //= arity
            out.append((r[0], r[1], leaf(r, r[4]), tree[-1][0], top[-1][0], proof, h))
    return sorted(out, key=repr)


def rows_of(seed, sizes):
    rnd = random.Random(seed)
    out = []
    for source, n in sizes.items():
        for _ in range(n):
            text = rnd.choice([None, "", "a\nb", "größe\n\n", "x" * 50])
            out.append((rnd.choice([None, *range(40)]), source, rnd.choice([None, "de"]), rnd.choice([None, 3]), text, "t", 1, "s", 2))
    return out + out[:5]


def fold_all(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_against_plain_trees(spark, arity):
    rows = rows_of(arity, {None: 4, "": 1, "web": 28, "Ärger": 9, "zz": 3, "a": 1, "b": 2, "c": 27})
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert fold_all(merkle.manifest(docs, arity=arity)) == brute(rows, arity)


def test_tampered_rows_fold_to_another_root(spark):
    rows = rows_of(9, {None: 5, "web": 20})
    docs = spark.createDataFrame(rows, SCHEMA)
    changed = merkle.manifest(docs, recheck={"text": F.replace("text", F.lit("\n"), F.lit(""))})
    want = brute(rows, 3, lambda t: t and t.replace("\n", ""))
    assert fold_all(changed) == want
    assert {r[6] == r[4] for r in want} == {True, False}


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 1, "b": 1}, {None: 3}, {"a": 81}])
def test_small_and_even_trees(spark, sizes):
    rows = [r for r in rows_of(3, sizes)][: sum(sizes.values())]
    assert fold_all(merkle.manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 3)


def test_empty_table(spark):
    done = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert done.count() == 0
    assert done.columns == ["doc_id", "source", "leaf", "subroot", "root", "proof", "folded"]


def test_numbers_do_not_depend_on_partitions(spark):
    rows = [(i % 3, i // 7, i) for i in range(500)]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "g int, k int, x int").repartition(parts)
        got = merkle.numbered(df, ["g"], ["k", "x"], "n").collect()
        for g in range(3):
            mine = sorted((r.n, r.k, r.x) for r in got if r.g == g)
            assert [r[0] for r in mine] == list(range(len(mine)))
            assert [r[1:] for r in mine] == sorted(r[1:] for r in mine)


def test_long_text(spark):
    rows = [(1, "a", "de", 1, "x\n" * 500_000, "", 0, "", 0), (2, "a", None, None, None, "", 0, "", 0)]
    assert fold_all(merkle.manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 3)
