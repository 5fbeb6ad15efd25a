"""Periodic runs against a brute-force search of every place and period."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from cohortlake.llm import periods

SAMPLE = "/root/testdata/sf0.001"


def brute(words, least_words=24, least_periods=3):
    out = []
    for q in range(1, len(words) // least_periods + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            run = words[i : j + q]
            if j > i and len(run) >= max(least_words, least_periods * q):
                if not any(run[r:] == run[:-r] for r in range(1, q)):
                    out.append((i, len(run), q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(words, runs):
    drop = {i for start, length, q in runs for i in range(start + q, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in drop)


def random_texts(seed):
    rnd = random.Random(seed)
    texts = []
    for _ in range(rnd.randrange(1, 5)):
        words = []
        for _ in range(rnd.randrange(6)):
            unit = [rnd.choice("abcd").encode() for _ in range(rnd.randrange(1, 20))]
            if rnd.random() < 0.6:
                words += (unit * rnd.randrange(1, 14))[: rnd.randrange(1, 150)]
            else:
                words += [rnd.choice("abcdefgh").encode() for _ in range(rnd.randrange(40))]
        texts.append(words)
    return texts


def test_runs_against_brute_force():
    total = 0
    for seed in range(150):
        texts = random_texts(seed)
        want = [brute(words) for words in texts]
        assert periods.runs_of(texts, 24, 3) == want
        total += sum(map(len, want))
    assert total > 100


def test_other_thresholds():
    for seed in range(60):
        texts = random_texts(1000 + seed)
        assert periods.runs_of(texts, 8, 4) == [brute(words, 8, 4) for words in texts]


def test_documents_searched_together_or_alone_agree():
    texts = [words for seed in range(20) for words in random_texts(seed)]
    alone = [periods.runs_of([words], 24, 3)[0] for words in texts]
    for limit in (1, 50, 500):
        assert [r for part in periods._together(texts, limit) for r in periods.runs_of(part, 24, 3)] == alone


def test_very_long_text_of_few_words():
    rnd = random.Random(5)
    noise = [rnd.choice([b"a", b"b"]) for _ in range(200_000)]
    unit = [b"%d" % i for i in range(30_000)]
    words = noise + unit * 4
    runs = periods.runs_of([words], 24, 3)[0]
    assert (200_000, 120_000, 30_000) in runs
    assert periods.runs_of([[b"x"] * 500_000], 24, 3) == [[(0, 500_000, 1)]]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc_id, text in docs:
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want[doc_id] = (
            len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept(words, runs)).hexdigest(),
        )
    got = {r[0]: tuple(r[1:]) for r in periods.op11_periods(spark, SAMPLE).collect()}
    assert got == want
    assert sum(v[0] > 0 for v in want.values()) > 5


def test_odd_rows(spark):
    loop = " ".join(["a b"] * 12)
    rows = [(1, None, "x"), (2, "", "x"), (None, loop, "x"), (3, loop, None), (3, loop, None), (4, "é ß " * 24, "x"), (5, "\x1c  \n\t" * 9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, RUNS string")
    got = periods.periodic_runs(docs).collect()
    assert got[0].__fields__ == ["doc_id", "text", "n_words", "runs", "collapsed"]
    by = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got]
    run = [(0, 24, 2)]
    assert sorted(by, key=repr) == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (None, 24, run, "a b"), (3, 24, run, "a b"), (3, 24, run, "a b"),
        (4, 24, [(0, 24, 1)], "é ß"), (5, 9, [], "\x1c  " * 8 + "\x1c "),
    ], key=repr)
    assert periods.periodic_runs(docs.limit(0)).count() == 0
    assert [r.text for r in periods.with_periodic_tails(docs).where("doc_id is null").collect()] == [loop]
    with pytest.raises(ValueError):
        periods.periodic_runs(docs, least_periods=2)


def test_strongest_run_of_ties(spark):
    rows = [([(0, 30, 10), (50, 24, 8), (90, 24, 6), (120, 40, 10)],), ([],), ([(9, 24, 8), (9, 30, 10)],)]
    df = spark.createDataFrame(rows, "runs array<struct<start:long,length:long,period:long>>")
    got = [r[0] and tuple(r[0]) for r in df.select(periods.strongest(periods.F.col("runs"))).collect()]
    assert got == [(90, 24, 6), None, (9, 24, 8)]
