"""Each stage of the pipeline against what it is defined to do to its own input."""

from __future__ import annotations

import numpy as np
import pytest
from test_simhash import slow_fingerprint
from test_texts import WORDS, library, slow_counts

import corpus_pipeline
from cohortlake.llm import mixing, quality, secrets
from cohortlake.llm.common import cut, local_roots

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{SAMPLE}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], SAMPLE).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[1:-1])


def test_quality(spark, steps):
    counted = cut(quality.counted(steps[0]).drop("text"))
    rules = quality.learned(cut(quality.labelled_counts(counted, spark.read.parquet(f"{SAMPLE}/labels.parquet"))))
    counts = {r["doc_id"]: r for r in quality.judged(counted, rules).collect()}
    want = []
    for r in steps[0].collect():
        n, _, _, _, repeat = slow_counts(r["text"])
        if n >= 50 and 100 * repeat <= 50 * n and counts[r["doc_id"]]["rule"] is None:
            want.append(tuple(r))
    assert rows(steps[1]) == sorted(want, key=repr)


def test_near_duplicates(steps):
    docs = steps[1].collect()
    fps = np.array([slow_fingerprint(r["text"]) for r in docs], dtype=np.uint64)
    x, y = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    roots = local_roots(len(docs), x, y)
    least = {r: min(docs[k]["doc_id"] for k in np.flatnonzero(roots == r)) for r in set(roots.tolist())}
    assert rows(steps[2]) == sorted((tuple(r) for r in docs if r["doc_id"] in set(least.values())), key=repr)


def test_secrets(steps):
    docs = {r["doc_id"]: r for r in steps[2].collect()}
    owners = {}
    for r in docs.values():
        for _, _, _, value, _ in secrets.candidates(r["text"]):
            owners.setdefault(value, set()).add((r["source"], r["lang"]))

    def example(value):
        return len({o for o, _ in owners[value]}) >= secrets.EXAMPLE_OWNERS or len(owners[value]) >= secrets.EXAMPLE_REPOS

    for r in steps[3].collect():
        before = docs.pop(r["doc_id"])
        live = [dict(start=a, stop=b) for _, a, b, v, random in secrets.candidates(before["text"]) if random and not example(v)]
        assert r["text"] == secrets.mask_spans(before["text"], live, "<secret>")
        assert r["n_chars"] == len(r["text"]) and (r["lang"], r["source"]) == (before["lang"], before["source"])
    assert not docs


def test_mix(steps):
    before, after = {r["doc_id"]: r for r in steps[3].collect()}, steps[4].collect()
    size = {k: len(WORDS.findall(r["text"])) for k, r in before.items()}
    per_source = {}
    for k, r in before.items():
        per_source[r["source"]] = per_source.get(r["source"], 0) + size[k]
    target = mixing.targets(per_source)
    times = {}
    for r in after:
        assert tuple(r) == tuple(before[r["doc_id"]])
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times.values()) <= 3
    for source, words in target.items():
        mine = [k for k, r in before.items() if r["source"] == source]
        assert abs(sum(size[k] * times.get(k, 0) for k in mine) - words) <= max(size[k] for k in mine)
        assert max(times.get(k, 0) for k in mine) - min(times.get(k, 0) for k in mine) <= 1


def test_encoding(steps):
    docs = [(r["doc_id"], r["text"]) for r in steps[4].collect()]
    want = [(k, *t) for (k, _), t in zip(docs, library([t for _, t in docs]), strict=True)]
    assert rows(steps[5]) == sorted(want, key=repr)


def test_odd_rows_and_clashing_columns(spark):
    odd = [(1, None, None, None, None, 1, "a", 2), (None, "", "en", "a", 0, 1, "a", 2), (2, "w " * 60 + " token=0123456789abcdef0123456789abcdef", None, None, None, 1, "a", 2)] * 2
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long, size int, row string, fp int")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SAMPLE)
        none = stage(spark, docs.where("false"), SAMPLE)
        assert none.count() == 0 and out.count() <= 3 * len(odd)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
