"""Secret scans by ownership frequency over the whole corpus.

Candidates are found in every whole text: three fixed kinds, and wider kinds that look like
credentials but may as well be ids or samples. The hashes of all candidate values are
aggregated by distinct repositories and owners. A value that many owners or repositories
hold is a copied example; one that hardly anyone else holds is a live credential, whatever its
length and characters. Wider candidates are looked at only if they look random, and become spans only if
they come out live; the fixed kinds always stay.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.llm.common import cut, free_name, ship, table
from cohortlake.operators.skew import join_one_per_key

KINDS = ("assign", "access", "hex", "bearer", "key_block", "url_login", "mixed")
BASE = KINDS[:3]
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
# A run that is long enough starts where its maximal run starts, so these give what dropping short matches gives.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Kinds that the method adds: (kind, what must occur in a text, pattern, group of the value).
WIDER = (
    ("bearer", "earer ", re.compile(r"[Bb]earer\x20+([A-Za-z0-9._~+/=-]{20,})", re.A), 1),
    # Up to the next end mark; headers of encrypted keys, with their hyphens, are part of it.
    ("key_block", "PRIVATE KEY-----", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----((?:(?!-----).){20,}?)-----END [A-Z ]*PRIVATE KEY-----", re.S), 1),
    ("url_login", "://", re.compile(r"://[^\s:/@]+:([^\s:/@]{6,})@"), 1),
)
#: Ids that look random and open nothing.
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
#: Part of the neighbours in a mixed run that differ in kind, from which on it is a token.
CHANGES = 0.4
MIXED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}", re.A)
#: Owners, and repositories of all owners together, from which on a value is an example.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 4
#: Bits a character below which a wider value is no credential.
LIVE_BITS = 3.0

SPAN = T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()),
    T.StructField("hash", T.BinaryType()), T.StructField("credible", T.BooleanType()),
])


def bits(value: str) -> float:
    """Entropy of the characters, in bits."""
    counts = Counter(value)
    return -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())


def random_looking(value: str, least: float = LIVE_BITS) -> bool:
    digits = sum(c.isdigit() for c in value)
    return 0 < digits < len(value) and bits(value) >= least


class Covered:
    """Stretches of a text that are taken, overlapping ones joined, in order; questions take a binary search."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self._starts: list[int] = []
        self._stops: list[int] = []
        for a, b in sorted(spans):
            if self._stops and a < self._stops[-1]:
                self._stops[-1] = max(b, self._stops[-1])
            else:
                self._starts.append(a)
                self._stops.append(b)

    def free(self, a: int, b: int) -> bool:
        after = bisect.bisect_right(self._stops, a)
        return after == len(self._starts) or self._starts[after] >= b

    def add(self, a: int, b: int) -> None:
        """Take a free stretch."""
        at = bisect.bisect_left(self._starts, a)
        self._starts.insert(at, a)
        self._stops.insert(at, b)


def kind_of(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2


def one_token(value: str, least: float = CHANGES) -> bool:
    """Whether a mixed run is one random token, and no path, slug, URL or UUID.

    It has small and capital letters and digits, and goes from one to another often: 62 of
    100 neighbours differ in kind in random tokens, a third at most in words put together.
    """
    kinds = [kind_of(c) for c in value if c.isalnum()]
    if len(set(kinds)) < 3 or UUID.fullmatch(value):
        return False
    return sum(a != b for a, b in zip(kinds, kinds[1:])) >= least * (len(kinds) - 1)


def candidates(text: str | None) -> list[tuple[int, int, int, bytes, bool]]:
    """(kind, start, stop, hash of the value, may be live), by start and kind; code points, stop exclusive.

    Fixed kinds may always be live, wider ones if they look random.
    """
    text = text or ""
    found = [("assign", *m.span(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 6] if "=" in text or ":" in text else []
    found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    covered = Covered((a, b) for _, a, b, _ in found)
    wider = [(kind, *m.span(), m[group]) for kind, need, rule, group in WIDER if need in text for m in rule.finditer(text)]
    wider += [("mixed", *m.span(), m[0]) for m in MIXED.finditer(text) if one_token(m[0])]
    for kind, a, b, value in wider:
        if random_looking(value) and covered.free(a, b):
            covered.add(a, b)
            found.append((kind, a, b, value))
    rows = [(KINDS.index(k), a, b, hashlib.sha256(v.encode()).digest()[:16], k in BASE or random_looking(v)) for k, a, b, v in found]
    return sorted(rows, key=lambda r: (r[1], r[0]))


def joined(spans: list) -> str:
    return ",".join(f"{KINDS[s[0]]}:{s[1]}:{s[2]}" for s in spans)


def scanned(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """``keep``, counts of the fixed kinds, digest of their spans, and ``found``, all candidates."""
    ship(docs.sparkSession)
    body = free_name("body", list(keep))
    frame = docs.select(*keep, F.col(text).alias(body))
    more = T.StructType([*[T.StructField(f"n_{k}", T.LongType()) for k in BASE], T.StructField("base_sha256", T.StringType()), T.StructField("found", T.ArrayType(SPAN))])
    arrow = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("hash", pa.binary()), ("credible", pa.bool_())]))
    names = [f.name for f in SPAN.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_found = [candidates(t) for t in batch.column(body).to_pylist()]
            counts = np.zeros((len(all_found), len(BASE)), dtype=np.int64)
            digests = []
            for k, found in enumerate(all_found):
                base = [s for s in found if s[0] < len(BASE)]
                for s in base:
                    counts[k, s[0]] += 1
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans = pa.array([[dict(zip(names, s, strict=True)) for s in found] for found in all_found], arrow)
            columns = [*[batch.column(c) for c in keep], *[pa.array(counts[:, k]) for k in range(len(BASE))], pa.array(digests, pa.string()), spans]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *more.names])

    kept = [f for f in frame.schema.fields if f.name != body]
    return frame.mapInArrow(run, T.StructType([*kept, *more.fields]))


def ownership(found: DataFrame) -> DataFrame:
    """``hash`` with its numbers of distinct ``n_repos`` and ``n_owners``, from rows (hash, owner, repo).

    Rows are reduced to distinct triples and pairs before they meet by hash, so a value in
    very many documents is one row per repository then. A null owner counts as one owner.
    """
    known = found.select("hash", F.struct("owner").alias("o"), F.struct("owner", "repo").alias("r")).distinct()
    return known.groupBy("hash", "o").agg(F.count("*").alias("n")).groupBy("hash").agg(F.sum("n").alias("n_repos"), F.count("*").alias("n_owners"))


def classified(docs: DataFrame, text: str = "text", owner: str = "source", repo: str = "lang", keep: tuple[str, ...] = ("doc_id",), example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """``keep`` with base counts and digest, ``spans`` (all as text), ``holders`` (n_owners:n_repos of each span's value),
    ``live`` (start and stop of live ones), ``n_live``, ``n_example``.

    A repository is an owner's ``repo``. Every candidate is an example (``example_owners``
    owners or more, or ``example_repos`` repositories or more) or live (fewer of both), wider
    ones only if they look random. Null texts are empty,
    repeated rows stay rows of their own, an empty table gives no rows, other columns are
    left out.
    """
    row, own, rep = (free_name(x, [*keep, "found"]) for x in ("row", "owner", "repo"))
    named = docs.withColumn(own, F.col(owner)).withColumn(rep, F.col(repo))
    # The row number is fixed by the cut: it is read from the written rows from here on.
    scan = cut(scanned(named, tuple(dict.fromkeys([*keep, own, rep])), text).withColumn(row, F.monotonically_increasing_id()))
    each = scan.where(F.size("found") > 0).select(row, F.col(own).alias("owner"), F.col(rep).alias("repo"), F.explode("found").alias("s"))
    each = each.select(row, "owner", "repo", "s.*")
    owners = ownership(each)
    verdict = (
        F.when((F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos), "example")
        .when(F.col("credible"), "live").otherwise("unclear")
    )
    judged = join_one_per_key(each.select(row, "kind", "start", "stop", "hash", "credible"), owners, "hash").withColumn("verdict", verdict)
    judged = judged.where((F.col("kind") < len(BASE)) | (F.col("verdict") == "live"))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    per_row = judged.groupBy(row).agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "stop", F.concat_ws(":", name, "start", "stop").alias("t"), F.concat_ws(":", "n_owners", "n_repos").alias("h"), F.col("verdict").alias("v")))).alias("l")
    )
    per_row = per_row.select(
        row, F.array_join(F.transform("l", lambda x: x["t"]), ",").alias("spans"), F.array_join(F.transform("l", lambda x: x["h"]), ",").alias("holders"),
        F.transform(F.filter("l", lambda x: x["v"] == "live"), lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"))).alias("live"),
        F.size(F.filter("l", lambda x: x["v"] == "live")).cast("long").alias("n_live"),
        F.size(F.filter("l", lambda x: x["v"] == "example")).cast("long").alias("n_example"),
    )
    counts = [f"n_{k}" for k in BASE]
    out = scan.select(row, *keep, *counts, "base_sha256").join(per_row, row, "left")
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return out.select(
        *keep, *counts, "base_sha256", F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("holders", F.lit("")).alias("holders"), F.coalesce("live", empty).alias("live"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"),
    )


def mask_spans(text: str | None, spans: list[dict] | None, mark: str) -> str | None:
    """The text with each span, spans that overlap together, replaced by ``mark``."""
    if not spans:
        return text
    out, end = [], 0
    for span in sorted(spans, key=lambda s: s["start"]):
        if not out or span["start"] >= end:
            out += [text[end : span["start"]], mark]
        end = max(end, span["stop"])
    return "".join([*out, text[end:]])


def masked(docs: DataFrame, text: str = "text", mark: str = "<secret>", owner: str = "source", repo: str = "lang") -> DataFrame:
    """``docs`` with every live secret replaced by ``mark``; all rows and columns stay, examples too.

    Live spans are a function of the text's candidates, so they are joined back by the
    text's digest, and only to the documents that have some.
    """
    key = free_name("text_key", docs.columns)
    live = free_name("live_spans", docs.columns)
    keyed = docs.withColumn(key, F.sha2(F.col(text).cast("binary"), 256))
    names = docs.columns
    spans = classified(keyed, text, owner, repo, (key,)).where("n_live > 0").groupBy(key).agg(F.first("live").alias(live))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [mask_spans(t, s, mark) for t, s in zip(batch.column(text).to_pylist(), batch.column(live).to_pylist(), strict=True)]
            columns = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return join_one_per_key(keyed, spans, key, "left").mapInArrow(run, docs.schema)


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return classified(table(spark, folder, "documents")).drop("live")
