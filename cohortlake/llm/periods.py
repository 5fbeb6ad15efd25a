"""Runs of words that repeat with a period, found by recursive frequency splitting and a lag scan.

A word of a run of at least ``least_periods`` periods stands in it at least that often. So a
word that is rarer within its segment belongs to no run there and splits the segment; pieces
that are too short for a run go, the others are counted again until nothing changes. What
survives is scanned by lags: where the piece of s words at a place next occurs q words later,
s/2 < q <= s, for some places in a row, those places and the piece at the last of them, taken
with its copy, are a whole run of smallest period q. One pass for each power of two s covers
all lags between s/2 and s, so the scan is not quadratic in a text of few different words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.llm.common import SPACE, free_name, ship, table

#: A run has at least this many words and periods; the lag scan needs three periods or more.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Words of documents that are searched together; a longer document is searched alone.
TOGETHER = 1 << 20

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
ARROW_RUNS = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN.fields]))


def surviving(word: np.ndarray, segment: np.ndarray, least_words: int, least_periods: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that may be in a run, and the number of each one's segment.

    ``segment`` ascends. Every round counts each word within its segment, drops the rare
    ones, cuts the segments there and drops those that are too short, until a round drops none.
    """
    at = np.arange(len(word))
    kinds = int(word.max(initial=0)) + 1
    while len(at):
        _, same, times = np.unique(segment * kinds + word[at], return_inverse=True, return_counts=True)
        often = times[same] >= least_periods
        left, of = at[often], segment[often]
        cuts = np.ones(len(left), dtype=bool)
        cuts[1:] = (np.diff(left) > 1) | (np.diff(of) > 0)
        of = np.cumsum(cuts) - 1
        sizes = np.bincount(of)
        long = sizes[of] >= least_words
        stable = len(left) == len(at) and long.all()
        at = left[long]
        segment = np.unique(of[long], return_inverse=True)[1]
        if stable:
            break
    return at, segment


def lag_scan(word: np.ndarray, segment: np.ndarray, least_words: int, least_periods: int) -> np.ndarray:
    """Rows (start, length, period) of all runs inside the segments of a sequence of words."""
    found = [np.empty((0, 3), dtype=np.int64)]
    size = len(word)
    if not size:
        return found[0]
    longest = int(np.bincount(segment).max())
    # The piece at a place is a number; -1 where it occurs once only or leaves its segment.
    piece, s = segment * (int(word.max()) + 1) + word, 1
    places = np.arange(size)
    while s // 2 < longest // least_periods:
        _, same, times = np.unique(piece[places], return_inverse=True, return_counts=True)
        again = times[same] > 1
        places, same = places[again], same[again]
        piece = np.full(size, -1, dtype=np.int64)
        piece[places] = same
        order = places[np.argsort(same, kind="stable")]
        lag = np.zeros(size, dtype=np.int64)
        next_is_same = piece[order[1:]] == piece[order[:-1]]
        lag[order[:-1][next_is_same]] = np.diff(order)[next_is_same]
        lag[(lag <= s // 2) | (lag > s)] = 0
        edge = np.flatnonzero(np.diff(lag, prepend=0, append=0))
        start, stop = edge[:-1], edge[1:]
        period = lag[start]
        start, stop, period = start[period > 0], stop[period > 0], period[period > 0]
        length = stop - start + s - 1 + period
        enough = (length >= least_words) & (length >= least_periods * period)
        found.append(np.stack([start, length, period], axis=1)[enough])
        places = places[places + s < size]
        places = places[piece[places + s] >= 0]
        piece[places] = piece[places] * size + piece[places + s]
        s *= 2
    return np.concatenate(found)


def runs_of(texts: list[list[bytes]], least_words: int, least_periods: int) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs (start, length, period) by start, then period."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    word = np.fromiter((numbers[w] for words in texts for w in words), np.int64, int(begin[-1]))
    at, segment = surviving(word, np.repeat(np.arange(len(texts)), sizes), least_words, least_periods)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in lag_scan(word[at], segment, least_words, least_periods).tolist():
        k = int(np.searchsorted(begin, at[start], side="right")) - 1
        out[k].append((int(at[start] - begin[k]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def without_repeats(words: list[bytes], runs: Iterable[tuple[int, int, int]]) -> bytes:
    """The words outside all runs and those of each run's first period, unless another run drops them."""
    drop: set[int] = set()
    for start, length, period in runs:
        drop.update(range(start + period, start + length))
    return b" ".join([w for i, w in enumerate(words) if i not in drop] if drop else words)


def _together(texts: list[list[bytes]], limit: int) -> Iterator[list[list[bytes]]]:
    part, size = [], 0
    for words in texts:
        if part and size + len(words) > limit:
            yield part
            part, size = [], 0
        part.append(words)
        size += len(words)
    if part:
        yield part


def periodic_runs(
    docs: DataFrame, text: str = "text", least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS, together: int = TOGETHER
) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period in words) and ``collapsed``, the text without repeats.

    A run is a longest stretch of words in which words ``period`` apart are equal, for the
    smallest such period, of at least ``least_words`` words and ``least_periods`` (3 or more)
    periods. ``collapsed`` keeps of each run the first period and joins words by one space.
    Null and empty texts have no words, no runs and an empty ``collapsed``. Rows that repeat
    are rows of their own, an empty table gives no rows, columns of the input named like
    results are replaced. Nothing is shuffled: each text is searched where it is read.
    """
    if least_periods < 3:
        raise ValueError("least_periods must be 3 or more")
    ship(docs.sparkSession)
    more = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]
    body = free_name("body", docs.columns)
    results = {f.name for f in more}
    keep = [c for c in docs.columns if c.lower() not in results]
    frame = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("binary").alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or b"").split() for t in batch.column(body).to_pylist()]
            runs = [r for part in _together(texts, together) for r in runs_of(part, least_words, least_periods)]
            named = [[{"start": s, "length": n, "period": p} for s, n, p in found] for found in runs]
            collapsed = [without_repeats(words, found) for words, found in zip(texts, runs, strict=True)]
            columns = [batch.column(c) for c in keep] + [
                pa.array([len(words) for words in texts], pa.int64()), pa.array(named, ARROW_RUNS),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *[f.name for f in more]])

    kept = [f for f in frame.schema.fields if f.name != body]
    return frame.mapInArrow(run, T.StructType([*kept, *more]))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length/period, then the smallest start and period; null without runs."""
    def better(a: Column, b: Column) -> Column:
        left, right = b["length"] * a["period"], a["length"] * b["period"]
        tie = (b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))
        return F.when(a.isNull() | (left > right) | ((left == right) & tie), b).otherwise(a)

    return F.reduce(runs, F.lit(None).cast(RUN), better)


def with_periodic_tails(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every text whose id has a CRC-32 divisible by 10 goes on from some word with copies of a piece of it.

    With g the tenth of the CRC-32 and n words, word i from a = g % n on becomes word
    a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8). Texts of rows without an id stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")
    g, n = F.floor(h / 10), F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    copies = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(copies), F.lit(1), n - a)), " ")
    return docs.withColumn(text, F.when((h % 10 == 0) & (n > 0), changed).otherwise(F.col(text)))


def op11_periods(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_periodic_tails(table(spark, folder, "documents").select("doc_id", "text"))
    found = periodic_runs(docs).withColumn("best", strongest(F.col("runs")))
    line = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
