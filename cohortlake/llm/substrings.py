"""Substring dedup by content-defined chunks.

Chunks end at words where a gear rolling hash of the words is smallest among its
neighbours. That depends on nothing but a few words around the end, so an insertion moves
no other end, and a passage is cut alike wherever it stands. Chunks with equal digests are
duplicates, in one document or in several. Consecutive chunks that occur before form a passage
once they have enough words; of each passage the first occurrence in the smallest doc_id stays,
and phrases below that length are left alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.llm.common import ascii_words, cut, free_name, ship, table
from cohortlake.operators.skew import join_one_per_key

#: Words the gear hash looks at; an end is smallest among so many words to either side.
GEAR_WORDS, REACH = 4, 4
#: Words from which on consecutive shared chunks are a passage: chunks lose some words at both ends of a repeat.
PASSAGE_WORDS = 20
#: Bytes of a digest; equal ones are taken as equal chunks.
DIGEST = 12
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def ends_of(words: list[bytes], gear: int = GEAR_WORDS, reach: int = REACH) -> np.ndarray:
    """Numbers of the words after which a chunk ends, the last one included."""
    n = len(words)
    h = np.fromiter(map(crc32, words), dtype=np.uint64, count=n) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    rolled = h.copy()
    for k in range(1, gear):
        rolled[k:] += h[:-k] << np.uint64(8 * k)
    rolled = (rolled * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(1)
    low = np.ones(n, dtype=bool)
    for k in range(1, reach + 1):
        # Where words repeat, every smallest one is an end: a repeated phrase is cut once a period.
        low[k:] &= rolled[k:] <= rolled[:-k]
        low[:-k] &= rolled[:-k] <= rolled[k:]
    ends = np.flatnonzero(low)
    return ends if len(ends) and ends[-1] == n - 1 else np.append(ends, n - 1)


def chunks_of(text: str | None) -> tuple[list[int], list[bytes]]:
    """First words of the chunks of a text, the number of words at the end, and the chunks' digests. No words: no chunks."""
    words = ascii_words(text)
    if not words:
        return [0], []
    at = [0, *(ends_of(words) + 1).tolist()]
    return at, [hashlib.blake2b(b" ".join(words[i:j]), digest_size=DIGEST).digest() for i, j in zip(at, at[1:], strict=False)]


def chunked(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``at`` (first words, and the number of words) and ``digests`` (one after the other) of every whole text."""
    ship(docs.sparkSession)
    body = free_name("body", list(keep))
    frame = docs.select(*keep, F.col(text).alias(body))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [chunks_of(t) for t in batch.column(body).to_pylist()]
            at, digests = pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([b"".join(m[1]) for m in made], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], at, digests], names=[*keep, "at", "digests"])

    kinds = T.StructType([*[frame.schema[c] for c in keep], T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("digests", T.BinaryType())])
    return frame.mapInArrow(run, kinds)


def runs_of(marks: Column, at: Column, least: int) -> Column:
    """Runs of consecutive chunk numbers (sorted) with at least so many words: first and last chunk, start and stop in words."""
    # A run starts where the number before is not among them, and stops where the number after is not.
    firsts = F.filter(marks, lambda x, i: (i == 0) | (F.get(marks, i - 1) < x - 1))
    lasts = F.filter(marks, lambda x, i: F.coalesce(F.get(marks, i + 1) > x + 1, F.lit(True)))
    runs = F.transform(
        F.arrays_zip(firsts.alias("a"), lasts.alias("b")),
        lambda r: F.struct(r["a"].alias("a"), r["b"].alias("b"), F.get(at, r["a"]).alias("start"), F.get(at, r["b"] + 1).alias("stop")),
    )
    return F.filter(runs, lambda r: r["stop"] - r["start"] >= least)


def spans_of(runs: str) -> Column:
    return F.transform(runs, lambda r: F.struct(r["start"].alias("start"), r["stop"].alias("stop")))


def numbers_of(marks: str, which: Callable[[Column], Column]) -> Column:
    return F.transform(F.filter(marks, which), lambda x: x["k"])


def shared_passages(docs: DataFrame, text: str = "text", least: int = PASSAGE_WORDS, numbered: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_chunks``, ``n_common`` (chunks that other
    documents hold too), ``n_shared`` (those of them that lie in passages), ``n_dropped`` (those of the shared
    that an earlier document, or this one before, holds), ``n_repeated`` (chunks that occur again anywhere, in
    this document too), ``n_later`` (those of them that are not the first occurrence), ``passages`` (array of
    start and stop in words, of consecutive chunks that other documents hold, ``least`` words at least),
    ``repeats`` (whether there are any) and ``drop_spans`` (array of start and stop in words, of consecutive
    chunks among ``n_later``, ``least`` words at least). A phrase below that is nobody's copy: it stays.

    Documents are told apart by rows, so repeated rows share everything; the smallest
    doc_id, null last, counts as the earliest. Null and blank texts have no chunks. Extra
    columns are left out; an empty table gives no rows. If ``numbered``, ``docs`` has a fixed
    number of each row in ``row``, which is returned too.
    """
    # Row numbers are fixed by the cut: everything below reads them from the written rows.
    rows = cut(chunked(docs, text, ("doc_id", "row")) if numbered else chunked(docs, text).withColumn("row", F.monotonically_increasing_id()))
    numbers = F.sequence(F.lit(0), F.size("at") - 2)
    digests = F.transform(numbers, lambda k: F.substring(F.col("digests"), k * DIGEST + 1, F.lit(DIGEST)))
    order = F.coalesce("doc_id", F.lit((1 << 63) - 1)).cast("long").alias("o")
    each = rows.where(F.size("at") > 1).select("row", order, F.posexplode(digests).alias("k", "digest"))
    # Counted in the tasks that read before anything moves: a chunk of very many documents is a few rows here.
    held = each.groupBy("digest").agg(
        F.min(F.struct("o", "row", "k")).alias("first"), F.min("row").alias("low"), F.max("row").alias("high"), F.count("*").alias("n"),
    )
    held = held.where("n > 1").select("digest", F.col("first.row").alias("row_1"), F.col("first.k").alias("k_1"), F.expr("low < high").alias("other"))
    shared = join_one_per_key(each.select("digest", "row", "k"), held, "digest")
    later = (F.col("row") != F.col("row_1")) | (F.col("k") != F.col("k_1"))
    marked = shared.select("row", F.struct("k", later.alias("later"), "other").alias("m")).groupBy("row").agg(F.sort_array(F.collect_list("m")).alias("m"))
    out = rows.select("row", "doc_id", "at").join(marked, "row", "left")
    none = F.array().cast("array<struct<k:int,later:boolean,other:boolean>>")
    out = out.select("row", "doc_id", "at", F.coalesce("m", none).alias("m")).select(
        "row", "doc_id", "at", "m", numbers_of("m", lambda x: x["other"]).alias("k"), numbers_of("m", lambda x: x["later"]).alias("later"),
    )
    out = out.select("*", runs_of(F.col("k"), F.col("at"), least).alias("shared"), runs_of(F.col("later"), F.col("at"), least).alias("dropped"))
    inside = lambda x: F.exists("shared", lambda r: (r["a"] <= x["k"]) & (x["k"] <= r["b"]))
    out = out.select(
        *["row"] * numbered, "doc_id", F.element_at("at", -1).cast("long").alias("n_words"), (F.size("at") - 1).cast("long").alias("n_chunks"),
        F.size("k").cast("long").alias("n_common"),
        F.aggregate("shared", F.lit(0).cast("long"), lambda n, r: n + r["b"] - r["a"] + 1).alias("n_shared"),
        F.size(F.filter("m", lambda x: x["other"] & x["later"] & inside(x))).cast("long").alias("n_dropped"),
        F.size("m").cast("long").alias("n_repeated"), F.size("later").cast("long").alias("n_later"),
        spans_of("shared").alias("passages"), spans_of("dropped").alias("drop_spans"),
    )
    return out.withColumn("repeats", F.size("passages") > 0)


def without(text: str | None, spans: list[dict] | None) -> str | None:
    """The text without the words of the spans (sorted, apart) and the white space after them."""
    if not spans:
        return text
    body = text.encode("utf-8", "surrogatepass")
    starts = [*[m.start() for m in WORD.finditer(body)], len(body)]
    out, end = [], 0
    for span in spans:
        out.append(body[end : starts[span["start"]]])
        end = starts[span["stop"]]
    return b"".join([*out, body[end:]]).decode("utf-8", "surrogatepass")


def deduplicated(docs: DataFrame, text: str = "text", least: int = PASSAGE_WORDS) -> DataFrame:
    """``docs`` without the later occurrences of passages of ``least`` words: the first one stays, in the smallest doc_id.

    Shorter repeats stay too; with ``least`` 1 every chunk is left once in the corpus. All rows and columns stay; a text of which nothing is left is empty or white space.
    """
    row, spans = (free_name(x, docs.columns) for x in ("row", "drop_spans"))
    names = docs.columns
    known = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    found = shared_passages(known.select("doc_id", F.col(row).alias("row"), F.col(text).alias("text")), least=least, numbered=True)
    found = found.where(F.size("drop_spans") > 0).select(F.col("row").alias(row), F.col("drop_spans").alias(spans))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [without(t, s) for t, s in zip(batch.column(text).to_pylist(), batch.column(spans).to_pylist(), strict=True)]
            columns = [pa.array(texts, pa.string()) if c == text else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return join_one_per_key(known, found, row, "left").mapInArrow(run, docs.schema)


def op9_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = shared_passages(table(spark, folder, "documents"))
    shown = lambda c: F.array_join(F.transform(c, lambda p: F.concat_ws(":", p["start"], p["stop"])), ",")
    return found.withColumn("passages", shown("passages")).withColumn("drop_spans", shown("drop_spans"))
