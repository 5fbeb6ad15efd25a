"""Mixing sources to target weights by fitting subset sums of document lengths.

Each source gets a budget of words. What the whole source covers once or several times is
taken as whole passes; the rest is fitted from counts of documents by exact length: the
same share of every length first, then single lengths from the longest down, and the last
``FIT_WORDS`` words by a bounded-knapsack dynamic programme over lengths. How many
documents of a length are taken is exact; which ones is decided by a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import SPACE, cut, free_name, ship, table

WEIGHTS = (5, 2, 1)
#: No document, and so no source, is taken more often than this.
MOST = 3
SEED = 7
#: Words that the dynamic programme fits; what is left before it is below this and one document.
FIT_WORDS = 1 << 17
#: Documents of one source and length that are put in order together, on average at most.
ROWS_TOGETHER = 50_000


def word_count(text) -> F.Column:
    """Number of words in a whole text; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> dict[str | None, float]:
    """Words per source: shares of all words by weight, none above ``most`` times the source, the excess reshared."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out: dict[str | None, float] = {}
    free, total = order, float(sum(sizes.values()))
    while free:
        unit = (total - sum(out.values())) / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > most * sizes[s]]
        for s in over or free:
            out[s] = float(most * sizes[s]) if over else unit * weight[s]
        free = [s for s in free if s not in out]
    return out


def fitted(lengths: np.ndarray, counts: np.ndarray, budget: int, limit: int = FIT_WORDS) -> np.ndarray:
    """How many documents of each length to take so that their words come as near ``budget`` as can be found."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return np.zeros_like(counts)
    if budget >= total:
        return counts.copy()
    # floor(count * budget / total) in whole numbers; Python's do not overflow.
    take = np.array([int(c) * budget // total for c in counts], dtype=np.int64)
    left = budget - int((take * lengths).sum())
    for k in np.argsort(-lengths)[: int((lengths > 0).sum())]:
        n = min(int(counts[k] - take[k]), max(0, left - limit) // int(lengths[k]))
        take[k] += n
        left -= n * int(lengths[k])
    spare = counts - take
    near = np.flatnonzero((spare > 0) & (lengths > 0))
    if not len(near) or left <= 0:
        return take
    reach = left + int(lengths[near].min())  # a little above the budget may be nearer than below
    if reach <= 16 * limit:
        items: list[tuple[int, int]] = []
        first = np.full(reach + 1, -1, dtype=np.int32)
        got = np.zeros(reach + 1, dtype=bool)
        got[0] = True
        for k in near[np.argsort(lengths[near])]:
            some = min(int(spare[k]), reach // int(lengths[k]))
            part = 1
            while some > 0 and not got[left]:
                n = min(part, some)
                w = n * int(lengths[k])
                new = got[: reach + 1 - w] & ~got[w:]
                first[w:][new] = len(items)
                got[w:] |= new
                items.append((int(k), n))
                some, part = some - n, part * 2
            if got[left]:
                break
        sums = np.flatnonzero(got)
        at = int(sums[np.argmin(np.abs(sums - left))])
        while at:
            k, n = items[first[at]]
            take[k] += n
            at -= n * int(lengths[k])
    elif int(lengths[near].min()) < 2 * left:
        take[near[np.argmin(lengths[near])]] += 1  # only documents longer than the programme's reach are left
    return take


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, sized: bool = False) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` (words that the mix takes of the row).

    ``taken`` is a multiple of ``size``, at most ``most`` times it. Null texts and texts
    without words have size 0 and nothing is taken of them. A null source is a source of
    its own, last in order. Rows that repeat are rows of their own; among equal rows it
    does not matter which is taken. An empty table gives no rows. Columns of the input
    named like results are replaced; with ``sized`` its column ``size`` holds the words
    already. The hash that orders documents of one length takes seed, doc_id and the
    column ``text``, so reruns and other partitionings agree.

    One row per source goes to the driver, which shares the budget; everything else stays
    in tables. Documents of a source and length are spread over salts, so no task orders
    more than about ``ROWS_TOGETHER`` of them.
    """
    ship(docs.sparkSession)
    docs = docs.drop("source_size", "target", "taken")
    draw, salt, place, allot, passes = (free_name(x, docs.columns) for x in ("draw", "salt", "place", "allot", "passes"))
    if not sized:
        docs = docs.withColumn("size", word_count(F.col("text")))
    docs = docs.withColumn(draw, F.xxhash64(F.lit(seed), "doc_id", "text"))
    spark = docs.sparkSession
    hist = cut(docs.groupBy("source", "size").agg(F.count("*").alias("n")))
    sizes = {r[0]: r[1] for r in hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long")).collect()}
    salts = (hist.agg(F.max("n")).first()[0] or 0) // ROWS_TOGETHER + 1
    goals = []
    for source, target in targets(sizes, weights, most).items():
        whole = min(most, int(target // sizes[source])) if sizes[source] else 0
        rest = round(target - whole * sizes[source]) if whole < most else 0
        goals.append((source, sizes[source], target, whole, rest))
    goals = spark.createDataFrame(goals, f"source string, source_size long, target double, {passes} int, rest long")
    plan = hist.alias("h").join(goals.alias("g"), F.expr("h.source <=> g.source")).select("h.source", "size", "n", "source_size", "target", passes, "rest")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        take = fitted(rows["size"].to_numpy(), rows["n"].to_numpy(), int(rows["rest"].iloc[0]))
        return rows.drop(columns=["rest"]).assign(take=take)

    plan = cut(plan.groupBy("source").applyInPandas(fit, f"source string, size long, n long, source_size long, target double, {passes} int, take long"))
    spread = F.pmod(F.col(draw), F.lit(salts)).alias(salt)
    by_salt = docs.select("source", "size", spread).groupBy("source", "size", salt).agg(F.count("*").alias("m"))
    # Salts are filled one after the other; a source and length has at most ``salts`` of them.
    before = F.sum("m").over(Window.partitionBy("source", "size").orderBy(salt)) - F.col("m")
    by_salt = by_salt.withColumn("before", before).alias("s").join(plan.alias("p"), F.expr("s.source <=> p.source and s.size = p.size"))
    allotted = by_salt.select(
        "s.source", "s.size", salt, "source_size", "target", passes,
        F.greatest(F.lit(0), F.least("m", F.col("take") - F.col("before"))).alias(allot),
    )
    ordered = docs.withColumn(salt, spread).withColumn(place, F.row_number().over(Window.partitionBy("source", "size", salt).orderBy(draw, "doc_id")))
    on = F.expr(f"d.source <=> a.source and d.size = a.size and d.{salt} = a.{salt}")
    out = ordered.alias("d").join(allotted.alias("a"), on)
    times = F.col(passes) + (F.col(place) <= F.col(allot)).cast("int")
    kept = [F.col(f"d.`{c}`") for c in docs.columns if c != draw]
    return out.select(*kept, "a.source_size", "a.target", (F.col("d.size") * times).cast("long").alias("taken"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    narrow = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text")))
    return mixed(narrow, sized=True).select("doc_id", "size", "source_size", "target", "taken")
