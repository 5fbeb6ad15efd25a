"""Quality rules: base statistics of whole texts and a learned decision list, all in built-in functions.

The list is found by sequential covering over labelled statistics. A rule is a conjunction
of thresholds that is grown one condition at a time by information gain on two thirds of
the labelled rows, pruned back on the rest, and accepted only if it is precise there; the
rows it covers are then set aside for the next rule. Every step is one aggregate over the
labelled rows that returns counts by feature and bin; the finished list is one ordered
conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm.common import SPACE, cut, free_name, table
from cohortlake.operators.skew import join_one_per_key

WINDOW = 3
#: Candidate thresholds per feature and class; rules at most; conditions in a rule at most.
QUANTILES, RULES, CONDITIONS = 24, 8, 3
#: Share of low-quality rows among those a rule covers, in either part, and their number in the pruning part.
PRECISION, SUPPORT = 0.995, 3
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bangs", "n_capitals", "n_lines")


def repeated_words(words: Column, hashes: Column, ordered: Column) -> Column:
    """Words that lie in a window whose hash occurs more than once, from windows sorted by (hash, place)."""
    same = F.filter(ordered, lambda x, i: (x["h"] == F.get(ordered, i + 1)["h"]) | (x["h"] == F.get(ordered, i - 1)["h"]))
    return F.sort_array(F.transform(same, lambda x: x["i"]))


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``COUNTS`` (long) for every whole text; null is an empty text.

    A column of the input with one of these names is replaced. Equal windows are told by 64-bit hashes of
    their words. Nothing here is recomputed inside a lambda: each array is a column of the
    projection below.
    """
    docs = docs.drop(*COUNTS)
    t, words, lines, h, s, p = (free_name(x, docs.columns) for x in ("t", "words", "lines", "h", "s", "p"))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    without = lambda marks: F.length(t) - F.length(F.regexp_replace(t, marks, ""))
    df = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias(t))
    df = df.select(
        *kept, F.array_remove(F.split(t, SPACE + "+"), "").alias(words),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(lines),
        without(r"[#*$%&|<>]").alias("n_symbols"), without("!").alias("n_bangs"), without("[A-Z]").alias("n_capitals"),
    )
    df = df.select(
        *kept, "n_symbols", "n_bangs", "n_capitals", F.size(words).alias("n_words"),
        F.length(F.array_join(words, "")).alias("word_chars"), F.size(lines).alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        F.slice(
            F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
            1, F.greatest(F.lit(0), F.size(words) - (WINDOW - 1)),
        ).alias(h),
    )
    counts = [F.col(c) for c in COUNTS if c != "n_repeat_words"]
    with_place = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.select(*kept, *counts, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(with_place)).otherwise(none).alias(s))
    df = df.select(*kept, *counts, repeated_words(F.col(words), F.col(h), F.col(s)).alias(p))
    # A window adds three words, or as many as lie between its start and the next one's.
    added = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
    repeat = F.aggregate(added, F.lit(0), lambda a, x: a + x)
    return df.select(*kept, *[(repeat if c == "n_repeat_words" else F.col(c)).cast("long").alias(c) for c in COUNTS])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """What rules look at: sizes and shares that have a meaning for a reader of the list."""
    per = lambda a, b: F.col(a) / F.greatest(F.lit(1), F.col(b))
    return {
        "words": F.col("n_words").cast("double"), "chars_per_word": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"), "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"), "bangs_per_word": per("n_bangs", "n_words"),
        "capital_share": per("n_capitals", "word_chars"), "words_per_line": per("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def meets(rule: Rule) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def decision(rules: list[Rule]) -> Column:
    """The first rule that a row meets, as text; null if none."""
    out = None
    for rule in rules:
        name = F.lit(" and ".join(map(str, rule)))
        out = F.when(meets(rule), name) if out is None else out.when(meets(rule), name)
    return F.lit(None).cast("string") if out is None else out.otherwise(F.lit(None).cast("string"))


def gain(p: float, n: float, p0: float, n0: float) -> float:
    """Information gained about low quality by keeping p of p0 low and n of n0 other rows."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learned(labelled: DataFrame, precision: float = PRECISION, support: int = SUPPORT) -> list[Rule]:
    """Rules for ``low`` (boolean) from rows with ``COUNTS``, ``low`` and ``part`` (0: prune, else grow).

    Only counts by feature and bin come to the driver, at most features x thresholds x 4 of
    them for each condition tried. No labelled rows, or none of one class, give no rules.
    """
    asked = features()
    probs = [(k + 0.5) / QUANTILES for k in range(QUANTILES)]
    by_class = labelled.groupBy("low").agg(*[F.percentile_approx(x, probs, 10_000).alias(name) for name, x in asked.items()]).collect()
    if len(by_class) < 2:
        return []
    cuts = {name: sorted({v for row in by_class for v in row[name]}) for name in asked}
    place = lambda name: F.size(F.filter(F.array(*map(F.lit, cuts[name])), lambda t: t < asked[name]))
    # A value's bin is the number of thresholds below it, so "> cuts[b]" is the bins above b.
    binned = F.explode(F.array(*[F.struct(F.lit(name).alias("f"), place(name).alias("b")) for name in asked]))
    rules: list[Rule] = []
    left = labelled
    while len(rules) < RULES:
        rule: Rule = ()
        scores: list[tuple[float, float, float]] = []
        while len(rule) < CONDITIONS:
            seen = left.where(meets(rule)).select("low", (F.col("part") > 0).alias("grow"), binned.alias("x"))
            cells = {}
            for r in seen.groupBy("x.f", "x.b", "low", "grow").agg(F.count("*").alias("n")).collect():
                cells[r["f"], r["b"], r["low"], r["grow"]] = r["n"]
            some = next(iter(asked))
            total = {(low, grow): sum(n for (f, _, lo, g), n in cells.items() if (f, lo, g) == (some, low, grow)) for low in (True, False) for grow in (True, False)}
            p0, n0 = total[True, True], total[False, True]
            if not p0 or not n0:
                break
            best = (False, 0.0, None, None)
            for name, at in cuts.items():
                below = dict.fromkeys(total, 0)
                for b, threshold in enumerate(at):
                    for key in below:
                        below[key] += cells.get((name, b, *key), 0)
                    for above in (True, False):
                        got = {k: total[k] - below[k] if above else below[k] for k in total}
                        p, n = got[True, True], got[False, True]
                        # A condition that makes the rule precise comes before any that only informs more.
                        sure = p >= support and p >= precision * (p + n)
                        best = max(best, (sure, gain(p, n, p0, n0), Condition(name, above, threshold), got), key=lambda x: x[:2])
            if best[2] is None:
                break
            rule += (best[2],)
            p, n = best[3][True, False], best[3][False, False]
            grown = best[3][True, True] / (best[3][True, True] + best[3][False, True])
            scores.append((min(grown, p / (p + n) if p + n else 0.0), p, n))
        # Pruned to the beginning that covers most of the rows it was not grown on, if precise on all.
        good = [k for k, (share, p, _) in enumerate(scores) if share >= precision and p >= support]
        if not good:
            break
        rule = rule[: 1 + max(good, key=lambda k: (scores[k][1] - scores[k][2], -k))]
        rules.append(rule)
        left = left.where(~meets(rule))
    return rules


def labelled_counts(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of documents with a label that did not fail the base rules; contradicting labels of a document are dropped."""
    low = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("q2")).where("q = q2")
    rows = join_one_per_key(counts.where(~base_failed()).select("doc_id", *COUNTS), low.select("doc_id", "q"), "doc_id")
    return rows.select(*COUNTS, (F.col("q") == 0).alias("low"), F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("part"))


def judged(counts: DataFrame, rules: list[Rule]) -> DataFrame:
    return counts.withColumn("base_failed", base_failed()).withColumn("rule", decision(rules)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, counts, ``base_failed``, ``rule`` (the first that a document meets, else null) and ``kept``.

    Null texts have no words and fail the base rules. Rows that repeat, or have no doc_id,
    are judged like any other; without a doc_id they are no examples to learn from.
    """
    counts = cut(counted(docs.select("doc_id", F.col(text).alias("text"))).drop("text"))
    return judged(counts, learned(cut(labelled_counts(counts, labels))))


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all its columns."""
    body = free_name("body", docs.columns)
    counts = cut(counted(docs.select("doc_id", F.col(text).alias("text"))).drop("text"))
    rules = learned(cut(labelled_counts(counts, labels)))
    # The number keeps the filter above the projections that count: pushed below, it would count anew for each use.
    number = free_name("number", docs.columns)
    mine = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias(body))
    out = judged(counted(mine, body), rules).withColumn(number, F.monotonically_increasing_id())
    return out.where(F.col("kept") & (F.col(number) >= 0)).select("row.*")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", *COUNTS[:5], "base_failed", "rule", "kept")
