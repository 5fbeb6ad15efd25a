"""Toxicity by a bidirectional gated recurrent network with attention pooling over overlapping windows.

A word enters as the evidence of the whole word and of its character 3-, 4- and 5-grams:
how much likelier a toxic training document is to hold it than another, by hash bucket.
Two gated recurrent layers read a window in both directions, attention weighs their
states, and a document scores as its highest window does. Everything is trained in numpy
on a bounded sample of labelled rows; every window of every document is scored in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.llm.common import ship, table

#: Labelled rows of each class that the model is fitted on, about; the only bound on what is read.
SAMPLE = 2500
WINDOW, STEP = 32, 24
BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
INPUTS, HIDDEN, ATTENTION = 2 * len(GRAMS) + 2, 8, 8
STEPS, MINED, BATCH, RATE = 400, 100, 128, 0.01
#: Documents below which a bucket's evidence is shrunk to half or less.
SHRINK = 6.0
TOXIC = 0.7
SEED = 6
#: Words a scoring worker remembers; windows scored at a time.
KNOWN, AT_ONCE = 300_000, 4096


# --- words -------------------------------------------------------------------------------

def word_buckets(words: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Buckets of whole words; per gram length the buckets of all grams in turn and where each word's begin.

    Words are lower-cased and marked at both ends. Words shorter than a gram have one, of the bytes there are.
    """
    plain = [b"^" + (w.strip(".,!?:;\"'()[]|#*$%&") or w).lower().encode("utf-8", "replace") + b"$" for w in words]
    sizes = np.array([len(w) for w in plain])
    raw = np.frombuffer(b"".join(plain), dtype=np.uint8).astype(np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    powers = np.uint64(0x9E3779B97F4A7C15)

    def mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h ^ (h >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64)

    # Position within the word orders its letters; the sum tells words apart.
    place = (np.arange(len(raw)) - np.repeat(starts, sizes)).astype(np.uint64)
    letters = (raw + np.uint64(1)) * (place * powers + np.uint64(0x2545F4914F6CDD1D))
    whole = mixed(np.add.reduceat(letters ^ (letters >> np.uint64(17)), starts) if len(starts) else np.zeros(0, np.uint64))
    grams = []
    for n in GRAMS:
        h = np.zeros(len(raw), dtype=np.uint64)
        for k in range(n):
            h = h * np.uint64(1000003)
            h[: len(raw) - k] += raw[k:] + np.uint64(1)
        counts = np.maximum(1, sizes - n + 1)
        begin = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
        at = np.repeat(starts - begin, counts) + np.arange(counts.sum())
        grams.append((mixed(h[at] + np.uint64(n)), begin))
    return whole, grams


@dataclass
class Evidence:
    """Evidence by bucket: of whole words first, then of each gram length."""

    tables: list[np.ndarray]

    def inputs(self, words: list[str]) -> np.ndarray:
        """For each word the evidence of the word, the largest and the mean of its grams, and whether the word is known."""
        if not words:
            return np.zeros((0, INPUTS), dtype=np.float32)
        whole, grams = word_buckets(words)
        out = [self.tables[0][whole]]
        for (buckets, begin), scores in zip(grams, self.tables[1:], strict=True):
            e = scores[buckets]
            n = np.diff([*begin, len(e)])
            out += [np.maximum.reduceat(e, begin), np.add.reduceat(e, begin) / n]
        out.append((out[0] != 0).astype(np.float32))
        return np.stack(out, axis=1).astype(np.float32)


def evidence(documents: list[list[str]], toxic: np.ndarray) -> Evidence:
    """Shrunk log ratios of how many documents of either class hold a bucket."""
    counts = [np.zeros((2, BUCKETS), dtype=np.int64) for _ in range(len(GRAMS) + 1)]
    for words, y in zip(documents, toxic, strict=True):
        if not (unique := list(set(words))):
            continue
        whole, grams = word_buckets(unique)
        for k, buckets in enumerate([whole, *[b for b, _ in grams]]):
            counts[k][int(y), np.unique(buckets)] += 1
    n0, n1 = int((toxic == 0).sum()), int((toxic == 1).sum())
    tables = []
    for c in counts:
        seen = c.sum(axis=0)
        ratio = np.log((c[1] + 0.5) / (n1 + 1)) - np.log((c[0] + 0.5) / (n0 + 1))
        tables.append(np.where(seen > 0, ratio * seen / (seen + SHRINK), 0).astype(np.float32))
    return Evidence(tables)


# --- the network -------------------------------------------------------------------------

def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fresh(seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    zero = lambda *shape: np.zeros(shape, dtype=np.float32)
    p = {}
    for d in "fb":
        p |= {f"in_{d}": draw(INPUTS, 3 * HIDDEN), f"bias_{d}": zero(3 * HIDDEN), f"gates_{d}": draw(HIDDEN, 2 * HIDDEN), f"new_{d}": draw(HIDDEN, HIDDEN)}
    return p | {"att": draw(2 * HIDDEN, ATTENTION), "att_bias": zero(ATTENTION), "att_out": draw(ATTENTION), "out": draw(2 * HIDDEN), "out_bias": zero(1)}


def read(p: dict, d: str, projected: np.ndarray, mask: np.ndarray, keep: bool):
    """States (batch, window, hidden) of one direction from projected inputs; with ``keep`` also what training needs."""
    n, length, _ = projected.shape
    h, states, saved = np.zeros((n, HIDDEN), dtype=np.float32), np.empty((n, length, HIDDEN), dtype=np.float32), []
    for t in range(length) if d == "f" else range(length - 1, -1, -1):
        x, m = projected[:, t], mask[:, t, None]
        gates = sigmoid(x[:, : 2 * HIDDEN] + h @ p[f"gates_{d}"])
        reset, update = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(x[:, 2 * HIDDEN :] + (reset * h) @ p[f"new_{d}"])
        before = h
        h = h + m * update * (new - h)
        states[:, t] = h
        if keep:
            saved.append((t, before, reset, update, new, m))
    return states, saved


def attend(p: dict, states: np.ndarray, mask: np.ndarray):
    u = np.tanh(states @ p["att"] + p["att_bias"])
    e = np.where(mask > 0, u @ p["att_out"], -1e9)
    a = np.exp(e - e.max(axis=1, keepdims=True))
    a /= a.sum(axis=1, keepdims=True)
    pooled = np.einsum("nt,nth->nh", a, states)
    return pooled @ p["out"] + p["out_bias"][0], (u, a, pooled)


def logits(p: dict, projected: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Of windows given as inputs projected for both directions, side by side."""
    states = np.concatenate([read(p, d, projected[:, :, k * 3 * HIDDEN : (k + 1) * 3 * HIDDEN], mask, False)[0] for k, d in enumerate("fb")], axis=2)
    return attend(p, states, mask)[0]


def project(p: dict, x: np.ndarray) -> np.ndarray:
    return np.concatenate([x @ p[f"in_{d}"] + p[f"bias_{d}"] for d in "fb"], axis=-1)


def gradients(p: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy of windows and its derivative by every parameter."""
    n = len(x)
    projected = project(p, x)
    runs = [read(p, d, projected[:, :, k * 3 * HIDDEN : (k + 1) * 3 * HIDDEN], mask, True) for k, d in enumerate("fb")]
    states = np.concatenate([r[0] for r in runs], axis=2)
    z, (u, a, pooled) = attend(p, states, mask)
    q = sigmoid(z)
    loss = float(-np.mean(y * np.log(q + 1e-7) + (1 - y) * np.log(1 - q + 1e-7)))
    dz = (q - y) / n
    g = {"out": pooled.T @ dz, "out_bias": np.array([dz.sum()], dtype=np.float32)}
    d_pooled = dz[:, None] * p["out"]
    d_a = np.einsum("nh,nth->nt", d_pooled, states)
    d_states = a[:, :, None] * d_pooled[:, None, :]
    d_e = a * (d_a - (a * d_a).sum(axis=1, keepdims=True))
    g["att_out"] = np.einsum("nt,ntk->k", d_e, u)
    d_u = d_e[:, :, None] * p["att_out"] * (1 - u * u)
    g["att"] = np.einsum("nth,ntk->hk", states, d_u)
    g["att_bias"] = d_u.sum(axis=(0, 1))
    d_states = d_states + d_u @ p["att"].T
    for k, d in enumerate("fb"):
        d_own, d_h = d_states[:, :, k * HIDDEN : (k + 1) * HIDDEN], np.zeros((n, HIDDEN), dtype=np.float32)
        g[f"gates_{d}"], g[f"new_{d}"] = np.zeros_like(p[f"gates_{d}"]), np.zeros_like(p[f"new_{d}"])
        d_x = np.zeros((n, x.shape[1], 3 * HIDDEN), dtype=np.float32)
        for t, before, reset, update, new, m in reversed(runs[k][1]):
            d_h = d_h + d_own[:, t]
            d_update = d_h * m * (new - before) * update * (1 - update)
            d_new = d_h * m * update * (1 - new * new)
            d_rh = d_new @ p[f"new_{d}"].T
            d_reset = d_rh * before * reset * (1 - reset)
            d_gates = np.concatenate([d_reset, d_update], axis=1)
            g[f"gates_{d}"] += before.T @ d_gates
            g[f"new_{d}"] += (reset * before).T @ d_new
            d_x[:, t] = np.concatenate([d_gates, d_new], axis=1)
            d_h = d_h * (1 - m * update) + d_gates @ p[f"gates_{d}"].T + d_rh * reset
        g[f"in_{d}"] = np.einsum("nti,ntk->ik", x, d_x)
        g[f"bias_{d}"] = d_x.sum(axis=(0, 1))
    return loss, g


# --- windows and documents ---------------------------------------------------------------

def windows(n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (window, place) and mask of all overlapping windows of a text; the last ends with the text."""
    if n_words <= WINDOW:
        at = np.arange(WINDOW)[None, :]
        return np.where(at < n_words, at, 0), (at < max(1, n_words)).astype(np.float32)
    starts = np.unique(np.concatenate([np.arange(0, n_words - WINDOW, STEP), [n_words - WINDOW]]))
    return starts[:, None] + np.arange(WINDOW), np.ones((len(starts), WINDOW), dtype=np.float32)


@dataclass
class Model:
    evidence: Evidence
    weights: dict[str, np.ndarray]
    scale: float
    shift: float

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * logit + self.shift)


def best_windows(p: dict, inputs: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The highest window of each document (its word numbers) and its logit."""
    out, top = [], []
    for x in inputs:
        at, mask = windows(len(x))
        z = logits(p, project(p, x[at]), mask)
        out.append(at[int(z.argmax())])
        top.append(float(z.max()))
    return out, np.array(top)


def trained(texts: list[str], toxic: np.ndarray, seed: int = SEED) -> Model | None:
    """Fit on whole documents: the window that scores highest stands for its document and is chosen anew after some steps.

    Evidence for training is taken from the other half of the documents, so that the
    network learns how far evidence holds for documents it was not taken from. None if a
    class is missing.
    """
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    documents = [t.split() or [""] for t in texts]
    half = np.random.default_rng(seed).permutation(len(documents)) % 2
    crossed = [evidence([d for d, h in zip(documents, half, strict=True) if h != k], toxic[half != k]) for k in (0, 1)]
    inputs = [crossed[half[k]].inputs(d) for k, d in enumerate(documents)]
    p, rng = fresh(seed), np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    # At first the window with the most evidence stands for its document.
    chosen = [at[int(x[:, 0][at].clip(0).sum(axis=1).argmax())] for x in inputs for at, _ in [windows(len(x))]]
    classes = [np.flatnonzero(toxic == k) for k in (0, 1)]
    for step in range(STEPS):
        if step and step % MINED == 0:
            chosen, _ = best_windows(p, inputs)
        part = np.concatenate([rng.choice(c, BATCH // 2) for c in classes])  # both classes weigh the same
        x = np.stack([inputs[i][chosen[i]] for i in part])
        mask = np.stack([(np.arange(WINDOW) < len(inputs[i])).astype(np.float32) for i in part])
        _, g = gradients(p, x, mask, toxic[part].astype(np.float32))
        rate = RATE * (1 - step / STEPS)
        for name, value in g.items():
            m, v = moments[name]
            m += 0.1 * (value - m)
            v += 0.001 * (value * value - v)
            p[name] -= (rate * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.999 ** (step + 1))) + 1e-8)).astype(np.float32)
    _, top = best_windows(p, inputs)
    scale, shift = calibrated(top, toxic)
    return Model(evidence(documents, toxic), p, scale, shift)


def calibrated(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of documents' logits by logistic regression, both classes weighing the same."""
    w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    a, b = 1.0, 0.0
    for _ in range(50):
        q = sigmoid(a * logit + b)
        r, c = w * (q - y), w * q * (1 - q) + 1e-9
        grad = np.array([(r * logit).sum() + 1e-3 * (a - 1), r.sum()])
        hess = np.array([[(c * logit * logit).sum() + 1e-3, (c * logit).sum()], [(c * logit).sum(), c.sum() + 1e-6]])
        da, db = np.clip(np.linalg.solve(hess, grad), -1, 1)
        a, b = a - da, b - db
    return float(a), float(b)


class Scorer:
    """Scores whole texts; remembers projected inputs of words it has met."""

    def __init__(self, model: Model):
        self.model, self.rows = model, {}
        self.projected = np.zeros((KNOWN, 6 * HIDDEN), dtype=np.float32)

    def _learn(self, words: set[str]) -> None:
        new = sorted(words.difference(self.rows))
        if len(self.rows) + len(new) > len(self.projected):
            self.rows = {}
            new = sorted(words)
        if len(new) > len(self.projected):
            self.projected = np.zeros((len(new), 6 * HIDDEN), dtype=np.float32)
        at = len(self.rows)
        self.projected[at : at + len(new)] = project(self.model.weights, self.model.evidence.inputs(new))
        self.rows.update(zip(new, range(at, at + len(new)), strict=True))

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities; a text without words, or null, scores as one empty word."""
        out = np.full(len(texts), -np.inf)
        group: list[tuple[int, list[str]]] = []
        size = 0
        for k, text in enumerate(texts):
            words = (text or "").split() or [""]
            group.append((k, words))
            size += len(words)
            if size > WINDOW * AT_ONCE or k == len(texts) - 1:
                self._learn(set().union(*[w for _, w in group]))
                self._score(group, out)
                group, size = [], 0
        return self.model.probability(out)

    def _score(self, group: list[tuple[int, list[str]]], out: np.ndarray) -> None:
        look = self.rows.__getitem__
        ids, masks, of = [], [], []
        for k, words in group:
            at, mask = windows(len(words))
            ids.append(np.fromiter(map(look, words), dtype=np.int64, count=len(words))[at])
            masks.append(mask)
            of.append(np.full(len(at), k))
        ids, masks, of = np.concatenate(ids), np.concatenate(masks), np.concatenate(of)
        for k in range(0, len(ids), AT_ONCE):
            z = logits(self.model.weights, self.projected[ids[k : k + AT_ONCE]], masks[k : k + AT_ONCE])
            np.maximum.at(out, of[k : k + AT_ONCE], z)


def held_out() -> Column:
    """Rows that are never learned from; a null doc_id is not learned from either, but not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, text: str = "text") -> tuple[list[str], np.ndarray]:
    """About ``size`` labelled texts of each class, drawn by a hash of doc_id; documents with contradicting labels are left out."""
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.min("toxic").alias("y"), F.max("toxic").alias("y2"))
    marks = marks.where((F.col("y") == F.col("y2")) & ~held_out()).select("doc_id", "y")
    counts = {r[0]: r[1] for r in marks.groupBy("y").count().collect()}
    draw = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rates = {y: min(1.0, size / n) for y, n in counts.items()}
    if not {0, 1} <= set(rates):
        return [], np.zeros(0)
    drawn = marks.where(draw < F.when(F.col("y") == 1, rates[1]).otherwise(rates[0]))
    # The same draw leaves out most documents before they are shuffled to meet their labels.
    some = docs.select("doc_id", F.col(text).alias("text")).where((draw < max(rates.values())) & ~held_out())
    rows = some.join(drawn, "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y").collect()
    rows.sort(key=lambda r: (r[0], r[1]))
    return [r[1] for r in rows], np.array([r[2] for r in rows])


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", toxic: float = TOXIC) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every whole text; nothing but the text enters a score.

    Null texts are empty and get the score of no words. Repeated rows are scored each. If
    the labels do not show both classes there is nothing to learn and every score is 0.5.
    Other columns are left out.
    """
    ship(docs.sparkSession)
    model = trained(*sample(docs, labels, text=text))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value) if sent.value else None
        for batch in batches:
            texts = batch.column(2).to_pylist()
            scores = scorer.score(texts) if scorer else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "score"])

    frame = docs.select("doc_id", held_out().alias("held_out"), F.col(text).alias("text"))
    kinds = T.StructType([*frame.schema.fields[:2], T.StructField("score", T.DoubleType())])
    return frame.mapInArrow(run, kinds).withColumn("predicted", (F.col("score") >= toxic).cast("int"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return scored(table(spark, folder, "documents"), table(spark, folder, "labels"))
