"""Pipeline stages of this package: what is fitted is saved with the pipeline as plain parameters."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import forest
from ..operators.moments import centre_sums, dot, moments, nearest_centre, packed
from ..operators.quantiles import exact_medians


def _param(name: str) -> Param:
    return Param(Params._dummy(), name, name)


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose parameters are given by name."""

    @keyword_only
    def __init__(self, **given: object):
        super().__init__()
        self._set(**{k: v for k, v in given.items() if v is not None})

    def value(self, name: str) -> object:
        return self.getOrDefault(name)


class MedianImputer(_Stage, Estimator):
    """Learn the exact median of each of ``columns``; nulls are skipped, a column of nulls has 0."""

    columns = _param("columns")

    def _fit(self, df: DataFrame) -> "FilledColumns":
        columns = self.value("columns")
        # One number per column.
        medians = {r["feature"]: r["median"] for r in exact_medians(df, columns).collect()}
        return FilledColumns(columns=columns, values=[float(medians.get(c, 0.0)) for c in columns])


class FilledColumns(_Stage, Model):
    """Columns as doubles with nulls replaced by what was learned; a column that is not there gets it everywhere."""

    columns = _param("columns")
    values = _param("values")

    def _transform(self, df: DataFrame) -> DataFrame:
        def filled(c: str, v: float) -> Column:
            return F.coalesce(F.col(c).cast("double"), F.lit(v)) if c in df.columns else F.lit(v)

        return df.withColumns({c: filled(c, v) for c, v in zip(self.value("columns"), self.value("values"))})


class LevelFlags(_Stage, Estimator):
    """Learn the sorted levels of ``column``; they are few, each becomes a position of ``output``."""

    column = _param("column")
    output = _param("output")

    def _fit(self, df: DataFrame) -> "FlaggedLevels":
        column = self.value("column")
        return FlaggedLevels(column=column, output=self.value("output"), levels=levels_of(df, column))


class FlaggedLevels(_Stage, Model):
    """An array of 0/1 flags, one per level; a value that was not seen sets none."""

    column = _param("column")
    output = _param("output")
    levels = _param("levels")

    def _transform(self, df: DataFrame) -> DataFrame:
        value = F.col(self.value("column"))
        flags = [F.coalesce((value == v).cast("double"), F.lit(0.0)) for v in self.value("levels")]
        return df.withColumn(self.value("output"), F.array(*flags) if flags else F.array().cast("array<double>"))


def levels_of(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a category column; each becomes a column of its own, so they are few."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)
    return [r[0] for r in values.collect()]


def standardised_by(values: Column, means: list[float], deviations: list[float]) -> Column:
    """An array minus means over deviations, by position; where the deviation is 0 the result is 0."""
    inverse = F.array(*[F.lit(1.0 / d if d else 0.0) for d in deviations])
    centred = F.zip_with(values, F.array(*[F.lit(m) for m in means]), lambda x, m: x - m)
    return F.zip_with(centred, inverse, lambda x, s: x * s)


def joined(columns: list[str], arrays: list[str]) -> Column:
    """Plain columns and array columns as one array."""
    return F.concat(F.array(*[F.col(f"`{c}`") for c in columns]).cast("array<double>"), *[F.col(a) for a in arrays])


class PopulationScaler(_Stage, Estimator):
    """Learn means and population deviations of ``columns`` and of the positions of ``arrays``."""

    columns = _param("columns")
    arrays = _param("arrays")
    output = _param("output")

    def _fit(self, df: DataFrame) -> "ScaledFeatures":
        columns, arrays = self.value("columns"), self.value("arrays")
        whole = df.select(joined(columns, arrays).alias("x"))
        first = whole.first()
        found = moments(whole, "x", len(first["x"]) if first else len(columns))
        deviation = np.sqrt(np.diag(found.scatter) / max(1, found.n))
        return ScaledFeatures(
            columns=columns, arrays=arrays, output=self.value("output"), means=found.mean.tolist(), deviations=deviation.tolist()
        )


class ScaledFeatures(_Stage, Model):
    """``output``: a vector of all features minus mean over deviation; constant ones are 0."""

    columns = _param("columns")
    arrays = _param("arrays")
    output = _param("output")
    means = _param("means")
    deviations = _param("deviations")

    def _transform(self, df: DataFrame) -> DataFrame:
        whole = joined(self.value("columns"), self.value("arrays"))
        scaled = standardised_by(whole, self.value("means"), self.value("deviations"))
        return df.withColumn(self.value("output"), array_to_vector(scaled))


class Ridge(_Stage, Estimator):
    """Least squares of ``target`` on the vector ``features`` with a penalty on squared weights, by one pass.

    The constant is not penalised: sums and cross products are centred, the weights solve
    (Z'Z + alpha I) w = Z'y.
    """

    features = _param("features")
    target = _param("target")
    output = _param("output")
    alpha = _param("alpha")

    def _fit(self, df: DataFrame) -> "LinearScore":
        features, target = self.value("features"), F.col(self.value("target")).cast("double")
        rows = df.select(F.concat(vector_to_array(features), F.array(target)).alias("x"))
        first = rows.first()
        if first is None:
            raise ValueError("no rows to fit")
        found = moments(rows, "x", len(first["x"]))
        cross, own = found.scatter[:-1, :-1], found.scatter[:-1, -1]
        weights = np.linalg.solve(cross + self.value("alpha") * np.eye(len(own)), own)
        constant = found.mean[-1] - found.mean[:-1] @ weights
        left = found.scatter[-1, -1] - 2 * weights @ own + weights @ cross @ weights
        r2 = float(1 - left / found.scatter[-1, -1]) if found.scatter[-1, -1] > 0 else 0.0
        return LinearScore(features=features, output=self.value("output"), weights=weights.tolist(), constant=float(constant), r2=r2)


class LinearScore(_Stage, Model):
    """``output``: constant plus weighted features."""

    features = _param("features")
    output = _param("output")
    weights = _param("weights")
    constant = _param("constant")
    r2 = _param("r2")

    def _transform(self, df: DataFrame) -> DataFrame:
        score = dot(vector_to_array(self.value("features")), self.value("weights")) + F.lit(self.value("constant"))
        return df.withColumn(self.value("output"), score)


class VotesOfForests(_Stage, Model):
    """``probability`` and ``prediction`` from the votes of several forests, vectors ``inputs``, as one forest of all their trees has them."""

    inputs = _param("inputs")

    def _transform(self, df: DataFrame) -> DataFrame:
        votes = [vector_to_array(c) for c in self.value("inputs")]
        added = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), votes)
        total = F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
        best = F.array_position("_votes", F.array_max("_votes")) - 1  # the first one on ties
        return df.withColumn("_votes", added).withColumns(
            {"probability": array_to_vector(F.transform("_votes", lambda x: x / total)), "prediction": best.cast("double")}
        ).drop("_votes")


class StoredForest(_Stage, Model):
    """``output``: the votes of a forest that is kept as tables below ``folder``, a vector by class.

    ``nodes`` has a row per node, ``trees`` a row per tree, packed for votes. Both are saved with the stage.
    """

    features = _param("features")
    output = _param("output")
    folder = _param("folder")
    classes = _param("classes")
    depth = _param("depth")
    tables = ("nodes", "trees")

    def getRawPredictionCol(self) -> str:
        return self.value("output")

    def nodes(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.value('folder')}/nodes")

    def _transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        if getattr(self, "_sent_by", None) != spark.sparkContext.applicationId:
            self._sent, self._sent_by = forest.sent(spark, f"{self.value('folder')}/trees"), spark.sparkContext.applicationId
        vote = forest.votes(self._sent, self.value("classes"))
        return df.withColumn(self.value("output"), array_to_vector(vote(vector_to_array(self.value("features")))))

    def write(self) -> MLWriter:
        return _WithTables(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _FromTables(cls)


class _WithTables(MLWriter):
    """Saves the parameters of a stage, and its tables beside them."""

    def __init__(self, stage: StoredForest):
        super().__init__()
        self._stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self._stage, path, self.sparkSession)
        for name in self._stage.tables:
            self.sparkSession.read.parquet(f"{self._stage.value('folder')}/{name}").write.parquet(f"{path}/{name}")


class _FromTables(DefaultParamsReader):
    """Loads a stage that reads the tables beside its parameters."""

    def load(self, path: str) -> StoredForest:
        return super().load(path)._set(folder=path)


class CentresOfStarts(_Stage, Estimator):
    """k-means from several starts that run side by side: one job over the data per round, for all of them.

    Starting centres are drawn far apart from a bounded ``sample`` of rows; the rounds and the
    cost are over all rows. A start is done when its centres stay where they are.
    """

    features = _param("features")
    output = _param("output")
    k = _param("k")
    starts = _param("starts")
    seed = _param("seed")
    rounds = _param("rounds")
    sample = _param("sample")

    def _fit(self, df: DataFrame) -> "NearestCentre":
        k, starts = self.value("k"), self.value("starts")
        rows = df.select(vector_to_array(self.value("features")).alias("x"))
        first = rows.first()
        if first is None:
            raise ValueError("no rows to fit")
        # The rounds read matrices; the draw reads the rows once.
        blocks = packed(rows, "x", len(first["x"])).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            drawn = rows.orderBy(F.xxhash64("x"), "x").limit(self.value("sample")).toArrow()
            points = np.array(drawn.column("x").to_pylist(), dtype=float)
            rng = np.random.default_rng(self.value("seed"))
            centres = np.stack([spread_centres(points, k, rng) for _ in range(starts)])
            open_, cost = np.arange(starts), np.full(starts, np.inf)
            for _ in range(self.value("rounds") + 1):
                sums, counts, cost[open_] = centre_sums(blocks, centres[open_])
                moved = np.where(counts[..., None] > 0, sums / np.maximum(counts, 1)[..., None], centres[open_])
                far = np.abs(moved - centres[open_]).max(axis=(1, 2))
                centres[open_] = moved
                open_ = open_[far > 1e-9]
                if not len(open_):
                    break
            best = int(np.argmin(cost))
        finally:
            blocks.unpersist()
        return NearestCentre(features=self.value("features"), output=self.value("output"), centres=centres[best].tolist(), cost=float(cost[best]))


def spread_centres(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k rows, each drawn with a chance that grows with its squared distance to those before."""
    chosen = [points[rng.integers(len(points))]]
    while len(chosen) < k:
        far = np.min([((points - c) ** 2).sum(axis=1) for c in chosen], axis=0)
        total = far.sum()
        chosen.append(points[rng.choice(len(points), p=far / total) if total > 0 else rng.integers(len(points))])
    return np.array(chosen)


class NearestCentre(_Stage, Model):
    """``output``: number of the nearest centre."""

    features = _param("features")
    output = _param("output")
    centres = _param("centres")
    cost = _param("cost")

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.value("output"), nearest_centre(vector_to_array(self.value("features")), self.value("centres")))
