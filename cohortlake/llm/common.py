"""What several operators share: tables, cut points, words, and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.operators.skew import join_one_per_key
from cohortlake.session import ensure_checkpoint_dir, shared_folder

#: White space that ends a word, as a character class for Java and SQL patterns.
SPACE = r"[\x20\x09-\x0D]"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless they find it by PYTHONPATH as the driver does."""
    package = Path(__file__).resolve().parents[1]
    given = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if package.parent in given or any(x.startswith(f"{package.name}-") for x in sc._python_includes):
        return
    packed = Path(tempfile.mkdtemp()) / f"{package.name}-{sc.applicationId}.zip"
    with zipfile.ZipFile(packed, "w") as out:
        for file in package.rglob("*.py"):
            out.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(packed))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder: computed once, safe from lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The same rows from Parquet files in the shared folder.

    The planner then knows their true size. After a checkpoint it keeps the estimate of the
    plan before, which is the product of the sizes for a join, so over many rounds of joins
    the estimates get so long that planning takes minutes.
    """
    place = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, with underscores before it until no column of the input has that name in either case."""
    lower = {x.lower() for x in taken}
    while wanted.lower() in lower:
        wanted = "_" + wanted
    return wanted


def ascii_words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8; ``bytes.split`` cuts at exactly the white space of ``SPACE``."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def local_roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index connected with each of ``size`` indices through the pairs (a, b).

    Labels sink to the smaller end of each pair and are then followed to their end, so the
    rounds grow with the logarithm of the longest chain.
    """
    root = np.arange(size)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, up := root[root]):
            root = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _one_per_node(edges: DataFrame, low: DataFrame) -> DataFrame:
    return join_one_per_key(edges, low, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root``: each node of the long columns ``u``, ``v`` with the smallest node it is connected with.

    Large-star and small-star rounds in turn until no edge changes. A round keeps at most
    as many edges as it got, and a node with very many edges is reduced by partial
    minimums and joined in pieces, never gathered. Nodes without an edge to another node
    are not returned.
    """
    edges = cut(edges.where("u <> v").distinct())
    seen = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _one_per_node(both, low).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Every edge now leads from the larger node to the smaller one.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _one_per_node(large, low)
        edges = cut(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
