"""Approximate nearest neighbours by an inverted file: vectors stored by centroid, queries that read a few lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.vector import BLOCK, block_top, knn

#: Vectors that centroids are fitted on, and queries that probes are chosen by, in expectation; both drawn by hash.
SAMPLE, ASKS = 20_000, 200
#: Lists at most; their number is otherwise the square root of that of the vectors. Centroids and the rows of each
#: list (a number a list) are all that the driver and the tasks hold of an index.
LISTS = 4_096
#: Recall that the sampled queries must reach.
TARGET = 0.95
ROUNDS = 10


@dataclass(frozen=True)
class Index:
    """path holds id, v, list, in order of list; sizes are the rows of each list, probes the lists that a query reads."""

    path: str
    centroids: np.ndarray
    sizes: np.ndarray
    probes: int

    def vectors(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def _fit(x: np.ndarray, lists: int) -> np.ndarray:
    """Lloyd's rounds from evenly chosen rows; a centroid that loses all its vectors stays where it is."""
    c = x[np.linspace(0, len(x) - 1, lists).astype(int)].copy()
    for _ in range(ROUNDS):
        at = _nearest(x, c)
        n = np.bincount(at, minlength=lists)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1)[None, :] - 2 * x @ c.T, axis=1)


def _usable(vectors: DataFrame, id_: str, vec: str) -> DataFrame:
    """id and v of the rows that take part: neither null, no component null or not finite."""
    v = F.col(vec).cast("array<double>")
    sound = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    return vectors.where(F.col(id_).isNotNull() & sound).select(F.col(id_).cast("long").alias("id"), v.alias("v"))


def _drawn(df: DataFrame, n: int, rows: int, seed: int) -> DataFrame:
    """rows of the n rows of df, in expectation, by the hash of their ids."""
    return df.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(n, 1))) < rows)


def build(vectors: DataFrame, path: str, id_: str = "id", vec: str = "embedding", lists: int | None = None, k: int = 20, target: float = TARGET) -> Index:
    """JN-6: store all vectors at path by their nearest of `lists` centroids, and choose the lists that a query reads.

    Centroids are fitted on SAMPLE rows in expectation. Probes are the fewest for which ASKS sampled rows
    (in expectation) find `target` of their exact k nearest; those are found by comparing these rows alone with
    all. Rows whose id or vector is null, or whose vector holds null or non-finite components, are left out.
    Vectors must have one length. An empty table gives an index that finds nothing.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, id_, vec)
    n = rows.count()
    sample = [r.v for r in _drawn(rows, n, SAMPLE, 1).orderBy("id").collect()] or [r.v for r in rows.limit(1).collect()]
    x = np.array(sample, np.float64)
    centroids = _fit(x, min(len(x), lists or min(LISTS, max(1, round(n**0.5))))) if n else x  # no rows, no lists

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = _nearest(np.array(b["v"].tolist(), np.float64), centroids) if len(b) else np.zeros(0, np.int64)
            yield b.assign(list=at.astype(np.int32))

    placed = rows.mapInPandas(assign, "id long, v array<double>, list int")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the hash of the id splits a list that is too large for one partition
    placed.repartitionByRange(parts, "list", F.xxhash64("id")).sortWithinPartitions("list").write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = np.zeros(len(centroids), np.int64)
    for r in stored.groupBy("list").count().collect():  # a row a list
        sizes[r["list"]] = r["count"]
    index = Index(path, centroids, sizes, len(centroids))
    return replace(index, probes=_calibrated(index, stored, n, k, target)) if n > 1 else index


def _calibrated(index: Index, stored: DataFrame, n: int, k: int, target: float) -> int:
    """The fewest lists, in each query's order, that hold `target` of the sampled queries' exact neighbours."""
    asks = _drawn(stored, n, ASKS, 2)
    exact = knn(stored, k, asks, vec="v").select("a", "b")
    at = exact.join(stored.select(F.col("id").alias("b"), "list"), "b").select("a", "list").toPandas()
    if not len(at):
        return len(index.centroids)
    ids = {r.id: r.v for r in asks.select("id", "v").collect()}
    a = {i: np.argsort(np.argsort(-(index.centroids @ np.array(v)), kind="stable"), kind="stable") for i, v in ids.items()}
    ranks = np.sort([a[i][c] for i, c in zip(at["a"], at["list"], strict=True)])
    return int(ranks[min(len(ranks) - 1, int(np.ceil(target * len(ranks))) - 1)]) + 1


def _probed(index: Index, queries: DataFrame, id_: str, vec: str, probes: int | None) -> DataFrame:
    """id, v, list: each query once for each list that it reads, the most promising ones by inner product."""
    c, p = index.centroids, min(probes or index.probes, len(index.centroids))

    def lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = np.array(b["v"].tolist(), np.float64) @ c.T if len(b) and len(c) else np.zeros((len(b), len(c)))
            yield pd.DataFrame({"id": b["id"], "v": b["v"], "lists": list(np.argsort(-s, axis=1, kind="stable")[:, :p].astype(np.int32))})

    return _usable(queries, id_, vec).mapInPandas(lists, "id long, v array<double>, lists array<int>").select("id", "v", F.explode("lists").alias("list"))


def search(index: Index, queries: DataFrame, k: int = 20, probes: int | None = None, id_: str = "id", vec: str = "embedding", block: int = BLOCK) -> DataFrame:
    """JN-6, WIN-2: a, b, sim, rank of each query's k nearest others in the lists it reads, ties to the smaller id.

    A list and the queries that read it meet in blocks of at most about `block` rows of each, so neither a list with
    most vectors nor one that most queries read is one task. Products are exact, in double precision.
    """
    spark = queries.sparkSession
    asked = _probed(index, queries, id_, vec, probes)
    per_list = {r["list"]: r["count"] for r in asked.groupBy("list").count().collect()}  # a row a list
    cuts = [(i, max(1, -(-int(index.sizes[i]) // block)), max(1, -(-n // block))) for i, n in per_list.items()]
    cuts = F.broadcast(spark.createDataFrame(cuts, "list int, n int, m int"))  # a row a list
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    of = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    left = asked.join(cuts, "list").select("id", "v", "list", of("m").alias("i"), every("n").alias("j"))
    right = index.vectors(spark).join(cuts, "list").select("id", "v", "list", every("m").alias("i"), of("n").alias("j"))
    key = ("list", "i", "j")
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(block_top(k), "a long, b long, sim double")
    w = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def compared(index: Index, queries: DataFrame, probes: int | None = None, id_: str = "id", vec: str = "embedding") -> int:
    """How many products search makes; queries times vectors would be all."""
    asked = _probed(index, queries, id_, vec, probes).groupBy("list").count().collect()  # a row a list
    return sum(int(index.sizes[r["list"]]) * r["count"] for r in asked)
