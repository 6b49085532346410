"""Whitening of embeddings by a tall-skinny QR (Benson, Gleich, Demmel 2013): no covariance is formed on the way.

Entries become integers, so that sums over the table are exact and rows are centred without rounding. Each partition
folds its centred rows into one triangular factor R, as many rows at a time as keep memory bounded; the factors are
merged in a tree of small groups; the singular values and right vectors of the last R are those of the whole table.
The error of the result is measured by another pass, whose partitions are merged in the same tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, release
from millrace.session import cut, drop, table

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
#: Factors that one task of the tree merges; rows that a partition gathers before it folds them in, at least.
FAN, ROWS = 16, 2048
#: Entries from here on have no x that is a long.
LARGE = float(1 << 56)
_MOST = (1 << 63) - 1


@dataclass
class Model:
    """n, the exact sums of x, and for each component its direction (a row), variance and share of the total variance."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)[0]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions.T / np.sqrt(self.variances)


def usable(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGE))


def remaining(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id and embedding (doubles) of the rows that take part, and their dimension: the most frequent one, of equals the smaller."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    v = v.where(usable(F.col("embedding")) & (F.size("embedding") > 0))
    first = v.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = first["dim"] if first else 0
    return v.where(F.size("embedding") == dim), dim


def integers(column: pa.Array, dim: int) -> np.ndarray:
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)).astype(np.int64) + SHIFT


def exact_sums(x: np.ndarray) -> list[int]:
    """Column sums without overflow: of upper and lower halves."""
    high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
    return [(int(h) << 32) + int(l) for h, l in zip(high, low, strict=True)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """x - S/n as doubles, each rounded once, and the exact sum of (n*x - S)^2 of each row; null where it is beyond a long."""
    middle = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]  # from 0 to n - 1
    small = all(abs(m) < 1 << 61 for m in middle) and len(x) and (int(np.abs(x - np.array(middle)).max()) + 1) ** 2 * n * n * x.shape[1] < _MOST
    if small:
        d = n * (x - np.array(middle)) - np.array(rest)
        return d / n, (d * d).sum(1).tolist()
    d = n * (x.astype(object) - np.array(middle, object)) - np.array(rest, object)
    squares = [sum(int(c) ** 2 for c in row) for row in d]
    return np.array([[int(c) / n for c in row] for row in d], np.float64).reshape(x.shape), [s if s <= _MOST else None for s in squares]


def triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, "r")


def merged(a: tuple, b: tuple) -> tuple:
    """Count, mean and centred products of two sets of rows together."""
    (n, m, p), (k, q, r) = a, b
    both = n + k
    if not both:
        return a
    d = q - m
    return both, m + d * (k / both), p + r + np.outer(d, d) * (n * k / both)


def moments(w: np.ndarray) -> tuple:
    m = w.mean(0) if len(w) else np.zeros(w.shape[1])
    return len(w), m, (w - m).T @ (w - m)


def gathered(batches: Iterator[pa.RecordBatch], dim: int, least: int) -> Iterator[np.ndarray]:
    """The integers of the batches, `least` rows or more at a time, but for the last."""
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(integers(b.column("embedding"), dim))
            n += b.num_rows
        if n >= least:
            yield np.concatenate(held)
            held, n = [], 0
    if held:
        yield np.concatenate(held)


def tree(leaves: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One array out of leaves (node long, m array<double>), FAN nodes to a task and round; None without leaves.

    The leaves are written once, a small row a partition; nodes are merged in their order, so that a lost task gives
    the same again.
    """

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"node": [key[0]], "m": [merge([np.asarray(m) for m in pdf.sort_values("node")["m"]]).ravel()]})

    leaves = nodes = cut(leaves, "wh-leaves")
    last = nodes.agg(F.max("node")).first()[0]
    while last:
        nodes = nodes.groupBy(F.floor(F.col("node") / FAN).alias("to")).applyInPandas(run, "node long, m array<double>")
        last //= FAN
    found = nodes.first()
    drop(leaves)
    return None if found is None else np.asarray(found["m"])


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Model | None]:
    """The rows that take part and the model of their first `components` components; None where no direction has variance.

    What reaches the driver is of the order of the dimension squared.
    """
    rows, dim = remaining(vectors)
    bounded_batches(vectors.sparkSession)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for x in gathered(batches, dim, ROWS):
            n, total = n + len(x), [a + b for a, b in zip(total, exact_sums(x), strict=True)]
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(dim), pa.int32()), "n": pa.array([n] * dim, pa.int64()), "s": pa.array(total, pa.decimal128(38, 0))})
        release()

    vecs = rows.select("embedding")
    found = vecs.mapInArrow(sums, "at int, n long, s decimal(38,0)").groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("at").collect()
    if not found or not found[0]["n"]:
        return rows, None
    n, total = found[0]["n"], [int(r["s"]) for r in found]

    def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, dim))
        for x in gathered(batches, dim, max(ROWS, 2 * dim)):
            r = triangle(np.vstack([r, centred(x, n, total)[0]]))
        if len(r):
            yield pa.RecordBatch.from_pydict({"node": pa.array([TaskContext.get().partitionId()], pa.int64()), "m": pa.array([r.ravel().tolist()], pa.list_(pa.float64()))})
        release()

    r = tree(vecs.mapInArrow(factors, "node long, m array<double>"), lambda ms: triangle(np.vstack([m.reshape(-1, dim) for m in ms])))
    _, s, v = np.linalg.svd(r.reshape(-1, dim), full_matrices=False)
    keep = min(components, int((s > s[0] * dim * np.finfo(float).eps).sum()) if s[0] > 0 else 0)
    if not keep:
        return rows, None
    model = Model(n, total, v[:keep], s[:keep] ** 2 / n, s[:keep] ** 2 / (s**2).sum())

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (0, np.zeros(keep), np.zeros((keep, keep)))
        for x in gathered(batches, dim, ROWS):
            state = merged(state, moments(model.whitened(x)))
        if state[0]:
            yield pa.RecordBatch.from_pydict({"node": pa.array([TaskContext.get().partitionId()], pa.int64()), "m": pa.array([_flat(state).tolist()], pa.list_(pa.float64()))})
        release()

    def merge(ms: list[np.ndarray]) -> np.ndarray:
        state = _state(ms[0], keep)
        for m in ms[1:]:
            state = merged(state, _state(m, keep))
        return _flat(state)

    count, _, products = _state(tree(vecs.mapInArrow(check, "node long, m array<double>"), merge), keep)
    model.identity_error = float(np.abs(products / count - np.eye(keep)).max())
    return rows, model


def _flat(state: tuple) -> np.ndarray:
    return np.concatenate([[state[0]], state[1], state[2].ravel()])


def _state(m: np.ndarray, k: int) -> tuple:
    return int(m[0]), m[1 : k + 1], m[k + 1 :].reshape(k, k)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Model | None]:
    """vec_id, deviation and whitened (an array, a value a component) of each row that takes part, and the model.

    vectors: vec_id (of any type, null or repeated too: every row counts) and embedding, anything else. Left out are
    rows whose vector is null or empty, has null or non-finite entries or entries of 2^56 and more (64 times those
    is no long), or is of another length than most are. Each entry c becomes x = floor(64*c) + 1000000. deviation
    is the exact sum of (n*x - S)^2, null where it is beyond a long. Directions without variance (equal rows, fewer
    rows than dimensions) are no components; where none is left, as with one row or an empty table, no row results.
    """
    rows, model = fit(vectors, components)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, deviation long, whitened array<double>"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema), None
    dim = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                y, deviation = centred(integers(b.column("embedding"), dim), model.n, model.sums)
                w = y @ model.directions.T / np.sqrt(model.variances)
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(deviation, pa.int64()), values], ["vec_id", "deviation", "whitened"])
        release()

    return rows.mapInArrow(run, schema), model


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, model = whiten(table(spark, sf_dir, "embeddings"))
    each = out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    n, shares, error = (model.n, model.explained.tolist(), model.identity_error) if model else (0, [0.0], 0.0)
    explained = F.element_at(F.lit(shares), F.col("at") + 1)
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


QUERIES = {"op12_whitening": op12_whitening}
