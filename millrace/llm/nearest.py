"""Nearest neighbours by collision counting (the query-aware scheme of QALSH, Huang et al. 2015).

Vectors are projected on random directions, one value each, and every direction keeps its values sorted.
A query opens a window around its own value in each array; a vector that lies in the windows of enough
directions is a candidate and is verified by its inner product. If too few vectors reach the threshold, all
windows are widened by the ratio (virtual rehashing) and counting goes on.

For inner products vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, and queries a
zero: the order of distances is then that of inner products. Equal vectors are one entry, so that a vector
which a third of the table holds costs as much as another.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.session import cut, table

K, QUERY_EVERY = 20, 20
#: Directions, the share of them that must collide, first half-width in standard deviations, ratio of rehashing, and the share of a block, and the number of its vectors, that are to be verified at least.
DIRECTIONS, THRESHOLD, WIDTH, RATIO, VERIFY, LEAST, SEED = 96, 0.75, 0.25, 1.15, 0.2, 1000, 17
#: Vectors of a block and queries of a block.
BLOCK, QUERIES_BLOCK = 16_384, 4_096


class Index:
    """Sorted projections of one block of vectors, the arrays of all directions laid end to end."""

    def __init__(self, vectors: np.ndarray, greatest: float, directions: int = DIRECTIONS, seed: int = SEED):
        self.vectors, self.greatest = vectors, greatest
        lifted = np.column_stack([vectors, np.sqrt(np.maximum(0, greatest**2 - (vectors**2).sum(1)))])
        self.axes = np.random.default_rng(seed).normal(size=(lifted.shape[1], directions))
        p = lifted @ self.axes
        self.scale = np.maximum(p.std(0), 1e-12)
        self.base = np.arange(directions) * len(vectors)
        order = np.argsort(p, axis=0, kind="stable")
        # the place of each vector in each array: it is in a window if its place less the window's start, as unsigned, is under its width
        assert len(vectors) < 1 << 16, "a block is too large for its ranks"
        self.rank = np.empty((directions, len(vectors)), np.uint16)
        np.put_along_axis(self.rank, order.T, np.arange(len(vectors), dtype=np.uint16)[None], 1)
        # in standard deviations and shifted, so that all directions form one sorted array
        self.middle, reach = p.mean(0), float(np.abs((p - p.mean(0)) / self.scale).max()) + 1
        self.shift = np.arange(directions) * 4 * reach + 2 * reach
        self.reach = reach
        self.flat = (np.take_along_axis((p - self.middle) / self.scale, order, 0) + self.shift).T.ravel()
        self.start = WIDTH

    def candidates(self, query: np.ndarray, least: int, threshold: float = THRESHOLD) -> np.ndarray:
        """Entries that collide with the query in enough directions once at least `least` of them do."""
        n, m = len(self.vectors), len(self.shift)
        if n <= least:
            return np.arange(n)
        at = (np.append(query, 0.0) @ self.axes * (self.greatest / np.linalg.norm(query)) - self.middle) / self.scale
        at, need, half = np.clip(at, -self.reach, self.reach) + self.shift, int(np.ceil(threshold * m)), self.start
        while True:
            half = min(half, self.reach)
            lo = np.maximum(np.searchsorted(self.flat, at - half), self.base) - self.base
            hi = np.minimum(np.searchsorted(self.flat, at + half, "right") - self.base, n)
            inside = self.rank - lo.astype(np.uint16)[:, None] < np.maximum(hi - lo, 0).astype(np.uint16)[:, None]
            found = np.flatnonzero(inside.view(np.uint8).sum(0, dtype=np.uint8 if m < 256 else np.uint32) >= need)
            if len(found) >= least or (hi - lo == n).all():
                return found
            half *= RATIO

    def calibrate(self, least: int, samples: int = 9) -> None:
        """Begin with the narrowest first window that some of a few stored vectors are served by, less one step."""
        ends = []
        for i in np.linspace(0, len(self.vectors) - 1, samples).astype(int):
            half = WIDTH
            while half < self.reach and len(self._once(self.vectors[i], half)) < least:
                half *= RATIO
            ends.append(half)
        self.start = max(WIDTH, min(ends) / RATIO)

    def _once(self, query: np.ndarray, half: float) -> np.ndarray:
        start, self.start = self.start, half
        found = self.candidates(query, 0) if len(self.vectors) else np.zeros(0)
        self.start = start
        return found


def _search(k: int, greatest: float, verify: float):
    def run(key, block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(queries):
            block = block.sort_values("entry")
            vectors, ids = np.array(block["embedding"].tolist(), np.float64), block["entry"].to_numpy()
            index = Index(vectors, greatest)
            least = max(4 * k, LEAST, int(np.ceil(verify * len(ids))))
            index.calibrate(least)
            for q, vector in zip(queries["query"].to_numpy(), queries["embedding"], strict=True):
                found = index.candidates(np.asarray(vector, np.float64), least)
                v = np.asarray(vector, np.float64)
                near = vectors[found] @ v
                if len(found) > k:  # sums in one fixed order decide; the quick product only drops what can't be among them
                    found = found[near >= np.partition(near, len(near) - k)[len(near) - k] - 1e-9 * max(1.0, greatest**2)]
                score = (vectors[found] * v).sum(1)
                first = np.lexsort((ids[found], -score))[:k]
                out.append(pd.DataFrame({"query": q, "entry": ids[found[first]], "score": score[first]}))
        return pd.concat(out) if out else pd.DataFrame({"query": np.array([], np.int64), "entry": np.array([], np.int64), "score": np.array([], np.float64)})

    return run


def usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = K, verify: float = VERIFY) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest other rows by inner product.

    vectors: vec_id and embedding (array of floats), anything else. Null vectors, zero ones, and those with
    null or non-finite components take no part; neither do rows with a null id. Ties go to the smaller
    vec_id; vectors of other lengths than the query's are no candidates. A repeated row (one id twice with
    one vector) counts once. Fewer candidates than k give fewer rows; an empty table gives none.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), is_query.alias("is_query"))
    v = v.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).dropDuplicates(["vec_id", "embedding"])
    # a class is a distinct vector; of its rows only the k + 1 smallest ids can be among the k nearest of any query
    w = Window.partitionBy("embedding").orderBy("vec_id")
    members = v.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1)
    classes = cut(members.groupBy("embedding").agg(F.min("vec_id").alias("entry"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "nn-classes")
    queries = cut(v.where("is_query").join(classes.select("embedding", "entry"), "embedding").select("vec_id", "embedding", "entry"), "nn-queries")
    distinct = queries.groupBy("embedding").agg(F.min("entry").alias("query"))
    stats = classes.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))).alias("greatest")).collect()
    n, greatest = sum(s["n"] for s in stats), max((s["greatest"] for s in stats), default=1.0)
    blocks = max(1, -(-n // BLOCK))
    parts = max(1, -(-distinct.count() // QUERIES_BLOCK))
    dim = F.size("embedding").alias("dim")
    block = F.pmod(F.xxhash64("entry"), F.lit(blocks)).alias("block")
    part = F.pmod(F.xxhash64("query"), F.lit(parts)).alias("part")
    data = classes.select(dim, block, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), "entry", "embedding")
    asks = distinct.select(dim, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), part, "query", "embedding")
    keys = ["dim", "block", "part"]
    found = data.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInPandas(_search(k + 1, greatest, verify), "query long, entry long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    found = found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    lists = found.join(classes.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    top = lists.withColumn("r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    answers = top.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("top"))  # k + 1 rows at most
    each = queries.select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query")).join(answers, "query")
    own = F.slice(F.filter("top", lambda t: t["vec_id"] != F.col("query_id")), 1, k)
    out = each.select("query_id", F.posexplode(own).alias("at", "t"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "t.vec_id", "t.score")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


QUERIES = {"op9_nearest": op9_nearest}
