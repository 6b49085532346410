"""Exact nearest neighbours in blocks, pair signals, clusters with a span limit, medoids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.places import location_similarity, river_similarity
from millrace.functions.text import jaccard, normalize_ascii
from millrace.functions.values import date_gap, date_proximity
from millrace.operators.clusters import span_limited_clusters
from millrace.operators.relational import first_by, may_be
from millrace.session import cut, drop, release, small_batches

#: Vectors of a block while there are up to SPREAD blocks; numbers of a block beyond that (32 MB).
BLOCK, SPREAD, NUMBERS = 8_192, 8, 1 << 22
#: Queries whose products with a block a task holds at once.
ROWS = 256
#: Numbers of sets that a task holds, pairs that are packed together, numbers of pairs that are compared at once.
PART, PAIRS, HELD = 1 << 21, 8_192, 1 << 20
SLOT_BITS = 20


def dot(a: Column, b: Column) -> Column:
    """NUM-10, in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def block_top(k: int):
    """A function of two blocks (id, v), queries and vectors: a, b, sim of each query's k nearest others in the block."""

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"a": [], "b": [], "sim": []}).astype({"a": np.int64, "b": np.int64})
        b = b.sort_values("id")
        x, y = (np.array(d["v"].tolist(), np.float64) for d in (a, b))
        ids, own, out = b["id"].to_numpy(), a["id"].to_numpy(), []
        n = min(k, len(ids))
        for i in range(0, len(own), ROWS):
            s = x[i : i + ROWS] @ y.T
            s[own[i : i + ROWS, None] == ids[None, :]] = -np.inf
            # all that reach the k-th product, which may be more than k by ties; columns are in order of id
            least = np.partition(s, len(ids) - n, axis=1)[:, len(ids) - n]
            row, col = np.nonzero(s >= least[:, None])
            sim = s[row, col]
            order = np.lexsort((-sim, row))
            row, col, sim = row[order], col[order], sim[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            kept = (place < n) & np.isfinite(sim)
            out.append(pd.DataFrame({"a": own[i + row[kept]], "b": ids[col[kept]], "sim": sim[kept]}))
        return pd.concat(out)

    return run


def block_count(n: int, width: int, block: int = BLOCK) -> int:
    """Blocks of n vectors: a vector is shuffled once a block of the other side, so blocks grow before their number does."""
    return max(1, min(SPREAD, -(-n // block)), -(-n // max(block, NUMBERS // max(1, width))))


def knn(vectors: DataFrame, k: int, queries: DataFrame | None = None, id_: str = "id", vec: str = "embedding", block: int = BLOCK, least: float | None = None) -> DataFrame:
    """JN-6, WIN-2: a, b, sim, rank of each query's k nearest others by inner product, ties to the smaller id.

    Queries and vectors meet block by block; a task multiplies two blocks and returns k rows a query, so
    no pairs are ever made and nothing is broadcast. Without queries every vector is one. Neighbours whose
    product, rounded to nine places, is under least are left out before they are ranked.
    """
    asks = vectors if queries is None else queries
    sizes = vectors.agg(F.count("*"), F.coalesce(F.max(F.size(vec)), F.lit(1))).first()
    n, m = (block_count(x, sizes[1], block) for x in (sizes[0], asks.count()))
    v = vectors.select(F.col(id_).alias("id"), F.col(vec).alias("v"))
    q = asks.select(F.col(id_).alias("id"), F.col(vec).alias("v"))
    of = lambda k: F.pmod(F.xxhash64("id"), F.lit(k)).cast("int")
    left = q.select("id", "v", of(m).alias("i"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("j"))
    right = v.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("i"), of(n).alias("j"))

    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(block_top(k), "a long, b long, sim double")
    if least is not None:
        found = found.where(F.round("sim", 9) >= least)
    w = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# fixed values: the weights of the signals, and what unknown fields count
WEIGHTS = {"semantic": 0.55, "date": 0.15, "location": 0.15, "river": 0.05, "type": 0.05, "country": 0.05}
UNKNOWN, UNKNOWN_TYPE = 0.5, "Unknown"


def same(a: Column, b: Column, unknown: float = UNKNOWN) -> Column:
    """1 for equal values, 0 for different ones, unknown if either is missing or empty."""
    return F.when(a.isNull() | b.isNull() | (a == "") | (b == ""), unknown).when(a == b, 1.0).otherwise(0.0)


def pair_signals(pairs: DataFrame) -> DataFrame:
    """NUM-11: the six signals of pairs with sim, date_min_a .. date_max_b, places_a, rivers_a, type_a, country_a and those of b.

    Places are compared by their best pair of names, rivers by their keys, countries by their normalised names;
    a type that is "Unknown" is no value.
    """
    gap = date_gap(F.col("date_min_a"), F.col("date_max_a"), F.col("date_min_b"), F.col("date_max_b"))

    def lists(x: str, similarity) -> Column:
        empty = (F.coalesce(F.size(f"{x}_a"), F.lit(0)) < 1) | (F.coalesce(F.size(f"{x}_b"), F.lit(0)) < 1)
        return F.when(empty, UNKNOWN).otherwise(similarity(f"{x}_a", f"{x}_b"))

    known = [F.nullif(F.col(f"type_{s}"), F.lit(UNKNOWN_TYPE)) for s in "ab"]
    return pairs.withColumns({
        "gap": gap, "s_semantic": F.least(F.greatest(F.col("sim"), F.lit(0.0)), F.lit(1.0)), "s_date": date_proximity(gap),
        "s_location": lists("places", location_similarity), "s_river": lists("rivers", river_similarity),
        "s_type": same(*known), "s_country": same(*[normalize_ascii(f"country_{s}") for s in "ab"]),
    })


def pair_score(weights: dict[str, float] = WEIGHTS) -> Column:
    total = F.lit(0.0)
    for k, w in weights.items():
        total = total + F.col(f"s_{k}") * w
    return total / sum(weights.values())


def veto(max_gap: int = 3) -> Column:
    """JN-8: too far apart in time, or in countries that are known and differ."""
    a, b = normalize_ascii("country_a"), normalize_ascii("country_b")
    return F.coalesce(F.col("gap") > max_gap, F.lit(False)) | ((a != "") & (b != "") & (a != b))


def medoids(members: DataFrame, cluster: str = "cluster", id_: str = "id", vec: str = "embedding") -> DataFrame:
    """AGG-21: the member of each cluster with the highest mean cosine to all, which is its product with the mean vector.

    Sums are taken by component, so a large cluster is pre-aggregated before its shuffle.
    """
    parts = members.select(cluster, F.posexplode(vec).alias("i", "x")).groupBy(cluster, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    mean = parts.groupBy(cluster).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("mean"))
    scored = members.join(mean, cluster).withColumn("mean_cosine", F.round(dot(F.col(vec), F.col("mean")), 9))
    return first_by(scored, [cluster], F.desc("mean_cosine"), id_).select(cluster, F.col(id_).alias("medoid"), "mean_cosine")


def cluster_events(vectors: DataFrame, meta: DataFrame, k: int = 20, min_cosine: float = 0.70, threshold: float = 0.82, days: int = 45, near: DataFrame | None = None) -> DataFrame:
    """CMP-1: node, cluster for every vector: neighbours, veto, score, span-limited union.

    vectors: id, embedding; meta: id, date_min, date_max, places, rivers, type, country. Each unordered pair
    counts once, if either end names the other among its nearest. near: neighbours (a, b, sim) found otherwise,
    as by ivf.search, which spares the comparison of all with all.
    """
    near = (knn(vectors, k) if near is None else near).where(F.col("sim") >= min_cosine)
    pairs = near.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("sim").alias("sim"))
    for s in "ab":
        pairs = pairs.join(meta.withColumnsRenamed({x: f"{x}_{s}" for x in meta.columns if x != "id"}).withColumnRenamed("id", s), s)
    scored = cut(pair_signals(pairs).withColumn("score", pair_score()).where(~veto() & (F.col("score") >= threshold)), "links")
    order = scored.select("a", "b", (F.lit(1_000_000_000) - F.round(F.col("score") * 1e6).cast("long")).alias("order"))
    clusters = span_limited_clusters(order, meta.select(F.col("id").alias("node"), F.col("date_min").alias("lo"), F.col("date_max").alias("hi")), days)
    return vectors.select(F.col("id").alias("node")).join(clusters, "node", "left").select("node", F.coalesce("cluster", "node").alias("cluster"))


def signal_percentiles(scored: DataFrame, signals: tuple[str, ...] = (*(f"s_{k}" for k in WEIGHTS), "score")) -> DataFrame:
    """AGG-22: signal, n, mean, p10, median and p90 over accepted links, a row a signal."""
    long = scored.select(F.explode(F.array(*[F.struct(F.lit(k).alias("signal"), F.col(k).cast("double").alias("v")) for k in signals])).alias("s")).select("s.*")
    p = F.percentile("v", F.array(*[F.lit(x) for x in (0.1, 0.5, 0.9)])).alias("p")
    out = long.groupBy("signal").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), p)
    return out.select("signal", "n", "mean", *[F.get("p", F.lit(i)).alias(x) for i, x in enumerate(("p10", "median", "p90"))])


def _planes(x: np.ndarray) -> bytes:
    """Numbers of 64 bits byte by byte, the first bytes of all before the second: what is alike compresses well."""
    return np.ascontiguousarray(x.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _packed(rows: list[tuple[int, bool, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    part, asks, x, y = zip(*rows, strict=True)
    types = (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((part, asks, map(_planes, x), map(_planes, y)), types, strict=True)], ["part", "asks", "x", "y"])


def deal_sets(parts: int):
    """A function of batches (row, h): the numbers of sets with their rows, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, h = np.repeat(batch["row"].to_numpy(), pc.list_value_length(batch["h"]).to_numpy()), batch["h"].flatten().to_numpy()
            part = h % parts
            order = np.argsort(part, kind="stable")
            row, h, part = row[order], h[order], part[order]
            ends = np.flatnonzero(np.diff(part, append=parts)) + 1
            if len(h):
                yield _packed([(int(part[i]), False, row[i:j], h[i:j]) for i, j in zip([0, *ends], ends)])
        release()

    return run


def pack_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (ra, rb), packed by the thousands."""
    held, n = [], 0
    for batch in batches:
        held.append([batch[c].to_numpy() for c in ("ra", "rb")])
        n += batch.num_rows
        if n >= PAIRS:
            yield _packed([(0, True, *map(np.concatenate, zip(*held)))])
            held, n = [], 0
    if n:
        yield _packed([(0, True, *map(np.concatenate, zip(*held)))])


class Sets:
    """What one part holds of all sets: numbers of a single set can't be shared and are left out."""

    def __init__(self, rows: list[np.ndarray], numbers: list[np.ndarray]):
        none = [np.empty(0, np.int64)]
        _, s, n = np.unique(np.concatenate(numbers or none), return_inverse=True, return_counts=True)
        shared = n[s] > 1
        row, s = np.concatenate(rows or none)[shared], s[shared]
        order = np.argsort(row, kind="stable")
        row, self.s, self.width = row[order], s[order], len(n)
        self.rows, self.at = np.unique(row, return_index=True)
        self.at = np.append(self.at, len(row))

    def place(self, row: np.ndarray) -> np.ndarray:
        """Where the sets of rows are, -1 for none."""
        if not len(self.rows):
            return np.full(len(row), -1)
        i = np.minimum(np.searchsorted(self.rows, row), len(self.rows) - 1)
        return np.where(self.rows[i] == row, i, -1)

    def shared(self, ra: np.ndarray, rb: np.ndarray) -> pa.RecordBatch:
        """ra, rb and how many numbers both hold, for the pairs that share any."""
        a, b = self.place(ra), self.place(rb)
        some = np.flatnonzero((a >= 0) & (b >= 0))
        size = np.diff(self.at)
        upto, counts = np.cumsum(size[a[some]] + size[b[some]]), np.zeros(len(ra), np.int64)
        i = 0
        while i < len(some):
            j = max(i + 1, np.searchsorted(upto, (upto[i - 1] if i else 0) + HELD, "right"))
            keys = []
            for side in (a[some[i:j]], b[some[i:j]]):
                n = size[side]
                at = np.arange(n.sum()) + np.repeat(self.at[side] - np.cumsum(n) + n, n)
                keys.append(np.repeat(np.arange(len(side)), n) * self.width + self.s[at])
            key = np.sort(np.concatenate(keys))
            counts[some[i:j]] = np.bincount(key[1:][key[1:] == key[:-1]] // self.width, minlength=j - i)
            i = j
        any_ = counts > 0
        return pa.RecordBatch.from_arrays([pa.array(x[any_]) for x in (ra, rb, counts)], ["ra", "rb", "both"])


def count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (part, asks, x, y), each part's sets before its pairs, as counts ra, rb, both of each part. Pairs are not held."""
    now, rows, numbers, sets = None, [], [], None
    for batch in batches:
        for r in batch.to_pylist():
            if r["part"] != now:
                now, rows, numbers, sets = r["part"], [], [], None
            x, y = _numbers(r["x"]), _numbers(r["y"])
            if not r["asks"]:
                rows.append(x)
                numbers.append(y)
                continue
            if sets is None:
                sets, rows, numbers = Sets(rows, numbers), [], []
            yield sets.shared(x, y)
    release()


def shared_counts(pairs: DataFrame, sets: DataFrame, numbers: int) -> DataFrame:
    """ra, rb, both: how many numbers the sets of a pair share, for the pairs that share any; exact.

    pairs: ra, rb; sets: row, h (distinct numbers, dealt like a hash). A task gets one part of the numbers of all
    sets, PART of them, and all pairs pass by it: a set is shuffled once, however many pairs it has, and a pair goes
    to each part in a few bytes.
    """
    parts = max(1, -(-numbers // PART))
    small_batches(pairs.sparkSession)
    columns = "part int, asks boolean, x binary, y binary"
    dealt = sets.select("row", "h").mapInArrow(deal_sets(parts), columns)
    asks = pairs.select("ra", "rb").mapInArrow(pack_pairs, columns).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    both = dealt.union(asks).repartition(parts, "part").sortWithinPartitions("part", "asks")
    return both.mapInArrow(count_shared, "ra long, rb long, both long").groupBy("ra", "rb").agg(F.sum("both").alias("both"))


def semantic_duplicates(vectors: DataFrame, texts: DataFrame, k: int = 20, least: float = 0.95, most_jaccard: float = 0.5) -> DataFrame:
    """CMP-2: a, b, sim, jaccard of neighbours whose vectors nearly agree while their words do not: candidates only.

    vectors: id, embedding; texts: id, shingles (array). Shingles are compared by their hashes, and pairs don't fetch
    them: only texts of pairs that pass the cosine are shuffled, each once.
    """
    near = knn(vectors, k, least=least)
    pairs = alike = cut(near.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("sim").alias("sim")), "alike")
    key = F.xxhash64(F.col("id").cast("long"))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).select(key.alias("key"))
    own = may_be(texts.where(F.col("shingles").isNotNull()).withColumn("key", key), ends, "key", SLOT_BITS)
    own = own.select("id", F.array_distinct(F.transform("shingles", lambda x: F.xxhash64(x))).alias("h"))
    own = cut(own.select(F.monotonically_increasing_id().alias("row"), "id", F.size("h").alias("n"), "h"), "shingles")
    for s in "ab":
        pairs = pairs.join(own.select(F.col("id").alias(s), F.col("row").alias(f"r{s}"), F.col("n").alias(f"n{s}")), s)
    numbers = own.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    both = F.coalesce("both", F.lit(0))
    out = pairs.join(shared_counts(pairs, own, numbers), ["ra", "rb"], "left")
    out = out.select("a", "b", "sim", F.when((F.col("na") == 0) | (F.col("nb") == 0), 0.0).otherwise(both / (F.col("na") + F.col("nb") - both)).alias("jaccard"))
    out = cut(out.where(F.col("jaccard") < most_jaccard), "unlike")
    drop(alike, own)
    return out
