"""The span-limited union against a single pass, and the inverted file against all products."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import clusters, ivf, vector
from millrace.session import shared_dir, table

LINKS, SPANS = "a long, b long, order long", "node long, lo date, hi date"


def single_pass(links, spans, days):
    of = {n: n for a, b, _ in links if a is not None and b is not None and a != b for n in (a, b)}
    dates = {n: [d for d in spans.get(n, ()) if d] for n in of}
    for _, x, y in sorted((o, min(a, b), max(a, b)) for a, b, o in links if a is not None and b is not None and a != b):
        x, y = sorted((of[x], of[y]))
        both = dates[x] + dates[y]
        if x != y and (not both or (max(both) - min(both)).days <= days):
            dates[x] = both
            of = {n: x if c == y else c for n, c in of.items()}
    return of


def run(spark, links, spans, days, fold):
    s = spark.createDataFrame([(n, *d) for n, d in spans.items()], SPANS)
    return {r.node: r.cluster for r in clusters.span_limited_clusters(spark.createDataFrame(links, LINKS), s, days, fold).collect()}


def day(n):
    return date(2021, 1, 1) + timedelta(n)


@pytest.mark.parametrize("seed", range(2))
def test_rounds_equal_a_single_pass(spark, seed):
    """Ties of order, repeated links, unknown dates, null ends and loops; folded at once, and in rounds."""
    r = random.Random(seed)
    links = [(r.randrange(40), r.randrange(40), r.randrange(20)) for _ in range(110)] + [(None, 1, 0), (3, 3, 0), (5, None, 1)]
    spans = {n: (d, d) for n in range(37) for d in [None if n % 7 == 0 else day(r.randrange(90))]}
    want = single_pass(links, spans, 30)
    assert len(set(want.values())) > 2
    for fold in (10**6, 20):
        assert run(spark, links, spans, 30, fold) == want, fold


def test_chains_and_hubs(spark):
    """A chain whose links come one after the other settles by folds of the first links; a hub has one link a round."""
    chain = [(i, i + 1, i) for i in range(40)]
    assert run(spark, chain, {i: (day(i), day(i)) for i in range(41)}, 10, 20) == single_pass(chain, {i: (day(i), day(i)) for i in range(41)}, 10)
    hub = [(0, i, 50 - i) for i in range(1, 41)]
    assert run(spark, hub, {i: (day(i), day(i)) for i in range(41)}, 9, 20) == single_pass(hub, {i: (day(i), day(i)) for i in range(41)}, 9)


def test_no_links(spark):
    assert run(spark, [], {1: (None, None)}, 5, 10) == {}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_and_work(spark, size):
    v = table(spark, f"/root/testdata/{size}", "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    index = ivf.build(v, f"{shared_dir(spark)}/ivf-test-{size}")
    n, asks = v.count(), v.where("id % 50 = 0")
    assert index.sizes.sum() == n  # every row is indexed
    found = ivf.search(index, asks)
    exact = vector.knn(v, 20, asks).select("a", "b")
    assert exact.join(found, ["a", "b"]).count() >= 0.9 * exact.count()
    assert ivf.compared(index, asks) < 0.9 * n * asks.count()
    assert found.groupBy("a").count().where("count <> 20").isEmpty()


def test_structure_makes_it_cheap_and_all_lists_make_it_exact(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 16))[rng.integers(0, 30, 3000)] * 4 + rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    v = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(x)], "id long, embedding array<double>")
    index = ivf.build(v, f"{shared_dir(spark)}/ivf-test-structure")
    asks = v.where("id % 30 = 0")
    assert ivf.compared(index, asks) < 0.3 * 3000 * 100
    whole = ivf.search(index, asks, probes=len(index.centroids), block=100).select("a", "b", "rank")
    exact = vector.knn(v, 20, asks).select("a", "b", "rank")
    assert whole.exceptAll(exact).isEmpty() and exact.exceptAll(whole).isEmpty()


def test_blocks_of_queries_and_ties(spark):
    """Over 256 queries in a block, and copies: the k nearest, ties to the smaller id."""
    rows = [(i, [float(i % 3), float(i % 5)]) for i in range(600)]
    got = {}
    for r in vector.knn(spark.createDataFrame(rows, "id long, embedding array<double>"), 4).collect():
        got.setdefault(r.a, []).append((r["rank"], r.b))
    v = dict(rows)
    for a in v:
        want = sorted((b for b in v if b != a), key=lambda b: (-(v[a][0] * v[b][0] + v[a][1] * v[b][1]), b))[:4]
        assert [b for _, b in sorted(got[a])] == want


def test_rows_that_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (None, [1.0, 1.0]), (7, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").withColumn("list", F.lit("x"))
    index = ivf.build(df, f"{shared_dir(spark)}/ivf-test-null")
    got = sorted((r.a, r.b) for r in ivf.search(index, df, k=5, probes=99).collect())
    assert got == [(1, 2), (1, 7), (2, 1), (2, 7), (7, 1), (7, 2)]
    none = ivf.build(df.limit(0), f"{shared_dir(spark)}/ivf-test-none")
    assert ivf.search(none, df).count() == 0


def test_blocks_of_vectors_grow_with_the_table():
    """Copies of a vector that are shuffled are bounded while tables grow: 60 times 10,256 vectors meet in 10 blocks, not 76."""
    assert [vector.block_count(n, 64) for n in (0, 1, 9000, 102_560, 615_360)] == [1, 1, 2, 8, 10]
    assert vector.block_count(100_000, 4096) == 13
