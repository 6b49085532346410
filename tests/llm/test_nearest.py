import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import nearest as nn


def brute(ids, x, queries, k=20):
    out = {}
    for q in queries:
        i = ids.index(q)
        s = (x * x[i]).sum(1)
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-s[j], ids[j]))[:k]
        out[q] = [(ids[j], s[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


@pytest.mark.parametrize("size", ["0.001", "0.01", "0.1"])
def test_recall(spark, size):
    rows = spark.read.parquet(f"/root/testdata/sf{size}/embeddings.parquet").orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in rows], np.float64), [r.vec_id for r in rows]
    got = found(nn.op9_nearest(spark, f"/root/testdata/sf{size}"))
    want = brute(ids, x, [i for i in ids if i % 20 == 0])
    assert got.keys() == want.keys()
    hit = sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want)
    recall = hit / sum(map(len, want.values()))
    print("recall", recall)
    assert recall >= 0.95
    exact = {(q, i): s for q, l in want.items() for i, s in l}
    assert all(abs(s - exact[q, i]) < 1e-12 for q, l in got.items() for i, s in l if (q, i) in exact)


def test_ties_edges_and_equal_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0], 1) for i in range(60)] + [(100, [0.5, 0.5], 2), (120, [3.0, 4.0], 2), (140, None, 1), (160, [0.0, 0.0], 1), (180, [nan, 1.0], 1), (200, [inf, 1.0], 1), (220, [None, 1.0], 1), (240, [], 1), (260, [1.0, 0.0, 0.0], 1), (None, [1.0, 1.0], 1), (120, [3.0, 4.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = found(nn.nearest(df, F.col("vec_id") % 20 == 0))
    assert set(got) == {0, 20, 40, 100, 120}
    assert [i for i, _ in got[0]] == [120, *range(1, 20)] and [i for i, _ in got[20]] == [120, *range(19)]
    assert got[120][0] == (100, 3.5) and len(got[120]) == 20
    assert nn.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_blocks_and_parts_meet_in_full(spark, monkeypatch):
    """Several blocks of vectors and parts of queries give what one block gives, ties across blocks included."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 12)).round(2)
    x[300:330] = x[0]
    df = spark.createDataFrame([(i, v.tolist(), "z") for i, v in enumerate(x)], "vec_id long, embedding array<double>, query string")
    monkeypatch.setattr(nn, "BLOCK", 200)
    monkeypatch.setattr(nn, "QUERIES_BLOCK", 10)
    monkeypatch.setattr(nn, "LEAST", 0)
    got = {}
    for r in nn.nearest(df, F.col("vec_id") % 20 == 0, verify=1.0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in range(0, 900, 20):
        s = (x * x[q]).sum(1)
        want = [i for i in np.lexsort((np.arange(900), -s)) if i != q][:20]
        assert [v for _, v in sorted(got[q])] == want
