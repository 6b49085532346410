import numpy as np
import pytest

from millrace.llm import whitening as wh


def plain(rows):
    """n, sums, exact deviations, variances and directions, by the covariance itself."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in rows], object)
    n, s = len(x), x.sum(0)
    y = ((n * x - s) / n).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return n, ((n * x - s) ** 2).sum(1), values[::-1], vectors[:, ::-1], y


@pytest.mark.parametrize("fan", [2, 16])
def test_equals_the_covariance(spark, sf, monkeypatch, fan):
    monkeypatch.setattr(wh, "FAN", fan)
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").repartition(5)
    rows = {r.vec_id: r.embedding for r in vectors.collect()}
    n, deviation, values, directions, y = plain(list(rows.values()))
    out, model = wh.whiten(vectors)
    got = {r.vec_id: r for r in out.collect()}
    assert got.keys() == rows.keys() and model.n == n
    assert [got[i].deviation for i in rows] == deviation.tolist()
    w = np.array([got[i].whitened for i in rows])
    assert w.shape == (n, 32)
    for k in range(32):
        want = y @ directions[:, k] / np.sqrt(values[k])
        assert min(np.abs(w[:, k] - want).max(), np.abs(w[:, k] + want).max()) < 1e-7
        assert abs(model.explained[k] / (values[k] / values.sum()) - 1) < 1e-9
    c = w - w.mean(0)
    assert abs(np.abs(c.T @ c / n - np.eye(32)).max() - model.identity_error) < 1e-9 and model.identity_error < 1e-9


def test_what_takes_part(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=3).tolist()) for i in range(40)] + [(7, [1.0, 2.0, 3.0])] * 20 + [(None, [0.0, 0.0, 0.0])]
    bad = [(100, None), (101, []), (102, [1.0, nan, 0.0]), (103, [inf, 0.0, 0.0]), (104, [1.0, None, 2.0]), (105, [1.0, 2.0]), (106, [1e30, 0.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in good + bad], "vec_id long, embedding array<float>, n int, component string")
    out, model = wh.whiten(frame)
    got = out.collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(str(i) for i, _ in good) and model.n == len(good)
    assert all(len(r.whitened) == 3 for r in got) and model.identity_error < 1e-10
    assert len({tuple(r.whitened) for r in got if r.vec_id == 7}) == 2


def test_few_directions_and_none(spark):
    one = "vec_id long, embedding array<float>"
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(10)], one)
    out, model = wh.whiten(line)
    w = np.array([r.whitened for r in out.collect()])
    assert w.shape == (10, 1) and abs((w * w).mean() - 1) < 1e-12 and abs(model.explained[0] - 1) < 1e-12
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        out, model = wh.whiten(spark.createDataFrame(rows, one))
        assert model is None and out.count() == 0 and out.columns == ["vec_id", "deviation", "whitened"]


def test_exact_beyond_words():
    x = np.array([[1 << 60, -(1 << 60)], [1, 2], [-(1 << 60), 5]])
    sums = [int(c) for c in x.astype(object).sum(0)]
    assert wh.exact_sums(np.repeat(x, 1000, 0)) == [1000 * s for s in sums]
    y, d = wh.centred(x, 3, sums)
    assert d[0] is None and abs(y[1][0] - (3 - sums[0]) / 3) < 1e-9
    small = np.array([[1, 5], [2, 9], [6, 1]])
    y, d = wh.centred(small, 3, [9, 15])
    assert d == [9 * (4 + 0), 9 * (1 + 16), 9 * (9 + 16)] and np.array_equal(y, small - np.array([3, 5]))
