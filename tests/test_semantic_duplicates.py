import numpy as np
import pytest

from millrace.operators import vector
from millrace.session import sweep, written


def _written(spark):
    """Bytes that tasks have written for shuffles in this session."""
    return spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()


def _vectors(spark, v):
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, embedding array<double>")


def _brute(v, sets, k, least, most):
    out, sim = [], v @ v.T
    near = {(min(a, b), max(a, b)) for a in range(len(v)) for b in sorted((j for j in range(len(v)) if j != a), key=lambda j: (-sim[a, j], j))[:k] if round(sim[a, b], 9) >= least}
    for a, b in near:
        for x in (set(s) for i, s in sets if i == a and s is not None):
            for y in (set(s) for i, s in sets if i == b and s is not None):
                j = len(x & y) / len(x | y) if x and y else 0.0
                if j < most:
                    out.append((a, b, round(sim[a, b], 9), j))
    return sorted(out)


@pytest.mark.parametrize("part", [40, 1 << 21])
def test_pairs_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(vector, "PART", part)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(60, 4))
    v /= np.linalg.norm(v, axis=1)[:, None]
    family = [f"f{i}" for i in range(30)]
    sets = [(i, [*rng.choice(family, rng.integers(0, 25), replace=False).tolist(), *(f"{i}-{j}" for j in range(rng.integers(0, 12)))]) for i in range(58)]
    # empty, null, one that repeats a shingle, a second text of an id, equal sets; 58 and 59 have no text
    sets[3:6] = [(3, []), (4, None), (5, ["f1", "f1", "f2"])]
    sets += [(7, ["f1", "f2", "f3"]), (100, family)]
    sets[8:11] = [(i, family) for i in (8, 9, 10)]
    texts = spark.createDataFrame(sets, "id long, shingles array<string>")
    before = written()
    got = vector.semantic_duplicates(_vectors(spark, v), texts, 6, 0.5, 0.5).collect()
    sweep(spark, before)
    assert sorted((r.a, r.b, round(r.sim, 9), r.jaccard) for r in got) == _brute(v, sets, 6, 0.5, 0.5)
    assert any(0 < r.jaccard < 0.5 for r in got)


def test_a_cosine_counts_by_nine_places(spark):
    v = np.array([[1.0, 0.0], [0.35 - 1e-11, 0.9], [0.35 - 1e-8, -0.9]])
    texts = spark.createDataFrame([(i, [str(i)]) for i in range(3)], "id long, shingles array<string>")
    assert [(r.a, r.b) for r in vector.semantic_duplicates(_vectors(spark, v), texts, 2, 0.35).collect()] == [(0, 1)]


def test_half_is_too_much(spark):
    v = np.array([[1.0, 0.0], [1.0, 0.0], [1.0, 0.0]])
    texts = spark.createDataFrame([(0, list("abcd")), (1, list("ab")), (2, list("axyz"))], "id long, shingles array<string>")
    got = vector.semantic_duplicates(_vectors(spark, v), texts, 2, 0.9).collect()
    assert sorted((r.a, r.b, r.jaccard) for r in got) == [(0, 2, 1 / 7), (1, 2, 0.2)]


@pytest.mark.parametrize("held", [1, 7, 1 << 20])
def test_counts_of_a_part(monkeypatch, held):
    monkeypatch.setattr(vector, "HELD", held)
    rng = np.random.default_rng(2)
    sets = {int(r): set(rng.choice(40, rng.integers(1, 15), replace=False).tolist()) for r in rng.choice(1 << 40, 30, replace=False)}
    rows, numbers = (np.array(x, np.int64) for x in zip(*[(r, h - 20) for r, s in sets.items() for h in s], strict=True))
    ra, rb = (np.array(x, np.int64) for x in zip(*[(a, b) for a in [*sets, 5] for b in [*sets, 6] if a != b], strict=True))
    got = vector.Sets([rows[:50], rows[50:]], [numbers[:50], numbers[50:]]).shared(ra, rb).to_pylist()
    want = {(a, b): len(sets.get(a, set()) & sets.get(b, set())) for a, b in zip(ra.tolist(), rb.tolist(), strict=True)}
    assert {(r["ra"], r["rb"]): r["both"] for r in got} == {p: n for p, n in want.items() if n}
    assert vector.Sets([], []).shared(ra, rb).num_rows == 0
    assert (vector._numbers(vector._planes(rows)) == rows).all()


def test_pairs_do_not_fetch_their_sets(spark):
    """300 texts with about 3,000 pairs: hashes of all sets are 2.4 MB, sets of all pairs 24 MB and more."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 8))
    v /= np.linalg.norm(v, axis=1)[:, None]
    texts = spark.createDataFrame([(i, rng.integers(0, 1 << 60, 1000).astype(str).tolist()) for i in range(300)], "id long, shingles array<string>")
    name = "spark.sql.autoBroadcastJoinThreshold"  # as with tables that are too large for a broadcast
    usual = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        start = _written(spark)
        got = vector.semantic_duplicates(_vectors(spark, v), texts, 20, -1.0).count()
        moved = _written(spark) - start
    finally:
        spark.conf.set(name, usual)
    assert got > 2900
    assert moved < 6 << 20
