import random

import numpy as np
import pytest

from millrace.llm import near_dup as nd
from tests.llm.oracle import near_dup


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = near_dup([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = nd.near_duplicates(docs)
    assert result(got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.collect())


def test_groups_of_near_copies(spark):
    rnd = random.Random(7)
    rows = []
    for g in range(12):
        base = [f"w{rnd.randrange(9999)}" for _ in range(rnd.choice([3, 7, 30, 90, 200]))]
        for _ in range(rnd.choice([2, 6, 25])):
            t = list(base)
            for _ in range(rnd.randrange(0, 1 + len(t) // 20)):
                t[rnd.randrange(len(t))] = f"x{rnd.randrange(9999)}"
            rows.append((len(rows), " ".join(t)))
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert result(got) == near_dup(rows)


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t", "c"), (4, "One two", "d"), (5, "one  TWO", "e"), (6, "É x", "f"), (7, "é x", "g"), (None, "one two", "h"), (None, None, "i"), (9, "a b c d e", "x"), (9, "a b c d e", "x"), (10, "z " * 30000, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in nd.near_duplicates(df).collect()), key=str)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 1, 7, True), (None, 1, 4, False), (None, 0, None, True), (9, 1, 9, True), (9, 1, 9, True), (10, 1, 10, True)]
    assert got == sorted(want, key=str)
    assert nd.near_duplicates(df.limit(0)).count() == 0


def by_matrix(rows, percent=75, size=5):
    """Components by one product of the incidence matrix: all pairs, for texts that share a lot."""
    sets = []
    for _, t in rows:
        w = t.lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))})
    at = {x: i for i, x in enumerate({x for s in sets for x in s})}
    m = np.zeros((len(sets), len(at)), np.float32)
    for i, s in enumerate(sets):
        m[i, [at[x] for x in s]] = 1
    both, n = m @ m.T, np.array([len(s) for s in sets])
    linked = 100 * both >= percent * (n[:, None] + n[None] - both)
    root = np.arange(len(sets))
    while True:  # every row takes the least label of the rows it is linked with
        new = np.where(linked, root[None], len(sets)).min(1)
        if (new == root).all():
            return {d: (int(k), rows[r][0]) for (d, _), k, r in zip(rows, n, root, strict=True)}
        root = new


def draw(rnd, n):
    return [f"w{rnd.randrange(10**6)}" for _ in range(n)]


def test_no_leader_hides_a_pair(spark):
    """Short near copies of a notice stay linked among very many longer texts that contain it."""
    rnd = random.Random(3)
    rows, notice = [], draw(rnd, 64)
    for own in (9, 9, 9, 9, 8, 8):
        rows.append((len(rows), " ".join(notice + draw(rnd, own))))
    for _ in range(700):
        rows.append((len(rows), " ".join(notice + draw(rnd, rnd.choice([12, 20, 58, 58, 58, 64, 96])))))
    rnd.shuffle(rows)
    rows = sorted((i, t) for i, (_, t) in enumerate(rows))
    want = by_matrix(rows)
    assert 2 < len({c for _, c in want.values()}) < 706
    assert result(nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == want


@pytest.mark.parametrize(("changed", "dense"), [(0.02, 0), (0.027, 1)])
def test_a_family_around_the_limit(spark, monkeypatch, changed, dense):
    """Changed copies of one text at 0.6 to 0.8, verified one by one and multiplied out, over several blocks."""
    monkeypatch.setattr(nd, "DENSE", dense)
    monkeypatch.setattr(nd, "CROWD", 64)
    rnd = random.Random(8)
    base = draw(rnd, 150)
    rows = []
    for _ in range(260):
        t = list(base)
        for i in range(len(t)):
            if rnd.random() < changed:
                t[i] = f"x{rnd.randrange(10**6)}"
        rows.append((len(rows), " ".join(t)))
    want = by_matrix(rows)
    assert len({c for _, c in want.values()}) > 3
    assert result(nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_text_ids_null_ids_and_one_id_for_two_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [("k", a), ("m", a + " more"), (None, a + " other"), (None, b), (None, b + " x"), ("m", b + " y z")]
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == sorted(
        [("k", "k", True), ("m", "k", False), (None, "k", False), (None, "m", False), (None, "m", False), ("m", "m", True)], key=str
    )
    assert len({r.group for r in got}) == 2


def test_registers_estimate_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2)
    b = np.concatenate([a[:2600], rng.integers(0, 2**63, 400, dtype=np.uint64)])
    ra, rb = (nd.compress(nd.registers(np.unique(x)))[None] for x in (a, b))
    n = np.array([3000])
    assert abs(nd.estimate(ra, rb, n, n)[0] - 2600 / 3400) < 0.15
