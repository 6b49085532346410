import random

import pytest
from pyspark.sql import functions as F

from millrace.plans import documents


def family(seed):
    """Near copies around the limit, exact copies, and texts of few distinct shingles."""
    r = random.Random(seed)
    texts = []
    for base in range(6):
        w = [f"w{r.randrange(400)}" for _ in range(60 + 20 * base)]
        texts += [" ".join(w)] * 3
        for changes in (1, 2, 3):
            x = list(w)
            for i in r.sample(range(len(x)), changes):
                x[i] = f"new{r.randrange(9)}"
            texts.append(" ".join(x))
        texts.append(" ".join(w[:-5]))
    for period in (1, 2, 3, 4, 5, 6):
        texts += [" ".join(f"p{i % period}" for i in range(n)) for n in (50, 61, 70)]
        texts.append(" ".join([*(f"p{i % period}" for i in range(60)), "tail"]))
    return [*texts, "too short", None]


def plain(texts):
    sets = {}
    for i, t in enumerate(texts):
        w = (t or "").split()
        if len(w) >= 50:
            sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4))
    rep = {i: min(j for j in sets if sets[j] == s) for i, s in sets.items()}
    found = {(rep[i], i, 1.0) for i in sets if rep[i] != i}
    reps = sorted(set(rep.values()))
    for n, a in enumerate(reps):
        for b in reps[n + 1 :]:
            j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            if j >= 0.8:
                found.add((a, b, round(j, 6)))
    return found


@pytest.mark.parametrize("copies", [500_000, 0])
def test_similar_pairs_move_few_sets(spark, tmp_path, monkeypatch, copies):
    """All pairs, of sets of any size; only the sets of candidates are shuffled, and none is written twice while copies are few."""
    texts = family(4) + [" ".join(f"own{k}x{i}" for i in range(80)) for k in range(200)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(documents, "BROADCAST_COPIES", copies)
    monkeypatch.setattr(documents, "SLOT_BITS", 12)
    seen, real, filtered, may_be = [], documents.cut, [], documents.may_be
    monkeypatch.setattr(documents, "cut", lambda df, name: seen.append(name) or real(df, name))
    monkeypatch.setattr(documents, "may_be", lambda *a: filtered.append(may_be(*a)) or filtered[-1])
    monkeypatch.setattr(documents, "drop", lambda *t: None)
    got = {(r.a, r.b, r.jaccard) for r in documents.doc_shingle_pairs(spark, str(tmp_path)).collect()}
    assert got == plain(texts) and len(got) > 20
    assert ("classes" in seen) == (copies == 0)
    assert filtered[0].count() < 60 < filtered[0].sparkSession.read.parquet(str(tmp_path / "documents.parquet")).where(F.col("text").isNotNull()).count()
