import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from millrace.llm import filter_audit as fa


def brute(docs, labels):
    """Every document goes through every order, one filter after the other."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    parts = defaultdict(list)
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and first[t] < i}
        parts[lang or ""].append(({f for f, x in fails.items() if x}, i in good, i in toxic))
    out = {}
    for part, rows in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                fails = sum(f in r[0] for r in rows)
                shapley[f] += len(gone)
                out[part, "".join(order), step + 1] = [len(left), len(gone), fails - len(gone), sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone), f]
        for row in (r for k, r in out.items() if k[0] == part):
            row[6] = shapley[row[6]]
    return {k: tuple(v) for k, v in out.items()}


def got(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_nasty_documents(spark, monkeypatch, broadcast):
    monkeypatch.setattr(fa, "BROADCAST", broadcast)
    long, caps = " ".join(f"w{i}" for i in range(250)), " ".join(f"Word{i} X" for i in range(150))
    docs = [
        (1, long, "en"), (2, long, "en"), (2, long, "en"), (3, long + " $", "en"), (4, "a " * 300, "en"), (5, caps, None), (6, caps, ""), (7, None, "de"), (8, "", "de"), (None, long, "de"),
        (None, None, None), (9, "É é É　x", "de"), (10, "\x1c\t\n\x0b\x0c\r ", "fr"), (11, "AB | " * 5000, "fr"), *[(100 + i, "same text", "fr") for i in range(30)],
    ]
    labels = [(1, 1, 0), (1, None, 1), (2, 1, 1), (2, 0, 0), (3, None, None), (None, 1, 1), (100, 1, 0), (105, 0, 1), (999, 1, 1), (11, 1, 1)]
    d = spark.createDataFrame([(*r, "x", 1, True) for r in docs], "doc_id long, text string, lang string, part string, digest int, A boolean").repartition(3)
    one = spark.createDataFrame([(*r, "y") for r in labels], "doc_id long, quality int, toxic int, good string")
    assert got(fa.audit(fa.failures(d, one))) == brute(docs, labels)
    if broadcast:
        none = one.limit(0)
        assert got(fa.audit(fa.failures(d.where("lang = 'de'"), none))) == brute([r for r in docs if r[2] == "de"], [])
        assert fa.audit(fa.failures(d.limit(0), one)).count() == 0


def test_states_are_shared_and_released(spark):
    """Two filters and no tag; 2^k - 1 states are made, and none stays persisted."""
    rows = spark.createDataFrame([("p", x, y) for x in (True, False) for y in (True, False)] + [("q", True, False)], "part string, X boolean, Y boolean")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    trie = fa.edges(rows, ("X", "Y"), ())
    assert sorted((r.state, r.filter, r.part, r.total, r.removed) for r in trie.collect()) == [(0, 0, "p", 4, 2), (0, 0, "q", 1, 1), (0, 1, "p", 4, 2), (0, 1, "q", 1, 0), (1, 1, "p", 2, 1), (2, 0, "p", 2, 1), (2, 0, "q", 1, 1)]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    out = {(r.part, r.filter_order, r.step): (r["filter"], r.kept, r.removed, r.redundant, r.shapley) for r in fa.audit(rows, ("X", "Y"), ()).collect()}
    assert out["q", "XY", 2] == ("Y", 0, 0, 0, 0) and out["p", "YX", 2] == ("X", 1, 1, 1, 3) and len(out) == 8
