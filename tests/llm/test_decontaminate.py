import hashlib
import random
import re
import time

import pytest

from millrace.llm import decontaminate as dc
from tests.llm.oracle import ascii_lower


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))


def brute(docs, items, size=10):
    win = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - size + 1)) if w and i is not None else ():
            win.setdefault(tuple(w[s : s + size]), set()).add(str(i))
    lens, out = {len(x) for x in win}, []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in lens:
            for s in range(len(w) - n + 1):
                if (x := tuple(w[s : s + n])) in win:
                    hit.update(range(s, s + n))
                    found |= win[x]
        ids = ",".join(sorted(found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=str)


def test_equals_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert got(dc.op2_decontaminate(spark, sf)) == brute(docs, items)


@pytest.mark.parametrize("broadcast", [True, False])
def test_edges(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(dc, "BROADCAST_SHINGLES", 0)
        monkeypatch.setattr(dc, "BROADCAST_WINDOWS", 0)
        monkeypatch.setattr(dc, "SLOT_BITS", 6)
    rnd = random.Random(4)
    some = lambda n: " ".join(rnd.choice("ab cd ef gh é Z1".split()) for _ in range(n))
    items = [(1, some(14)), (2, "one"), (3, "two Words"), (4, "a b c d e f g"), (5, None), (6, "!!"), (None, "lost item"), (7, some(30)), (1, "again one"), (9, "É x")]
    long = " ".join(some(9) for _ in range(400))
    docs = [(1, f"x {items[0][1]} y {items[7][1]}"), (2, "One! ONE, one"), (3, "two-words; a b c d e f g"), (4, None), (5, ""), (6, "É x é x"), (7, items[7][1][:40]), (7, "one two"), (7, "one two"), (None, "one"), (8, long), (9, f"{items[0][1]} " * 30)]
    d = spark.createDataFrame([(*r, "z", 1) for r in docs], "doc_id long, text string, items string, row int")
    b = spark.createDataFrame([(*r, "q") for r in items], "item_id long, text string, doc_id string")
    assert got(dc.find_contamination(d, b)) == brute(docs, items)
    assert got(dc.find_contamination(d, b.limit(0))) == brute(docs, [])
    assert dc.find_contamination(d.limit(0), b).count() == 0


def test_a_long_text_is_split_once(spark):
    """The time grows with the length of a text, not with its square."""
    rnd = random.Random(9)
    text = " ".join(f"w{rnd.randrange(5000)}" for _ in range(60_000))
    item = " ".join(text.split()[31_000:31_012])
    docs = spark.createDataFrame([(1, text), (2, "w1 w2")], "doc_id long, text string")
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    began = time.time()
    assert got(dc.find_contamination(docs, items)) == brute([(1, text), (2, "w1 w2")], [(5, item)])
    assert time.time() - began < 60


def test_texts_are_read_once(spark, monkeypatch):
    """Positions are written once and serve the counts and the matches, so texts are not split a second time."""
    names, cut = [], dc.cut
    monkeypatch.setattr(dc, "cut", lambda df, name: names.append(name) or cut(df, name))
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (2, "x y z"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "b c d e f g h i j k"), (8, "x y")], "item_id long, text string")
    rows = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in dc.find_contamination(docs, items).collect()}
    assert rows == {1: (12, 10, ["7"]), 2: (3, 2, ["8"]), 3: (0, 0, [])}
    assert names.index("dc-near") < names.index("dc-counts")
