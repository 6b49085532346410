import re
import zlib
from collections import Counter

import numpy as np

from millrace.llm import language_id as li
from millrace.llm import sharding as sh


def test_shards_are_contiguous_balanced_and_gapless(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = sorted(sh.op4_sharding(spark, sf).collect(), key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in rows] == sorted(docs)
    total = sum(len(t.encode()) + 1 for t in docs.values())
    before = 0
    for r in rows:
        size = len(docs[r.doc_id].encode()) + 1
        assert (r.size, r.text_crc32) == (size, zlib.crc32(docs[r.doc_id].encode()))
        assert r.shard == min(7, (2 * before + size) * 8 // (2 * total))
        before += size
    for s in range(8):
        own = [r for r in rows if r.shard == s]
        assert [r.slot for r in own] == list(range(len(own)))


def test_shard_edges(spark, tmp_path):
    rows = [(None, "x", 1), (3, None, 2), (3, None, 2), (2, "", 3), (1, "é" * 5000, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sorted(sh.assign_shards(df, 3).collect(), key=lambda r: (r.shard, r.slot))
    assert [(r.doc_id, r.size) for r in got] == [(None, 2), (1, 10001), (2, 1), (3, 1), (3, 1)]
    assert sh.assign_shards(df.limit(0)).count() == 0
    plain = spark.createDataFrame([(i, "t" * (i % 7), "a") for i in range(100)], "doc_id long, text string, lang string")
    sh.write_shards(plain, str(tmp_path / "s"), 4)
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 4


def test_every_row_is_written(spark, tmp_path):
    """Null ids, repeated ids and rows that are wholly alike all arrive, in the place that the assignment gives."""
    rows = [(None, "x", "a"), (3, "same", "b"), (3, "same", "b"), (3, "other", "c"), (None, "x", "d"), (1, None, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    places = sh.write_shards(df, str(tmp_path / "s"), 2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(((r.doc_id, r.text, r._row) for r in back.collect()), key=str) == sorted(rows, key=str)
    crc = lambda t: zlib.crc32((t or "").encode())
    assert sorted(((r.doc_id, r.text_crc32, r.shard, r.slot) for r in places.collect()), key=str) == sorted(((r.doc_id, crc(r.text), r.shard, r.slot) for r in back.collect()), key=str)


def grams_of(text):
    """Codes of all n-grams of one to three characters, each word between two blanks."""
    out = []
    for word in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in text.lower())):
        c = [32, *map(ord, word), 32]
        out += c[1:-1] + [a << 21 | b for a, b in zip(c, c[1:], strict=False)]
        out += [a << 42 | b << 21 | d for a, b, d in zip(c, c[1:], c[2:], strict=False)]
    return Counter(out)


def test_language_equals_plain_counting(spark, sf):
    """Profiles and out-of-place distances again with Counter and dict, on all documents (all training rows fit the sample)."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    total = {}
    for r in docs:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            total.setdefault(r.lang, Counter()).update(grams_of(r.text or ""))
    order = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[: li.PROFILE]]
    ranks = {lang: {g: i for i, g in enumerate(order(c))} for lang, c in total.items()}
    got = {r.doc_id: r for r in li.op1_language_id(spark, sf).collect()}
    for r in docs:
        own = order(grams_of(r.text or ""))
        far = {lang: sum(abs(k[g] - i) if g in k else li.PROFILE for i, g in enumerate(own)) for lang, k in ranks.items()}
        lang = min(sorted(far), key=far.get) if own else "und"
        assert got[r.doc_id].lang_pred == lang
        assert abs(got[r.doc_id].score - (1 - far[lang] / (li.PROFILE * len(own)) if own else 0)) < 1e-12


def test_language_ties_go_to_the_first_by_name():
    p = li.Profiles({"zz": [97, 98], "aa": [98, 97], "mm": [99]}, 2)
    assert p.predict("ab")[0] == p.predict("ba")[0] and p.predict("q")[0] == "aa"


def test_language_held_out_accuracy(spark, sf):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = li.op1_language_id(spark, sf).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.95


def test_language_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !!", None), (4, "the", "en"), (5, "der die das " * 200000, "de"), (5, "der die", "de"), (None, "the of", "en")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = li.identify(df.withColumn("score", df.doc_id), li.learn(df)).collect()
    assert [r.lang_pred for r in out][:4] == ["und", "und", "und", "en"] and len(out) == len(rows)
    assert all(0 <= r.score <= 1 for r in out)
    assert li.identify(df.limit(0), li.learn(df.limit(0))).count() == 0
    assert li.identify(df, li.Profiles({})).where("lang_pred <> 'und'").count() == 0


def test_grams_of_giant_texts_equal_those_of_pieces():
    text = "ab cde, éß " * 150_000
    small, n = li.gram_counts("ab cde, éß ")
    big, m = li.gram_counts(text)
    assert set(small) == set(big) and np.all(m >= n * 150_000)
