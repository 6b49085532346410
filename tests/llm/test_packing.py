import math
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing as pk

NASTY = [
    "a\x1cb", ".\x1c.", "a\x85b", "x y", "<|startoftext|>a", "a<|endoftext|>b <|endoftext|>", "é ́x", "ΑΣ ΣΑΣ.", "İx", "a\x0bb\x0cc\rd", "don't I'LL '’s 12345", "　a　b", "​z",
    "中文 字", "it 's", "'  s", "\x00 a\x00b", "e ́e", "ÀÉÿß÷×ñ¿¡²", "´e", "Ünïcödé's", "I'M'LL'd''s", "$$'s'x5'", "", " ", "\U0001f600\U0001f600 x", "<| <|x", "Å",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(pk.TOKENIZER)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def packed(rows, capacity):
    """The contract: pieces of each sequence follow one another from 0 and never exceed the capacity."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for some in sequences.values():
        some.sort(key=lambda r: (r.offset, r.place))
        assert [r.place for r in some] == list(range(len(some)))
        assert [r.offset for r in some] == [sum(x.length for x in some[:i]) for i in range(len(some))]
        assert sum(r.length for r in some) <= capacity
    return sequences


def decreasing_best_fit(sizes, capacity):
    gaps = []
    for s in sorted(sizes, reverse=True):
        at = min((i for i, g in enumerate(gaps) if g >= s), key=lambda i: gaps[i], default=None)
        if at is None:
            gaps.append(capacity)
            at = -1
        gaps[at] -= s
    return len(gaps)


def test_documents(spark, sf, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = pk.op13_packing(spark, sf).collect()
    pieces = {}
    for r in sorted(rows, key=lambda r: r.piece):
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for i, t in docs.items():
        ids = np.array(ids_of(tokenizer, t), "<u4")
        assert pieces.pop(i) == [(k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
    assert not pieces
    n = len(packed(rows, 4096))
    assert n <= decreasing_best_fit([r.length for r in rows], 4096) * 1.01 + 1 and n <= math.ceil(sum(r.length for r in rows) / 4096) * 1.01 + 1


def test_words_have_the_ids_of_the_library(tokenizer, monkeypatch):
    monkeypatch.setattr(pk, "MEMORY", 8)
    e = pk.Encoder(open(pk.TOKENIZER, encoding="utf-8").read())
    assert e.by_word
    texts = NASTY + [a + b for a in NASTY for b in NASTY]
    for t, ids in zip(texts, e.many([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, t)[:-1], repr(t)
    monkeypatch.setattr(pk, "RUN", 100)  # giant texts go in runs, which begin and end at white space
    for t in ("some words, more\nwords; " * 90, "é" * 150 + " tail", "unbroken" * 40, "", " " * 300):
        runs = list(e.runs(t.encode()))
        assert b"".join(runs) == t.encode() and b"".join(x for r in runs for x in e.many([r])) == e.text(t)
        assert len(runs) > 1 or " " not in t
    e.by_word = False  # as with another file: whole texts
    assert [np.frombuffer(x, "<u4").tolist() for x in e.many([t.encode() for t in NASTY])] == [ids_of(tokenizer, t)[:-1] for t in NASTY]


def test_words_of_letters_are_spared_the_slow_steps(tokenizer, monkeypatch):
    e = pk.Encoder(open(pk.TOKENIZER, encoding="utf-8").read())
    asked, cut, replace = [], [], pk.pc.replace_substring_regex

    class Letters(dict):
        def __missing__(self, c):
            asked.append(chr(c))
            raise LookupError

    e.letters = Letters(e.letters)
    monkeypatch.setattr(pk.pc, "replace_substring_regex", lambda words, *a: cut.extend(words.to_pylist()) or replace(words, *a))
    texts = ["Plain words and more words", "it's 12, Née née", "", "words 中文 once more"]
    assert [np.frombuffer(x, "<u4").tolist() for x in e.many([t.encode() for t in texts])] == [ids_of(tokenizer, t)[:-1] for t in texts]
    assert sorted(cut) == ["12,", "it's"]  # what is one part isn't split
    assert set(asked) <= set("née")  # nor is ASCII translated
    for some in ([], [""], [" "], ["", "a"], ["中"], ["a", "中 b", "c1"]):
        assert [np.frombuffer(x, "<u4").tolist() for x in e.many([t.encode() for t in some])] == [ids_of(tokenizer, t)[:-1] for t in some]


def test_nasty_rows_and_long_texts(spark, tokenizer):
    giant, unbroken = "some words, more words; " * 4_000, "abc123" * 10_000
    texts = [*NASTY, None, None, giant, giant[:50_000], unbroken, "same text"] + ["same text"] * 50
    docs = spark.createDataFrame([(i if i % 7 else None, t, "x", 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, place string, _key int, length int").repartition(3)
    rows = pk.pack(docs, keep_ids=True).cache()
    found = rows.collect()
    packed(found, 4096)
    each = [np.array(ids_of(tokenizer, t), "<u4") for t in texts]
    want = sorted(zlib.crc32(ids[s : s + 4096].tobytes()) for ids in each for s in range(0, len(ids), 4096))
    assert sorted(r.ids_crc32 for r in found) == want
    for s in pk.sequences(rows).collect():
        mine = sorted((r for r in found if r.sequence_id == s.sequence_id), key=lambda r: r.offset)
        assert s.ids == [i for r in mine for i in r.ids] and s.starts == [r.offset for r in mine]
    rows.unpersist()
    none = pk.pack(docs.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "place"]


@pytest.mark.parametrize("case", ["mixed", "one size", "over a half"])
def test_rounds(spark, monkeypatch, case):
    monkeypatch.setattr(pk, "SWEEP_ROWS", 100)  # so that most matches are between partitions
    r = random.Random(3)
    sizes = {"mixed": [min(100, int(r.lognormvariate(3, 1)) + 1) for _ in range(600)], "one size": [3] * 500, "over a half": [r.randint(40, 70) for _ in range(400)] + [1] * 30}[case]
    items = spark.createDataFrame(list(enumerate(sizes)), "key long, size long").repartition(4)
    got = pk.best_fit(items, 100).collect()
    assert sorted(x.key for x in got) == list(range(len(sizes)))
    fill = {}
    for x in got:
        fill[x.sequence] = fill.get(x.sequence, 0) + sizes[x.key]
    assert max(fill.values()) <= 100 and len(fill) <= decreasing_best_fit(sizes, 100) * 1.03 + 1


def test_across():
    # partition 0 leaves three gaps, 1 leaves a piece and a gap, 2 leaves four pieces: the nearest gaps first, the last piece gets none
    assert pk.across([(2, 4, 0), (0, 0, 3), (1, 1, 1)]) == [(1, 0, 1, 0, 0), (2, 0, 1, 1, 0), (2, 1, 3, 0, 1)]
