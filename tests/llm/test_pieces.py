import random
import struct

import pytest
import sentencepiece

from millrace.llm import pieces as sp


@pytest.fixture(scope="module")
def v():
    return sp.load()


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(i, data):
    return varint(i << 3 | 2) + varint(len(data)) + data


def unigram_model(v):
    """The same pieces and scores as a unigram model of the library."""
    raw = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
    score = {i: s for _, i, s in v.pieces}
    out = b""
    for i in range(raw.vocab_size()):
        kind = 2 if raw.is_unknown(i) else 3 if raw.is_control(i) else 6 if raw.is_byte(i) else 1
        out += field(1, field(1, raw.id_to_piece(i).encode()) + b"\x15" + struct.pack("<f", score.get(i, 0.0)) + b"\x18" + varint(kind))
    out += field(2, b"\x18\x01" + varint(35 << 3) + b"\x01") + field(3, field(1, b"identity") + b"\x18\x01\x20\x00\x28\x01")
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def texts(n, rnd):
    parts = ["the ", "thand", "édonre ", " ", "  ", "\n", "ing", "über", "straße ", "中文", "\U0001f600", "x1.2,", "A", "tion.", "ñ"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 60))) for _ in range(n)]


def test_equals_the_library(v):
    lib, rnd = unigram_model(v), random.Random(1)
    for t in ["", "Hello world", " a", *texts(400, rnd)]:
        assert sp.encode(v, sp.prepare(t, v)).tolist() == lib.encode(t), t
        assert sp.decode(v, sp.encode(v, sp.prepare(t, v)).tolist()) == t


def test_chunks_equal_one_pass(v):
    rnd = random.Random(2)
    k = v.reach
    for t in [*texts(60, rnd), "abcdefgh" * 40, "straßeüber" * 30, "中" * 50 + "international" * 20]:
        p = sp.prepare(t, v)
        _, back, ids = sp.forward(v, p, len(p), [0.0])
        want = sp.trace(v, p, back, ids, len(p))[1]
        for size in (k, 23, 40):
            at = range(0, len(p), size)
            assert sp._long([(p[a : a + size + k], len(p[a : a + size])) for a in at], v) == want


def test_words_together_equal_words_alone(v):
    """The segmentation of many words at once is that of each word, ties, strange characters and long words included."""
    rnd = random.Random(5)
    alphabet = "aeinrst" * 3 + "bcdghlmopuüé中\U0001f600\x00"
    words = list({sp.SPACE * rnd.randrange(2) + "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 12))) for _ in range(4000)})
    words += ["abcdefgh" * n for n in (7, 8, 9, 40)]
    fresh = sp.load()
    got = sp.encode_many(fresh, words)
    for w, ids in zip(words, got, strict=True):
        _, back, found = sp.forward(v, w, len(w), [0.0])
        whole = sp.trace(v, w, back, found, len(w))[1] if len(v.words.findall(w)) == 1 else sp.encode(v, w).tolist()
        assert ids.tolist() == whole, w


def test_words_of_all_lengths_take_one_pass(v):
    """Few words of each length are still worked out together, with what forward() finds for each; surrogates too."""
    rnd = random.Random(8)
    words = [sp.SPACE * (n % 3) + "".join(rnd.choice("aeinrstlo\ud800é中\U0001f600") for _ in range(n)) for n in range(1, 62) for _ in range(4)]
    words += ["\n", sp.SPACE, sp.SPACE * 40, "the"]
    assert sp.best_of_words(v, words) == [sp.best_alone(v, w) for w in words]
    assert sp.best_of_words(v, []) == []


def test_words_of_chunks_are_segmented_once(v, monkeypatch):
    """Cuts are where runs of words begin, and neither they nor the matrices and maps segment what lies between."""
    rnd = random.Random(9)
    for t in [*texts(200, rnd), "", "\n\n", "abc", "▁▁▁a", " x\n y"]:
        p = sp.prepare(t, v)
        for n in {0, 1, len(p) // 2, len(p)}:
            at = [m.start() for m in v.words.finditer(p) if 0 < m.start() <= n]
            assert sp.cuts(v, p, n) == ((at[0], at[-1]) if at else None), (p, n)
    p = sp.prepare("one two three " * 50, v)
    monkeypatch.setattr(sp, "encode_many", None)
    m = sp.transfer(v, p, 600)
    assert m.shape == (v.reach, v.reach) and sp.entries(v, p, 600, [0.0] + [sp.NONE] * (v.reach - 1))[0] == 0


def test_a_full_memory_changes_nothing(v, monkeypatch):
    monkeypatch.setattr(sp, "MEMO", 5)
    small, rnd = sp.load(), random.Random(6)
    small.memo = {}
    ts = [sp.prepare(t, v) for t in texts(30, rnd)]
    assert [x.tolist() for x in sp.encode_many(small, ts)] == [sp.encode(v, t).tolist() for t in ts]
    assert len(sp.memo(small)) <= 5


@pytest.mark.parametrize("n", [1, 2, 3, 7, 30])
def test_trees_equal_one_fold(spark, v, n):
    """The tree of products gives every chunk the states that a fold from the left, and one from the right, give."""
    import numpy as np

    rng, k = np.random.default_rng(n), 4
    ms = rng.integers(-20, 0, (n, k, k)).astype(float)
    maps = rng.integers(0, k, (n, k))
    df = spark.createDataFrame([(r, c, (ms[c] - r).ravel().tolist()) for r in (0, 5) for c in range(n)], "_row long, c int, m array<double>")
    want, f = [], np.array([0.0] + [sp.NONE] * (k - 1))
    for m in ms:
        want.append(f.tolist())
        f = (f[:, None] + m).max(0)
    got = {(r._row, r.c): r.entry for r in sp.prefix_states(df, k, n, 3).collect()}
    assert [got[0, c] for c in range(n)] == want and len(got) == 2 * n
    df = spark.createDataFrame([(0, c, maps[c].tolist()) for c in range(n)], "_row long, c int, m array<int>")
    want, state = {}, 0
    for c in reversed(range(n)):
        want[c] = state
        state = int(maps[c][state])
    assert {r.c: r.exit for r in sp.suffix_states(df, n, 3).collect()} == want


def test_documents(spark, v, monkeypatch):
    monkeypatch.setattr(sp, "FOLD", 2)
    rnd = random.Random(3)
    rows = [(i, t, 7) for i, t in enumerate(["", "one", *texts(20, rnd), "word " * 2000, "unbrokentext" * 500, "\n" * 900, "end"])] + [(99, None, 1), (99, "one", 1), (99, "one", 1)]
    df = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, ids int, _ROW string")
    out = sp.encode_documents(df, v, chunk=256).collect()
    assert len(out) == len(rows) and {r._ROW for r in out} == {"mine"}
    for r in out:
        assert r.ids == sp.encode(v, sp.prepare(r.text, v)).tolist(), r.text
        assert r.round_trip is (None if r.text is None else True)
    back = sp.decode_documents(sp.encode_documents(df, v, chunk=256), v).collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert sp.encode_documents(df.limit(0), v).count() == 0


@pytest.mark.parametrize("most", [0, 500_000])
def test_texts_of_chunks_stay_where_few_states_are(spark, v, monkeypatch, most):
    """Up to a bound states go to the chunks; beyond it they meet by a shuffle, with the same ids."""
    monkeypatch.setattr(sp, "BROADCAST_STATES", most)
    sent, broadcast = [], sp.F.broadcast
    monkeypatch.setattr(sp.F, "broadcast", lambda df: sent.append(df.columns) or broadcast(df))
    df = spark.createDataFrame([(1, "one two " * 300), (2, "unbroken" * 100), (3, "x")], "doc_id long, text string")
    out = sp.encode_documents(df, v, chunk=256).collect()
    assert len(sent) == (2 if most else 0)
    assert {r.doc_id: r.ids for r in out} == {r.doc_id: sp.encode(v, sp.prepare(r.text, v)).tolist() for r in df.collect()}
