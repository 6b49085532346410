"""Toxicity by a small convolutional text classifier, trained here in numpy.

A word is the sum of hashed embeddings: of the word and of its first 4, 5 and 6 letters, so that unseen
endings still find their stem. Filters of one, two and three words slide over the whole text; the largest
response of each goes through a dense layer. Only the positions that win the pooling get gradients, which
keeps training on long texts cheap. All labelled rows are learned from, in shards whose models are averaged after
each epoch. Thresholds are calibrated by language on a fold that the weights never see; they are an extra
output, and neither language nor source nor id enters a score.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, held_out, map_arrow, release
from millrace.operators.relational import may_be
from millrace.session import cut, drop, table

#: Labels that one task trains on, in expectation; rows that are gone through at least, in 2 to EPOCHS epochs; the weight of all toxic rows together.
SHARD, ROWS, SHARE = 8192, 60_000, 0.3
#: Rows of the embedding table that are averaged at once; characters of a step.
BLOCK, PIECE = 512, 1 << 21
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 17, 16, 8, (1, 2, 3)
EPOCHS, BATCH, RATE, SEED, CUT = 8, 64, 0.05, 11, 0.3
#: Batches after which freed memory, which lies scattered between what stays, is given back.
TRIM = 8
#: Characters whose words are listed at once, and of the texts that are scored at once; places whose responses, and words whose hashes, are held at once.
RUN, PLACES = 1 << 18, 1 << 15
#: Labelled ids that are broadcast at most; beyond that, texts pass a filter of 2 ** SLOT_BITS times 64 bits before they are shuffled for the join.
BROADCAST_LABELS, SLOT_BITS = 500_000, 20
#: The columns that score() adds.
OUTPUT = ("score", "predicted", "lang_threshold", "flagged")
_WORD, _GAP = re.compile(r"[^\W_]+"), re.compile(r"[\W_]")
_OFF = np.cumsum((0, *WIDTHS))
STEMS = (4, 5, 6)
PARTS = 1 + len(STEMS)
_ODD = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, 25)], np.uint64)


def word_buckets(words: list[str]) -> np.ndarray:
    """(words, PARTS) rows of the embedding table: of the whole word and of its stems; 0 is none."""
    return np.concatenate([_word_buckets(words[i : i + PLACES]) for i in range(0, max(1, len(words)), PLACES)])


def _word_buckets(words: list[str]) -> np.ndarray:
    codes = np.array(words, "<U24").view(np.uint32).reshape(len(words), 24).astype(np.uint64)
    n = np.fromiter(map(len, words), np.uint64, len(words))
    rest = np.fromiter((zlib.crc32(w[24:].encode("utf-8", "surrogatepass")) if len(w) > 24 else 0 for w in words), np.uint64, len(words))  # letters beyond the columns of codes
    partial = np.cumsum((codes + np.uint64(1)) * _ODD, axis=1)
    out = np.zeros((len(words), PARTS), np.int32)
    for j, (h, ok) in enumerate([(partial[:, -1] + n * _ODD[3] + rest * _ODD[5], n > 0), *((partial[:, k - 1] + np.uint64(k), n >= k) for k in STEMS)]):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        out[:, j] = np.where(ok, (h >> np.uint64(33)) % np.uint64(BUCKETS - 1) + np.uint64(1), 0)
    return out


def word_runs(text: str) -> Iterator[list[str]]:
    """The words of a text, those of about RUN characters at a time; no word is cut."""
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + RUN)
        end = gap.start() if gap else len(text)
        yield _WORD.findall(text, at, end)
        at = end


class Batch:
    """Texts as indices of their distinct words; index 0 pads every text so that each filter has a position."""

    def __init__(self, texts: list[str | None]):
        index: defaultdict[str, int] = defaultdict()
        index.default_factory = index.__len__
        parts, lengths, pad, get = [], [], np.zeros(max(WIDTHS), np.int32), index.__getitem__
        get("")  # the padding
        for t in texts:
            n = 0
            for s in word_runs(t.lower() if t else ""):
                parts.append(np.fromiter(map(get, s), np.int32, len(s)))
                n += len(s)
            lengths.append(max(1, n))
            parts.append(pad[1:] if n else pad)
        index.default_factory = None  # else the words stay in a ring of references until the garbage collector happens to come by
        self.buckets = word_buckets(list(index))
        self.lengths = np.array(lengths, np.int64)
        self.ids = np.concatenate(parts)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + max(WIDTHS) - 1)[:-1]])

    @classmethod
    def stored(cls, ids: bytes, buckets: bytes, lengths: bytes) -> Batch:
        """A batch whose arrays were written."""
        b = cls.__new__(cls)
        b.ids, b.buckets, b.lengths = np.frombuffer(ids, np.int32), np.frombuffer(buckets, np.int32).reshape(-1, PARTS), np.frombuffer(lengths, np.int64)
        b.starts = np.concatenate([[0], np.cumsum(b.lengths + max(WIDTHS) - 1)[:-1]])
        return b


@dataclass
class Model:
    emb: np.ndarray
    filters: np.ndarray  # (sum(WIDTHS), DIM, FILTERS)
    bias: np.ndarray  # (len(WIDTHS) * FILTERS,)
    dense: np.ndarray
    out: float = 0.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)

    def words(self, b: Batch) -> np.ndarray:
        e = self.emb[b.buckets[:, 0]].copy()
        for j in range(1, PARTS):
            e += self.emb[b.buckets[:, j]]
        return e

    def pooled(self, b: Batch, want_argmax: bool = False):
        """The largest response of each filter in each text, before bias; where it is.

        Responses are worked out for PLACES places at a time, so that memory does not follow the length of the texts.
        """
        e = self.words(b)
        table = np.tensordot(e, self.filters, ([1], [1]))  # (words, positions, FILTERS)
        best, where = [], []
        ends = b.starts + b.lengths
        for w, off in zip(WIDTHS, _OFF, strict=False):
            most = np.full((len(b.starts), FILTERS), -np.inf, table.dtype)
            at = np.zeros(most.shape, np.int64)
            for lo in range(0, ends[-1], PLACES):
                hi = min(lo + PLACES, ends[-1])
                z = table[b.ids[lo : hi + 1], off]  # one place more, as a bound; pads stand there at the end
                for j in range(1, w):
                    z[: hi - lo] += table[b.ids[lo + j : hi + j], off + j]
                # the last pads of each text must not win: reduce [start, end) by interleaved bounds
                texts = slice(np.searchsorted(ends, lo, "right"), np.searchsorted(b.starts, hi))
                first, last = np.maximum(b.starts[texts], lo) - lo, np.minimum(ends[texts], hi) - lo
                if not len(first):  # pads alone
                    continue
                m = np.maximum.reduceat(z, np.ravel(np.column_stack([first, last])), axis=0)[::2]
                if want_argmax:
                    size = last - first
                    text = np.repeat(np.arange(len(first)), size)
                    pos = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                    here = np.zeros(m.shape, np.int64)
                    hit, f = np.nonzero(z[pos] == m[text])
                    here[text[hit[::-1]], f[::-1]] = lo + pos[hit[::-1]]  # the first of equals stays
                    at[texts] = np.where(m > most[texts], here, at[texts])
                most[texts] = np.maximum(most[texts], m)
            best.append(most)
            where.append(at)
        return e, np.concatenate(best, 1), where

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        if not texts:
            return np.zeros(0)
        runs, size = [[]], 0
        for t in texts:
            if size >= RUN:
                runs.append([])
                size = 0
            runs[-1].append(t)
            size += len(t or "")
        return np.concatenate([self.batch_scores(Batch(r)) for r in runs])

    def batch_scores(self, b: Batch) -> np.ndarray:
        m = self.pooled(b)[1]
        z = np.maximum(m + self.bias, 0) @ self.dense + self.out
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def _start(rng: np.random.Generator) -> Model:
    k = len(WIDTHS) * FILTERS
    m = Model(
        rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32), rng.normal(0, 0.3, (sum(WIDTHS), DIM, FILTERS)).astype(np.float32),
        np.zeros(k, np.float32), rng.normal(0, 0.3, k).astype(np.float32), -1.0,
    )
    m.emb[0] = 0
    return m


def train(texts: list[str | None], labels: list[int], langs: list[str | None], seed: int = SEED) -> Model:
    """Fit on four fifths of the rows and calibrate thresholds by language on the rest."""
    rng = np.random.default_rng(seed)
    m = _start(rng)
    y = np.array(labels, np.float32)
    if len(y) == 0 or y.min() == y.max():
        m.constant = float(y.mean()) if len(y) else 0.0
        return m
    order = rng.permutation(len(y))
    fold, fit = order[: len(y) // 5], order[len(y) // 5 :]
    fit = fit[np.argsort([len(texts[i] or "") // 2000 for i in fit], kind="stable")]  # batches of like length
    batches = []
    for i in range(0, len(fit), BATCH):
        ids = fit[i : i + BATCH]
        batches.append((Batch([texts[j] for j in ids]), y[ids]))
        if len(batches) % TRIM == 0:
            release()
    grads = _fresh(m)
    for _ in range(EPOCHS):
        for done, i in enumerate(rng.permutation(len(batches))):
            if done % TRIM == 0:
                release()
            _descend(m, grads, *batches[i])
    _calibrate(m, [texts[i] for i in fold], y[fold], [langs[i] for i in fold])
    return m


def _fresh(m: Model) -> dict:
    """The sums of squared slopes before training."""
    return {"emb": np.full(BUCKETS, 1e-3, np.float32), "filters": np.full_like(m.filters, 1e-3), "bias": np.full_like(m.bias, 1e-3), "dense": np.full_like(m.dense, 1e-3), "out": 1e-3}


def _descend(m: Model, grads: dict, b: Batch, t: np.ndarray, weight: np.ndarray | float = 1.0) -> np.ndarray:
    """One step on a batch; the rows of the embedding table that moved."""
    e, best, where = m.pooled(b, True)
    a = best + m.bias
    h = np.maximum(a, 0)
    p = 1 / (1 + np.exp(-np.clip(h @ m.dense + m.out, -30, 30)))
    d = (weight * (p - t) / len(t)).astype(np.float32)
    da = d[:, None] * m.dense * (a > 0)
    g = {"dense": h.T @ d + 1e-4 * m.dense, "bias": da.sum(0)}
    g_filters, rows, values = np.zeros_like(m.filters), [], []
    for w, off, at, s in zip(WIDTHS, _OFF, where, range(len(WIDTHS)), strict=False):
        dw = da[:, s * FILTERS : (s + 1) * FILTERS]
        for j in range(w):
            ids = b.ids[at + j]  # (texts, FILTERS)
            g_filters[off + j] = np.einsum("tfd,tf->df", e[ids], dw)
            rows.append(ids.ravel())
            values.append((dw[:, :, None] * m.filters[off + j].T[None]).reshape(-1, DIM))
    words, back = np.unique(np.concatenate(rows), return_inverse=True)
    g_words = np.zeros((len(words), DIM), np.float32)
    np.add.at(g_words, back, np.concatenate(values))
    buckets, back = np.unique(b.buckets[words].ravel(), return_inverse=True)
    g_emb = np.zeros((len(buckets), DIM), np.float32)
    np.add.at(g_emb, back, np.repeat(g_words, PARTS, 0))
    g_emb[buckets == 0] = 0
    grads["emb"][buckets] += (g_emb**2).mean(1)
    m.emb[buckets] -= RATE * g_emb / np.sqrt(grads["emb"][buckets])[:, None]
    g["filters"] = g_filters
    for name in ("filters", "bias", "dense"):
        grads[name] += g[name] ** 2
        setattr(m, name, (getattr(m, name) - RATE * g[name] / np.sqrt(grads[name])).astype(np.float32))
    g_out = float(d.sum())
    grads["out"] += g_out**2
    m.out -= RATE * g_out / grads["out"] ** 0.5
    return buckets


GRID = np.round(np.arange(0.05, 0.96, 0.05), 2)


def _calibrate(m: Model, texts: list, y: np.ndarray, langs: list, least: int = 20) -> None:
    s = np.concatenate([m.scores(texts[i : i + 256]) for i in range(0, len(texts), 256)]) if texts else np.zeros(0)
    counts: dict = {}
    for lang, toxic, at in zip(langs, y, np.searchsorted(GRID, s, "right"), strict=True):
        key = (lang, int(toxic), int(at))
        counts[key] = counts.get(key, 0) + 1
    m.thresholds = _thresholds(counts, least)


def _thresholds(counts: dict[tuple[str | None, int, int], int], least: int = 20) -> dict[str, float]:
    """For each language the threshold with the best F1 (of equals, the one nearest to CUT); "" is for all others.

    counts: how many rows of (language, label, number of thresholds that the score reaches).
    """
    by: dict[str, np.ndarray] = {"": np.zeros((2, len(GRID) + 1), np.int64)}
    for (lang, toxic, at), n in counts.items():
        for key in {"", lang} - {None}:
            by.setdefault(key, np.zeros((2, len(GRID) + 1), np.int64))[toxic, at] += n
    found = {}
    for lang, c in sorted(by.items()):
        if lang and (c.sum() < least or not c[1].any()) or not c.any():
            continue
        over = c[:, ::-1].cumsum(1)[:, ::-1][:, 1:]  # rows that reach each threshold
        f1 = 2 * over[1] / np.maximum(1, over.sum(0) + c[1].sum())
        best = np.flatnonzero(f1 == f1.max())
        found[lang] = float(min(GRID[best], key=lambda x: abs(x - CUT))) if c[1].any() else CUT
    return found


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, lang and toxic of every labelled row outside the held-out quarter.

    Texts stay where they are while the labelled ids can be broadcast; beyond that, those of labelled rows alone
    (and few that the filter lets through) are shuffled.
    """
    y = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), lang)
    if labels.count() <= BROADCAST_LABELS:
        return rows.join(F.broadcast(y), "doc_id").select("doc_id", "text", "lang", "toxic")
    key = F.xxhash64(F.col("doc_id").cast("string"))
    rows = may_be(rows.withColumn("_id", key), y.select(key.alias("_id")), "_id", SLOT_BITS).drop("_id")
    return rows.join(y.hint("shuffle_merge"), "doc_id").select("doc_id", "text", "lang", "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on all labelled rows, in shards of SHARD rows, each of which goes on from the mean of all after every epoch.

    A fifth, by a hash of doc_id, gives the thresholds: all its scores are counted, by language. Toxic rows weigh
    SHARE together, however rare they are. Only models, thresholds and counts come to the driver.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    part = lambda seed, n: F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(n)).cast("int")
    # the number of labels bounds that of the shards; texts are dealt and listed once, as batches
    shards = max(1, -(-labels.count() // SHARD))
    rows = training_rows(docs, labels).select(part(SEED + 1, shards).alias("shard"), (part(SEED, 5) == 0).alias("fold"), "text", "lang", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id", F.lit(SEED + 2)).alias("spot"))
    rows = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "fold", "spot", "text").drop("spot")
    batches = cut(rows.mapInArrow(_listed, LISTED), "tx-batches")
    n = {r.fold: (r.clean, r.toxic) for r in batches.groupBy("fold").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).collect()}
    m, clean, toxic = _start(np.random.default_rng(SEED)), *n.get(False, (0, 0))
    if not clean or not toxic:
        known = sum(map(sum, n.values()))
        m.constant = sum(t for _, t in n.values()) / known if known else 0.0
        drop(batches)
        return m
    size, grads = clean + toxic, _fresh(m)
    for epoch in range(min(EPOCHS, max(2, -(-ROWS // size)))):
        _epoch(batches.where("NOT fold").drop("langs"), m, grads, [(1 - SHARE) * size / clean, SHARE * size / toxic], epoch)
    found = map_arrow(batches.where("fold").select("ids", "buckets", "lengths", "labels", "langs"), _counted(m), "lang string, toxic int, at int")
    m.thresholds = _thresholds({(r.lang, r.toxic, r.at): r["count"] for r in found.groupBy("lang", "toxic", "at").count().collect()})
    drop(batches)
    return m


LISTED = "shard int, fold boolean, clean long, toxic long, ids binary, buckets binary, lengths binary, labels binary, langs array<string>"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts as batches of one shard and fold, of BATCH texts and about PIECE characters."""
    names = [f.split()[0] for f in LISTED.split(", ")]
    kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string()))
    held, size, of = [], 0, None

    def made() -> pa.RecordBatch:
        b, y = Batch([t for t, _, _ in held]), np.array([y for _, _, y in held], np.int8)
        row = (*of, int((y == 0).sum()), int((y == 1).sum()), b.ids.tobytes(), b.buckets.tobytes(), b.lengths.tobytes(), y.tobytes(), [x for _, x, _ in held])
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

    done = 0
    for batch in batches:
        for shard, fold, text, lang, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and (of != (shard, fold) or len(held) >= BATCH or size + len(text or "") > PIECE):
                yield made()
                held, size, done = [], 0, done + 1
                if done % TRIM == 0:
                    release()
            of = (shard, fold)
            held.append((text, lang, toxic))
            size += len(text or "")
    if held:
        yield made()
    release()


def _counted(m: Model):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cells = [c.to_pylist() for c in batch.columns]
        at = [np.searchsorted(GRID, m.batch_scores(Batch.stored(*x)), "right") for x in zip(*cells[:3], strict=True)]
        y = np.concatenate([np.frombuffer(x, np.int8) for x in cells[3]])
        return pa.RecordBatch.from_arrays([pa.array(sum(cells[4], []), pa.string()), pa.array(y, pa.int32()), pa.array(np.concatenate(at), pa.int32())], ["lang", "toxic", "at"])

    return run


def _epoch(rows: DataFrame, m: Model, grads: dict, weights: list[float], epoch: int) -> None:
    """One pass over all rows; m and grads become the mean of what the shards make of them.

    A row of the embedding table is the mean over the shards that moved it, so that rare words learn as fast as in
    one shard. Shards send what they moved, in blocks of BLOCK rows of the table, and blocks are averaged in Spark.
    """
    names = ("filters", "bias", "dense", "out")
    parts = lambda m, g: np.concatenate([np.ravel(x[k]) for x in (vars(m), g) for k in names]).astype(np.float64)
    state = (m.emb, grads["emb"], {k: getattr(m, k) for k in names}, {k: grads[k] for k in names})

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            of = batch.column("shard").to_numpy()
            for lo, hi in zip(np.flatnonzero(np.r_[True, of[1:] != of[:-1]]), [*np.flatnonzero(of[1:] != of[:-1]) + 1, len(of)], strict=True):
                if of[lo] != shard:
                    if shard is not None:
                        yield sent(shard, own, g, moved, seen)
                    shard, seen, moved = int(of[lo]), 0, np.zeros(BUCKETS, bool)
                    own, g = Model(state[0].copy(), **{k: state[2][k] if k == "out" else state[2][k].copy() for k in names}), {"emb": state[1].copy(), **{k: state[3][k] if k == "out" else state[3][k].copy() for k in names}}
                    rng = np.random.default_rng((SEED, epoch, shard))
                cells = [batch.column(c) for c in ("ids", "buckets", "lengths", "labels")]
                for i in rng.permutation(np.arange(lo, hi)):
                    *arrays, y = (c[i].as_py() for c in cells)
                    t = np.frombuffer(y, np.int8).astype(np.float32)
                    moved[_descend(own, g, Batch.stored(*arrays), t, np.where(t == 1, weights[1], weights[0]))] = True
                    seen += len(t)
                release()
        if shard is not None:
            yield sent(shard, own, g, moved, seen)
        release()

    def sent(shard: int, own: Model, g: dict, moved: np.ndarray, seen: int) -> pa.RecordBatch:
        ids = np.flatnonzero(moved)
        values = np.column_stack([own.emb[ids], g["emb"][ids]])
        cuts = np.searchsorted(ids, np.arange(0, BUCKETS + BLOCK, BLOCK))
        kept = [(i // BLOCK, lo, hi) for i, lo, hi in zip(range(0, BUCKETS, BLOCK), cuts[:-1], cuts[1:], strict=True) if hi > lo]
        columns = [
            [-1, *(k for k, _, _ in kept)], [b"", *(ids[lo:hi].astype(np.int32).tobytes() for _, lo, hi in kept)], [parts(own, g).tobytes(), *(values[lo:hi].tobytes() for _, lo, hi in kept)],
        ]
        n = len(kept) + 1
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()), strict=True)), pa.array([shard] * n, pa.int32()), pa.array([seen] * n, pa.int64())], ["block", "ids", "moved", "shard", "seen"])

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["shard", "seen"])
        block = int(pdf["block"].iloc[0])
        if block < 0:
            out = sum(np.frombuffer(v) * k for v, k in zip(pdf["moved"], pdf["seen"], strict=True)) / pdf["seen"].sum()
            return pd.DataFrame({"block": [block], "ids": [b""], "moved": [out.tobytes()]})
        total, times = np.zeros((BLOCK, DIM + 1)), np.zeros(BLOCK)
        for ids, values in zip(pdf["ids"], pdf["moved"], strict=True):
            at = np.frombuffer(ids, np.int32) - block * BLOCK
            total[at] += np.frombuffer(values, np.float32).reshape(-1, DIM + 1)
            times[at] += 1
        at = np.flatnonzero(times)
        return pd.DataFrame({"block": [block], "ids": [(at + block * BLOCK).astype(np.int32).tobytes()], "moved": [(total[at] / times[at, None]).astype(np.float32).tobytes()]})

    made = rows.mapInArrow(one, "block int, ids binary, moved binary, shard int, seen long")
    merged = made.groupBy("block").applyInPandas(mean, "block int, ids binary, moved binary").collect()  # a model
    for r in merged:
        if r.block < 0:
            flat, at = np.frombuffer(r.moved), 0
            for x in (vars(m), grads):
                for k in names:
                    size = np.size(x[k])
                    x[k] = float(flat[at]) if k == "out" else flat[at : at + size].reshape(np.shape(x[k])).astype(np.float32)
                    at += size
        else:
            ids, values = np.frombuffer(r.ids, np.int32), np.frombuffer(r.moved, np.float32).reshape(-1, DIM + 1)
            m.emb[ids], grads["emb"][ids] = values[:, :DIM], values[:, DIM]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score (0 to 1), predicted (score >= 0.3), lang_threshold and flagged (score >= that threshold).

    Whole texts are scored; a null or wordless text gets the score of a text of padding. Columns of docs
    that bear one of these names are replaced. Repeated rows are scored alike; an empty table gives no rows.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = model.scores(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], [*batch.schema.names, "score"])

    docs = docs.drop(*OUTPUT)
    base = docs.withColumn("text", F.col("text").cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    out = map_arrow(base, run, f"{schema}, score double")
    limits = F.create_map(*[F.lit(x) for kv in sorted(model.thresholds.items()) for x in kv]) if model.thresholds else F.create_map(F.lit(""), F.lit(CUT))
    lang = F.coalesce(F.col("lang"), F.lit("")) if "lang" in docs.columns else F.lit("")
    limit = F.coalesce(F.try_element_at(limits, lang), F.try_element_at(limits, F.lit("")), F.lit(CUT))
    return out.withColumns({"predicted": (F.col("score") >= CUT).cast("int"), "lang_threshold": limit}).withColumn("flagged", F.col("score") >= F.col("lang_threshold"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs.select("doc_id", "text", "lang"), fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "lang_threshold", "flagged")


QUERIES = {"op3_toxicity": op3_toxicity}
