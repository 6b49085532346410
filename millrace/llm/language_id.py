"""Language identification by rank-order profiles of character n-grams (Cavnar and Trenkle 1994).

The n-grams of one to three characters of a text's words, each word between two blanks, are counted; the
most frequent ones in order are its profile. A document's distance to a language is the sum over its profile
of how far each n-gram is out of place there, and the nearest language wins. An n-gram is one integer of
63 bits (three code points of 21), so counting is sorting, without collisions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import bounded_batches, held_out, map_arrow
from millrace.session import table

#: Length of a profile, and the rows of each language that profiles are learnt from, in expectation (taken by a hash of doc_id).
PROFILE, TRAIN_ROWS, SEED = 400, 3000, 29
UNDETERMINED = "und"
_CHUNK = 1 << 20
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def _grams(codes: np.ndarray) -> np.ndarray:
    """All n-grams of lower-case code points in which everything but letters is a blank (code 32)."""
    c = np.where(_is_letter()[codes], codes, 32).astype(np.int64)
    c = np.concatenate([[32], c, [32]])
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)  # one blank between words
    c = c[keep]
    word = c != 32
    one = c[word]
    two = (c[:-1] << 21 | c[1:])[word[:-1] | word[1:]]
    three = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[word[1:-1]]
    return np.concatenate([one, two, three])


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams in order and their counts; giant texts are counted in pieces, cut at blanks of their words."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(codes) <= _CHUNK:
        return np.unique(_grams(codes), return_counts=True)
    blanks, at, parts = np.flatnonzero(~_is_letter()[codes]), 0, []
    while at < len(codes):
        k = np.searchsorted(blanks, at + _CHUNK)
        end = int(blanks[k]) + 1 if k < len(blanks) else len(codes)
        parts.append(np.unique(_grams(codes[at:end]), return_counts=True))
        at = end
    grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(back, np.concatenate([n for _, n in parts])).astype(np.int64)


def profile(text: str | None, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, the first is the most frequent; of equals the smaller code is first."""
    grams, n = gram_counts(text)
    if len(n) > size:
        least = np.partition(n, len(n) - size)[len(n) - size]
        grams, n = grams[n >= least], n[n >= least]
    return grams[np.lexsort((grams, -n))[:size]]


class Profiles:
    """Ranks of the n-grams of each language."""

    def __init__(self, ranked: dict[str, list[int]], size: int = PROFILE):
        self.langs, self.size = sorted(ranked), size
        self.grams = np.unique(np.array([g for r in ranked.values() for g in r], np.int64))
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)  # the last column is for n-grams of no profile
        for i, lang in enumerate(self.langs):
            self.ranks[i, np.searchsorted(self.grams, np.array(ranked[lang], np.int64))] = np.arange(len(ranked[lang]))

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score (1 less the share of the greatest distance) and margin to the second; of equals the first by name."""
        p = profile(text, self.size)
        if not len(p) or not self.langs:
            return UNDETERMINED, 0.0, 0.0
        at = np.minimum(np.searchsorted(self.grams, p), len(self.grams) - 1)
        at = np.where(self.grams[at] == p, at, len(self.grams))
        r = self.ranks[:, at]
        d = np.where(r < 0, self.size, np.abs(r - np.arange(len(p)))).sum(1)
        best = int(np.argmin(d))
        rest = np.delete(d, best)
        most = self.size * len(p)
        return self.langs[best], 1 - float(d[best]) / most, float(rest.min() - d[best]) / most if len(rest) else 1.0


def learn(docs: DataFrame, rows: int = TRAIN_ROWS, size: int = PROFILE) -> Profiles:
    """Profiles from a bounded sample of rows with a language outside the held-out quarter; counts are summed in Spark."""
    known = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    n = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not n:
        return Profiles({}, size)
    rate = F.try_element_at(F.create_map(*[F.lit(x) for k, v in sorted(n.items()) for x in (k, rows / v)]), F.col("lang"))
    spot = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1_000_000)) / 1e6
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            by: dict[str, list] = {}
            for lang, text in zip(langs, batch.column("text").to_pylist(), strict=True):
                by.setdefault(lang, []).append(gram_counts(text))
            for lang, parts in by.items():
                grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                total = np.bincount(back, np.concatenate([c for _, c in parts]), len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(total)], ["lang", "gram", "n"])

    counts = known.where(spot < rate).select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= size)  # size rows a language
    ranked: dict[str, list[int]] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["rank"])):
        ranked.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(ranked, size)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """docs with lang_pred, score (0 to 1) and margin, from the whole text alone.

    A null text, or one without letters, is "und" with score 0, and so is every text if nothing was learnt.
    Columns of docs that bear one of these names are replaced; rows that repeat are predicted alike.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [profiles.predict(t) for t in batch.column("text").to_pylist()]
        new = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
        return pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "lang_pred", "score", "margin"])

    base = docs.drop("lang_pred", "score", "margin").withColumn("text", F.col("text").cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return map_arrow(base, run, f"{schema}, lang_pred string, score double, margin double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), learn(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin")


QUERIES = {"op1_language_id": op1_language_id}
