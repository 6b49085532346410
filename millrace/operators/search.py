"""BM25, rank fusion, filters and folding of hits into events."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import tokenize
from millrace.operators.relational import first_by
from millrace.session import cut, release, small_batches

K1, B, RRF_K, SUPPORT = 1.5, 0.75, 60, 0.05


#: Pairs of a query and a term that are sent to the tasks at most; products of a slice of documents; hits that a task holds before it keeps the best.
PAIRS, SLICE, HELD = 1_000_000, 1 << 20, 1 << 19


def bm25(docs: DataFrame, queries: DataFrame, k: int = 100, id_: str = "id", text: str = "text") -> DataFrame:
    """NUM-6, SRT-5: query_id, id, score, rank of the k best documents of each query (Okapi, idf floored as the public formula).

    One pass over the texts writes, a row a document, its length and how often it holds which of the queries' terms.
    Documents and terms are counted there; then each task scores its documents against all queries and sends on its k
    best a query, so that no pairs of documents and queries are shuffled and a task's memory does not follow the
    collection. With over PAIRS terms of queries, or repeated ids, the pairs are made by joins. A term with a negative
    idf gets a quarter of the mean idf. For a collection that is searched again and again there is a stored index
    (millrace.operators.index).
    """
    asked = cut(queries.select("query_id", F.explode(F.array_distinct(tokenize("query"))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("times")), "terms")
    if asked.count() > PAIRS or not docs.groupBy(id_).count().where("count > 1").isEmpty():
        return _joined_bm25(docs, queries, k, id_, text)
    spark, kind = docs.sparkSession, docs.schema[id_].dataType.simpleString()
    asked_rows = asked.collect()  # PAIRS at most
    number = {t: i for i, t in enumerate(sorted({r.term for r in asked_rows}))}
    names = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "[^a-z0-9]+", " ")
    small_batches(spark)
    tf = cut(docs.select(F.col(id_).alias("id"), names.alias("t")).mapInArrow(_counts(number), f"id {kind}, dl long, terms array<int>, counts array<int>"), "tf")
    n, mean = tf.agg(F.count("*"), F.avg("dl")).first()
    df = {r.term: r["count"] for r in tf.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}  # a row a term of the queries
    return best_documents(tf, asked_rows, number, df, n, mean, k, queries.schema["query_id"].dataType.simpleString())


def best_documents(tf: DataFrame, asked: list, number: dict[str, int], df: dict[int, int], n: int, mean: float | None, k: int, kind: str, arrange=None) -> DataFrame:
    """query_id (kind), id, score and rank of the k best of the documents in tf, each of which stands in one partition.

    tf: id, dl, terms and counts (the numbers of terms, and how often each occurs), or what arrange makes that of.
    asked: query_id, term and times; df: by number, how many of the n documents hold a term. A task sends on its k best a query.
    """
    spark, id_kind = tf.sparkSession, tf.schema["id"].dataType.simpleString()
    idf = {t: math.log((n - f + 0.5) / (f + 0.5)) for t, f in df.items()}
    floor = 0.25 * (math.fsum(idf.values()) / len(idf) if idf else 0.0)
    ids = sorted({r.query_id for r in asked}, key=lambda x: (x is not None, x))
    place = {q: i for i, q in enumerate(ids)}
    known = sorted((number[r.term], place[r.query_id], r.times) for r in asked if number[r.term] in idf)
    weights = np.array([(floor if idf[t] < 0 else idf[t]) * m for t, _, m in known])
    index = (np.searchsorted([t for t, _, _ in known], np.arange(len(number) + 1)), np.array([q for _, q, _ in known], np.int64), weights)
    best = _best_here(index, len(ids), mean or 1.0, k)
    found = tf.mapInArrow((lambda batches: best(arrange(batches))) if arrange else best, f"q int, id {id_kind}, score double")
    numbers = spark.createDataFrame(list(enumerate(ids)), f"q int, query_id {kind}")
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "id")
    scored = found.join(F.broadcast(numbers), "q").select("query_id", "id", "score")
    return scored.where(F.round("score", 9) > 0).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _counts(number: dict[str, int]):
    """id, dl, and the numbers and counts of known terms, of texts whose tokens stand between blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dl, terms, counts = [], [], []
            for t in batch.column("t").to_pylist():
                words = t.split()
                c = Counter(filter(None.__ne__, map(number.get, words)))
                dl.append(len(words))
                terms.append(sorted(c))
                counts.append([c[x] for x in terms[-1]])
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(dl, pa.int64()), pa.array(terms, lists), pa.array(counts, lists)], ["id", "dl", "terms", "counts"])
        release()

    return run


def _best_here(index: tuple[np.ndarray, np.ndarray, np.ndarray], queries: int, mean: float, k: int):
    """q, id and score of the k best documents of each query among those of a task."""
    starts, of, idf = index

    def best(held: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(held)
        t = t.append_column("rounded", pa.array(np.round(t["score"].to_numpy(), 9)))
        t = t.take(pc.sort_indices(t, [("q", "ascending"), ("rounded", "descending"), ("id", "ascending")], null_placement="at_start"))
        q = t["q"].to_numpy()
        return t.filter(pa.array(np.arange(len(q)) - np.searchsorted(q, q) < k)).drop_columns(["rounded"]).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, least = [], 0, np.zeros(queries)
        for batch in batches:
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            doc, dl = np.repeat(np.arange(len(sizes)), sizes), batch.column("dl").to_numpy().astype(float)
            term, tf = batch.column("terms").flatten().to_numpy(), batch.column("counts").flatten().to_numpy().astype(float)
            part = tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl[doc] / mean))
            times = starts[term + 1] - starts[term]
            work = np.concatenate([[0], np.cumsum(np.bincount(doc, times, len(sizes)))]) + queries * np.arange(len(sizes) + 1)
            lo = 0
            while lo < len(sizes):
                hi = max(lo + 1, int(np.searchsorted(work, work[lo] + SLICE, "right")) - 1)
                x, y = np.searchsorted(doc, [lo, hi])
                t = times[x:y]
                at = np.repeat(starts[term[x:y]] - np.concatenate([[0], np.cumsum(t)[:-1]]), t) + np.arange(t.sum()) if len(t) else np.zeros(0, np.int64)
                cell = np.repeat(doc[x:y] - lo, t) * queries + of[at]
                score = np.bincount(cell, np.repeat(part[x:y], t) * idf[at], (hi - lo) * queries).reshape(hi - lo, queries)
                d, q = np.nonzero((score > 0) & (score >= least - 1e-8))
                held.append(pa.table({"q": pa.array(q, pa.int32()), "id": batch.column("id").take(pa.array(lo + d)), "score": score[d, q]}))
                size, lo = size + len(d), hi
                if size > HELD:
                    held = [best(held)]
                    size, q, s = len(held[0]), held[0]["q"].to_numpy(), held[0]["score"].to_numpy()
                    n = np.bincount(q, minlength=queries)
                    least[n >= k] = s[np.searchsorted(q, np.flatnonzero(n >= k), "right") - 1]
        if held:
            yield from best(held).to_batches()
        release()

    return run


def _joined_bm25(docs: DataFrame, queries: DataFrame, k: int, id_: str, text: str) -> DataFrame:
    """bm25 for any number of queries and repeated ids, whose rows of one length count as one: postings that can score are shuffled."""
    lengths = docs.select(F.col(id_).alias("id"), tokenize(text).alias("t")).withColumn("dl", F.size("t").cast("double"))
    totals = lengths.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).first()
    terms = queries.select("query_id", F.explode(F.array_distinct(tokenize("query"))).alias("term"))
    tf = lengths.select("id", "dl", F.explode("t").alias("term")).join(terms.select("term").distinct(), "term").groupBy("term", "id", "dl").agg(F.count("*").alias("tf"))
    tf = cut(tf, "tf")  # read three times; and joins of written tables are split by AQE where a term is hot
    df = tf.groupBy("term").agg(F.count("*").alias("df")).withColumn("idf", F.log((F.lit(totals["n"]) - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    floor = 0.25 * (df.agg(F.avg("idf")).first()[0] or 0.0)
    idf = df.select("term", F.when(F.col("idf") < 0, F.lit(floor)).otherwise(F.col("idf")).alias("idf"))
    part = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.lit(totals["avgdl"] or 1.0)))
    scored = tf.join(idf, "term").join(terms, "term").groupBy("query_id", "id").agg(F.sum(part).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "id")
    return scored.where(F.round("score", 9) > 0).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def fuse(runs: list[DataFrame], k: int = RRF_K) -> DataFrame:
    """NUM-7, JN-11, WIN-3: query_id, id, rrf_score, rank from runs of query_id, id, rank."""
    all_ = runs[0].select("query_id", "id", "rank")
    for r in runs[1:]:
        all_ = all_.union(r.select("query_id", "id", "rank"))
    fused = all_.groupBy("query_id", "id").agg(F.sum(1 / (F.lit(float(k)) + F.col("rank"))).alias("rrf_score"))
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("rrf_score", 12)), "id")
    return fused.withColumn("rank", F.row_number().over(w))


def matches(years: list[int] | None = None, country: str | None = None, type_: str | None = None, since: str | None = None, until: str | None = None, min_deaths: int | None = None) -> Column:
    """FLT-8, FLT-9: filters over year, country, flood_type, date_min, date_max, deaths; undated rows fail date filters."""
    ok = F.lit(True)
    if years:
        ok = ok & F.col("year").isin(years)
    if country:
        ok = ok & F.contains(F.lower("country"), F.lit(country.lower()))
    if type_:
        ok = ok & (F.col("flood_type") == type_)
    if since:
        ok = ok & (F.coalesce("date_max", "date_min") >= F.lit(since))
    if until:
        ok = ok & (F.coalesce("date_min", "date_max") <= F.lit(until))
    if min_deaths is not None:
        ok = ok & (F.col("deaths") >= min_deaths)
    return F.coalesce(ok, F.lit(False))


def fold_events(hits: DataFrame, events: DataFrame, score: str = "rrf_score", support: float = SUPPORT) -> DataFrame:
    """NUM-8, JN-10: hits as events: best score * (1 + support * ln(1 + hits)); a hit without an event is one of its own."""
    own = hits.join(events.select("id", "event_id"), "id", "left").withColumn("event_id", F.coalesce("event_id", F.concat(F.lit("doc-"), F.col("id").cast("string"))))
    return own.groupBy("query_id", "event_id").agg(F.max(score).alias("best"), F.count("*").alias("hits"), F.min("rank").alias("best_rank")).withColumn("event_score", F.col("best") * (1 + support * F.log1p(F.col("hits"))))


def evidence(chunks: DataFrame, hits: DataFrame, heads: DataFrame, per: int = 3) -> DataFrame:
    """CMP-5b: the best chunks of each hit put back in the order of the text, else the head of the article."""
    best = first_by(chunks.join(hits.select("id").distinct(), "id", "left_semi"), ["id"], F.desc("sim"), "start", n=per)
    joined = best.groupBy("id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "text"))), lambda s: s["text"]), "\n").alias("evidence"))
    return hits.join(joined, "id", "left").join(heads, "id", "left").withColumn("evidence", F.coalesce("evidence", "head")).drop("head")


def rerank(hits: DataFrame, scorer: Column, first: int = 50) -> DataFrame:
    """The first hits in the order of the scorer, the rest behind them as they were."""
    key = F.when(F.col("rank") <= first, scorer)
    w = Window.partitionBy("query_id").orderBy(F.desc_nulls_last(key), "rank")
    return hits.withColumn("rank", F.row_number().over(w))
