"""Evaluation against human annotation: six scorings and six samplings.

Gold and system rows meet by their identifier in one inner join; a row that nobody judged takes no part, and a
scoring without judged rows is empty rather than zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import normalize_ascii
from millrace.functions.values import to_number
from millrace.operators.metrics import prf, ratio
from millrace.operators.relational import first_by, order_hash, run_union

UNKNOWN = "Unknown"


def judged(gold: DataFrame, system: DataFrame, keys: list[str], columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """JN-13: gold rows with their system columns (as system_<name>), and the gold rows that the system lacks."""
    s = system.select(*keys, *[F.col(x).alias(f"system_{x}") for x in columns])
    return gold.join(s, keys), gold.join(system.select(*keys), keys, "left_anti")


def decision_scores(rows: DataFrame, decisions: dict[str, tuple[str, str]]) -> DataFrame:
    """CMP-7, detection and clustering: decision, judged, tp, fp, fn, tn, precision, recall, f1, accuracy for each (gold, system) pair of booleans.

    A null gold is not judged; a null system counts as false. All decisions come from one pass.
    """
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("decision"), F.col(g).alias("g"), F.coalesce(s, F.lit(False)).alias("s")) for n, (g, s) in decisions.items()]))
    r = rows.select(each.alias("x")).select("x.*").where("g IS NOT NULL")
    n = lambda x: F.sum(x.cast("long"))
    g, s = F.col("g"), F.col("s")
    out = r.groupBy("decision").agg(F.count("*").alias("judged"), n(g & s).alias("tp"), n(~g & s).alias("fp"), n(g & ~s).alias("fn"), n(~g & ~s).alias("tn"))
    return out.select("*", *prf(F.col("tp"), F.col("fp"), F.col("fn")), ((F.col("tp") + F.col("tn")) / F.col("judged")).alias("accuracy"))


def class_scores(rows: DataFrame, gold: str, system: str) -> DataFrame:
    """CMP-7, types: label, support, predicted, tp, precision, recall, f1 of each class; a missing system label is Unknown."""
    r = rows.where(F.coalesce(gold, F.lit("")) != "").select(F.col(gold).alias("g"), F.coalesce(system, F.lit(UNKNOWN)).alias("p"))
    one = lambda label, s, p, tp: F.struct(label.alias("label"), F.lit(s).alias("s"), F.lit(p).alias("p"), tp.alias("tp"))
    both = (F.col("g") == F.col("p")).cast("int")
    each = r.select(F.explode(F.array(one(F.col("g"), 1, 0, both), one(F.col("p"), 0, 1, F.lit(0)))).alias("x")).select("x.*")
    n = each.groupBy("label").agg(F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum("tp").alias("tp"))
    return n.select("*", *prf(F.col("tp"), F.col("predicted") - F.col("tp"), F.col("support") - F.col("tp")))


def type_scores(rows: DataFrame, gold: str, system: str) -> DataFrame:
    """CMP-7, types: one row of judged, accuracy, macro_f1, weighted_f1, typed, typed_correct, coverage, missed and typeable_recall."""
    c = class_scores(rows, gold, system)
    f1 = c.agg(F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))  # one row
    r = rows.where(F.coalesce(gold, F.lit("")) != "").select(F.col(gold).alias("g"), F.coalesce(system, F.lit(UNKNOWN)).alias("p"))
    n = lambda x: F.sum(x.cast("long"))
    g, p = F.col("g"), F.col("p")
    t = r.agg(
        F.count("*").alias("judged"), F.avg((g == p).cast("double")).alias("accuracy"), n(p != UNKNOWN).alias("typed"), n((p != UNKNOWN) & (g == p)).alias("typed_correct"),
        n((p == UNKNOWN) & (g != UNKNOWN)).alias("missed"), n(g != UNKNOWN).alias("typeable"),
    )
    out = t.join(F.broadcast(f1))
    return out.select("judged", "accuracy", "macro_f1", "weighted_f1", "typed", "typed_correct", (F.col("typed") / F.col("judged")).alias("coverage"), "missed", ratio(F.col("typeable") - F.col("missed"), F.col("typeable")).alias("typeable_recall"))


def span_scores(docs: DataFrame, gold: str = "gold", system: str = "system") -> DataFrame:
    """CMP-7, SET-6: matching (strict, or strict by label, or relaxed), label, tp, fp, fn and measures of entity spans.

    docs: two arrays of struct(start, end, label). Strict takes both as sets: the same span with the same label.
    Relaxed walks the system's spans in order, and each takes the first gold span of its label, not taken yet,
    that it overlaps. Spans that begin before 0 are not the system's.
    """
    d = docs.select(F.col(gold).alias("g"), F.filter(system, lambda e: e["start"] >= 0).alias("p"))
    sets = F.array(*[F.struct(F.lit(k).alias("k"), e.alias("e")) for k, e in (("tp", F.array_intersect("p", "g")), ("fp", F.array_except("p", "g")), ("fn", F.array_except("g", "p")))])
    strict = d.select(F.explode(sets).alias("x")).select("x.k", F.explode("x.e").alias("e")).select("k", F.col("e.label").alias("label"))
    counts = [F.sum((F.col("k") == k).cast("long")).alias(k) for k in ("tp", "fp", "fn")]
    by_label = strict.groupBy("label").agg(*counts).select(F.lit("strict").alias("matching"), "label", "tp", "fp", "fn")
    whole = strict.agg(*counts).select(F.lit("strict").alias("matching"), F.lit(None).cast("string").alias("label"), *[F.coalesce(k, F.lit(0)).alias(k) for k in ("tp", "fp", "fn")])

    def take(left: Column, p: Column) -> Column:
        """The state (gold spans left, hits) after one span of the system."""
        fits = F.transform(left["left"], lambda g: (g["label"] == p["label"]) & (p["start"] < g["end"]) & (g["start"] < p["end"]))
        at = F.array_position(fits, F.lit(True)).cast("int")
        rest = F.when(at > 0, F.concat(F.slice(left["left"], F.lit(1), F.greatest(at - 1, F.lit(0))), F.slice(left["left"], F.greatest(at + 1, F.lit(1)), F.size(left["left"])))).otherwise(left["left"])
        return F.struct(rest.alias("left"), (left["hits"] + (at > 0).cast("int")).alias("hits"))

    end = F.aggregate("p", F.struct(F.col("g").alias("left"), F.lit(0).alias("hits")), take)
    r = d.select(end.alias("z"), "p").select(F.col("z.hits").cast("long").alias("tp"), (F.size("p") - F.col("z.hits")).cast("long").alias("fp"), F.size("z.left").cast("long").alias("fn"))
    relaxed = r.agg(*[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("tp", "fp", "fn")]).select(F.lit("relaxed").alias("matching"), F.lit(None).cast("string").alias("label"), "tp", "fp", "fn")
    return by_label.union(whole).union(relaxed).select("*", *prf(F.col("tp"), F.col("fp"), F.col("fn")))


def list_field_scores(rows: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """CMP-7, extraction: field, rows, tp, fp, fn and measures of list fields, as sets of normalised texts; a null gold is not judged."""
    norm = lambda x: F.array_distinct(F.transform(F.filter(F.coalesce(x, F.array().cast("array<string>")), lambda v: F.trim(v) != ""), normalize_ascii))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(g).isNotNull().alias("known"), norm(F.col(g)).alias("g"), norm(F.col(s)).alias("p")) for n, (g, s) in fields.items()]))
    r = rows.select(each.alias("x")).select("x.*").where("known")
    sums = [F.sum(F.size(x)).alias(k) for k, x in (("tp", F.array_intersect("g", "p")), ("fp", F.array_except("p", "g")), ("fn", F.array_except("g", "p")))]
    return r.groupBy("field").agg(F.count("*").alias("rows"), *sums).select("*", *prf(F.col("tp"), F.col("fp"), F.col("fn")))


def scalar_field_scores(rows: DataFrame, fields: dict[str, tuple[str, str]], numbers: tuple[str, ...] = ()) -> DataFrame:
    """CMP-7, extraction: field, rows, exact, both_accuracy, predicted_rate and gold_rate of single values; a null gold is not judged.

    Numbers are read as numbers (a text without one counts as absent), all else is compared normalised.
    """
    def value(n: str, x: str) -> Column:
        v = F.col(x).cast("string")
        return to_number(v).cast("string") if n in numbers else F.when(v.isNotNull(), normalize_ascii(v))

    each = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(g).isNotNull().alias("known"), value(n, g).alias("g"), value(n, s).alias("p")) for n, (g, s) in fields.items()]))
    r = rows.select(each.alias("x")).select("x.*").where("known")
    g, p = F.col("g"), F.col("p")
    n = lambda x: F.sum(x.cast("long"))
    out = r.groupBy("field").agg(F.count("*").alias("rows"), n(g.eqNullSafe(p)).alias("same"), n(g.isNotNull() & p.isNotNull()).alias("both"), n(F.coalesce(g == p, F.lit(False))).alias("right"), F.count("p").alias("p"), F.count("g").alias("g"))
    return out.select("field", "rows", (F.col("same") / F.col("rows")).alias("exact"), ratio(F.col("right"), F.col("both")).alias("both_accuracy"), (F.col("p") / F.col("rows")).alias("predicted_rate"), (F.col("g") / F.col("rows")).alias("gold_rate"))


def pooled_retrieval_scores(judgements: DataFrame, runs: DataFrame, ks: tuple[int, ...] = (1, 5, 10, 20)) -> DataFrame:
    """CMP-7, retrieval: run, k and the means over judged queries of recall, precision, ndcg and mrr.

    judgements: query, uid, relevance (null: not judged); runs: run, query, uid, rank from 1. Recall is over the pool;
    what nobody judged counts as not relevant; a judged query for which a run has nothing counts as zero.
    """
    j = judgements.where("relevance IS NOT NULL").select("query", "uid", "relevance")
    w = Window.partitionBy("query").orderBy(F.desc("relevance"), "uid")
    ideal = j.withColumn("n", F.row_number().over(w))
    gain = lambda rank: F.col("relevance") / F.log2(F.col(rank) + 1)
    per_query = ideal.groupBy("query").agg(F.sum((F.col("relevance") > 0).cast("long")).alias("relevant"), *[F.sum(F.when(F.col("n") <= k, gain("n")).otherwise(0.0)).alias(f"ideal_{k}") for k in ks])
    hits = runs.join(j, ["query", "uid"])
    aggs = []
    for k in ks:
        inside = F.col("rank") <= k
        aggs += [F.sum((inside & (F.col("relevance") > 0)).cast("long")).alias(f"hits_{k}"), F.sum(F.when(inside, gain("rank")).otherwise(0.0)).alias(f"dcg_{k}"), F.min(F.when(inside & (F.col("relevance") > 0), F.col("rank"))).alias(f"first_{k}")]
    found = hits.groupBy("run", "query").agg(*aggs)
    names = runs.select("run").distinct()  # a row a retriever
    all_ = per_query.join(F.broadcast(names)).join(found, ["run", "query"], "left")
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    each = F.explode(F.array(*[F.struct(
        F.lit(k).alias("k"), zero(ratio(F.col(f"hits_{k}"), F.col("relevant"))).alias("recall"), zero(F.col(f"hits_{k}") / k).alias("precision"),
        zero(ratio(F.col(f"dcg_{k}"), F.col(f"ideal_{k}"))).alias("ndcg"), zero(1 / F.col(f"first_{k}")).alias("mrr"),
    ) for k in ks]))
    return all_.select("run", each.alias("x")).select("run", "x.*").groupBy("run", "k").agg(*[F.avg(m).alias(m) for m in ("recall", "precision", "ndcg", "mrr")])


# sampling: what annotators are given; the size is the feature, the order is that of a seeded digest


def sample_strata(rows: DataFrame, stratum: str, key: str, n: int, seed: int = 13) -> DataFrame:
    """CMP-6, detection: n rows in all, spread over the strata as evenly as their sizes allow: the first of each, then the second ..."""
    h = order_hash(seed, key)
    w = Window.partitionBy(stratum).orderBy("_h", key)
    turn = first_by(rows.withColumn("_h", h), [stratum], "_h", key, n=n).withColumn("_n", F.row_number().over(w))  # n rows a stratum
    return turn.orderBy("_n", "_h", key).limit(n).drop("_h", "_n")


def sample_types(predictions: DataFrame, label: str, key: str, n: int, seed: int = 13) -> DataFrame:
    """CMP-6, types: half from the typed rows, the rest from those that the system left Unknown."""
    p = predictions.withColumn("_typed", F.coalesce(label, F.lit(UNKNOWN)) != UNKNOWN).withColumn("_h", order_hash(seed, key))
    some = first_by(p, ["_typed"], "_h", key, n=n - n // 2)
    w = Window.partitionBy("_typed").orderBy("_h", key)
    return some.withColumn("_n", F.row_number().over(w)).where((F.col("_n") <= n // 2) | ~F.col("_typed")).drop("_typed", "_h", "_n")


def sample_rows(rows: DataFrame, key: str, n: int, seed: int = 13) -> DataFrame:
    """CMP-6, entities and extraction: n rows in the order of the digest, by a top-n that keeps n rows a task."""
    return rows.withColumn("_h", order_hash(seed, key)).orderBy("_h", key).limit(n).drop("_h")


def sample_pairs(clusters: DataFrame, near: DataFrame, n: int, per_cluster: int = 3, seed: int = 13) -> DataFrame:
    """CMP-6, coreference: a, b, same_event: half pairs that the system linked, half its most similar refusals.

    clusters: id, cluster; near: a, b, sim of neighbours. A cluster gives at most `per_cluster` pairs, of its members
    in the order of the digest, each with the next one; the refusals are neighbours of different clusters.
    """
    c = clusters.withColumn("_h", order_hash(seed, "id"))
    some = first_by(c, ["cluster"], "_h", "id", n=per_cluster + 1)
    w = Window.partitionBy("cluster").orderBy("_h", "id")
    linked = some.withColumn("b", F.lead("id").over(w)).where("b IS NOT NULL").select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b"))
    linked = sample_rows(linked.withColumn("_pair", F.concat_ws("|", "a", "b")), "_pair", n // 2, seed).select("a", "b", F.lit(True).alias("same_event"))
    of = lambda x: clusters.select(F.col("id").alias(x), F.col("cluster").alias(f"cluster_{x}"))
    refused = near.join(of("a"), "a").join(of("b"), "b").where("cluster_a <> cluster_b")
    refused = refused.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("sim").alias("sim"))
    refused = refused.orderBy(F.desc(F.round("sim", 9)), "a", "b").limit(n - n // 2).select("a", "b", F.lit(False).alias("same_event"))
    return linked.union(refused)


def sample_retrieval(runs: dict[str, DataFrame], depth: int) -> DataFrame:
    """CMP-6, retrieval: every (query, uid) among the first `depth` of some run, with its rank in each."""
    return run_union({name: df.where(F.col("rank") <= depth) for name, df in runs.items()})
