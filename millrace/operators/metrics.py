"""Evaluation: precision and recall, confusion, ranking measures, the title prefilter."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.relational import running_sums


def ratio(a: Column, b: Column) -> Column:
    """0 where the denominator is 0."""
    return F.when(b == 0, 0.0).otherwise(a / b)


def prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """NUM-9: precision, recall, f1."""
    p, r = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return [p.alias("precision"), r.alias("recall"), ratio(2 * p * r, p + r).alias("f1")]


def binary_scores(df: DataFrame, gold: str, system: str, keys: list[str] | None = None) -> DataFrame:
    """AGG-26: tp, fp, fn, tn and measures of two 0/1 columns."""
    g, s = F.col(gold) == 1, F.col(system) == 1
    n = lambda x: F.sum(x.cast("long"))
    return df.groupBy(*(keys or [])).agg(n(g & s).alias("tp"), n(~g & s).alias("fp"), n(g & ~s).alias("fn"), n(~g & ~s).alias("tn")).select(*(keys or []), "tp", "fp", "fn", "tn", *prf(F.col("tp"), F.col("fp"), F.col("fn")))


def confusion(df: DataFrame, gold: str, system: str, labels: list) -> DataFrame:
    """AGG-26: a row for each gold label, a column for each system label."""
    return df.groupBy(gold).pivot(system, labels).count().na.fill(0)


def list_scores(gold: Column, system: Column) -> list[Column]:
    """SET-2: true positives, false positives, false negatives of two lists as sets."""
    return [F.size(F.array_intersect(gold, system)).alias("tp"), F.size(F.array_except(system, gold)).alias("fp"), F.size(F.array_except(gold, system)).alias("fn")]


def ranking_scores(run: DataFrame, k: int = 10) -> DataFrame:
    """NUM-9: nDCG@k, recall@k and MRR of each query; run: query_id, id, rank (null if not found), relevance."""
    gain = F.when(F.col("rank") <= k, F.col("relevance") / F.log2(F.col("rank") + 1)).otherwise(0.0)
    w = Window.partitionBy("query_id").orderBy(F.desc("relevance"), "id")
    ideal = F.when(F.col("n") <= k, F.col("relevance") / F.log2(F.col("n") + 1)).otherwise(0.0)
    rel = F.col("relevance") > 0
    out = run.withColumn("n", F.row_number().over(w)).groupBy("query_id").agg(
        F.sum(gain).alias("dcg"), F.sum(ideal).alias("idcg"), F.sum((rel & (F.col("rank") <= k)).cast("long")).alias("hits"), F.sum(rel.cast("long")).alias("relevant"), F.min(F.when(rel & (F.col("rank") <= k), F.col("rank"))).alias("first")
    )
    return out.select("query_id", ratio(F.col("dcg"), F.col("idcg")).alias("ndcg"), ratio(F.coalesce("hits", F.lit(0)), F.col("relevant")).alias("recall"), F.coalesce(1 / F.col("first"), F.lit(0.0)).alias("mrr"))


def operating_point(scored: DataFrame, target: float, score: str = "score", label: str = "label") -> DataFrame:
    """WIN-8: the highest threshold whose recall reaches the target. Scores are counted first; sums run over range partitions."""
    by = scored.groupBy(score).agg(F.sum(label).alias("pos"), F.count("*").alias("n"))
    total = scored.agg(F.sum(label)).first()[0] or 0
    run = running_sums(by, [F.desc(score)], "pos", "n").select(F.col(score).alias("threshold"), F.col("pos_sum").cast("long").alias("tp"), F.col("n_sum").cast("long").alias("kept"))
    run = run.withColumns({"recall": F.col("tp") / F.lit(max(total, 1)), "precision": F.col("tp") / F.col("kept")})
    return run.where(F.col("recall") >= target).orderBy(F.desc("threshold")).limit(1)


def roc_auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """AGG-27: the area under the curve by ranks with ties halved, and average precision, over distinct scores.

    One descending order serves both: the negatives below a score are all of them less those down to it.
    """
    by = scored.groupBy(score).agg(F.sum(label).cast("double").alias("pos"), F.count("*").cast("double").alias("n")).withColumn("neg", F.col("n") - F.col("pos"))
    run = running_sums(by, [F.desc(score)], "pos", "n", "neg")
    out = run.agg(
        F.sum(F.col("pos") * (F.col("neg") / 2 - F.col("neg_sum"))).alias("less"), F.sum("pos").alias("p"), F.sum("neg").alias("q"), F.sum(F.col("pos") * F.col("pos_sum") / F.col("n_sum")).alias("ap")
    )
    wins = F.col("p") * F.col("q") + F.col("less")
    return out.select(ratio(wins, F.col("p") * F.col("q")).alias("roc_auc"), ratio(F.col("ap"), F.col("p")).alias("average_precision"))


def title_prefilter(train: DataFrame, text: str = "text", label: str = "label", features: int = 1 << 16, penalty: float = 0.01):
    """CMP-8: TF-IDF of words and word pairs with character trigrams of words, into a balanced logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, NGram, RegexTokenizer, SQLTransformer, VectorAssembler

    n = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    weights = " ".join(f"WHEN {label} = {k} THEN {sum(n.values()) / (len(n) * v)}" for k, v in n.items())
    stages = [
        SQLTransformer(statement=f"SELECT *, CASE {weights} ELSE 1.0 END AS weight FROM __THIS__") if label in train.columns else None,
        RegexTokenizer(inputCol=text, outputCol="words", pattern=r"\W+"), NGram(n=2, inputCol="words", outputCol="pairs"),
        SQLTransformer(statement=r"SELECT *, flatten(transform(words, w -> transform(sequence(1, greatest(length(w), 1)), i -> substring(concat(' ', w, ' '), i, 3)))) AS grams FROM __THIS__"),
        *[HashingTF(numFeatures=features, inputCol=x, outputCol=f"{x}_tf") for x in ("words", "pairs", "grams")], *[IDF(inputCol=f"{x}_tf", outputCol=f"{x}_idf") for x in ("words", "pairs", "grams")],
        VectorAssembler(inputCols=["words_idf", "pairs_idf", "grams_idf"], outputCol="features"), LogisticRegression(labelCol=label, weightCol="weight", regParam=penalty, maxIter=30),
    ]
    return Pipeline(stages=[s for s in stages if s is not None]).fit(train)


def tuned_prefilter(rows: DataFrame, text: str = "text", label: str = "label", penalties: tuple[float, ...] = (0.001, 0.01, 0.1), target: float = 0.95, every: int = 5, features: int = 1 << 16):
    """CMP-8: (model, measures): the penalty with the best average precision on held-out rows, and its operating point.

    A row is held out by a digest of its text, so that copies of a title never stand on both sides. measures has
    penalty, roc_auc, average_precision, threshold, recall and precision.
    """
    side = F.pmod(F.xxhash64(F.lower(F.trim(text))), F.lit(every)) == 0
    train, held = (rows.where(x & F.col(label).isNotNull() & F.col(text).isNotNull()) for x in (~side, side))
    best = None
    for penalty in penalties:
        model = title_prefilter(train, text, label, features, penalty)
        scored = model.transform(held).select(vector_to_array("probability")[1].alias("score"), F.col(label).cast("int").alias("label"))
        m = roc_auc(scored).first().asDict() | {"penalty": penalty}
        if best is None or m["average_precision"] > best[1]["average_precision"]:
            best = model, m, scored
    model, m, scored = best
    at = operating_point(scored, target).first()
    return model, m | ({} if at is None else {k: at[k] for k in ("threshold", "recall", "precision")})
