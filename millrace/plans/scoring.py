"""Queries of the evaluation: six scorings against gold and six samplings, over the columns of the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import evaluation as E
from millrace.plans.base import query
from millrace.plans.semantics import norm
from millrace.session import table


def prf_sql(tp: str = "tp", fp: str = "fp", fn: str = "fn") -> str:
    p, r = (f"(CASE WHEN {tp} + {x} = 0 THEN 0 ELSE {tp} / ({tp} + {x}) END)" for x in (fp, fn))
    return f"round({p}, 6) AS precision, round({r}, 6) AS recall, round(CASE WHEN {p} + {r} = 0 THEN 0 ELSE 2 * {p} * {r} / ({p} + {r}) END, 6) AS f1"


def _round(df, *names):
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


_M = ("precision", "recall", "f1", "accuracy")


@query(f"""WITH r AS (SELECT CASE WHEN d.doc_id % 5 > 0 THEN quality = 1 END AS g1, d.n_chars > 1500 AS s1, CASE WHEN d.doc_id % 7 > 0 THEN toxic = 1 END AS g2, CASE WHEN d.doc_id % 3 > 0 THEN d.n_chars % 4 = 0 ELSE false END AS s2 FROM labels l JOIN documents d USING (doc_id)),
x AS (SELECT 'flood' AS decision, g1 AS g, s1 AS s FROM r UNION ALL SELECT 'verifiable', g2, s2 FROM r), n AS (SELECT decision, count(*) AS judged, sum((g AND s)::INT)::BIGINT AS tp, sum((NOT g AND s)::INT)::BIGINT AS fp, sum((g AND NOT s)::INT)::BIGINT AS fn, sum((NOT g AND NOT s)::INT)::BIGINT AS tn FROM x WHERE g IS NOT NULL GROUP BY decision)
SELECT *, {prf_sql()}, round((tp + tn) / judged, 6) AS accuracy FROM n""")
def score_detection(spark, sf):
    """CMP-7, NUM-9: two decisions against their judgements, unjudged rows left out."""
    d = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")
    k, n = F.col("doc_id"), F.col("n_chars")
    r = d.select(F.when(k % 5 > 0, F.col("quality") == 1).alias("g1"), (n > 1500).alias("s1"), F.when(k % 7 > 0, F.col("toxic") == 1).alias("g2"), F.when(k % 3 > 0, n % 4 == 0).alias("s2"))
    return _round(E.decision_scores(r, {"flood": ("g1", "s1"), "verifiable": ("g2", "s2")}), *_M)


@query(f"""WITH x AS (SELECT o_orderkey % 3 = 0 AS g, o_custkey % 4 = 0 AS s FROM orders WHERE o_orderkey % 11 > 0), n AS (SELECT 'same_event' AS decision, count(*) AS judged, sum((g AND s)::INT)::BIGINT AS tp, sum((NOT g AND s)::INT)::BIGINT AS fp, sum((g AND NOT s)::INT)::BIGINT AS fn, sum((NOT g AND NOT s)::INT)::BIGINT AS tn FROM x)
SELECT *, {prf_sql()}, round((tp + tn) / judged, 6) AS accuracy FROM n""")
def score_clustering(spark, sf):
    """CMP-7: pairs judged to be one event or two."""
    k = F.col("o_orderkey")
    r = table(spark, sf, "orders").select(F.when(k % 11 > 0, k % 3 == 0).alias("gold"), (F.col("o_custkey") % 4 == 0).alias("system"))
    return _round(E.decision_scores(r, {"same_event": ("gold", "system")}), *_M)


_TYPES = """r AS (SELECT CASE l_orderkey % 4 WHEN 0 THEN 'Unknown' WHEN 1 THEN l_returnflag WHEN 2 THEN l_linestatus ELSE '' END AS g, CASE l_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN l_returnflag ELSE l_linestatus END AS p0 FROM lineitem),
j AS (SELECT g, coalesce(p0, 'Unknown') AS p FROM r WHERE g <> ''), lab AS (SELECT g AS label FROM j UNION SELECT p FROM j),
c AS (SELECT label, (SELECT count(*) FROM j WHERE g = label) AS support, (SELECT count(*) FROM j WHERE p = label) AS predicted, (SELECT count(*) FROM j WHERE g = label AND p = label) AS tp FROM lab)"""


def _types(spark, sf):
    o, p = F.col("l_orderkey") % 4, F.col("l_partkey") % 3
    gold = F.when(o == 0, "Unknown").when(o == 1, F.col("l_returnflag")).when(o == 2, F.col("l_linestatus")).otherwise("")
    return table(spark, sf, "lineitem").select(gold.alias("gold"), F.when(p == 1, F.col("l_returnflag")).when(p == 2, F.col("l_linestatus")).alias("system"))


@query(f"WITH {_TYPES} SELECT label, support, predicted, tp, {prf_sql('tp', '(predicted - tp)', '(support - tp)')} FROM c")
def score_classes(spark, sf):
    """CMP-7, AGG-26: precision, recall and F1 of each type."""
    return _round(E.class_scores(_types(spark, sf), "gold", "system"), *_M)


@query(f"""WITH {_TYPES}, f AS (SELECT support, CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * tp / (support + predicted) END AS f1 FROM c)
SELECT count(*) AS judged, round(avg((g = p)::INT::DOUBLE), 6) AS accuracy, (SELECT round(avg(f1), 6) FROM f) AS macro_f1, (SELECT round(sum(f1 * support) / sum(support), 6) FROM f) AS weighted_f1,
sum((p <> 'Unknown')::INT)::BIGINT AS typed, sum((p <> 'Unknown' AND g = p)::INT)::BIGINT AS typed_correct, round(avg((p <> 'Unknown')::INT::DOUBLE), 6) AS coverage, sum((p = 'Unknown' AND g <> 'Unknown')::INT)::BIGINT AS missed,
round(1 - sum((p = 'Unknown' AND g <> 'Unknown')::INT) / sum((g <> 'Unknown')::INT), 6) AS typeable_recall FROM j""")
def score_types(spark, sf):
    """CMP-7: macro and weighted F1, accuracy, coverage and the price of abstaining."""
    t = E.type_scores(_types(spark, sf), "gold", "system")
    return _round(t, "accuracy", "macro_f1", "weighted_f1", "coverage", "typeable_recall")


_SPANS = """l AS MATERIALIZED (SELECT *, row_number() OVER () AS rid FROM lineitem), s AS MATERIALIZED (SELECT rid, unnest(range(l_quantity::BIGINT % 7)) AS i, l_partkey % 3 AS a, l_suppkey % 4 AS b, l_suppkey % 5 AS c, l_suppkey FROM l),
g AS (SELECT rid, i * 10 + a AS x, i * 10 + 8 AS y, (i % 3)::VARCHAR AS label FROM s), p AS (SELECT rid, i * 10 + b - CASE WHEN c = 0 THEN 5 ELSE 0 END AS x, i * 10 + 6 + CASE WHEN c < 3 THEN c ELSE 2 END AS y, ((i + CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE 0 END) % 3)::VARCHAR AS label FROM s),
q AS (SELECT * FROM p WHERE x >= 0), tp AS (SELECT label, count(*) AS n FROM g JOIN q USING (rid, x, y, label) GROUP BY label), gn AS (SELECT label, count(*) AS n FROM g GROUP BY label), qn AS (SELECT label, count(*) AS n FROM q GROUP BY label),
b AS (SELECT label, coalesce(tp.n, 0) AS tp, coalesce(qn.n, 0) - coalesce(tp.n, 0) AS fp, coalesce(gn.n, 0) - coalesce(tp.n, 0) AS fn FROM gn FULL JOIN qn USING (label) LEFT JOIN tp USING (label)),
o AS (SELECT count(*) AS n FROM g JOIN q ON g.rid = q.rid AND g.label = q.label AND q.x < g.y AND g.x < q.y),
w AS (SELECT 'strict' AS matching, label, tp, fp, fn FROM b UNION ALL SELECT 'strict', NULL, sum(tp), sum(fp), sum(fn) FROM b UNION ALL SELECT 'relaxed', NULL, n, (SELECT count(*) FROM q) - n, (SELECT count(*) FROM g) - n FROM o)"""


@query(f"WITH {_SPANS} SELECT matching, label, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, {prf_sql()} FROM w")
def score_spans(spark, sf):
    """CMP-7, SET-6: entity spans, strict by label and in all, and relaxed."""
    n = (F.col("l_quantity").cast("long") % 7).cast("int")
    seq = F.filter(F.sequence(F.lit(0), F.lit(6)), lambda i: i < n)
    a, b, c = (F.col("l_partkey") % 3).cast("int"), (F.col("l_suppkey") % 4).cast("int"), (F.col("l_suppkey") % 5).cast("int")
    span = lambda x, y, label: F.struct(x.alias("start"), y.alias("end"), label.cast("string").alias("label"))
    shift = F.when(F.col("l_suppkey") % 7 == 0, 1).otherwise(0)
    gold = F.transform(seq, lambda i: span(i * 10 + a, i * 10 + 8, i % 3))
    system = F.transform(seq, lambda i: span(i * 10 + b - F.when(c == 0, 5).otherwise(0), i * 10 + 6 + F.when(c < 3, c).otherwise(2), (i + shift) % 3))
    return _round(E.span_scores(table(spark, sf, "lineitem").select(gold.alias("gold"), system.alias("system"))), *_M)


_LISTS = """r AS (SELECT p_partkey, CASE WHEN p_size % 4 > 0 THEN [p_type || '!', p_brand, p_name, ' '] END AS g1, CASE WHEN p_partkey % 3 > 0 THEN [lower(p_type), p_brand || ' x', upper(p_name)] ELSE NULL END AS s1, [p_brand] AS g2, [CASE WHEN p_size > 25 THEN lower(p_brand) ELSE p_name END, p_name] AS s2 FROM part)"""


def _set(x: str) -> str:
    return f"list_distinct(list_transform(list_filter(coalesce({x}, []), lambda v: trim(v) <> ''), lambda v: {norm('v')}))"


@query(f"""WITH {_LISTS}, u AS (SELECT 'locations' AS field, g1 AS g0, {_set('g1')} AS g, {_set('s1')} AS p FROM r UNION ALL SELECT 'rivers', g2, {_set('g2')}, {_set('s2')} FROM r),
n AS (SELECT field, count(*) AS rows, sum(len(list_intersect(g, p)))::BIGINT AS tp, sum(len(p) - len(list_intersect(g, p)))::BIGINT AS fp, sum(len(g) - len(list_intersect(g, p)))::BIGINT AS fn FROM u WHERE g0 IS NOT NULL GROUP BY field) SELECT *, {prf_sql()} FROM n""")
def score_list_fields(spark, sf):
    """CMP-7, SET-2: list fields as sets of normalised texts."""
    n, k = F.col("p_size"), F.col("p_partkey")
    r = table(spark, sf, "part").select(
        F.when(n % 4 > 0, F.array(F.concat("p_type", F.lit("!")), "p_brand", "p_name", F.lit(" "))).alias("g1"), F.when(k % 3 > 0, F.array(F.lower("p_type"), F.concat("p_brand", F.lit(" x")), F.upper("p_name"))).alias("s1"),
        F.array("p_brand").alias("g2"), F.array(F.when(n > 25, F.lower("p_brand")).otherwise(F.col("p_name")), "p_name").alias("s2"),
    )
    return _round(E.list_field_scores(r, {"locations": ("g1", "s1"), "rivers": ("g2", "s2")}), *_M)


@query(f"""WITH r AS (SELECT CASE p_size % 6 WHEN 0 THEN NULL WHEN 1 THEN 'none' ELSE p_size::VARCHAR END AS g1, CASE p_partkey % 4 WHEN 0 THEN p_size || ' people' WHEN 1 THEN 'none' WHEN 2 THEN (p_size + 1)::VARCHAR END AS s1, CASE WHEN p_size > 10 THEN p_brand || '.' END AS g2, CASE WHEN p_partkey % 3 > 0 THEN upper(p_brand) ELSE p_name END AS s2 FROM part),
u AS (SELECT 'deaths' AS field, g1 AS g0, regexp_extract(g1, '\\d+')  AS g, regexp_extract(s1, '\\d+') AS p FROM r UNION ALL SELECT 'country', g2, {norm('g2')}, {norm('s2')} FROM r), v AS (SELECT field, g0, nullif(g, '') AS g, nullif(p, '') AS p FROM u WHERE g0 IS NOT NULL)
SELECT field, count(*) AS rows, round(avg((g IS NOT DISTINCT FROM p)::INT::DOUBLE), 6) AS exact, round(sum((g = p)::INT) / sum((g IS NOT NULL AND p IS NOT NULL)::INT), 6) AS both_accuracy, round(count(p) / count(*), 6) AS predicted_rate, round(count(g) / count(*), 6) AS gold_rate FROM v GROUP BY field""")
def score_scalar_fields(spark, sf):
    """CMP-7: single values, numbers as numbers, absence that both agree on counted as exact."""
    n, k = F.col("p_size"), F.col("p_partkey")
    r = table(spark, sf, "part").select(
        F.when(n % 6 == 1, "none").when(n % 6 > 1, n.cast("string")).alias("g1"), F.when(k % 4 == 0, F.concat(n.cast("string"), F.lit(" people"))).when(k % 4 == 1, "none").when(k % 4 == 2, (n + 1).cast("string")).alias("s1"),
        F.when(n > 10, F.concat("p_brand", F.lit("."))).alias("g2"), F.when(k % 3 > 0, F.upper("p_brand")).otherwise(F.col("p_name")).alias("s2"),
    )
    return _round(E.scalar_field_scores(r, {"deaths": ("g1", "s1"), "country": ("g2", "s2")}, ("deaths",)), "exact", "both_accuracy", "predicted_rate", "gold_rate")


_RUNS = """u AS (SELECT l_suppkey AS query, l_partkey AS uid, max(l_extendedprice) AS a, min(l_discount) AS b, max(l_quantity)::BIGINT AS q FROM lineitem GROUP BY ALL), j AS (SELECT query, uid, CASE WHEN q % 4 < 3 THEN q % 4 END AS relevance FROM u),
runs AS (SELECT 'bm25' AS run, query, uid, row_number() OVER (PARTITION BY query ORDER BY a DESC, uid) AS rank FROM u UNION ALL SELECT 'dense', query, uid, row_number() OVER (PARTITION BY query ORDER BY b, uid DESC) FROM u WHERE uid % 3 > 0)"""


def _runs(spark, sf):
    u = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("query"), F.col("l_partkey").alias("uid")).agg(F.max("l_extendedprice").alias("a"), F.min("l_discount").alias("b"), F.max("l_quantity").cast("long").alias("q"))
    w = Window.partitionBy("query")
    bm25 = u.withColumn("rank", F.row_number().over(w.orderBy(F.desc("a"), "uid"))).select("query", "uid", "rank")
    dense = u.where("uid % 3 > 0").withColumn("rank", F.row_number().over(w.orderBy("b", F.desc("uid")))).select("query", "uid", "rank")
    return u.select("query", "uid", F.when(F.col("q") % 4 < 3, F.col("q") % 4).alias("relevance")), {"bm25": bm25, "dense": dense}


@query(f"""WITH {_RUNS}, jj AS (SELECT * FROM j WHERE relevance IS NOT NULL), i AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY relevance DESC, uid) AS n FROM jj), ks AS (SELECT unnest([1, 5, 10, 20]) AS k),
pq AS (SELECT query, k, sum((relevance > 0)::INT) AS rel, sum(CASE WHEN n <= k THEN relevance / log2(n + 1) ELSE 0 END) AS ideal FROM i, ks GROUP BY ALL), h AS (SELECT run, query, k, sum((rank <= k AND relevance > 0)::INT) AS hits, sum(CASE WHEN rank <= k THEN relevance / log2(rank + 1) ELSE 0 END) AS dcg, min(CASE WHEN rank <= k AND relevance > 0 THEN rank END) AS f
FROM runs JOIN jj USING (query, uid), ks GROUP BY ALL), a AS (SELECT r.run, pq.k, coalesce(CASE WHEN rel = 0 THEN 0 ELSE hits / rel END, 0) AS recall, coalesce(hits / pq.k, 0) AS precision, coalesce(CASE WHEN ideal = 0 THEN 0 ELSE dcg / ideal END, 0) AS ndcg, coalesce(1 / f, 0) AS mrr
FROM pq CROSS JOIN (SELECT DISTINCT run FROM runs) r LEFT JOIN h ON h.query = pq.query AND h.k = pq.k AND h.run = r.run) SELECT run, k, round(avg(recall), 6) AS recall, round(avg(precision), 6) AS precision, round(avg(ndcg), 6) AS ndcg, round(avg(mrr), 6) AS mrr FROM a GROUP BY ALL""")
def score_retrieval(spark, sf):
    """CMP-7, NUM-9: recall, precision, nDCG and MRR at four depths over pooled judgements, for two runs."""
    j, runs = _runs(spark, sf)
    both = runs["bm25"].withColumn("run", F.lit("bm25")).union(runs["dense"].withColumn("run", F.lit("dense")))
    return _round(E.pooled_retrieval_scores(j, both), "recall", "precision", "ndcg", "mrr")


@query("""SELECT l.doc_id, 'judged' AS state, d.n_chars, d.lang FROM labels l JOIN (SELECT * FROM documents WHERE doc_id % 3 > 0) d USING (doc_id) UNION ALL SELECT doc_id, 'missing', NULL, NULL FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 3 > 0)""")
def gold_and_system(spark, sf):
    """JN-13: gold rows with what the system says of them, and the gold rows that it lacks."""
    both, lost = E.judged(table(spark, sf, "labels"), table(spark, sf, "documents").where("doc_id % 3 > 0"), ["doc_id"], ["n_chars", "lang"])
    missing = lost.select("doc_id", F.lit("missing").alias("state"), F.lit(None).cast("long").alias("n_chars"), F.lit(None).cast("string").alias("lang"))
    return both.select("doc_id", F.lit("judged").alias("state"), F.col("system_n_chars").alias("n_chars"), F.col("system_lang").alias("lang")).union(missing)


# samples: their size is the feature


@query("""WITH s AS (SELECT doc_id, quality, md5('13|' || doc_id) AS h FROM labels), t AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, doc_id) AS n FROM s) SELECT doc_id, quality FROM t ORDER BY n, h, doc_id LIMIT 30""")
def sample_detection(spark, sf):
    """CMP-6, SRT-4: thirty rows, spread over the strata."""
    return E.sample_strata(table(spark, sf, "labels"), "quality", "doc_id", 30).select("doc_id", "quality")


@query("""WITH s AS (SELECT doc_id, CASE WHEN n_chars % 3 > 0 THEN lang END AS label, n_chars % 3 > 0 AS typed, md5('13|' || doc_id) AS h FROM documents), t AS (SELECT *, row_number() OVER (PARTITION BY typed ORDER BY h, doc_id) AS n FROM s) SELECT doc_id, label FROM t WHERE n <= CASE WHEN typed THEN 12 ELSE 13 END""")
def sample_flood_types(spark, sf):
    """CMP-6: half from typed rows, half from abstentions."""
    d = table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") % 3 > 0, F.col("lang")).alias("label"))
    return E.sample_types(d, "label", "doc_id", 25)


@query("""WITH a AS (SELECT doc_id FROM documents ORDER BY md5('7|' || doc_id), doc_id LIMIT 40) SELECT doc_id, md5(text) AS text, lang FROM documents JOIN a USING (doc_id)""")
def annotation_sample(spark, sf):
    """CMP-6, JN-12, entities: forty documents with what an annotator sees; texts are read for them alone."""
    d = table(spark, sf, "documents")
    ids = E.sample_rows(d.select("doc_id"), "doc_id", 40, seed=7)
    return d.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", F.md5("text").alias("text"), "lang")  # forty ids


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY md5('13|' || o_orderkey), o_orderkey LIMIT 25")
def sample_extraction(spark, sf):
    """CMP-6: verifiable rows in the order of a seeded digest."""
    return E.sample_rows(table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), "o_orderkey", 25)


@query("""WITH c AS (SELECT o_orderkey AS id, o_custkey AS cluster, md5('13|' || o_orderkey) AS h FROM orders), t AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY h, id) AS n FROM c), l AS (SELECT id, lead(id) OVER (PARTITION BY cluster ORDER BY h, id) AS b FROM t WHERE n <= 4),
p AS (SELECT least(id, b) AS a, greatest(id, b) AS b FROM l WHERE b IS NOT NULL), s AS (SELECT a, b, true AS same_event FROM p ORDER BY md5('13|' || a || '|' || b), a || '|' || b LIMIT 10),
n AS (SELECT o_orderkey AS a, o_orderkey + 1 AS b, (o_orderkey * 37 % 1000) / 1000 AS sim FROM orders), r AS (SELECT n.a, n.b, sim FROM n JOIN c x ON x.id = n.a JOIN c y ON y.id = n.b WHERE x.cluster <> y.cluster),
q AS (SELECT a, b, false AS same_event FROM r ORDER BY round(sim, 9) DESC, a, b LIMIT 11) SELECT * FROM s UNION ALL SELECT * FROM q""")
def sample_pairs(spark, sf):
    """CMP-6: half pairs of one cluster, half the most similar neighbours of different clusters."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    near = o.select(k.alias("a"), (k + 1).alias("b"), (k * 37 % 1000 / 1000).alias("sim"))
    return E.sample_pairs(o.select(k.alias("id"), F.col("o_custkey").alias("cluster")), near, 21)


@query(f"""WITH {_RUNS} SELECT query, uid, min(CASE WHEN run = 'bm25' THEN rank END) AS bm25_rank, min(CASE WHEN run = 'dense' THEN rank END) AS dense_rank FROM runs WHERE rank <= 7 GROUP BY ALL""")
def sample_retrieval(spark, sf):
    """CMP-6, SET-1: pooled results of two runs with their rank in each."""
    return E.sample_retrieval(_runs(spark, sf)[1], 7)
