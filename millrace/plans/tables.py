"""Queries over embeddings, labels, events and the order tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import values as V
from millrace.operators import ivf, metrics, relational, vector
from millrace.operators.clusters import span_limited_clusters
from millrace.operators.graph import connected_components
from millrace.plans.base import query
from millrace.session import shared_dir, table
from millrace.streaming import live


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


_DOT = "list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"
_KNN = f"""k AS (SELECT a.vec_id AS a, b.vec_id AS b, {_DOT} AS sim, row_number() OVER (PARTITION BY a.vec_id ORDER BY {_DOT} DESC, b.vec_id) AS rank
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)"""


@query(f"WITH {_KNN} SELECT a, b, round(sim, 6) AS sim, rank FROM k WHERE rank <= 5")
def emb_knn_topk(spark, sf):
    """JN-6, WIN-2, NUM-10."""
    return vector.knn(_vectors(spark, sf), 5).select("a", "b", F.round("sim", 6).alias("sim"), F.col("rank").cast("long").alias("rank"))


_PAIRS = f"""{_KNN}, p AS (SELECT least(a, b) AS a, greatest(a, b) AS b, max(sim) AS sim FROM k WHERE rank <= 5 GROUP BY ALL),
s AS (SELECT a, b, sim, 0.55 * least(greatest(sim, 0), 1) + 0.15 * 0.35 + 0.15 * 0.5 + 0.05 * 0.5 + 0.05 * (x.label = y.label)::INT + 0.05 * 0.5 AS score
FROM p JOIN embeddings x ON x.vec_id = a JOIN embeddings y ON y.vec_id = b)"""


def _scored(spark, sf):
    near = vector.knn(_vectors(spark, sf), 5)
    p = near.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("sim").alias("sim"))
    none = {"date_min": F.lit(None).cast("date"), "date_max": F.lit(None).cast("date"), "places": F.array().cast("array<string>"), "rivers": F.array().cast("array<string>"), "country": F.lit("")}
    meta = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("type"), *[c.alias(k) for k, c in none.items()])
    for s in "ab":
        p = p.join(meta.select(*[F.col(x).alias(s if x == "id" else f"{x}_{s}") for x in meta.columns]), s)
    return vector.pair_signals(p).withColumn("score", vector.pair_score()).where(~vector.veto())


@query(f"WITH {_PAIRS} SELECT a, b, round(score, 6) AS score FROM s")
def emb_pair_score(spark, sf):
    """NUM-11, DAT-4: semantic and type signals, all others unknown."""
    return _scored(spark, sf).select("a", "b", F.round("score", 6).alias("score"))


@query(f"""WITH RECURSIVE {_PAIRS}, l AS (SELECT a, b FROM s WHERE score >= 0.44), u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS node, a AS root FROM u UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.node), g AS (SELECT node, min(root) AS c FROM r GROUP BY node)
SELECT size, count(*) AS clusters FROM (SELECT c, count(*) AS size FROM g GROUP BY c) GROUP BY size""")
def emb_cluster_sizes(spark, sf):
    """CMP-1 without the span limit; AGG-3."""
    g = connected_components(_scored(spark, sf).where("score >= 0.44"))
    return g.groupBy("component").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters"))


@query()
def emb_ivf_neighbours(spark, sf):
    """JN-6, WIN-2 by an inverted file over all vectors: 20 neighbours of each whose id is divisible by 50. Approximate, so no SQL."""
    v = _vectors(spark, sf)
    index = ivf.build(v, f"{shared_dir(spark)}/ivf-{uuid.uuid4().hex}")
    return ivf.search(index, v.where("id % 50 = 0")).select("a", "b", F.round("sim", 6).alias("sim"), F.col("rank").cast("long").alias("rank"))


_SPAN_DAYS, _SPAN_SCORE = 45, 0.38


@query(f"""WITH RECURSIVE {_PAIRS}, n AS (SELECT vec_id AS id, row_number() OVER (ORDER BY vec_id) AS pos,
CASE WHEN vec_id % 11 <> 0 THEN DATE '2021-01-01' + (vec_id * 37 % 180)::INT END AS day FROM embeddings),
l AS MATERIALIZED (SELECT x.pos AS a, y.pos AS b, row_number() OVER (ORDER BY round(score * 1e6) DESC, s.a, s.b) AS i FROM s JOIN n x ON x.id = s.a JOIN n y ON y.id = s.b WHERE score >= {_SPAN_SCORE}),
u(i, owner, lo, hi) AS (SELECT 0::BIGINT, list(pos ORDER BY pos), list(day ORDER BY pos), list(day ORDER BY pos) FROM n
UNION ALL SELECT i, CASE WHEN ok THEN list_transform(owner, lambda c: CASE WHEN c = gone THEN keep ELSE c END) ELSE owner END,
CASE WHEN ok THEN list_concat(lo[1:keep - 1], [first_day], lo[keep + 1:]) ELSE lo END, CASE WHEN ok THEN list_concat(hi[1:keep - 1], [last_day], hi[keep + 1:]) ELSE hi END
FROM (SELECT *, keep <> gone AND coalesce(last_day - first_day <= {_SPAN_DAYS}, true) AS ok FROM (SELECT *, least(lo[keep], lo[gone]) AS first_day, greatest(hi[keep], hi[gone]) AS last_day
FROM (SELECT l.i, u.owner, u.lo, u.hi, least(u.owner[l.a], u.owner[l.b]) AS keep, greatest(u.owner[l.a], u.owner[l.b]) AS gone FROM u JOIN l ON l.i = u.i + 1)))),
f AS (SELECT owner FROM u ORDER BY i DESC LIMIT 1), e AS (SELECT n.id, n.day, n.pos, f.owner[n.pos] AS c FROM n, f)
SELECT m.id AS cluster, count(*) AS n_articles, min(e.day) AS date_min, max(e.day) AS date_max FROM e JOIN n m ON m.pos = e.c GROUP BY m.id""")
def emb_span_clusters(spark, sf):
    """CMP-1: the union that depends on the order of links, by score, under a span of 45 days; one row an event."""
    links = _scored(spark, sf).where(F.col("score") >= _SPAN_SCORE).select("a", "b", (-F.round(F.col("score") * 1e6)).cast("long").alias("order"))
    day = F.when(F.col("id") % 11 != 0, F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") * 37 % 180).cast("int")))
    days = _vectors(spark, sf).select("id", day.alias("day"))
    clusters = span_limited_clusters(links, days.select(F.col("id").alias("node"), F.col("day").alias("lo"), F.col("day").alias("hi")), _SPAN_DAYS)
    placed = days.join(clusters.withColumnRenamed("node", "id"), "id", "left").withColumn("cluster", F.coalesce("cluster", "id"))
    return placed.groupBy("cluster").agg(F.count("*").alias("n_articles"), F.min("day").alias("date_min"), F.max("day").alias("date_max"))


@query("""WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), m AS (SELECT label, i, avg(x) AS mx FROM x GROUP BY ALL),
s AS (SELECT x.label, vec_id, round(sum(x * mx), 9) AS c FROM x JOIN m USING (label, i) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY c DESC, vec_id) AS n FROM s)
SELECT label, vec_id AS medoid, round(c, 6) AS mean_cosine FROM r WHERE n = 1""")
def emb_medoids(spark, sf):
    """AGG-21: labels stand for clusters."""
    m = vector.medoids(table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label"), "label")
    return m.withColumn("mean_cosine", F.round("mean_cosine", 6))


@query("""WITH x AS (SELECT l_partkey, CASE WHEN l_quantity >= 3 THEN l_quantity END AS q, l_suppkey FROM lineitem),
a AS (SELECT l_partkey, coalesce(max(q), -1) AS value, min(q) AS min, max(q) AS max, count(q) AS reports, count(DISTINCT q) > 1 AS conflict FROM x GROUP BY l_partkey)
SELECT * FROM a""")
def order_count_estimates(spark, sf):
    """AGG-6: what reports (line items) say of a count; quantities under 3 stand for unknown."""
    l = table(spark, sf, "lineitem").select("l_partkey", F.when(F.col("l_quantity") >= 3, F.col("l_quantity")).otherwise(-1.0).alias("q"))
    return relational.merge_counts(l, ["l_partkey"], "q")


@query("""WITH c AS (SELECT l_partkey, l_returnflag, count(*) AS n, avg(l_discount) AS d FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_returnflag) AS k FROM c)
SELECT l_partkey, l_returnflag AS mode, n, round(d, 6) AS mean_score FROM r WHERE k = 1""")
def order_mode_flag(spark, sf):
    """AGG-8: the majority value, ties to the smallest, and the mean score of its rows."""
    return relational.mode_of(table(spark, sf, "lineitem"), ["l_partkey"], "l_returnflag", "l_discount").select("l_partkey", F.col("l_returnflag").alias("mode"), "n", F.round("mean_score", 6).alias("mean_score"))


@query("""SELECT severity, count(*) AS n FROM (SELECT CASE WHEN o_totalprice < 1000 THEN NULL WHEN o_totalprice >= 300000 THEN 'catastrophic' WHEN o_totalprice >= 150000 THEN 'severe' WHEN o_totalprice >= 50000 THEN 'moderate' WHEN o_totalprice >= 0 THEN 'minor' END AS severity FROM orders) GROUP BY severity""")
def severity_bands(spark, sf):
    """AGG-10: bands of magnitude; prices under 1,000 stand for unknown."""
    x = F.when(F.col("o_totalprice") >= 1000, F.col("o_totalprice"))
    bands = [("catastrophic", 300000, 300000), ("severe", 150000, 150000), ("moderate", 50000, 50000), ("minor", 0, 0)]
    return table(spark, sf, "orders").select(V.severity(x, F.lit(None).cast("double"), bands).alias("severity")).groupBy("severity").agg(F.count("*").alias("n"))


@query("""SELECT o_orderpriority AS field, count(*) AS n, sum((o_totalprice > 1000)::INT)::BIGINT AS clean, round(sum(o_totalprice), 2) AS total, max(o_totalprice) AS most, arg_max(o_orderkey, o_totalprice) AS at,
round(median(o_totalprice), 6) AS median FROM orders GROUP BY ALL""")
def median_impact(spark, sf):
    """AGG-11, AGG-22: sums, the largest with its key, exact medians."""
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("field")).agg(
        F.count("*").alias("n"), F.sum((F.col("o_totalprice") > 1000).cast("long")).alias("clean"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("o_totalprice").alias("most"),
        F.max_by("o_orderkey", "o_totalprice").alias("at"), F.round(F.percentile("o_totalprice", F.lit(0.5)), 6).alias("median"),
    )


@query("""WITH g AS (SELECT o_custkey, date_trunc('month', o_orderdate) AS m, max(o_totalprice) AS v FROM orders GROUP BY ALL)
SELECT o_custkey, count(*) AS events, round(sum(v), 2) AS total, round(median(v), 6) AS median FROM g GROUP BY o_custkey""")
def impact_dedup(spark, sf):
    """AGG-12: the largest figure of each (place, date) group, then sum and median."""
    g = table(spark, sf, "orders").groupBy("o_custkey", F.date_trunc("month", "o_orderdate").alias("m")).agg(F.max("o_totalprice").alias("v"))
    return g.groupBy("o_custkey").agg(F.count("*").alias("events"), F.round(F.sum("v"), 2).alias("total"), F.round(F.percentile("v", F.lit(0.5)), 6).alias("median"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IS NOT NULL)")
def resume_anti_join(spark, sf):
    """SNK-2, JN-5, SET-4: what is not done yet."""
    done = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return relational.resume(table(spark, sf, "orders"), done, "o_orderkey").select("o_orderkey", "o_custkey")


@query("""WITH p AS (SELECT c_custkey, 'patched ' || c_name AS n FROM customer WHERE c_acctbal < 0) SELECT c_custkey, coalesce(p.n, c_name) AS c_name FROM customer LEFT JOIN p USING (c_custkey)""")
def patch_merge(spark, sf):
    """SNK-6, JN-4: rows replaced where a patch is accepted."""
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    patch = c.withColumn("c_name", F.concat(F.lit("patched "), "c_name"))
    return relational.merge(c, patch, "c_custkey", "c_name", F.col("c_acctbal") < 0).select("c_custkey", "c_name")


@query("""SELECT n_name, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders, round(coalesce(sum(o_totalprice), 0), 2) AS total FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_name""")
def enrichment_join(spark, sf):
    """JN-2, JN-3, JN-10: left joins along keys."""
    o = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("k"), F.sum("o_totalprice").alias("v"))
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")).join(o, "c_custkey", "left")
    per = c.groupBy("n_nationkey").agg(F.count("*").alias("customers"), F.sum("k").alias("orders"), F.sum("v").alias("total"))
    n = table(spark, sf, "nation").join(per, "n_nationkey", "left")
    return n.select("n_name", *[F.coalesce(x, F.lit(0)).cast("long").alias(x) for x in ("customers", "orders")], F.round(F.coalesce("total", F.lit(0.0)), 2).alias("total"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 3")
def best_per_key(spark, sf):
    """WIN-4: the best three rows of each key."""
    return relational.first_by(table(spark, sf, "orders"), ["o_custkey"], F.desc("o_totalprice"), "o_orderkey", n=3).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT a.l_partkey AS part, count(*) AS both FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'A') a JOIN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R') b ON a.l_partkey = b.l_partkey GROUP BY ALL".replace("AS both", "AS n"))
def set_intersection(spark, sf):
    """SET-2, SET-3: keys in both of two sets."""
    l = table(spark, sf, "lineitem")
    s = [l.where(F.col("l_returnflag") == f).select(F.col("l_partkey").alias("part")) for f in "AR"]
    return s[0].intersect(s[1]).withColumn("n", F.lit(1).cast("long"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 45 THEN 'l_quantity' WHEN l_discount >= 0.1 THEN 'l_discount' END AS outlier FROM lineitem WHERE l_quantity >= 45 OR l_discount >= 0.1")
def implausible_values(spark, sf):
    """FLT-16: values over the limit of their field."""
    found = V.implausible({"l_quantity": 45, "l_discount": 0.1})
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.get(found, F.lit(0))["field"].alias("outlier")).where("outlier IS NOT NULL")


@query("""SELECT a.o_orderkey AS a, b.o_orderkey AS b, greatest(date_diff('day', a.o_orderdate, b.o_orderdate), date_diff('day', b.o_orderdate, a.o_orderdate), 0) AS gap
FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey WHERE abs(date_diff('day', a.o_orderdate, b.o_orderdate)) <= 3""")
def interval_join(spark, sf):
    """JN-8, DAT-3: pairs of one key whose dates are at most three days apart."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("d"))
    return relational.interval_pairs(o, "o_custkey", "o_orderkey", "d", "d", 3).select("a", "b", F.col("gap").cast("long").alias("gap"))


@query("SELECT event_type, json_extract_string(props, '$.' || k) AS value, k AS key, count(*) AS n FROM (SELECT event_type, props, unnest(json_keys(props)) AS k FROM events) GROUP BY ALL")
def events_explode_props(spark, sf):
    """ARR-5, ARR-6, AGG-15: keys of JSON properties with their values."""
    e = table(spark, sf, "events").select("event_type", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    return e.groupBy("event_type", "key", "value").agg(F.count("*").alias("n"))


@query("""SELECT event_id, round(CASE WHEN t - min(t) OVER w >= 5 THEN count(*) OVER w / (t - min(t) OVER w) END, 6) AS rate FROM (SELECT *, floor(epoch(ts))::BIGINT AS t FROM events) WINDOW w AS (PARTITION BY event_type ORDER BY t RANGE BETWEEN 60 PRECEDING AND CURRENT ROW)""")
def rate_60s(spark, sf):
    """WIN-6, STM-4."""
    return live.trailing_rate(table(spark, sf, "events"), ["event_type"]).select("event_id", F.round("rate", 6).alias("rate"))


@query("""WITH s AS (SELECT user_id, event_type, floor(epoch(ts))::BIGINT AS t, event_id FROM events), d AS (SELECT user_id, t - lag(t) OVER w AS dt, event_id - lag(event_id) OVER w AS dn FROM s WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
SELECT user_id, sum(dn)::BIGINT AS items, sum(dt)::BIGINT AS seconds, round(sum(dn) / sum(dt), 6) AS rate FROM d WHERE dt > 0 AND dt <= 86400 AND dn >= 0 GROUP BY user_id""")
def gap_rates(spark, sf):
    """WIN-7, STM-6: rates between samples, gaps over a day left out."""
    d = live.gap_rates(table(spark, sf, "events"), ["user_id"], "ts", "event_id", interval=21_600)  # four intervals are a day
    return d.select("user_id", "items", "seconds", F.round("rate", 6).alias("rate"))


@query("SELECT event_type, time_bucket(INTERVAL 1 hour, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def events_tumbling(spark, sf):
    """Tumbling windows of an hour; the same function serves the stream."""
    e = live.tumbling(table(spark, sf, "events"), "1 hour", ["event_type"])
    return e.select("event_type", F.col("window.start").alias("start"), "n", F.round("total", 4).alias("total"))


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 minute THEN 0 ELSE 1 END AS new FROM events),
g AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id, min(ts) AS start, count(*) AS n FROM g GROUP BY user_id, k""")
def events_session(spark, sf):
    """STM-6: sessions with gaps under half an hour."""
    return live.sessions(table(spark, sf, "events"), "30 minutes", ["user_id"]).select("user_id", F.col("session_window.start").alias("start"), "n")


@query("SELECT user_id % 50 AS part, event_type AS article_id, CASE WHEN max((value >= 50)::INT) = 1 THEN 'ok' ELSE 'failed' END AS state FROM events GROUP BY ALL".replace("user_id % 50 AS part", "user_id::VARCHAR AS part"))
def reconcile_states(spark, sf):
    """STM-2: success and failure reports of an item reconciled."""
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("part"), F.col("event_type").alias("article_id"), (F.col("value") >= 50).alias("ok"))
    return live.reconcile_batch(e)


@query("SELECT month(ts) AS month, event_type, count(*) AS n FROM events GROUP BY ALL")
def events_seasonality(spark, sf):
    """DAT-7, STM-3: counts by month."""
    return table(spark, sf, "events").groupBy(F.month("ts").cast("long").alias("month"), "event_type").agg(F.count("*").alias("n"))


@query("SELECT quality, sum((toxic = 0)::INT)::BIGINT AS t0, sum((toxic = 1)::INT)::BIGINT AS t1 FROM labels GROUP BY quality")
def label_confusion(spark, sf):
    """AGG-26: quality as gold, toxicity as system."""
    return metrics.confusion(table(spark, sf, "labels"), "quality", "toxic", [0, 1]).select("quality", F.col("0").alias("t0"), F.col("1").alias("t1"))


@query("""WITH c AS (SELECT sum((quality = 1 AND toxic = 1)::INT) AS tp, sum((quality = 0 AND toxic = 1)::INT) AS fp, sum((quality = 1 AND toxic = 0)::INT) AS fn, sum((quality = 0 AND toxic = 0)::INT) AS tn FROM labels)
SELECT tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, tn::BIGINT AS tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) AS f1 FROM c""")
def label_prf(spark, sf):
    """NUM-9."""
    m = metrics.binary_scores(table(spark, sf, "labels"), "quality", "toxic")
    return m.select("tp", "fp", "fn", "tn", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")])


_SCORED = "s AS (SELECT l.toxic AS label, d.n_chars AS score FROM labels l JOIN documents d USING (doc_id))"


def _label_scores(spark, sf):
    return table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("score")), "doc_id").select(F.col("toxic").alias("label"), "score")


@query(f"""WITH {_SCORED} SELECT round((SELECT sum((p.score > q.score)::INT + 0.5 * (p.score = q.score)::INT) / count(*) FROM s p, s q WHERE p.label = 1 AND q.label = 0), 6) AS roc_auc,
round((SELECT sum(label * tp / kept) / sum(label) FROM (SELECT label, sum(label) OVER w AS tp, count(*) OVER w AS kept FROM s WINDOW w AS (ORDER BY score DESC RANGE UNBOUNDED PRECEDING))), 6) AS average_precision""")
def label_auc(spark, sf):
    """AGG-27: length as a score of toxicity."""
    a = metrics.roc_auc(_label_scores(spark, sf))
    return a.select(*[F.round(x, 6).alias(x) for x in a.columns])


@query(f"""WITH {_SCORED}, r AS (SELECT DISTINCT score AS threshold, sum(label) OVER w AS tp, count(*) OVER w AS kept FROM s WINDOW w AS (ORDER BY score DESC RANGE UNBOUNDED PRECEDING))
SELECT threshold, tp::BIGINT AS tp, kept, round(tp / (SELECT sum(label) FROM s), 6) AS recall, round(tp / kept, 6) AS precision FROM r WHERE tp / (SELECT sum(label) FROM s) >= 0.95 ORDER BY threshold DESC LIMIT 1""")
def operating_point(spark, sf):
    """WIN-8: the highest threshold with a recall of 0.95."""
    p = metrics.operating_point(_label_scores(spark, sf), 0.95)
    return p.select("threshold", "tp", "kept", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"))


@query("""WITH r AS (SELECT l_suppkey AS query_id, l_orderkey * 10 + l_linenumber AS id, l_quantity::INT % 3 AS relevance, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem),
i AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, id) AS n FROM r),
a AS (SELECT query_id, sum(CASE WHEN rank <= 10 THEN relevance / log2(rank + 1) ELSE 0 END) AS dcg, sum(CASE WHEN n <= 10 THEN relevance / log2(n + 1) ELSE 0 END) AS idcg, sum((relevance > 0 AND rank <= 10)::INT) AS h, sum((relevance > 0)::INT) AS rel, min(CASE WHEN relevance > 0 AND rank <= 10 THEN rank END) AS f FROM i GROUP BY query_id)
SELECT query_id, round(CASE WHEN idcg = 0 THEN 0 ELSE dcg / idcg END, 6) AS ndcg, round(CASE WHEN rel = 0 THEN 0 ELSE h / rel END, 6) AS recall, round(coalesce(1.0 / f, 0), 6) AS mrr FROM a""")
def ranking_scores(spark, sf):
    """NUM-9: nDCG, recall and MRR; suppliers stand for queries."""
    w = Window.partitionBy("query_id").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    l = table(spark, sf, "lineitem").withColumn("query_id", F.col("l_suppkey"))
    r = l.select("query_id", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_quantity").cast("int") % 3).alias("relevance"), F.row_number().over(w).alias("rank"))
    s = metrics.ranking_scores(r)
    return s.select("query_id", *[F.round(x, 6).alias(x) for x in ("ndcg", "recall", "mrr")])


@query("SELECT CASE WHEN quality = 1 AND toxic = 0 THEN 'verifiable' WHEN quality = 1 THEN 'flood_not_verifiable' ELSE 'not_flood' END AS stratum, count(*) AS n FROM labels GROUP BY ALL")
def strata(spark, sf):
    """FLT-17."""
    s = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "verifiable").when(F.col("quality") == 1, "flood_not_verifiable").otherwise("not_flood")
    return table(spark, sf, "labels").select(s.alias("stratum")).groupBy("stratum").agg(F.count("*").alias("n"))


@query("SELECT doc_id, quality, toxic FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5('13|' || doc_id), doc_id) AS n FROM labels) WHERE n <= 20")
def stratified_sample(spark, sf):
    """SRT-3, SRT-4: sampling is the feature."""
    return relational.stratified_sample(table(spark, sf, "labels"), "quality", "doc_id", 20)


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem GROUP BY ALL")
def lineitem_summary(spark, sf):
    """AGG-2: sums and means."""
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("""WITH y AS (SELECT year(o_orderdate) AS year, count(*) AS titles, sum((o_orderstatus <> 'P')::INT)::BIGINT AS kept, sum((o_orderstatus = 'F')::INT)::BIGINT AS verified FROM orders GROUP BY ALL) SELECT *, round(kept / titles, 6) AS keep_rate, round(verified / kept, 6) AS verify_rate FROM y""")
def yearly_funnel(spark, sf):
    """AGG-14, CMP-9: a funnel with retention a year."""
    y = table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("long").alias("year")).agg(F.count("*").alias("titles"), F.sum((F.col("o_orderstatus") != "P").cast("long")).alias("kept"), F.sum((F.col("o_orderstatus") == "F").cast("long")).alias("verified"))
    return y.withColumns({"keep_rate": F.round(F.col("kept") / F.col("titles"), 6), "verify_rate": F.round(F.when(F.col("kept") > 0, F.col("verified") / F.col("kept")), 6)})


@query("SELECT l_orderkey, count(*) - count(DISTINCT l_partkey) AS repeats FROM lineitem GROUP BY l_orderkey HAVING count(*) > count(DISTINCT l_partkey)")
def duplicate_keys(spark, sf):
    """AGG-29, SRC-15: rows that repeat a key."""
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg((F.count("*") - F.count_distinct("l_partkey")).alias("repeats")).where("repeats > 0")


@query("SELECT p_brand, count(*) AS n, round(avg((p_size > 25)::INT::DOUBLE), 6) AS fill, bool_or(p_size > 49) AS any_big, bool_and(p_size > 0) AS all_sized FROM part GROUP BY p_brand")
def fill_rates(spark, sf):
    """AGG-15, AGG-16, AGG-18, AGG-19: rates, any and all."""
    return table(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.round(F.avg((F.col("p_size") > 25).cast("double")), 6).alias("fill"), F.bool_or(F.col("p_size") > 49).alias("any_big"), F.bool_and(F.col("p_size") > 0).alias("all_sized"))


@query("SELECT c_mktsegment, string_agg(DISTINCT n_name, '; ' ORDER BY n_name) AS nations FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def ordered_union(spark, sf):
    """AGG-9, SET-1: distinct values joined in order."""
    j = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")), "c_nationkey")  # 25 rows
    return j.groupBy("c_mktsegment").agg(F.array_join(F.sort_array(F.collect_set("n_name")), "; ").alias("nations"))


@query("""WITH r AS (SELECT user_id::VARCHAR AS part, event_type AS article_id, value >= 50 AS ok, floor(epoch(ts)) AS t FROM events WHERE user_id % 10 > 0), i AS (SELECT part, article_id, max(ok::INT) AS ok FROM r GROUP BY ALL),
p AS (SELECT part, sum(ok) AS ok, count(*) - sum(ok) AS failed FROM i GROUP BY part), l AS (SELECT part, max(t) AS last FROM r GROUP BY part), n AS (SELECT max(floor(epoch(ts))) AS now FROM events), w AS (SELECT DISTINCT user_id::VARCHAR AS part, 3 + user_id % 4 AS total FROM events)
SELECT part, coalesce(ok, 0)::BIGINT AS ok, coalesce(failed, 0)::BIGINT AS failed, total, CASE WHEN coalesce(ok, 0) + coalesce(failed, 0) >= total THEN CASE WHEN coalesce(now - last < 7200, false) THEN 'retry' ELSE 'done' END WHEN coalesce(now - last < 7200, false) THEN 'running' WHEN coalesce(ok + failed, 0) > 0 THEN 'partial' ELSE 'queued' END AS state
FROM w LEFT JOIN p USING (part) LEFT JOIN l USING (part), n""")
def part_states(spark, sf):
    """STM-2, STM-5: what each partition of the work is doing; users stand for partitions."""
    e = table(spark, sf, "events")
    part = F.col("user_id").cast("string").alias("part")
    now = e.agg(F.max("ts")).first()[0]
    r = e.where("user_id % 10 > 0").select(part, F.col("event_type").alias("article_id"), (F.col("value") >= 50).alias("ok"), "ts")
    return live.part_states(r, e.select(part, (3 + F.col("user_id") % 4).alias("total")).distinct(), F.lit(now), fresh=7200)


@query("""SELECT count(*) + 1 AS block, round(sum(value) / sum(1 + user_id % 7), 6) AS chunks_per_s, round(5000 / (sum(value) / sum(1 + user_id % 7)), 6) AS estimated, round(greatest(0, 5000 / (sum(value) / sum(1 + user_id % 7)) - 60), 6) AS remaining FROM events""")
def block_eta(spark, sf):
    """STM-8: the pace of all finished blocks and what the one in flight still takes."""
    e = table(spark, sf, "events").select(F.col("value").alias("chunks"), (1 + F.col("user_id") % 7).alias("seconds"))
    b = live.block_eta(e, F.lit(5000.0), F.lit(60.0))
    return b.select("block", *[F.round(x, 6).alias(x) for x in ("chunks_per_s", "estimated", "remaining")])


@query("""WITH l AS (SELECT event_type AS t, user_id AS u, event_id AS i FROM events) SELECT CASE WHEN t = 'error' THEN 'other' WHEN u % 3 = 0 THEN 'done' WHEN u % 3 = 1 THEN 'plan' ELSE 'oom' END AS kind,
CASE WHEN t = 'error' THEN 'ERROR failed to read <path> line N' WHEN u % 3 = 2 THEN 'CUDA out of memory at N' END AS error, count(*) AS n, sum(CASE WHEN t <> 'error' AND u % 3 < 2 THEN i % 40 END)::DOUBLE AS chunks, sum(CASE WHEN t <> 'error' AND u % 3 = 0 THEN u + 0.5 END)::DOUBLE AS seconds FROM l GROUP BY ALL""")
def log_state(spark, sf):
    """STM-7, STR-23, STR-25: progress lines and error classes of a log."""
    u, i = F.col("user_id"), F.col("event_id")
    text = lambda *xs: F.concat(*[x.cast("string") if not isinstance(x, str) else F.lit(x) for x in xs])
    line = (
        F.when(F.col("event_type") == "error", text("ERROR failed to read /data/", u, "/", i, ".json line ", i)).when(u % 3 == 0, text("block ", u, " done: ", i % 40, " chunks in ", u, ".5 s"))
        .when(u % 3 == 1, text("block ", u, ": ", i % 40, " chunks planned")).otherwise(text("CUDA out of memory at ", i))
    )
    return live.log_state(table(spark, sf, "events").select(line.alias("line")))


@query("""WITH x AS (SELECT event_type AS part, 'user_id' AS list, user_id::VARCHAR AS value FROM events UNION ALL SELECT event_type, 'hour', hour(ts)::VARCHAR FROM events), c AS (SELECT part, list, value, count(*) AS n FROM x GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY part, list ORDER BY n DESC, value) AS k FROM c) SELECT part, list, value, n FROM r WHERE k <= 5""")
def top_lists(spark, sf):
    """STM-3: the most frequent values of each partition."""
    e = table(spark, sf, "events").select(F.col("event_type").alias("part"), "user_id", F.hour("ts").alias("hour"))
    return live.top_lists(e, "part", ["user_id", "hour"])
