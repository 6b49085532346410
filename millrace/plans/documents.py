"""Queries over documents, benchmark, pages and conversations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions import values as V
from millrace.operators import rules, search, vector
from millrace.operators.graph import connected_components
from millrace.operators.relational import exact_duplicates, first_by, may_be, top_counts, validation_reason
from millrace.plans.base import query
from millrace.session import cut, drop, table

#: Copies whose ids are broadcast at most; 2 ** SLOT_BITS times 64 bits of the filter for sets that candidates need.
BROADCAST_COPIES, SLOT_BITS = 500_000, 20

_NORM = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"
_WORDS = rf"(CASE WHEN {_NORM} = '' THEN 0 ELSE len(string_split({_NORM}, ' ')) END)"
_TITLE = r"split_part(text, chr(10), 1)"
_REASON = rf"CASE WHEN {_NORM} = '' THEN 'empty_translated_text' WHEN {_WORDS} < 100 THEN 'fewer_than_min_words' END"


def _cleaned(spark, sf):
    d = table(spark, sf, "documents")
    norm = F.lower(T.collapse("text"))
    words = F.when(norm == "", 0).otherwise(F.size(F.split(norm, " "))).cast("long")
    title = F.split("text", "\n")[0]
    reason = validation_reason(title, F.col("text"), F.lit("-"), norm, words)  # titles are not judged here
    return d.withColumns({"norm": norm, "words": words, "reason": reason})


@query(rf"""WITH d AS (SELECT *, {_NORM} AS norm, {_REASON} AS reason FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY sha256(norm) ORDER BY doc_id) AS n FROM d WHERE reason IS NULL)
SELECT lang, count(*) AS valid, sum((n > 1)::INT)::BIGINT AS duplicates, sum((n = 1)::INT)::BIGINT AS written FROM k GROUP BY lang""")
def doc_clean_dedup(spark, sf):
    """STR-1, STR-6, FLT-4, AGG-4: valid documents, duplicates and what is written, by language."""
    kept = exact_duplicates(_cleaned(spark, sf).where("reason IS NULL").select("doc_id", "lang", "norm"), "norm", "doc_id")
    dup = F.sum(F.col("is_duplicate").cast("long"))
    return kept.groupBy("lang").agg(F.count("*").alias("valid"), dup.alias("duplicates"), (F.count("*") - dup).alias("written"))


@query(rf"""WITH d AS (SELECT *, coalesce({_REASON}, 'kept') AS reason, {_WORDS}::BIGINT AS words FROM documents)
SELECT reason, count(*) AS n, sum(words)::BIGINT AS words, floor(sum(words) / count(*))::BIGINT AS mean_words, sum(strlen(text))::BIGINT AS bytes,
array_to_string(list_slice(list(doc_id ORDER BY doc_id), 1, 10), ',') AS examples FROM d GROUP BY reason""")
def doc_reason_report(spark, sf):
    """AGG-2, AGG-5, WIN-5: totals and at most ten examples by reason."""
    d = _cleaned(spark, sf).withColumn("reason", F.coalesce("reason", F.lit("kept"))).select("doc_id", "reason", "words", F.octet_length("text").cast("long").alias("bytes"))
    totals = d.groupBy("reason").agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.floor(F.sum("words") / F.count("*")).alias("mean_words"), F.sum("bytes").alias("bytes"))
    ten = first_by(d.select("reason", "doc_id"), ["reason"], "doc_id", n=10).groupBy("reason").agg(F.array_join(F.sort_array(F.collect_list("doc_id")).cast("array<string>"), ",").alias("examples"))
    return totals.join(ten, "reason")


@query(rf"SELECT doc_id, sha256({_NORM}) AS digest, first_value(doc_id) OVER w AS original, count(*) OVER (PARTITION BY sha256({_NORM})) AS copies FROM documents WINDOW w AS (PARTITION BY sha256({_NORM}) ORDER BY doc_id)")
def doc_exact_duplicates(spark, sf):
    """AGG-4, WIN-1: digest, original and copies of each document."""
    return exact_duplicates(_cleaned(spark, sf).select("doc_id", "norm"), "norm", "doc_id").select("doc_id", "digest", "original", "copies")


@query(r"SELECT lang, source, count(*) AS n, grouping(lang) AS no_lang, grouping(source) AS no_source FROM documents GROUP BY ROLLUP (lang, source)")
def doc_language_rollup(spark, sf):
    """AGG-17, AGG-25: languages by source with totals."""
    return table(spark, sf, "documents").rollup("lang", "source").agg(F.count("*").alias("n"), F.grouping("lang").cast("long").alias("no_lang"), F.grouping("source").cast("long").alias("no_source"))


@query(r"""SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN w <= 1 THEN '1' WHEN w <= 5 THEN '2-5' WHEN w <= 15 THEN '6-15' WHEN w <= 40 THEN '16-40' ELSE '40+' END AS bucket
FROM (SELECT len(string_split(trim(regexp_replace(split_part(text, chr(10), 1), '\s+', ' ', 'g')), ' ')) AS w FROM documents)) GROUP BY bucket""")
def doc_title_histogram(spark, sf):
    """AGG-3: words of the first line, in buckets."""
    w = F.size(F.split(T.collapse(F.split("text", "\n")[0]), " "))
    return table(spark, sf, "documents").select(V.bucket(w, [1, 5, 15, 40], ["1", "2-5", "6-15", "16-40", "40+"]).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


@query(r"SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 10")
def doc_top_sources(spark, sf):
    """AGG-1: a top ten."""
    return top_counts(table(spark, sf, "documents"), "source", 10)


@query(r"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS token FROM documents)
SELECT token, count(*) AS n, count(DISTINCT doc_id) AS docs FROM t GROUP BY token""")
def doc_token_counts(spark, sf):
    """STR-7: how often each token occurs, and in how many documents."""
    t = table(spark, sf, "documents").select("doc_id", F.explode(T.tokenize("text")).alias("token")).groupBy("token", "doc_id").agg(F.count("*").alias("n"))
    return t.groupBy("token").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))


_SH = r"""t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) >= 50)),
k AS (SELECT doc_id, count(*) AS n, min(sha256(s)) AS low FROM s GROUP BY doc_id)"""


def _shingle_sets(spark, sf):
    t = table(spark, sf, "documents").select("doc_id", T.tokenize("text").alias("w")).where("size(w) >= 50")
    return t.select("doc_id", T.shingles("w", 5).alias("s"))


def _similar_pairs(spark, sf):
    """JN-7, CMP-2: pairs with Jaccard >= 0.8 of five-word shingles, by prefix filtering; equal sets are one class.

    Of a class of equal sets the smallest id stands for it: pairs are those of representatives, and each other
    member has one pair with its representative, so m copies give m - 1 pairs. A pair of classes must share one of
    the first n - ceil(0.8 n) + 1 shingles of either side in any order that is the same for all, so only those are
    joined; where the prefixes first meet bounds what can still be shared, and candidates are verified on hashed full
    sets. In this order shingles with a negative hash come first, by rarity, then the others by their hash: only the
    first half is counted and shuffled, and fills all prefixes but those of very small sets.
    """
    own = _shingle_sets(spark, sf).select("doc_id", F.array_sort(F.transform("s", lambda x: F.xxhash64(x))).alias("s"))
    size = {"n": F.size("s"), "low": F.size(F.filter("s", lambda x: x < 0)), "g": F.md5(F.array_join(F.transform("s", lambda x: x.cast("string")), " "))}
    own = cut(own.withColumns(size), "sets")
    reps = own.groupBy("g").agg(F.min("doc_id").alias("rep"))
    member = cut(own.select("doc_id", "g").join(reps, "g").where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"), F.lit(1.0).alias("jaccard")), "members")
    copies = member.select(F.col("b").alias("doc_id"))
    if copies.count() <= BROADCAST_COPIES:
        sets = own.drop("g").join(F.broadcast(copies), "doc_id", "left_anti")
    else:
        sets = cut(own.drop("g").join(copies, "doc_id", "left_anti"), "classes")
    each = sets.select("doc_id", F.explode(F.slice("s", F.lit(1), F.col("low"))).alias("x"))
    ranked = each.withColumn("f", F.count("*").over(Window.partitionBy("x"))).where("f > 1")  # a shingle of one document joins nothing
    order = F.sort_array(F.collect_list(F.struct("f", "x")))
    # single shingles come first in the order by rarity, so what is left of the prefix is known from their number
    pre = ranked.groupBy("doc_id").agg(order.alias("o")).join(sets.select("doc_id", "n", "low"), "doc_id")
    alone, prefix = F.col("low") - F.size("o"), F.col("n") - F.ceil(F.lit(0.8) * F.col("n")).cast("int") + 1
    keep = prefix - alone
    pre = pre.where(keep > 0).select("doc_id", "n", alone.alias("alone"), F.posexplode(F.slice("o", F.lit(1), keep)).alias("i", "p"))
    pre = pre.select("doc_id", "n", (F.col("n") - F.col("alone") - F.col("i")).alias("rest"), "p.x")  # shingles from this one on
    more = sets.where(prefix > F.col("low")).select("doc_id", "n", "low", F.posexplode(F.slice("s", F.col("low") + 1, prefix - F.col("low"))).alias("i", "x"))
    pre = cut(pre.union(more.select("doc_id", "n", F.col("n") - F.col("low") - F.col("i"), "x")), "prefixes")
    a, b = (pre.select(F.col("doc_id").alias(s), F.col("n").alias(f"n{s}"), F.col("rest").alias(f"r{s}"), "x") for s in "ab")
    size = "a < b AND least(na, nb) >= 0.8 * greatest(na, nb)"
    first = a.join(b, "x").where(size).groupBy("a", "b", "na", "nb").agg(F.max(F.least("ra", "rb")).alias("most"))  # at the first shingle that both prefixes hold
    pairs = cut(first.where("most >= 0.8 * (na + nb - most) - 1e-9").select("a", "b"), "candidates")
    # sets of other documents are not shuffled
    key = F.xxhash64("doc_id")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).select(key.alias("h"))
    wanted = may_be(sets.select("doc_id", "s", key.alias("h")), ends, "h", SLOT_BITS)
    for s in "ab":
        pairs = pairs.join(wanted.select(F.col("doc_id").alias(s), F.col("s").alias(f"s{s}")), s)
    out = cut(pairs.select("a", "b", T.jaccard("sa", "sb").alias("jaccard")).where("jaccard >= 0.8").union(member), "pairs")
    drop(own, sets, member, pre)
    return out


@query(rf"""WITH {_SH}, g AS (SELECT doc_id, md5(string_agg(s, '|' ORDER BY s)) AS g FROM s GROUP BY doc_id), c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY g) AS rep FROM g), r AS (SELECT s.doc_id, s FROM s JOIN c ON c.doc_id = s.doc_id AND c.rep = s.doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM r x JOIN r y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL)
SELECT a, b, round(shared / (ka.n + kb.n - shared), 6) AS jaccard FROM p JOIN k ka ON ka.doc_id = a JOIN k kb ON kb.doc_id = b WHERE shared / (ka.n + kb.n - shared) >= 0.8 UNION ALL SELECT rep, doc_id, 1.0 FROM c WHERE rep <> doc_id""")
def doc_shingle_pairs(spark, sf):
    """STR-8, SET-5, JN-7: pairs of class representatives, and each other member with its own."""
    return _similar_pairs(spark, sf).select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query(rf"""WITH RECURSIVE {_SH}, p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN k ka ON ka.doc_id = a JOIN k kb ON kb.doc_id = b WHERE shared / (ka.n + kb.n - shared) >= 0.8), u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a AS node, a AS root FROM u UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.node),
g AS (SELECT node, min(root) AS component FROM r GROUP BY node)
SELECT component, count(*) AS size, arg_max(node, n_chars * 1000000 - node) AS kept, count(*) - 1 AS dropped FROM g JOIN documents d ON d.doc_id = g.node GROUP BY component""")
def doc_components_keep_longest(spark, sf):
    """CMP-2, AGG-24: groups of near-duplicates; the longest stays, the first of equals."""
    g = connected_components(_similar_pairs(spark, sf)).join(table(spark, sf, "documents").select(F.col("doc_id").alias("node"), "n_chars"), "node")
    best = F.max(F.struct("n_chars", (-F.col("node")).alias("minus")))
    return g.groupBy("component").agg(F.count("*").alias("size"), (-best["minus"]).alias("kept"), (F.count("*") - 1).alias("dropped"))


def _bm25_sql(k):
    return rf"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS t FROM documents), st AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM benchmark),
tf AS (SELECT term, doc_id, dl, count(*) AS tf FROM (SELECT doc_id, len(t)::DOUBLE AS dl, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, ln((st.n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, st GROUP BY term, st.n), i AS (SELECT term, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM f) ELSE idf END AS idf FROM f),
s AS (SELECT item_id, doc_id, round(sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 9) AS score FROM tf JOIN i USING (term) JOIN q USING (term), st GROUP BY item_id, doc_id),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id AS query_id, doc_id AS id, round(score, 6) AS score, rank FROM r WHERE rank <= {k}"""


def _bm25(spark, sf, k):
    """Every benchmark item searches all documents."""
    q = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return search.bm25(table(spark, sf, "documents"), q, k, "doc_id", "text")


@query(_bm25_sql(20))
def bm25_topk(spark, sf):
    """NUM-6, SRT-5."""
    return _bm25(spark, sf, 20).select("query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


_RRF = f"""WITH b AS ({_bm25_sql(20)}), o AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY d.n_chars DESC, id) AS rank FROM b JOIN documents d ON d.doc_id = b.id),
f AS (SELECT query_id, id, sum(1.0 / (60 + rank)) AS s FROM (SELECT query_id, id, rank FROM b UNION ALL SELECT query_id, id, rank FROM o) GROUP BY ALL)"""


def _fused(spark, sf):
    b = cut(_bm25(spark, sf, 20), "bm25")
    w = Window.partitionBy("query_id").orderBy(F.desc("n_chars"), "id")
    o = b.join(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "n_chars"), "id").withColumn("rank", F.row_number().over(w))
    return search.fuse([b, o])


@query(f"{_RRF} SELECT query_id, id, round(s, 9) AS rrf_score, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, id) AS rank FROM f")
def rrf_fusion(spark, sf):
    """NUM-7, JN-11, WIN-3, SET-1: two runs (by BM25, by length) as one."""
    return _fused(spark, sf).select("query_id", "id", F.round("rrf_score", 9).alias("rrf_score"), F.col("rank").cast("long").alias("rank"))


@query(f"""{_RRF}, r AS (SELECT query_id, id, s, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, id) AS rank FROM f)
SELECT query_id, coalesce(d.source, 'doc-' || id) AS event_id, round(max(s) * (1 + 0.05 * ln(1 + count(*))), 9) AS event_score, count(*) AS hits, min(rank) AS best_rank
FROM r LEFT JOIN documents d ON d.doc_id = r.id AND d.lang = 'en' GROUP BY ALL""")
def event_fold(spark, sf):
    """NUM-8, JN-10, CMP-5: hits as events; sources stand for events, in other languages each hit is its own."""
    ev = table(spark, sf, "documents").where("lang = 'en'").select(F.col("doc_id").alias("id"), F.col("source").alias("event_id"))
    return search.fold_events(_fused(spark, sf), ev).select("query_id", "event_id", F.round("event_score", 9).alias("event_score"), "hits", F.col("best_rank").cast("long").alias("best_rank"))


LEXICON = {"alpha": {"the": 1.0, "tion": 1.5, "there": 2.0}, "beta": {"der": 1.0, "und": 1.5}, "gamma": {"que": 1.5, "les": 1.0, "des": 1.0}}
_score = {k: " + ".join(f"(CASE WHEN regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_])(?:{c})([^\\p{{L}}\\p{{N}}_]|$)') THEN {w} ELSE 0.0 END)" for c, w in v.items()) for k, v in LEXICON.items()}


@query(rf"""WITH s AS (SELECT doc_id, {", ".join(f"({x}) AS {k}" for k, x in _score.items())} FROM documents),
r AS (SELECT doc_id, list_reverse_sort([{", ".join(f"{{'s': {k}, 'o': {-i}, 'l': '{k}'}}" for i, k in enumerate(LEXICON))}]) AS r FROM s)
SELECT doc_id, CASE WHEN r[1].s >= 2 AND r[1].s - r[2].s >= 1 THEN r[1].l END AS label, round(r[1].s::DOUBLE, 6) AS score,
round(CASE WHEN r[1].s >= 2 AND r[1].s - r[2].s >= 1 THEN (r[1].s - r[2].s) / (r[1].s + r[2].s) ELSE 0 END::DOUBLE, 6) AS confidence FROM r""")
def type_classifier(spark, sf):
    """STR-16 with a test lexicon."""
    d = table(spark, sf, "documents").select("doc_id", rules.classify("text", LEXICON).alias("k"))
    return d.select("doc_id", "k.label", F.round("k.score", 6).alias("score"), F.round("k.confidence", 6).alias("confidence"))


@query(r"SELECT doc_id, NOT regexp_matches(split_part(text, chr(10), 1) || chr(10) || text, '(?i)(^|[^\p{L}\p{N}_])(?:the|und)([^\p{L}\p{N}_]|$)') AS prefiltered FROM documents")
def doc_prefilter(spark, sf):
    """FLT-3: documents that the pattern spares the expensive step."""
    d = table(spark, sf, "documents").withColumn("title", F.split("text", "\n")[0])
    return rules.prefilter(d, r"\b(?:the|und)\b").select("doc_id", "prefiltered")


@query(r"""SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS body, count(*) AS chunks, max(turn) - min(turn) + 1 = count(*) AS complete FROM conversations GROUP BY conv_id""")
def conversation_reassemble(spark, sf):
    """PRJ-15: chunks put together in order."""
    g = table(spark, sf, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("x"), F.count("*").alias("chunks"), (F.max("turn") - F.min("turn") + 1 == F.count("*")).alias("complete"))
    return g.select("conv_id", F.array_join(F.transform("x", lambda t: t["text"]), " ").alias("body"), "chunks", "complete")


@query(r"SELECT role, floor(length(text) / 200) * 200 AS size_band, count(*) AS n FROM conversations GROUP BY ALL")
def conversation_size_bands(spark, sf):
    """AGG-3: sizes in bands."""
    return table(spark, sf, "conversations").groupBy("role", (F.floor(F.char_length("text") / 200) * 200).cast("double").alias("size_band")).agg(F.count("*").alias("n"))


@query()
def doc_full_clean(spark, sf):
    """STR-4, STR-5: the whole cleaner; its rules need lookbehind, which RE2 lacks."""
    return table(spark, sf, "documents").select("doc_id", F.sha2(T.clean_text("text"), 256).alias("digest"), T.clean_title(F.split("text", "\n")[0]).alias("title"))


@query()
def page_strip_html(spark, sf):
    """STR-24: entities, tags, scripts and styles."""
    return table(spark, sf, "pages").select("page_id", T.strip_markup("html").alias("text"))


@query()
def passage_index(spark, sf):
    """STR-11, CMP-5b: passages of each document with their offsets."""
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(T.chunk_text("text")).alias("i", "p"))
    return d.select(F.concat_ws("#", F.col("doc_id").cast("string"), F.col("i").cast("string")).alias("passage_id"), "doc_id", "p.start", "p.end", "p.text")


@query()
def doc_script_and_language(spark, sf):
    """STR-13, STR-14, STR-15."""
    d = table(spark, sf, "documents")
    return d.select("doc_id", T.detect_script("text").alias("script"), T.to_flores("lang").alias("flores"), T.detect_language("text").alias("guess"))


@query()
def lexicon_match(spark, sf):
    """FLT-1 over the first lines of all documents."""
    d = table(spark, sf, "documents").select("doc_id", rules.match_title(F.split("text", "\n")[0], rules.TitleRules.load()).alias("m"))
    return d.select("doc_id", "m.matched", "m.reason")


@query()
def doc_entities(spark, sf):
    """STR-17, STR-18: rule entities with offsets."""
    d = table(spark, sf, "documents").select("doc_id", F.explode(rules.entities("text", {"HAZARD": ["flood", "storm", "landslide"]})).alias("e"))
    return d.select("doc_id", "e.text", "e.label", "e.start", "e.end")


_DENSE = """v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), q AS (SELECT item_id, (SELECT e FROM v WHERE vec_id = item_id) AS e FROM benchmark),
dense AS (SELECT item_id AS query_id, vec_id AS id, row_number() OVER (PARTITION BY item_id ORDER BY list_dot_product(q.e, v.e) DESC, vec_id) AS rank FROM q, v WHERE q.e IS NOT NULL AND vec_id <> item_id QUALIFY rank <= 20)"""


@query(f"""WITH {_DENSE}, b AS ({_bm25_sql(20)}), f AS (SELECT query_id, id, sum(1.0 / (60 + rank)) AS s FROM (SELECT query_id, id, rank FROM b UNION ALL SELECT query_id, id, rank FROM dense) GROUP BY ALL)
SELECT query_id, id, round(s, 9) AS rrf_score, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, id) AS rank FROM f""")
def hybrid_search(spark, sf):
    """CMP-5: a lexical and a dense run as one; the vector with an item's number stands for its embedding."""
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    asks = v.join(table(spark, sf, "benchmark").select(F.col("item_id").alias("id")), "id", "left_semi")
    dense = vector.knn(v, 20, asks).select(F.col("a").alias("query_id"), F.col("b").alias("id"), "rank")
    fused = search.fuse([_bm25(spark, sf, 20), dense])
    return fused.select("query_id", "id", F.round("rrf_score", 9).alias("rrf_score"), F.col("rank").cast("long").alias("rank"))


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), n AS (SELECT x.vec_id AS a, y.vec_id AS b, list_dot_product(x.e, y.e) AS sim, row_number() OVER (PARTITION BY x.vec_id ORDER BY list_dot_product(x.e, y.e) DESC, y.vec_id) AS rank FROM v x, v y WHERE x.vec_id <> y.vec_id),
p AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b, sim FROM n WHERE rank <= 20 AND round(sim, 9) >= 0.35), t AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s FROM t WHERE len(w) > 0)
SELECT p.a, p.b, count(*) AS n, bool_and(len(list_intersect(x.s, y.s)) / len(list_distinct(list_concat(x.s, y.s))) < 0.5) AS unlike FROM p JOIN s x ON x.doc_id = p.a JOIN s y ON y.doc_id = p.b
WHERE len(list_intersect(x.s, y.s)) / len(list_distinct(list_concat(x.s, y.s))) < 0.5 GROUP BY ALL""")
def semantic_duplicates(spark, sf):
    """CMP-2: pairs whose vectors agree while their words do not; a vector stands for the document of its number, the cosine is lowered to what these data hold."""
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    d, key = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"), F.xxhash64(F.col("id").cast("long")).alias("key")
    d = may_be(d.select("*", key), v.select(key), "key", SLOT_BITS)  # texts without a vector are not taken apart
    d = d.select("id", T.tokenize("text").alias("w")).where("size(w) > 0").select("id", T.shingles("w", 5).alias("shingles"))
    p = vector.semantic_duplicates(v, d, least=0.35)
    return p.select("a", "b", F.lit(1).cast("long").alias("n"), (F.col("jaccard") < 0.5).alias("unlike"))
