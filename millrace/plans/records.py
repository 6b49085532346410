"""Queries of the record functions: values, slots, dates, validation, grounding, geocoding, order and batches.

The driver's tables have no extraction records, so these build their records from keys of orders and events
by plain arithmetic; every row of the table takes part.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import values as V
from millrace.operators import grounding, relational
from millrace.plans.base import query
from millrace.session import table

_TEXTS = ["at least 1,200", "two", "14", "+7", "true", "-3.5 mm", "about 2,000,000 people", "n/a"]
_CASE = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TEXTS))


def _pick(key: str, values: list[str]):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))


@query(f"""WITH t AS (SELECT o_orderkey, CASE o_orderkey % 8 {_CASE} END AS v FROM orders), n AS (SELECT *, replace(regexp_extract(v, '-?\\d[\\d,]*(?:\\.\\d+)?', 0), ',', '') AS d FROM t)
SELECT o_orderkey, CASE WHEN lower(v) IN ('true', 'false') THEN -1 ELSE coalesce(TRY_CAST(nullif(d, '') AS DOUBLE), -1) END AS number,
regexp_matches(replace(regexp_replace(v, '^\\+', ''), ',', ''), '^-?\\d+(\\.\\d+)?$') AS clean FROM n""")
def number_parsing(spark, sf):
    """NUM-1, NUM-2."""
    t = table(spark, sf, "orders").select("o_orderkey", _pick("o_orderkey", _TEXTS).alias("v"))
    return t.select("o_orderkey", V.to_number("v", -1.0).alias("number"), V.as_number("v")["clean"].alias("clean"))


_DATES = ["2021-05-07", "2021-05-00", "2021-02-30", "May 2021", "2021-12-31T10:00"]
_DCASE = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_DATES))


@query(f"""WITH t AS (SELECT CASE o_orderkey % 5 {_DCASE} END AS d FROM orders)
SELECT quality, count(*) AS n, count(parsed) AS parsed FROM (SELECT CASE WHEN NOT regexp_matches(d, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN 'not-iso' WHEN contains(d, '-00') THEN 'partial' WHEN TRY_CAST(d AS DATE) IS NULL THEN 'impossible' ELSE 'valid' END AS quality,
CASE WHEN regexp_matches(d, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(substr(d, 1, 10) AS DATE) END AS parsed FROM t) GROUP BY quality""")
def date_quality_counts(spark, sf):
    """AGG-13, DAT-1."""
    t = table(spark, sf, "orders").select(_pick("o_orderkey", _DATES).alias("d")).select(V.date_quality("d").alias("quality"), V.parse_iso("d").alias("p"))
    return t.groupBy("quality").agg(F.count("*").alias("n"), F.count("p").alias("parsed"))


@query("""SELECT o_orderkey, (o_orderkey % 7)::VARCHAR AS first_wins, (o_orderkey % 5)::VARCHAR AS canonical_wins, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS slots FROM orders""")
def slot_folding(spark, sf):
    """PRJ-3, PRJ-4, ARR-1: both rules for keys that mean one slot."""
    j = F.concat(F.lit('{"fatalities":"'), F.col("o_orderkey") % 7, F.lit('","deaths":"'), F.col("o_orderkey") % 5, F.lit('","death_toll":"9","river":" '), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise("Mula"), F.lit(' "}'))
    e = table(spark, sf, "orders").select("o_orderkey", F.from_json(j, "map<string,string>").alias("e"))
    names = {"fatalities": "deaths", "death_toll": "deaths"}
    a, b = V.fold_slots("e", names), V.fold_slots("e", names, True)
    return e.select("o_orderkey", F.element_at(a, "deaths").alias("first_wins"), F.element_at(b, "deaths").alias("canonical_wins"), F.size(a).alias("slots"))


@query("""WITH r AS (SELECT o_orderkey, range(o_orderkey % 3) AS e FROM orders), x AS (SELECT o_orderkey, unnest(e) AS i FROM r UNION ALL SELECT o_orderkey, NULL FROM r WHERE len(e) = 0)
SELECT o_orderkey, coalesce(i::VARCHAR, '') AS event_index, CASE WHEN i IS NULL THEN '' ELSE 'v' || i END AS value, CASE WHEN i IS NULL THEN '' WHEN i = 1 THEN 'true' ELSE 'false' END AS flag FROM x""")
def event_rows(spark, sf):
    """PRJ-5, PRJ-6: a row an event, one for an article without events."""
    e = F.when(F.col("o_orderkey") % 3 == 0, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(0).cast("long"), F.col("o_orderkey") % 3 - 1))
    r = table(spark, sf, "orders").select("o_orderkey", F.posexplode_outer(e).alias("event_index", "i"))
    return r.select("o_orderkey", V.cell(F.col("event_index"), "int").alias("event_index"), V.cell(F.concat(F.lit("v"), "i"), "string").alias("value"), V.cell(F.col("i") == 1, "boolean").alias("flag"))


@query("""SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 > 0 THEN NULL ELSE c_name END, c_mktsegment) AS shown, c_custkey % 4 > 0 AS informative FROM customer""")
def fallback_fields(spark, sf):
    """PRJ-1, PRJ-17, FLT-10: the first field that is not blank; placeholders."""
    first = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(" ")
    value = F.when(F.col("c_custkey") % 4 == 0, " Unknown ").otherwise("12")
    return table(spark, sf, "customer").select("c_custkey", V.fill(first, "c_mktsegment").alias("shown"), V.informative(value).alias("informative"))


@query("""SELECT o_orderkey, list_filter(['Ab', 'ab', 'c' || (o_orderkey % 2), 'c1'], lambda x, i: i <> 2 AND NOT (i = 4 AND o_orderkey % 2 = 1)) AS kept, ['x', 'y z'] AS parts FROM orders""")
def ordered_distinct(spark, sf):
    """ARR-2, ARR-3."""
    x = F.array(F.lit("Ab"), F.lit("ab"), F.concat(F.lit("c"), F.col("o_orderkey") % 2), F.lit("c1"))
    return table(spark, sf, "orders").select("o_orderkey", V.distinct_by(x, F.lower).alias("kept"), V.split_semi(F.lit(" x; ;y z ")).alias("parts"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || '|' || strftime(o_orderdate, '%-d %B %Y') || '|' || strftime(o_orderdate, '%B %-d, %Y') || '|' || strftime(o_orderdate, '%d/%m/%Y') AS forms,
list_contains(['2021', '2022'], year(o_orderdate)::VARCHAR) AS in_years, date_diff('day', o_orderdate::DATE, (o_orderdate + INTERVAL 5 day)::DATE) <= 7 AS within_week FROM orders""")
def date_forms(spark, sf):
    """DAT-2, DAT-5, FLT-8."""
    d = F.to_date("o_orderdate")
    f = V.date_surface_forms(d)
    some = F.concat_ws("|", *[F.element_at(f, i) for i in (1, 2, 3)], F.date_format(d, "dd/MM/yyyy"))
    return table(spark, sf, "orders").select("o_orderkey", some.alias("forms"), F.year(d).isin(2021, 2022).alias("in_years"), (F.datediff(F.date_add(d, 5), d) <= 7).alias("within_week"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '2021_0' || (o_orderkey % 9 + 1) ELSE 'stem' END AS month, CASE WHEN o_totalprice < 1000 THEN (o_totalprice::BIGINT)::VARCHAR WHEN o_totalprice < 1000000 THEN printf('%.1fk', o_totalprice / 1000) ELSE printf('%.1fM', o_totalprice / 1000000) END AS human,
'failed <path> at N' AS error_class FROM (SELECT o_orderkey, floor(o_totalprice / 100) * 100 AS o_totalprice FROM orders)""")
def label_functions(spark, sf):
    """DAT-6, NUM-5, STR-23."""
    o = table(spark, sf, "orders")
    i = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("2021_0"), F.col("o_orderkey") % 9 + 1, F.lit("/x"))).otherwise(F.col("o_orderkey").cast("string"))
    msg = F.concat(F.lit("failed /data/in/a.json at "), F.col("o_orderkey"))
    return o.select("o_orderkey", V.month_label(i, F.lit("stem")).alias("month"), V.human_count(F.floor(F.col("o_totalprice") / 100) * 100).alias("human"), V.error_class(msg).alias("error_class"))


@query("""WITH e AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 50 > 0 THEN l_partkey::VARCHAR ELSE '' END AS event_id, (l_partkey % 4)::BIGINT AS uids, (l_quantity::BIGINT % 4)::BIGINT AS n_articles, l_shipdate::DATE AS d1, (l_shipdate + INTERVAL 2 day)::DATE - l_linenumber::INT AS d2,
l_quantity::BIGINT AS lo, floor(l_extendedprice / 1000)::BIGINT AS hi, l_suppkey - 3 AS deaths, l_discount * 20 AS conf FROM lineitem)
SELECT l_orderkey, l_linenumber, list_filter([CASE WHEN event_id = '' THEN 'missing event_id' END, CASE WHEN uids = 0 THEN 'no source_uids: an event with no article is not evidence of anything' END,
CASE WHEN n_articles <> uids THEN 'n_articles=' || n_articles || ' but ' || uids || ' source_uids' END, CASE WHEN d1 > d2 THEN 'date_start after date_end' END, CASE WHEN lo > hi THEN 'counts: min ' || lo || ' > max ' || hi END,
CASE WHEN deaths < 0 THEN 'deaths is negative' END, CASE WHEN deaths - 50 < 0 THEN 'affected_population is negative' END, CASE WHEN conf > 1 THEN 'flood_type_confidence outside [0, 1]' END], lambda x: x IS NOT NULL) AS problems FROM e""")
def event_validation(spark, sf):
    """FLT-14: the structural problems of event rows, in words."""
    k = F.col("l_partkey")
    e = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(k % 50 > 0, k.cast("string")).otherwise("").alias("event_id"), F.slice(F.array(*[F.lit(x) for x in "abc"]), 1, (k % 4).cast("int")).alias("source_uids"),
        (F.col("l_quantity").cast("long") % 4).alias("n_articles"), F.to_date("l_shipdate").alias("date_start"), F.date_add(F.to_date("l_shipdate"), 2 - F.col("l_linenumber")).alias("date_end"),
        F.struct(F.col("l_quantity").cast("long").alias("min"), F.floor(F.col("l_extendedprice") / 1000).alias("max")).alias("counts"), (F.col("l_suppkey") - 3).alias("deaths"),
        (F.col("l_suppkey") - 53).alias("affected_population"), (F.col("l_discount") * 20).alias("flood_type_confidence"),
    )
    return e.select("l_orderkey", "l_linenumber", V.event_problems().alias("problems"))


@query(r"""WITH a AS (SELECT doc_id, text, lang, CASE lang WHEN 'en' THEN 'the' WHEN 'de' THEN 'und' ELSE 'que' END AS value FROM documents)
SELECT lang AS field, count(*) AS n, round(avg(regexp_matches(lower(text), '(^|[^\p{L}\p{Nd}])' || value || '([^\p{L}\p{Nd}]|$)')::INT::DOUBLE), 6) AS support FROM a GROUP BY lang""")
def grounding_rates(spark, sf):
    """CMP-3, AGG-18: whether texts hold a value as a whole word; languages stand for fields."""
    value = F.when(F.col("lang") == "en", "the").when(F.col("lang") == "de", "und").otherwise("que")
    a = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("uid"), F.col("lang").alias("field"), F.lit("quote").alias("kind"), value.alias("value"), "text")
    return grounding.support_rates(grounding.ground(a)).select("field", "n", F.round("support", 6).alias("support"))


@query("""SELECT n_name AS mention, CASE WHEN n_nationkey % 5 = 0 THEN 'ambiguous' ELSE 'resolved' END AS status, CASE WHEN n_nationkey % 5 > 0 THEN n_nationkey END AS place_id, CASE WHEN n_nationkey % 5 = 0 THEN 2 ELSE 1 END AS candidates FROM nation""")
def geocode_nations(spark, sf):
    """CMP-4, JN-9: nations as a gazetteer in which every fifth has a rival of its name."""
    n = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("place_id"), F.col("n_name").alias("name"), F.array().cast("array<string>").alias("alternates"), F.lit("XX").alias("country"), F.lit(1000).alias("population"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), F.lit("point").alias("feature"))
    twin = n.where("place_id % 5 = 0").withColumns({"place_id": F.col("place_id") + 1000, "population": F.lit(900)})
    m = n.select(F.col("name").alias("mention"), F.lit(None).cast("string").alias("country"))
    return grounding.geocode(m, n.union(twin)).select("mention", "status", "place_id", F.col("candidates").cast("long").alias("candidates"))


@query("SELECT doc_id, row_number() OVER (ORDER BY coalesce(nullif(lang, 'es'), 'zzz~unknown'), doc_id) AS rank FROM documents")
def work_order(spark, sf):
    """SRT-1: the order by language and id, unknown languages last, without one task for all rows."""
    d = table(spark, sf, "documents").select("doc_id", F.coalesce(F.nullif("lang", F.lit("es")), F.lit("zzz~unknown")).alias("k"))
    return relational.ranked(d, "k", "doc_id").select("doc_id", "rank")


@query("WITH a AS (SELECT l_orderkey, count(l_quantity) AS r, count(DISTINCT l_quantity) > 1 AS c FROM lineitem GROUP BY ALL) SELECT count(*) AS events, round(avg(c::INT::DOUBLE), 6) AS conflict_rate FROM a WHERE r >= 2")
def conflict_rate(spark, sf):
    """AGG-23."""
    m = relational.merge_counts(table(spark, sf, "lineitem"), ["l_orderkey"], "l_quantity").where("reports >= 2")
    return m.agg(F.count("*").alias("events"), F.round(F.avg(F.col("conflict").cast("double")), 6).alias("conflict_rate"))


@query()
def translation_batches(spark, sf):
    """SRT-2: texts of each language, sorted by length and packed under a budget; each language in blocks by id."""
    d = table(spark, sf, "documents").select("lang", "doc_id", F.floor(F.col("doc_id") / 4096).alias("block"), F.ceil(F.char_length("text") / 4).cast("int").alias("tokens"))

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        bins = relational.bins_by_budget(pdf["tokens"].tolist(), 16_384, 64)
        return pd.DataFrame([(key[0], int(key[1]), b, len(ids), int(pdf["tokens"].iloc[ids].max()), int(pdf["tokens"].iloc[ids].sum())) for b, ids in enumerate(bins)], columns=["lang", "block", "batch", "texts", "longest", "tokens"])

    return d.groupBy("lang", "block").applyInPandas(run, "lang string, block long, batch int, texts int, longest int, tokens long")


