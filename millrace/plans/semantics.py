"""Queries of the semantic layer: place and river names, pair signals, severity, texts of mentions, filters and projections.

The driver's tables have no extraction records; these are built from the columns of orders, items and parts by
plain arithmetic, so that values vary from row to row, and every row of a table takes part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import places as P
from millrace.functions import values as V
from millrace.operators import filters, grounding, mentions, projections, relational, vector
from millrace.plans.base import query
from millrace.session import table

# SQL of the functions


def norm(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g'))"


_STOP = ", ".join(f"'{w}'" for w in P.PLACE_WORDS)
_RIVER = ", ".join(f"'{w}'" for w in (*P.WATERCOURSES, *P.RIVER_ARTICLES))


def _tokens(x: str) -> str:
    return f"list_distinct(list_filter(string_split({norm(x)}, ' '), lambda w: length(w) > 1 AND NOT list_contains([{_STOP}], w)))"


def _jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0 ELSE len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) END"


def _places(a: str, b: str) -> str:
    pairs = f"flatten(list_transform(list_transform({a}, lambda p: {_tokens('p')}), lambda x: list_transform(list_transform({b}, lambda p: {_tokens('p')}), lambda y: {_jaccard('x', 'y')})))"
    shared = f"len(list_intersect(list_transform({a}, lambda p: {norm('p')}), list_transform({b}, lambda p: {norm('p')}))) > 0"
    return f"CASE WHEN {shared} THEN 1.0 WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE coalesce(list_max({pairs}), 0) END"


def _river(x: str) -> str:
    return f"array_to_string(list_filter(string_split({norm(x)}, ' '), lambda w: NOT list_contains([{_RIVER}], w)), ' ')"


def _rivers(a: str, b: str) -> str:
    keys = [f"list_filter(list_transform({x}, lambda p: {_river('p')}), lambda k: k <> '')" for x in (a, b)]
    return f"CASE WHEN len(list_intersect({keys[0]}, {keys[1]})) > 0 THEN 1.0 ELSE 0.0 END"


# two names of places and rivers for each item: of its part and of the part with its supplier's number
_PAIRS = """p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount, l_quantity, l_shipdate::DATE AS d1, (l_shipdate + to_days((l_quantity::BIGINT % 12 - 4)::INT))::DATE AS d2,
CASE WHEN l_linenumber = 1 THEN [] ELSE [a.p_name || ' District', a.p_brand] END AS xs, [CASE WHEN l_quantity < 10 THEN 'The ' || a.p_name || ' (district)' ELSE 'the ' || b.p_name || ' valley' END, b.p_type] AS ys,
[a.p_name || ' River', 'River'] AS r1, CASE WHEN l_linenumber = 2 THEN [] ELSE ['the River ' || CASE WHEN l_quantity > 25 THEN a.p_name ELSE b.p_name END, ''] END AS r2, a.p_type AS t1, b.p_type AS t2
FROM lineitem JOIN part a ON l_partkey = a.p_partkey JOIN part b ON l_suppkey = b.p_partkey)"""


def _pairs(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    a, b = (part.toDF(*[f"{c}_{s}" for c in part.columns]) for s in "ab")
    l = table(spark, sf, "lineitem").join(a, F.col("l_partkey") == F.col("p_partkey_a")).join(b, F.col("l_suppkey") == F.col("p_partkey_b"))
    none = F.array().cast("array<string>")
    d1 = F.to_date("l_shipdate")
    q = F.col("l_quantity")
    one = F.when(q < 10, F.concat(F.lit("The "), "p_name_a", F.lit(" (district)"))).otherwise(F.concat(F.lit("the "), "p_name_b", F.lit(" valley")))
    return l.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_quantity", d1.alias("d1"), F.date_add(d1, (q.cast("long") % 12 - 4).cast("int")).alias("d2"),
        F.when(F.col("l_linenumber") == 1, none).otherwise(F.array(F.concat("p_name_a", F.lit(" District")), "p_brand_a")).alias("xs"), F.array(one, "p_type_b").alias("ys"),
        F.array(F.concat("p_name_a", F.lit(" River")), F.lit("River")).alias("r1"),
        F.when(F.col("l_linenumber") == 2, none).otherwise(F.array(F.concat(F.lit("the River "), F.when(q > 25, F.col("p_name_a")).otherwise(F.col("p_name_b"))), F.lit(""))).alias("r2"),
        F.col("p_type_a").alias("t1"), F.col("p_type_b").alias("t2"),
    )


@query(f"""WITH {_PAIRS} SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(list_sort({_tokens("ys[1]")}), ' ') AS tokens, round({_places("xs", "ys")}, 6) AS location, {_river("r1[1]")} AS river, {_rivers("r1", "r2")} AS same_river FROM p""")
def location_pairs(spark, sf):
    """STR-19, STR-20: tokens of places, best-pair similarity, river keys."""
    return _pairs(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.array_join(F.array_sort(P.location_tokens(F.get("ys", F.lit(0)))), " ").alias("tokens"), F.round(P.location_similarity("xs", "ys"), 6).alias("location"),
        P.river_key(F.get("r1", F.lit(0))).alias("river"), P.river_similarity("r1", "r2").alias("same_river"),
    )


_SIGNALS = f"""{_PAIRS}, g AS (SELECT *, date_diff('day', d1, d2) AS gap, CASE WHEN l_suppkey % 4 = 0 THEN 'Unknown' ELSE t2 END AS tb, CASE l_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Côte d-Or' ELSE 'Chile' END AS ca,
CASE l_partkey % 3 WHEN 0 THEN 'côte  D-or' WHEN 1 THEN 'chile.' ELSE 'Peru' END AS cb FROM p),
s AS (SELECT *, least(greatest(l_discount * 10, 0), 1) AS sem, greatest(0, 1 - greatest(gap, -gap) / 7) AS dat, CASE WHEN len(xs) = 0 THEN 0.5 ELSE {_places("xs", "ys")} END AS loc, CASE WHEN len(r2) = 0 THEN 0.5 ELSE {_rivers("r1", "r2")} END AS riv,
CASE WHEN tb = 'Unknown' THEN 0.5 WHEN t1 = tb THEN 1 ELSE 0 END AS typ, CASE WHEN ca = '' THEN 0.5 WHEN {norm("ca")} = {norm("cb")} THEN 1 ELSE 0 END AS cou FROM g),
z AS (SELECT l_orderkey, l_linenumber, l_partkey, sem, dat, loc, riv, typ, cou, 0.55 * sem + 0.15 * dat + 0.15 * loc + 0.05 * riv + 0.05 * typ + 0.05 * cou AS score, abs(gap) > 3 OR (ca <> '' AND {norm("ca")} <> {norm("cb")}) AS veto FROM s)"""


def _signals(spark, sf):
    s, p = F.col("l_suppkey"), F.col("l_partkey")
    g = _pairs(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_discount") * 10).alias("sim"), F.col("d1").alias("date_min_a"), F.col("d1").alias("date_max_a"), F.col("d2").alias("date_min_b"), F.col("d2").alias("date_max_b"),
        F.col("xs").alias("places_a"), F.col("ys").alias("places_b"), F.col("r1").alias("rivers_a"), F.col("r2").alias("rivers_b"), F.col("t1").alias("type_a"), F.when(s % 4 == 0, "Unknown").otherwise(F.col("t2")).alias("type_b"),
        F.when(s % 3 == 0, "").when(s % 3 == 1, "Côte d-Or").otherwise("Chile").alias("country_a"), F.when(p % 3 == 0, "côte  D-or").when(p % 3 == 1, "chile.").otherwise("Peru").alias("country_b"),
    )
    return vector.pair_signals(g).withColumn("score", vector.pair_score()).withColumn("veto", vector.veto())


@query(f"""WITH {_SIGNALS} SELECT l_orderkey, l_linenumber, l_partkey, round(sem, 6) AS semantic, round(dat, 6) AS date, round(loc, 6) AS location, riv AS river, typ::DOUBLE AS type, cou::DOUBLE AS country, round(score, 6) AS score, veto FROM z""")
def pair_signal_scores(spark, sf):
    """NUM-11, DAT-3, DAT-4, JN-8: the six signals of pairs, their score and the veto."""
    names = {"semantic": "semantic", "date": "date", "location": "location", "river": "river", "type": "type", "country": "country"}
    return _signals(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", *[F.round(f"s_{k}", 6).alias(v) for k, v in names.items()], F.round("score", 6).alias("score"), "veto")


@query(f"""WITH {_SIGNALS}, l AS (SELECT unnest(['s_semantic', 's_date', 's_location', 's_river', 's_type', 's_country', 'score']) AS signal, unnest([sem, dat, loc, riv, typ, cou, score]) AS v FROM z WHERE NOT veto AND score >= 0.3)
SELECT signal, count(*) AS n, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.1), 6) AS p10, round(quantile_cont(v, 0.5), 6) AS median, round(quantile_cont(v, 0.9), 6) AS p90 FROM l GROUP BY signal""")
def link_percentiles(spark, sf):
    """AGG-22: mean, p10, median and p90 of the signals of accepted links."""
    p = vector.signal_percentiles(_signals(spark, sf).where("NOT veto AND score >= 0.3"))
    return p.select("signal", "n", *[F.round(x, 6).alias(x) for x in ("mean", "p10", "median", "p90")])


@query("""WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN floor(o_totalprice / 3000) END AS d, CASE WHEN o_custkey % 3 > 0 THEN floor(o_totalprice * (o_custkey % 4)) END AS a FROM orders)
SELECT o_orderkey, CASE WHEN d IS NULL AND a IS NULL THEN NULL WHEN coalesce(d, -1) >= 100 OR coalesce(a, -1) >= 1000000 THEN 'catastrophic' WHEN coalesce(d, -1) >= 20 OR coalesce(a, -1) >= 100000 THEN 'major'
WHEN coalesce(d, -1) >= 3 OR coalesce(a, -1) >= 10000 THEN 'moderate' ELSE 'minor' END AS severity FROM t""")
def severity_levels(spark, sf):
    """AGG-10: the default bands over two figures, either of which may be unknown."""
    o = table(spark, sf, "orders")
    d = F.when(F.col("o_orderkey") % 5 > 0, F.floor(F.col("o_totalprice") / 3000))
    a = F.when(F.col("o_custkey") % 3 > 0, F.floor(F.col("o_totalprice") * (F.col("o_custkey") % 4)))
    return o.select("o_orderkey", V.severity(d, a, mentions.BANDS).alias("severity"))


# a mention for each part

_MENTIONS = """m AS (SELECT p_partkey, p_name || CASE p_partkey % 3 WHEN 0 THEN '.' WHEN 1 THEN '' ELSE ' ...' END AS title, CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE p_type || ' seen. ' || p_brand || '.' END AS summary,
list_transform(range(p_size % 23), lambda i: p_brand || ' ' || i) AS places, list_transform(range(p_size % 12), lambda i: 'Mula ' || i) AS rivers, CASE WHEN p_partkey % 5 > 0 THEN 'Land ' || p_size END AS country,
CASE p_partkey % 3 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Flash Flood' END AS flood_type, list_transform(range(p_size % 8), lambda i: '2021-07-1' || i) AS dates, list_transform(range(p_size % 6), lambda i: p_type || i) AS causes,
CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END AS deaths FROM part)"""


def _mention_rows(spark, sf):
    k, n = F.col("p_partkey"), F.col("p_size")
    seq = lambda m: F.filter(F.sequence(F.lit(0), F.lit(30)), lambda i: i < n % m)
    text = lambda m, f: F.transform(seq(m), lambda i: F.concat(f, i.cast("string")))
    return table(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.when(k % 3 == 0, ".").when(k % 3 == 1, "").otherwise(" ...")).alias("title"),
        F.when(k % 4 == 1, "").when(k % 4 > 1, F.concat("p_type", F.lit(" seen. "), "p_brand", F.lit("."))).alias("summary"), text(23, F.concat("p_brand", F.lit(" "))).alias("places"), text(12, F.lit("Mula ")).alias("rivers"),
        F.when(k % 5 > 0, F.concat(F.lit("Land "), n.cast("string"))).alias("country"), F.when(k % 3 == 0, "Unknown").when(k % 3 == 1, "Flash Flood").alias("flood_type"), text(8, F.lit("2021-07-1")).alias("dates"),
        text(6, F.col("p_type")).alias("causes"), F.when(k % 2 == 0, F.col("p_retailprice")).alias("deaths"),
    )


def _joined(x: str, n: int, sep: str = "; ") -> str:
    return f"array_to_string(list_slice({x}, 1, {n}), '{sep}')"


_LABELLED = "".join(f" || CASE WHEN {c} THEN '. ' || regexp_replace({v}, '\\.+$', '') ELSE '' END" for c, v in [
    ("coalesce(summary, '') <> ''", "summary"), ("len(places) > 0", f"'Flooded: ' || {_joined('places', 12)}"), ("len(rivers) > 0", f"'River: ' || {_joined('rivers', 6)}"), ("country IS NOT NULL", "'Country: ' || country"),
    ("coalesce(flood_type, 'Unknown') <> 'Unknown'", "'Flood type: ' || flood_type"), ("len(dates) > 0", f"'Date: ' || {_joined('dates', 6, ', ')}"), ("len(causes) > 0", f"'Cause: ' || {_joined('causes', 4)}"),
])


@query(f"WITH {_MENTIONS} SELECT p_partkey, regexp_replace(trim(title), '\\.+$', ''){_LABELLED} AS text FROM m")
def embedding_texts(spark, sf):
    """PRJ-8: the labelled text that an embedding model sees."""
    return _mention_rows(spark, sf).select("p_partkey", mentions.embedding_text().alias("text"))


@query(f"""WITH {_MENTIONS} SELECT 'u/' || p_partkey AS uid, 2021 AS year, coalesce(dates[1], '') AS date_min, coalesce(dates[-1], '') AS date_max, coalesce(country, '') AS country, {_joined("places", 20)} AS locations, len(places) AS n_locations,
{_joined("rivers", 10)} AS rivers, coalesce(flood_type, 'Unknown') AS flood_type, 0.0 AS flood_type_confidence, repeat(title, 20)[:300] AS title, coalesce(deaths, -1) AS deaths, -1.0 AS missing, p_partkey % 2 = 0 AS verifiable FROM m""")
def mention_metadata(spark, sf):
    """PRJ-9: flat metadata of mentions without nulls."""
    m = _mention_rows(spark, sf)
    none = {k: F.lit(None).cast("double") for k in mentions.COUNTS if k != "deaths"}
    m = m.withColumns({
        **none, "uid": F.concat(F.lit("u/"), F.col("p_partkey").cast("string")), "year": F.lit("2021"), "month": F.lit("07"), "article_id": F.lit("a"), "publish_date": F.lit(None).cast("string"), "city": F.lit(None).cast("string"),
        "title": F.repeat("title", F.lit(20)), "flood_type_confidence": F.lit(None).cast("double"), "flood_type_evidence": F.lit(None).cast("string"), "n_events": F.lit(1),
        "verifiable": F.when(F.col("p_partkey") % 2 == 0, True), "contains_flood": F.lit(True),
    })
    return mentions.index_metadata(m).select("uid", "year", "date_min", "date_max", "country", "locations", "n_locations", "rivers", "flood_type", "flood_type_confidence", "title", "deaths", "missing", "verifiable")


# filters


@query("""WITH t AS (SELECT o_orderkey, 'about ' || (o_orderkey % 16) AS deaths, (o_custkey % 7)::VARCHAR AS missing, CASE WHEN o_custkey % 2 = 0 THEN '82 people' ELSE '820' END AS injured, floor(o_totalprice)::BIGINT % 3 = 0 AS big,
[strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate + INTERVAL 40 day, '%Y-%m-%d')] AS dates, strftime(o_orderdate + to_days((o_orderkey % 50)::INT), '%Y_%m') AS month FROM orders)
SELECT o_orderkey, list_filter([CASE WHEN big THEN 'affected_people' END, CASE WHEN deaths = 'about 14' THEN 'deaths' END, CASE WHEN injured = '82 people' THEN 'injured' END, CASE WHEN missing = '5' THEN 'missing' END], lambda x: x IS NOT NULL) AS leaked,
starts_with(dates[1], replace(month, '_', '-')) OR starts_with(dates[2], replace(month, '_', '-')) AS in_month FROM t""")
def leak_flags(spark, sf):
    """FLT-11, FLT-12: values of the prompt's example, and dates in the month of publication."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    values = {
        "affected_people": F.when(F.floor("o_totalprice") % 3 == 0, "15,000").otherwise("15,001"), "deaths": F.concat(F.lit("about "), (k % 16).cast("string")),
        "injured": F.when(c % 2 == 0, "82 people").otherwise("820"), "missing": (c % 7).cast("string"),
    }
    d = F.to_date("o_orderdate")
    month = F.date_format(F.date_add(d, (k % 50).cast("int")), "yyyy_MM")
    dates = F.array(d.cast("string"), F.date_add(d, 40).cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", filters.leaks(values).alias("leaked"), filters.in_publish_month(dates, month).alias("in_month"))


@query("""SELECT o_orderkey, o_orderstatus = 'F' AS kept_floods, o_orderstatus = 'F' AND o_custkey % 2 = 0 AS kept_both, contains(lower(concat_ws(' ', o_orderpriority, 'Pune ' || o_custkey, o_orderstatus || ' ' || o_orderkey)), 'urgent') OR contains('pune ' || o_custkey || ' ', '77 ') AS marquee FROM orders""")
def row_filters(spark, sf):
    """FLT-13, FLT-15: flags of CSV rows, and keywords in what a record says."""
    r = table(spark, sf, "orders").select("*", F.when(F.col("o_orderstatus") == "F", "true").otherwise("").alias("contains_flood_event"), F.when(F.col("o_custkey") % 2 == 0, "true").otherwise("false").alias("is_verifiable_flood"))
    place = F.array(F.concat(F.lit("Pune "), F.col("o_custkey").cast("string")))
    shown = filters.marquee(["urgent", "77 "], "o_orderpriority", place, F.array(F.col("o_orderstatus"), F.col("o_orderkey").cast("string")))
    return r.select("o_orderkey", filters.wanted(only_floods=True).alias("kept_floods"), filters.wanted(True, True).alias("kept_both"), shown.alias("marquee"))


_TITLES = ["Река {} вышла", "大雨が {} 降る", "der Fluss {} ist in der Stadt und das Dorf", "the river {} is in the town", "Inundación {} en la calle de los ríos", "洪水 {}"]
_FOUND = [("rus_Cyrl", "script"), ("jpn_Jpan", "script"), ("deu_Latn", "latin"), None, ("spa_Latn", "latin"), ("zho_Hans", "script")]


@query("WITH t AS (SELECT o_orderkey, o_orderkey % 6 AS k FROM orders WHERE o_custkey % 3 <> 0) SELECT o_orderkey, "
       + " ".join(f"{name} END AS {col}," for col, i in (("flores", 0), ("bucket", 1)) for name in ["CASE k " + " ".join(f"WHEN {j} THEN '{f[i]}'" for j, f in enumerate(_FOUND) if f)]).rstrip(",") + " FROM t WHERE k <> 3")
def untranslated_rows(spark, sf):
    """FLT-6: titles that a translation left as they were, told by script or by stop words of another language."""
    k = F.col("o_orderkey")
    title = F.element_at(F.array(*[F.concat(F.lit(a), k.cast("string"), F.lit(b)) for a, b in (t.split("{}") for t in _TITLES)]), (k % 6 + 1).cast("int"))
    o = table(spark, sf, "orders").select("o_orderkey", title.alias("original_title"), F.when(F.col("o_custkey") % 3 == 0, F.concat(title, F.lit("."))).otherwise(title).alias("translated_title"))
    return filters.untranslated(o).select("o_orderkey", "flores", "bucket")


@query("""WITH e AS (SELECT l_partkey, [('deaths', CASE WHEN l_quantity < 20 THEN 'unknown' ELSE l_quantity::INT::VARCHAR END), ('colour_' || l_linenumber, l_shipdate::DATE::VARCHAR), ('deaths_type', ' ' || upper(l_returnflag) || ' '), ('river', CASE WHEN l_discount > 0.05 THEN 'N/A' ELSE 'Mula' END)] AS kv FROM lineitem),
x AS (SELECT l_partkey % 20 AS part, unnest(kv) AS f FROM e), y AS (SELECT part, f[1] AS name FROM x WHERE lower(trim(f[2])) NOT IN ('unknown', 'n/a'))
SELECT part, count(*) AS values, count(DISTINCT name) AS names, round(avg((name IN ('deaths', 'river'))::INT::DOUBLE), 6) AS canonical_share FROM y GROUP BY part""".replace("f[1]", "struct_extract(f, 1)").replace("f[2]", "struct_extract(f, 2)"))
def schema_drift(spark, sf):
    """AGG-16, ARR-4: the names that informative fields bear, and the share of known ones."""
    return filters.schema_drift(_fields(spark, sf), "event", ["part"], ["deaths", "river"]).select("part", "values", "names", F.round("canonical_share", 6).alias("canonical_share"))


def _fields(spark, sf):
    e = F.create_map(
        F.lit("deaths"), F.when(F.col("l_quantity") < 20, "unknown").otherwise(F.col("l_quantity").cast("int").cast("string")), F.concat(F.lit("colour_"), F.col("l_linenumber").cast("string")), F.to_date("l_shipdate").cast("string"),
        F.lit("deaths_type"), F.concat(F.lit(" "), F.upper("l_returnflag"), F.lit(" ")), F.lit("river"), F.when(F.col("l_discount") > 0.05, "N/A").otherwise("Mula"),
    )
    return table(spark, sf, "lineitem").select((F.col("l_partkey") % 20).alias("part"), "l_orderkey", "l_linenumber", "l_partkey", e.alias("event"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, 2 + (l_quantity >= 20)::INT + (l_discount <= 0.05)::INT AS fields, (l_quantity >= 20)::INT + (l_discount <= 0.05)::INT AS canonical FROM lineitem""")
def field_counts(spark, sf):
    """ARR-4: informative fields of each record, and those with known names."""
    n = filters.field_counts("event", ["deaths", "river"])
    return _fields(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", n["fields"].alias("fields"), n["canonical"].alias("canonical"))


@query("""SELECT 'deaths_type' AS name, lower(l_returnflag) AS value, count(*) AS n FROM lineitem GROUP BY ALL UNION ALL
SELECT 'agency' AS name, a AS value, count(*) AS n FROM (SELECT unnest(['Red Cross', 'Unit ' || l_linenumber]) AS a FROM lineitem) GROUP BY ALL""")
def unit_tally(spark, sf):
    """AGG-28: values of *_type fields, and agencies."""
    e = _fields(spark, sf)
    agencies = F.array(F.lit("Red Cross "), F.concat(F.lit("Unit "), F.col("l_linenumber").cast("string")))
    units = filters.unit_tally(e, "event").select(F.col("field").alias("name"), "value", "n")
    return units.union(filters.agency_counts(e, agencies).select(F.lit("agency").alias("name"), F.col("agency").alias("value"), "n"))


# reports and samples


@query("""WITH r AS (SELECT p_type AS rule, p_name || ' ' || p_partkey AS title FROM part), pool AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY title) AS n FROM r),
picked AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY md5('13|' || rule || '|' || title), title) AS k FROM pool WHERE n <= 40)
SELECT rule, title, (SELECT count(*) FROM r x WHERE x.rule = picked.rule) AS fired FROM picked WHERE k <= 5""")
def rule_examples(spark, sf):
    """SRT-7: five random examples of each rule, out of a pool of forty."""
    r = table(spark, sf, "part").select(F.col("p_type").alias("rule"), F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("title"))
    return relational.rule_examples(r, "rule", "title", 5)


@query("""WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 35), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 35)
SELECT k AS l_partkey, 'left' AS only_in FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'right' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def key_differences(spark, sf):
    """SET-3: keys of exactly one of two tables."""
    l = table(spark, sf, "lineitem").where("l_quantity > 35")
    return relational.symmetric_difference(l.where("l_returnflag = 'A'"), l.where("l_returnflag = 'R'"), "l_partkey")


@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN ' \n ' ELSE text END AS text, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 11 = 1 THEN ' ' ELSE lang END AS title, n_chars, len(string_split_regex(trim(text), '\\s+')) AS words FROM documents),
r AS (SELECT doc_id, n_chars, CASE WHEN text IS NULL THEN 'missing_translated_text' WHEN NOT regexp_matches(text, '\\S') THEN 'empty_translated_text' WHEN title IS NULL THEN 'missing_translated_title' WHEN trim(title) = '' THEN 'empty_translated_title'
WHEN n_chars % 19 = 0 THEN 'empty_translated_text_after_cleaning' WHEN words < 100 THEN 'fewer_than_min_words' WHEN n_chars % 17 = 0 THEN 'garbled_text' END AS reason FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY doc_id) AS i, count(*) OVER (PARTITION BY reason) AS n, count(*) OVER () AS total FROM r WHERE reason IS NOT NULL)
SELECT reason, n, round(n / total, 6) AS share, string_agg(doc_id || ':' || n_chars, ' ' ORDER BY doc_id) AS examples FROM k WHERE i <= 10 GROUP BY ALL""")
def validation_report(spark, sf):
    """FLT-4, AGG-5: the first reason against each document, cheapest first, and a report with ten examples a reason."""
    k, n = F.col("doc_id"), F.col("n_chars")
    text = F.when(k % 7 == 1, " \n ").when(k % 7 != 0, F.col("text"))
    title = F.when(k % 11 == 1, " ").when(k % 11 != 0, F.col("lang"))
    words = F.size(F.split(F.trim("text"), r"\s+"))
    reason = relational.validation_reason(title, text, F.trim(title), F.when(n % 19 != 0, text), words, garbled=n % 17 == 0)
    d = table(spark, sf, "documents").select("doc_id", n.cast("string").alias("detail"), reason.alias("reason")).where("reason IS NOT NULL")
    r = relational.reason_report(d, key="doc_id")
    shown = F.array_join(F.transform("examples", lambda e: F.concat(e["doc_id"].cast("string"), F.lit(":"), e["detail"])), " ")
    return r.select("reason", "n", F.round("share", 6).alias("share"), shown.alias("examples"))


@query("""WITH r AS (SELECT l_orderkey AS uid, CASE WHEN l_quantity > 10 THEN 'resolved' ELSE 'ambiguous' END AS status, l_returnflag AS feature FROM lineitem), u AS (SELECT uid, bool_or(status = 'resolved') AS a, bool_and(status = 'resolved') AS b FROM r GROUP BY uid)
SELECT 'uids' AS name, count(*) AS n, round(avg(a::INT::DOUBLE), 6) AS any_resolved, round(avg(b::INT::DOUBLE), 6) AS all_resolved FROM u UNION ALL SELECT feature, count(*), NULL, NULL FROM r WHERE status = 'resolved' GROUP BY feature""")
def resolution_rates(spark, sf):
    """AGG-19: how many records have any and all of their places resolved, and by feature."""
    l = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("uid"), F.when(F.col("l_quantity") > 10, "resolved").otherwise("ambiguous").alias("status"), F.col("l_returnflag").alias("feature"))
    rates, by = grounding.resolution_rates(l)
    none = F.lit(None).cast("double")
    whole = rates.select(F.lit("uids").alias("name"), F.col("uids").alias("n"), F.round("any", 6).alias("any_resolved"), F.round("all", 6).alias("all_resolved"))
    return whole.union(by.select(F.col("feature").alias("name"), "n", none.alias("any_resolved"), none.alias("all_resolved")))


@query(r"""WITH t AS (SELECT o_orderkey, o_custkey, o_orderdate::DATE AS d, (o_orderdate + to_days((o_custkey % 15)::INT))::DATE AS published, CASE o_orderkey % 3 WHEN 0 THEN 'Water rose on Saturday, a Tuesday and ' || strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'It came on monday, friday' ELSE 'thursdays only; Sunday' END AS text FROM orders),
g AS (SELECT *, contains(text, strftime(d, '%Y-%m-%d')) AS found, regexp_matches(lower(text), '\b' || lower(strftime(d, '%A')) || '\b') AND abs(date_diff('day', d, published)) <= 7 AS near FROM t),
m AS (SELECT o_custkey, found, CASE WHEN found THEN 'exact' WHEN near THEN 'weekday_relative' ELSE 'none' END AS method FROM g)
SELECT method, count(*) AS n, sum(found::INT)::BIGINT AS grounded FROM m GROUP BY method""")
def weekday_dates(spark, sf):
    """DAT-5, CMP-3: dates that a text states, names by their weekday near publication, or neither."""
    d, k = F.to_date("o_orderdate"), F.col("o_orderkey") % 3
    text = F.when(k == 0, F.concat(F.lit("Water rose on Saturday, a Tuesday and "), d.cast("string"))).when(k == 1, "It came on monday, friday").otherwise("thursdays only; Sunday")
    a = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("uid"), F.lit("date").alias("field"), F.lit("date").alias("kind"), d.cast("string").alias("value"), text.alias("text"),
        F.date_add(d, (F.col("o_custkey") % 15).cast("int")).cast("string").alias("publish_date"),
    )
    return grounding.ground(a).groupBy("method").agg(F.count("*").alias("n"), F.sum(F.col("grounded").cast("long")).alias("grounded"))


@query("""WITH g AS (SELECT l_orderkey AS uid, avg((l_quantity > 5)::INT::DOUBLE) AS share FROM lineitem GROUP BY ALL)
SELECT count(*) AS articles, round(avg(share), 6) AS mean_ratio, round(avg((share = 1)::INT::DOUBLE), 6) AS fully_grounded, (SELECT round(avg((l_tax < 0.05)::INT::DOUBLE), 6) FROM lineitem) AS agreement FROM g""")
def grounding_summary(spark, sf):
    """AGG-18: the mean grounded share of articles, those grounded in full, and agreement with a tagger."""
    l = table(spark, sf, "lineitem")
    g = l.select(F.col("l_orderkey").alias("uid"), (F.col("l_quantity") > 5).alias("grounded"))
    s = grounding.grounding_summary(g, l.select(F.col("l_orderkey").alias("uid"), (F.col("l_tax") < 0.05).alias("agrees")))
    return s.select("articles", *[F.round(x, 6).alias(x) for x in ("mean_ratio", "fully_grounded", "agreement")])


# projections


@query("""WITH e AS (SELECT p_brand AS event_id, count(*) AS n_articles, list_sort(list(DISTINCT p_type)) AS locations, list_sort(list(p_partkey::VARCHAR)) AS source_uids, max(p_retailprice) AS deaths, arg_min(p_name, p_partkey) AS title FROM part GROUP BY ALL)
SELECT event_id, n_articles, array_to_string(locations, '; ') AS locations, array_to_string(source_uids, ' ') AS source_uids, deaths, title, NULL::VARCHAR AS severity, NULL::VARCHAR AS rivers, 22 AS columns FROM e""")
def event_csv_rows(spark, sf):
    """PRJ-12: the 22 columns of events' CSV rows."""
    e = table(spark, sf, "part").groupBy(F.col("p_brand").alias("event_id")).agg(
        F.count("*").alias("n_articles"), F.sort_array(F.collect_set("p_type")).alias("locations"), F.sort_array(F.collect_list(F.col("p_partkey").cast("string"))).alias("source_uids"), F.max("p_retailprice").alias("deaths"),
        F.min_by("p_name", "p_partkey").alias("title"),
    )
    rows = projections.event_csv(e)
    return rows.select("event_id", "n_articles", "locations", "source_uids", "deaths", "title", "severity", "rivers", F.lit(len(rows.columns)).alias("columns"))


@query("""WITH a AS (SELECT strftime(o_orderdate, '%Y_%m') AS month, o_orderkey::VARCHAR AS article_id, o_orderpriority AS translated_title, o_orderstatus AS source FROM orders),
d AS (SELECT o_orderkey::VARCHAR AS article_id, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'May 2021' END AS publish_date FROM orders WHERE o_orderkey % 5 > 0)
SELECT a.article_id, month AS year, coalesce(publish_date, '') AS publish_date, translated_title, source, '' AS region FROM a LEFT JOIN d USING (article_id)""")
def identity_columns(spark, sf):
    """PRJ-13, PRJ-14: publication dates of a parallel table, cut to the day, and the identity columns of a CSV."""
    o, k, d = table(spark, sf, "orders"), F.col("o_orderkey"), F.to_date("o_orderdate")
    a = o.select(F.date_format(d, "yyyy_MM").alias("month"), k.cast("string").alias("article_id"), F.col("o_orderpriority").alias("translated_title"), F.col("o_orderstatus").alias("source"))
    raw = F.when(k % 4 == 0, F.concat(F.lit(" "), d.cast("string"), F.lit("T00:00:00+00:00"))).when(k % 4 == 1, "May 2021 ").when(k % 4 == 2, " ")
    dates = o.where("o_orderkey % 5 > 0").select(F.date_format(d, "yyyy_MM").alias("month"), k.cast("string").alias("article_id"), raw.alias("publish_date"))
    return projections.record_columns(projections.resolve_publish_date(a, dates), partition="year", passthrough=("source", "region"))


@query(r"""SELECT doc_id, md5(CASE WHEN doc_id % 3 = 0 THEN 'PUBLISHED: 2021-07-0' || (doc_id % 9) || chr(10) || chr(10) ELSE '' END || 'TITLE: ' || lang || chr(10) || chr(10) || 'ARTICLE:' || chr(10) || text) AS message,
md5(lang || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'rain' || chr(10) ELSE '' END || source || CASE WHEN trim(text) <> '' THEN chr(10) || text ELSE '' END) AS classified,
trim(regexp_replace(lower(lang), '[^a-z0-9]+', ' ', 'g')) || '|' || trim(regexp_replace(lower(source), '[^a-z0-9]+', ' ', 'g')) AS key FROM documents""")
def prompt_texts(spark, sf):
    """PRJ-16, PRJ-18, PRJ-19: what a model is asked, the text that types are read from, and keys of mentions; whole texts, as digests."""
    k = F.col("doc_id")
    date = F.when(k % 3 == 0, F.concat(F.lit("2021-07-0"), (k % 9).cast("string")))
    causes = F.array(F.when(k % 2 == 0, "rain").otherwise(" "), F.col("source"))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(projections.user_message("lang", "text", date)).alias("message"), F.md5(projections.classification_text("lang", F.lit(None).cast("string"), causes, "text")).alias("classified"),
        projections.mention_key("source", "lang").alias("key"),
    )
