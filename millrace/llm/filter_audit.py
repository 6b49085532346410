"""What filters remove in every order in which they can be applied: a trie of permutations whose states are shared.

Two orders that have applied the same filters hold the same survivors, so k filters have 2^k states, not k! paths. The
states are visited depth first: the survivors of a state are a persisted DataFrame, made from those of the state above
by one filter; one aggregate over them counts what each filter that is still to come removes; a state that another
order has already reached is not made again. At most k + 1 states are persisted at a time, and all that they hold of a
document is one boolean a filter and a tag.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import UPPER
from millrace.session import cut, drop, table

FILTERS = ("A", "B", "C", "D", "E")
TAGS = ("good", "toxic")
#: Texts that several ids share, and labelled documents, that are broadcast at most (under 100 bytes each); more are shuffled.
BROADCAST = 500_000


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, whether the document fails each of the filters A to E, and the tags good and toxic, a row a document.

    docs: doc_id, text, lang and anything else; labels: doc_id, quality, toxic and anything else. A null text is empty, a
    null lang is the part of the empty string. A document fails E if a smaller doc_id has its text; documents without an id neither
    fail it nor make others fail, and rows that repeat an id and its text do not fail for one another. A document is
    good, or toxic, if any label of its id says 1. Texts are compared by their SHA-256, which is what moves, not the text.
    """
    text, words = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("_words")
    d = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("_text"))
    d = d.withColumn("_words", F.filter(F.split("_text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    upper = F.char_length(F.regexp_replace("_text", f"[^{UPPER[0]}-{UPPER[-1]}]+", ""))
    d = d.select(
        "doc_id", "part", F.unhex(F.sha2("_text", 256)).alias("digest"), (F.size(words) < 200).alias("A"),
        (F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * 50).alias("B"),
        (upper.cast("long") * 100 > F.char_length("_text").cast("long") * 3).alias("C"), F.col("_text").rlike("[#$%&*|]").alias("D"),
    )
    d = cut(d, "fa-measured")  # texts are read once, and both sides of the join below are shuffles, which AQE splits if a text is hot
    shared = d.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    tagged = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id")
    tagged = tagged.agg(*[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(t) for c, t in (("quality", "good"), ("toxic", "toxic"))])
    for side, key in ((cut(shared, "fa-shared"), "digest"), (cut(tagged, "fa-tagged"), "doc_id")):
        d = d.join(F.broadcast(side) if side.count() <= BROADCAST else side, key, "left")
    no = lambda c: F.coalesce(c, F.lit(False))
    return d.select("part", *FILTERS[:4], no(F.col("doc_id") > F.col("first")).alias("E"), *[no(F.col(t)).alias(t) for t in TAGS])


def edges(rows: DataFrame, filters: tuple[str, ...] = FILTERS, tags: tuple[str, ...] = TAGS) -> DataFrame:
    """state (the filters applied before, as bits), filter (its number), part, total, removed and a count a tag: an edge of the trie a row.

    rows: part, a boolean column a filter (true: fails) and a tag, no nulls. Parts of which a state keeps nothing have no row there.
    """
    made, tables = set(), []

    def visit(state: int, survivors: DataFrame) -> None:
        made.add(state)
        rest = [i for i in range(len(filters)) if not state >> i & 1]
        new = [i for i in rest if len(rest) > 1 and state | 1 << i not in made]
        if new:  # those that no other state is made from are read once
            survivors = survivors.persist(StorageLevel.MEMORY_AND_DISK)
        counts = survivors.groupBy("part").agg(
            F.count("*").alias("total"), *[F.count(F.when(F.col(filters[i]), 1)).alias(f"r{i}") for i in rest],
            *[F.count(F.when(F.col(filters[i]) & F.col(t), 1)).alias(f"t{i}_{k}") for i in rest for k, t in enumerate(tags)],
        )
        each = [F.struct(F.lit(i).alias("filter"), F.col(f"r{i}").alias("removed"), *[F.col(f"t{i}_{k}").alias(t) for k, t in enumerate(tags)]) for i in rest]
        tables.append(cut(counts.select(F.lit(state).alias("state"), "part", "total", F.inline(F.array(*each))), "fa-edges"))
        for i in new:
            visit(state | 1 << i, survivors.where(~F.col(filters[i])))
        if new:
            survivors.unpersist()

    visit(0, rows)
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    out = cut(out, "fa-trie")
    drop(*tables)
    return out


def audit(rows: DataFrame, filters: tuple[str, ...] = FILTERS, tags: tuple[str, ...] = TAGS) -> DataFrame:
    """part, filter_order, step, filter and the counts of that step, for every part, order and step, zeros included.

    kept: documents after the step; removed: here; redundant: failing its filter, but removed before; unique_fails:
    failing no other filter; <tag>_lost: of those removed here; shapley: removed by its filter summed over all orders.
    An empty table gives no rows. k filters have k! orders: this is for some few.
    """
    spark, k = rows.sparkSession, len(filters)
    trie, everything = edges(rows, filters, tags), (1 << k) - 1
    paths = [("".join(filters[i] for i in p), s + 1, p[s], sum(1 << i for i in p[:s])) for p in permutations(range(k)) for s in range(k)]
    orders = spark.createDataFrame(paths, "filter_order string, step int, filter int, state int")  # k * k! rows
    ways = F.element_at(F.lit([factorial(n) * factorial(k - 1 - n) for n in range(k)]), F.bit_count("state") + 1)
    last = F.col("state") == F.lit(everything) - F.expr("shiftleft(1, filter)")
    of_filter = trie.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("state") == 0, F.col("removed")).otherwise(0)).alias("fails"), F.sum(F.when(last, F.col("removed")).otherwise(0)).alias("unique_fails"),
        F.sum(F.col("removed") * ways).alias("shapley"),
    )
    asked = of_filter.join(F.broadcast(orders), "filter")
    found = asked.join(trie, ["part", "state", "filter"], "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return found.select(
        "part", "filter_order", "step", F.element_at(F.lit(list(filters)), F.col("filter") + 1).alias("filter"), (n("total") - n("removed")).alias("kept"), n("removed").alias("removed"),
        (n("fails") - n("removed")).alias("redundant"), n("unique_fails").alias("unique_fails"), *[n(t).alias(f"{t}_lost") for t in tags], n("shapley").alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit(rows).drop("filter")


QUERIES = {"op11_filter_audit": op11_filter_audit}
ORACLE = {
    "op11_filter_audit": r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM t),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
g AS (SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
        100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d, e,
        coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
      FROM w LEFT JOIN l USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, s::INT AS s, o[s] AS f, left(o, s - 1) AS pre FROM orders, range(1, 6) r(s)),
x AS (SELECT g.part, steps.o, steps.s, steps.f, good, toxic, n,
        CASE f WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails,
        (contains(pre, 'A') AND a) OR (contains(pre, 'B') AND b) OR (contains(pre, 'C') AND c) OR (contains(pre, 'D') AND d) OR (contains(pre, 'E') AND e) AS gone,
        a::INT + b::INT + c::INT + d::INT + e::INT AS many
      FROM g, steps),
y AS (SELECT part, o, s, f, sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN fails AND many = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN NOT gone AND fails AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN NOT gone AND fails AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
      FROM x GROUP BY ALL)
SELECT part, o AS filter_order, s AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM y"""
}
