import random

from pyspark.sql import functions as F

from millrace.functions import places as P
from millrace.operators import evaluation as E
from millrace.operators import filters, grounding, projections, relational


def test_relaxed_spans_take_the_first_free_overlap(spark):
    """The greedy walk again in plain Python, over spans that overlap one another."""
    rnd = random.Random(2)

    def spans(n):
        out = []
        for _ in range(n):
            s = rnd.randrange(-2, 30)
            out.append((s, s + rnd.randrange(1, 9), rnd.choice("ab")))
        return out

    docs = [(spans(rnd.randrange(6)), spans(rnd.randrange(6))) for _ in range(60)] + [([], []), ([(0, 3, "a")], [])]
    tp = fp = fn = 0
    for gold, system in docs:
        left = list(gold)
        for s, e, label in (x for x in system if x[0] >= 0):
            hit = next((g for g in left if g[2] == label and s < g[1] and g[0] < e), None)
            tp, fp = tp + (hit is not None), fp + (hit is None)
            if hit:
                left.remove(hit)
        fn += len(left)
    kind = "array<struct<start:int,end:int,label:string>>"
    r = {(x.matching, x.label): x for x in E.span_scores(spark.createDataFrame(docs, f"gold {kind}, system {kind}")).collect()}
    relaxed = r["relaxed", None]
    assert (relaxed.tp, relaxed.fp, relaxed.fn) == (tp, fp, fn)
    strict = [(len(set(g) & p), len(p - set(g)), len(set(g) - p)) for g, s in docs for p in [{x for x in s if x[0] >= 0}]]
    assert (r["strict", None].tp, r["strict", None].fp, r["strict", None].fn) == tuple(map(sum, zip(*strict, strict=True)))


def test_nothing_judged_gives_no_measure(spark):
    empty = spark.createDataFrame([], "gold boolean, system boolean")
    assert E.decision_scores(empty, {"d": ("gold", "system")}).count() == 0
    none = spark.createDataFrame([("q", 1, None)], "query string, uid long, relevance int")
    runs = spark.createDataFrame([("r", "q", 1, 1)], "run string, query string, uid long, rank int")
    assert E.pooled_retrieval_scores(none, runs).count() == 0
    types = E.class_scores(spark.createDataFrame([("", "a"), (None, "b")], "gold string, system string"), "gold", "system")
    assert types.count() == 0


def test_places_and_rivers(spark):
    df = spark.createDataFrame([(["Cachar district"], ["the Cachar"]), (["A", "B"], ["C"]), ([], ["x"]), (["North of the River"], ["river"]), (["São Paulo City"], ["sao paulo"])], "a array<string>, b array<string>")
    got = [round(r[0], 3) for r in df.select(P.location_similarity("a", "b")).collect()]
    assert got == [1.0, 0.0, 0.0, 0.0, 0.5]  # "são" without its letter is dropped: {paulo} against {sao, paulo}
    rivers = spark.createDataFrame([(["the Brahmaputra River"], ["Brahmaputra"]), (["River"], ["the"]), (None, ["x"])], "a array<string>, b array<string>")
    assert [r[0] for r in rivers.select(P.river_similarity("a", "b")).collect()] == [1.0, 0.0, 0.0]


def test_projection_edges(spark):
    df = spark.createDataFrame([("2015-05-20T00:00:00+00:00",), (" May 2021 ",), ("",), (None,)], "d string")
    assert [r[0] for r in df.select(projections.normalize_date("d")).collect()] == ["2015-05-20", "May 2021", None, None]
    m = spark.range(1).select(projections.user_message(F.lit(None).cast("string"), F.lit("abcdef"), most=3)).first()[0]
    assert m == "TITLE: \n\nARTICLE:\nabc"
    rows = spark.createDataFrame([("1", "07", "t")], "article_id string, month string, translated_title string")
    assert projections.record_columns(rows, partition="year", passthrough=("x",)).collect()[0].asDict() == {"article_id": "1", "year": "07", "publish_date": "", "translated_title": "t", "x": ""}
    inline = spark.createDataFrame([("1", "2020-01-02T1")], "article_id string, publish_date string")
    assert projections.resolve_publish_date(inline, inline=True).first().publish_date == "2020-01-02"
    assert projections.resolve_publish_date(inline).first().publish_date is None


def test_filters_and_reports(spark):
    e = spark.createDataFrame([({"deaths": "14", "river": "n/a", "roof_type": " Tin "},), ({},), (None,)], "event map<string,string>")
    assert [r[0] for r in e.select(filters.field_counts("event", ["deaths"])["fields"]).collect()][:2] == [2, 0]
    assert [tuple(r) for r in filters.unit_tally(e, "event").collect()] == [("roof_type", "tin", 1)]
    a, b = spark.createDataFrame([("x",), ("x",), ("y",)], "k string"), spark.createDataFrame([("y",), ("z",)], "k string")
    assert sorted(tuple(r) for r in relational.symmetric_difference(a, b, "k").collect()) == [("x", "left"), ("z", "right")]
    places = spark.createDataFrame([("u", "resolved", "point"), ("u", "ambiguous", None), ("v", "resolved", "admin")], "uid string, status string, feature string")
    rates, by = grounding.resolution_rates(places)
    r = rates.first()
    assert (r.uids, r["any"], r["all"]) == (2, 1.0, 0.5) and by.count() == 2
