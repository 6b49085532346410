import datetime as dt
import json
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import grounding, mentions, metrics, relational, search, vector
from millrace.operators.graph import connected_components
from millrace.plans import documents
from millrace.sources import files, sinks
from millrace.streaming import live


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 60)] + [(200, 200), (None, 3), (70, 71), (71, 70)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(1, 60)} == {1} and got[71] == 70 and 200 not in got


def test_components_of_long_paths(spark):
    shuffled = random.Random(0).sample(range(600), 600)
    adverse = [1000, *range(1599, 1000, -1)]
    edges = [e for path in (shuffled, adverse) for e in zip(path, path[1:])]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(600)} | {i: 1000 for i in range(1000, 1600)}


def test_span_limited_union_depends_on_order(spark):
    d = lambda n: dt.date(2021, 1, 1) + dt.timedelta(n)
    spans = spark.createDataFrame([(1, d(0), d(0)), (2, d(40), d(40)), (3, d(80), d(80)), (4, None, None)], "node long, lo date, hi date")
    links = spark.createDataFrame([(1, 2, 1), (2, 3, 2), (3, 4, 3)], "a long, b long, order long")
    got = {r.node: r.cluster for r in vector.span_limited_clusters(links, spans).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3}
    other = links.withColumn("order", -F.col("order") + 10)
    assert {r.node: r.cluster for r in vector.span_limited_clusters(other, spans).collect()} == {1: 1, 2: 2, 3: 2, 4: 2}


def test_clusters_and_events(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], "id long, embedding array<float>")
    day = dt.date(2021, 7, 1)
    meta = spark.createDataFrame([(i, day, day, ["Pune"], ["Mula"], "flash", "India") for i in (1, 2, 3)], "id long, date_min date, date_max date, places array<string>, rivers array<string>, type string, country string")
    c = vector.cluster_events(v, meta)
    assert {r.node: r.cluster for r in c.collect()} == {1: 1, 2: 1, 3: 3}
    x = lambda n: json.dumps({"contains_flood_event": True, "is_verifiable_flood": True, "flood_dates": ["2021-07-01", "bad"], "flooded_locations": ["Pune", "pune "], "events": [{"fatalities": n, "river": "Mula", "country": "India"}]})
    rec = spark.createDataFrame([("2021", "07", str(i), "T.", "2021-07-02", x(n)) for i, n in ((1, "at least 3"), (2, "5"), (3, None))], "year string, month string, article_id string, translated_title string, publish_date string, extraction string")
    m = mentions.mention_rows(rec).withColumn("id", F.col("article_id").cast("long"))
    rows = {r.uid: r for r in m.collect()}
    r = rows["2021/07/1"]
    assert (r.deaths, r.places, r.rivers, r.date_min, r.country) == (3.0, ["Pune"], ["Mula"], day, "India") and rows["2021/07/3"].deaths == -1.0
    typed = m.withColumn("flood_type", F.lit("Flash Flood"))
    assert typed.select(mentions.embedding_text().alias("t")).first().t == "T. Flooded: Pune. River: Mula. Country: India. Flood type: Flash Flood. Date: 2021-07-01"
    ev = {r.event_id: r for r in mentions.build_events(m, c.withColumnRenamed("node", "id"), v).collect()}
    e = ev["E-2021-000001"]
    assert (e.n_articles, e.deaths.value, e.deaths.min, e.deaths.conflict, e.severity, e.medoid) == (2, 5.0, 3.0, True, "moderate", 1)
    assert mentions.conflict_rates(mentions.build_events(m, c.withColumnRenamed("node", "id"))).first().conflict_rate == 1.0
    more = {k: F.lit(None).cast("string") for k in ("year", "month", "publish_date", "city", "flood_type", "flood_type_confidence", "flood_type_evidence", "n_events")}
    assert mentions.index_metadata(m.withColumns({**more, "verifiable": F.col("is_verifiable_flood"), "contains_flood": F.col("contains_flood_event")})).where("deaths = -1").count() == 1


def test_grounding(spark):
    text = "On 3 May 2021, 1,20,000 people left Pune district; two died near the Mula-Mutha river."
    rows = [("deaths", "number", "2"), ("displaced", "number", "120000"), ("date", "date", "2021-05-03"), ("place", "text", "Pune district"), ("place", "text", "Mutha river near Mula"), ("deaths", "number", "7"), ("place", "text", "Delhi")]
    df = spark.createDataFrame([("u", *r, text) for r in rows], "uid string, field string, kind string, value string, text string")
    got = [(r.value, r.grounded, r.method) for r in grounding.ground(df).collect()]
    assert got == [("2", True, "exact"), ("120000", True, "exact"), ("2021-05-03", True, "exact"), ("Pune district", True, "exact"), ("Mutha river near Mula", True, "tokens"), ("7", False, "none"), ("Delhi", False, "none")]
    assert {r.field: r.support for r in grounding.support_rates(grounding.ground(df)).collect()}["deaths"] == 0.5


def test_grounding_reads_whole_texts(spark):
    df = spark.createDataFrame([("a", "f", "quote", "levee", "word " * 5000 + "levee")], "uid string, field string, kind string, value string, text string")
    r = grounding.ground(df).first()
    assert r.grounded and r.method == "exact" and "levee" in r.evidence


def test_geocoding(spark):
    g = spark.createDataFrame(
        [(1, "Pune", ["Poona"], "IN", 3_000_000, 18.5, 73.8, "point"), (2, "Springfield", [], "US", 150_000, 37.2, -93.3, "point"), (3, "Springfield", [], "US", 110_000, 39.8, -89.6, "point"), (4, "India", [], "IN", 10**9, 20.0, 77.0, "country"), (5, "Paris", [], "FR", 2_000_000, 48.8, 2.3, "point"), (6, "Paris", [], "US", 20_000, 33.6, -95.5, "point")],
        "place_id long, name string, alternates array<string>, country string, population long, lat double, lon double, feature string",
    )
    m = spark.createDataFrame([("Poona", "IN"), ("Springfield", None), ("Pune district, India", "IN"), ("Paris", None), ("Paris", "US"), ("Atlantis", ""), ("India", None)], "mention string, country string")
    got = {(r.mention, r.country): (r.status, r.place_id) for r in grounding.geocode(m, g).collect()}
    assert got == {("Poona", "IN"): ("resolved", 1), ("Springfield", None): ("ambiguous", None), ("Pune district, India", "IN"): ("resolved", 1), ("Paris", None): ("resolved", 5), ("Paris", "US"): ("resolved", 6), ("Atlantis", ""): ("unresolved", None), ("India", None): ("resolved", 4)}
    c = grounding.centroids(g.withColumn("k", F.lit(1)), "k").first()
    assert c.primary_place == 1 and c.places == 6


def test_search(spark):
    d = spark.createDataFrame([(1, "flood in assam"), (2, "assam tea"), (3, "rain")], "id long, text string")
    q = spark.createDataFrame([(0, "assam flood"), (1, "snow")], "query_id long, query string")
    assert [(r.query_id, r.id) for r in search.bm25(d, q).orderBy("rank").collect()][0] == (0, 1)
    m = spark.createDataFrame([(2021, "India", "flash", "2021-07-01", "2021-07-03", 0), (2022, "Nepal", None, None, None, None)], "year int, country string, flood_type string, date_min string, date_max string, deaths int")
    n = lambda **k: m.where(search.matches(**k)).count()
    assert (n(), n(years=[2021]), n(country="nep"), n(type_="flash"), n(since="2021-07-02"), n(until="2021-06-30"), n(min_deaths=0)) == (2, 1, 1, 1, 1, 0, 1)
    hits = spark.createDataFrame([(0, i, i) for i in range(1, 6)], "query_id long, id long, rank int")
    assert [r.id for r in search.rerank(hits, F.col("id"), 3).orderBy("rank").collect()] == [3, 2, 1, 4, 5]
    chunks = spark.createDataFrame([(1, 0, 0.1, "a"), (1, 5, 0.9, "b"), (1, 9, 0.8, "c"), (1, 12, 0.7, "d")], "id long, start int, sim double, text string")
    heads = spark.createDataFrame([(2, "head")], "id long, head string")
    ev = {r.id: r.evidence for r in search.evidence(chunks, hits, heads).collect()}
    assert ev[1] == "b\nc\nd" and ev[2] == "head"


def test_every_benchmark_item_searches(spark, sf):
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    docs = {r.doc_id: Counter(words(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: set(words(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    df = Counter(w for d in docs.values() for w in d if any(w in q for q in items.values()))
    idf = {w: math.log((len(docs) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    low = 0.25 * sum(idf.values()) / len(idf)
    mean = sum(d.total() for d in docs.values()) / len(docs)
    want = {}
    for i, q in items.items():
        score = lambda d: sum((idf[w] if idf[w] >= 0 else low) * d[w] * 2.5 / (d[w] + 1.5 * (0.25 + 0.75 * d.total() / mean)) for w in q if w in d)  # noqa: B023, E731
        best = sorted((-round(score(d), 9), k) for k, d in docs.items())[:20]
        want |= {(i, n): -s for n, (s, _) in enumerate(best, 1) if s < 0}
    got = {(r.query_id, r["rank"]): r.score for r in documents.bm25_topk(spark, sf).collect()}
    assert len(items) > 8 and got == pytest.approx(want, abs=2e-6)


def test_relational(spark):
    p = spark.createDataFrame([("a/z.json",), ("a/b/c.json",), ("a/b.json",)], "p string")
    assert [r.p for r in p.orderBy(relational.path_order(F.col("p"))).collect()] == ["a/b.json", "a/z.json", "a/b/c.json"]
    assert relational.bins_by_budget([5, 1, 9, 2], 10, 3) == [[1, 3], [0], [2]]
    t = spark.createDataFrame([("�", "x"), ("ab", "w " * 9), ("abc", "y" * 70), ("long enough", "fine"), ("a", " ")], "s string, n string")
    assert [r.r for r in t.select(relational.patch_rejection(F.col("s"), F.col("n")).alias("r")).collect()] == ["mojibake-source", "repetition-loop", "bloated-from-short", None, "empty"]
    assert [r["rank"] for r in relational.ranked(spark.range(50).select(F.col("id").alias("x")), F.desc("x")).orderBy("x").collect()] == list(range(50, 0, -1))
    s = relational.stratified_sample(spark.range(100).selectExpr("id", "id % 2 AS k"), "k", "id", 5)
    assert sorted(r.id for r in s.collect()) == sorted(r.id for r in relational.stratified_sample(spark.range(100).repartition(7).selectExpr("id", "id % 2 AS k"), "k", "id", 5).collect())


def test_sources_and_sinks(spark, tmp_path):
    root = tmp_path / "in"
    (root / "2021_07").mkdir(parents=True)
    (root / "2021_07" / "a.json").write_text("﻿" + json.dumps({"article_id": "x1", "title": "T", "odd": 1}), encoding="utf-8")
    (root / "2021_07" / "b.json").write_text(json.dumps([{"title": "1"}, {"id": "q"}]))
    (root / "2021_07" / "c.json").write_text("not json")
    (root / "2021_07" / "d.jsonl").write_text('{"id":"x1","title":"second"}\n{"id":"l2","title":""}\n[1]\n')
    a = files.articles(spark, str(root))
    assert sorted(r.article_id for r in a.where("NOT corrupt").collect()) == ["b#0", "l2", "q", "x1", "x1"] and a.where("corrupt").count() == 2
    c = files.columns(a).where("title = 'T'").first()
    assert c.extra == {"odd": "1"}
    assert {r.article_id: r.title for r in files.event_ids(spark, str(root)).collect()}["x1"] == "T"
    assert [(r.month, r.files) for r in files.month_totals(files.raw_files(spark, str(root))).collect()] == [("2021_07", 4)]
    found, missing = files.id_index(spark.createDataFrame([("2021_07/a",), ("zz",)], "article_id string"), files.raw_files(spark, str(root)))
    assert found.count() == 1 and missing.first().article_id == "zz"
    assert files.parse_years(["2019-2021,2020", "2023"]) == [2019, 2020, 2021, 2023]
    with pytest.raises(ValueError):
        files.parse_years(["2022-2020"])
    out = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "id string, v int")
    assert sinks.append_new(df, out, "id") == 2 and sinks.append_new(df.union(spark.createDataFrame([("c", 3)], df.schema)), out, "id") == 1
    sinks.write_months(df.withColumn("month", F.lit("2021_07")), str(tmp_path / "m"))
    with pytest.raises(Exception, match="exists"):
        sinks.write_months(df.withColumn("month", F.lit("2021_07")), str(tmp_path / "m"), overwrite=False)
    ev = spark.createDataFrame([("a", [{"deaths": "1", "odd": "x"}, {"deaths": "2"}]), ("b", [])], "id string, events array<map<string,string>>")
    keys, rare = sinks.flat_columns(ev.select(F.explode("events").alias("fields")), min_fill=2)
    assert (keys, rare) == (["deaths"], ["odd"])
    flat = sorted(tuple(r) for r in sinks.flatten_events(ev, ["id"], keys, rare).collect())
    assert flat == [("a", "0", "1", '{"odd":"x"}'), ("a", "1", "2", ""), ("b", "", "", "")]
    assert sinks.markdown(df.limit(1)) == "| id | v |\n|---|---|\n| a | 1 |"
    x = spark.createDataFrame([("u", True, True, 2), ("u", True, True, 1), ("w", True, False, 3)], "uid string, contains_flood_event boolean, is_verifiable_flood boolean, seq int")
    assert [(r.uid, r.seq) for r in files.mentions(x).collect()] == [("u", 1)] and files.mentions(x, "flood", done=x.where("uid = 'u'")).first().uid == "w"


def test_streams(spark, tmp_path):
    root = tmp_path / "s"
    root.mkdir()
    lines = [("p", "1", False), ("p", "1", True), ("p", "1", False), ("p", "2", False), ("q", "3", True)]
    for i, (p, a, ok) in enumerate(lines):
        (root / f"{i}.json").write_text(json.dumps({"part": p, "article_id": a, "ok": ok, "ts": f"2021-01-01 00:0{i}:00", "value": 1.0}))
    s = live.tail(spark, str(root), "part string, article_id string, ok boolean, ts timestamp, value double")
    q = live.reconcile(s).writeStream.outputMode("update").format("memory").queryName("states").start()
    q.processAllAvailable()
    q.stop()
    got = {r.article_id: r.state for r in spark.sql("SELECT * FROM states").collect()}
    assert got == {"1": "ok", "2": "failed", "3": "ok"}
    w = live.tumbling(s, "2 minutes", ["part"]).writeStream.outputMode("complete").format("memory").queryName("win").start()
    w.processAllAvailable()
    w.stop()
    assert spark.sql("SELECT sum(n) FROM win").first()[0] == 5
    batch = spark.read.json(str(root))
    assert {r.article_id: r.state for r in live.reconcile_batch(batch).collect()} == got


def test_title_prefilter(spark):
    rows = [(f"flood water rises {i}", 1) for i in range(30)] + [(f"market shares fall {i}", 0) for i in range(60)]
    df = spark.createDataFrame(rows, "text string, label int")
    out = metrics.title_prefilter(df, features=1 << 12).transform(df)
    assert metrics.binary_scores(out.select("label", F.col("prediction").cast("int").alias("p")), "label", "p").first().f1 > 0.95


def test_tuned_prefilter(spark):
    rows = [(f"flood water rises {i}", 1) for i in range(60)] + [(f"market shares fall {i}", 0) for i in range(90)] + [(f"water market {i}", i % 2) for i in range(40)] + [(None, 1), ("x", None)]
    df = spark.createDataFrame(rows, "text string, label int")
    model, m = metrics.tuned_prefilter(df.coalesce(2), penalties=(0.01, 1.0), features=256)
    assert m["roc_auc"] > 0.8 and m["penalty"] in (0.01, 1.0) and m["recall"] >= 0.95 and 0 < m["threshold"] < 1
    assert model.transform(df.where("text IS NOT NULL")).count() == len(rows) - 1


def test_bm25_keeps_the_best_in_tasks_whatever_they_hold(spark, monkeypatch):
    """Scores made inside tasks equal those of joins, with copies (ties by id), empty texts and little held at once; no join makes pairs."""
    words = ["flood", "river", "storm", "town", "rain"]
    texts = [None, "", "..."] + [" ".join(words[(i * j) % 5] for j in range(1, 2 + i % 9)) + f" Flood-{i % 40} W{i % 23}" for i in range(300)]
    docs = spark.createDataFrame([(f"d{i % 7}-{i}", t) for i, t in enumerate(texts)], "id string, text string").repartition(4)
    asks = spark.createDataFrame([("a", "flood w3 w4"), ("b", "the 9 TOWN w5 w5 8"), ("b", "9"), ("c", "unknown"), ("d", None)], "query_id string, query string")
    rows = lambda df: sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in df.collect())
    want = rows(search._joined_bm25(docs, asks, 7, "id", "text"))
    got = search.bm25(docs, asks, 7)
    assert rows(got) == want and len(want) == 14
    assert "MapInArrow" in got._jdf.queryExecution().toString()
    monkeypatch.setattr(search, "SLICE", 20)
    monkeypatch.setattr(search, "HELD", 15)
    assert rows(search.bm25(docs, asks, 7)) == want
    twice = docs.union(docs.limit(50))
    assert rows(search.bm25(twice, asks, 7)) == rows(search._joined_bm25(twice, asks, 7, "id", "text"))
