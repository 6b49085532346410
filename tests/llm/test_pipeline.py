import corpus_pipeline as cp
from millrace.llm import pieces, pii, toxicity
from millrace.session import cut, table
from tests.llm.oracle import base_spans, near_dup
from tests.llm.test_decontaminate import brute


def test_stages_against_brute_force(spark, sf, monkeypatch):
    kept = {}

    def keep(df, name="t"):
        kept[name] = cut(df, name)
        return kept[name]

    monkeypatch.setattr(cp, "cut", keep)
    last = cp.run(spark, sf)
    tables = [table(spark, sf, "documents"), *(kept[n] for n, _ in cp.STAGES[:-1]), last]
    assert all(t.columns == tables[0].columns for t in tables[1:-1])
    rows = [{r.doc_id: r for r in t.collect()} for t in tables]
    a, b, d, f, h, j = rows
    c, e, g, i = rows[1:5]
    model = toxicity.fit(table(spark, sf, "documents"), table(spark, sf, "labels"))
    assert set(b) == {k for k, r in a.items() if model.scores([r.text])[0] < 0.3} and len(b) < len(a)
    groups = near_dup([(k, r.text) for k, r in c.items()])
    assert set(d) == {k for k, (_, least) in groups.items() if least == k}
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    hit = {r[0] for r in brute([(k, r.text) for k, r in e.items()], items) if r[5]}
    assert set(f) == set(e) - hit and all(f[k] == e[k] for k in f)
    assert set(h) == set(g)
    for k, r in h.items():
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        if not base_spans(g[k].text) and "[" not in r.text:
            assert r.text == g[k].text
    v = pieces.load()
    assert set(j) == set(i) and all(r.round_trip and r.ids == pieces.encode(v, pieces.prepare(i[k].text, v)).tolist() for k, r in j.items())


def test_redaction_leaves_clean_texts(spark):
    df = spark.createDataFrame([(1, "nothing here", "en", "s", 12)], "doc_id long, text string, lang string, source string, n_chars long")
    assert pii.redact(df).collect() == df.collect()


def nasty(spark):
    """Null ids, ids that stand for two texts, repeated rows, null and empty texts, and extra columns whose names operators use."""
    long = lambda stem, n=60: " ".join(f"{stem}{i}" for i in range(n))
    rows = [
        (3, long("a")), (7, long("a")), (7, long("u")), (None, long("a") + " more"), (None, long("z")), (None, long("z") + " end"), (9, None), (9, None), (10, ""), (11, long("c")), (11, long("c")),
        (12, long("c") + " tail"), (13, "mail a@b.co"), (14, long("q", 5000)), (15, "x " + long("bench", 12)), (None, long("bench", 12) + " y"), (15, "clean text of the same id"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, score double, row int, Predicted int, spans string"
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), f"k{i}", float(i), i, i, "sp") for i, (d, t) in enumerate(rows)], schema), rows


def test_stages_on_a_nasty_table(spark, tmp_path):
    docs, rows = nasty(spark)
    spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"bench{i}" for i in range(12)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at = lambda df: sorted(r.row for r in df.collect())

    got = cp.drop_toxic(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    model = toxicity.fit(docs, table(spark, str(tmp_path), "labels"))
    kept = [i for i, (_, t) in enumerate(rows) if model.scores([t])[0] < 0.3]
    assert at(got) == kept and all(r.score == float(r.row) and r.Predicted == r.row for r in got.collect())

    got = cp.drop_near_duplicates(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    # of 0, 1 and 3 the smallest id stays; 2 is another text of id 7; of 4 and 5, without ids, one stays; of 9, 10 and 11 one row of the smaller id
    assert [i for i in at(got) if i not in (4, 5, 9, 10)] == [0, 2, 6, 7, 8, 12, 13, 14, 16]  # 15 is a near copy of 14
    assert len({4, 5} & set(at(got))) == 1 and len({9, 10} & set(at(got))) == 1

    got = cp.drop_contaminated(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and at(got) == [i for i in range(len(rows)) if i not in (14, 15)]

    got = cp.redact_pii(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and at(got) == list(range(len(rows)))
    by = {r.row: r for r in got.collect()}
    assert by[12].text == "mail [EMAIL]" and by[12].n_chars == 12 and all((r.key, r.spans, r.score) == (f"k{i}", "sp", float(i)) for i, r in by.items())
    assert all(by[i].text == t for i, (_, t) in enumerate(rows) if i != 12)

    got = cp.encode(spark, docs, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(r.round_trip in (True, None) for r in got)


def test_stages_on_an_empty_table(spark, tmp_path, sf):
    docs = nasty(spark)[0].limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, sf).count() == 0


def test_the_stage_that_cuts_nothing_gives_memory_back(spark, sf, freed):
    leave, mb = freed
    docs = table(spark, sf, "documents")
    cp.drop_toxic(spark, docs, sf)
    leave()
    before = mb()
    cp.drop_toxic(spark, docs, sf)
    assert mb() < before - 100


def test_executors_collect_their_garbage_around_a_stage(spark, sf):
    jvm = spark._jvm
    count, name = (next(m for m in jvm.java.lang.Class.forName(f"java.lang.management.{c}MXBean").getMethods() if m.getName() == g) for c, g in (("GarbageCollector", "getCollectionCount"), ("MemoryManager", "getName")))

    def full():  # collections of the whole heap; here the driver's JVM is the executor's
        none = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 0)
        beans = jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(count.invoke(b, none) for b in beans if "Young" not in name.invoke(b, none))

    docs = table(spark, sf, "documents")
    before = full()
    out = dict(cp.STAGES)["pii"](spark, docs, sf)
    assert full() >= before + 2
    assert out.count() == docs.count()
