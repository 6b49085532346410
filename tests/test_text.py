import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions import values as V
from millrace.operators import grounding, rules


def rows(name):
    for line in open(name):
        if not line.startswith("#"):
            y, t = line.rstrip("\n").split("\t")
            yield t, y == "1"


def test_flood_titles(spark):
    cases = list(rows("tests/flood_titles.tsv"))
    assert len(cases) == 84
    r = rules.TitleRules.load()
    df = spark.createDataFrame(cases, "title string, want boolean").withColumn("m", rules.match_title("title", r))
    wrong = [(x.title, x.m.reason) for x in df.collect() if x.m.matched != x.want]
    assert not wrong


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("a &amp;amp; b", "a & b"), ("<p>x</p><script>y</script>z", "x z"), ("“q” — r", '"q" - r'), ("a​b ", "ab"), ("see https://x.y/z, then", "see, then"), ("One.\nREAD: Other story\nTwo.", "One.\n\nTwo."),
        ("wait.... what,, no", "wait... what, no"), ("a (READ: x) b", "a b"), ("ADVERTISEMENT\nbody", "body"), ("x\n\n\n\ny", "x\n\ny"), (None, None),
    ],
)
def test_clean(raw, want):
    got = T.clean(raw)
    assert (got and got.replace("\n\n", "\n")) == (want and want.replace("\n\n", "\n"))
    assert T.clean(got) == got


def test_clean_is_idempotent(spark, sf):
    for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect():
        once = T.clean(r.text)
        assert T.clean(once) == once


def test_strings():
    assert T.fold("São Paulo—FLOOD's") == "s o paulo flood s"
    assert T.repair_mojibake("cafÃ©") == "café" and T.repair_mojibake("café") == "café"
    assert T.sentences("One. Two said. three\n\nFour") == ["One.", "Two said. three", "Four"]
    assert T.sentences_any("Dr. Smith came. He left。 中文。") == ["Dr. Smith came.", "He left。", "中文。"]
    assert T.dominant_script("漢字かな") == "Hiragana" and T.dominant_script("привет") == "Cyrillic" and T.dominant_script("12") is None
    assert T.guess_language("the cat is in the house of the king") == "en"
    assert T.number_forms(120000) == ["120000", "120,000", "120 000", "1,20,000", "1200 hundred", "120 thousand"]
    assert T.number_forms(2) == ["2", "two"] and T.number_forms(2.5) == ["2.5"]
    assert T.pack("aa bb cc. dd ee. " + "x " * 9, 5, 6) == ["aa bb cc. dd ee.", "x x x x x x", "x x x"]
    out = T.passages("Aaaa bbbb. " * 60, 200, 40, 60, 8)
    assert all(p["end"] - p["start"] <= 260 for p in out) and T.passages("", 9) == []


def test_whole_texts_for_passages():
    long = "Aaaa bbbb cccc dddd. " * 1000
    assert T.passages(long)[-1]["end"] == len(long.rstrip()) and len(T.passages(long, most=8)) == 8


def test_whole_texts_for_entities():
    late = "word " * 1000 + "a flood on 3 May 2021"
    assert [(s["text"], s["start"]) for s in rules.entity_spans(late, {"HAZARD": ["flood"]})] == [("flood", 5002), ("3 May 2021", 5011)]


def test_whole_texts_for_scripts_and_languages():
    assert T.dominant_script("a" * 2500 + "б" * 3000) == "Cyrillic" and T.dominant_script("漢" * 2500 + "か") == "Hiragana"
    assert T.guess_language("the of and " * 200 + "der die das " * 400) == "de"


def test_values(spark):
    v = spark.createDataFrame([("at least 1,200", "2021-02-30", "12.3k"), ("two", "2021-05-00", "7"), ("+14", "2021-05-01T10", None), ("true", "May", "2M")], "n string, d string, h string")
    got = v.select(V.to_number("n").alias("n"), V.as_number("n").alias("a"), V.parse_iso("d").alias("d"), V.date_quality("d").alias("q"), V.unhuman("h").alias("h")).collect()
    assert [r.n for r in got] == [1200.0, None, 14.0, None] and [r.a.clean for r in got] == [False, False, True, False]
    assert [str(r.d) for r in got] == ["None", "None", "2021-05-01", "None"] and [r.q for r in got] == ["impossible", "partial", "not-iso", "not-iso"]
    assert [r.h for r in got] == [12300.0, 7.0, None, 2e6]
    e = spark.createDataFrame([('{"fatalities":"3","deaths":"4","x":" "}',)], "j string").select(F.from_json("j", "map<string,string>").alias("e"))
    assert e.select(V.fold_slots("e", {"fatalities": "deaths"}).alias("m")).first().m == {"deaths": "3"}
    assert e.select(V.fold_slots("e", {"fatalities": "deaths"}, True).alias("m")).first().m == {"deaths": "4"}
    j = spark.createDataFrame([('say ```json\n{"a":1}\n```',), ('x {"b":{"c":2}} y',), ("none",)], "r string").select(V.json_salvage("r").alias("j")).collect()
    assert [r.j for r in j] == ['{"a":1}', '{"b":{"c":2}}', None]
    d = spark.sql("SELECT array('Ab','ab ','c','') AS x").select(V.distinct_by("x", lambda s: F.lower(F.trim(s))).alias("d")).first().d
    assert d == ["Ab", "c"]


def test_entities_and_classifier(spark):
    spans = rules.entity_spans("On 3 May 2021 the Kosi River rose; 1,200 people fled landslides.", {"HAZARD": ["land", "landslides"]})
    assert [(s["text"], s["label"]) for s in spans] == [("3 May 2021", "DATE"), ("Kosi River", "RIVER"), ("1,200", "NUMBER"), ("landslides", "HAZARD")]
    df = spark.createDataFrame([("the dam burst and dam water",), ("rain",), (None,)], "t string").withColumn("k", rules.classify("t", {"dam": {"dam": 1.5, "burst": 1.0}, "rain": {"rain": 2.0, "water": 0.5}}))
    assert [r.k.label for r in df.collect()] == ["dam", "rain", None]


def test_entity_forms_and_promotion():
    found = {(s["text"], s["label"]) for s in rules.entity_spans("On 5 Sept. 2020 and Jan 3, two lakh of 4 lakhs crossed the Tungabhadra Nadi, not River Monday; rivers the Mula Mutha.", {})}
    assert {("5 Sept. 2020", "DATE"), ("Jan 3", "DATE"), ("4 lakhs", "NUMBER"), ("Tungabhadra Nadi", "RIVER"), ("rivers the Mula Mutha", "RIVER")} <= found
    assert not any("Monday" in t for t, _ in found)
    text = "Flood on the Teesta Canal"
    place = {"text": "Teesta", "label": "LOCATION", "start": 13, "end": 19, "confidence": 0.9, "source": "model"}
    assert rules.promote_rivers(text, [place]) == [{**place, "label": "RIVER", "text": "Teesta Canal", "end": 25, "source": "rule", "confidence": 0.6}]
    assert rules.promote_rivers("Teesta, a town", [{**place, "start": 0, "end": 6}]) == []


def test_evidence_of_a_cue_that_is_an_expression(spark):
    df = spark.createDataFrame([("Before: the dams burst at night.",)], "t string")
    r = df.select(rules.classify("t", {"dam": {r"dams?\s+burst": 3.0}, "other": {"rain": 1.0}}).alias("k")).first().k
    assert r.label == "dam" and "dams burst" in r.evidence


def test_sentences_of_any_language():
    assert T.sentences_any('Dr. Rao said "Run." Then he left.\nMr. X।  दो। 三。 四！ End') == ['Dr. Rao said "Run.', "Then he left.", "Mr. X।", "दो।", "三。", "四！", "End"]
    assert T.sentences_any("At the end of St.") == ["At the end of St."] and T.sentences_any(None) == []


def test_readings_of_a_place(spark):
    df = spark.createDataFrame([("Lower Assam (Barpeta), Cachar District",), ("Bombay",), ("",), (None,)], "m string")
    got = [[tuple(f) for f in r[0] or []] for r in df.select(grounding.surface_forms("m", {"bombay": "Mumbai"})).collect()]
    assert got[0] == [
        ("lower assam barpeta cachar district", "full"), ("lower assam cachar district", "full"), ("lower assam cachar", "stripped"), ("barpeta", "part"), ("lower assam", "part"), ("cachar district", "part"), ("cachar", "part"),
    ]
    assert got[1] == [("bombay", "full"), ("mumbai", "full")] and got[2] == [] and got[3] == []


def test_batches_of_texts_are_small(spark):
    """However many rows a task has, a function of texts sees few at once, so that its memory does not follow them."""
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sizes = F.pandas_udf(lambda v: v.map(lambda _: len(v)), "int", F.PandasUDFType.SCALAR)
    T.clean_text("text")
    assert spark.range(3000).coalesce(1).select(sizes(F.col("id")).alias("n")).agg(F.max("n")).first()[0] <= 500
