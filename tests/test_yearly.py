import json

from pyspark.sql import functions as F

from millrace.plans import yearly


def test_a_year_runs_and_goes_on(spark, tmp_path):
    raw, out, calls = tmp_path / "raw", str(tmp_path / "out"), []
    raw.mkdir()
    for i, title in enumerate(["Floods kill ten in Pune", "A flood of tears at the opera", "Heavy flooding displaces thousands", "Markets rise"]):
        (raw / f"{i}.json").write_text(json.dumps({"article_id": str(i), "title": title, "text": f"text {i}", "language": "en", "publish_date": "2021-07-01"}))

    def named(name, f):
        return lambda df: calls.append(name) or f(df)

    events = F.array(F.create_map(F.lit("fatalities"), F.concat(F.lit("1"), "article_id"), F.lit("place"), F.lit("Pune")))
    steps = (
        named("titles", lambda df: df.withColumn("translated_title", F.col("title"))), named("articles", lambda df: df.withColumn("translated_text", F.upper("text"))),
        named("extract", lambda df: df.withColumn("events", F.when(F.col("article_id") == "0", events).otherwise(F.array().cast("array<map<string,string>>")))),
    )
    n = yearly.run_year(spark, str(raw), out, *steps)
    assert n["titles"] == 4 and 1 <= n["filtered"] < 4 and n["csv"] == n["extracted"] == n["filtered"]
    row = spark.read.option("header", True).csv(f"{out}/csv").where("article_id = '0'").first()
    assert row.deaths == "10" and row.place == "Pune" and row.event_index == "0"
    assert spark.read.parquet(f"{out}/english").where("article_id = '0'").first().text == "TEXT 0"
    assert yearly.run_year(spark, str(raw), out, *steps) == n and calls == ["titles", "articles", "extract"]
