import json

from millrace.sources import files, sinks


def test_lines_of_a_split_file_keep_their_numbers(spark, tmp_path):
    """A file that many tasks read gives the same indices as one task would."""
    rows = [json.dumps({"title": f"t{i}", "text": "x" * (i % 50)}) for i in range(3000)]
    (tmp_path / "a.jsonl").write_text("﻿" + "\n\n".join(rows) + "\n\nnot json\n", encoding="utf-8")
    (tmp_path / "b.jsonl").write_text(rows[0], encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = files.raw_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 1
        got = {r["index"]: r.raw for r in lines.where("path LIKE '%a.jsonl'").collect()}
        articles = files.articles(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert got == dict(enumerate([*rows, "not json"]))
    ids = {r.article_id for r in articles if not r.corrupt}
    assert ids == {f"a#{i}" for i in range(3000)} | {"b"} and sum(r.corrupt for r in articles) == 1


def test_languages_years_and_extraction_files(spark, tmp_path):
    for i, t in enumerate(['{"language": "EN", "text": "x"}', '{"text": "' + "y" * 6000 + '", "language" : " de "}', '{"language": null}', '{"text": "no"}']):
        (tmp_path / f"{i}.json").write_text(t)
    got = {r.path.rsplit("/", 1)[1]: r.language for r in files.scan_languages(spark, str(tmp_path)).collect()}
    assert got == {"0.json": "en", "1.json": "de", "2.json": None, "3.json": None}
    paths = spark.createDataFrame([(f"/d/{p}",) for p in ("2021/2021_07.jsonl", "2021/2021_07.failed.jsonl", "2022/2022_01.jsonl", "2022/notes.txt", "x/2023_01.jsonl")], "path string")
    assert sorted(tuple(r)[:2] for r in files.extraction_files(paths).collect()) == [(2021, "2021_07"), (2022, "2022_01")]
    assert files.extraction_files(paths, [2022]).count() == 1 and files.discover_years(paths) == [2021, 2022]


def test_gazetteer(spark, tmp_path):
    (tmp_path / "c.csv").write_text('id,name,alternates,country,population,lat,lon\n1,Pune,"Poona, Puna",in,3000000,18.5,73.8\n2,,x,in,1,1,1\n3,Nowhere,,in,,bad,1\n')
    (tmp_path / "s.csv").write_text("id,name,alternates,country,lat,lon\n1,Goa,,IN,15.3,74.0\n")
    rows = {r.name: r for r in files.read_gazetteer(spark, str(tmp_path / "c.csv"), states=str(tmp_path / "s.csv")).collect()}
    assert set(rows) == {"Pune", "Goa"} and rows["Pune"].alternates == ["Poona", "Puna"] and rows["Pune"].country == "IN"
    assert rows["Goa"].feature == "admin" and rows["Goa"].place_id != rows["Pune"].place_id and rows["Goa"].population == 0


def test_months_are_written_whole(spark, tmp_path):
    df = spark.range(200).selectExpr("id", "IF(id < 180, '2021_07', '2021_08') AS month")
    sinks.write_months(df, str(tmp_path / "m"))
    back = spark.read.json(str(tmp_path / "m"))
    assert back.count() == 200 and back.where("month = '2021_08'").count() == 20


def test_journals_indexes_and_selections(spark, tmp_path):
    journal = spark.createDataFrame([("a", "failed", 1), ("a", "done", 2), ("a", "done", 3), ("b", "failed", 1)], "article_id string, status string, seq int")
    assert {tuple(r) for r in sinks.status_counts(journal).collect()} == {("done", 1), ("failed", 1)}
    index = spark.createDataFrame([("a", [1.0], "x"), ("b", [2.0], "y")], "uid string, embedding array<double>, title string")
    new = spark.createDataFrame([("b", [3.0]), ("c", None)], "uid string, embedding array<double>")
    both = sinks.upsert(index, new)
    assert sorted((r.uid, r.embedding, r.title) for r in both.collect()) == [("a", [1.0], "x"), ("b", [3.0], None), ("c", None, None)]
    assert sinks.export_matrix(both, str(tmp_path / "m")) == 2
    sinks.write_csv(index.select("uid", "title"), str(tmp_path / "csv"), bom=True)
    assert next((tmp_path / "csv").glob("part*")).read_bytes().startswith(b"\xef\xbb\xbfuid")
    paths = spark.createDataFrame([("/r/2021_07/a.json",), ("/r/2021-08/b.json",), ("/r/x/c.json",)], "path string")
    assert files.select_months(paths).count() == 2 and files.select_months(paths, ["2021-07"]).first().month == "2021_07"
    assert files.year_roots([2021, 2022], "/d/{year}", {2022: "/e"}) == {2021: "/d/2021", 2022: "/e"}
    ev = spark.createDataFrame([("u", 2021, True, False, None), ("u", 2021, True, True, "b"), ("v", 2022, True, True, " ")], "uid string, year int, contains_flood_event boolean, is_verifiable_flood boolean, body string")
    assert (files.count_events(ev), files.count_events(ev, "all")) == (2, 2)
    assert sorted(tuple(r) for r in files.missing_bodies(ev).collect()) == [(2021, 2, 1), (2022, 1, 1)]
