"""Reading article trees: JSON and JSONL discovery, tolerant parsing, ids, languages, months and years."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.values import fill

FIELDS = ("article_id", "id", "url", "title", "author", "publish_date", "language", "text", "status", "http_status", "final_url", "translated_title", "translated_text", "original_title")


def raw_files(spark: SparkSession, root: str, glob: str = "*.json*", folder: str | None = None) -> DataFrame:
    """SRC-1, SRC-4: path and whole text of each file below root, if need be only below a folder of that name."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    return df.where(F.lower("path").rlike(rf"/{re.escape(folder.lower())}/")) if folder else df


def raw_lines(spark: SparkSession, root: str, glob: str = "*.jsonl", folder: str | None = None) -> DataFrame:
    """SRC-3: path, index (from 0 among the lines that are not blank) and text of each line below root.

    Files are split, so a large one is read by many tasks; a line's number comes from where it begins: lines are
    counted per split, and a split starts from the counts of those before it in its file (one row a split).
    """
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root)
    df = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("raw"), F.monotonically_increasing_id().alias("at"))
    df = df.where(F.trim(F.regexp_replace("raw", "^\ufeff", "")) != "")
    df = df.where(F.lower("path").rlike(rf"/{re.escape(folder.lower())}/")) if folder else df
    # within a split lines come in order, and a task numbers its rows upwards
    within = df.withColumn("n", F.row_number().over(Window.partitionBy("path", "split").orderBy("at")))
    sizes = df.groupBy("path", "split").agg(F.count("*").alias("lines"))
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = sizes.select("path", "split", before.alias("before"), F.sum("lines").over(Window.partitionBy("path")).alias("total"))
    out = within.join(start, ["path", "split"])
    return out.select("path", (F.col("before") + F.col("n") - 1).cast("int").alias("index"), F.col("total").cast("int").alias("n"), F.regexp_replace("raw", "^\ufeff", "").alias("raw"))


def _record(raw: Column) -> Column:
    return F.from_json(raw, "map<string,string>")


def articles(spark: SparkSession, root: str, folder: str | None = None) -> DataFrame:
    """SRC-2, SRC-3, SRC-9: path, index, record (map, key order kept), article_id and corrupt of every record.

    A .json file is an object or a list of objects and is read whole; a .jsonl file is read line by line, by many
    tasks if it is large. A byte order mark is skipped. What can't be
    read is a row with corrupt = true, and no error. Without an id the file's stem is the id, with #index
    where a file has several records.
    """
    files = raw_files(spark, root, "*.json", folder)
    body = F.regexp_replace("raw", "^﻿", "")
    items = F.when(F.trim(body).startswith("["), F.coalesce(F.from_json(body, "array<string>"), F.array(body))).otherwise(F.array(body))
    each = files.select("path", F.size(items).alias("n"), F.posexplode(items).alias("index", "raw"))
    each = each.unionByName(raw_lines(spark, root, folder=folder))
    stem = F.regexp_extract("path", r"([^/]+)\.jsonl?$", 1)
    rec = each.withColumn("record", F.when(F.trim("raw").startswith("{"), _record(F.col("raw"))))
    bad = F.col("record").isNull() | ((F.size("record") == 0) & (F.regexp_replace("raw", r"\s", "") != "{}"))
    known = fill(F.try_element_at("record", F.lit("article_id")), F.try_element_at("record", F.lit("id")), F.try_element_at("record", F.lit("articleId")))
    ids = F.coalesce(known, F.when(F.col("n") > 1, F.concat(stem, F.lit("#"), F.col("index").cast("string"))).otherwise(stem))
    return rec.select("path", "index", "record", F.when(~bad, ids).alias("article_id"), bad.alias("corrupt"))


def columns(records: DataFrame, names: tuple[str, ...] = FIELDS) -> DataFrame:
    """The known fields as columns, all others in the map extra."""
    picked = [F.try_element_at("record", F.lit(n)).alias(n) for n in names if n not in ("article_id", "id")]
    return records.where("NOT corrupt").select("path", "article_id", *picked, F.map_filter("record", lambda k, v: ~k.isin(*names)).alias("extra"))


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC-16: malformed lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def count_lines(spark: SparkSession, path: str) -> int:
    """SRC-17."""
    return spark.read.text(path).count()


def event_ids(spark: SparkSession, root: str) -> DataFrame:
    """SRC-5: article_id and its first non-empty title, in the order of files and records."""
    r = articles(spark, root).where("NOT corrupt")
    title = fill(F.try_element_at("record", F.lit("translated_title")), F.try_element_at("record", F.lit("title")))
    order = F.struct(title.isNull().alias("e"), F.col("path"), F.col("index"), title.alias("title"))
    return r.groupBy("article_id").agg(F.min(order)["title"].alias("title"))


def id_index(ids: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-6, JN-1, SET-4: (article_id, path) of ids found among files (path), and the ids that are not."""
    key = F.regexp_extract("path", r"([^/]+/[^/]+)\.json$", 1)
    stem = F.regexp_extract("path", r"([^/]+)\.json$", 1)
    by = files.select("path", key.alias("article_id")).union(files.select("path", stem)).groupBy("article_id").agg(F.min("path").alias("path"))
    return ids.join(by, "article_id"), ids.join(by.select("article_id"), "article_id", "left_anti")


def mentions(extractions: DataFrame, select: str = "verifiable", done: DataFrame | None = None, enrich: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """SRC-12, FLT-2: filter, skip what is done, first of each uid, enrich, limit; in that order.

    extractions: uid, contains_flood_event, is_verifiable_flood, seq (the order of reading), anything else.
    """
    keep = {"all": F.lit(True), "flood": F.col("contains_flood_event"), "verifiable": F.col("is_verifiable_flood")}[select]
    df = extractions.where(F.coalesce(keep, F.lit(False)))
    if done is not None:
        df = df.join(done.select("uid"), "uid", "left_anti")
    w = Window.partitionBy("uid").orderBy("seq")
    df = df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    if enrich is not None:
        df = df.join(enrich, "uid", "left")
    return df.orderBy("seq").limit(limit) if limit is not None else df


def with_bodies(events: DataFrame, bodies: DataFrame) -> DataFrame:
    """SRC-13: events with the body of each uid, null where the file is missing."""
    return events.join(bodies.select("uid", fill("translated_text", "text").alias("body")), "uid", "left")


def year_roots(years: list[int], root: str, overrides: dict[int, str] | None = None) -> dict[int, str]:
    """SRC-14: the folder of each year's articles: root with {year} filled in, or an override."""
    return {y: (overrides or {}).get(y, root.format(year=y)) for y in years}


def missing_bodies(events: DataFrame) -> DataFrame:
    """SRC-14: by year, the events and how many of them have no body."""
    missing = F.sum((F.trim(F.coalesce("body", F.lit(""))) == "").cast("long"))
    return events.groupBy("year").agg(F.count("*").alias("events"), missing.alias("missing"))


def count_events(extractions: DataFrame, select: str = "verifiable") -> int:
    """SRC-15: the number of distinct mentions (uid) of a selection."""
    keep = {"all": F.lit(True), "flood": F.col("contains_flood_event"), "verifiable": F.col("is_verifiable_flood")}[select]
    return extractions.where(F.coalesce(keep, F.lit(False))).select(F.count_distinct("uid")).first()[0]


def select_months(files: DataFrame, months: list[str] | None = None) -> DataFrame:
    """SRC-10: month and path of files below month folders, of some months (2021_07 or 2021-07) or of all, in their order."""
    month = F.replace(F.regexp_extract("path", r"/(\d{4}[_-]\d{2})/", 1), F.lit("-"), F.lit("_"))
    out = files.select(month.alias("month"), "path").where("month <> ''")
    return out.where(F.col("month").isin([m.replace("-", "_") for m in months])) if months else out


def parse_years(tokens: list[str]) -> list[int]:
    """SRC-20, SET-7: 2021, 2019-2024, in order and once each."""
    out: set[int] = set()
    for t in (x for token in tokens for x in token.replace(",", " ").split()):
        lo, _, hi = t.partition("-")
        a, b = int(lo), int(hi or lo)
        if a > b:
            raise ValueError(f"reversed range of years: {t}")
        out |= set(range(a, b + 1))
    return sorted(out)


def month_totals(files: DataFrame) -> DataFrame:
    """SRC-10, SRC-19: files of each month folder."""
    return files.groupBy(F.regexp_extract("path", r"/(\d{4}_\d{2}|\d{4}-\d{2})/", 1).alias("month")).agg(F.count("*").alias("files")).where("month <> ''")


def parse_uid(uid: Column) -> Column:
    """struct(year, month, article_id) of year/month/id or year/id."""
    p = F.split(uid, "/", 3)
    three = F.size(p) == 3
    return F.struct(p[0].alias("year"), F.when(three, p[1]).otherwise("").alias("month"), F.when(three, p[2]).otherwise(F.get(p, F.lit(1))).alias("article_id"))


def scan_languages(spark: SparkSession, root: str, head: int = 4096, folder: str | None = None) -> DataFrame:
    """SRC-7: path and language of each .json file: the field is looked for in the first bytes, then in the whole file.

    Only path, head and (where the head lacks the field) a match of the rest leave the scan; nothing is parsed.
    """
    pattern = r'"language"\s*:\s*(?:"((?:[^"\\\\]|\\\\.)*)"|null)'
    find = lambda x: F.nullif(F.trim(F.regexp_extract(x, pattern, 1)), F.lit(""))
    files = raw_files(spark, root, "*.json", folder)
    first = F.substring("raw", 1, head)
    return files.select("path", F.lower(F.when(first.rlike(pattern), find(first)).otherwise(find(F.col("raw")))).alias("language"))


def extraction_files(paths: DataFrame, years: list[int] | None = None) -> DataFrame:
    """SRC-11: year, month and path of extraction files (.../<year>/<year>_<month>.jsonl), failures left out, in order of year and month."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    parts = paths.select(F.regexp_extract("path", r"/(\d{4})/(\d{4}_\d{2})\.jsonl$", 1).alias("year"), F.regexp_extract("path", r"/(\d{4})/(\d{4}_\d{2})\.jsonl$", 2).alias("month"), "path", name.alias("name"))
    ok = (F.col("year") != "") & ~F.contains("name", F.lit(".failed."))
    out = parts.where(ok).select(F.col("year").cast("int").alias("year"), "month", "path")
    return out.where(F.col("year").isin(years)) if years else out


def discover_years(paths: DataFrame) -> list[int]:
    """SRC-20: the years that name a folder, in order; one row a year reaches the driver."""
    y = F.explode(F.regexp_extract_all("path", F.lit(r"/((?:19|20)\d{2})(?=/)"), F.lit(1)))
    return sorted(int(r.year) for r in paths.select(y.alias("year")).distinct().collect())


# fixed values: countries and states are gazetteer rows of their own, by feature
FEATURES = ("point", "admin", "country")


def read_gazetteer(spark: SparkSession, cities: str, countries: str | None = None, states: str | None = None) -> DataFrame:
    """SRC-18: place_id, name, alternates, country, population, lat, lon and feature of CSV files with a header.

    cities: id, name, alternates (joined by commas), country, population, lat, lon; countries and states: id, name,
    alternates, country, lat, lon. Ids are made unique across the three; rows without a name or place are left out.
    """
    out = None
    for i, (path, feature) in enumerate(zip((cities, states, countries), FEATURES, strict=True)):
        if path is None:
            continue
        df = spark.read.option("header", True).option("escape", '"').csv(path)
        people = F.col("population").try_cast("long") if "population" in df.columns else F.lit(0).cast("long")
        names = F.filter(F.transform(F.split(F.coalesce("alternates", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
        part = df.select(
            (F.col("id").try_cast("long") * 3 + i).alias("place_id"), F.trim("name").alias("name"), names.alias("alternates"), F.upper(F.trim("country")).alias("country"), F.coalesce(people, F.lit(0)).alias("population"),
            F.col("lat").try_cast("double").alias("lat"), F.col("lon").try_cast("double").alias("lon"), F.lit(feature).alias("feature"),
        ).where("place_id IS NOT NULL AND name <> '' AND lat IS NOT NULL AND lon IS NOT NULL")
        out = part if out is None else out.unionByName(part)
    return out
