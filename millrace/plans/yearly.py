"""CMP-10: one year from raw articles to a CSV, in six steps that each write a folder and can be resumed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.values import fill, fold_slots
from millrace.operators import mentions, rules
from millrace.sources import files, sinks

Step = Callable[[DataFrame], DataFrame]
STEPS = ("titles", "filtered", "articles", "english", "extracted", "csv")


def _done(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def run_year(spark: SparkSession, raw: str, out: str, translate_titles: Step, translate_articles: Step, extract: Step, rules_: rules.TitleRules | None = None, min_fill: int = 1) -> dict[str, int]:
    """Titles translated, filtered by the lexicon, their articles translated, projected, extracted and flattened.

    The three model steps are functions of a DataFrame: translate_titles adds translated_title, translate_articles
    adds translated_text, extract adds events (array of maps). Each step writes out/<step>; one whose folder is
    complete is not run again, so a run that stopped goes on where it was. Returns the rows of each step.
    """
    def step(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{out}/{name}"
        if not _done(spark, path):
            make().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    records = files.columns(files.articles(spark, raw))
    titles = step("titles", lambda: translate_titles(records.select("path", "article_id", "title", "language")))
    load = rules_ or rules.TitleRules.load()
    matched = step("filtered", lambda: titles.withColumn("m", rules.match_title("translated_title", load)).where("m.matched").withColumn("reason", F.col("m.reason")).drop("m"))
    found = step("articles", lambda: translate_articles(records.select("path", "article_id", "text", "publish_date").join(matched.select("path", "article_id", "translated_title"), ["path", "article_id"])))
    english = step("english", lambda: found.select("article_id", F.col("translated_title").alias("title"), fill("translated_text", "text").alias("text"), "publish_date"))
    extracted = step("extracted", lambda: extract(english))
    if not _done(spark, f"{out}/csv"):
        folded = extracted.withColumn("events", F.transform("events", lambda e: fold_slots(e, mentions.ALIASES)))
        names, rare = sinks.flat_columns(folded.select(F.explode("events").alias("fields")), min_fill=min_fill)
        sinks.write_csv(sinks.flatten_events(folded, ["article_id", "title", "publish_date"], names, rare), f"{out}/csv")
    counts = {n: spark.read.parquet(f"{out}/{n}").count() for n in STEPS[:-1]}
    return counts | {"csv": spark.read.option("header", True).csv(f"{out}/csv").count()}
