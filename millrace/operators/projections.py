"""Rows and texts made of records: CSV rows, prompts, keys and dates, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import normalize_ascii
from millrace.functions.values import c

# fixed values: the columns of an event's CSV row, in order
EVENT_COLUMNS = (
    "event_id", "n_articles", "date_start", "date_end", "country", "flood_type", "flood_type_confidence", "locations", "cities", "rivers", "causes",
    "severity", "deaths", "injuries", "missing", "displaced", "evacuated_population", "affected_population", "economic_damage", "title",
    "representative_uid", "source_uids",
)
_LISTS = ("locations", "cities", "rivers", "causes")


def event_csv(events: DataFrame) -> DataFrame:
    """PRJ-12: the 22 columns of an event's CSV row; lists are joined, a column that events lacks is null."""
    def one(name: str) -> Column:
        if name not in events.columns:
            return F.lit(None).cast("string").alias(name)
        if name in _LISTS or name == "source_uids":
            return F.coalesce(F.array_join(name, " " if name == "source_uids" else "; "), F.lit("")).alias(name)
        return F.col(name)

    return events.select(*[one(n) for n in EVENT_COLUMNS])


def normalize_date(value: Column | str) -> Column:
    """PRJ-13: the ISO date that a text begins with, else the trimmed text; null if it is blank."""
    v = F.nullif(F.trim(c(value).cast("string")), F.lit(""))
    return F.coalesce(F.nullif(F.regexp_extract(v, r"^(\d{4}-\d{2}-\d{2})", 1), F.lit("")), v)


def resolve_publish_date(articles: DataFrame, dates: DataFrame | None = None, field: str = "publish_date", inline: bool = False) -> DataFrame:
    """PRJ-13: articles with their publication date, inline or from a parallel table (month, article_id, the field); else null."""
    if inline:
        return articles.withColumn("publish_date", normalize_date(field))
    base = articles.drop("publish_date")
    if dates is None:
        return base.withColumn("publish_date", F.lit(None).cast("string"))
    found = dates.select("month", "article_id", normalize_date(field).alias("publish_date"))
    return base.join(found, ["month", "article_id"], "left")


def record_columns(records: DataFrame, title: str = "translated_title", partition: str = "month", passthrough: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-14: the identity columns of a CSV: id, partition (renamed at will), publication date, title, then passthrough fields; missing ones are empty."""
    def one(source: str, name: str) -> Column:
        return (F.coalesce(F.col(source).cast("string"), F.lit("")) if source in records.columns else F.lit("")).alias(name)

    names = [("article_id", "article_id"), ("month", partition), ("publish_date", "publish_date"), (title, title), *((p, p) for p in passthrough)]
    return records.select(*[one(s, n) for s, n in names])


def user_message(title: Column | str, text: Column | str, publish_date: Column | str | None = None, most: int | None = None) -> Column:
    """PRJ-16: what a model is asked: the date if there is one, the title, and the article, cut to `most` characters if given."""
    body = F.coalesce(c(text), F.lit(""))
    body = body if most is None else F.substring(body, 1, most)
    date = F.lit(None).cast("string") if publish_date is None else F.nullif(c(publish_date).cast("string"), F.lit(""))
    header = F.coalesce(F.concat(F.lit("PUBLISHED: "), date, F.lit("\n\n")), F.lit(""))
    return F.concat(header, F.lit("TITLE: "), F.coalesce(c(title), F.lit("")), F.lit("\n\nARTICLE:\n"), body)


def classification_text(title: Column | str, summary: Column | str, causes: Column | str, body: Column | str | None = None, most: int | None = None) -> Column:
    """PRJ-18: title, summary, causes and the body (its first `most` characters if given), a line each; blank ones are left out."""
    head = [] if body is None else [F.array(c(body) if most is None else F.substring(c(body), 1, most))]
    parts = F.concat(F.array(c(title), c(summary)), F.coalesce(c(causes), F.array().cast("array<string>")), *head)
    return F.array_join(F.filter(parts, lambda p: p.isNotNull() & (F.trim(p) != "")), "\n")


def mention_key(mention: Column | str, country: Column | str) -> Column:
    """PRJ-19: the key of a place mention: normalised country and mention, a bar between."""
    return F.concat(normalize_ascii(country), F.lit("|"), normalize_ascii(mention))
