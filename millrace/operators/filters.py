"""Filters over extraction records: untranslated rows, leaked examples, months, keywords, informative fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import SCRIPTS, detect_script, scalar, guess_language, to_flores
from millrace.functions.values import c, informative, to_number

# fixed values: numbers of the prompt's example, by field
LEAKED = {"affected_people": (15000, 450), "evacuated": (600,), "deaths": (14,), "injured": (82,), "missing": (5,), "livestock_loss": (350,)}


def untranslated(rows: DataFrame, original: str = "original_title", translated: str = "translated_title", home: str = "en") -> DataFrame:
    """FLT-6: rows that a translation left as they were although they are in another language, with flores and bucket.

    bucket is "script" where the script alone tells the language, "latin" where stop words of another language do.
    """
    same = rows.where((F.trim(F.coalesce(original, F.lit(""))) != "") & (F.col(original) == F.coalesce(translated, F.lit(""))))
    by_script = F.create_map(*[F.lit(x) for n, code in SCRIPTS if code for x in (n, code)])
    guess = scalar(lambda t: guess_language(t, least=1), "string")
    found = same.withColumn("_script", F.try_element_at(by_script, detect_script(original))).withColumn("_guess", guess(original))
    flores = F.coalesce("_script", F.when(F.col("_guess") != home, to_flores("_guess")))
    out = found.withColumn("flores", flores).withColumn("bucket", F.when(F.col("_script").isNotNull(), "script").otherwise("latin"))
    return out.where("flores IS NOT NULL").drop("_script", "_guess")


def leaks(values: dict[str, Column] | None = None, leaked: dict[str, tuple[float, ...]] = LEAKED) -> Column:
    """FLT-11: the fields whose value is a number of the prompt's example."""
    values = {k: F.col(k) for k in leaked} if values is None else values
    each = [F.when(to_number(values[k]).isin(*[float(x) for x in nums]), k) for k, nums in leaked.items() if k in values]
    return F.array_compact(F.array(*each))


def in_publish_month(dates: Column | str, month: Column | str) -> Column:
    """FLT-12: whether some date of the flood lies in the month (2021_07 or 2021-07) in which the article came out."""
    m = F.replace(F.coalesce(c(month), F.lit("")), F.lit("_"), F.lit("-"))
    return F.coalesce(F.exists(c(dates), lambda d: F.coalesce(F.startswith(d.cast("string"), m), F.lit(False))), F.lit(False))


def wanted(only_floods: bool = False, only_verifiable: bool = False) -> Column:
    """FLT-13: which CSV rows stay, by the cells contains_flood_event and is_verifiable_flood."""
    ok = F.lit(True)
    if only_verifiable:
        ok = ok & (F.coalesce("is_verifiable_flood", F.lit("")) == "true")
    if only_floods:
        ok = ok & (F.coalesce("contains_flood_event", F.lit("")) == "true")
    return ok


def marquee(keys: list[str], title: Column | str, places: Column | str, values: Column | str) -> Column:
    """FLT-15: whether title, places and scalar values together hold one of the keywords (lower case)."""
    some = lambda x: F.coalesce(F.array_join(c(x), " "), F.lit(""))
    blob = F.lower(F.concat_ws(" ", F.coalesce(c(title), F.lit("")), some(places), some(values)))
    held = F.lit(False)
    for k in keys:
        held = held | F.contains(blob, F.lit(k))
    return held


def informative_fields(event: Column | str) -> Column:
    """ARR-4: a record's fields that say something."""
    return F.map_filter(c(event), lambda _, v: informative(v))


def field_counts(event: Column | str, canonical: list[str]) -> Column:
    """ARR-4, AGG-16: struct(fields, canonical): how many informative fields there are, and how many of these are known names."""
    keys = F.map_keys(informative_fields(event))
    known = F.array(*[F.lit(k) for k in canonical])
    return F.struct(F.size(keys).alias("fields"), F.size(F.array_intersect(keys, known)).alias("canonical"))


def schema_drift(events: DataFrame, event: str, keys: list[str], canonical: list[str]) -> DataFrame:
    """AGG-16: by keys, the values of records, how many names they bear, and the share that bears a known name."""
    names = events.select(*keys, F.explode(F.map_keys(informative_fields(event))).alias("name"))
    out = names.groupBy(*keys).agg(F.count("*").alias("values"), F.count_distinct("name").alias("names"), F.avg(F.col("name").isin(*canonical).cast("double")).alias("canonical_share"))
    return out


def unit_tally(events: DataFrame, event: str) -> DataFrame:
    """AGG-28: field, value (trimmed, lower case) and count of every *_type field of records."""
    each = events.select(F.explode(F.col(event)).alias("field", "value")).where(F.endswith("field", F.lit("_type")) & F.col("value").isNotNull())
    return each.groupBy("field", F.lower(F.trim("value")).alias("value")).agg(F.count("*").alias("n"))


def agency_counts(events: DataFrame, agencies: Column) -> DataFrame:
    """AGG-28: agency and count, over lists of agencies."""
    return events.select(F.explode(agencies).alias("agency")).select(F.trim("agency").alias("agency")).groupBy("agency").agg(F.count("*").alias("n"))
