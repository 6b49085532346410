"""Extraction records as event mentions, and mentions as events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions import values as V
from millrace.operators.relational import first_by, ranked
from millrace.operators.vector import UNKNOWN_TYPE, medoids

# fixed values: names that models invent for a slot, and the slot they mean
ALIASES = {
    "description": "summary", "date": "event_date", "flood_date": "event_date", "flood_cause": "cause", "flood_depth": "water_depth", "death_toll": "deaths", "total_deaths": "deaths", "number_of_deaths": "deaths",
    "num_deaths": "deaths", "fatalities": "deaths", "people_dead": "deaths", "missing_people": "missing", "people_missing": "missing", "injured_people": "injured", "people_injured": "injured",
    "people_displaced": "displaced", "displaced_people": "displaced", "people_evacuated": "evacuated", "evacuated_people": "evacuated", "people_affected": "affected_people", "affected": "affected_people",
    "houses_damaged_count": "houses_damaged", "homes_damaged": "houses_damaged", "homes_destroyed": "houses_destroyed",
}
COUNTS = ("deaths", "missing", "injured", "displaced", "evacuated", "affected_people", "houses_damaged", "houses_destroyed", "rainfall_mm")
SCHEMA = "struct<contains_flood_event:boolean,flood_dates:array<string>,is_verifiable_flood:boolean,flooded_locations:array<string>,events:array<map<string,string>>>"


def slot_values(events: Column, *keys: str) -> Column:
    """PRJ-10: the values of slots over all sub-events, distinct by their normalised form, first spelling kept."""
    each = F.flatten(F.transform(events, lambda e: F.array_compact(F.array(*[F.try_element_at(e, F.lit(k)) for k in keys]))))
    return V.distinct_by(F.flatten(F.transform(each, V.as_list)), lambda x: T.normalize_ascii(x))


def mention_rows(records: DataFrame, year: str = "year") -> DataFrame:
    """PRJ-2, PRJ-3, PRJ-11, AGG-7: uid, flags, dates, places, rivers, causes and counts (-1: unknown) of records.

    records: year, month, article_id, translated_title, publish_date, extraction (JSON text).
    """
    r = records.withColumn("x", F.from_json("extraction", SCHEMA))
    folded = F.transform(F.coalesce("x.events", F.array().cast("array<map<string,string>>")), lambda e: V.fold_slots(e, ALIASES))
    r = r.withColumn("slots", folded)
    dates = F.concat(F.coalesce("x.flood_dates", F.array().cast("array<string>")), slot_values(F.col("slots"), "event_date", "start_date", "end_date"))
    parsed = F.array_sort(F.array_distinct(F.array_compact(F.transform(dates, V.parse_iso))))
    counts = [_count(k) for k in COUNTS]
    return r.select(
        F.concat_ws("/", year, "month", "article_id").alias("uid"), "article_id", F.col("translated_title").alias("title"), F.coalesce("x.contains_flood_event", F.lit(False)).alias("contains_flood_event"),
        F.coalesce("x.is_verifiable_flood", F.lit(False)).alias("is_verifiable_flood"), parsed.alias("dates"), F.array_min(parsed).alias("date_min"), F.array_max(parsed).alias("date_max"),
        V.distinct_by(F.concat(F.coalesce("x.flooded_locations", F.array().cast("array<string>")), slot_values(F.col("slots"), "location", "district", "state")), lambda x: T.normalize_ascii(x)).alias("places"),
        slot_values(F.col("slots"), "river", "water_body", "dam").alias("rivers"), slot_values(F.col("slots"), "cause").alias("causes"), F.get(slot_values(F.col("slots"), "country"), F.lit(0)).alias("country"),
        F.array_join(slot_values(F.col("slots"), "summary"), " ").alias("summary"), *counts,
    )


def _count(key: str) -> Column:
    values = F.transform("slots", lambda e: V.to_number(F.try_element_at(e, F.lit(key))))
    return F.coalesce(F.array_max(values), F.lit(-1.0)).alias(key)


def embedding_text(type_: Column | str | None = None) -> Column:
    """PRJ-8: what an embedding model sees of a mention: title, summary and labelled parts, each without its last full stops."""
    def part(label: str, value: Column) -> Column:
        return F.when(F.coalesce(value, F.lit("")) != "", F.regexp_replace(F.concat(F.lit(label), value), r"\.+$", ""))

    def some(name: str, n: int, by: str = "; ") -> Column:
        return F.array_join(F.slice(F.col(name).cast("array<string>"), 1, n), by)

    kind = F.col("flood_type") if type_ is None else F.col(type_) if isinstance(type_, str) else type_
    title = F.regexp_replace(F.trim(F.coalesce("title", F.lit(""))), r"\.+$", "")
    return F.concat_ws(
        ". ", F.when(F.trim(F.coalesce("title", F.lit(""))) != "", title), part("", F.col("summary")), part("Flooded: ", some("places", 12)), part("River: ", some("rivers", 6)),
        part("Country: ", F.col("country")), part("Flood type: ", F.nullif(kind, F.lit(UNKNOWN_TYPE))), part("Date: ", some("dates", 6, ", ")), part("Cause: ", some("causes", 4)),
    )


def index_metadata(mentions: DataFrame) -> DataFrame:
    """PRJ-9: flat metadata without nulls: missing counts -1, missing texts empty, lists joined.

    mentions: uid, year, month, article_id, publish_date, title, country, city, places, rivers, dates (sorted),
    flood_type, flood_type_confidence, flood_type_evidence, n_events, verifiable, contains_flood and the counts.
    """
    text = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(""))
    some = lambda x, n: F.coalesce(F.array_join(F.slice(x, 1, n), "; "), F.lit(""))
    day = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    first, last = F.get("dates", F.lit(0)), F.try_element_at("dates", F.lit(-1))
    return mentions.select(
        "uid", F.col("year").cast("int").alias("year"), *[text(x).alias(x) for x in ("month", "article_id", "publish_date")],
        day(first).alias("event_date"), day(first).alias("date_min"), day(last).alias("date_max"), text("country").alias("country"), text("city").alias("city"),
        some("places", 20).alias("locations"), F.coalesce(F.size("places"), F.lit(0)).alias("n_locations"), some("rivers", 10).alias("rivers"),
        F.coalesce("flood_type", F.lit(UNKNOWN_TYPE)).alias("flood_type"), F.coalesce(F.col("flood_type_confidence").cast("double"), F.lit(0.0)).alias("flood_type_confidence"),
        F.substring(text("flood_type_evidence"), 1, 300).alias("flood_type_evidence"), F.coalesce("n_events", F.lit(0)).alias("n_events"),
        *[F.coalesce(x, F.lit(False)).alias(x) for x in ("verifiable", "contains_flood")], F.substring(text("title"), 1, 300).alias("title"),
        *[F.coalesce(k, F.lit(-1.0)).alias(k) for k in COUNTS],
    )


# fixed values: severity bands by the least deaths and the least people affected
BANDS = [("catastrophic", 100, 1_000_000), ("major", 20, 100_000), ("moderate", 3, 10_000), ("minor", 0, 0)]


def build_events(mentions: DataFrame, clusters: DataFrame, vectors: DataFrame | None = None, bands=BANDS) -> DataFrame:
    """CMP-1, AGG-6, AGG-8, AGG-9, AGG-10: one event a cluster, disagreements kept, event_id by size then first member.

    mentions: uid, id (the order), title, country, dates, places, rivers and counts; clusters: id, cluster.
    """
    m = mentions.join(clusters, "id")
    known = lambda k: F.when(F.col(k) >= 0, F.col(k))
    counts = [F.struct(F.coalesce(F.max(known(k)), F.lit(-1.0)).alias("value"), F.min(known(k)).alias("min"), F.max(known(k)).alias("max"), F.count(known(k)).alias("reports"), (F.count_distinct(known(k)) > 1).alias("conflict")).alias(k) for k in COUNTS]
    union = lambda x: V.distinct_by(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("id", x))), lambda s: s[x])), lambda v: T.normalize_ascii(v)).alias(x)
    events = m.groupBy("cluster").agg(F.count("*").alias("n_articles"), F.min("id").alias("first"), F.min("date_min").alias("date_min"), F.max("date_max").alias("date_max"), union("places"), union("rivers"), *counts)
    country = first_by(m.where("country IS NOT NULL AND country <> ''").groupBy("cluster", "country").agg(F.count("*").alias("n")), ["cluster"], F.desc("n"), "country").select("cluster", "country")
    out = events.join(country, "cluster", "left")
    if vectors is not None:
        out = out.join(medoids(vectors.join(clusters, "id")).select("cluster", "medoid"), "cluster", "left")
    d, a = F.when(F.col("deaths.value") >= 0, F.col("deaths.value")), F.when(F.col("affected_people.value") >= 0, F.col("affected_people.value"))
    out = out.withColumn("severity", V.severity(d, a, bands))
    # the rank of an event is its place in one global order: events are few beside mentions, and only their keys are ranked
    order = ranked(out.select("cluster", "n_articles", "first"), F.desc("n_articles"), "first")
    year = F.coalesce(F.year("date_min").cast("string"), F.lit("0000"))
    return out.join(order.select("cluster", "rank"), "cluster").withColumn("event_id", F.format_string("E-%s-%06d", year, F.col("rank")))


def conflict_rates(events: DataFrame) -> DataFrame:
    """AGG-23: by slot, the share of events with two reports or more that disagree."""
    each = events.select(F.explode(F.array(*[F.struct(F.lit(k).alias("slot"), F.col(f"{k}.reports").alias("reports"), F.col(f"{k}.conflict").alias("conflict")) for k in COUNTS])).alias("s")).select("s.*")
    return each.where("reports >= 2").groupBy("slot").agg(F.count("*").alias("events"), F.avg(F.col("conflict").cast("double")).alias("conflict_rate"))
