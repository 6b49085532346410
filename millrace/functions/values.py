"""Numbers, dates, lists and small string functions as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = "January February March April May June July August September October November December".split()


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# numbers


def to_number(value: Column | str, default: float | None = None) -> Column:
    """NUM-1: the first number in a text, thousands separators removed; booleans and texts without one give default."""
    v = c(value).cast("string")
    found = F.regexp_replace(F.regexp_extract(v, r"-?\d[\d,]*(?:\.\d+)?", 0), ",", "").try_cast("double")
    return F.when(v.isNull() | F.lower(v).isin("true", "false"), F.lit(default).cast("double")).otherwise(F.coalesce(found, F.lit(default).cast("double")))


def as_number(value: Column | str) -> Column:
    """NUM-2: struct(value, clean): clean if the text is nothing but a number, a leading + and separators included."""
    v = F.trim(c(value).cast("string"))
    bare = F.regexp_replace(F.regexp_replace(v, r"^\+", ""), ",", "")
    return F.struct(to_number(v).alias("value"), F.coalesce(bare.rlike(r"^-?\d+(\.\d+)?$"), F.lit(False)).alias("clean"))


def unhuman(s: Column | str) -> Column:
    """STR-26: 12.3k, 4M, 1.5B as numbers."""
    v = F.lower(F.trim(c(s)))
    scale = F.when(v.endswith("k"), 1e3).when(v.endswith("m"), 1e6).when(v.endswith("b"), 1e9).otherwise(1.0)
    return F.regexp_replace(v, r"[kmb,]", "").try_cast("double") * scale


def human_count(n: Column | str) -> Column:
    """NUM-5: 999, 12.3k, 4.0M."""
    v = c(n).cast("double")
    return F.when(v < 1e3, F.format_string("%d", v.cast("long"))).when(v < 1e6, F.format_string("%.1fk", v / 1e3)).otherwise(F.format_string("%.1fM", v / 1e6))


def human_duration(seconds: Column | str) -> Column:
    """NUM-5: 1h02m03s, 2m03s, 3s."""
    s = c(seconds).cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.format_string("%dh%02dm%02ds", h, m, r)).when(m > 0, F.format_string("%dm%02ds", m, r)).otherwise(F.format_string("%ds", r))


def severity(deaths: Column | str, affected: Column | str, bands: list[tuple[str, float, float]]) -> Column:
    """AGG-10: the first band (name, least deaths, least affected) that either figure reaches; null if both are unknown."""
    d, a = c(deaths), c(affected)
    out = F.when(d.isNull() & a.isNull(), F.lit(None).cast("string"))
    for name, least_d, least_a in bands:
        out = out.when((d >= least_d) | (a >= least_a), name)
    return out


def bucket(x: Column | str, limits: list[float], labels: list[str]) -> Column:
    """AGG-3: the label of the first limit that is not exceeded; the last label is for what exceeds all."""
    out = reduce(lambda w, kv: w.when(c(x) <= kv[0], kv[1]), zip(limits, labels, strict=False), F.when(F.lit(False), ""))
    return F.when(c(x).isNull(), None).otherwise(out.otherwise(labels[-1]))


# dates


def parse_iso(value: Column | str) -> Column:
    """DAT-1: the date that a text begins with, null if it is none."""
    v = c(value).cast("string")
    return F.when(v.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(v, 1, 10), "yyyy-MM-dd"))


def date_quality(value: Column | str) -> Column:
    """AGG-13: missing, valid, partial (month or day 00), impossible or not-iso."""
    v = c(value)
    shape = v.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return (
        F.when(v.isNull(), "missing").when(~shape, "not-iso").when(v.rlike(r"-00"), "partial")
        .when(F.try_to_date(v, "yyyy-MM-dd").isNull(), "impossible").otherwise("valid")
    )


def date_gap(a_min: Column, a_max: Column, b_min: Column, b_max: Column) -> Column:
    """DAT-3: days between two closed intervals, 0 if they meet, null if either is unknown."""
    return F.greatest(F.datediff(b_min, a_max), F.datediff(a_min, b_max), F.lit(0)) + F.when(a_min.isNull() | a_max.isNull() | b_min.isNull() | b_max.isNull(), F.lit(None).cast("int")).otherwise(0)


def date_proximity(gap: Column, window: int = 7, unknown: float = 0.35) -> Column:
    """DAT-4: 1 at no gap, falling to 0 at the window."""
    return F.when(gap.isNull(), F.lit(unknown)).otherwise(F.greatest(F.lit(0.0), 1 - gap / F.lit(float(window))))


def date_surface_forms(d: Column | str) -> Column:
    """DAT-2: twelve ways in which a date is written."""
    forms = ["yyyy-MM-dd", "d MMMM yyyy", "MMMM d, yyyy", "MMMM d yyyy", "d MMM yyyy", "MMM d, yyyy", "d MMMM", "MMMM d", "d MMM", "MMM d", "dd/MM/yyyy", "MM/dd/yyyy"]
    return F.array_distinct(F.array(*[F.date_format(c(d), f) for f in forms]))


def month_label(article_id: Column | str, stem: Column | str) -> Column:
    """DAT-6: the month folder that an id begins with, else the stem of its file."""
    m = F.regexp_extract(c(article_id), r"^(\d{4}_\d{2})[/\\]", 1)
    return F.coalesce(F.nullif(m, F.lit("")), c(stem))


# lists, maps and texts


def as_list(value: Column | str) -> Column:
    """ARR-1: a text or a JSON list of texts as an array of trimmed, non-empty texts."""
    v = F.trim(c(value))
    items = F.when(v.startswith("["), F.coalesce(F.from_json(v, "array<string>"), F.array(v))).otherwise(F.array(v))
    return F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def split_semi(value: Column | str) -> Column:
    """ARR-3: the parts of a list joined by semicolons."""
    return F.filter(F.transform(F.split(F.coalesce(c(value), F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")


def distinct_by(values: Column | str, key) -> Column:
    """ARR-2: distinct by a key of each element, the first spelling stays, in order; elements with an empty key go."""
    pairs = F.transform(c(values), lambda x: F.struct(key(x).alias("k"), x.alias("v")))
    kept = F.filter(pairs, lambda p, i: (p["k"] != "") & (F.array_position(F.transform(pairs, lambda q: q["k"]), p["k"]) == i + 1))
    return F.transform(kept, lambda p: p["v"])


def fold_slots(event: Column | str, aliases: dict[str, str], canonical_first: bool = False) -> Column:
    """PRJ-3 and PRJ-4: rename alias keys of a map; of keys that meet, the first with a value wins (or the canonical one).

    Key order is that of the source, so maps must come from from_json, which keeps it.
    """
    table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    e = F.filter(F.map_entries(c(event)), lambda kv: kv["value"].isNotNull() & (F.trim(kv["value"]) != ""))
    named = F.transform(e, lambda kv: F.struct(F.coalesce(F.try_element_at(table, kv["key"]), kv["key"]).alias("key"), kv["value"].alias("value"), F.try_element_at(table, kv["key"]).isNotNull().alias("alias")))
    if canonical_first:
        named = F.concat(F.filter(named, lambda x: ~x["alias"]), F.filter(named, lambda x: x["alias"]))
    keys = F.transform(named, lambda x: x["key"])
    first = F.filter(named, lambda x, i: F.array_position(keys, x["key"]) == i + 1)
    return F.map_from_entries(F.transform(first, lambda x: F.struct(x["key"], x["value"])))


PLACEHOLDERS = ("", "none", "null", "n/a", "na", "unknown", "not specified", "not mentioned", "unspecified", "-", "[]", "{}")


def informative(value: Column | str) -> Column:
    """FLT-10: neither null nor a placeholder."""
    return F.coalesce(~F.lower(F.trim(c(value).cast("string"))).isin(*PLACEHOLDERS), F.lit(False))


def fill(primary: Column | str, *others: Column | str) -> Column:
    """PRJ-1 and PRJ-17: the first that is not blank."""
    return F.coalesce(*[F.when(F.trim(c(x)) != "", c(x)) for x in (primary, *others)])


def cell(value: Column, kind: str, sep: str = "; ") -> Column:
    """PRJ-6: a CSV cell: nulls empty, booleans true/false, lists joined, nested values as JSON."""
    if kind == "boolean":
        return F.when(value.isNull(), "").when(value, "true").otherwise("false")
    if kind == "array<string>":
        return F.coalesce(F.array_join(value, sep), F.lit(""))
    if kind.startswith(("array", "map", "struct")):
        return F.coalesce(F.to_json(value), F.lit(""))
    return F.coalesce(value.cast("string"), F.lit(""))


def error_class(message: Column | str) -> Column:
    """STR-23: paths and digits masked, 180 characters."""
    return F.substring(F.regexp_replace(F.regexp_replace(c(message), r"(?:[A-Za-z]:)?(?:[\\/][\w.-]+){2,}", "<path>"), r"\d+", "N"), 1, 180)


def json_salvage(raw: Column | str) -> Column:
    """STR-22: the JSON object within a reply: inside a fence, else between the outermost braces, else null."""
    fenced = F.nullif(F.regexp_extract(c(raw), r"(?s)```(?:json)?\s*(\{.*\})\s*```", 1), F.lit(""))
    braces = F.nullif(F.regexp_extract(c(raw), r"(?s)\{.*\}", 0), F.lit(""))
    return F.coalesce(fenced, braces)


def log_fields(line: Column | str) -> Column:
    """STR-25: what a progress line says: struct(kind, block, chunks, seconds)."""
    v = c(line)
    num = lambda p: F.nullif(F.regexp_extract(v, p, 1), F.lit("")).try_cast("double")
    kind = F.when(v.rlike(r"(?i)\bout of memory|\boom\b"), "oom").when(v.rlike(r"(?i)block \d+.*\bdone\b"), "done").when(v.rlike(r"(?i)block \d+"), "plan").otherwise("other")
    return F.struct(kind.alias("kind"), num(r"(?i)block (\d+)").alias("block"), num(r"(\d+) chunks").alias("chunks"), num(r"([\d.]+)\s?s\b").alias("seconds"))


def contains_quote(evidence: Column | str, quote: Column | str) -> Column:
    """STR-27: whether the evidence holds the quote, whatever the case."""
    return F.contains(F.lower(c(evidence)), F.lower(F.trim(c(quote)))) & (F.trim(c(quote)) != "")


def event_problems(counts: tuple[str, ...] = ("counts",)) -> Column:
    """FLT-14: what is wrong with the structure of an event row, in order; an empty list is a well-formed row.

    The row has event_id, source_uids (array), n_articles, date_start, date_end, deaths, affected_population,
    flood_type_confidence and, for each of counts, a struct with min and max.
    """
    n = F.coalesce(F.size("source_uids"), F.lit(0))
    texts = lambda *xs: F.concat(*[x.cast("string") if isinstance(x, Column) else F.lit(x) for x in xs])
    bad = [
        (F.coalesce("event_id", F.lit("")) == "", F.lit("missing event_id")),
        (n == 0, F.lit("no source_uids: an event with no article is not evidence of anything")),
        (F.col("n_articles") != n, texts("n_articles=", F.col("n_articles"), " but ", n, " source_uids")),
        (F.col("date_start") > F.col("date_end"), F.lit("date_start after date_end")),
        *[(F.col(f"{k}.min") > F.col(f"{k}.max"), texts(f"{k}: min ", F.col(f"{k}.min"), " > max ", F.col(f"{k}.max"))) for k in counts],
        *[(F.col(k) < 0, F.lit(f"{k} is negative")) for k in ("deaths", "affected_population")],
        (~F.col("flood_type_confidence").between(0, 1), F.lit("flood_type_confidence outside [0, 1]")),
    ]
    return F.array_compact(F.array(*[F.when(b, msg) for b, msg in bad]))


def implausible(limits: dict[str, float]) -> Column:
    """FLT-16: struct(field, value) of every field whose value reaches its limit, in the order of limits."""
    each = [F.when(F.col(k).cast("double") >= v, F.struct(F.lit(k).alias("field"), F.col(k).cast("double").alias("value"))) for k, v in limits.items()]
    return F.array_compact(F.array(*each))
