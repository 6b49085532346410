"""Grounding of extracted values in their texts, and geocoding against a gazetteer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import normalize_ascii, number_surface_forms
from millrace.functions.values import c, date_surface_forms
from millrace.operators.relational import first_by

STOP = "the a an of in on at and to for by from".split()


def find_any(text: Column, forms: Column) -> Column:
    """The first form that the text holds as whole words, whatever the case; null if none."""
    t = F.lower(text)
    held = F.filter(forms, lambda f: F.regexp_like(t, F.concat(F.lit(r"(?<![\p{L}\d])\Q"), F.lower(f), F.lit(r"\E(?![\p{L}\d])"))))
    return F.get(held, F.lit(0))


def token_support(text: Column, phrase: Column) -> Column:
    """STR-28: the share of a phrase's words that the text holds."""
    words = F.filter(F.array_distinct(F.regexp_extract_all(F.lower(phrase), F.lit(r"[\p{L}\d]+"), F.lit(0))), lambda w: ~w.isin(STOP) & (F.length(w) > 1))
    held = F.filter(words, lambda w: F.array_contains(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\d]+"), F.lit(0)), w))
    return F.when(F.size(words) > 0, F.size(held) / F.size(words)).otherwise(0.0)


def ground(assertions: DataFrame, ratio: float = 0.6, window: int = 160, head: int | None = None) -> DataFrame:
    """CMP-3, DAT-5: grounded, method, token_ratio and evidence of assertions (uid, field, kind number/date/text, value, text), in the first `head` characters if it is given.

    With a column publish_date, a date that the text does not state but whose weekday it names, within a week of
    publication, has the method weekday_relative: it is still not grounded.
    """
    text = F.col("text") if head is None else F.substring("text", 1, head)
    forms = (
        F.when(F.col("kind") == "number", number_surface_forms(F.col("value").try_cast("double")))
        .when(F.col("kind") == "date", date_surface_forms(F.try_to_date("value", "yyyy-MM-dd"))).otherwise(F.array("value"))
    )
    out = assertions.withColumn("form", find_any(text, F.filter(forms, lambda f: F.trim(f) != "")))
    share = F.when(F.col("kind") == "text", token_support(text, F.col("value"))).otherwise(F.lit(0.0))
    out = out.withColumn("token_ratio", share)
    method = F.when(F.col("form").isNotNull(), "exact").when(F.col("token_ratio") >= ratio, "tokens").otherwise("none")
    at = F.instr(F.lower(text), F.lower(F.coalesce("form", F.get(F.split("value", " "), F.lit(0)))))
    near = F.when(at > 0, F.substring(text, F.greatest(at - window // 2, F.lit(1)), F.lit(window)))
    out = out.withColumns({"method": method, "grounded": method != "none", "evidence": F.when(method != "none", near)}).drop("form")
    if "publish_date" not in assertions.columns:
        return out
    day = F.try_to_date("value", "yyyy-MM-dd")
    relative = (F.col("kind") == "date") & (F.col("method") == "none") & weekday_relative(text, day, F.try_to_date(F.col("publish_date").cast("string"), "yyyy-MM-dd"))
    return out.withColumn("method", F.when(relative, "weekday_relative").otherwise(F.col("method")))


def weekday_relative(text: Column, day: Column, published: Column, days: int = 7) -> Column:
    """DAT-5: whether a text names the weekday of a date that lies within so many days of its publication."""
    named = F.regexp_like(F.lower(text), F.concat(F.lit(r"\b"), F.lower(F.date_format(day, "EEEE")), F.lit(r"\b")))
    return F.coalesce(named & (F.abs(F.datediff(published, day)) <= days), F.lit(False))


def support_rates(grounded: DataFrame) -> DataFrame:
    """AGG-18: by field the share that is grounded and the mean token ratio."""
    return grounded.groupBy("field").agg(F.count("*").alias("n"), F.avg(F.col("grounded").cast("double")).alias("support"), F.avg("token_ratio").alias("mean_ratio"))


def grounding_summary(grounded: DataFrame, agreement: DataFrame | None = None) -> DataFrame:
    """AGG-18: one row of articles, mean_ratio (of each article's grounded share), fully_grounded and agreement.

    agreement: uid and agrees (whether an entity tagger found what a slot says); without it the share is null.
    """
    per = grounded.groupBy("uid").agg(F.avg(F.col("grounded").cast("double")).alias("share"))
    out = per.agg(F.count("*").alias("articles"), F.avg("share").alias("mean_ratio"), F.avg((F.col("share") == 1).cast("double")).alias("fully_grounded"))
    if agreement is None:
        return out.withColumn("agreement", F.lit(None).cast("double"))
    return out.join(F.broadcast(agreement.agg(F.avg(F.col("agrees").cast("double")).alias("agreement"))))  # one row


def resolution_rates(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """AGG-19: shares of uids with any and with all places resolved (one row), and resolved places by feature.

    places: uid, status, feature.
    """
    ok = F.col("status") == "resolved"
    per = places.groupBy("uid").agg(F.bool_or(ok).alias("any"), F.bool_and(ok).alias("all"))
    rate = lambda x: F.avg(F.col(x).cast("double")).alias(x)
    return per.agg(F.count("*").alias("uids"), rate("any"), rate("all")), places.where(ok).groupBy("feature").agg(F.count("*").alias("n"))


# fixed values: administrative words that a place may be found without
STRIPPED = "district province state city county region municipality village town prefecture department governorate".split()


def surface_forms(mention: Column | str, aliases: dict[str, str] | None = None, stripped: list[str] = STRIPPED) -> Column:
    """STR-21: array of struct(form, kind): ever freer readings of a place, each normalised and once, the earliest first.

    full: the mention, its alias, the mention without brackets; stripped: without administrative words; part: what
    brackets hold, parts between commas, slashes and semicolons, these stripped; caps: runs of capitalised words,
    the longest first.
    """
    m = F.trim(c(mention))
    outer = F.regexp_replace(m, r"\([^)]*\)", " ")
    key = normalize_ascii(m)
    alias = F.lit(None).cast("string")
    if aliases:
        alias = F.try_element_at(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]), key)
    bare = lambda x: F.array_join(F.filter(F.split(normalize_ascii(x), " "), lambda w: ~w.isin(*stripped)), " ")
    form = lambda x, kind: F.struct(normalize_ascii(x).alias("form"), F.lit(kind).alias("kind"))
    parts = F.flatten(F.transform(F.split(outer, r"[,/;]"), lambda p: F.array(form(p, "part"), form(bare(p), "part"))))
    runs = F.regexp_extract_all(outer, F.lit(r"\p{Lu}[\p{L}\p{N}_'-]+(?:\s+\p{Lu}[\p{L}\p{N}_'-]+)*"), F.lit(0))
    longest = F.transform(F.array_sort(F.transform(runs, lambda r, i: F.struct((-F.length(r)).alias("n"), i.alias("i"), r.alias("r")))), lambda x: x["r"])
    forms = F.concat(
        F.array(form(m, "full"), form(F.coalesce(alias, F.lit("")), "full"), form(outer, "full"), form(bare(outer), "stripped")),
        F.transform(F.regexp_extract_all(m, F.lit(r"\(([^)]*)\)"), F.lit(1)), lambda x: form(x, "part")), parts, F.transform(longest, lambda x: form(x, "caps")),
    )
    # the list is worked out once, then each form is looked up among those before it
    once = F.get(F.transform(F.array(forms), lambda fs: F.filter(fs, lambda f, i: F.array_position(F.transform(fs, lambda g: g["form"]), f["form"]) == i + 1)), F.lit(0))
    return F.filter(once, lambda f: f["form"] != "")


def geocode(mentions: DataFrame, gazetteer: DataFrame, ratio: float = 5.0, aliases: dict[str, str] | None = None) -> DataFrame:
    """CMP-4, JN-9: status, place_id, lat and lon of mentions (mention, country).

    gazetteer: place_id, name, alternates (array), country, population, lat, lon, feature (point, admin,
    country). The first form with candidates wins, primary names before alternates; a known country narrows
    them, and if it leaves none the next form is tried. One candidate, or one with `ratio` times the people
    of the next, is resolved. Countries and states answer to full and stripped forms only.
    """
    names = gazetteer.select("*", F.explode(F.concat(F.array(F.struct(F.lit(0).alias("rank"), normalize_ascii("name").alias("form"))), F.transform("alternates", lambda a: F.struct(F.lit(1).alias("rank"), normalize_ascii(a).alias("form"))))).alias("n"))
    names = names.select("place_id", "country", "population", "lat", "lon", "feature", "n.rank", "n.form").withColumnRenamed("country", "place_country")
    asked = mentions.select("mention", "country").distinct()
    forms = asked.select("mention", "country", F.posexplode(surface_forms("mention", aliases)).alias("at", "f")).select("mention", "country", "at", "f.form", "f.kind")
    hits = forms.join(names, "form").where((F.col("feature") == "point") | F.col("kind").isin("full", "stripped"))
    hits = hits.where(F.col("country").isNull() | (F.col("country") == "") | (F.col("place_country") == F.col("country")))
    key = Window.partitionBy("mention", "country")
    first = hits.withColumn("best", F.min(F.struct("at", "rank")).over(key)).where(F.struct("at", "rank") == F.col("best"))
    first = first.dropDuplicates(["mention", "country", "place_id"])
    w = key.orderBy(F.desc("population"), "place_id")
    ranked = first.withColumns({"n": F.row_number().over(w), "next": F.coalesce(F.lead("population").over(w), F.lit(0)), "candidates": F.count("*").over(key)}).where("n = 1")
    ok = (F.col("candidates") == 1) | (F.col("next") == 0) | (F.col("population") >= ratio * F.col("next"))
    found = ranked.select("mention", F.col("country").alias("c"), F.when(ok, "resolved").otherwise("ambiguous").alias("status"), *[F.when(ok, F.col(x)).alias(x) for x in ("place_id", "lat", "lon", "population", "feature")], "candidates")
    out = asked.withColumnRenamed("mention", "m").join(found, (F.col("m") == F.col("mention")) & F.col("country").eqNullSafe(F.col("c")), "left").drop("mention", "c").withColumnRenamed("m", "mention")
    return out.withColumns({"status": F.coalesce("status", F.lit("unresolved")), "candidates": F.coalesce("candidates", F.lit(0))})


def centroids(resolved: DataFrame, key: str) -> DataFrame:
    """AGG-20: mean place, and the primary one: points before areas, then the most people."""
    mean = resolved.groupBy(key).agg(F.round(F.avg("lat"), 5).alias("lat"), F.round(F.avg("lon"), 5).alias("lon"), F.count("*").alias("places"))
    primary = first_by(resolved, [key], F.col("feature") != "point", F.desc("population"), "place_id").select(key, F.col("place_id").alias("primary_place"))
    return mean.join(primary, key)
