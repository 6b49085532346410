"""Place and river names as sets of tokens, compared by their best pair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import normalize_ascii
from millrace.functions.values import c

# fixed values: words that say what kind of place a name is, not which one
PLACE_WORDS = (
    "the of in at and district districts city town village villages province state region county area areas municipality "
    "prefecture department governorate island islands along near parts part highway road river valley north south east west "
    "northern southern eastern western central"
).split()
# fixed values: words for a watercourse, and those left out of its name
WATERCOURSES, RIVER_ARTICLES = "river rivers nadi creek canal stream nala khal".split(), ("the", "of")


def location_tokens(place: Column | str) -> Column:
    """STR-19: the distinct words of a place's name that tell it from others."""
    words = F.array_distinct(F.split(normalize_ascii(place), " "))
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*PLACE_WORDS))


def token_jaccard(a: Column, b: Column) -> Column:
    """STR-19: shared tokens by all tokens, 0 if either side has none."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def location_similarity(a: Column | str, b: Column | str) -> Column:
    """STR-19: 1 if two lists share a name once it is normalised, else the highest token Jaccard of a pair; 0 for an empty list."""
    a, b = c(a), c(b)
    names = [F.transform(x, normalize_ascii) for x in (a, b)]
    # the tokens of each name are worked out once, then every pair is compared
    sets = F.struct(F.transform(a, location_tokens).alias("x"), F.transform(b, location_tokens).alias("y"))
    best = F.get(F.transform(F.array(sets), lambda s: F.array_max(F.flatten(F.transform(s["x"], lambda x: F.transform(s["y"], lambda y: token_jaccard(x, y)))))), F.lit(0))
    return F.when(F.arrays_overlap(*names), 1.0).when((F.size(a) > 0) & (F.size(b) > 0), F.coalesce(best, F.lit(0.0))).otherwise(0.0)


def river_key(name: Column | str) -> Column:
    """STR-20: a river's name without the word for a watercourse and articles; empty if nothing is left."""
    words = F.split(normalize_ascii(name), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin(*WATERCOURSES, *RIVER_ARTICLES)), " ")


def river_similarity(a: Column | str, b: Column | str) -> Column:
    """STR-20: 1 if two lists name one river, else 0."""
    keys = [F.filter(F.transform(c(x), river_key), lambda k: k != "") for x in (a, b)]
    return F.when(F.coalesce(F.arrays_overlap(*keys), F.lit(False)), 1.0).otherwise(0.0)
