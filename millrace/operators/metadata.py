"""Metadata of events laid out so that filters reach the files: folders by year, rows sorted, statistics and bloom filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns that are stored beside the given ones, so that a filter is a plain comparison with a column.
FIRST, LAST, PLACE = "first_date", "last_date", "country_key"
#: Whole values of these are looked up by bloom filters.
BLOOM = (PLACE, "flood_type")


def write_metadata(rows: DataFrame, path: str, files: int = 4, row_group: int = 16 << 20) -> None:
    """FLT-9: store rows (year, country, flood_type, date_min, date_max, deaths and anything else) for select_metadata.

    A year is a folder (rows without one are in Spark's default folder) of at most `files` files, each a range of dates,
    so a year with a third of all rows is dealt over as many tasks. A date of which only one end is known counts for both.
    Columns of rows with the names of those that are added are replaced.
    """
    more = {FIRST: F.coalesce("date_min", "date_max"), LAST: F.coalesce("date_max", "date_min"), PLACE: F.lower("country")}
    laid = rows.drop(*more).withColumns(more)
    # a range over (year, date), with a number that parts equal dates
    parts = max(files, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = laid.repartitionByRange(parts, "year", FIRST, PLACE, F.xxhash64(*[c for c in laid.columns if c not in (FIRST, "year")])).sortWithinPartitions("year", FIRST, PLACE)
    out = dealt.write.partitionBy("year").mode("overwrite").option("parquet.block.size", str(row_group))
    for c in BLOOM:
        out = out.option(f"parquet.bloom.filter.enabled#{c}", "true")
    out.parquet(path)


def conditions(years: list[int] | None = None, country: str | None = None, type_: str | None = None, since: str | None = None, until: str | None = None, min_deaths: int | None = None, exact_country: str | None = None) -> list[Column]:
    """FLT-8, FLT-9: one condition a filter, each a comparison of a stored column with a literal. Unknown values fail.

    country is a part of the name, exact_country all of it, in any case of letters; since and until are dates as text
    (year-month-day): an event counts that ended at or after since, or began at or before until.
    """
    out = []
    if years:
        out.append(F.col("year").isin(years))
    if exact_country:
        out.append(F.col(PLACE) == exact_country.lower())
    if country:
        out.append(F.col(PLACE).contains(country.lower()))
    if type_:
        out.append(F.col("flood_type") == type_)
    if since:
        out.append(F.col(LAST) >= since)
    if until:
        out.append(F.col(FIRST) <= until)
    if min_deaths is not None:
        out.append(F.col("deaths") >= min_deaths)
    return out


def select_metadata(spark: SparkSession, path: str, **filters) -> DataFrame:
    """The stored rows that pass the filters of conditions(); files, row groups and pages that can't hold any are not read."""
    rows = spark.read.parquet(path)
    for c in conditions(**filters):
        rows = rows.where(c)
    return rows.drop(FIRST, LAST, PLACE)
