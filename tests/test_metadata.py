from pyspark.sql import functions as F

from millrace.operators import metadata
from millrace.operators.search import matches


def scanned(df):
    """Rows that the scan of a plan without a shuffle gave."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        total += leaves.apply(i).metrics().apply("numOutputRows").value()
    return total


def test_filters_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = spark.range(20_000).select(
        F.col("id"), (2000 + F.col("id") % 4).alias("year"), F.element_at(F.lit(["India", "Nepal", "Sri Lanka"]), (F.col("id") % 3 + 1).cast("int")).alias("country"), F.when(F.col("id") % 5 > 0, "flash").alias("flood_type"),
        F.when(F.col("id") % 2 > 0, F.format_string("2000-%02d-%02d", F.col("id") % 12 + 1, F.col("id") % 28 + 1)).alias("date_min"), F.when(F.col("id") % 3 > 0, F.lit("2000-06-15")).alias("date_max"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 100).alias("deaths"), F.lit("mine").alias("first_date"),
    )
    rows = rows.unionByName(spark.createDataFrame([(-1, None, None, None, None, None, None, None), (-2, 2001, "", "flash", None, None, 5, None)], "id long, year long, country string, flood_type string, date_min string, date_max string, deaths long, first_date string"))
    metadata.write_metadata(rows, path, row_group=1 << 12)
    ids = lambda df: sorted(r.id for r in df.select("id").collect())
    assert metadata.select_metadata(spark, path).count() == 20_002
    for f in ({"years": [2001]}, {"country": "NEP"}, {"type_": "flash"}, {"since": "2000-07-01"}, {"until": "2000-03-31"}, {"min_deaths": 0}, {"years": [2000, 2003], "country": "lan", "type_": "flash", "since": "2000-02-01", "until": "2000-08-01", "min_deaths": 90}):
        assert ids(metadata.select_metadata(spark, path, **f)) == ids(rows.where(matches(**f))), f
    assert ids(metadata.select_metadata(spark, path, exact_country="sri LANKA")) == ids(rows.where("country = 'Sri Lanka'")) and ids(metadata.select_metadata(spark, path, exact_country="lanka")) == []
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    some = metadata.select_metadata(spark, path, years=[2001], country="nep", type_="flash", since="2000-12-01", until="2000-12-31", min_deaths=3).select("id")
    plan = some._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "year" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0] and "year" not in pushed
    for want in ("StringContains(country_key,nep)", "EqualTo(flood_type,flash)", "GreaterThanOrEqual(last_date,2000-12-01)", "LessThanOrEqual(first_date,2000-12-31)", "GreaterThanOrEqual(deaths,3)"):
        assert want in pushed, plan
    assert "date_min" not in plan.split("ReadSchema")[1]
    one = metadata.select_metadata(spark, path, years=[2001], until="2000-02-10").select("id")
    assert 0 < scanned(one) < 1500  # of 5,001 in that folder
