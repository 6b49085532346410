"""Writing: resumable appends, partitions, merges, flattened CSV, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.values import cell
from millrace.operators.relational import resume


def append_new(df: DataFrame, path: str, key: str) -> int:
    """SNK-1, SNK-2, SNK-3: append the rows whose key the folder does not hold yet; how many."""
    spark = df.sparkSession
    try:
        done = spark.read.parquet(path).select(key)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
            raise
        done = None
    new = df.dropDuplicates([key]) if done is None else resume(df.dropDuplicates([key]), done, key)
    new.write.mode("append").parquet(path)
    return spark.read.parquet(path).count() - (0 if done is None else done.count())


def write_months(df: DataFrame, path: str, by: str = "month", overwrite: bool = True, files: int = 8) -> None:
    """SNK-4, SNK-7, SNK-8: one folder a month, each month's rows in at most `files` tasks; refuses a folder that is there unless told."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(files))
    df.withColumn("_salt", salt).repartition(F.col(by), F.col("_salt")).drop("_salt").write.partitionBy(by).mode("overwrite" if overwrite else "errorifexists").json(path)


def split_write(df: DataFrame, ok: str, path: str) -> None:
    """SNK-11: successes and failures in a folder each."""
    df.where(F.col(ok)).write.mode("overwrite").json(f"{path}/ok")
    df.where(~F.coalesce(F.col(ok), F.lit(False))).write.mode("overwrite").json(f"{path}/failed")


def flat_columns(records: DataFrame, fields: str = "fields", min_fill: int = 1) -> tuple[list[str], list[str]]:
    """ARR-5, SRT-6, PRJ-7: keys of an open map, densest first, then by name; those under min_fill apart."""
    n = records.select(F.explode(F.map_keys(fields)).alias("k")).groupBy("k").count().collect()  # one row a key
    order = sorted(n, key=lambda r: (-r["count"], r["k"]))
    return [r["k"] for r in order if r["count"] >= min_fill], [r["k"] for r in order if r["count"] < min_fill]


def flatten_events(records: DataFrame, keep: list[str], fields: list[str], rare: list[str]) -> DataFrame:
    """PRJ-5, SNK-9: a row an event (events: array of maps); an article without events keeps one row with an empty index."""
    each = records.select(*keep, F.posexplode_outer("events").alias("event_index", "event"))
    cols = [F.coalesce(F.try_element_at("event", F.lit(k)), F.lit("")).alias(k) for k in fields]
    extra = F.map_filter(F.coalesce("event", F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*rare) if rare else F.lit(False))
    return each.select(*keep, cell(F.col("event_index"), "int").alias("event_index"), *cols, F.when(F.size(extra) > 0, F.to_json(extra)).otherwise("").alias("extra_fields"))


def write_csv(df: DataFrame, path: str, bom: bool = False) -> None:
    """SNK-9: CSV with a header; with bom every file begins with a byte order mark, as spreadsheets want it."""
    if bom:
        first = df.columns[0]
        df = df.withColumnRenamed(first, f"\ufeff{first}")
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def status_counts(journal: DataFrame, key: str = "article_id", status: str = "status", order: str = "seq") -> DataFrame:
    """SNK-3: how many items are in each state; of an item's marks the last one counts, so marking twice is marking once."""
    last = journal.groupBy(key).agg(F.max_by(status, order).alias(status))
    return last.groupBy(status).agg(F.count("*").alias("n"))


def refresh_metadata(index: DataFrame, meta: DataFrame, key: str = "uid") -> DataFrame:
    """SNK-10: new metadata beside the vectors that are there; nothing is embedded again."""
    kept = [c for c in index.columns if c not in meta.columns or c == key]
    return index.select(*kept).join(meta, key, "left")


def upsert(index: DataFrame, rows: DataFrame, key: str = "uid") -> DataFrame:
    """SNK-10: index with rows added, and put in the place of those with their key; columns that rows lack are null."""
    return index.join(rows.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def export_matrix(index: DataFrame, path: str, key: str = "uid", vec: str = "embedding") -> int:
    """SNK-10: keys and vectors of the index as Parquet, in the order of the keys, those without a vector left out; how many."""
    index.where(F.col(vec).isNotNull()).select(key, vec).sort(key).write.mode("overwrite").parquet(path)
    return index.sparkSession.read.parquet(path).count()


def markdown(df: DataFrame, rows: int = 100) -> str:
    """SNK-12: a small table as Markdown."""
    out = [f"| {' | '.join(df.columns)} |", f"|{'---|' * len(df.columns)}"]
    return "\n".join([*out, *(f"| {' | '.join('' if v is None else str(v) for v in r)} |" for r in df.limit(rows).collect())])
