"""A table of files with numbered versions: corrections rewrite only the files that they touch, and are published at once.

Folder `data` holds files that are never changed. A version is a small file in `versions` that lists the files of the
table; it gets its name, the next number, in one step after everything it lists is written. A writer that is killed
leaves files that no version lists; of two writers with the same number one is refused. Older versions stay readable.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import cut, drop
from millrace.sources import store


class Conflict(Exception):
    """Another writer has published a version in the meantime; nothing of this one is visible."""


def versions(spark: SparkSession, root: str) -> list[int]:
    """SNK-5: the numbers of the published versions, in order."""
    return [int(n[:-5]) for n in store.names(spark, f"{root}/versions") if n.endswith(".json") and n[:-5].isdigit()]


def _manifest(spark: SparkSession, root: str, version: int | None) -> tuple[int, list[str], StructType]:
    found = versions(spark, root)
    if not found or (version is not None and version not in found):
        raise FileNotFoundError(f"{root} has no version {version or ''}")
    version = found[-1] if version is None else version
    m = json.loads(store.read_text(spark, f"{root}/versions/{version:010d}.json"))
    return version, m["files"], StructType.fromJson(m["schema"])


def _publish(spark: SparkSession, root: str, version: int, files: list[str], schema: StructType) -> int:
    text = json.dumps({"files": sorted(files), "schema": schema.jsonValue()})
    if not store.publish(spark, f"{root}/versions/{version:010d}.json", text, f"{root}/versions/draft-{uuid.uuid4().hex}"):
        raise Conflict(f"version {version} of {root} is there already")
    return version


def _write(df: DataFrame, root: str) -> list[str]:
    name = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}")
    return [f"{name}/{n}" for n in store.names(df.sparkSession, f"{root}/{name}") if n.endswith(".parquet")]


def create(df: DataFrame, root: str) -> int:
    """SNK-5: write df as version 1."""
    return _publish(df.sparkSession, root, 1, _write(df, root), df.schema)


def files(spark: SparkSession, root: str, version: int | None = None) -> list[str]:
    """The files of a version, by default of the last."""
    return _manifest(spark, root, version)[1]


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as it is in a version, by default the last. What is published later doesn't change it."""
    _, names, schema = _manifest(spark, root, version)
    return spark.read.schema(schema).parquet(*[f"{root}/{n}" for n in names]) if names else spark.createDataFrame([], schema)


def merge(spark: SparkSession, root: str, patch: DataFrame, key: str, column: str, accept: Column | None = None, where: Column | None = None) -> int:
    """SNK-6: column takes the value that an accepted row of patch has for its key; the version in which it does.

    accept is a condition on rows of patch, where one on rows of the table. Null keys and null values change nothing;
    of several values for a key the largest counts. Only files with a row that changes are rewritten, all others
    keep their names; a patch that changes nothing publishes nothing, so that merging twice is merging once. The number
    of files, not of rows, is what the driver sees.
    """
    version, names, schema = _manifest(spark, root, None)
    p = patch if accept is None else patch.where(accept)
    p = p.where(F.col(key).isNotNull() & F.col(column).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.max(column).alias("__new"))
    p = cut(p, "patch")
    able = (F.lit(True) if where is None else F.coalesce(where, F.lit(False))) & F.col("__new").isNotNull() & ~F.col("__new").eqNullSafe(F.col(column))

    def joined(some: list[str]) -> DataFrame:
        rows = spark.read.schema(schema).parquet(*[f"{root}/{n}" for n in some]).withColumn("__file", F.col("_metadata.file_path"))
        return rows.join(p, F.col(key) == F.col("__key"), "left")

    touched = []
    if names:
        paths = {r["__file"] for r in joined(names).where(able).select("__file").distinct().collect()}
        ends = {"/".join(x.split("/")[-2:]) for x in paths}
        touched = [n for n in names if "/".join(n.split("/")[-2:]) in ends]
    if touched:
        new = joined(touched).withColumn(column, F.when(able, F.col("__new").cast(schema[column].dataType)).otherwise(F.col(column))).select(*schema.names)
        written = _write(new, root)
        version = _publish(spark, root, version + 1, [n for n in names if n not in set(touched)] + written, schema)
    drop(p)
    return version


def restore(spark: SparkSession, root: str, version: int) -> int:
    """SNK-6: publish the files of an older version as the next one; no file is written or lost."""
    _, names, schema = _manifest(spark, root, version)
    return _publish(spark, root, versions(spark, root)[-1] + 1, names, schema)


def clean(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete data folders that neither the first version nor the last `keep` list, and the other versions; how many folders.

    Not while a writer is at work: what it has not published yet looks like what a killed one left behind.
    """
    found = versions(spark, root)
    kept = {found[0], *found[-keep:]} if found else set()
    used = {n.split("/")[1] for v in kept for n in files(spark, root, v)}
    for v in found:
        if v not in kept:
            store.delete(spark, f"{root}/versions/{v:010d}.json")
    lost = [n for n in store.names(spark, f"{root}/data") if n not in used]
    for n in lost:
        store.delete(spark, f"{root}/data/{n}")
    return len(lost)
