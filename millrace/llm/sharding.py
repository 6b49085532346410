"""Contiguous shards of near-equal bytes by global prefix sums, in DataFrame functions alone.

Only ids, sizes and checksums move, never texts. Rows are range-partitioned by their order, so that each
partition is a run of the global order; the partitions' totals (one small row each) give every partition
its offset, and sums within a partition give every row its place. A row goes to the shard in which its
middle byte lies when the total is cut at equal targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import free_name
from millrace.session import cut, drop, table

SHARDS = 8


def global_positions(df: DataFrame, order: list[str], size: str, partitions: int | None = None) -> DataFrame:
    """df with position (from 0) and before (the sum of size over earlier rows) in the order given.

    A running number makes the order total, so that rows which are alike, even a third of the table, are
    dealt over many partitions. Nulls come first. The numbered rows are written once: every later step
    sees the same partitions, whatever is lost and computed again.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie")
    # the identifier holds the partition above 33 bits and the place within it below
    runs = cut(ordered.drop("_tie").withColumn("_id", F.monotonically_increasing_id()).withColumn("_run", F.shiftright("_id", 33)), "runs")
    totals = runs.groupBy("_run").agg(F.count("*").alias("rows"), F.sum(size).alias("bytes")).collect()  # a row a partition
    offsets, rows, total = [], 0, 0
    for t in sorted(totals, key=lambda t: t["_run"]):
        offsets.append((t["_run"], rows, total))
        rows, total = rows + t["rows"], total + t["bytes"]
    start = spark.createDataFrame(offsets or [(-1, 0, 0)], "_run long, _rows long, _bytes long")
    w = Window.partitionBy("_run").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    within = runs.withColumn("_sum", F.sum(size).over(w))
    out = within.join(F.broadcast(start), "_run")  # a row a partition
    position = F.col("_rows") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return out.withColumns({"position": position, "before": F.col("_bytes") + F.col("_sum") - F.col(size), "total": F.lit(total).cast("long")}).drop("_run", "_id", "_sum", "_rows", "_bytes")


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for each row of docs (doc_id, text, anything else).

    size is the UTF-8 bytes of the text plus 1 (a null text has none), so every row has a weight and slots
    are gapless. Shards are runs of the order by doc_id, then checksum; rows that repeat keep a place each.
    With fewer rows than shards some shards are empty; an empty table gives no rows.
    """
    placed, offsets = _placed(docs, shards)
    out = placed.join(F.broadcast(offsets), "shard").select("doc_id", "size", "text_crc32", "shard", _slot())
    return out


def _placed(docs: DataFrame, shards: int, row: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """doc_id, size, text_crc32, position, shard (and row, a number of the row), and the first position of each shard."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    extra = [] if row is None else [row.alias("row")]
    light = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), *extra)
    placed = global_positions(light, ["doc_id", "text_crc32"], "size")
    # the middle of the row, twice, to stay with integers; decimals keep 100 TB times the shards exact
    middle = (F.col("before") * 2 + F.col("size")).cast("decimal(38,0)")
    shard = F.least(F.floor(middle * shards / (F.col("total") * 2).cast("decimal(38,0)")), F.lit(shards - 1)).cast("int")
    placed = cut(placed.select("doc_id", "size", "text_crc32", "position", shard.alias("shard"), *(["row"] if extra else [])), "shards")
    return placed, placed.groupBy("shard").agg(F.min("position").alias("first"))  # a row a shard


def _slot() -> Column:
    return (F.col("position") - F.col("first")).alias("slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Write docs (doc_id, text, anything else) as one folder a shard, each in slot order; returns the assignment.

    The rows are numbered and written once, and a row meets its place by that number: rows with a null doc_id
    and rows that repeat are all written. The columns shard and slot of docs, if any, are replaced.
    """
    spark = docs.sparkSession
    row = free_name(docs, "_row")
    numbered = cut(docs.drop("shard", "slot").withColumn(row, F.monotonically_increasing_id()), "numbered")
    placed, offsets = _placed(numbered, shards, F.col(row))
    places = cut(placed.join(F.broadcast(offsets), "shard").select("doc_id", "size", "text_crc32", "shard", _slot(), "row"), "places")
    rows = numbered.join(places.select(F.col("row").alias(row), "shard", "slot"), row).drop(row)
    n = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    drop(numbered, placed)
    return places.drop("row")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign_shards(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op4_sharding": op4_sharding}
