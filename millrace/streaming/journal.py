"""A journal of finished items that a stream writes exactly once: what is marked stays marked, however often a batch is replayed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import store

SCHEMA = "id string, status string, batch long, place long"


class Journal:
    """SNK-3: marks (id, status) under a folder. The first mark of an id counts; those after it change nothing.

    Each micro-batch is a folder named by its number, complete once Spark's own mark of success is there, so a batch
    that is replayed replaces itself and one that was torn doesn't count. compact() folds complete batches into one
    folder of first marks, which then answers for their numbers. Use ``stream.writeStream.foreachBatch(journal.write)``.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "id", status: str = "status", order: str | None = None):
        self.spark, self.root, self.key, self.status, self.order = spark, root, key, status, order

    def _numbers(self, kind: str) -> list[int]:
        found = [n for n in store.names(self.spark, self.root) if n.startswith(f"{kind}-")]
        return [int(n.partition("-")[2]) for n in found if store.exists(self.spark, f"{self.root}/{n}/_SUCCESS")]

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.root}/{kind}-{number:012d}"

    def compacted(self) -> int:
        """The last batch that a compaction answers for, -1 if none does."""
        return max(self._numbers("first"), default=-1)

    def write(self, marks: DataFrame, batch: int) -> None:
        """Record a batch. Ids that are null are no marks; a null status is "ok". Within a batch marks are in the order
        of the column `order` (nulls first), then by status."""
        if batch <= self.compacted():
            return
        m = marks.select(F.col(self.key).cast("string").alias("id"), F.coalesce(F.col(self.status).cast("string"), F.lit("ok")).alias("status"), (F.col(self.order).cast("long") if self.order else F.lit(0).cast("long")).alias("place"))
        first = m.where("id IS NOT NULL").groupBy("id").agg(F.min(F.struct("place", "status")).alias("m"))
        first.select("id", "m.status", F.lit(batch).cast("long").alias("batch"), "m.place").write.mode("overwrite").parquet(self._folder("batch", batch))

    def marks(self, upto: int | None = None) -> DataFrame:
        """id, status, batch and place of the first mark of each id."""
        done = self.compacted()
        folders = [self._folder("batch", n) for n in self._numbers("batch") if n > done and (upto is None or n <= upto)]
        if done >= 0:
            folders.append(self._folder("first", done))
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*folders)
        return rows.groupBy("id").agg(F.min(F.struct("batch", "place", "status")).alias("m")).select("id", "m.status", "m.batch", "m.place")

    def counts(self) -> DataFrame:
        """status and n, and how many items are complete in all (null status)."""
        return self.marks().rollup("status").agg(F.count("*").alias("n"))

    def open_items(self, todo: DataFrame, key: str) -> DataFrame:
        """The rows of todo that no mark is there for: where a restarted run goes on."""
        return todo.join(self.marks().select(F.col("id").alias("__id")), F.col(key).cast("string") == F.col("__id"), "left_anti")

    def compact(self) -> int:
        """Fold the complete batches into one folder; the last number it answers for.

        What it replaces is deleted only once it is complete: after a crash before that, batches are read as before;
        after one in the middle of deleting, what is left of them is ignored.
        """
        last, done = max(self._numbers("batch"), default=-1), self.compacted()
        if last > done:
            self.marks(last).write.mode("overwrite").parquet(self._folder("first", last))
            done = last
        for n in store.names(self.spark, self.root):
            kind, _, number = n.partition("-")
            if (kind == "batch" and int(number) <= done) or (kind == "first" and int(number) < done):
                store.delete(self.spark, f"{self.root}/{n}")
        return done
