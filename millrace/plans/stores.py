"""Queries over what is stored and added to: an index, a journal, versions of a table, live states. The stores are made of
the given tables, in the shared folder, and deleted when the result is written."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import index, metadata
from millrace.plans.base import query
from millrace.plans.documents import _bm25_sql
from millrace.session import cut, shared_dir, table
from millrace.sources import store, versioned
from millrace.streaming import progress
from millrace.streaming.journal import Journal


@contextmanager
def _folder(spark: SparkSession, name: str):
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        store.delete(spark, path)


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The table's files as a stream: a pattern, as the table can be one file or a folder."""
    return spark.readStream.schema(table(spark, sf, name).schema).parquet(f"{sf}/{name}.parque[t]")


def _drain(stream: DataFrame, sink, path: str) -> None:
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{path}/checkpoint").outputMode("update").trigger(availableNow=True).start().awaitTermination()


@query(_bm25_sql(20))
def bm25_index_topk(spark, sf):
    """NUM-6, SRT-5, CMP-5: every benchmark item searches an index that was stored in two increments."""
    docs, q = table(spark, sf, "documents"), table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    with _folder(spark, "index") as path:
        for odd in (0, 1):  # as they come: one half, then the other
            index.add(docs.where(F.col("doc_id") % 2 == odd), path, "doc_id", "text", segment=f"half-{odd}")
        top = index.top(spark, path, q, 20)
        return cut(top.select("query_id", "id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank")), "top")


@query("""WITH p AS (SELECT l_orderkey AS o_orderkey, max(l_linestatus || ' ' || l_returnflag) AS title FROM lineitem WHERE l_orderkey % 100 = 7 AND l_quantity > 10 GROUP BY ALL)
SELECT o.o_orderkey, CASE WHEN o_orderstatus = 'O' AND p.title IS NOT NULL THEN p.title ELSE o_orderpriority END AS title, o_orderpriority AS title_before FROM orders o LEFT JOIN p USING (o_orderkey)""")
def versioned_patch(spark, sf):
    """SNK-6, SNK-5, JN-4: corrections merged into a table with versions, beside the version before them."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("title"), "o_orderstatus")
    patch = table(spark, sf, "lineitem").where("l_orderkey % 100 = 7").select(F.col("l_orderkey").alias("o_orderkey"), F.concat_ws(" ", "l_linestatus", "l_returnflag").alias("title"), "l_quantity")
    with _folder(spark, "versions") as path:
        versioned.create(orders.repartitionByRange(8, "o_orderkey"), path)
        for _ in range(2):  # the second time changes nothing
            versioned.merge(spark, path, patch, "o_orderkey", "title", accept=F.col("l_quantity") > 10, where=F.col("o_orderstatus") == "O")
        before = versioned.read(spark, path, 1).select("o_orderkey", F.col("title").alias("title_before"))
        return cut(versioned.read(spark, path).select("o_orderkey", "title").join(before, "o_orderkey"), "patched")


@query("""WITH m AS (SELECT user_id, arg_min(event_type, ts::VARCHAR || event_type) AS status FROM events GROUP BY user_id)
SELECT status, count(*) AS n FROM m GROUP BY status UNION ALL SELECT NULL, count(*) FROM m""")
def journal_counts(spark, sf):
    """SNK-3, STM-3: a stream of marks in a journal, every batch of it written twice and folded; of a user's marks the first counts."""
    events = _stream(spark, sf, "events")
    marks = events.select("user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    with _folder(spark, "journal") as path:
        journal = Journal(spark, f"{path}/marks", "user_id", "event_type", "at")

        def twice(df: DataFrame, batch: int) -> None:
            journal.write(df, batch)
            journal.write(df, batch)

        _drain(marks, twice, path)
        journal.compact()
        return cut(journal.counts().select("status", "n"), "counts")


@query("""WITH r AS (SELECT user_id::VARCHAR AS part, event_type AS item, max((value >= 50)::INT) AS ok, max(3 + user_id % 4) AS total FROM events GROUP BY ALL)
SELECT part, sum(ok)::BIGINT AS ok, (count(*) - sum(ok))::BIGINT AS failed, max(total)::BIGINT AS total, CASE WHEN count(*) >= max(total) THEN 'retry' ELSE 'running' END AS state FROM r GROUP BY part""")
def live_part_states(spark, sf):
    """STM-5, STM-2: what each part is doing while the stream that tells of it goes on; users stand for parts."""
    records = _stream(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("part"), F.col("event_type").alias("article_id"), (F.col("value") >= 50).alias("ok"), (3 + F.col("user_id") % 4).alias("total")
    )
    # without data there is nothing to wait for here: a query with timers would go on for ever
    wanted = {"spark.sql.streaming.stateStore.providerClass": progress.STORE, "spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    with _folder(spark, "progress") as path:
        try:
            for k, v in wanted.items():
                spark.conf.set(k, v)
            _drain(progress.part_progress(records), lambda df, batch: df.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}"), path)
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        rows = spark.read.parquet(f"{path}/rows")
        last = rows.groupBy("part").agg(F.max_by(F.struct("ok", "failed", "total", "state"), "seq").alias("x"))
        return cut(last.select("part", "x.*"), "parts")


@query("""WITH m AS (SELECT o_orderkey, year(o_orderdate) AS year, n_name AS country, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS flood_type, CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date_min,
CASE WHEN o_orderkey % 3 > 0 THEN strftime(o_orderdate + INTERVAL 5 day, '%Y-%m-%d') END AS date_max, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey % 50 END AS deaths FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT o_orderkey, year::INT AS year, country FROM m WHERE year IN (1995, 1996) AND contains(lower(country), 'ion_1') AND flood_type = 'O' AND coalesce(date_max, date_min) >= '1995-06-01' AND coalesce(date_min, date_max) <= '1996-09-30' AND deaths >= 10""")
def metadata_filters(spark, sf):
    """FLT-8, FLT-9: all filters at once over stored metadata; orders stand for events, nations for countries."""
    nations = F.broadcast(table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")))  # 25 rows
    people = table(spark, sf, "customer").join(nations, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "country")
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    rows = table(spark, sf, "orders").join(people, "o_custkey").select(
        "o_orderkey", F.year(day).alias("year"), "country", F.when(k % 4 > 0, F.col("o_orderstatus")).alias("flood_type"), F.when(k % 5 > 0, day.cast("string")).alias("date_min"),
        F.when(k % 3 > 0, F.date_add(day, 5).cast("string")).alias("date_max"), F.when(k % 7 > 0, F.col("o_custkey") % 50).alias("deaths"),
    )
    with _folder(spark, "metadata") as path:
        metadata.write_metadata(rows, path)
        found = metadata.select_metadata(spark, path, years=[1995, 1996], country="ION_1", type_="O", since="1995-06-01", until="1996-09-30", min_deaths=10)
        return cut(found.select("o_orderkey", F.col("year").cast("int").alias("year"), "country"), "found")
