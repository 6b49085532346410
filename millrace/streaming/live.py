"""Live operators: windows with watermarks, and the state of items that succeed or fail."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.values import error_class, log_fields
from millrace.operators.relational import first_by


def tail(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """STM-1: the records of JSON files as they are completed in a folder."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").json(path)


def tumbling(events: DataFrame, width: str, keys: list[str], ts: str = "ts", late: str = "10 minutes", value: str = "value") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def sliding(events: DataFrame, width: str, step: str, keys: list[str], ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """STM-4."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width, step), *keys).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, gap: str, keys: list[str], ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """STM-6."""
    return events.withWatermark(ts, late).groupBy(F.session_window(ts, gap), *keys).agg(F.count("*").alias("n"))


def tallies(events: DataFrame, keys: list[str]) -> DataFrame:
    """STM-3, STM-7: counts that are kept up to date (output mode complete)."""
    return events.groupBy(*keys).agg(F.count("*").alias("n"))


def step(state: str, ok: bool) -> str:
    """STM-2: a success stays; it removes an earlier failure; a failure after it is ignored."""
    return "ok" if ok or state == "ok" else "failed"


def reconcile(records: DataFrame, timeout: bool = False) -> DataFrame:
    """STM-2: part, article_id, state, changes for a stream of part, article_id, ok; one row whenever a state changes."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before, changes = state.get if state.exists else ("", 0)
        now = before
        for pdf in frames:
            for ok in pdf["ok"]:
                now = step(now, bool(ok))
        if now != before:
            changes += 1
            state.update((now, changes))
            yield pd.DataFrame({"part": [key[0]], "article_id": [key[1]], "state": [now], "changes": [changes]})

    return records.groupBy("part", "article_id").applyInPandasWithState(run, "part string, article_id string, state string, changes int", "state string, changes int", "update", GroupStateTimeout.NoTimeout)


def reconcile_batch(records: DataFrame) -> DataFrame:
    """The same over a finished table, as an aggregate: ok if ever ok."""
    return records.groupBy("part", "article_id").agg(F.when(F.max(F.col("ok").cast("int")) == 1, "ok").otherwise("failed").alias("state"))


def part_state(done: Column, failed: Column, total: Column, idle_seconds: Column, fresh: int = 120) -> Column:
    """STM-5: what a partition of the work is doing: retry, done, running, partial or queued.

    Where every item is accounted for it is done, unless it has been written to lately: then failures are being
    retried. idle_seconds is null for a partition that was never written to.
    """
    seen, lately = done + failed, F.coalesce(idle_seconds < fresh, F.lit(False))
    return (
        F.when((total > 0) & (seen >= total), F.when(lately, "retry").otherwise("done")).when(lately, "running")
        .when(seen > 0, "partial").otherwise("queued")
    )


def part_states(records: DataFrame, totals: DataFrame, now: Column, fresh: int = 120) -> DataFrame:
    """STM-5: part, ok, failed, total and state, from records (part, article_id, ok, ts) and totals (part, total)."""
    last = records.groupBy("part").agg(F.max("ts").alias("last"))
    items = reconcile_batch(records).groupBy("part").agg(F.sum((F.col("state") == "ok").cast("long")).alias("ok"), F.sum((F.col("state") != "ok").cast("long")).alias("failed"))
    out = totals.join(items, "part", "left").join(last, "part", "left")
    ok, failed = F.coalesce("ok", F.lit(0)), F.coalesce("failed", F.lit(0))
    idle = now.cast("timestamp").cast("long") - F.col("last").cast("timestamp").cast("long")
    return out.select("part", ok.alias("ok"), failed.alias("failed"), "total", part_state(ok, failed, F.col("total"), idle, fresh).alias("state"))


def block_eta(blocks: DataFrame, plan_chunks: Column, elapsed: Column) -> DataFrame:
    """STM-8: chunks_per_s over every finished block (chunks, seconds), and what the block in flight still takes."""
    rate = blocks.agg(F.count("*").alias("blocks"), (F.sum("chunks") / F.nullif(F.sum("seconds"), F.lit(0))).alias("chunks_per_s"))
    estimate = plan_chunks / F.col("chunks_per_s")
    return rate.select((F.col("blocks") + 1).alias("block"), "chunks_per_s", estimate.alias("estimated"), F.greatest(F.lit(0.0), estimate - elapsed).alias("remaining"))


def log_state(lines: DataFrame, line: str = "line") -> DataFrame:
    """STM-7: kind, error, n, chunks and seconds of progress lines; errors are grouped by their masked text."""
    r = lines.select(log_fields(line).alias("x"), F.col(line).alias("line"))
    error = F.when(F.col("x.kind").isin("other", "oom") & F.lower("line").rlike("error|failed|out of memory"), error_class("line"))
    return r.groupBy(F.col("x.kind").alias("kind"), error.alias("error")).agg(F.count("*").alias("n"), F.sum("x.chunks").alias("chunks"), F.sum("x.seconds").alias("seconds"))


def top_lists(records: DataFrame, part: str, columns: list[str], n: int = 5) -> DataFrame:
    """STM-3: part, list, value and n: the most frequent values of each column in each partition, of equals the smaller."""
    each = records.select(part, F.explode(F.array(*[F.struct(F.lit(c).alias("list"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select(part, "x.*")
    counts = each.where("value IS NOT NULL").groupBy(part, "list", "value").agg(F.count("*").alias("n"))
    return first_by(counts, [part, "list"], F.desc("n"), "value", n=n)


def trailing_rate(events: DataFrame, keys: list[str], ts: str = "ts", seconds: int = 60, least: int = 5, stretch: int = 64) -> DataFrame:
    """WIN-6: events in the trailing window a second, null until it spans `least` seconds.

    Time is cut into stretches of `stretch` windows, each a group of its own that also sees the last window of the
    stretch before, so that a key with very many events is dealt over many tasks.
    """
    t, size = F.col(ts).cast("timestamp").cast("long"), seconds * stretch
    at = F.floor(t / size)
    late = F.pmod(t, F.lit(size)) >= size - seconds  # the next stretch looks back at these
    home, guest = F.struct(at.alias("at"), F.lit(True).alias("own")), F.struct((at + 1).alias("at"), F.lit(False).alias("own"))
    dealt = events.withColumn("_s", F.explode(F.when(late, F.array(home, guest)).otherwise(F.array(home))))
    w = Window.partitionBy(*keys, "_s.at").orderBy(t).rangeBetween(-seconds, 0)
    span = t - F.min(t).over(w)
    return dealt.withColumn("rate", F.when(span >= least, F.count("*").over(w) / span)).where("_s.own").drop("_s")


def gap_rates(samples: DataFrame, keys: list[str], ts: str, count: str, interval: int = 15) -> DataFrame:
    """WIN-7: deltas between consecutive samples, left out across gaps over max(60, 4 intervals) and where counts fall."""
    t = F.col(ts).cast("timestamp").cast("long")
    w = Window.partitionBy(*keys).orderBy(t, count)
    dt = t - F.lag(t).over(w)
    dn = F.col(count) - F.lag(count).over(w)
    ok = (F.col("dt") > 0) & (F.col("dt") <= max(60, 4 * interval)) & (F.col("dn") >= 0)
    return samples.withColumns({"dt": dt, "dn": dn}).where(ok).groupBy(*keys).agg(F.sum("dn").alias("items"), F.sum("dt").alias("seconds"), (F.sum("dn") / F.sum("dt")).alias("rate"))


def eta(done: Column, total: Column, elapsed: Column, recent: Column, switch: int = 300) -> Column:
    """STM-4, STM-8: seconds left, by the recent rate once `switch` seconds have passed."""
    rate = F.when((elapsed >= switch) & recent.isNotNull(), recent).otherwise(done / elapsed)
    return F.when(rate > 0, (total - done) / rate)
