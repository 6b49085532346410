"""First-wins, top-n, merges, samples and counts that the pipelines are built of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.values import date_gap
from millrace.session import cut


def first_by(df: DataFrame, keys: list[str], *order: Column | str, n: int = 1) -> DataFrame:
    """WIN-1, WIN-4, WIN-5: the first n rows of each key. Spark keeps n rows a key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def exact_duplicates(df: DataFrame, text: Column | str, *order: str) -> DataFrame:
    """AGG-4: digest, original (the first id of each digest) and is_duplicate. Texts are hashed before the shuffle."""
    digest = F.sha2(F.col(text) if isinstance(text, str) else text, 256)
    first = df.groupBy(digest.alias("digest")).agg(F.min(F.struct(*order)).alias("first"), F.count("*").alias("copies"))
    out = df.withColumn("digest", digest).join(first, "digest")
    return out.withColumn("original", F.col("first")[order[0]]).withColumn("is_duplicate", F.struct(*order) != F.col("first")).drop("first")


def may_be(rows: DataFrame, keys: DataFrame, name: str, bits: int) -> DataFrame:
    """The rows whose column name (long, dealt like a hash) may be in that of keys: a filter of 2 ** bits times 64 bits, so its broadcast never grows."""
    slot = F.col(name).bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(name, bits), F.lit(64)).cast("int"))
    kept = keys.groupBy(slot.alias("slot")).agg(F.bit_or(bit).alias("bits"))  # 2 ** bits rows at most
    near = rows.withColumn("slot", slot).join(F.broadcast(kept), "slot")
    return near.where(F.col("bits").bitwiseAND(bit) != 0).drop("slot", "bits")


def path_order(path: Column) -> Column:
    """SRC-8: an order in which, within each folder, files come before subfolders."""
    parts = F.split(path, "/")
    return F.transform(parts, lambda p, i: F.concat(F.when(i == F.size(parts) - 1, "0").otherwise("1"), p))


def resume(todo: DataFrame, done: DataFrame, key: str | list[str]) -> DataFrame:
    """SNK-2, JN-5: what is not done yet."""
    return todo.join(done.select(key) if isinstance(key, str) else done.select(*key), key, "left_anti")


def merge(base: DataFrame, patch: DataFrame, key: str, column: str, accept: Column | None = None) -> DataFrame:
    """SNK-6, JN-4: base with column replaced where an accepted patch row exists; applying it twice is applying it once."""
    p = patch.select(F.col(key), F.col(column).alias("_new"))
    if accept is not None:
        p = patch.where(accept).select(F.col(key), F.col(column).alias("_new"))
    return base.join(p, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def top_counts(df: DataFrame, key: str, n: int) -> DataFrame:
    """AGG-1: the n most frequent values, of equals the smaller."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(n)


def stratified_sample(df: DataFrame, strata: str, key: str, n: int, seed: int = 13) -> DataFrame:
    """SRT-3, SRT-4: n rows of each stratum in the order of a seeded digest: the same rows, however the table is dealt."""
    return first_by(df.withColumn("_h", order_hash(seed, key)), [strata], "_h", key, n=n).drop("_h")


def merge_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """AGG-6: value (the largest), min, max, reports and conflict of what reports say; negatives are unknown."""
    x = F.when(F.col(value) >= 0, F.col(value))
    out = df.groupBy(*keys).agg(F.max(x).alias("value"), F.min(x).alias("min"), F.max(x).alias("max"), F.count(x).alias("reports"), (F.count_distinct(x) > 1).alias("conflict"))
    return out.withColumn("value", F.coalesce("value", F.lit(-1)))


def mode_of(df: DataFrame, keys: list[str], value: str, score: str) -> DataFrame:
    """AGG-8: the most frequent value of each key (of equals the smallest) and the mean score of its rows."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"))
    return first_by(counts, keys, F.desc("n"), value)


def bins_by_budget(lengths: list[int], budget: int, most: int) -> list[list[int]]:
    """SRT-2: rows sorted by length into batches whose padded size stays within the budget."""
    out: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (lengths[i], i)):
        if out and len(out[-1]) < most and (len(out[-1]) + 1) * lengths[i] <= budget:
            out[-1].append(i)
        else:
            out.append([i])
    return out


def repetition_loop(text: Column) -> Column:
    """FLT-7: eight words or more of which at most max(2, a quarter) differ."""
    w = F.split(F.trim(F.lower(text)), r"\s+")
    return (F.size(w) >= 8) & (F.size(F.array_distinct(w)) <= F.greatest(F.lit(2), F.floor(F.size(w) / 4)))


def patch_rejection(source: Column, patch: Column) -> Column:
    """FLT-7: why a patch is not applied: a broken source, a loop, a long text from a short one; null if it is fine."""
    return (
        F.when(F.contains(source, F.lit("�")), "mojibake-source").when(F.trim(F.coalesce(patch, F.lit(""))) == "", "empty")
        .when(repetition_loop(patch), "repetition-loop").when((F.length(source) <= 6) & (F.length(patch) > 60), "bloated-from-short")
    )


# fixed values: the codes for leaving a document out
REASONS = (
    "malformed_json", "unreadable_file", "not_a_json_object", "missing_translated_text", "empty_translated_text", "empty_translated_text_after_cleaning", "missing_translated_title",
    "empty_translated_title", "fewer_than_min_words", "garbled_text", "missing_article_id", "write_failed", "duplicate_text",
)


def file_reason(raw: Column, is_object: Column, is_json: Column) -> Column:
    """FLT-4: why a file gives no document: it can't be read (a null), is no JSON, or is no object."""
    return F.when(raw.isNull(), "unreadable_file").when(~is_json, "malformed_json").when(~is_object, "not_a_json_object")


def validation_reason(title: Column, text: Column, cleaned_title: Column, cleaned: Column, words: Column, min_words: int = 100, garbled: Column | None = None) -> Column:
    """FLT-4: the first reason to leave a document out, cheapest test first; null keeps it."""
    blank = lambda x: ~F.coalesce(x, F.lit("")).rlike(r"(?U)\S")
    out = (
        F.when(text.isNull(), "missing_translated_text").when(blank(text), "empty_translated_text")
        .when(title.isNull(), "missing_translated_title").when(F.coalesce(cleaned_title, F.lit("")) == "", "empty_translated_title")
        .when(F.coalesce(cleaned, F.lit("")) == "", "empty_translated_text_after_cleaning").when(words < min_words, "fewer_than_min_words")
    )
    return out.when(garbled, "garbled_text") if garbled is not None else out


def reason_report(rejected: DataFrame, reason: str = "reason", key: str = "article_id", detail: str = "detail", shown: int = 10) -> DataFrame:
    """AGG-5: reason, n, share and the first examples (key and detail) by key; only those examples ever leave their tasks."""
    counts = rejected.groupBy(reason).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    some = first_by(rejected, [reason], key, n=shown).groupBy(reason).agg(F.sort_array(F.collect_list(F.struct(key, detail))).alias("examples"))
    out = counts.join(F.broadcast(total)).join(some, reason)
    return out.select(reason, "n", (F.col("n") / F.col("total")).alias("share"), "examples")


def order_hash(seed: int, *keys: Column | str) -> Column:
    """The place of a row in a seeded random order: a digest of its key, alike wherever it is computed."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]))


def rule_examples(df: DataFrame, rule: str, text: str, n: int, pool: int = 40, seed: int = 13) -> DataFrame:
    """SRT-7: n random examples of each rule, out of its first `pool` by text, with how often the rule fired."""
    w = Window.partitionBy(rule).orderBy(text)
    first = df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= pool)
    some = first_by(first.withColumn("_h", order_hash(seed, rule, text)), [rule], "_h", text, n=n).select(rule, text)
    return some.join(df.groupBy(rule).agg(F.count("*").alias("fired")), rule)


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """SET-3: keys of exactly one of two tables, and which; one aggregate, no anti-joins."""
    sides = a.select(key, F.lit(1).alias("side")).union(b.select(key, F.lit(2).alias("side")))
    seen = sides.groupBy(key).agg(F.bit_or("side").alias("side"))
    return seen.where("side < 3").select(key, F.when(F.col("side") == 1, "left").otherwise("right").alias("only_in"))


def run_union(runs: dict[str, DataFrame], keys: tuple[str, ...] = ("query", "uid"), rank: str = "rank") -> DataFrame:
    """SET-1: the distinct keys of several runs, with the rank in each run (null where it has none)."""
    parts = [df.select(*keys, *[F.col(rank).alias(f"{name}_rank") if n == name else F.lit(None).cast(df.schema[rank].dataType).alias(f"{n}_rank") for n in runs]) for name, df in runs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*keys).agg(*[F.min(f"{n}_rank").alias(f"{n}_rank") for n in runs])


def running_sums(df: DataFrame, order: list[Column | str], *columns: str) -> DataFrame:
    """df with <column>_sum, the sum of each column over all rows up to this one in a global order, in many tasks.

    The order must be total. Rows are range-partitioned by it and written once; a partition starts from the totals
    of those before (one row a partition on the driver), and sums within partitions do the rest.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    runs = cut(runs.withColumn("_run", F.shiftright("_id", 33)), "sums")
    rows, start = [], [0.0] * len(columns)
    for r in sorted(runs.groupBy("_run").agg(*[F.sum(c).cast("double").alias(c) for c in columns]).collect(), key=lambda r: r["_run"]):
        rows.append((r["_run"], *start))
        start = [a + (r[c] or 0.0) for a, c in zip(start, columns, strict=True)]
    offsets = spark.createDataFrame(rows or [(-1, *start)], "_run long, " + ", ".join(f"_start_{i} double" for i in range(len(columns))))
    w = Window.partitionBy("_run").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    out = runs.withColumns({f"{c}_sum": F.sum(c).over(w) for c in columns}).join(F.broadcast(offsets), "_run")
    return out.withColumns({f"{c}_sum": F.col(f"{c}_sum") + F.col(f"_start_{i}") for i, c in enumerate(columns)}).drop("_id", "_run", *[f"_start_{i}" for i in range(len(columns))])


def interval_pairs(df: DataFrame, key: str, id_: str, lo: str, hi: str, days: int) -> DataFrame:
    """JN-8: a, b (ids, a < b) and gap of rows of one key whose closed date intervals are at most `days` apart.

    Time is cut into windows; a row is in those that it touches, its later end stretched by `days`, and rows meet in
    a window, so a key with very many rows is spread over its windows. A pair counts in the first one it shares.
    """
    width = max(1, days) + 1
    day = lambda x, more=0: F.floor((F.datediff(F.col(x), F.lit("1970-01-01")) + more) / width)
    rows = df.where(F.col(lo).isNotNull() & F.col(hi).isNotNull()).select(key, id_, lo, hi, day(lo).alias("from"), F.sequence(day(lo), day(hi, days)).alias("ws"))
    a, b = (rows.select(key, F.col(id_).alias(s), F.col(lo).alias(f"lo_{s}"), F.col(hi).alias(f"hi_{s}"), F.col("from").alias(f"from_{s}"), F.explode("ws").alias("w")) for s in "ab")
    gap = date_gap(F.col("lo_a"), F.col("hi_a"), F.col("lo_b"), F.col("hi_b"))
    met = a.join(b, [key, "w"]).where((F.col("a") < F.col("b")) & (F.col("w") == F.greatest("from_a", "from_b")))
    return met.select("a", "b", gap.alias("gap")).where(F.col("gap") <= days)


def ranked(df: DataFrame, *order: Column | str) -> DataFrame:
    """df with rank, from 1, in a global order, without bringing all rows to one task.

    Rows are range-partitioned by the order and written once; a partition's offset is the count of those before.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "ranked").withColumn("_run", F.shiftright("_id", 33))
    rows, start = [], 0
    for r in sorted(runs.groupBy("_run").count().collect(), key=lambda r: r["_run"]):  # a row a partition
        rows.append((r["_run"], start))
        start += r["count"]
    offsets = spark.createDataFrame(rows or [(-1, 0)], "_run long, _start long")
    return runs.join(F.broadcast(offsets), "_run").withColumn("rank", F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_run", "_id", "_start")
