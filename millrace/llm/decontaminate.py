"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions alone.

An item's windows are its runs of ``size`` consecutive words (all its words, if it has fewer). Windows are
seen as sets of shingles of five words (of all words, in a window of fewer). A pass over the documents writes
where shingles of the benchmark occur, with the words around; their counts give the order by rarity. As a
document must hold all shingles of a window, the necessary prefix is its rarest shingle, and a window with a
shingle that occurs nowhere is out. The positions are joined with these prefixes only (with a very large
benchmark they are sought in a second pass, and the first only counts). The offset of the shingle gives the
positional bound (the window would begin at position - offset, not before the first word), the length bound is
that it ends within the document; then the words of the window are compared one by one with those around the
position.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower
from millrace.operators.relational import may_be
from millrace.session import cut, drop, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SIZE, SHINGLE = 10, 5
#: Shingles (16 bytes each) and prefixes with their windows (200 bytes each) that are broadcast at most.
BROADCAST_SHINGLES, BROADCAST_WINDOWS = 1_000_000, 100_000
#: Beyond that, positions pass a filter of 2 ** SLOT_BITS times 64 bits, a broadcast of fixed size, before they are shuffled.
SLOT_BITS = 20
OWN = -1  # the key of position 0, which stands for the row itself


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def windows(benchmark: DataFrame, size: int) -> DataFrame:
    """Distinct windows: window (words), len, items (ids as strings); the number of windows is that of the items' words."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    w = w.where("item IS NOT NULL AND size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    each = w.select("item", "w", F.explode(starts).alias("s"))
    return each.select("item", F.slice("w", F.col("s"), F.lit(size)).alias("window")).distinct()


def _hash(w: Column, k: int, i: Column) -> Column:
    """Of the k words from 0-based i on."""
    return F.xxhash64(F.lit(k), *[F.get(w, i + j) for j in range(k)])


def _shingles(win: DataFrame, lengths: list[int]) -> DataFrame:
    """window_id, window, offset, k, shingle: all shingles of each window."""
    parts = []
    for k in lengths:
        own = win.where(F.col("k") == k)
        each = own.select("*", F.explode(F.sequence(F.lit(0), F.size("window") - k)).alias("offset"))
        parts.append(each.withColumn("shingle", _hash(F.col("window"), k, F.col("offset"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _of_words(w: Column, k: int) -> Column:
    """OWN, then the hash of every run of k words."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(w) - k), partial(_hash, w, k))
    own = F.array(F.lit(OWN).cast("long"))
    return F.when(F.size(w) >= k, F.concat(own, hashes)).otherwise(own)


def _positions(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """row, doc_id, w, k_at, at, shingle of every position (from 1) of every text; position 0 stands for the row.

    A text is split into words once, whatever the optimiser does: the words are bound to the variable of a
    lambda, they stand in one projection with the running number (nothing is pushed below that), and the
    outer explode infers no filter that would compute them again.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words(F.col("text")).alias("w"))
    bound = F.get(F.transform(F.array("w"), lambda w: F.array(*[_of_words(w, k) for k in lengths])), F.lit(0))
    hashed = rows.select("row", "doc_id", "w", bound.alias("hs"))
    if len(lengths) == 1:
        hashed = hashed.select("row", "doc_id", "w", F.lit(0).alias("k_at"), F.get("hs", F.lit(0)).alias("hs"))
    else:
        hashed = hashed.select("row", "doc_id", "w", F.posexplode_outer("hs").alias("k_at", "hs"))
    return hashed.select("row", "doc_id", "w", "k_at", F.posexplode_outer("hs").alias("at", "shingle"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and items (ids) for each row of docs.

    docs: doc_id and text; benchmark: item_id and text; further columns do not matter. A null text has no
    words; a null or wordless item, and an item with a null id, has no windows. Rows that repeat a doc_id
    are told apart and each gives a row. An empty benchmark contaminates nothing.
    """
    per_item = cut(windows(benchmark, size), "dc-items")
    distinct = per_item.select("window").distinct().withColumn("window_id", F.monotonically_increasing_id())
    win = cut(distinct.withColumn("k", F.least(F.size("window"), F.lit(shingle))), "dc-windows")
    lengths = sorted(r.k for r in win.select("k").distinct().collect())  # shingle at most
    if not lengths:
        drop(per_item, win)
        found = docs.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"))
        return _result(found.withColumns({"n_hit": F.lit(None).cast("long"), "items": F.lit(None).cast("array<string>")}))

    shingles = cut(_shingles(win, lengths), "dc-shingles")
    wanted = shingles.select("shingle").distinct()
    each, near = _positions(docs, lengths), None
    if wanted.count() <= BROADCAST_SHINGLES:
        # the only pass over the texts: split, hash, explode and join run as one stage
        mark = docs.sparkSession.range(1).select(F.lit(OWN).cast("long").alias("shingle"))
        near = cut(_context(each.join(F.broadcast(wanted.union(mark)), "shingle"), size), "dc-near")
        occurring = near.where("at > 0").groupBy("shingle").agg(F.count("*").alias("count"))
    else:
        occurring = may_be(each.where("at > 0").select("shingle"), wanted, "shingle", SLOT_BITS).groupBy("shingle").agg(F.count("*").alias("count")).join(wanted, "shingle")
    counts = cut(occurring, "dc-counts")

    rarest = F.min(F.struct("count", "shingle", "offset")).alias("p")
    held = shingles.join(counts, "shingle").groupBy("window_id").agg(rarest, F.count("*").alias("held"))
    whole = shingles.groupBy("window_id").agg(F.count("*").alias("all"), F.first("window").alias("window"))
    # a window of which some shingle occurs nowhere can't occur
    complete = held.join(whole, "window_id").where("held = all")
    prefix = cut(complete.select("window_id", "window", "p.shingle", "p.offset"), "dc-prefix")
    found = cut(_matches(each, prefix, size, near), "dc-hits")

    matches = found.where("window_id IS NOT NULL").select("row", "window_id", "start", "len")
    spots = matches.select("row", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("at"))
    hit = spots.distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    ids = per_item.join(win, "window").select("window_id", "item")
    items = matches.select("row", "window_id").distinct().join(ids, "window_id").select("row", "item").distinct()
    items = items.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))  # the benchmark's items at most
    base = found.where("window_id IS NULL").select("row", "doc_id", "n_words")
    out = cut(_result(base.join(hit, "row", "left").join(items, "row", "left")), "dc-result")
    drop(per_item, win, shingles, near, counts, prefix, found)
    return out


def _context(each: DataFrame, size: int) -> DataFrame:
    """Positions with the words around them that a window through them can hold; first is the number of words before these."""
    reach = size - 1
    first = F.greatest(F.col("at") - 1 - reach, F.lit(0))
    words_ = F.when(F.col("at") > 0, F.slice("w", first + 1, F.lit(size + reach)))
    return each.select("row", "doc_id", "k_at", "at", "shingle", first.alias("first"), F.size("w").cast("long").alias("n_words"), words_.alias("w"))


def _matches(each: DataFrame, prefix: DataFrame, size: int, near: DataFrame | None = None) -> DataFrame:
    """row, doc_id and n_words of every row (window_id null), and row, window_id, start, len of every match.

    near: the written positions of all shingles of the benchmark; without them those of prefixes are found here.
    """
    spark, own = each.sparkSession, F.lit(OWN).cast("long")
    null = {c: F.lit(None).cast(prefix.schema[c].dataType) for c in ("window_id", "window", "offset")}
    mark = spark.range(1).select(*[x.alias(c) for c, x in null.items()], own.alias("shingle"))
    keys = prefix.select(*null, "shingle").union(mark)
    start, length = F.col("at") - 1 - F.col("offset"), F.size("window")
    few = prefix.count() <= BROADCAST_WINDOWS
    if near is None and few:
        # split, hash, explode, join and compare run as one stage; the words themselves are never written
        joined = each.join(F.broadcast(keys), "shingle").withColumns({"first": F.lit(0), "n_words": F.size("w").cast("long")})
    else:
        # the number of a row is data from here on; a shingle that very many documents hold is split by AQE
        near = cut(_context(may_be(each, keys.select("shingle"), "shingle", SLOT_BITS), size), "dc-near") if near is None else near
        joined = near.join(F.broadcast(keys) if few else keys, "shingle")
    row = (F.col("at") == 0) & (F.col("k_at") == 0)
    equal = F.slice("w", start - F.col("first") + 1, F.greatest(length, F.lit(0))) == F.col("window")
    bounded = (start >= 0) & (start + length <= F.col("n_words"))
    match = F.when(F.col("window_id").isNotNull() & bounded, equal).otherwise(False)
    return joined.where(row | match).select("row", "doc_id", "n_words", "window_id", start.alias("start"), length.alias("len"))


def _result(found: DataFrame) -> DataFrame:
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), items.alias("items"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


_W = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLE = {
    "op2_decontaminate": rf"""
WITH d AS (SELECT doc_id, {_W} AS w FROM documents),
i AS (SELECT item_id, {_W} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, s, s + 9), ' ') AS win, least(len(w), 10) AS n
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS win
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens)),
m AS (SELECT doc_id, item_id, s, p.n FROM pos p JOIN win USING (win) WHERE win.n = p.n),
hit AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS spot FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM m GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""
}
