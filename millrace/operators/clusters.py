"""Clusters of links that are taken in order, none of which may span too many days."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.graph import connected_components
from millrace.session import cut, drop

#: Links that one task folds at most.
FOLD = 200_000
_SIDES = ("a", "a_lo", "a_hi", "b", "b_lo", "b_hi")
_MOVES = "old long, keep long, lo date, hi date"


def _open(days: int) -> Column:
    """Links of two clusters whose union is short enough. Clusters only grow, so a link that is not open never will be."""
    span = F.date_diff(F.greatest("a_hi", "b_hi"), F.least("a_lo", "b_lo"))
    return (F.col("a") != F.col("b")) & ~F.coalesce(span > days, F.lit(False))


def _first_for_both(live: DataFrame) -> DataFrame:
    """The moves of the links that come first for both of their clusters: what a single pass would do at their turn.

    The first link of each cluster is a partial minimum, so a cluster with very many links is no hot key; a link
    is taken if it is the first of two clusters.
    """
    link = F.struct("order", "x", "y", *_SIDES)
    ends = live.select(link.alias("l"), F.explode(F.array("a", "b")).alias("end"))
    taken = ends.groupBy("end").agg(F.min("l").alias("l")).groupBy("l").count().where("count = 2").select("l.*")
    keep = (F.least("a", "b").alias("keep"), F.least("a_lo", "b_lo").alias("lo"), F.greatest("a_hi", "b_hi").alias("hi"))
    return taken.select(F.explode(F.array("a", "b")).alias("old"), *keep)


def _fold(pdf: pd.DataFrame) -> pd.DataFrame:
    """The moves of a single pass over links, all of which are known."""
    parent, lo, hi = {}, {}, {}
    for s in "ab":
        for n, x, y in zip(pdf[s], pdf[f"{s}_lo"], pdf[f"{s}_hi"], strict=True):
            parent[n], lo[n], hi[n] = n, None if pd.isna(x) else x, None if pd.isna(y) else y

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    days = pdf["days"].iloc[0] if len(pdf) else 0
    for a, b in pdf.sort_values(["order", "x", "y"])[["a", "b"]].itertuples(index=False):
        x, y = sorted((find(a), find(b)))
        lows, highs = ([m[z] for z in (x, y) if m[z] is not None] for m in (lo, hi))
        if x == y or (lows and highs and (max(highs) - min(lows)).days > days):
            continue
        parent[y], lo[x], hi[x] = x, min(lows, default=None), max(highs, default=None)
    roots = [find(n) for n in parent]
    return pd.DataFrame({"old": list(parent), "keep": roots, "lo": [lo[r] for r in roots], "hi": [hi[r] for r in roots]})


def _moved(live: DataFrame, moves: DataFrame, days: int) -> DataFrame:
    """Links between the clusters that there are after the moves, those that can still be taken."""
    for s in "ab":
        m = moves.select(F.col("old").alias(s), "keep", "lo", "hi")
        # a cluster that moved has the span of the union, null only if it knows none
        span = {f"{s}_{e}": F.when(F.col("keep").isNull(), F.col(f"{s}_{e}")).otherwise(F.col(e)) for e in ("lo", "hi")}
        live = live.join(m, s, "left").withColumns({**span, s: F.coalesce("keep", s)}).drop("keep", "lo", "hi")
    return live.where(_open(days)).select("order", "x", "y", *_SIDES)


def span_limited_clusters(links: DataFrame, spans: DataFrame, days: int = 45, fold: int = FOLD) -> DataFrame:
    """CMP-1: node, cluster: links (a, b, order) are taken in order, unless the union would span over `days`.

    The order is that of (order, smaller end, larger end), so it is total; the cluster is its smallest node. spans:
    node, lo, hi (dates, null where unknown; unknown ends do not count). Links with a null end, or from a node to
    itself, do nothing; nodes without a link give no row.

    Whether a union is allowed depends on those before it, and the result is that of a single pass, in parallel: a
    link that comes first for both its clusters meets them as the pass would, so all such links are taken at
    once, in rounds. Links whose union is too long are dropped for good, as clusters only grow. Once no connected
    component has over `fold` links left, each is folded by one task. If a round settles few links, as in a chain
    whose links come one after the other, the first `fold` links of all are folded too: they come before the rest.
    """
    pair = links.where("a <> b").select(F.col("order").cast("long").alias("order"), F.least("a", "b").cast("long").alias("x"), F.greatest("a", "b").cast("long").alias("y"))
    known = spans.groupBy(F.col("node").cast("long").alias("node")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    full = pair.withColumns({"a": F.col("x"), "b": F.col("y")})
    for s in "ab":
        full = full.join(known.toDF(s, f"{s}_lo", f"{s}_hi"), s, "left")
    full = cut(full.select("order", "x", "y", *_SIDES), "span-links")
    nodes = cut(full.select(F.explode(F.array("x", "y")).alias("node")).distinct().withColumn("cluster", F.col("node")), "span-nodes")
    live = cut(full.where(_open(days)), "span-links")
    drop(full)
    left = live.count()

    def step(moves: DataFrame) -> None:
        nonlocal nodes, live
        moves = cut(moves, "span-moves")
        at = nodes.join(moves.select(F.col("old").alias("cluster"), "keep"), "cluster", "left").select("node", F.coalesce("keep", "cluster").alias("cluster"))
        old = nodes, live
        nodes, live = cut(at, "span-nodes"), cut(_moved(live, moves, days), "span-links")
        drop(*old, moves)

    folded = lambda df, key: df.withColumn("days", F.lit(days)).groupBy(key).applyInPandas(_fold, _MOVES)
    while left:
        of = connected_components(live)
        placed = live.join(of.withColumnRenamed("node", "a"), "a")
        if placed.groupBy("component").count().agg(F.max("count")).first()[0] <= fold:
            step(folded(placed, "component"))
            drop(of)
            break
        drop(of)
        step(_first_for_both(live))
        now = live.count()
        if now > fold and left - now < left // 8:
            step(folded(live.orderBy("order", "x", "y").limit(fold), "days"))
            now = live.count()
        left = now
    drop(live)
    return nodes
