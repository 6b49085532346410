"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct five-word shingles. Every shingle is hashed to 64 bits; the top seven bits
choose one of 128 buckets and the least remaining value of each bucket is kept as a register of 16 bits:
6 bits of leading zeros and 10 mantissa bits (HyperMinHash, Yu and Weber 2017). Empty registers borrow from
the next full one. Bands of 4 registers are the LSH keys. Candidates of a bucket pass the estimate
(equal registers less the expected accidental collisions) and are then verified on their full sets.

Work grows with the pairs that are likely, not with the square of a group of copies:
* equal sets form one class first (an aggregate with map-side combine), and one text stands for it;
* every band pairs its members with one leader, chosen anew for each band; each member is verified against its
  likeliest leader, and components are computed; two members of one component need no comparison;
* a bucket that still holds several components is split by length class (sizes with a ratio under the wanted
  similarity never meet, exactly), and all its pairs of different components are compared. Where few rows share
  it, a join makes the pairs, a bounded number for each row. In a crowd, those outside its largest component
  meet all others in blocks: registers say which rows of a block have a likely partner there, the texts of these
  come to the block, and the task verifies likely pairs, the likeliest first, skipping those whose components it
  has joined by then. It returns links between components, never pairs of texts. A pair is the work of its first
  common bucket. Texts of a crowd with more shingles of their own than any partner could leave unmatched are out
  beforehand. So no leader hides a pair: each pair that shares a band is in one component or compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import map_arrow, release
from millrace.operators.graph import connected_components
from millrace.session import collect_garbage, cut, drop, table

WORDS, BUCKETS, ROWS = 5, 128, 4
BANDS = BUCKETS // ROWS
ZERO_BITS, MANTISSA = 6, 10
#: Shingles of one piece of a block's matrices.
COLUMNS = 8192
#: Members of a bucket and length class that a join pairs; with more they are compared in blocks of CROWD.
FEW, CROWD = 16, 512
#: The share of a block's pairs from which all are multiplied out rather than verified one by one.
DENSE = 1 / 16
#: Ids that are broadcast at most (16 bytes each); beyond it the texts are shuffled.
BROADCAST_IDS = 500_000
_P = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; bytes.lower and bytes.split touch ASCII alone."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    total = np.full(n, len(h) if len(h) < size else size, np.uint64)
    for j in range(min(size, len(h))):
        total += _mix(h[j : j + n] * _P[j] + np.uint64(j))
    return np.unique(_mix(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """BUCKETS registers of a sorted set: the first hash at or after each bucket's start is its minimum."""
    starts = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - 7)
    at = np.searchsorted(hashes, starts)
    # an empty bucket borrows from the next full one, around the ring
    return hashes[at % len(hashes)]


def compress(minima: np.ndarray) -> np.ndarray:
    """16-bit registers of raw minima: leading zeros of the 57 low bits, and the 10 bits after the leading one."""
    rest = minima << np.uint64(7)
    _, e = np.frexp((rest >> np.uint64(11)).astype(np.float64))
    zeros = np.where(rest == 0, 57, 53 - e).astype(np.uint64)
    mantissa = ((rest << zeros) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(documents, BANDS) keys of 64 bits, the lowest five of which are the band."""
    packed = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.zeros(packed.shape[:2], np.uint64)
    for j in range(ROWS):
        key = (key << np.uint64(16)) | packed[:, :, j]
    bands = np.arange(BANDS, dtype=np.uint64)
    key = _mix(key ^ _mix(bands + np.uint64(1))[None, :])
    return (key & ~np.uint64(BANDS - 1)) | bands[None, :]


def estimate_from(same: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard estimate by the number of equal registers, less those expected to be equal by accident."""
    n, m = np.maximum(n_a, n_b).astype(float), np.minimum(n_a, n_b).astype(float)
    ratio = (1 + n) / m
    accidents = 0.169919487159739093975315012348 * 2.0 ** (7 - MANTISSA) * 4 * n / m / ratio**2
    return np.clip((same - accidents) / (BUCKETS - accidents), 0, 1)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The estimate for rows of registers."""
    return estimate_from((a == b).sum(1), n_a, n_b)


def least_estimate(n_a: np.ndarray, n_b: np.ndarray, similarity: float) -> np.ndarray:
    """An estimate below this is 4.5 standard errors under the wanted similarity; small sets have few free registers."""
    v = similarity * (1 - similarity) * (1 / BUCKETS + 1 / np.minimum(n_a, n_b))
    return similarity - 4.5 * np.sqrt(v)


def _signatures(batch: pa.RecordBatch) -> pa.RecordBatch:
    n, hi, lo, regs, th, size = [], [], [], [], [], []
    for t in batch.column("text").cast(pa.binary()).to_pylist():
        s = shingle_set(t)
        d = xxhash.xxh3_128_intdigest(s.tobytes())
        n.append(len(s))
        hi.append((d >> 64) - (1 << 63))
        lo.append((d & (1 << 64) - 1) - (1 << 63))
        regs.append(compress(registers(s)).tobytes() if len(s) else None)
        th.append((xxhash.xxh64_intdigest(t or b"", seed=42) + (1 << 63)) % (1 << 64) - (1 << 63))  # Spark's xxhash64(text)
        size.append(len(t or b""))
    longs = [pa.array(x, pa.int64()) for x in (n, hi, lo, th, size)]
    names = ["n_shingles", "h1", "h2", "text_hash", "text_size"]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), *longs, pa.array(regs, pa.binary())], ["doc_id", *names, "regs"])


def _bands(batch: pa.RecordBatch) -> pa.RecordBatch:
    regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16).reshape(-1, BUCKETS)
    keys = band_keys(regs).astype(np.int64)
    nodes = np.repeat(batch.column("node").to_numpy(), BANDS)
    return pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes)], ["bucket", "node"])


def _estimates(similarity: float):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("regs_a", "regs_b"))
        n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        e = estimate(a, b, n_a, n_b)
        # the sizes alone rule out pairs with min / max below the wanted similarity
        ok = (e >= least_estimate(n_a, n_b, similarity)) & (np.minimum(n_a, n_b) >= similarity * np.maximum(n_a, n_b) - 1e-9)
        out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(e)], ["a", "b", "est"])
        return out.filter(pa.array(ok))

    return run


def _verify(percent: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        last, left, keep = None, None, []
        texts = [batch.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b")]
        for a, x, y in zip(batch.column("a").to_pylist(), *texts, strict=True):
            if a != last:
                last, left = a, shingle_set(x)
            right = shingle_set(y)
            both = len(np.intersect1d(left, right, assume_unique=True))
            keep.append(100 * both >= percent * (len(left) + len(right) - both) > 0)
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _with_registers(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that pass the estimate, with est."""
    for c in "ab":
        side = classes.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("regs").alias(f"regs_{c}"))
        pairs = pairs.join(side, c)
    return map_arrow(pairs, _estimates(similarity), "a long, b long, est double")


def _texts(nodes: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """node and text of the classes; a class's text is fetched by its hash and size, and once."""
    ids = classes.join(nodes.select("node").distinct(), "node", "left_semi").select("node", "rep.text_hash", "rep.text_size")
    ids = cut(ids, "nd-ids")
    text = F.coalesce("text", F.lit(""))
    hashed = rows.select("text", F.xxhash64(text).alias("text_hash"), F.octet_length(text).cast("long").alias("text_size"))
    few = ids.count() <= BROADCAST_IDS
    found = hashed.join(F.broadcast(ids) if few else ids, ["text_hash", "text_size"]).select("node", "text")
    out = cut(found.dropDuplicates(["node"]), "nd-texts")
    drop(ids)
    return out


def _verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar."""
    kept = _texts(pairs.select(F.explode(F.array("a", "b")).alias("node")), classes, rows)
    for c in "ba":
        pairs = pairs.join(kept.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")), c)
    out = cut(map_arrow(pairs.select("a", "b", "text_a", "text_b"), _verify(percent), "a long, b long"), "nd-links")
    drop(kept)
    return out


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of one side shares with each of the other: exact, as a product of matrices."""
    both = np.zeros((len(left), len(right)), np.float32)  # exact: counts are far below 2 ** 24
    sides = [(np.concatenate(x), np.repeat(np.arange(len(x)), [len(s) for s in x])) for x in (left, right)]
    shared = np.intersect1d(*[np.unique(h) for h, _ in sides])
    for at in range(0, len(shared), COLUMNS):
        part, dense = shared[at : at + COLUMNS], []
        for (h, row), x in zip(sides, (left, right), strict=True):
            c = np.minimum(np.searchsorted(part, h), len(part) - 1)
            ok, m = part[c] == h, np.zeros((len(x), len(part)), np.float32)
            m[row[ok], c[ok]] = 1
            dense.append(m)
        both += dense[0] @ dense[1].T
    return both


def _own(batch: pa.RecordBatch) -> pa.RecordBatch:
    """node and shingle of every text of a batch."""
    sets = [shingle_set(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
    nodes = np.repeat(batch.column("node").to_numpy(), [len(s) for s in sets])
    shingles = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(shingles, pa.int64())], ["node", "shingle"])


class Block:
    """Strangers and members of a bucket in one task."""

    def __init__(self, pdf: pd.DataFrame, similarity: float):
        self.left, self.right = (pdf[pdf["stranger"]].reset_index(drop=True), pdf[~pdf["stranger"]].reset_index(drop=True))
        self.similarity, self.band = similarity, int(pdf["bucket"].iloc[0]) & (BANDS - 1)

    def likely(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of strangers and of members, and the estimate, of likely pairs whose first common bucket is this one."""
        a, b = self.left, self.right
        # once a pair, in one order if both are strangers here
        new = a["comp"].to_numpy()[:, None] != b["comp"].to_numpy()[None]
        new &= (b["comp"] == b["main"]).to_numpy()[None] | (a["node"].to_numpy()[:, None] < b["node"].to_numpy()[None])
        x, y = np.nonzero(new & (a["home"].to_numpy()[:, None] | b["home"].to_numpy()[None]))
        n_a, n_b = a["n"].to_numpy(), b["n"].to_numpy()
        most = np.minimum(a["free"].to_numpy()[x], b["free"].to_numpy()[y])  # what either shares with anyone
        ok = most >= self.similarity * (n_a[x] + n_b[y] - most) - 1e-9
        x, y = x[ok], y[ok]
        regs_a, regs_b = (np.frombuffer(b"".join(d["regs"]), np.uint16).reshape(-1, BUCKETS) for d in (a, b))
        out = []
        for at in range(0, len(x), 1 << 15):
            i, j = x[at : at + (1 << 15)], y[at : at + (1 << 15)]
            same = regs_a[i] == regs_b[j]
            est = estimate_from(same.sum(1), n_a[i], n_b[j])
            keep = est >= least_estimate(n_a[i], n_b[j], self.similarity)
            if self.band:
                earlier = same[:, : self.band * ROWS].reshape(len(i), self.band, ROWS).all(2).any(1)
                keep &= ~earlier
            out.append((i[keep], j[keep], est[keep]))
        return tuple(np.concatenate(v) for v in zip(*out, strict=True)) if out else (x, y, np.zeros(0))

    def links(self, percent: int, dense: float) -> np.ndarray:
        """Pairs of components that some likely pair links."""
        x, y, est = self.likely()
        comps = [self.left["comp"].to_numpy(), self.right["comp"].to_numpy()]
        sets = [[shingle_set(t.encode()) for t in d["text"]] for d in (self.left, self.right)]
        sizes = [np.array([len(s) for s in side]) for side in sets]
        if len(x) > dense * len(self.left) * len(self.right):
            both = common(*sets)[x, y]
            ok = 100 * both.astype(np.float64) >= percent * (sizes[0][x] + sizes[1][y] - both)
            found = np.column_stack([comps[0][x[ok]], comps[1][y[ok]]])
            return np.unique(np.sort(found, axis=1), axis=0)
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.setdefault(c, c) != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        out = []
        for i in np.argsort(-est, kind="stable"):
            p, q = find(int(comps[0][x[i]])), find(int(comps[1][y[i]]))
            if p == q:
                continue
            left, right = sets[0][x[i]], sets[1][y[i]]
            both = len(np.intersect1d(left, right, assume_unique=True))
            if 100 * both >= percent * (len(left) + len(right) - both) > 0:
                root[max(p, q)] = min(p, q)
                out.append(sorted((int(comps[0][x[i]]), int(comps[1][y[i]]))))
        return np.array(out, np.int64).reshape(-1, 2)


KEYS = ["bucket", "length", "at", "strangers"]


def _partners(similarity: float):
    """The rows of a block that have a likely partner there."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        b = Block(pdf, similarity)
        x, y, _ = b.likely()
        found = pd.concat([b.left.iloc[np.unique(x)], b.right.iloc[np.unique(y)]])
        release()
        return found[[*KEYS, "home", "node", "comp", "main", "n", "free", "regs", "stranger"]]

    return run


def _block_links(similarity: float, percent: int, dense: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        found = Block(pdf, similarity).links(percent, dense) if pdf["stranger"].any() and not pdf["stranger"].all() else np.empty((0, 2), np.int64)
        release()
        return pd.DataFrame(found, columns=["a", "b"])

    return run


def _hidden_links(mates: DataFrame, comps: DataFrame, classes: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components among all that share a bucket, not only those with its leader."""
    similarity = percent / 100
    # similar sizes are in one class or in neighbouring ones; the margin is for rounding
    width = -float(np.log(similarity)) * (1 + 1e-6)
    length = F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(width)).cast("int")
    placed = mates.select("bucket", "node").join(classes.select("node", F.col("n_shingles").alias("n")), "node")
    placed = placed.join(comps, "node", "left").withColumnRenamed("n", "n_shingles")
    home, guest = F.struct(length.alias("length"), F.lit(True).alias("home")), F.struct((length + 1).alias("length"), F.lit(False).alias("home"))
    placed = placed.select("bucket", "node", "n_shingles", F.coalesce("component", "node").alias("comp"), F.explode(F.array(home, guest)).alias("at"))
    placed = cut(placed.select("bucket", "at.length", "at.home", "node", "n_shingles", "comp"), "nd-placed")

    sizes = placed.groupBy("bucket", "length", "comp").agg(F.count("*").alias("n"), F.max("home").alias("home"))
    open_ = sizes.groupBy("bucket", "length").agg(
        F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("members"), F.count("*").alias("comps"), F.max("home").alias("homes")
    )
    open_ = open_.where("comps > 1 AND homes").select("bucket", "length", "members", F.col("main.n").alias("most"), F.col("main.comp").alias("main"))
    open_ = cut(open_, "nd-open")
    few = open_.count() <= BROADCAST_IDS
    left = placed.join(F.broadcast(open_) if few else open_, ["bucket", "length"])
    left = cut(left, "nd-left")

    # a bucket of few: its rows meet in a join that gives at most FEW for each
    small = left.where(F.col("members") <= FEW)
    x, y = (small.select("bucket", "length", *[F.col(c).alias(f"{c}_{i}") for c in ("node", "n_shingles", "comp", "home")]) for i in (1, 2))
    ratio = F.least("n_shingles_1", "n_shingles_2") >= F.lit(similarity) * F.greatest("n_shingles_1", "n_shingles_2") - 1e-9
    met = x.join(y, ["bucket", "length"]).where("node_1 < node_2 AND comp_1 <> comp_2 AND (home_1 OR home_2)").where(ratio)
    pairs = cut(met.select(F.col("node_1").alias("a"), F.col("node_2").alias("b")).distinct(), "nd-met")
    likely = cut(_with_registers(pairs, classes, similarity).select("a", "b"), "nd-likely")
    links = _verified(likely, classes, rows, percent)

    crowd = left.where(F.col("members") > FEW)
    nodes = cut(crowd.select("node").distinct(), "nd-crowd")
    made = [placed, open_, left, pairs, likely, nodes]
    if not nodes.isEmpty():
        texts = _texts(nodes, classes, rows)
        own = map_arrow(texts, _own, "node long, shingle long").groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"))
        own = own.where("n = 1").groupBy("node").agg(F.count("*").alias("own"))
        free = F.col("n_shingles") - F.coalesce("own", F.lit(0))
        able = nodes.join(classes.select("node", "n_shingles", "regs"), "node").join(own, "node", "left").select("node", "regs", free.alias("free"), "n_shingles")
        able = cut(able.where(free >= F.lit(similarity) * F.col("n_shingles") - 1e-9).drop("n_shingles"), "nd-able")
        each = crowd.join(able, "node").select("bucket", "length", "home", "node", "comp", "main", F.col("n_shingles").alias("n"), "free", "regs", "members", "most")
        blocks = _blocks(each, CROWD, ["home", "node", "comp", "main", "n", "free", "regs"])
        schema = "bucket long, length int, at int, strangers int, home boolean, node long, comp long, main long, n long, free long, regs binary, stranger boolean"
        near = blocks.groupBy(*KEYS).applyInPandas(_partners(similarity), schema)
        found = near.join(texts, "node").groupBy(*KEYS).applyInPandas(_block_links(similarity, percent, DENSE), "a long, b long").distinct()
        both = cut(links.union(found), "nd-hidden")
        made += [texts, able, links]
        links = both
    drop(*made)
    return links


def _blocks(rows: DataFrame, size: int, columns: list[str]) -> DataFrame:
    """Rows dealt over blocks (KEYS) of a bucket: every row outside its largest component meets every row in one of them."""
    counts = [F.greatest(F.ceil(n / size).cast("int"), F.lit(1)) for n in (F.col("members"), F.col("members") - F.col("most"))]
    own = [F.pmod(F.xxhash64("node", F.lit(i)), n).cast("int") for i, n in enumerate(counts)]
    each = [F.explode(F.sequence(F.lit(0), n - 1)) for n in counts]
    member = rows.select("bucket", "length", own[0].alias("at"), each[1].alias("strangers"), *columns, F.lit(False).alias("stranger"))
    outside = rows.where("comp <> main")
    return member.union(outside.select("bucket", "length", each[0].alias("at"), own[1].alias("strangers"), *columns, F.lit(True).alias("stranger")))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and group for each row of docs (doc_id and text, anything else).

    Texts are linked if 100 * |intersection| >= percent * |union| of their shingle sets; component_id is the
    smallest doc_id that links reach, itself included. A null, empty or blank text has an empty set and is
    linked with nothing. Rows with one set are one class, whatever their ids; rows that repeat a doc_id with
    different texts are linked each by its own text. Rows with a null doc_id are linked by their texts like
    others; if no row of a component has an id, its component_id is null and its rows are kept. group is one
    number a component, null for an empty set. An empty table gives no rows.
    """
    similarity, kind = percent / 100, docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = f"doc_id {kind}, n_shingles long, h1 long, h2 long, text_hash long, text_size long, regs binary"
    sig = cut(map_arrow(rows, _signatures, found), "nd-sig")
    by_set = sig.where("n_shingles > 0").groupBy("h1", "h2", "n_shingles").agg(
        F.min(F.struct("text_hash", "text_size")).alias("rep"), F.min("doc_id").alias("doc_id"), F.first("regs").alias("regs")
    )
    classes = cut(by_set.withColumn("node", F.monotonically_increasing_id()), "nd-classes")
    members = map_arrow(classes.select("node", "regs"), _bands, "bucket long, node long")
    order = F.struct(F.xxhash64("node", "bucket"), "node")
    leaders = members.groupBy("bucket").agg(F.min(order)["node"].alias("leader"), F.count("*").alias("size")).where("size > 1")
    mates = cut(members.join(leaders, "bucket"), "nd-mates")
    star = cut(mates.where("leader <> node").select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct(), "nd-star")
    likely = cut(_with_registers(star, classes, similarity), "nd-likely")
    ends = likely.select("est", F.col("a").alias("node"), F.col("b").alias("mate")).union(likely.select("est", "b", "a"))
    best = ends.groupBy("node").agg(F.max(F.struct("est", "mate"))["mate"].alias("mate"))
    first = cut(best.select(F.least("node", "mate").alias("a"), F.greatest("node", "mate").alias("b")).distinct(), "nd-first")
    links = _verified(first, classes, rows, percent)
    comps = connected_components(links)
    drop(star, likely, first)

    collect_garbage(docs.sparkSession)
    hidden = _hidden_links(mates, comps, classes, rows, percent)
    if not hidden.isEmpty():
        both = cut(links.union(hidden), "nd-links")
        drop(comps, links)
        links, comps = both, connected_components(both)
    drop(mates, hidden, links)

    placed = classes.join(comps, "node", "left").select("h1", "h2", "n_shingles", "doc_id", F.coalesce("component", "node").alias("group"))
    least = placed.groupBy("group").agg(F.min("doc_id").alias("least"))
    of_class = placed.join(least, "group").select("h1", "h2", "n_shingles", "least", "group")
    out = sig.drop("regs").join(of_class, ["h1", "h2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "group")
    out = cut(out, "nd-result")
    drop(sig, classes, comps)
    return out


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("group")


QUERIES = {"op6_near_dup": op6_near_dup}
