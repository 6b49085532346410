"""Best-fit packing of tokenized documents into sequences, in bulk-synchronous rounds.

Every round sorts the pieces that are left and the open gaps by size, over range partitions. A sweep down a partition
gives each piece the smallest gap that is still free at its size (its successor); pieces that want the same gap are
told apart by their rank in the sweep. What a partition could not match, pieces first and gaps behind them, is matched
between partitions by the same rule, from their counts alone (two numbers a partition) and the ranks of what is left.
Gaps are then updated, and the next round begins, until nothing is left.

As many sequences as the tokens need at least are open from the start; more are opened when pieces are larger than
every gap, again as many as those pieces need at least. A gap that could hold several of the largest piece left stands
several times in the order, once a piece: rounds then follow the spread of sizes, not the number of pieces to a sequence.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import bounded_batches, free_name, release
from millrace.session import cut, table

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
CAPACITY, END = 4096, 1
#: Bytes of text that a task splits at once; parts of words whose ids it remembers, and letters of those.
RUN, MEMORY, REMEMBERED = 8 << 20, 1_000_000, 64
#: Rows that a partition of a sweep holds at most, in expectation.
SWEEP_ROWS = 1 << 20

# How the vocabulary file says that it splits texts (fixed values). White space parts its tokens, so that words have ids of their own.
SPLITS_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# Words of these characters are the same when normalised but for their case, and fall into parts by the second expression.
_PLAIN = "^[!-~À-ÖØ-öø-ÿ]+$"
_LETTERS = "^[a-zß-öø-ÿ]+$"
_PARTS = "('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+)"
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


class Remembered(dict):
    """Ids (little-endian bytes) of the parts of words. When full, the older half goes; what is asked for again comes back."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        if len(key) <= REMEMBERED:
            if len(self) >= MEMORY // 2:
                self.old = dict(self)
                self.clear()
            self[key] = ids
        return ids


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _strings(a: pa.Array) -> list[str]:
    return a.to_numpy(zero_copy_only=False).tolist()


def _ends(a: pa.Array) -> np.ndarray:
    """Where each value of an array of bytes begins, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(pc.binary_length(a).to_numpy(), dtype=np.int64)])


def _data(a: pa.Array) -> pa.Buffer:
    return a.buffers()[2] or pa.py_buffer(b"")


class Encoder:
    """Ids of texts by a vocabulary file of the tokenizers library, those of the library, without special tokens.

    Where the file's rules let words stand alone, each distinct word of a run of texts is worked out once, and plain
    words by the model itself, part by part; all else goes through the library.
    """

    def __init__(self, source: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.whole = Tokenizer.from_str(source)
        self.model, rules = self.whole.model, json.loads(source)
        self.added = tuple({t["content"][:2] for t in rules.get("added_tokens", [])})
        normal = [n["type"] for n in (rules.get("normalizer") or {}).get("normalizers", [])]
        split = (rules.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.by_word = normal == NORMALIZERS and split.get("pattern") == {"Regex": SPLITS_WORDS}
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.parts = Remembered(self._part)

    def _part(self, part: str) -> bytes:
        return _bytes([t.id for t in self.model.tokenize(part if part.isascii() else part.translate(self.letters))])

    def text(self, text: str) -> bytes:
        return _bytes(self.whole.encode(text, add_special_tokens=False).ids)

    def many(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text."""
        if not self.by_word:
            yield from (self.text(t.decode()) for t in texts)
            return
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        plain = pc.match_substring_regex(words, _PLAIN)
        for a in self.added:
            plain = pc.and_not(plain, pc.match_substring(words, a))
        lower = pc.utf8_lower(words.filter(plain))
        single = pc.match_substring_regex(lower, _LETTERS)  # most words are one part
        parts = pc.ascii_split_whitespace(pc.ascii_ltrim_whitespace(pc.replace_substring_regex(lower.filter(pc.invert(single)), _PARTS, r" \1")))
        each = pa.concat_arrays([lower.filter(single), parts.flatten()]).dictionary_encode()
        known = pa.array([self.parts[p] for p in _strings(each.dictionary)], pa.large_binary()).take(each.indices)
        # the parts of a word lie together: a word's ids are those from its first part to the next word's
        plain, single = (x.to_numpy(zero_copy_only=False) for x in (plain, single))
        firsts = np.concatenate([np.arange(single.sum()), single.sum() + parts.offsets.to_numpy()])
        ids = pa.Array.from_buffers(pa.large_binary(), len(single), [None, pa.py_buffer(_ends(known)[firsts]), _data(known)])
        ids = pa.concat_arrays([ids, pa.array([self.text(w) if w else b"" for w in _strings(words.filter(pa.array(~plain)))], pa.large_binary())])
        place = np.empty(len(words), np.int64)
        at = np.flatnonzero(plain)
        place[np.concatenate([at[single], at[~single], np.flatnonzero(~plain)])] = np.arange(len(words))
        out = ids.take(pa.array(place[coded.indices.to_numpy()]))
        data = memoryview(_data(out))
        yield from (bytes(data[a:b]) for a, b in pairwise(_ends(out)[split.offsets.to_numpy()].tolist()))

    def runs(self, text: bytes) -> Iterator[bytes]:
        """The text in runs of about RUN bytes that begin and end at white space, so that memory doesn't follow its length."""
        at = 0
        while self.by_word and len(text) - at > RUN:
            blank = _BLANK.search(text, at + RUN)
            if not blank:
                break
            yield text[at : blank.start()]
            at = blank.start()
        yield text[at:]


_encoders: dict[int, Encoder] = {}


def encoder(source: str) -> Encoder:
    """That of this process: workers live on, and so does what they remember."""
    key = zlib.crc32(source.encode())
    if key not in _encoders:
        _encoders[key] = Encoder(source)
    return _encoders[key]


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end: int | None = END, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each row's pieces of at most `capacity` tokens, with keep_ids also ids.

    The file of the tokenizer is read here and sent to the tasks. A null text is empty; without an end marker an empty
    text has one piece without tokens.
    """
    source, last = Path(tokenizer).read_text(encoding="utf-8"), b"" if end is None else np.array([end], "<u4").tobytes()
    size, sent = 4 * capacity, docs.sparkSession.sparkContext.broadcast(source)

    def cuts(runs: Iterator[bytes]) -> Iterator[bytes]:
        held = b""
        for r in runs:
            held += r
            whole = (len(held) - 1) // size * size  # the last piece waits for the end
            for i in range(0, max(0, whole), size):
                yield held[i : i + size]
            held = held[max(0, whole) :]
        if len(held) + len(last) > size:
            yield held + last[: size - len(held)]
            held = b""
        yield held + last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(sent.value)

        def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            whose, number, start, length, crc, kept = [], [], [], [], [], []
            short = enc.many([t for t in texts if len(t) <= RUN])
            for i, t in enumerate(texts):
                runs = iter([next(short)]) if len(t) <= RUN else (x for r in enc.runs(t) for x in enc.many([r]))
                before = 0
                for k, p in enumerate(cuts(runs)):
                    whose.append(i), number.append(k), start.append(before), length.append(len(p) // 4), crc.append(zlib.crc32(p))
                    before += len(p) // 4
                    if keep_ids:
                        kept.append(np.frombuffer(p, "<u4").astype(np.int64))
            out = [batch.column("doc_id").take(pa.array(whose, pa.int64())), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            return pa.RecordBatch.from_arrays(out + ([pa.array(kept, pa.list_(pa.int64()))] if keep_ids else []), names)

        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.column("text").nbytes
            if n >= RUN:
                yield from map(rows, joined(held))
                held, n = [], 0
        yield from map(rows, joined(held))
        release()

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def joined(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    return pa.Table.from_batches(batches).combine_chunks().to_batches() if batches else []


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Down a partition: a gap goes on the stack, a piece takes the top one. What is left is numbered: pieces as they come, gaps from the top."""
    part, stack, free = TaskContext.get().partitionId(), [], 0

    def out(key: list, gap: list, size: list, rank: list) -> pa.RecordBatch:
        columns = {"part": [part] * len(key), "key": key, "gap": gap, "size": size, "rank": rank}
        return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in columns.items()})

    for b in batches:
        key, gap, size, rank = [], [], [], []
        for is_piece, number, s in zip(b.column("is_piece").to_pylist(), b.column("number").to_pylist(), b.column("size").to_pylist(), strict=True):
            if not is_piece:
                stack.append(number)
                continue
            key.append(number)
            size.append(s)
            gap.append(stack.pop() if stack else None)
            rank.append(free if gap[-1] is None else None)
            free += gap[-1] is None
        yield out(key, gap, size, rank)
    stack.reverse()
    for i in range(0, len(stack), 1 << 16):
        some = stack[i : i + (1 << 16)]
        yield out([None] * len(some), some, [None] * len(some), list(range(i, i + len(some))))


def across(totals: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(part, first, last, of, at): the pieces left in part with ranks first to last - 1 take the gaps left in partition of, from rank at on.

    totals: partition, pieces left and gaps left, of each. The rule is that of a partition: the nearest gaps above come first.
    """
    stack, out = [], []
    for part, free, gaps in sorted(totals):
        first = 0
        while first < free and stack:
            of, at, n = stack.pop()
            take = min(n, free - first)
            out.append((part, first, first + take, of, at))
            first += take
            if take < n:
                stack.append((of, at + take, n - take))
        if gaps:
            stack.append((part, 0, gaps))
    return out


def need(histogram: dict[int, int], capacity: int) -> int:
    """Sequences that pieces of these sizes need at least: by their sum, and as no two of over a half share one."""
    return max(-(-sum(s * n for s, n in histogram.items()) // capacity), sum(n for s, n in histogram.items() if 2 * s > capacity))


def best_fit(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """key and sequence of each item: items is key (long, unique, not negative) and size (1 to capacity).

    What reaches the driver is a number of items for each size, and two numbers a partition.
    """
    spark = items.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    opened = 0
    gaps, placed = None, []
    while True:
        counts = items.select("size", F.lit(True).alias("piece"))
        if gaps is not None:
            counts = counts.union(gaps.select("gap", F.lit(False)))
        sizes: dict[bool, dict[int, int]] = {True: {}, False: {}}
        for r in counts.groupBy("piece", "size").count().collect():  # a row a size
            sizes[r["piece"]][r["size"]] = r["count"]
        left, room = sizes[True], sizes[False]
        if not left:
            break
        most, least, widest = max(left), min(left), max(room, default=0)
        if most > widest:
            more = need({s: n for s, n in left.items() if s > widest}, capacity) if opened else need(left, capacity)
            fresh = spark.range(opened, opened + more).select(F.col("id").alias("seq"), F.lit(capacity).cast("long").alias("gap"))
            gaps = fresh if gaps is None else gaps.union(fresh)
            opened, room = opened + more, room | {capacity: room.get(capacity, 0) + more}
        gaps = gaps.where(F.col("gap") >= least)
        open_ = sum(n for s, n in room.items() if s >= least)
        # a wide gap stands there several times; twice as many places as there are pieces are enough
        times = F.when(F.col("gap") >= 2 * most, F.least(F.floor(F.col("gap") / most), F.lit(-(-2 * sum(left.values()) // open_)))).otherwise(1)
        places = gaps.select(F.col("gap").alias("size"), F.lit(False).alias("is_piece"), F.col("seq").alias("number"), F.explode(F.sequence(F.lit(1).cast("long"), times.cast("long"))).alias("_t")).drop("_t")
        rows = places.union(items.select("size", F.lit(True), "key"))
        n = max(parts, -(-(open_ + sum(left.values())) // SWEEP_ROWS))
        order = [F.desc("size"), F.asc("is_piece"), F.xxhash64("number"), F.col("number")]  # equal sizes, even a third of all, are dealt over many partitions
        swept = cut(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(sweep, "part long, key long, gap long, size long, rank long"), "pk-swept")
        kinds = swept.where("rank IS NOT NULL").groupBy("part").agg(F.count("key").alias("pieces"), F.count("gap").alias("gaps")).collect()
        runs = across([(r["part"], r["pieces"], r["gaps"]) for r in kinds])
        found = [swept.where("key IS NOT NULL AND gap IS NOT NULL").select("key", F.col("gap").alias("seq"), "size")]
        items = swept.where("key IS NOT NULL AND gap IS NULL").select("part", "key", "size", "rank")
        if runs:
            matched = cut(_ranks(items, runs).join(swept.where("key IS NULL").select(F.col("part").alias("of"), F.col("rank").alias("at"), F.col("gap").alias("seq")), ["of", "at"]).select("key", "seq", "size"), "pk-across")
            found.append(matched)
            items = _ranks(items, runs, others=True)
        items = items.select("key", "size")
        placed += [f.select("key", "seq") for f in found]
        change = gaps
        for f in found:
            change = change.union(f.select("seq", -F.col("size")))
        gaps = cut(change.groupBy("seq").agg(F.sum("gap").alias("gap")).where("gap > 0"), "pk-gaps")
    out = placed[0] if placed else items.select("key", F.col("size").alias("seq"))
    for p in placed[1:]:
        out = out.union(p)
    return out.select("key", F.col("seq").alias("sequence"))


def _ranks(items: DataFrame, runs: list[tuple], others: bool = False) -> DataFrame:
    """The items that take a gap of another partition, with its place (of, at); or the others."""
    by_part: dict[int, list] = {}
    for r in runs:  # sorted by rank in each partition
        by_part.setdefault(r[0], []).append(r[1:])
    sent = items.sparkSession.sparkContext.broadcast(by_part)  # two rows a partition at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = {p: [r[0] for r in rs] for p, rs in sent.value.items()}
        for b in batches:
            of, at = [], []
            for p, rank in zip(b.column("part").to_pylist(), b.column("rank").to_pylist(), strict=True):
                i = bisect_right(firsts.get(p, ()), rank) - 1
                first, last, other, place = sent.value[p][i] if i >= 0 else (0, 0, 0, 0)
                of.append(other if rank < last else None)
                at.append(place + rank - first if rank < last else None)
            out = pa.RecordBatch.from_arrays([b.column("key"), b.column("size"), pa.array(of, pa.int64()), pa.array(at, pa.int64())], ["key", "size", "of", "at"])
            yield out.filter(pc.invert(out.column("of").is_valid()) if others else out.column("of").is_valid())

    return items.mapInArrow(run, "key long, size long, of long, at long")


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end: int | None = END, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset and place of each piece of docs, with keep_ids also ids.

    docs: doc_id (of any type, null or repeated: each row is a document of its own), text and anything else. A null
    or empty text is the end marker alone. Only documents of more than `capacity` tokens are cut, into pieces of
    that many; the last may be shorter. offset is the number of tokens before the piece in its sequence, place
    its number there; within a sequence longer pieces come first. An empty table gives no rows.
    """
    row = free_name(docs, "_key")
    made = cut(pieces(docs, tokenizer, capacity, end, keep_ids).withColumn(row, F.monotonically_increasing_id()), "pk-pieces")
    whole = F.col("length") == capacity
    if end is None:
        whole = whole | (F.col("length") == 0)  # nothing to pack: alone
    rest = best_fit(made.where(~whole).select(F.col(row).alias("key"), F.col("length").alias("size")), capacity)
    alone = made.where(whole).withColumn("sequence_id", -F.col(row) - 1)
    out = made.join(rest.select(F.col("key").alias(row), F.col("sequence").alias("sequence_id")), row).select(*alone.columns).union(alone)
    w = Window.partitionBy("sequence_id").orderBy(F.desc("length"), row)  # at most `capacity` pieces
    before = F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    return out.withColumns({"offset": before, "place": F.row_number().over(w) - 1}).drop(row)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and starts (where its pieces begin) of each sequence, from pack(keep_ids=True): the rows to train on."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    each = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return each.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), F.transform("parts", lambda p: p["offset"]).alias("starts"))


def op13_packing(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer)


QUERIES = {"op13_packing": op13_packing}
