"""SentencePiece encoding and decoding: the segmentation with the highest sum of piece scores, in parallel.

The best segmentation is a product of matrices over (max, +). Giant texts are split into chunks. A chunk's
transfer matrix holds, for every number of its first characters that a piece from the left already covers
and every number of characters by which its own last piece reaches into the next chunk, the best score
between the two. Products of the matrices from the left give each chunk the scores of its entry states;
with them every chunk finds alone from which entry each exit is reached; following those maps from the
right fixes all states; and then every chunk traces its pieces back alone. The result is the same, ties
included, as that of one pass over the whole text.

No piece holds a blank after another character or (here) a line break, so words are independent: between
two such cuts a matrix has rank one, and the pieces of a word are computed once and remembered.

The installed model was made for BPE merges; its pieces and scores are used as they are, but what is
computed is the best-scoring segmentation (as of a unigram model with these pieces), not greedy merges.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, free_name, release
from millrace.session import cut, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE, UNK_PENALTY, LEAST = "▁", 10.0, -1e8
#: Characters of a chunk; longer texts are split. Words that a worker remembers.
CHUNK, MEMO = 32_768, 60_000
#: Words that are worked out together, from so many on and so many at a time, up to so many characters each.
FEW_WORDS, WORDS_AT_ONCE, LONG_WORD = 24, 8192, 64
#: Chunks of a giant text whose matrices one task multiplies; more are multiplied in a tree.
FOLD = 64
#: Chunks whose states are broadcast at most (about 200 bytes each); for more, the chunks' texts are shuffled to them.
BROADCAST_STATES = 500_000
NONE = -np.inf


_KNOWN: dict[tuple, Vocabulary] = {}


def _intern(digest: int, *state) -> Vocabulary:
    """One vocabulary of a kind in a worker, so that the tasks which it runs in turn share the trie and the words."""
    key = (digest, *state[1:])
    if key not in _KNOWN:
        _KNOWN[key] = Vocabulary(*state)
    return _KNOWN[key]


@dataclass
class Vocabulary:
    """Pieces with scores, shipped to the workers; the trie is built there once."""

    pieces: list[tuple[str, int, float]]  # piece, id, score
    byte_ids: tuple[int, ...]  # ids of the 256 bytes, or empty
    unk_id: int
    dummy_prefix: bool = True
    memo: dict = field(default_factory=dict)

    def __reduce__(self):
        return _intern, (self.digest, self.pieces, tuple(self.byte_ids), self.unk_id, self.dummy_prefix)

    @cached_property
    def digest(self) -> int:
        return xxhash.xxh3_64_intdigest(repr(self.pieces).encode())

    @cached_property
    def trie(self) -> dict:
        root: dict = {}
        for piece, i, score in self.pieces:
            node = root
            for c in piece:
                node = node.setdefault(c, {})
            node[None] = (i, score)
        return root

    @cached_property
    def table(self) -> PieceTable:
        return PieceTable(self)

    @cached_property
    def unk_score(self) -> float:
        return min(s for *_, s in self.pieces) - UNK_PENALTY

    @cached_property
    def reach(self) -> int:
        return max(len(p) for p, *_ in self.pieces)

    @cached_property
    def words(self) -> re.Pattern:
        """The runs between two places that no piece crosses."""
        assert not any(SPACE in p.lstrip(SPACE) for p, *_ in self.pieces), "a piece holds a blank after another character"
        return re.compile(f"{SPACE}*[^{SPACE}{self.line}]+|{SPACE}+" + (f"|{self.line}" if self.line else ""))

    @cached_property
    def line(self) -> str:
        """A line break, if no piece holds one."""
        return "" if any("\n" in p for p, *_ in self.pieces) else "\n"

    @cached_property
    def surface(self) -> dict[int, bytes]:
        out = {i: p.encode("utf-8", "surrogatepass") for p, i, _ in self.pieces}
        return out | {i: bytes([b]) for b, i in enumerate(self.byte_ids)} | {self.unk_id: b" \xe2\x81\x87 "}

    def ids_of(self, start: int, end: int, piece: int, text: str) -> list[int]:
        if piece != self.unk_id:
            return [piece]
        return [self.byte_ids[b] for b in text[start:end].encode("utf-8", "replace")] if self.byte_ids else [piece]


def load(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a SentencePiece file. Scores far below all others (pieces that are never merged) count as just below them."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    floor = min(s for i in normal if (s := sp.get_score(i)) > LEAST) - 1
    by_byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.vocab_size()) if sp.is_byte(i)}
    return Vocabulary([(sp.id_to_piece(i), i, max(floor, sp.get_score(i))) for i in normal], tuple(by_byte[b] for b in range(256)) if len(by_byte) == 256 else (), sp.unk_id())


def prepare(text: str | None, v: Vocabulary) -> str:
    """Blanks become visible, and one is put before the text; other characters stay."""
    return ((SPACE if v.dummy_prefix else "") + text.replace(" ", SPACE)) if text else ""


def forward(v: Vocabulary, text: str, n: int, entry: list[float]):
    """Best scores of the positions 0 .. n + reach, with where their last piece began (-1: it came from the left) and its id.

    Pieces begin in the first n characters; entry[i] is the score with which position i is already reached.
    """
    size = min(len(text), n + v.reach - 1) + 1
    best = (list(entry) + [NONE] * size)[: max(size, 1)]
    back, ids, trie, unk, unk_id = [-1] * len(best), [-1] * len(best), v.trie, v.unk_score, v.unk_id
    for i in range(min(n, len(text))):
        b = best[i]
        if b == NONE:
            continue
        node, j, single = trie, i, False
        while j < size - 1:
            node = node.get(text[j])
            if node is None:
                break
            j += 1
            hit = node.get(None)
            if hit is not None:
                single = single or j == i + 1
                if b + hit[1] > best[j]:
                    best[j], back[j], ids[j] = b + hit[1], i, hit[0]
        if not single and i + 1 < size and b + unk > best[i + 1]:
            best[i + 1], back[i + 1], ids[i + 1] = b + unk, i, unk_id
    return best, back, ids


def trace(v: Vocabulary, text: str, back: list[int], ids: list[int], at: int) -> tuple[int, list[int]]:
    """The entry from which a position is reached, and the ids on the way."""
    path = []
    while back[at] >= 0:
        path.append((back[at], at, ids[at]))
        at = back[at]
    return at, [x for s, e, i in reversed(path) for x in v.ids_of(s, e, i, text)]


class _Memo(dict):
    """Ids of words, as bytes of 32-bit integers."""

    def __init__(self, v: Vocabulary):
        super().__init__()
        self.v = v

    def learn(self, words: list[str]) -> list[str]:
        """Add words that are not in it yet; returns those over its bound, for the caller to take out again."""
        at = max(0, MEMO - len(self))
        many = [w for w in words if len(w) <= LONG_WORD]
        if len(many) < FEW_WORDS:
            many = []
        for i in range(0, len(many), WORDS_AT_ONCE):
            part = many[i : i + WORDS_AT_ONCE]
            self.update(zip(part, best_of_words(self.v, part), strict=True))
        if len(many) < len(words):
            self.update((w, best_alone(self.v, w)) for w in words if not many or len(w) > LONG_WORD)
        return words[at:]


def memo(v: Vocabulary) -> _Memo:
    if "words" not in v.memo:
        v.memo["words"] = _Memo(v)
    return v.memo["words"]


class PieceTable:
    """Pieces by a hash of their characters, for looking up very many substrings at once."""

    BASE, SPREAD, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(44)

    def __init__(self, v: Vocabulary):
        found, longer = [], set()
        for piece, i, score in v.pieces:
            x = 0
            for c in piece:
                longer.add(x)  # a piece goes on from here
                x = (x * int(self.BASE) + ord(c) + 1) % (1 << 64)
            found.append((x * int(self.SPREAD) % (1 << 64), i, score, len(piece)))
        h, ids, scores, sizes = zip(*sorted(found), strict=True)
        self.hashes, self.ids, self.scores, self.sizes = np.array(h, np.uint64), np.array(ids, np.int32), np.array(scores, float), np.array(sizes)
        spot = self.hashes >> self.SHIFT
        self.begins = np.searchsorted(spot, np.arange(1 << 20, dtype=np.uint64)).astype(np.int32)
        self.probes = int(np.bincount(spot.astype(np.int64)).max())
        self.is_piece, self.goes_on = np.zeros(1 << 20, bool), np.zeros(1 << 20, bool)
        self.is_piece[spot] = True  # both may say so of strings of which it is not true
        self.goes_on[np.array(list(longer), np.uint64) * self.SPREAD >> self.SHIFT] = True

    def find(self, h: np.ndarray, spot: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of hashes h (spread; their spots) that are pieces of this size, and where these stand in the table."""
        rows = np.flatnonzero(self.is_piece[spot])
        want, at = h[rows], self.begins[spot[rows]]
        hits, places = [], []
        for k in range(self.probes):
            here = np.minimum(at + k, len(self.hashes) - 1)
            ok = np.flatnonzero((self.hashes[here] == want) & (self.sizes[here] == size))
            hits.append(rows[ok])
            places.append(here[ok])
            if len(ok) == len(rows):
                break
        return np.concatenate(hits), np.concatenate(places)


def best_alone(v: Vocabulary, word: str) -> bytes:
    """The ids of the best segmentation of a word, as bytes of 32-bit integers."""
    _, back, ids = forward(v, word, len(word), [0.0])
    return np.array(trace(v, word, back, ids, len(word))[1], np.int32).tobytes()


def best_of_words(v: Vocabulary, words: list[str]) -> list[bytes]:
    """The ids of the best segmentation of each word: forward() and trace() for all of them at once.

    First all pieces are found at all places, by their lengths; a place is given up as soon as no piece goes on there.
    Then the places are followed from the left, those at the same distance from their word's begin together.
    """
    t, k = v.table, len(words)
    n = np.fromiter(map(len, words), np.int64, k)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    ends, word, pos = np.cumsum(n), np.repeat(np.arange(k), n), np.arange(len(codes))
    offset, room = pos - (ends - n)[word], ends[word] - pos
    single = np.zeros(len(codes), bool)
    starts, sizes, pieces, scores = [], [], [], []
    at, h = pos, np.zeros(len(codes), np.uint64)
    for size in range(1, v.reach + 1):
        h = h * t.BASE + codes[at + size - 1]
        spread = h * t.SPREAD
        spot = (spread >> t.SHIFT).astype(np.int64)
        rows, found = t.find(spread, spot, size)
        starts.append(at[rows])
        sizes.append(np.full(len(rows), size))
        pieces.append(t.ids[found])
        scores.append(t.scores[found])
        if size == 1:
            single[at[rows]] = True
        on = t.goes_on[spot] & (room[at] > size)
        at, h = at[on], h[on]
        if not len(at):
            break
    strange = np.flatnonzero(~single)  # places of characters that are no pieces
    start = np.concatenate([*starts, strange])
    size = np.concatenate([*sizes, np.ones(len(strange), np.int64)])
    piece = np.concatenate([*pieces, np.full(len(strange), v.unk_id, np.int32)])
    score = np.concatenate([*scores, np.full(len(strange), v.unk_score)])
    order = np.argsort(offset[start].astype(np.uint16), kind="stable")
    start, size, piece, score = start[order], size[order], piece[order], score[order]
    begin = start + word[start]  # a word has one place more than characters
    end = begin + size
    best, back, ids = np.full(len(codes) + k, NONE), np.zeros(len(codes) + k, np.int64), np.zeros(len(codes) + k, np.int32)
    first, last = ends - n + np.arange(k), ends + np.arange(k)
    best[first] = 0.0
    bounds = np.searchsorted(offset[start], np.arange(n.max(initial=0) + 1))
    for a, b in zip(bounds, bounds[1:]):  # pieces of one begin have different ends; of equals the earliest begin stays, as in forward()
        to, total = end[a:b], best[begin[a:b]] + score[a:b]
        up = total > best[to]
        to = to[up]
        best[to], back[to], ids[to] = total[up], size[a:b][up], piece[a:b][up]
    on_path, here = np.zeros(len(best), bool), last[last > first]
    while len(here):
        on_path[here] = True
        here = here - back[here]
        here = here[back[here] > 0]
    path = ids[on_path]
    cuts_ = np.concatenate([[0], np.cumsum(on_path)[last]]) * 4
    raw = path.tobytes()
    out = [raw[a:b] for a, b in zip(cuts_.tolist(), cuts_[1:].tolist())]
    for x in np.unique(word[start[piece == v.unk_id]]).tolist():  # with characters that no piece covers: these become bytes
        out[x] = best_alone(v, words[x])
    return out


def encode_many(v: Vocabulary, prepared: Iterable[str], at_once: int = 1 << 18) -> list[np.ndarray]:
    """Ids of texts that begin and end at a cut.

    Texts are taken in runs of about `at_once` characters, whose lists of words are all that is held; words that the
    memory does not hold are worked out together.
    """
    out, run, size = [], [], 0
    for t in prepared:
        run.append(t)
        size += len(t)
        if size >= at_once:
            out += _encode_run(v, run)
            run, size = [], 0
    return out + _encode_run(v, run)


def _encode_run(v: Vocabulary, prepared: list[str]) -> list[np.ndarray]:
    words, known = [v.words.findall(t) for t in prepared], memo(v)
    over = known.learn(list(set(chain.from_iterable(words)).difference(known)))
    out = [np.frombuffer(b"".join(map(known.__getitem__, ws)), np.int32) for ws in words]
    for w in over:
        del known[w]
    return out


def encode(v: Vocabulary, prepared: str) -> np.ndarray:
    """Ids of a text that begins and ends at a cut."""
    return encode_many(v, [prepared])[0]


def decode(v: Vocabulary, ids) -> str:
    """The text of ids. Bytes that are no UTF-8 become the replacement character."""
    text = b"".join(map(v.surface.get, ids)).decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if v.dummy_prefix and text.startswith(" ") else text


def cuts(v: Vocabulary, text: str, n: int) -> tuple[int, int] | None:
    """The first and the last place among 1 .. n of a chunk that no piece crosses (where v.words begins a run); none may exist."""
    def cut_at(p: int) -> bool:
        a, b = text[p - 1], text[p]
        return b == SPACE != a or v.line in (a, b)

    end = min(n, len(text) - 1)
    first = next((p for p in range(1, end + 1) if cut_at(p)), None)
    return None if first is None else (first, next(p for p in range(end, 0, -1) if cut_at(p)))


def transfer(v: Vocabulary, text: str, n: int) -> np.ndarray:
    """The matrix of a chunk: its n characters, then at least reach - 1 more of the next chunk if there is one.

    Every path goes through the first and the last cut, so what lies between adds the same to all and decides
    nothing: the matrix is without it, and words are segmented once, in backtrace().
    """
    k = v.reach
    m = np.full((k, k), NONE)
    found = cuts(v, text, n)
    if found is None:
        for i in range(min(k, len(text) + 1)):
            best, _, _ = forward(v, text, n, [NONE] * i + [0.0])
            row = best[n : n + k]
            m[i, : len(row)] = row
        return m
    first, last = found
    head = text[:first]
    best, _, _ = forward(v, text[last:], n - last, [0.0])
    tail = np.full(k, NONE)
    row = best[n - last : n - last + k]
    tail[: len(row)] = row
    for i in range(min(k, first + 1)):
        b, _, _ = forward(v, head, first, [NONE] * i + [0.0])
        m[i] = b[first] + tail
    return m


def entries(v: Vocabulary, text: str, n: int, entry: list[float]) -> list[int]:
    """For each exit state the entry state it is reached from, -1 if it can't be reached."""
    k, found = v.reach, cuts(v, text, n)
    end = found[0] if found else None
    if end is not None:
        _, back, ids = forward(v, text[:end], end, entry[: end + 1])
        return [trace(v, text, back, ids, end)[0]] * k
    best, back, ids = forward(v, text, n, entry)
    return [trace(v, text, back, ids, n + j)[0] if n + j < len(best) and best[n + j] > NONE else -1 for j in range(k)]


def backtrace(v: Vocabulary, text: str, n: int, entry: list[float], out: int) -> np.ndarray:
    """The ids of the pieces that begin in the chunk, given its exit state."""
    found = cuts(v, text, n)
    if found is None:
        _, back, ids = forward(v, text, n, entry)
        return np.array(trace(v, text, back, ids, n + out)[1], np.int32)
    first, last = found
    _, back, ids = forward(v, text[:first], first, entry[: first + 1])
    head = trace(v, text[:first], back, ids, first)[1]
    _, back, ids = forward(v, text[last:], n - last, [0.0])
    tail = trace(v, text[last:], back, ids, n - last + out)[1]
    return np.concatenate([np.array(head, np.int32), encode(v, text[first:last]), np.array(tail, np.int32)])


def _long(parts: list[str], v: Vocabulary):  # the scan on one machine, for tests and for reading along
    """[(text with lookahead, n)] -> ids."""
    k, f, fs = v.reach, [0.0] + [NONE] * (v.reach - 1), []
    for t, n in parts:
        fs.append(f)
        f = (np.array(f)[:, None] + transfer(v, t, n)).max(0).tolist()
    assert len(f) == k
    state, out = 0, []
    for (t, n), f in zip(reversed(parts), reversed(fs), strict=True):
        out.append(backtrace(v, t, n, f, state))
        state = entries(v, t, n, f)[state]
    return [x for ids in reversed(out) for x in ids]


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(x) for x in values], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.zeros(0), kind))


def encode_documents(docs: DataFrame, v: Vocabulary, chunk: int = CHUNK, keep_text: bool = True) -> DataFrame:
    """docs with ids (array<int>) and round_trip (whether decoding gives the text back), without the text if it is not wanted.

    A null or empty text has no ids; a null's round_trip is null. A text that itself holds U+2581 decodes to
    a blank there. Columns of docs that bear one of these names are replaced; rows that repeat are kept.
    """
    if own := [c for c in docs.columns if c.lower() == "_row"]:  # the number of a row goes by this name
        other = free_name(docs, "_own_row")
        return encode_documents(docs.withColumnRenamed(own[0], other), v, chunk, keep_text).withColumnRenamed(other, own[0])
    spark, k = docs.sparkSession, v.reach
    base = docs.drop("ids", "round_trip").withColumn("text", F.col("text").cast("string"))
    kept = [f for f in base.schema.fields if keep_text or f.name.lower() != "text"]  # a text that is not wanted need not come back from Python
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    names = [f.name for f in kept]
    bounded_batches(spark)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = encode_many(v, (prepare(t, v) for t in texts))
            ok = [None if t is None else decode(v, x.tolist()) == t for t, x in zip(texts, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), _lists(ids, pa.int32()), pa.array(ok, pa.bool_())], [*names, "ids", "round_trip"])
        release()

    giant = F.coalesce(F.char_length("text"), F.lit(0)) > chunk
    out = base.where(~giant).mapInArrow(short, f"{schema}, ids array<int>, round_trip boolean")
    rows = cut(base.where(giant).withColumn("_row", F.monotonically_increasing_id()), "sp-giant")
    if rows.isEmpty():
        return out

    # chunks overlap by the characters that a piece can reach over
    n = F.char_length("text")
    at = F.explode(F.sequence(F.lit(0), F.floor((n - 1) / chunk).cast("int"))).alias("c")
    size = F.least(F.lit(chunk), n - F.col("c") * chunk).cast("int")
    chunks = rows.select("_row", "text", at).select("_row", "c", size.alias("n"), F.substring("text", F.col("c") * chunk + 1, F.lit(chunk + k)).alias("part"))
    chunks = cut(chunks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_row", "c"), "sp-chunks")

    def texts(pdf: pd.DataFrame) -> list[tuple[str, int]]:
        # the first chunk alone begins with the blank that is put before the text
        first = (pdf["c"] == 0) & v.dummy_prefix
        return [(prepare(t, v) if f else t.replace(" ", SPACE), int(n) + f) for t, n, f in zip(pdf["part"], pdf["n"], first, strict=True)]

    def matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"_row": pdf["_row"], "c": pdf["c"], "m": [transfer(v, *x).ravel() for x in texts(pdf)]})
        release()

    def maps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"_row": pdf["_row"], "c": pdf["c"], "entry": pdf["entry"], "from_": [entries(v, *x, list(f)) for x, f in zip(texts(pdf), pdf["entry"], strict=True)]})
        release()

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"_row": pdf["_row"], "c": pdf["c"], "part_ids": [backtrace(v, *x, list(f), int(e)) for x, f, e in zip(texts(pdf), pdf["entry"], pdf["exit"], strict=True)]})
        release()

    few = chunks.count() <= BROADCAST_STATES

    def with_states(states: DataFrame) -> DataFrame:
        return chunks.join(F.broadcast(states) if few else states, ["_row", "c"])

    most = chunks.groupBy("_row").agg(F.max("c").alias("c")).agg(F.max("c")).first()[0] + 1
    found_matrices = cut(chunks.mapInPandas(matrices, "_row long, c int, m array<double>"), "sp-matrices")
    scan = prefix_states(found_matrices, k, most, FOLD)
    found = cut(with_states(scan).mapInPandas(maps, "_row long, c int, entry array<double>, from_ array<int>"), "sp-maps")
    exits = suffix_states(found.select("_row", "c", F.col("from_").alias("m")), most, FOLD)
    state = found.select("_row", "c", "entry").join(exits, ["_row", "c"])
    done = with_states(state).mapInPandas(pieces, "_row long, c int, part_ids array<int>")
    joined = done.groupBy("_row").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("c", "part_ids"))), lambda x: x["part_ids"])).alias("ids"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [decode(v, ids) == t for t, ids in zip(batch.column("text").to_pylist(), batch.column("ids").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), batch.column("ids"), pa.array(ok, pa.bool_())], [*names, "ids", "round_trip"])

    giants = rows.join(joined, "_row").select(*base.columns, "ids").mapInArrow(check, f"{schema}, ids array<int>, round_trip boolean")
    return out.unionByName(giants)


def prefix_states(matrices: DataFrame, k: int, most: int, fold: int) -> DataFrame:
    """_row, c and entry (scores of the entry states) of chunks with matrices m, most of them in a document.

    The product over (max, +) is associative: more than `fold` matrices are multiplied in blocks, the blocks'
    products scanned in turn by this function, and each block goes on from its own entry.
    """
    start = [0.0] + [NONE] * (k - 1)

    def from_entry(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, out = pdf.sort_values("c"), []
        f = np.array(pdf["at"].iloc[0], float)
        for m in pdf["m"]:
            out.append(f)
            f = (f[:, None] + np.asarray(m).reshape(k, k)).max(0)
        return pd.DataFrame({"_row": pdf["_row"], "c": pdf["c"], "entry": out})

    def product(key, pdf: pd.DataFrame) -> pd.DataFrame:
        p = None
        for m in pdf.sort_values("c")["m"]:
            m = np.asarray(m).reshape(k, k)
            p = m if p is None else (p[:, :, None] + m[None]).max(1)
        return pd.DataFrame({"_row": [key[0]], "c": [key[1]], "m": [p.ravel()]})

    done = "_row long, c int, entry array<double>"
    if most <= fold:
        at = F.array(*[F.lit(x) for x in start]).alias("at")
        return matrices.select("_row", "c", "m", at).groupBy("_row").applyInPandas(from_entry, done)
    block = F.floor(F.col("c") / fold).cast("int").alias("b")
    blocks = matrices.select("_row", block, "c", "m")
    totals = cut(blocks.groupBy("_row", "b").applyInPandas(product, "_row long, c int, m array<double>"), "sp-blocks")
    entries_ = prefix_states(totals, k, -(-most // fold), fold).select("_row", F.col("c").alias("b"), F.col("entry").alias("at"))
    return blocks.join(entries_, ["_row", "b"]).groupBy("_row", "b").applyInPandas(from_entry, done)


def suffix_states(maps: DataFrame, most: int, fold: int) -> DataFrame:
    """_row, c and exit of chunks with maps m (exit state to entry state): the same tree, from the right, over maps."""

    def from_exit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, out = pdf.sort_values("c", ascending=False), []
        state = int(pdf["at"].iloc[0])
        for m in pdf["m"]:
            out.append(state)
            state = int(m[state])
        return pd.DataFrame({"_row": pdf["_row"], "c": pdf["c"], "exit": out})

    def composed(key, pdf: pd.DataFrame) -> pd.DataFrame:
        p = None
        for m in pdf.sort_values("c", ascending=False)["m"]:
            m = np.asarray(m)
            p = m if p is None else np.where(p >= 0, m[p], -1)
        return pd.DataFrame({"_row": [key[0]], "c": [key[1]], "m": [p]})

    done = "_row long, c int, exit int"
    if most <= fold:
        return maps.select("_row", "c", "m", F.lit(0).alias("at")).groupBy("_row").applyInPandas(from_exit, done)
    block = F.floor(F.col("c") / fold).cast("int").alias("b")
    blocks = maps.select("_row", block, "c", "m")
    totals = cut(blocks.groupBy("_row", "b").applyInPandas(composed, "_row long, c int, m array<int>"), "sp-blocks")
    exits = suffix_states(totals, -(-most // fold), fold).select("_row", F.col("c").alias("b"), F.col("exit").alias("at"))
    return blocks.join(exits, ["_row", "b"]).groupBy("_row", "b").applyInPandas(from_exit, done)


def decode_documents(encoded: DataFrame, v: Vocabulary) -> DataFrame:
    """encoded (with ids) plus decoded; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = [None if ids is None else decode(v, ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(t, pa.string())], [*batch.schema.names, "decoded"])

    base = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    bounded_batches(encoded.sparkSession)
    return base.mapInArrow(run, f"{schema}, decoded string")


def op10_pieces(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    out = encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), load(model), keep_text=False)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "round_trip", "ids")


QUERIES = {"op10_pieces": op10_pieces}
