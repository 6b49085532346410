"""Personal data by weak supervision, in DataFrame functions alone.

Base spans come from four patterns and their checks and always stay. Further candidates (an address written
with "at" and "dot", a number of a telephone's or card's length that no base span covers, a dotted quad with
a part over 255) are judged by labelers that vote for, against or not at all:

* pattern labelers: shapes that real numbers and addresses have, or that sequence numbers and amounts have;
* gazetteer labelers: the word before the candidate is one that announces this kind of data, or another one;
* context labelers: what stands directly around it (a currency sign, a percent sign, a letter, a quote).

The distinct combinations of votes are counted in Spark; there are 3 ** labelers at most, so their counts
are a bounded table. Expectation-maximisation (Dawid and Skene 1979, two classes) estimates each labeler's
reliability from them; its posteriors then train a logistic regression over the votes and the shape of the
span, the final classifier, which is written back as a column expression.
"""

from __future__ import annotations

import math
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import free_name
from millrace.session import cut, drop, table

KINDS = ("email", "ip", "card", "phone")
# The base patterns, written so that no text makes them slow: a run of characters is entered at its start
# only (or where the last match ended), and possessive repeats do not go back. They match the same spans.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GUARDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
CANDIDATES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,4}+\.[0-9]{1,4}+\.[0-9]{1,4}+\.[0-9]{1,4}+(?![0-9.])",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9])\(?[0-9]{2,5}\)?[\x20.-][0-9]{2,4}[\x20.-][0-9]{2,5}(?![0-9])",
}
# fixed values: the words that announce each kind of data
GAZETTEER = {
    "email": "email e-mail mail mailto contact correo courriel adresse",
    "ip": "ip host server address addr client",
    "card": "card visa mastercard amex credit debit karte tarjeta carte pan",
    "phone": "phone tel telephone mobile cell call fax telefon telefono telephone movil",
}
OTHER = "version section chapter page no nr id isbn order invoice total sum amount year"
CANDIDATE_GUARDS = {"email": "at", "ip": ".", "card": "", "phone": ""}
CONTEXT = 40
#: Spans that are broadcast at most (under 100 bytes each, 20 MB); with more, the texts are shuffled to them.
BROADCAST_SPANS = 200_000


def _sum(cols) -> Column:
    return reduce(lambda a, b: a + b, cols)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes; all digits are summed from the right, every second one doubled."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int"))))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, r"[^0-9]", "")


def valid(kind: Column, m: Column) -> Column:
    """The check that a base match of each kind must pass."""
    n = F.length(_digits(m))
    value = lambda p: F.ltrim(p, F.lit("0"))
    small = F.forall(F.split(m, r"\."), lambda p: (F.length(value(p)) <= 3) & (F.coalesce(value(p).try_cast("int"), F.lit(0)) <= 255))
    card = (n >= 13) & (n <= 19) & luhn(_digits(m))
    return F.when(kind == "email", True).when(kind == "ip", small).when(kind == "card", card).otherwise((n >= 9) & (n <= 15))


def _matches(rows: DataFrame) -> DataFrame:
    """row, key, doc_id, kind, k, base, hit, start, end (code points), before, after of every match of all patterns.

    The pieces between the matches and the matches themselves come from the same pattern; lengths of both,
    summed along a text, are the positions. Texts are read once; only small rows are shuffled.
    """
    text, parts = F.col("text"), []
    for base, patterns, guards in ((True, PATTERNS, GUARDS), (False, CANDIDATES, CANDIDATE_GUARDS)):
        for k, kind in enumerate(KINDS):
            # a match at position 0 leaves an empty first piece, so pieces and matches alternate
            gaps = F.transform(F.split(text, patterns[kind], -1), lambda g: F.struct(F.length(g).alias("len"), F.right(g, F.lit(CONTEXT)).alias("tail"), F.left(g, F.lit(CONTEXT)).alias("head")))
            hits = F.regexp_extract_all(text, F.lit(patterns[kind]), F.lit(0))
            one = F.struct(F.lit(k).alias("k"), F.lit(kind).alias("kind"), F.lit(base).alias("base"), gaps.alias("gaps"), hits.alias("hits"))
            parts.append(F.when(F.contains(text, F.lit(guards[kind])) if guards[kind] else text.rlike("[0-9]"), F.when(text.rlike(patterns[kind]), one)))
    each = rows.select("row", "key", "doc_id", F.explode(F.array_compact(F.array(*parts))).alias("m")).select("row", "key", "doc_id", "m.k", "m.kind", "m.base", "m.gaps", F.posexplode("m.hits").alias("n", "hit"))
    gap, after = F.get("gaps", F.col("n")), F.get("gaps", F.col("n") + 1)
    out = each.select("row", "key", "doc_id", "k", "kind", "base", "n", "hit", gap["len"].alias("gap"), gap["tail"].alias("before"), after["head"].alias("after"))
    w = Window.partitionBy("row", "k", "base").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.length("hit")).cast("long")).over(w)
    return out.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit")).drop("gap", "n")


def _votes(c: DataFrame) -> dict[str, Column]:
    """The labelers: 1 for, -1 against, 0 abstains."""
    k, m, digits = F.col("kind"), F.col("hit"), _digits(F.col("hit"))
    n, word = F.length(digits), F.lower(F.regexp_extract(F.col("before"), r"([\p{L}-]+)[^\p{L}\n]{0,3}$", 1))
    of_kind = reduce(lambda a, x: a.when(k == x[0], word.isin(x[1].split())), GAZETTEER.items(), F.when(F.lit(False), False))
    of_other = reduce(lambda a, x: a.when(k == x[0], word.isin(sorted({w for o, ws in GAZETTEER.items() if o != x[0] for w in ws.split()} | set(OTHER.split())))), GAZETTEER.items(), F.when(F.lit(False), False))
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    seps = F.array_distinct(F.regexp_extract_all(m, F.lit(r"[\x20.-]"), F.lit(0)))
    return {
        "length": vote(F.when(k == "card", n.isin(15, 16)).when(k == "phone", n.isin(10, 11)).when(k == "email", F.length(m) >= 9).otherwise(n >= 7), F.when(k == "card", n < 15).when(k == "phone", n < 8).otherwise(False)),
        "grouping": vote(F.when(k == "card", m.rlike(r"^\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}$")).when(k == "phone", m.rlike(r"^\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}$")).when(k == "email", m.rlike(r"[\])]\x20?(com|org|net|edu|[a-z]{2})$")).otherwise(False), (F.size(seps) > 1) | m.rlike(r"^(19|20)\d\d[-.]\d\d[-.]\d\d$")),
        "checksum": F.when(k == "card", vote(luhn(digits), ~luhn(digits))).otherwise(0),
        "announced": vote(of_kind, of_other),
        "context": vote(F.col("before").rlike(r"[:=]\s?$"), F.col("before").rlike(r"[$€£#%\p{L}/.,_-]$") | F.col("after").rlike(r"^[%\p{L}/€$_-]")),
        "repeats": F.when(k.isin("card", "phone"), vote(F.lit(False), digits.rlike(r"^(\d)\1+$") | digits.rlike(r"^0000|^1234"))).otherwise(0),
        "range": F.when(k == "ip", vote(F.lit(False), ~valid(F.lit("ip"), m))).when(k == "phone", vote(digits.rlike(r"^[2-9]"), digits.rlike(r"^[01]{2}"))).otherwise(0),
    }


def em(counts: list[tuple[tuple[int, ...], int]], rounds: int = 60, prior: float = 0.3) -> tuple[float, list[dict[int, tuple[float, float]]], list[float]]:
    """Two-class Dawid-Skene with abstention over counted vote combinations: prior, reliabilities, posteriors.

    Starts from the majority of votes; a labeler's chance of each vote in either class is smoothed by one
    pseudo-row that agrees with it, so that a labeler which never votes stays neutral.
    """
    if not counts:
        return prior, [], []
    labelers = len(counts[0][0])
    post = [1 / (1 + math.exp(-1.5 * sum(v) + 0.7)) for v, _ in counts]
    rel: list[dict[int, tuple[float, float]]] = []
    for _ in range(rounds):
        pos = sum(p * n for p, (_, n) in zip(post, counts, strict=True))
        total = sum(n for _, n in counts)
        prior = (pos + 1) / (total + 3)
        rel = []
        for j in range(labelers):
            seen = {x: [0.3 + 1.4 * (x == 1), 0.3 + 1.4 * (x == -1)] for x in (-1, 0, 1)}
            for p, (v, n) in zip(post, counts, strict=True):
                seen[v[j]][0] += p * n
                seen[v[j]][1] += (1 - p) * n
            tops = [sum(s[c] for s in seen.values()) for c in (0, 1)]
            rel.append({x: (s[0] / tops[0], s[1] / tops[1]) for x, s in seen.items()})
        post = []
        for v, _ in counts:
            z = math.log(prior / (1 - prior)) + sum(math.log(r[x][0] / r[x][1]) for r, x in zip(rel, v, strict=True))
            post.append(1 / (1 + math.exp(-max(-30, min(30, z)))))
    return prior, rel, post


def logistic(rows: list[tuple[tuple[float, ...], float, float]], rounds: int = 400, rate: float = 0.5, decay: float = 1e-3) -> list[float]:
    """Weights (bias first) of a logistic regression on (features, soft label, weight) by full gradients."""
    if not rows:
        return [-4.0]
    w, total = [0.0] * (1 + len(rows[0][0])), sum(n for *_, n in rows)
    for _ in range(rounds):
        g = [decay * x for x in w]
        for f, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30, min(30, w[0] + sum(a * b for a, b in zip(w[1:], f, strict=True))))))
            d = (p - y) * n / total
            g[0] += d
            for i, x in enumerate(f):
                g[i + 1] += d * x
        w = [a - rate * b for a, b in zip(w, g, strict=True)]
    return w


def key_of() -> Column:
    """The doc_id and a hash of the text, not the place of a row: the same in every reading."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex(F.xxhash64(text)))


def _free(found: DataFrame) -> DataFrame:
    """The candidates among the matches that overlap no base span: two sweeps of each text, linear in its matches."""
    at = Window.partitionBy("row")
    before = at.orderBy("start", F.desc("base")).rowsBetween(Window.unboundedPreceding, 0)
    after = at.orderBy(F.desc("start"), "base").rowsBetween(Window.unboundedPreceding, 0)
    swept = found.withColumn("_last", F.max(F.when(F.col("base"), F.col("end"))).over(before))
    swept = swept.withColumn("_next", F.min(F.when(F.col("base"), F.col("start"))).over(after))
    clear = (F.coalesce("_last", F.lit(0)) <= F.col("start")) & (F.col("_next").isNull() | (F.col("_next") >= F.col("end")))
    return swept.where(~F.col("base") & clear).drop("_last", "_next")


def find_pii(docs: DataFrame, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): key, doc_id and text of every row, and key, doc_id, kind, k, start, end, base of every span found.

    docs: doc_id, text and anything else. A null text counts as empty and has no spans. Rows that repeat an id
    and its text share their key and spans. Added spans never overlap a base span, nor one another of their
    kind. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(key_of().alias("key"), "doc_id", text.alias("text"))
    narrow = rows.select(F.monotonically_increasing_id().alias("row"), "key", "doc_id", "text")
    found = cut(_matches(narrow), "pii-matches")
    sure = ~F.col("base") | valid(F.col("kind"), F.col("hit"))
    base = found.where("base").where(valid(F.col("kind"), F.col("hit"))).select("row", "key", "doc_id", "kind", "k", "start", "end", "base")
    free = _free(found.where(sure))
    votes = _votes(free)
    names = list(votes)
    voted = cut(free.withColumns(votes).select("row", "key", "doc_id", "kind", "k", "start", "end", *names), "pii-votes")
    counted = [(r.k, tuple(r[n] for n in names), r["count"]) for r in voted.groupBy("k", *names).count().collect()]  # 4 * 3 ** labelers rows at most
    accept = F.lit(False)
    for i in range(len(KINDS)):
        own = sorted((v, n) for k, v, n in counted if k == i)
        _, rel, post = em(own)
        w = logistic([(tuple(map(float, v)), p, float(n)) for (v, n), p in zip(own, post, strict=True)])
        if len(w) > 1:
            z = _sum([F.lit(w[0]), *(F.col(n) * F.lit(x) for n, x in zip(names, w[1:], strict=True))])
            accept = accept | ((F.col("k") == i) & (z >= math.log(threshold / (1 - threshold))))
    added = voted.where(accept).select("key", "doc_id", "kind", "k", "start", "end", F.lit(False).alias("base"))
    spans = cut(base.drop("row").union(added).distinct(), "pii-spans")
    drop(found, voted)
    return rows, spans


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, **options) -> DataFrame:
    """docs with every span replaced by its kind in brackets; n_chars, if there, is that of the new text.

    Overlapping spans are replaced once, by the kind of the first. A null text stays null.
    """
    _, spans = find_pii(docs, **options)
    w = Window.partitionBy("key").orderBy("start", "end", "k").rowsBetween(Window.unboundedPreceding, -1)
    cutting = spans.withColumn("reach", F.coalesce(F.max("end").over(w), F.lit(0)))  # where the text before a span begins
    lists = F.sort_array(F.collect_list(F.struct("start", "end", "kind", "reach"))).alias("spans")
    key, found = free_name(docs, "_key"), free_name(docs, "_found")
    per_row = cutting.groupBy(F.col("key").alias(key)).agg(F.struct(lists, F.max("end").alias("last")).alias(found))

    def piece(s: Column) -> Column:
        gap = F.substring(F.col("text"), (s["reach"] + 1).cast("int"), (s["start"] - s["reach"]).cast("int"))
        return F.when(s["start"] >= s["reach"], F.concat(gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")

    rest = F.substring(F.col("text"), (F.col(found)["last"] + 1).cast("int"), F.char_length("text"))
    changed = F.concat(F.array_join(F.transform(F.col(found)["spans"], piece), ""), rest)
    few = spans.count() <= BROADCAST_SPANS
    rows = docs.withColumn("text", F.col("text").cast("string")).withColumn(key, key_of())
    out = rows.join(F.broadcast(per_row) if few else per_row, key, "left").withColumn("text", F.when(F.col(found).isNull(), F.col("text")).otherwise(changed))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, spans = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    one = F.struct("k", "start", "end", "kind", "base")
    found = spans.groupBy("key").agg(F.sort_array(F.collect_list(one)).alias("spans"))
    out = rows.select("key", "doc_id").join(found, "key", "left").withColumn("spans", F.coalesce("spans", F.array_compact(F.array(F.lit(None).cast(found.schema["spans"].dataType.elementType)))))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter("spans", partial(lambda kind, s: s["base"] & (s["kind"] == kind), kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return out.select("doc_id", *counts, F.sha2(_text_of(base), 256).alias("base_sha256"), _text_of(F.col("spans")).alias("spans"))


QUERIES = {"op5_pii": op5_pii}
