import hashlib
import random
import re

from millrace.llm import pii
from tests.llm.oracle import PII, base_spans, luhn


def digest(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def test_base_spans_equal_plain_regexes(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in pii.op5_pii(spark, sf).collect():
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == digest(want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in want) for k in PII]
        assert set(want) <= set(r.spans.split(",")) or not want


def test_hard_texts(spark):
    rnd = random.Random(5)
    pieces = ["a@b.co", "x.y@z", "@", "1.2.3.4", "1.2.3.256", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (586) 555-8430", "+1+2 333 444 5555", "é", "\U0001f600", "_", "-", " ", ".", "0000001.2.3.4", "12", "a@b.com_x@c.de", "a@b.com@c.de", "+", "\n", "+49 ((", ")) 1"]
    rows = [(i, "".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 14)))) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "a" * 2000), (403, "1" * 2000 + "."), (404, "a.b@" * 300), (405, "a@b" + ".c" * 3000), (406, "ab " * 20 + "x@y.zz " * 300), (407, "1.1." * 300)]
    df = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, spans string")
    _, spans = pii.find_pii(df)
    got = {}
    for r in spans.where("base").orderBy("k", "start").collect():
        got.setdefault(r.doc_id, []).append(f"{r.kind}:{r.start}:{r.end}")
    for d, t in rows:
        assert got.get(d, []) == base_spans(t), (d, (t or "")[:100])


def test_giant_runs_take_linear_time(spark):
    rows = [(1, "a" * 400_000), (2, "1" * 400_000 + "."), (3, "a.b@" * 50_000), (4, "a@b" + ".c" * 100_000), (5, "1.1." * 50_000), (6, "+" * 100_000)]
    _, spans = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in spans.where("base AND kind = 'email'").collect()} == {3, 4}


def test_redaction_and_added_spans(spark):
    rows = [(i, f"Phone: ({200 + i}) 555-0{i:03d} or 12{i}.5% of {i * 7919} on 2021-05-1{i % 10}") for i in range(60)]
    rows += [(100 + i, f"mail me: joe{i} [at] site{i}.x[dot]com, or joe@site.org; card 4111 1111 1111 1111") for i in range(30)]
    rows += [(900, None), (901, ""), (901, "")]
    df = spark.createDataFrame([(d, t, len(t or "")) for d, t in rows], "doc_id long, text string, n_chars long")
    _, spans = pii.find_pii(df)
    added = spans.where("NOT base").groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in added}.get("phone") == 60
    out = pii.redact(df).collect()
    assert len(out) == len(rows) and out[0].text.startswith("Phone: [PHONE] or") and "2021-05-10" in out[0].text
    by = {r.doc_id: r for r in out}
    assert "[EMAIL]; card [CARD]" in by[100].text and by[100].n_chars == len(by[100].text)
    assert by[900].text is None and by[901].text == ""
    assert pii.redact(df.limit(0)).count() == 0


def test_em_finds_the_reliable_labeler():
    counts = [((1, 1, 0), 50), ((-1, -1, 1), 80), ((-1, -1, 0), 40), ((1, 1, 1), 30), ((1, -1, 0), 5), ((-1, 1, 1), 5)]
    prior, rel, post = pii.em(counts)
    assert post[0] > 0.9 and post[1] < 0.1 and 0.2 < prior < 0.6
    assert rel[0][1][0] > rel[2][1][0]


def test_redaction_keeps_columns_with_clashing_names(spark):
    names = ["doc_id", "text", "key", "spans", "last", "base", "_key", "_found", "row", "start", "k"]
    rows = [(1, "mail a@b.co now", "k1", "s", 7, True, "u", "v", 3, "st", 9), (None, "a@b.co", None, "t", 8, False, "w", "x", 4, "su", 10)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, "long,string,string,string,int,boolean,string,string,int,string,int".split(","), strict=True)))
    got = sorted((tuple(r) for r in pii.redact(df).collect()), key=str)
    assert pii.redact(df).columns == names
    assert got == sorted([(1, "mail [EMAIL] now", *rows[0][2:]), (None, "[EMAIL]", *rows[1][2:])], key=str)


def votes(kind, hit, before, after):
    """The labelers again, in plain Python."""
    d = re.sub("[^0-9]", "", hit)
    n, vote = len(d), lambda yes, no: 1 if yes else -1 if no else 0
    m = re.search(r"((?:[^\W\d_]|-)+)[^a-zA-ZÀ-ɏ\n]{0,3}$", before)
    word = m[1].lower() if m else ""
    others = {w for o, ws in pii.GAZETTEER.items() if o != kind for w in ws.split()} | set(pii.OTHER.split())
    good = {"card": n in (15, 16), "phone": n in (10, 11), "email": len(hit) >= 9, "ip": n >= 7}[kind]
    bad = {"card": n < 15, "phone": n < 8}.get(kind, False)
    shape = {"card": r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}", "phone": r"\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}", "email": r"(?s:.*)[\])] ?(com|org|net|edu|[a-z]{2})"}.get(kind)
    mixed = len(set(re.findall("[ .-]", hit))) > 1 or re.fullmatch(r"(19|20)\d\d[-.]\d\d[-.]\d\d", hit)
    number = kind in ("card", "phone")
    return (
        vote(good, bad),
        vote(shape and re.fullmatch(shape, hit), mixed),
        vote(luhn(d), not luhn(d)) if kind == "card" else 0,
        vote(word in pii.GAZETTEER[kind].split(), word in others),
        vote(re.search(r"[:=]\s?$", before), re.search(r"([$€£#%/.,_-]|[^\W\d_])$", before) or re.match(r"[%/€$_-]|[^\W\d_]", after)),
        vote(False, re.fullmatch(r"(\d)\1+", d) or re.match("0000|1234", d)) if number else 0,
        vote(False, any(int(x) > 255 for x in hit.split("."))) if kind == "ip" else vote(re.match("[2-9]", d), re.match("[01]{2}", d)) if kind == "phone" else 0,
    )


def test_added_spans_equal_plain_python(spark):
    """Candidates, votes, reliabilities and the classifier over a table with every kind of labeler at work."""
    rnd = random.Random(12)
    before = ["Phone: ", "tel ", "card no ", "visa ", "total $", "order ", "at ", "ip ", "version ", "mail ", "x", ", ", "= "]
    make = [
        lambda: f"{rnd.randrange(200, 999)}-{rnd.randrange(100, 999)}-{rnd.randrange(1000, 9999)}",
        lambda: f"({rnd.randrange(20, 999)}) {rnd.randrange(10, 999)}.{rnd.randrange(1000, 99999)}",
        lambda: " ".join(str(rnd.randrange(1000, 9999)) for _ in range(4)),
        lambda: str(rnd.randrange(10**13, 10**16)),
        lambda: ".".join(str(rnd.randrange(300)) for _ in range(4)),
        lambda: f"joe{rnd.randrange(99)} [at] site{rnd.randrange(9)} [dot] {rnd.choice(['com', 'org', 'xyzzy'])}",
        lambda: f"2021-0{rnd.randrange(1, 9)}-1{rnd.randrange(9)} 1111-22-333",
    ]
    rows = [(i, "; ".join(rnd.choice(before) + rnd.choice(make)() + rnd.choice(["", "", "%", " a", "/x"]) for _ in range(rnd.randrange(1, 9)))) for i in range(300)]
    counts, cands = {}, []
    for d, t in rows:
        base = [(int(s.split(":")[1]), int(s.split(":")[2])) for s in base_spans(t)]
        for k, kind in enumerate(pii.KINDS):
            if not re.search({"email": "at", "ip": r"\."}.get(kind, "[0-9]"), t):
                continue
            for m in re.finditer(pii.CANDIDATES[kind], t):
                if all(e <= m.start() or s >= m.end() for s, e in base):
                    v = votes(kind, m[0], t[max(0, m.start() - 40) : m.start()], t[m.end() : m.end() + 40])
                    cands.append((d, k, m.start(), m.end(), v))
                    counts.setdefault(k, {}).setdefault(v, []).append(1)
    accept = {}
    for k, own in counts.items():
        own = sorted((v, len(x)) for v, x in own.items())
        post = pii.em(own)[2]
        w = pii.logistic([(tuple(map(float, v)), p, float(n)) for (v, n), p in zip(own, post, strict=True)])
        accept |= {(k, v): w[0] + sum(a * b for a, b in zip(w[1:], v, strict=True)) >= 0 for v, _ in own}
    want = {(d, k, s, e) for d, k, s, e, v in cands if accept[k, v]}
    _, spans = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r.doc_id, r.k, r.start, r.end) for r in spans.where("NOT base").collect()}
    assert got == want and 20 < len(want) < len(cands)
