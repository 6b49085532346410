from collections import defaultdict

from millrace.llm import chat


def brute(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn is not None, turn or 0, role if role is not None else "unknown", text is not None, text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        for me in {t[2] for t in turns} - {"system"}:
            text, mask = "", []
            for _, _, role, _, said in turns:
                text += f"<|im_start|>{'assistant' if role == me else 'system' if role == 'system' else 'user name=' + role}\n"
                start = len(text)
                text += said.replace("<|", "< |") + "<|im_end|>"
                if role == me:
                    mask.append((start, len(text)))
                text += "\n"
            out[c, me] = (len(turns), text, mask)
    return out


def found(df):
    rows = df.collect()
    out = {(r.conv_id, r.perspective): (r.n_turns, r.text, [tuple(m) for m in r["mask"]]) for r in rows}
    assert len(out) == len(rows)  # a row a participant
    return out


def test_equals_brute_force(spark, sf):
    conv = spark.read.parquet(f"{sf}/conversations.parquet")
    rows = [tuple(r) for r in conv.select("conv_id", "turn", "role", "text").collect()]
    assert found(chat.op8_chat(spark, sf)) == brute(rows)


def test_edges(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 3, None, "é\U0001f600"), (2, 0, "system", "alone"), (None, 0, "x", "null"), (None, None, "y", ""), *((3, i, "ab"[i % 2], str(i)) for i in range(25))]
    df = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, block int")
    for block in (1, 7, 24, 25, chat.BLOCK):
        assert found(chat.rotate(df, block=block)) == brute(rows), block
    assert chat.rotate(df.limit(0)).count() == 0


def test_a_rendering_does_not_depend_on_blocks(spark):
    """1,100 turns of three speakers: one row each, with offsets and turns of the whole; blocks join to it."""
    rows = [(c, i, ["ann", "bob", "system", None][(i * 7 + i // 5) % 4], "é" * (i % 13)) for c in (1, None) for i in range(1100)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = brute(rows)
    assert found(chat.rotate(df)) == want and len(want) == 6
    joined = {}
    for r in sorted(chat.rotate_blocks(df).collect(), key=lambda r: r.block):
        n, t, m = joined.get((r.conv_id, r.perspective), (r.n_turns, "", []))
        assert (r.start, r.n_turns) == (len(t), 1100)
        joined[r.conv_id, r.perspective] = (n, t + r.text, m + [tuple(x) for x in r["mask"]])
    assert joined == want
    assert chat.rotate_blocks(df).agg({"block": "max"}).first()[0] == 2
