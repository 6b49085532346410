import json
import time

import pytest
from pyspark.sql import functions as F

from millrace.sources import store, versioned
from millrace.streaming import live, progress, tail
from millrace.streaming.journal import Journal


def run(stream, sink, checkpoint, **trigger):
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(checkpoint)).outputMode("update").trigger(**(trigger or {"availableNow": True})).start()
    q.awaitTermination(120)
    return q


def test_growing_files_give_each_line_once(spark, tmp_path):
    folder, got = tmp_path / "logs", []
    (folder / "deep").mkdir(parents=True)
    a, b = folder / "a.log", folder / "deep" / "b.log"

    def poll(chunk=7):  # a new query from the same checkpoint each time, as after a restart
        before = len(got)
        run(tail.growing_lines(spark, str(folder), ".log", chunk), lambda df, _: got.extend((r.path.rsplit("/", 1)[1], r.position, r.line) for r in df.collect()), tmp_path / "at")
        return sorted(got[before:])

    a.write_bytes(b"one\ntwo two two two two\n\nthr")
    (folder / "c.txt").write_text("not a log\n")
    assert poll() == [("a.log", 0, "one"), ("a.log", 4, "two two two two two")]
    assert poll() == []
    with a.open("ab") as f:  # the torn line is completed, and another begins
        f.write(b"ee\r\nfo\xffur\nfive")
    b.write_bytes("é\n".encode() * 3)
    assert poll() == [("a.log", 25, "three"), ("a.log", 32, "fo�ur"), *[("b.log", 3 * i, "é") for i in range(3)]]
    b.write_bytes(b"short\n")  # cut off
    a.write_bytes(b"another file that is longer than the one before it was\n")  # replaced
    assert poll(1 << 20) == [("a.log", 0, "another file that is longer than the one before it was"), ("b.log", 0, "short")]
    a.unlink()
    with b.open("ab") as f:
        f.write(b"x" * 200_000 + b"\nlast\n")
    assert poll(50_000) == [("b.log", 6, "x" * 200_000), ("b.log", 200_007, "last")]


def test_a_journal_is_written_once(spark, tmp_path):
    root = str(tmp_path / "journal")
    journal = Journal(spark, root, "item", "s", "seq")
    frame = lambda rows: spark.createDataFrame(rows, "item string, s string, seq int")
    one, two, three = frame([("a", "failed", 2), ("a", "ok", 1), ("b", None, 3), (None, "ok", 4)]), frame([("b", "failed", 1), ("c", "corrupt", 1)]), frame([("c", "ok", 1), ("d", "ok", 1)])
    state = lambda: {r.id: r.status for r in journal.marks().collect()}
    assert state() == {} and journal.compact() == -1
    journal.write(one, 0)
    journal.write(two, 1)
    want = {"a": "ok", "b": "ok", "c": "corrupt"}
    assert state() == want
    journal.write(two, 1)  # replayed
    assert state() == want
    torn = tmp_path / "journal" / "batch-000000000002"
    three.selectExpr("item id", "s status", "2L batch", "1L place").write.parquet(str(torn))
    (torn / "_SUCCESS").unlink()
    assert state() == want  # a batch that was not completed doesn't count
    assert journal.compact() == 1 and state() == want
    journal.write(one, 0)  # a batch that was folded in is replayed
    journal.write(three, 2)
    want["d"] = "ok"
    assert state() == want and journal.compact() == 2 and state() == want
    assert store.names(spark, root) == ["first-000000000002"]
    assert {r.status: r.n for r in journal.counts().collect()} == {"ok": 3, "corrupt": 1, None: 4}
    assert [r.x for r in journal.open_items(spark.createDataFrame([("a",), ("z",), (None,)], "x string"), "x").collect() if r.x] == ["z"]


def test_a_journal_behind_a_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    journal = Journal(spark, str(tmp_path / "journal"), "item", "s")
    seen = []

    def sink(df, batch):
        seen.append(batch)
        journal.write(df, batch)
        if len(seen) == 2:
            raise RuntimeError("killed after the write, before the commit")

    def go():
        return run(spark.readStream.schema("item string, s string").option("maxFilesPerTrigger", 1).json(str(src)), sink, tmp_path / "at")

    for i in range(3):
        (src / f"{i}.json").write_text(json.dumps({"item": f"x{i}", "s": "ok"}))
    with pytest.raises(Exception, match="killed"):
        go()
    go()
    assert seen == [0, 1, 1, 2]
    rows = journal.marks().collect()
    assert sorted(r.id for r in rows) == ["x0", "x1", "x2"] and sorted(r.batch for r in rows) == [0, 1, 2]


def test_merges_rewrite_what_they_touch(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    rows = spark.range(100).selectExpr("id", "concat('t', id) title", "id % 3 = 0 same").repartitionByRange(5, "id").sortWithinPartitions("id")
    assert versioned.create(rows, root) == 1 and len(versioned.files(spark, root)) == 5
    patch = spark.createDataFrame([(3, "new", True), (3, "newer", True), (4, "wrong", True), (6, "refused", False), (None, "x", True), (9, None, True), (500, "absent", True)], "id long, title string, good boolean")
    merge = lambda: versioned.merge(spark, root, patch, "id", "title", accept=F.col("good"), where=F.col("same"))
    old = {r.id: r.title for r in versioned.read(spark, root).collect()}
    before = versioned.read(spark, root)
    assert merge() == 2
    assert {r.id: r.title for r in versioned.read(spark, root).collect()} == old | {3: "newer"}
    assert len(set(versioned.files(spark, root)) & set(versioned.files(spark, root, 1))) == 4  # one file was rewritten
    assert merge() == 2  # again: nothing to do
    assert {r.id: r.title for r in before.collect()} == old == {r.id: r.title for r in versioned.read(spark, root, 1).collect()}

    # a writer that is killed before it publishes
    real = versioned._publish
    monkeypatch.setattr(versioned, "_publish", lambda *a: 1 / 0)
    more = spark.createDataFrame([(i, "late") for i in range(0, 100, 20)], "id long, title string")
    with pytest.raises(ZeroDivisionError):
        versioned.merge(spark, root, more, "id", "title")
    monkeypatch.setattr(versioned, "_publish", real)
    assert versioned.versions(spark, root) == [1, 2] and {r.id: r.title for r in versioned.read(spark, root).collect()} == old | {3: "newer"}
    # two writers: the number is taken
    _, names, schema = versioned._manifest(spark, root, None)
    with pytest.raises(versioned.Conflict):
        versioned._publish(spark, root, 2, names, schema)
    assert versioned.merge(spark, root, more, "id", "title") == 3 and versioned.restore(spark, root, 1) == 4
    assert {r.id: r.title for r in versioned.read(spark, root).collect()} == old
    assert versioned.clean(spark, root, keep=1) == 3 and versioned.versions(spark, root) == [1, 4]
    assert {r.id: r.title for r in versioned.read(spark, root).collect()} == old
    # an empty table, and a patch without rows
    assert versioned.create(rows.limit(0), f"{root}-none") == 1 and versioned.merge(spark, f"{root}-none", patch, "id", "title") == 1
    assert versioned.merge(spark, root, patch.limit(0), "id", "title") == 4


def test_parts_change_by_themselves(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", progress.STORE)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    src, got = tmp_path / "in", []
    src.mkdir()

    def put(name, rows):
        (tmp_path / name).write_text("".join(json.dumps(dict(zip(("part", "article_id", "ok", "total"), r, strict=True))) + "\n" for r in rows))
        (tmp_path / name).rename(src / f"{name}.json")

    def until(part, state, after=0):
        end = time.time() + 90
        while time.time() < end:
            if any(g.part == part and g.state == state and g.seq > after for g in got):
                return max(g.seq for g in got if g.part == part and g.state == state)
            time.sleep(0.2)
        raise AssertionError(f"{part} never was {state}: {[(g.part, g.seq, g.state) for g in got]}")

    put("1", [("p", "a", False, 2), ("p", "a", False, 2), ("q", "x", True, 1), (None, "y", True, 1), ("r", None, None, 5)])
    records = spark.readStream.schema("part string, article_id string, ok boolean, total long").json(str(src))
    q = progress.part_progress(records, fresh=3).writeStream.foreachBatch(lambda df, _: got.extend(df.collect())).option("checkpointLocation", str(tmp_path / "at")).outputMode("update").trigger(processingTime="1 second").start()
    try:
        until("p", "running"), until("q", "retry")
        first = until("p", "partial")  # without another record
        until("q", "done"), until("r", "queued")
        put("2", [("p", "a", True, 2), ("p", "b", False, 2), ("p", "b", True, 2), ("p", "a", False, 2)])
        until("p", "retry", first), until("p", "done", first)
    finally:
        q.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    last = {}
    for g in sorted(got, key=lambda g: g.seq):
        last[g.part] = (g.ok, g.failed, g.total, g.state)
    assert last == {"p": (2, 0, 2, "done"), "q": (1, 0, 1, "done"), "r": (0, 0, 5, "queued")}
    # the batch query over the same records, long after
    rows = spark.read.json(str(src)).where("part IS NOT NULL").withColumn("ts", F.lit("2021-01-01 00:00:00"))
    batch = live.part_states(rows.where("article_id IS NOT NULL"), rows.groupBy("part").agg(F.max("total").alias("total")), F.lit("2022-01-01"))
    assert {r.part: (r.ok, r.failed, r.total, r.state) for r in batch.collect()} == last
