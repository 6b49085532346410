"""States of the parts of a running job that change by themselves when nothing is written for a while."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FRESH = 120
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "part string, seq long, ok long, failed long, total long, state string"


def part_state(seen: int, total: int, lately: bool) -> str:
    """STM-5, as millrace.streaming.live.part_state says it in a column."""
    if total > 0 and seen >= total:
        return "retry" if lately else "done"
    return "running" if lately else "partial" if seen else "queued"


class _Parts(StatefulProcessor):
    """Items are rows of a map state, so that a part with very many is not held in memory."""

    def __init__(self, fresh: int, forget: int | None):
        self.fresh, self.forget = fresh * 1000, None if forget is None else forget * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getMapState("items", "id string", "ok boolean")
        self.sums = handle.getValueState("sums", "ok long, failed long, total long, seq long, last long, state string")

    def _now(self, part: str, ok: int, failed: int, total: int, seq: int, last: int, state: str) -> pd.DataFrame:
        self.sums.update((ok, failed, total, seq, last, state))
        return pd.DataFrame({"part": [part], "seq": [seq], "ok": [ok], "failed": [failed], "total": [total], "state": [state]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ok, failed, total, seq, last, _ = self.sums.get() if self.sums.exists() else (0, 0, 0, 0, 0, "")
        now = timerValues.getCurrentProcessingTimeInMs()
        for pdf in rows:
            total = max(total, int(pdf["total"].fillna(0).max()))
            # within a batch an item that succeeds anywhere has succeeded
            for item, good in pdf[pdf["article_id"].notna()].groupby("article_id", sort=True)["ok"].agg(lambda s: bool(s.fillna(False).astype(bool).any())).items():
                before = self.items.getValue((item,))[0] if self.items.containsKey((item,)) else None
                if before is None or (good and not before):
                    self.items.updateValue((item,), (good,))
                    ok, failed = ok + good, failed + (not good if before is None else -1)
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(now + self.fresh)
        yield self._now(key[0], ok, failed, total, seq + 1, now, part_state(ok + failed, total, True))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.sums.exists():
            return
        ok, failed, total, seq, last, state = self.sums.get()
        now = timerValues.getCurrentProcessingTimeInMs()
        if self.forget is not None and now - last >= self.forget:
            self.items.clear()
            self.sums.clear()
            return
        if self.forget is not None:
            self.handle.registerTimer(last + self.forget)
        yield self._now(key[0], ok, failed, total, seq + 1, last, part_state(ok + failed, total, False))

    def close(self) -> None:
        pass


def part_progress(records: DataFrame, fresh: int = FRESH, forget: int | None = None) -> DataFrame:
    """STM-5, STM-2: part, seq, ok, failed, total and state, a row whenever a part is written to or its state changes by itself.

    records: a stream of part, article_id, ok and total (the items that the part has). An item that has succeeded
    stays so, a success removes an earlier failure. A part that is written to is running, or, if every item is accounted
    for, retry; `fresh` seconds after the last record a timer makes it partial, or done. `forget` seconds after the last record,
    if given, all that is held of the part is dropped; it begins anew if it is written to again. Records without a part are
    left out, those without an item only show that the part is at work. The row with the largest seq of a part is
    what it does now. The session needs the state store STORE (spark.sql.streaming.stateStore.providerClass).
    """
    one = records.where("part IS NOT NULL").selectExpr("cast(part AS string) part", "cast(article_id AS string) article_id", "cast(ok AS boolean) ok", "cast(total AS long) total")
    return one.groupBy("part").transformWithStateInPandas(_Parts(fresh, forget), OUT, "update", "processingTime")
