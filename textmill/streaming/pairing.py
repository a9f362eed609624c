"""The state machine that pairs two workers' answers to one key, for streams and for replays of a table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

RULES = """A pair opens with the first answer to a key and takes the later ones, one a worker, the last said.  When both
workers have answered it closes: ``agree`` or ``disagree`` where one answer was shadowed and both name labels, else without
a row.  An answer that comes ``ttl`` or more after the opening closes the pair first, and opens the next one.  A shadowed pair that
ends for its age with one side only is a gap of the other worker; one that is put out for want of room is none."""


def pairing_processor(ttl_ms: int, most: int | None, delay_ms: int = 0) -> StatefulProcessor:
    """A processor of rows ``key``, ``worker``, ``said``, ``shadow``, ``ts`` of one lane.

    The class is made here so that it travels to the workers by value: they need not know this package."""

    class Pairing(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.open = handle.getMapState("open", "key string", "created long, stable string, candidate string, shadow boolean")

        def _load(self) -> dict:
            return {k[0]: list(v) for k, v in self.open.iterator()} if self.open.exists() else {}

        def _store(self, before: dict, now: dict) -> None:
            for k in before.keys() - now.keys():
                self.open.removeKey((k,))
            for k, v in now.items():
                if before.get(k) != v:
                    self.open.updateValue((k,), tuple(v))
            # one timer a lane: for the pair that is over first
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            if now:
                self.handle.registerTimer(min(v[0] for v in now.values()) + ttl_ms)

        @staticmethod
        def _gap(pair: list) -> str | None:
            _, stable, candidate, shadow = pair
            return None if not shadow or (stable is None) == (candidate is None) else "gap_candidate" if candidate is None else "gap_stable"

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            import pandas as pd

            before = self._load()
            now = {k: list(v) for k, v in before.items()}
            out = []
            parts = list(rows)
            if parts:
                batch = pd.concat(parts).sort_values(["ts", "worker", "said"], kind="stable")
                times = (batch["ts"] - pd.Timestamp(0)) // pd.Timedelta(milliseconds=1) if batch["ts"].dt.tz is None else (batch["ts"] - pd.Timestamp(0, tz="UTC")) // pd.Timedelta(milliseconds=1)
                for k, worker, said, shadow, at in zip(batch["key"], batch["worker"], batch["said"], batch["shadow"], times):
                    at = int(at)
                    pair = now.get(k)
                    if pair is not None and at - pair[0] >= ttl_ms:
                        if gap := self._gap(now.pop(k)):
                            out.append((k, gap))
                        pair = None
                    if pair is None:
                        if most is not None and len(now) >= most:
                            now.pop(min(now, key=lambda x: now[x][0]))
                        pair = now[k] = [at, None, None, False]
                    if worker in ("stable", "candidate"):
                        pair[1 if worker == "stable" else 2] = said
                    pair[3] = pair[3] or bool(shadow)
                    if pair[1] is not None and pair[2] is not None:
                        del now[k]
                        if pair[3] and pair[1] and pair[2]:
                            out.append((k, "agree" if pair[1] == pair[2] else "disagree"))
                # the watermark will be here at least after this batch: no later answer can join a pair that is over by then
                horizon = int(max(times)) - delay_ms
                for k in [k for k, v in now.items() if v[0] + ttl_ms <= horizon]:
                    if gap := self._gap(now.pop(k)):
                        out.append((k, gap))
            self._store(before, now)
            yield pd.DataFrame(out, columns=["key", "outcome"])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
            import pandas as pd

            before, until = self._load(), timerValues.getCurrentWatermarkInMs()
            over = [k for k, v in before.items() if v[0] + ttl_ms <= until]
            out = [(k, gap) for k in over if (gap := self._gap(before[k]))]
            self._store(before, {k: v for k, v in before.items() if k not in set(over)})
            yield pd.DataFrame(out, columns=["key", "outcome"])

        def close(self) -> None:
            pass

    return Pairing()


def replayed(events: DataFrame, ttl_seconds: int = 30) -> DataFrame:
    """``key``, ``outcome`` of a table of answers, by the same rules in the order of ``ts``, with room for all; pairs still open when the
    last answer of the table came give no row.

    Rows are brought together by key and put in order there; the state machine runs over them one by one and holds one pair."""
    eligible = events.where((F.coalesce("key", F.lit("")) != "") & (F.coalesce("shadow", F.lit(False)) | (F.coalesce("request_id", F.lit("")) != "")))
    said = F.when(F.size("labels") > 0, F.to_json("labels")).otherwise("")
    rows = eligible.select("key", "worker", said.alias("said"), F.coalesce("shadow", F.lit(False)).alias("shadow"), F.unix_millis("ts").alias("at"))
    last = rows.agg(F.max("at").alias("last"))
    ordered = rows.crossJoin(F.broadcast(last)).repartition("key").sortWithinPartitions("key", "at", "worker", "said")  # last: one row
    ttl = ttl_seconds * 1000

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, pair, end = None, None, 0

        def gap() -> list:
            if pair is None or not pair[3] or (pair[1] is None) == (pair[2] is None):
                return []
            return [(key, "gap_candidate" if pair[2] is None else "gap_stable")]

        for b in batches:
            out = []
            for k, worker, said, shadow, at, last in b.itertuples(index=False):
                if k != key:
                    if pair is not None and pair[0] + ttl <= end:
                        out += gap()
                    key, pair = k, None
                end = last
                if pair is not None and at - pair[0] >= ttl:
                    out += gap()
                    pair = None
                pair = pair or [at, None, None, False]
                if worker in ("stable", "candidate"):
                    pair[1 if worker == "stable" else 2] = said
                pair[3] = pair[3] or shadow
                if pair[1] is not None and pair[2] is not None:
                    if pair[3] and pair[1] and pair[2]:
                        out.append((k, "agree" if pair[1] == pair[2] else "disagree"))
                    pair = None
            yield pd.DataFrame(out, columns=["key", "outcome"])
        if pair is not None and pair[0] + ttl <= end:
            yield pd.DataFrame(gap(), columns=["key", "outcome"])

    return ordered.mapInPandas(run, "key string, outcome string")
