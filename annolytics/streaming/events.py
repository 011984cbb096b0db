"""The life of tracks on a stream in event time: rows of a frame may come in several batches, and
frames in any order. A frame is judged once the watermark has passed its time, by a timer.

State of a video, as typed tables that the state store keeps apart: the rows that wait for
their frame's time, the live objects, what they have lain over, the ids that were removed,
and the frames whose output waits. Only what a due frame touches is written back. All of it
goes with the video's last frame, or when the video has had no frame for `idle`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .lifecycle import OUTPUT, Rules, fresh, step

_PENDING = "ms long, frame_idx long, object_id long, matched boolean, is_empty boolean, overlaps array<long>, is_last boolean"
_OBJECT = "first long, misses long, keep long, row long, sure boolean, hidden long, over array<long>, times array<long>"
_HELD = "frame_idx long, object_id long, suppressed boolean, hidden long"
_NAMES = [c.split()[0] for c in OUTPUT.split(", ")]


class TrackLife(StatefulProcessor):
    """One video's frames in order of time."""

    def __init__(self, rules: Rules, idle_ms: int):
        self.rules, self.idle = rules, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", _PENDING)
        self.objects = handle.getMapState("objects", "object_id long", _OBJECT)
        self.removed = handle.getMapState("removed", "object_id long", "frame_idx long")
        self.held = handle.getListState("held", _HELD)
        self.latest = handle.getValueState("latest", "ms long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for part in rows:
            for ms, frame, i, matched, empty, overlaps, last in zip(*(part[c] for c in ("ms", "frame_idx", "object_id", "matched", "is_empty", "overlaps", "is_last")), strict=True):
                there = not pd.isna(i)
                new.append((int(ms), int(frame), int(i) if there else None, bool(matched) if there else False, bool(empty) if there else False, [int(x) for x in overlaps] if overlaps is not None else [], bool(last)))
        if new:
            self.pending.appendList(new)
            known = self.latest.get() if self.latest.exists() else None
            latest = max([ms for ms, *_ in new] + ([known[0]] if known else []))
            self.latest.update((latest,))
            for ms in {ms for ms, *_ in new}:
                self.handle.registerTimer(ms)
            self.handle.registerTimer(latest + self.idle)
        yield pd.DataFrame(columns=_NAMES)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # all frames that the watermark has passed at once, so that their own timers find nothing left
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        rows = list(self.pending.get()) if self.pending.exists() else []
        due, wait = [r for r in rows if r[0] <= passed], [r for r in rows if r[0] > passed]
        idle = self.latest.exists() and passed >= self.latest.get()[0] + self.idle
        out, ended = self._judge(due, idle) if due or idle else ([], False)
        if ended:
            for state in (self.pending, self.objects, self.removed, self.held, self.latest):
                state.clear()
        elif due:
            self.pending.put(wait) if wait else self.pending.clear()
        yield pd.DataFrame([(key[0], *row) for row in out], columns=_NAMES)

    def _judge(self, due: list[tuple], idle: bool) -> tuple[list[tuple], bool]:
        state, before = fresh(), {}
        for (i,), o in self.objects.iterator():
            names = ("first", "misses", "keep", "row", "sure", "hidden")
            state["objects"][str(i)] = dict(zip(names, o[:6], strict=True)) | {"over": {str(k): n for k, n in zip(o[6], o[7], strict=True)}}
            before[str(i)] = tuple(o[:6]), dict(zip(o[6], o[7], strict=True))
        held = list(self.held.get()) if self.held.exists() else []
        for frame, i, suppressed, hidden in held:
            if not state["held"] or state["held"][-1][0] != frame:
                state["held"].append([frame, []])
            if i is not None:
                state["held"][-1][1].append([i, suppressed, hidden])
        named = {r[2] for r in due if r[2] is not None} | {i for _, i, *_ in held if i is not None}
        state["removed"] = sorted(i for i in named if self.removed.containsKey((i,)))
        gone, out, ended = set(state["removed"]), [], False
        frames: dict[int, list] = {}
        for _, frame, *row in sorted(due, key=lambda r: (r[0], r[1])):
            frames.setdefault(frame, []).append(row)
        for frame, rows in frames.items():
            objects = [(i, matched, empty, list(overlaps or [])) for i, matched, empty, overlaps, _ in rows if i is not None]
            ended = ended or any(r[4] for r in rows)
            out += step(state, self.rules, frame, objects, any(r[4] for r in rows))
        if idle and not ended:  # nothing more comes: what waits is due
            removed = set(state["removed"])
            out += [(f, i, s, bool(state["objects"][str(i)]["sure"]), h) for f, shown in state["held"] for i, s, h in shown if i not in removed]
            ended = True
        if not ended:
            self._write(state, before, gone)
        return out, ended

    def _write(self, state: dict, before: dict, gone: set) -> None:
        for key, o in state["objects"].items():
            values, over = tuple(o[n] for n in ("first", "misses", "keep", "row", "sure", "hidden")), {int(k): n for k, n in o["over"].items()}
            if before.get(key) != (values, over):
                self.objects.updateValue((int(key),), (*values, list(over), list(over.values())))
        for i in set(state["removed"]) - gone:
            self.removed.updateValue((i,), (state["held"][-1][0] if state["held"] else 0,))
            if str(i) in before:
                self.objects.removeKey((i,))
        rows = [row for frame, shown in state["held"] for row in ([(frame, *s) for s in shown] or [(frame, None, False, 0)])]
        self.held.put(rows) if rows else self.held.clear()

    def close(self) -> None:
        pass


def track_events(rows: DataFrame, rules: Rules, time: str = "ts", late: str = "10 seconds", idle: str = "1 hour") -> DataFrame:
    """The rows that track_frames shows, from a stream whose frames carry their time in the
    column `time` (one for all rows of a frame, rising with the frames; falling for reverse
    rules is not allowed). Rows later than `late` behind the greatest time seen are dropped, as
    Spark's watermark has it. Needs the state store of RocksDB."""
    if rules.reverse:
        raise ValueError("event time runs forwards")
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    timed = rows.withWatermark(time, late).withColumn("ms", F.unix_millis(time))
    return timed.groupBy("video_id").transformWithStateInPandas(TrackLife(rules, idle_ms), OUTPUT, "Append", "EventTime")
