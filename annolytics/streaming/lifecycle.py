"""The life of tracks, frame by frame: hot start, keep-alive, confirmation, occlusion and
delayed output. One step function serves the stream and the table.

Rows: video_id, frame_idx, object_id, matched, is_empty, overlaps (older objects that this
one overlaps in the frame), is_last (the video's last frame). A frame without an object has
one row of null object_id. The frames of a video come in order, each whole in one batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.ordered import in_order, places

INPUT = "video_id long, frame_idx long, object_id long, matched boolean, is_empty boolean, overlaps array<long>, is_last boolean"
OUTPUT = "video_id long, frame_idx long, object_id long, suppressed boolean, confirmed boolean, last_occluded long"
#: Frames of an object never occluded, and of one that was removed.
NEVER, REMOVED = -1, 100_000


@dataclass(frozen=True)
class Rules:
    """start_delay: frames from its first one within which an object may be removed, after
    `unmatched` misses or `overlap` frames over one older object. keep: a counter from
    keep_init, up on a match to keep_max, down on a miss (or, with empty_counts, on an
    empty mask) to keep_min; at 0 or less the object is suppressed in the frame. confirm:
    matches in a row that confirm an object for ever; 0 confirms all. delay: frames that
    output waits for, at least confirm - 1. reverse: frames run backwards."""

    start_delay: int = 15
    unmatched: int = 8
    overlap: int = 8
    keep_init: int = 30
    keep_max: int = 30
    keep_min: int = -1
    empty_counts: bool = False
    confirm: int = 0
    delay: int = 0
    reverse: bool = False

    @property
    def wait(self) -> int:
        return max(self.delay, self.confirm - 1, 0)


def fresh() -> dict:
    return {"objects": {}, "removed": [], "held": []}


def step(state: dict, rules: Rules, frame: int, rows: list[tuple[int, bool, bool, list[int]]], is_last: bool) -> list[tuple]:
    """Take a frame's objects (id, matched, is_empty, overlaps) into the state; returns the rows
    (frame, object, suppressed, confirmed, last_occluded) of the frames that are now due."""
    objects, removed = state["objects"], set(state["removed"])
    shown = []
    for object_id, matched, is_empty, overlaps in sorted(rows):
        key = str(object_id)
        if object_id in removed:
            continue
        new = key not in objects
        o = objects.setdefault(key, {"first": frame, "misses": 0, "over": {}, "keep": rules.keep_init, "row": 0, "sure": rules.confirm <= 0, "hidden": NEVER})
        matched = matched or new  # a detection of the frame makes the object
        down = not matched or (rules.empty_counts and is_empty)
        if not new or not matched:
            o["keep"] = max(rules.keep_min, o["keep"] - 1) if down else min(rules.keep_max, o["keep"] + 1)
        o["misses"] += not matched
        o["row"] = o["row"] + 1 if matched else 0
        o["sure"] = o["sure"] or o["row"] >= rules.confirm
        for older in overlaps or []:
            o["over"][str(older)] = o["over"].get(str(older), 0) + 1
        young = o["first"] < frame + rules.start_delay if rules.reverse else o["first"] > frame - rules.start_delay
        if young and (o["misses"] >= rules.unmatched or any(n >= rules.overlap for n in o["over"].values())):
            removed.add(object_id)
            del objects[key]
            continue
        suppressed = o["misses"] > 0 and o["keep"] <= 0
        if is_empty or suppressed:
            o["hidden"] = frame
        if not is_empty:
            shown.append([object_id, suppressed, o["hidden"]])
    state["removed"] = sorted(removed)
    state["held"].append([frame, shown])
    due = []
    while state["held"] and (is_last or len(state["held"]) > rules.wait):
        at, objects_then = state["held"].pop(0)
        for object_id, suppressed, hidden in objects_then:
            if object_id not in removed:
                due.append((at, object_id, suppressed, bool(objects[str(object_id)]["sure"]), hidden))
    return due


def _work(state: dict, rules: Rules, video: int, part: pd.DataFrame) -> pd.DataFrame:
    out = []
    for frame, rows in part.sort_values("frame_idx", ascending=not rules.reverse).groupby("frame_idx", sort=False):
        there = rows[rows["object_id"].notna()]
        objects = [(int(i), bool(m), bool(e), [int(x) for x in (o if o is not None else [])]) for i, m, e, o in zip(there["object_id"], there["matched"], there["is_empty"], there["overlaps"], strict=True)]
        out += [(video, *row) for row in step(state, rules, int(frame), objects, bool(rows["is_last"].any()))]
    return pd.DataFrame(out, columns=[c.split()[0] for c in OUTPUT.split(", ")])


def _no_later(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Of each row the least of its own and later values of the group; rows lie by group."""
    out = values.copy()
    reach, n = 1, len(out)
    while reach < n and (group[reach:] == group[:-reach]).any():
        same = group[reach:] == group[:-reach]
        out[:-reach][same] = np.minimum(out[:-reach], out[reach:])[same]
        reach *= 2
    return out


def _life_of_batch(batch: pa.RecordBatch, rules: Rules) -> pa.RecordBatch:
    """`step` over whole videos at once: the n-th frames of all videos are taken together. Rows
    lie by video, in the order in which the frames run, and within a frame by object."""
    video, frame = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    n = len(video)
    new_video = np.r_[True, video[1:] != video[:-1]]
    new_frame = new_video | np.r_[True, frame[1:] != frame[:-1]]
    of_video, of_frame = np.cumsum(new_video) - 1, np.cumsum(new_frame) - 1
    there = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
    object_id = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False)
    matched, empty, ends = (batch.column(i).fill_null(False).to_numpy(zero_copy_only=False) for i in (3, 4, 6))
    # frames of a video are numbered from 0; a frame that says so ends it, and all that wait are due
    first_frame = of_frame[new_video]
    nth = of_frame - first_frame[of_video]
    n_frames = of_frame[-1] + 1
    heads = np.flatnonzero(new_frame)
    frame_ends = np.bincount(of_frame, weights=ends, minlength=n_frames) > 0
    # a frame is due with the frame `wait` places on, or with one that ends the video
    video_of_frame = of_video[heads]
    place = np.arange(n_frames) - first_frame[video_of_frame]
    last_place = np.bincount(video_of_frame)[video_of_frame] - 1
    never = np.iinfo(np.int64).max
    due_end = _no_later(np.where(frame_ends, place, never), video_of_frame)
    due = np.minimum(np.where(place + rules.wait <= last_place, place + rules.wait, never), due_end)

    at = np.flatnonzero(there)
    thing = np.zeros(n, np.int64)
    thing[at] = places(of_video[at], object_id[at]) if len(at) else 0
    n_things = int(thing.max()) + 1 if len(at) else 0
    # how often an object has lain over each older one: a counter for each pair that occurs
    lists = batch.column(5)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    older = lists.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(n), sizes)
    known = there[owner]
    owner, older = owner[known], older[known]
    over = np.zeros(n, np.int64)
    if len(owner):
        pair = places(thing[owner], older)
        # repeats of one older object in a row's list count each
        by = np.lexsort((owner, pair))
        start = np.r_[True, pair[by][1:] != pair[by][:-1]]
        run = np.arange(len(by)) - np.maximum.accumulate(np.where(start, np.arange(len(by)), 0)) + 1
        np.maximum.at(over, owner[by], run)
    first, misses, keep, row = np.full(n_things, never), np.zeros(n_things, np.int64), np.full(n_things, rules.keep_init), np.zeros(n_things, np.int64)
    sure, hidden, most_over = np.full(n_things, rules.confirm <= 0), np.full(n_things, NEVER), np.zeros(n_things, np.int64)
    removed_at, sure_at = np.full(n_things, never), np.full(n_things, never if rules.confirm > 0 else -1)
    shown, suppressed, last_hidden = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, np.int64)
    # an object given twice in a frame goes twice, one after the other
    again = np.zeros(n, np.int64)
    twin = np.r_[False, (object_id[1:] == object_id[:-1]) & ~new_frame[1:] & there[1:] & there[:-1]]
    again[twin] = (np.arange(n) - np.maximum.accumulate(np.where(twin, 0, np.arange(n))))[twin]
    turn = nth * (int(again.max()) + 1) + again
    by_place = at[np.argsort(turn[at], kind="stable")]
    cuts = np.r_[np.flatnonzero(np.r_[True, np.diff(turn[by_place]) > 0]), len(by_place)] if len(at) else np.zeros(1, np.int64)
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        rows = by_place[i:j]
        rows = rows[removed_at[thing[rows]] == never]
        o, now, t = thing[rows], frame[rows], nth[rows]
        new = first[o] == never
        first[o] = np.where(new, now, first[o])
        hit = matched[rows] | new
        down = ~hit | (empty[rows] if rules.empty_counts else False)
        keep[o] = np.where(new, keep[o], np.where(down, np.maximum(rules.keep_min, keep[o] - 1), np.minimum(rules.keep_max, keep[o] + 1)))
        misses[o] += ~hit
        row[o] = np.where(hit, row[o] + 1, 0)
        turned = ~sure[o] & (row[o] >= rules.confirm)
        sure[o] |= turned
        sure_at[o[turned]] = t[turned]
        most_over[o] = np.maximum(most_over[o], over[rows])
        young = first[o] < now + rules.start_delay if rules.reverse else first[o] > now - rules.start_delay
        gone = young & ((misses[o] >= rules.unmatched) | ((most_over[o] > 0) & (most_over[o] >= rules.overlap)))
        removed_at[o[gone]] = t[gone]
        rows, o, now = rows[~gone], o[~gone], now[~gone]
        held_back = (misses[o] > 0) & (keep[o] <= 0)
        hidden[o] = np.where(empty[rows] | held_back, now, hidden[o])
        shown[rows], suppressed[rows], last_hidden[rows] = ~empty[rows], held_back, hidden[o]
    out = np.flatnonzero(shown)
    when = due[of_frame[out]]
    out, when = out[when < never], when[when < never]
    stays = removed_at[thing[out]] > when
    out, when = out[stays], when[stays]
    return pa.RecordBatch.from_arrays([pa.array(video[out]), pa.array(frame[out]), pa.array(object_id[out]), pa.array(suppressed[out]), pa.array(sure_at[thing[out]] <= when), pa.array(last_hidden[out])], names=[c.split()[0] for c in OUTPUT.split(", ")])


def track_frames(rows: DataFrame, rules: Rules) -> DataFrame:
    """The rows shown of each frame of a table: objects that are not removed by the time that
    the frame is due, with what they are in it. A video is one task's group: frames in order
    depend on each other. The videos of a batch go frame by frame together."""
    names = [c.split()[0] for c in INPUT.split(", ")]
    typed = rows.select(*(F.col(n).cast(k).alias(n) for n, k in (c.split(" ", 1) for c in INPUT.split(", "))))
    order = [F.desc("frame_idx") if rules.reverse else F.asc("frame_idx"), "object_id", "matched", "is_empty", "overlaps"]
    return in_order(typed.filter("frame_idx is not null").select(*names), ["video_id"], order, lambda batch: _life_of_batch(batch, rules), OUTPUT)


def track_stream(rows: DataFrame, rules: Rules) -> DataFrame:
    """The same on a stream, with the state of a video kept between batches; it is dropped
    after the last frame. Memory of a video: its live objects and the frames that wait."""

    def batch(key: tuple, parts: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        state = json.loads(held.get[0]) if held.exists else fresh()
        part = pd.concat(list(parts), ignore_index=True)
        out = _work(state, rules, int(key[0]), part)
        if part["is_last"].any():
            held.remove()
        else:
            held.update((json.dumps(state),))
        yield out

    return rows.groupBy("video_id").applyInPandasWithState(batch, OUTPUT, "state string", "append", "NoTimeout")
