"""Ids, meters and deduplication on streams, and a run of a stream to its present end."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.reshape import weighted_meter

_IDS = "video_id long, frame_idx long, det_id long, object_id long"


def _assign(top: int, alive: int, most: int, part: pd.DataFrame) -> tuple[int, int, list[tuple]]:
    out = []
    for frame, rows in part.sort_values("frame_idx").groupby("frame_idx", sort=False):
        rows = rows.sort_values(["score", "det_id"], ascending=[False, True])
        kept = rows.head(max(0, most - alive)) if most > 0 else rows
        for det in sorted(kept["det_id"]):
            top += 1
            alive += 1
            out.append((int(frame), int(det), top))
    return top, alive, out


def _frame(video: int, rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(video, *r) for r in rows], columns=["video_id", "frame_idx", "det_id", "object_id"])


def assign_object_ids(dets: DataFrame, most: int = 0) -> DataFrame:
    """Ids 1, 2, ... of the new detections (video_id, frame_idx, det_id, score) of each video in
    the order of frame and det_id. With `most` above 0 a video has so many objects at most,
    and of a frame's detections those of highest score get the ids that are left."""

    rows = dets.filter("frame_idx is not null").select("video_id", "frame_idx", "det_id", "score")
    video = Window.partitionBy("video_id")
    if most > 0:
        best = video.orderBy("frame_idx", F.desc_nulls_last(F.nanvl("score", F.lit(None).cast("double"))), "det_id")
        rows = rows.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= most)
    number = F.row_number().over(video.orderBy("frame_idx", "det_id")).cast("long")
    return rows.select(*(F.col(c).cast("long").alias(c) for c in ("video_id", "frame_idx", "det_id")), number.alias("object_id"))


def _expire_later(held, part: pd.DataFrame, time: str, idle_ms: int) -> None:
    """A key's state goes once the watermark is idle_ms past its last row."""
    last = int(part[time].max().timestamp() * 1000)
    held.setTimeoutTimestamp(max(last + idle_ms, held.getCurrentWatermarkMs() + 1))


def _ms(span: str) -> int:
    return int(pd.Timedelta(span).total_seconds() * 1000)


def assign_object_ids_stream(dets: DataFrame, most: int = 0, time: str | None = None, late: str = "1 hour", idle: str = "1 day") -> DataFrame:
    """The same on a stream; a video's state is its greatest id and its number of objects. With
    a column `time` the state of a video without detections for `idle` goes, and a later
    one of that video begins at 1 again; without it, state is kept for ever."""

    def batch(key: tuple, parts: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        top, alive = held.get if held.exists else (0, 0)
        part = pd.concat(list(parts), ignore_index=True)
        top, alive, rows = _assign(top, alive, most, part)
        held.update((top, alive))
        if time:
            _expire_later(held, part, time, idle_ms)
        yield _frame(int(key[0]), rows)

    idle_ms = _ms(idle)
    timed = dets.withWatermark(time, late) if time else dets
    return timed.groupBy("video_id").applyInPandasWithState(batch, _IDS, "top long, alive long", "append", "EventTimeTimeout" if time else "NoTimeout")


#: Groups in which the choices of stream_dedup are kept; a group's are one state, taken up at once.
GROUPS = 4096


def _whole(column: pd.Series, missing: int) -> np.ndarray:
    gone = column.isna().to_numpy()
    return np.where(gone, missing, column.where(~gone, 0).to_numpy(np.int64))


def _choose(held: np.ndarray, part: pd.DataFrame, times: np.ndarray, idle_ms: int, watermark: int) -> tuple[np.ndarray, np.ndarray]:
    """The choices (rows of video_id, category_id, shard and the time up to which it stands) after a batch
    of a group, and whether each row of the batch is of its key's shard."""
    least_long, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    keys = np.column_stack([_whole(part[c], least_long) for c in ("video_id", "category_id")])
    given = _whole(part["shard"], most)
    both = np.concatenate([held[:, :2], keys])
    order = np.lexsort((both[:, 1], both[:, 0]))
    new = np.r_[True, (both[order][1:] != both[order][:-1]).any(axis=1)]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    old, own = number[: len(held)], number[len(held) :]
    n = int(number.max()) + 1
    least = np.full(n, most)
    np.minimum.at(least, own, given)
    shard = least.copy()
    shard[old] = held[:, 2]
    last = np.full(n, -most)
    np.maximum.at(last, own, times)
    until = np.maximum(last + idle_ms, watermark + 1)
    there = np.zeros(n, bool)
    there[own] = True
    until[old[~there[old]]] = held[~there[old], 3]
    # what has run out goes, but for the keys that have come again just now
    stays = there | (until >= watermark)
    return np.column_stack([both[order][new], shard, until])[stays], given == shard[own]


def stream_dedup(predictions: DataFrame, time: str = "ts", late: str = "1 hour", idle: str = "1 day") -> DataFrame:
    """Of a stream of predictions (video_id, category_id, track_id, shard, ts) for each video and
    category the rows of the first shard that brought it (the least of one batch), and of
    these each track once within the watermark. What a video and category have chosen is
    forgotten once no row has come for `idle`."""
    schema, idle_ms = predictions.schema, _ms(idle)

    def batch(key: tuple, parts: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        choices = np.frombuffer(held.get[0], np.int64).reshape(-1, 4) if held.exists else np.empty((0, 4), np.int64)
        watermark = held.getCurrentWatermarkMs()
        if held.hasTimedOut:
            choices, part = choices[choices[:, 3] >= watermark], None
        else:
            part = pd.concat(list(parts), ignore_index=True)
            times = part[time].to_numpy("datetime64[ms]").astype(np.int64)
            choices, chosen = _choose(choices, part, times, idle_ms, watermark)
        if len(choices):
            held.update((choices.tobytes(),))
            held.setTimeoutTimestamp(max(int(choices[:, 3].min()), watermark + 1))
        else:
            held.remove()
        if part is not None:
            yield part.loc[chosen, schema.names]

    chosen = predictions.dropDuplicates(["video_id", "category_id", "track_id", "shard"]) if not predictions.isStreaming else predictions
    if not predictions.isStreaming:
        first = chosen.groupBy("video_id", "category_id").agg(F.min("shard").alias("shard"))
        return chosen.join(first, ["video_id", "category_id", "shard"], "left_semi").select(*predictions.columns)
    once = predictions.withWatermark(time, late).dropDuplicatesWithinWatermark(["video_id", "category_id", "track_id", "shard"])
    group = F.pmod(F.xxhash64("video_id", "category_id"), F.lit(GROUPS))
    return once.withColumn("_group", group).groupBy("_group").applyInPandasWithState(batch, schema, "choices binary", "append", "EventTimeTimeout")


def streaming_meter(values: DataFrame, *by: str) -> DataFrame:
    """Sum, count, weighted mean and last value so far; on a stream written in update mode."""
    return weighted_meter(values, *by)


def run_available(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run a stream to the end of what is there now, into a table below path, and read it. With
    mode `update` each batch replaces the rows of its keys, so that the last ones stand."""
    spark = stream.sparkSession
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").start(f"{path}/table")
    else:
        query = writer.foreachBatch(lambda df, i: df.withColumn("batch", F.lit(i)).write.mode("append").parquet(f"{path}/table")).start()
    query.awaitTermination()
    return spark.read.parquet(f"{path}/table")
