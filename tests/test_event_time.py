"""Streams in event time: frames out of order and in parts, and state that goes."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from annolytics.streaming import Rules, assign_object_ids, assign_object_ids_stream, run_available, stream_dedup, track_events, track_frames

FRAMES = "video_id long, frame_idx long, object_id long, matched boolean, is_empty boolean, overlaps array<long>, is_last boolean, ts timestamp"
START = datetime(2024, 1, 1)


def frames(seed: int, videos: int = 3, ended: bool = True) -> list[tuple]:
    rnd = random.Random(seed)
    rows = []
    for v in range(videos):
        n = rnd.randrange(6, 12)
        for f in range(n):
            ids = [i for i in range(5) if f >= i and rnd.random() < 0.8]
            at, last = START + timedelta(seconds=f), ended and f == n - 1
            rows += [(v, f, i, rnd.random() < 0.6, rnd.random() < 0.2, [j for j in range(i) if rnd.random() < 0.3], last, at) for i in ids] or [(v, f, None, None, None, None, last, at)]
    return rows


def stream_of(spark, parts: list[list[tuple]], schema: str, path: str):
    """Each part is one batch; the last one pushes the watermark on."""
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{path}/in/part={i}")
        # files are taken by time of change
    return spark.readStream.schema(spark.read.parquet(f"{path}/in/part=0").schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(f"{path}/in")


def test_frames_out_of_order_and_in_parts(spark, tmp_path):
    rows = frames(4)
    rnd = random.Random(1)
    # within the watermark's 5 seconds rows come in any order, so that frames are split over batches
    mixed = sorted(rows, key=lambda r: r[7] + timedelta(seconds=rnd.random() * 4))
    size = len(mixed) // 4 + 1
    parts = [mixed[i : i + size] for i in range(0, len(mixed), size)]
    parts += [[(99, f, None, None, None, None, False, START + timedelta(hours=f + 1))] for f in range(2)]
    rules = Rules(start_delay=6, unmatched=3, overlap=3, keep_init=2, keep_max=3, confirm=2, delay=2)
    out = run_available(track_events(stream_of(spark, parts, FRAMES, str(tmp_path)), rules, late="5 seconds"), str(tmp_path))
    want = track_frames(spark.createDataFrame(rows, FRAMES).drop("ts"), rules)
    got, table = (sorted(map(tuple, df.filter("video_id <> 99").collect())) for df in (out, want))
    assert got == table and len(table) > 30


def state_rows(spark, query) -> int:
    return sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"])


def run(df, path: str):
    query = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/table")
    query.awaitTermination()
    return query


def test_state_of_silent_videos_goes(spark, tmp_path):
    rows = frames(5, ended=False)
    parts = [rows, *([(99, f, None, None, None, None, True, START + timedelta(hours=f + 2))] for f in range(3))]
    query = run(track_events(stream_of(spark, parts, FRAMES, str(tmp_path)), Rules(delay=3), late="5 seconds", idle="10 minutes"), str(tmp_path))
    got = spark.read.parquet(f"{tmp_path}/table").filter("video_id <> 99")
    ended = [(*r[:6], r[1] == max(x[1] for x in rows if x[0] == r[0]), r[7]) for r in rows]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, track_frames(spark.createDataFrame(ended, FRAMES).drop("ts"), Rules(delay=3)).collect()))
    # of the videos nothing is left; the pushing video's last frame waits
    assert state_rows(spark, query) <= 6


def test_ids_and_shards_expire(spark, tmp_path):
    dets = [(v, f, 10 * f + k, 0.5, START + timedelta(seconds=f)) for v in range(4) for f in range(3) for k in range(2)]
    late = [[(99, f, f, 0.5, START + timedelta(hours=f + 1))] for f in range(3)]
    schema = "video_id long, frame_idx long, det_id long, score double, ts timestamp"
    stream = stream_of(spark, [dets, *late], schema, f"{tmp_path}/ids")
    query = run(assign_object_ids_stream(stream, time="ts", late="5 seconds", idle="10 minutes"), f"{tmp_path}/ids")
    got = spark.read.parquet(f"{tmp_path}/ids/table").filter("video_id <> 99")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, assign_object_ids(spark.createDataFrame(dets, schema)).collect()))
    assert state_rows(spark, query) == 1
    shards = [(v, 1, k, s, START + timedelta(seconds=k)) for v in range(4) for k in range(3) for s in (1, 2)]
    schema = "video_id long, category_id long, track_id long, shard long, ts timestamp"
    stream = stream_of(spark, [shards, *([(99, 1, f, 1, START + timedelta(hours=f + 2))] for f in range(3))], schema, f"{tmp_path}/shards")
    query = run(stream_dedup(stream, "ts", "5 seconds", idle="10 minutes"), f"{tmp_path}/shards")
    got = spark.read.parquet(f"{tmp_path}/shards/table").filter("video_id <> 99")
    assert sorted(map(tuple, got.collect())) == sorted(r for r in shards if r[3] == 1)
    assert state_rows(spark, query) <= 3
