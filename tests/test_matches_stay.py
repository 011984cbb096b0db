"""Matches of tracks stay where their video lies; only what loses in a frame is dealt anew."""

from __future__ import annotations

import re

import numpy as np

import __spark_entry__ as entry
from annolytics.operators import reshape
from annolytics.operators.ordered import optimal_pairs, unchosen_pairs
from annolytics.views import view


def test_hota_deals_no_matches(spark, sf_dir, capsys):
    entry.queries()["hota_by_pair"](spark, sf_dir).explain()
    plan = capsys.readouterr().out.split("== Initial Plan ==")[0]
    dealt = [keys for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if not keys.startswith("l_orderkey")]
    assert len(dealt) == 1  # the pairs that are not chosen


def test_unchosen_are_all_but_the_optimal(spark):
    rng = np.random.default_rng(3)
    rows = {(int(g), int(a), int(b)): float(s) for g, a, b, s in zip(rng.integers(0, 60, 900), rng.integers(0, 5, 900), rng.integers(0, 5, 900), rng.choice([0.0, 0.2, 0.5, 0.9, 1.0], 900), strict=True)}
    pairs = spark.createDataFrame([(*k, s) for k, s in rows.items()], "g long, a long, b long, s double").repartition(3)
    chosen = {tuple(r)[:3] for r in optimal_pairs(pairs, ["g"], "a", "b", "s").collect()}
    rest = [tuple(r) for r in unchosen_pairs(pairs, ["g"], "a", "b", "s").collect()]
    assert chosen and len(rest) == len(set(rest)) and not chosen & set(rest) and chosen | set(rest) == set(rows)


def test_cleaning_deals_holes_alone(spark, sf_dir, capsys):
    entry.queries()["clean_masks"](spark, sf_dir).explain()
    plan = capsys.readouterr().out.split("== Initial Plan ==")[0]
    # holes come from Python; they are summed and dealt to the runs of their mask
    assert plan.count("Exchange hashpartitioning(image_id") <= 2 and "Union" not in plan.split("MapInArrow")[1]


def test_frames_of_tracks_keep_one_row_a_video(spark, sf_dir, monkeypatch):
    kept, keep = [], reshape.settled
    monkeypatch.setattr(reshape, "settled", lambda df: kept.append(df.count()) or keep(df))
    entry.queries()["tracks_to_frames"](spark, sf_dir)
    assert kept == [view(spark, sf_dir, "gt_tracks").select("video_id").distinct().count()]
