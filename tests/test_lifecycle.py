from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from geoledger.operators import merge as M
from geoledger.sources.state import STATE_SCHEMA
from geoledger.streaming import lifecycle

START = datetime(2024, 3, 1, tzinfo=timezone.utc)
SCHEMA = "id long, row_hash string, name_zh string, municipality_zh string, location_zh string"


def snapshot(spark, rows):
    made = spark.createDataFrame([(n, h, z, None, None) for n, h, z in rows], SCHEMA)
    more = [c for c in M.INCOMING_COLUMNS if c not in made.columns]
    return made.select("*", *[F.lit(None).cast(STATE_SCHEMA[c].dataType).alias(c) for c in more])


def test_the_stream_equals_the_batch_feed(spark, tmp_path):
    rng, folder = random.Random(5), str(tmp_path / "stream")
    assert lifecycle.read_feed(spark, folder).count() == 0
    state, want = spark.createDataFrame([], STATE_SCHEMA), []
    for turn in range(4):
        at = START + timedelta(hours=turn)
        rows = [(n, rng.choice("ab"), rng.choice([None, "甲"])) for n in range(25) if rng.random() < 0.7]
        incoming = snapshot(spark, rows)
        feed = M.change_feed(state, incoming, at).where("change <> 'absent'")
        want += [(r["id"], r["change"], r["reactivated"], turn) for r in feed.collect()]
        state = spark.createDataFrame(M.merge_snapshot(state, incoming, at).collect(), STATE_SCHEMA)
        lifecycle.take(spark, incoming, folder, at)  # starts again from its checkpoint each time
    hours = ((F.unix_timestamp("snapshot_at") - int(START.timestamp())) / 3600).cast("int")
    got = lifecycle.read_feed(spark, folder).select("id", "change", "reactivated", hours).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert {r[1] for r in want} == {"inserted", "updated", "unchanged", "deactivated"} and any(r[2] for r in want)


def test_rows_without_id_late_snapshots_and_restarts_without_news(spark, tmp_path):
    folder = str(tmp_path / "stream")
    lifecycle.take(spark, snapshot(spark, [(1, "a", None), (None, "a", None)]), folder, START)
    lifecycle.take(spark, snapshot(spark, [(1, "b", None)]), folder, START - timedelta(hours=1))
    lifecycle.start_feed(spark, f"{folder}/landing", f"{folder}/feed", f"{folder}/checkpoint").awaitTermination()
    assert [tuple(r)[:2] for r in lifecycle.read_feed(spark, folder).collect()] == [(1, "inserted")]


def test_ids_share_the_state_of_their_group(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lifecycle, "GROUPS", 3, raising=False)
    folder, want = str(tmp_path / "stream"), set()
    seen = [range(60), range(30, 90), range(0, 90, 2)]
    for turn, ids in enumerate(seen[:2]):  # two snapshots in one batch, so a group has ids of different times
        lifecycle.land(snapshot(spark, [(n, "a", None) for n in ids]), f"{folder}/landing", START + timedelta(hours=turn))
    for turn in (1, 2):
        if turn == 2:
            lifecycle.land(snapshot(spark, [(n, "b", None) for n in seen[2]]), f"{folder}/landing", START + timedelta(hours=2))
        query = lifecycle.start_feed(spark, f"{folder}/landing", f"{folder}/feed", f"{folder}/checkpoint")
        query.awaitTermination()
        assert {p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress} == {3}
    want |= {(n, "inserted", False, 0) for n in range(60)} | {(n, "unchanged", False, 1) for n in range(30, 60)}
    want |= {(n, "inserted", False, 1) for n in range(60, 90)} | {(n, "deactivated", False, 1) for n in range(30)}
    want |= {(n, "updated", n < 30, 2) for n in seen[2]} | {(n, "deactivated", False, 2) for n in range(31, 90, 2)}
    hours = ((F.unix_timestamp("snapshot_at") - int(START.timestamp())) / 3600).cast("int")
    got = lifecycle.read_feed(spark, folder).select("id", "change", "reactivated", hours).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
