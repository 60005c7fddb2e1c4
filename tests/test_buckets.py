from __future__ import annotations

import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import cell, row
from pyspark.sql import functions as F
from test_merge import names

from geoledger import constants as K
from geoledger.operators import merge as M
from geoledger.operators.quality import DataRejected
from geoledger.plans.collect import incoming_rows
from geoledger.sources.buckets import BucketedState
from geoledger.sources.state import STATE_SCHEMA

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def day(n: int) -> datetime:
    return START + timedelta(days=n)


def files(root) -> set[str]:
    return {
        os.path.join(d, f) for d, _, found in os.walk(f"{root}/data") for f in found if f.endswith(".parquet") and "manifest" not in d
    }


@pytest.fixture
def state(spark, tmp_path):
    made = BucketedState(spark, str(tmp_path / "state"), buckets=8)
    yield made
    made.forget()


@pytest.fixture
def snapshot(spark, places):
    def build(ids, changed=()):
        rows = [row(id=n, ident=f"{cell('ident', n)}{'!' if n in changed else ''}") for n in ids]
        return incoming_rows(places(rows), names(spark, {n: "甲" for n in ids if n % 3 == 0}))

    return build


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_an_equal_snapshot_writes_no_rows(state, snapshot, tmp_path):
    state.merge(snapshot(range(40)), day(1))
    held = files(tmp_path / "state")
    state.merge(snapshot([*reversed(range(40))]), day(2))
    assert files(tmp_path / "state") == held
    rows = state.read()
    assert rows.where(F.col("last_seen_at") != F.lit(day(2))).count() == 0
    assert rows.where(F.col("updated_at") != F.lit(day(1))).count() == 0
    assert state.changes().groupBy("change").count().collect() == [("unchanged", 40)]


def test_one_changed_row_rewrites_its_bucket(state, snapshot, tmp_path):
    state.merge(snapshot(range(40)), day(1))
    held = files(tmp_path / "state")
    state.merge(snapshot(range(40), changed=[7]), day(2))
    assert len(files(tmp_path / "state") - held) == 1
    assert state.manifest().where("NOT linked").count() == 1
    assert [r["id"] for r in state.changes().where("change = 'updated'").collect()] == [7]


def test_the_state_is_not_shuffled(spark, state, snapshot):
    state.merge(snapshot(range(40)), day(1))
    current = state._confirmed(1).select(*K.STATE_COLUMNS)
    merged = M.merge_with_changes(current, snapshot(range(50)), day(2))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = plan.split("FullOuter")[1].split("Bucketed: true")[0]
    assert "Exchange hashpartitioning" not in left


def test_rows_that_expire_later_keep_their_bucket_open(state, snapshot):
    state.merge(snapshot(range(20)), day(5))
    state.merge(snapshot(range(10)), day(3))  # an older snapshot takes nothing away
    assert state.read().where("NOT is_active").count() == 0
    state.merge(snapshot(range(10)), day(9))
    gone = state.read().where("NOT is_active")
    assert {r["id"] for r in gone.collect()} == set(range(10, 20))
    assert gone.where(F.col("deactivated_at") != F.lit(day(9))).count() == 0


def test_random_histories_equal_plain_merges(spark, state, snapshot):
    rng = random.Random(2)
    plain = spark.createDataFrame([], STATE_SCHEMA)
    held, when = set(range(12)), 3
    for turn in range(6):
        if turn % 3:
            held = (held | {rng.randrange(20)}) - {rng.randrange(20)}
        changed = [n for n in held if rng.random() < 0.1] if turn % 2 else []
        when += rng.choice([1, 2, -1, 0])
        incoming = snapshot(sorted(held), changed)
        feed = M.change_feed(plain, incoming, day(when))
        merged = M.merge_snapshot(plain, incoming, day(when))
        state.merge(incoming, day(when))
        assert rows_of(state.changes()) == rows_of(feed)
        plain = spark.createDataFrame(merged.collect(), STATE_SCHEMA)
        assert rows_of(state.read()) == rows_of(plain)


def test_load_empty_snapshots_and_older_versions(spark, state, snapshot):
    assert state.version() is None and state.read().count() == 0 and state.changes().count() == 0
    first = M.merge_snapshot(spark.createDataFrame([], STATE_SCHEMA), snapshot(range(9)), day(1))
    state.load(first)
    assert rows_of(state.read()) == rows_of(first)
    state.merge(snapshot([]), day(2))
    assert state.read().where("is_active").count() == 0
    state.merge(snapshot([]), day(3))
    assert state.manifest().where("NOT linked").count() == 0
    assert rows_of(state.read(1)) == rows_of(first)


def test_of_two_writers_one_gets_the_version(state, snapshot, monkeypatch):
    state.merge(snapshot(range(4)), day(1))
    write = BucketedState._write

    def overtaken(self, folder, rows):
        write(self, folder, rows)
        self._log.commit(2, "other")

    monkeypatch.setattr(BucketedState, "_write", overtaken)
    with pytest.raises(DataRejected):
        state.merge(snapshot(range(5)), day(2))
