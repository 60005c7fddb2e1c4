from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from conftest import csv_text, mixed_rows, row
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.operators import merge as M
from geoledger.operators.quality import DataRejected
from geoledger.plans.collect import collect_job, incoming_rows, state_status
from geoledger.sources.names import write_names
from geoledger.sources.state import STATE_SCHEMA, StateTable
from geoledger.streaming.landing import announce, run_pending

DAY = [datetime(2024, 1, day, tzinfo=timezone.utc) for day in range(1, 10)]


def names(spark, values: dict[int, str | None], **more):
    rows = [(key, name, f"wikidata:Q{key}:zh-cn", None, None, None, None) for key, name in values.items()]
    columns = "id bigint, " + ", ".join(f"{name} string" for name in K.ATTACHED_NAME_COLUMNS)
    return spark.createDataFrame(rows, columns)


def step(spark, places, state, rows, named, at):
    incoming = incoming_rows(places(rows), names(spark, named))
    feed = M.change_feed(state, incoming, at)
    counts = M.merge_counts(feed).first().asDict()
    merged = M.merge_snapshot(state, incoming, at)
    return spark.createDataFrame(merged.collect(), STATE_SCHEMA), counts


def test_five_scenarios(spark, places):
    state = spark.createDataFrame([], STATE_SCHEMA)
    state, counts = step(spark, places, state, mixed_rows(), {1: "甲"}, DAY[0])
    assert counts == {"inserted": 4, "updated": 0, "unchanged": 0, "deactivated": 0, "reactivated": 0}

    state, counts = step(spark, places, state, mixed_rows(), {1: "甲"}, DAY[1])
    assert counts["unchanged"] == 4 and counts["updated"] == 0
    rows = {r["id"]: r for r in state.collect()}
    assert all(r["updated_at"].day == 1 and r["last_seen_at"].day == 2 for r in rows.values())

    state, counts = step(spark, places, state, mixed_rows()[:3], {1: "甲"}, DAY[2])
    assert counts["deactivated"] == 1 and counts["unchanged"] == 3
    gone = {r["id"]: r for r in state.collect()}[4]
    assert not gone["is_active"] and gone["deactivated_at"].day == 3 and gone["updated_at"].day == 3
    assert gone["last_seen_at"].day == 2

    state, counts = step(spark, places, state, mixed_rows(), {1: "甲"}, DAY[3])
    assert counts["reactivated"] == 1 and counts["unchanged"] == 4
    back = {r["id"]: r for r in state.collect()}[4]
    assert back["is_active"] and back["deactivated_at"] is None and back["updated_at"].day == 4
    assert back["first_seen_at"].day == 1

    state, counts = step(spark, places, state, mixed_rows(), {1: "乙"}, DAY[4])
    assert counts["updated"] == 1 and counts["unchanged"] == 3
    edited = {r["id"]: r for r in state.collect()}[1]
    assert edited["name_zh_updated_at"].day == 5 and edited["name_zh"] == "乙"

    state, counts = step(spark, places, state, mixed_rows(), {}, DAY[5])
    cleared = {r["id"]: r for r in state.collect()}[1]
    assert cleared["name_zh"] is None and cleared["name_zh_updated_at"].day == 6
    assert {r["id"]: r for r in state.collect()}[2]["name_zh_updated_at"] is None


def test_source_columns_of_names_are_not_compared(spark, places):
    state, _ = step(spark, places, spark.createDataFrame([], STATE_SCHEMA), mixed_rows(), {1: "甲"}, DAY[0])
    incoming = incoming_rows(places(mixed_rows()), names(spark, {1: "甲"})).withColumn(
        "name_zh_source", F.lit("other")
    )
    assert M.merge_counts(M.change_feed(state, incoming, DAY[1])).first()["unchanged"] == 4
    merged = {r["id"]: r for r in M.merge_snapshot(state, incoming, DAY[1]).collect()}
    assert merged[1]["name_zh_source"] == "other" and merged[1]["updated_at"].day == 1


def test_an_older_snapshot_deactivates_nothing_newer(spark, places):
    state, _ = step(spark, places, spark.createDataFrame([], STATE_SCHEMA), mixed_rows(), {}, DAY[4])
    state, counts = step(spark, places, state, mixed_rows()[:1], {}, DAY[2])
    assert counts["deactivated"] == 0
    rows = {r["id"]: r for r in state.collect()}
    assert rows[1]["source_snapshot_at"].day == 3 and all(r["is_active"] for r in rows.values())


def test_insert_update_unchanged_cover_the_snapshot(spark, places):
    state, _ = step(spark, places, spark.createDataFrame([], STATE_SCHEMA), mixed_rows()[:2], {}, DAY[0])
    rows = [*mixed_rows()[1:], row(id=9, ident="NNN")]
    incoming = incoming_rows(places(rows), names(spark, {2: "乙"}))
    counts = M.merge_counts(M.change_feed(state, incoming, DAY[1])).first()
    assert counts["inserted"] + counts["updated"] + counts["unchanged"] == 4
    assert [r["id"] for r in M.absent_keys(state, incoming).collect()] == [1]


LIMITS = {"min_rows": 1, "min_large": 1}


def names_file(spark, tmp_path, values):
    entries = [(key, f"I{key}", "large_airport", None, None, "N", name, "llm:m", "resolved", *[None] * 3, "unresolved", None, None) for key, name in values.items()]
    schema = ", ".join(f"{name} {'bigint' if name == 'id' else 'string'}" for name in K.NAME_COLUMNS)
    path = str(tmp_path / "names")
    write_names(spark.createDataFrame(entries, schema), path)
    return path


def test_collect_job(spark, write, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"))
    path, named = write(csv_text(mixed_rows())), names_file(spark, tmp_path, {1: "测试", 4: "中型"})
    first = collect_job(spark, path, table, named, snapshot_at=DAY[0], **LIMITS)
    assert (first.run_id, first.version, first.rows_total, first.rows_inserted) == (1, 1, 4, 4)
    assert (first.rows_named_targets, first.rows_missing_zh) == (2, 0)
    again = collect_job(spark, path, table, named, snapshot_at=DAY[1], **LIMITS)
    assert again.rows_unchanged == 4 and again.version == 2
    assert collect_job(spark, path, table, named, run_id=2, **LIMITS) is None
    runs = {r["run_id"]: r for r in table.runs().collect()}
    assert runs[1]["status"] == "succeeded" and runs[1]["source_bytes"] > 0 and len(runs[1]["source_sha256"]) == 64
    status = state_status(table).first()
    assert (status["rows_total"], status["named_targets_with_zh"], status["last_run_id"]) == (4, 2, 2)


def test_names_are_required_unless_allowed(spark, write, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"))
    path, missing = write(csv_text(mixed_rows())), str(tmp_path / "no-names")
    with pytest.raises(DataRejected, match="does not exist"):
        collect_job(spark, path, table, missing, **LIMITS)
    assert table.events().count() == 0
    got = collect_job(spark, path, table, missing, allow_missing_names=True, **LIMITS)
    assert got.rows_missing_zh == 2


def test_failure_is_logged_and_leaves_the_state(spark, write, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"))
    collect_job(spark, write(csv_text(mixed_rows()), "a.csv"), table, snapshot_at=DAY[0], allow_missing_names=True, **LIMITS)
    # The ident of an inactive row moves to a new id.
    moved = mixed_rows()[:3] + [row(id=8, ident="ident 4")]
    with pytest.raises(DataRejected, match="more than one id"):
        collect_job(spark, write(csv_text(moved), "b.csv"), table, snapshot_at=DAY[1], allow_missing_names=True, **LIMITS)
    assert table.version() == 1 and table.read().count() == 4
    last = table.runs().orderBy(F.desc("run_id")).first()
    assert last["status"] == "failed" and "more than one id" in last["error_message"]
    collect_job(spark, write(csv_text(mixed_rows()), "c.csv"), table, snapshot_at=DAY[2], allow_missing_names=True, **LIMITS)
    assert table.version() == 2


def test_error_text_is_cut(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"))
    table.log(1, DAY[0], "failed", error_message="x" * 3000)
    assert len(table.runs().first()["error_message"]) == 2000


def test_duplicate_ids_stop_the_job(spark, write, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"))
    with pytest.raises(DataRejected, match="twice"):
        collect_job(spark, write(csv_text([row(), row(ident="Z")])), table, allow_missing_names=True, **LIMITS)
    assert table.version() is None


def test_landing_stream(spark, write, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"))
    landing = tmp_path / "landing"
    first = write(csv_text(mixed_rows()), "snapshots/one/a.csv")
    write(csv_text(mixed_rows()[:2]), "snapshots/two/a.csv")
    write(csv_text([mixed_rows()[3]]), "snapshots/two/b.csv")

    def run():
        run_pending(
            spark, str(landing), table, str(tmp_path / "stream"), allow_missing_names=True, **LIMITS
        ).awaitTermination()

    announce(spark, str(landing), "one", first, DAY[0])
    run()
    assert table.version() == 1
    announce(spark, str(landing), "two", str(tmp_path / "snapshots/two"), DAY[1])
    run()
    run()
    assert table.version() == 2
    assert {r["id"]: r["is_active"] for r in table.read().collect()} == {1: True, 2: True, 3: False, 4: True}
    assert table.runs().count() == 2


def test_landing_stream_keeps_snapshots_beside_other_runs(spark, write, tmp_path):
    """A run by hand takes a number of its own, and a broken snapshot does not hold up the next one."""
    table = StateTable(spark, str(tmp_path / "state"))
    by_hand = write(csv_text(mixed_rows()), "hand/a.csv")
    collect_job(spark, by_hand, table, snapshot_at=DAY[0], allow_missing_names=True, **LIMITS)
    landing = str(tmp_path / "landing")
    broken = [row(type="no such type")]
    for name, rows, at in (("one", mixed_rows()[:3], DAY[1]), ("two", broken, DAY[1]), ("three", [mixed_rows()[0], *mixed_rows()[2:]], DAY[2])):
        announce(spark, landing, name, write(csv_text(rows), f"{name}/a.csv"), at)

    def run():
        run_pending(
            spark, landing, table, str(tmp_path / "stream"), allow_missing_names=True, **LIMITS
        ).awaitTermination()

    run()
    run()
    assert table.version() == 3
    assert sorted(r["status"] for r in table.runs().collect()) == ["refused", "succeeded", "succeeded", "succeeded"]
    assert {r["id"] for r in table.read().where("is_active").collect()} == {1, 3, 4}


def test_of_two_writers_one_starts_again(spark, write, tmp_path, monkeypatch):
    table = StateTable(spark, str(tmp_path / "state"))
    other, own = write(csv_text(mixed_rows()[:2]), "x/a.csv"), write(csv_text(mixed_rows()), "y/a.csv")
    plain, calls = StateTable.write_folder, []

    def late(self, folder, merged, rows):
        plain(self, folder, merged, rows)
        calls.append(folder)
        if len(calls) == 1:
            collect_job(spark, other, table, snapshot_at=DAY[0], allow_missing_names=True, **LIMITS)

    monkeypatch.setattr(StateTable, "write_folder", late)
    got = collect_job(spark, own, table, snapshot_at=DAY[1], allow_missing_names=True, **LIMITS)
    assert (got.version, got.rows_inserted, got.rows_unchanged) == (2, 2, 2)
    assert len(calls) == 3 and table.read().count() == 4
    assert not table.commit(1, "elsewhere")
    assert len(table.clean(keep=1)) == 2 and table.clean(keep=1) == []
    assert table.read().count() == 4


def test_deactivate_missing_alone(spark, places):
    state, _ = step(spark, places, spark.createDataFrame([], STATE_SCHEMA), mixed_rows(), {}, DAY[0])
    same = M.deactivate_missing(state, DAY[0])
    assert same.where("is_active").count() == 4
    later = M.deactivate_missing(state, DAY[0] + timedelta(seconds=1))
    assert later.where("is_active").count() == 0
