from __future__ import annotations

import hashlib
import os

import pytest
from conftest import csv_text, mixed_rows, row

from geoledger import constants as K
from geoledger.operators import quality as Q
from geoledger.plans.collect import checked_snapshot
from geoledger.sources import snapshot
from geoledger.sources.snapshot import ragged_rows, read_snapshot, snapshot_meta, source_digest


def test_reads_and_types_rows(spark, write):
    rows = {r["id"]: r for r in checked_snapshot(spark, write(csv_text(mixed_rows()))).collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    assert rows[1]["latitude_deg"] == 1.25 and rows[1]["keywords"] == "keywords 1"
    assert rows[2]["iata_code"] is None and rows[3]["iata_code"] is None


def test_columns_are_read_by_name(spark, write):
    order = list(K.SOURCE_COLUMNS)
    order[12], order[13] = order[13], order[12]
    text = csv_text([row(gps_code="GGGG", icao_code="IIII")], order)
    got = checked_snapshot(spark, write(text)).first()
    assert (got["gps_code"], got["icao_code"]) == ("GGGG", "IIII")


def test_header_cells_are_trimmed_and_bom_dropped(spark, write):
    text = "﻿" + csv_text([row()]).replace("ident,", " ident ,", 1)
    assert checked_snapshot(spark, write(text)).first()["ident"] == "ident 1"


@pytest.mark.parametrize(
    "change",
    [
        lambda text: text.replace("latitude_deg", "lat_deg", 1),
        lambda text: text.replace("keywords", "ident", 1),
        lambda text: text.replace("keywords", "keywords,more", 1),
    ],
)
def test_wrong_headers_are_rejected(spark, write, change):
    with pytest.raises(Q.DataRejected, match="header"):
        read_snapshot(spark, write(change(csv_text([row()]))))


def test_blank_rows_are_skipped_whatever_their_width(spark, write):
    text = csv_text(mixed_rows()) + " , ,\n" + "," * 18 + "\n\n"
    assert checked_snapshot(spark, write(text)).count() == 4


def test_ragged_rows_are_rejected(spark, write):
    path = write(csv_text(mixed_rows()) + "9,XYZ,large_airport\n")
    assert ragged_rows(read_snapshot(spark, path)).count() == 1
    with pytest.raises(Q.DataRejected, match="wrong number of cells"):
        checked_snapshot(spark, path)


def test_quoted_line_breaks_stay_in_their_cell(spark, write):
    path = write(csv_text([row(keywords='a "b"\nc')]))
    assert checked_snapshot(spark, path, multi_line=True).first()["keywords"] == 'a "b"\nc'
    assert checked_snapshot(spark, path).first()["keywords"] == 'a "b"\nc'


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"ident": "  "}, "ident is empty"),
        ({"name": ""}, "name is empty"),
        ({"type": "airport"}, "type is not an allowed value"),
        ({"type": ""}, "type is not an allowed value"),
        ({"continent": "XX"}, "continent is not an allowed value"),
        ({"scheduled_service": "maybe"}, "scheduled_service is not an allowed value"),
        ({"id": "1.5"}, "id is not a whole number"),
        ({"latitude_deg": "1.5d"}, "latitude_deg is not a number"),
        ({"longitude_deg": "nan"}, "longitude_deg is not a number"),
        ({"elevation_ft": "high"}, "elevation_ft is not a number"),
        ({"type": "airport", "id": "x"}, "type is not an allowed value"),
    ],
)
def test_first_broken_rule_is_the_reason(spark, write, change, reason):
    raw = read_snapshot(spark, write(csv_text([row(), row(**{"id": 2, "ident": "BBB", **change})])))
    good, rejects = Q.validate_rows(raw)
    assert good.count() == 1
    assert [r["reason"] for r in rejects.collect()] == [reason]
    with pytest.raises(Q.DataRejected, match="break a rule"):
        checked_snapshot(spark, write(csv_text([row(**change)])))


def test_elevation_is_cut_toward_zero(spark, write):
    rows = [row(elevation_ft="-12.9"), row(id=2, ident="B", elevation_ft="1e2"), row(id=3, ident="C", elevation_ft=" ")]
    got = {r["id"]: r["elevation_ft"] for r in checked_snapshot(spark, write(csv_text(rows))).collect()}
    assert got == {1: -12, 2: 100, 3: None}


def test_duplicate_keys(places):
    df = places([row(), row(ident="ZZZ"), row(id=3, ident="ident 1"), row(id=4, ident="D")])
    got = {(r["key"], r["value"], r["rows"]) for r in Q.require_unique(df, "id", "ident").collect()}
    assert got == {("id", "1", 2), ("ident", "ident 1", 2)}
    with pytest.raises(Q.DataRejected, match="twice"):
        Q.enforce(Q.require_unique(df, "id"), "twice")


def test_gate(places):
    df = places(mixed_rows())
    assert Q.enforce_gate(Q.sanity_gate(df, 1, 1)) == (4, 1)
    for limits in ((50_000, 1), (1, 5)):
        with pytest.raises(Q.DataRejected, match="below the safe limit"):
            Q.enforce_gate(Q.sanity_gate(df, *limits))


def test_row_hash_sees_every_column(places):
    base = places([row()]).select(Q.row_hash()).first()[0]
    assert len(base) == 64
    for name in K.SOURCE_COLUMNS:
        changed = {"id": "7", "type": "closed", "continent": "EU", "scheduled_service": "no"}.get(name, "5")
        assert places([row(**{name: changed})]).select(Q.row_hash()).first()[0] != base
    assert places([row(iso_country="", iso_region="CN")]).select(Q.row_hash()).first()[0] != places(
        [row(iso_country="CN", iso_region="")]
    ).select(Q.row_hash()).first()[0]


def test_digests_of_whole_and_of_large_files(spark, write, monkeypatch):
    text = csv_text(mixed_rows())
    paths = [write(text, "a/a.csv"), write(text.replace("name 2", "name Z"), "b/a.csv"), write(text * 400, "c/a.csv")]
    metas = [snapshot_meta(spark, path).first() for path in paths]
    assert [m["sha256"] for m in metas] == [hashlib.sha256(open(p, "rb").read()).hexdigest() for p in paths]
    assert metas[0]["bytes"] == len(text.encode()) and metas[0]["tree_sha256"] is None
    assert source_digest(snapshot_meta(spark, paths[0])).first()["source_sha256"] == metas[0]["sha256"]
    monkeypatch.setattr(snapshot, "WHOLE_BYTES", 2000)
    folder = os.path.dirname(os.path.dirname(paths[0]))
    mixed = {m["path"][-7:]: m for m in snapshot_meta(spark, f"{folder}/*/a.csv").collect()}
    assert mixed["a/a.csv"]["sha256"] == metas[0]["sha256"]
    assert mixed["c/a.csv"]["sha256"] is None and len(mixed["c/a.csv"]["tree_sha256"]) == 64
    assert len(source_digest(snapshot_meta(spark, f"{folder}/*/a.csv")).first()["source_sha256"]) == 64
    lines = (text * 400).split("\n")
    lines[5], lines[6] = lines[6], lines[5]
    other = snapshot_meta(spark, write("\n".join(lines), "d/a.csv")).first()
    assert other["tree_sha256"] != mixed["c/a.csv"]["tree_sha256"]


def test_contract(spark, places):
    places([row()]).createOrReplaceTempView("contract_places")
    got = Q.check_contract(spark, {"contract_places": ["id", "row_hash"], "no_such_view": ["id"]}).collect()
    assert [tuple(r) for r in got] == [
        ("contract_places", "row_hash", "missing column"),
        ("no_such_view", None, "missing table or view"),
    ]
