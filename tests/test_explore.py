from __future__ import annotations

import json
import random
from datetime import datetime, timezone

import pytest
from conftest import csv_text, mixed_rows, row
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import geo as G
from geoledger.functions import text as T
from geoledger.operators import explore as E
from geoledger.operators import spatial as SP
from geoledger.operators.quality import DataRejected
from geoledger.plans.publish import publish_job
from geoledger.sources import published as P


def named(places, rows, zh=()):
    df = places(rows)
    known = F.col("id").isin(*zh) if zh else F.lit(False)
    return df.withColumns(
        {name: F.when(known, "北京首都").cast("string") for name in ("name_zh", "municipality_zh", "location_zh")}
    ).withColumn("name_zh_source", F.when(known, "wikidata:Q1:zh-cn"))


def idents(df):
    return sorted(r["ident"] for r in df.collect())


def test_filters(places):
    rows = [
        row(ident="ZBAA", keywords="北京 首都", iata_code="PEK"),
        row(id=2, ident="KJFK", iso_country="US"),
        row(id=3, ident="ZZZ", scheduled_service="no"),
        row(id=4, ident="S", type="small_airport"),
        row(id=5, ident="H", type="heliport"),
        row(id=6, ident="C", type="closed"),
    ]
    df = named(places, rows, [1, 3])
    state = E.FilterState
    assert idents(E.filter_places(df)) == ["KJFK", "ZBAA", "ZZZ"]
    assert idents(E.filter_places(df, state(types=()))) == []
    assert idents(E.filter_places(df, state(countries=("US",)))) == ["KJFK"]
    assert idents(E.filter_places(df, state(has_zh=True))) == ["ZBAA", "ZZZ"]
    assert idents(E.filter_places(df, state(scheduled_only=True))) == ["KJFK", "ZBAA"]
    assert idents(E.filter_places(df, state(query="首都 PEK"))) == ["ZBAA"]
    assert idents(E.filter_places(df, state(query="kennedy"))) == []
    assert idents(E.search(df, " zbaa　municipality ")) == ["ZBAA"]
    assert {r["type"]: r["places"] for r in E.count_by_type(df).collect()} == {
        "large_airport": 3, "medium_airport": 0, "small_airport": 1, "heliport": 1, "seaplane_base": 0,
        "balloonport": 0, "closed": 1,
    }
    assert [(r[0], r[1]) for r in E.top_countries(df, 1).collect()] == [("PG", 5)]
    assert [r[0] for r in E.top_countries(df, 5, " u").collect()] == ["US"]
    assert idents(E.lod_filter(df)) == ["KJFK", "ZBAA", "ZZZ"]


URLS = [
    ("", "large_airport,medium_airport,seaplane_base,balloonport", "", "", False, False, True, "satellite"),
    ("?type=", "", "", "", False, False, True, "satellite"),
    ("type=large_airport%2C+closed,bogus&country=cn,USA,%20us&q=%E9%A6%96+airport&zh=1&sched=1&borders=0&map=street",
     "large_airport,closed", "CN,US", "首 airport", True, True, False, "street"),
    ("q=100%&map=nonsense&zh=true", "large_airport,medium_airport,seaplane_base,balloonport", "", "100%", False, False, True, "satellite"),
    ("https://x.example/a?q=a%3Db=c&q=second#f", "large_airport,medium_airport,seaplane_base,balloonport", "", "a=b=c", False, False, True, "satellite"),
    ("%71=enc&&type=heliport", "heliport", "", "enc", False, False, True, "satellite"),
]


def test_decode_and_encode(spark):
    df = spark.createDataFrame([(u[0],) for u in URLS], "url string")
    got = E.decode_filters(df, "url")
    flat = got.withColumns({"types": F.array_join("types", ","), "countries": F.array_join("countries", ",")})
    assert [tuple(r) for r in flat.collect()] == URLS
    encoded = E.encode_filters(got, "again")
    again = E.decode_filters(encoded.select("url", "again"), "again").drop("again")
    assert [tuple(r) for r in again.select(got.columns).collect()] == [tuple(r) for r in got.collect()]
    assert encoded.where("url = '?type='").first()["again"] == "type="


def test_filter_table_against_single_filters(spark, places):
    rng = random.Random(2)
    rows = [
        row(id=i, ident=f"I{i}", type=rng.choice(K.PLACE_TYPES), iso_country=rng.choice(["CN", "US", ""]),
            scheduled_service=rng.choice(["yes", "no", ""]), name=rng.choice(["Red Field", "Blue Airport", "Red Airport"]))
        for i in range(60)
    ]
    df = named(places, rows, range(0, 60, 2))
    states = [
        E.FilterState(
            types=tuple(rng.sample(K.PLACE_TYPES, rng.randrange(4))), countries=rng.choice([(), ("CN",), ("CN", "US")]),
            query=rng.choice(["", "red", "AIRPORT red", "nothing"]), has_zh=rng.random() < 0.3, scheduled_only=rng.random() < 0.3,
        )
        for _ in range(25)
    ]
    states.append(states[0])
    table = spark.createDataFrame(
        [(list(s.types), list(s.countries), s.query, s.has_zh, s.scheduled_only) for s in states],
        "types array<string>, countries array<string>, query string, has_zh boolean, scheduled_only boolean",
    )
    found = df.select("id", *[F.when(E.filter_predicate(s), 1).otherwise(0).alias(f"s{i}") for i, s in enumerate(states)]).collect()
    expected: dict[str, set] = {}
    counts: dict[str, int] = {}
    for i, s in enumerate(states):
        key = json.dumps([sorted(s.types), sorted(s.countries), sorted(s.query.lower().split()), s.has_zh, s.scheduled_only])
        expected[key] = {r["id"] for r in found if r[f"s{i}"]}
        counts[key] = counts.get(key, 0) + 1

    def key_of(text):
        value = json.loads(text)
        return json.dumps([value[n] for n in ("types", "countries", "tokens", "has_zh", "scheduled_only")])

    pairs: dict[str, set] = {}
    for r in E.apply_filter_table(df, table).collect():
        pairs.setdefault(key_of(r["state"]), set()).add(r["id"])
    assert pairs == {k: v for k, v in expected.items() if v}
    got = {key_of(r["state"]): (r["filters"], r["places"]) for r in E.count_filter_table(df, table).collect()}
    assert got == {k: (counts[k], len(v)) for k, v in expected.items()}


def test_display(spark, places):
    df = named(places, [row(), row(id=2, ident="B", municipality="", iso_country="")], [1])
    zh = {r["id"]: r for r in E.display_names(df, "zh-CN").collect()}
    assert (zh[1]["primary_name"], zh[1]["secondary_name"], zh[1]["city_name"]) == ("北京首都", "name 1", "北京首都")
    assert (zh[2]["primary_name"], zh[2]["secondary_name"], zh[2]["city_name"]) == ("name 2", None, None)
    en = {r["id"]: r for r in E.display_names(df, "en").collect()}
    assert (en[1]["primary_name"], en[1]["secondary_name"], en[1]["city_name"]) == ("name 1", "北京首都", "municipality 1")
    labels = spark.createDataFrame([("PG", "Papua")], "code string, label string")
    assert {r["id"]: r["country_label"] for r in E.country_label(df, labels).collect()} == {1: "Papua", 2: "—"}
    kinds = spark.createDataFrame([("wikidata:Q1:zh",), ("wikipedia:en:L>zh",), ("composite:x",), ("llm:m",), (None,), ("x",)], "s string")
    assert [r[0] for r in kinds.select(T.name_source_kind("s")).collect()] == [
        "authoritative", "authoritative", "composite", "llm", "unknown", "unknown"
    ]


def test_formats(spark):
    df = spark.createDataFrame([(40.0801, 116.5846, 116), (-33.5, -0.25, -1200), (0.0, 0.0, None)], "lat double, lon double, ft int")
    got = [tuple(r) for r in df.select(G.format_coordinates("lat", "lon"), G.format_elevation("ft")).collect()]
    assert got == [
        ("40.0801° N, 116.5846° E", "116 ft / 35 m"), ("33.5000° S, 0.2500° W", "-1,200 ft / -366 m"),
        ("0.0000° N, 0.0000° E", "—"),
    ]


def test_globe(spark):
    df = spark.createDataFrame([(0.0, 0.0), (90.0, 0.0), (0.0, 90.0)], "lat double, lon double")
    got = [tuple(round(x, 6) + 0.0 for x in r[0]) for r in df.select(G.globe_xyz("lat", "lon")).collect()]
    assert got == [(0.0, 0.0, 100.0), (0.0, 100.0, 0.0), (100.0, 0.0, 0.0)]
    assert [r["lat"] for r in SP.facing(df, (0.0, 300.0, 0.0)).collect()] == [90.0]
    km = df.limit(1).select(G.haversine_km(F.lit(39.9042), F.lit(116.4074), F.lit(31.2304), F.lit(121.4737))).first()[0]
    assert km == pytest.approx(1067, rel=0.02)


POINTS = "position bigint, lat double, lon double"
QUERIES = "query string, lat double, lon double"


def test_grid(spark):
    points = spark.createDataFrame([(1, 10.0, 20.0), (2, 10.4, 20.4), (3, -30.0, 150.0)], POINTS)
    assert points.select(G.cell_key("lat", "lon")).first()[0] == "20:40"
    asked = spark.createDataFrame([("near", 10.2, 20.2), ("far", -30.0, 150.0), ("none", 40.0, 40.0)], QUERIES)
    pairs = SP.neighbour_pairs(asked, points)
    assert sorted((r["query"], r["position"]) for r in pairs.collect()) == [("far", 3), ("near", 1), ("near", 2)]
    assert {r["query"]: r["points"] for r in SP.neighbour_counts(asked, points).collect()} == {"near": 2, "far": 1, "none": 0}
    edge = spark.createDataFrame([("east", 0.1, 179.9)], QUERIES)
    other = spark.createDataFrame([(7, 0.1, -179.9)], POINTS)
    assert SP.neighbour_counts(edge, other).first()["points"] == 0
    assert SP.neighbour_counts(edge, other, wrap=True).first()["points"] == 1


def picked(queries, points, limit, size=K.CELL_SIZE, rings=K.PICK_RINGS):
    from math import floor

    out = {}
    for name, lat, lon in queries:
        for ring in rings:
            best = None
            for p, a, b in points:
                da, db = floor(a / size) - floor(lat / size), floor(b / size) - floor(lon / size)
                square = (b - lon) * (b - lon) + (a - lat) * (a - lat)
                if max(abs(da), abs(db)) <= ring and square <= limit * limit:
                    rank = (square, -da, -db, -p)
                    best = min(best, (rank, p)) if best else (rank, p)
            if best:
                out[name] = best[1]
                break
    return out


@pytest.mark.parametrize("limit", [0.05, 0.5, 1.0, 2.6])
def test_nearest_pick_against_all_pairs(spark, limit):
    rng = random.Random(int(limit * 100))
    points = [(i, rng.uniform(-3, 3), rng.uniform(-3, 3)) for i in range(80)]
    points += [(200 + i, 1 + rng.uniform(-0.01, 0.01), 1 + rng.uniform(-0.01, 0.01)) for i in range(80)]
    points += [(400 + i, round(rng.uniform(-2, 2) * 4) / 4, round(rng.uniform(-2, 2) * 4) / 4) for i in range(80)]
    queries = [(f"a{i}", rng.uniform(-5, 5), rng.uniform(-5, 5)) for i in range(60)]
    queries += [(f"b{i}", 1 + rng.uniform(-0.02, 0.02), 1 + rng.uniform(-0.02, 0.02)) for i in range(40)]
    queries += [(f"c{i}", round(rng.uniform(-2, 2) * 4) / 4 + 0.125, round(rng.uniform(-2, 2) * 4) / 4) for i in range(40)]
    got = SP.nearest_pick(spark.createDataFrame(queries, QUERIES), spark.createDataFrame(points, POINTS), limit)
    assert {r["query"]: r["position"] for r in got.collect()} == picked(queries, points, limit)


def test_pick_example(spark):
    points = spark.createDataFrame([(1, 10.0, 20.0), (2, 10.4, 20.4), (3, -30.0, 150.0)], POINTS)
    asked = spark.createDataFrame([("a", 10.1, 20.1), ("b", 40.0, 40.0)], QUERIES)
    assert [(r["query"], r["position"]) for r in SP.nearest_pick(asked, points, 1.0).collect()] == [("a", 1)]


def names_of(spark, rows):
    schema = ", ".join(f"{name} {'bigint' if name == 'id' else 'string'}" for name in K.NAME_COLUMNS)
    full = [tuple({**dict.fromkeys(K.NAME_COLUMNS), **r}[name] for name in K.NAME_COLUMNS) for r in rows]
    return spark.createDataFrame(full, schema)


def test_publish(spark, places, write, tmp_path):
    from geoledger.sources.names import write_names

    entries = names_of(spark, [{"id": 1, "name_zh": '测"试', "name_zh_source": "wikidata:Q1:zh-cn", "location_zh": "镇"}])
    write_names(entries, str(tmp_path / "names"))
    path = write(csv_text(list(reversed(mixed_rows()))))
    out = str(tmp_path / "out")
    manifest = publish_job(
        spark, path, str(tmp_path / "names"), out, generated_at=datetime(2026, 1, 1, tzinfo=timezone.utc), min_rows=1, min_large=1
    )
    assert manifest["schemaVersion"] == 1 and manifest["rows"] == 4 and manifest["names"]["rowCount"] == 1
    assert manifest["namedRows"] == 1 and manifest["unresolvedTargets"] == 1
    assert {k: v for k, v in manifest["typeCounts"].items() if v} == {
        "closed": 1, "large_airport": 1, "medium_airport": 1, "small_airport": 1
    }
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{out}/rows").collect()]
    assert [line[0] for line in lines] == [1, 2, 3, 4] and all(len(line) == 25 for line in lines)
    assert lines[0][list(K.PUBLISHED_FIELDS).index("name_zh")] == '测"试' and lines[1][14] is None
    back = P.read_published(spark, f"{out}/rows", f"{out}/manifest").orderBy("id").collect()
    assert [r["id"] for r in back] == [1, 2, 3, 4]
    assert back[0]["location_zh"] == "镇" and back[0]["latitude_deg"] == 1.25 and back[0]["elevation_ft"] == 50


def test_parse_published(spark):
    fields = ["id", "ident", "type", "name", "latitude_deg", "longitude_deg", "municipality", "keywords"]
    rows = [
        [1, "AAA", "large_airport", "Ok", 10, 20.5, None, 7],
        [2, "BBB", "spaceship", "Bad type", 10, 20, None, None],
        [3, "CCC", "large_airport", "No coordinate", None, 20, None, None],
        [4, "DDD", "closed", "Text coordinate", "10", 20, None, None],
        [5, "", "closed", "No ident", 10, 20, None, None],
        [6, "FFF", "closed", "Short", 10, 20],
        [9007199254740993, "HUGE", "closed", "Beyond doubles", 10, 20],
        [7.0, "GGG", "closed", "Whole fraction", 10, 20],
    ]
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows] + [("oops",)], "value string")
    got = P.parse_published(lines, fields).collect()
    assert [(r["id"], r["ident"]) for r in got] == [(1, "AAA"), (6, "FFF"), (9007199254740993, "HUGE"), (7, "GGG")]
    assert got[0]["longitude_deg"] == 20.5 and got[0]["keywords"] is None and got[0]["name_zh"] is None
    objects = spark.createDataFrame([(json.dumps(dict(zip(fields, r))),) for r in rows], "value string")
    assert [r["ident"] for r in P.parse_published(objects).collect()] == ["AAA", "FFF", "HUGE", "GGG"]


@pytest.mark.parametrize("version, fields", [(99, list(K.PUBLISHED_FIELDS)), (1, ["id", "name"])])
def test_bad_manifests(spark, version, fields):
    with pytest.raises(DataRejected):
        P.check_manifest(spark.createDataFrame([(version, fields)], "schemaVersion int, fields array<string>"))
