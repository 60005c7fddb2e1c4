from __future__ import annotations

import itertools
import math
import random

import pytest
from conftest import row
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import text as T
from geoledger.operators import labels as L
from geoledger.operators import matching as MT
from geoledger.operators import replies as R
from geoledger.operators.ordering import numbered
from geoledger.plans import resolve as RS
from geoledger.sources import names as N

SIMPLIFY = T.Simplifier("國際機場磯維爾號車", "国际机场矶维尔号车")
CANDIDATE = "property string, code string, qid string, lat double, lon double, lang string, label string"


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def site(**changes):
    """The place that the matching cases are about."""
    return row(**{"latitude_deg": 10.0, "longitude_deg": 20.0, "iata_code": "AAA", "icao_code": "AAAA", **changes})


def candidates(spark, *rows):
    return MT.collect_candidates(spark.createDataFrame(list(rows), CANDIDATE), SIMPLIFY)


def empty_inputs(spark):
    return {
        "settlements": L.collect_settlements(
            spark.createDataFrame([], "entity string, admin_qid string, population string, lang string, label string")
        ),
        "pages": spark.createDataFrame(
            [], "title string, missing boolean, categories array<string>, langlinks array<string>"
        ),
        "redirects": spark.createDataFrame([], "from_title string, to_title string"),
    }


def resolve(spark, places, found, **inputs):
    return RS.resolve_names(places, found, **{**empty_inputs(spark), **inputs}, simplify=SIMPLIFY)


@pytest.mark.parametrize(
    "labels, expected",
    [
        # Simplified labels win over traditional ones, whatever their order.
        ({"zh-tw": ["東港號車站"], "zh-hans": ["东港号车站"]}, ("东港号车站", "zh-hans", False)),
        # A traditional label is simplified, and says so.
        ({"zh-hk": ["東港車場"]}, ("東港车场", "zh-hk>zh-hans", True)),
        ({"zh": ["國際場"]}, ("国际场", "zh>zh-hans", True)),
        # Labels without a character, or with a run of Latin letters, are none.
        ({"zh-cn": ["Plain words"]}, None),
        ({"zh": ["Quux機場"]}, None),
        # The next language takes over, and of two labels the first by text.
        ({"zh-cn": ["Plain words"], "zh": ["山", "口"]}, ("口", "zh", False)),
        # Other languages do not count.
        ({"fr": ["口"]}, None),
    ],
)
def test_choose_label(spark, labels, expected):
    rows = [("P238", "A", "Q1", 1.0, 1.0, lang, text) for lang, texts in labels.items() for text in texts]
    got = candidates(spark, *rows).first()
    assert (got["label"] and (got["label"], got["suffix"], got["converted"])) == expected


def test_bindings(spark):
    rows = [("P238", "A", "http://x/entity/Q5", text, "zh", "甲") for text in ("Point(116.4 39.9)", "nonsense", None)]
    df = spark.createDataFrame(rows, "property string, code string, entity string, coord string, lang string, label string")
    assert [(r["qid"], r["lat"], r["lon"]) for r in MT.parse_bindings(df).collect()] == [
        ("Q5", 39.9, 116.4), ("Q5", None, None), ("Q5", None, None)
    ]
    assert MT.collect_candidates(MT.parse_bindings(df)).first()["lat"] == 39.9


CASES = {
    "resolve": ([("P238", "AAA", "Q1", 10.0, 20.0, "zh-cn", "测试国际机场")], "AAA", "wikidata:Q1:zh-cn"),
    "far": ([("P238", "AAA", "Q1", 40.0, 20.0, "zh-cn", "错误机场")], "AAA", None),
    "ambiguous": (
        [("P238", "AAA", "Q1", 10.0, 20.0, "zh-cn", "甲"), ("P238", "AAA", "Q2", 10.0001, 20.0, "zh-cn", "乙"),
         ("P239", "AAAA", "Q3", 10.0, 20.0, "zh-cn", "丙")],
        "AAA", None,
    ),
    "second property": ([("P239", "AAAA", "Q9", 10.0, 20.0, "zh-hans", "伊")], "", "wikidata:Q9:zh-hans"),
    "first out of range": (
        [("P238", "AAA", "Q1", 40.0, 20.0, "zh", "远"), ("P239", "AAAA", "Q2", 10.1, 20.0, "zh", "近")],
        "AAA", "wikidata:Q2:zh",
    ),
    "no coordinate": ([("P238", "AAA", "Q1", None, None, "zh", "甲")], "AAA", None),
    "order of ids is text order": (
        [("P238", "AAA", "Q9", 10.0, 20.0, "zh", "九"), ("P238", "AAA", "Q10", 10.05, 20.0, "zh", "十")],
        "AAA", "wikidata:Q9:zh",
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_matching_cases(spark, places, case):
    rows, iata, source = CASES[case]
    got = resolve(spark, places([site(iata_code=iata)]), candidates(spark, *rows)).first()
    assert got["name_zh_source"] == source
    assert got["name_zh_status"] == (K.RESOLVED if source else K.UNRESOLVED)
    assert got["ambiguous"] == (case == "ambiguous")


def test_only_targets_are_resolved(spark, places):
    rows = [row(id=i, ident=f"I{i}", type=kind) for i, kind in enumerate(K.PLACE_TYPES)]
    got = resolve(spark, places(rows), candidates(spark))
    assert sorted(r["type"] for r in got.collect()) == ["large_airport", "medium_airport"]


def test_place_without_coordinates_scores_zero(spark, places):
    df = places([site(latitude_deg="")])
    single = candidates(spark, ("P238", "AAA", "Q1", 80.0, 20.0, "zh", "甲"))
    assert resolve(spark, df, single).first()["name_zh"] == "甲"
    two = candidates(spark, ("P238", "AAA", "Q1", 80.0, 20.0, "zh", "甲"), ("P238", "AAA", "Q2", -80.0, 2.0, "zh", "乙"))
    assert resolve(spark, df, two).first()["ambiguous"]


def great_circle(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * K.EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(h)))


def test_match_by_code_against_all_pairs(spark):
    """Crowds, lone points, copies, the date line and the poles under one shared code."""
    rng = random.Random(5)
    centres = [(0.0, 0.0), (89.99, 10.0), (-89.995, -170.0), (45.0, 179.999), (45.0, -179.999), (10.0, 20.0)]

    def near(centre, spread):
        lat = max(-90.0, min(90.0, centre[0] + rng.uniform(-spread, spread)))
        return lat, (centre[1] + rng.uniform(-spread, spread) + 180) % 360 - 180

    spots = [near(c, s) for c in centres for s in (0.001, 0.01, 0.1, 0.5) for _ in range(10)]
    entities = [near(c, s) for c in centres for s in (0.001, 0.02, 0.3) for _ in range(8)]
    entities += entities[:20] + spots[:5]
    places = [(i, *spot, "X", "Y" if i % 2 else None) for i, spot in enumerate(spots)]
    df = spark.createDataFrame(
        places, "id bigint, latitude_deg double, longitude_deg double, iata_code string, icao_code string"
    )
    rows = [("P238" if i % 3 else "P239", "X" if i % 3 else "Y", f"Q{i}", *e, None, None) for i, e in enumerate(entities)]
    got = {
        (r["id"], r["property"], r["place"]): (r["qid"], round(r["km"], 6))
        for r in MT.match_by_code(df, candidates(spark, *rows)).collect()
    }
    expected = {}
    for i, lat, lon, iata, icao in places:
        for prop, code in (("P238", iata), ("P239", icao)):
            scored = sorted(
                (great_circle((lat, lon), (r[3], r[4])), r[2]) for r in rows if r[0] == prop and r[1] == code
            )
            for place, (km, qid) in enumerate([s for s in scored if s[0] <= 25.0][:2], 1):
                expected[(i, prop, place)] = (qid, round(km, 6))
    assert got.keys() == expected.keys()
    assert {k: v[1] for k, v in got.items()} == pytest.approx({k: v[1] for k, v in expected.items()}, abs=2e-6)
    clear = [k for k in got if k[2] == 1 and got.get((k[0], k[1], 2), ("", 99.0))[1] - got[k][1] > 1e-4]
    assert clear and all(got[k][0] == expected[k][0] for k in clear)


def test_settlements(spark):
    schema = "entity string, admin_qid string, population string, lang string, label string"
    rows = [
        ("E1", "Q1", "100", "zh-cn", "小镇"), ("E1", "Q2", "90000", "zh-cn", "大城"), ("E1", "Q2", "bad", "zh-cn", "大城"),
        ("E2", "Q3", "5", "zh", "Town"), ("E3", "Q10", None, "zh", "甲"), ("E3", "Q9", "0.5", "zh", "乙"),
    ]
    best = L.best_settlement(L.collect_settlements(spark.createDataFrame(rows, schema)))
    assert {r["entity"]: (r["admin_qid"], r["label"]) for r in best.collect()} == {
        "E1": ("Q2", "大城"), "E3": ("Q10", "甲")
    }


PAGES = [
    ("Bakersfield, California", False, ["Category:Cities in California"], ["贝克斯菲尔德 (加利福尼亚州)"]),
    ("Alabaster", False, ["Category:Minerals"], ["雪花石膏"]),
    ("Akita", False, ["Category:Disambiguation pages", "Category:Towns"], ["秋田號列車"]),
    ("Shanghai", False, ["Category:Cities in China"], ["上海市"]),
    ("Springfield", False, [], []),
    ("Springfield", False, ["Category:Cities in Illinois"], ["斯普林菲尔德 (伊利诺伊州)"]),
    ("Nowhere", True, ["Category:Cities"], ["无处"]),
    ("D", False, ["Category:Towns"], ["丁"]),
]
REDIRECTS = [("Bakersfield", "Bakersfield, California"), ("A", "B"), ("B", "C"), ("C", "D"), ("Z", "A"), ("L", "L")]


def city_inputs(spark):
    return {
        "pages": spark.createDataFrame(
            PAGES, "title string, missing boolean, categories array<string>, langlinks array<string>"
        ),
        "redirects": spark.createDataFrame(REDIRECTS, "from_title string, to_title string"),
    }


def test_city_names(spark):
    cities = ["Bakersfield", "Alabaster", "Akita", "Shanghai (Pudong)", "Springfield", "Nowhere", "A", "Z", "L", None]
    df = spark.createDataFrame([(c,) for c in cities], "city string")
    got = {r["city"]: r["name_zh"] for r in L.city_names(df, **city_inputs(spark), simplify=SIMPLIFY).collect()}
    assert got == {
        "Bakersfield": "贝克斯菲尔德", "Shanghai (Pudong)": "上海市", "Springfield": "斯普林菲尔德", "A": "丁"
    }


def test_merge_pages(spark):
    got = L.merge_pages(city_inputs(spark)["pages"]).where("title in ('Springfield', 'Akita')").collect()
    assert sorted((r["title"], r["category"], r["langlink"]) for r in got) == [
        ("Akita", "Category:Disambiguation pages", "秋田號列車"),
        ("Akita", "Category:Towns", "秋田號列車"),
        ("Springfield", "Category:Cities in Illinois", "斯普林菲尔德 (伊利诺伊州)"),
    ]


@pytest.mark.parametrize(
    "title, expected",
    [("贝克斯菲尔德 (加利福尼亚州)", "贝克斯菲尔德"), ("阿什維爾（北卡）", "阿什维尔"), ("ABC City", None), (None, None)],
)
def test_clean_title(spark, title, expected):
    assert one(spark, T.clean_title(F.lit(title).cast("string"), SIMPLIFY)) == expected


@pytest.mark.parametrize(
    "name, place, place_zh, expected",
    [
        ("Tolvik Airport", "Tolvik", "托维克", "托维克机场"),
        ("Tolvik Regional Airport", "Tolvik", "托维克", "托维克机场"),
        ("New-Oskar   Air Base", "New Oskar", "新奥斯卡", "新奥斯卡空军基地"),
        ("Lake Seaplane Base", "Lake", "湖", "湖水上飞机基地"),
        # Words that are neither the place, nor a modifier, nor a kind.
        ("Tolvik Old Mill Airport", "Tolvik", "托维克", None),
        # One of the three is missing.
        (None, "Tolvik", "托维克", None),
        ("Tolvik Airport", None, "托维克", None),
        ("Tolvik Airport", "Tolvik", None, None),
        # Nothing is left for the place.
        ("Airport", "Airport", "机", None),
    ],
)
def test_compose_name(spark, name, place, place_zh, expected):
    columns = [F.lit(value).cast("string") for value in (name, place, place_zh)]
    assert one(spark, T.compose_name(*columns)) == expected


@pytest.mark.parametrize(
    "name, english, expected",
    [
        ("托维克机场", "Tolvik Airport", "托维克机场"),
        (' "托维克" ', "T", "托维克"),
        ("Tolvik", "Other", None),
        ("托" * 41, "Tolvik", None),
        ("山A", "山a", None),
        (None, "Tolvik", None),
    ],
)
def test_validate_name(spark, name, english, expected):
    assert one(spark, T.validate_name(F.lit(name).cast("string"), F.lit(english))) == expected


def test_white_space_matches_the_definition(spark):
    chars = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, f"{c}x{c}") for c in chars], "c string, t string")
    got = {r["c"] for r in df.where(T.strip("t") == "x").collect()}
    assert got == {c for c in chars if f"{c}x{c}".strip() == "x"}


def replied(spark, reply, ids):
    replies = spark.createDataFrame([(1, reply)], "batch_id bigint, reply string")
    expected = spark.createDataFrame([(1, i) for i in ids], "batch_id bigint, id bigint")
    return {r["id"]: r["value"] for r in R.reply_map(replies, expected).collect()}


@pytest.mark.parametrize(
    "reply, expected",
    [
        # The last object that answers wins, and null answers nothing.
        ('draft {"1": "山"} then {"1": "口", "2": null}', {1: "口", 2: None}),
        ('{"1": "口"} {"7": "山"}', {1: "口"}),
        ('{"7": "山"}', {}),
        # Values are trimmed; other kinds of values do not answer.
        ('{"1": " 口 ", "2": [1]}', {1: "口"}),
        # Braces and quotes inside quotes, and inside quoted text between objects.
        ('{"2": "a}{b", "1": "c\\"}"}', {1: 'c"}', 2: "a}{b"}),
        ('he wrote "{" and {"2": "山"}', {2: "山"}),
        ('{"1": "山"} "never closed {"2": "口"}', {1: "山"}),
        # An object that never ends hides what follows it.
        ('{"1": "山"} { open {"2": "口"}', {1: "山"}),
        # Objects nested to any depth are one object, and those behind them count.
        ('{"a": {"b": {"c": {"d": {"e": 1}}}}} {"2": "口"}', {2: "口"}),
        ('{"1": "山", "x": ' + '{"y": ' * 40 + "1" + "}" * 41 + ' } {"2": "口"}', {2: "口"}),
        # Not JSON: single quotes, stray braces, no object.
        ("{'1': '山'}", {}),
        ('} {"1": "山"}', {1: "山"}),
        ("none at all", {}),
        # The same id twice: the later entry.
        ('{" 01 ": "山", "1": "口"}', {1: "口"}),
    ],
)
def test_reply_map(spark, reply, expected):
    assert replied(spark, reply, [1, 2]) == expected


def test_numbering_is_global(spark):
    ids = random.Random(1).sample(range(10**9), 2000)
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(7)
    got = {r["id"]: r["rn"] for r in numbered(df, "id", slices=9).collect()}
    assert got == {key: place for place, key in enumerate(sorted(ids), 1)}
    assert numbered(df.limit(0), "id").count() == 0


def test_request_batches(spark):
    rows = [(i, f"N{i}", "PG" if i % 2 else None, None) for i in range(250)]
    df = spark.createDataFrame(rows, "id bigint, name string, iso_country string, municipality string")
    got = {r["batch_id"]: r for r in R.request_batches(df).collect()}
    assert [got[b]["size"] for b in (0, 1, 2)] == [100, 100, 50]
    assert got[1]["requests"].startswith('[{"id":100,"name":"N100","country":"","city":""},{"id":101')


def test_refresh_job(spark, places, tmp_path):
    rows = [
        site(id=1, name="One Airport"),
        row(id=2, ident="B", type="medium_airport", name="Springfield Regional Airport", iata_code="SSS", municipality="Springfield"),
        row(id=3, ident="C", name="Kerema Airport", iata_code="KKK", municipality=""),
        row(id=4, ident="D", name="Four Airport", iata_code="FFF", municipality="Nowhere"),
        row(id=5, ident="E", name="Five Airport", iata_code="VVV", municipality=""),
    ]
    archive = spark.createDataFrame([(3, "凯里马机场", "llm:codex:old"), (1, "不用", "llm:x")], "id bigint, name_zh string, source string")
    replies = spark.createDataFrame([(0, '{"4": "四机场", "5": "Five Airport", "1": "坏"}')], "batch_id bigint, reply string")
    settlements = spark.createDataFrame(
        [("Q1", "Q7", "5000", "zh-cn", "试验城市")],
        "entity string, admin_qid string, population string, lang string, label string",
    )
    inputs = RS.ResolutionInputs(
        places(rows),
        candidates(spark, ("P238", "AAA", "Q1", 10.0, 20.0, "zh-tw", "測試國際機場")),
        L.collect_settlements(settlements),
        **city_inputs(spark),
        archive=archive,
        replies=replies,
        reply_label="fake:test",
        simplify=SIMPLIFY,
    )
    out, kept = str(tmp_path / "names"), str(tmp_path / "archive")
    stats = RS.refresh_job(spark, inputs, str(tmp_path / "work"), out, kept).first().asDict()
    got = {r["id"]: r for r in N.read_names(spark, out).collect()}
    assert {key: r["name_zh_source"] for key, r in got.items()} == {
        1: "wikidata:Q1:zh-tw>zh-hans", 2: "composite:municipality:Springfield", 3: "llm:codex:old",
        4: "llm:fake:test", 5: None,
    }
    assert got[1]["location_zh_source"] == "wikidata:Q1:P131:Q7:zh-cn"
    assert got[2]["municipality_zh_source"] == "wikipedia:en:Springfield>zh"
    assert got[2]["name_zh"] == "斯普林菲尔德机场"
    assert {r["id"]: r["source"] for r in N.read_archive(spark, kept).collect()} == {3: "llm:codex:old", 4: "llm:fake:test"}
    assert stats == {
        "targets": 5, "resolved": 1, "unresolved": 1, "ambiguous": 0, "via_iata": 1, "via_icao": 0,
        "converted_from_traditional": 1, "municipality_from_wikipedia": 1, "municipality_unresolved": 2,
        "composite_resolved": 1, "llm_supplement_applied": 1, "llm_resolved": 1, "llm_unresolved": 1,
        "location_from_wikidata": 1, "location_unresolved": 4,
    }


def test_names_file(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(",".join(reversed(K.NAME_COLUMNS)) + "\n")
    with pytest.raises(Exception, match="header"):
        N.read_names(spark, str(path))
    path = tmp_path / "twice.csv"
    path.write_text(",".join(K.NAME_COLUMNS) + "\n" + ("1" + "," * 14 + "\n") * 2)
    with pytest.raises(Exception, match="more than once"):
        N.read_names(spark, str(path))
    assert N.read_archive(spark, str(tmp_path / "missing.csv")).count() == 0


def test_class_closure(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(70)] + [(100, 101), (101, 100)]
    df = spark.createDataFrame(edges, "child bigint, parent bigint")
    known = {1, 100}
    for _ in itertools.repeat(None, 200):
        known |= {c for c, p in edges if p in known}
    assert {r["node"] for r in MT.class_closure(df, [1, 100]).collect()} == known


def counted_tables(monkeypatch):
    made = []

    def keep(df, real=MT.written):
        made.append(1)
        return real(df)

    monkeypatch.setattr(MT, "written", keep)
    return made


def test_a_long_chain_is_closed_in_log_rounds(spark, monkeypatch):
    made = counted_tables(monkeypatch)
    n = 10_000
    chain = spark.range(n).selectExpr("id + 1 AS child", "id AS parent")
    assert MT.class_closure(chain, [0]).count() == n + 1
    assert len(made) <= 1 + 4 * 15  # four tables a round


def brute_closure(edges, roots):
    out = {}
    for root in roots:
        near, depth = {root}, 0
        while near:
            for node in near:
                out[root, node] = depth
            near = {c for c, p in edges if p in near and (root, c) not in out}
            depth += 1
    return out


def test_closures_of_graphs_with_cycles_and_many_parents(spark):
    rng = random.Random(4)
    for n, m in ((6, 9), (40, 50), (60, 110)):
        edges = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
        df = spark.createDataFrame([*edges, (None, 1), (2, None), *list(edges)[:3]], "child long, parent long")
        want = brute_closure(edges, {p for _, p in edges})
        got = {(r["root"], r["node"]): r["distance"] for r in MT.closure(df.where("child is not null")).collect() if r["root"] is not None}
        assert got == want
        for roots in ([1], [0, n + 5]):
            assert {r["node"] for r in MT.class_closure(df, roots).collect()} == {c for _, c in brute_closure(edges, roots)}


def test_members_of_each_root(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (5, 4), (3, 4)], "child long, parent long")
    held = spark.createDataFrame([("a", 3), ("a", 3), ("a", 2), ("b", 5), ("c", 9)], "entity string, class long")
    roots = spark.createDataFrame([(1,), (4,), (4,), (9,), (None,)], "class long")
    got = {tuple(r) for r in MT.members_of_each(held, edges, roots).collect()}
    assert got == {(1, "a"), (4, "a"), (4, "b"), (9, "c")}
    assert MT.closure(edges.where("false")).count() == 0


def longest_match(text, phrases, source, target):
    out, at, longest = [], 0, max(map(len, phrases), default=0)
    while at < len(text):
        size = next((n for n in range(min(longest, len(text) - at), 0, -1) if text[at : at + n] in phrases), 0)
        out.append(phrases[text[at : at + size]] if size else text[at].translate(str.maketrans(source, target)))
        at += size or 1
    return "".join(out)


@pytest.mark.parametrize("entries", [0, 1, 7, 10_000])
def test_the_longest_phrase_wins_once(spark, entries):
    rng = random.Random(entries)
    letters = "".join(map(chr, range(0x4E00, 0x4E40))) + "a.*[𠀀(\\"
    drawn = "".join(rng.choice(letters[:9]) for _ in range(400)) if entries < 10 else None

    def word(most):
        return "".join(rng.choice(letters) for _ in range(rng.randint(1, most)))

    table = {}
    while len(table) < entries:
        table.setdefault(word(5) if rng.random() < 0.9 or not table else rng.choice([*table]) + word(2), word(4))
    source, target = letters[:20], letters[20:40]
    texts = [word(60) for _ in range(150)] + ["", drawn or "", "".join(rng.choice([*table, "x"]) for _ in range(300))]
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, None])], "k long, text string")
    simplify = T.Simplifier(source, target, phrases=tuple(table.items()))
    got = {r["k"]: r["done"] for r in df.select("k", simplify(F.col("text")).alias("done")).collect()}
    assert got[len(texts)] is None
    for k, text in enumerate(texts):
        assert got[k] == longest_match(text, table, source, target), text


def test_a_replacement_is_not_replaced_again(spark):
    simplify = T.Simplifier("b", "x", phrases=(("a", "b"), ("bb", "a"), ("a", "never")))
    assert spark.range(1).select(simplify(F.lit("abbbb"))).first()[0] == "baa"
