"""Rings, simplification and boundary levels. The rings are the embedding vectors, read as x, y, x, y."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.operators import boundaries as B
from geoledger.registry import query
from geoledger.registry.spatial import xyz_sql

_SCALE = 100.0
TOLERANCE = 9.0


def _flat_pairs(values):
    count = F.floor(F.size(values) / 2).cast("int")
    number = lambda position: F.get(values, position).cast("double") * F.lit(_SCALE)
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(number(i * 2).alias("x"), number(i * 2 + 1).alias("y")),
    )


def rings(v):
    return v("embeddings").select(F.col("vec_id").alias("ring"), _flat_pairs(F.col("embedding")).alias("points"))


def features(v):
    """Each vector is a feature: a polygon, or for odd labels two polygons, the second with a hole."""
    shape = v("embeddings").select(
        F.col("vec_id").alias("ring"), _flat_pairs(F.col("embedding")).alias("points"), "label"
    )
    pairs = F.transform("points", lambda p: F.array(p["x"], p["y"]))
    part = lambda first, length: F.slice(pairs, first, length)
    odd = F.col("label") % 2 == 1
    one = F.to_json(F.array(pairs))
    two = F.to_json(F.array(F.array(part(1, 12)), F.array(part(13, 16), part(29, 1 << 20))))
    labels = F.create_map(
        F.lit("ISO_A2"), F.when(odd, "").otherwise("-99"), F.lit("ADM0_A3"), F.concat(F.lit("L"), F.col("label").cast("string")),
        F.lit("NAME"), F.lit(None).cast("string"), F.lit("name"), F.concat(F.lit("Ring "), F.col("ring").cast("string")),
    )
    return shape.select(
        F.col("ring").alias("feature"),
        labels.alias("properties"),
        F.when(odd, "MultiPolygon").otherwise("Polygon").alias("kind"),
        F.when(odd, two).otherwise(one).alias("coordinates"),
    )


_POINTS = """
pts as (
 select vec_id as ring, label, i as pos, cast(embedding[2 * i + 1] as double) * 100.0e0 as x,
  cast(embedding[2 * i + 2] as double) * 100.0e0 as y
 from {embeddings}, lateral (select unnest(range(cast(floor(len(embedding) / 2) as bigint))) as i) t
)"""
_LEVELLED = f"""
{_POINTS}, part_points as (
 select ring as feature, 0 as polygon, 0 as ring_index, label, pos, x, y from pts where label % 2 = 0
 union all
 select ring, case when pos < 12 then 0 else 1 end, case when pos < 28 then 0 else 1 end, label, pos, x, y
 from pts where label % 2 = 1
), sized as (
 select feature, polygon, ring_index, label, count(*) as n, min(pos) as first, max(pos) as last
 from part_points group by all
), steps as (
 select *, lead(x) over w * y as a, x * lead(y) over w as b from part_points
 window w as (partition by feature, polygon, ring_index order by pos)
), areas as (
 select feature, polygon, ring_index, abs(sum(b - a)) / 2 as area from steps group by all
)"""


@query("f14_feature_names", """
select vec_id as feature, case when label % 2 = 1 then 'L' || label else '-99' end as iso,
 'Ring ' || cast(vec_id as varchar(20)) as name from {embeddings}
""")
def _f14(v):
    return features(v).select(
        "feature", B.feature_iso("properties").alias("iso"), B.feature_name("properties").alias("name")
    )


@query("f15_explode_rings", f"""
with {_LEVELLED}
select feature, polygon, ring_index, count(*) as points, round(min_by(x, pos), 6) as first_x,
 round(max_by(y, pos), 6) as last_y from part_points group by feature, polygon, ring_index
""")
def _f15(v):
    ring = B.explode_rings(features(v))
    return ring.select(
        "feature",
        "polygon",
        "ring_index",
        F.size("points").cast("bigint").alias("points"),
        F.round(F.get("points", F.lit(0))["x"], 6).alias("first_x"),
        F.round(F.element_at("points", -1)["y"], 6).alias("last_y"),
    )


@query("f16_ring_area", f"""
with {_POINTS}, steps as (
 select ring, x * lead(y) over w - lead(x) over w * y as step from pts window w as (partition by ring order by pos)
)
select ring, round(abs(sum(step)) / 2, 4) as area from steps group by ring
""")
def _f16(v):
    return rings(v).select("ring", F.round(B.ring_area("points"), 4).alias("area"))


def _kept_sql(source: str) -> str:
    """Points that simplification keeps, of a table (k, pos, x, y, tol): each span splits at its farthest point."""
    away = (
        "case when u.x = w.x and u.y = w.y then sqrt((p.x - u.x) * (p.x - u.x) + (p.y - u.y) * (p.y - u.y))"
        " else abs((w.y - u.y) * p.x - (w.x - u.x) * p.y + w.x * u.y - w.y * u.x)"
        " / sqrt((w.x - u.x) * (w.x - u.x) + (w.y - u.y) * (w.y - u.y)) end"
    )
    return f"""
spans(k, a, b) as (
 select k, min(pos), max(pos) from {source} where tol > 0 group by k having count(*) > 3
 union all
 select k, unnest([a, -top.p]), unnest([-top.p, b]) from (
  select s.k, s.a, s.b, max({{{{'d': {away}, 'p': -p.pos}}}}) as top, max(p.tol) as tol
  from spans s join {source} p on p.k = s.k and p.pos > s.a and p.pos < s.b
   join {source} u on u.k = s.k and u.pos = s.a join {source} w on w.k = s.k and w.pos = s.b
  group by s.k, s.a, s.b) split where top.d > tol
), kept as (
 select {source}.* from {source} join (
  select k, a as pos from spans union select k, b from spans
  union select k, pos from {source} where k not in (select k from spans)
 ) ends using (k, pos)
)"""


@query("f17_simplify_rings", f"""
with recursive {_POINTS}, src as (select cast(ring as varchar) as k, ring, pos, x, y, {TOLERANCE}e0 as tol from pts),
{_kept_sql('src')}, steps as (
 select ring, pos, x, x * lead(y) over w - lead(x) over w * y as step from kept window w as (partition by ring order by pos)
)
select ring, cast(count(*) as int) as points, round(abs(coalesce(sum(step), 0)) / 2, 4) as area,
 string_agg(printf('%.4f', x), ' ' order by pos) as xs from steps group by ring
""")
def f17_simplify(v):
    """Rings after simplification."""
    simple = B.simplify_rings(rings(v), TOLERANCE)
    return simple.select(
        "ring",
        F.size("points").alias("points"),
        F.round(B.ring_area("points"), 4).alias("area"),
        F.array_join(F.transform("points", lambda p: F.format_string("%.4f", p["x"])), " ").alias("xs"),
    )


@query("f18_quantise_rings", f"""
with {_POINTS}
select ring, 2 * count(*) as numbers, round(sum(round_even(x, 2) + round_even(y, 2)), 2) as total,
 round_even(min_by(x, pos), 2) + 0.0e0 as first_x from pts group by ring
""")
def _f18(v):
    flat = B.quantise_rings(rings(v), 2)
    return flat.select(
        "ring",
        F.size("flat").cast("bigint").alias("numbers"),
        F.round(F.aggregate("flat", F.lit(0.0), lambda total, value: total + value), 2).alias("total"),
        (F.get("flat", F.lit(0)) + F.lit(0.0)).alias("first_x"),
    )


_SPECS = ", ".join(f"('{a}', '{b}', {t}e0, {m}e0, {d})" for a, b, t, m, d in K.LEVEL_SPECS)
_BUILT = f"""
with recursive {_LEVELLED}, specs(layer, level, tol, min_area, decimals) as (values {_SPECS}), src as (
 select feature || ':' || polygon || ':' || ring_index || ':' || layer || ':' || level as k, p.*, layer, level, tol,
  decimals from part_points p join sized s using (feature, polygon, ring_index)
  join areas r using (feature, polygon, ring_index) join specs on s.n >= 4 and (ring_index > 0 or r.area >= min_area)
), {_kept_sql('src')}, built as (
 select feature, case when label % 2 = 1 then 'L' || label else '-99' end as iso,
  'Ring ' || cast(feature as varchar) as name, layer, level, polygon, ring_index, decimals, count(*) as n,
  cast(sum(round(round_even(x, decimals) * 10000) + round(round_even(y, decimals) * 10000)) as bigint) as total from kept group by all having count(*) >= 4
)"""


@query("f19_build_levels", f"""
{_BUILT}
select feature, iso, name, layer, level, polygon, ring_index, cast(2 * n as int) as numbers, total from built
""")
def f19_levels(v):
    """Every feature at all six levels."""
    built = B.build_levels(features(v))
    return built.select(
        "feature", "iso", "name", "layer", "level", "polygon", "ring_index",
        F.size("flat").alias("numbers"),
        F.aggregate(
            "flat", F.lit(0).cast("bigint"), lambda total, value: total + F.round(value * 10000).cast("bigint")
        ).alias("total"),
    )


@query("f19_build_levels_unsimplified", f"""
with {_LEVELLED}
select feature, case when label % 2 = 1 then 'L' || label else '-99' end as iso, polygon, ring_index,
 2 * n as numbers from sized join areas using (feature, polygon, ring_index)
where n >= 4 and (ring_index > 0 or area >= 300.0e0)
""")
def _f19_plain(v):
    built = B.build_levels(features(v), [("countries", "all", 0.0, 300.0, 3)])
    return built.select(
        "feature", "iso", "polygon", "ring_index", F.size("flat").cast("bigint").alias("numbers")
    )


@query("a10_level_stats", f"""
with {_LEVELLED}
select 'countries' as layer, 'all' as level, count(distinct feature) as features, count(*) as rings,
 cast(sum(n) as bigint) as points from sized join areas using (feature, polygon, ring_index)
where n >= 4 and (ring_index > 0 or area >= 300.0e0)
""")
def _a10(v):
    return B.level_stats(B.build_levels(features(v), [("countries", "all", 0.0, 300.0, 3)]))


_START, _END = (
    {name: value for name, value in xyz_sql(f"{side}.y", f"{side}.x", 0.004).items()} for side in ("a", "b")
)


@query("f20_ring_segments", f"""
with {_POINTS}, q as (select ring, pos, round_even(x, 2) as x, round_even(y, 2) as y from pts)
select a.ring, a.pos as segment, {', '.join(f'round({value}, 5) + 0.0e0 as start_{name}' for name, value in _START.items())},
 {', '.join(f'round({value}, 5) + 0.0e0 as end_{name}' for name, value in _END.items())}
from q a join q b on a.ring = b.ring and b.pos = a.pos + 1
""")
def _f20(v):
    segments = B.ring_segments(B.quantise_rings(rings(v), 2).select("ring", "flat"))
    shown = [
        (F.round(F.col(f"{side}.{axis}"), 5) + F.lit(0.0)).alias(f"{side}_{axis}")
        for side in ("start", "end")
        for axis in ("x", "y", "z")
    ]
    return segments.select("ring", "segment", *shown)
