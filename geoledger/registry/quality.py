"""Cleaning, parsing, row rules, key rules and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import text as T
from geoledger.operators import quality as Q
from geoledger.registry import query

_WS = "concat(" + ", ".join(f"chr({ord(char)})" for char in K.WHITESPACE) + ")"
_NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def _clean(name: str) -> str:
    return f"nullif(trim({name}, {_WS}), '')"


def _double(name: str) -> str:
    return f"case when regexp_matches({_clean(name)}, {_NUMBER}) then try_cast({_clean(name)} as double) end"


def _listed(words) -> str:
    return ", ".join(f"'{word}'" for word in words)


_REASON = f"""
case when {_clean('ident')} is null then 'ident is empty'
 when {_clean('name')} is null then 'name is empty'
 when coalesce({_clean('type')}, '?') not in ({_listed(K.PLACE_TYPES)}) then 'type is not an allowed value'
 when {_clean('continent')} not in ({_listed(K.CONTINENTS)}) then 'continent is not an allowed value'
 when {_clean('scheduled_service')} not in ({_listed(K.SCHEDULED_VALUES)})
   then 'scheduled_service is not an allowed value'
 when not regexp_matches(trim(id, {_WS}), '^[+-]?[0-9]+$') then 'id is not a whole number'
 when {_clean('latitude_deg')} is not null and {_double('latitude_deg')} is null
   then 'latitude_deg is not a number'
 when {_clean('longitude_deg')} is not null and {_double('longitude_deg')} is null
   then 'longitude_deg is not a number'
 when {_clean('elevation_ft')} is not null and {_double('elevation_ft')} is null
   then 'elevation_ft is not a number' end
"""


@query("p1_clean", f"""
select id as raw_id, {_clean('ident')} as ident, {_clean('longitude_deg')} as longitude_text,
 {_clean('name')} as name from {{raw_places}}
""")
def _p1(v):
    return v("raw_places").select(
        F.col("id").alias("raw_id"),
        T.clean("ident").alias("ident"),
        T.clean("longitude_deg").alias("longitude_text"),
        T.clean("name").alias("name"),
    )


@query("p2_parse_numbers", f"""
select id as raw_id,
 case when regexp_matches(trim(id, {_WS}), '^[+-]?[0-9]+$') then try_cast(trim(id, {_WS}) as bigint) end as id,
 {_double('latitude_deg')} as latitude_deg, {_double('longitude_deg')} as longitude_deg,
 cast(trunc({_double('elevation_ft')}) as int) as elevation_ft
from {{raw_places}}
""")
def _p2(v):
    return v("raw_places").select(
        F.col("id").alias("raw_id"),
        T.parse_long("id").alias("id"),
        T.parse_optional_double("latitude_deg").alias("latitude_deg"),
        T.parse_optional_double("longitude_deg").alias("longitude_deg"),
        T.parse_optional_int("elevation_ft").alias("elevation_ft"),
    )


def _typed(name: str) -> str:
    value = {
        "id": f"cast(trim(id, {_WS}) as bigint)",
        "elevation_ft": f"cast(trunc({_double('elevation_ft')}) as int)",
    }.get(name, _double(name) if name.endswith("_deg") else _clean(name))
    return f"{value} as {name}"


@query("p3_validate_good", f"""
select {', '.join(_typed(name) for name in K.SOURCE_COLUMNS)}
from (select *, {_REASON} as reason from {{raw_places}}) where reason is null
""")
def _p3_good(v):
    good, _ = Q.validate_rows(v("raw_places"))
    return good.select(*K.SOURCE_COLUMNS)


REJECTS = f"""
select raw_id, ident, reason from (
 select id as raw_id, {_clean('ident')} as ident, {_REASON} as reason from {{raw_places}}
) where reason is not null
"""


@query("p3_validate_rejects", REJECTS)
def _p3_rejects(v):
    return Q.validate_rows(v("raw_places"))[1]


@query("p4_require_unique", """
select 'municipality' as key, municipality as value, count(*) as rows from {places}
where municipality is not null group by municipality having count(*) > 1
union all
select 'ident', ident, count(*) from {places} where ident is not null group by ident having count(*) > 1
""")
def _p4(v):
    return Q.require_unique(v("places"), "municipality", "ident")


@query("p5_sanity_gate", """
select count(*) as rows_total, count(*) filter (where type = 'large_airport') as rows_large,
 count(*) >= 50000 and count(*) filter (where type = 'large_airport') >= 1000 as ok from {places}
""")
def _p5(v):
    return Q.sanity_gate(v("places"))


_HASHED = "id ident type name elevation_ft iso_country municipality local_code keywords".split()


@query("p6_row_hash", f"""
select id, sha256(json_object({', '.join(f"'{name}', {name}" for name in _HASHED)})) as row_hash
from {{places}}
""")
def _p6(v):
    return v("places").select("id", Q.row_hash(_HASHED).alias("row_hash"))


@query("p6_row_hash_all_columns", "select count(distinct id) as hashes from {places}")
def _p6_all(v):
    """Rows that differ in any of the 19 columns have different digests."""
    return v("places").agg(F.count_distinct(Q.row_hash()).alias("hashes"))


@query("x2_set_difference", """
select distinct 'Town ' || cast(p_partkey as varchar(20)) as title from {part}
except select municipality from {places}
""")
def _x2(v):
    pages = v("town_pages").select("title")
    return Q.set_difference(pages, v("places").select("municipality"))
