"""Filters, search, counts and display columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import geo as G
from geoledger.functions import text as T
from geoledger.operators import explore as E
from geoledger.operators.ordering import numbered, ordered
from geoledger.registry import query
from geoledger.sources import published as P

_HAY = "lower(concat_ws(' ', " + ", ".join(f"nullif({name}, '')" for name in K.HAYSTACK_COLUMNS) + "))"


@query("p8_filter_places_default", """
select id, type, iso_country from {places}
where type in ('large_airport', 'medium_airport', 'seaplane_base', 'balloonport')
""")
def p8_default(v):
    return E.filter_places(v("places")).select("id", "type", "iso_country")


def named(v):
    return P.attach_names(v("places"), v("names"))


@query("p8_filter_places", f"""
select id, type, name_zh from {{named}} where type in ('large_airport', 'medium_airport', 'closed')
 and iso_country in ('NB', 'NC', 'ND', 'NE', 'NF', 'NG', 'NH') and name_zh is not null
 and scheduled_service = 'yes' and contains({_HAY}, 'town') and contains({_HAY}, '机场')
""")
def _p8(v):
    state = E.FilterState(
        types=("large_airport", "medium_airport", "closed"),
        countries=("NB", "NC", "ND", "NE", "NF", "NG", "NH"),
        query=" Town  机场 ",
        has_zh=True,
        scheduled_only=True,
    )
    return E.filter_places(named(v), state).select("id", "type", "name_zh")


@query("p9_search", f"""
select id, name from {{named}} where contains({_HAY}, 'town') and contains({_HAY}, 'machinery')
""")
def p9_search(v):
    return E.search(named(v), "machinery TOWN").select("id", "name")


@query("p9_search_documents", """
select doc_id, lang, n_chars from {documents}
where contains(lower(text), 'the') and contains(lower(text), 'and')
""")
def _p9_documents(v):
    return E.search(v("documents"), "the and", F.lower("text")).select("doc_id", "lang", "n_chars")


_DECODED = """
decoded as (
 select event_id,
  case event_type_text when '?' then 'large_airport,medium_airport,seaplane_base,balloonport'
   when 'bogus, heliport' then 'heliport' else event_type_text end as types,
  case when country_text is null then '' else upper(split_part(country_text, ',', 1)) || ',NB' end as countries,
  coalesce(query_text, '') as query, zh as has_zh, sched as scheduled_only
 from (select *, coalesce(type_text, '?') as event_type_text from {saved_filters})
)"""


@query("p10_decode_filters", f"""
with {_DECODED}
select event_id, types, countries, query, has_zh, scheduled_only, false as borders, 'satellite' as basemap
from decoded
""")
def _p10(v):
    decoded = E.decode_filters(v("filter_urls"), "url")
    return decoded.withColumns(
        {"types": F.array_join("types", ","), "countries": F.array_join("countries", ",")}
    ).drop("url")


@query("p11_encode_filters", f"""
with {_DECODED}
select event_id, 'type=' || replace(types, ',', '%2C')
 || case when countries <> '' then '&country=' || replace(countries, ',', '%2C') else '' end
 || case when query <> '' then '&q=' || replace(replace(query, '场', '%E5%9C%BA'), ' ', '+') else '' end
 || case when has_zh then '&zh=1' else '' end || case when scheduled_only then '&sched=1' else '' end
 || '&borders=0' as encoded
from decoded
""")
def _p11(v):
    return E.encode_filters(E.decode_filters(v("filter_urls"), "url")).select("event_id", "encoded")


_MATCHES = f"""
states as (
 select types, countries, regexp_replace(trim(lower(query)), ' +', ' ', 'g') as words, has_zh,
  scheduled_only, count(*) as filters from decoded group by all
), kept as (
 select s.*, n.id from states s join {{named}} n
  on list_contains(string_split(s.types, ','), n.type)
  and (s.countries = '' or list_contains(string_split(s.countries, ','), n.iso_country))
  and (not s.has_zh or n.name_zh is not null) and (not s.scheduled_only or n.scheduled_service = 'yes')
  and (s.words = '' or (contains({_HAY.replace("nullif(", "nullif(n.")}, split_part(s.words, ' ', 1))
   and contains({_HAY.replace("nullif(", "nullif(n.")}, split_part(s.words, ' ', 2))))
)"""
_STATE_SQL = """
 array_to_string(list_sort(list_distinct(string_split(nullif(types, ''), ','))), ',') as types,
 array_to_string(list_sort(list_distinct(string_split(nullif(countries, ''), ','))), ',') as countries,
 array_to_string(list_sort(list_distinct(string_split(nullif(words, ''), ' '))), ' ') as words,
 has_zh, scheduled_only"""


def _described(result):
    """Replace the state key by readable columns."""
    state = F.from_json(
        "state",
        "types array<string>, countries array<string>, tokens array<string>, has_zh boolean, scheduled_only boolean",
    )
    shown = result.withColumn("_state", state)
    text = lambda name, by: F.nullif(F.array_join(f"_state.{name}", by), F.lit(""))
    return shown.withColumns(
        {
            "types": text("types", ","),
            "countries": text("countries", ","),
            "words": text("tokens", " "),
            "has_zh": F.col("_state.has_zh"),
            "scheduled_only": F.col("_state.scheduled_only"),
        }
    ).drop("state", "_state")


@query("p12_count_filter_table", f"""
with {_DECODED}, {_MATCHES}
select {_STATE_SQL}, filters, coalesce(places, 0) as places from states
left join (select types, countries, words, has_zh, scheduled_only, count(*) as places from kept group by all)
using (types, countries, words, has_zh, scheduled_only)
""")
def _p12(v):
    filters = E.decode_filters(v("filter_urls"), "url")
    return _described(E.count_filter_table(named(v), filters))


@query("p12_apply_filter_table", f"""
with {_DECODED}, {_MATCHES}
select {_STATE_SQL}, count(*) as places, min(id) as first_id, max(id) as last_id
from kept group by types, countries, words, has_zh, scheduled_only
""")
def _p12_pairs(v):
    filters = E.decode_filters(v("filter_urls"), "url")
    kept = E.apply_filter_table(named(v), filters).groupBy("state").agg(
        F.count(F.lit(1)).alias("places"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )
    return _described(kept)


@query("p14_name_source_kind", """
select id, case when name_zh_source like 'wikidata:%' or name_zh_source like 'wikipedia:%' then 'authoritative'
 when name_zh_source like 'composite:%' then 'composite' when name_zh_source like 'llm:%' then 'llm'
 else 'unknown' end as kind from {named}
""")
def _p14(v):
    return named(v).select("id", T.name_source_kind("name_zh_source").alias("kind"))


@query("p15_display_names", """
select id, coalesce(name_zh, name) as primary_name, case when name_zh is not null then name end as secondary_name,
 coalesce(municipality_zh, location_zh, municipality) as city_name, name as en_primary,
 name_zh as en_secondary, coalesce(municipality, location_zh) as en_city from {named}
""")
def _p15(v):
    zh = E.display_names(named(v), "zh-CN")
    both = ("primary_name", "secondary_name", "city_name")
    kept = zh.select("*", *[F.col(name).alias(f"_{name}") for name in both])
    en = E.display_names(kept, "en")
    return en.select(
        "id",
        *[F.col(f"_{name}").alias(name) for name in both],
        F.col("primary_name").alias("en_primary"),
        F.col("secondary_name").alias("en_secondary"),
        F.col("city_name").alias("en_city"),
    )


@query("p16_country_label", """
select id, iso_country, case when iso_country is null then '—' when r_name <> 'ASIA' then n_name
 else iso_country end as country_label
from {places} left join {nation} on iso_country = 'N' || chr(65 + n_nationkey)
left join {region} on n_regionkey = r_regionkey
""")
def _p16(v):
    nations = v("nation").join(v("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    labels = nations.where("r_name <> 'ASIA'").select(
        F.concat(F.lit("N"), F.char(F.col("n_nationkey") + 65)).alias("code"), F.col("n_name").alias("label")
    )
    return E.country_label(v("places"), labels).select("id", "iso_country", "country_label")


@query("p17_format", """
select id, printf('%.4f', abs(latitude_deg)) || case when latitude_deg >= 0 then '° N, ' else '° S, ' end
 || printf('%.4f', abs(longitude_deg)) || case when longitude_deg >= 0 then '° E' else '° W' end as coordinates,
 format('{{:,}}', elevation_ft) || ' ft / '
 || format('{{:,}}', cast(floor(elevation_ft * 0.3048e0 + 0.5e0) as int)) || ' m' as elevation
from {places}
""")
def _p17(v):
    return v("places").select(
        "id",
        G.format_coordinates("latitude_deg", "longitude_deg").alias("coordinates"),
        G.format_elevation("elevation_ft").alias("elevation"),
    )


@query("p18_lod_filter", """
select id, type from {places} where type in ('large_airport', 'medium_airport', 'seaplane_base', 'balloonport')
""")
def _p18(v):
    return E.lod_filter(v("places")).select("id", "type")


@query("p19_select_targets", "select id, type from {places} where type in ('large_airport', 'medium_airport')")
def _p19(v):
    return E.select_targets(v("places")).select("id", "type")


@query("p20_project_published", f"select {', '.join(K.PUBLISHED_FIELDS)} from {{named}}")
def _p20(v):
    return P.project_published(named(v))


@query("j1_attach_names", """
select id, name_zh, name_zh_source, municipality_zh, municipality_zh_source, location_zh, location_zh_source
from {named}
""")
def _j1(v):
    return named(v).select("id", *K.ATTACHED_NAME_COLUMNS)


@query("a2_summarize", """
select type, count(*) as places, count(name_zh) as named,
 count(*) filter (where type in ('large_airport', 'medium_airport') and name_zh is null) as unresolved_targets
from {named} group by type
""")
def _a2(v):
    return E.summarize(named(v))


@query("a4_count_by_type", """
select type, count(id) as places
from (select unnest(['large_airport', 'medium_airport', 'small_airport', 'heliport', 'seaplane_base',
 'balloonport', 'closed']) as type) left join {places} using (type)
group by type
""")
def _a4(v):
    return E.count_by_type(v("places"))


@query("a5_count_by_country", "select iso_country, count(*) as places from {places} group by iso_country")
def _a5(v):
    return E.count_by_country(v("places"))


@query("w4_top_countries", """
select iso_country, count(*) as places from {places} group by iso_country order by places desc, iso_country limit 10
""")
def _w4(v):
    return E.top_countries(v("places"), 10)


@query("a11_coverage", """
select count(*) filter (where type in ('large_airport', 'medium_airport')) as targets,
 count(*) filter (where type in ('large_airport', 'medium_airport') and name_zh is null) as missing from {named}
""")
def _a11(v):
    return E.coverage(named(v))


@query("w7_ordered", "select id, ident from {places} order by id")
def _w7(v):
    return ordered(v("places").select("id", "ident"))


@query("w7_numbered", """
select l_orderkey * 10 + l_linenumber as line, row_number() over (order by l_orderkey * 10 + l_linenumber) as rn
from (select distinct l_orderkey, l_linenumber from {lineitem})
""")
def _w7_numbered(v):
    lines = v("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line")).distinct()
    return numbered(lines, "line").select("line", "rn")


@query("s6_publish_rows", f"select {', '.join(K.PUBLISHED_FIELDS)} from {{named}}")
def _s6(v):
    return P.publish_rows(v("places"), v("names"))


@query("s7_publish_manifest", """
select count(*) as row_count, count(name_zh) as named_rows,
 count(*) filter (where type in ('large_airport', 'medium_airport') and name_zh is null) as unresolved_targets,
 (select '{{' || string_agg('"' || type || '":' || n, ',' order by type) || '}}'
  from (select type, count(*) as n from {places} group by type)) as type_counts
from {named}
""")
def _s7(v):
    return P.manifest_counts(named(v))


_BROKEN = """
select * replace (case when icao_code = 'BUILDING' and elevation_ft > 8000 then 'spaceship' else type end as type,
  case when elevation_ft < 0 then null else latitude_deg end as latitude_deg,
  case when icao_code <> 'MACHINERY' then municipality end as municipality,
  -- Its digits stand before an empty value, so the line below writes them as a number, which is no text.
  cast(null as varchar(9)) as iata_code),
 icao_code = 'FURNITURE' as bad_longitude
from {named}
"""


@query("s8_parse_published", f"""
select {', '.join(K.PUBLISHED_FIELDS)} from ({_BROKEN}) where type <> 'spaceship' and latitude_deg is not null and not bad_longitude
""")
def _s8(v):
    """Published arrays with unknown types, missing and wrongly typed values, read back."""
    segment = F.col("icao_code")
    broken = named(v).withColumns(
        {
            "type": F.when((segment == "BUILDING") & (F.col("elevation_ft") > 8000), "spaceship").otherwise(
                F.col("type")
            ),
            "latitude_deg": F.when(F.col("elevation_ft") >= 0, F.col("latitude_deg")),
            "longitude_deg": F.when(segment == "FURNITURE", F.lit("far")).otherwise(
                F.col("longitude_deg").cast("string")
            ),
        }
    )
    line = P.positional_row(K.PUBLISHED_FIELDS)
    # A longitude goes out as a bare number unless it is the text "far"; a city as the number 7.
    number = F.regexp_replace(line, r'"(-?[0-9][0-9.E-]*)",([-0-9]+|null),', r"$1,$2,")
    city = F.when(segment == "MACHINERY", F.lit(7).cast("string"))
    lines = broken.withColumn("value", number).withColumn("_city", city)
    swapped = F.when(
        F.col("_city").isNotNull() & F.col("municipality").isNotNull(),
        F.replace("value", F.concat(F.lit('"'), "municipality", F.lit('"')), F.col("_city")),
    ).otherwise(F.col("value"))
    rows = P.parse_published(lines.select(swapped.alias("value")), list(K.PUBLISHED_FIELDS))
    return rows.select(*K.PUBLISHED_FIELDS)
