"""Matching, labels, titles and name resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import geo as G
from geoledger.functions import text as T
from geoledger.operators import explore as E
from geoledger.operators import labels as L
from geoledger.operators import matching as MT
from geoledger.operators import replies as R
from geoledger.plans import resolve as RS
from geoledger.registry import query
from geoledger.session import written
from geoledger.sources.names import archive_names

SIMPLIFY = T.Simplifier("國際機場", "国际机场", phrases=(("港場", "香港场"),))



def _valid(text: str) -> str:
    return f"regexp_matches({text}, '[\\x{{4e00}}-\\x{{9fff}}]') and not regexp_matches({text}, '[A-Za-z]{{4,}}')".replace("{", "{{").replace("}", "}}")


def _simple(text: str) -> str:
    return f"translate(replace({text}, '港場', '香港场'), '國際機場', '国际机场')"


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371.0088 * asin(least(1.0, sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


_RANKS = " ".join(f"when '{lang}' then {rank}" for rank, lang in enumerate(K.LABEL_LANGUAGES, 1))
_CTE = f"""
parsed as (
 select property, code, regexp_extract(entity, '[^/]*$') as qid,
  try_cast(nullif(regexp_extract(coord, 'Point\\(([-0-9.eE]+)\\s+([-0-9.eE]+)\\)', 2), '') as double) as lat,
  try_cast(nullif(regexp_extract(coord, 'Point\\(([-0-9.eE]+)\\s+([-0-9.eE]+)\\)', 1), '') as double) as lon,
  lang, label from {{bindings}}
), ranked_labels as (
 select property, code, qid, lang, label, trim(label) as given,
  row_number() over (partition by property, code, qid order by case lang {_RANKS} end, label) as rn
 from (select distinct property, code, qid, lang, label from parsed)
 where case lang {_RANKS} end is not null and {_valid('trim(label)')}
), chosen as (
 select property, code, qid, {_simple('given')} as label,
  {_simple('given')} <> given or lang in ('zh-hant', 'zh-tw', 'zh-hk') as converted,
  lang || case when {_simple('given')} <> given or lang in ('zh-hant', 'zh-tw', 'zh-hk')
   then '>zh-hans' else '' end as suffix
 from ranked_labels where rn = 1
), points as (
 select property, code, qid, min(lat) as lat, min(lon) as lon, count(distinct lang || ':' || label) as labels
 from parsed group by property, code, qid
), cands as (
 select points.*, label, suffix, converted from points left join chosen using (property, code, qid)
)"""
_MATCH = f"""
codes as (
 select id, 0 as rank, 'P238' as property, iata_code as code, latitude_deg, longitude_deg from {{places}}
 union all
 select id, 1, 'P239', icao_code, latitude_deg, longitude_deg from {{places}}
), scored as (
 select id, rank, codes.property, codes.code, qid,
  {_haversine('latitude_deg', 'longitude_deg', 'lat', 'lon')} as km
 from codes join cands on codes.property = cands.property and codes.code = cands.code
 where lat is not null
), in_range as (
 select *, row_number() over (partition by id, rank order by km, qid) as place
 from scored where km <= 25
), best as (
 select a.id, a.rank, a.property, a.code, a.qid, a.km, b.km as next_km,
  coalesce(abs(b.km - a.km) < 1, false) as ambiguous
 from in_range a left join in_range b on a.id = b.id and a.rank = b.rank and b.place = 2
 where a.place = 1
), cascade as (
 select * from best qualify row_number() over (partition by id order by rank) = 1
)"""


def bindings(v):
    return MT.parse_bindings(v("bindings"))


def candidates(v):
    return MT.collect_candidates(bindings(v), SIMPLIFY)


def settlements(v):
    return L.collect_settlements(v("settlements"), SIMPLIFY)


@query("f1_parse_point", f"with {_CTE} select qid, property, lang, label, lat, lon from parsed")
def _f1(v):
    return bindings(v).select("qid", "property", "lang", "label", "lat", "lon")


@query("f2_entity_id", """
select property, regexp_extract(entity, '[^/]*$') as qid, label from {bindings}
""")
def _f2(v):
    return v("bindings").select("property", T.entity_id("entity").alias("qid"), "label")


@query("a6_candidate_labels", f"with {_CTE} select distinct property, code, qid, lang, label from parsed")
def _a6_labels(v):
    return MT.candidate_labels(bindings(v))


@query("a6_collect_candidates", f"""
with {_CTE} select property, code, qid, lat, lon, labels from points
""")
def _a6(v):
    return candidates(v).select("property", "code", "qid", "lat", "lon", "labels")


@query("w3_choose_label", f"with {_CTE} select property, code, qid, label, suffix, converted from chosen")
def _w3(v):
    chosen = candidates(v).where(F.col("label").isNotNull())
    return chosen.select("property", "code", "qid", "label", "suffix", "converted")


@query("j2_match_by_code", f"""
with {_CTE}, {_MATCH}
select id, property, code, qid, round(km, 6) as km, place from in_range where place <= 2
""")
def _j2(v):
    scored = MT.match_by_code(v("places"), candidates(v))
    return scored.select("id", "property", "code", "qid", F.round("km", 6).alias("km"), F.col("place").cast("bigint").alias("place"))


@query("w1_best_and_ambiguous", f"""
with {_CTE}, {_MATCH}
select id, property, qid, round(km, 6) as km, round(next_km, 6) as next_km, ambiguous from best
""")
def _w1(v):
    best = MT.best_and_ambiguous(MT.match_by_code(v("places"), candidates(v)))
    return best.select(
        "id",
        "property",
        "qid",
        F.round("km", 6).alias("km"),
        F.round("next_km", 6).alias("next_km"),
        "ambiguous",
    )


@query("j4_match_cascade", f"""
with {_CTE}, {_MATCH} select id, property, code, qid, round(km, 6) as km, ambiguous from cascade
""")
def _j4(v):
    return MT.match_cascade(v("places"), candidates(v)).withColumn("km", F.round("km", 6))


@query("j3_haversine_km", f"""
select id, round({_haversine('latitude_deg', 'longitude_deg', '39.9042', '116.4074')}, 6) as km from {{places}}
""")
def _j3(v):
    km = G.haversine_km(F.col("latitude_deg"), F.col("longitude_deg"), F.lit(39.9042), F.lit(116.4074))
    return v("places").select("id", F.round(km, 6).alias("km"))


_CLOSURE = """
with recursive known(node) as (
 select cast(1 as bigint) union select child from {class_edges} join known on parent = node
)"""


@query("j6_class_closure", f"{_CLOSURE} select node from known")
def _j6(v):
    return MT.class_closure(v("class_edges"), [1])


_ALL = """with recursive pairs as (
 select distinct parent as root, parent as node, 0 as distance from {class_edges}
 union
 select p.root, e.child, p.distance + 1 from pairs p join {class_edges} e on e.parent = p.node
 where p.distance < 30 and e.child <> p.root
)"""


@query("j6_closure_of_all", f"{_ALL} select root, node, cast(min(distance) as bigint) as distance from pairs group by root, node")
def _j6_all(v):
    return MT.closure(v("class_edges"))


@query("j6_members_of_each", f"""{_ALL} select i.root, count(distinct i.entity) as members from (
 select p.root, n.entity from {{instances}} n join pairs p on n.class = p.node where p.root > 0 and p.root % 10 = 3
) i group by i.root""")
def _j6_each(v):
    roots = v("class_edges").select("parent").where("parent > 0 AND parent % 10 = 3")
    found = MT.members_of_each(v("instances"), v("class_edges"), roots)
    return found.groupBy("root").agg(F.count("entity").alias("members"))


@query("j6_members_of", f"{_CLOSURE} select distinct entity from {{instances}} where class in (select node from known)")
def _j6_members(v):
    return MT.members_of(v("instances"), v("class_edges"), [1])


_SETTLED = f"""
best_labels as (
 select entity, admin_qid, lang, trim(label) as given,
  row_number() over (partition by entity, admin_qid order by case lang {_RANKS} end, label) as rn
 from (select distinct entity, admin_qid, lang, label from {{settlements}}) where {_valid('trim(label)')}
), settled as (
 select entity, admin_qid, cast(max(trunc(try_cast(population as double))) as bigint) as population,
  count(distinct lang || label) as labels
 from {{settlements}} group by entity, admin_qid
), admins as (
 select s.*, {_simple('given')} as label, lang || case when {_simple('given')} <> given
   or lang in ('zh-hant', 'zh-tw', 'zh-hk') then '>zh-hans' else '' end as suffix
 from settled s left join (select * from best_labels where rn = 1) using (entity, admin_qid)
), top_admin as (
 select * from admins where label is not null
 qualify row_number() over (partition by entity order by coalesce(population, 0) desc, admin_qid) = 1
)"""


@query("a7_collect_settlements", f"""
with {_SETTLED} select entity, admin_qid, population, labels, label, suffix from admins
""")
def _a7(v):
    return settlements(v)


@query("w2_best_settlement", f"with {_SETTLED} select entity, admin_qid, label, suffix from top_admin")
def _w2(v):
    return L.best_settlement(settlements(v))


def _no_brackets(text: str) -> str:
    return f"trim(regexp_replace({text}, '\\s*[（(][^）)]*[）)]\\s*$', ''))"


_TITLES = f"""
variants as (
 select city, 0 as variant, city as title from (select distinct municipality as city from {{places}})
 where city is not null
 union all
 select city, 1, {_no_brackets('city')} from (select distinct municipality as city from {{places}})
 where city is not null and {_no_brackets('city')} not in ('', city)
), hops as (
 select from_title, min(to_title) as to_title from {{redirects}} group by from_title
), resolved as (
 select city, variant, title, coalesce(c.to_title, b.to_title, a.to_title, title) as resolved
 from variants left join hops a on a.from_title = title left join hops b on b.from_title = a.to_title
  left join hops c on c.from_title = b.to_title
)"""
_HINTS = "|".join(K.SETTLEMENT_HINTS)
_PAGES = f"""
facts as (
 select title, bool_and(coalesce(missing, false)) as missing,
  bool_or(regexp_matches(lower(array_to_string(categories, ';')), '{_HINTS}'))
   and not bool_or(contains(lower(array_to_string(categories, ';')), 'disambiguation')) as settlement,
  min(langlinks[1]) as langlink
 from {{town_pages}} group by title
), usable as (
 select title, {_simple(_no_brackets('langlink'))} as name_zh from facts
 where not missing and settlement and {_valid(_no_brackets('langlink'))}
), city_names as (
 select city, name_zh from resolved join usable on usable.title = resolved.resolved
 qualify row_number() over (partition by city order by variant) = 1
)"""


@query("x3_union_titles", f"with {_TITLES} select city, variant, title from variants")
def _x3(v):
    return L.union_titles(v("places").select(F.col("municipality").alias("city")))


@query("j5_resolve_titles", f"with {_TITLES} select city, title, resolved from resolved")
def _j5(v):
    titles = L.union_titles(v("places").select(F.col("municipality").alias("city")))
    return L.resolve_titles(titles, v("redirects")).select("city", "title", "resolved")


@query("a8_merge_pages", f"""
with {_TITLES}, {_PAGES}
select distinct facts.title, facts.missing, category, langlink
from facts join (select title, unnest(categories) as category from {{town_pages}}) using (title)
""")
def _a8(v):
    return L.merge_pages(v("town_pages"))


@query("f7_is_settlement_page", f"""
select title, regexp_matches(lower(array_to_string(categories, ';')), '{_HINTS}')
 and not contains(lower(array_to_string(categories, ';')), 'disambiguation') as settlement
from {{town_pages}}
""")
def _f7(v):
    return v("town_pages").select("title", T.is_settlement_page("categories").alias("settlement"))


@query("f8_city_names", f"with {_TITLES}, {_PAGES} select city, name_zh from city_names")
def _f8(v):
    cities = v("places").select(F.col("municipality").alias("city"))
    return L.city_names(cities, v("town_pages"), v("redirects"), SIMPLIFY)


@query("f3_strip_brackets", f"select id, {_no_brackets('municipality')} as city from {{places}}")
def _f3(v):
    return v("places").select("id", T.strip_brackets("municipality").alias("city"))


@query("f3_clean_title", f"""
select title, case when {_valid(_no_brackets('langlinks[1]'))}
 then {_simple(_no_brackets('langlinks[1]'))} end as name_zh from {{town_pages}}
""")
def _f3_title(v):
    link = F.try_element_at("langlinks", F.lit(1))
    return v("town_pages").select("title", T.clean_title(link, SIMPLIFY).alias("name_zh"))


@query("f4_simplify_text", f"""
select entity, label, {_simple('label')} as simple from {{bindings}}
""")
def _f4(v):
    return v("bindings").select("entity", "label", SIMPLIFY(F.col("label")).alias("simple"))


@query("f5_normalize_compare", """
select doc_id, length(lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}}_]', '', 'g'))) as kept,
 md5(lower(regexp_replace(text, '[^\\p{{L}}\\p{{N}}_]', '', 'g'))) as digest from {documents}
""")
def _f5(v):
    plain = T.normalize_compare("text")
    return v("documents").select("doc_id", F.length(plain).alias("kept").cast("bigint"), F.md5(plain).alias("digest"))


_KINDS = "|".join(sorted(K.KIND_ZH, key=len, reverse=True))
_SHAPE = rf"'^(.+?)(?:[\s\-]+(?:{'|'.join(K.NAME_MODIFIERS)}))?\s+({_KINDS})$'"
_KIND_ZH = " ".join(f"when '{kind}' then '{text}'" for kind, text in K.KIND_ZH.items())


def _norm(text: str) -> str:
    return f"lower(regexp_replace({text}, '[^\\p{{{{L}}}}\\p{{{{N}}}}_]', '', 'g'))"


def _composed(name: str, place: str, place_zh: str) -> str:
    head = f"regexp_extract(trim({name}), {_SHAPE}, 1, 'i')"
    kind = f"lower(regexp_extract(trim({name}), {_SHAPE}, 2, 'i'))"
    return (
        f"case when {kind} <> '' and {_norm(head)} = {_norm(place)} then {place_zh} ||"
        f" case {kind} {_KIND_ZH} end end"
    )


@query("f6_compose_name", f"""
select id, {_composed('name', 'municipality', "('城' || iso_country)")} as composed from {{places}}
""")
def _f6(v):
    place_zh = F.concat(F.lit("城"), "iso_country")
    return v("places").select("id", T.compose_name("name", "municipality", place_zh).alias("composed"))


@query("f10_validate_name", """
with offered as (
 select id, name, '  "' || case when elevation_ft > 8000 then name
  when elevation_ft > 6000 then repeat('机场', 21) when elevation_ft > 3000 then '机场' || name
  else '机场' || cast(id as varchar(20)) end || '" ' as given from {places}
)
select id, case when length(trim(trim(trim(given), '"'))) between 1 and 40
 and regexp_matches(given, '[\\x{{4e00}}-\\x{{9fff}}]') and not regexp_matches(given, '[A-Za-z]{{4,}}')
 and lower(trim(trim(trim(given), '"'))) <> lower(trim(name)) then trim(trim(trim(given), '"')) end as accepted
from offered
""")
def _f10(v):
    feet = F.col("elevation_ft")
    given = (
        F.when(feet > 8000, F.col("name"))
        .when(feet > 6000, F.repeat(F.lit("机场"), 21))
        .when(feet > 3000, F.concat(F.lit("机场"), "name"))
        .otherwise(F.concat(F.lit("机场"), F.col("id").cast("string")))
    )
    quoted = F.concat(F.lit('  "'), given, F.lit('" '))
    return v("places").select("id", T.validate_name(quoted, "name").alias("accepted"))


@query("f9_reply_map", """
select conv_id * 1000 + turn as batch_id, turn as id,
 case when turn % 4 = 1 then '乙机场' || cast(conv_id as varchar(20)) end as value
from {conversations} where turn % 4 in (1, 3)
""")
def _f9(v):
    """Every turn expects its own number; turns without an answer give no row."""
    expected = v("conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("batch_id"), F.col("turn").alias("id")
    )
    return R.reply_map(v("replies"), expected)


_ENTRIES = f"""
targets as (
 select * from {{places}} where type in ('large_airport', 'medium_airport')
), clear as (
 select cascade.id, cascade.qid, cascade.property, cascade.ambiguous, cands.label, cands.suffix, cands.converted
 from cascade join targets using (id) left join cands on cands.property = cascade.property
  and cands.code = cascade.code and cands.qid = cascade.qid
), full_rows as (
 select t.*, c.property, coalesce(c.ambiguous, false) as ambiguous, n.name_zh as city_zh,
  case when not c.ambiguous then c.qid end as qid,
  case when not c.ambiguous then c.label end as entity_label,
  case when not c.ambiguous then c.suffix end as suffix,
  case when not c.ambiguous then coalesce(c.converted, false) else false end as converted,
  {_composed('t.name', 't.municipality', 'n.name_zh')} as composed
 from targets t left join clear c on c.id = t.id left join city_names n on n.city = t.municipality
), entries as (
 select f.id, f.ident, f.type, f.iata_code, f.icao_code, f.name, f.iso_country,
  coalesce(entity_label, composed) as name_zh,
  case when entity_label is not null then 'wikidata:' || qid || ':' || f.suffix
   when composed is not null then 'composite:municipality:' || municipality end as name_zh_source,
  case when coalesce(entity_label, composed) is null then 'unresolved' else 'resolved' end as name_zh_status,
  municipality, city_zh as municipality_zh,
  case when city_zh is not null then 'wikipedia:en:' || municipality || '>zh' end as municipality_zh_source,
  case when city_zh is not null then 'resolved' else 'unresolved' end as municipality_zh_status,
  a.label as location_zh,
  case when a.label is not null then 'wikidata:' || qid || ':P131:' || a.admin_qid || ':' || a.suffix end
   as location_zh_source,
  case when entity_label is not null then 'entity' when composed is not null then 'composite' end as origin,
  ambiguous, entity_label is not null and converted as converted,
  property as match_property
 from full_rows f left join top_admin a on a.entity = f.qid
)"""
_RESOLVED = f"with {_CTE}, {_MATCH}, {_SETTLED}, {_TITLES}, {_PAGES}, {_ENTRIES}"
_NAME_LIST = ", ".join(K.NAME_COLUMNS)


def resolved(v):
    return RS.resolve_names(
        v("places"), candidates(v), settlements(v), v("town_pages"), v("redirects"), SIMPLIFY
    )


@query("m7_resolve_names", f"{_RESOLVED} select {_NAME_LIST}, ambiguous from entries")
def _m7(v):
    return resolved(v).select(*K.NAME_COLUMNS, "ambiguous")


# The archive: what an earlier service run said about the places without a scheduled service.
_ARCHIVE = """
select id, '存' || cast(id as varchar(20)) as name_zh,
 case when elevation_ft < -500 then null else 'llm:codex:old' end as source
from {places} where scheduled_service = 'no'
"""
_ARCHIVED = f"""
archive as (
 select id, name_zh as stored, coalesce(source, 'llm:unknown') as stored_source from ({_ARCHIVE})
), archived as (
 select e.* replace (
  case when name_zh_status = 'unresolved' and stored is not null then stored else name_zh end as name_zh,
  case when name_zh_status = 'unresolved' and stored is not null then stored_source
   else name_zh_source end as name_zh_source,
  case when stored is not null then 'resolved' else name_zh_status end as name_zh_status,
  case when name_zh_status = 'unresolved' and stored is not null then 'archive' else origin end as origin)
 from entries e left join archive using (id)
)"""


def archive(v):
    places = v("places").where(F.col("scheduled_service") == "no")
    source = F.when(F.col("elevation_ft") >= -500, "llm:codex:old")
    return archive_names(
        places.select(
            "id", F.concat(F.lit("存"), F.col("id").cast("string")).alias("name_zh"), source.alias("source")
        )
    )


@query("m8_apply_archive", f"{_RESOLVED}, {_ARCHIVED} select {_NAME_LIST} from archived")
def _m8(v):
    return RS.apply_archive(resolved(v), archive(v)).select(*K.NAME_COLUMNS)


def archived(v):
    """Entries after the archive, cut off from the plan that made them: several branches read them."""
    return written(RS.apply_archive(resolved(v), archive(v)))


@query("w6_request_batches", f"""
{_RESOLVED}, waiting as (
 select id, name, iso_country, municipality,
  cast(floor((row_number() over (order by id) - 1) / 100) as bigint) as batch_id
 from entries where name_zh_status = 'unresolved'
)
select batch_id, count(*) as size, min(id) as first_id, max(id) as last_id,
 '[' || string_agg('{{{{"id":' || id || ',"name":"' || name || '","country":"' || coalesce(iso_country, '')
  || '","city":"' || coalesce(municipality, '') || '"}}}}', ',' order by id) || ']' as requests
from waiting group by batch_id
""")
def _w6(v):
    return R.request_batches(written(RS.pending(resolved(v))))


_REPLIED = f"""
{_RESOLVED}, {_ARCHIVED}, answers as (
 select a.*, case when name_zh_status = 'unresolved' and p.elevation_ft > 2000
  then '答' || cast(a.id as varchar(20)) end as answer
 from archived a join (select id, elevation_ft from {{places}}) p on p.id = a.id
), final as (
 select * replace (coalesce(answer, name_zh) as name_zh,
  case when answer is not null then 'llm:codex:new' else name_zh_source end as name_zh_source,
  case when answer is not null then 'resolved' else name_zh_status end as name_zh_status,
  case when answer is not null then 'reply' else origin end as origin) from answers
)"""


def replies(v, entries):
    """One reply per request batch: a name for the high places, Latin or nothing for the rest."""
    members = R.request_members(RS.pending(entries), K.REPLY_BATCH_SIZE).join(
        v("places").select("id", "elevation_ft"), "id"
    )
    number = F.col("id").cast("string")
    answer = (
        F.when(F.col("elevation_ft") > 2000, F.concat(F.lit('": "答'), number, F.lit('"')))
        .when(F.col("elevation_ft") > 0, F.lit('": "Latin name"'))
        .otherwise(F.lit('": null'))
    )
    item = F.concat(F.lit('"'), number, answer)
    # A batch has at most REPLY_BATCH_SIZE members, so its reply is small.
    return members.groupBy("batch_id").agg(
        F.concat(
            F.lit('Thinking {"0": "x"} ... {'),
            F.array_join(F.array_sort(F.collect_list(item)), ", "),
            F.lit("} done"),
        ).alias("reply")
    )


@query("m9_apply_replies", f"{_REPLIED} select {_NAME_LIST} from final")
def _m9(v):
    entries = archived(v)
    return RS.apply_replies(entries, replies(v, entries), "codex:new").select(*K.NAME_COLUMNS)


_COUNTERS = """
select count(*) as targets, count(*) filter (where origin = 'entity') as resolved,
 count(*) filter (where name_zh_status = 'unresolved') as unresolved,
 count(*) filter (where ambiguous) as ambiguous,
 count(*) filter (where origin = 'entity' and match_property = 'P238') as via_iata,
 count(*) filter (where origin = 'entity' and match_property = 'P239') as via_icao,
 count(*) filter (where origin = 'entity' and converted) as converted_from_traditional,
 count(*) filter (where municipality is not null and municipality_zh is not null) as municipality_from_wikipedia,
 count(*) filter (where municipality is not null and municipality_zh is null) as municipality_unresolved,
 count(*) filter (where origin = 'composite') as composite_resolved,
 count(*) filter (where origin = 'archive') as llm_supplement_applied,
 count(*) filter (where origin = 'reply') as llm_resolved,
 count(*) filter (where name_zh_status = 'unresolved') as llm_unresolved,
 count(*) filter (where location_zh is not null) as location_from_wikidata,
 count(*) filter (where location_zh is null) as location_unresolved
"""


@query("a9_refresh_stats", f"{_REPLIED} {_COUNTERS} from final")
def _a9(v):
    entries = archived(v)
    return RS.refresh_stats(RS.apply_replies(entries, replies(v, entries), "codex:new"), replied=True)


@query("p19_lookup_keys", """
select distinct 'P238' as kind, iata_code as value from {places}
where type in ('large_airport', 'medium_airport') and iata_code is not null
union all select distinct 'P239', icao_code from {places}
where type in ('large_airport', 'medium_airport') and icao_code is not null
union all select distinct 'city', municipality from {places}
where type in ('large_airport', 'medium_airport') and municipality is not null
""")
def _p19(v):
    return E.lookup_keys(v("places"))
