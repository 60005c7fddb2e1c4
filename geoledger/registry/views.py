"""Places, names, entities, pages and requests derived from the given tables.

Each view is one SELECT that Spark and a checking engine read alike. Braces name a given table or
another view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

VIEWS = {
    # Every customer is a place with the 19 source columns.
    "places": """
select c_custkey as id, c_name as ident,
 case c_custkey % 7 when 0 then 'large_airport' when 1 then 'medium_airport'
   when 2 then 'small_airport' when 3 then 'heliport' when 4 then 'seaplane_base'
   when 5 then 'balloonport' else 'closed' end as type,
 case when c_custkey % 2 = 0 then 'Town ' || cast(cast(floor(c_custkey / 5) as bigint) as varchar(20))
   else n_name end
   || case c_custkey % 3 when 0 then ' International' when 1 then ' Regional' else '' end
   || case c_custkey % 4 when 0 then ' Airport' when 1 then ' Air Base' when 2 then ' Heliport'
      else ' Field' end as name,
 cast((c_custkey * 7919) % 17000 as double) / 100 - 85 as latitude_deg,
 cast((c_custkey * 104729) % 36000 as double) / 100 - 180 as longitude_deg,
 cast(floor(c_acctbal) as int) as elevation_ft,
 case r_name when 'AFRICA' then 'AF' when 'AMERICA' then 'NA' when 'ASIA' then 'AS'
   when 'EUROPE' then 'EU' end as continent,
 'N' || chr(65 + n_nationkey) as iso_country,
 'N' || chr(65 + n_nationkey) || '-' || cast(n_regionkey as varchar(9)) as iso_region,
 case when c_custkey % 10 <> 0 then
   'Town ' || cast(cast(floor(c_custkey / 5) as bigint) as varchar(20))
   || case when c_custkey % 9 = 0 then ' (North)' else '' end end as municipality,
 case when c_acctbal > 0 then 'yes' else 'no' end as scheduled_service,
 'G' || cast(c_custkey as varchar(20)) as gps_code,
 c_mktsegment as icao_code,
 case when c_custkey % 4 <> 0 then cast(n_nationkey as varchar(9)) end as iata_code,
 cast(null as varchar(9)) as local_code,
 'https://example.com/' || cast(c_custkey as varchar(20)) as home_link,
 cast(null as varchar(9)) as wikipedia_link,
 lower(c_mktsegment) as keywords
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
""",
    # The same customers as raw text, with blanks, padding and broken values.
    "raw_places": """
select cast(id as varchar(20)) || case when id % 71 = 0 then 'x' else ' ' end as id,
 case when id % 83 = 0 then '  ' else ' ' || ident || ' ' end as ident,
 case when id % 97 = 0 then 'airport' else type end as type,
 case when id % 101 = 0 then '' else name end as name,
 case when id % 89 = 0 then 'x' else cast(latitude_deg as varchar(30)) end as latitude_deg,
 case when id % 91 = 0 then ' ' else cast(longitude_deg as varchar(30)) end as longitude_deg,
 cast(elevation_ft as varchar(20)) || '.9' as elevation_ft,
 case when id % 67 = 0 then 'XX' else continent end as continent,
 iso_country, iso_region, municipality,
 case when id % 79 = 0 then 'maybe' else scheduled_service end as scheduled_service,
 gps_code, icao_code, iata_code, local_code, home_link, wikipedia_link, keywords
from {places}
""",
    # Name entries of the large and medium places.
    "names": """
select id, ident, type, iata_code, icao_code, name,
 case when elevation_ft > 1000 then '机场' || cast(id as varchar(20)) end as name_zh,
 case when elevation_ft > 6000 then 'wikidata:Q' || cast(id as varchar(20)) || ':zh-cn'
   when elevation_ft > 3000 then 'composite:municipality:' || coalesce(municipality, 'none')
   when elevation_ft > 1000 then 'llm:codex:m' end as name_zh_source,
 case when elevation_ft > 1000 then 'resolved' else 'unresolved' end as name_zh_status,
 municipality,
 case when scheduled_service = 'yes' and municipality is not null then '城' || iso_country end
   as municipality_zh,
 case when scheduled_service = 'yes' then 'wikipedia:en:' || municipality || '>zh' end
   as municipality_zh_source,
 case when scheduled_service = 'yes' and municipality is not null then 'resolved'
   else 'unresolved' end as municipality_zh_status,
 case when continent = 'AS' then '镇' || iso_country end as location_zh,
 case when continent = 'AS' then 'wikidata:Q1:P131:Q2:zh' end as location_zh_source
from {places} where type in ('large_airport', 'medium_airport')
""",
    "named": """
select p.*, n.name_zh, n.name_zh_source, n.municipality_zh, n.municipality_zh_source,
 n.location_zh, n.location_zh_source
from {places} p left join {names} n on p.id = n.id
""",
    # The state before a snapshot: one market segment is not in it yet.
    "current_state": """
select id, ident, type, name, latitude_deg, longitude_deg, elevation_ft, continent, iso_country,
 iso_region, municipality, scheduled_service, gps_code, icao_code, iata_code, local_code, home_link,
 wikipedia_link, keywords, name_zh, municipality_zh, name_zh_source,
 case when name_zh is not null then timestamp '2024-01-01 00:00:00' end as name_zh_updated_at,
 md5(ident || name || cast(elevation_ft as varchar(20))) as row_hash,
 elevation_ft >= 0 as is_active,
 timestamp '2024-01-01 00:00:00' as first_seen_at,
 timestamp '2024-01-02 00:00:00' as last_seen_at,
 case when elevation_ft < 0 then timestamp '2024-01-03 00:00:00' end as deactivated_at,
 timestamp '2024-01-02 00:00:00' as updated_at,
 case when continent = 'EU' then timestamp '2024-03-01 00:00:00'
   else timestamp '2024-01-02 00:00:00' end as source_snapshot_at,
 municipality_zh_source, location_zh, location_zh_source
from {named} where icao_code <> 'MACHINERY'
""",
    # The snapshot to merge: another segment is gone, some names and values have changed.
    "incoming": """
select id, ident, type, case when elevation_ft > 9000 then name || ' (new)' else name end as name,
 latitude_deg, longitude_deg, elevation_ft, continent, iso_country, iso_region, municipality,
 scheduled_service, gps_code, icao_code, iata_code, local_code, home_link, wikipedia_link, keywords,
 case when continent = 'AF' then '新' || name_zh when continent = 'NA' then null else name_zh end
   as name_zh,
 'wikidata:new' as name_zh_source,
 case when iso_country = 'NC' then '市' else municipality_zh end as municipality_zh,
 municipality_zh_source, location_zh, location_zh_source,
 md5(ident || case when elevation_ft > 9000 then name || ' (new)' else name end
   || cast(elevation_ft as varchar(20))) as row_hash
from {named} where icao_code <> 'FURNITURE'
""",
    # Each supplier is an entity beside the place with 15 times its key; rich ones have a twin.
    "sites": """
select s_suppkey, s_name, s_acctbal, c_nationkey, c_mktsegment,
 cast((c_custkey * 7919) % 17000 as double) / 100 - 85 as lat,
 cast((c_custkey * 104729) % 36000 as double) / 100 - 180 as lon
from {supplier} join {customer} on c_custkey = s_suppkey * 15
""",
    "entities": """
select 'Q' || cast(s_suppkey as varchar(20)) as qid, cast(c_nationkey as varchar(9)) as p238,
 c_mktsegment as p239, lat + case when s_acctbal < 1500 then 5.0e0 else 0.05e0 end as lat, lon,
 s_suppkey, s_name, s_acctbal
from {sites}
union all
select 'Q' || cast(s_suppkey + 1000000000 as varchar(20)), cast(c_nationkey as varchar(9)),
 c_mktsegment, lat + case when s_acctbal < 8000 then 0.052e0 else 0.15e0 end, lon,
 s_suppkey, s_name, s_acctbal
from {sites} where s_acctbal > 6000
""",
    # Bindings of the entities: property, code, address, point text, language and label.
    "bindings": """
select 'P238' as property, p238 as code, 'http://example.org/entity/' || qid as entity,
 'Point(' || cast(lon as varchar(40)) || ' ' || cast(lat as varchar(40)) || ')' as coord,
 case s_suppkey % 6 when 0 then 'zh-cn' when 1 then 'zh-hans' when 2 then 'zh'
   when 3 then 'zh-hant' when 4 then 'zh-tw' else 'zh-hk' end as lang,
 case when s_suppkey % 4 = 0 then s_name else ' 机场' || cast(s_suppkey as varchar(20)) end as label
from {entities}
union all
select 'P239', p239, 'http://example.org/entity/' || qid, 
 'Point(' || cast(lon as varchar(40)) || ' ' || cast(lat as varchar(40)) || ')',
 'zh', '國際機場' || cast(s_suppkey as varchar(20))
from {entities} where s_acctbal > 2500
union all
select 'P238', p238, 'http://example.org/entity/' || qid, cast(null as varchar(40)), 'zh-hk',
 '港場' || cast(s_suppkey as varchar(20))
from {entities} where s_acctbal > 4000
""",
    # Settlements of the entities, with readable and unreadable populations.
    "settlements": """
select qid as entity, 'Q7' || cast(s_suppkey as varchar(20)) as admin_qid,
 cast(cast(floor(s_acctbal) as int) as varchar(20)) || '.5' as population, 'zh-cn' as lang,
 '镇' || cast(s_suppkey as varchar(20)) as label
from {entities}
union all
select qid, 'Q8' || cast(s_suppkey as varchar(20)),
 case when s_acctbal > 5000 then 'unknown' else '3000' end, 'zh-tw',
 '國' || cast(s_suppkey as varchar(20))
from {entities}
union all
select qid, 'Q9' || cast(s_suppkey as varchar(20)), '999999', 'zh', 'Latin label' from {entities}
""",
    # Every part is a page about a town; some come in two pieces.
    "town_pages": """
select 'Town ' || cast(p_partkey as varchar(20)) as title, p_size > 45 as missing,
 split(case when p_size % 5 = 0 then 'Category:Minerals'
   when p_size % 5 = 1 then 'Category:Disambiguation pages;Category:Towns in X'
   else 'Category:Ports;Category:Cities in X' end, ';') as categories,
 split(case when p_size % 11 = 0 then null when p_size % 7 = 0 then 'Latin'
   else '城' || cast(p_partkey as varchar(20)) || case when p_size % 3 = 0 then ' (省)' else '' end
   end, ';') as langlinks
from {part}
union all
select 'Town ' || cast(p_partkey as varchar(20)), p_size > 45,
 split('Category:Populated places in ' || p_type || ';Category:Ports', ';'),
 split(case when p_size % 11 = 0 then '合城' || cast(p_partkey as varchar(20)) end, ';')
from {part} where p_retailprice > 1000
""",
    "redirects": """
select 'Town ' || cast(p_partkey as varchar(20)) as from_title,
 'Town ' || cast(p_partkey + 1 as varchar(20)) as to_title
from {part} where p_size < 15
""",
    # Class edges: every part key is a subclass of its tenth.
    "class_edges": """
select p_partkey as child, cast(floor(p_partkey / 10) as bigint) as parent from {part}
""",
    "instances": """
select cast(l_orderkey as varchar(20)) || '-' || cast(l_linenumber as varchar(9)) as entity,
 l_partkey as class from {lineitem}
""",
    # Every event is a saved filter.
    "saved_filters": """
select event_id,
 case event_type when 'click' then 'large_airport,closed' when 'view' then ''
   when 'error' then 'bogus, heliport' when 'purchase' then 'small_airport,balloonport,large_airport'
   end as type_text,
 case when user_id % 5 = 0 then 'n' || chr(cast(97 + user_id % 25 as int)) || ',XYZ, NB' end as country_text,
 case when value > 60 then 'town machinery' when value > 50 then 'Field  G1' when value > 45 then '场' end
   as query_text,
 user_id % 3 = 0 as zh, user_id % 4 = 0 as sched
from {events}
""",
    "filter_urls": """
select event_id, 'https://example.com/globe?x=%zz'
 || case when type_text is not null then '&type=' || replace(replace(type_text, ',', '%2C'), ' ', '+')
    else '' end
 || case when country_text is not null then '&country=' || replace(country_text, ' ', '%20') else '' end
 || case when query_text is not null then '&q=' || replace(replace(query_text, ' ', '+'), '场', '%E5%9C%BA')
    else '' end
 || case when zh then '&zh=1&zh=0' else '&zh=yes' end
 || case when sched then '&sched=1' else '' end || '&borders=0#top' as url
from {saved_filters}
""",
    # Runs: the days of the event log.
    "runs": """
select cast(extract(day from ts) as bigint) as run_id, max(ts) as finished_at,
 case when cast(extract(day from ts) as int) % 5 = 0 then 'failed' else 'succeeded' end as status,
 count(*) as rows_total
from {events} group by cast(extract(day from ts) as bigint), cast(extract(day from ts) as int)
""",
    # Replies: each conversation turn answers about its own number.
    "replies": """
select conv_id * 1000 + turn as batch_id,
 case turn % 4 when 0 then text
  when 1 then '{{"' || cast(turn as varchar(9)) || '": "甲机场"}} then {{"' || cast(turn as varchar(9))
    || '": " 乙机场' || cast(conv_id as varchar(20)) || ' ", "x": "}}", "n": {{"a": 1}}}} {{"0": "z"}} end'
  when 2 then '{{"99": "x"}}' else '```json {{"' || cast(turn as varchar(9)) || '": null, "5": 7}} ```' end
  || case when turn % 4 = 0 then '' else replace(replace(text, '{{', '('), '"', ' ') end as reply
from {conversations}
""",
}

_NAMES = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def needs(sql: str) -> list[str]:
    """Tables and views a statement names, in order of first use."""
    return list(dict.fromkeys(_NAMES.findall(sql)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a view over them as a DataFrame.

    The session keeps the unexecuted DataFrames, so a table's schema is read once.
    """
    known = spark.__dict__.setdefault("_geoledger_views", {})
    key = (sf_dir, name)
    if key not in known:
        if name in TABLES:
            known[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            sql = VIEWS[name]
            known[key] = spark.sql(sql, **{part: view(spark, sf_dir, part) for part in needs(sql)})
    return known[key]


def standalone(sql: str) -> str:
    """A statement with the views it needs as common table expressions."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in needs(text):
            if name in VIEWS and name not in order:
                visit(VIEWS[name])
                order.append(name)

    visit(sql)
    plain = {name: name for name in (*TABLES, *VIEWS)}
    parts = [f"{name} as ({VIEWS[name].format(**plain).strip()})" for name in order]
    body = sql.format(**plain).strip()
    if not parts:
        return body
    if body.lower().startswith("with recursive"):
        return f"with recursive {', '.join(parts)}, {body[len('with recursive'):].strip()}"
    if body.lower().startswith("with "):
        return f"with {', '.join(parts)}, {body[len('with '):].strip()}"
    return f"with {', '.join(parts)} {body}"
