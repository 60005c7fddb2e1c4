"""Queries that write the given tables as files and run the file-based jobs over them."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.operators import merge as M
from geoledger.operators import quality as Q
from geoledger.plans import collect as C
from geoledger.plans import publish as PB
from geoledger.plans import resolve as RS
from geoledger.registry import boundary, match, query, state
from geoledger.registry.boundary import features
from geoledger.registry.quality import REJECTS
from geoledger.session import ensure_checkpoint_dir
from geoledger.sources import geojson as GJ
from geoledger.sources import names as N
from geoledger.sources import published as P
from geoledger.sources.records import ordered_digest, placed_lines
from geoledger.sources.snapshot import read_snapshot, snapshot_meta
from geoledger.sources.state import STATE_SCHEMA, StateTable
from geoledger.streaming.landing import announce, run_pending

FIRST_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
SECOND_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)


def scratch(spark: SparkSession) -> str:
    """A new folder beside the session's checkpoints, which all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


def write_csv(df: DataFrame, path: str) -> str:
    text = df.select(*[F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in df.columns])
    text.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)
    return path


def snapshot_file(v, name: str = "places") -> tuple[SparkSession, str, str]:
    places = v(name).select(*K.SOURCE_COLUMNS)
    spark = places.sparkSession
    root = scratch(spark)
    return spark, root, write_csv(places, f"{root}/snapshot")


_SOURCE = ", ".join(K.SOURCE_COLUMNS)
_ATTACHED = ", ".join(f"n.{name} as {name}" for name in K.ATTACHED_NAME_COLUMNS)


@query("s1_read_snapshot", f"select {_SOURCE} from {{places}}")
def s1(v):
    """Places written as CSV, read by name, checked and typed."""
    spark, _, path = snapshot_file(v)
    return C.checked_snapshot(spark, path)


@query("s1_read_snapshot_rejects", f"""
select trim(raw_id) as raw_id, ident, reason from ({REJECTS.strip()}) r
""")
def _s1_raw(v):
    """Raw rows written as CSV and read; those that break a rule, with the reason."""
    spark, _, path = snapshot_file(v, "raw_places")
    rejects = Q.validate_rows(read_snapshot(spark, path).drop("_bad"))[1]
    return rejects.select(F.trim("raw_id").alias("raw_id"), "ident", "reason")


_LINE = "cast(doc_id as varchar) || chr(9) || source || chr(9) || lang"


@query("s1_read_quoted_breaks", f"""
select id, ident, name || chr(10) || '"' || coalesce(municipality, '') || '",' as name,
 case when id % 3 = 0 then keywords || chr(10) || chr(10) || name else keywords end as keywords from {{places}}
""")
def _s1_breaks(v):
    """Places with line breaks, commas and quotation marks in their fields, written as CSV and read in parallel."""
    told = F.concat("name", F.lit('\n"'), F.coalesce("municipality", F.lit("")), F.lit('",'))
    more = F.when(F.expr("id % 3 = 0"), F.concat("keywords", F.lit("\n\n"), "name")).otherwise(F.col("keywords"))
    places = v("places").select("id", "ident", told.alias("name"), more.alias("keywords"))
    path = write_csv(places, f"{scratch(places.sparkSession)}/breaks")
    read = read_snapshot(places.sparkSession, path, ["id", "ident", "name", "keywords"])
    return read.select(F.col("id").cast("bigint").alias("id"), "ident", "name", "keywords")


@query("s2_snapshot_meta", f"""
with lines as (select source, doc_id, {_LINE} as line from {{documents}})
select source, cast(sum(length(line) + 1) as bigint) as bytes,
 sha256(string_agg(line, chr(10) order by doc_id) || chr(10)) as sha256
from lines group by source
""")
def _s2(v):
    """Documents written as lines, one file for each source; bytes and digest of every file."""
    documents = v("documents")
    spark = documents.sparkSession
    line = F.concat_ws("\t", F.col("doc_id").cast("string"), "source", "lang")
    path = line_files(documents.select(F.col("source").alias("part"), line.alias("value"), "doc_id"), "doc_id")
    source = F.regexp_extract("path", "/part=([^/]*)/", 1).alias("source")
    return snapshot_meta(spark, f"{path}/part=*").select(source, "bytes", "sha256")


def line_files(rows: DataFrame, *order: str) -> str:
    """Lines written in order, one file for each `part`."""
    path = f"{scratch(rows.sparkSession)}/lines"
    rows.repartition("part").sortWithinPartitions("part", *order).select("part", "value").write.partitionBy("part").text(path)
    return path


_ITEM = "cast(l_orderkey as varchar(20)) || ':' || cast(l_linenumber as varchar(9)) || ':' || cast(l_partkey as varchar(20))"


@query("s2_ordered_digest", f"""
with lines as (
 select l_linestatus as part, l_orderkey, l_linenumber, l_partkey, {_ITEM} as line from {{lineitem}}
), placed as (
 select *, coalesce(sum(length(line) + 1) over (partition by part order by l_orderkey, l_linenumber, l_partkey
   rows between unbounded preceding and 1 preceding), 0) as pos
 from lines
), ranges as (
 select part, floor(pos / 1048576) as n, sha256(string_agg(line, chr(10) order by pos)) as hash from placed group by all
), folds as (
 select part, floor(n / 1024) as n, sha256(string_agg(hash, '' order by n)) as hash from ranges group by all
)
select part, case when count(*) = 1 and (select max(n) from ranges) < 1024 then max(hash)
 else sha256(string_agg(hash, '' order by n)) end as tree_sha256 from folds group by part
""")
def _s2_tree(v):
    """Order lines written as one file for each status, hashed range by range in order."""
    items = v("lineitem")
    line = F.concat_ws(":", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")])
    rows = items.select(F.col("l_linestatus").alias("part"), line.alias("value"), "l_orderkey", "l_linenumber", "l_partkey")
    path = line_files(rows, "l_orderkey", "l_linenumber", "l_partkey")
    roots = ordered_digest(placed_lines(items.sparkSession, f"{path}/part=*"))
    return roots.select(F.regexp_extract("path", "/part=([^/]*)/", 1).alias("part"), "tree_sha256")


_NAME_LIST = ", ".join(K.NAME_COLUMNS)


@query("s3_read_names", f"select {_NAME_LIST} from {{names}}")
def _s3(v):
    names = v("names")
    path = f"{scratch(names.sparkSession)}/names"
    N.write_names(names, path)
    return N.read_names(names.sparkSession, path)


_BLANK_NAMES = ", ".join(f"coalesce({name}, '') as {name}" for name in K.NAME_COLUMNS if name != "id")


@query("s4_write_names", f"select id, {_BLANK_NAMES} from {{names}}")
def _s4(v):
    names = v("names")
    path = f"{scratch(names.sparkSession)}/names"
    N.write_names(names, path)
    written = names.sparkSession.read.option("header", True).option("escape", '"').csv(path)
    blank = lambda name: F.coalesce(name, F.lit("")).alias(name)
    return written.select(
        F.col("id").cast("bigint").alias("id"), *[blank(name) for name in K.NAME_COLUMNS if name != "id"]
    )


@query("s5_archive", """
select id, name_zh, name_zh_source as source from {names} where name_zh_source like 'llm:%' and name_zh is not null
""")
def _s5(v):
    names = v("names")
    path = f"{scratch(names.sparkSession)}/archive"
    N.write_archive(names, path)
    return N.read_archive(names.sparkSession, path)


@query("s6_publish_snapshot", f"select {', '.join(K.PUBLISHED_FIELDS)} from {{named}}")
def _s6(v):
    """Positional gzip lines, read back by the declared field order."""
    places = v("places")
    path = f"{scratch(places.sparkSession)}/published"
    P.publish_snapshot(places, v("names"), path, positional=True)
    return P.parse_published(places.sparkSession.read.text(path), list(K.PUBLISHED_FIELDS))


@query("m11_publish_job", """
select 1 as schema_version, count(*) as rows, (select count(*) from {names}) as name_rows,
 count(name_zh) as named_rows,
 count(*) filter (where type in ('large_airport', 'medium_airport') and name_zh is null) as unresolved_targets,
 25 as fields, count(*) as source_rows, true as compressed from {named}
""")
def _m11(v):
    spark, root, path = snapshot_file(v)
    N.write_names(v("names"), f"{root}/names")
    PB.publish_job(spark, path, f"{root}/names", f"{root}/out", generated_at=FIRST_AT, min_rows=1, min_large=1)
    manifest = spark.read.json(f"{root}/out/manifest")
    return manifest.select(
        F.col("schemaVersion").cast("int").alias("schema_version"),
        "rows",
        F.col("names.rowCount").alias("name_rows"),
        F.col("namedRows").alias("named_rows"),
        F.col("unresolvedTargets").alias("unresolved_targets"),
        F.size("fields").alias("fields"),
        F.col("source.rowCount").alias("source_rows"),
        (F.col("snapshot.storedBytes") < F.col("snapshot.uncompressedBytes")).alias("compressed"),
    )


_FIRST = "timestamp '2024-01-01 00:00:00'"
_SECOND = "timestamp '2024-02-01 00:00:00'"
_JOB = f"""
with before as (select * from {{places}} where icao_code <> 'MACHINERY'),
after as (
 select * replace (case when elevation_ft > 9000 then name || ' (new)' else name end as name)
 from {{places}} where icao_code <> 'FURNITURE'
), both_sides as (
 select coalesce(a.id, b.id) as id, a.id is not null as seen, b.id is not null as known,
  coalesce(a.name, b.name) as name, coalesce(a.latitude_deg, b.latitude_deg) as latitude_deg,
  a.name is distinct from b.name or n.name_zh is not null or n.municipality_zh is not null
   or n.location_zh is not null as changed, case when a.id is not null then n.name_zh end as name_zh
 from after a full join before b on a.id = b.id left join {{names}} n on n.id = a.id
)"""


@query("m5_collect_job", f"""
{_JOB}
select p.* replace (b.name as name), {', '.join(f"case when seen then n.{name} end as {name}" for name in K.ATTACHED_NAME_COLUMNS)},
 case when seen and n.name_zh is not null then {_SECOND} end as name_zh_updated_at, seen as is_active,
 case when known then {_FIRST} else {_SECOND} end as first_seen_at,
 case when seen then {_SECOND} else {_FIRST} end as last_seen_at,
 case when not seen then {_SECOND} end as deactivated_at,
 case when changed or not known or not seen then {_SECOND} else {_FIRST} end as updated_at,
 case when seen then {_SECOND} else {_FIRST} end as source_snapshot_at
from both_sides b join {{places}} p using (id) left join {{names}} n on n.id = b.id
""")
def _m5(v):
    """Two runs of the real job over CSV files: one without names, then a changed one with names."""
    return state._plain(collected(v).read().select(*[c for c in K.STATE_COLUMNS if c != "row_hash"]))


def two_snapshots(v) -> tuple[SparkSession, str, str, str]:
    """A first snapshot, a changed second one and a names file, as CSV below a new folder."""
    places = v("places").select(*K.SOURCE_COLUMNS)
    spark = places.sparkSession
    root = scratch(spark)
    before = write_csv(places.where("icao_code <> 'MACHINERY'"), f"{root}/first")
    renamed = F.when(F.col("elevation_ft") > 9000, F.concat("name", F.lit(" (new)"))).otherwise(F.col("name"))
    changed = places.where("icao_code <> 'FURNITURE'").withColumn("name", renamed)
    after = write_csv(changed, f"{root}/second")
    N.write_names(v("names"), f"{root}/names")
    return spark, root, before, after


def collected(v) -> StateTable:
    spark, root, before, after = two_snapshots(v)
    table = StateTable(spark, f"{root}/state")
    limits = {"min_rows": 1, "min_large": 1}
    C.collect_job(spark, before, table, snapshot_at=FIRST_AT, allow_missing_names=True, **limits)
    C.collect_job(spark, after, table, f"{root}/names", snapshot_at=SECOND_AT, **limits)
    return table


@query("m5_collect_runs", f"""
{_JOB}
select cast(1 as bigint) as run_id, 'succeeded' as status, count(*) as rows_total, count(*) as rows_inserted, 0 as rows_updated,
 0 as rows_unchanged, 0 as rows_deactivated from before
union all
select cast(2 as bigint), 'succeeded', count(*) filter (where seen), count(*) filter (where seen and not known),
 count(*) filter (where seen and known and changed), count(*) filter (where seen and known and not changed),
 count(*) filter (where not seen) from both_sides
""")
def _m5_runs(v):
    runs = collected(v).runs()
    return runs.select(
        "run_id", "status", "rows_total", "rows_inserted", "rows_updated", "rows_unchanged", "rows_deactivated"
    )


@query("m6_stage_check", f"""
select p.*, {_ATTACHED}, true as is_active, {_FIRST} as first_seen_at, {_FIRST} as last_seen_at, {_FIRST} as updated_at,
 {_FIRST} as source_snapshot_at from {{places}} p left join {{names}} n on n.id = p.id
""")
def _m6(v):
    """A version is written aside, counted and checked for unique idents before it may be read."""
    rows = C.incoming_rows(v("places"), v("names"))
    table = StateTable(rows.sparkSession, f"{scratch(rows.sparkSession)}/state")
    staged = table.stage(1, rows)
    table.write_version(1, M.merge_with_changes(table.read(), staged, FIRST_AT), staged.count())
    times = ("first_seen_at", "last_seen_at", "updated_at", "source_snapshot_at")
    return state._plain(table.read(1).select(*K.SOURCE_COLUMNS, *K.ATTACHED_NAME_COLUMNS, "is_active", *times))


@query("m5_collect_frames", f"""
select p.*, {_ATTACHED}, true as is_active from {{places}} p left join {{names}} n on n.id = p.id
""")
def _m5_frames(v):
    """The job's plan without files: rules, names, hash and merge into an empty state."""
    places = v("places")
    raw = places.select(*[F.col(name).cast("string").alias(name) for name in K.SOURCE_COLUMNS])
    empty = places.sparkSession.createDataFrame([], STATE_SCHEMA)
    merged = C.collect_frames(empty, raw, v("names"), FIRST_AT)
    return merged.select(*K.SOURCE_COLUMNS, *K.ATTACHED_NAME_COLUMNS, "is_active")


@query("m10_refresh_job", f"{match._REPLIED} {match._COUNTERS} from final")
def _m10(v):
    """The refresh job with files: entries, archive, replies, names and archive written, counters."""
    first = match.archived(v)
    spark = first.sparkSession
    root = scratch(spark)
    inputs = RS.ResolutionInputs(
        v("places"),
        match.candidates(v),
        match.settlements(v),
        v("town_pages"),
        v("redirects"),
        archive=match.archive(v),
        replies=match.replies(v, first),
        reply_label="codex:new",
        simplify=match.SIMPLIFY,
    )
    return RS.refresh_job(spark, inputs, f"{root}/work", f"{root}/names", f"{root}/archive")


@query("s9_read_geojson", """
select case when label % 2 = 1 then 'MultiPolygon' else 'Polygon' end as kind,
 'Ring ' || cast(vec_id as varchar(20)) as name from {embeddings}
""")
def _s9(v):
    shapes = features(v)
    spark = shapes.sparkSession
    path = f"{scratch(spark)}/features"
    geometry = F.struct(F.col("kind").alias("type"), F.col("coordinates"))
    lines = shapes.select(F.to_json(F.struct("properties", geometry.alias("geometry"))).alias("value"))
    # The coordinates are JSON themselves; they go in as an array, not as quoted text.
    bare = F.regexp_replace("value", r'"coordinates":"(\[[^"]*\])"', r'"coordinates":$1')
    lines.select(bare.alias("value")).write.text(path)
    read = GJ.read_geojson(spark, path, lines=True)
    return read.select("kind", F.col("properties")["name"].alias("name"))


@query("s9_feature_rejects", """
select case doc_id % 4 when 1 then 'not a JSON object' when 2 then 'not a feature' else 'geometry without coordinates' end as reason,
 count(*) as n, cast(sum(doc_id) as bigint) as ids
from {documents} where doc_id % 4 <> 0 group by reason
""")
def _s9_rejects(v):
    """Documents written as feature lines, three of four broken in different ways; the rejects by reason."""
    documents = v("documents")
    spark = documents.sparkSession
    name = F.concat(F.lit('{"properties": {"id": "'), F.col("doc_id").cast("string"), F.lit('"}, '))
    line = (
        F.when(F.expr("doc_id % 4 = 0"), F.concat(name, F.lit('"geometry": {"type": "Point", "coordinates": [1, 2]}}')))
        .when(F.expr("doc_id % 4 = 1"), F.concat(name, F.lit('"geometry": {"type": ')))
        .when(F.expr("doc_id % 4 = 2"), F.concat(name, F.lit('"type": "Topology"}')))
        .otherwise(F.concat(name, F.lit('"geometry": {"type": "Point"}}')))
    )
    path = f"{scratch(spark)}/features"
    documents.select(line.alias("value")).write.text(path)
    ids = F.regexp_extract("line", r'"id": "([0-9]+)"', 1).cast("long")
    rejects = GJ.feature_lines(spark, path)[1]
    return rejects.groupBy("reason").agg(F.count("line").alias("n"), F.sum(ids).alias("ids"))


@query("s10_write_boundary_level", f"""
{boundary._BUILT}
select layer, level, count(distinct feature) as features, count(*) as rings, cast(sum(n) as bigint) as points,
 any_value(s.tol) as tolerance, any_value(s.min_area) as min_area, any_value(s.decimals) as decimals,
 'embeddings' as source, true as compressed from built join specs s using (layer, level) group by layer, level
""")
def _s10(v):
    """All levels written; their counts, settings and whether the files are smaller than their lines."""
    from geoledger.operators.boundaries import build_levels

    shapes = features(v)
    path = f"{scratch(shapes.sparkSession)}/levels"
    manifest = GJ.write_boundary_level(build_levels(shapes), path, source="embeddings")
    return manifest.withColumn("compressed", F.col("stored_bytes") < F.col("raw_bytes")).drop(
        "path", "raw_bytes", "stored_bytes", "attribution"
    )


@query("s11_run_pending", f"""
{_JOB}
select p.* replace (b.name as name), seen as is_active, {_ATTACHED}
from both_sides b join {{places}} p using (id) left join {{names}} n on n.id = b.id
""")
def _s11(v):
    """After a run by hand two snapshots and a broken one between them wait in a landing folder."""
    spark, root, before, after = two_snapshots(v)
    table = StateTable(spark, f"{root}/state")
    broken = write_csv(v("raw_places").select(*K.SOURCE_COLUMNS), f"{root}/broken")
    limits = {"min_rows": 1, "min_large": 1}
    C.collect_job(spark, before, table, snapshot_at=FIRST_AT, allow_missing_names=True, **limits)
    announce(spark, f"{root}/landing", "first", before, FIRST_AT)
    announce(spark, f"{root}/landing", "middle", broken, SECOND_AT)
    announce(spark, f"{root}/landing", "second", after, SECOND_AT)
    stream = run_pending(
        spark,
        f"{root}/landing",
        table,
        f"{root}/stream",
        f"{root}/names",
        min_rows=1,
        min_large=1,
    )
    stream.awaitTermination()
    return table.read().select(*K.SOURCE_COLUMNS, "is_active", *K.ATTACHED_NAME_COLUMNS)
