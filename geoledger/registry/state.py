"""Merging snapshots into the current state."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.operators import facets as FC
from geoledger.operators import merge as M
from geoledger.registry import query
from geoledger.session import ensure_checkpoint_dir, written
from geoledger.sources.buckets import BucketedState
from geoledger.sources.state import run_log
from geoledger.streaming import lifecycle as LC

SNAPSHOT_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
_AT = "timestamp '2024-02-01 00:00:00'"
_TIMES = [name for name in K.STATE_COLUMNS if name.endswith("_at")]

_DIFFERS = " or ".join(f"c.{name} is distinct from i.{name}" for name in M.COMPARED)
_EXPIRED = f"i.id is null and c.is_active and c.source_snapshot_at < {_AT}"
_FEED = f"""
select coalesce(c.id, i.id) as id,
 case when c.id is null then 'inserted' when i.id is not null and ({_DIFFERS}) then 'updated'
  when i.id is not null then 'unchanged' when {_EXPIRED} then 'deactivated' else 'absent' end as change,
 i.id is not null and coalesce(not c.is_active, false) as reactivated
from {{current_state}} c full join {{incoming}} i on c.id = i.id
"""


def _merged_column(name: str, at: str = _AT, expired: str = _EXPIRED) -> str:
    lifecycle = {
        "id": "coalesce(c.id, i.id)",
        "name_zh_updated_at": f"case when c.id is null then case when i.name_zh is not null then {at} end"
        f" when i.id is not null and c.name_zh is distinct from i.name_zh then {at}"
        " else c.name_zh_updated_at end",
        "is_active": f"case when i.id is not null then true when {expired} then false else c.is_active end",
        "first_seen_at": f"case when c.id is null then {at} else c.first_seen_at end",
        "last_seen_at": f"case when i.id is not null then {at} else c.last_seen_at end",
        "deactivated_at": f"case when i.id is not null then null when {expired} then {at}"
        " else c.deactivated_at end",
        "updated_at": f"case when c.id is null or (i.id is not null and ({_DIFFERS} or not c.is_active))"
        f" or ({expired}) then {at} else c.updated_at end",
        "source_snapshot_at": f"case when i.id is not null then {at} else c.source_snapshot_at end",
    }
    value = lifecycle.get(name, f"case when i.id is not null then i.{name} else c.{name} end")
    return f"{value} as {name}"


_MERGED = (
    "select " + ", ".join(_merged_column(name) for name in K.STATE_COLUMNS)
    + " from {current_state} c full join {incoming} i on c.id = i.id"
)


def _plain(df):
    """Timestamps without a zone, so the comparison does not depend on the session's zone."""
    return df.withColumns(
        {name: F.col(name).cast("timestamp_ntz") for name in df.columns if name.endswith("_at")}
    )


def merged(v):
    return M.merge_snapshot(v("current_state"), v("incoming"), SNAPSHOT_AT)


@query("j9_merge_join", """
select coalesce(c.id, i.id) as id, c.id is not null as in_state, i.id is not null as in_snapshot,
 c.row_hash as old_hash, i.row_hash as new_hash
from {current_state} c full join {incoming} i on c.id = i.id
""")
def _j9(v):
    joined = M.merge_join(
        v("current_state").select("id", "row_hash"), v("incoming").select("id", "row_hash")
    )
    return joined.select(
        "id",
        F.col("c").isNotNull().alias("in_state"),
        F.col("i").isNotNull().alias("in_snapshot"),
        F.col("c.row_hash").alias("old_hash"),
        F.col("i.row_hash").alias("new_hash"),
    )


@query("m1_merge_snapshot", _MERGED)
def _m1(v):
    return _plain(merged(v))


AGAIN_AT = datetime(2024, 2, 20, tzinfo=timezone.utc)
_AGAIN = "timestamp '2024-02-20 00:00:00'"
_EXPIRED_AGAIN = _EXPIRED.replace(_AT, _AGAIN)


@query(
    "m1_merge_buckets",
    f"with first as ({_MERGED}) select "
    + ", ".join(_merged_column(name, _AGAIN, _EXPIRED_AGAIN) for name in K.STATE_COLUMNS)
    + " from first c full join {incoming} i on c.id = i.id",
)
def _m1_buckets(v):
    """A snapshot merged into a bucketed state and confirmed by an equal one, which writes no rows."""
    current, incoming = v("current_state"), v("incoming")
    spark = current.sparkSession
    state = BucketedState(spark, f"{ensure_checkpoint_dir(spark)}/state-{uuid.uuid4().hex}", buckets=16)
    state.load(current)
    state.merge(incoming, SNAPSHOT_AT)
    state.merge(incoming, AGAIN_AT)
    return _plain(state.read())


@query("m2_deactivate_missing", f"""
select id, is_active and not (source_snapshot_at < {_AT}) as is_active,
 case when is_active and source_snapshot_at < {_AT} then {_AT} else deactivated_at end as deactivated_at,
 case when is_active and source_snapshot_at < {_AT} then {_AT} else updated_at end as updated_at
from {{current_state}}
""")
def _m2(v):
    state = M.deactivate_missing(v("current_state"), SNAPSHOT_AT)
    return _plain(state.select("id", "is_active", "deactivated_at", "updated_at"))


@query("m3_change_feed", _FEED)
def _m3(v):
    return M.change_feed(v("current_state"), v("incoming"), SNAPSHOT_AT)


@query("a1_merge_counts", f"""
select count(*) filter (where change = 'inserted') as inserted,
 count(*) filter (where change = 'updated') as updated,
 count(*) filter (where change = 'unchanged') as unchanged,
 count(*) filter (where change = 'deactivated') as deactivated,
 count(*) filter (where reactivated) as reactivated from ({_FEED})
""")
def a1_merge_counts(v):
    return M.merge_counts(M.change_feed(v("current_state"), v("incoming"), SNAPSHOT_AT))


@query("x1_absent_keys", """
select id from {current_state} where id not in (select id from {incoming})
""")
def _x1(v):
    return M.absent_keys(v("current_state"), v("incoming"))


@query("p13_active", "select id, type, is_active from {current_state} where is_active")
def _p13(v):
    return M.active(v("current_state")).select("id", "type", "is_active")


@query("p20_project_active", f"""
select {', '.join(K.ACTIVE_VIEW_COLUMNS)} from ({_MERGED}) where is_active
""")
def _p20(v):
    return _plain(M.project_active(merged(v)))


_STATS = """
select count(*) as rows_total, count(*) filter (where is_active) as rows_active,
 count(*) filter (where not is_active) as rows_inactive,
 count(*) filter (where is_active and type in ('large_airport', 'medium_airport')) as named_targets,
 count(*) filter (where is_active and type in ('large_airport', 'medium_airport')
  and name_zh is not null) as named_targets_with_zh,
 count(*) filter (where name_zh is not null) as rows_with_zh,
 count(*) filter (where is_active and municipality is not null) as rows_with_municipality,
 count(*) filter (where is_active and municipality is not null and municipality_zh is not null)
  as rows_with_municipality_zh,
 count(*) filter (where is_active and location_zh is not null) as rows_with_location_zh,
 (select max(finished_at) from {runs} where status = 'succeeded') as last_success_at,
 (select max(run_id) from {runs}) as last_run_id,
 (select status from {runs} order by run_id desc limit 1) as last_run_status
from {current_state}
"""


@query("a3_status_stats", _STATS)
def _a3(v):
    return _plain(M.status_stats(v("current_state"), v("runs")))


@query("w5_latest_run", """
select max(finished_at) filter (where status = 'succeeded') as last_success_at,
 max(run_id) as last_run_id, max_by(status, run_id) as last_run_status from {runs}
""")
def _w5(v):
    return _plain(M.latest_run(v("runs")))


@query("m4_run_log", """
with ends as (
 select user_id as run_id, max(ts) filter (where event_type = 'purchase') as ok_at,
  max(ts) filter (where event_type = 'error') as bad_at,
  min(ts) filter (where event_type not in ('purchase', 'error')) as started_at, max(value) as rows_total
 from {events} group by user_id
)
select run_id, case when ok_at is null and bad_at is null then 'running'
 when bad_at is null or ok_at > bad_at then 'succeeded' else 'failed' end as status, started_at,
 greatest(ok_at, bad_at) as finished_at, rows_total from ends
""")
def _m4(v):
    """Runs folded from all their events: purchases and errors end a run, the others are in it."""
    status = (
        F.when(F.col("event_type") == "purchase", "succeeded")
        .when(F.col("event_type") == "error", "failed")
        .otherwise("running")
    )
    events = v("events").select(
        F.col("user_id").alias("run_id"),
        F.col("ts").alias("event_at"),
        status.alias("status"),
        F.col("value").alias("rows_total"),
    )
    return _plain(run_log(events))


_DAYS = [datetime(2024, 2, day, tzinfo=timezone.utc) for day in (1, 2, 3)]
#: What each snapshot leaves out, and the rows that differ in it.
_GONE = ("id % 7 = 0", "id % 5 = 0", "id % 3 = 0 and id % 4 <> 0")
_OTHER = ("id < 0", "id % 11 = 0", "id % 11 in (0, 1)")
_SNAPSHOTS = " union all ".join(
    f"select {n} as n, id, case when {other} then row_hash || '{n}' else row_hash end as row_hash, name_zh,"
    f" municipality_zh, location_zh from {{incoming}} where not ({gone})"
    for n, (gone, other) in enumerate(zip(_GONE, _OTHER, strict=True), 1)
)
_SAME = " and ".join(f"s.{name} is not distinct from p.{name}" for name in M.COMPARED)


@query("s11_lifecycle_feed", f"""
with s as ({_SNAPSHOTS}), before as (
 select s.*, (select max(p.n) from s p where p.id = s.id and p.n < s.n) as prev from s
)
select s.id, case when s.prev is null then 'inserted' when {_SAME} then 'unchanged' else 'updated' end as change,
 s.prev is not null and s.prev < s.n - 1 as reactivated, timestamp '2024-02-01 00:00:00' + to_days(cast(s.n - 1 as integer)) as snapshot_at
from before s left join s p on p.id = s.id and p.n = s.prev
union all
select s.id, 'deactivated', false, timestamp '2024-02-01 00:00:00' + to_days(cast(s.n as integer))
from s where s.n < 3 and not exists (select 1 from s q where q.id = s.id and q.n = s.n + 1)
""")
def _s11_feed(v):
    """Three snapshots landed one after the other, each taken by a stream that starts again from its checkpoint."""
    incoming = v("incoming")
    spark = incoming.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/lifecycle-{uuid.uuid4().hex}"
    for n, (gone, other, at) in enumerate(zip(_GONE, _OTHER, _DAYS, strict=True), 1):
        changed = F.when(F.expr(other), F.concat("row_hash", F.lit(str(n)))).otherwise(F.col("row_hash"))
        LC.take(spark, incoming.where(f"not ({gone})").withColumn("row_hash", changed), folder, at)
    return LC.read_feed(spark, folder).withColumn("snapshot_at", F.col("snapshot_at").cast("timestamp_ntz"))


_FACETS_SQL = "type, continent, iso_country, scheduled_service, name_zh is not null as named"
_SECOND = """select * replace (case when id % 11 = 0 then 'heliport' else type end as type,
  case when id % 13 = 0 then null else name_zh end as name_zh) from {incoming} where id % 5 <> 0"""


@query(
    "a4_facets_by_feed",
    f"with first as ({_MERGED}), other as ({_SECOND}), second as (select "
    + ", ".join(_merged_column(name, _AGAIN, _EXPIRED_AGAIN) for name in K.STATE_COLUMNS)
    + f" from first c full join other i on c.id = i.id) select {_FACETS_SQL}, count(*) as places"
    " from second where is_active group by all",
)
def _a4_facets(v):
    """Counts by facet after two merges, from the counts before them and the deltas of each."""
    current, incoming = v("current_state"), v("incoming")
    other = incoming.where("id % 5 <> 0").withColumns(
        {
            "type": F.when(F.expr("id % 11 = 0"), "heliport").otherwise(F.col("type")),
            "name_zh": F.when(F.expr("id % 13 <> 0"), F.col("name_zh")),
        }
    )
    counts = written(FC.facet_counts(current))
    first = written(FC.facet_deltas(current, incoming, SNAPSHOT_AT))
    merged = written(M.merge_snapshot(current, incoming, SNAPSHOT_AT))
    second = written(FC.facet_deltas(merged, other, AGAIN_AT))
    return FC.apply_deltas(counts, first, second)
