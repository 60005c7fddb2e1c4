from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from geoledger.operators import facets as FC
from geoledger.operators import merge as M
from geoledger.session import written
from geoledger.sources.state import STATE_SCHEMA

START = datetime(2024, 5, 1, tzinfo=timezone.utc)


def incoming(spark, rng):
    rows = [
        (n, rng.choice(["a", "b", None]), rng.choice(["x", "y"]), rng.choice([None, "名"]), rng.choice("pq"))
        for n in range(30)
        if rng.random() < 0.7
    ]
    made = spark.createDataFrame(rows, "id long, type string, iso_country string, name_zh string, row_hash string")
    more = [c for c in M.INCOMING_COLUMNS if c not in made.columns]
    return made.select("*", *[F.lit(None).cast(STATE_SCHEMA[c].dataType).alias(c) for c in more])


def rows_of(df):
    return sorted(map(repr, df.select(*FC.FACETS, "places").collect()))


def test_counts_kept_up_by_deltas_equal_a_recount(spark):
    rng = random.Random(3)
    state = spark.createDataFrame([], STATE_SCHEMA)
    counts = FC.facet_counts(state)
    for turn in (1, 2, 2, 1, 5):  # also an older snapshot, and one at the same time
        rows, at = written(incoming(spark, rng)), START + timedelta(days=turn)
        deltas = written(FC.facet_deltas(state, rows, at))
        state = written(M.merge_snapshot(state, rows, at))
        counts = written(FC.apply_deltas(counts, deltas))
        assert rows_of(counts) == rows_of(FC.facet_counts(state))
    assert FC.facet_deltas(state, rows, at).count() == 0
    by_type = {r["type"]: r["places"] for r in FC.counts_by(counts, "type").collect()}
    want = {r["type"]: r["count"] for r in state.where("is_active").groupBy("type").count().collect()}
    assert by_type == want
    assert FC.counts_by(counts, "type", only=["a"]).count() == 1


def test_the_update_reads_counts_and_deltas_only(spark):
    counts, deltas = (written(FC.facet_counts(spark.createDataFrame([], STATE_SCHEMA))) for _ in range(2))
    plan = FC.apply_deltas(counts, deltas)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2 and "Join" not in plan
