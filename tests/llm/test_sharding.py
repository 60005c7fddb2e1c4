from __future__ import annotations

import zlib

from odd import empty_table, odd_rows, odd_table

from geoledger.llm import sharding
from pyspark.sql import functions as F


def test_one_more_shard_takes_rows_only_into_itself(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    both = sharding.assign(sharding.assign(rows, "doc_id", [1.0] * 24), "doc_id", [1.0] * 25, "grown")
    moved = both.where("shard <> grown")
    assert moved.where("grown <> 24").count() == 0
    assert 600 < moved.count() < 1000
    counts = [r["count"] for r in both.groupBy("shard").count().collect()]
    assert len(counts) == 24 and min(counts) > 700 and max(counts) < 970


def test_weights_share_rows_in_proportion(spark):
    rows = spark.range(30_000).withColumnRenamed("id", "doc_id")
    got = {r["shard"]: r["count"] for r in sharding.assign(rows, "doc_id", [1.0, 2.0, 0.0, 3.0]).groupBy("shard").count().collect()}
    assert set(got) == {0, 1, 3} and abs(got[1] / got[0] - 2) < 0.15 and abs(got[3] / got[0] - 3) < 0.2


def test_numbers_have_no_gaps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_A_BUCKET", 50)
    monkeypatch.setattr(sharding, "COPIES_A_TASK", 7)
    rows = spark.range(3000).select((F.col("id") % 5).alias("g"), F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
    got = sharding.numbered(rows, "g", ["k"]).collect()
    for g in range(5):
        slots = sorted(r["slot"] for r in got if r["g"] == g)
        assert slots == list(range(600))
    assert sorted((r["g"], r["k"]) for r in got) == sorted((r["g"], r["k"]) for r in rows.collect())


def test_odd_rows(spark):
    placed = sharding.assign(odd_table(spark), "doc_id", [1.0] * 4)
    assert placed.count() == len(odd_rows()) and "kept" in placed.columns
    assert placed.where("doc_id is null").select("shard").distinct().count() == 1
    assert sharding.numbered(placed, "shard", ["doc_id", "text"]).count() == len(odd_rows())
    empty = sharding.assign(empty_table(spark), "doc_id", [1.0])
    assert sharding.numbered(empty, "shard", ["doc_id"]).count() == 0


def test_query_over_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = sharding.op3_rendezvous_sharding(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 8, zlib.crc32(data), "key")


def test_written_shards(spark, tmp_path):
    sharding.write_shards(odd_table(spark), str(tmp_path / "s"), "doc_id", [1.0] * 3, files=2)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(odd_rows())


def test_shards_of_the_query_equal_a_plain_version(spark):
    import math

    sf = "/root/testdata/sf0.001"
    keys = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").distinct()
    hashes = F.array(*[F.xxhash64(F.col("doc_id").cast("string"), F.lit(k)) for k in range(25)])
    drawn = {r["doc_id"]: r["h"] for r in keys.select("doc_id", hashes.alias("h")).collect()}

    def plain(key, shards):
        def score(k):
            u = (((drawn[key][k] % 2**64) >> 11) + 0.5) / 2**53
            return -1.0 / math.log(u), -k

        return -max(score(k) for k in range(shards))[1]

    slots = {}
    for r in sharding.op3_rendezvous_sharding(spark, sf).collect():
        assert (r["shard"], r["grown_shard"]) == (plain(r["doc_id"], 24), plain(r["doc_id"], 25))
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
