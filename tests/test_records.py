from __future__ import annotations

import csv
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from geoledger.operators.quality import DataRejected
from geoledger.sources import records as R
from geoledger.sources.snapshot import read_raw

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    cost = "spark.sql.files.openCostInBytes"
    spark.conf.set(SPLIT, "700")
    spark.conf.set(cost, "0")
    yield
    spark.conf.unset(SPLIT)
    spark.conf.unset(cost)


def text_of(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([("a", "b", "c"), *rows])
    return out.getvalue()


def cells(rng):
    parts = ["x", "yy", "\n", '"', ",", " ", "é", "\n\n", "word "]
    return "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 9])))


def as_rows(df):
    return sorted(map(repr, map(tuple, df.select("a", "b", "c").collect())))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_whole_file_reader(spark, tmp_path, small_splits, end):
    rng = random.Random(len(end))
    for n in range(4):
        rows = [(str(k), cells(rng), cells(rng)) for k in range(90)]
        rows.append(("long", "line\n" * 800, "end"))  # reaches over many splits
        (tmp_path / f"f{n}.csv").write_bytes(text_of(rows, end).encode())
    got = read_raw(spark, str(tmp_path), ["a", "b", "c"])
    want = read_raw(spark, str(tmp_path), ["a", "b", "c"], multi_line=True)
    assert as_rows(got) == as_rows(want) and want.count() == 4 * 91
    lines = R.placed_lines(spark, str(tmp_path))
    assert lines.select("path", "block").distinct().count() > 20


def test_ragged_rows_and_wrong_headers(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b,c\n1,"x\ny",z\n2,short\n\n3,"p","q"\n')
    got = read_raw(spark, str(tmp_path), ["a", "b", "c"])
    assert [r["a"] for r in got.where("_bad IS NULL").orderBy("a").collect()] == ["1", "3"]
    assert [r["_bad"] for r in got.where("_bad IS NOT NULL").collect()] == ["2,short"]
    (tmp_path / "two.csv").write_text("a,c,b\n1,2,3\n")
    with pytest.raises(DataRejected, match="header"):
        read_raw(spark, str(tmp_path), ["a", "b", "c"])


def test_marks_that_do_not_pair_up_are_refused(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b,c\n1,"x,y\n')
    with pytest.raises(DataRejected, match="pair up"):
        read_raw(spark, str(tmp_path), ["a", "b", "c"])


def test_offsets_and_ordered_digests(spark, tmp_path, small_splits, monkeypatch):
    monkeypatch.setattr(R, "RANGE_BYTES", 400)
    monkeypatch.setattr(R, "FOLD", 3)
    lines = [f"line {k} é" for k in range(300)]
    (tmp_path / "f.txt").write_text("\n".join(lines) + "\n")
    placed = R.placed_lines(spark, str(tmp_path))
    at = 0
    for r in placed.orderBy("offset").collect():
        assert r["offset"] == at
        at += len(r["value"].encode()) + 1
    root = R.ordered_digest(placed).collect()
    spark.conf.set(SPLIT, "1900")
    assert R.ordered_digest(R.placed_lines(spark, str(tmp_path))).collect() == root
    lines[7], lines[250] = lines[250], lines[7]
    (tmp_path / "f.txt").write_text("\n".join(lines) + "\n")
    assert R.ordered_digest(R.placed_lines(spark, str(tmp_path))).first()[1] != root[0][1]
    assert placed.agg(F.count("*")).first()[0] == 300


def plain_root(text, size, fold):
    """Ranges of lines by where they start, hashed and folded in order."""
    ranges, at = {}, 0
    for line in text.removesuffix(b"\n").split(b"\n"):
        ranges.setdefault(at // size, []).append(line)
        at += len(line) + 1
    level = {n: hashlib.sha256(b"\n".join(found)).hexdigest() for n, found in sorted(ranges.items())}
    while True:
        most, above = max(level), {}
        for n, found in level.items():
            above[n // fold] = above.get(n // fold, "") + found
        level = {n: hashlib.sha256(found.encode()).hexdigest() for n, found in above.items()}
        if most < fold:
            return level[0]


@pytest.mark.parametrize("piece", [64, 90, 5000])
def test_ranges_are_folded_in_order(spark, tmp_path, small_splits, monkeypatch, piece):
    monkeypatch.setattr(R, "RANGE_BYTES", 400)
    monkeypatch.setattr(R, "FOLD", 3)
    monkeypatch.setattr(R, "PIECE_BYTES", piece)
    lines = [f"line {k} é" * (k % 4) + "\r" * (k % 5 == 0) for k in range(300)]
    lines[40], lines[200] = "long " * 700, ""  # longer than a range, and than the splits
    want = {}
    for name, some in (("f", lines), ("g", lines[250:]), ("h", [*lines[150:], *lines[:150]])):
        text = ("\n".join(some) + "\n").encode()
        (tmp_path / f"{name}.txt").write_bytes(text)
        want[f"{name}.txt"] = plain_root(text, 400, 3)
    # All files fold as often as the longest needs.
    small = want.pop("g.txt")
    got = {path[-5:]: root for path, root in R.ordered_digest(R.placed_lines(spark, str(tmp_path))).collect()}
    assert {name: got[name] for name in want} == want
    alone = R.ordered_digest(R.placed_lines(spark, str(tmp_path / "g.txt"))).collect()
    assert [r["tree_sha256"] for r in alone] == [small]


def test_whole_ranges_swapped_give_another_root(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "RANGE_BYTES", 400)
    halves = ["a" * 399, "b" * 399]
    roots = []
    for n, some in enumerate((halves, halves[::-1])):
        (tmp_path / f"f{n}.txt").write_text("\n".join(some) + "\n")
        roots.append(R.ordered_digest(R.placed_lines(spark, str(tmp_path / f"f{n}.txt"))).first()["tree_sha256"])
    assert roots[0] != roots[1]


def test_no_more_than_a_piece_is_collected_from_lines(spark, tmp_path, monkeypatch):
    """Whole ranges of short lines, 128 of them a task, filled the executors' memory."""
    monkeypatch.setattr(R, "PIECE_BYTES", 1000)
    lines = [f"{k}:{k % 7}" for k in range(5000)]
    (tmp_path / "f.txt").write_text("\n".join(lines) + "\n")
    placed = R.placed_lines(spark, str(tmp_path))
    cut = R.pieces(placed).orderBy("offset").collect()
    assert "\n".join(r["value"] for r in cut) == "\n".join(lines)
    assert max(len(r["value"]) for r in cut) < 1000 + max(map(len, lines)) and len(cut) > 30
    # Lines are not dealt out again for it.
    plan = R.pieces(placed)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(path" in plan and "range" not in "".join(x for x in plan.split("\n") if "Exchange" in x)
