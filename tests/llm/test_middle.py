from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from odd import CLASHES, empty_table, odd_rows, odd_table
from pyspark.sql import functions as F

from geoledger.llm import middle

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain(key, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'null' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    p, q = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    prefix, mid, suffix = ("".join(x) for x in (units[:p], units[p:q], units[q:]))
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return n, "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


@pytest.mark.parametrize("error", [0, 1, 5, 127])
def test_every_offset_is_looked_up_exactly(error):
    rng = random.Random(error)
    for size in (0, 1, 2, 3, 50, 4000, 60_000):
        text = "".join(rng.choice(["a", "b" * rng.randint(1, 900), " ", "é", "🙂", "\n"]) for _ in range(size))
        offsets = middle.boundaries(np.frombuffer(text.encode(), "u1"))
        want = np.cumsum([0, *map(len, UNIT.findall(text))])
        assert (offsets == want).all()
        knots, at, residuals = middle.fit(offsets, error)
        assert np.abs(residuals.astype(int)).max() <= error
        ranks = np.arange(len(offsets))
        assert (middle.look_up(knots, at, residuals, ranks) == offsets).all()


def test_even_units_need_two_knots():
    knots, _, residuals = middle.fit(np.arange(0, 700_001, 7))
    assert len(knots) == 2 and not residuals.any()


def test_odd_rows_and_brute_force(spark):
    got = middle.fill_in_middle(odd_table(spark))
    assert [c for c in got.columns if c in CLASHES] == CLASHES
    back = middle.restored(F.col("output"), F.col("form")).alias("back")
    rows = got.select("doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", back).collect()
    assert sorted(map(repr, [(r[0], *r[2:7]) for r in rows])) == sorted(map(repr, [(k, *plain(k, t)) for k, t in odd_rows()]))
    assert all(r["back"] == (r["text"] or "") for r in rows)
    assert middle.fill_in_middle(empty_table(spark)).count() == 0


def test_random_texts(spark):
    rng = random.Random(8)
    parts = ["a", "Bc", " ", "<", "P", ">", "<S", "M>", "<M>", "é", "🙂", "\n", "1", ""]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for k in range(600)]
    got = middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"))
    back = middle.restored(F.col("output"), F.col("form")).alias("back")
    for r in got.select("*", back).collect():
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain(r["doc_id"], r["text"])
        assert r["back"] == r["text"]
