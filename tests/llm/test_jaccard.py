from __future__ import annotations

import itertools
import random

import pytest
from odd import empty_table, odd_rows, odd_table

from geoledger.llm import jaccard
from geoledger.llm.graph import components


def plain_set(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain(rows):
    sets = {k: plain_set(t) for k, t in rows}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {k: (len(sets[k]), find(k)) for k in sets}


def corpus(seed):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(400)]
    passage = [rng.choice(pool) for _ in range(40)]
    docs = []
    for _ in range(14):
        base = [rng.choice(pool) for _ in range(rng.choice([3, 5, 6, 7, 8, 9, 10, 12, 14, 16, 18, 22, 25, 30, 40, 60, 120, 250]))]
        for _ in range(rng.choice([1, 2, 6, 25])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.choice([0, 1])] = [rng.choice(pool)] * rng.choice([0, 1])
            docs.append(" ".join(words))
    for k in range(110):
        docs.append(" ".join(passage + [rng.choice(pool) for _ in range(rng.randint(0, 60) if k < 60 else 9)]))
    docs += ["", None, "   ", "a", "A", "a b", "a  b\n"]
    rng.shuffle(docs)
    return [(3 * i, d) for i, d in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, seed):
    rows = corpus(seed)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked(table).collect()}
    assert got == plain(rows)


def test_bounds_hold_for_all_small_sizes():
    for n in range(1, 200):
        for m in jaccard.partners(n):
            o = jaccard.least_overlap(n, m)
            assert 180 * o >= 80 * (n + m) and 180 * (o - 1) < 80 * (n + m)
            if o <= min(n, m):
                assert o >= jaccard.own_least(n)
                assert jaccard.shared_least(n) <= jaccard.slack(m)


def test_boundary_follows_the_sizes():
    assert jaccard.boundary({}) == 1
    assert jaccard.boundary({n: 1000 for n in range(1, 12)}) < jaccard.MOST_LIGHT


def test_one_of_each_component_stays(spark):
    rows = corpus(3)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r["doc_id"] for r in jaccard.one_of_each(table).collect()}
    assert left == {k for k, (_, component) in plain(rows).items() if k == component}


def test_odd_rows(spark):
    rows = jaccard.linked(odd_table(spark)).collect()
    assert len(rows) == len(odd_rows())
    assert {r["component_id"] for r in rows if r["doc_id"] == 7} == {6}
    left = jaccard.one_of_each(odd_table(spark))
    assert left.columns == odd_table(spark).columns
    kept = sorted((r["doc_id"] or -1, len(r["text"] or "")) for r in left.collect())
    prose, long = len(odd_rows()[0][1]), len(odd_rows()[10][1])
    assert kept.count((1, prose)) == 1 and (-1, prose) not in kept and (7, long) not in kept
    assert kept.count((-1, 0)) == 2 and (3, 0) in kept
    assert jaccard.linked(empty_table(spark)).count() == 0
    assert jaccard.one_of_each(empty_table(spark)).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert {got[i] for i in range(41)} == {0} and got[100] == got[90] == 90
