from __future__ import annotations

import math
import random
import re

from odd import empty_table, odd_rows, odd_table

from geoledger.llm import quality

SF = "/root/testdata/sf0.01"


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_statistics_equal_plain_ones():
    rng = random.Random(2)
    parts = ["a", "b", "é🙂", " ", " ", " ", "\n", "\t", "\x0b", "　", "#", "|", "<", "\x1c"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 80)))
        assert quality.statistics(text)[:5] == plain(text), text
    assert quality.statistics(None)[:5] == plain(None)


def test_model_finds_planted_accuracies():
    rng = random.Random(1)
    counts = {}
    for _ in range(20_000):
        good = rng.random() < 0.8
        votes = tuple(
            0 if rng.random() < 0.3 else (1 if (rng.random() < a) == good else -1) for a in (0.95, 0.9, 0.85, 0.8)
        )
        counts[votes] = counts.get(votes, 0) + 1
    model = quality.fit(counts)
    assert abs(model.good - 0.8) < 0.05
    assert model.posterior((1, 1, 1, 1)) > 0.95 and model.posterior((-1, -1, -1, -1)) < 0.05
    assert quality.fit({}).posterior((0,) * len(quality.RULES)) > 0.5


def test_verdicts_agree_with_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = quality.assess(docs).collect()
    judged = [(r["kept"], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(kept == bool(label) for kept, label in judged) > 0.98 * len(judged)
    for r in rows:
        own = plain(r["text"])
        assert tuple(r[n] for n in quality.STAT_NAMES[:5]) == own
        assert r["base_failed"] == (own[0] < 20 or 100 * own[4] > 30 * own[0])
        assert not (r["kept"] and r["base_failed"])


def test_odd_rows(spark):
    table = odd_table(spark)
    rows = quality.assess(table).collect()
    assert len(rows) == len(odd_rows())
    assert all(r["base_failed"] and not r["kept"] for r in rows if not (r["text"] or "").strip())
    assert rows[0]["rid"] == "c6" and rows[0]["_stats"] == table.collect()[0]["_stats"]
    assert quality.assess(empty_table(spark)).count() == 0


def plain_posteriors(rows, rounds=200):
    """Expectation-maximisation text by text, in plain numbers: the chance that each is good."""
    n_rules = len(rows[0])
    bad = [0.9 if -1 in votes else 0.05 for votes in rows]
    for _ in range(rounds):
        good = min(max((sum(1 - b for b in bad) + 9) / (len(rows) + 10), 0.05), 0.99)
        odds = [math.log(good / (1 - good))] * len(rows)
        for k in range(n_rules):
            on_good, on_bad = {-1: 0.1, 0: 9.0, 1: 0.9}, {-1: 3.0, 0: 6.5, 1: 0.5}
            for votes, b in zip(rows, bad, strict=True):
                on_good[votes[k]] += 1 - b
                on_bad[votes[k]] += b
            all_good, all_bad = sum(on_good.values()), sum(on_bad.values())
            for i, votes in enumerate(rows):
                odds[i] += math.log(on_good[votes[k]] / all_good * all_bad / on_bad[votes[k]])
        old, bad = bad, [1 / (1 + math.exp(max(-700.0, min(700.0, o)))) for o in odds]
        if max(abs(a - b) for a, b in zip(old, bad, strict=True)) < 1e-9:
            break
    return [1 - b for b in bad]


def test_posteriors_and_verdicts_equal_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = quality.assess(docs.select("doc_id", "text")).collect()
    want = plain_posteriors([r["votes"] for r in rows])
    for r, p in zip(rows, want, strict=True):
        assert abs(r["quality"] - p) < 1e-6
        if abs(p - quality.KEEP_FROM) > 1e-6:
            assert r["kept"] == (not r["base_failed"] and p >= quality.KEEP_FROM)
    assert 0 < sum(r["kept"] for r in rows) < len(rows)
