from __future__ import annotations

import random

import numpy as np
import public_tokenizers
from odd import CLASHES, empty_table, odd_rows, odd_table
from pyspark.sql import functions as F
from test_words import PARTS

from geoledger.llm import prefixes
from geoledger.llm.words import tokenizer

BYTES = public_tokenizers.path("byte_bpe_50k.json")
MORE = ["<|endof", "'re", "'r", " something", "unbelievable", " internationally", "====", "----", "        ", "ÃÂÃÂ", "²", "Ⅷ", "_", "\x1d", "ǅ"]


def count(text: str) -> int:
    return len(tokenizer(BYTES).encode(text, add_special_tokens=False).ids)


def test_every_prefix_has_the_count_of_its_own_encoding():
    rng, counter = random.Random(2), prefixes.prefixes(BYTES)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS + MORE) for _ in range(rng.randint(0, 14)))
        steps = np.frombuffer(counter.steps(text), "i1")
        assert np.cumsum(steps).tolist() == [count(text[: k + 1]) for k in range(len(text))], text


def test_memories_may_be_forgotten(monkeypatch):
    for name in ("KEPT_PAIRS", "KEPT_PREFIXES", "KEPT_ENDINGS"):
        monkeypatch.setattr(prefixes, name, 3)
    monkeypatch.setattr(prefixes, "KEPT_BYTES", 1000)
    rng, counter = random.Random(3), prefixes.Prefixes(BYTES)
    for _ in range(200):
        text = "".join(rng.choice(PARTS + MORE) for _ in range(12))
        assert np.frombuffer(counter.steps(text), "i1").sum() == count(text)
        assert len(counter.known) + len(counter.known.older) <= 12


def test_stored_counts_answer_prefixes_and_budgets():
    rng, counter = random.Random(4), prefixes.prefixes(BYTES)
    for size in (0, 5, 900, 1500):
        text = "".join(rng.choice(PARTS + MORE) for _ in range(size))
        steps = counter.steps(text)
        marks = prefixes.stored_counts(steps)
        counts = [0, *np.cumsum(np.frombuffer(steps, "i1"), dtype="i8").tolist()]
        for k in [0, 1, len(text) // 2, len(text), len(text) + 5, *range(0, len(text), 97)]:
            assert prefixes.count_at(steps, marks, k) == counts[min(k, len(text))]
        for budget in [0, 1, 2, 50, counts[-1] - 1, counts[-1], counts[-1] + 1, rng.randint(0, 2000)]:
            want = max(k for k, c in enumerate(counts) if c <= max(budget, 0)) if budget >= 0 else 0
            assert prefixes.longest_within(steps, marks, budget) == want


def test_odd_rows(spark):
    done = prefixes.with_prefix_counts(odd_table(spark), BYTES, limit=30)
    assert [c for c in done.columns if c in CLASHES] == CLASHES
    rows = done.select("doc_id", "text", "n_bytes", "n_tokens", "over_limit", "limit_chars").collect()
    want = [(k, t, len((t or "").encode()), count(t or "")) for k, t in odd_rows()]
    assert sorted(map(repr, [tuple(r)[:4] for r in rows])) == sorted(map(repr, want))
    for r in rows:
        text = r["text"] or ""
        assert r["over_limit"] == (r["n_tokens"] > 30)
        assert count(text[: r["limit_chars"]]) <= 30
        assert r["limit_chars"] == len(text) or count(text[: r["limit_chars"] + 1]) > 30
    assert prefixes.with_prefix_counts(empty_table(spark), BYTES).count() == 0


def test_truncation_from_stored_counts(spark):
    done = prefixes.with_prefix_counts(odd_table(spark), BYTES)
    seen = prefixes.tokens_of_prefix(F.col("prefix_steps"), F.col("prefix_marks"), F.lit(11).cast("long"))
    short = prefixes.truncated(done.withColumn("whole", F.col("text")).withColumn("seen", seen), F.lit(7))
    for r in short.select("whole", "text", "seen").collect():
        if r["whole"] is None:
            assert r["text"] is None
        else:
            assert r["whole"].startswith(r["text"]) and count(r["text"]) <= 7
        assert r["seen"] == count((r["whole"] or "")[:11])
