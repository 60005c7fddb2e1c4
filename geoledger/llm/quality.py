"""Weak supervision of text quality.

Rules vote good or bad on a text, or abstain. Expectation-maximisation over the counts of all vote patterns estimates
how often each rule is right on good and on bad texts, and the share of good texts; no labels are read. A text is kept
by its posterior probability of being good, so one lenient or wrong rule does not decide.

The model sees the corpus as counts of patterns. There are at most three to the power of the number of rules of them,
whatever the size of the corpus, which bounds what reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoledger.llm.rows import documents, keeping, ship, stored, text_of

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
WINDOW = 8
STAT_NAMES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_ended_lines",
    "n_upper_words",
    "n_bangs",
    "n_distinct_words",
    "n_marks",
    "n_bare_words",
]
STATS = T.StructType([T.StructField(name, T.LongType()) for name in STAT_NAMES])
#: A kept text is good with at least this probability.
KEEP_FROM = 0.5
OWN = [*STAT_NAMES, "votes", "quality", "base_failed", "kept"]


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words inside windows of so many words that occur twice or more."""
    import numpy as np

    n = len(words)
    if n <= window:
        return 0
    codes = np.fromiter(map(hash, words), "i8", n)
    rolled = np.zeros(n - window + 1, "i8")
    for k in range(window):
        rolled = rolled * np.int64(-7046029254386353131) + codes[k : n - window + 1 + k]
    order = np.sort(rolled)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    # Equal windows have equal hashes; here the words themselves decide.
    suspects = np.flatnonzero(np.isin(rolled, twice)).tolist()
    seen: dict[tuple, list[int]] = {}
    for i in suspects:
        seen.setdefault(tuple(words[i : i + window]), []).append(i)
    edges = np.zeros(n + 1, "i8")
    for places in seen.values():
        if len(places) > 1:
            at = np.asarray(places)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges)[:n] > 0).sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The counts named in STAT_NAMES, for one whole text; a null text has none of anything."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lettered = data.translate(None, MARKS)
    lines = [x for x in data.split(b"\n") if x.strip(SPACE)]
    return (
        len(words),
        len(text) - (len(data) - len(data.translate(None, SPACE))),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(x.rstrip(SPACE)[-1:] in (b".", b"!", b"?", b":", b";") for x in lines),
        sum(map(bytes.isupper, words)),
        data.count(b"!"),
        len(set(words)),
        len(data) - len(lettered),
        len(words) - len(lettered.split()),
    )


@F.pandas_udf(STATS)
def measured(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([statistics(t) for t in text], columns=STAT_NAMES)


@dataclass(frozen=True)
class Rule:
    """A text is bad where `bad` holds, else good where `good` holds; else the rule abstains."""

    name: str
    bad: str
    good: str

    def vote(self) -> Column:
        return F.when(F.expr(self.bad), -1).when(F.expr(self.good), 1).otherwise(0)


NEVER = "false"
#: Each kind of fault is looked for by two rules or more, since agreement is what the model learns from. A rule that
#: looks for a fault abstains where it finds none; only signs of ordinary prose vote good.
RULES = (
    Rule("short", "n_words < 20", NEVER),
    Rule("repeats", "100 * n_repeat_words > 30 * n_words", NEVER),
    Rule("variety", "n_words >= 25 AND 100 * n_distinct_words < 30 * n_words", NEVER),
    Rule("lines", "100 * n_dup_lines > 30 * n_lines", NEVER),
    Rule("symbols", "100 * n_symbols > 10 * n_words", NEVER),
    Rule("marks", "100 * n_marks > 12 * word_chars", NEVER),
    Rule("bare", "100 * n_bare_words > 10 * n_words", NEVER),
    Rule("upper", "100 * n_upper_words > 40 * n_words", NEVER),
    Rule("bangs", "100 * n_bangs > 30 * n_words", NEVER),
    Rule("ends", "n_lines >= 5 AND 100 * n_ended_lines < 10 * n_lines", "100 * n_ended_lines >= 60 * n_lines"),
    Rule("size", "word_chars < 2 * n_words OR word_chars > 14 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
)


@dataclass(frozen=True)
class Model:
    """The share of good texts, and by rule how often it votes bad, abstains or votes good on good and on bad texts."""

    good: float
    on_good: tuple[tuple[float, float, float], ...]
    on_bad: tuple[tuple[float, float, float], ...]

    def start(self) -> float:
        return math.log(self.good / (1 - self.good))

    def weights(self) -> list[tuple[float, float, float]]:
        """By rule the log odds that its vote -1, 0 or 1 adds for a good text."""
        return [
            tuple(math.log(g / b) for g, b in zip(*rule, strict=True))
            for rule in zip(self.on_good, self.on_bad, strict=True)
        ]

    def accuracies(self) -> list[tuple[float, float]]:
        """By rule the probability that a text is bad if it says bad, and good if it says good."""
        out = []
        for g, b in zip(self.on_good, self.on_bad, strict=True):
            bad, good = (1 - self.good) * b[0], self.good * g[2]
            out.append((bad / (bad + self.good * g[0]), good / (good + (1 - self.good) * b[2])))
        return out

    def posterior(self, votes: Sequence[int]) -> float:
        odds = self.start() + sum(w[v + 1] for w, v in zip(self.weights(), votes, strict=True))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def fit(counts: dict[tuple[int, ...], int], rounds: int = 200) -> Model:
    """Expectation-maximisation over counts of vote patterns.

    It starts from the belief that a text is bad with 0.9 if any rule says so, else with 0.05. Ten texts that follow
    this belief are added to the counts of each rule, which settles rules that never vote; an empty corpus gives that
    belief alone.
    """
    import numpy as np

    patterns = sorted(counts)
    n_rules = len(patterns[0]) if patterns else len(RULES)
    votes = np.array(patterns, int).reshape(-1, n_rules)
    weight = np.array([counts[p] for p in patterns], float)
    bad = np.where((votes < 0).any(axis=1), 0.9, 0.05)
    belief_good, belief_bad = np.array([0.1, 9.0, 0.9]), np.array([3.0, 6.5, 0.5])
    hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    good, on_good, on_bad = 0.9, None, None
    for _ in range(rounds):
        old = bad
        good = float(np.clip(((weight * (1 - bad)).sum() + 9) / (weight.sum() + 10), 0.05, 0.99))
        on_good = np.einsum("p,prv->rv", weight * (1 - bad), hot) + belief_good
        on_bad = np.einsum("p,prv->rv", weight * bad, hot) + belief_bad
        on_good /= on_good.sum(axis=1, keepdims=True)
        on_bad /= on_bad.sum(axis=1, keepdims=True)
        odds = np.log(good / (1 - good)) + np.einsum("prv,rv->p", hot, np.log(on_good / on_bad))
        bad = 1 / (1 + np.exp(np.clip(odds, -700, 700)))
        if not len(bad) or np.abs(bad - old).max() < 1e-9:
            break
    return Model(good, tuple(map(tuple, on_good.tolist())), tuple(map(tuple, on_bad.tolist())))


def with_votes(rows: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Rows with a column `text`, with the counts of it and the rules' votes."""
    ship(rows.sparkSession)
    wide = rows.withColumn("_stats", measured(text_of("text"))).select("*", "_stats.*").drop("_stats")
    return wide.withColumn("votes", F.array(*[r.vote().cast("int") for r in rules]))


def fit_votes(voted: DataFrame) -> Model:
    """The model of a table with votes. The driver gets one row a pattern, of which there are at most 3 ** rules."""
    counted = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    return fit({tuple(r["votes"]): r["n"] for r in counted})


def judged(voted: DataFrame, model: Model) -> DataFrame:
    """All rows with the posterior quality, the fixed base rule and the verdict."""
    odds = F.lit(model.start())
    for k, (no, none, yes) in enumerate(model.weights()):
        vote = F.col("votes")[k]
        odds = odds + F.when(vote < 0, no).when(vote > 0, yes).otherwise(none)
    failed = (F.col("n_words") < 20) | (F.lit(100) * F.col("n_repeat_words") > F.lit(30) * F.col("n_words"))
    return (
        voted.withColumn("quality", 1 / (1 + F.exp(-odds)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM))
    )


def assess(df: DataFrame, text: str = "text") -> DataFrame:
    """All rows with their counts, votes, quality, base_failed and kept.

    A null text has no words and fails; equal texts get equal verdicts. Input columns of these names are replaced, the
    others stay; an empty table stays empty. Rows with their votes are stored once, fitted and judged from there.
    """

    def body(rows: DataFrame) -> DataFrame:
        voted = stored(with_votes(rows))
        return judged(voted, fit_votes(voted))

    return keeping(df, {"text": text}, body, OWN)


def op1_weak_supervision(spark, sf_dir: str) -> DataFrame:
    """Counts, the base rule and the weak-supervision verdict of all documents."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    # The text is left behind before the counts are stored.
    voted = stored(with_votes(docs).drop("text"))
    return judged(voted, fit_votes(voted)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )
