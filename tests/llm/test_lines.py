from __future__ import annotations

import random
import re

from odd import empty_table, odd_rows, odd_table
from pyspark.sql import functions as F

from geoledger.llm import lines

LEAST = 6


def words_of(line):
    return len(re.findall(r"[^\x20\x09-\x0D]+", line))


def plain(rows, least):
    """Deleted lines by row: windows equal to an earlier one, extended along the first of them."""
    first, windows, texts = {}, [], dict(rows)
    for key, text in rows:
        parts = text.split("\n") if text is not None else []
        for a in range(len(parts)):
            total, b = 0, a
            while words_of(parts[a]) and b < len(parts):
                total += words_of(parts[b])
                if total >= least:
                    windows.append((key, a, b, tuple(parts[a : b + 1])))
                    first.setdefault(windows[-1][3], (key, a))
                    break
                b += 1
    gone = {key: set() for key, _ in rows}
    for key, a, b, content in windows:
        there, at = first[content]
        if (there, at) == (key, a):
            continue
        own, other = texts[key].split("\n"), texts[there].split("\n")
        low, high, back, ahead = a, b, at, at + b - a
        while low and back and own[low - 1] == other[back - 1]:
            low, back = low - 1, back - 1
        while high + 1 < len(own) and ahead + 1 < len(other) and own[high + 1] == other[ahead + 1]:
            high, ahead = high + 1, ahead + 1
        gone[key] |= set(range(low, high + 1))
    return gone


def test_equals_a_plain_version(spark):
    rng = random.Random(5)
    gaps = [" ", " ", " ", "  ", "\t", " \t "]
    pool = ["".join(rng.choice("abcdefgh") + rng.choice(gaps) for _ in range(rng.randint(1, 4))) for _ in range(14)]
    pool += ["", "", " ", "\t\t", "\xa0"]
    docs = []
    for _ in range(70):
        if docs and rng.random() < 0.35:
            parts = rng.choice(docs).split("\n")
            k = rng.randrange(len(parts))
            docs.append("\n".join(parts[:k] + [rng.choice(pool) for _ in range(rng.randint(0, 3))] + parts[k:]))
        else:
            docs.append("\n".join(rng.choice(pool) for _ in range(rng.randint(1, 18))))
    rows = [*enumerate([*docs, None, "", docs[0]])]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in lines.dedup_lines(table, least=LEAST).collect()}
    gone = plain(rows, LEAST)
    assert sum(map(len, gone.values())) > 100
    for key, text in rows:
        parts = text.split("\n") if text is not None else []
        left = "\n".join(x for k, x in enumerate(parts) if k not in gone[key]) if text is not None else None
        assert (got[key]["text"], got[key]["n_lines"], got[key]["n_deleted"]) == (left, len(parts), len(gone[key]))


def test_odd_rows(spark):
    rows = lines.dedup_lines(odd_table(spark)).collect()
    assert len(rows) == len(odd_rows()) and rows[0]["rid"] == "c6"
    assert {r["n_deleted"] for r in rows if r["doc_id"] == 6} == {0}
    assert {(r["n_deleted"], r["text"]) for r in rows if r["doc_id"] == 7} == {(1, "")}
    assert {r["text"] for r in rows if r["doc_id"] == 2} == {None}
    assert lines.dedup_lines(empty_table(spark)).count() == 0


def test_words_are_runs_of_characters_not_spaces(spark):
    texts = ["a" + " " * 49 + "b", " \t a \t\x0b b\t\tc \r", "a b", "a  b", "\t \x0c", "", "x  " * 40]
    counted = spark.createDataFrame([(t,) for t in texts], "t string").select("t", lines.words_of(F.col("t")).alias("n"))
    expected = {t: len([w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]) for t in texts}
    assert {r["t"]: r["n"] for r in counted.collect()} == expected


def test_aligned_lines_of_few_words_stay(spark):
    head = "name" + " " * 30 + "count\n" + "\n".join(f"row{k}" + "\t" * 15 + f"{k}" for k in range(3))
    rows = [(1, head + "\nfirst text"), (2, head + "\nsecond text"), (3, "a" + " " * 49 + "b"), (4, "a" + " " * 49 + "b")]
    long = "   ".join(f"w{k}" for k in range(lines.RUN_WORDS))
    rows += [(5, long + "\nfive"), (6, long + "\nsix")]
    got = {r["doc_id"]: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: r["n_deleted"] for k, r in got.items()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1}
    assert got[2]["text"] == rows[1][1] and got[6]["text"] == "six"


def test_long_runs_of_blank_lines(spark):
    import time

    words = " ".join(f"w{k}" for k in range(LEAST))
    blank = "\n" * 100_000
    rows = [(1, f"{words}{blank}tail a"), (2, f"head b\n{words}{blank}end c"), (3, blank), (4, f"{blank}\n{words}\n\n")]
    started = time.time()
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in lines.dedup_lines(table, least=LEAST).collect()}
    assert time.time() - started < 60
    assert got[1]["n_deleted"] == 0 and got[3]["n_deleted"] == 0
    assert got[2]["n_deleted"] == 100_000 and got[2]["text"] == "head b\nend c"
    assert got[4]["n_deleted"] == 3 and got[4]["text"] == blank
