"""Tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

from __future__ import annotations

CLASHES = ["shard", "slot", "kept", "votes", "quality", "n_lines", "rid", "owner", "runs", "own", "hash", "key", "box", "secret_base", "pii_spans", "component", "sid", "_row", "_stats"]

LONG = " ".join(f"long{i % 977} word{i % 31}." for i in range(20_000))


def odd_rows() -> list[tuple[int | None, str | None]]:
    prose = "One plain line of words that is quite long enough to be kept by any rule at all.\n" * 3
    return [
        (1, prose),
        (1, prose),
        (1, "another text under the same key"),
        (2, None),
        (None, prose),
        (None, None),
        (None, None),
        (3, ""),
        (4, " \n\t "),
        (5, "é 🙂 ß　x​"),
        (6, LONG),
        (7, LONG),
        (8, "x" * 100_000),
        (9, "1" * 50_000 + " token=abcdef123456"),
    ]


def odd_table(spark):
    rows = [(k, t, "en", None, *[f"c{i}" for i in range(len(CLASHES))]) for k, t in odd_rows()]
    names = ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {names}")


def empty_table(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
