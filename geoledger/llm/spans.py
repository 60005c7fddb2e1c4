"""Spans of pattern matches as array columns, by built-in functions only.

Patterns are written so that Java's matcher stays linear: what cannot be given back is possessive, and a search
starts at the beginning of a run of characters, since no later start in the run can do better.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that are summed one by one; longer arrays are summed by blocks of so many first.
BLOCK = 128
SPAN = "array<struct<start:bigint,end:bigint,hit:string,before:string,after:string>>"
MARK = "array<struct<start:bigint,kind:int,end:bigint>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, also where body uses it for each element of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def sums_before(sizes: Column) -> Column:
    """For each element the sum of those before it."""

    def by_blocks(blocks: Column) -> Column:
        def before(_, i: Column) -> Column:
            block = F.floor(i / BLOCK).cast("int")
            return total(F.slice(blocks, 1, block)) + total(F.slice(sizes, block * BLOCK + 1, i % BLOCK))

        return F.transform(sizes, before)

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")),
        lambda b: total(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))),
    )
    return let(blocks, by_blocks)


def found(text: Column, pattern: str, around: int = 0) -> Column:
    """All matches from left to right: start, end (code points, end exclusive), the match, and so many characters of
    the text between it and its neighbours."""

    def placed(s: Column) -> Column:
        gaps, hits = s["gaps"], s["hits"]

        def spans(before: Column) -> Column:
            def span(hit: Column, i: Column) -> Column:
                gap = F.get(gaps, i)
                start = F.get(before, i) + F.length(gap)
                return F.struct(
                    start.cast("long").alias("start"),
                    (start + F.length(hit)).cast("long").alias("end"),
                    hit.alias("hit"),
                    (F.right(gap, F.lit(around)) if around else F.lit("")).alias("before"),
                    (F.left(F.get(gaps, i + 1), F.lit(around)) if around else F.lit("")).alias("after"),
                )

            return F.transform(hits, span)

        sizes = F.transform(hits, lambda h, i: (F.length(F.get(gaps, i)) + F.length(h)).cast("long"))
        return F.when(F.size(hits) > 0, let(let(sizes, sums_before), spans)).otherwise(
            F.from_json(F.lit("[]"), SPAN)
        )

    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("hits"))
    return let(both, placed)


def none(kind: str = SPAN) -> Column:
    return F.from_json(F.lit("[]"), kind)


def marked(spans: Column, kind: int, keep: Callable[[Column], Column] | None = None) -> Column:
    """Spans of a kind as (start, kind, end), those that `keep` accepts."""
    chosen = F.filter(spans, keep) if keep else spans
    return F.transform(
        chosen, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"))
    )


def count_of(marks: Column, kind: int) -> Column:
    return F.size(F.filter(marks, lambda m: m["kind"] == kind)).cast("long")


def listed(marks: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of each, by start and then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(
        F.transform(
            F.array_sort(marks),
            lambda m: F.concat_ws(":", F.get(names, m["kind"]), m["start"].cast("string"), m["end"].cast("string")),
        ),
        ",",
    )


def overlaps(span: Column, marks: Column) -> Column:
    return F.exists(marks, lambda m: (m["start"] < span["end"]) & (span["start"] < m["end"]))


def masked(text: Column, marks: Column, mask: str) -> Column:
    """The text with each span replaced by a mask, overlapping spans by one."""

    def cut(state: Column, m: Column) -> Column:
        fresh = m["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], m["end"]).alias("at"),
            F.when(
                fresh,
                F.concat(
                    state["out"],
                    F.substring(text, (state["at"] + 1).cast("int"), (m["start"] - state["at"]).cast("int")),
                    F.lit(mask),
                ),
            )
            .otherwise(state["out"])
            .alias("out"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(
        F.array_sort(marks), start, cut, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))
    )
    return F.when(F.size(marks) > 0, rest).otherwise(text)
