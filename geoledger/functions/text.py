"""Column functions on text: cleaning, strict parsing, titles, labels and composed names."""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoledger import constants as K

_INTEGER = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Remove white space of any kind from both ends."""
    return F.trim(_col(value), F.lit(K.WHITESPACE))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_col(value), F.lit(""))


def clean(value: Column | str) -> Column:
    """Stripped text, NULL when nothing is left."""
    return blank_to_null(strip(value))


def parse_long(value: Column | str) -> Column:
    """A strict whole number; NULL for anything else."""
    text = strip(value)
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def parse_optional_double(value: Column | str) -> Column:
    """A finite decimal or exponent number; NULL for blank or anything else."""
    text = strip(value)
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def parse_optional_int(value: Column | str) -> Column:
    """A number cut toward zero; NULL for blank, bad or too large input."""
    return parse_optional_double(value).try_cast("int")


def parse_point(wkt: Column | str) -> Column:
    """`Point(lon lat)` as STRUCT<lat, lon>; NULL when the text holds no point."""
    text = _col(wkt)
    lon = F.regexp_extract(text, K.POINT_PATTERN, 1).try_cast("double")
    lat = F.regexp_extract(text, K.POINT_PATTERN, 2).try_cast("double")
    return F.when(
        lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon"))
    )


def entity_id(uri: Column | str) -> Column:
    """Last path segment of an entity address."""
    return F.substring_index(_col(uri), "/", -1)


def strip_brackets(text: Column | str) -> Column:
    """Drop one trailing parenthetical, ASCII or full width.

    It ends the text, and begins at the first opening bracket behind any bracket that closed before.
    """
    whole = strip(text)
    inner = F.translate(F.left(whole, F.length(whole) - 1), "（）", "()")
    tail = F.substring_index(inner, ")", -1)
    opening = F.instr(tail, F.lit("("))
    before = F.left(whole, F.length(inner) - F.length(tail) + opening - 1)
    closed = F.right(whole, F.lit(1)).isin(")", "）") & (opening > 0)
    return F.when(closed, strip(before)).otherwise(whole)


def title_variants(city: Column | str) -> Column:
    """The title as given, then without its trailing parenthetical when that differs."""
    given = _col(city)
    short = blank_to_null(strip_brackets(given))
    return F.array_distinct(F.array_compact(F.array(given, short)))


#: Branches of a trie that are tried one after the other; more are halved by their first characters.
BRANCHES = 4
#: Phrases that are looked up one after the other.
BUCKET = 8


def trie_pattern(phrases: Sequence[str]) -> str:
    """A pattern that matches the longest phrase at a place, from a trie of the phrases.

    Nodes with many branches choose between halves by the next character, so a place costs a few steps for each
    character of a phrase, whatever the number of phrases.
    """

    def char(c: str) -> str:
        return f"\\x{{{ord(c):x}}}"

    def choice(branches: list[tuple[str, str]]) -> str:
        if len(branches) <= BRANCHES:
            return "|".join(rest for _, rest in branches)
        half = len(branches) // 2
        sides = [(f"[{char(part[0][0])}-{char(part[-1][0])}]", part) for part in (branches[:half], branches[half:])]
        return "|".join(f"(?={first})(?:{choice(part)})" for first, part in sides)

    def node(words: list[str]) -> str:
        """Of sorted words that are not empty."""
        branches = []
        for first, group in groupby(words, key=lambda w: w[0]):
            tails = [w[1:] for w in group]
            longer = [t for t in tails if t]
            inner = f"(?:{node(longer)})" if longer else ""
            branches.append((first, char(first) + inner + ("?" if longer and len(longer) < len(tails) else "")))
        return choice(branches)

    return node(sorted({p for p in phrases if p}))


@dataclass(frozen=True)
class Simplifier:
    """Character and phrase table from traditional to simplified writing; empty means identity.

    A text is walked once. At each place the longest phrase wins and is replaced as a whole, whatever the order of the
    table; what is replaced is not looked at again. The first of several entries for a phrase counts. The characters
    between phrases are replaced one by one.
    """

    source: str = ""
    target: str = ""
    phrases: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        if len(self.source) != len(self.target):
            raise ValueError("source and target need the same number of characters")

    def __call__(self, text: Column) -> Column:
        known = {old: new for old, new in reversed(self.phrases) if old}
        if not known:
            return self._characters(text)
        pattern = trie_pattern([*known])
        buckets = max(1, len(known) // BUCKET)
        held: list[dict[str, str]] = [{} for _ in range(buckets)]
        for old, new in known.items():
            held[zlib.crc32(old.encode()) % buckets][old] = new
        table = F.from_json(F.lit(json.dumps(held)), "array<map<string,string>>")

        def converted(phrase: Column) -> Column:
            bucket = (F.crc32(phrase.cast("binary")) % buckets).cast("int")
            return F.try_element_at(F.get(table, bucket), phrase)

        hits = F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), converted)
        gaps = F.transform(F.split(text, pattern, -1), self._characters)
        parts = F.zip_with(gaps, hits, lambda gap, hit: F.concat(gap, F.coalesce(hit, F.lit(""))))
        return F.array_join(parts, "")

    def _characters(self, text: Column) -> Column:
        return F.translate(text, self.source, self.target) if self.source else text


IDENTITY = Simplifier()


def has_cjk(text: Column | str) -> Column:
    return _col(text).rlike(K.CJK_PATTERN)


def has_latin_run(text: Column | str) -> Column:
    return _col(text).rlike(K.LATIN_RUN_PATTERN)


def clean_title(title: Column | str, simplify: Simplifier = IDENTITY) -> Column:
    """A linked page title fit to be a name, else NULL."""
    text = strip_brackets(title)
    return F.when(has_cjk(text) & ~has_latin_run(text), simplify(text))


def normalize_compare(text: Column | str) -> Column:
    """Letters, digits and underscores in lower case."""
    return F.lower(F.regexp_replace(_col(text), r"[^\p{L}\p{N}_]", ""))


def _without(text: Column, endings: Sequence[str], separators: str) -> Column:
    """(head, ending) by the longest of some endings, in lower case; the head stands before it and the separators that
    must be in front of it. NULL where no ending fits."""

    def parts(ending: Column) -> Column:
        before = F.left(text, F.length(text) - F.length(ending))
        return F.struct(F.rtrim(before, F.lit(separators)).alias("head"), before.alias("before"), ending.alias("ending"))

    longest_first = sorted((e.lower() for e in endings), key=len, reverse=True)
    ends = F.filter(
        F.array(*[F.lit(e) for e in longest_first]), lambda e: F.lower(F.right(text, F.length(e))) == e
    )
    fits = F.filter(F.transform(ends, parts), lambda p: (p["head"] != "") & (p["head"] != p["before"]))
    return F.get(fits, F.lit(0))


def compose_name(name: Column | str, place: Column | str, place_zh: Column | str) -> Column:
    """`<place> [modifier] <kind>` in the local language, when the head is the place; else NULL.

    The longest kind that ends the name counts, and one modifier before it may go.
    """
    place, place_zh, text = blank_to_null(place), blank_to_null(place_zh), strip(name)
    kinds = F.create_map(*[F.lit(part) for pair in K.KIND_ZH.items() for part in pair])
    found = _without(text, list(K.KIND_ZH), K.WHITESPACE)

    def composed(named: Column) -> Column:
        head = named["head"]
        short = F.coalesce(_without(head, K.NAME_MODIFIERS, K.WHITESPACE + "-")["head"], head)
        same = normalize_compare(short) == normalize_compare(place)
        return F.when(same, F.concat(place_zh, F.try_element_at(kinds, named["ending"])))

    # An array of one, so that the parts of the name are found once.
    return F.get(F.transform(F.array(found), composed), F.lit(0))


def validate_name(name: Column | str, english: Column | str) -> Column:
    """A proposed name that may be used, else NULL."""
    text = strip(F.trim(strip(name), F.lit('"')))
    usable = (
        (F.length(text) > 0)
        & (F.length(text) <= K.MAX_NAME_LENGTH)
        & has_cjk(text)
        & ~has_latin_run(text)
        & (F.lower(text) != F.lower(strip(english)))
    )
    return F.when(usable, text)


def label_rank(lang: Column | str) -> Column:
    """Position of a language in the preference order, NULL for other languages."""
    languages = F.array(*[F.lit(code) for code in K.LABEL_LANGUAGES])
    return F.nullif(F.array_position(languages, _col(lang)), F.lit(0))


def best_label(lang: Column | str, label: Column | str) -> Column:
    """Aggregate: first usable label by language preference, then by text."""
    text = strip(label)
    rank = label_rank(lang)
    usable = rank.isNotNull() & has_cjk(text) & ~has_latin_run(text)
    return F.min(
        F.when(usable, F.struct(rank.alias("rank"), _col(label).alias("label"), _col(lang).alias("lang")))
    )


def label_text(best: Column, simplify: Simplifier = IDENTITY) -> Column:
    """A best_label value as STRUCT<text, suffix, converted>."""
    given = strip(best["label"])
    text = simplify(given)
    converted = (text != given) | best["lang"].isin(*K.TRADITIONAL_LANGUAGES)
    suffix = F.when(converted, F.concat(best["lang"], F.lit(">zh-hans"))).otherwise(best["lang"])
    return F.when(
        best.isNotNull(),
        F.struct(text.alias("text"), suffix.alias("suffix"), converted.alias("converted")),
    )


def is_settlement_page(categories: Column | str) -> Column:
    """No category speaks of disambiguation and one of them names a settlement."""
    names = _col(categories)
    return ~F.coalesce(F.exists(names, is_disambiguation), F.lit(False)) & F.coalesce(
        F.exists(names, is_settlement_category), F.lit(False)
    )


def is_disambiguation(category: Column) -> Column:
    return F.contains(F.lower(category), F.lit("disambiguation"))


def is_settlement_category(category: Column) -> Column:
    return F.lower(category).rlike("|".join(K.SETTLEMENT_HINTS))


def name_source_kind(source: Column | str) -> Column:
    """authoritative, composite, llm or unknown, by the prefix of the source text."""
    text = _col(source)
    return (
        F.when(text.startswith("wikidata:") | text.startswith("wikipedia:"), "authoritative")
        .when(text.startswith("composite:"), "composite")
        .when(text.startswith("llm:"), "llm")
        .otherwise("unknown")
    )
