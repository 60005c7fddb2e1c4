"""Filters, keyword search, counts and display columns over published places."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import text as T
from geoledger.functions.text import _col
from geoledger.session import written

_SPACES = f"{K.SPACE_PATTERN}+"


@dataclass(frozen=True)
class FilterState:
    """What a reader of the places has chosen to see."""

    types: tuple[str, ...] = K.DEFAULT_TYPES
    countries: tuple[str, ...] = field(default=())
    query: str = ""
    has_zh: bool = False
    scheduled_only: bool = False


def haystack(columns: tuple[str, ...] = K.HAYSTACK_COLUMNS) -> Column:
    """Searchable text of a place: its non-empty columns in lower case."""
    return F.lower(F.concat_ws(" ", *[T.blank_to_null(name) for name in columns]))


def query_tokens(query: Column | str) -> Column:
    """Lower-case words of a query."""
    words = F.split(F.lower(T.strip(_col(query))), _SPACES)
    return F.filter(words, lambda word: word != "")


def search(df: DataFrame, query: str, text: Column | None = None) -> DataFrame:
    """Rows whose searchable text holds every word of the query."""
    return df.where(_holds_all(query, haystack() if text is None else text))


def _holds_all(query: str, text: Column) -> Column:
    words = query.strip(K.WHITESPACE).lower().split()
    return reduce(lambda a, b: a & b, [F.contains(text, F.lit(word)) for word in words], F.lit(True))


def filter_predicate(state: FilterState) -> Column:
    """One predicate for a filter state; an empty type list matches nothing."""
    keep = F.col("type").isin(*state.types) if state.types else F.lit(False)
    if state.countries:
        keep = keep & F.coalesce("iso_country", F.lit("")).isin(*state.countries)
    if state.has_zh:
        keep = keep & T.blank_to_null("name_zh").isNotNull()
    if state.scheduled_only:
        keep = keep & (F.col("scheduled_service") == "yes")
    if state.query.strip(K.WHITESPACE):
        keep = keep & _holds_all(state.query, haystack())
    return keep


def filter_places(df: DataFrame, state: FilterState = FilterState()) -> DataFrame:
    return df.where(filter_predicate(state))


def decode_filters(df: DataFrame, url: str) -> DataFrame:
    """Filter columns read from the query part of an address.

    The first occurrence of a parameter counts. An absent type list means the default types, an
    empty one none.
    """
    query = F.regexp_replace(F.regexp_extract(_col(url), r"^[^?]*\??(.*)\z", 1), r"#.*\z", "")
    query = F.when(F.contains(_col(url), F.lit("?")), query).otherwise(_col(url))

    def decoded(text: Column) -> Column:
        # A percent sign that starts no byte stands for itself.
        return F.url_decode(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"))

    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda part: part != ""),
        lambda part: F.struct(
            decoded(F.regexp_extract(part, r"^([^=]*)", 1)).alias("key"),
            decoded(F.regexp_replace(part, r"^[^=]*=?", "")).alias("value"),
        ),
    )
    def first_value(name: str) -> Column:
        found = F.filter(F.col("_pairs"), lambda pair: pair["key"] == name)
        return F.try_element_at(found, F.lit(1))["value"]

    names = ("type", "country", "q", "zh", "sched", "borders", "map")
    # Each address is taken apart once; the columns below read the found values.
    parsed = df.withColumn("_pairs", pairs).select(
        *df.columns, F.struct(*[first_value(name).alias(name) for name in names]).alias("_given")
    )

    def parameter(name: str) -> Column:
        return F.col(f"_given.{name}")

    def listed(name: str) -> Column:
        return F.transform(F.split(F.coalesce(parameter(name), F.lit("")), ","), T.strip)

    types = F.filter(listed("type"), lambda value: value.isin(*K.PLACE_TYPES))
    countries = F.filter(
        F.transform(listed("country"), F.upper), lambda value: value.rlike("^[A-Z0-9]{2}$")
    )
    basemap = parameter("map")
    return parsed.withColumns(
        {
            "types": F.when(parameter("type").isNotNull(), types).otherwise(
                F.array(*[F.lit(name) for name in K.DEFAULT_TYPES])
            ),
            "countries": countries,
            "query": F.coalesce(parameter("q"), F.lit("")),
            "has_zh": F.coalesce(parameter("zh") == "1", F.lit(False)),
            "scheduled_only": F.coalesce(parameter("sched") == "1", F.lit(False)),
            "borders": F.coalesce(parameter("borders") != "0", F.lit(True)),
            "basemap": F.when(basemap.isin(*K.BASEMAPS), basemap).otherwise(K.BASEMAPS[0]),
        }
    ).drop("_given")


def encode_filters(df: DataFrame, name: str = "encoded") -> DataFrame:
    """The address query of the filter columns; values at their default are left out."""
    joined = lambda column: F.url_encode(F.array_join(column, ","))
    parts = [
        F.concat(F.lit("type="), joined("types")),
        F.when(F.size("countries") > 0, F.concat(F.lit("country="), joined("countries"))),
        F.when(F.col("query") != "", F.concat(F.lit("q="), F.url_encode("query"))),
        F.when(F.col("has_zh"), "zh=1"),
        F.when(F.col("scheduled_only"), "sched=1"),
        F.when(~F.col("borders"), "borders=0"),
        F.when(F.col("basemap") != K.BASEMAPS[0], F.concat(F.lit("map="), F.url_encode("basemap"))),
    ]
    return df.withColumn(name, F.concat_ws("&", *parts))


_STATE = ["types", "countries", "tokens", "has_zh", "scheduled_only"]


def filter_states(filters: DataFrame) -> DataFrame:
    """Distinct filter states with how many saved filters share each; equal filters run once."""
    normal = filters.select(
        F.array_sort(F.array_distinct("types")).alias("types"),
        F.array_sort(F.array_distinct("countries")).alias("countries"),
        F.array_sort(F.array_distinct(query_tokens("query"))).alias("tokens"),
        "has_zh",
        "scheduled_only",
    )
    return normal.groupBy(*_STATE).agg(F.count(F.lit(1)).alias("filters")).withColumn(
        "state", F.to_json(F.struct(*_STATE))
    )


_ANY = "*"


def _lengths(words: str) -> Column:
    return F.transform(words, F.length)


def _asked(states: DataFrame) -> DataFrame:
    """States by each (type, country) they accept; a star stands for any country."""
    countries = F.when(F.size("countries") > 0, F.col("countries")).otherwise(F.array(F.lit(_ANY)))
    return states.select(
        "state",
        "tokens",
        # The longest word is the one the lookup goes by.
        F.try_element_at(F.sort_array(F.arrays_zip(_lengths("tokens"), "tokens")), F.lit(-1))["tokens"].alias("lead"),
        "has_zh",
        "scheduled_only",
        F.explode("types").alias("type"),
        countries.alias("_countries"),
    ).select("*", F.explode("_countries").alias("country")).drop("_countries")


def _offered(places: DataFrame, *columns: Column | str) -> DataFrame:
    return places.select(
        "type",
        F.coalesce("iso_country", F.lit("")).alias("country"),
        T.blank_to_null("name_zh").isNotNull().alias("named"),
        F.coalesce(F.col("scheduled_service") == "yes", F.lit(False)).alias("scheduled"),
        *columns,
    )


def _flags_met() -> Column:
    return (~F.col("has_zh") | F.col("named")) & (~F.col("scheduled_only") | F.col("scheduled"))


GRAM = 3  # characters of a word that are looked up


def _grams(text: str, sizes: Sequence[int]) -> Column:
    """Distinct substrings of the given sizes."""
    pieces = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)) for size in sizes]
    return F.array_distinct(F.concat(*pieces)) if pieces else F.array().cast("array<string>")


def _meet_words(offered: DataFrame, asked: DataFrame) -> DataFrame:
    """Offers, without their text, by each list of words that they hold.

    Lists of words are looked up once, however many states share them. A text that holds a word holds its first
    characters, so these become a join key: a list meets the texts with its beginning and not every text. Only
    beginnings of the lengths asked for are made, three at most.
    """
    words = asked.where(F.size("tokens") > 0).select("tokens", "lead", F.substring("lead", 1, GRAM).alias("gram"))
    words = written(words.distinct())
    sizes = [r[0] for r in words.select(F.length("gram")).distinct().collect()]
    # The outer form keeps Spark from testing every list of beginnings for emptiness first.
    keyed = offered.select("*", F.explode_outer(_grams("text", sorted(sizes))).alias("gram"))
    text = F.col("text")
    return (
        keyed.join(words, "gram")
        .where(F.contains(text, F.col("lead")) & F.forall("tokens", lambda word: F.contains(text, word)))
        .drop("text", "gram", "lead")
    )


def _no_words(offered: DataFrame) -> DataFrame:
    return offered.withColumn("tokens", F.array().cast("array<string>"))


def _meet(offered: DataFrame, asked: DataFrame) -> DataFrame:
    """Equi-join of offers with demands for the same words; an offer meets demands for its country and for any."""
    kept = [name for name in offered.columns if name != "country"]
    both = offered.select(*kept, F.explode(F.array("country", F.lit(_ANY))).alias("country"))
    return both.join(asked, ["type", "country", "tokens"]).where(_flags_met())


def apply_filter_table(places: DataFrame, filters: DataFrame) -> DataFrame:
    """(state, id) for every distinct filter state and the places it keeps."""
    asked = written(_asked(written(filter_states(filters))))
    worded = _meet_words(_offered(places, "id", haystack().alias("text")), asked)
    offers = _no_words(_offered(places, "id")).unionByName(worded)
    return _meet(offers, asked).select("state", "id")


def count_filter_table(places: DataFrame, filters: DataFrame) -> DataFrame:
    """Per distinct filter state how many saved filters share it and how many places it keeps.

    States are answered from the counts per facet and list of words, so no place is paired with a state. The states
    feed several branches and become a table first, so the saved filters are decoded once.
    """
    states = written(filter_states(filters))
    asked = written(_asked(states))
    facet = ["tokens", "type", "country", "named", "scheduled"]
    count = F.count(F.lit(1)).alias("places")
    plain = _no_words(_offered(places)).groupBy(*facet).agg(count)
    worded = _meet_words(_offered(places, haystack().alias("text")), asked).groupBy(*facet).agg(count)
    counted = _meet(plain.unionByName(worded), asked).groupBy("state").agg(F.sum("places").alias("places"))
    return states.join(counted, "state", "left").select(
        "state", "filters", F.coalesce("places", F.lit(0)).alias("places")
    )


def count_by_type(df: DataFrame) -> DataFrame:
    """Rows per place type, zero for types without rows."""
    counts = [F.count_if(F.col("type") == name).alias(name) for name in K.PLACE_TYPES]
    pairs = [F.struct(F.lit(name).alias("type"), F.col(name).alias("places")) for name in K.PLACE_TYPES]
    return df.agg(*counts).select(F.inline(F.array(*pairs)))


def count_by_country(df: DataFrame) -> DataFrame:
    known = df.where(T.blank_to_null("iso_country").isNotNull())
    return known.groupBy("iso_country").agg(F.count(F.lit(1)).alias("places"))


def top_countries(df: DataFrame, k: int = K.TOP_COUNTRIES, contains: str = "") -> DataFrame:
    """Countries by count, then code; optionally only codes that hold a text."""
    counts = count_by_country(df)
    wanted = contains.strip(K.WHITESPACE).lower()
    if wanted:
        counts = counts.where(F.contains(F.lower("iso_country"), F.lit(wanted)))
    return counts.orderBy(F.desc("places"), "iso_country").limit(k)


def display_names(df: DataFrame, lang: str) -> DataFrame:
    """Add primary, secondary and city name for a reading language."""
    if lang.startswith("zh"):
        columns = {
            "primary_name": F.coalesce("name_zh", "name"),
            "secondary_name": F.when(T.blank_to_null("name_zh").isNotNull(), F.col("name")),
            "city_name": F.coalesce("municipality_zh", "location_zh", "municipality"),
        }
    else:
        columns = {
            "primary_name": F.col("name"),
            "secondary_name": F.col("name_zh"),
            "city_name": F.coalesce("municipality", "location_zh"),
        }
    return df.withColumns(columns)


def country_label(df: DataFrame, names: DataFrame, missing: str = "—") -> DataFrame:
    """Add the country's name from a (code, label) table, else its code, else a dash."""
    labels = names.select(F.col("code").alias("iso_country"), F.col("label").alias("_label"))
    code = T.blank_to_null("iso_country")
    return (
        df.join(labels, "iso_country", "left")
        .withColumn("country_label", F.coalesce(F.when(code.isNotNull(), F.col("_label")), code, F.lit(missing)))
        .drop("_label")
    )


def lod_filter(df: DataFrame) -> DataFrame:
    """The types a far view shows."""
    return df.where(F.col("type").isin(*K.COARSE_TYPES))


def select_targets(places: DataFrame) -> DataFrame:
    """Places whose names are resolved."""
    return places.where(F.col("type").isin(*K.TARGET_TYPES))


def lookup_keys(places: DataFrame) -> DataFrame:
    """Distinct (kind, value) to look up for the targets: codes per property, and cities."""
    wanted = [("P238", "iata_code"), ("P239", "icao_code"), ("city", "municipality")]
    keys = F.array(
        *[F.struct(F.lit(kind).alias("kind"), F.col(name).alias("value")) for kind, name in wanted]
    )
    rows = select_targets(places).select(F.inline(keys))
    return rows.where(T.blank_to_null("value").isNotNull()).distinct().orderBy("kind", "value")


def summarize(places: DataFrame) -> DataFrame:
    """Rows, named rows and unresolved targets per type, sorted by type."""
    named = T.blank_to_null("name_zh").isNotNull()
    return (
        places.groupBy("type")
        .agg(
            F.count(F.lit(1)).alias("places"),
            F.count_if(named).alias("named"),
            F.count_if(F.col("type").isin(*K.TARGET_TYPES) & ~named).alias("unresolved_targets"),
        )
        .orderBy("type")
    )


def coverage(places: DataFrame) -> DataFrame:
    """One row: how many targets there are and how many of them lack a name."""
    target = F.col("type").isin(*K.TARGET_TYPES)
    return places.agg(
        F.count_if(target).alias("targets"),
        F.count_if(target & T.blank_to_null("name_zh").isNull()).alias("missing"),
    )
