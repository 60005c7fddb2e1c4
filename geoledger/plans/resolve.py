"""Name resolution: from codes, coordinates and linked pages to a name with its source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import text as T
from geoledger.operators import labels as L
from geoledger.operators import matching as MT
from geoledger.operators import replies as R
from geoledger.operators.explore import select_targets
from geoledger.sources.names import read_archive, read_names, write_archive, write_names

TRACE_COLUMNS = ("match_property", "match_qid", "ambiguous", "converted", "origin")


def resolve_names(
    places: DataFrame,
    candidates: DataFrame,
    settlements: DataFrame,
    pages: DataFrame,
    redirects: DataFrame,
    simplify: T.Simplifier = T.IDENTITY,
) -> DataFrame:
    """Name entries of all targets plus the trace columns.

    candidates: one row per (property, code, qid) as collect_candidates gives them.
    settlements: one row per (entity, admin_qid) as collect_settlements gives them.
    """
    targets = select_targets(places)
    matches = MT.match_cascade(targets, candidates)
    chosen = candidates.where(F.col("label").isNotNull()).select(
        *MT.CANDIDATE_KEY, F.col("label").alias("entity_label"), "suffix", "converted"
    )
    located = L.best_settlement(settlements).select(
        F.col("entity").alias("qid"),
        F.col("label").alias("location_zh"),
        "admin_qid",
        F.col("suffix").alias("location_suffix"),
    )
    described = matches.join(chosen, list(MT.CANDIDATE_KEY), "left").join(located, "qid", "left")
    location_source = F.concat(
        F.lit("wikidata:"), "qid", F.lit(":P131:"), "admin_qid", F.lit(":"), "location_suffix"
    )
    # An ambiguous match names neither the place nor its location.
    clear = ~F.col("ambiguous")
    facts = described.select(
        "id",
        F.col("property").alias("match_property"),
        "ambiguous",
        *[
            F.when(clear, value).alias(name)
            for name, value in {
                "match_qid": F.col("qid"),
                "entity_label": F.col("entity_label"),
                "suffix": F.col("suffix"),
                "converted": F.col("converted"),
                "location_zh": F.col("location_zh"),
                "location_zh_source": location_source,
            }.items()
        ],
    )

    cities = targets.select(F.col("municipality").alias("city"))
    named_cities = L.city_names(cities, pages, redirects, simplify).select(
        F.col("city").alias("municipality"), F.col("name_zh").alias("municipality_zh")
    )

    joined = targets.join(facts, "id", "left").join(named_cities, "municipality", "left")
    composed = T.compose_name("name", "municipality", "municipality_zh")
    by_entity = F.col("entity_label").isNotNull()
    full = joined.withColumn("composed", composed)
    origin = F.when(by_entity, "entity").when(F.col("composed").isNotNull(), "composite")
    known_city = F.col("municipality_zh").isNotNull()
    return full.select(
        "id",
        "ident",
        "type",
        "iata_code",
        "icao_code",
        "name",
        F.coalesce("entity_label", "composed").alias("name_zh"),
        F.when(by_entity, F.concat(F.lit("wikidata:"), "match_qid", F.lit(":"), "suffix"))
        .when(
            F.col("composed").isNotNull(),
            F.concat(F.lit("composite:municipality:"), "municipality"),
        )
        .alias("name_zh_source"),
        F.when(origin.isNotNull(), K.RESOLVED).otherwise(K.UNRESOLVED).alias("name_zh_status"),
        "municipality",
        "municipality_zh",
        F.when(known_city, F.concat(F.lit("wikipedia:en:"), "municipality", F.lit(">zh"))).alias(
            "municipality_zh_source"
        ),
        F.when(known_city, K.RESOLVED).otherwise(K.UNRESOLVED).alias("municipality_zh_status"),
        "location_zh",
        "location_zh_source",
        "iso_country",
        "match_property",
        "match_qid",
        F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"),
        F.coalesce("converted", F.lit(False)).alias("converted"),
        origin.alias("origin"),
    )


def _filled(entries: DataFrame, given: DataFrame, origin: str) -> DataFrame:
    """Fill rows without a name from (id, name_zh, source)."""
    offer = given.select("id", F.col("name_zh").alias("_name"), F.col("source").alias("_source"))
    use = (F.col("name_zh_status") == K.UNRESOLVED) & T.blank_to_null("_name").isNotNull()
    return (
        entries.join(offer, "id", "left")
        .withColumn("_use", F.coalesce(use, F.lit(False)))
        .withColumns(
            {
                "name_zh": F.when(F.col("_use"), F.col("_name")).otherwise(F.col("name_zh")),
                "name_zh_source": F.when(F.col("_use"), F.col("_source")).otherwise(
                    F.col("name_zh_source")
                ),
                "name_zh_status": F.when(F.col("_use"), K.RESOLVED).otherwise(
                    F.col("name_zh_status")
                ),
                "origin": F.when(F.col("_use"), origin).otherwise(F.col("origin")),
            }
        )
        .drop("_name", "_source", "_use")
    )


def apply_archive(entries: DataFrame, archive: DataFrame) -> DataFrame:
    """Fill only unresolved rows from archived (id, name_zh, source)."""
    return _filled(entries, archive, "archive")


def pending(entries: DataFrame) -> DataFrame:
    """Rows that still need a name."""
    return entries.where(F.col("name_zh_status") == K.UNRESOLVED)


def apply_replies(
    entries: DataFrame, replies: DataFrame, label: str, size: int = K.REPLY_BATCH_SIZE
) -> DataFrame:
    """Fill only unresolved rows from the replies (batch_id, reply) to their request batches."""
    waiting = pending(entries)
    expected = R.request_members(waiting, size)
    accepted = R.accepted_replies(R.reply_map(replies, expected), waiting)
    offer = accepted.withColumn("source", F.lit(f"llm:{label}"))
    return _filled(entries, offer, "reply")


def refresh_stats(entries: DataFrame, replied: bool = False) -> DataFrame:
    """One row with the counters of a resolution run."""

    def counted(condition, name):
        return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)

    origin = F.col("origin")
    entity = origin == "entity"
    city, city_zh = T.blank_to_null("municipality"), F.col("municipality_zh")
    open_rows = F.col("name_zh_status") == K.UNRESOLVED
    asked = (origin == "reply") | open_rows
    return entries.agg(
        F.count(F.lit(1)).alias("targets"),
        counted(entity, "resolved"),
        counted(open_rows, "unresolved"),
        counted(F.col("ambiguous"), "ambiguous"),
        counted(entity & (F.col("match_property") == "P238"), "via_iata"),
        counted(entity & (F.col("match_property") != "P238"), "via_icao"),
        counted(entity & F.col("converted"), "converted_from_traditional"),
        counted(city.isNotNull() & city_zh.isNotNull(), "municipality_from_wikipedia"),
        counted(city.isNotNull() & city_zh.isNull(), "municipality_unresolved"),
        counted(origin == "composite", "composite_resolved"),
        counted(origin == "archive", "llm_supplement_applied"),
        counted(origin == "reply", "llm_resolved"),
        counted(asked & (origin.isNull()) & F.lit(replied), "llm_unresolved"),
        counted(F.col("location_zh").isNotNull(), "location_from_wikidata"),
        counted(F.col("location_zh").isNull(), "location_unresolved"),
    )


@dataclass(frozen=True)
class ResolutionInputs:
    """Everything a refresh reads, as tables."""

    places: DataFrame
    candidates: DataFrame
    settlements: DataFrame
    pages: DataFrame
    redirects: DataFrame
    archive: DataFrame | None = None
    replies: DataFrame | None = None
    reply_label: str = "default"
    simplify: T.Simplifier = T.IDENTITY


def refresh_frames(inputs: ResolutionInputs) -> DataFrame:
    """Entries after entities, composed names, archive and replies, with the trace columns."""
    entries = resolve_names(
        inputs.places,
        inputs.candidates,
        inputs.settlements,
        inputs.pages,
        inputs.redirects,
        inputs.simplify,
    )
    if inputs.archive is not None:
        entries = apply_archive(entries, inputs.archive)
    if inputs.replies is not None:
        entries = apply_replies(entries, inputs.replies, inputs.reply_label)
    return entries


def refresh_job(
    spark: SparkSession, inputs: ResolutionInputs, work_path: str, names_path: str, archive_path: str
) -> DataFrame:
    """Resolve, fill, write names and archive; returns the counters.

    Each stage is written below `work_path` (a shared folder), so the stages after it start from
    files and not from the whole plan.
    """

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{work_path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work_path}/{name}")

    first = stored(
        resolve_names(
            inputs.places,
            inputs.candidates,
            inputs.settlements,
            inputs.pages,
            inputs.redirects,
            inputs.simplify,
        ),
        "resolved",
    )
    archive = inputs.archive if inputs.archive is not None else read_archive(spark, archive_path)
    entries = apply_archive(first, archive)
    if inputs.replies is not None:
        entries = apply_replies(stored(entries, "archived"), inputs.replies, inputs.reply_label)
    final = stored(entries, "final")
    write_names(final, names_path)
    write_archive(final, archive_path)
    return refresh_stats(final, replied=inputs.replies is not None)


def extract_archive(spark: SparkSession, names_path: str, archive_path: str) -> None:
    """Write the archive that a name table implies."""
    write_archive(read_names(spark, names_path), archive_path)
