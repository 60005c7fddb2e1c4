"""Settlement candidates and the names of cities from linked pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.functions import text as T


def collect_settlements(rows: DataFrame, simplify: T.Simplifier = T.IDENTITY) -> DataFrame:
    """One row per (entity, admin): largest readable population, number of labels, label to use."""
    population = T.parse_optional_double(F.col("population").cast("string")).try_cast("bigint")
    per_label = rows.groupBy("entity", "admin_qid", "lang", "label").agg(
        F.max(population).alias("population")
    )
    known = F.col("label").isNotNull() & F.col("lang").isNotNull()
    label = T.label_text(F.col("best"), simplify)
    return (
        per_label.groupBy("entity", "admin_qid")
        .agg(
            F.max("population").alias("population"),
            F.count_if(known).alias("labels"),
            T.best_label("lang", "label").alias("best"),
        )
        .select(
            "entity",
            "admin_qid",
            "population",
            "labels",
            label["text"].alias("label"),
            label["suffix"].alias("suffix"),
        )
    )


def best_settlement(settlements: DataFrame) -> DataFrame:
    """Per entity the settlement with a usable label and the largest population, then lowest id."""
    order = F.struct(-F.coalesce(F.col("population"), F.lit(0)), "admin_qid", "label", "suffix")
    return (
        settlements.where(F.col("label").isNotNull())
        .groupBy("entity")
        .agg(F.min(order).alias("best"))
        .select("entity", "best.admin_qid", "best.label", "best.suffix")
    )


def union_titles(cities: DataFrame) -> DataFrame:
    """Titles to look up per distinct city: as given, then without its parenthetical."""
    return (
        cities.select("city")
        .where(T.blank_to_null("city").isNotNull())
        .distinct()
        .select("city", F.posexplode(T.title_variants("city")).alias("variant", "title"))
    )


def resolve_titles(titles: DataFrame, redirects: DataFrame, column: str = "title") -> DataFrame:
    """Follow the redirect table up to three hops; adds `resolved`.

    Only distinct titles take part in the hops.
    """
    hop = (
        redirects.where(T.blank_to_null("to_title").isNotNull())
        .groupBy("from_title")
        .agg(F.min("to_title").alias("to_title"))
    )
    walk = titles.select(column).distinct().withColumn("resolved", F.col(column))
    for _ in range(3):
        walk = (
            walk.join(hop, walk["resolved"] == hop["from_title"], "left")
            .select(column, F.coalesce("to_title", "resolved").alias("resolved"))
        )
    return titles.join(walk, column)


def merge_pages(pages: DataFrame) -> DataFrame:
    """The merged categories of each title, one row per title and category, with its first link.

    Parts of a page may arrive in several rows. Categories stay in long form, so a title with very
    many of them is never one row.
    """
    per_title = page_facts(pages).select("title", "missing", "langlink")
    categories = pages.select("title", F.explode("categories").alias("category")).distinct()
    return per_title.join(categories, "title", "left").select(
        "title", "missing", "category", "langlink"
    )


def page_facts(pages: DataFrame) -> DataFrame:
    """One row per title: missing or not, settlement or not, its first link."""
    def any_category(test):
        return F.coalesce(F.max(F.exists("categories", test)), F.lit(False))

    return pages.groupBy("title").agg(
        F.min(F.coalesce("missing", F.lit(False))).alias("missing"),
        (any_category(T.is_settlement_category) & ~any_category(T.is_disambiguation)).alias(
            "settlement"
        ),
        F.min(F.try_element_at("langlinks", F.lit(1))).alias("langlink"),
    )


def city_names(
    cities: DataFrame,
    pages: DataFrame,
    redirects: DataFrame,
    simplify: T.Simplifier = T.IDENTITY,
) -> DataFrame:
    """(city, name_zh): the first title variant whose page is a settlement with a usable link."""
    usable = (
        page_facts(pages)
        .where(~F.col("missing") & F.col("settlement"))
        .select(F.col("title").alias("resolved"), T.clean_title("langlink", simplify).alias("name_zh"))
        .where(F.col("name_zh").isNotNull())
    )
    wanted = resolve_titles(union_titles(cities), redirects)
    return (
        wanted.join(usable, "resolved")
        .groupBy("city")
        .agg(F.min_by("name_zh", "variant").alias("name_zh"))
    )
