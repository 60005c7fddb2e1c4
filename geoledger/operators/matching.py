"""Matching of places to entity candidates by code and distance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import geo as G
from geoledger.functions import text as T
from geoledger.operators.nearby import near_pairs
from geoledger.session import written

CANDIDATE_KEY = ("property", "code", "qid")
SITE = ("property", "code", "latitude_deg", "longitude_deg")


def parse_bindings(rows: DataFrame) -> DataFrame:
    """Raw bindings (property, code, entity, coord, lang, label) with the address and point parsed."""
    point = T.parse_point("coord")
    return rows.select(
        "property",
        "code",
        T.entity_id("entity").alias("qid"),
        point["lat"].alias("lat"),
        point["lon"].alias("lon"),
        "lang",
        "label",
    )


def candidate_labels(rows: DataFrame) -> DataFrame:
    """The label set of every candidate, one row per label."""
    labelled = rows.where(F.col("label").isNotNull() & F.col("lang").isNotNull())
    return labelled.select(*CANDIDATE_KEY, "lang", "label").distinct()


def collect_candidates(rows: DataFrame, simplify: T.Simplifier = T.IDENTITY) -> DataFrame:
    """One row per candidate: a coordinate, how many labels it has, the label to use.

    Repeated rows fold into one per label before anything is grouped by candidate, so a candidate
    that fills a third of the input still costs its distinct labels only.
    """
    point = F.when(
        F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.struct("lat", "lon")
    )
    per_label = rows.groupBy(*CANDIDATE_KEY, "lang", "label").agg(F.min(point).alias("point"))
    known = F.col("label").isNotNull() & F.col("lang").isNotNull()
    per_candidate = per_label.groupBy(*CANDIDATE_KEY).agg(
        F.min("point").alias("point"),
        F.count_if(known).alias("labels"),
        T.best_label("lang", "label").alias("best"),
    )
    label = T.label_text(F.col("best"), simplify)
    return per_candidate.select(
        *CANDIDATE_KEY,
        F.col("point.lat").alias("lat"),
        F.col("point.lon").alias("lon"),
        "labels",
        label["text"].alias("label"),
        label["suffix"].alias("suffix"),
        label["converted"].alias("converted"),
    )


def code_rows(places: DataFrame, properties: Mapping[str, str] = K.CODE_PROPERTIES) -> DataFrame:
    """One row per place and non-empty code, with the property's turn as `rank`."""
    codes = F.array(
        *[
            F.struct(
                F.lit(rank).alias("rank"), F.lit(name).alias("property"), F.col(column).alias("code")
            )
            for rank, (name, column) in enumerate(properties.items())
        ]
    )
    return (
        places.select("id", "latitude_deg", "longitude_deg", F.inline(codes))
        .where(T.blank_to_null("code").isNotNull())
    )


def match_by_code(
    places: DataFrame,
    candidates: DataFrame,
    properties: Mapping[str, str] = K.CODE_PROPERTIES,
    max_km: float = K.MAX_DISTANCE_KM,
) -> DataFrame:
    """The two nearest candidates in range for every place and property, as `place` 1 and 2.

    The match runs once per distinct site (code and coordinate) and once per distinct candidate
    point, of which only the two lowest ids can count. The distance limit becomes part of the
    equi-join through a grid, so one code shared by a third of all rows does not pair them all.
    Sites without a coordinate score 0 for every candidate of their code; for them an aggregate
    per code is enough.
    """
    by_place = code_rows(places, properties)
    sites = by_place.select(*SITE).distinct()
    located = F.col("latitude_deg").isNotNull() & F.col("longitude_deg").isNotNull()

    order = Window.partitionBy("property", "code", "lat", "lon").orderBy("qid")
    points = (
        candidates.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .select("property", "code", "lat", "lon", "qid")
        .distinct()
        .withColumn("_n", F.row_number().over(order))
        .where("_n <= 2")
        .drop("_n")
    )

    left = _with_axes(sites.where(located), "latitude_deg", "longitude_deg")
    right = _with_axes(points, "lat", "lon")
    pairs = near_pairs(
        left, right, by=["property", "code"], axes=["_x", "_y", "_z"], radius=max_km, enough=2
    )
    distance = G.haversine_km(
        F.col("latitude_deg"), F.col("longitude_deg"), F.col("lat"), F.col("lon")
    )
    near = pairs.withColumn("km", distance).where(F.col("km") <= max_km).select(*SITE, "qid", "km")

    anywhere = Window.partitionBy("property", "code").orderBy("qid")
    first_two = points.select("property", "code", "qid").distinct()
    first_two = first_two.withColumn("_n", F.row_number().over(anywhere)).where("_n <= 2").drop("_n")
    unplaced = (
        sites.where(~located)
        .join(first_two, ["property", "code"])
        .select(*SITE, "qid", F.lit(0.0).alias("km"))
    )

    best = Window.partitionBy(*SITE).orderBy("km", "qid")
    ranked = (
        near.unionByName(unplaced)
        .withColumn("place", F.row_number().over(best))
        .where("place <= 2")
    )
    same_site = reduce(
        lambda a, b: a & b, [F.col(f"p.{name}").eqNullSafe(F.col(f"s.{name}")) for name in SITE]
    )
    return (
        by_place.alias("p")
        .join(ranked.alias("s"), same_site)
        .select("p.id", "p.rank", "p.property", "p.code", "s.qid", "s.km", "s.place")
    )


def _with_axes(df: DataFrame, lat: str, lon: str) -> DataFrame:
    x, y, z = G.chord_km(F.col(lat), F.col(lon))
    return df.withColumns({"_x": x, "_y": y, "_z": z})


def best_and_ambiguous(scored: DataFrame, radius_km: float = K.AMBIGUITY_KM) -> DataFrame:
    """Per place and property the nearest candidate, and whether the next is too close to tell."""
    first, second = F.col("place") == 1, F.col("place") == 2
    return (
        scored.groupBy("id", "rank", "property", "code")
        .agg(
            F.max(F.when(first, F.col("qid"))).alias("qid"),
            F.max(F.when(first, F.col("km"))).alias("km"),
            F.max(F.when(second, F.col("km"))).alias("next_km"),
        )
        .withColumn(
            "ambiguous",
            F.coalesce(F.abs(F.col("next_km") - F.col("km")) < radius_km, F.lit(False)),
        )
    )


def match_cascade(
    places: DataFrame,
    candidates: DataFrame,
    properties: Mapping[str, str] = K.CODE_PROPERTIES,
    max_km: float = K.MAX_DISTANCE_KM,
    radius_km: float = K.AMBIGUITY_KM,
) -> DataFrame:
    """One row per matched place: the first property with any candidate in range decides.

    An ambiguous match stays, flagged; it does not fall through to the next property.
    """
    best = best_and_ambiguous(match_by_code(places, candidates, properties, max_km), radius_km)
    fields = ["rank", "property", "code", "qid", "km", "ambiguous"]
    return (
        best.groupBy("id")
        .agg(F.min(F.struct(*fields)).alias("m"))
        .select("id", *[F.col(f"m.{name}") for name in fields[1:]])
    )


def _edges(subclass_of: DataFrame) -> DataFrame:
    edges = subclass_of.select(F.col("child").alias("node"), F.col("parent").alias("target"))
    return written(edges.where("node is not null and target is not null").distinct())


def _doubled(steps: DataFrame, more: DataFrame) -> DataFrame:
    """Two jumps in a row as one."""
    first = steps.select("node", F.col("target").alias("_via"))
    return first.join(more.select(F.col("node").alias("_via"), "target"), "_via").select("node", "target").distinct()


def class_closure(subclass_of: DataFrame, roots: Sequence[object]) -> DataFrame:
    """The root classes and all their transitive subclasses, from (child, parent) edges.

    Jumps double in length with each round: a class that can jump to a known one is known, and the others jump twice.
    A hierarchy of n levels is done in about log2(n) rounds, cycles or not: once a round finds nothing, no class is
    farther away. `known` and the jumps are tables that each round writes anew, so plans stay short, each round reads
    what it needs once, and a lost executor's work is redone from the files.
    """
    spark = subclass_of.sparkSession
    jumps = _edges(subclass_of)
    kind = jumps.schema["target"].dataType
    known = spark.createDataFrame([(root,) for root in roots], ["node"]).select(F.col("node").cast(kind)).distinct()
    while True:
        there = known.withColumnRenamed("node", "target")
        reached = jumps.join(there, "target", "left_semi").select("node").distinct()
        fresh = written(reached.join(known, "node", "left_anti"))
        if fresh.isEmpty():
            return known
        known = written(known.unionByName(fresh))
        waiting = written(jumps.join(known, "node", "left_anti"))
        arrived = waiting.join(known.withColumnRenamed("node", "target"), "target", "left_semi").select("node", "target")
        jumps = written(_doubled(waiting, waiting).unionByName(arrived).distinct())


def closure(subclass_of: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(root, node, distance): every class below every root, at its least distance, the root itself at 0.

    `roots` has one column of classes; without it every class that is a parent is a root. All roots go at once, in
    about log2(levels) rounds: what is known up to a distance, reached by jumps of that length, is known up to twice
    the distance. The pairs are the result and as many as the hierarchy has; the jumps of a round are pairs too.
    """
    jumps = _edges(subclass_of)
    if roots is None:
        roots = jumps.select("target")
    first = roots.columns[0]
    start = roots.select(F.col(f"`{first}`").cast(jumps.schema["target"].dataType).alias("root")).distinct()
    known = written(
        start.where("root is not null").select("root", F.col("root").alias("node"), F.lit(0).cast("long").alias("distance"))
    )
    length, count = 1, known.count()
    while True:
        below = known.select("root", F.col("node").alias("target"), (F.col("distance") + length).alias("distance"))
        longer = jumps.join(below, "target").select("root", "node", "distance")
        known = written(known.unionByName(longer).groupBy("root", "node").agg(F.min("distance").alias("distance")))
        before, count = count, known.count()
        if count == before:
            return known
        length, jumps = 2 * length, written(_doubled(jumps, jumps))


def members_of(instance_of: DataFrame, subclass_of: DataFrame, roots: Sequence[object]) -> DataFrame:
    """Entities whose class is a root or one of its transitive subclasses."""
    classes = class_closure(subclass_of, roots).select(F.col("node").alias("class"))
    return instance_of.join(classes, "class", "left_semi").select("entity").distinct()


def members_of_each(instance_of: DataFrame, subclass_of: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, entity): the entities of many roots at once, each under every root above its classes."""
    classes = closure(subclass_of, roots).select("root", F.col("node").alias("class"))
    held = instance_of.select("entity", "class").distinct()
    return held.join(classes, "class").select("root", "entity").distinct()
