"""Reading geographic features and writing boundary levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.operators.boundaries import LevelSpec, level_stats
from geoledger.operators.quality import DataRejected, enforce
from geoledger.session import written
from geoledger.sources.records import placed_lines

_GEOMETRY = "geometry:struct<type:string,coordinates:string,geometries:string>"
_FEATURE = f"struct<properties:map<string,string>,{_GEOMETRY}>"
_LINE = f"struct<type:string,properties:map<string,string>,{_GEOMETRY},_bad:string>"


def feature_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Features of files with one on each line, and the lines that are none.

    The first table is that of read_geojson; a feature is known by its file and place there, so equal lines are two
    features. The second is (path, offset, reason, line): lines that are not JSON, another kind of object, or a geometry
    without a kind or coordinates. A feature without a geometry is one. Blank lines are skipped.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    lines = placed_lines(spark, path).where(F.trim(F.translate("value", "\r\t", "  ")) != "")
    shape, kind = F.col("f.geometry"), F.col("f.type")
    reason = (
        F.when(F.col("f").isNull() | F.col("f._bad").isNotNull(), "not a JSON object")
        .when(kind.isNotNull() & (kind != "Feature"), "not a feature")
        .when(F.col("f.properties").isNull() & shape.isNull() & kind.isNull(), "not a feature")
        .when(shape.isNotNull() & shape["type"].isNull(), "geometry without a kind")
        .when(shape.isNotNull() & shape["coordinates"].isNull() & shape["geometries"].isNull(), "geometry without coordinates")
    )
    parsed = written(
        lines.withColumn("f", F.from_json("value", _LINE, options)).select("path", "offset", "value", "f", reason.alias("reason"))
    )
    good = parsed.where("reason IS NULL").select(F.xxhash64("path", "offset").alias("feature"), "f")
    bad = parsed.where("reason IS NOT NULL").select("path", "offset", "reason", F.col("value").alias("line"))
    return _columns(good), bad


def read_geojson(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(feature, properties, kind, coordinates) from feature collections or feature lines.

    A collection is one JSON document and so one record; Spark reads the documents of a folder in
    parallel. Large layers should come as one feature per line (`lines=True`), which Spark splits.
    Raises for a document that is no collection, and for lines that are no feature.
    """
    if lines:
        features, rejects = feature_lines(spark, path)
        enforce(rejects.select("path", "offset", "reason"), f"{path}: lines that are no feature")
        return features
    schema = f"type string, features array<{_FEATURE}>"
    documents = spark.read.schema(schema).option("multiLine", True).json(path)
    if documents.where("type is null or type <> 'FeatureCollection'").limit(1).collect():
        raise DataRejected(f"{path} is not a FeatureCollection")
    numbered = documents.select(
        F.xxhash64(F.col("_metadata.file_path")).alias("file"), F.posexplode("features").alias("pos", "f")
    )
    return _columns(numbered.select(F.xxhash64("file", "pos").alias("feature"), "f"))


def _columns(features: DataFrame) -> DataFrame:
    return features.select(
        "feature",
        F.col("f.properties").alias("properties"),
        F.col("f.geometry.type").alias("kind"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    )


def write_boundary_level(
    rings: DataFrame, path: str, specs: Sequence[LevelSpec] = K.LEVEL_SPECS, source: str | None = None
) -> DataFrame:
    """Gzip JSON lines per layer and level under `path`; returns the manifest rows.

    A row has the counts of a level, its settings, its folder, where it came from, and the bytes of
    its lines before and after compression.
    """
    rings.write.mode("overwrite").partitionBy("layer", "level").json(path, compression="gzip")
    spark = rings.sparkSession
    rows = spark.read.schema(
        "feature bigint, iso string, name string, polygon int, ring_index int, flat array<double>, "
        "layer string, level string"
    ).json(path)
    settings = spark.createDataFrame(
        [tuple(spec) for spec in specs], "layer string, level string, tolerance double, min_area double, decimals int"
    )
    levels = ["layer", "level"]
    raw = spark.read.text(path).groupBy(*levels).agg(F.sum(F.octet_length("value") + 1).alias("raw_bytes"))
    stored = spark.read.format("binaryFile").load(path).groupBy(*levels).agg(F.sum("length").alias("stored_bytes"))
    folder = F.concat(F.lit(f"{path}/layer="), "layer", F.lit("/level="), "level")
    return (
        level_stats(rows)
        .join(settings, levels)
        .join(raw, levels)
        .join(stored, levels)
        .select("*", folder.alias("path"), F.lit(source).cast("string").alias("source"))
        .withColumn("attribution", F.lit(K.BOUNDARY_ATTRIBUTION))
    )
