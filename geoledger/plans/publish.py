"""The publishing jobs: joined snapshot with manifest, and boundary levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.operators.boundaries import LevelSpec, build_levels
from geoledger.operators.quality import enforce, enforce_gate, require_unique, sanity_gate
from geoledger.plans.collect import checked_snapshot
from geoledger.sources.geojson import read_geojson, write_boundary_level
from geoledger.sources.names import read_names
from geoledger.sources.published import publish_manifest, publish_rows, publish_snapshot
from geoledger.sources.snapshot import snapshot_meta, source_digest


def publish_job(
    spark: SparkSession,
    snapshot_path: str,
    names_path: str,
    out_path: str,
    *,
    generated_at: datetime | None = None,
    positional: bool = True,
    min_rows: int = K.MIN_ROWS,
    min_large: int = K.MIN_LARGE,
    multi_line: bool = False,
) -> dict:
    """Write `out/rows` and `out/manifest` and return the manifest."""
    places = checked_snapshot(spark, snapshot_path, multi_line)
    enforce(require_unique(places, "id", "ident"), f"{snapshot_path}: keys that occur twice")
    enforce_gate(sanity_gate(places, min_rows, min_large))
    names = read_names(spark, names_path)
    rows = publish_rows(places, names)
    publish_snapshot(places, names, f"{out_path}/rows", positional)
    written = source_digest(snapshot_meta(spark, f"{out_path}/rows")).first()
    source = source_digest(snapshot_meta(spark, snapshot_path)).first()
    named = source_digest(snapshot_meta(spark, names_path)).first()
    manifest = publish_manifest(
        rows,
        generated_at or datetime.now(timezone.utc),
        source={"url": snapshot_path, "sha256": source["source_sha256"], "rowCount": places.count()},
        names={"file": names_path, "sha256": named["source_sha256"], "rowCount": names.count()},
        snapshot={
            "path": "rows",
            "storedBytes": written["source_bytes"],
            "uncompressedBytes": spark.read.text(f"{out_path}/rows").agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0,
            "sha256": written["source_sha256"],
            "compressed": True,
        },
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{out_path}/manifest")
    return spark.read.schema(manifest.schema).json(f"{out_path}/manifest").first().asDict(True)


def boundary_job(
    spark: SparkSession,
    sources: dict[tuple[str, str], str],
    out_path: str,
    specs: Sequence[LevelSpec] = K.LEVEL_SPECS,
    lines: bool = False,
    label_fields: Mapping[tuple[str, str], str] | None = None,
) -> DataFrame:
    """Build every level from its source file, write them and the manifest; returns the manifest.

    `label_fields` names the property that holds the names of a level, where it is not the usual one.
    """
    fields = label_fields or {}
    parts = [
        read_geojson(spark, path, lines).withColumns(
            {
                "layer": F.lit(layer),
                "level": F.lit(level),
                "label_field": F.lit(fields.get((layer, level), K.NAME_PROPERTIES[0])),
            }
        )
        for (layer, level), path in sources.items()
    ]
    features = parts[0]
    for part in parts[1:]:
        features = features.unionByName(part)
    origin = spark.createDataFrame(
        [(*level, path) for level, path in sources.items()], "layer string, level string, source string"
    )
    manifest = write_boundary_level(build_levels(features, specs), f"{out_path}/levels", specs)
    manifest = manifest.drop("source").join(origin, ["layer", "level"])
    manifest.coalesce(1).write.mode("overwrite").json(f"{out_path}/manifest")
    return spark.read.schema(manifest.schema).json(f"{out_path}/manifest")
