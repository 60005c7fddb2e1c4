"""Publishing joined snapshots and reading them back."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.operators.quality import DataRejected


def attach_names(places: DataFrame, names: DataFrame) -> DataFrame:
    """Add the six name columns by id; places without an entry get NULLs.

    The table of names grows with the places, so no side is forced: Spark broadcasts it while it
    is small and shuffles both by id when it is not.
    """
    return places.join(names.select("id", *K.ATTACHED_NAME_COLUMNS), "id", "left")


def project_published(places: DataFrame) -> DataFrame:
    """The published fields in their order."""
    return places.select(*K.PUBLISHED_FIELDS)


def positional_row(fields: tuple[str, ...] = K.PUBLISHED_FIELDS) -> Column:
    """A row as one JSON array text in field order, NULLs as null."""
    return F.to_json(F.array(*[F.col(name).cast("variant") for name in fields]))


def publish_rows(places: DataFrame, names: DataFrame) -> DataFrame:
    return project_published(attach_names(places, names)).orderBy("id")


def publish_snapshot(places: DataFrame, names: DataFrame, path: str, positional: bool = False) -> None:
    """Gzip JSON lines, sorted by id over all part files; objects or positional arrays."""
    rows = publish_rows(places, names)
    if positional:
        rows.select(positional_row().alias("value")).write.mode("overwrite").text(path, compression="gzip")
    else:
        rows.write.mode("overwrite").json(path, compression="gzip", ignoreNullFields=False)


def manifest_counts(places: DataFrame) -> DataFrame:
    """One row: published rows, rows per type as JSON, named rows, unresolved targets."""
    named = F.coalesce(F.col("name_zh") != "", F.lit(False))
    target = F.col("type").isin(*K.TARGET_TYPES)
    counts = [F.count_if(F.col("type") == name).alias(name) for name in sorted(K.PLACE_TYPES)]
    shown = [F.nullif(F.col(name), F.lit(0)).alias(name) for name in sorted(K.PLACE_TYPES)]
    return places.agg(
        F.count(F.lit(1)).alias("row_count"),
        *counts,
        F.count_if(named).alias("named_rows"),
        F.count_if(target & ~named).alias("unresolved_targets"),
    ).select(
        "row_count", F.to_json(F.struct(*shown)).alias("type_counts"), "named_rows", "unresolved_targets"
    )


def publish_manifest(
    places: DataFrame,
    generated_at: datetime,
    source: dict | None = None,
    names: dict | None = None,
    snapshot: dict | None = None,
) -> DataFrame:
    """A single-row table whose JSON describes a published snapshot."""

    def described(values: dict | None) -> Column:
        pairs = [F.lit(value).alias(key) for key, value in (values or {}).items()]
        return F.struct(*pairs) if pairs else F.lit(None).cast("struct<path:string>")

    return manifest_counts(places).select(
        F.lit(K.SCHEMA_VERSION).alias("schemaVersion"),
        F.lit(generated_at.isoformat()).alias("generatedAt"),
        F.col("row_count").alias("rows"),
        described(snapshot).alias("snapshot"),
        described(source).alias("source"),
        described(names).alias("names"),
        F.from_json("type_counts", "map<string,bigint>").alias("typeCounts"),
        F.col("named_rows").alias("namedRows"),
        F.col("unresolved_targets").alias("unresolvedTargets"),
        F.array(*[F.lit(name) for name in K.PUBLISHED_FIELDS]).alias("fields"),
    )


def check_manifest(manifest: DataFrame) -> list[str]:
    """The field order a manifest declares; unknown versions and missing fields are errors."""
    row = manifest.select("schemaVersion", "fields").first()
    if row is None or row["schemaVersion"] != K.SCHEMA_VERSION:
        raise DataRejected(f"unknown schemaVersion {row and row['schemaVersion']}")
    fields = list(row["fields"] or [])
    missing = [name for name in K.PUBLISHED_REQUIRED if name not in fields]
    if missing:
        raise DataRejected(f"published fields lack {missing}")
    return fields


def parse_published(lines: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Published rows from the JSON texts in `value`; `fields` gives the order of array rows.

    A value of the wrong type counts as missing. Rows without a known type, a finite coordinate,
    an id, an ident or a name are skipped.
    """
    known = [name for name in K.PUBLISHED_FIELDS if fields is None or name in fields]
    paths = [f"$.{name}" if fields is None else f"$[{fields.index(name)}]" for name in known]
    row = F.try_parse_json("value")
    values = F.array(*[F.try_variant_get("row", path, "variant") for path in paths])
    cells = F.transform(
        values,
        lambda value: F.struct(
            F.schema_of_variant(value).alias("kind"),
            F.try_variant_get(value, "$", "string").alias("shown"),
        ),
    )
    parsed_rows = lines.select(row.alias("row")).where(F.col("row").isNotNull())
    # Exploding the one cell list keeps the filter below from moving into the parsing, where every
    # condition would parse the row again.
    typed = parsed_rows.select(F.explode(F.array(cells)).alias("cells"))

    def cell(name: str) -> Column:
        if name not in known:
            return F.lit(None).cast("struct<kind:string,shown:string>")
        return F.get("cells", F.lit(known.index(name)))

    def text(name: str) -> Column:
        return F.when((cell(name)["kind"] == "STRING") & (cell(name)["shown"] != ""), cell(name)["shown"])

    def number(name: str) -> Column:
        numeric = cell(name)["kind"].rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        parsed = F.when(numeric, cell(name)["shown"].try_cast("double"))
        return F.when(F.abs(parsed) < F.lit(float("inf")), parsed)

    columns = {name: number(name) if name in K.PUBLISHED_NUMBERS else text(name) for name in K.PUBLISHED_FIELDS}
    # Whole numbers keep all their digits; only fractional kinds go through a double.
    for name, kind in (("id", "bigint"), ("elevation_ft", "int")):
        whole = F.when(cell(name)["kind"] == "BIGINT", cell(name)["shown"].try_cast(kind))
        columns[name] = F.coalesce(whole, columns[name].try_cast(kind))
    rows = typed.select(*[column.alias(name) for name, column in columns.items()])
    complete = F.col("type").isin(*K.PLACE_TYPES)
    for name in K.PUBLISHED_REQUIRED:
        complete = complete & F.col(name).isNotNull()
    return rows.where(complete)


def read_published(spark: SparkSession, path: str, manifest: str | None = None) -> DataFrame:
    """Published rows of a folder; with a manifest the rows are positional arrays."""
    fields = check_manifest(spark.read.json(manifest)) if manifest else None
    return parse_published(spark.read.text(path), fields)
