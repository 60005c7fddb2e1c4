"""Row rules, key rules and gates that a snapshot must pass before it may change the state."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import text as T


class DataRejected(RuntimeError):
    """The input breaks a rule and may not be used."""


def type_rows(raw: DataFrame, ragged: Column | None = None) -> DataFrame:
    """Typed snapshot columns plus `reason`, the first rule a row breaks (NULL for a good row).

    `ragged` tells the rows whose number of cells is wrong; that rule comes before all others.
    """

    def unreadable(name: str) -> Column:
        return F.when(T.clean(name).isNotNull() & F.col(f"_{name}").isNull(), f"{name} is not a number")

    def outside(name: str, domain: Iterable[str], required: bool = False) -> Column:
        value = T.clean(name)
        allowed = F.coalesce(value.isin(*domain), F.lit(not required))
        return F.when(~allowed, f"{name} is not an allowed value")

    parsed = {
        "id": T.parse_long("id"),
        "latitude_deg": T.parse_optional_double("latitude_deg"),
        "longitude_deg": T.parse_optional_double("longitude_deg"),
        "elevation_ft": T.parse_optional_int("elevation_ft"),
    }
    checked = raw.withColumns({f"_{name}": value for name, value in parsed.items()})
    shape = F.lit(False) if ragged is None else ragged
    reason = F.coalesce(
        F.when(shape, "wrong number of cells"),
        F.when(T.clean("ident").isNull(), "ident is empty"),
        F.when(T.clean("name").isNull(), "name is empty"),
        outside("type", K.PLACE_TYPES, required=True),
        outside("continent", K.CONTINENTS),
        outside("scheduled_service", K.SCHEDULED_VALUES),
        F.when(F.col("_id").isNull(), "id is not a whole number"),
        unreadable("latitude_deg"),
        unreadable("longitude_deg"),
        unreadable("elevation_ft"),
    )
    columns = [
        (F.col(f"_{name}") if name in parsed else T.clean(name)).alias(name)
        for name in K.SOURCE_COLUMNS
    ]
    return checked.select(*columns, reason.alias("reason"), F.col("id").alias("raw_id"))


def validate_rows(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw text rows into good typed rows and rejects with their reason."""
    typed = type_rows(raw)
    good = typed.where(F.col("reason").isNull()).select(*K.SOURCE_COLUMNS)
    rejects = typed.where(F.col("reason").isNotNull()).select("raw_id", "ident", "reason")
    return good, rejects


def require_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once, per column; an empty result means every key is unique."""
    repeated = [
        df.where(F.col(name).isNotNull())
        .groupBy(F.col(name).cast("string").alias("value"))
        .count()
        .where("count > 1")
        .select(F.lit(name).alias("key"), "value", F.col("count").alias("rows"))
        for name in columns
    ]
    result = repeated[0]
    for other in repeated[1:]:
        result = result.unionByName(other)
    return result


def sanity_gate(df: DataFrame, min_rows: int = K.MIN_ROWS, min_large: int = K.MIN_LARGE) -> DataFrame:
    """One row: how many rows and large places there are and whether that is enough."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(F.col("type") == "large_airport").alias("rows_large"),
    ).withColumn("ok", (F.col("rows_total") >= min_rows) & (F.col("rows_large") >= min_large))


def row_hash(columns: Iterable[str] = K.SOURCE_COLUMNS) -> Column:
    """Digest over the named columns in their order, NULLs included."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def set_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Distinct rows of `expected` that `actual` lacks, sorted."""
    return expected.subtract(actual).orderBy(*expected.columns)


def check_contract(spark: SparkSession, expected: Mapping[str, Iterable[str]]) -> DataFrame:
    """Missing tables, views and columns, one row each; reads the catalog, not the data."""
    problems = []
    for name, columns in expected.items():
        if not spark.catalog.tableExists(name):
            problems.append((name, None, "missing table or view"))
            continue
        present = {column.name for column in spark.catalog.listColumns(name)}
        problems += [(name, column, "missing column") for column in columns if column not in present]
    return spark.createDataFrame(problems, "object string, column string, problem string").orderBy(
        "object", "column"
    )


def enforce(problems: DataFrame, message: str) -> None:
    """Raise with a few examples when the problem table has any row."""
    examples = problems.limit(5).collect()
    if examples:
        raise DataRejected(f"{message}: {[row.asDict() for row in examples]}")


def enforce_gate(gate: DataFrame) -> tuple[int, int]:
    """Raise unless the gate row says ok; returns its two counts."""
    row = gate.first()
    if not row["ok"]:
        raise DataRejected(
            f"only {row['rows_total']} rows and {row['rows_large']} large places, below the safe limit"
        )
    return row["rows_total"], row["rows_large"]
