"""Global order and numbering without pulling all rows into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoledger.session import written


def ordered(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows sorted by key; Spark range-partitions before it sorts."""
    return df.orderBy(key)


#: Rows of a slice, on average; there are as many slices as shuffle partitions at least.
ROWS_A_SLICE = 1_000_000


def numbered(df: DataFrame, key: str, name: str = "rn", slices: int | None = None) -> DataFrame:
    """Add the 1-based position by a unique key.

    Rows are range-partitioned by the key into slices and written once with the number of their slice. Slices are
    numbered on their own and shifted by the sizes of those before; both steps read the written table, so they agree on
    the slices and a task that runs again gives the same numbers. The number of slices follows the number of rows.
    """
    if slices is None:
        parallel = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slices = max(parallel, -(-df.select(key).count() // ROWS_A_SLICE))
    sliced = written(df.repartitionByRange(slices, key).withColumn("_slice", F.spark_partition_id()))
    # One row a slice, so one task for the running total is enough.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        sliced.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    )
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(key))
    return (
        sliced.withColumn("_inside", inside)
        .join(shift, "_slice")
        .withColumn(name, F.col("_inside") + F.col("_shift"))
        .drop("_slice", "_inside", "_shift")
    )
