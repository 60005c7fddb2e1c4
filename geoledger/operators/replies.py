"""Name requests to, and replies from, a completion service, both as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger import constants as K
from geoledger.functions import text as T
from geoledger.operators.ordering import numbered

# A quoted text, which may lack its end; a brace; or anything else.
_PARTS = r'(?s)"(?:[^"\\]++|\\.)*+(?:"|\z)|[{}]|[^{}"]++'


def request_batches(pending: DataFrame, size: int = K.REPLY_BATCH_SIZE) -> DataFrame:
    """Rows without a name packed by id: (batch_id, size, first_id, last_id, requests).

    `requests` is the ordered JSON list of one batch, never more than `size` objects.
    """
    request = F.struct(
        "id",
        "name",
        F.coalesce("iso_country", F.lit("")).alias("country"),
        F.coalesce("municipality", F.lit("")).alias("city"),
    )
    placed = request_members(pending, size, F.to_json(request).alias("request"))
    ordered = F.array_sort(F.collect_list(F.struct("id", "request")))
    return placed.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.concat(F.lit("["), F.array_join(F.transform(ordered, lambda r: r["request"]), ","), F.lit("]")).alias(
            "requests"
        ),
    )


def request_members(
    pending: DataFrame, size: int = K.REPLY_BATCH_SIZE, *columns: Column | str
) -> DataFrame:
    """(batch_id, id): which batch expects which id."""
    placed = numbered(pending.select("id", *columns), "id", "rn")
    return placed.withColumn("batch_id", F.floor((F.col("rn") - 1) / size)).drop("rn")


def outer_objects(text: Column) -> Column:
    """The outermost objects of a text, nested to any depth, in order.

    One pass over its quoted texts and braces counts the depth. Braces inside quotes do not count, quotes outside
    objects hide what is in them, and an object that never ends is none.
    """

    def step(state: Column, part: Column) -> Column:
        inside = (state["depth"] > 0) | (part == "{")
        depth = F.when(part == "{", state["depth"] + 1).when(part == "}", F.greatest(state["depth"] - 1, F.lit(0)))
        after = depth.otherwise(state["depth"])
        grown = F.when(inside, F.concat(state["open"], part)).otherwise(state["open"])
        closed = inside & (after == 0)
        return F.struct(
            after.alias("depth"),
            F.when(closed, F.lit("")).otherwise(grown).alias("open"),
            F.when(closed, F.concat(state["done"], F.array(grown))).otherwise(state["done"]).alias("done"),
        )

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("open"), F.array().cast("array<string>").alias("done"))
    return F.aggregate(F.regexp_extract_all(text, F.lit(_PARTS), F.lit(0)), start, step, lambda s: s["done"])


def reply_objects(replies: DataFrame) -> DataFrame:
    """Every JSON object in a reply as rows (batch_id, position, id, is_text, value)."""
    pieces = outer_objects(F.col("reply"))
    parsed = replies.select("batch_id", F.posexplode(pieces).alias("position", "piece"))
    strict = {"allowSingleQuotes": "false"}
    entries = F.map_entries(F.from_json("piece", "map<string,variant>", strict))
    rows = parsed.select("batch_id", "position", F.posexplode(entries).alias("turn", "entry"))
    value = F.col("entry.value")
    return rows.select(
        "batch_id",
        "position",
        "turn",
        T.parse_long("entry.key").alias("id"),
        (F.schema_of_variant(value) == "STRING").alias("is_text"),
        F.coalesce(F.is_variant_null(value), F.lit(True)).alias("is_null"),
        T.strip(F.try_variant_get(value, "$", "string")).alias("value"),
    ).where(F.col("id").isNotNull())


def reply_map(replies: DataFrame, expected: DataFrame) -> DataFrame:
    """(batch_id, id, value): the last object of a reply that answers any expected id.

    `expected` holds (batch_id, id). Values that are neither text nor null do not answer.
    """
    hits = (
        reply_objects(replies)
        .where(F.col("is_text") | F.col("is_null"))
        .join(expected.select("batch_id", "id").distinct(), ["batch_id", "id"])
        .groupBy("batch_id", "position", "id")
        .agg(F.max_by(F.when(F.col("is_text"), F.col("value")), "turn").alias("value"))
    )
    last = hits.groupBy("batch_id").agg(F.max("position").alias("position"))
    return hits.join(last, ["batch_id", "position"], "left_semi").select("batch_id", "id", "value")


def accepted_replies(answers: DataFrame, entries: DataFrame) -> DataFrame:
    """(id, name_zh) of the answers that pass the name rules."""
    known = entries.select("id", F.col("name").alias("english"))
    accepted = answers.join(known, "id").withColumn("name_zh", T.validate_name("value", "english"))
    return accepted.where(F.col("name_zh").isNotNull()).groupBy("id").agg(
        F.max_by("name_zh", "batch_id").alias("name_zh")
    )


