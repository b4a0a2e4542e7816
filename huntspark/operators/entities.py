"""Entities of alerts and what they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntspark.functions.fixed import ENTITY_TYPES
from huntspark.functions.names import q

FIELD, VALUE = "x_entities_field", "x_entities_value"


def _logical_type(kind: Column) -> Column:
    out = F.lit(None).cast("string")
    for logical, names in reversed(ENTITY_TYPES.items()):
        out = F.when(kind.isin(names), logical).otherwise(out)
    return out


def _entity(text: Column) -> Column:
    """``type:value`` as a (field, value) struct; without a known type or without a colon a part of it is null."""
    kind = F.substring_index(text, ":", 1)
    value = F.when(F.contains(text, F.lit(":")), F.substr(text, F.length(kind) + 2))
    return F.struct(_logical_type(kind).alias("field"), value.alias("value"))


def entity_set(column: Column) -> Column:
    """The distinct logical entities of one alert, sorted."""
    known = F.filter(F.transform(column, _entity), lambda e: e["field"].isNotNull() & e["value"].isNotNull())
    return F.array_sort(F.array_distinct(known))


def entity_rows(df: DataFrame, column: str = "entities.entities") -> DataFrame:
    """One row per listed entity with a logical type, duplicates included."""
    rows = df.withColumn("__entity", F.explode(q(column))).withColumn("__e", _entity(F.col("__entity")))
    rows = rows.withColumns({FIELD: F.col("__e.field"), VALUE: F.col("__e.value")}).drop("__entity", "__e")
    return rows.dropna(subset=[FIELD, VALUE])


def normalize_entities(df: DataFrame, column: str = "entities.entities", unique_ids: bool = False) -> DataFrame:
    """One row per distinct (alert id, field, value). Alerts without known entities contribute nothing.

    ``unique_ids``: every alert is one row of ``df``, so its entities are made distinct in the row and nothing is shuffled.
    """
    if not unique_ids:
        return entity_rows(df, column).dropDuplicates(["id", FIELD, VALUE])
    rows = df.withColumn("__e", F.explode(entity_set(q(column))))
    return rows.withColumns({FIELD: F.col("__e.field"), VALUE: F.col("__e.value")}).drop("__e")


def keep_logical_type(df: DataFrame, field: str) -> DataFrame:
    return df.where(q(FIELD) == field)


BLOCK = 256  # entities of an alert that are paired in its own row


def relate_entities(df: DataFrame, column: str = "entities.entities", block: int = BLOCK) -> DataFrame:
    """Which values appear together in an alert: (value, related_field, related_value), each once.

    A value is the same entity whichever fields it appears in. Long form on purpose: a value that is everywhere is related to most
    others, and such a list does not fit a row. The entities of an alert stand in its row, so no join is needed; alerts with
    the same entities are merged first and only distinct relations reach the last shuffle. An alert of more than ``block``
    entities is dealt out as pairs of blocks, so its pairs come from many tasks.
    """
    sets = df.select(entity_set(q(column)).alias("s")).where(F.size("s") > 1).distinct()
    whole = sets.where(F.size("s") <= block).select(F.col("s").alias("one"), F.col("s").alias("two"))
    starts = F.sequence(F.lit(1), F.size("s"), F.lit(block))
    cuts = sets.where(F.size("s") > block).withColumn("blocks", F.transform(starts, lambda k: F.slice("s", k, block)))
    rows = cuts.select(F.xxhash64("s").alias("id"), "blocks", F.posexplode("blocks").alias("i", "one"))
    dealt = rows.select("id", "i", "one", F.posexplode("blocks").alias("j", "two")).repartition("id", "i", "j")
    pairs = whole.unionByName(dealt.select("one", "two")).select(F.explode("one").alias("e"), "two").select("e", F.explode("two").alias("o"))
    return (
        pairs.where(F.col("o.value") != F.col("e.value"))
        .select(
            F.col("e.value").alias("value"),
            F.col("o.field").alias("related_field"),
            F.col("o.value").alias("related_value"),
        )
        .distinct()
    )


def relation_counts(relations: DataFrame) -> DataFrame:
    """How many values of each logical type an entity is related to, one row per entity."""
    per_type = [
        F.count_if(F.col("related_field") == name).alias("related_" + name.strip("@")) for name in ENTITY_TYPES
    ]
    return relations.groupBy("value").agg(*per_type)


def entity_alerts(df: DataFrame, column: str = "entities.entities", unique_ids: bool = False) -> DataFrame:
    """Distinct (field, value, alert id)."""
    return normalize_entities(df.select("id", q(column)), column, unique_ids).select(
        q(FIELD).alias("field"), q(VALUE).alias("value"), "id"
    )


def entity_alert_counts(df: DataFrame, column: str = "entities.entities") -> DataFrame:
    """Number of distinct alerts per entity."""
    return entity_alerts(df, column).groupBy("field", "value").agg(F.count("*").alias("alerts"))
