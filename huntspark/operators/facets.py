"""Counts of the columns an analyst sees first, for many event schemas in one scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from huntspark.functions.fixed import DEFAULT_COLUMNS
from huntspark.functions.names import q
from huntspark.plans.lineage_cut import cut

# Longest preview of a script text.
PREVIEW = 200


# Schemas whose facets have columns of their own; of any other schema all columns count.
FACET_SCHEMAS = ["auth", "thirdpartyalert", "dnsquery", "cloudaudit", "http", "netflow", "nids", "process", "scriptblock"]
_SAME_COLUMNS = {"thirdpartyalert": "thirdparty"}


def _names(df: DataFrame, schema: str, extra: list[str]) -> list[str]:
    return [c for c in [*DEFAULT_COLUMNS.get(_SAME_COLUMNS.get(schema, schema), []), *extra] if c in df.columns]


def _facet(names: list[str], missing: str | None) -> Column:
    """``column=value|…`` of the values of ``names``; only here long scripts are shortened."""
    parts = []
    for k, name in enumerate(names):
        value = F.get("values", F.lit(k))
        if name == "decoded_block_text":
            value = F.substring(value, 1, PREVIEW)
        if missing is not None:
            value = F.coalesce(value, F.lit(missing))
        parts += [F.lit(f"{'|' if parts else ''}{name}="), value]
    return F.concat(*parts) if parts else F.lit("")


def _by_schema(schema: Column, schemas: list[str], of) -> Column:
    return reduce(lambda chain, s: chain.when(schema == s, of(s)), schemas[1:], F.when(schema == schemas[0], of(schemas[0])))


def _counts(df: DataFrame, schema: Column, schemas: list[str], extra: list[str], missing: str | None) -> DataFrame:
    """Counted by the whole values, so neither long texts, nor separators in them, nor a text like ``missing`` meet."""

    def values(s: str) -> Column:
        return F.array(*[q(c).cast("string") for c in _names(df, s, extra)]).cast("array<string>")

    rows = df.where(schema.isin(schemas)).select(schema.alias("schema"), _by_schema(schema, schemas, values).alias("values"))
    if missing is None:
        rows = rows.where(~F.exists("values", lambda v: v.isNull()))
    counted = rows.groupBy("schema", "values").agg(F.count("*").alias("count"))
    facet = _by_schema(F.col("schema"), schemas, lambda s: _facet(_names(df, s, extra), missing))
    return counted.select("schema", facet.alias("facet"), "count")


def facets_by_schema(df: DataFrame, schema: Column, schemas: list[str] | None = None, extra: list[str] | None = None) -> DataFrame:
    """(schema, facet, count) over each schema's columns, of all schemas or the given ones.

    A schema without columns of its own is counted by all columns of ``df``. Columns that a schema never fills are left out of
    its facets; rows that miss one of the others do not count. One aggregation counts whole values for all schemas, without
    their names, which the schema gives; another finds the filled columns: a row for each schema.
    """
    rows = df.withColumn("__schema", schema)
    rows = rows.where(F.col("__schema").isin(schemas) if schemas is not None else F.col("__schema").isNotNull())
    listed = {s: _names(df, s, extra or []) for s in FACET_SCHEMAS}

    def texts(of) -> Column:
        """``of`` each column that counts for the row's schema."""
        def each(names: list[str]) -> Column:
            return F.array(*[of(c) for c in names]).cast("array<string>")

        return reduce(lambda chain, s: chain.when(F.col("__schema") == s, each(listed[s])), FACET_SCHEMAS, F.when(F.lit(False), each([]))).otherwise(each(df.columns))

    counted = rows.select("__schema", texts(lambda c: q(c).cast("string")).alias("held")).groupBy("__schema", "held").agg(F.count("*").alias("count"))
    filled = [F.when(F.count(q(c)) > 0, F.lit(c)) for c in df.columns]
    present = rows.groupBy(F.col("__schema").alias("schema")).agg(F.array_compact(F.array(*filled)).alias("present"))
    # written, so that the join is by key even where all rows are of one literal schema
    joined = cut(counted).join(cut(present), F.col("__schema") == F.col("schema"))
    named = joined.withColumn("held", F.zip_with(texts(F.lit), "held", lambda n, v: F.struct(n.alias("name"), v.alias("value"))))
    kept = named.withColumn("held", F.expr("filter(held, p -> array_contains(present, p.name))")).where(~F.exists("held", lambda p: p["value"].isNull()))
    shown = F.transform(
        "held",
        lambda p: F.concat(p["name"], F.lit("="), F.when(p["name"] == "decoded_block_text", F.substring(p["value"], 1, PREVIEW)).otherwise(p["value"])),
    )
    return kept.select("schema", F.array_join(shown, "|").alias("facet"), "count")


def top_by_schema(df: DataFrame, schema: Column, schemas: list[str], n: int = 20) -> DataFrame:
    """The ``n`` most frequent facets of each schema, missing values shown as ``null``, ties by text.

    Spark keeps only ``n`` rows per schema and task before the rows of a schema meet.
    """
    counts = _counts(df, schema, schemas, [], "null")
    order = Window.partitionBy("schema").orderBy(F.desc("count"), "facet")
    return counts.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= n).drop("__rank")
