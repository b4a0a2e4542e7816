"""Column names: quoting, candidate pickers, flattening and prefixing.

Everything here looks at ``df.schema`` on the driver and costs no job, except ``drop_all_null`` which says so.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huntspark.functions.fixed import DEFAULT_COLUMNS

DERIVED = "x_"


def q(name: str) -> Column:
    """Column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def derived(name: str) -> str:
    """Name of a column this library adds: ``metadata.severity`` -> ``x_metadata_severity``."""
    return DERIVED + re.sub(r"\W+", "_", name)


def first_present(df: DataFrame, candidates: list[str], what: str) -> str:
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"no {what} column; expected one of {candidates}")


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def coalesce_columns(df: DataFrame, columns: list[str]) -> Column:
    """First non-null value among those of ``columns`` that exist."""
    present = [c for c in columns if c in df.columns]
    if not present:
        raise ValueError(f"none of the columns {columns} exists")
    return F.coalesce(*[q(c) for c in present])


def return_valid_column(df: DataFrame, column_list: list[str]) -> Column:
    if not column_list or not isinstance(column_list, list):
        raise ValueError("column list is empty or not a list")
    return coalesce_columns(df, column_list)


def get_tenant_id(df: DataFrame, column: str) -> Column:
    """Tenant id as clean text: number -> text, list -> its first element, text without brackets and quotes."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.ArrayType):
        return F.get(q(column), F.lit(0)).cast("string")
    if isinstance(dtype, T.IntegralType):
        return q(column).cast("string")
    if isinstance(dtype, T.StringType):
        return F.regexp_replace(q(column), r"[\[\]'\"]", "")
    raise ValueError(f"{column} of type {dtype.simpleString()} is not a tenant id")


def tenant_id_column(df: DataFrame) -> str:
    return first_present(df, ["tenant_id", "tenant.id", "event_data.tenant_id"], "tenant id")


def evidence_id_column(df: DataFrame) -> str:
    return first_present(df, [DERIVED + "evidence_id", "resource_id", "id"], "evidence id")


def host_id_column(df: DataFrame) -> str:
    for name in df.columns:
        if "host_id" in name and "asset_info." not in name:
            return name
    raise ValueError("no host_id column")


def default_schema_columns(schema: str) -> list[str]:
    return list(DEFAULT_COLUMNS.get(schema.lower(), []))


def select_schema_columns(df: DataFrame, schema: str) -> DataFrame:
    """The columns an analyst sees first for an event schema, as far as they exist."""
    return df.select(*[q(c) for c in default_schema_columns(schema) if c in df.columns])


def flatten_struct(df: DataFrame, max_level: int | None = 3) -> DataFrame:
    """Structs become dotted columns, ``max_level`` levels deep; arrays and maps stay as they are."""

    def walk(path: list[str], name: str, dtype: T.DataType, level: int) -> list[Column]:
        if isinstance(dtype, T.StructType) and (max_level is None or level < max_level):
            out: list[Column] = []
            for field in dtype.fields:
                out += walk([*path, field.name], f"{name}.{field.name}", field.dataType, level + 1)
            return out
        col = q(path[0])
        for part in path[1:]:
            col = col.getField(part)
        return [col.alias(name)]

    columns: list[Column] = []
    for field in df.schema.fields:
        columns += walk([field.name], field.name, field.dataType, 0)
    return df.select(*columns)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop columns without any value. Runs ONE aggregation job over ``df``; its result is a single row."""
    counts = df.agg(*[F.count(q(c)).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    return df.select(*[q(c) for i, c in enumerate(df.columns) if counts[i]])


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[q(c).alias(prefix + c) for c in df.columns])


def suffix_clashes(right: DataFrame, left: DataFrame, suffix: str) -> DataFrame:
    """Rename the columns of ``right`` that ``left`` has too; the names of ``left`` win."""
    taken = set(left.columns)
    return right.select(*[q(c).alias(c + suffix if c in taken else c) for c in right.columns])


def scalar_columns(df: DataFrame) -> list[str]:
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]


def drop_duplicates_by_hashables(df: DataFrame) -> DataFrame:
    """Drop rows that agree on every scalar column."""
    names = scalar_columns(df)
    if len(names) == len(df.columns):
        return df.distinct()
    return df.dropDuplicates(names)


def json_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for display and text sinks."""
    plain = set(scalar_columns(df))
    return df.select(*[q(c) if c in plain else F.to_json(q(c)).alias(c) for c in df.columns])


def schema_catalogue(df: DataFrame) -> DataFrame:
    """One row ``key`` per leaf of the schema, dotted, arrays and maps entered."""

    def walk(name: str, dtype: T.DataType) -> list[str]:
        if isinstance(dtype, T.ArrayType):
            return walk(name, dtype.elementType)
        if isinstance(dtype, T.MapType):
            return walk(name, dtype.valueType)
        if isinstance(dtype, T.StructType):
            return [k for f in dtype.fields for k in walk(f"{name}.{f.name}", f.dataType)]
        return [name]

    keys = [k for f in df.schema.fields for k in walk(f.name, f.dataType)]
    return df.sparkSession.createDataFrame([(k,) for k in keys], "key string")
