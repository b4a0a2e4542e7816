"""Where results go."""

from __future__ import annotations

from pyspark.sql import DataFrame

from huntspark.functions.names import drop_all_null, q


def assign(df: DataFrame, name: str, drop_empty: bool = False) -> DataFrame:
    """Bind a result to a name that SQL can use; ``drop_empty`` leaves out columns without values (one job)."""
    out = drop_all_null(df) if drop_empty else df
    out.createOrReplaceTempView(name)
    return out


def append(existing: DataFrame | None, df: DataFrame) -> DataFrame:
    """Rows of both; columns may differ."""
    return df if existing is None else existing.unionByName(df, allowMissingColumns=True)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("error").json(path)


def write_network_ranges(df: DataFrame, path: str) -> None:
    """Network ranges as CSV, every value as text."""
    df.select(*[q(c).cast("string").alias(c) for c in df.columns]).write.option("header", True).csv(path)


def write_state(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A new table state, written next to the old one and never over the files it is read from."""
    df.write.mode("error").partitionBy(*(partition_by or [])).parquet(path)

