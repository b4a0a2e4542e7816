"""Severity scores, categories and the small enum maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntspark.functions.fixed import INVESTIGATION_PRIORITY, RULE_SEVERITY, SEVERITY_FLOORS
from huntspark.functions.names import DERIVED, coalesce_columns


def severity_rounded_and_category(
    df: DataFrame, severity_columns: list[str] | None = None, strict: bool = False
) -> DataFrame:
    """``x_severity`` (two decimals, half to even on the scaled value) and ``x_severity_category``.

    The category follows the rounded value. A missing severity has no category; ``strict=True`` makes it an error.
    """
    raw = coalesce_columns(df, severity_columns or ["metadata.severity", "severity"]).try_cast("double")
    rounded = F.rint(raw * 100) / 100
    return df.withColumn(DERIVED + "severity", rounded).withColumn(
        DERIVED + "severity_category", category(F.col(DERIVED + "severity"), strict)
    )


def category(rounded: Column, strict: bool = False) -> Column:
    out = F.when(rounded.isNull(), F.raise_error(F.lit("severity is missing")) if strict else F.lit(None))
    for name, floor in SEVERITY_FLOORS:
        out = out.when(rounded >= floor, name)
    return out.otherwise("Informational")


def _enum(mapping: dict, column: Column) -> Column:
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.element_at(F.create_map(*pairs), column)


def rule_severity(column: Column) -> Column:
    return _enum(RULE_SEVERITY, F.lower(column))


def investigation_priority(column: Column) -> Column:
    return _enum(INVESTIGATION_PRIORITY, F.upper(column))
