"""What changed between the two states of an audit record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huntspark.functions.names import DERIVED, q

BEFORE, AFTER = "before_state.", "after_state."


def diff_fields(df: DataFrame) -> list[str]:
    """Fields that have both a state before and a state after; an error if there are none."""
    before = [c.removeprefix(BEFORE) for c in df.columns if c.startswith(BEFORE)]
    after = {c.removeprefix(AFTER) for c in df.columns if c.startswith(AFTER)}
    if not before:
        raise ValueError("no before_state columns")
    if not after:
        raise ValueError("no after_state columns")
    both = [c for c in before if c in after]
    if not both:
        raise ValueError("before_state and after_state share no field")
    return both


def _lines(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(q(name).cast("array<string>"), F.array().cast("array<string>"))
    text = q(name).cast("string")
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))


def _surplus(of: Column, other: Column, mark: str) -> Column:
    """The items of ``of`` as often as it has them more than ``other``, in order of their first place, marked. Items that are all
    different on both sides, as lines mostly are, need no counting."""

    def times(items: Column, s: Column) -> Column:
        return F.size(F.filter(items, lambda x: x.eqNullSafe(s)))

    def more(s: Column) -> Column:
        return F.array_repeat(F.concat(F.lit(mark), s), F.greatest(times(of, s) - times(other, s), F.lit(0)))

    different = (F.size(F.array_distinct(of)) == F.size(of)) & (F.size(F.array_distinct(other)) == F.size(other))
    marked = F.transform(F.array_except(of, other), lambda s: F.concat(F.lit(mark), s))
    return F.when(different, marked).otherwise(F.flatten(F.transform(F.array_distinct(of), more)))


def get_diffs(df: DataFrame) -> DataFrame:
    """``x_diff_<field>``: the lines (or list items) that went away, marked ``- ``, and those that came, ``+ ``.

    Lines are compared as often as they stand, blank ones included; a line that only moved is not shown, though
    ``changed_fields`` names the field. A missing or empty text has no lines.
    """
    new = {}
    for field in diff_fields(df):
        name = DERIVED + "diff_" + field.replace(".", "_")
        if name in df.columns:
            continue
        before, after = _lines(df, BEFORE + field), _lines(df, AFTER + field)
        new[name] = F.concat(_surplus(before, after, "- "), _surplus(after, before, "+ "))
    return df.withColumns(new) if new else df


def changed_fields(df: DataFrame) -> DataFrame:
    """``x_changed_fields``: sorted names of the fields whose two states differ, null against value included."""
    marks = [
        F.when(~q(BEFORE + f).eqNullSafe(q(AFTER + f)), F.lit(f)) for f in sorted(diff_fields(df))
    ]
    return df.withColumn(DERIVED + "changed_fields", F.array_compact(F.array(*marks)))
