"""Join shapes that hold when one key owns a third of all rows.

Spark broadcasts a side by itself where the files show it is small, and adaptive execution where a shuffle did, but then
the large side is shuffled already. ``broadcast_if_small`` measures a derived side first. Nothing else is hinted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from huntspark.functions.names import q
from huntspark.plans.lineage_cut import cut

BROADCAST_BYTES = 64 << 20  # largest side that is sent to every executor
TOP = 64  # heavy hitters looked for
TRACKED = 1024  # keys the sketch of a task may hold
HOT_ROWS = 1_000_000  # rows from which a key is worth splitting
SALTS = 32  # parts a hot key is split into


def on_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    def side(df: DataFrame, name: str) -> Column:
        return df["`" + name.replace("`", "``") + "`"]

    return reduce(lambda a, b: a & b, [side(left, lk) == side(right, rk) for lk, rk in pairs])


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, computed and written once, with a broadcast hint if its rows as text take at most ``limit`` bytes.

    Beyond that it is a plain side that Spark shuffles.
    """
    kept, small = _measured(df, limit)
    return F.broadcast(kept) if small else kept


def _measured(df: DataFrame, limit: int) -> tuple[DataFrame, bool]:
    kept = cut(df)
    size = kept.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return kept, size <= limit


def all_present(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [q(n).isNotNull() for n in names])


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> list[int]:
    """Hashes of the keys with at least about ``hot_rows`` rows, from a bounded sketch: at most ``TOP`` numbers.

    One job over the key columns. The answer becomes part of the plan, so both sides of a join always agree on it; a
    key the sketch misses is joined like any other.
    """
    hashed = df.where(all_present(keys)).select(F.xxhash64(*[q(k) for k in keys]).alias("__h"))
    top = hashed.agg(F.expr(f"approx_top_k(__h, {TOP}, {TRACKED})").alias("top")).select(F.explode("top").alias("t"))
    return [r["h"] for r in top.where(F.col("t.count") >= hot_rows).select(F.col("t.item").alias("h")).collect()]


def hot_of_counts(counts: DataFrame, keys: list[str], count: str, hot_rows: int = HOT_ROWS) -> list[int]:
    """The same from rows that are counted per key already."""
    top = counts.where(all_present(keys) & (q(count) >= hot_rows)).orderBy(F.desc(count)).limit(TOP)
    return [r["h"] for r in top.select(F.xxhash64(*[q(k) for k in keys]).alias("h")).collect()]


def _row_hash(df: DataFrame) -> Column:
    usable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*[q(c) for c in usable])


def split_hot_join(
    many: DataFrame,
    few: DataFrame,
    pairs: list[tuple[str, str]],
    how: str = "inner",
    at_most: int | None = None,
    hot: list[int] | None = None,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Equi join (inner, or left with ``many`` kept) in which the hot keys of ``many`` are spread over ``salts`` tasks.

    ``pairs`` names the key columns as (many, few). Without hot keys this is the plain join; ``at_most`` is a known
    bound on the rows of ``many`` that can make the search for them unnecessary, ``hot`` the answer of ``hot_keys`` on
    something cheaper than ``many``. Otherwise a row of a hot key gets a
    salt from its own content, so a task that is run again salts it the same way; the rows of ``few`` with a hot key
    are copied once per salt, all others stand once. Kept rows without a key are salted too: they match nothing.
    """
    many_keys, few_keys = [m for m, _ in pairs], [f for _, f in pairs]
    if how == "inner":
        many = many.where(all_present(many_keys))
    few = few.where(all_present(few_keys))
    if hot is None:
        hot = [] if at_most is not None and at_most < hot_rows else hot_keys(many, many_keys, hot_rows)
    if not hot:
        return many.join(few, on_keys(many, few, pairs), how)

    def is_hot(keys: list[str]) -> Column:
        return F.xxhash64(*[q(k) for k in keys]).isin(hot)

    salt = F.pmod(_row_hash(many), F.lit(salts)).cast("int")
    left = many.withColumn(
        "__many_part", F.when(is_hot(many_keys) | ~all_present(many_keys), salt).otherwise(F.lit(0))
    )
    copies = F.when(is_hot(few_keys), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = few.withColumn("__few_part", F.explode(copies))
    joined = left.join(right, on_keys(left, right, pairs) & (F.col("__many_part") == F.col("__few_part")), how)
    return joined.drop("__many_part", "__few_part")


def measured_join(many: DataFrame, few: DataFrame, pairs: list[tuple[str, str]], hot: list[int]) -> DataFrame:
    """Inner join of exploded rows to a derived side that is computed, written and measured first.

    Spark takes exploded lists to be as small as the files they come from, and would send all of them through the driver. Here
    only ``few`` is ever broadcast, and only if it is small; else both sides are shuffled, with the hot keys of ``many`` split.
    """
    few = few.where(all_present([f for _, f in pairs]))
    side, small = _measured(few, BROADCAST_BYTES)
    if not small:
        return split_hot_join(many, side.hint("merge"), pairs, hot=hot)
    many = many.where(all_present([m for m, _ in pairs]))
    return many.join(F.broadcast(side), on_keys(many, side, pairs))


def expand_left_join(
    few: DataFrame, many: DataFrame, pairs: list[tuple[str, str]], hot_rows: int = HOT_ROWS, salts: int = SALTS
) -> DataFrame:
    """Left join of ``few`` to a larger ``many`` whose keys may be hot.

    A left outer join can only be split on its left side, so the matched rows come from a splittable inner join and
    the unmatched ones from an anti join against the distinct keys. ``pairs`` names (few, many).
    """
    flipped = [(m, f) for f, m in pairs]
    matched = split_hot_join(many, few, flipped, hot_rows=hot_rows, salts=salts).select(
        *[q(c) for c in few.columns], *[q(c) for c in many.columns]
    )
    keys = many.select(*[q(m).alias(f"__{m}") for _, m in pairs]).distinct()
    unmatched = few.join(keys, on_keys(few, keys, [(f, f"__{m}") for f, m in pairs]), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def lookup_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Left join of facts to a lookup table: one join, which reads the facts once.

    A small lookup table is broadcast. Otherwise rows without a key, or with a hot one, meet in one partition, which adaptive
    execution splits: it may split the kept side of a left join. Nothing but the keys is read for the join; columns that the
    caller does not use are pruned at the scan.
    """
    return left.join(right, on_keys(left, right, pairs), "left")
