"""Mixing sources to target weights: length counts, a bounded knapsack for the remaining budget, seeded documents."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from huntspark.llm.common import WORD
from huntspark.plans.lineage_cut import cut

WEIGHTS = (5, 2, 1)
EPOCHS = 3  # no document is taken more often
SEED = 7
BUDGET = 1 << 13  # words that are left to the exact knapsack, where documents are not longer
TABLE = 1 << 26  # bytes of reachable sums that it remembers
BIN_BITS = 12  # documents of one source and length are ranked within bins of their seeded number


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with size (words; 0 for null) and draw, a seeded number of the document's id and text."""
    return docs.withColumn("size", n_words(F.col("text"))).withColumn("draw", F.xxhash64(F.lit(seed), "doc_id", "text"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source_no (by code point, null last), source_size, target.

    The sources share the sum of all sizes by their weights, which repeat over the sources; a target stops at ``epochs``
    times the source's size, and the excess goes to the others by weight until none is above. In order of that bound per
    weight, a source is stopped if its share of what the ones before it leave reaches its bound, which is where resharing
    ends; the first source that is not has the level of all others, and levels fall behind it. The windows hold one row per source.
    """
    every = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("source_no", F.lit(len(weights))) + 1)
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(every) - 1)
        .withColumn("weight", weight)
        .withColumn("bound", epochs * F.col("source_size"))
    )
    by_bound = W.orderBy(F.col("bound") / F.col("weight"), "source_no")
    before, whole = by_bound.rowsBetween(W.unboundedPreceding, -1), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("bound").over(before), F.lit(0))
    level = left / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    stopped = level * F.col("weight") >= F.col("bound")
    target = F.when(F.col("stopped"), F.col("bound").cast("double")).otherwise(
        F.max(F.when(~F.col("stopped"), F.col("level"))).over(whole) * F.col("weight")
    )
    return sources.withColumn("level", level).withColumn("stopped", stopped).select(
        "source", "source_no", "source_size", target.alias("target")
    )


def fill(counts: dict[int, int], budget: int, exact: int = BUDGET, seed: int = SEED) -> dict[int, int]:
    """How many documents of each length to take, at most ``counts``, so that their words come as near ``budget`` as found.

    All but a rest of ``exact`` words (or three of the longest documents) is spread evenly: every length gives its share of
    documents, fractions carried on from length to length, from a seeded start, which leaves an error of one document at most. The
    rest is filled by a bounded knapsack over what is left of all lengths in a seeded order (reachable sums as bits of a
    number, copies of a length in powers of two), up to the sum next to it on either side. A budget of at most ``exact`` words
    is met as nearly as any choice can. The knapsack looks at no more lots than ``TABLE`` bytes of sums remember.
    """
    total = sum(n * k for n, k in counts.items())
    budget = max(0, min(budget, total))
    take = dict.fromkeys(counts, 0)
    lengths = sorted(n for n in counts if n > 0)
    if not budget:
        return take
    if 0 in counts:
        take[0] = counts[0] * budget // total
    room = min(budget, max(exact, 3 * lengths[-1]))
    carry = (seed * 0x9E3779B97F4A7C15 % (1 << 64)) / (1 << 64)
    for n in lengths:
        share = counts[n] * (budget - room) / total + carry
        take[n] = min(counts[n], int(share))
        carry = share - take[n]
    rest = max(0, budget - sum(n * take[n] for n in lengths))
    window = (1 << (rest + lengths[-1] + 1)) - 1
    reach, steps = 1, []
    for n in sorted(lengths, key=lambda n: (n * 0x9E3779B1 + seed) % (1 << 32)):
        spare, lot = min(counts[n] - take[n], rest // n + 1), 1
        while spare > 0 and not reach >> rest & 1 and len(steps) * (rest + lengths[-1]) < 8 * TABLE:
            lot = min(lot, spare)
            steps.append((n, lot, reach))
            reach |= reach << (n * lot) & window
            spare, lot = spare - lot, lot * 2
    below = (reach & (1 << (rest + 1)) - 1).bit_length() - 1
    above = reach >> rest
    above = rest + (above & -above).bit_length() - 1 if above else None
    at = below if above is None or rest - below <= above - rest else above
    for n, lot, before in reversed(steps):
        if not before >> at & 1:
            take[n] += lot
            at -= n * lot
    return take


def plan(sizes: DataFrame, targets: DataFrame, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """Rows (source_no, size, rounds, extra): every document of that length is taken ``rounds`` times and ``extra`` of them
    once more. One task holds the length counts of one source, never its documents."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        total, target = int(pdf.source_size.iloc[0]), float(pdf.target.iloc[0])
        rounds = min(epochs, int(target // total)) if total else 1
        budget = round(target) - rounds * total if rounds < epochs else 0
        counts = dict(zip(pdf["size"].tolist(), pdf["n"].tolist()))
        take = fill(counts, budget, seed=seed) if total else dict.fromkeys(counts, 0)
        out = pd.DataFrame({"size": list(take), "extra": list(take.values())})
        return out.assign(source_no=pdf.source_no.iloc[0], rounds=rounds)[["source_no", "size", "rounds", "extra"]]

    counted = sizes.groupBy("source_no", "size").agg(F.count("*").alias("n")).join(targets, "source_no")
    return counted.select("source_no", "size", "n", "source_size", "target").groupBy("source_no").applyInPandas(
        one, "source_no int, size long, rounds int, extra long"
    )


def thresholds(sizes: DataFrame, planned: DataFrame) -> DataFrame:
    """``planned`` with the draw up to which documents of a length are taken once more: those below ``draw_at``, and
    ``more_at`` of the ``n_at`` with that very draw (rows that repeat). Only the bins that hold a boundary are ranked."""
    key = ["source_no", "size"]
    binned = sizes.select(*key, "draw", F.shiftright("draw", 64 - BIN_BITS).alias("bin"))
    counts = binned.groupBy(*key, "bin").agg(F.count("*").alias("n"))
    running = F.sum("n").over(W.partitionBy(*key).orderBy("bin"))
    boundary = (
        counts.join(planned.where("extra > 0"), key)
        .withColumn("upto", running)
        .where((F.col("upto") >= F.col("extra")) & (F.col("upto") - F.col("n") < F.col("extra")))
        .select(*key, "bin", (F.col("extra") - F.col("upto") + F.col("n")).alias("need"))
    )
    ranked = F.sum("n_at").over(W.partitionBy(*key, "bin").orderBy("draw"))
    found = (
        binned.join(boundary, [*key, "bin"])
        .groupBy(*key, "bin", "need", "draw")
        .agg(F.count("*").alias("n_at"))
        .withColumn("upto", ranked)
        .where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n_at") < F.col("need")))
        .select(*key, F.col("draw").alias("draw_at"), "n_at", (F.col("need") - F.col("upto") + F.col("n_at")).alias("more_at"))
    )
    return planned.join(found, key, "left").select(*key, "rounds", "draw_at", "n_at", "more_at")


def decide(docs: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED):
    """(sizes, targets, rules) of ``docs`` (doc_id, text, source): written tables that hold no text."""
    found = cut(sized(docs.select("doc_id", "text", "source"), seed).select("doc_id", "source", "size", "draw"))
    targets = cut(source_targets(found, weights, epochs))
    sizes = found.join(targets.select("source", "source_no"), found.source.eqNullSafe(targets.source)).select(
        "doc_id", "source_no", "size", "draw"
    )
    planned = cut(plan(sizes, targets, epochs, seed))
    return sizes, targets, cut(thresholds(sizes, planned))


def taken_words(docs: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """Per document of ``docs``: doc_id, size, source_size, target (of its source) and taken, the words the mix takes.

    Null and empty texts have size 0 and take nothing; null is a source of its own; a source without words has target 0;
    ties of length are broken by a seeded number, so reruns agree. Repeated rows are documents of their own. Other columns are
    not read; an empty table has no rows.
    """
    sizes, targets, rules = decide(docs, weights, epochs, seed)
    joined = sizes.join(rules, ["source_no", "size"]).join(targets.drop("source"), "source_no")
    at = (F.col("draw") == F.col("draw_at")) & (F.col("more_at") < F.col("n_at"))
    part = F.coalesce(at, F.lit(False))
    extra = F.when(F.col("draw") <= F.col("draw_at"), 1).otherwise(0)
    again = F.row_number().over(W.partitionBy("source_no", "size", "draw").orderBy("doc_id"))
    whole = joined.where(~part).withColumn("times", F.col("rounds") + extra)
    split = joined.where(part).withColumn("times", F.col("rounds") + F.when(again <= F.col("more_at"), 1).otherwise(0))
    return whole.unionByName(split).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of the mix: every document of ``docs`` as often as it is taken, with its own columns.

    The rules are few (lengths per source); the texts are joined to them, not shuffled by id. Documents without words are
    taken as often as their source goes round, at least once.
    """
    own, names = docs.columns, ["__size", "__draw", "__no"]
    _, targets, rules = decide(docs, weights, epochs, seed)
    rows = docs.withColumns({"__size": n_words(F.col("text")), "__draw": F.xxhash64(F.lit(seed), "doc_id", "text")})
    source = targets.select(F.col("source").alias("__source"), F.col("source_no").alias("__no"))
    rows = rows.join(source, F.col("source").eqNullSafe(F.col("__source")))
    few = rules.select(*[F.col(c).alias(f"__rule_{c}") for c in rules.columns])
    rows = rows.join(few, (F.col("__no") == F.col("__rule_source_no")) & (F.col("__size") == F.col("__rule_size")))
    at = (F.col("__draw") == F.col("__rule_draw_at")) & (F.col("__rule_more_at") < F.col("__rule_n_at"))
    part = F.coalesce(at, F.lit(False))
    times = F.col("__rule_rounds") + F.when(F.col("__draw") <= F.col("__rule_draw_at"), 1).otherwise(0)
    times = F.when(F.col("__size") == 0, F.greatest(F.col("__rule_rounds"), F.lit(1))).otherwise(times)
    whole = rows.where(~part).withColumn("__times", times)
    # rows that repeat with one draw: one of them stands for what all are taken
    same = rows.where(part).groupBy(*own, *names).agg(
        F.count("*").alias("__n"), F.first("__rule_rounds").alias("__rounds"), F.first("__rule_more_at").alias("__more")
    )
    times = F.when(F.col("__size") == 0, F.greatest(F.col("__rounds"), F.lit(1)) * F.col("__n"))
    same = same.withColumn("__times", times.otherwise(F.col("__rounds") * F.col("__n") + F.col("__more")).cast("int"))
    both = whole.select(*own, "__times").unionByName(same.select(*own, "__times")).where("__times > 0")
    return both.withColumn("__round", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*own)
