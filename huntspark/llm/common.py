"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from huntspark.plans.lineage_cut import cut

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """Pieces of sorted batches in which the first ``keys`` (integer) columns are constant, with their values. A group that
    spans batches comes as several pieces, one after the other."""
    for b in batches:
        if b.num_rows:
            columns = [b.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
            change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
            for lo, hi in zip([0, *change.tolist()], [*change.tolist(), b.num_rows]):
                yield tuple(int(c[lo]) for c in columns), b.slice(lo, hi - lo)


def give_back() -> None:
    """Return to the system what Arrow's pool and the C library keep of freed memory: a worker that is reused would hold the
    most that any batch took, beside the executor's own memory."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b: long) as rows (node, root); root is the smallest node.

    Alternating large and small stars: every round hangs a node's larger (then smaller) neighbours under the smallest
    one, so paths shorten by halves. Each round is a written table, the driver only sees a count and a checksum. A node
    of a star with a third of all edges is summed per task first, and its join is one that adaptive execution splits.
    Nodes without an edge to another node have no row.
    """

    def hang(links: DataFrame, larger: bool) -> DataFrame:
        sides = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else links
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = sides.join(least, "u")
        moved = joined.where("v > u" if larger else "v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = moved if larger else moved.unionByName(least.select("u", F.col("m").alias("v")))
        return kept.where("u != v").distinct()

    links = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, before = cut(links), None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now
        links = cut(hang(hang(links, True), False))
