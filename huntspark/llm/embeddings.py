"""Near copies of embeddings: cross-polytope hashing after fast Hadamard rotations, candidates checked exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from huntspark.llm.common import components
from huntspark.llm.simhash import forest
from huntspark.plans.lineage_cut import cut

COSINE = 0.93
TABLES = 8  # hash tables
PROBES = 3  # buckets a vector visits in each table
SEED = 20240917
CHUNK = 1000  # vectors of a bucket that one task compares with as many others
TABLE_BITS = 40  # a bucket's number is its table shifted by so many bits, plus its code
NEVER = np.iinfo(np.int64).max
ROWS = 20_000  # rows a task gathers before it compares them
SMALL = 24  # buckets up to this size are compared shift by shift, all at once


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    h, (n, d) = 1, x.shape
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def buckets(vectors: np.ndarray, tables: int = TABLES, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """Bucket numbers (n, tables, probes), distinct within a table, of unit ``vectors``.

    A hash is the signed axis that a rotated vector lies nearest to; the rotation is three rounds of random signs and a
    Hadamard transform. A bucket joins two hashes; the further probes take the next nearest axes at the least loss.
    """
    n, d = vectors.shape
    size = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :d] = vectors
    random, out = np.random.default_rng(seed), np.empty((n, tables, probes), np.int64)
    ways = [(0, 0), (1, 0), (0, 1), (2, 0), (0, 2), (1, 1)]
    for t in range(tables):
        axes, values = [], []
        for _ in range(2):
            x = padded
            for _ in range(3):
                x = hadamard(x * random.choice([-1.0, 1.0], size))
            near = np.argsort(-np.abs(x), axis=1, kind="stable")[:, : min(3, size)]
            at = np.take_along_axis(x, near, 1)
            if near.shape[1] < 3:
                near, at = np.pad(near, ((0, 0), (0, 1)), mode="edge"), np.pad(at, ((0, 0), (0, 1)), mode="edge")
            axes.append(near * 2 + (at < 0))
            values.append(np.abs(at))
        loss = np.stack([values[0][:, 0] - values[0][:, a] + values[1][:, 0] - values[1][:, b] for a, b in ways], 1)
        code = np.stack([axes[0][:, a] * (2 * size) + axes[1][:, b] for a, b in ways], 1)
        out[:, t] = np.take_along_axis(code, np.argsort(loss, axis=1, kind="stable")[:, :probes], 1)
    return out


def usable(embedding: Column) -> Column:
    """True for a vector that can be linked: not null, not empty, all components finite, not zero."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(embedding, lambda x: x != 0)


def links_in(node, part, side, vec, code, group, cosine):
    """Position pairs (i, j) of linked vectors in a batch of whole buckets, sorted by ``group``.

    A pair counts in the first bucket (by table, then number) that both visit, so once over all tasks. ``side`` is 0 in
    a bucket (or chunk) that is compared with itself, else 1 or 2 for the two chunks of a pair.
    """
    unit = vec / np.sqrt((vec * vec).sum(axis=1, keepdims=True))
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    ends = np.append(starts[1:], len(group))
    small = ends - starts <= SMALL
    found = []
    inside = np.repeat(small, ends - starts)
    for shift in range(1, SMALL):
        i = np.flatnonzero((group[:-shift] == group[shift:]) & inside[:-shift])
        if not len(i):
            break
        i = i[(side[i] == 0) | (side[i] != side[i + shift])]
        near = np.einsum("ij,ij->i", unit[i], unit[i + shift]) >= cosine - 1e-9
        found.append((i[near], i[near] + shift))
    for a, b in zip(starts[~small], ends[~small]):
        one = two = np.arange(a, b)
        if side[a]:
            one, two = one[side[a:b] == 1], two[side[a:b] == 2]
        for k in range(0, len(one), 256):
            i, j = np.nonzero(unit[one[k : k + 256]] @ unit[two].T >= cosine - 1e-9)
            i, j = one[k + i], two[j]
            found.append((i, j) if side[a] else (i[i < j], j[i < j]))
    kept = [(np.empty(0, np.int64),) * 2]
    for i, j in found:
        for k in range(0, len(i), 1 << 13):
            x, y = i[k : k + (1 << 13)], j[k : k + (1 << 13)]
            a, b = vec[x], vec[y]
            cos = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
            both = (code[x][:, :, :, None] == code[y][:, :, None, :]).any(axis=3)  # buckets of x that y visits too
            least = np.where(both, code[x], NEVER).min(axis=2)
            first = (least != NEVER).argmax(axis=1)
            here = (first << TABLE_BITS) + np.take_along_axis(least, first[:, None], 1)[:, 0] == part[x]
            kept.append((x[here & (cos >= cosine)], y[here & (cos >= cosine)]))
    return tuple(np.concatenate(x) for x in zip(*kept))


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, chunk: int = CHUNK
) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) as rows (vec_id, n_links, component_id, kept).

    Vectors are compared only with those of the same non-null label and length. Null, zero, empty or non-finite vectors,
    and those without a label, link with nothing: n_links 0, component_id = vec_id. Equal vectors of a label are one node
    with a count; they link with each other. Copies of a row count as links of each other. A row without vec_id is
    counted by its partners, but never names a component. Rows keep their number.

    Hashing may miss a pair (recall is measured in the tests), but a bucket is compared whole: one of more than ``chunk``
    vectors is dealt out as pairs of chunks. Tasks return counts per node and a spanning forest, never all pairs.
    """
    rows = vectors.select("vec_id", "embedding", "label", (usable(F.col("embedding")) & F.col("label").isNotNull()).alias("fit"))
    nodes = cut(
        rows.where("fit")
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id())
    )

    def hashed(batches):
        for b in batches:
            lists = b.column(1)
            lengths = lists.value_lengths().to_numpy()
            for d in np.unique(lengths):
                of = np.flatnonzero(lengths == d)
                vec = lists.take(pa.array(of)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
                code = buckets(vec / np.sqrt((vec * vec).sum(axis=1, keepdims=True)), tables, probes)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(of)), pa.array(list(code.reshape(len(of), -1)), pa.list_(pa.int64()))], names=["node", "code"]
                )

    codes = cut(nodes.select("node", "embedding").mapInArrow(hashed, "node long, code array<long>"))
    coded = nodes.join(codes, "node").withColumn("dim", F.size("embedding"))
    numbers = F.expr(f"array_distinct(transform(code, (c, k) -> cast(k div {probes} as bigint) * {1 << TABLE_BITS} + c))")
    key = ["label", "dim", "part"]
    sizes = coded.select("label", "dim", F.explode(numbers).alias("part")).groupBy(*key).count().where("count > 1")
    sizes = sizes.select(*key, F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    spread = [*key, "lo", "hi"]
    dealt = (
        coded.withColumn("part", F.explode(numbers))
        .join(sizes, key)
        .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("lo", F.least("mine", "other"))
        .withColumn("hi", F.greatest("mine", "other"))
        .withColumn("side", F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2))
        .select(*spread, "side", "node", "n", "embedding", "code")
    )

    def compared(batches):
        def flush(t):
            ids = np.stack([t.column(k).to_numpy().astype(np.int64) for k in range(8)])
            for d in np.unique(ids[1]):
                of = np.flatnonzero(ids[1] == d)
                take = pa.array(of)
                vec, code = (t.column(k).take(take).combine_chunks().flatten().to_numpy(zero_copy_only=False) for k in (8, 9))
                label, _, part, lo, hi, side, node, n = ids[:, of]
                group = np.cumsum(np.concatenate(([0], (np.diff([label, part, lo, hi]) != 0).any(axis=0))))
                vec, code = vec.astype(np.float64).reshape(-1, d), code.reshape(len(of), tables, probes)
                i, j = links_in(node, part, side, vec, code, group, cosine)
                if len(i):
                    names, at = np.unique(np.concatenate([node[i], node[j]]), return_inverse=True)
                    links = np.bincount(at, np.concatenate([n[j], n[i]]), len(names)).astype(np.int64)
                    root = names[forest(at[: len(i)], at[len(i) :], np.arange(len(names)))]
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(links), pa.array(root)], names=["node", "links", "root"])

        held = None
        for b in batches:
            held = pa.concat_tables([*([held] if held else []), pa.Table.from_batches([b])])
            if held.num_rows < ROWS:
                continue
            ids = np.stack([held.column(k).to_numpy().astype(np.int64) for k in range(5)])
            change = np.flatnonzero((np.diff(ids) != 0).any(axis=0)) + 1
            if len(change):
                yield from flush(held.slice(0, int(change[-1])))
                held = held.slice(int(change[-1]))
        if held is not None and held.num_rows:
            yield from flush(held)

    found = cut(
        dealt.repartition(*spread).sortWithinPartitions(*spread).mapInArrow(compared, "node long, links long, root long")
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    rooted = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = nodes.join(links, "node", "left").join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select(
        "label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    linked = rows.where("fit").join(cut(known), ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not fit").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionByName(alone).withColumn("kept", kept)
