"""Near copies by 64-bit fingerprints: SimHash of word shingles, linked by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.llm.common import components
from huntspark.plans.lineage_cut import cut

BUDGET = 3  # differing bits of a link
GROUP = 1000  # fingerprints from which a group is dealt out by further bits
BATCH = 1 << 16  # fingerprints in one trie; the groups of a trie are numbered with 16 bits
FRONTIER = 1 << 18  # node pairs that are expanded at once
CHUNK = 1 << 16  # shingles counted at once


def fingerprint(text: str | None, width: int = 3) -> int:
    """Signed 64-bit SimHash of the ``width``-word shingles; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII case and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, n, CHUNK):
        pieces = [joined[a:b] for a, b in zip(starts[k : k + CHUNK], ends[k : k + CHUNK])]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(42)), np.uint64, len(pieces))
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """``docs`` with a long column ``fp``."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return docs.withColumn("fp", of(F.col(text)))


# --- groups: the bits a pair agrees on -------------------------------------------------------------------------------


def blocks(path: int) -> tuple[int, list[list[int]]]:
    """Of a group's path (digits 1-4 in base 5, first choice first): the pinned bits as a mask, and for each choice the
    blocks that stood before the chosen one. Each choice pins one of four blocks that the free bits are cut into."""
    digits = []
    while path:
        path, d = divmod(path, 5)
        digits.insert(0, d)
    pinned, before = 0, []
    for d in digits:
        free = [b for b in range(63, -1, -1) if not pinned >> b & 1]
        cuts = [sum(1 << b for b in free[len(free) * k // 4 : len(free) * (k + 1) // 4]) for k in range(4)]
        before.append(cuts[: d - 1])
        pinned |= cuts[d - 1]
    return pinned, before


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def grouped(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """Rows (path, pinned, fp): every fingerprint once for each group it is in.

    Of four blocks of bits, two fingerprints with at most three differing bits agree on one: each block's value is a
    group. Groups of more than ``group`` fingerprints are cut again by four blocks of the bits that are still free, up to
    four times; then at most 20 bits are free. Only the counts of large groups decide, so any input takes the same way.
    """

    def deal(rows: DataFrame, paths: list[int]) -> DataFrame:
        children = F.create_map(
            *[
                x
                for p in paths
                for x in (
                    F.lit(p),
                    F.array(*[F.struct(F.lit(c).alias("path"), F.lit(_signed(blocks(c)[0])).cast("long").alias("mask")) for c in range(p * 5 + 1, p * 5 + 5)]),
                )
            ]
        )
        return rows.select("fp", F.explode(F.element_at(children, F.col("path"))).alias("to")).select(
            F.col("to.path").alias("path"), F.col("fp").bitwiseAND(F.col("to.mask")).alias("pinned"), "fp"
        )

    paths, rows, done = [0], fps.select(F.lit(0).alias("path"), "fp"), []
    for depth in range(4):
        rows = deal(rows, paths)
        paths = [p * 5 + k for p in paths for k in range(1, 5)]
        if depth == 3:
            break
        large = cut(rows.groupBy("path", "pinned").count().where(F.col("count") > group).drop("count"))
        if large.isEmpty():
            break
        done.append(rows.join(large, ["path", "pinned"], "left_anti"))
        rows = rows.join(large, ["path", "pinned"], "left_semi")
    for part in done:
        rows = rows.unionByName(part)
    return rows


# --- the trie ----------------------------------------------------------------------------------------------------------


def trie_pairs(keys: np.ndarray, depth: int, bits: int, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in the sorted distinct uint64 ``keys`` that agree above bit ``bits`` (``depth`` = 64 - bits bits,
    the roots) and differ in at most ``budget`` of the ``bits`` low ones.

    A node is a range of ``keys`` with a common prefix. Node pairs go down together, a bit at a time, with the bits they
    differ in so far; beyond the budget a pair is dropped with everything below it. A pair of leaves is settled at once.
    """
    if len(keys) == 0:
        return
    top = keys >> np.uint64(bits) if bits < 64 else np.zeros(len(keys), np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1])))
    ends = np.append(starts[1:], len(keys))
    many = ends - starts > 1
    s, e = starts[many], ends[many]
    stack = [(bits, np.stack([s, e, s, e, np.zeros_like(s)]))] if len(s) else []
    while stack:
        left, pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            half = pairs.shape[1] // 2
            stack += [(left, pairs[:, half:]), (left, pairs[:, :half])]
            continue
        alo, ahi, blo, bhi, err = pairs
        bit = np.uint64(1) << np.uint64(left - 1)
        above = ~((bit << np.uint64(1)) - np.uint64(1)) if left < 64 else np.uint64(0)

        def middle(lo, hi):
            return np.clip(np.searchsorted(keys, (keys[lo] & above) | bit), lo, hi)

        same = alo == blo
        am, bm = middle(alo, ahi), middle(blo, bhi)
        other = ~same
        new = [
            np.stack([alo, am, blo, bm, err]),
            np.stack([am, ahi, bm, bhi, err]),
            np.stack([alo, am, bm, bhi, err + 1]),
            np.stack([am[other], ahi[other], blo[other], bm[other], err[other] + 1]),
        ]
        pairs = np.concatenate(new, axis=1)
        alo, ahi, blo, bhi, err = pairs
        live = (ahi > alo) & (bhi > blo) & (err <= budget) & ~((alo == blo) & (ahi - alo == 1))
        pairs = pairs[:, live]
        alo, ahi, blo, bhi, err = pairs
        leaves = (ahi - alo == 1) & (bhi - blo == 1)
        if leaves.any():
            i, j = alo[leaves], blo[leaves]
            near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            yield i[near], j[near]
        pairs = pairs[:, ~leaves]
        if pairs.shape[1]:
            stack.append((left - 1, pairs))


def squeeze(fps: np.ndarray, pinned: int) -> tuple[np.ndarray, int]:
    """The bits of ``fps`` that are not pinned, moved together at the low end, and how many they are."""
    out, n = np.zeros(len(fps), np.uint64), 0
    for b in range(64):
        if not pinned >> b & 1:
            out |= (fps >> np.uint64(b) & np.uint64(1)) << np.uint64(n)
            n += 1
    return out, n


def forest(i: np.ndarray, j: np.ndarray, label: np.ndarray) -> np.ndarray:
    """``label`` (a smaller or equal position for each position) after the links i - j: linked positions share one."""
    while True:
        a, b = label[i], label[j]
        low = np.minimum(a, b)
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _links(path: int, pinned: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one batch of whole groups with one path, sorted by (pinned, fp), reduced to a spanning forest."""
    mask, before = blocks(path)
    change = np.concatenate(([True], pinned[1:] != pinned[:-1]))
    free, bits = squeeze(fps, mask)
    keys = (np.cumsum(change) - 1).astype(np.uint64) << np.uint64(bits) | free
    order = np.argsort(keys)
    keys, fps = keys[order], fps[order]
    label = np.arange(len(keys))
    for i, j in trie_pairs(keys, 64 - bits, bits):
        differ = fps[i] ^ fps[j]
        first = np.ones(len(i), bool)  # found here only if no block before the chosen one agrees
        for cuts in before:
            for c in cuts:
                first &= (differ & np.uint64(c)) != 0
        label = forest(i[first], j[first], label)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return fps[moved], fps[label[moved]]


def near_links(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` as all pairs with at most ``BUDGET`` differing bits do.

    Each task reads its groups in order and joins the tries of some thousands of groups at once. A dense group yields no
    more links than it has fingerprints.
    """

    def run(batches):
        held = []

        def flush(rows):
            path, pinned, fp = rows
            for p in np.unique(path):
                of = path == p
                a, b = _links(int(p), pinned[of], fp[of].view(np.uint64))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)])
            if sum(len(h[0]) for h in held) < BATCH // 2:
                continue
            rows = [np.concatenate(x) for x in zip(*held)]
            change = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1
            last = int(change[-1]) if len(change) else 0
            for lo in range(0, last, BATCH // 2):  # cut at the change of group next to each multiple
                a = int(change[np.searchsorted(change, lo)]) if lo else 0
                z = int(change[min(np.searchsorted(change, lo + BATCH // 2), len(change) - 1)])
                if z > a:
                    yield from flush([x[a:z] for x in rows])
            held = [[x[last:] for x in rows]]
        if held:
            yield from flush([np.concatenate(x) for x in zip(*held)])

    rows = grouped(fps, group).repartition(F.col("path"), F.col("pinned")).sortWithinPartitions("path", "pinned", "fp")
    return rows.select("path", "pinned", "fp").mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, width: int = 3, group: int = GROUP) -> DataFrame:
    """``docs`` (doc_id, text) as rows (doc_id, fp, component_id): the smallest doc_id reachable over fingerprints that
    differ in at most ``BUDGET`` bits.

    Documents with one fingerprint are one node, so copies are never expanded into pairs. Null and empty texts have
    fingerprint 0 and are linked like any other; repeated rows stay; a null doc_id is never the smallest, and a component
    without any other has a null component_id.
    """
    rows = cut(fingerprints(docs.select("doc_id", "text"), width=width).select("doc_id", "fp"))
    nodes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(near_links(nodes, group))
    rooted = nodes.join(found, nodes.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = cut(rooted.join(least, "root").select("fp", "component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
