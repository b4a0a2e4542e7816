"""Hard negatives by a secondary sort: scores come to an anchor's iterator in falling order, positives open windows, and
negatives are emitted as they pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from huntspark.llm.common import runs
from huntspark.plans.lineage_cut import cut

ANCHOR_EVERY = 100  # an anchor is a row whose vec_id this divides
POSITIVES, NEGATIVES = 5, 10  # of an anchor, of a positive
LOW, HIGH = 30, 90  # a window, in hundredths of the positive's score
ANCHORS = 8192  # anchors of a cell, about
ROWS = 4096, 1 << 18  # least and largest number of rows of a cell, about
CHUNKS = 64  # of rows, once there are enough of them
TILE = 1024  # rows that are scored at once; their place takes ten bits
BOUND = 1 << 52  # of a score
NONE = np.iinfo(np.int64).min


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, label, whole: components as floor(256 x)) that take part, one for each vec_id."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    one = rows.groupBy("vec_id").agg(F.min(F.struct(moved.alias("label"), "embedding")).alias("row"))
    whole = F.transform("row.embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("double"))
    return one.select("vec_id", "row.label", whole.alias("whole"))


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as int64, exact up to ``BOUND`` and set to it beyond."""
    most = [float(np.abs(x).max(initial=0.0)) for x in (anchors, rows)]
    if most[0] * most[1] * max(1, anchors.shape[1]) < BOUND:
        return (anchors @ rows.T).astype(np.int64)
    exact = [np.array([[int(x) for x in row] for row in side], dtype=object).reshape(side.shape) for side in (anchors, rows)]
    return np.array(np.clip(exact[0] @ exact[1].T, -BOUND, BOUND), dtype=np.int64)


def best(found: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each line of ``found`` the ``k`` highest allowed scores and their ids; ``ids`` ascend, so equal scores come by id.
    Score and place are packed into one number, which makes all of them different."""
    packed = np.where(allowed, (found << 10) | (TILE - 1 - np.arange(len(ids))), NONE)
    if packed.shape[1] > k:
        packed = np.partition(packed, packed.shape[1] - k, axis=1)[:, -k:]
    place = np.where(packed == NONE, 0, TILE - 1 - (packed & (TILE - 1)))
    return np.where(packed == NONE, NONE, packed >> 10), ids[place]


def merged(one: tuple, two: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` first of two lists of (scores, ids) a line, by falling score and rising id."""
    score, ids = (np.concatenate(x, axis=1) for x in zip(one, two))
    order = np.lexsort((ids, -np.maximum(score, -BOUND - 1)), axis=1)[:, :k]
    return np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


def in_cells(anchors: DataFrame, rows: DataFrame, size: int, chunk_rows: tuple[int, int], chunk_anchors: int) -> DataFrame:
    """Every anchor and every row of its length met in one cell: (dim, a, r, kind, vec_id, label, whole, windows), in the order in
    which a task reads them, anchors (kind 0) first. Both sides are cut by hash, so cells are even; none holds more than about
    the given numbers, and no pair of rows is a row of the shuffle."""
    a_parts = max(1, -(-size // ANCHOR_EVERY // chunk_anchors))
    r_parts = max(1, -(-size // min(max(chunk_rows[0], size // CHUNKS), chunk_rows[1])))

    def part(n: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(n))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))

    rest = ["vec_id", "label", "whole"]
    dim = F.size("whole").cast("long").alias("dim")
    left = anchors.select(dim, part(a_parts).alias("a"), every(r_parts).alias("r"), F.lit(0).alias("kind"), *rest, "windows")
    right = rows.select(dim, every(a_parts).alias("a"), part(r_parts).alias("r"), F.lit(1).alias("kind"), *rest)
    both = left.unionByName(right.withColumn("windows", F.lit(None).cast("array<bigint>")))
    return both.repartition("dim", "a", "r").sortWithinPartitions("dim", "a", "r", "kind", "vec_id")


def _matrix(piece: pa.RecordBatch, dim: int) -> np.ndarray:
    return piece.column(6).flatten().to_numpy(zero_copy_only=False).reshape(piece.num_rows, dim)


def _tiles(cell) -> Iterator[tuple]:
    """Of each tile of a cell: its first anchors (ids, labels, windows; once), row ids, whether labels are equal, whether rows are
    the anchor itself, and scores."""
    held = []
    ids = None
    for (dim, *_, kind), piece in cell:
        if kind == 0:
            held.append(piece)
            continue
        if not held:
            return
        if ids is None:
            ids, labels = (np.concatenate([p.column(k).to_numpy() for p in held]) for k in (4, 5))
            vectors = np.concatenate([_matrix(p, dim) for p in held])
            wanted = [w for p in held for w in p.column(7).to_pylist()]
        row_ids, row_labels, matrix = piece.column(4).to_numpy(), piece.column(5).to_numpy(), _matrix(piece, dim)
        for k in range(0, len(row_ids), TILE):
            of = slice(k, k + TILE)
            same = labels[:, None] == row_labels[None, of]
            yield ids, wanted, row_ids[of], same, ids[:, None] == row_ids[None, of], scores(vectors, matrix[of])


def _cells(batches) -> Iterator[Iterator]:
    from itertools import groupby

    for _, cell in groupby(runs(batches, 4), key=lambda x: x[0][:3]):
        yield cell


def _records(ids: np.ndarray, score: np.ndarray, partner: np.ndarray) -> pa.RecordBatch:
    line, place = np.nonzero(score != NONE)
    names = np.unique(np.stack([ids[line], -score[line, place], partner[line, place]]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in names], names=["anchor_id", "falling", "id"])


def nearest_positives(batches) -> Iterator[pa.RecordBatch]:
    """Of each cell the first positives of every anchor."""
    for cell in _cells(batches):
        kept = None
        for ids, _, row_ids, same, own, found in _tiles(cell):
            new = best(found, same & ~own, row_ids, POSITIVES)
            kept = new if kept is None else merged(kept, new, POSITIVES)
        if kept is not None:
            yield _records(ids, *kept)


def window_negatives(batches) -> Iterator[pa.RecordBatch]:
    """Of each cell the first negatives inside every window of its anchors. ``windows`` holds the positives' scores; no row outside
    these can be among the first of the whole table."""
    for cell in _cells(batches):
        kept, opened = [None] * POSITIVES, None
        for ids, wanted, row_ids, same, _, found in _tiles(cell):
            if opened is None:
                opened = np.full((len(ids), POSITIVES), -1, np.int64)  # a negative score opens no window
                for k, w in enumerate(wanted):
                    opened[k, : len(w)] = w
            for p in range(POSITIVES):
                base = opened[:, p : p + 1]
                inside = (base >= 0) & (LOW * base <= 100 * found) & (100 * found <= HIGH * base) & ~same
                if inside.any():
                    new = best(found, inside, row_ids, NEGATIVES)
                    kept[p] = new if kept[p] is None else merged(kept[p], new, NEGATIVES)
        if any(k is not None for k in kept):
            yield _records(ids, *(np.concatenate(x, axis=1) for x in zip(*[k for k in kept if k is not None])))


def emitted(batches) -> Iterator[pa.RecordBatch]:
    """The streaming iterator: records (anchor_id, falling score, kind, id) in this order. A positive opens a window; a negative goes
    out once for each open window it lies in that still has room. Only the open windows of one anchor are held."""
    anchor, windows = None, []
    for b in batches:
        out = []
        for anchor_id, falling, kind, partner in zip(*(b.column(k).to_pylist() for k in range(4))):
            if anchor_id != anchor:
                anchor, windows = anchor_id, []
            if kind == 0:
                windows.append([partner, -falling, 0])
                continue
            for w in windows:
                if w[2] < NEGATIVES and LOW * w[1] <= -100 * falling <= HIGH * w[1]:
                    w[2] += 1
                    out.append((anchor_id, w[0], w[2], partner, w[1], -falling))
        columns = list(zip(*out)) or [()] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def mine_negatives(vectors: DataFrame, chunk_rows: tuple[int, int] = ROWS, chunk_anchors: int = ANCHORS) -> DataFrame:
    """Hard negatives of ``vectors`` (vec_id, embedding, label) as rows (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score).

    Rows score the integer inner product of floor(256 x) with the anchor. The first five rows of an anchor's label are its
    positives; a positive's negatives are the first ten rows of other labels that score 30 to 90 hundredths of it. Cells of
    anchors and rows are scored as blocks, twice: for the positives, then for what lies in their windows. A cell hands on only
    what can be among the first of the whole table, so the sorted shuffle by (anchor, falling score, id) stays small and no
    label or vector is a key of it.

    Null vec_id, label, vector or component and non-finite components: the row takes no part. Repeated rows count once; of
    different rows with one vec_id the least (label, vector) does. Vectors of another length than the anchor's are not compared.
    Equal scores come by vec_id. A positive score below zero opens no window, one of zero takes negatives of zero. Scores beyond
    2**52 are set to that. Anchors without positives, and empty tables, give no rows; other columns are not read.
    """
    rows = cut(usable(vectors))
    size = rows.count()
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    plain = anchors.withColumn("windows", F.lit(None).cast("array<bigint>"))
    record = "anchor_id long, falling long, id long"
    near = in_cells(plain, rows, size, chunk_rows, chunk_anchors).mapInArrow(nearest_positives, record)
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy("falling", "id"))
    positives = cut(near.withColumn("place", place).where(F.col("place") <= POSITIVES).drop("place"))
    opened = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(-F.col("falling")).alias("windows"))
    far = in_cells(anchors.join(opened, "vec_id"), rows, size, chunk_rows, chunk_anchors).mapInArrow(window_negatives, record)
    keys = ["anchor_id", "falling", "kind", "id"]  # at equal scores the positive comes first
    packed = positives.withColumn("kind", F.lit(0)).unionByName(far.withColumn("kind", F.lit(1))).select(*keys)
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return packed.repartition("anchor_id").sortWithinPartitions(*keys).mapInArrow(emitted, result)
