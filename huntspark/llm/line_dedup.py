"""Lines that stand in several documents, kept once: sharded cuckoo filters in front of exact tables of references.

The filters say which lines may have been seen before; only those are counted, exactly. Documents can be added and taken away
again at any time, and an index after an insertion and its deletion is what it was.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from hashlib import md5
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huntspark.llm.common import runs
from huntspark.plans.lineage_cut import cut

LEAST_LENGTH = 10  # code points of a line that can be dropped
WHITE = b" \t\n\v\f\r"
BUCKET_BITS, SLOTS = 17, 4  # of a filter: 524,288 places of two bytes
SHARD_ROWS = 400_000  # references a shard is planned for
LEAST_BITS = 4  # of the number of shards
KICKS = 200  # rounds of moves before what has no place goes to the filter's list of the rest
_SPREAD = 0x5BD1E995
_MASK = (1 << BUCKET_BITS) - 1


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def long_enough(key: bytes) -> bool:
    return len(key) >= 4 * LEAST_LENGTH or len(key.decode("utf-8", "replace")) >= LEAST_LENGTH


def hashed(key: bytes) -> tuple[int, int]:
    h = md5(key, usedforsecurity=False).digest()
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


# --- the filter ------------------------------------------------------------------------------------------------------


def classes(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """The lower of a key's two buckets and its fingerprint, as one number: what a filter knows of the key."""
    print_ = np.maximum(lo & 0xFFFF, 1)
    bucket = hi & _MASK
    return np.minimum(bucket, bucket ^ (print_ * _SPREAD & _MASK)) << 16 | print_


class Cuckoo:
    """A set of classes: each stands in one of its two buckets of four places, or in the list of the rest. It can hold any
    number of them, has no false negatives, and gives up what is removed."""

    def __init__(self, table: bytes | None = None, rest: bytes | None = None):
        shape = (1 << BUCKET_BITS, SLOTS)
        self.table = np.frombuffer(table, np.uint16).reshape(shape).copy() if table else np.zeros(shape, np.uint16)
        self.rest = np.frombuffer(rest or b"", np.int64)

    def _at(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        print_ = found & 0xFFFF
        bucket = found >> 16
        return print_.astype(np.uint16), bucket, bucket ^ (print_ * _SPREAD & _MASK)

    def has(self, found: np.ndarray) -> np.ndarray:
        print_, one, two = self._at(found)
        there = (self.table[one] == print_[:, None]).any(axis=1) | (self.table[two] == print_[:, None]).any(axis=1)
        return there | np.isin(found, self.rest) if len(self.rest) else there

    def add(self, found: np.ndarray) -> None:
        """``found``: different classes that are not there yet."""
        print_, bucket, other = self._at(found)
        for k in range(KICKS):
            order = np.argsort(bucket, kind="stable")
            print_, bucket, other = print_[order], bucket[order], other[order]
            change = np.concatenate(([True], bucket[1:] != bucket[:-1])) if len(bucket) else np.empty(0, bool)
            rank = np.arange(len(bucket)) - np.maximum.accumulate(np.where(change, np.arange(len(bucket)), 0))
            taken = self.table[bucket] != 0
            fits = rank < SLOTS - taken.sum(axis=1)
            free = np.argsort(taken[fits], axis=1, kind="stable")
            self.table[bucket[fits], free[np.arange(int(fits.sum())), rank[fits]]] = print_[fits]
            print_, bucket, other = print_[~fits], bucket[~fits], other[~fits]
            if not len(print_):
                return
            if k % 2:  # its other bucket is full too: one of each bucket pushes out what stands there
                _, first = np.unique(bucket, return_index=True)
                place = (bucket[first] + k) % SLOTS
                out = self.table[bucket[first], place]
                self.table[bucket[first], place] = print_[first]
                print_[first] = out
                other[first] = bucket[first] ^ (out.astype(np.int64) * _SPREAD & _MASK)
            bucket, other = other, bucket
        self.rest = np.concatenate([self.rest, np.minimum(bucket, other) << 16 | print_.astype(np.int64)])

    def remove(self, found: np.ndarray) -> None:
        """``found``: different classes."""
        print_, one, two = self._at(found)
        for bucket in (one, two):
            line, place = np.nonzero(self.table[bucket] == print_[:, None])
            self.table[bucket[line], place] = 0
        self.rest = self.rest[~np.isin(self.rest, found)]

    def state(self) -> tuple[bytes, bytes]:
        return self.table.tobytes(), self.rest.tobytes()


_STATE = "shard long, table binary, rest binary, hi long, lo long"


def _filtered(batches):
    """For batches of (shard, kind, hi, lo, many, table, rest), a shard's filter (kind 0) first, then keys to add (1) and to remove
    (2): the keys whose class was there before, or that come several times, and the new filters."""

    def batch(shard, n, **columns):
        kinds = {"table": pa.binary(), "rest": pa.binary(), "hi": pa.int64(), "lo": pa.int64()}
        rest = [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in kinds.items()]
        return pa.RecordBatch.from_arrays([pa.array([shard] * n, pa.int64()), *rest], names=["shard", *kinds])

    for shard, pieces in groupby(runs(batches, 2), key=lambda x: x[0][0]):
        cuckoo = Cuckoo()
        for (_, kind), piece in pieces:
            if kind == 0:
                cuckoo = Cuckoo(piece.column(5)[0].as_py(), piece.column(6)[0].as_py())
                continue
            hi, lo = piece.column(2).to_numpy(), piece.column(3).to_numpy()
            found = classes(hi, lo)
            if kind == 2:
                cuckoo.remove(found)
                continue
            new, first = np.unique(found, return_index=True)
            fresh = ~cuckoo.has(new)
            cuckoo.add(new[fresh])
            seen = np.ones(len(found), bool)
            seen[first[fresh]] = False
            seen |= piece.column(4).to_numpy(zero_copy_only=False)
            if seen.any():
                yield batch(shard, int(seen.sum()), hi=hi[seen], lo=lo[seen])
        table, rest = cuckoo.state()
        yield batch(shard, 1, table=[table], rest=[rest])


def _together(batches):
    """Each key of a batch once, with a mark if it came several times: a line of a third of all documents is a row for each batch
    when it comes to its shard."""
    for b in batches:
        hi, lo = b.column(0).to_numpy(), b.column(1).to_numpy()
        order = np.lexsort((lo, hi))
        hi, lo = hi[order], lo[order]
        starts = np.flatnonzero(np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])))) if len(hi) else np.empty(0, np.int64)
        many = np.diff(np.append(starts, len(hi))) > 1
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (hi[starts], lo[starts], many)], names=["hi", "lo", "many"])


# --- the index ---------------------------------------------------------------------------------------------------------

KEY = ["hi", "lo"]


@dataclass(frozen=True)
class Index:
    """``references``: a table (doc_id, row, hi, lo, n) for each insertion, never rewritten; a row is a text's number of lines
    with one key. ``gone``: (doc_id, before): deleted documents, for the insertions before that one. ``filters``: (shard,
    table, rest). ``shared``: (hi, lo, n_docs, least): the exact count of every key of two or more documents."""

    references: tuple[DataFrame, ...]
    gone: DataFrame | None
    filters: DataFrame | None
    shared: DataFrame
    shard_bits: int
    rows: int


def empty_index(spark: SparkSession, id_type: str = "long") -> Index:
    return Index((), None, None, spark.createDataFrame([], f"hi long, lo long, n_docs long, least {id_type}"), LEAST_BITS, 0)


def references_of(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, row, hi, lo, n) of the lines that can be dropped; ``row`` tells texts of one doc_id apart."""

    def run(batches):
        for b in batches:
            at, keys, counts = [], [], []
            for k, text in enumerate(b.column(2).to_pylist()):
                found: dict[bytes, int] = {}
                for line in (text or b"").split(b"\n"):
                    key = line_key(line)
                    if long_enough(key):
                        found[key] = found.get(key, 0) + 1
                at += [k] * len(found)
                keys += [md5(key, usedforsecurity=False).digest() for key in found]
                counts += found.values()
            numbers = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            take = pa.array(at, pa.int64())
            columns = [b.column(0).take(take), b.column(1).take(take), *(pa.array(np.ascontiguousarray(numbers[:, k])) for k in (0, 1)), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "hi", "lo", "n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64("text").alias("row"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, f"doc_id {kind}, row long, hi long, lo long, n long")


def live(index: Index) -> DataFrame | None:
    """The references that are not deleted."""
    layers = []
    for k, layer in enumerate(index.references):
        if index.gone is not None:
            gone = index.gone.where(F.col("before") > k).select(F.col("doc_id").alias("__gone"))
            layer = layer.join(gone, F.col("doc_id").eqNullSafe(F.col("__gone")), "left_anti")
        layers.append(layer)
    return reduce(DataFrame.unionByName, layers) if layers else None


def _shard(bits: int):
    return F.shiftrightunsigned("hi", 64 - bits).alias("shard")


def _through_filters(index: Index, keys: DataFrame, kind: int) -> tuple[DataFrame, DataFrame]:
    """The new filters, and the keys (hi, lo) that may have been there before."""
    rows = keys.select(_shard(index.shard_bits), F.lit(kind).alias("kind"), "hi", "lo", "many")
    rows = rows.withColumns({"table": F.lit(None).cast("binary"), "rest": F.lit(None).cast("binary")})
    if index.filters is not None:
        no = F.lit(0).cast("long")
        state = index.filters.select("shard", F.lit(0).alias("kind"), no.alias("hi"), no.alias("lo"), F.lit(False).alias("many"), "table", "rest")
        rows = rows.unionByName(state)
    made = cut(rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(_filtered, _STATE))
    return made.where(F.col("table").isNotNull()).select("shard", "table", "rest"), made.where(F.col("hi").isNotNull()).select(*KEY).distinct()


def _counted(references: DataFrame) -> DataFrame:
    """Documents that hold each key; one without doc_id is one document, after all others."""
    per_document = references.groupBy(*KEY, "doc_id").agg(F.sum("n").alias("n"))
    return per_document.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("least")).where(F.col("n_docs") > 1)


def insert(index: Index, docs: DataFrame) -> Index:
    """The index with ``docs`` (doc_id, text) added.

    Lines whose class the filter of their shard has not seen are new and need no count. For the others the exact table is
    read. When references outgrow the shards, more shards are planned and the filters are filled again from the references.
    """
    new = cut(references_of(docs))
    rows = index.rows + new.count()
    bits = max(LEAST_BITS, index.shard_bits, (rows // SHARD_ROWS).bit_length())
    grown = replace(index, references=(*index.references, new), rows=rows, shard_bits=bits)
    known = live(grown)
    if bits > index.shard_bits and index.filters is not None:
        grown, arriving = replace(grown, filters=None), known
    else:
        arriving = new
    together = arriving.select(*KEY).mapInArrow(_together, "hi long, lo long, many boolean")
    filters, seen = _through_filters(grown, together, 1)
    counted = _counted(known.join(seen, KEY, "left_semi"))
    shared = cut(counted.unionByName(index.shared.join(seen, KEY, "left_anti")))
    return replace(grown, filters=filters, shared=shared)


def delete(index: Index, doc_ids: DataFrame) -> Index:
    """The index without the documents whose doc_id stands in ``doc_ids`` (doc_id).

    The references of the other documents that share a class with a deleted line are counted anew; a class that no document
    holds any more leaves its filter.
    """
    if not index.references:
        return index
    layer = cut(doc_ids.select("doc_id").distinct().withColumn("before", F.lit(len(index.references))))
    less = replace(index, gone=layer if index.gone is None else index.gone.unionByName(layer))

    def known_of(frame: DataFrame) -> DataFrame:
        print_ = F.greatest(F.col("lo").bitwiseAND(0xFFFF), F.lit(1).cast("long"))
        bucket = F.col("hi").bitwiseAND(_MASK)
        other = bucket.bitwiseXOR((print_ * F.lit(_SPREAD).cast("long")).bitwiseAND(_MASK))
        return frame.withColumns({"shard": _shard(index.shard_bits), "bucket": F.least(bucket, other), "print": print_})

    where = ["shard", "bucket", "print"]
    ids = layer.select(F.col("doc_id").alias("__id"))
    removed = live(index).join(ids, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    touched = cut(known_of(removed.select(*KEY)).groupBy(*where).agg(F.min(F.struct(*KEY)).alias("key")))
    beside = cut(known_of(live(less)).join(touched.select(*where), where, "left_semi"))
    nobody = touched.join(beside.select(*where).distinct(), where, "left_anti").select("key.hi", "key.lo", F.lit(False).alias("many"))
    filters, _ = _through_filters(less, nobody, 2)
    kept = known_of(index.shared).join(touched.select(*where), where, "left_anti").select(*index.shared.columns)
    return replace(less, filters=filters, shared=cut(kept.unionByName(_counted(beside))))


def without_repeats(docs: DataFrame, index: Index) -> DataFrame:
    """``docs`` with ``n_lines`` (before dropping), ``n_dropped`` and ``kept_text``, whose lines are those that no smaller doc_id of
    the index holds. ``docs`` are documents of the index; a column of one of these names gives way.

    A document's list of dropped keys is never longer than its text. Texts are shuffled once, to meet that list.
    """
    lost = index.shared.withColumnRenamed("least", "__least").select(*KEY, "__least")
    away = live(index).join(lost, KEY).where(F.col("doc_id").isNull() | (F.col("doc_id") > F.col("__least")))
    lists = away.groupBy("doc_id", "row").agg(F.collect_set(F.struct(*KEY)).alias("__away"))
    lists = lists.select(F.col("doc_id").alias("__doc"), F.col("row").alias("__of"), "__away")
    on = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__of"))

    @F.pandas_udf("n_lines long, n_dropped long, kept binary")
    def dropped(texts: pd.Series, his: pd.Series, los: pd.Series) -> pd.DataFrame:
        out = []
        for text, hi, lo in zip(texts, his, los):
            lines = (text or b"").split(b"\n")
            if hi is None:
                out.append((len(lines), 0, text or b""))
                continue
            gone = set(zip(hi.tolist(), lo.tolist()))
            kept = [x for x in lines if not (long_enough(key := line_key(x)) and hashed(key) in gone)]
            out.append((len(lines), len(lines) - len(kept), b"\n".join(kept)))
        return pd.DataFrame(out, columns=["n_lines", "n_dropped", "kept"])

    joined = docs.join(lists, on, "left").withColumn("__row", dropped(F.col("text").cast("binary"), F.col("__away.hi"), F.col("__away.lo")))
    named = {"n_lines": F.col("__row.n_lines"), "n_dropped": F.col("__row.n_dropped"), "kept_text": F.col("__row.kept").cast("string")}
    return joined.withColumns(named).drop("__doc", "__of", "__away", "__row")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the columns of ``without_repeats``, of an index that holds them all.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of ten or more code points that two or more
    documents hold stay in the smallest doc_id alone, as often as they stand there. Null and empty texts are one empty line.
    Rows with one doc_id are one document, and so are all rows without doc_id, which comes after all others; every row is
    returned on its own. An empty table has no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return without_repeats(docs, insert(empty_index(docs.sparkSession, kind), docs))
