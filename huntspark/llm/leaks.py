"""Benchmark passages in documents: shared character q-grams in diagonal bands, checked by banded alignment."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from huntspark.plans.lineage_cut import cut

Q = 8  # characters of a gram
RATE = 0.08  # edits per character of an item
BLOCK_CHARS = 8_000_000  # benchmark characters that are sent to the executors at once
SLICE = 1 << 20  # characters searched at once
MULTIPLIER = 0x9E3779B97F4A7C15


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space, trimmed: what items and documents are compared in."""
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(chars: np.ndarray, q: int) -> np.ndarray:
    """A hash of the ``q`` characters from each position on, by doubling."""
    with np.errstate(over="ignore"):
        base, out, done = np.uint64(MULTIPLIER), None, 0
        part, width = chars.astype(np.uint64), 1
        while True:
            if q & width:
                if out is None:
                    out, done = part, width
                else:  # what is there comes first
                    n = len(chars) - done - width + 1
                    out, done = out[:n] * base + part[done : done + n], done + width
            if width * 2 > q:
                return out
            part = part[: len(part) - width] * base + part[width:]
            base, width = base * base, width * 2


class Index:
    """The q-grams of a block of items and what a match of each item must share."""

    def __init__(self, ids: list, texts: list[str], q: int = Q, rate: float = RATE):
        self.q = q
        whole = [(i, t) for i, t in zip(ids, texts) if t]
        self.short = [(i, t) for i, t in whole if len(t) < q]
        long = [(i, t) for i, t in whole if len(t) >= q]
        self.ids, self.texts = [i for i, _ in long], [t for _, t in long]
        size = np.array([len(t) for t in self.texts], np.int64)
        # k edits leave at least size - q + 1 - k * q grams; k is as large as leaves one
        self.edits = np.minimum((size * rate).astype(np.int64), (size - q) // q) if len(size) else size
        self.least = size - q + 1 - self.edits * q
        self.size = size
        hashes = [grams(codes(t), q) for t in self.texts]
        every = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes]) if hashes else np.empty(0, np.int64)
        at = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.item, self.at = item[order], at[order]
        self.hash, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.hash >> np.uint64(42)] = True

    def hits(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, position in the item) of every gram of ``chars`` that an item has."""
        out = []
        for a in range(0, len(chars), SLICE):
            h = grams(chars[a : a + SLICE + self.q - 1], self.q) if len(chars) - a >= self.q else np.empty(0, np.uint64)
            p = np.flatnonzero(self.seen[h >> np.uint64(42)])
            k = np.searchsorted(self.hash, h[p])
            k[k == len(self.hash)] = 0
            ok = self.hash[k] == h[p] if len(self.hash) else np.zeros(len(p), bool)
            p, k = p[ok] + a, k[ok]
            n = self.count[k]
            entry = np.repeat(self.first[k] - np.cumsum(n) + n, n) + np.arange(n.sum())
            out.append((np.repeat(p, n), self.item[entry], self.at[entry]))
        if not out:
            return (np.empty(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*out))

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """Matches (text number, item number, start, end, edits) in normal ``texts``; the least edits of each place."""
        if not self.texts:
            return []
        sizes = np.array([len(t) + 1 for t in texts])
        begins = np.cumsum(sizes) - sizes
        chars = codes("\x00".join(texts))
        place, item, at = self.hits(chars)
        doc = np.searchsorted(begins, place, "right") - 1
        place = place - begins[doc]
        # of an item, a document must share enough grams at all before its diagonals are looked at
        pair, which, total = np.unique(doc * len(self.texts) + item, return_inverse=True, return_counts=True)
        enough = (total >= self.least[pair % len(self.texts)])[which]
        doc, item, place, at = doc[enough], item[enough], place[enough], at[enough]
        # edits move a match over at most `edits` diagonals: bands of twice that plus two, each half over the next
        half = self.edits[item] + 1
        band = (place - at) // half
        doc, item, band, at = np.tile(doc, 2), np.tile(item, 2), np.concatenate([band, band - 1]), np.tile(at, 2)
        if not len(doc):
            return []
        order = np.lexsort((at, band, item, doc))
        doc, item, band, at = doc[order], item[order], band[order], at[order]
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])))
        fresh = new | np.concatenate(([True], at[1:] != at[:-1]))  # a gram of the item counts once in a band
        starts = np.flatnonzero(new)
        count = np.add.reduceat(fresh.astype(np.int64), starts)
        found: dict[tuple, tuple] = {}
        for s in starts[count >= self.least[item[starts]]]:
            d, i, k = int(doc[s]), int(item[s]), int(self.edits[item[s]])
            low = int(band[s]) * (k + 1)
            match = align(texts[d], self.texts[i], low, low + 2 * (k + 1), k)
            if match:
                key = (d, i, match[1])
                found[key] = min(found.get(key, match + (0,))[:3], match, key=lambda m: (m[2], m[0]))
        return sorted((d, i, *m) for (d, i, _), m in found.items())


def align(text: str, item: str, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the part of ``text`` nearest to ``item`` on the diagonals [low - edits, high + edits), if it is
    at most ``edits`` away. Of a diagonal, text position less item position is constant."""
    a, b = max(0, low - edits), min(len(text), high + edits + len(item))
    exact = text.find(item, a, b)
    if exact >= 0:
        return exact, exact + len(item), 0
    if edits == 0:
        return None
    low, high = low - edits, high + edits
    width, far = high - low, 1 << 50
    chars = np.zeros(width + len(item), np.uint32)  # chars[i + x]: the text's character at diagonal low + x and item position i
    inside = codes(text[max(0, low) : max(0, low + len(chars))])
    chars[max(0, -low) : max(0, -low) + len(inside)] = inside
    x = np.arange(width, dtype=np.int64) << 32
    here = np.arange(low, high)
    value = np.where((here >= 0) & (here <= len(text)), here, far)  # edits shifted by 32, plus the start
    one = 1 << 32
    for i, c in enumerate(codes(item)):
        step = value + np.where(chars[i : i + width] == c, 0, one)
        step[:-1] = np.minimum(step[:-1], value[1:] + one)
        value = np.minimum.accumulate(step - x) + x
        off = here + i + 1
        value = np.where((off < 0) | (off > len(text)), far, value)
    best = int(value.min())
    if best >> 32 > edits:
        return None
    end = int(here[int(np.argmin(value))]) + len(item)
    return best & 0xFFFFFFFF, end, best >> 32


def find_leaks(docs: DataFrame, items: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """Rows (doc_id, item_id, start, end, edits): the parts of documents that an item's whole text is at most ``rate`` edits
    per character away from. Offsets are in the normal form of the text (see ``normal``).

    An item of ``m`` characters may have k = min(rate * m, (m - q) / q) edits; by the q-gram lemma a match shares at least
    m - q + 1 - k * q grams on k + 1 neighbouring diagonals, so no match is lost. Items shorter than ``q`` must occur
    exactly; empty and null ones never match. The benchmark goes to the executors in blocks of bounded size, and the
    documents are read once for each. Null texts match nothing; a null doc_id is kept; repeated rows give repeated rows.
    """
    found = None
    for block in benchmark_blocks(items):

        def run(batches, block=block):
            index = index_of(block, q, rate)
            for b in batches:
                rows = [(k, *m) for k, m in matches(b.column(1).to_pylist(), index)]
                if rows:
                    doc, item, start, end, edits = zip(*rows)
                    ids = b.column(0).take(pa.array(doc))
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, t) for x, t in zip((item, start, end, edits), types))], names=names)

        names = ["doc_id", "item_id", "start", "end", "edits"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        id_type = docs.schema["doc_id"].dataType.simpleString()
        part = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, item_id long, start long, end long, edits int")
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, items: DataFrame, q: int = Q, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` in which ``find_leaks`` finds nothing, unchanged. Nothing is shuffled."""

    def leaks_of(block):
        @F.pandas_udf("boolean")
        def leaks(texts: pd.Series) -> pd.Series:
            hit = {k for k, _ in matches(texts.tolist(), index_of(block, q, rate))}
            return pd.Series([k in hit for k in range(len(texts))], dtype=bool)

        return leaks(F.col("text"))

    for block in benchmark_blocks(items):
        docs = docs.where(~leaks_of(block))
    return docs


def benchmark_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> list:
    """Broadcasts of (item_id, normal text) that together hold all ``items``, each of about ``block_chars`` characters."""
    spark: SparkSession = items.sparkSession
    kept = cut(items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null"))
    n = max(1, -(-(kept.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars))
    out = []
    for k in range(n):
        rows = kept.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        out.append(spark.sparkContext.broadcast(sorted({(r.item_id, normal(r.text)) for r in rows}, key=repr)))
    return out


def index_of(block, q: int, rate: float) -> Index:
    if getattr(block, "index", None) is None:
        block.index = Index([i for i, _ in block.value], [t for _, t in block.value], q, rate)
    return block.index


def matches(texts: list[str | None], index: Index):
    """(position in ``texts``, (item_id, start, end, edits)) of all matches, a bounded part of the texts at a time."""
    held, first, size = [], 0, 0
    for k, t in enumerate(texts):
        held.append(normal(t))
        size += len(held[-1])
        if size < SLICE and k + 1 < len(texts):
            continue
        for d, i, start, end, edits in index.search(held):
            yield first + d, (index.ids[i], start, end, edits)
        for i, item in index.short:
            for d, text in enumerate(held):
                at = text.find(item)
                if at >= 0:
                    yield first + d, (i, at, at + len(item), 0)
        held, first, size = [], k + 1, 0
