"""Token ids as grammar-compressed shards: encode, Re-Pair per shard, write, and read back at random.

File format: Parquet rows, one per shard, in ascending doc_id order by (part, seq). A shard holds whole documents:

    part, seq       place of the shard in the order
    n_tokens        ids in the shard, end ids included
    doc_ids         the documents, in order
    rules           rule k as two little-endian uint32: nonterminal ``vocab + 1 + k`` stands for these two symbols
    lengths         uint32 per rule: ids that it expands to
    symbols         uint32: ids below ``vocab``, ``vocab`` for the end of a document, nonterminals
    offsets         uint32 per document and one more: where its symbols start
"""

from __future__ import annotations

import os
import re
import string
import sys
import types
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from huntspark.llm.common import give_back

END = 2
SHARD_TOKENS = 1 << 20
LEAST = 8  # uses of a pair that make it a rule
PER_ROUND = 4096  # pairs replaced at once
WORDS = 300_000  # distinct words whose ids a worker keeps
TEXTS = 2 << 20  # characters encoded at once
SLOTS = 18  # bits of a table of pairs
LOT = 64  # words that are encoded as one string
WHITE, ALNUM = np.frombuffer(b" \n", np.uint8), np.frombuffer((string.ascii_letters + string.digits).encode(), np.uint8)
LETTERS, DIGITS, SIGNS = "A-Za-zÀ-ÖØ-öø-ɏ", "0-9", r"!-&(-/:-@\[-`{-~"  # words of these need no pattern; an apostrophe does
# fixed values: white space other than the space and the line end
OTHER_SPACES = "\t\v\f\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SHARD = "part int, seq int, n_tokens long, doc_ids array<{id}>, rules binary, lengths binary, symbols binary, offsets binary"


# --- ids ---------------------------------------------------------------------------------------------------------------


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it can be seen, else the next from
    256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b if b in seen else next(hidden)) for b in range(256)]


class Encoder:
    """Whole texts to ids with a byte-level tokenizer file of the tokenizers library, as it encodes them by itself.

    Its pattern starts a new pre-token at every single space and makes a single line end one of its own, so a text without two
    white spaces in a row is the list of its words, each encoded on its own with the space or line end before it. Signs after an
    ASCII letter or digit are words of their own where no token stands across such a place. Other texts are not cut, and so are
    texts with a special token. Words are numbered a batch of texts at a time, by their distinct ones. The ids of up to
    ``limit`` words are kept; beyond that the rarest give way. Ids are those of the whole text either way.
    """

    def __init__(self, path: str, limit: int = WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.vocab = self.whole.get_vocab_size()
        # where no token stands across a place at which the pattern cuts, words are merged side by side
        self.plain = Tokenizer(self.whole.model)  # without a pattern; the vocabulary stands in memory once
        alphabet = byte_alphabet()
        self.points = np.array([ord(c) for c in alphabet], "<u4")
        self.simple = None if self._crosses(alphabet) else rf"^[ \n][{LETTERS}{DIGITS}{SIGNS}]+$"
        self.sizes = np.array([len(t) for t, _ in sorted(self.whole.get_vocab().items(), key=lambda x: x[1])], np.int64)
        own = re.compile(f"[{SIGNS}]" if self.simple is not None else "(?!)").match
        self.signs = bytes(bool(own(chr(b))) for b in range(256))
        self.words, self.limit = pa.array([], pa.large_string()), limit
        self.flat, self.start, self.size, self.uses = np.empty(0, np.uint32), *(np.empty(0, np.int64) for _ in range(3))

    def _crosses(self, alphabet: list[str]) -> bool:
        """Whether some token stands across two kinds of characters, or before a space or beside a line end. Halves of letters
        count as letters."""
        byte = {c: b for b, c in enumerate(alphabet)}
        letters = LETTERS + "\udc80-\udcbf\udcc3-\udcc9"
        own = re.compile(rf"[{letters}{DIGITS}{SIGNS} \n]+").fullmatch
        cut = re.compile("|".join([rf"[{k}][^{k}]|[^ {k}][{k}]" for k in (letters, DIGITS, SIGNS)] + ["[^ ] ", r"\n[^\n]", r"[^\n]\n"])).search
        tokens = self.whole.get_vocab().keys() - set(self.special)
        texts = (bytes(byte[c] for c in t if c in byte).decode("utf-8", "surrogateescape") for t in tokens)
        return any(own(t) and cut(t) for t in texts)

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of ``words``; where those of a word start, and how many they are."""
        none, simple = pa.scalar("", pa.large_string()), np.zeros(len(words), bool)
        if self.simple is not None:
            simple = pc.match_substring_regex(words, self.simple).to_numpy(zero_copy_only=False)
        counts, flats = np.zeros(len(words), np.int64), []
        if simple.any():
            plain = words.filter(pa.array(simple))
            ends = np.cumsum(pc.binary_length(plain).to_numpy())
            one = np.frombuffer(pc.binary_join(pa.LargeListArray.from_arrays([0, len(plain)], plain), none)[0].as_buffer(), np.uint8)
            signs = self.points[one].tobytes().decode("utf-32-le")  # one for each byte
            places = [0, *ends[LOT - 1 : -1 : LOT].tolist(), len(one)]
            lots = [signs[a:z] for a, z in zip(places, places[1:])]
            flats.append(np.concatenate([np.array(e.ids, np.uint32) for e in self.plain.encode_batch_fast(lots, add_special_tokens=False)]))
            counts[simple] = np.diff(np.searchsorted(np.cumsum(self.sizes[flats[0]]), ends) + 1, prepend=0)
        if not simple.all():
            other = words.filter(pa.array(~simple)).to_numpy(zero_copy_only=False).tolist()
            ids = [e.ids for e in self.whole.encode_batch_fast(other, add_special_tokens=False)]
            counts[~simple] = [len(x) for x in ids]
            flats.append(np.fromiter(chain.from_iterable(ids), np.uint32))
        order = np.concatenate([np.flatnonzero(simple), np.flatnonzero(~simple)])  # whose ids stand where
        size = counts[order]
        start = np.empty(len(words), np.int64)
        start[order] = np.cumsum(size) - size
        return np.concatenate(flats), start, counts

    def _make_room(self) -> None:
        """Forget words that were met once, and beyond half the limit the rarest others; what stays counts as met once."""
        often = np.flatnonzero(self.uses > 1)
        if len(often) > self.limit // 2:
            often = np.sort(often[np.argsort(-self.uses[often], kind="stable")[: self.limit // 2]])
        sizes = self.size[often]
        self.words = self.words.take(pa.array(often))
        start = np.cumsum(sizes) - sizes
        self.flat = self.flat[np.repeat(self.start[often] - start, sizes) + np.arange(sizes.sum())]
        self.start, self.size, self.uses = start, sizes, np.ones(len(often), np.int64)

    def _can_cut(self, text: str) -> bool:
        """Whether the words of a text can be encoded one by one."""
        if "  " in text or " \n" in text or any(s in text for s in self.special):
            return False
        return not (any(c in text for c in OTHER_SPACES) and re.search(r"\s\s", text))

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The words of all ``texts``, as they stand side by side, and how many there are before each text and at the end. A word
        starts with its text, at a space, at a line end without white space beside it, or with a sign after a letter or digit."""
        parts = [t.encode() for t in texts]
        data, offsets = b"".join(parts), np.cumsum([0, *map(len, parts)])
        one = np.frombuffer(data, np.uint8)
        first = one == 32
        signs = np.flatnonzero(np.frombuffer(data.translate(self.signs), bool))
        first[signs[np.isin(one[signs - 1], ALNUM)]] = True
        lines = np.flatnonzero(one == 10)
        first[lines[~np.isin(one[lines - 1], WHITE) & ~np.isin(one[(lines + 1) % len(one)], WHITE)]] = True
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(first)
        ends = pa.py_buffer(np.append(start, len(one)))
        return pa.LargeStringArray.from_buffers(len(start), ends, pa.py_buffer(data)), np.searchsorted(start, offsets)

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each word; words that are met for the first time are encoded."""
        if len(self.words) > self.limit:
            self._make_room()
        found = words.dictionary_encode()
        known = pc.index_in(found.dictionary, value_set=self.words)
        number = known.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = number < 0
        if new.any():
            fresh = found.dictionary.filter(pa.array(new))
            number[new] = len(self.words) + np.arange(len(fresh))
            more, at, sizes = self._of_words(fresh)
            self.words = pa.concat_arrays([self.words, fresh])
            self.start = np.concatenate([self.start, len(self.flat) + at])
            self.flat, self.size = np.concatenate([self.flat, more]), np.concatenate([self.size, sizes])
            self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.int64)])
        indices = found.indices.to_numpy()
        self.uses[number] += np.bincount(indices, minlength=len(number))
        return number[indices]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; ``texts`` should be some megabytes together."""
        found = self._ids(texts)
        give_back()
        return found

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        ready = [self._can_cut(t) for t in texts]
        words, places = self._cut([t for t, r in zip(texts, ready) if r])
        whole = iter(self.whole.encode_batch_fast([t for t, r in zip(texts, ready) if not r], add_special_tokens=False))
        number = self._numbers(words)
        sizes = self.size[number]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.flat[np.repeat(self.start[number] - upto[:-1], sizes) + np.arange(upto[-1])]
        cut = iter(np.split(ids, upto[places[1:-1]]))
        return [next(cut) if r else np.array(next(whole).ids, np.uint32) for r in ready]


def encoder(path: str) -> Encoder:
    """One encoder per worker process and tokenizer file, kept between tasks."""
    kept = sys.modules.setdefault("_llm_encoders", types.ModuleType("_llm_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


# --- Re-Pair -----------------------------------------------------------------------------------------------------------


def find(frequent: np.ndarray, chosen: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``pairs`` that hold none of the ``frequent`` (some that hold none may be left out); places of one of the
    ``chosen`` among them, and which one. ``chosen`` is sorted. Pairs lie in a table by a hash; only chosen ones that share a
    slot are searched."""
    factor, bits = (0x9E3779B1, 32) if pairs.dtype == np.uint32 else (0x9E3779B97F4A7C15, 64)
    slots, slots_chosen, slots_frequent = (x * x.dtype.type(factor) >> x.dtype.type(bits - SLOTS) for x in (pairs, chosen, frequent))
    held, number = np.zeros(1 << SLOTS, np.int32), np.arange(len(chosen), dtype=np.int32)
    mark = np.zeros(1 << SLOTS, np.uint8)  # 1: of a frequent pair, 2: of a chosen one
    mark[slots_frequent], mark[slots_chosen], held[slots_chosen] = 1, 2, number
    found = mark[slots]
    some = np.flatnonzero(found == 2)
    rule, asked = held[slots[some]], pairs[some]
    ok = chosen[rule] == asked
    shared = slots_chosen[held[slots_chosen] != number]
    if len(shared):
        several = np.zeros(1 << SLOTS, bool)
        several[shared] = True
        rest = np.flatnonzero(several[slots[some]] & ~ok)
        rule[rest] = np.minimum(np.searchsorted(chosen, asked[rest]), len(chosen) - 1)
        ok[rest] = chosen[rule[rest]] == asked[rest]
    return np.flatnonzero(found == 0), some[ok], rule[ok]


def repair(symbols: np.ndarray, barrier: int, least: int = LEAST, per_round: int = PER_ROUND) -> tuple[np.ndarray, np.ndarray]:
    """(rules, symbols): frequent neighbours replaced by nonterminals from ``barrier`` + 1 on, until no pair occurs ``least``
    times. Nothing is paired with ``barrier``.

    A round counts every pair, then replaces the most frequent ones at once. Within a round no symbol is the left of one
    pair and the right of another, so occurrences cannot overlap, except in runs of one symbol, which are paired from
    their start; what a round passes over is counted again in the next.
    """
    # symbols are numbered anew as they occur, so that mostly a pair fits 32 bits, which sort faster
    present = np.zeros(barrier + 1, bool)
    present[symbols] = True
    names, ids = np.flatnonzero(present), int(present.sum())
    number = (np.cumsum(present) - 1).astype(np.uint32)
    end = int(number[barrier]) if present[barrier] else -1
    symbols = number[symbols]
    rules = [np.empty((0, 2), np.uint32)]
    # a pair never gains uses, so places of rare pairs are looked at again only when a neighbour was replaced
    live = np.zeros(len(symbols), bool)
    live[:-1] = (symbols[:-1] != end) & (symbols[1:] != end)
    while live.any():
        kind, bits = (np.uint32, 16) if ids <= 1 << 16 else (np.uint64, 32)
        places = np.flatnonzero(live)
        left, right = symbols[places], symbols[places + 1]
        pairs = left.astype(kind) << kind(bits) | right.astype(kind)
        keys = np.sort(pairs)
        new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        count = np.diff(np.append(new, len(keys)))
        keys, count = keys[new[count >= least]], count[count >= least]
        lefts: set[int] = set()
        rights: set[int] = set()
        picked = []
        for k in keys[np.argsort(-count, kind="stable")].tolist():
            a, b = k >> bits, k & (1 << bits) - 1
            if a in rights or b in lefts or (a == b and (a in lefts or b in rights)):
                continue
            lefts.add(a)
            rights.add(b)
            picked.append(k)
            if len(picked) == per_round:
                break
        if not picked:
            break
        chosen = np.sort(np.array(picked, kind))
        both = np.stack([chosen >> kind(bits), chosen & kind((1 << bits) - 1)], axis=1).astype(np.uint32)
        rare, at, rule = find(keys, chosen, pairs)
        live[places[rare]] = False
        at = places[at]
        double = both[:, 0] == both[:, 1]
        if double.any():  # every second place of a run, counted from its start
            of = np.flatnonzero(double[rule])
            run = np.concatenate(([True], at[of[1:]] != at[of[:-1]] + 1))[: len(of)]
            origin = at[of][np.maximum.accumulate(np.where(run, np.arange(len(of)), 0))]
            ok = np.ones(len(at), bool)
            ok[of] = (at[of] - origin) % 2 == 0
            at, rule = at[ok], rule[ok]
        symbols[at] = (ids + rule).astype(np.uint32)
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, live = symbols[keep], live[keep]
        at -= np.arange(len(at))
        word = symbols != end
        for near in (at[at < len(symbols) - 1], at[at > 0] - 1):
            live[near] = word[near] & word[near + 1]
        live[-1] = False
        rules.append(both)
        ids += len(both)
    every = np.concatenate(rules)
    names = np.concatenate([names, barrier + 1 + np.arange(len(every))]).astype(np.uint32)
    return names[every], names[symbols]


def expansion_lengths(rules: np.ndarray, barrier: int) -> np.ndarray:
    """Ids each rule expands to. A rule uses only rules of earlier rounds, so passes settle it bottom-up."""
    size = np.zeros(len(rules), np.int64)
    while len(rules) and (size == 0).any():
        known = np.concatenate([np.ones(barrier + 1, np.int64), size])
        parts = known[rules]
        size = np.where((parts > 0).all(axis=1), parts.sum(axis=1), 0)
    return size.astype(np.uint32)


def expand(symbols: np.ndarray, rules: np.ndarray, barrier: int, end: int = END) -> np.ndarray:
    """The ids that ``symbols`` stand for; the end of a document is ``end``. The rules are written out first, round by round,
    then each symbol is looked up once."""
    flat, at = np.arange(barrier + 1, barrier + 1 + len(rules), dtype=np.uint32), np.arange(len(rules) + 1)
    while (inner := flat > barrier).any():
        place = np.cumsum(np.concatenate(([0], np.where(inner, 2, 1))))
        out = np.empty(int(place[-1]), np.uint32)
        out[place[:-1][~inner]] = flat[~inner]
        pair = rules[flat[inner].astype(np.int64) - barrier - 1]
        out[place[:-1][inner]], out[place[:-1][inner] + 1] = pair[:, 0], pair[:, 1]
        flat, at = out, place[at]
    flat = np.concatenate([np.arange(barrier + 1, dtype=np.uint32), flat])
    flat[barrier] = end
    start = np.concatenate([np.arange(barrier + 1), at[:-1] + barrier + 1])
    size = np.concatenate([np.ones(barrier + 1, np.int64), np.diff(at)])[symbols]
    return flat[np.repeat(start[symbols] - np.cumsum(size) + size, size) + np.arange(size.sum())]


def id_at(shard: dict, doc: int, position: int, barrier: int, end: int = END) -> int:
    """The id at ``position`` of the shard's document number ``doc``, without expanding anything else: whole symbols are
    skipped by their expansion lengths, then one rule is followed down."""
    rules, lengths, symbols, offsets = (np.frombuffer(shard[k], "<u4") for k in ("rules", "lengths", "symbols", "offsets"))
    rules = rules.reshape(-1, 2)
    own = symbols[offsets[doc] : offsets[doc + 1]].astype(np.int64)
    size = np.concatenate([np.ones(barrier + 1, np.int64), lengths])
    upto = np.cumsum(size[own])
    k = int(np.searchsorted(upto, position, "right"))
    if k == len(own):
        raise IndexError(position)
    symbol, rest = int(own[k]), position - int(upto[k] - size[own[k]])
    while symbol > barrier:
        a, b = (int(x) for x in rules[symbol - barrier - 1])
        symbol, rest = (a, rest) if rest < size[a] else (b, rest - int(size[a]))
    return end if symbol == barrier else symbol


# --- shards ------------------------------------------------------------------------------------------------------------


def shards(docs: DataFrame, tokenizer: str, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``docs`` (doc_id, text) as shard rows. Null texts are empty: only the end id. Documents come by ascending doc_id, null
    first, rows that repeat side by side; each is whole in one shard, however long it is. A task holds one shard and
    two megabytes of text beyond its Arrow batch, and gives back what encoding and Re-Pair took."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType

    def run(batches):
        tool = encoder(tokenizer)
        end = np.array([tool.vocab], np.uint32)
        part, seq, ids, held, size = TaskContext.get().partitionId(), 0, [], [], 0

        def shard():
            flat = np.concatenate(held)
            held.clear()
            rules, symbols = repair(flat, tool.vocab)
            del flat
            give_back()
            ends = np.flatnonzero(symbols == tool.vocab) + 1
            parts = (rules, expansion_lengths(rules, tool.vocab), symbols, np.concatenate(([0], ends)))
            blobs = [pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in parts]
            lists = pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids))
            head = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()), lists]
            return pa.RecordBatch.from_arrays([*head, *blobs], names=names)

        names = ["part", "seq", "n_tokens", "doc_ids", "rules", "lengths", "symbols", "offsets"]
        for b in batches:
            texts, first, chars = [], 0, 0
            for k in range(b.num_rows):
                texts.append(b.column(1)[k].as_py())
                chars += len(texts[-1])
                if chars < TEXTS and k + 1 < b.num_rows:
                    continue
                for n, found in enumerate(tool.encode(texts)):
                    held += [found, end]
                    ids.append(b.column(0).slice(first + n, 1))
                    size += len(found) + 1
                    if size >= shard_tokens:
                        yield shard()
                        seq, ids, held, size = seq + 1, [], [], 0
                texts, first, chars = [], k + 1, 0
        if held:
            yield shard()

    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return ordered.mapInArrow(run, SHARD.format(id=id_type.simpleString()))


def write_shards(docs: DataFrame, path: str, tokenizer: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write ``docs`` as shard files to ``path``, a folder all executors reach; Spark commits each task's file."""
    shards(docs, tokenizer, shard_tokens).write.parquet(path)


def read_documents(spark: SparkSession, path: str, vocab: int, end: int = END) -> DataFrame:
    """The documents of shard files: doc_id, start (ids of all documents before), n_tokens, ids_crc32, and part, seq, place.

    Starts come from the token counts of the shards: summed per part, then in one window over the parts (one row per
    task of the write), then within each part.
    """
    files = spark.read.parquet(path)
    id_type = files.schema["doc_ids"].dataType.elementType

    def run(batches):
        for b in batches:
            for row in range(b.num_rows):
                one = {n: b.column(k)[row] for k, n in enumerate(b.schema.names)}
                rules, symbols, offsets = (np.frombuffer(one[n].as_py(), "<u4") for n in ("rules", "symbols", "offsets"))
                rules, lengths = rules.reshape(-1, 2), np.frombuffer(one["lengths"].as_py(), "<u4")
                size = np.concatenate([np.ones(vocab + 1, np.int64), lengths])
                ends = np.cumsum(size[symbols.astype(np.int64)])[offsets[1:].astype(np.int64) - 1]
                starts = np.concatenate(([0], ends[:-1]))
                ids = expand(symbols, rules, vocab, end).astype("<u4")
                crc = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(starts, ends)]
                n = len(ends)
                columns = [
                    one["doc_ids"].values, pa.array(starts, pa.int64()), pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array([one["part"].as_py()] * n, pa.int32()), pa.array([one["seq"].as_py()] * n, pa.int32()), pa.array(np.arange(n), pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "within", "n_tokens", "ids_crc32", "part", "seq", "place"])
                del one, rules, symbols, offsets, lengths, size, ids
                give_back()

    docs = files.select("part", "seq", "doc_ids", "rules", "lengths", "symbols", "offsets").mapInArrow(
        run, f"doc_id {id_type.simpleString()}, within long, n_tokens long, ids_crc32 long, part int, seq int, place int"
    )
    counts = files.select("part", "seq", "n_tokens")
    before = W.rowsBetween(W.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("part_start"))
    within = F.coalesce(F.sum("n_tokens").over(before.partitionBy("part").orderBy("seq")), F.lit(0))
    starts = counts.withColumn("shard_start", within).join(parts, "part")
    starts = starts.select("part", "seq", (F.col("part_start") + F.col("shard_start")).alias("shard_start"))
    return docs.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "part", "seq", "place"
    )
