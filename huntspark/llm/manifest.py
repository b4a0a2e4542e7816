"""Merkle manifest of a dataset: a ternary tree per source, one over the sources, and a proof for every document.

A leaf partition is an aligned block of consecutive leaves. It proves all of its leaves at once (an octopus multiproof): it
names the nodes it can't derive, gets each once, derives what they share, and expands the proofs of its own leaves.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from huntspark.llm.common import runs
from huntspark.plans.lineage_cut import cut

ARITY = 3
HEIGHT = 8  # levels of a block: 6,561 leaves
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SOURCES = -1  # the number of the tree over the sources; a source's tree has its place among them


def digest(pieces: list[bytes]) -> bytes:
    return sha256(b"".join(pieces)).hexdigest().encode()


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def grow(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """``nodes`` and the levels above them."""
    out = [nodes]
    for _ in range(levels):
        out.append([digest(out[-1][k : k + ARITY]) for k in range(0, len(out[-1]), ARITY)])
    return out


def missing(known: list[int], n: int) -> list[tuple[int, int]]:
    """The least set of nodes (level, place) that, with the leaves ``known`` (sorted) of ``n``, give the root."""
    out, level = [], 0
    while n > 1:
        have = set(known)
        known = sorted({k // ARITY for k in known})
        out += [(level, c) for k in known for c in range(k * ARITY, min(k * ARITY + ARITY, n)) if c not in have]
        n, level = -(-n // ARITY), level + 1
    return out


def siblings(nodes: list[list[bytes]], levels: range, place: int) -> list[list[bytes]]:
    """Of each level the run that the node above ``place`` (of the first level) stands in, with None for itself."""
    out = []
    for level in levels:
        lo = place - place % ARITY
        out.append([None if lo + k == place else x for k, x in enumerate(nodes[level][lo : lo + ARITY])])
        place //= ARITY
    return out


def fold(leaf: bytes, path: list[list[bytes]]) -> bytes:
    """The root that ``leaf`` has under the runs of its proof."""
    for run in path:
        leaf = digest([leaf if x is None else x for x in run])
    return leaf


def leaf_hash(columns: dict[str, Column]) -> Column:
    """sha256 over the fields, each as byte count, colon and value, or ``-`` where it is null."""

    def told(c: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[told(columns[f].cast("string")) for f in FIELDS]), 256))


def leaves_of(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, source, leaf, altered): the leaf of each document, and that of its text without line ends where it is one
    of those that are tampered with (else null)."""
    fields = {f: F.col(f) for f in FIELDS}
    told = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    altered = leaf_hash(fields | {"text": F.replace("text", F.lit("\n"), F.lit(""))})
    touched = (told % 2 == 0) & (F.instr("text", "\n") > 0)
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), leaf_hash(fields).alias("leaf"), F.when(touched, altered).alias("altered"))


def positions(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``at``, the place (from 0) of each in its group by ``order`` (nulls first), and the groups (group, count).

    One shuffle by range, so a group of a third of all rows is spread over tasks; the only window sees a row for each group
    and task. The numbers are written before they are used: a task that is run again can't change them.
    """
    sorted_rows = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = cut(sorted_rows.withColumn("__n", F.monotonically_increasing_id())).withColumn("__part", F.shiftright("__n", 33))
    counted = placed.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__of")).agg(F.count("*").alias("__count"), F.min("__n").alias("__first"))
    counted = cut(counted)
    before = Window.partitionBy("__group").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.withColumn("__before", F.coalesce(F.sum("__count").over(before), F.lit(0)))
    on = F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__of"))
    at = (F.col("__n") - F.col("__first") + F.col("__before")).alias("at")
    groups = counted.groupBy(F.col("__group").alias(group)).agg(F.sum("__count").alias("count"))
    return placed.join(starts, on).select(*rows.columns, at), groups


_NODES = "tree long, block long, of long, level long, at long, node binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.binary()]
    columns = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["tree", "block", "of", "level", "at", "node"])


def _binary(node: bytes) -> bytes:
    return bytes.fromhex(node.decode())


def _hex(piece: pa.RecordBatch, k: int) -> list[bytes]:
    return [x.hex().encode() for x in piece.column(k).to_pylist()]


def block_nodes(base: int, levels: int, all_levels: bool, trees: int):
    """For batches of (tree, block, at, count, node), the nodes ``base`` levels above the leaves: those above them inside their
    block (only the block's top unless ``all_levels``), and, from the leaves of a source, what the block's proofs miss (rows
    without a node): coordinates in its own tree and in that of the sources."""

    def run(batches):
        out = []
        for (tree, block), pieces in groupby(runs(batches, 2), key=lambda x: x[0]):
            pieces = [p for _, p in pieces]
            count = pieces[0].column(3)[0].as_py()
            nodes = [x for p in pieces for x in _hex(p, 4)]
            rows = grow(nodes, min(levels, height(count) - base))
            for level in range(0 if all_levels else len(rows) - 1, len(rows)):
                first = block * ARITY ** (levels - level)
                out += [(tree, block, tree, base + level, first + k, _binary(x)) for k, x in enumerate(rows[level])]
            if base == 0 and tree != SOURCES:
                first = block * ARITY**levels
                asked = [(tree, *x) for x in missing(list(range(first, first + len(nodes))), count)]
                asked += [(SOURCES, *x) for x in missing([tree], trees)]
                out += [(tree, block, *x, None) for x in asked]
            if len(out) > 10_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    return run


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    block = F.expr(f"at div {ARITY**levels}").alias("block")
    rows = nodes.select("tree", block, "at", "count", "node")
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")


def tree_nodes(leaves: DataFrame, most: int, levels: int, trees: int, all_levels: bool = False) -> DataFrame:
    """Nodes of the trees whose leaves are (tree, at, count, node), as rows like ``_NODES``: the tops of the blocks of leaves
    (all nodes, if ``all_levels``), everything above them, and the coordinates that the blocks miss.

    A round climbs ``levels`` levels, and a round's input is the tops of the one before: with 6,561 leaves in a block, two or
    three rounds for any dataset. ``most`` is the largest count."""
    done, base, now = None, 0, leaves
    while True:
        made = cut(_in_blocks(now, levels).mapInArrow(block_nodes(base, levels, all_levels or base > 0, trees), _NODES))
        inner = made if base == 0 else made.where(F.col("level") > base)
        done = inner if done is None else done.unionByName(inner)
        base += levels
        if base >= height(most):
            return done
        counts = leaves.select("tree", "count").distinct()
        tops = made.where(F.col("node").isNotNull() & (F.col("level") == base)).select("tree", "at", "node")
        now = tops.join(counts, "tree")


_PROOFS = "doc_id {}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def proofs(levels: int, trees: int):
    """For batches of (tree, block, kind, of, level, at, count, node, altered, doc_id), the nodes a block asked for (kind 0) before
    its leaves: a proof for each leaf."""

    def run(batches):
        for (tree, block), pieces in groupby(runs(batches, 2), key=lambda x: x[0]):
            fetched, leaves, altered, ids, count = {}, [], [], [], 0
            for _, p in pieces:
                kind = p.column(2).to_numpy()
                nodes = p.slice(0, n) if (n := int((kind == 0).sum())) else None
                if nodes is not None:
                    keys = zip(*(nodes.column(k).to_pylist() for k in (3, 4, 5)))
                    fetched |= dict(zip(keys, _hex(nodes, 7)))
                own = p.slice(n)
                if own.num_rows:
                    count = own.column(6)[0].as_py()
                    leaves += _hex(own, 7)
                    altered += [x and x.hex().encode() for x in own.column(8).to_pylist()]
                    ids.append(own.column(9))
            if not leaves:
                continue
            inside = min(levels, height(count))
            rows = grow(leaves, inside)
            node, place, n, shared = rows[-1][0], block, count, []
            for _ in range(inside):
                n = -(-n // ARITY)

            def climb(node, place, level, n, of):
                """From a node to the root of its tree, by way of the nodes that were fetched."""
                while n > 1:
                    lo = place - place % ARITY
                    run = [None if k == place else fetched[of, level, k] for k in range(lo, min(lo + ARITY, n))]
                    shared.append(run)
                    node, place, level, n = fold(node, [run]), place // ARITY, level + 1, -(-n // ARITY)
                return node

            subroot = climb(node, place, inside, n, tree)
            root = climb(subroot, tree, 0, trees, SOURCES)
            tail = b"".join(x for r in shared for x in r if x is not None)
            proof, folded, above = [], [], {}
            for k, leaf in enumerate(leaves):
                if k // ARITY not in above:
                    above = {k // ARITY: siblings(rows, range(1, inside), k // ARITY)}
                path = siblings(rows, range(min(1, inside)), k) + above[k // ARITY]
                proof.append(sha256(b"".join([x for r in path for x in r if x is not None]) + tail).hexdigest())
                folded.append(fold(altered[k] or leaf, path + shared).decode())
            fixed = [pa.array([x] * len(leaves)) for x in (subroot.decode(), root.decode())]
            columns = [
                pa.concat_arrays(ids), pa.array([x.decode() for x in leaves]), *fixed, pa.array(proof), pa.array(folded),
                pa.array([x == root.decode() for x in folded]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return run


def manifest(docs: DataFrame, levels: int = HEIGHT) -> DataFrame:
    """``docs`` (doc_id, source, lang, n_chars, text) as rows (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified).

    Null doc_ids come first in their source, a null source is a source of its own and the first. Equal doc_ids come in the order
    of their leaves; repeated rows are leaves of their own with proofs of their own. A null doc_id or text is never tampered
    with. A tree of one leaf is that leaf; without any sibling, a proof is the hash of nothing. Other columns are not read. An
    empty table has no rows.

    Texts are read once and never shuffled: all that moves is a digest or two a document, and the nodes a block fetches (at
    most two a level). A source of a third of all rows is as many blocks as any other rows.
    """
    found = cut(leaves_of(docs))
    placed, groups = positions(found, "source", ["doc_id", "leaf"])
    named, _ = positions(groups.withColumn("all", F.lit(0)), "all", ["source"])
    named = cut(named.select(F.col("source").alias("__source"), F.col("at").alias("tree"), "count"))
    leaves = placed.join(named, F.col("source").eqNullSafe(F.col("__source")))
    leaves = cut(leaves.select("tree", "at", "count", "doc_id", F.col("leaf").alias("node"), "altered"))
    trees, most = named.agg(F.count("*"), F.max("count")).first()
    made = tree_nodes(leaves, most or 0, levels, trees)
    subroots = made.where(F.col("node").isNotNull()).groupBy("tree").agg(F.max_by("node", "level").alias("node"))
    tops = cut(subroots.select(F.lit(SOURCES).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(trees).cast("long").alias("count"), "node"))
    nodes = made.unionByName(tree_nodes(tops, trees, levels, trees, all_levels=True))

    asked = made.where(F.col("node").isNull()).select("tree", "block", "of", "level", "at")
    known = nodes.where(F.col("node").isNotNull()).select("of", "level", "at", "node")
    fetched = asked.join(known, ["of", "level", "at"]).select("tree", "block", F.lit(0).alias("kind"), "of", "level", "at", F.lit(0).cast("long").alias("count"), "node")
    block = F.expr(f"at div {ARITY**levels}").alias("block")
    own = leaves.select("tree", block, F.lit(1).alias("kind"), F.lit(0).cast("long").alias("of"), F.lit(0).cast("long").alias("level"), "at", "count", "node", "altered", "doc_id")
    rows = own.unionByName(fetched, allowMissingColumns=True)
    rows = rows.select("tree", "block", "kind", "of", "level", "at", "count", "node", "altered", "doc_id")
    rows = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "at")
    return rows.mapInArrow(proofs(levels, trees), _PROOFS.format(docs.schema["doc_id"].dataType.simpleString()))
