"""Hard negatives, manifests and line dedup against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from huntspark.llm import hard_negatives, line_dedup, manifest

VECTORS = "vec_id long, embedding array<float>, label int, anchor_id long, whole string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_lines string, at long, leaf string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- hard negatives ------------------------------------------------------------------------------------------------------


def mined(rows):
    fine = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = int(math.fmod(label + 1, 10)) if i % 7 == 0 else label
        v = tuple(float(np.float32(x)) for x in v)
        fine[i] = min(fine.get(i, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in fine.items()}
    out = []
    for a, (label, v) in whole.items():
        if a % 100:
            continue
        scored = []
        for i, (other, w) in whole.items():
            if i != a and len(w) == len(v):
                s = sum(x * y for x, y in zip(v, w))
                scored.append((-max(-(1 << 52), min(1 << 52, s)), i, other == label))
        scored.sort()
        for s, p, same in [x for x in scored if x[2]][:5]:
            inside = [(-t, n) for t, n, own in scored if not own and -30 * s <= -100 * t <= -90 * s][:10]
            out += [(a, p, k, n, -s, t) for k, (t, n) in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("chunks", [((4096, 1 << 18), 8192), ((40, 64), 1)])
def test_negatives_against_all_scores(spark, chunks):
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.normal(size=6) + 1.2).round(2).tolist(), int(rng.integers(0, 4))) for i in rng.choice(900, 420, replace=False)]
    rows += [(100 * k, rows[k][1], k % 4) for k in range(10, 14)] + [(i + 2000, rows[5][1], i % 3) for i in range(40)]
    rows += [rows[0], rows[0], (rows[1][0], rows[1][1], 9), (rows[1][0], rows[2][1], 0)]  # repeated, and one id with several rows
    odd = [(None, [1.0] * 6, 1), (3000, None, 1), (3100, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (3200, [float("nan")] * 6, 1)]
    odd += [(3300, [float("inf")] * 6, 1), (3400, [1.0] * 6, None), (3500, [], 1), (3501, [], 1), (3502, [], 2), (3600, [1.0, 2.0], 1), (3601, [2.0, 1.0], 2)]
    odd += [(3700, [0.0] * 6, 1), (-100, [1.0] * 6, -3), (-700, [1.0] * 6, -3), (4000, [1e30] * 6, 1), (4001, [-1e30, 1e30, 1.0, 1.0, 1.0, 1.0], 2), (4002, [1e12] * 6, 3)]
    odd += [(2147483647 * 7, [1.0] * 6, 2147483647)]
    random.Random(5).shuffle(rows)
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows + odd], VECTORS)
    got = sorted(tuple(r) for r in hard_negatives.mine_negatives(frame, *chunks).collect())
    want = mined(rows + odd)
    assert got == want and len(want) > 100


def test_negatives_of_nothing(spark):
    frame = spark.createDataFrame([(100, [1.0], 1, 1, "x"), (101, [1.0], 2, 1, "x")], VECTORS)
    assert hard_negatives.mine_negatives(frame).collect() == []  # no positive
    assert hard_negatives.mine_negatives(frame.limit(0)).collect() == []


def test_best_and_merged():
    rng = random.Random(1)
    found = np.array([[rng.randrange(-3, 4) for _ in range(50)] for _ in range(20)])
    allowed, ids = found % 3 != 0, np.arange(100, 150)
    one, two = (hard_negatives.best(found[:, a:b], allowed[:, a:b], ids[a:b], 4) for a, b in ((0, 25), (25, 50)))
    score, partner = hard_negatives.merged(one, two, 4)
    for k in range(20):
        want = sorted((-s, i) for s, i, ok in zip(found[k].tolist(), ids.tolist(), allowed[k]) if ok)[:4]
        assert [(-s, i) for s, i in zip(score[k].tolist(), partner[k].tolist())] == want


# --- manifest ------------------------------------------------------------------------------------------------------------


def told(row):
    doc_id, text, lang, source, n_chars = row
    values = (doc_id, source, lang, n_chars, text)
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in values))


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def proven(rows):
    def low(x):
        return (x is not None, x if x is not None else 0)

    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = {s: sorted(((low(r[0]), told(r), r) for r in rows if r[3] == s), key=lambda x: x[:2]) for s in sources}
    trees = {s: levels_of([x[1] for x in g]) for s, g in groups.items()}
    top = levels_of([trees[s][-1][0] for s in sources])
    out = []
    for number, s in enumerate(sources):
        for place, (_, leaf, row) in enumerate(groups[s]):
            doc_id, text, *rest = row
            now = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
                now = told((doc_id, text.replace("\n", ""), *rest))
            beside = []
            for levels, at in ((trees[s], place), (top, number)):
                for level in levels[:-1]:
                    run = range(at - at % 3, min(at - at % 3 + 3, len(level)))
                    beside += [level[k] for k in run if k != at]
                    now = sha("".join(now if k == at else level[k] for k in run))
                    at //= 3
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], sha("".join(beside)), now, now == top[-1][0]))
    return sorted(out, key=repr)


def manifest_rows(seed, n):
    rng = random.Random(seed)
    rows = [(k, f"line {k}\nü{'x' * (k % 5)}\n", rng.choice([None, "en"]), rng.choice([None, "", "a", "z", "é", "\U0001f600", "hot", "hot", "hot"]), k % 7 or None) for k in range(n)]
    rows += [rows[3], rows[3], (None, "a\nb", None, "a", 1), (None, "a\nb", None, "a", 1), (3, "other\n", "en", rows[3][3], 2), (n + 1, None, None, "only", None)]
    rows += [(n + 2, "", "", "only", 0), (-4, "w " * 50_000 + "\n", "en", "long", 100_001)]
    return rows


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_against_plain_trees(spark, levels):
    rows = manifest_rows(1, 150)
    frame = spark.createDataFrame([(*r, "x", 5, "leaf") for r in rows], DOCS)
    got = sorted((tuple(r) for r in manifest.manifest(frame, levels).collect()), key=repr)
    assert got == proven(rows)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 9, 10])
def test_manifest_of_few(spark, n):
    rows = [(k, f"a\n{k}", "en", "s", 1) for k in range(n)]
    frame = spark.createDataFrame([(*r, "x", 5, "leaf") for r in rows], DOCS)
    assert sorted((tuple(r) for r in manifest.manifest(frame, 1).collect()), key=repr) == proven(rows)


@pytest.mark.parametrize("n", [1, 2, 7, 27, 30])
def test_missing_nodes_are_least_and_enough(n):
    rng = random.Random(n)
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // 3))
    for _ in range(20):
        known = sorted(rng.sample(range(n), rng.randint(1, n)))
        asked = manifest.missing(known, n)
        have = {(0, k) for k in known} | set(asked)
        for level, size in enumerate(sizes[1:]):
            have |= {(level + 1, k) for k in range(size) if all((level, c) in have for c in range(3 * k, min(3 * k + 3, sizes[level])))}
        assert (len(sizes) - 1, 0) in have
        for level, at in asked:  # a node that a known leaf is below could be derived
            assert not any(k // 3**level == at for k in known)


# --- lines ---------------------------------------------------------------------------------------------------------------

STRIP = re.compile(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def deduped(rows, index=None):
    def key(line):
        return STRIP.sub("", line).translate(SMALL)

    holders: dict[str, set] = {}
    for i, text in rows if index is None else index:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        kept = []
        lines = (text or "").split("\n")
        for line in lines:
            ids = holders[key(line)]
            if len(key(line)) < 10 or len(ids) < 2 or i == min(x for x in ids if x is not None):
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def line_rows(seed, n):
    rng = random.Random(seed)
    lines = [f"a common line {k}" for k in range(30)] + ["short", "ninechars", " ten chars\t", "TEN CHARS", "Ten  chars", "ééééééééé", "éééééééééé", "ÉÉÉÉÉÉÉÉÉÉ", "", "\r", "\x0b\x0cvertical white\x1f"]
    rows = [(k, "\n".join(rng.choice(lines + [f"own line of {k}"]) for _ in range(rng.randint(1, 12)))) for k in range(n)]
    return rows + [(2 * n, None), (2 * n + 1, ""), (2 * n + 2, "\n"), (2 * n + 3, "y" * 200_000 + "\n" + lines[0])]


def texts(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "clash", 5, "leaf") for i, t in rows], DOCS)


def result(frame):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in frame.collect()), key=repr)


def test_lines_against_plain_counts(spark):
    rows = line_rows(1, 120)
    rows += [rows[5], rows[5], (5, "another text of five\na common line 1\nnobody else has this")]  # one doc_id, several rows
    rows += [(None, "a common line 2\nonly without an id\nonly without an id"), (None, "only without an id\na common line 3")]
    found = line_dedup.deduplicated(texts(spark, rows))
    assert result(found) == deduped(rows)
    assert set(found.columns) == set(DOCS.replace(",", "").split()[::2]) | {"n_dropped", "kept_text"}


def test_lines_of_nothing(spark):
    assert line_dedup.deduplicated(texts(spark, [])).collect() == []


def test_insertions_and_deletions_are_reversible(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_ROWS", 20)  # shards are planned anew at the second insertion
    one, two = line_rows(2, 60), [(i + 1000, t) for i, t in line_rows(3, 60)]
    three = [(i, "a new text\n" + (t or "")) for i, t in one[:10]]
    kind = line_dedup.empty_index(spark)
    first = line_dedup.insert(kind, texts(spark, one))
    both = line_dedup.insert(first, texts(spark, two))
    assert both.shard_bits > first.shard_bits
    assert result(line_dedup.without_repeats(texts(spark, one + two), both)) == deduped(one + two)

    def shared(index):
        return sorted(tuple(r) for r in index.shared.select("hi", "lo", "n_docs", "least").collect())

    def members(index):
        held = {r.shard: line_dedup.Cuckoo(r.table, r.rest) for r in index.filters.collect()}
        return {s: (int((c.table != 0).sum()), len(c.rest)) for s, c in held.items() if (c.table != 0).any()}

    ids = spark.createDataFrame([(i,) for i, _ in two], "doc_id long")
    back = line_dedup.delete(both, ids)
    plain = line_dedup.insert(line_dedup.Index((), None, None, kind.shared, both.shard_bits, 0), texts(spark, one))
    assert shared(back) == shared(first) and members(back) == members(plain)
    gone = line_dedup.delete(back, spark.createDataFrame([(i,) for i, _ in one[:10]], "doc_id long"))
    assert result(line_dedup.without_repeats(texts(spark, one[10:]), gone)) == deduped(one[10:])
    again = line_dedup.insert(gone, texts(spark, three))  # the deleted ids come back with other texts
    assert result(line_dedup.without_repeats(texts(spark, one[10:] + three), again)) == deduped(one[10:] + three)


def test_the_filter_alone():
    rng = np.random.default_rng(7)
    known = np.unique(line_dedup.classes(*rng.integers(-(1 << 63), 1 << 63, (2, 500_000))))
    cuckoo = line_dedup.Cuckoo()
    for k in range(0, len(known), 60_000):
        cuckoo.add(known[k : k + 60_000])
    cuckoo = line_dedup.Cuckoo(*cuckoo.state())
    assert cuckoo.has(known).all()  # 95 of 100 places are taken
    others = np.setdiff1d(line_dedup.classes(*rng.integers(-(1 << 63), 1 << 63, (2, 100_000))), known)
    assert not cuckoo.has(others).any()  # a class is known exactly; keys that share one are told apart by the table
    cuckoo.remove(known[::2])
    assert not cuckoo.has(known[::2]).any() and cuckoo.has(known[1::2]).all()
    crowd = np.unique(line_dedup.classes(np.full(4000, 5), np.arange(1, 4001)))
    small = line_dedup.Cuckoo()
    small.add(crowd)  # one bucket for all: what has no place is listed
    assert small.has(crowd).all()
    small.remove(crowd)
    assert not small.has(crowd).any() and not small.table.any() and not len(small.rest)
