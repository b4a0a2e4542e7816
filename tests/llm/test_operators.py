"""Odd cases and brute-force checks of the training-data operators."""

from __future__ import annotations

import math
import random
import re
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash

from huntspark.llm import embeddings, leaks, mixing, simhash, style_tree, token_counts, token_shards, toxicity, url_rules
from huntspark.llm.chat import perspectives
from huntspark.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"
BPE = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark, rows):
    """(doc_id, text, source) with a column whose name clashes with an operator's."""
    return spark.createDataFrame([(i, t, None, s, None, 0.5) for i, t, s in rows], DOCS)


ODD = [
    (3, None, None), (1, "", "a"), (1, "", "a"), (None, "x y z", "b"), (5, " \t\n", "b"), (7, "a  b   c\n\n d", "b"),
    (8, "word " * 30_000, "c"), (9, "<|endoftext|> It's naïve, ÀÉ 日本", "c"), (2, "--- --- ---", None),
]


def whole_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def test_words_give_the_ids_of_whole_texts():
    """Random texts of spaces, line ends, marks and special tokens, with a cache that turns over all the time."""
    rng, tool = random.Random(9), whole_tokenizer()
    parts = ["word", "Word.", "a,", "été", "ÀÉ", "12", "it's", "_x", "日本", "<|endoftext|>", "ĉ", "\t", " ", "  ", "\n", "\n\n", "\r\n", " \n", "\n ", "...", "x\u0301", "\u00a0", "Ġ", "Ċ", "ab" * 40]
    parts += [" \u00a0 \u00a0", "\t \t", "\u3000 ", "²", "½", "a×b", "ɏɐ", "'", "'ll", "a1!b", "--|", "[x]", "`~_", "\x00", "\x7f"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    texts += [" ".join(rng.choice(["lorem", "Ipsum,", "été.", "x"]) + rng.choice(["", "", "\nNew", ".\nLine"]) for _ in range(30)) for _ in range(200)]
    for limit in (0, 50, 1_000_000):
        encoder = token_shards.Encoder(BPE, limit)
        for k in range(0, len(texts), 400):
            for text, ids in zip(texts[k : k + 400], encoder.encode(texts[k : k + 400])):
                assert ids.tolist() == tool.encode(text, add_special_tokens=False).ids, text


def test_words_are_known_without_the_signs_after_them():
    """A word before twenty different signs is one word, encoded once; 20 of 21 were encoded again before."""
    tool, words = token_shards.Encoder(BPE), [a + b + c for a in "bdfgklmn" for b in "aeiou" for c in "lmnrst"]
    texts = [" ".join(w + sign for w in words) for sign in "!#$%&()*+,-./:;<=>?"] + ["\n".join(words)]
    whole = whole_tokenizer()
    for text, ids in zip(texts, tool.encode(texts)):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(tool.words) <= 2 * len(words) + 21


ENCODE = """
import random, re, sys
from huntspark.llm import token_shards

def held():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024

rng = random.Random(4)
words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(20_000)]
tool, before = token_shards.Encoder(sys.argv[1]), held()
for _ in range(4):
    tool.encode([" ".join(rng.choices(words, k=700)) for _ in range(3000)])
print(held() - before)
"""


@pytest.mark.skipif(not Path("/proc/self/status").exists(), reason="reads memory from /proc")
def test_encoder_gives_back_what_it_took():
    """After lots of 12 MB a process has grown by its known words and little else: 18 MB, and 92 where freed memory is kept."""
    found = subprocess.run([sys.executable, "-c", ENCODE, BPE], cwd=Path(__file__).parents[2], capture_output=True, text=True, check=True)
    assert int(found.stdout) < 50


def test_components_of_chain_and_star(spark):
    chain = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(8, 60)] + [(3, 3)]
    found = dict(components(spark.createDataFrame(random.Random(1).sample(chain, len(chain)), "a long, b long")).collect())
    assert found == {k: 100 for k in range(100, 141)} | {k: 7 for k in range(7, 60)}


def test_token_shards_round_trip(spark, tmp_path):
    path, tool = str(tmp_path / "shards"), whole_tokenizer()
    token_shards.write_shards(documents(spark, ODD), path, BPE, shard_tokens=50)
    got = sorted(token_shards.read_documents(spark, path, 50257).collect(), key=lambda r: r.start)
    want = [(i, tool.encode(t or "", add_special_tokens=False).ids + [2]) for i, t, _ in ODD]
    start = 0
    assert [r.doc_id for r in got] == sorted((i for i, _ in want), key=lambda i: -1 if i is None else i)
    assert sorted(zlib.crc32(np.array(ids, "<u4").tobytes()) for _, ids in want) == sorted(r.ids_crc32 for r in got)
    for r in got:
        assert (r.doc_id, r.n_tokens) in [(i, len(ids)) for i, ids in want] and r.start == start
        start += r.n_tokens
    shards = [r.asDict() for r in spark.read.parquet(path).collect()]
    for shard in shards:
        for k, i in enumerate(shard["doc_ids"]):
            if i in (7, 8, 9):
                ids = dict(want)[i]
                for at in {0, len(ids) // 2, len(ids) - 1}:
                    assert token_shards.id_at(shard, k, at, 50257) == ids[at]


def test_token_shards_of_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    token_shards.write_shards(documents(spark, []), path, BPE)
    assert token_shards.read_documents(spark, path, 50257).collect() == []


@pytest.mark.parametrize("n,kinds", [(0, 3), (1, 3), (4000, 2), (20_000, 40), (3000, 1)])
def test_repair_expands_to_its_input(n, kinds):
    random_ = np.random.default_rng(n + kinds)
    symbols = np.where(random_.random(n) < 0.01, 50, random_.integers(0, kinds, n)).astype(np.uint32)
    rules, short = token_shards.repair(symbols, 50)
    assert (token_shards.expand(short, rules, 50, 7) == np.where(symbols == 50, 7, symbols)).all()
    sizes = token_shards.expansion_lengths(rules, 50)
    assert [len(token_shards.expand(np.array([51 + k], np.uint32), rules, 50)) for k in range(len(rules))] == sizes.tolist()
    pairs = list(zip(short[:-1].tolist(), short[1:].tolist()))
    assert all(pairs.count(p) < 2 * token_shards.LEAST for p in set(pairs) if 50 not in p)


def test_repair_leaves_out_pairs_that_are_rare(monkeypatch):
    """Rounds sort 1.3 pairs for each symbol; where only the symbols of a pair had to be frequent beside others it was 2.2."""
    random_, sort, seen = np.random.default_rng(8), np.sort, []
    phrases = random_.integers(0, 2000, (2000, 3))
    parts = [np.append(phrases[k], random_.integers(0, 2000, 15)) for k in random_.integers(0, 2000, 30_000)]
    symbols = np.concatenate(parts).astype(np.uint32)
    monkeypatch.setattr(np, "sort", lambda a, *args, **kw: seen.append(len(a)) or sort(a, *args, **kw))
    rules, short = token_shards.repair(symbols, 2000)
    assert (token_shards.expand(short, rules, 2000) == symbols).all()
    assert sum(seen) < 1.7 * len(symbols)


@pytest.mark.parametrize("kind,bits", [(np.uint32, 16), (np.uint64, 32)])
def test_find_is_exact_where_pairs_share_a_slot(kind, bits, monkeypatch):
    monkeypatch.setattr(token_shards, "SLOTS", 5)
    random_ = np.random.default_rng(bits)
    pairs = (random_.integers(0, 40, 5000).astype(kind) << kind(bits)) | random_.integers(0, 40, 5000).astype(kind)
    frequent = np.unique(pairs)[::7]
    chosen = frequent[::3]
    rare, at, rule = token_shards.find(frequent, chosen, pairs)
    assert at.tolist() == np.flatnonzero(np.isin(pairs, chosen)).tolist()
    assert (chosen[rule] == pairs[at]).all()
    assert not np.isin(pairs[rare], frequent).any()


def test_fill_is_as_near_as_any_choice():
    random_ = random.Random(5)
    cases = [{random_.randint(0, 40): random_.randint(1, 6) for _ in range(6)} for _ in range(200)]
    cases += [{random_.randint(500, 3000): 1 for _ in range(7)} for _ in range(50)]
    for n, counts in enumerate(cases):
        total = sum(n * k for n, k in counts.items())
        budget = random_.randint(0, min(total, 8192))
        take = mixing.fill(counts, budget, seed=n)
        assert all(0 <= take[n] <= counts[n] for n in counts)
        reach = {0}
        for n, k in counts.items():
            reach = {r + n * j for r in reach for j in range(k + 1)}
        assert abs(sum(n * k for n, k in take.items()) - budget) == min(abs(r - budget) for r in reach)
    assert mixing.fill({6000: 1, 5001: 1, 4999: 1}, 10_000) == {6000: 0, 5001: 1, 4999: 1}
    assert mixing.fill({3: 10**9, 7: 5}, 10**9 + 1)[3] > 0 and mixing.fill({}, 5) == {} and mixing.fill({0: 3}, 0) == {0: 0}


def test_fill_spreads_over_all_lengths():
    """Thousands of documents of different lengths: the target is met, long and short ones are taken alike, the seed decides which."""
    random_ = random.Random(8)
    counts = {n: 1 for n in random_.sample(range(50, 20_000), 2400)}
    total = sum(counts)
    budget = total // 3
    one, two = (mixing.fill(counts, budget, seed=s) for s in (1, 2))
    for take in (one, two):
        assert abs(sum(n * k for n, k in take.items()) - budget) <= 1
        for lo in range(0, 20_000, 4000):
            part = [take[n] for n in counts if lo <= n < lo + 4000]
            assert 0.25 < sum(part) / len(part) < 0.42
    assert sum(one[n] != two[n] for n in counts) > 300


def test_mix_odd_cases(spark):
    rows = documents(spark, [*ODD, *[(100 + k, "w " * (k % 9 + 1), "abc"[k % 3]) for k in range(300)]])
    got = mixing.taken_words(rows).collect()
    assert len(got) == len(ODD) + 300 and sorted(map(repr, got)) == sorted(map(repr, mixing.taken_words(rows).collect()))
    sizes, by = {}, {}
    for r in got:
        assert r.taken % r["size"] == 0 if r["size"] else r.taken == 0
        assert r.taken <= 3 * r["size"]
        by[(r.source_size, r.target)] = by.get((r.source_size, r.target), 0) + r.taken
    total = sum(r["size"] for r in got)
    assert math.isclose(sum(t for _, t in by), total) and all(t <= 3 * s + 1e-6 for s, t in by)
    assert all(abs(v - t) <= 2 for (s, t), v in by.items() if s < 10_000), by
    out = mixing.mixed(rows)
    assert out.columns == rows.columns
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in out.collect())
    assert words == sum(r.taken for r in got)
    assert mixing.taken_words(documents(spark, [])).collect() == []
    assert {r.target for r in mixing.taken_words(documents(spark, [(1, None, "a"), (2, " ", None)])).collect()} == {0.0}


def test_token_counts_against_all_segmentations(spark):
    scores = {"▁": -3.0, "▁a": -1.0, "a": -2.0, "ab": -2.5, "b": -2.0, "▁ab": -4.0, "bb": -3.0}

    def best(word):
        if not word:
            return 0.0, 0
        options = []
        for k in range(1, len(word) + 1):
            tail = best(word[k:])
            if word[:k] in scores:
                options.append((tail[0] + scores[word[:k]], -(tail[1] + 1)))
            elif k == 1:
                n = len(word[0].encode())
                options.append((tail[0] + n * (min(scores.values()) - 10), -(tail[1] + n)))
        s, n = max((round(s, 9), n) for s, n in options)
        return s, -n

    texts = [None, "", "a abba  bb\nab", "é abé", "ab " * 3000, "ba"]
    rows = documents(spark, [(k, t, None) for k, t in enumerate(texts)])
    for nodes in (2, 10_000):
        got = {r.doc_id: (r.n_words, r.n_tokens) for r in token_counts.token_counts(rows, scores, nodes).collect()}
        assert got == {k: (len((t or "").split()), sum(best("▁" + w)[1] for w in (t or "").split())) for k, t in enumerate(texts)}


def test_fingerprint_against_plain_count():
    def plain(text, width):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        runs = [" ".join(words[k : k + width]) for k in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
        value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        return value - (1 << 64) if value >> 63 else value

    for text in (None, "", "  ", "One", "two words", "É a\x0bb c\x1fd E", "the cat sat " * 500, "a\u00a0b c d"):
        for width in (3, 5):
            assert simhash.fingerprint(text, width) == plain(text, width)


@pytest.mark.parametrize("group", [4, 1000])
def test_trie_links_are_those_of_all_pairs(spark, group):
    random_ = random.Random(group)
    base = [random_.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    values = {b ^ sum({1 << random_.randrange(64) for _ in range(random_.randint(0, 4))}) for b in base for _ in range(8)}
    signed = [simhash._signed(v) for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = dict(components(simhash.near_links(frame, group)).collect())
    parent = {v: v for v in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in signed:
        for b in signed:
            if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {v: got.get(v, v) for v in signed} == {v: find(v) for v in signed}


def test_near_copies_odd_cases(spark):
    got = sorted((r.doc_id is None, r.doc_id, r.fp, r.component_id) for r in simhash.near_copies(documents(spark, ODD)).collect())
    assert len(got) == len(ODD)
    assert {(i, c) for _, i, fp, c in got if fp == 0 and i in (1, 3, 5)} == {(1, 1), (3, 1), (5, 1)}
    assert simhash.near_copies(documents(spark, [])).collect() == []


def test_perspectives(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 300, None, "?"), (None, None, "ann", "x"), (2, 0, "system", "only")]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, speaker string")
    got = {(r.conv_id, r.speaker, r.part): r for r in perspectives(turns).collect()}
    assert set(got) == {(1, "ann", 0), (1, "ann", 1), (1, "bob", 0), (1, "bob", 1), (None, "ann", -1)}
    ann, bob = got[1, "ann", 0], got[1, "bob", 0]
    assert ann.text == "<|system|>\ns<|end|>\n<|assistant|>\nhi<|end|>\n" + "<|user name=bob|>\n<|end|>\n" * 2
    assert [ann.text[s.start : s.end] for s in ann.spans] == ["hi<|end|>"] and len(bob.spans) == 2
    assert got[1, "ann", 1].text == "<|user name=unknown|>\n?<|end|>\n" and ann.n_masked == len(ann.text) - 9
    assert perspectives(turns.limit(0)).collect() == []


def test_toxicity_learns_and_scores(spark):
    random_ = random.Random(3)
    words = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]

    def text(bad):
        return " ".join(random_.choice(words) for _ in range(40)) + (f" blargh{random_.choice('abc')}" if bad else "")

    docs = [(k, text(k % 5 == 0), None) for k in range(900)] + [(2000, None, None), (2001, "", None), (2002, "BLARGHA! " + "x " * 50_000, None), (None, "blargha", None)]
    labels = spark.createDataFrame([(k, None, int(k % 5 == 0)) for k in range(900)] + [(5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    frame = documents(spark, docs)
    got = {r.doc_id: r for r in toxicity.judged(frame, toxicity.fit(frame, labels)).collect()}
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got.values())
    held = [k for k in range(900) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert all(got[k].held_out for k in held) and sum(got[k].predicted == (k % 5 == 0) for k in held) >= 0.98 * len(held)
    assert (got[2000].predicted, got[2001].predicted, got[2002].predicted, got[None].predicted) == (0, 0, 1, 1)
    none = toxicity.fit(documents(spark, []), labels.limit(0))
    assert [r.predicted for r in toxicity.judged(documents(spark, [(1, "you idiot", None), (2, "hello", None)]), none).collect()] == [1, 0]


def test_leaks_against_edit_distance(spark):
    random_ = random.Random(9)
    letters = "abcdefghij  "
    item = "".join(random_.choice(letters) for _ in range(200)).strip()

    def edited(n):
        chars = list(item)
        for _ in range(n):
            k = random_.randrange(len(chars))
            random_.choice([lambda: chars.insert(k, "z"), lambda: chars.pop(k), lambda: chars.__setitem__(k, "y")])()
        return "".join(chars)

    noise = "".join(random_.choice(letters) for _ in range(500))
    docs = [(k, f"{noise} {edited(k)} {noise}", None) for k in range(0, 13)] + [(50, None, None), (51, "", None), (52, noise * 2000 + item.upper().replace(" ", "\n \t"), None)]
    items = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "", 0), (4, "zzz", 0)], "item_id long, text string, doc_id long")
    got = {r.doc_id: r for r in leaks.find_leaks(documents(spark, docs), items).where("item_id = 1").collect()}
    assert {*range(0, 13), 52} == set(got) and all(got[k].edits <= k for k in range(13)) and got[0].edits == 0
    far = documents(spark, [(1, f"{noise} {edited(60)}", None), (2, noise, None)])
    assert leaks.find_leaks(far, items).where("item_id = 1").collect() == []
    assert [r.doc_id for r in leaks.without_leaks(documents(spark, docs), items.where("item_id = 1")).orderBy("doc_id").collect()] == [50, 51]
    assert leaks.find_leaks(documents(spark, docs), items.limit(0)).collect() == []
    short = leaks.find_leaks(documents(spark, [(1, "a ZZZ b", None)]), items).collect()
    assert [(r.doc_id, r.item_id, r.start, r.end) for r in short] == [(1, 4, 2, 5)]


def brute_links(rows, cosine=0.93):
    def fit(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    out = []
    for k, (_, v, label) in enumerate(rows):
        n = 0
        for j, (_, w, other) in enumerate(rows):
            if j != k and label is not None and label == other and fit(v) and fit(w) and len(v) == len(w):
                a, b = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                n += a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine
        out.append(n)
    return out


def test_embeddings_against_all_pairs(spark):
    random_ = np.random.default_rng(2)
    base = random_.normal(size=(12, 64))
    rows = [(int(k), (base[k % 12] + random_.normal(size=64) * 0.15).tolist(), int(k % 2)) for k in range(240)]
    rows += [(1000 + k, base[0].tolist(), 0) for k in range(5)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 64, 1), (2003, [math.nan] * 64, 1), (2004, base[1].tolist(), None), (2005, [None] * 64, 1), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1)]
    frame = spark.createDataFrame([(*r, 7) for r in rows], "vec_id long, embedding array<float>, label int, node int")
    for chunk in (1000, 7):
        got = {r.vec_id: r for r in embeddings.near_vectors(frame, chunk=chunk).collect()}
        assert len(got) == len(rows)
        found, want = [got[i].n_links for i, _, _ in rows], brute_links(rows)
        assert all(a <= b for a, b in zip(found, want)) and sum(found) >= 0.95 * sum(want)
        assert all((r.component_id, r.kept, r.n_links) == (i, True, 0) for i, r in got.items() if 2000 <= i <= 2005)
        assert got[2007].component_id == 2006
    assert embeddings.near_vectors(frame.limit(0)).collect() == []


def test_recall_of_hashing_at_the_threshold():
    random_ = np.random.default_rng(4)
    a = random_.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    off = random_.normal(size=a.shape)
    off -= (off * a).sum(axis=1, keepdims=True) * a
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * off
    x, y = embeddings.buckets(a), embeddings.buckets(b)
    assert (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3)).mean() >= 0.9


def page(body, tail="</body></html>"):
    return f"<!DOCTYPE html><html><head><title>t</title><script>var a='</p>';</script></head><body>{body}{tail}"


def test_main_text(spark):
    menu = "<nav><a href=/>Home</a></nav><div class='cookie-notice'>We use</div><div class=teaser>Same on all pages</div>"
    body = "<article><h1>A&amp;B {k}</h1><p><b>One\n  two<br>three<p>Four {k}<div class='comments'>reader</div></article><footer>f</footer>"
    rows = [(k, f"http://h.com/{k}", page(menu + body.replace("{k}", str(k)), "" if k % 2 else "</body></html>")) for k in range(30)]
    rows += [(100, None, None), (101, "x", ""), (102, "http://o.org/", "<p>a<p>b <!-- c --> &lt;d"), (103, "http://o.org/", page("<form>q</form><p>" + "long " * 40_000))]
    frame = spark.createDataFrame([(*r, "p") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in style_tree.main_text(frame).collect()}
    assert len(got) == len(rows)
    assert all(got[k].text == f"A&B {k}\nOne two three\nFour {k}" for k in range(30))
    assert (got[100].text, got[101].text, got[102].text) == ("", "", "a\nb <d") and got[103].n_chars == 5 * 40_000 - 1
    assert style_tree.main_text(frame.limit(0)).collect() == []


def test_main_text_where_class_words_mislead(spark):
    """Twelve pages of each kind: the article stays, whatever the names around it; the menu and the advert go."""
    text, menu = "<h1>T {k}</h1><p class=lead>Same lead</p><p>Own {k}</p>", "<div class=main-menu>Home</div><div class=ad>Buy</div>"
    kinds = [
        "<article class='post comments-open'>%s</article>", "<div id='main' class='has-sidebar'>%s</div>", "<main class='site-main nav-fixed'>%s</main>",
        "<form>Search<article>%s</article></form>", "<div class='layout-sidebar'><div class=site-header>S</div><article>%s</article></div>",
        "<div class='share page'><p>T {k}</p><p>Same lead</p><p>Own {k}</p></div>",
    ]
    rows = [(100 * n + k, f"http://h{n}.com/{k}", page(menu + (kind % text if "%s" in kind else kind).replace("{k}", str(k)))) for n, kind in enumerate(kinds) for k in range(12)]
    got = {r.page_id: r.text for r in style_tree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(len(kinds)):
        for k in range(12):
            assert got[100 * n + k] == ("Search\n" if n == 3 else "") + f"T {k}\nSame lead\nOwn {k}", n


def test_url_rules(spark):
    rows = [(1, "https://A.Example.COM/en/x?q#f"), (2, "http://www.example.com/en/"), (3, "x://b.NET/es/1"), (4, "http://com"), (5, None), (6, "no scheme"), (7, "s://é.net/FR/"), (7, "s://é.net/FR/"), (8, "http://notexample.com/en/")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, tokens string")
    mined = spark.createDataFrame([(["d:é.net", "p:FR"],)], "antecedent array<string>")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_rules.filter_urls(pages, mined).collect())
    assert got == [
        (1, "a.example.com", "/en/x", "example.com/en/", "block"), (2, "www.example.com", "/en/", "www.example.com/en/", "allow"),
        (3, "b.net", "/es/1", "net/es/", "block"), (4, "com", "", None, "allow"), (5, "", "", None, "allow"), (6, "", "", None, "allow"),
        (7, "é.net", "/FR/", None, "block"), (7, "é.net", "/FR/", None, "block"), (8, "notexample.com", "/en/", "com/", "allow"),
    ]


def low(hits, n, z=2.576):
    p = hits / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def test_mined_rules_against_counting(spark):
    from itertools import combinations

    random_ = random.Random(6)
    rows = []
    for _ in range(400):
        tokens = sorted({random_.choice("abcdefg") for _ in range(5)})
        rows.append((tokens, random_.random() < (0.95 if {"a", "b", "c"} <= set(tokens) or {"d", "g"} <= set(tokens) else 0.3)))
    rows += [([], True), (["a"], None), (None, True), (["x", "y"], True)] + [(list("pqrst"), True)] * 7 + [(["p"], False)] * 30
    frame = spark.createDataFrame(rows, "tokens array<string>, blocked boolean")
    known = [(set(t), b) for t, b in rows if t is not None and b is not None]
    base = sum(b for _, b in known) / len(known)
    good = set()
    for n in range(1, 8):
        for a in {x for t, b in known if b for x in combinations(sorted(t), n)}:
            hit = [b for t, b in known if set(a) <= t]
            if sum(hit) >= 5 and low(sum(hit), len(hit)) >= max(0.5, base):
                good.add(a)
    want = {a for a in good if not any(set(b) < set(a) for b in good)}
    got = {tuple(r.antecedent) for r in url_rules.mine_block_rules(frame).collect()}
    assert got == want and ("q",) in got and any(len(a) > 1 for a in got)
    assert url_rules.mine_block_rules(frame.limit(0)).collect() == []


@pytest.mark.parametrize("size", [1000, 60_000])
def test_a_host_of_few_urls_is_a_rule_at_any_size(spark, size):
    """Eight blocked URLs of one host among a thousand or many labels of other hosts, of which one in ten is blocked."""
    urls = spark.range(size).selectExpr("id as page_id", "'http://www.site'||chr(97 + id % 17)||'.example.org/en/'||id as url", "id % 10 = 3 as blocked")
    bad = spark.range(9).selectExpr("id + 10000000 as page_id", "'http://planted.example.org/en/'||id||'.html' as url", "id < 8 as blocked")
    pages = urls.unionByName(bad)
    labelled = pages.where("page_id <> 10000008").select(url_rules.url_tokens(pages["url"]).alias("tokens"), "blocked")
    mined = url_rules.mine_block_rules(labelled)
    assert sorted(tuple(r.antecedent) for r in mined.collect()) == [("d:planted.example.org",), ("h:planted",), ("p:html",)]
    verdicts = url_rules.filter_urls(pages.select("page_id", "url"), mined).where("verdict = 'block'")
    assert sorted(r.page_id for r in verdicts.collect()) == list(range(10000000, 10000009))
