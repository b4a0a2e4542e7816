"""Token counts of a unigram model: distinct pre-tokens in a trie, forward scores computed once per shared prefix."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NODES = 300_000  # trie nodes a task holds; then it starts a new trie, with the same counts
SPACE = "▁"  # stands before every pre-token, as in the vocabulary
PART = 1000  # documents whose pre-tokens are inserted together


def piece_scores(path: str) -> dict[str, float]:
    """Log probabilities for the pieces of a SentencePiece file whose scores are ranks: Zipf-Mandelbrot over the rank.
    Control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    ranks = {model.id_to_piece(i): -model.get_score(i) for i in ids}
    norm = math.log(sum(1 / (r + 2.7) for r in ranks.values()))
    return {p: -math.log(r + 2.7) - norm for p, r in ranks.items()}


class Trie:
    """Pre-tokens as paths of characters. A node holds what the forward pass knows at its prefix: the best score of a
    segmentation and the number of its tokens (the fewest at equal score). A node needs its ancestors' scores only, so a
    prefix is computed once however many pre-tokens share it.

    A character outside the vocabulary may stand alone, as one token for each of its UTF-8 bytes, at ``unknown`` each.
    """

    def __init__(self, scores: dict[str, float]):
        self.scores, self.longest = scores, max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - 10
        self.child: dict[tuple[int, str], int] = {}
        self.score, self.count = [0.0], [0]

    def insert(self, word: str) -> int:
        """The token count of ``word``."""
        child, score, count, scores = self.child, self.score, self.count, self.scores
        path = [0]
        for depth, c in enumerate(word, 1):
            node = child.get((path[-1], c))
            if node is None:
                best, tokens = -math.inf, 0
                for start in range(max(0, depth - self.longest), depth):
                    p = scores.get(word[start:depth])
                    if p is not None:
                        s, n = score[path[start]] + p, count[path[start]] + 1
                        if s > best or (s == best and n < tokens):
                            best, tokens = s, n
                if c not in scores:
                    size = len(c.encode("utf-8", "surrogatepass"))
                    s, n = score[path[-1]] + self.unknown * size, count[path[-1]] + size
                    if s > best or (s == best and n < tokens):
                        best, tokens = s, n
                node = child[(path[-1], c)] = len(score)
                score.append(best)
                count.append(tokens)
            path.append(node)
        return count[path[-1]]


class Counter:
    """Counts of texts; the terminal counts of the trie's pre-tokens are kept beside it, and both start anew at ``nodes``."""

    def __init__(self, scores: dict[str, float], nodes: int = NODES):
        self.scores, self.nodes = scores, nodes
        self.trie, self.known = Trie(scores), {}

    def count(self, texts: list[str | None]) -> list[int]:
        words = [(t or "").split() for t in texts]
        for w in sorted(set().union(*words)):
            if w not in self.known:
                self.known[w] = self.trie.insert(SPACE + w)
        out = [sum(map(self.known.__getitem__, w)) for w in words]
        if len(self.trie.score) > self.nodes:
            self.trie, self.known = Trie(self.scores), {}
        return out


def token_counts(docs: DataFrame, scores: dict[str, float], nodes: int = NODES) -> DataFrame:
    """``docs`` with n_words and n_tokens of the whole text; 0 for null, empty and blank texts. Columns of these names give way;
    repeated rows stay, and an empty table has no rows.

    Pre-tokens are the runs between white space. Nothing is shuffled: each task builds the trie of what it reads, and its
    size is bounded; ``scores`` is a fixed vocabulary. A text's words are held while it is counted.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(scores)

    @F.pandas_udf("n_words long, n_tokens long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = Counter(shipped.value, nodes)
        for texts in parts:
            held = texts.tolist()
            sizes = [len((t or "").split()) for t in held]
            tokens = [n for k in range(0, len(held), PART) for n in counter.count(held[k : k + PART])]
            yield pd.DataFrame({"n_words": sizes, "n_tokens": tokens})

    return docs.withColumn("__counts", count(F.col("text"))).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "n_tokens")], "__counts.n_words", "__counts.n_tokens"
    )
