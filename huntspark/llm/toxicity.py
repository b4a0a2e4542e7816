"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier."""

from __future__ import annotations

from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huntspark.plans.lineage_cut import cut

#: fixed values: words of abuse in the languages of common web text; voters that fire on none of the labelled texts are left out
LEXICON = (
    "idiot idiots moron morons stupid loser losers pathetic worthless scum trash disgusting clown dumb imbecile cretin jerk filth vermin "
    "garbage bastard bitch asshole slut whore retard pig freak coward shithead "
    "idiota idiotas estúpido estúpida imbécil basura escoria "
    "imbécile connard salope ordure débile crétin "
    "dummkopf trottel abschaum widerlich arschloch vollidiot"
).split()
PREFIXES = (4, 5, 6, 7)  # letters of a pattern voter: the beginning of a word
SAMPLE = 20_000  # labelled documents (expected) from which voters are mined and the models fitted, whatever the input
LEAST = 3  # labelled toxic documents a mined voter needs
VOTERS = 400  # voters kept
THRESHOLD = 0.7
SHARED = 0.5  # correlation given the label from which voters share a vote
SEED = 11


@dataclass
class Model:
    """Voters (pattern, whole word or prefix) and the linear classifier over what they see in a text."""

    voters: list[tuple[str, bool]]
    weights: np.ndarray
    bias: float
    accuracies: np.ndarray = field(default_factory=lambda: np.empty(0))  # of voters: log odds of a vote
    correlations: np.ndarray = field(default_factory=lambda: np.empty(0))  # of voters, given the label

    def automaton(self):
        found = ahocorasick.Automaton()
        by_text: dict[str, list[tuple[int, bool]]] = {}
        for k, (text, whole) in enumerate(self.voters):
            by_text.setdefault(text, []).append((k, whole))
        for text, own in by_text.items():
            found.add_word(text, (len(text), own))
        if self.voters:
            found.make_automaton()
        return found

    def score(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(votes @ self.weights + self.bias)))


def votes_of(texts: list[str | None], automaton, n_voters: int) -> np.ndarray:
    """Votes (0 or 1) of each voter on each whole text: its word, or a word that begins with it, occurs."""
    out = np.zeros((len(texts), n_voters), np.float32)
    if not n_voters:
        return out
    for row, text in zip(out, texts):
        low = (text or "").lower()
        for end, (size, own) in automaton.iter(low):
            start = end - size + 1
            if start and low[start - 1].isalpha():
                continue
            word = end + 1 == len(low) or not low[end + 1].isalpha()
            for k, whole in own:
                if word or not whole:
                    row[k] = 1
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """About ``size`` documents with a toxicity label whose fold may be learned from (crc32 of the id as text, mod 3, is not 1),
    drawn by a seeded number of the id: (text, toxic)."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    n = known.count()
    if n > size:
        known = known.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * size / n))
    return cut(docs.select("doc_id", "text").join(known, "doc_id").select("text", "toxic"))


def mine_voters(sample: DataFrame, least: int = LEAST, most: int = VOTERS) -> list[tuple[str, bool]]:
    """Lexicon voters and mined ones: words and beginnings of words that at least ``least`` toxic documents of ``sample`` have
    and that speak for toxicity by the lower end of their log odds. Counted in Spark; at most ``most`` come back. A
    voter is left out if a shorter beginning of it was kept with as few clean documents, for it would see less."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{3,})"), F.lit(1)))

    def starts(n: int):
        return F.transform(F.filter("w", lambda x: F.length(x) > n), lambda x: F.concat(F.substring(x, 1, n), F.lit("*")))

    terms = sample.select("toxic", words.alias("w")).select("toxic", F.explode(F.array_distinct(F.concat("w", *map(starts, PREFIXES)))).alias("term"))
    counts = terms.groupBy("term").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    sizes = sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    n_bad, n_good = float(sizes[0] or 0), float(sizes[1] or 0)
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n_good + 1))
    low = odds - 2 * F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    strong = (F.col("bad") >= least) & (F.col("good") * n_bad <= 0.02 * F.col("bad") * n_good)
    top = counts.where(strong).select("term", "bad", "good", low.alias("low")).orderBy(F.desc("low"), F.desc("bad"), "term").limit(most)
    kept: dict[str, int] = {}
    for r in sorted(top.collect(), key=lambda r: (len(r.term.rstrip("*")), r.term)):
        text = r.term.rstrip("*")
        if not any(text[:n] + "*" in kept and kept[text[:n] + "*"] <= r.good for n in range(1, len(text) + (not r.term.endswith("*")))):
            kept[r.term] = r.good
    known = sorted(set(LEXICON) - set(kept))
    return [(t.rstrip("*"), not t.endswith("*")) for t in [*sorted(kept), *known]]


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 20, anchor: float = 0.9):
    """Posterior labels of the rows, and each voter's log odds and the voters' correlations given the label.

    Generative model: a hidden label, and voters that fire with one rate on toxic and another on clean texts. A silent
    voter abstains; that all are silent is a pattern of its own. Expectation maximisation starts at the given labels,
    which are themselves a voter of accuracy ``anchor``: wrong ones are outvoted. Voters that agree beyond their rates
    share a vote: the log odds of a voter are divided by 1 plus its correlations above ``SHARED`` with others.
    """
    n, v = votes.shape
    post = np.where(labels > 0, anchor, 1 - anchor).astype(np.float64)
    odds, relation, silent = np.zeros(v), np.zeros((v, v)), votes.sum(axis=1) == 0
    for _ in range(rounds):
        prior = np.clip(post.mean(), 1e-4, 1 - 1e-4)
        p1 = (post @ votes + 0.1) / (post.sum() + 10)
        p0 = ((1 - post) @ votes + 0.02) / ((1 - post).sum() + 10)
        rest = (votes - np.outer(post, p1) - np.outer(1 - post, p0)).astype(np.float32)
        cov = rest.T @ rest / max(1, n)
        scale = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
        relation = cov / np.outer(scale, scale)
        np.fill_diagonal(relation, 0)
        share = 1 + np.where(relation > SHARED, relation, 0).sum(axis=1)
        odds = np.clip(np.log(p1) - np.log(p0), 0, 8) / share
        none = np.log((post @ silent + 0.1) / (post.sum() + 10)) - np.log(((1 - post) @ silent + 0.1) / ((1 - post).sum() + 10))
        belief = np.log(prior / (1 - prior)) + votes @ odds + silent * none
        belief += np.where(labels > 0, 1, -1) * np.log(anchor / (1 - anchor))
        new = 1 / (1 + np.exp(-np.clip(belief, -30, 30)))
        if np.abs(new - post).max() < 1e-4:
            break
        post = new
    return post, odds, relation


def fit_linear(votes: np.ndarray, post: np.ndarray, rounds: int = 30, ridge: float = 0.02):
    """Logistic regression on posterior labels by Newton steps; (weights, bias). Weights are not below 0: a voter never speaks
    for clean text. ``ridge`` keeps the weight of a voter that is always right finite."""
    n, v = votes.shape
    x = np.concatenate([votes, np.ones((n, 1), votes.dtype)], axis=1).astype(np.float64)
    w, keep = np.zeros(v + 1), np.append(np.full(v, ridge), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - post) + keep * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 4 / (np.abs(step).max() + 1e-9))
        w[:v] = np.clip(w[:v], 0, 12)
        if np.abs(step).max() < 1e-4:
            break
    return w[:v], w[v]


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    """The model learned from a bounded sample of labelled rows. Without toxic labels the lexicon votes alone."""
    sample = labelled_sample(docs, labels, size)
    voters = mine_voters(sample)
    probe = Model(voters, np.zeros(len(voters)), 0.0)

    def run(batches):
        automaton = probe.automaton()
        for pdf in batches:
            votes = votes_of(pdf.text.tolist(), automaton, len(voters))
            yield pd.DataFrame({"toxic": pdf.toxic, "fired": [np.flatnonzero(v).tolist() for v in votes]})

    rows = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInPandas(run, "toxic int, fired array<int>").collect()
    rows.sort(key=lambda r: (r.toxic, r.fired))
    votes = np.zeros((len(rows), len(voters)), np.float32)
    for k, r in enumerate(rows):
        votes[k, r.fired] = 1
    toxic = np.array([r.toxic for r in rows], np.int64)
    if not toxic.any():
        return Model(voters, np.full(len(voters), 6.0), -3.0)
    post, odds, relation = label_model(votes, toxic)
    weights, bias = fit_linear(votes, post)
    # a lexicon voter that no labelled text has weighs what the others do
    unseen = votes.sum(axis=0) == 0
    weights[unseen] = np.median(weights[weights > 0]) if (weights > 0).any() else 6.0
    return Model(voters, weights, float(bias), odds, relation)


def scored(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with a score (0 to 1) in column ``out``, which takes the place of one of that name. Only the text is read, whole; null and
    empty texts get the score of a text without votes, repeated rows the same score. An empty table has no rows."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if getattr(shipped, "automaton", None) is None:
            shipped.automaton = shipped.value.automaton()
        held = texts.tolist()
        parts = [
            shipped.value.score(votes_of(held[k : k + 1000], shipped.automaton, len(shipped.value.voters)).astype(np.float64))
            for k in range(0, len(held), 1000)
        ]
        return pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return docs.withColumn(out, score(F.col("text")))


def judged(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; held_out: crc32 of the id as text, mod 3, is 1."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
