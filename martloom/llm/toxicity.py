"""Toxicity by weak supervision.

Many voters (lexicons mined from a bounded sample of labelled rows, a seed
lexicon, patterns in which insults are used) vote on every document. A generative label model
estimates each voter's accuracy from how voters agree over all documents,
finds the pairs that agree more than a common cause explains, and discounts
them. Its posterior labels train a linear classifier over word features, on
the labelled sample and on a bounded sample of all documents.

Where the table is too small to estimate a voter, because it hardly fires or
has no two others to form a triplet with, the voter keeps a prior log-odds; and the
classifier starts from a prior weight for the seed lexicon, which words of it
that no training row holds keep. Few labels thus leave a seed classifier.

A document's features are hashed distinct words and word prefixes; ids,
languages, sources and labels never enter a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_CLASS = 5_000   # labelled rows of each class the lexicons and the classifier are fitted on, at most
UNLABELLED = 5_000         # documents of any kind the classifier is fitted on besides, about
LEXICONS = 12
LEXICON_TERMS = 1_200      # terms of all lexicons together, the surest ones: a parameter of the label model
LEAST_ROWS = 5
LEAST_ODDS = 1.5           # lower bound of a lexicon term's log-odds
SELECTED_ODDS = 0.5        # and of a classifier feature's, in absolute value
BOUND = 2.0                # standard errors below the estimate
FOLDS = 5
PREFIX = 4
CACHED_WORDS = 150_000
CORRELATED = 0.15
STEPS = 80
PRIOR_ODDS = 2.0           # log-odds of a voter that fires and could not be estimated
SEED_WEIGHT = 2.0          # the classifier's weight of a seed word before it sees a row
# A seed lexicon of insults.
SEED = ("idiot", "moron", "stupid", "scum", "loser", "trash", "pathetic", "worthless", "disgusting", "clown",
        "dumb", "imbecile", "vermin", "filth", "bastard")
EDGE = ".,;:!?\"'()[]{}<>*_-…«»“”‘’¡¿"
INSULT = re.compile(r"\b(" + "|".join(SEED) + r")\b(\W?)", re.I)
PATTERNS = ("repeated", "varied", "stressed", "dense")
DENSE = 100                # characters of text to an insult, at most, in a dense text


def feature(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass"))


def word_features(raw: str) -> tuple[int, ...]:
    """Features of a raw word: the word without its edges, and its prefix."""
    word = raw.strip(EDGE)
    if not word:
        return ()
    return (feature("w" + word),) if len(word) <= PREFIX else (feature("w" + word), feature("p" + word[:PREFIX]))


SEED_FEATURES = frozenset(feature("w" + w) for w in SEED)


class Vocabulary(dict):
    """Raw word -> places of its features among the chosen ones (all features if none are chosen)."""

    def __init__(self, chosen: np.ndarray | None = None) -> None:
        super().__init__()
        self.place = None if chosen is None else {int(f): i for i, f in enumerate(chosen)}

    def __missing__(self, raw: str) -> tuple[int, ...]:
        if len(self) > CACHED_WORDS:
            self.clear()
        ids = word_features(raw)
        if self.place is not None:
            ids = tuple(self.place[i] for i in ids if i in self.place)
        self[raw] = ids
        return ids

    def of(self, text: str | None) -> np.ndarray:
        """Distinct features of a whole text, ascending."""
        found = {i for ids in map(self.__getitem__, set((text or "").lower().split())) for i in ids}
        return np.array(sorted(found), np.int64)


def votes_of(places: np.ndarray, patterns: list[bool], voter_of: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """True where a voter fires: lexicons first, then the seed lexicon, then patterns."""
    fired = np.zeros(LEXICONS + 1 + len(PATTERNS), bool)
    hits = voter_of[places]
    fired[hits[hits >= 0]] = True
    fired[LEXICONS] = bool(seeds[places].any())
    fired[LEXICONS + 1 :] = patterns
    return fired


def patterns_of(text: str | None) -> list[bool]:
    """Whether a seed insult is repeated, several are used, one ends a clause, and they come densely."""
    found = [(m[0].lower(), m[1]) for m in INSULT.findall(text or "")]
    words = {w for w, _ in found}
    return [len(words) < len(found), len(words) > 1, any(after in set(".!?,;") for _, after in found),
            bool(found) and len(text) <= DENSE * len(found)]


@dataclass(frozen=True)
class LabelModel:
    """Naive Bayes over voters with the weights of correlated voters discounted."""

    prior: float
    fires: np.ndarray      # log-odds of a voter that fires
    silent: np.ndarray     # log-odds of a voter that does not
    accuracies: np.ndarray
    correlated: list[tuple[int, int]]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        z = np.log(self.prior / (1 - self.prior)) + np.where(votes, self.fires, self.silent).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_label_model(n: float, fired: np.ndarray, together: np.ndarray, prior: float) -> LabelModel:
    """Accuracies and correlations from how often voters fire, alone and in pairs.

    Voters that are independent given the class have a covariance of rank one
    off the diagonal, ``prior (1 - prior) d_i d_j`` with d the difference of a
    voter's firing rates between the classes. d comes from triplets of voters;
    pairs whose residual correlation is high are taken as correlated, left out
    of a least-squares fit that refines d, and their voters' weights divided
    by one plus the sum of those correlations. A voter that fires on fewer than
    ``LEAST_ROWS`` rows, or has no triplet, has ``PRIOR_ODDS`` when it fires.
    """
    m = len(fired)
    mean = fired / max(n, 1)
    cov = together / max(n, 1) - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    live = (mean * n >= LEAST_ROWS) & (mean < 1)
    scale = prior * (1 - prior)
    use = np.outer(live, live) & ~np.eye(m, dtype=bool)

    def residual(d: np.ndarray) -> np.ndarray:
        off = (cov - scale * np.outer(d, d)) / np.outer(spread, spread)
        return np.where(np.outer(live, live) & ~np.eye(m, dtype=bool), off, 0.0)

    # scale * d_i^2 = cov_ij cov_ik / cov_jk for any two others; the median withstands correlated pairs
    d, estimated = np.zeros(m), np.zeros(m, bool)
    for i in np.flatnonzero(live):
        j, k = np.meshgrid(*[np.setdiff1d(np.flatnonzero(live), i)] * 2)
        ok = (j < k) & (cov[j, k] > 1e-12)
        squares = cov[i, j[ok]] * cov[i, k[ok]] / cov[j[ok], k[ok]] / scale
        d[i] = np.sqrt(max(np.median(squares), 0.0)) if len(squares) else 0.0
        estimated[i] = len(squares) > 0
    use = use & (np.abs(residual(d)) < CORRELATED)
    for _ in range(200):
        top, base = np.where(use, cov, 0.0) @ d, scale * (use @ (d * d))
        fresh = np.where(base > 1e-15, np.maximum(top / np.maximum(base, 1e-15), 0), d)
        if np.allclose(fresh, d, atol=1e-9):
            break
        d = 0.5 * (d + fresh)
    corr = residual(d)
    given1 = np.clip(mean + (1 - prior) * d, 1e-4, 1 - 1e-4)
    given0 = np.clip(mean - prior * d, 1e-4, 1 - 1e-4)
    strong = np.where(np.abs(corr) >= CORRELATED, np.abs(corr), 0.0)
    discount = 1 / (1 + strong.sum(axis=1))
    fires = np.where(estimated, np.log(given1 / given0), PRIOR_ODDS) * discount
    silent = np.where(estimated, np.log((1 - given1) / (1 - given0)), 0.0) * discount
    pairs = [(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(strong)), strict=True)]
    return LabelModel(prior, fires, silent, prior * given1 + (1 - prior) * (1 - given0), pairs)


def fit_linear(rows: list[np.ndarray], targets: np.ndarray, importance: np.ndarray,
               start: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels; rows hold the places of their features.

    Weights begin at ``start`` and are drawn back to it.
    """
    size = len(start)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    w, m1, m2 = np.append(start, 0.0), np.zeros(size + 1), np.zeros(size + 1)  # the bias is last
    importance = importance / max(importance.sum(), 1e-12)
    for step in range(1, STEPS + 1):
        z = np.bincount(at, weights=w[ids], minlength=len(rows)) + w[-1]
        off = importance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - targets)
        g = np.append(np.bincount(ids, weights=off[at], minlength=size) + 1e-6 * (w[:-1] - start), off.sum())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        w -= 0.1 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-9)
    return w[:-1], float(w[-1])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; ids that are NULL are among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % F.lit(FOLDS) == 0, F.lit(True))


@dataclass(frozen=True)
class ToxicityModel:
    features: np.ndarray
    weights: np.ndarray
    bias: float
    labels: LabelModel


def fit(docs: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS,
        unlabelled: int = UNLABELLED) -> ToxicityModel:
    """Fit on ``docs`` (``doc_id, text``) and ``labels`` (``doc_id, toxic``).

    Labels are read from rows outside the held-out fold only. Lexicons and the
    classifier see at most ``sample_per_class`` labelled rows of each class,
    taken in hash order, equal feature sets once; the classifier also sees about
    ``unlabelled`` documents of any kind, drawn by a hash of id and text, with
    the label model's posteriors. The prior and the label model's statistics
    cover all rows. Without labels of a class, the seed lexicon alone makes the
    score. NULL ids are never labelled; NULL texts hold no word; texts are read
    whole; of an id labelled both ways the label is 1; ties in hash order go to
    the smaller id.
    """
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out(F.col("doc_id"))).groupBy(
        "doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {int(r[0]): int(r[1]) for r in known.groupBy("toxic").count().collect()}
    parts = [known.filter(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_per_class)
             for value in (0, 1)]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.record_batch([batch.column("toxic"), pa.array([words.of(t) for t in texts], pa.list_(pa.int64())),
                                   pa.array(map(patterns_of, texts), pa.list_(pa.bool_()))],
                                  names=["toxic", "features", "patterns"])

    # at most 2 * sample_per_class rows of (id, label): a bound set by a parameter
    rows = docs.select("doc_id", "text").join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id").select(
        "toxic", "text").mapInArrow(extract, "toxic int, features array<long>, patterns array<boolean>").toArrow()
    sample = {}
    for y, f, p in zip(rows["toxic"].to_pylist(), rows["features"].to_pylist(), rows["patterns"].to_pylist(), strict=True):
        sample[tuple(f)] = max(sample.get(tuple(f), (0, p)), (y, p))
    features = [np.array(f, np.int64) for f in sorted(sample)]
    truth = np.array([sample[f][0] for f in sorted(sample)], float)
    patterns = [sample[f][1] for f in sorted(sample)]
    total = sum(counts.values())
    prior = float(np.clip(counts.get(1, 0) / total, 0.001, 0.999)) if total else 0.1

    space = np.unique(np.concatenate([np.array(sorted(SEED_FEATURES), np.int64), *features]))
    seen = [np.bincount(np.searchsorted(space, np.concatenate([np.zeros(0, np.int64), *(
        f for f, y in zip(features, truth, strict=True) if y == value)])), minlength=len(space)) for value in (0, 1)]
    n0, n1 = float((truth == 0).sum()), float((truth == 1).sum())
    odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
    surely = np.abs(odds) - BOUND * np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))
    seed = np.isin(space, sorted(SEED_FEATURES))
    chosen = np.flatnonzero(seed | (surely >= SELECTED_ODDS) & (seen[0] + seen[1] >= LEAST_ROWS) & (n0 > 0) & (n1 > 0))
    space, odds, surely, seed = space[chosen], odds[chosen], surely[chosen], seed[chosen]
    voter_of = np.full(len(space), -1, np.int16)
    strong = np.flatnonzero((odds > 0) & (surely >= LEAST_ODDS))
    strong = strong[np.lexsort((strong, -surely[strong]))][:LEXICON_TERMS]
    voter_of[strong] = np.arange(len(strong)) % LEXICONS
    voters = LEXICONS + 1 + len(PATTERNS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, both = Vocabulary(space), np.zeros((voters + 1, voters + 1), np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                fired = np.append(votes_of(words.of(text), patterns_of(text), voter_of, seed), True)
                at = np.flatnonzero(fired)
                both[np.ix_(at, at)] += 1
        i, j = np.nonzero(both)
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(both[i, j])], names=["i", "j", "n"])

    both = np.zeros((voters + 1, voters + 1))
    for i, j, n in docs.select("text").mapInArrow(moments, "i long, j long, n long").groupBy("i", "j").agg(
            F.sum("n")).collect():  # one row per pair of voters
        both[i, j] = n
    model = fit_label_model(both[-1, -1], np.diag(both)[:-1], both[:-1, :-1], prior)

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(space)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.record_batch([pa.array([words.of(t) for t in texts], pa.list_(pa.int64())),
                                   pa.array(map(patterns_of, texts), pa.list_(pa.bool_()))], names=["places", "patterns"])

    places = [np.searchsorted(space, f[np.isin(f, space)]) for f in features]
    if n0 and n1:
        importance = np.where(truth == 1, prior / n1, (1 - prior) / n0)
        share = int(min(1.0, unlabelled / max(both[-1, -1], 1)) * (1 << 20))
        more = docs.select("text").filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share).mapInArrow(
            drawn, "places array<long>, patterns array<boolean>").groupBy("places", "patterns").count().toArrow().sort_by("count")
        places += [np.array(p, np.int64) for p in more["places"].to_pylist()]
        patterns += more["patterns"].to_pylist()
        n = more["count"].to_numpy()
        importance = np.concatenate([importance, n / max(n.sum(), 1)])
        votes = np.array([votes_of(f, p, voter_of, seed) for f, p in zip(places, patterns, strict=True)], bool)
        weights, bias = fit_linear(places, model.posterior(votes), importance, np.where(seed, SEED_WEIGHT, 0.0))
    else:
        weights, bias = np.where(seed, 3.0, 0.0), -2.0
    return ToxicityModel(space, weights, bias, model)


def predict(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) appended.

    Columns of ``docs`` pass through; clashing ``score`` or ``predicted``
    columns are replaced. NULL and empty texts get the classifier's score of
    no word at all; texts are scored whole, repeated words once; repeated rows
    get equal scores; a score of exactly 0.5 is predicted 1. An empty table
    gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        space, weights, bias = sent.value
        words = Vocabulary(space)
        for texts in batches:
            z = [bias + weights[words.of(t if isinstance(t, str) else None)].sum() for t in texts]
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(z, float), -30, 30))))

    kept = docs.drop("score", "predicted").withColumn("score", score(F.col("text")))
    return kept.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
