"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text: one on ordinary text,
one on the same with what is particular to toxic text in place of as much of the
ordinary. A window of the text - a word, between two copies of a carrier that
both dictionaries hold, so that its bytes alone decide - is compressed with
both, and the difference of the lengths is its gain. How many different windows of
a document reach which gain, in numbers and as shares, is calibrated to a
probability on labelled rows that the dictionaries were not trained on.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import whole_text

#: The labelled rows that are learned from, at most: those with the smallest hash of their id. Half trains, half calibrates.
TOXIC_ROWS, ORDINARY_ROWS = 4000, 8000
#: Longer labelled texts are not learned from: with the numbers above it bounds what comes to the driver.
LEARN_CHARS = 20_000
#: Bytes of the common part of both dictionaries, and of the part that differs.
COMMON, OWN = 16_384, 4_096
#: A word, or a beginning of so many letters, is particular to toxic text if so large a share of its documents holds it, and no ordinary one of the sample.
PARTICULAR, BEGINNINGS = 0.005, (4, 5, 6)
GAINS = (2, 3, 4, 5, 6, 8)
#: A feature that hardly varies in the labelled rows is not stretched beyond this.
SPREAD = 0.5
HELD_OUT = (3, 1)
THRESHOLD = 0.7
#: Longer words are cut; words whose gain a worker remembers.
WORD, REMEMBERED = 64, 700_000

WORDS = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    found = WORDS.findall(text.lower())
    if any(len(w) > WORD for w in found):
        found = [w[i:i + WORD] for w in found for i in range(0, len(w), WORD)]
    return found


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    carrier: bytes
    mean: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()


class Gains:
    """Bytes that the toxic dictionary saves on each word over the ordinary one."""

    def __init__(self, model: Model):
        self.known: dict[str, int] = {}
        self.carrier = model.carrier
        self.with_toxic, self.with_ordinary = self.compressor(model.toxic), self.compressor(model.ordinary)

    def compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        how = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_GREEDY, min_match=5, window_log=17, hash_log=17, chain_log=17, search_log=5,
            write_content_size=0, write_checksum=0, write_dict_id=0)
        dictionary = zstandard.ZstdCompressionDict(content + self.carrier, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=how)

    def of(self, words: list[str]) -> np.ndarray:
        known = self.known
        new = set(words).difference(known)
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = set(words)
        for word in new:
            window = b"%b %b %b" % (self.carrier, word.encode(), self.carrier)
            known[word] = len(self.with_ordinary.compress(window)) - len(self.with_toxic.compress(window))
        return np.array([known[w] for w in words], np.int64)

    def features(self, text: str) -> list[float]:
        words = sorted(set(words_of(text)))  # a word repeated all over says no more than the word
        gains = self.of(words)
        reached = [int((gains >= g).sum()) for g in GAINS]
        return [1.0, *np.log1p(reached), *(float(np.log1p(100 * n / (len(words) + 10))) for n in reached),
                float(gains.max(initial=0)), float(np.log1p(len(words)))]


@functools.lru_cache(maxsize=2)
def gains_of(model: Model) -> Gains:
    """One for each Python worker, which keeps what it has compressed for its next task."""
    return Gains(model)


def without_copies(texts: list[str]) -> list[set[str]]:
    """The word sets of texts but near copies of earlier ones, which would count as evidence: those that share four smallest hashes."""
    seen, kept = set(), []
    for text in texts:
        words = set(words_of(text))
        marks = {tuple([band, *(min(xxhash.xxh32_intdigest(w, 4 * band + k) for w in words) for k in range(4))]) for band in range(3)} if words else set()
        if words and not marks & seen:
            kept.append(words)
            seen |= marks
    return kept


def joined(words: list[str], size: int) -> bytes:
    """The most frequent words last, where a match is cheapest to name."""
    return (" " + " ".join(reversed(words)) + " ").encode()[-size:]


def units(words: set[str]) -> set[str]:
    """Words and their beginnings: one stem shows in many words of few documents each."""
    return words | {w[:n] for w in words for n in BEGINNINGS if len(w) > n}


def train(toxic: list[str], ordinary: list[str]) -> Model:
    common = Counter(w for text in ordinary for w in set(words_of(text)))
    sets = without_copies(toxic)
    known = units(set(common))
    own = Counter(u for words in sets for u in units(words) - known)
    rank = lambda counts: [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    particular = [w for w in rank(own) if own[w] >= max(3, PARTICULAR * len(sets))]
    frequent = rank(common)
    special = joined(particular, OWN)
    shared = joined(frequent, COMMON)
    return Model(shared + special, shared + shared[-len(special):], joined(frequent[:8], 64))


def fit(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method."""
    weights = np.zeros(features.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        curve = features.T @ (features * (p * (1 - p))[:, None]) + ridge * np.eye(len(weights))
        weights -= np.linalg.solve(curve, features.T @ (p - labels) + ridge * weights)
    return weights


def calibrate(model: Model, toxic: list[str], ordinary: list[str]) -> Model:
    gains = Gains(model)
    x = np.array([gains.features(t) for t in [*toxic, *ordinary]])
    y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), SPREAD)
    mean[0], scale[0] = 0.0, 1.0
    weights = fit((x - mean) / scale, y)
    return Model(model.toxic, model.ordinary, model.carrier, tuple(mean), tuple(scale), tuple(weights))


def held_out(doc_id: Column) -> Column:
    """Whether a row's label may not be learned from; a missing id counts as not held out, and has no label."""
    modulus, rest = HELD_OUT
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == rest, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model, or None where a class has fewer than four labelled rows to learn from."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = marked.where("toxic = 1").orderBy(order, "doc_id").limit(TOXIC_ROWS).unionAll(marked.where("toxic = 0").orderBy(order, "doc_id").limit(ORDINARY_ROWS))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).where(F.length("text").between(1, LEARN_CHARS))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy(order, "doc_id").collect()
    toxic, ordinary = ([r.text for r in rows if r.toxic == c] for c in (1, 0))
    if min(len(toxic), len(ordinary)) < 4:
        return None
    return calibrate(train(toxic[::2], ordinary[::2]), toxic[1::2], ordinary[1::2])


def scorer(model: Model | None):
    """A function of a text Column that gives the probability of label 1; without a model 0."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if model is None:
                yield pd.Series(np.zeros(len(texts)))
                continue
            gains = gains_of(model)
            x = np.array([gains.features(t) for t in texts]).reshape(len(texts), len(model.weights))
            z = (x - np.array(model.mean)) / np.array(model.scale) @ np.array(model.weights)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    A missing text is empty and scores as a text without words. An id with
    contradicting labels counts as toxic. Each row is on its own, so repeated
    rows need no rule; an empty table gives none.
    """
    score = scorer(learn(docs, labels))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), score(whole_text()).alias("score")).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
