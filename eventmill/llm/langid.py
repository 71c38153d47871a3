"""Language identification by inference on a mixture of languages.

The model is a smoothed distribution over hashed letter trigrams for each
language, counted over all documents that may be learned from. A document is a
mixture: expectation-maximisation finds the share of each language in a set,
and the set grows from the best single language for as long as another one
raises the likelihood by more than its penalty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import whole_text

#: The model is languages x BUCKETS numbers: all that is ever broadcast.
BUCKETS = 1 << 15
SMOOTHING = 0.5
#: Steps of expectation-maximisation at most, and the change of a share that ends it.
STEPS, CLOSE = 30, 1e-3
#: A further language must raise the log-likelihood by so much per log of the trigrams: they overlap, so three times the usual half.
PENALTY = 1.5
UNKNOWN = "und"
HELD_OUT = (4, 2)
#: Characters hashed at a time.
BLOCK = 1 << 20

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which of the first 65,536 characters are letters; a character beyond counts as one if Python says so."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(1 << 16)), bool, 1 << 16))
    return _letters[0]


def trigram_counts(text: str) -> np.ndarray | None:
    """How often each bucket's trigrams occur in the lower-cased text, all but letters read as blanks; None without a letter."""
    counts, some = np.zeros(BUCKETS, np.int64), False
    for start in range(0, len(text), BLOCK):  # blocks overlap, so no trigram is lost
        codes = np.frombuffer(text[max(0, start - 2):start + BLOCK].lower().encode("utf-32-le", "replace"), np.uint32)
        low = codes < (1 << 16)
        letter = letters()[np.where(low, codes, 0)]
        if not low.all():
            far = np.flatnonzero(~low)
            letter[far] = [chr(c).isalpha() for c in codes[far].tolist()]
        some = some or bool(letter.any())
        codes = np.where(letter, codes, 32).astype(np.uint32)
        if start == 0:
            codes = np.concatenate(([np.uint32(32)], codes, [np.uint32(32)])) if len(text) <= BLOCK else np.concatenate(([np.uint32(32)], codes))
        if len(codes) > 2:
            mixed = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA6B) + codes[2:] * np.uint32(0xC2B2AE35)
            filled = letter_triples(codes)
            counts += np.bincount((mixed ^ (mixed >> np.uint32(15)))[filled] & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return counts if some else None


def letter_triples(codes: np.ndarray) -> np.ndarray:
    """Triples with a letter in the middle: a word of n letters has n of them, blanks between words none."""
    return codes[1:-1] != 32


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # BUCKETS x languages

    def shares(self, counts: np.ndarray) -> list[tuple[str, float]]:
        """The chosen languages and their shares, largest first."""
        here = np.flatnonzero(counts)
        weight = counts[here].astype(float)
        log_p = self.log_p[here]
        log_p = log_p - log_p.max(axis=1, keepdims=True)  # the same for all sets, so it changes no comparison
        p, total = np.exp(log_p), weight.sum()
        single = weight @ log_p
        chosen, share, best = [int(single.argmax())], np.ones(1), float(single.max())
        while len(chosen) < len(self.languages):
            mix = p[:, chosen] @ share
            gains = (weight / mix) @ p / total  # of a small share of each language
            gains[chosen] = 0
            more = int(gains.argmax())
            if gains[more] <= 1:
                break
            trial = [*chosen, more]
            shares, value = fit(p[:, trial], weight)
            if value - best <= PENALTY * np.log(total + 1):
                break
            chosen, share, best = trial, shares, value
        order = np.argsort(-share, kind="stable")
        return [(self.languages[chosen[i]], float(share[i])) for i in order]

    def predict(self, text: str | None) -> tuple[str, float, str]:
        counts = trigram_counts(text) if text else None
        if counts is None or not self.languages or not counts.any():
            return UNKNOWN, 0.0, ""
        found = self.shares(counts)
        return *found[0], ",".join(f"{name}:{share:.2f}" for name, share in found)


def fit(p: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the columns' languages by expectation-maximisation, and their log-likelihood."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    for _ in range(STEPS):
        new = share * ((weight / (p @ share)) @ p) / weight.sum()
        done = np.abs(new - share).max() < CLOSE
        share = new
        if done:
            break
    return share, float(weight @ np.log(p @ share))


def held_out(doc_id: Column) -> Column:
    """Whether a row's label may not be learned from; a missing id counts as not held out, and is not learned from either."""
    modulus, rest = HELD_OUT
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == rest, F.lit(False))


def learn(docs: DataFrame) -> Model:
    """Counts over every row with an id, a text and a language that is not held out."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                found = trigram_counts(text.as_py())
                if found is not None:
                    sums[lang] = sums[lang] + found if lang in sums else found
        for lang, found in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([found.tobytes()])], ["lang", "counts"])

    # One vector for each language and partition, added up bucket by bucket in the tasks of the next stage.
    parts = rows.mapInArrow(count, "lang string, counts binary")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, counted in zip(batch.column("lang").to_pylist(), batch.column("counts").to_pylist()):
                found = np.frombuffer(counted, np.int64)
                sums[lang] = sums[lang] + found if lang in sums else found
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["lang", "counts"])

    summed = parts.repartition(F.col("lang"), F.spark_partition_id() % 16).mapInArrow(add, "lang string, counts binary")
    counts: dict[str, np.ndarray] = {}
    for row in summed.toLocalIterator():
        found = np.frombuffer(row.counts, np.int64)
        counts[row.lang] = counts[row.lang] + found if row.lang in counts else found
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)))
    table = np.stack([counts[name] for name in languages], axis=1) + SMOOTHING
    return Model(languages, np.log(table / table.sum(axis=0)))


def predictor(spark, model: Model):
    """A function of a text Column that gives struct(lang, score, languages)."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double, languages string")
    def predict(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t.as_py()) for t in texts]
        kinds = {"lang": pa.string(), "score": pa.float64(), "languages": pa.string()}
        return pa.StructArray.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds.values())], list(kinds))

    return predict


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, languages) of every row.

    ``lang_pred`` is the language with the largest share and ``score`` its
    share; ``languages`` lists the whole set. A missing text or one without
    letters is ``und`` with score 0, as is any text where no language was
    learned. Each row is on its own, so repeated rows need no rule.
    """
    predict = predictor(docs.sparkSession, learn(docs))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text").cast("string")).alias("found")
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"), F.col("found.languages").alias("languages"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a language; their columns do not change."""
    predict = predictor(docs.sparkSession, learn(docs))
    row = docs.select(F.struct(*docs.columns).alias("doc"), predict(whole_text()).alias("found"))
    return row.where(F.col("found.lang") != UNKNOWN).select("doc.*")
