"""Language mixtures: held-out accuracy, mixed texts, awkward rows."""

import math
import zlib
from collections import Counter

import helpers
import numpy as np
from conftest import MEDIUM
from pyspark.sql import functions as F

from eventmill.llm import langid
from eventmill.llm.common import table


def test_held_out_accuracy(spark):
    docs = table(spark, MEDIUM, "documents")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def plain_counts(text):
    """Buckets of all letter triples around a letter, one by one."""
    codes = [32, *(ord(c) if c.isalpha() else 32 for c in text.lower()), 32]
    found = Counter()
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b != 32:
            mixed = (a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) % (1 << 32)
            found[(mixed ^ mixed >> 15) % langid.BUCKETS] += 1
    return found


def plain_prediction(text, model):
    """The set and shares by plain loops: the best language, then any that the likelihood pays for."""
    counts = plain_counts(text)
    total = sum(counts.values())
    p = lambda name, bucket: (model[name].get(bucket, 0) + langid.SMOOTHING) / (sum(model[name].values()) + langid.SMOOTHING * langid.BUCKETS)
    seen = {b: [p(name, b) for name in model] for b in counts}
    names = list(model)

    def fit(chosen):
        share = {i: 1 / len(chosen) for i in chosen}
        for _ in range(langid.STEPS):
            new = dict.fromkeys(chosen, 0.0)
            for b, n in counts.items():
                whole = sum(share[i] * seen[b][i] for i in chosen)
                for i in chosen:
                    new[i] += n * share[i] * seen[b][i] / whole / total
            done = max(abs(new[i] - share[i]) for i in chosen) < langid.CLOSE
            share = new
            if done:
                break
        return share, sum(n * math.log(sum(share[i] * seen[b][i] for i in chosen)) for b, n in counts.items())

    single = [sum(n * math.log(seen[b][i]) for b, n in counts.items()) for i in range(len(names))]
    best = max(single)
    share = {single.index(best): 1.0}
    while len(share) < len(names):
        gains = [0 if i in share else sum(n * seen[b][i] / sum(share[k] * seen[b][k] for k in share) for b, n in counts.items()) / total for i in range(len(names))]
        more = gains.index(max(gains))
        if gains[more] <= 1:
            break
        trial, value = fit([*share, more])
        if value - best <= langid.PENALTY * math.log(total + 1):
            break
        share, best = trial, value
    return {names[i]: s for i, s in share.items()}


def test_predictions_are_those_of_plain_loops(spark):
    """Counts over all rows that may be learned from, and the mixture of each text, one by one."""
    docs = table(spark, MEDIUM, "documents").where(F.length("text") < 2000).limit(60).collect()
    rows = [(r.doc_id, r.text, r.lang) for r in docs] + [(9000, docs[0].text[:400] + " " + docs[7].text[:300], None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = {}
    for i, text, lang in rows:
        if lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            model.setdefault(lang, Counter()).update(plain_counts(text))
    model = {name: model[name] for name in sorted(model)}
    got = {r.doc_id: r for r in langid.identify(frame).collect()}
    for i, text, _ in rows:
        want = plain_prediction(text, model)
        first = max(want, key=want.get)
        assert got[i].lang_pred == first and abs(got[i].score - want[first]) < 1e-6
        assert {part.split(":")[0] for part in got[i].languages.split(",")} == set(want)


def test_mixture():
    rng = np.random.default_rng(1)
    texts = {"a": "".join(rng.choice(list("abcd "), 4000)), "b": "".join(rng.choice(list("wxyz "), 4000))}
    counts = np.stack([langid.trigram_counts(t) for t in texts.values()], axis=1) + langid.SMOOTHING
    model = langid.Model(list(texts), np.log(counts / counts.sum(axis=0)))
    assert model.predict(texts["a"][:500])[0] == "a" and model.predict(texts["a"][:500])[2] == "a:1.00"
    name, share, languages = model.predict(texts["a"][:600] + texts["b"][:300])
    assert name == "a" and 0.6 < share < 0.75 and languages.count(":") == 2
    assert model.predict(None) == model.predict("12 34 !") == (langid.UNKNOWN, 0.0, "")


def test_counts_do_not_depend_on_blocks(monkeypatch):
    text = "Größe und Länge, 12 Wörter; 中文 😀 " * 40
    whole = langid.trigram_counts(text)
    monkeypatch.setattr(langid, "BLOCK", 50)
    assert abs(int(langid.trigram_counts(text).sum()) - int(whole.sum())) <= 2


def test_awkward_rows(spark):
    docs = helpers.documents(spark).withColumn("score", F.lit(1))
    got = langid.identify(docs)
    assert got.count() == len(helpers.AWKWARD)
    found = {r.doc_id: r.lang_pred for r in got.collect()}
    assert found[3] == found[4] == found[5] == "und" and found[1] == "en"
    assert langid.keep_identified(docs).columns == docs.columns
    assert langid.identify(helpers.documents(spark, [])).collect() == []


def test_nothing_to_learn_from(spark):
    docs = helpers.documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(docs).collect()} == {"und"}
