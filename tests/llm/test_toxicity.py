"""Toxicity on planted words, and awkward rows."""

import random

import helpers

from eventmill.llm import toxicity


def planted(n=600):
    rng = random.Random(7)
    common = ["".join(rng.choice("aeionrstl") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(common) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            words[10], words[40] = rng.choice(["vilezzqurk", "muckqqface"]), "grubxxnose"
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out(spark):
    rows, labels = planted()
    got = toxicity.scored(helpers.documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    truth = dict(labels)
    assert all(r.predicted == truth[r.doc_id] for r in got) and len(got) > 100


def test_awkward_rows(spark):
    rows, labels = planted(200)
    more = [(None if i is None else i + 1000, t) for i, t in helpers.AWKWARD]
    table = spark.createDataFrame([*labels, (None, 1), (5, None), (6, 3), (7, 1), (7, 0)], "doc_id long, toxic int")
    got = toxicity.scored(helpers.documents(spark, rows + more), table).collect()
    assert len(got) == len(rows + more) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(not r.predicted for r in got if r.doc_id is None or r.doc_id >= 1000)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.scored(helpers.documents(spark), none).collect()} == {(0.0, 0)}
    assert toxicity.scored(helpers.documents(spark, []), none).collect() == []
