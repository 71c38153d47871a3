"""Licence scan against a plain search."""

import re

import helpers

from eventmill.llm import licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORDS.findall((text or "").translate(helpers.LOWER_AZ))
    places, labels = [], set()
    for label, phrase in licenses.BASE_PHRASES.items():
        phrase = phrase.split()
        for i in range(len(words) - len(phrase) + 1):
            if words[i:i + len(phrase)] == phrase:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    "Under THE mit license, cc by nc cc by nc 4.0 apache license version 2", "x under the mit\nlicense under the mit license", "cc by nc", "under the mit licenses",
    "This work is licensed under the GNU General Public License, version 3.", "the GNU General Public License, version", "free as in speech, public as in park",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
]


def test_base(spark):
    rows = helpers.AWKWARD + [(50 + i, t) for i, t in enumerate(TEXTS)]
    got = licenses.scanned(helpers.documents(spark, rows)).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert helpers.by_id(got.collect()) == helpers.by_id((i, *plain(t)) for i, t in rows)


def test_templates(spark):
    found = {r.doc_id: (r.labels, r.score) for r in licenses.scanned(helpers.documents(spark, list(enumerate(TEXTS)))).collect()}
    assert found[4] == ("gpl-3", 1.0) and found[7][0] == "bsd"
    assert found[0] == ("apache-2,cc-by-nc,mit", 1.0)
    assert found[5][0] == "" and found[6] == ("", 0.0)


def test_file_with_every_template(spark):
    notices = [text for _, text, _ in licenses.TEMPLATES]
    rows = [(1, " and also ".join(notices)), (2, " ".join(reversed(notices))), (3, "word " * 5_000 + " filler ".join(notices)), (4, helpers.PROSE)]
    rows += [(10 + i, f"{helpers.PROSE} {text} {helpers.PROSE}") for i, text in enumerate(notices)]
    found = {r.doc_id: r.labels for r in licenses.scanned(helpers.documents(spark, rows)).collect()}
    every = ",".join(sorted({label for label, _, _ in licenses.TEMPLATES}))
    assert found[1] == found[2] == found[3] == every and found[4] == ""


def test_empty(spark):
    assert licenses.scanned(helpers.documents(spark, [])).collect() == []
