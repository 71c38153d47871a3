"""Licence scan with a positional index of rare words.

The templates' words are indexed by template and position. Over all files it is
counted how many hold each of these words; every template is then found through
its rarest ones. In a file, the places of all these words are turned into
(template, start) by the index's postings; starts that several of them
agree on are candidates, however many licences the file holds, and a candidate is verified against the template's
words and its mandatory key phrases. It runs row by row in Spark expressions:
only the word counts, one row for each template word, are gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import let, whole_text

#: Rarest words that each template is looked up by.
TEMPLATE_WORDS = 3
#: Words of an edit that may shift a template's parts against each other, and share of its words that must stand in place.
SHIFT, MATCH = 1, 0.6

# Phrases of the base labels.
BASE_PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

# Notices of public licences, and what each must hold word for word.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ["free of charge", "associated documentation files"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ["apache org licenses"]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ["general public license version 3"]),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ["general public license version 2"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ["gnu general public license", "free software"]),
    ("lgpl", "under the terms of the gnu lesser general public license", ["gnu lesser general public license"]),
    ("agpl-3", "under the terms of the gnu affero general public license version 3", ["gnu affero general public license"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["source and binary forms", "following conditions are met"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ["waived all copyright"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", ["held liable", "express or implied warranty"]),
]


def words_of(text: Column) -> Column:
    """Words of the text in lower-case A-Z."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lowered, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", -1), "")


def literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def places(words: Column, phrase: list[str]) -> Column:
    """Where the phrase's words stand consecutively; only rows with all of them are searched."""
    n = len(phrase)
    possible = F.size(words) >= n
    for word in set(phrase):
        possible = possible & F.array_contains(words, word)

    def here(i: Column) -> Column:
        found = F.get(words, i) == phrase[0]
        for k in range(1, n):
            found = found & (F.get(words, i + k) == phrase[k])
        return found

    return F.when(possible, F.filter(F.sequence(F.lit(0), F.size(words) - n), here)).otherwise(F.array().cast("array<int>"))


def template_words() -> list[str]:
    return sorted({w for _, text, _ in TEMPLATES for w in text.split()})


def inverse_frequencies(docs: DataFrame) -> dict[str, float]:
    """log(files / files with the word) of each template word, over all files; a word of no file is the rarest."""
    held = docs.select(F.array_intersect(words_of(whole_text()), literal(template_words())).alias("held"))
    # the row without a word counts the files
    counts = {r.word: r.n for r in held.select(F.explode(F.concat("held", F.array(F.lit("")))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    files = counts.get("", 0)
    return {w: math.log((files + 1) / (counts.get(w, 0) + 0.5)) for w in template_words()}


def index(idf: dict[str, float]) -> list[tuple[str, list[tuple[int, int]]]]:
    """(word, [(template, position)]) of each template's rarest words, rarest first."""
    looked_up = {w for _, text, _ in TEMPLATES for w in sorted(set(text.split()), key=lambda w: (-idf[w], w))[:TEMPLATE_WORDS]}
    postings = {w: [(t, i) for t, (_, text, _) in enumerate(TEMPLATES) for i, x in enumerate(text.split()) if x == w] for w in looked_up}
    return sorted(postings.items(), key=lambda x: (-idf[x[0]], x[0]))


def verified(words: Column, template: int, starts: Column) -> Column:
    """The best match of one template at these starts: its share of words in place, 0 without its key phrases."""
    _, text, phrases = TEMPLATES[template]
    body = text.split()

    def share(start: Column) -> Column:
        near = F.slice(words, F.greatest(start - SHIFT, F.lit(0)) + 1, F.lit(len(body) + 2 * SHIFT))
        must = F.lit(True)
        for phrase in phrases:
            must = must & F.contains(F.concat(F.lit(" "), F.array_join(near, " "), F.lit(" ")), F.lit(f" {phrase} "))
        in_place = F.aggregate(literal(body), F.struct(F.lit(0).alias("i"), F.lit(0).alias("n")), lambda acc, w: F.struct(
            (acc["i"] + 1).alias("i"),
            (acc["n"] + F.array_contains(F.slice(words, F.greatest(start + acc["i"] - SHIFT, F.lit(0)) + 1, F.lit(2 * SHIFT + 1)), w).cast("int")).alias("n")))
        return F.when(must, in_place["n"] / len(body)).otherwise(0.0)

    return F.coalesce(F.array_max(F.transform(starts, share)), F.lit(0.0))


def starts_by(hits: Column, word: str, position: int) -> Column:
    """Where a template starts if each hit of the word is at this position of it."""
    return F.transform(F.filter(hits, lambda h: h["w"] == word), lambda h: h["i"] - position)


def agreed(starts: Column) -> Column:
    """The starts that two words give at least, give or take a shift: in order, the next one or the last one is near."""
    def near(s: Column) -> Column:
        return F.filter(s, lambda x, i: (x - F.get(s, i - 1) <= SHIFT) | (F.get(s, i + 1) - x <= SHIFT))

    return F.array_distinct(let(F.array_sort(starts), near))


def template_scores(words: Column, postings: list[tuple[str, list[tuple[int, int]]]]) -> Column:
    """An array with the best score of each template, through the postings of every index word of the file."""
    rare = [w for w, _ in postings]
    hits = F.filter(F.transform(words, lambda w, i: F.when(w.isin(rare), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull())

    def by_template(hits: Column) -> Column:
        scores = []
        for t in range(len(TEMPLATES)):
            known = [(w, at) for w, posts in postings for tpl, at in posts if tpl == t]
            starts = F.flatten(F.array(*(starts_by(hits, w, at) for w, at in known)))
            scores.append(verified(words, t, agreed(starts)))
        return F.array(*scores)

    return F.when(F.arrays_overlap(words, literal(rare)), let(hits, by_template)).otherwise(F.array().cast("array<double>"))


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    ``score`` is 1 where a base phrase stands, else the best share of a
    template's words in place, 0 without its key phrases. A missing text is
    empty: no words, no labels, score 0. Each row is on its own, so repeated
    rows need no rule; an empty table gives none.
    """
    postings = index(inverse_frequencies(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(whole_text()).alias("words"))
    base = F.array(*(places(F.col("words"), phrase.split()) for phrase in BASE_PHRASES.values()))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), base.alias("base"), template_scores(F.col("words"), postings).alias("scores"))
    every = F.flatten("base")
    named = lambda labels: F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))
    base_labels = [F.when(F.size(F.col("base")[i]) > 0, F.lit(label)) for i, label in enumerate(BASE_PHRASES)]
    scores = F.col("scores")
    own = [F.when(F.coalesce(F.get(scores, F.lit(t)), F.lit(0.0)) >= MATCH, F.lit(label)) for t, (label, _, _) in enumerate(TEMPLATES)]
    return rows.select(
        "doc_id", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"), F.array_join(named(base_labels), ",").alias("base_labels"),
        F.array_join(named(base_labels + own), ",").alias("labels"),
        F.when(F.size(every) > 0, 1.0).otherwise(F.coalesce(F.array_max(scores), F.lit(0.0))).alias("score"))
