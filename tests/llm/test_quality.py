"""Quality measures against plain counts, and the verdicts on planted junk."""

import random
import re
from collections import Counter

import helpers

from eventmill.llm import quality


def plain(text):
    text = text or ""
    words = helpers.SPACE_WORDS.findall(text)
    lines = [line for line in text.split("\n") if helpers.SPACE_WORDS.search(line)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_measures(spark):
    rows = helpers.AWKWARD + [(50, "a b c d e a b c d e a b c d e f g"), (51, "x#$ y & z|\nx#$ y & z|\n\n<x>"), (52, "p q r s t u p q r s t v " * 30)]
    got = quality.judged(helpers.documents(spark, rows))
    base = got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert helpers.by_id(base.collect()) == helpers.by_id((i, *plain(t)) for i, t in rows)
    assert all(not r.kept for r in got.collect() if r.base_failed)


def test_verdicts(spark):
    names = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "rd", "st", "l")]
    prose = lambda i: " ".join(names[(i * 37 + k * k * 11 + k * 3) % len(names)] for k in range(60)) + "."
    good = [(i, prose(i)) for i in range(60)]
    junk = [(100 + i, " ".join(w + "$$$" for w in prose(i).split())) for i in range(6)] + [(200 + i, prose(i).upper().replace(" ", "!! ")) for i in range(6)]
    kept = {r.doc_id: r.kept for r in quality.judged(helpers.documents(spark, good + junk)).collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i, _ in junk)


def test_rates_stay_sensible():
    found = quality.normal({(0, -1): (50.0, 1.0)}, 100.0, 110.0, 1)
    assert found.rates[0, -1][0] <= found.rates[0, -1][1]
    assert 0.5 < quality.normal({}, 0.0, 0.0, 1).accuracy(0, True) <= 1


def plain_em(patterns, n_rules):
    """Expectation-maximisation over every document by itself, in loops."""
    prior = {v: quality.START_RATES[v] for v in quality.VOTES}
    rates = {(j, v): tuple(prior[v][side] / sum(prior[w][side] for w in prior) for side in (0, 1)) for j in range(n_rules) for v in prior}
    good = quality.START_GOOD
    for _ in range(quality.STEPS):
        mass, counts = 0.0, {(j, v): [0.0, 0.0] for j in range(n_rules) for v in prior}
        n = 0
        for votes, often in patterns:
            on_good, on_bad = good, 1 - good
            for j, v in enumerate(votes):
                if v:
                    on_good, on_bad = on_good * rates[j, v][0], on_bad * rates[j, v][1]
            p = on_good / (on_good + on_bad)
            mass, n = mass + often * p, n + often
            for j, v in enumerate(votes):
                if v:
                    counts[j, v][0] += often * p
                    counts[j, v][1] += often * (1 - p)
        new = {}
        for j in range(n_rules):
            said = {v: [counts[j, v][side] + quality.PRIOR_VOTES * prior[v][side] for side in (0, 1)] for v in prior}
            share = {v: [said[v][side] / sum(said[w][side] for w in said) for side in (0, 1)] for v in said}
            if share[-1][0] > share[-1][1]:
                share = {v: [(a + b) / 2] * 2 for v, (a, b) in share.items()}
            new |= {(j, v): tuple(share[v]) for v in share}
        now = (mass + quality.PRIOR_VOTES * quality.START_GOOD) / (n + quality.PRIOR_VOTES)
        change = max(abs(now - good), *(abs(a - b) for k in new for a, b in zip(new[k], rates[k])))
        good, rates = now, new
        if change < quality.CLOSE:
            break
    return good, rates


def test_estimates_are_those_of_plain_loops(spark):
    rng = random.Random(8)
    patterns = Counter()
    for _ in range(3000):
        bad = rng.random() < 0.2
        patterns[tuple(rng.choice([0, 0, (-1 if rng.random() < 0.8 else 1) if bad else (1 if rng.random() < 0.85 else -1)]) for _ in range(4))] += 1
    found = quality.estimate(spark.createDataFrame([(list(v), n) for v, n in patterns.items()], "votes array<int>, n long"), 4)
    good, rates = plain_em(list(patterns.items()), 4)
    assert abs(found.good - good) < 1e-9 and set(found.rates) == set(rates)
    assert all(abs(a - b) < 1e-9 for k in rates for a, b in zip(found.rates[k], rates[k]))


def test_empty(spark):
    assert quality.judged(helpers.documents(spark, [])).collect() == []
