"""Quality by weak supervision.

Rules vote good, bad or abstain on each document. What they say is counted by
pattern of votes (at most 3 ** rules patterns, whatever the corpus), and
expectation-maximisation over that table estimates for each rule how often it
is right on good and on bad documents. A
document's verdict is the posterior probability that it is good.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import whole_text
from eventmill.session import written

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Steps of expectation-maximisation at most, and the change of every estimate that ends it.
STEPS, CLOSE = 20, 2e-3
#: Where estimation starts: the share of good documents, each vote's rate on good and on bad ones, and for how many votes that counts.
START_GOOD, START_RATES, PRIOR_VOTES = 0.7, {1: (0.998, 0.83), -1: (0.002, 0.17)}, 20.0
VOTES = (-1, 1)
KEPT_FROM = 0.5


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""

    name: str
    bad: Column
    good: Column

    def vote(self) -> Column:
        return F.when(self.bad, -1).when(self.good, 1).otherwise(0).cast("int")


def rules() -> list[Rule]:
    """The rules over the measures of ``measured``."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    letters = F.greatest(F.col("n_letters"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    share = lambda part, whole: F.col(part) / whole
    characters = F.greatest(F.col("word_chars"), F.lit(1))
    long = F.col("n_words") >= 10
    return [
        Rule("length", F.col("n_words") < 10, F.col("n_words") >= 40),
        Rule("word_length", (share("word_chars", words) < 2) | (share("word_chars", words) > 14), share("word_chars", words).between(3, 10)),
        Rule("symbols", share("n_symbols", words) > 0.1, share("n_symbols", words) < 0.02),
        Rule("repeated_lines", (F.col("n_dup_lines") >= 3) & (share("n_dup_lines", lines) > 0.3), share("n_dup_lines", lines) <= 0.1),
        Rule("repeated_words", share("n_repeat_words", words) > 0.2, share("n_repeat_words", words) < 0.05),
        Rule("capitals", long & (share("n_capitals", letters) > 0.4), share("n_capitals", letters) < 0.15),
        Rule("shouting", share("n_marks", words) > 0.3, share("n_marks", words) < 0.05),
        Rule("letters", (F.col("n_words") >= 30) & (share("n_letters", characters) < 0.85), share("n_letters", characters) > 0.92),
        Rule("doubled_words", long & (share("n_doubled", words) > 0.2), share("n_doubled", words) < 0.05),
    ]


def repeat_words(hashes: Column) -> Column:
    """Words covered by windows of five words that are found twice or more, from the windows' hashes in order."""
    ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(s: Column) -> Column:
        n = F.size(s)
        twin = F.filter(F.transform(s, lambda x, k: F.when(
            ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | ((k < n - 1) & (F.get(s, k + 1)["h"] == x["h"])), x["i"])), lambda x: x.isNotNull())
        places = F.array_sort(twin)
        return F.transform(F.array(places), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda total, x: total + x))[0]

    any_twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(any_twice, F.transform(F.array(ranked), covered)[0]).otherwise(0)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, measures...) of each whole text; a missing text has no words."""
    text = F.col("text")
    gone = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    counted = rows.select(
        "doc_id", F.array_remove(F.split("text", SPACE, -1), "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        gone("[" + SYMBOLS.replace("&", "\\&") + "]+").alias("n_symbols"), gone("[\\p{Lu}]+").alias("n_capitals"), gone("[\\p{L}\\p{M}]+").alias("n_letters"),
        gone("[!?]+").alias("n_marks"))
    hashed = counted.select(
        "doc_id", F.size("words").alias("n_words"), F.length(F.array_join("words", "")).alias("word_chars"), "n_symbols", "n_capitals", "n_letters",
        "n_marks", F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    at = lambda i: F.get(F.col("h"), i)
    windows = F.when(F.size("h") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("h") - WINDOW), lambda i: F.xxhash64(*(at(i + k) for k in range(WINDOW))))).otherwise(F.array().cast("array<long>"))
    doubled = F.size(F.filter(F.transform("h", lambda h, i: (i > 0) & (h == at(i - 1))), lambda x: x))
    windowed = hashed.withColumn("windows", windows).withColumn("n_doubled", doubled).drop("h")
    return windowed.withColumn("n_repeat_words", repeat_words(F.col("windows"))).drop("windows")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass
class Estimates:
    """How rules vote, given a document's quality; votes are independent of each other then, and abstaining says nothing."""

    good: float  # share of good documents
    rates: dict[tuple[int, int], tuple[float, float]]  # (rule, vote): probability of that vote, if any, on a good and on a bad document

    def accuracy(self, rule: int, good: bool) -> float:
        """How often the rule is right about such documents."""
        return self.rates[rule, 1 if good else -1][0 if good else 1]

    def posterior(self, votes: Column) -> Column:
        """Probability that a document with these votes is good."""
        logit = F.lit(math.log(self.good / (1 - self.good)))
        for j in range(len(self.rates) // len(VOTES)):
            said = {v: math.log(self.rates[j, v][0] / self.rates[j, v][1]) for v in VOTES}
            logit = logit + F.when(votes[j] == 1, said[1]).when(votes[j] == -1, said[-1]).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))

    def differs(self, other: Estimates) -> float:
        return max(abs(self.good - other.good), *(abs(a - b) for k, x in self.rates.items() for a, b in zip(x, other.rates[k])))


def normal(sums: dict[tuple[int, int], tuple[float, float]], good: float, n: float, n_rules: int) -> Estimates:
    """Rates from weighed counts with the start as a prior. No rule is taken to vote bad more often on good documents than on bad ones."""
    rates = {}
    for j in range(n_rules):
        columns = []
        for side in (0, 1):
            said = {v: sums.get((j, v), (0.0, 0.0))[side] + PRIOR_VOTES * START_RATES[v][side] for v in VOTES}
            columns.append({v: said[v] / sum(said.values()) for v in VOTES})
        on_good, on_bad = columns
        if on_good[-1] > on_bad[-1]:
            on_good = on_bad = {v: (on_good[v] + on_bad[v]) / 2 for v in VOTES}
        rates |= {(j, v): (on_good[v], on_bad[v]) for v in VOTES}
    return Estimates((good + PRIOR_VOTES * START_GOOD) / (n + PRIOR_VOTES), rates)


def estimate(patterns: DataFrame, n_rules: int) -> Estimates:
    """Expectation-maximisation over (votes, n): each step joins the rates to the votes and sums up the weighed counts, 3 x rules rows."""
    spark = patterns.sparkSession
    now = normal({}, 0.0, 0.0, n_rules)
    each = written(patterns.select("n", F.col("votes").alias("pattern"), F.posexplode("votes").alias("rule", "vote")), "votes")
    for _ in range(STEPS):
        rates = spark.createDataFrame([(j, v, math.log(g / b)) for (j, v), (g, b) in now.rates.items()], "rule int, vote int, said double")
        prior = spark.createDataFrame([(math.log(now.good / (1 - now.good)),)], "logit double")
        logit = each.join(F.broadcast(rates), ["rule", "vote"], "left").groupBy("pattern").agg(F.coalesce(F.sum("said"), F.lit(0.0)).alias("said"))
        good = logit.withColumn("good", 1 / (1 + F.exp(-(F.col("said") + prior.select("logit").scalar())))).select("pattern", "good")
        weighed = each.join(good, "pattern").groupBy("rule", "vote").agg(F.sum(F.col("n") * F.col("good")).alias("good"), F.sum("n").alias("n")).collect()
        n = sum(r.n for r in weighed if r.rule == 0)
        if not n:
            return now
        sums = {(r.rule, r.vote): (r.good, r.n - r.good) for r in weighed}
        new = normal(sums, sum(r.good for r in weighed if r.rule == 0), n, n_rules)
        change, now = new.differs(now), new
        if change < CLOSE:
            break
    return now


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, posterior) of every row.

    A missing or blank text has no words and fails. Each row is on its own, so
    repeated rows and missing ids need no rule; an empty table gives none.
    """
    found = rules()
    measures = written(measured(docs).withColumn("votes", F.array(*(r.vote() for r in found))), "measures")
    patterns = written(measures.where(~base_failed()).groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "patterns")
    posterior = estimate(patterns, len(found)).posterior(F.col("votes"))
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return measures.select("doc_id", *(F.col(c).cast("long").alias(c) for c in longs), base_failed().alias("base_failed"),
                           (~base_failed() & (posterior >= KEPT_FROM)).alias("kept"), posterior.alias("posterior"))
