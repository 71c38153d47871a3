"""Personal data by bootstrapped contextual extraction.

Four patterns find the seed entities. What surrounds a whole seed in the text -
the two pieces before, the piece before with the word behind, and what it is
glued to - are lexical patterns; a piece is a word with what separates it from the
next one. Whatever stands in the slot of a pattern that surrounds enough known
instances is an instance too, with or without digits, of one word or several.
Patterns are scored by the sure instances among all that they surround, instances
by the patterns that surround them, in turn, over the graph of both. Instances
that get sure are looked up in the whole corpus; the patterns around them that
now have enough support join the graph, until no pattern is added. Values inside
a pattern of high confidence are identifiers, though no seed pattern matches them.

All of it is Spark SQL. The graph holds one row per different (pattern,
instance), so copies of a document add nothing, and a pattern that surrounds a
third of all values is summed up before it is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.llm.common import let, whole_text
from eventmill.session import written

#: Rounds of scoring each time patterns join; confidence from which a pattern extracts.
ROUNDS, CONFIDENT = 3, 0.8
#: Different sure instances that a pattern must surround: so many, and this share of all different seeds. Values that stand in
#: running text meet a common pair of words in proportion to the corpus; such pairs are no contexts at any size. As a seed has
#: three patterns at a place, the share also bounds how many patterns the seeds can support.
SUPPORT, SHARE = 5, 0.005
#: Characters before and after a value that its context is taken from.
REACH = 80

# A match of each kind starts where the last one ended or its first class does not go on to the left:
# elsewhere a longer match would have started before. So long runs are read once.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
#: Kind of the spans that patterns discover.
FOUND = "id"
#: Characters of a word, and those that it must end with; a piece is a word and all up to the next one.
IN_WORD, WORD_END = r"\p{L}\p{M}\p{N}._@%+-", r"\p{L}\p{M}\p{N}"
PIECE = f"[{IN_WORD}]++[^{IN_WORD}]*+|[^{IN_WORD}]++"
TAIL = f"(?<=[{WORD_END}])[^{WORD_END}]++$"
#: Words that a discovered value may have.
LONGEST = 5
#: Up to so many patterns or instances are named in the plan; of more, a filter of so many bits is, and a join decides.
IN_ROWS, FILTER_BITS = 2_000, 1 << 20
PART_TO_255 = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def luhn(text: Column) -> Column:
    """Whether the digits of the text pass: every second one from the right doubled, the sum ends in 0."""
    digits = F.reverse(F.regexp_replace(text, "[^0-9]", ""))

    def worth(d: Column, i: Column) -> Column:
        value = d.cast("int") * (1 + i % 2)
        return F.when(value > 9, value - 9).otherwise(value)

    return F.aggregate(F.transform(F.split(digits, ""), worth), F.lit(0), lambda total, v: total + v) % 10 == 0


def digits_between(text: Column, least: int, most: int) -> Column:
    return F.length(F.regexp_replace(text, "[^0-9]", "")).between(least, most)


def kept_match(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike("^" + r"\.".join([PART_TO_255] * 4) + "$")
    if kind == "card":
        return digits_between(match, 16, 19) & luhn(match)
    if kind == "phone":
        return digits_between(match, 8, 15)
    return F.lit(True)


def located(text: Column, pattern: str, gate: Column) -> Column:
    """Every match in order as (start, end, value, before, behind): code points, end exclusive, and the texts next to it.

    Cutting a text at its matches gives what lies between them, and with the
    lengths of both the places follow.
    """
    kind = "array<struct<start:int,end:int,value:string,before:string,behind:string>>"
    none = F.array().cast(kind)

    def placed(found: Column) -> Column:
        def walk(parts: Column) -> Column:
            steps = F.zip_with(F.slice(parts, F.lit(1), F.size(found)), found, lambda part, value: F.struct(part.alias("part"), value.alias("value")))
            start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), none.alias("out"))

            def step(acc: Column, x: Column) -> Column:
                begin = acc["at"] + F.length(x["part"])
                end = begin + F.length(x["value"])
                here = F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"), F.right(x["part"], F.lit(REACH)).alias("before"),
                                F.left(F.get(parts, acc["i"] + 1), F.lit(REACH)).alias("behind"))
                return F.struct(end.alias("at"), (acc["i"] + 1).alias("i"), F.array_append(acc["out"], here).alias("out"))

            return F.aggregate(steps, start, step, lambda acc: acc["out"])

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), walk)).otherwise(none)

    return F.when(gate, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(none)


PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}


def gates(text: Column) -> dict[str, Column]:
    """Of each kind whether a text may have it."""
    return {"email": F.contains(text, F.lit("@")), "ip": text.rlike("[0-9]\\.[0-9]"), "card": text.rlike("[0-9][\\x20-]?[0-9]"), "phone": F.contains(text, F.lit("+"))}


def plainly(text: Column) -> Column:
    """In lower case, with single blanks; \0 parts the pieces of a pattern."""
    return F.regexp_replace(F.lower(text), r"[\s\x00]+", " ")


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def left_patterns(two: Column, one: Column) -> Column:
    """The patterns of the two pieces before, and of what a value is glued to; none without a piece before."""
    return F.array_compact(F.array(
        F.when((two != "") & (one != ""), F.concat(F.lit("2\0"), two, F.lit("\0"), one)),
        F.when((one != "") & ~one.endswith(" "), F.concat(F.lit("0\0"), one))))


def both_sides(one: Column, behind: Column) -> Column:
    """The pattern of the piece before and the word behind, missing without one of them."""
    after = F.regexp_replace(F.regexp_extract(behind, f"^[^{WORD_END}]*+[{IN_WORD}]++", 0), TAIL, "")
    return F.when((one != "") & (after != ""), F.concat(F.lit("1\0"), one, F.lit("\0"), after))


def seeds_of(text: Column, kind: str, pattern: str, gate: Column) -> Column:
    """The base spans of a kind as (start, end, instance, patterns): each whole span is an instance."""
    fine = F.filter(located(text, pattern, gate), lambda x: kept_match(kind, x["value"]))

    def seed(x: Column) -> Column:
        last = lambda q, n: F.coalesce(F.get(q, F.size(q) - n), F.lit(""))
        around = let(F.transform(pieces(x["before"]), plainly), lambda q: F.concat(
            left_patterns(last(q, 2), last(q, 1)), F.array_compact(F.array(both_sides(last(q, 1), plainly(x["behind"]))))))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), plainly(x["value"]).alias("instance"), around.alias("patterns"))

    return F.transform(fine, seed)


def extracted(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text, email, ip, card, phone) of each row, the base spans with instance and patterns."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    text = F.col("text")
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text", *(seeds_of(text, k, PATTERNS[k], gate).alias(k) for k, gate in gates(text).items()))


def joined_words(q: Column, i: Column, k: int) -> Column:
    """Pieces i to i + k - 1 without what follows the last word."""
    return F.regexp_replace(F.concat(*(F.coalesce(F.get(q, i + j), F.lit("")) for j in range(k))), TAIL, "")


def candidates_at(q: Column, i: Column, wanted, may_end) -> Column:
    """Each value of one to LONGEST words from piece i on, as (i, k, instance, pattern) of every pattern around it.

    Only what stands behind tells where a value of several words ends, so other
    patterns take one word, or all of a number that is written with blanks.
    ``wanted`` tells of a pattern and ``may_end`` of a number of words, before
    the value is made, whether they can be asked for.
    """
    piece = lambda n: F.coalesce(F.get(q, i + n), F.lit(""))
    none = F.array().cast(CANDIDATE)

    def of(k: int, patterns: Column) -> Column:
        return let(joined_words(q, i, k), lambda value: F.when((F.size(q) >= i + k) & value.rlike(f"(?s)^[{IN_WORD}].*[{WORD_END}]$"), F.transform(
            F.filter(patterns, wanted), lambda p: F.struct(i.alias("i"), F.lit(k).alias("k"), value.alias("instance"), p.alias("pattern")))).otherwise(none))

    def by_left(patterns: Column) -> Column:
        number = F.coalesce(*(F.when((F.size(q) >= i + k) & joined_words(q, i, k).rlike(r"^[+]?[0-9][0-9 ().-]*+$"), k) for k in range(LONGEST, 1, -1)), F.lit(1))
        made = let(number, lambda whole: F.coalesce(*(F.when(whole == k, of(k, patterns)) for k in range(1, LONGEST + 1))))
        return F.when(F.size(patterns) > 0, made).otherwise(none)

    def by_both(k: int) -> Column:
        behind = F.concat(F.regexp_extract(piece(k - 1), TAIL, 0), piece(k), piece(k + 1))
        return F.when(may_end(k), of(k, F.array_compact(F.array(both_sides(piece(-1), behind))))).otherwise(none)

    return F.flatten(F.array(let(F.filter(left_patterns(piece(-2), piece(-1)), wanted), by_left), *map(by_both, range(1, LONGEST + 1))))


CANDIDATE = "array<struct<i:int,k:int,instance:string,pattern:string>>"


def with_places(hits: Column, p: Column) -> Column:
    """Hits as (start, end, instance, pattern): code points, end exclusive, by the length of the pieces before."""
    text = lambda a, n: F.array_join(F.slice(p, a + 1, n), "")

    def placed(x: Column) -> Column:
        return let(F.length(text(F.lit(0), x["i"])), lambda begin: F.struct(
            begin.alias("start"), (begin + F.length(F.regexp_replace(text(x["i"], x["k"]), TAIL, ""))).alias("end"), x["instance"].alias("instance"), x["pattern"].alias("pattern")))

    return F.transform(hits, placed)


def first_word(value: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(value, f"^[{IN_WORD}]*+", 0), TAIL, "")


def known_filter(values: DataFrame):
    """A test of a text against one column of texts, and whether it is exact: else it also lets a few others through.

    Up to IN_ROWS texts are named. Of more, each sets two bits; the bits, a table
    of a fixed size, are summed up in Spark.
    """
    few = [r[0] for r in values.limit(IN_ROWS + 1).collect()]
    if len(few) <= IN_ROWS:
        return lambda x: F.coalesce(x.isin(few), F.lit(False)), True
    places = lambda x: [F.pmod(F.xxhash64(*salt, x), F.lit(FILTER_BITS)) for salt in ((), (F.lit(1),))]
    marks = values.select(F.explode(F.array(*places(F.col(values.columns[0])))).alias("at"))
    words = marks.groupBy(F.floor(F.col("at") / 64).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    table = ["0"] * (FILTER_BITS // 64)
    for row in words.collect():
        table[row.word] = str(row.bits)
    bits = F.split(F.lit(",".join(table)), ",").cast("array<bigint>")  # one literal

    def might(x: Column) -> Column:
        one, other = (F.bit_get(F.get(bits, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1 for at in places(x))
        return F.coalesce(one & other, F.lit(False))

    return might, False


def looked_up(found: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """(doc_id, text_hash, start, end, instance, pattern) of every value outside base spans whose ``column`` is wanted.

    Only positions whose first word (of instances) or piece before (of patterns)
    is that of a wanted one are gone into, and only values that pass the test
    leave their row.
    """
    asked, exact = known_filter(wanted.select(column).distinct())
    ended = lambda x: F.lit(True)
    if column == "instance":
        begun, _ = known_filter(wanted.select(first_word(F.col(column)).alias("first")).distinct())
    else:  # the piece before, and with it the word behind
        parts = F.split(column, "\0")
        begun, _ = known_filter(wanted.select(F.when(F.col(column).startswith("2"), parts[2]).otherwise(parts[1]).alias("first")).distinct())
        ended, _ = known_filter(wanted.where(F.col(column).startswith("1")).select(
            F.concat(parts[1], F.lit("\0"), F.regexp_extract(parts[2], f"[{IN_WORD}]*$", 0)).alias("pair")).distinct())

    def hits(p: Column) -> Column:
        def of(q: Column, words: Column) -> Column:
            at = F.sequence(F.lit(0), F.size(q) - 1)
            if column == "instance":
                at = F.filter(at, lambda i: begun(F.get(words, i)))
                each = F.flatten(F.transform(at, lambda i: candidates_at(q, i, lambda x: F.lit(True), lambda k: F.lit(True))))
                return F.filter(each, lambda x: asked(x["instance"]))
            at = F.filter(at, lambda i: begun(F.get(q, i - 1)))
            # a piece without a word may stand between
            pair = lambda i, k: F.concat(F.get(q, i - 1), F.lit("\0"), F.get(words, i + k))
            may_end = lambda i: lambda k: ended(pair(i, k)) | ended(pair(i, k + 1))
            return F.flatten(F.transform(at, lambda i: candidates_at(q, i, asked, may_end(i))))

        def found_in(q: Column) -> Column:
            return let(F.transform(q, first_word), lambda words: let(of(q, words), lambda h: with_places(h, p)))

        return let(F.transform(p, plainly), lambda q: F.when(F.size(q) > 0, found_in(q)))

    seeds = F.transform(F.flatten(F.array(*KINDS)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    values = let(seeds, lambda base: F.filter(let(pieces(F.col("text")), hits), lambda v: ~F.exists(base, lambda s: (s["start"] < v["end"]) & (s["end"] > v["start"]))))
    each = found.select("doc_id", "text_hash", F.explode(values).alias("v")).select("doc_id", "text_hash", "v.*")
    return each if exact else each.join(wanted, column, "left_semi").select("doc_id", "text_hash", "start", "end", "instance", "pattern")


def scored_graph(graph: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pattern, confidence) and the sure (instance) that no seed is, after the last round."""
    scores = graph.withColumn("score", F.col("known").cast("double"))
    for round_ in range(ROUNDS):
        patterns = written(scores.groupBy("pattern").agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("confidence")), "patterns")
        # An instance is as sure as its surest pattern; a known one stays sure.
        sure = graph.join(patterns, "pattern").groupBy("instance").agg(F.max("confidence").alias("surest"), F.max("known").alias("seed"))
        if round_ == ROUNDS - 1:
            break
        scores = graph.join(sure.drop("seed"), "instance").withColumn(
            "score", F.when(F.col("known"), 1.0).when(F.col("surest") >= CONFIDENT, F.col("surest")).otherwise(0.0)).drop("surest")
    return patterns.where(F.col("confidence") >= CONFIDENT), sure.where((F.col("surest") >= CONFIDENT) & ~F.col("seed")).select("instance")


def discovered(found: DataFrame) -> DataFrame | None:
    """(doc_id, text_hash, start, end) of every value in the slot of a confident pattern; None if no pattern has support."""
    seed = found.select(F.explode(F.flatten(F.array(*KINDS))).alias("s")).select(F.explode("s.patterns").alias("pattern"), "s.instance")
    support = seeds = written(seed.distinct(), "support")
    least = max(SUPPORT, math.ceil(SHARE * seeds.select("instance").distinct().count()))
    admitted = known_sure = inside = confident = None
    while True:
        supported = support.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("pattern")
        new = written(supported if admitted is None else supported.join(admitted, "pattern", "left_anti"), "admitted")
        if new.isEmpty():
            break
        admitted = new if admitted is None else admitted.unionAll(new)
        slots = written(looked_up(found, new, "pattern"), "slots")
        inside = slots if inside is None else inside.unionAll(slots)
        graph = seeds.withColumn("known", F.lit(True)).join(admitted, "pattern", "left_semi").unionByName(inside.select("pattern", "instance", F.lit(False).alias("known")))
        confident, sure = scored_graph(written(graph.groupBy("pattern", "instance").agg(F.max("known").alias("known")), "graph"))
        more = written(sure if known_sure is None else sure.join(known_sure, "instance", "left_anti"), "sure")
        if more.isEmpty():
            break
        # What got sure supports the patterns around it, wherever it stands.
        known_sure = more if known_sure is None else known_sure.unionAll(more)
        support = written(support.unionByName(looked_up(found, more, "instance").select("pattern", "instance")).distinct(), "support")
    return inside if inside is None else inside.join(confident, "pattern", "left_semi").select("doc_id", "text_hash", "start", "end")


def outermost(spans: Column) -> Column:
    """Spans in order without those inside another."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"))))
    start = F.struct(F.lit(-1).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    return F.aggregate(ordered, start, lambda acc, s: F.when(-s["back"] > acc["at"], F.struct((-s["back"]).alias("at"), F.array_append(
        acc["out"], F.struct(s["start"].alias("start"), (-s["back"]).alias("end"))).alias("out"))).otherwise(acc), lambda acc: acc["out"])


def all_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, email, ip, card, phone, id): the spans of each row, arrays of (start, end) in order."""
    found = written(extracted(docs), "extracted")
    new = discovered(found)
    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = found.select("doc_id", "text_hash", *(F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k) for k in KINDS))
    if new is None:
        return spans.withColumn(FOUND, none)
    keys = F.struct("doc_id", "text_hash")
    new = written(new.groupBy(keys.alias("whose")).agg(outermost(F.collect_set(F.struct("start", "end"))).alias(FOUND)), "discovered")
    return spans.withColumn("whose", keys).join(new, "whose", "left").drop("whose").withColumn(FOUND, F.coalesce(FOUND, none))


def listed(kinds: tuple[str, ...]) -> Column:
    """All spans as kind:start:end, kind by kind, joined by commas."""
    return F.array_join(F.flatten(F.array(*(
        F.transform(kind, spelled(kind)) for kind in kinds))), ",")


def spelled(kind: str):
    return lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_discovered) of every row.

    A missing text is empty: no spans. Rows alike in id and text are one
    document with the same spans in each row; a missing id changes nothing. An
    empty table gives none.
    """
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return all_spans(docs).select("doc_id", *counts, F.sha2(listed(KINDS), 256).alias("base_sha256"), listed((*KINDS, FOUND)).alias("spans"),
                                  F.size(FOUND).cast("long").alias("n_discovered"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span, overlapping ones as one, replaced by its kind in brackets; ``spans`` are (start, end, kind)."""
    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        out = F.when(new, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(F.array_sort(spans), start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data replaced in the text, and n_spans (long); a missing text stays missing.

    All columns are kept, but for a former n_spans.
    """
    of = lambda kind: F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))
    spans = all_spans(docs).select(F.struct("doc_id", "text_hash").alias("_whose"), F.flatten(F.array(*map(of, (*KINDS, FOUND)))).alias("_spans"))
    spans = spans.where(F.size("_spans") > 0).groupBy("_whose").agg(F.first("_spans").alias("_spans"))  # rows that repeat have the same spans
    names = [c for c in docs.columns if c != "n_spans"]
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(whole_text()).alias("text_hash"))
    joined = docs.select(F.struct(*names).alias("_doc"), key.alias("_whose")).join(spans, "_whose", "left")
    text = F.when(F.col("_spans").isNull(), F.col("_doc.text")).otherwise(redact(F.col("_doc.text"), F.col("_spans")))
    return joined.select(*(text.alias("text") if c == "text" else F.col("_doc")[c].alias(c) for c in names),
                         F.coalesce(F.size("_spans"), F.lit(0)).cast("long").alias("n_spans"))
