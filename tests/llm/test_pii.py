"""Personal data against plain regular expressions."""

import hashlib
import re

import time

import helpers
import pytest
from pyspark.sql import functions as F

from eventmill.llm import pii


@pytest.fixture(params=["named", "filtered"])
def lookups(request, monkeypatch):
    """Both ways to look up patterns and instances: named in the plan, and by bits with a join."""
    if request.param == "filtered":
        monkeypatch.setattr(pii, "IN_ROWS", 0)
        monkeypatch.setattr(pii, "FILTER_BITS", 256)
    return request.param

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
TEXTS = [
    " a@b.c_d@e.f x@y.z..w@q.r", "1.2.3.4.5.6.7.8 300.1.1.1 0001.02.3.255 1.2.3.4.", "+1 (434) 555-5481 +49((( 12 345 678 9 +1",
    "😀é 4111111111111111 4111 1111-1111 1111 1234567890123456789012345", "1" * 20_000, "1 " * 9_000, "@".join("a" * 50), "a@b." * 500,
    "x@y.com,z@w.org;+12345678901 1.2.3.4 -4111111111111111-",
]


def fine(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        doubled = (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0
    return True


def plain(text):
    spans = {k: [(m.start(), m.end()) for m in p.finditer(text or "") if fine(k, m.group())] for k, p in PLAIN.items()}
    joined = ",".join(f"{k}:{a}:{b}" for k, found in spans.items() for a, b in found)
    return *(len(x) for x in spans.values()), hashlib.sha256(joined.encode()).hexdigest()


def test_base_spans(spark):
    rows = helpers.AWKWARD + [(100 + i, t) for i, t in enumerate(TEXTS)]
    got = pii.personal_data(helpers.documents(spark, rows)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()
    assert helpers.by_id(got) == helpers.by_id((i, *plain(t)) for i, t in rows)


def test_patterns_find_unseen_identifiers(spark, lookups):
    rows = [(i, f"reach me at user{i}@mail.com today") for i in range(12)] + [(50, "reach me at zz9-k77 today"), (51, "we bought part zz9-k88 today")]
    spans = {r.doc_id: r.spans for r in pii.personal_data(helpers.documents(spark, rows)).collect()}
    assert spans[50] == "id:12:19" and spans[51] == ""
    assert spans[0] == "email:12:26"


def test_whole_seeds_make_patterns(spark, lookups):
    names = ["jane", "omar", "li", "eva", "tom", "ada", "ben", "zoe", "max", "ida", "amy", "bob", "cy", "dan"]
    rows = [(i, f"please write to {n}.doe@mail.com soon") for i, n in enumerate(names)]
    rows += [(20 + i, f"you may ring +44 20 7946 09{10 + i} after noon") for i in range(10)]
    rows += [(40, "please write to jdoe soon"), (41, "you may ring 20 7946 after noon"), (42, "please write to the front desk soon"), (43, "nothing to see here")]
    spans = {r.doc_id: r.spans for r in pii.personal_data(helpers.documents(spark, rows)).collect()}
    assert spans[0] == "email:16:33" and spans[20] == "phone:13:29"
    assert spans[40] == "id:16:20" and spans[41] == "id:13:20" and spans[42] == "id:16:30" and spans[43] == ""


def test_discovered_values_support_further_patterns(spark, lookups):
    rows = [(100 + i, f"reach me at user{i}@mail.com today") for i in range(80)]
    rows += [(20 + i, f"reach me at nick{c} today") for i, c in enumerate("abcdefghijkl")]
    rows += [(40 + i, f"greetings from handle nick{c} as ever") for i, c in enumerate("abcdefghijkl")]
    rows += [(70, "greetings from handle sam as ever"), (71, "greetings from uncle sam as ever")]
    spans = {r.doc_id: r.spans for r in pii.personal_data(helpers.documents(spark, rows)).collect()}
    assert spans[20] == "id:12:17" and spans[40] == "id:22:27" and spans[70] == "id:22:25" and spans[71] == ""


@pytest.mark.parametrize("column", ["pattern", "instance"])
def test_long_text_is_looked_up_in_little_time(spark, lookups, monkeypatch, column):
    """20,000 words, each of a thousand hits at its place."""
    monkeypatch.setattr(pii, "FILTER_BITS", 1 << 20)
    text = " ".join(f"word{i % 977} of" if i % 20 else f"reach me at nick{i}" for i in range(9_000))
    found = pii.written(pii.extracted(helpers.documents(spark, [(1, text)])), "found")
    wanted = spark.createDataFrame([("2\0me \0at ",)] if column == "pattern" else [(f"nick{i}",) for i in range(0, 9_000, 20)], f"{column} string")
    began = time.monotonic()
    rows = pii.looked_up(found, wanted, column).where(F.col("pattern") == "2\0me \0at ").collect()
    assert time.monotonic() - began < 20
    assert sorted((r.start, r.end) for r in rows) == [m.span() for m in re.finditer(r"nick\d+", text)]
    assert {r.instance for r in rows} == {f"nick{i}" for i in range(0, 9_000, 20)}


def test_support_grows_with_the_seeds(spark, monkeypatch):
    """A pattern around fewer than its share of all different seeds is no context."""
    rows = [(i, f"reach me at user{i}@mail.com today") for i in range(12)] + [(50, "reach me at zz9-k77 today")]
    monkeypatch.setattr(pii, "SHARE", 0.9)
    rows += [(100 + i, f"x{i} y{i} other{i}@mail.com z{i}") for i in range(12)]
    assert all(r.n_discovered == 0 for r in pii.personal_data(helpers.documents(spark, rows)).collect())
    monkeypatch.setattr(pii, "SHARE", 0.4)
    assert {r.doc_id: r.n_discovered for r in pii.personal_data(helpers.documents(spark, rows)).collect()}[50] == 1


def test_long_run_of_letters_is_read_once(spark):
    got = pii.personal_data(helpers.documents(spark, [(1, "a" * 200_000 + "@b.c")])).first()
    assert got.spans == "email:0:200004"


def test_redaction(spark):
    docs = helpers.documents(spark, [(1, "é mail a@b.co, call +1 (434) 555-5481."), (2, None), (3, "none"), (1, "é mail a@b.co, call +1 (434) 555-5481.")])
    got = pii.redacted(docs)
    assert got.columns == [*docs.columns, "n_spans"]
    assert sorted((r.doc_id, r.text or "", r.n_spans) for r in got.collect()) == [
        (1, "é mail [EMAIL], call [PHONE].", 2), (1, "é mail [EMAIL], call [PHONE].", 2), (2, "", 0), (3, "none", 0)]


def test_empty(spark):
    assert pii.personal_data(helpers.documents(spark, []).limit(0)).collect() == []
    assert pii.redacted(helpers.documents(spark, [])).collect() == []
