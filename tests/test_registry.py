"""Mappings kept between runs, the id-indexed store, and templates in great number."""

import random
import re

import pytest
from pyspark.sql import functions as F

from eventmill.operators import bulk, mapping, routing
from eventmill.operators.registry import Registry
from eventmill.sources import indexed

LEAF = "index string, path string, type string, event_id int"


def leaves(rng, n, first=0):
    return [(rng.choice(["i", "i", "i", "j", None]), rng.choice("abcd"), rng.choice(["long", "string"]), first + i) for i in range(n)]


def known(frame):
    return {(r["index"], r.path, r.type): (r["first"].event_id, r.n) for r in frame.collect()}


def test_halves_merge_to_the_whole(spark):
    rows = leaves(random.Random(1), 300)
    whole, one, other = (spark.createDataFrame(part, LEAF) for part in (rows, rows[::2], rows[1::2]))
    parts = [mapping.summary(f, ["event_id"]) for f in (one, other)]
    want = known(mapping.summary(whole, ["event_id"]))
    assert known(mapping.merged(*parts)) == known(mapping.merged(*parts[::-1])) == want
    assert known(mapping.merged(parts[0], spark.createDataFrame([], parts[0].schema))) == known(parts[0])
    first = {}
    for index, path, kind, i in rows:
        first.setdefault((index, path), (kind, i))
    assert {(r["index"], r.path): r.mapped_type for r in mapping.mappings(mapping.summary(whole, ["event_id"])).collect()} == {k: v[0] for k, v in first.items()}


def test_registry_opens_new_documents_only(spark, tmp_path):
    rng, registry = random.Random(2), Registry(spark, str(tmp_path / "registry"))
    assert registry.known() is None
    rows = []
    for number in range(3):
        new = leaves(rng, 100, 100 * number)
        rows += new
        registry.update(spark.createDataFrame(new, LEAF), ["event_id"], number)
    want = known(mapping.summary(spark.createDataFrame(rows, LEAF), ["event_id"]))
    assert known(registry.known()) == want
    assert known(registry.update(spark.createDataFrame(rows, LEAF), ["event_id"], 2)) == want, "an update counts once"
    late = spark.createDataFrame([("i", "a", "string", 900), ("i", "a", "long", 901)], LEAF)
    found = mapping.conflicting(late, registry.update(late, ["event_id"], 3)).collect()
    first = next(kind for index, path, kind, _ in rows if (index, path) == ("i", "a"))
    assert [r.type for r in found] == [{"long": "string", "string": "long"}[first]]


def test_a_run_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    registry = Registry(spark, str(tmp_path / "registry"))
    registry.update(spark.createDataFrame(leaves(random.Random(3), 20), LEAF), ["event_id"], 0)
    want = known(registry.known())
    monkeypatch.setattr("eventmill.operators.registry.put", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        registry.update(spark.createDataFrame(leaves(random.Random(4), 20), LEAF), ["event_id"], 1)
    assert known(registry.known()) == want and registry.current()["update"] == 0


@pytest.fixture
def store(spark, tmp_path):
    documents = spark.range(4000).select(
        F.concat(F.lit("d"), F.col("id")).alias("id"), F.concat(F.lit("i"), F.col("id") % 3).alias("_index"), F.lit("old").alias("doc"), F.lit(0).cast("long").alias("at"))
    found = indexed.IndexedStore(spark, str(tmp_path / "store"), "id", 16)
    found.write(documents, "overwrite")
    return found, documents


def events_of(spark, rng, n):
    rows = [(f"d{rng.choice([rng.randint(0, 30), rng.randint(5000, 5010)])}", f"i{rng.randint(0, 2)}", f"new{i}", i + 1) for i in range(n)]
    return spark.createDataFrame(rows, "id string, _index string, doc string, at long")


def content(frame):
    return sorted((r["id"], r["_index"], r.doc, r["at"]) for r in frame.collect())


@pytest.mark.parametrize("named", [True, False])
def test_create_and_replace_as_on_tables(spark, store, monkeypatch, named):
    """The same as the operators that read the whole store, also where folders and ids are too many to name."""
    if not named:
        monkeypatch.setattr(indexed, "NAMED_FOLDERS", 2)
        monkeypatch.setattr(indexed, "NAMED_IDS", 2)
    kept, documents = store
    for number, way in enumerate(("create", "replace", "create", "replace")):
        events = events_of(spark, random.Random(number), 60)
        both = [f.withColumn("key", F.struct("_index", "id")) for f in (documents, events)]
        if way == "create":
            documents = bulk.apply_create(*both, "key", ["at"])
            kept.create(events, ["at"])
        else:
            documents = bulk.apply_index(*both, "key", ["at"])
            kept.replace(events, ["at"])
        documents = spark.createDataFrame(documents.select("id", "_index", "doc", "at").collect(), "id string, _index string, doc string, at long")
        assert content(kept.read()) == content(documents)


def test_few_ids_read_few_files(spark, store):
    kept, _ = store
    ids = spark.createDataFrame([(f"d{i}", f"i{i % 3}") for i in (1, 2, 3, 9001)], "id string, _index string")
    files = lambda frame: {r[0] for r in frame.select(F.input_file_name()).distinct().collect()}
    assert len(files(kept.touched(ids))) <= 4 < 40 < len(files(kept.read()))
    plan = kept.touched(ids).filter(F.col("id").isin("d1", "d2"))._jdf.queryExecution().toString()
    assert "PushedFilters: [In(id, [d1,d2])" in plan or "PushedFilters: [Or(EqualTo(id" in plan
    assert sorted(r["id"] for r in kept.stored(ids).collect()) == ["d1", "d2", "d3"]
    before = {f for f in kept.read().inputFiles()}
    kept.replace(ids.limit(1).select("id", "_index", F.lit("x").alias("doc"), F.lit(5).cast("long").alias("at")), ["at"])
    assert len(before - set(kept.read().inputFiles())) == 1, "one folder is written again"


def test_ten_thousand_templates(spark):
    """As the expression with an arm for each."""
    rng = random.Random(5)
    stems = ["logs", "logs-", "logs-app", "metrics", "me", "", "x.y", "a\\Eb", "a_b", "100%"]
    templates = [routing.IndexTemplate(f"t{i:05d}", rng.choice(stems) + (f"{rng.randint(0, 400)}-" if rng.random() < 0.9 else "") + rng.choice(["*", "*z", "", "*b*"]), rng.randint(0, 3))
                 for i in range(10_000)]
    names = [rng.choice(stems) + rng.choice([f"{rng.randint(0, 400)}-", "q"]) + rng.choice(["", "z", "abz", "b"]) for _ in range(300)] + [None, ""]
    table = spark.createDataFrame([(t.name, t.pattern, t.priority) for t in templates], "name string, pattern string, priority int")
    frame = spark.createDataFrame([(n,) for n in names], "index string")
    got = {r["index"]: r.template for r in routing.best_templates(frame, table).collect()}
    compiled = [(t, re.compile(".*".join(map(re.escape, t.pattern.split("*"))), re.S)) for t in templates]

    def plain(name):
        fits = [t for t, pattern in compiled if pattern.fullmatch(name)]
        return min(fits, key=lambda t: (-t.priority, t.name)).name if fits else None

    assert got == {n: plain(n) if n is not None else None for n in names} and any(got.values())
    few = [t for t in templates if "\\" not in t.pattern][:60]
    with_few = spark.createDataFrame([(t.name, t.pattern, t.priority) for t in few], "name string, pattern string, priority int")
    for rows in (0, 1_000):
        joined = routing.best_templates(frame, with_few, max_broadcast_rows=rows).withColumn("expression", routing.best_template(F.col("index"), few))
        assert joined.filter("NOT template <=> expression").count() == 0 and joined.count() == len(names)
    assert {r.template for r in routing.best_templates(frame, table.limit(0)).collect()} == {None}
