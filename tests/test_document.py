"""Documents: envelope, toggles, delimiters, properties, exceptions."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from eventmill.functions import jsontext, times
from eventmill.model import EVENT_COLUMNS
from eventmill.operators import document, exceptions
from eventmill.options import DocumentOptions

WHEN = datetime.datetime(2013, 5, 28, 12, 10, 20, 666000, tzinfo=datetime.timezone.utc)
DEEP = ("8\nThrow\nLib, Version=1.2.3.4, Culture=neutral, PublicKeyToken=null\nApp.Thrower\nVoid Throw()")


def chain(*messages):
    return [("classname nasty exception" if i == 1 else "App.Error", m, "source", f"stack\r\n\r\nof {m}\n", None, i,
             DEEP if i == 0 else None, 123123, "help url" if i == 1 else None) for i, m in enumerate(messages)]


@pytest.fixture(scope="module")
def events(spark):
    schema = ", ".join(f"{name} {kind}" for name, kind in EVENT_COLUMNS.items())
    song = {"Song": '"New Macabre"', "Complex": '{"A":1,"B":2}', "level": '"shadow"'}
    return spark.createDataFrame([
        (1, WHEN, 600, "Information", "{Song}++ @{Complex}", song, None),
        (2, WHEN, 0, "Fatal", "{Song}", {"Song": '"Old"'}, chain("outer", "inner", "innermost")),
        (3, WHEN, -300, "Debug", "", {}, []),
    ], schema)


def documents(events, common=(), **options):
    rows = events.select("event_id", document.event_document(DocumentOptions(**options), common).alias("doc")).collect()
    return {row.event_id: row.doc for row in rows}


def test_whole_document(events):
    doc = documents(events)[1]
    assert doc.startswith('{"@timestamp":"2013-05-28T22:10:20.6660000+10:00","level":"Information","messageTemplate":')
    assert json.loads(doc)["message"] == '"New Macabre"++ @{"A":1,"B":2}'
    assert '"fields":{' in doc and 'Complex":{' in doc


def test_minimal_document(events):
    assert json.loads(documents(events)[3]) == {
        "@timestamp": "2013-05-28T07:10:20.6660000-05:00", "level": "Debug", "messageTemplate": "", "message": ""}


def test_common_templates_change_nothing(events):
    assert documents(events) == documents(events, common=["{Song}++ @{Complex}", "{Song}", ""])


def test_toggles(events):
    doc = json.loads(documents(events, render_message=False, render_template=False)[1])
    assert "message" not in doc and "messageTemplate" not in doc


def test_inline_fields(events):
    doc = documents(events, inline_fields=True)[2]
    assert '"fields"' not in doc and doc.endswith('"Song":"Old"}')
    envelope_wins = documents(events, inline_fields=True)[1]
    assert json.loads(envelope_wins)["level"] == "Information" and envelope_wins.count('"level"') == 1
    row = events.filter("event_id = 1").select(document.colliding_fields(F.col("properties"))).first()
    assert row[0] == ["level"]


def test_delimiters(events):
    whole = documents(events)[3]
    assert documents(events, closing_delimiter=";\n")[3] == whole + ";\n"
    assert documents(events, omit_enclosing_object=True, closing_delimiter=";")[3] == whole[1:-1]


def test_exceptions_as_array(events):
    found = json.loads(documents(events)[2])["exceptions"]
    assert [e["Depth"] for e in found] == [0, 1, 2] and [e["Message"] for e in found] == ["outer", "inner", "innermost"]
    assert found[1]["ClassName"] == "classname nasty exception" and found[1]["HelpURL"] == "help url"
    assert found[1]["HResult"] == 123123 and found[1]["RemoteStackIndex"] == 1
    assert found[0]["HelpURL"] is None and "ExceptionMethod" not in found[1]
    assert found[0]["ExceptionMethod"] == {
        "Name": "Throw", "AssemblyName": "Lib", "AssemblyVersion": "1.2.3.4", "AssemblyCulture": "",
        "ClassName": "App.Thrower", "Signature": "Void Throw()", "MemberType": 8}
    assert list(found[0]) == ["Depth", "ClassName", "Message", "Source", "StackTraceString", "RemoteStackTraceString",
                              "RemoteStackIndex", "ExceptionMethod", "HResult", "HelpURL"]


def test_stack_traces_as_lines(events):
    found = json.loads(documents(events, stack_trace_as_array=True)[2])["exceptions"][0]
    # The remote trace is its own, not a second copy of the local one.
    assert found["StackTrace"] == ["stack", "of outer"] and found["RemoteStackTrace"] == []
    assert "StackTraceString" not in found


def test_exception_as_object(events):
    found = json.loads(documents(events, exceptions_as_object=True)[2])["exception"]
    assert found["innerException"]["innerException"]["Message"] == "innermost"
    assert "innerException" not in found["innerException"]["innerException"]


def test_depth_limit(spark):
    long = spark.createDataFrame([(chain(*map(str, range(30))),)], f"exceptions {EVENT_COLUMNS['exceptions']}")
    row = long.select(F.size(exceptions.flattened(F.col("exceptions"))), exceptions.nested_json(F.col("exceptions"))).first()
    assert row[0] == 21 and row[1].count("innerException") == 29 and json.loads(row[1])


@pytest.mark.parametrize("text, parts", [
    ("8\x00M\x00Lib\x00C\x00S", {"Name": "M", "AssemblyName": "Lib", "AssemblyVersion": None, "AssemblyCulture": None}),
    ("8\nM\nLib, Culture=de-DE\nC\nS", {"Name": "M", "AssemblyName": "Lib", "AssemblyCulture": "de-DE"}),
    ("8\nM", None), ("  ", None), (None, None),
])
def test_methods(spark, text, parts):
    found = spark.createDataFrame([(text,)], "t string").select(exceptions.exception_method(F.col("t")).alias("m")).first().m
    assert (found is None) == (parts is None)
    assert not parts or all(found[name] == value for name, value in parts.items())


@pytest.mark.parametrize("value, text", [
    (2.0, "2"), (0.01, "0.01"), (-1.5, "-1.5"), (12345678.25, "12345678.25"), (1e-4, "0.0001"), (float("nan"), '"NaN"'),
    (float("inf"), '"Infinity"'), (None, "null"), (0.0, "0")])
def test_numbers(spark, value, text):
    frame = spark.createDataFrame([(value,)], "v double")
    assert frame.select(jsontext.number_json(F.col("v"))).first()[0] == text


@pytest.mark.parametrize("text", ["", "plain", "é ü/", "end\n", "tab\t", 'q"', "back\\slash", "\u2028", "\x7f\x01", None])
def test_every_string_is_valid_json(spark, text):
    made = spark.createDataFrame([(text,)], "s string").select(jsontext.string_json(F.col("s"))).first()[0]
    assert json.loads(made) == text


def test_strings_and_fields(spark):
    text = 'q"\\\n\u0001é'
    frame = spark.createDataFrame([(text, '{"b":[1,2.50],"a":null,"c":{"x":"y"}}', "no json")], "s string, p string, q string")
    row = frame.select(
        jsontext.string_json(F.col("s")), jsontext.fields_json(jsontext.dynamic_fields(F.col("p"))),
        jsontext.fields_json(jsontext.dynamic_fields(F.col("q")))).first()
    assert json.loads(row[0]) == text
    assert json.loads(row[1]) == {"a": None, "b": [1, 2.5], "c": {"x": "y"}} and row[2] is None


def test_merging(spark):
    frame = spark.sql("SELECT map('a', '1') AS f, map('a', '2', 'b', '3') AS s, CAST(NULL AS map<string,string>) AS n")
    row = frame.select(jsontext.merged_maps(F.col("f"), F.col("s")), jsontext.merged_maps(F.col("f"), F.col("n"))).first()
    assert row[0] == {"a": "1", "b": "3"} and row[1] == {"a": "1"}


@pytest.mark.parametrize("pattern", ["yyyy.MM.dd", "yyyyMMddHH", "yyyy-MM-dd'x"])
def test_date_patterns(pattern):
    if "x" in pattern:
        with pytest.raises(ValueError):
            times.date_pattern(pattern)
    else:
        assert times.date_pattern(pattern) == pattern


def test_name_without_pattern(spark):
    with pytest.raises(ValueError):
        times.formatted_name("logs-{0}", F.lit(0))


def test_heavy_tasks_have_a_bounded_number_of_rows(spark, monkeypatch, tmp_path):
    from eventmill.sources import views

    spark.range(0, 5000, 1, 1).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    monkeypatch.setattr(views, "ROWS_PER_TASK", 100)
    found = views.spread(rows, "id")
    assert found.rdd.getNumPartitions() == 50 and found.count() == 5000
    assert max(map(len, found.rdd.glom().collect())) <= 200
    monkeypatch.setattr(views, "ROWS_PER_TASK", 10**6)
    assert views.spread(rows, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
