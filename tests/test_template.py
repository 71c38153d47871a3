"""Message templates: tokens, rendering, and the same text from both ways."""

import json

import pytest
from pyspark.sql import functions as F

from eventmill.functions import template

PROPERTIES = {
    "Song": json.dumps("New Macabre"), "Odd": json.dumps('a "b" \\ c'), "N": "7", "Price": "1234.565", "Small": "-0.5",
    "Fine": "2.67499999999999999", "Large": "1e30",
    "Neg": "-1", "Wide": "-4294967296", "Zero": "0", "Flag": "true", "None": "null", "List": "[1,2]",
}

CASES = [
    ("", ""),
    ("plain", "plain"),
    ("{Song}++ @{Complex}", '"New Macabre"++ @{Complex}'),
    ("{Song:l}", "New Macabre"),
    ("{Odd}", '"a \\"b\\" \\ c"'),
    ("{Odd:l}", 'a "b" \\ c'),
    ("{{literal}} {N}", "{literal} 7"),
    ("{{{N}}}", "{7}"),
    ("{N:000}|{Price:0.00}|{Small:0.00}", "007|1234.57|-0.50"),
    ("{Price:F1} {Price:N2} {N:D4} {Price:F}", "1234.6 1,234.57 0007 1234.57"),
    ("{N,5}|{N,-5}|{Song,3}", '    7|7    |"New Macabre"'),
    ("{N,6:000}", "   007"),
    ("{Fine:0.00} {Fine:0.000000000000}", "2.67 2.675000000000"),
    ("{Large:0.00} {Large:0}", "1000000000000000000000000000000.00 1000000000000000000000000000000"),
    ("{@List} {$Flag} {None}", "[1,2] true null"),
    ("{Price:weird}", "1234.565"),
    ("{Price:#,##0.0#} {Price:#,##0} {N:#,##0.0##} {N:0.0#} {Small:#.##} {Small:0#.0}", "1,234.57 1,235 7.0 7.0 -.5 -00.5"),
    ("{Price:P1} {Small:P} {N:P0} {Price:p2}", "123,456.5 % -50.00 % 700 % 123,456.50 %"),
    ("{Price:E2} {Small:e3} {N:E} {Large:E1}", "1.23E+003 -5.000e-001 7.000000E+000 1.0E+030"),
    ("{Price:D6} {N:X4} {N:x} {Neg:X} {Neg:x2} {Wide:X} {Price:X}", "1234.565 0007 7 FFFFFFFF ffffffff FFFFFFFF00000000 1234.565"),
    ("{Zero:#.#}|{Zero:#,##0}|{Zero:.0}|{Price:C}", "|0|0|1234.565"),
    ("{not a hole} {", "{not a hole} {"),
    ("{Missing,5:000}", "{Missing,5:000}"),
]


@pytest.fixture(scope="module")
def frame(spark):
    rows = spark.createDataFrame([(t, PROPERTIES) for t, _ in CASES], "t string, p map<string,string>")
    return rows


@pytest.mark.parametrize("common", [[], [t for t, _ in CASES]], ids=["general", "compiled"])
def test_messages(frame, common):
    texts = template.message_texts(F.col("t"), F.col("p"), common)
    got = {row.t: row.m for row in frame.select("t", texts["message"].alias("m")).collect()}
    assert got == dict(CASES)


@pytest.mark.parametrize("common", [[], [t for t, _ in CASES]], ids=["general", "compiled"])
def test_renderings(frame, common):
    texts = template.message_texts(F.col("t"), F.col("p"), common)
    got = {row.t: row.r and json.loads(row.r) for row in frame.select("t", texts["renderings"].alias("r")).collect()}
    assert got["plain"] is None and got["{N,5}|{N,-5}|{Song,3}"] is None
    assert got["{N,6:000}"] == {"N": [{"Format": "000", "Rendering": "   007"}]}
    assert got["{Price:F1} {Price:N2} {N:D4} {Price:F}"] == {
        "Price": [{"Format": "F1", "Rendering": "1234.6"}, {"Format": "N2", "Rendering": "1,234.57"},
                  {"Format": "F", "Rendering": "1234.57"}],
        "N": [{"Format": "D4", "Rendering": "0007"}]}
    assert got["{Missing,5:000}"] == {"Missing": [{"Format": "000", "Rendering": "{Missing,5:000}"}]}
    assert got["{Song:l}"] == {"Song": [{"Format": "l", "Rendering": "New Macabre"}]}


def test_helpers_agree(frame):
    row = frame.filter("t = '{N,6:000}'").select(
        template.rendered_message(F.col("t"), F.col("p")), F.to_json(template.renderings(F.col("t"), F.col("p"))),
        template.holes(F.col("t"))).first()
    assert tuple(row) == ("   007", '{"N":[{"Format":"000","Rendering":"   007"}]}', ["{N,6:000}"])


def test_common_templates(frame):
    assert set(template.common_templates(frame, "t")) == {t for t, _ in CASES}


def test_formats_that_are_not_followed_are_told(spark):
    rows = spark.createDataFrame([("{A:C2} {A:0.0} {B:HH:mm}",), ("{A:C2} {A:0.0} {B:HH:mm}",), ("{A:l} {A:#,##0.0} {A:P} {A:G}",), (None,)], "message_template string")
    assert {tuple(r) for r in template.unsupported_formats(rows).collect()} == {("{A:C2} {A:0.0} {B:HH:mm}", "C2", 2), ("{A:C2} {A:0.0} {B:HH:mm}", "HH:mm", 2)}
