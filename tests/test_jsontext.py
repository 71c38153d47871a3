"""JSON text of structured values, and serializers of one's own."""

import json

import pandas as pd
from pyspark.sql import functions as F

from eventmill.functions import jsontext


def test_structured_values(spark):
    kind = "o struct<b:int,_typeTag:string,a:array<map<int,double>>>, n map<string,struct<x:boolean,d:date>>, e array<int>, q struct<_typeTag:string>"
    rows = spark.createDataFrame([
        ((1, "T", [{10: 1.5, 2: None}]), {"k\"": (True, None)}, [], (None,)), (None, None, None, None)], kind)
    columns = rows.columns
    got = rows.select(*(jsontext.value_json(F.col(c), rows.schema[c].dataType) for c in columns)).collect()
    assert got[0][0].startswith('{"_typeTag":"T","b":1,"a":[{') and json.loads(got[0][0])["a"] == [{"10": 1.5, "2": None}]
    assert list(got[0])[1:] == ['{"k\\"":{"x":true,"d":null}}', "[]", "{}"]
    assert list(got[1]) == ["null"] * 4


def test_own_serializer(spark):
    rows = spark.createDataFrame([((1, "x"), 5), ((2, "y"), 6)], "Point struct<x:int,y:string>, n int")

    @F.pandas_udf("string")
    def short(points: pd.DataFrame) -> pd.Series:
        return pd.Series([f'"{x}/{y}"' if x == 1 else None for x, y in zip(points["x"], points["y"])])

    got = [r[0] for r in rows.select(jsontext.structured_fields(rows, ["Point", "n"], {"Point": short})).collect()]
    assert got == [{"Point": '"1/x"', "n": "5"}, {"Point": '{"x":2,"y":"y"}', "n": "6"}]
