"""Types of JSON members come from the document, not from how a text begins."""

import json

import pytest

from sluice.operators.reshape import flatten_agencies, monthly_long, payload_rows


def frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "key LONG, p STRING")


def records(spark, text):
    return [json.loads(r.record) for r in payload_rows(frame(spark, text), "p").collect()]


@pytest.mark.parametrize("text, want", [
    ('{"a":" [1]","b":[{"x":1}]}', [{"x": 1}]),
    ('{"a":"[{\\"x\\":2}]","b":{"c":[1]},"d":[]}', [{"a": '[{"x":2}]', "b": {"c": [1]}, "d": []}]),
    ('{"z":[{"x":1}],"a":[{"x":2}]}', [{"x": 1}]),          # the order of the document, not of the names
    (' [1, "[2]", null, {"x": "{"}]', [1, "[2]", None, {"x": "{"}]),
    ('"[1]"', []), ("3", []), ("[not json", []), ("{}", []), ("[]", []), ("", []),
    ('{"a":null,"list":[[]]}', [[]]),
])
def test_records_of_a_payload(spark, text, want):
    assert records(spark, text) == want


def test_texts_are_no_agencies(spark):
    text = ('{"A":[{"ori":"1","n":7,"o":{"p":[1]}},"{not json","{\\"ori\\":\\"2\\"}",null,[{"ori":"3"}],4],'
            '"B":"[{\\"ori\\":\\"5\\"}]","C":null,"D":{"ori":"6"}}')
    got = flatten_agencies(frame(spark, text, None, "[1]"), "p", "ori STRING, n INT, o STRING, gone DOUBLE, key LONG",
                           keep=["key"]).collect()
    assert [tuple(r) for r in got] == [("1", 7, '{"p":[1]}', None, "A", 0)]


def test_texts_are_no_series_and_counts_keep_their_meaning(spark):
    text = ('{"rates":{"r":{"03-2020":"0.5","01-2020":2}},"actuals":{"note":"{\\"01-1950\\":1}","zz":'
            '{"03-2020":"12","01-2020":4,"05-2020":true,"06-2020":"many","07-2020":null,"08-2020":[1],"09-2020":" 1.5 "},'
            '"aa":{"01-2020":99}}}')
    got = monthly_long(frame(spark, text, '{"actuals":"{}"}', '{"actuals":{"a":{}}}'), "p", keep=["key"],
                       lookups={"rate": "rates"}).collect()
    assert {(r.key, r.series_label) for r in got} == {(0, "zz")}
    assert {r.month_text: (r.value, r.rate) for r in got} == {
        "03-2020": (12.0, "0.5"), "01-2020": (4.0, "2"), "05-2020": (1.0, None), "06-2020": (None, None),
        "07-2020": (None, None), "08-2020": (None, None), "09-2020": (1.5, None)}


def test_members_are_opened_by_a_generate(spark):
    df = frame(spark, "{}")
    for out in (payload_rows(df, "p"), flatten_agencies(df, "p", "ori STRING"), monthly_long(df, "p")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Generate variant_explode" in plan and "Exchange" not in plan and "Join" not in plan
