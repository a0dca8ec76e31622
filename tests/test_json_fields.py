"""Null removal, nested criteria, medians and chat forms, with results written out by hand."""

import json
import statistics

import pytest
from pyspark.sql import functions as F

from vigil.operators import aggregate as ag
from vigil.operators import chatml as cm
from vigil.operators import normalize as nz


@pytest.mark.parametrize(("text", "preserve", "expected"), [
    ('{"a": null, "b": 1, "c": null}', (), {"b": 1}),
    ('{"a": null}', (), {}),
    ('{"a": {"b": null, "c": {"d": null}}, "e": [null, {"f": null}], "g": "null, \\"x\\": null"}', (),
     {"a": {"c": {}}, "e": [None, {"f": None}], "g": 'null, "x": null'}),
    ('{"keep": null, "a": {"keep": null, "b": null}, "z": null}', ("keep",), {"keep": None, "a": {"keep": None}}),
    ('{"a": [], "b": null, "c": {}}', (), {"a": [], "c": {}}),
])
def test_null_fields_are_dropped(spark, text, preserve, expected):
    df = spark.createDataFrame([(text,)], "metadata string")
    assert json.loads(nz.drop_null_fields(df, preserve=preserve).first()[0]) == expected


def test_what_is_no_object_stays(spark):
    rows = [(None,), ("text",), ("[null]",), ("",)]
    got = nz.drop_null_fields(spark.createDataFrame(rows, "metadata string")).collect()
    assert [tuple(r) for r in got] == rows


ROWS = [("1", "high", '{"command": "/bin/bash", "port": 22, "in": {"x": [1, 2], "y": true}}', ["a"]),
        ("2", "low", '{"command": "/usr/bin/cron", "port": "22"}', ["a"]), ("3", None, None, None), ("4", "high", "no json", [])]


@pytest.mark.parametrize(("criteria", "expected"), [
    ({"severity": "high"}, {"1", "4"}), ({"severity": ["low", "high"]}, {"1", "2", "4"}), ({}, {"1", "2", "3", "4"}),
    ({"metadata": {"command": "/bin/bash"}, "severity": "high"}, {"1"}), ({"metadata": {"command": "/bin/sh"}}, set()),
    ({"metadata": {"port": 22}}, {"1"}), ({"metadata": {"port": [22, "22"]}}, {"1", "2"}),
    ({"metadata": {"in": {"y": True}}}, {"1"}), ({"metadata": {"in": {"y": "true"}}}, set()),
    ({"metadata": {"in": 1}}, set()), ({"missing": 1}, set()), ({"tags": ["a"]}, set()), ({"severity": {"x": 1}}, set()),
])
def test_nested_criteria(spark, criteria, expected):
    df = spark.createDataFrame(ROWS, "id string, severity string, metadata string, tags array<string>")
    assert {r.id for r in nz.find_related(df, criteria).collect()} == expected


def test_medians(spark):
    groups = {"a": [5.0], "b": [1.0, 2.0], "c": [1.5, 1.25, 1.75, 9.0, -3.5], "d": [2.0] * 5 + [3.0] * 5, "e": [-1.5, -1.25, 0.0, 0.5]}
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [(None, 4.0), ("a", None)]
    df = spark.createDataFrame(rows, "g string, risk_score double")
    got = {r.g: r.median for r in ag.risk_stats(df, "g").collect()}
    groups["a"].append(0.0)
    assert got == {g: pytest.approx(statistics.median(x), abs=0.0051) for g, x in groups.items()} | {None: 4.0}
    assert ag.risk_stats(df).first()["median"] == pytest.approx(statistics.median([x or 0.0 for _, x in rows]), abs=0.006)


def test_chat_forms(spark):
    df = spark.createDataFrame([(1, "T", "D", '{"a": 1}', "net", "low", 41.9, 'say "x"', "", "reply")],
                               "id int, title string, description string, metadata string, category string, severity string, "
                               "risk_score double, rationale string, output string, response string")
    user = {"title": "T", "description": "D", "metadata": {"a": 1}}
    plain = cm.training_messages(df, "json").first().messages
    assert json.loads(plain[2].content) == {"risk_score": 41, "severity": "low", "rationale": 'say "x"', "mitigation_steps": []}
    assert plain[1].content == json.dumps(user, indent=2)
    think = cm.training_messages(df, "think").first().messages
    assert think[1].content == json.dumps(user | {"category": "net"}, indent=2)
    assert think[2].content == '<think>\nsay "x"\n</think>\n<answer>\n{"risk_score": 41, "severity": "low"}\n</answer>'
    assert cm.protocol_texts(df, "P").first().text.endswith("<|im_start|>assistant\nreply<|im_end|>")
    assert cm.protocol_texts(df.withColumn("output", F.lit("own")), "P").first().text.endswith("\nown<|im_end|>")
    with pytest.raises(ValueError):
        cm.training_messages(df, "other")
