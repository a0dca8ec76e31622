"""JSON tokens, answer repair and rebuilt texts, with results written out by hand."""

import json
import re

import pytest
from pyspark.sql import functions as F

from vigil.functions import chat as ch
from vigil.functions import jsontext as jt
from vigil.operators import chatml as cm

DOCUMENTS = ['{}', '[]', '{"a": []}', '{"a": {"b": [1, 2.5, {"c": null}]}, "d": "x, y: [z]"}', '"none"', '  {"k":true}  ',
             '{"q": "a\\"b\\\\", "n": [[], [[]], {}], "u": "é\\u00e9"}', '[{"x": -1e5}, "n/a", null]',
             '{"none": "None", "null": null, "l": ["unknown", "N/A", "na ", "nap", " NULL"]}']


@pytest.mark.parametrize("text", DOCUMENTS)
def test_indented_text_is_that_of_the_standard_library(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(jt.indented(jt.tokens(F.col("t")))).first()[0]
    expected = json.dumps(json.loads(text), indent=2, ensure_ascii=False)
    assert got.replace("-1e5", "-100000.0") == expected


OBJECTS = [d for d in DOCUMENTS if d.strip().startswith("{")] + [
    '{"port": 22 , "user":"a, b: c", "x" : null,"e":""}', "{ }", '{"b": "{}"}', '{"t": "1", "u": true\n}']


@pytest.mark.parametrize("text", OBJECTS)
def test_indented_object_is_the_fold(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    for depth in (0, 2):
        fast, fold = df.select(jt.indented_object(F.col("t"), depth), jt.indented(jt.tokens(F.col("t")), depth)).first()
        assert fast == fold


def test_placeholders_by_hand(spark):
    texts = {
        '{"none": "None", "null": null, "l": ["unknown", "N/A", "na ", "nap", " NULL"]}':
            {"none": "unspecified", "null": "unspecified", "l": ["unspecified", "unspecified", "unspecified", "nap", "unspecified"]},
        '{"a": {"b": [null, {"c": "none"}]}, "s": "say \\"none\\", null, [null]"}':
            {"a": {"b": ["unspecified", {"c": "unspecified"}]}, "s": 'say "none", null, [null]'},
        '"unknown"': "unspecified", "7": 7, "null": "unspecified",
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: json.loads(r.c) for r in df.select("t", jt.indented(jt.cleaned(jt.tokens(F.col("t")))).alias("c")).collect()}
    assert got == texts


def repaired(spark, answer, risk=None, sev=None, cat=None):
    df = spark.createDataFrame([(answer, risk, sev, cat)], "a string, r string, s string, c string")
    return cm.repair_answers(df, *map(F.col, "arsc")).first()["answer"]


@pytest.mark.parametrize(("answer", "fallback", "expected"), [
    ('{"confidence": 0.9, "severity": "low", "risk_score": 41.5, "category": "dns"}', (),
     '{"confidence": 0.9, "severity": "LOW", "risk_score": 42, "category": "dns"}'),
    ('{}', ("77", "high", "ioc"), '{"risk_score": 77, "severity": "HIGH", "category": "ioc"}'),
    (None, (), '{"risk_score": 0, "severity": "INFO", "category": "unspecified"}'),
    ('[1]', ("2.5",), '{"risk_score": 2, "severity": "INFO", "category": "unspecified"}'),
    ('{"severity": "n/a", "x": {"y": [1, "a, b"]}, "category": "None", "risk_score": "abc"}', ("5", "low", "mac"),
     '{"severity": "INFO", "x": {"y": [1, "a, b"]}, "category": "unspecified", "risk_score": 5}'),
    ('{"a": [], "b": {}, "risk_score": null, "severity": ""}', ("", "medium"),
     '{"a": [], "b": {}, "risk_score": 0, "severity": "MEDIUM", "category": "unspecified"}'),
])
def test_answer_repair_by_hand(spark, answer, fallback, expected):
    assert repaired(spark, answer, *fallback) == expected


def chatml(user, assistant):
    return f"<|im_start|>system\nS\n<|im_end|>\n<|im_start|>user\n{user}\n<|im_end|>\n<|im_start|>assistant\n{assistant}\n<|im_end|>"


def answer_of(text):
    return json.loads(re.search(r"<answer>\n(.*)\n</answer>", text, re.S)[1])


def user_of(text):
    return json.loads(re.search(r"<\|im_start\|>user\n(.*?)\n<\|im_end\|>", text, re.S)[1])


def test_rebuilt_texts_by_hand(spark):
    user = '{"severity": "high", "risk_score": 77, "category": "ioc", "host": null}'
    rows = [(1, chatml(user, "<think>t</think><answer>{}</answer>"), None, None, None),
            (2, chatml(user, "<answer>{}</answer>"), 12.0, "low", "dns"),
            (3, None, 1.0, "low", "dns"),
            (4, chatml('Look: {"title": "unknown"} please', "<think>t</think><answer>oops</answer>"), None, None, None),
            (5, chatml("no json", "<think>t</think>"), None, "", None)]
    df = spark.createDataFrame(rows, "id int, text string, risk_score double, severity string, category string")
    got = {r.id: r for r in cm.repair_chatml(df).collect()}
    assert got.keys() == {1, 2, 4, 5}
    assert answer_of(got[1].text) == {"risk_score": 77, "severity": "HIGH", "category": "ioc"}
    assert user_of(got[1].text) == {"severity": "high", "risk_score": 77, "category": "ioc", "host": "unspecified"}
    assert answer_of(got[2].text) == {"risk_score": 12, "severity": "LOW", "category": "dns"}
    assert user_of(got[4].text) == {"title": "unspecified"} and got[4].placeholder_fixed
    assert answer_of(got[5].text) == {"risk_score": 0, "severity": "INFO", "category": "unspecified"}
    assert user_of(got[5].text) == {} and not got[5].placeholder_fixed


def test_prompt_pairs_take_the_row_s_own_values(spark):
    rows = [(1, chatml("u", "<answer>{}</answer>"), 50.0, "high", "ioc"), (2, chatml("u", "<answer>{\"risk_score\": 3}</answer>"), 50.0, "", None),
            (3, chatml("", "x"), 1.0, "low", "a"), (4, chatml("u", "no answer"), None, " low ", "dns")]
    df = spark.createDataFrame(rows, "id int, text string, risk_score double, severity string, category string")
    got = {r.id: tuple(r.ground_truth) for r in cm.prompt_pairs(df).collect()}
    assert got == {1: (50, "HIGH", "ioc"), 2: (3, "INFO", "unspecified"), 4: (0, "LOW", "dns")}


def test_text_operators_stay_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "t", "d", '{"a": 1}', "c", "low", 3.0, chatml("{}", "x"))],
                               "id int, title string, description string, metadata string, category string, severity string, "
                               "risk_score double, text string")
    for out in (cm.sft_texts(df), cm.repair_chatml(df), cm.prompt_pairs(df), cm.chat_messages(df)):
        assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())


def test_user_block(spark):
    rows = [("T", "D", '{"a": {"b": [1]}}'), (None, None, None), ('q"\n', "é", "not json"), ("T", "", "{}"), ("T", "", "[1]")]
    df = spark.createDataFrame(rows, "t string, d string, m string")
    got = [r[0] for r in df.select(ch.user_block_json(F.col("t"), F.col("d"), F.col("m"))).collect()]
    for (t, d, m), text in zip(rows, got, strict=True):
        try:
            meta = json.loads(m) if m else {}
        except ValueError:
            meta = None
        meta = meta if isinstance(meta, dict) else {"raw": m}
        title = t if t is not None else json.loads(text)["title"]
        assert text == json.dumps({"title": title, "description": d or "", "metadata": meta}, indent=2, ensure_ascii=False)


NESTED = ['{}', ' { } ', '{"a": 1}', '{"a":{},"b" : { "c":1 ,"d":"x, {y}: [z] \\"q\\" \\\\"},"e":"}"}', '{"m": {"port": 22,"user": "a"}}',
          '{"none": "None", "x": {"null": null, "u": " unknown ", "s": "say \\"none\\", null, \\n", "n": "nap"}, "y": "n/a"}',
          '{"a": "$1 \\\\ ", "b": {"none": "$2"}, "c": null}', '{"a": {"b": 1}, "c": {"d": "N/A"}, "e": {}}']
OTHER = ['{"a": [1]}', '{"a": {"b": {"c": 1}}}', '{"a": "\\u00e9"}', '{"a": "\\/"}', '[]', '"none"', '{"a": 1} x', '{"a": 1}}', '{"a": 1},',
         '{"a": 1} {"b": 2}', '{"a": {"b": 1}} {"c": 2}', '7']


def test_nested_objects_are_printed_and_cleaned_as_by_tokens(spark):
    """objects of scalars and objects take no fold over their tokens."""
    df = spark.createDataFrame([(t, t in NESTED) for t in NESTED + OTHER], "t string, n boolean")
    t, tokens = F.col("t"), jt.tokens(F.col("t"))
    for depth in (0, 2):
        got = df.select("t", "n", jt.is_nested(t).alias("is"), jt.nested_parts(t, depth).alias("p"), jt.indented(tokens, depth).alias("fold"),
                        jt.indented_object(t, depth).alias("any"), (jt.tokens(jt.cleaned_text(t)) == jt.cleaned(tokens)).alias("clean"))
        for r in got.withColumn("fast", jt.nested_object(F.col("p"), depth)).collect():
            assert r["is"] == r.n, r.t
            assert r.any == r.fold
            if r.n:
                assert r.fast == r.fold and r.clean, r.t


def test_entries_of_objects(spark):
    texts = [t for t in NESTED + OTHER + DOCUMENTS if t.strip().startswith("{")] + ['{"a" :1,"b": "x: \\"y\\", {z}" , "c":null}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", jt.object_entries(F.col("t")).alias("fast"), jt.entries(jt.tokens(F.col("t"))).alias("fold")).collect():
        assert r.fast == r.fold, r.t


def test_long_texts_are_repaired(spark):
    """A string's characters took a stack frame each."""
    long = "x, <y> {z} " * 20_000
    rows = [(1, chatml(json.dumps({"d": long, "m": {"u": None}}), f"<think>{long}</think><answer>{{}}</answer>")),
            (2, chatml(json.dumps({"d": [long, "none"]}), "<think>t</think><answer>{}</answer>"))]
    got = {r.id: r for r in cm.repair_chatml(spark.createDataFrame(rows, "id int, text string")).collect()}
    assert user_of(got[1].text) == {"d": long, "m": {"u": "unspecified"}} and got[1].placeholder_fixed
    assert f"<think>\n{long.strip()}\n</think>" in got[1].text
    assert user_of(got[2].text) == {"d": [long, "unspecified"]}


def test_what_follows_the_user_json_is_repaired_too(spark):
    rows = [(1, chatml('{"a": {"b": 1}} null', "<think>t</think><answer>{}</answer>")), (2, chatml('{"a": {"b": 1}}', "x"))]
    got = {r.id: r for r in cm.repair_chatml(spark.createDataFrame(rows, "id int, text string")).collect()}
    assert '}"unspecified"\n<|im_end|>' in got[1].text and got[1].placeholder_fixed
    assert not got[2].placeholder_fixed


@pytest.mark.parametrize("role", ["system", "user", "assistant"])
def test_blocks_by_hand(spark, role):
    def naive(text):
        mark = f"<|im_start|>{role}"
        return None if text is None or mark not in text else text.split(mark, 1)[1].split("<|im_end|>", 1)[0].strip()

    texts = [None, "", "x", chatml("u < v <|im_", "a <|im_end"), "<|im_start|>user\n", "<|im_start|>user a <|im_start|>user b<|im_end|>c",
             "<|im_end|><|im_start|>assistant\n\u00a0 a<|im_end|", "<|im_start|>system<|im_end|>", "<<|im_start|>usersystem<<|im_end|>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(ch.parse_block(F.col("t"), role)).collect()] == [naive(t) for t in texts]


def test_sections_by_hand(spark):
    texts = ["", "<think>a</think>", "x <THINK>a<b></Think> <think>c</think>", "<think>a <think>b</THINK>", "</think><think>a", "<think></think>",
             "<think>a\n</thin></think", "<<think><</think>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [re.search("<think>(.*?)</think>", t, re.S | re.I) for t in texts]
    assert [r[0] for r in df.select(ch.tag_section(F.col("t"), "think", True)).collect()] == [m and m[1] for m in found]
