"""ChatML validation, repair and rationale on crafted rows with hand-written expectations."""

import json
import re

from pyspark.sql import functions as F

from vigil.functions import chat as ch
from vigil.operators import chatml as cm

GOOD = ("<|im_start|>system\nsys\n<|im_end|>\n<|im_start|>user\n"
        + json.dumps({"title": "t", "metadata": {"user": "None", "x": None, "k": ["n/a", 1]}}, indent=2)
        + "\n<|im_end|>\n<|im_start|>assistant\n<think>\nwhy\n</think>\n<answer>\n"
        + '{"risk_score": 42.5, "severity": "unknown", "category": "null"}' + "\n</answer><|im_end|>")


def test_validation_codes(spark):
    rows = [(1, GOOD), (2, None), (3, "<|im_start|>user\nhello<|im_end|>"),
            (4, "<|im_start|>user\n{bad json}<|im_end|><|im_start|>assistant\n<THINK>x</THINK><answer>{oops</answer>")]
    df = spark.createDataFrame(rows, "k int, text string")
    got = {r["k"]: r["error_codes"] for r in cm.validate_chatml(df).collect()}
    assert got[1] == []
    assert got[2] == ["missing_text"]
    assert got[3] == ["chatml_structure", "user_json_missing", "missing_think", "missing_answer"]
    assert got[4] == ["user_json_parse", "answer_json_parse"]


def test_repair_cleans_placeholders_and_answer(spark):
    df = spark.createDataFrame([(1, GOOD)], "k int, text string")
    r = cm.repair_chatml(df).first()
    assert r["placeholder_fixed"] is True
    user = r["text"].split("<|im_start|>user\n", 1)[1].split("\n<|im_end|>", 1)[0]
    assert json.loads(user)["metadata"] == {"user": "unspecified", "x": "unspecified", "k": ["unspecified", 1]}
    assert '{"risk_score": 42, "severity": "INFO", "category": "unspecified"}' in r["text"]


def test_rationale_branches(spark):
    rows = [("network", "high", "t", '{"port": 22}'), ("suid", "low", "Bin", "{}"),
            ("kernel_params", "medium", "vm.x", '{"param": "kernel.kptr"}'), ("ioc", "info", "T", '{"user": "root"}')]
    df = spark.createDataFrame(rows, "category string, severity string, title string, metadata string")
    got = [r["r"] for r in df.select(ch.build_rationale(F.col("category"), F.col("severity"), F.col("title"),
                                                        ch.meta_fields(F.col("metadata"))).alias("r")).collect()]
    assert got[0].startswith("I am analyzing a high severity finding related to network. The risk score is elevated "
                             "**because** port 22/unknown is exposed")
    assert "the binary 'Bin' has the SUID bit set" in got[1]
    assert "kernel parameter 'kernel.kptr'" in got[2] and "misconfiguration" in got[2]
    assert "scheduled maintenance window" in got[3] and got[3].endswith("**Therefore**, I have classified this as info.")


def test_tag_section_takes_the_first_pair(spark):
    cases = {"<think>a</think><think>b</think>": "a", "x<think></think>": "", "<think>\n<b>\n</think>": "\n<b>\n",
             "</think><think>c": None, "<THINK>d</THINK>": None, "": None, "<think>" + "e<" * 200_000 + "</think>": "e<" * 200_000}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.s for r in df.select("t", ch.tag_section(F.col("t"), "think").alias("s")).collect()} == cases
    assert df.where("t like '<THINK%'").select(ch.tag_section(F.col("t"), "think", True)).first()[0] == "d"
    many = spark.createDataFrame([("<think>" * 200_000,)], "t string")
    assert many.select(ch.tag_section(F.col("t"), "think"), ch.format_reward(F.col("t"), False)).first()[:] == (None, 0.0)


def test_format_reward_is_the_pattern(spark):
    texts = ["<think>a</think> \n<answer>b</answer>", "<think>a</think><answer>b</answer>\n", "x<think></think><answer></answer>y",
             "<think>a</think><answer>b", "<think></answer></think><answer>", "<think>a</think>b</think><answer>c</answer>",
             "<think>a</think><answer>b</answer><answer></answer>", "", "</think><answer></answer><think>",
             "<think>a</think><answer>b</answer>\n\n"]
    strict, loose = (re.compile(p, re.S) for p in (r"<think>.*?</think>\s*<answer>.*?</answer>$", r"<think>.*?</think>\s*<answer>.*?</answer>"))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.s, r.l) for r in df.select("t", ch.format_reward(F.col("t")).alias("s"),
                                              ch.format_reward(F.col("t"), False).alias("l")).collect()}
    assert got == {t: (float(bool(strict.match(t))), float(bool(loose.search(t)))) for t in texts}
