"""The fused verifiers on rows that break rules the driver's tables never break, with issues worked out by hand."""

import json

import pytest

from vigil.operators import verify as V

COLS = "id string, category string, severity string, title string, description string, risk_score double, metadata string, raw string"


def rows(spark, *docs):
    out = []
    for d in docs:
        d = {"id": "x", "category": "c", "severity": "info", "title": "a long title", "description": "a description of it",
             "risk_score": 5.0, "metadata": {}} | d
        out.append((d["id"], d["category"], d["severity"], d["title"], d["description"], float(d["risk_score"]),
                    json.dumps(d["metadata"]), json.dumps(d)))
    return spark.createDataFrame(out, COLS)


def of(issues, *skip):
    return sorted((r.verifier[:-8], r.row_id, r.rule) for r in issues.collect()
                  if not r.rule.startswith(("missing:", "metadata.", "distribution:", "diversity:", *skip)))


def test_rules_that_no_adapter_row_breaks(spark):
    host = {"distro": "d", "distro_version": "1", "package_manager": "p", "kernel": "k", "kb_refs": ["a"]}
    frame = rows(spark,
                 {"id": "a", "probability_actionable": 1.5, "risk_subscores": {"impact": 2, "exposure": "x", "anomaly": 0.5}, "metadata": host},
                 {"id": "b", "severity": "odd", "category": "processes", "metadata": host | {"pid": 100000, "command": "fake_tool"}},
                 {"id": "c", "category": "network", "metadata": host | {"port": 70000, "state": "ODD"}, "title": "t", "description": "d"},
                 {"id": "d", "metadata": "none", "base_severity_score": "high"}, {"id": "e", "description": "x" * 501, "probability_actionable": "p"})
    found = V.run_verifiers(frame, frame.limit(0).withColumn("correlation_refs", V.F.array().cast("array<string>")))
    got = of(found, "too_", "category:", "host_", "repetition:")
    schema = [r[1:] for r in got if r[0] == "Schema"]
    assert schema == sorted([("a", "probability_actionable:range"), ("a", "risk_subscores.confidence:missing"),
                             ("a", "risk_subscores.exposure:not_numeric"), ("a", "risk_subscores.impact:range"),
                             ("b", "invalid_severity"), ("d", "metadata:not_dict"), ("d", "base_severity_score:not_numeric"),
                             ("e", "probability_actionable:not_numeric")])
    realism = [r[1:] for r in got if r[0] == "Realism"]
    assert {("b", "pid"), ("c", "port"), ("c", "socket_state"), ("c", "description_short"), ("c", "title_short"),
            ("e", "description_long"), ("d", "metadata:not_dict")} <= set(realism)
    texts = {(r.row_id, r.rule): r.message for r in found.collect()}
    assert texts["a", "probability_actionable:range"] == \
        "[SchemaVerifier] Finding a: probability_actionable must be between 0 and 1 (got 1.5)"
    assert texts["c", "port"] == "[RealismVerifier] Finding c: Invalid port 70000"
    assert texts["b", "invalid_severity"] == "[SchemaVerifier] Finding b: Invalid severity 'odd'"


def test_group_rules(spark):
    host = {"distro": "d", "distro_version": "1"}
    docs = [{"id": f"g{i}", "category": "c" if i else "other", "severity": "critical" if i < 20 else "low",
             "title": f"Same: {i % 3}", "metadata": host | ({"command": "ls"} if i != 5 else {"command": "ps", "distro": "e"})} for i in range(60)]
    found = V.run_verifiers(rows(spark, *docs), None, ("realism", "abundance"))
    texts = {r.rule: r.message for r in found.where("entity = 'dataset'").collect()}
    assert texts["category:c"] == "[AbundanceVerifier] Category 'c' dominates: 98.3% of findings (max 80.0%)"
    assert texts["title_pattern:Same"] == "[AbundanceVerifier] Over-abundance of similar findings: 'Same' appears 60 times (max 50)"
    assert texts["host_profile"] == "[AbundanceVerifier] Host profile ('d', '1') dominates: 98.3% of findings (max 80.0%)"
    assert texts["repetition:command"] == "[RealismVerifier] Over-repetition of command='ls' (98.3%)"
    assert texts["repetition:distro"] == "[RealismVerifier] Host distro diversity low: d appears 98.3% of findings"
    assert texts["too_many_critical"] == "[AbundanceVerifier] Too many critical findings: 20 (33.3%)"
    assert texts["too_few_info"] == "[AbundanceVerifier] Too few info findings: 0 (0.0%) - should be at least 30%"
    assert texts["diversity:title"] == "[AbundanceVerifier] Low diversity for field 'title': 3/60 unique (5.0%)"
    assert any(k.startswith("identical_metadata:") for k in texts) and "repetition:port" not in texts
    lo, hi = (f"{x:.0%}" for x in V.fixed.REALISM_RANGES["critical"])
    assert texts["distribution:critical"] == f"[RealismVerifier] Severity 'critical' distribution unrealistic: 33.3% (expected {lo}-{hi})"


def test_sets(spark):
    f = rows(spark, {"id": "a", "category": "processes", "severity": "high", "risk_score": 75}, {"id": "a"}, {"id": ""}, {"id": "b", "risk_score": 99})
    f = f.withColumn("correlation_refs", V.F.when(V.F.col("id") == "b", V.F.array(V.F.lit("c1"), V.F.lit("gone"))))
    c = rows(spark, {"id": "c1"}).withColumn("correlation_refs", V.F.array(V.F.lit("a"), V.F.lit("lost")))
    got = of(V.run_verifiers(f, c, ("coherence",)))
    assert got == [("Coherence", "a", "duplicate_id"), ("Coherence", "b", "broken_ref"), ("Coherence", "b", "severity_risk"),
                   ("Coherence", "c1", "broken_ref"), ("Coherence", "dataset", "process_network")]


@pytest.mark.parametrize("names", [("schema",), ("coherence",), ("realism", "abundance"), None])
def test_empty_inputs(spark, names):
    f = rows(spark, {}).limit(0)
    c = f.withColumn("correlation_refs", V.F.array().cast("array<string>"))
    assert {r.row_id for r in V.run_verifiers(f, c, names).collect()} <= {"dataset"}


def test_inputs_are_read_once(spark):
    from vigil.plans.registry import registry
    plan = registry()["verifier_issue_totals"].fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 14


TYPED = ("id string, category string, severity string, title string, description string, risk_score double, metadata string, "
         "probability_actionable double, risk_subscores struct<impact:double,exposure:double>, correlation_refs array<string>")


def test_typed_columns_answer_as_their_document(spark):
    nan, inf = float("nan"), float("inf")
    frame = spark.createDataFrame([
        ("a", "processes", "odd", "t", None, 100.5, '{"distro": "d", "kernel": 5, "pid": 1e6, "kb_refs": ["k"]}', 1.5, (2.0, None), ["a"]),
        ("b", "network", None, None, "d", nan, '{"port": 70000.0, "kb_refs": []}', nan, None, []),
        (None, None, "low", "a title", "x" * 501, inf, "[1]", None, (0.5, nan), None),
        ("", "c", "info", "a title", "a description", None, None, -0.5, (0.5, 0.5), ["b"])], TYPED)
    own = V.F.struct(*[V.F.try_parse_json(c).alias(c) if c == "metadata" else V.F.col(c) for c in frame.columns])
    read = frame.withColumn("raw", V.F.to_json(own, {"ignoreNullFields": "false"}))
    typed, parsed = (sorted(map(str, V.run_verifiers(f, f).collect())) for f in (frame, read))
    assert typed == parsed and len(typed) > 50


def test_row_rules_of_typed_frames_are_compiled(spark):
    """no row is printed and parsed again, and no rule stands in a lambda, which Spark does not compile."""
    f = spark.createDataFrame([], TYPED)
    plan = V.schema_issues(f, f).groupBy("rule").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan.lower() and "json_object_keys" not in plan and "jsonObjectKeys" not in plan
    assert plan.count("StructsToJson") <= 4
