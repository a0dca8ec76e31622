"""Host context, cluster distributions, class rules, isolated stages and the run report on rows worked out by hand."""

from pyspark.sql import functions as F

from vigil.operators import aggregate as ag
from vigil.operators import classify as cl
from vigil.operators import report as rp
from vigil.operators import scorecard as sc

FINDING = "id string, ord long, scanner string, category string, severity string, title string, description string, risk_score double, metadata string"
LINKED = FINDING + ", correlation_refs array<string>, correlation_type string"


def findings(spark, n=4):
    return spark.createDataFrame([(f"f{i}", i, "s", "c", "info", f"title {i}", "d", 10.0, "{}") for i in range(n)], FINDING)


def correlations(spark):
    return spark.createDataFrame([("k1", 0, "correlation", "c", "low", "t", "d", 30.0, "{}", ["f0", "f1"], "x")], LINKED)


def test_host_context_takes_the_first_bearing_member(spark):
    rows = spark.createDataFrame([
        ("a", 0, None), ("b", 1, '{"kernel": "1", "kernel_version": "2"}'), ("c", 2, '{"distro": "D", "kernel": ""}'),
        ("b", 5, '{"distro": "later"}'), ("d", 3, "no json"), ("e", 4, '{"distro": ""}')], "id string, ord long, metadata string")
    edges = spark.createDataFrame([("k", "a", 1), ("k", "c", 3), ("k", "b", 2), ("l", "d", 1), ("l", "e", 2), ("l", "gone", 3),
                                   ("m", "c", 1), ("m", "b", 1)], "correlation_id string, finding_id string, ord long")
    got = {r[0]: tuple(r[1:]) for r in ag.host_context(edges, rows).collect()}
    assert got == {"k": (3, None, None, None, "1"), "l": (3, None, None, None, None), "m": (2, None, None, None, "1")}
    got = {r.correlation_id: r.kernel for r in ag.host_context(edges, rows, prefer_version=True).collect()}
    assert got == {"k": "2", "l": None, "m": "2"}
    assert ag.host_context(edges.limit(0), rows).count() == 0


def test_distributions_and_rows_aggregated_before(spark):
    rows = spark.createDataFrame([("a", 0, "s", "x", "y_z", 1.0, "{}"), ("b", 1, "s", "x_y", "z", 2.0, "{}"), ("c", 2, "s", "x", "y_z", 3.0, "{}"),
                                  ("d", 3, "s", "x", "y_z", 3.0, '{"type": "t"}')],
                                 "id string, ord long, scanner string, category string, severity string, risk_score double, metadata string")
    got = {r.cluster_key: (r.aggregated_count, r.severity_distribution, r.pattern_summary) for r in ag.aggregate_findings(rows).collect()}
    assert got == {"x_y_z_generic": (3, {"y_z": 2, "z": 1}, {"generic": 3}), "x_y_z_t": (1, {"y_z": 1}, {"t": 1})}
    done = rows.withColumn("metadata", F.lit('{"aggregated_count": 2}'))
    assert ag.aggregate_findings(done) is done and ag.aggregate_findings(rows.limit(0)).count() == 0


def test_longest_listed_path(spark):
    table = {"one": ["/a", "/home/*/x"], "two": ["/a/b/c"]}
    cases = {"/a": "one", "/a/b": "one", "/a/b/c": "two", "/a/b/c/d/e": "two", "/ab": None, "a": None, "": None, "/": None,
             "/home/u/x/y": "one", "/home/u": None, "/a/" + "b/" * 50_000: "one"}
    df = spark.createDataFrame([(p,) for p in cases], "p string")
    assert {r.p: r.c for r in df.select("p", cl.longest_prefix(F.col("p"), table).alias("c")).collect()} == cases


def test_null_commands_and_paths(spark):
    df = spark.createDataFrame([(None, None, None, None), ("x" * 1000, "/srv", None, "[]")], "command string, path string, rule string, metadata string")
    assert [r.process_class for r in cl.classify_processes(df).collect()] == ["edge_case", "edge_case"]
    assert [(r.mode_class, r.class_risk) for r in cl.classify_file_modes(df).collect()] == [("other", 10.0)] * 2
    assert [r.ioc_class for r in cl.classify_indicators(df).collect()] == ["normal", "normal"]


def test_a_failing_stage_is_an_error_row(spark):
    f, c = findings(spark), correlations(spark)
    sound = sc.isolated_stages(f, c)
    assert sorted(sound.drop("error").collect()) == sorted(sc.stage_table(sc.scorecard_metrics(f, c)).collect())
    broken = c.withColumn("correlation_type", F.col("title").cast("int").cast("string"))
    got = {r.stage: r for r in sc.isolated_stages(f, broken).collect()}
    assert len(got) == 5 and [s for s, r in got.items() if r.status == "error"] == ["correlation_validation"]
    bad = got["correlation_validation"]
    assert bad.passed is False and bad.score is None and bad.error
    lost = {r.stage: r.status for r in sc.isolated_stages(f.drop("title"), c).collect()}
    assert lost["quality_scoring"] == "error" and lost["realism_assessment"] != "error"


def test_run_report(spark):
    f, c = findings(spark), correlations(spark)
    got = {(r.section, r.metric): r.value for r in rp.run_report(f, c, sc.scorecard_metrics(f, c), timings={"rules": 1.5}).collect()}
    line = len('{"id":"f0","scanner":"s","severity":"info","title":"title 0"}') + 1
    assert got["data_summary", "total_findings"] == "4" and got["performance_metrics", "data_bytes"] == str(4 * line)
    assert got["data_summary", "correlation_types"] == "1" and got["performance_metrics", "seconds.rules"] == "1.5"
    none = {r.metric: r.value for r in rp.run_report(f.limit(0), c.limit(0), sc.scorecard_metrics(f.limit(0), c.limit(0))).collect()}
    assert none["total_findings"] == "0" and none["data_bytes"] == "0" and none["correlation_types"] == "0"
