"""The compiled correlation rules: which rules fire, isolation of failing ones, scans, and the index of module words."""

import random

import pytest
from pyspark.sql import functions as F

from vigil.operators import correlate as cr
from vigil.sources import tables as tb

SF = "/root/testdata/sf0.001"
SCHEMA = "id string, ord long, scanner string, severity string, title string, metadata string"


def pool(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [("p1", 1, "processes", "high", "P", '{"command": "/bin/netcat -l"}'), ("p2", 2, "processes", "info", "P", None),
        ("n1", 1, "network", "low", "to the command host", '{"port": 4444}'), ("n2", 2, "network", "medium", None, '{"port": "80"}'),
        ("w1", 1, "world_writable", "high", "a Capability", "{}"), ("w2", 2, "world_writable", "low", "x", '{"rule": "file_capability"}'),
        ("s1", 5, "suid", "medium", "s", None), ("s2", 4, "suid", "critical", "s", None), ("s3", 3, "suid", "high", "s", None),
        ("m1", 1, "mac", "low", "mac", '{"enabled": "false"}'), ("i1", 1, "ioc", "critical", "bad 'thing' {}", None),
        ("k1", 1, "kernel_params", "medium", "net.ipv4.tcp_x", None), ("k2", 2, "kernel_params", "high", "icmp rule", None),
        ("k3", 3, "kernel_params", "low", "kernel.ptrace selinux", None), ("d1", 1, "modules", "high", "Module tcp net", None)]


def edges_of(found):
    out = {}
    for r in found[1].collect():
        out.setdefault(r.correlation_id, []).append((r.grp, r.ord, r.finding_id, r.n))
    return {k: [(x[2], x[3]) for x in sorted(v)] for k, v in out.items()}


def test_every_rule_by_hand(spark):
    found = cr.run_rules(pool(spark, ROWS).repartition(3))
    edges = edges_of(found)
    heads = {r.correlation_id: r for r in found[0].collect()}
    one = {i: [(i, 1)] for i in "n1 n2 s1 s2 s3 w1 w2 m1 k1 k2 k3 p1 p2 d1 i1".split()}
    assert edges["process_network_suspicious:p1"] == one["p1"] + one["n2"]
    assert edges["malware_c2:p1"] == one["p1"] and edges["malware_c2:*"] == one["n1"]
    assert edges["unusual_port_usage:p1"] == one["p1"] + one["n1"] and "unusual_port_usage:p2" in edges
    assert edges["suid_world_writable:w1"] == one["w1"] + one["s3"] + one["s2"]
    assert edges["capabilities_weak_mac:*"] == one["w1"] + one["w2"] + one["m1"]
    assert edges["ioc_file_permissions:i1"] == one["i1"] + one["w1"] + one["s3"] + one["s2"]
    assert edges["weak_kernel_security:network_hardening"] == one["k1"] + one["k2"]
    assert edges["module_kernel_conflict:*"] == one["d1"] + one["k1"]
    assert edges["kernel_mac_disabled:*"] == one["k3"] + one["m1"]
    assert edges["kernel_process_suspicious:*"] == one["k3"] + one["p1"]
    assert edges["multi_vector_apt:*"] == one["p1"] + one["p2"] + one["n1"] + one["n2"] + one["w1"] + one["w2"]
    assert edges["temporal_sequence:*"] == one["n1"] + one["n2"] + one["p1"] + one["p2"] + one["k1"]
    assert edges["causal_ioc_process:*"] == one["i1"] + one["p1"] + one["p2"]
    assert heads["ioc_file_permissions:i1"].title == "IOC with file permission vulnerabilities: bad 'thing' {}"
    assert heads["malware_c2:p1"].description == "Process 'netcat -l' showing signs of malware with C2 communications"
    assert heads["weak_kernel_security:network_hardening"].description.endswith("net.ipv4.tcp_x, icmp rule")
    assert set(heads) == {e for e in edges if e != "malware_c2:*"}


def test_rules_that_lack_a_side_give_nothing(spark):
    for scanners in ([], ["processes"], ["network", "mac"], ["kernel_params", "suid"]):
        h, e = cr.run_rules(pool(spark, [r for r in ROWS if r[2] in scanners]))
        assert {r.correlation_type for r in h.collect()} <= {"weak_kernel_security", "temporal_sequence"}
        assert e.where("correlation_id like 'module%' or correlation_id like '%apt%'").count() == 0


def test_lists_hold_the_first_rows_of_many(spark):
    frame = spark.range(5000).select(
        F.concat(F.lit("f"), F.col("id")).alias("id"), (F.col("id") * 7919 % 5003).alias("ord"), F.lit("suid").alias("scanner"),
        F.lit("high").alias("severity"), F.lit("t").alias("title"), F.lit(None).cast("string").alias("metadata"))
    facts = cr.gather_facts(cr.staged(frame), {"some": cr.First(lambda: cr._in("suid"), 5, lambda: F.col("title")),
                                               "none": cr.First(lambda: cr._in("ioc"), 2)})
    assert [o for o, _, _ in facts["some"]] == sorted(i * 7919 % 5003 for i in range(5000))[:5] and facts["none"] == []


def test_a_failing_rule_is_reported_and_the_rest_run(spark):
    broken = cr.Rule("broken", "x", "low", 1, lambda f: True, lambda: F.col("no_such_column") > 1, "t", "d")
    unready = cr.Rule("unready", "x", "low", 1, lambda f: 1 / 0)
    rules = {"broken": broken, "unready": unready, "apart": lambda f: f.select("nowhere"), "j14": cr.RULES["causal_ioc_process"]}
    errors = []
    h, _ = cr.run_rules(pool(spark, ROWS), rules, errors)
    assert [r.correlation_type for r in h.collect()] == ["causal_ioc_process"]
    assert [name for name, _ in errors] == ["apart", "unready", "broken"]
    with pytest.raises(Exception, match="no_such_column"):
        cr.run_rules(pool(spark, ROWS), {"broken": broken})


def test_rules_of_other_forms_join_in(spark):
    def own(findings):
        return findings.limit(1).select(*[F.lit("1").cast(c.split()[1]).alias(c.split()[0]) for c in cr._HEADER.split(", ")]), \
            findings.limit(2).select(*[F.lit("1").cast(c.split()[1]).alias(c.split()[0]) for c in cr._EDGE.split(", ")])
    h, e = cr.run_rules(pool(spark, ROWS), {"own": own})
    assert h.count() == 1 and e.count() == 2


def test_module_words_against_a_search(spark):
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abc_") for _ in range(rng.randint(0, 5))) for _ in range(60)} | {""})
    titles = [(f"t{i}", i, "".join(rng.choice("abc_.") for _ in range(rng.randint(0, 30)))) for i in range(80)]
    got = cr.title_hits(spark.createDataFrame(titles, "id string, ord long, pt string"), spark.createDataFrame([(w,) for w in words], "w string"))
    assert sorted((r.id, r.w) for r in got.collect()) == sorted((i, w) for i, _, t in titles for w in words if w in t)


def test_three_scans_whatever_the_rules(spark):
    """The frames that come back read the written rows, not the findings."""
    h, e = cr.run_rules(tb.exposed_findings(spark, SF))
    for frame in (h, e):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "events.parquet" not in plan and "props" not in plan
    assert {r[0] for r in h.select("correlation_type").distinct().collect()} == set(cr.RULES)


def test_plans_after_the_first_pass_are_short_and_read_what_it_wrote(spark, monkeypatch):
    """The driver keeps every plan: only the first one holds the findings' own columns."""
    plans, keep = {}, cr.written

    def noted(df, name, by=None):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, name, by)

    monkeypatch.setattr(cr, "written", noted)
    cr.run_rules(pool(spark, ROWS).withColumn("title", F.concat("title", F.lit("mark of the input"))))
    assert "mark of the input" in plans["staged"]
    assert "mark of the input" not in plans["rules"] and len(plans["rules"]) < 12_000


def test_returned_plans_hold_neither_the_joins_of_j9_nor_the_rules(spark, monkeypatch):
    """The driver plans again at each stage; what comes back is a union of written rows. Only the first plan repeats itself
    in the branches of the findings' union, and it holds no rule."""
    plans, keep = {}, cr.written

    def noted(df, name, by=None):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return keep(df, name, by)

    monkeypatch.setattr(cr, "written", noted)
    h, e = cr.run_rules(tb.exposed_findings(spark, SF))
    for frame in (h, e):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert not any(word in plan for word in ("Join", "Aggregate", "Generate"))
    assert "backdoor" not in plans["staged"] and plans["marked"].count("backdoor") == 1


def test_modules_without_a_parameter_give_nothing(spark):
    rows = [r for r in ROWS if r[2] != "modules"] + [("d1", 1, "modules", "high", "Module zzz", None)]
    h, e = cr.run_rules(pool(spark, rows))
    assert e.where("correlation_id like 'module%'").count() == 0 and h.where("correlation_type like 'module%'").count() == 0


def test_rows_of_one_ord_do_not_all_reach_the_driver(spark, monkeypatch):
    frame = spark.range(5000).select(
        F.concat(F.lit("f"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("id"), F.lit(7).cast("long").alias("ord"),
        F.lit("suid").alias("scanner"), F.lit("high").alias("severity"), F.lit("t").alias("title"),
        F.lit(None).cast("string").alias("metadata")).repartition(4)
    seen, collect = [], type(frame).collect

    def noted(df):
        seen.append(collect(df))
        return seen[-1]

    monkeypatch.setattr(type(frame), "collect", noted)
    facts = cr.gather_facts(cr.staged(frame), {"some": cr.First(lambda: cr._in("suid"), 3, lambda: F.col("title")),
                                               "one": cr.First(lambda: cr._in("suid"))})
    assert facts == {"some": [(7, f"f0000{i}", "t") for i in range(3)], "one": [(7, "f00000", None)]}
    assert max(len(str(rows)) for rows in seen) < 2000
