"""DuckDB SQL for the adapters, shared by every oracle query.

Mirrors ``vigil.sources.tables`` exactly (same ids, bands, texts and JSON),
so each oracle query is ``WITH <adapters> <body>``.
"""

FINDINGS_CTE = """
ev AS (
  SELECT 'evt_' || CAST(event_id AS VARCHAR) AS id,
         event_id AS ord, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS port,
         CASE event_type WHEN 'click' THEN 'processes' WHEN 'view' THEN 'network'
              WHEN 'error' THEN 'ioc' WHEN 'signup' THEN 'suid'
              WHEN 'purchase' THEN 'world_writable' ELSE 'unknown' END AS scanner,
         CAST(FLOOR(value) AS DOUBLE) AS risk_score
  FROM events
),
findings AS (
  SELECT ev.*, scanner AS category,
         CASE WHEN risk_score < 20 THEN 'info' WHEN risk_score < 40 THEN 'low'
              WHEN risk_score < 70 THEN 'medium' WHEN risk_score < 90 THEN 'high'
              ELSE 'critical' END AS severity,
         upper(substr(event_type, 1, 1)) || substr(event_type, 2) || ' event on port '
           || CAST(port AS VARCHAR) || ': user ' || CAST(user_id AS VARCHAR) AS title,
         'Event ' || CAST(ord AS VARCHAR) || ' of type ' || event_type || ' by user '
           || CAST(user_id AS VARCHAR) || ' on port ' || CAST(port AS VARCHAR) AS description,
         CAST(json_object('port', port, 'user', user_id) AS VARCHAR) AS metadata,
         round(least(1.0, risk_score / 100.0), 3) AS probability_actionable
  FROM ev
)"""

EDGES_CTE = """
edges AS (
  SELECT 'corr_' || CAST(l_orderkey AS VARCHAR) AS correlation_id,
         'evt_' || CAST(l_partkey * 5 + l_linenumber AS VARCHAR) AS finding_id,
         l_linenumber AS pos, l_orderkey AS orderkey
  FROM lineitem
)"""

CORRELATIONS_CTE = EDGES_CTE + """,
corr_refs AS (
  SELECT orderkey, list(finding_id ORDER BY pos, finding_id) AS correlation_refs
  FROM edges GROUP BY orderkey
),
correlations AS (
  SELECT 'corr_' || CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS orderkey, o_orderkey AS ord,
         CASE o_orderstatus WHEN 'O' THEN 'process_network' WHEN 'F' THEN 'filesystem'
              WHEN 'P' THEN 'kernel' ELSE 'unknown' END AS correlation_type,
         CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 95.0 WHEN '2-HIGH' THEN 80.0
              WHEN '3-MEDIUM' THEN 55.0 WHEN '4-NOT SPECIFIED' THEN 30.0
              WHEN '5-LOW' THEN 10.0 ELSE 50.0 END AS DOUBLE) AS risk_score,
         coalesce(r.correlation_refs, []::VARCHAR[]) AS correlation_refs,
         '{}' AS metadata
  FROM orders o LEFT JOIN corr_refs r ON r.orderkey = o.o_orderkey
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _band_ok(bands: dict, risk: str = "risk_score", unknown: str = "TRUE") -> str:
    whens = " ".join(f"WHEN '{k}' THEN ({risk} BETWEEN {lo} AND {hi} AND NOT isnan({risk}))"
                     for k, (lo, hi) in bands.items())
    return f"(CASE severity {whens} ELSE {unknown} END)"


def _weight(col: str) -> str:
    from vigil.functions import fixed
    whens = " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in fixed.SEVERITY_WEIGHTS.items())
    return f"(CASE {col} {whens} ELSE CAST({fixed.SEVERITY_WEIGHT_DEFAULT} AS DOUBLE) END)"


def scorecard_ctes() -> str:
    from vigil.functions import fixed
    exp = fixed.REALISM_EXPECTED
    realism_terms = " + ".join(
        f"(1.0 - least(abs({s} / total - {e}) * 2, 1.0))" for s, e in exp.items())
    realism_flags = " + ".join(
        f"(CASE WHEN abs({s} / total - {e}) > 0.15 THEN 1 ELSE 0 END)" for s, e in exp.items())
    return f""",
ids AS (SELECT id FROM findings UNION ALL SELECT id FROM correlations),
m_dup AS (SELECT CAST(coalesce(sum(n - 1), 0) AS DOUBLE) AS duplicate_ids
          FROM (SELECT id, count(*) AS n FROM ids GROUP BY id) t),
m_band AS (SELECT CAST(count(*) FILTER (WHERE NOT {_band_ok(fixed.SCORECARD_BANDS)}) AS DOUBLE)
                  AS severity_inconsistencies FROM findings),
m_broken AS (SELECT CAST(count(*) AS DOUBLE) AS broken_correlations
             FROM (SELECT unnest(correlation_refs) AS ref FROM correlations) r
             WHERE NOT EXISTS (SELECT 1 FROM ids WHERE ids.id = r.ref)),
sev_counts AS (
  SELECT CAST(count(*) AS DOUBLE) AS total,
         {", ".join(f"CAST(count(*) FILTER (WHERE severity = '{s}') AS DOUBLE) AS {s}" for s in fixed.SEVERITIES)}
  FROM findings),
m_real AS (
  SELECT total,
         CASE WHEN total = 0 THEN 0.0 ELSE
           ({realism_terms}) / {len(exp)}
           * (CASE WHEN critical > total * 0.1 THEN 0.8 ELSE 1.0 END)
           * (CASE WHEN info < total * 0.2 THEN 0.9 ELSE 1.0 END) END AS realism_score,
         CASE WHEN total = 0 THEN 1 ELSE {realism_flags}
           + (CASE WHEN critical > total * 0.1 THEN 1 ELSE 0 END)
           + (CASE WHEN info < total * 0.2 THEN 1 ELSE 0 END) END AS issues
  FROM sev_counts),
fbi AS (SELECT id, arg_max(severity, ord) AS ref_severity FROM findings GROUP BY id),
cq_agg AS (
  SELECT e.correlation_id, count(*) AS n_refs, count(f.ref_severity) AS found,
         sum(CASE WHEN f.ref_severity IS NULL THEN 0.0 ELSE {_weight('f.ref_severity')} END) AS wsum
  FROM (SELECT id AS correlation_id, unnest(correlation_refs) AS ref FROM correlations) e
  LEFT JOIN fbi f ON f.id = e.ref
  GROUP BY e.correlation_id),
cq AS (
  SELECT c.id AS correlation_id, coalesce(a.n_refs, 0) AS n_refs, coalesce(a.found, 0) AS found,
         CAST(CASE WHEN coalesce(a.n_refs, 0) = 0 THEN 0.0
              ELSE least((CASE WHEN a.found < a.n_refs THEN 0.8 ELSE 1.0 END)
                         * (0.5 + a.wsum / a.n_refs * 0.5), 1.0) END AS DOUBLE) AS quality
  FROM correlations c LEFT JOIN cq_agg a ON a.correlation_id = c.id),
m_cq AS (SELECT CAST(count(*) AS DOUBLE) AS correlations, coalesce(avg(quality), 0.0) AS correlation_quality_score FROM cq),
m_red AS (SELECT CAST(coalesce(sum(n - 1), 0) AS DOUBLE) AS redundant
          FROM (SELECT list_sort(correlation_refs) AS refs, coalesce(correlation_type, '') AS ctype, count(*) AS n
                FROM correlations GROUP BY ALL) t),
per_scanner AS (SELECT scanner, count(*) AS n, count(DISTINCT coalesce(title, '')) AS u FROM findings GROUP BY scanner),
m_div AS (SELECT CAST(count(*) AS DOUBLE) AS scanner_coverage,
                 CASE WHEN count(*) = 0 THEN 0.0
                      ELSE (least(count(*) / {float(fixed.SCANNER_NORMALISER)}, 1.0) + avg(least(u / n, 1.0))) / 2 END
                   AS diversity_score FROM per_scanner),
m_stats AS (
  SELECT CAST(count(*) AS DOUBLE) AS total_findings,
         CASE WHEN count(*) = 0 THEN 0.0 ELSE 1.0 END AS completeness_score,
         CASE WHEN count(*) FILTER (WHERE v) = 0 THEN 0.0 ELSE
           greatest(0.0, 1.0 - (abs(avg(risk_score) FILTER (WHERE v) - 50) / 50
             + least(abs(coalesce(stddev_samp(risk_score) FILTER (WHERE v), 0.0) - 20) / 20, 1.0)) / 2) END
           AS consistency_score
  FROM (SELECT risk_score, (risk_score BETWEEN 0 AND 100 AND NOT isnan(risk_score)) AS v FROM findings) t),
m_cov AS (SELECT CAST(count(DISTINCT ref) AS DOUBLE) AS distinct_refs
          FROM (SELECT unnest(correlation_refs) AS ref FROM correlations) t),
m_schema AS (SELECT (SELECT count(*) FROM findings) + (SELECT count(*) FROM correlations) AS total),
metrics AS (
  SELECT 'schema_validation' AS stage, 'total_findings' AS metric, CAST(total AS DOUBLE) AS value FROM m_schema
  UNION ALL SELECT 'schema_validation', 'valid_findings', CAST(total AS DOUBLE) FROM m_schema
  UNION ALL SELECT 'schema_validation', 'invalid_findings', 0.0 FROM m_schema
  UNION ALL SELECT 'consistency_check', 'duplicate_ids', duplicate_ids FROM m_dup
  UNION ALL SELECT 'consistency_check', 'severity_inconsistencies', severity_inconsistencies FROM m_band
  UNION ALL SELECT 'consistency_check', 'broken_correlations', broken_correlations FROM m_broken
  UNION ALL SELECT 'realism_assessment', 'realism_score', realism_score FROM m_real
  UNION ALL SELECT 'realism_assessment', 'issues', CAST(issues AS DOUBLE) FROM m_real
  UNION ALL SELECT 'realism_assessment', 'total', total FROM m_real
  UNION ALL SELECT 'correlation_validation', 'correlation_quality_score', correlation_quality_score FROM m_cq
  UNION ALL SELECT 'correlation_validation', 'correlations', correlations FROM m_cq
  UNION ALL SELECT 'correlation_validation', 'redundant', redundant FROM m_red
  UNION ALL SELECT 'quality_scoring', 'diversity_score', diversity_score FROM m_div
  UNION ALL SELECT 'quality_scoring', 'scanner_coverage', scanner_coverage FROM m_div
  UNION ALL SELECT 'quality_scoring', 'completeness_score', completeness_score FROM m_stats
  UNION ALL SELECT 'quality_scoring', 'consistency_score', consistency_score FROM m_stats
  UNION ALL SELECT 'quality_scoring', 'total_findings', total_findings FROM m_stats
  UNION ALL SELECT 'quality_scoring', 'distinct_refs', distinct_refs FROM m_cov
),
w AS (
  SELECT
    (SELECT value FROM metrics WHERE stage = 'schema_validation' AND metric = 'invalid_findings') AS invalid,
    ((SELECT CASE WHEN duplicate_ids > 0 THEN 1 ELSE 0 END FROM m_dup)
     + (SELECT CASE WHEN severity_inconsistencies > 0 THEN 1 ELSE 0 END FROM m_band)
     + (SELECT CASE WHEN broken_correlations > 0 THEN 1 ELSE 0 END FROM m_broken)) AS issues_c,
    (SELECT realism_score FROM m_real) AS realism, (SELECT total FROM m_real) AS total,
    (SELECT correlation_quality_score FROM m_cq) AS cq, (SELECT correlations FROM m_cq) AS n_corr,
    ((SELECT diversity_score FROM m_div) + (SELECT completeness_score FROM m_stats)
      + (SELECT consistency_score FROM m_stats)
      + (SELECT CASE WHEN total_findings = 0 THEN 0.0 ELSE least(distinct_refs / total_findings, 1.0) END
         FROM m_cov, m_stats)) / 4 AS overall_q
),
stages AS (
  SELECT 'schema_validation' AS stage, CASE WHEN invalid = 0 THEN 'passed' ELSE 'failed' END AS status,
         invalid = 0 AS passed, CAST(invalid AS DOUBLE) AS score FROM w
  UNION ALL SELECT 'consistency_check',
         CASE WHEN issues_c = 0 THEN 'passed' WHEN issues_c <= 2 THEN 'warning' ELSE 'failed' END,
         issues_c = 0, CAST(issues_c AS DOUBLE) FROM w
  UNION ALL SELECT 'realism_assessment',
         CASE WHEN total = 0 THEN 'failed' WHEN realism < 0.5 THEN 'failed' WHEN realism < 0.7 THEN 'warning'
              ELSE 'passed' END,
         total > 0 AND realism >= 0.5, CAST(realism AS DOUBLE) FROM w
  UNION ALL SELECT 'correlation_validation',
         CASE WHEN n_corr = 0 THEN 'passed' WHEN cq < 0.4 THEN 'failed' WHEN cq < 0.6 THEN 'warning'
              ELSE 'passed' END,
         n_corr = 0 OR cq >= 0.4, CAST(CASE WHEN n_corr = 0 THEN 0.0 ELSE cq END AS DOUBLE) FROM w
  UNION ALL SELECT 'quality_scoring',
         CASE WHEN overall_q >= 0.7 THEN 'passed' WHEN overall_q >= 0.5 THEN 'warning' ELSE 'failed' END,
         overall_q >= 0.7, CAST(overall_q AS DOUBLE) FROM w
)
"""


def py_token(meta: str, key: str) -> str:
    """SQL for Python str(metadata.get(key, '')) over JSON text."""
    v = f"json_extract_string({meta}, '$.{key}')"
    return (f"(CASE WHEN {v} IS NULL THEN (CASE WHEN list_contains(coalesce(json_keys({meta}), []), '{key}') "
            f"THEN 'None' ELSE '' END) WHEN {v} = 'true' THEN 'True' WHEN {v} = 'false' THEN 'False' ELSE {v} END)")


def dedup_pattern_sql() -> str:
    from vigil.functions import fixed
    toks = [py_token("metadata", k) for k in fixed.PATTERN_KEYS]
    base = ("coalesce(category, 'unknown') || ':' || coalesce(severity, 'unknown') || ':' || "
            + " || '|' || ".join(toks))
    empty = " AND ".join(f"{t} = ''" for t in toks)
    digest = "substr(md5(coalesce(title, '') || '|' || coalesce(description, '')), 1, 8)"
    return f"(CASE WHEN {empty} THEN {base} || ':' || {digest} ELSE {base} END)"


def cluster_pattern_sql() -> str:
    from vigil.functions import fixed
    parts = []
    for k in fixed.PATTERN_KEYS:
        v = f"json_extract_string(metadata, '$.{k}')"
        parts.append(f"(CASE WHEN {v} IS NOT NULL AND {v} NOT IN ('', 'false', '0', '0.0', '[]', '{{}}') "
                     f"THEN (CASE WHEN {v} = 'true' THEN 'True' ELSE {v} END) END)")
    joined = f"concat_ws('|', {', '.join(parts)})"
    return f"(CASE WHEN {joined} = '' THEN 'generic' ELSE {joined} END)"

HOST_FINDINGS_CTE = FINDINGS_CTE + """,
kp AS (
  SELECT 'kp_' || CAST(p_partkey AS VARCHAR) AS id, p_partkey AS ord, 'kernel_params' AS scanner,
         'kernel_params' AS category,
         CASE p_type WHEN 'ECONOMY' THEN 'net.ipv4.tcp' WHEN 'STANDARD' THEN 'vm.mmap'
              WHEN 'LARGE' THEN 'fs.protected' WHEN 'SMALL' THEN 'kernel.randomize'
              WHEN 'PROMO' THEN 'kernel.yama.ptrace' WHEN 'MEDIUM' THEN 'security.selinux'
              ELSE 'kernel' END || '.' || replace(p_name, ' ', '_') AS title,
         CAST(p_size * 2 AS DOUBLE) AS risk_score, '{}' AS metadata
  FROM part),
mods AS (
  SELECT 'mod_' || CAST(s_suppkey AS VARCHAR) AS id, s_suppkey AS ord, 'modules' AS scanner, 'modules' AS category,
         'Module ' || coalesce(split_part(p.p_name, ' ', 1), 'unknown') AS title,
         CAST(floor(s_acctbal / 100) AS DOUBLE) AS risk_score, '{}' AS metadata
  FROM supplier s LEFT JOIN part p ON p.p_partkey = s.s_suppkey),
macs AS (
  SELECT 'mac_' || CAST(c_custkey AS VARCHAR) AS id, c_custkey AS ord, 'mac' AS scanner, 'mac' AS category,
         'MAC status ' || lower(c_mktsegment) AS title, CAST(c_nationkey * 4 AS DOUBLE) AS risk_score,
         CASE WHEN c_acctbal < 0 THEN '{"enabled":"false"}' ELSE '{"enabled":"true"}' END AS metadata
  FROM customer),
hf AS (
  SELECT id, ord, scanner, category, title, severity, risk_score, metadata FROM findings
  UNION ALL
  SELECT id, ord, scanner, category, title,
         CASE WHEN risk_score < 20 THEN 'info' WHEN risk_score < 40 THEN 'low'
              WHEN risk_score < 70 THEN 'medium' WHEN risk_score < 90 THEN 'high' ELSE 'critical' END AS severity,
         risk_score, metadata
  FROM (SELECT * FROM kp UNION ALL SELECT * FROM mods UNION ALL SELECT * FROM macs) x
)"""


def _contains_any(col: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


#: ``hx``: ``hf`` and the rows of ``exposed_findings``.
EXPOSED_FINDINGS_CTE = HOST_FINDINGS_CTE + """,
exposed AS (
  SELECT 'proc_' || s_suppkey AS id, s_suppkey + 1000000000 AS ord, 'processes' AS scanner, 'Process of ' || s_name AS title,
         CAST(s_suppkey % 100 AS DOUBLE) AS risk_score,
         '{"command":"/usr/bin/' || CASE s_suppkey % 10 WHEN 0 THEN 'netcat' WHEN 1 THEN 'xcryptominer' ELSE 'worker' END
           || ' --listen"}' AS metadata FROM supplier
  UNION ALL
  SELECT 'net_' || c_custkey, c_custkey + 1000000000, 'network',
         CASE WHEN c_nationkey < 5 THEN 'Connection to command server' ELSE 'Connection to host' END,
         CAST(c_nationkey * 4 AS DOUBLE), '{"port":' || (c_custkey * 37 % 4096) || '}' FROM customer
  UNION ALL
  SELECT 'cap_' || s_suppkey, s_suppkey + 1000000000, 'world_writable',
         CASE WHEN s_suppkey % 8 = 0 THEN 'File capability found' ELSE 'Extended file attribute' END,
         CAST(s_suppkey % 100 AS DOUBLE),
         '{"rule":"' || CASE WHEN s_suppkey % 12 = 0 THEN 'file_capability' ELSE 'attribute' END || '"}'
  FROM supplier WHERE s_suppkey % 4 = 0),
hx AS (
  SELECT * FROM hf UNION ALL
  SELECT id, ord, scanner, scanner AS category, title,
         CASE WHEN risk_score < 20 THEN 'info' WHEN risk_score < 40 THEN 'low'
              WHEN risk_score < 70 THEN 'medium' WHEN risk_score < 90 THEN 'high' ELSE 'critical' END AS severity,
         risk_score, metadata FROM exposed)"""


def rules_ctes(pool: str = "hf") -> str:
    """DuckDB form of the correlation rules over the pooled table (edges + headers)."""
    from vigil.operators import correlate as C
    pname = "regexp_extract(coalesce(json_extract_string(metadata, '$.command'), ''), '[^/]*$')"
    lt = "lower(coalesce(title, ''))"
    cls = " ".join(f"WHEN {_contains_any(lt, ws)} THEN '{n}'" for n, ws in C.PARAM_CLASSES)
    mal = _contains_any(f"lower({pname})", C.MALWARE_PATTERNS)
    c2 = _contains_any(lt, C.C2_WORDS)
    macw = _contains_any(lt, C.MAC_PARAM_WORDS)
    procw = _contains_any(lt, C.PROCESS_PARAM_WORDS)
    return f""",
rp AS (SELECT * FROM {pool} WHERE scanner = 'processes'),
rn AS (SELECT * FROM {pool} WHERE scanner = 'network'),
rww AS (SELECT * FROM {pool} WHERE scanner = 'world_writable'),
rsu AS (SELECT * FROM {pool} WHERE scanner = 'suid'),
rio AS (SELECT * FROM {pool} WHERE scanner = 'ioc'),
rmc AS (SELECT * FROM {pool} WHERE scanner = 'mac'),
rkp AS (SELECT * FROM {pool} WHERE scanner = 'kernel_params'),
rmd AS (SELECT * FROM {pool} WHERE scanner = 'modules'),
mac_off AS (SELECT 1 FROM rmc WHERE json_extract_string(metadata, '$.enabled') = 'false' OR severity = 'medium'),
net3 AS (SELECT id, row_number() OVER (ORDER BY ord) - 1 AS pos FROM
           (SELECT * FROM rn WHERE severity IN ('medium', 'high', 'critical') ORDER BY ord LIMIT 3) t),
j2p AS (SELECT id, {pname} AS pn FROM rp WHERE severity IN ('medium', 'high', 'critical') AND EXISTS (SELECT 1 FROM net3)),
c2 AS (SELECT id, ord FROM rn WHERE {c2}),
j3p AS (SELECT id, {pname} AS pn FROM rp WHERE {mal} AND EXISTS (SELECT 1 FROM c2)),
unus AS (SELECT id, row_number() OVER (ORDER BY ord) - 1 AS pos FROM
           (SELECT * FROM rn WHERE TRY_CAST(json_extract_string(metadata, '$.port') AS DOUBLE) > 1024
              AND severity IN ('low', 'medium') ORDER BY ord LIMIT 2) t),
j4p AS (SELECT id, {pname} AS pn FROM rp WHERE EXISTS (SELECT 1 FROM unus)),
suid2 AS (SELECT id, row_number() OVER (ORDER BY ord) - 1 AS pos FROM
           (SELECT * FROM rsu WHERE severity IN ('medium', 'high', 'critical') ORDER BY ord LIMIT 2) t),
j5w AS (SELECT id FROM rww WHERE severity IN ('high', 'critical') AND EXISTS (SELECT 1 FROM suid2)),
cap AS (SELECT id, ord FROM rww WHERE contains({lt}, 'capability')
          OR json_extract_string(metadata, '$.rule') = 'file_capability'),
j6 AS (SELECT 1 AS f WHERE EXISTS (SELECT 1 FROM cap) AND EXISTS (SELECT 1 FROM mac_off)),
files3 AS (SELECT id, row_number() OVER (ORDER BY g, ord) - 1 AS pos FROM
           (SELECT id, ord, CASE WHEN scanner = 'world_writable' THEN 0 ELSE 1 END AS g FROM {pool}
            WHERE scanner IN ('world_writable', 'suid') AND severity IN ('medium', 'high', 'critical')
            ORDER BY g, ord LIMIT 3) t),
j7i AS (SELECT id, coalesce(title, '') AS t FROM rio WHERE severity IN ('high', 'critical') AND EXISTS (SELECT 1 FROM files3)),
kpc AS (SELECT *, CASE {cls} END AS cls FROM rkp),
weak AS (SELECT * FROM kpc WHERE cls IS NOT NULL AND severity IN ('medium', 'high')),
weak_cls AS (SELECT cls FROM weak GROUP BY cls HAVING count(*) >= 2),
secmod AS (SELECT id, ord, title, lower(replace(coalesce(title, ''), 'Module ', '')) AS name FROM rmd
           WHERE severity IN ('medium', 'high')),
modw AS (SELECT id, name AS w FROM secmod
         UNION SELECT id, w FROM (SELECT id, unnest(string_split_regex(trim(name), '\\s+')) AS w FROM secmod) t
         WHERE w <> ''),
pairs AS (SELECT DISTINCT m.id AS mid, k.id AS pid, k.ord AS pord FROM modw m JOIN rkp k
          ON contains(lower(coalesce(k.title, '')), m.w)),
pp AS (SELECT pid, pord, count(*) AS n FROM pairs GROUP BY pid, pord),
j9 AS (SELECT 1 AS f WHERE EXISTS (SELECT 1 FROM secmod) AND EXISTS (SELECT 1 FROM pp)),
macp AS (SELECT id, ord FROM rkp WHERE {macw}),
j10 AS (SELECT 1 AS f WHERE EXISTS (SELECT 1 FROM macp) AND EXISTS (SELECT 1 FROM mac_off)),
procp AS (SELECT id, ord FROM rkp WHERE {procw}),
susp AS (SELECT id, ord, {pname} AS pn FROM rp WHERE severity IN ('medium', 'high', 'critical')),
j11 AS (SELECT 1 AS f WHERE EXISTS (SELECT 1 FROM procp) AND EXISTS (SELECT 1 FROM susp)),
j12 AS (SELECT 1 AS f WHERE EXISTS (SELECT 1 FROM rp) AND EXISTS (SELECT 1 FROM rn) AND EXISTS (SELECT 1 FROM rww)),
flat AS (SELECT id, ord, CASE scanner WHEN 'network' THEN 0 WHEN 'processes' THEN 1 ELSE 2 END AS g
         FROM {pool} WHERE scanner IN ('network', 'processes', 'kernel_params')),
j13 AS (SELECT 1 AS f WHERE (SELECT count(*) FROM flat) >= 3),
first5 AS (SELECT * FROM flat ORDER BY g, ord LIMIT 5),
j14 AS (SELECT 1 AS f WHERE EXISTS (SELECT 1 FROM rio) AND EXISTS (SELECT 1 FROM rp)),
edges_all AS (
  SELECT 'process_network_suspicious:' || id AS correlation_id, id AS finding_id, 0 AS grp, CAST(0 AS BIGINT) AS ord, CAST(1 AS BIGINT) AS n FROM j2p
  UNION ALL SELECT 'process_network_suspicious:' || p.id, n.id, 1, n.pos, 1 FROM j2p p, net3 n
  UNION ALL SELECT 'malware_c2:' || id, id, 0, 0, 1 FROM j3p
  UNION ALL SELECT 'malware_c2:*', id, 1, ord, 1 FROM c2 WHERE EXISTS (SELECT 1 FROM j3p)
  UNION ALL SELECT 'unusual_port_usage:' || id, id, 0, 0, 1 FROM j4p
  UNION ALL SELECT 'unusual_port_usage:' || p.id, u.id, 1, u.pos, 1 FROM j4p p, unus u
  UNION ALL SELECT 'suid_world_writable:' || id, id, 0, 0, 1 FROM j5w
  UNION ALL SELECT 'suid_world_writable:' || w.id, s.id, 1, s.pos, 1 FROM j5w w, suid2 s
  UNION ALL SELECT 'capabilities_weak_mac:*', id, 0, ord, 1 FROM cap WHERE EXISTS (SELECT 1 FROM j6)
  UNION ALL SELECT 'capabilities_weak_mac:*', id, 1, ord, 1 FROM rmc WHERE EXISTS (SELECT 1 FROM j6)
  UNION ALL SELECT 'ioc_file_permissions:' || id, id, 0, 0, 1 FROM j7i
  UNION ALL SELECT 'ioc_file_permissions:' || i.id, f.id, 1, f.pos, 1 FROM j7i i, files3 f
  UNION ALL SELECT 'weak_kernel_security:' || cls, id, 0, ord, 1 FROM weak WHERE cls IN (SELECT cls FROM weak_cls)
  UNION ALL SELECT 'module_kernel_conflict:*', id, 0, ord, 1 FROM secmod WHERE EXISTS (SELECT 1 FROM j9)
  UNION ALL SELECT 'module_kernel_conflict:*', pid, 1, pord, n FROM pp WHERE EXISTS (SELECT 1 FROM j9)
  UNION ALL SELECT 'kernel_mac_disabled:*', id, 0, ord, 1 FROM macp WHERE EXISTS (SELECT 1 FROM j10)
  UNION ALL SELECT 'kernel_mac_disabled:*', id, 1, ord, 1 FROM rmc WHERE EXISTS (SELECT 1 FROM j10)
  UNION ALL SELECT 'kernel_process_suspicious:*', id, 0, ord, 1 FROM procp WHERE EXISTS (SELECT 1 FROM j11)
  UNION ALL SELECT 'kernel_process_suspicious:*', id, 1, ord, 1 FROM susp WHERE EXISTS (SELECT 1 FROM j11)
  UNION ALL SELECT 'multi_vector_apt:*', id, CASE scanner WHEN 'processes' THEN 0 WHEN 'network' THEN 1 ELSE 2 END,
                   ord, 1 FROM {pool}
            WHERE scanner IN ('processes', 'network', 'world_writable') AND coalesce(id, '') <> ''
              AND EXISTS (SELECT 1 FROM j12)
  UNION ALL SELECT 'temporal_sequence:*', id, g, ord, 1 FROM first5 WHERE coalesce(id, '') <> '' AND EXISTS (SELECT 1 FROM j13)
  UNION ALL SELECT 'causal_ioc_process:*', id, CASE scanner WHEN 'ioc' THEN 0 ELSE 1 END, ord, 1 FROM {pool}
            WHERE scanner IN ('ioc', 'processes') AND coalesce(id, '') <> '' AND EXISTS (SELECT 1 FROM j14)
),
weak_first3 AS (SELECT cls, string_agg(title, ', ' ORDER BY ord) AS names FROM
                  (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY ord) AS r FROM weak) t WHERE r <= 3 GROUP BY cls),
headers AS (
  SELECT 'process_network_suspicious:' || id AS correlation_id, 'process_network_suspicious' AS correlation_type,
         'process_network' AS producer, 'Suspicious process with network activity: ' || pn AS title,
         'Suspicious process ''' || pn || ''' detected alongside unusual network activity' AS description,
         'high' AS severity, 75.0 AS risk_score FROM j2p
  UNION ALL SELECT 'malware_c2:' || id, 'malware_c2', 'process_network', 'Potential malware C2 communication: ' || pn,
         'Process ''' || pn || ''' showing signs of malware with C2 communications', 'critical', 95.0 FROM j3p
  UNION ALL SELECT 'unusual_port_usage:' || id, 'unusual_port_usage', 'process_network',
         'Unusual port usage by process: ' || pn, 'Process ''' || pn || ''' using unusual network ports', 'medium', 55.0 FROM j4p
  UNION ALL SELECT 'suid_world_writable:' || id, 'suid_world_writable', 'filesystem', 'SUID binary in world-writable location',
         'Privileged SUID binary found in world-writable directory, potential privilege escalation risk', 'critical', 90.0 FROM j5w
  UNION ALL SELECT 'capabilities_weak_mac:*', 'capabilities_weak_mac', 'filesystem', 'File capabilities with weak MAC protection',
         'Files with capabilities detected but MAC system shows weak protection', 'high', 80.0 FROM j6
  UNION ALL SELECT 'ioc_file_permissions:' || id, 'ioc_file_permissions', 'filesystem',
         'IOC with file permission vulnerabilities: ' || t,
         'Indicator of compromise ''' || t || ''' detected alongside file permission issues', 'high', 85.0 FROM j7i
  UNION ALL SELECT 'weak_kernel_security:' || c.cls, 'weak_kernel_security', 'kernel',
         'Weak ' || replace(c.cls, '_', ' ') || ' configuration',
         'Multiple kernel parameters in ' || c.cls || ' category show weak security settings: ' || f.names,
         'high', 75.0 FROM weak_cls c JOIN weak_first3 f USING (cls)
  UNION ALL SELECT 'module_kernel_conflict:*', 'module_kernel_conflict', 'kernel',
         'Security modules with kernel parameter conflicts',
         'Security-related kernel modules detected with potentially conflicting kernel parameters: '
           || (SELECT string_agg(title, ', ' ORDER BY ord) FROM (SELECT * FROM secmod ORDER BY ord LIMIT 2) t),
         'medium', 60.0 FROM j9
  UNION ALL SELECT 'kernel_mac_disabled:*', 'kernel_mac_disabled', 'kernel', 'Kernel MAC parameters with disabled MAC system',
         'Kernel parameters related to MAC security detected but MAC system is disabled', 'high', 80.0 FROM j10
  UNION ALL SELECT 'kernel_process_suspicious:*', 'kernel_process_suspicious', 'kernel',
         'Kernel process controls with suspicious activity',
         'Kernel parameters controlling process execution detected alongside suspicious processes: '
           || (SELECT string_agg(pn, ', ' ORDER BY ord) FROM (SELECT * FROM susp ORDER BY ord LIMIT 2) t),
         'medium', 65.0 FROM j11
  UNION ALL SELECT 'multi_vector_apt:*', 'multi_vector_apt', 'dense', 'Advanced persistent threat indicators',
         'Coordinated attack pattern detected: suspicious process with network connectivity, world-writable files, and kernel parameter manipulation',
         'critical', 95.0 FROM j12
  UNION ALL SELECT 'temporal_sequence:*', 'temporal_sequence', 'dense', 'Temporal escalation sequence',
         'Sequential events across network, process, and kernel parameters indicate possible escalation.', 'high', 80.0 FROM j13
  UNION ALL SELECT 'causal_ioc_process:*', 'causal_ioc_process', 'dense', 'IOC-led process compromise',
         'Indicator of compromise aligns with process behavior anomalies, suggesting cause-effect chain.', 'high', 85.0 FROM j14
),
own AS (SELECT correlation_id, sum(n) AS own FROM edges_all GROUP BY 1),
shared AS (SELECT replace(correlation_id, ':*', '') AS correlation_type, sum(n) AS shared FROM edges_all
           WHERE suffix(correlation_id, ':*') GROUP BY 1),
rules_out AS (
  SELECT h.*, coalesce(o.own, 0) + CASE WHEN suffix(h.correlation_id, ':*') THEN 0 ELSE coalesce(s.shared, 0) END AS graph_degree
  FROM headers h LEFT JOIN own o USING (correlation_id) LEFT JOIN shared s USING (correlation_type)
)
"""


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _meta_py(meta: str, key: str) -> str:
    v = f"json_extract_string({meta}, '$.{key}')"
    return f"(CASE WHEN {v} = 'true' THEN 'True' WHEN {v} = 'false' THEN 'False' ELSE {v} END)"


def _truthy(v: str) -> str:
    return f"({v} IS NOT NULL AND {v} NOT IN ('', '0', '0.0', 'False', '[]', '{{}}'))"


def rationale_sql(category="category", severity="severity", title="title", meta="metadata") -> str:
    """SQL twin of vigil.functions.chat.build_rationale."""
    from vigil.functions import chat as ch
    cat = f"coalesce({category}, 'generic')"
    sev = f"lower(coalesce({severity}, 'info'))"
    t = f"coalesce({title}, 'Unknown Finding')"

    def first_truthy(*vals):
        return "(CASE " + " ".join(f"WHEN {_truthy(v)} THEN {v}" for v in vals) + " END)"

    def fmt(v):
        return f"coalesce({v}, 'unknown')"

    because = (
        f"(CASE WHEN {cat} = 'network' THEN printf({_sq(ch.BECAUSE_NETWORK)}, {fmt(_meta_py(meta, 'port'))}, "
        f"{fmt(_meta_py(meta, 'protocol'))}) "
        f"WHEN {cat} = 'suid' THEN printf({_sq(ch.BECAUSE_SUID)}, {fmt('coalesce(' + first_truthy(_meta_py(meta, 'file_path'), _meta_py(meta, 'binary'), _meta_py(meta, 'path')) + ', ' + t + ')')}) "
        f"WHEN {cat} = 'process' THEN printf({_sq(ch.BECAUSE_PROCESS)}, {fmt(first_truthy(_meta_py(meta, 'process_name'), _meta_py(meta, 'command')))}, {fmt(_meta_py(meta, 'user'))}) "
        f"WHEN {cat} = 'kernel_params' THEN printf({_sq(ch.BECAUSE_KERNEL)}, {fmt('coalesce(' + first_truthy(_meta_py(meta, 'param')) + ', ' + t + ')')}) "
        f"ELSE printf({_sq(ch.BECAUSE_OTHER)}, {t}) END)")
    implies = (f"(CASE WHEN {sev} IN ('high', 'critical') THEN {_sq(ch.IMPLIES_HIGH)} "
               f"WHEN {sev} = 'medium' THEN {_sq(ch.IMPLIES_MEDIUM)} ELSE {_sq(ch.IMPACT_LOW)} END)")
    nuance = (f"(CASE WHEN {_truthy(_meta_py(meta, 'container_id'))} THEN {_sq(ch.HOWEVER_CONTAINER)} "
              f"WHEN {_truthy(_meta_py(meta, 'is_trusted_user'))} OR {_meta_py(meta, 'user')} = 'root' "
              f"THEN {_sq(ch.HOWEVER_TRUSTED)} ELSE {_sq(ch.HOWEVER_DEFAULT)} END)")
    return (f"concat_ws(' ', printf({_sq(ch.PREMISE)}, {sev}, {cat}), {because}, {implies}, {nuance}, "
            f"printf({_sq(ch.THEREFORE)}, {sev}))")


def kb_refs_sql(category="category", meta="metadata") -> str:
    from vigil.functions import chat as ch
    cat = f"coalesce({category}, 'generic')"
    return (f"(CASE WHEN len(coalesce(json_keys({meta}), [])) > 0 THEN "
            f"(CASE WHEN {cat} IN ('network', 'dns') THEN {_sq(ch.KB_NETWORK)} "
            f"WHEN {cat} IN ('processes', 'ioc') THEN {_sq(ch.KB_EXECUTION)} ELSE {_sq(ch.KB_DEFAULT)} END) END)")


def sft_text_sql() -> str:
    """SQL twin of vigil.operators.chatml.sft_texts for the events adapter (metadata {port, user})."""
    from vigil.functions import chat as ch
    user = ("'{\n  \"title\": ' || to_json(title) || ',\n  \"description\": ' || to_json(description) "
            "|| ',\n  \"metadata\": {\n    \"port\": ' || CAST(port AS VARCHAR) || ',\n    \"user\": ' "
            "|| CAST(user_id AS VARCHAR) || '\n  }\n}'")
    answer = ("'{\"risk_score\": ' || CAST(CAST(round_even(risk_score, 0) AS BIGINT) AS VARCHAR) "
              "|| ', \"severity\": ' || to_json(upper(severity)) || ', \"category\": ' || to_json(category) || '}'")
    return ("'<|im_start|>system\n' || " + _sq(ch.SYSTEM_PROMPT) + " || '\n<|im_end|>\n<|im_start|>user\n' || "
            + user + " || '\n<|im_end|>\n<|im_start|>assistant\n<think>\n' || " + rationale_sql()
            + " || '\n</think>\n<answer>\n' || " + answer + " || '\n</answer><|im_end|>'")
