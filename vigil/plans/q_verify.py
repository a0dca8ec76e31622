"""Queries for the standalone verifiers (V1-V6, V9, V11, V26-V35, J17, J19): issue counts per rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions import fixed
from vigil.operators import verify as V
from vigil.plans import oracle as O
from vigil.plans.catalog import correlations, findings
from vigil.plans.registry import query
from vigil.sources import tables as tb

_FC = "WITH " + O.FINDINGS_CTE + "," + O.CORRELATIONS_CTE

# Top-level keys of the adapter rows (what a JSON export of them would contain).
FINDING_KEYS = ["id", "ts", "user_id", "event_type", "port", "scanner", "risk_score", "event_value", "category",
                "severity", "title", "description", "metadata", "baseline_status", "tags", "risk_subscores",
                "probability_actionable", "base_severity_score", "risk_total"]
CORRELATION_KEYS = ["orderkey", "id", "correlation_type", "risk_score", "timestamp", "o_orderpriority",
                    "correlation_refs", "severity", "title", "description", "category", "scanner", "metadata",
                    "tags", "risk_subscores"]


def _counts(df):
    return df.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def _host_sql(table: str) -> str:
    parts = [f"SELECT 'metadata.{k}:missing' AS rule FROM {table} "
             f"WHERE coalesce(json_extract_string(metadata, '$.{k}'), '') = ''" for k in fixed.HOST_KEYS]
    parts.append(f"SELECT 'metadata.kb_refs:empty' FROM {table} "
                 f"WHERE coalesce(json_array_length(json_extract(metadata, '$.kb_refs')), 0) = 0")
    return " UNION ALL ".join(parts)


def _missing_sql(table: str, required: list[str], present: list[str]) -> str:
    miss = [f for f in required if f not in present]
    return " UNION ALL ".join(f"SELECT 'missing:{f}' AS rule FROM {table}" for f in miss)


_sev_list = ", ".join(f"'{s}'" for s in fixed.SEVERITIES)


@query("schema_issue_counts", _FC + f""",
iss AS (
  {_missing_sql('findings', V.FINDING_REQUIRED, FINDING_KEYS)}
  UNION ALL {_missing_sql('correlations', V.CORRELATION_REQUIRED, CORRELATION_KEYS)}
  UNION ALL SELECT 'invalid_severity' FROM findings WHERE severity NOT IN ({_sev_list})
  UNION ALL SELECT 'invalid_severity' FROM correlations
    WHERE (CASE WHEN risk_score < 20 THEN 'info' WHEN risk_score < 40 THEN 'low' WHEN risk_score < 70 THEN 'medium'
                WHEN risk_score < 90 THEN 'high' ELSE 'critical' END) NOT IN ({_sev_list})
  UNION ALL SELECT 'risk_score:range' FROM findings WHERE risk_score < 0 OR risk_score > 100
  UNION ALL SELECT 'risk_score:range' FROM correlations WHERE risk_score < 0 OR risk_score > 100
  UNION ALL SELECT 'base_severity_score:range' FROM findings WHERE risk_score < 0 OR risk_score > 100
  UNION ALL SELECT 'probability_actionable:range' FROM findings
    WHERE probability_actionable < 0 OR probability_actionable > 1
  UNION ALL SELECT 'risk_subscores:not_dict' FROM correlations
  UNION ALL {_host_sql('findings')}
  UNION ALL {_host_sql('correlations')}
  UNION ALL SELECT 'correlation_refs:empty' FROM correlations WHERE len(correlation_refs) = 0
)
SELECT rule, count(*) AS n FROM iss GROUP BY rule""", ops=("V1", "V2", "V3", "V4", "V5", "V6", "S8"))
def q_schema_issue_counts(spark, sf_dir):
    return _counts(V.schema_issues(findings(spark, sf_dir), correlations(spark, sf_dir)))


@query("coherence_issue_counts", _FC + f""",
ids AS (SELECT id FROM findings UNION ALL SELECT id FROM correlations),
iss AS (
  SELECT 'duplicate_id' AS rule FROM (SELECT id FROM ids WHERE coalesce(id, '') <> '' GROUP BY id HAVING count(*) > 1) d
  UNION ALL SELECT 'process_network' FROM (SELECT 1) x
    WHERE EXISTS (SELECT 1 FROM findings WHERE category = 'processes' AND severity IN ('high', 'critical'))
      AND NOT EXISTS (SELECT 1 FROM findings WHERE category = 'network' AND severity IN ('high', 'critical'))
  UNION ALL SELECT 'severity_risk' FROM findings
    WHERE NOT (CASE severity {" ".join(f"WHEN '{k}' THEN risk_score BETWEEN {lo} AND {hi}"
                                       for k, (lo, hi) in fixed.COHERENCE_BANDS.items())}
               ELSE risk_score BETWEEN 0 AND 100 END)
  UNION ALL SELECT 'broken_ref' FROM (SELECT unnest(correlation_refs) AS ref FROM correlations) r
    WHERE ref NOT IN (SELECT id FROM findings WHERE coalesce(id, '') <> '')
  UNION ALL {_host_sql('correlations')}
)
SELECT rule, count(*) AS n FROM iss GROUP BY rule""", ops=("V9", "V11", "J17", "J19"))
def q_coherence_issue_counts(spark, sf_dir):
    return _counts(V.coherence_issues(findings(spark, sf_dir), correlations(spark, sf_dir)))


@query("realism_issue_counts", "WITH " + O.FINDINGS_CTE + f""",
tot AS (SELECT count(*) AS t, {", ".join(f"count(*) FILTER (WHERE severity = '{s}') AS {s}" for s in fixed.SEVERITIES)}
        FROM findings),
iss AS (
  {" UNION ALL ".join(f"SELECT 'distribution:{s}' AS rule FROM tot WHERE NOT ({s} / t BETWEEN {lo} AND {hi})"
                      for s, (lo, hi) in fixed.REALISM_RANGES.items())}
  UNION ALL SELECT 'port' FROM findings WHERE category = 'network' AND port IS NOT NULL AND (port < 1 OR port > 65535)
  UNION ALL SELECT 'description_short' FROM findings WHERE length(coalesce(description, '')) < 10
  UNION ALL SELECT 'description_long' FROM findings WHERE length(coalesce(description, '')) > 500
  UNION ALL SELECT 'title_short' FROM findings WHERE length(coalesce(title, '')) < 5
  UNION ALL {_host_sql('findings')}
  UNION ALL SELECT 'repetition:' || field FROM (
    SELECT field, max(n) * 1.0 / sum(n) AS share FROM (
      SELECT 'port' AS field, CAST(port AS VARCHAR) AS value, count(*) AS n FROM findings
        WHERE port IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'user', CAST(user_id AS VARCHAR), count(*) FROM findings GROUP BY 2) u
    GROUP BY field) s WHERE share > 0.8
)
SELECT rule, count(*) AS n FROM iss GROUP BY rule""", ops=("V26", "V27", "V28"))
def q_realism_issue_counts(spark, sf_dir):
    return _counts(V.realism_issues(findings(spark, sf_dir)))


@query("abundance_issue_counts", "WITH " + O.FINDINGS_CTE + f""",
tot AS (SELECT count(*) AS t, count(*) FILTER (WHERE severity = 'critical') AS c,
               count(*) FILTER (WHERE severity = 'high') AS h, count(*) FILTER (WHERE severity = 'info') AS i
        FROM findings),
iss AS (
  SELECT 'category:' || k AS rule FROM (SELECT coalesce(category, 'unknown') AS k, count(*) AS n FROM findings GROUP BY 1) c, tot
    WHERE n / t > {fixed.MAX_CATEGORY_SHARE}
  UNION ALL SELECT 'title_pattern:' || k FROM (
      SELECT CASE WHEN contains(title, ':') THEN trim(split_part(title, ':', 1)) ELSE substr(title, 1, 20) END AS k,
             count(*) AS n FROM findings GROUP BY 1) p WHERE n > {fixed.MAX_SIMILAR_FINDINGS}
  UNION ALL SELECT 'identical_metadata:' || md5(k) FROM (
      SELECT metadata AS k, count(*) AS n FROM findings GROUP BY 1) m WHERE n > {fixed.MAX_SIMILAR_FINDINGS}
  UNION ALL SELECT 'too_many_critical' FROM tot WHERE t > 0 AND c > t * 0.1
  UNION ALL SELECT 'too_many_high' FROM tot WHERE t > 0 AND h > t * 0.2
  UNION ALL SELECT 'too_few_info' FROM tot WHERE t > 0 AND i < t * 0.3
  UNION ALL {_host_sql('findings')}
  UNION ALL SELECT 'diversity:title' FROM tot WHERE (SELECT count(DISTINCT coalesce(title, '')) FROM findings) / t < 0.4
  UNION ALL SELECT 'diversity:rationale' FROM tot WHERE 1 / t < 0.4
  UNION ALL SELECT 'diversity:port' FROM tot
    WHERE (SELECT count(DISTINCT coalesce(CAST(port AS VARCHAR), 'None')) FROM findings) / t < 0.4
  UNION ALL SELECT 'diversity:command' FROM tot WHERE 1 / t < 0.4
)
SELECT rule, count(*) AS n FROM iss GROUP BY rule""", ops=("V29", "V30", "V31", "V32", "V33"))
def q_abundance_issue_counts(spark, sf_dir):
    return _counts(V.abundance_issues(findings(spark, sf_dir)))


HOST_KEYS_PRESENT = ["id", "title", "severity", "risk_score", "description", "metadata"]
_events = "(SELECT * FROM hfd WHERE id LIKE 'evt_%')"


def _of(verifier: str, *selects: str) -> str:
    return " UNION ALL ".join(f"SELECT '{verifier}' AS verifier, rule FROM ({x}) q" for x in selects)


@query("verifier_issue_totals", "WITH " + O.HOST_FINDINGS_CTE + "," + O.CORRELATIONS_CTE + f""",
hfd AS (SELECT hf.*, CASE WHEN hf.id LIKE 'evt_%' THEN f.description ELSE hf.category || ' finding: ' || hf.title END AS description,
               f.port, f.user_id
        FROM hf LEFT JOIN findings f USING (id)),
tot AS (SELECT count(*) AS t, {", ".join(f"count(*) FILTER (WHERE severity = '{x}') AS {x}" for x in fixed.SEVERITIES)} FROM hfd),
shares AS (SELECT field, max(n) * 1.0 / sum(n) AS share FROM (
    SELECT 'port' AS field, CAST(port AS VARCHAR) AS value, count(*) AS n FROM {_events} e GROUP BY 2
    UNION ALL SELECT 'user', CAST(user_id AS VARCHAR), count(*) FROM {_events} e GROUP BY 2) u GROUP BY field),
iss AS (
  {_of("SchemaVerifier", _missing_sql("hfd", V.FINDING_REQUIRED, HOST_KEYS_PRESENT),
       _missing_sql("correlations", V.CORRELATION_REQUIRED, CORRELATION_KEYS),
       "SELECT 'risk_score:range' AS rule FROM hfd WHERE risk_score < 0 OR risk_score > 100",
       "SELECT 'risk_score:range' AS rule FROM correlations WHERE risk_score < 0 OR risk_score > 100",
       "SELECT 'risk_subscores:not_dict' AS rule FROM correlations",
       "SELECT 'correlation_refs:empty' AS rule FROM correlations WHERE len(correlation_refs) = 0",
       _host_sql("hfd"), _host_sql("correlations"))}
  UNION ALL {_of("CoherenceVerifier",
       "SELECT 'duplicate_id' AS rule FROM (SELECT id FROM (SELECT id FROM hfd UNION ALL SELECT id FROM correlations) i "
       "WHERE coalesce(id, '') <> '' GROUP BY id HAVING count(*) > 1) d",
       "SELECT 'process_network' AS rule FROM (SELECT 1) x WHERE EXISTS (SELECT 1 FROM hfd WHERE category = 'processes' AND "
       "severity IN ('high', 'critical')) AND NOT EXISTS (SELECT 1 FROM hfd WHERE category = 'network' AND severity IN ('high', 'critical'))",
       "SELECT 'severity_risk' AS rule FROM hfd WHERE NOT (CASE severity "
       + " ".join(f"WHEN '{k}' THEN risk_score BETWEEN {lo} AND {hi}" for k, (lo, hi) in fixed.COHERENCE_BANDS.items())
       + " ELSE risk_score BETWEEN 0 AND 100 END)",
       "SELECT 'broken_ref' AS rule FROM (SELECT unnest(correlation_refs) AS ref FROM correlations) r "
       "WHERE ref NOT IN (SELECT id FROM hfd WHERE coalesce(id, '') <> '')",
       _host_sql("correlations"))}
  UNION ALL {_of("RealismVerifier", *[f"SELECT 'distribution:{x}' AS rule FROM tot WHERE NOT ({x} / t BETWEEN {lo} AND {hi})"
                                      for x, (lo, hi) in fixed.REALISM_RANGES.items()],
       f"SELECT 'port' AS rule FROM {_events} e WHERE category = 'network' AND (port < 1 OR port > 65535)",
       "SELECT 'description_short' AS rule FROM hfd WHERE length(coalesce(description, '')) < 10",
       "SELECT 'description_long' AS rule FROM hfd WHERE length(coalesce(description, '')) > 500",
       "SELECT 'title_short' AS rule FROM hfd WHERE length(coalesce(title, '')) < 5",
       _host_sql("hfd"), "SELECT 'repetition:' || field AS rule FROM shares WHERE share > 0.8")}
  UNION ALL {_of("AbundanceVerifier",
       f"SELECT 'category:' || k AS rule FROM (SELECT coalesce(category, 'unknown') AS k, count(*) AS n FROM hfd GROUP BY 1) c, tot "
       f"WHERE n / t > {fixed.MAX_CATEGORY_SHARE}",
       f"SELECT 'title_pattern:' || k AS rule FROM (SELECT CASE WHEN contains(title, ':') THEN trim(split_part(title, ':', 1)) "
       f"ELSE substr(title, 1, 20) END AS k, count(*) AS n FROM hfd GROUP BY 1) p WHERE n > {fixed.MAX_SIMILAR_FINDINGS}",
       f"SELECT 'identical_metadata:' || md5(k) AS rule FROM (SELECT metadata AS k, count(*) AS n FROM hfd GROUP BY 1) m "
       f"WHERE n > {fixed.MAX_SIMILAR_FINDINGS}",
       "SELECT 'too_many_critical' AS rule FROM tot WHERE t > 0 AND critical > t * 0.1",
       "SELECT 'too_many_high' AS rule FROM tot WHERE t > 0 AND high > t * 0.2",
       "SELECT 'too_few_info' AS rule FROM tot WHERE t > 0 AND info < t * 0.3", _host_sql("hfd"),
       "SELECT 'diversity:title' AS rule FROM tot WHERE (SELECT count(DISTINCT coalesce(title, '')) FROM hfd) / t < 0.4",
       "SELECT 'diversity:rationale' AS rule FROM tot WHERE 1 / t < 0.4",
       "SELECT 'diversity:port' AS rule FROM tot WHERE (SELECT count(DISTINCT coalesce(CAST(port AS VARCHAR), '')) FROM hfd) / t < 0.4",
       "SELECT 'diversity:command' AS rule FROM tot WHERE 1 / t < 0.4")}
)
SELECT verifier, rule, count(*) AS n FROM iss GROUP BY verifier, rule""", ops=("V34",))
def q_verifier_issue_totals(spark, sf_dir):
    """Every verifier's issues pooled over all scanner categories (counts per verifier and rule)."""
    host = tb.host_findings(spark, sf_dir)
    issues = V.run_verifiers(host, correlations(spark, sf_dir))
    return issues.groupBy("verifier", "rule").agg(F.count(F.lit(1)).alias("n"))
