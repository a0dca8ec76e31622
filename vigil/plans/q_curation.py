"""Queries for dedup, aggregation, indexes, sampling and splits (A*, X*, D*, W*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import aggregate as ag
from vigil.operators import dedup as dd
from vigil.operators import normalize as nz
from vigil.operators import sample as sp
from vigil.plans import oracle as O
from vigil.plans.catalog import correlations, edges, findings
from vigil.plans.registry import query
from vigil.session import ensure_checkpoint_dir
from vigil.sources import tables as tb

_F = "WITH " + O.FINDINGS_CTE + "\n"
_FC = "WITH " + O.FINDINGS_CTE + "," + O.CORRELATIONS_CTE + "\n"

SAMPLE_TARGET = 2500  # the pipeline's default sampling target
SPLIT_RATIOS = (0.3, 0.6, 0.1)  # the split tool's default ratios
SEED = "0"


# D2 exact pass ------------------------------------------------------------------------------
@query("dedup_patterns", _F + f"""
SELECT pattern, id, severity, risk_score FROM (
  SELECT *, {O.dedup_pattern_sql()} AS pattern FROM findings) t
QUALIFY row_number() OVER (PARTITION BY pattern ORDER BY -coalesce(risk_score, 0), ord) = 1""",
       ops=("D2", "P21", "W3"))
def q_dedup_patterns(spark, sf_dir):
    return dd.dedup_exact_patterns(findings(spark, sf_dir)).select("pattern", "id", "severity", "risk_score")


# D1 exact dedup on the training-row key -----------------------------------------------------
@query("dedupe_items", _F + """
SELECT title, category, id FROM (
  SELECT id, ord, 'Event on port ' || CAST(port AS VARCHAR) AS title, category,
         'User ' || CAST(user_id AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS rationale FROM findings) t
QUALIFY row_number() OVER (PARTITION BY title, description, category, rationale ORDER BY ord) = 1""",
       ops=("D1",))
def q_dedupe_items(spark, sf_dir):
    f = findings(spark, sf_dir).select(
        "id", "ord", F.concat(F.lit("Event on port "), F.col("port").cast("string")).alias("title"), "category",
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("description"),
        F.lit(None).cast("string").alias("rationale"))
    return dd.dedupe_items(f, order_cols=("ord",)).select("title", "category", "id")


# A1 / A2 clusters ---------------------------------------------------------------------------
@query("finding_clusters", _F + f"""
SELECT cluster_key, arg_min(id, ord) AS id, count(*) AS aggregated_count,
       printf('Aggregate: %d %s findings', count(*), arg_min(category, ord)) AS title,
       printf('Aggregated %d findings across %d category(ies). Dominant severity: %s (%d findings).',
              count(*), count(DISTINCT category), arg_min(severity, ord), count(*)) AS description,
       max(risk_score) AS risk_score,
       CAST((2 * sum(CAST(round(probability_actionable * 1000000) AS BIGINT)) + 1000 * count(*)) // (2000 * count(*))
            AS DOUBLE) / 1000.0 AS probability_actionable
FROM (SELECT *, category || '_' || severity || '_' || {O.cluster_pattern_sql()} AS cluster_key FROM findings) t
GROUP BY cluster_key""", ops=("A1", "A2", "P22"))
def q_finding_clusters(spark, sf_dir):
    clusters, _ = ag.cluster_findings(findings(spark, sf_dir))
    return clusters.select("cluster_key", "id", "aggregated_count", "title", "description", "risk_score",
                           "probability_actionable")


@query("cluster_members", _F + f"""
SELECT category || '_' || severity || '_' || {O.cluster_pattern_sql()} AS cluster_key, id FROM findings""",
       ops=("A1",))
def q_cluster_members(spark, sf_dir):
    _, members = ag.cluster_findings(findings(spark, sf_dir))
    return members.select("cluster_key", "id")


# A1 with distributions: metadata with patterns, and joined names that coincide (ioc_low + info, ioc + low_info) --------
@query("cluster_distributions", _F + """
, t AS (SELECT id, ord, CASE ord % 7 WHEN 0 THEN 'ioc_low' WHEN 1 THEN 'ioc' ELSE category END AS category,
               CASE ord % 7 WHEN 0 THEN 'info' WHEN 1 THEN 'low_info' ELSE severity END AS severity,
               CASE ord % 3 WHEN 0 THEN 'exec|/bin/a' WHEN 1 THEN 'exec' ELSE 'generic' END AS pattern FROM findings),
k AS (SELECT *, category || '_' || severity || '_' || pattern AS cluster_key FROM t),
sd AS (SELECT cluster_key, string_agg(severity || '=' || n, ',' ORDER BY severity) AS severity_distribution
       FROM (SELECT cluster_key, severity, count(*) AS n FROM k GROUP BY ALL) x GROUP BY 1),
pd AS (SELECT cluster_key, string_agg(pattern || '=' || n, ',' ORDER BY pattern) AS pattern_summary
       FROM (SELECT cluster_key, pattern, count(*) AS n FROM k GROUP BY ALL) x GROUP BY 1)
SELECT cluster_key, arg_min(id, ord) AS id, count(*) AS aggregated_count, any_value(severity_distribution) AS severity_distribution,
       any_value(pattern_summary) AS pattern_summary
FROM k JOIN sd USING (cluster_key) JOIN pd USING (cluster_key) GROUP BY cluster_key""", ops=("A1", "A2", "P22"))
def q_cluster_distributions(spark, sf_dir):
    n = F.col("ord") % 7
    rows = findings(spark, sf_dir).withColumns({
        "category": F.when(n == 0, "ioc_low").when(n == 1, "ioc").otherwise(F.col("category")),
        "severity": F.when(n == 0, "info").when(n == 1, "low_info").otherwise(F.col("severity")),
        "metadata": F.when(F.col("ord") % 3 == 0, '{"type": "exec", "command": "/bin/a"}')
        .when(F.col("ord") % 3 == 1, '{"type": "exec", "command": ""}').otherwise('{"port": 1}')})

    def shown(name):
        return F.array_join(F.transform(F.array_sort(F.map_entries(name)),
                                        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias(name)
    return ag.aggregate_findings(rows).select("cluster_key", "id", "aggregated_count", shown("severity_distribution"),
                                              shown("pattern_summary"))


# Host fields on some findings (by number: both kernels, only one, empty text, none) -------------------------
@query("correlation_host_context", """
WITH m AS (SELECT 'corr_' || CAST(l_orderkey AS VARCHAR) AS correlation_id, l_linenumber AS pos,
                  l_partkey * 5 + l_linenumber AS n, e.event_id IS NOT NULL AS known
           FROM lineitem LEFT JOIN events e ON e.event_id = l_partkey * 5 + l_linenumber),
     h AS (SELECT *, known AND n % 4 < 2 AS bears FROM m),
     f AS (SELECT correlation_id, count(*) AS graph_degree,
                  arg_min(n, (pos, 'evt_' || n)) FILTER (WHERE bears) AS host FROM h GROUP BY 1)
SELECT correlation_id, graph_degree, CASE host % 4 WHEN 0 THEN 'Debian' WHEN 1 THEN 'Fedora' END AS distro,
       CASE host % 4 WHEN 0 THEN '12' END AS distro_version, CASE host % 4 WHEN 0 THEN 'apt' WHEN 1 THEN '' END AS package_manager,
       CASE host % 4 WHEN 0 THEN '6.1.' || (host % 10) WHEN 1 THEN '5.9' END AS kernel
FROM f""", ops=("P25", "J1"))
def q_correlation_host_context(spark, sf_dir):
    n = F.col("ord") % 4
    debian = F.concat(F.lit('{"distro": "Debian", "distro_version": "12", "package_manager": "apt", "kernel": "6.1.'),
                      (F.col("ord") % 10).cast("string"), F.lit('", "kernel_version": "old"}'))
    rows = findings(spark, sf_dir).select("id", "ord", F.when(n == 0, debian)
                                          .when(n == 1, '{"distro": "Fedora", "package_manager": "", "kernel": "", "kernel_version": "5.9"}')
                                          .when(n == 2, '{"distro": "", "port": 1}').alias("metadata"))
    return ag.host_context(edges(spark, sf_dir), rows, "pos")


# A3 histograms -----------------------------------------------------------------------------
@query("histograms", _F + """
SELECT 'severity' AS dimension, coalesce(severity, 'unknown') AS value, count(*) AS n FROM findings GROUP BY 2
UNION ALL SELECT 'category', coalesce(category, 'unknown'), count(*) FROM findings GROUP BY 2
UNION ALL SELECT 'scanner', scanner, count(*) FROM findings GROUP BY 2""", ops=("A3",))
def q_histograms(spark, sf_dir):
    return ag.histograms(findings(spark, sf_dir))


# A4 risk stats -------------------------------------------------------------------------------
@query("risk_stats", _F + """
SELECT scanner, count(*) AS n, round(avg(risk_score), 2) AS mean, round(median(risk_score), 2) AS median,
       min(risk_score) AS min, max(risk_score) AS max,
       round(coalesce(stddev_samp(risk_score), 0), 2) AS std_dev
FROM findings GROUP BY scanner""", ops=("A4",))
def q_risk_stats(spark, sf_dir):
    return ag.risk_stats(findings(spark, sf_dir), by="scanner")


# A5 / A6 ---------------------------------------------------------------------------------------
@query("correlation_stats", _FC + """
SELECT coalesce(correlation_type, 'unknown') AS correlation_type, count(*) AS n,
       round(avg(0.5), 2) AS avg_strength
FROM correlations GROUP BY 1""", ops=("A5",))
def q_correlation_stats(spark, sf_dir):
    return ag.correlation_stats(correlations(spark, sf_dir))


@query("dataset_totals", _FC + """
SELECT (SELECT count(*) FROM findings) AS total_findings,
       (SELECT count(DISTINCT scanner) FROM findings) AS scanner_types,
       (SELECT count(*) FROM correlations) AS total_correlations""", ops=("A6",))
def q_dataset_totals(spark, sf_dir):
    return ag.dataset_totals(findings(spark, sf_dir), correlations(spark, sf_dir))


# A7 / W2 ----------------------------------------------------------------------------------------
@query("correlation_summary", _FC + """
, b AS (SELECT coalesce(correlation_type, 'unknown') AS correlation_type, coalesce(severity, 'unknown') AS severity,
          CASE WHEN risk_score >= 80 THEN 'critical' WHEN risk_score >= 60 THEN 'high'
               WHEN risk_score >= 40 THEN 'medium' ELSE 'low' END AS risk_band
        FROM (SELECT *, CASE WHEN risk_score < 20 THEN 'info' WHEN risk_score < 40 THEN 'low'
                             WHEN risk_score < 70 THEN 'medium' WHEN risk_score < 90 THEN 'high'
                             ELSE 'critical' END AS severity FROM correlations) c)
SELECT 'correlation_type' AS dimension, correlation_type AS value, count(*) AS n FROM b GROUP BY 2
UNION ALL SELECT 'severity', severity, count(*) FROM b GROUP BY 2
UNION ALL SELECT 'risk_band', risk_band, count(*) FROM b GROUP BY 2""",
       ops=("A7",))
def q_correlation_summary(spark, sf_dir):
    return ag.correlation_summary(correlations(spark, sf_dir))


@query("top_correlations", _FC + """
SELECT id, 'Correlated order ' || CAST(orderkey AS VARCHAR) AS title, risk_score,
       CASE WHEN risk_score < 20 THEN 'info' WHEN risk_score < 40 THEN 'low' WHEN risk_score < 70 THEN 'medium'
            WHEN risk_score < 90 THEN 'high' ELSE 'critical' END AS severity, correlation_type, ord
FROM correlations ORDER BY risk_score DESC, ord LIMIT 5""", ops=("W2",))
def q_top_correlations(spark, sf_dir):
    return ag.top_correlations(correlations(spark, sf_dir), 5)


# X1-X4 ----------------------------------------------------------------------------------------
@query("index_by_id", _F + """
SELECT id, arg_max(scanner, ord) AS scanner, arg_max(severity, ord) AS severity, arg_max(category, ord) AS category
FROM findings GROUP BY id""", ops=("X1",))
def q_index_by_id(spark, sf_dir):
    return ag.index_by_id(findings(spark, sf_dir))


@query("index_by_severity", _F + "SELECT coalesce(severity, 'unknown') AS key, id FROM findings", ops=("X2",))
def q_index_by_severity(spark, sf_dir):
    return ag.index_long(findings(spark, sf_dir), "severity")


@query("correlations_by_type", _FC + """
SELECT coalesce(correlation_type, 'unknown') AS correlation_type, id AS correlation_id FROM correlations""",
       ops=("X3",))
def q_correlations_by_type(spark, sf_dir):
    return ag.correlations_by_type(correlations(spark, sf_dir))


@query("correlations_by_finding", _FC + """
SELECT unnest(correlation_refs) AS finding_id, id AS correlation_id FROM correlations""", ops=("X4",))
def q_correlations_by_finding(spark, sf_dir):
    return ag.correlations_by_finding(correlations(spark, sf_dir))


# D6 stratified sample ---------------------------------------------------------------------------
def _alloc_sql(target: int) -> str:
    return f"""
, strata AS (SELECT lower(coalesce(severity, 'None')) AS s, count(*) AS n, min(ord) AS first FROM findings GROUP BY 1),
tot AS (SELECT sum(n) AS total, count(*) AS k FROM strata),
a0 AS (SELECT s, n, first, greatest(1, CAST(round_even(n / total * {target}, 0) AS BIGINT)) AS a,
              row_number() OVER (ORDER BY n DESC, first) - 1 AS pos FROM strata, tot),
d AS (SELECT {target} - sum(a) AS diff FROM a0),
a1 AS (SELECT a0.*, row_number() OVER (PARTITION BY a > 1 ORDER BY pos) AS gpos FROM a0),
alloc AS (
  SELECT s, n, a + CASE WHEN diff > 0 THEN diff // k + (CASE WHEN pos < diff % k THEN 1 ELSE 0 END)
                        WHEN diff < 0 AND a > 1 AND gpos <= -diff THEN -1 ELSE 0 END AS alloc
  FROM a1, d, tot)
"""


_STRATIFIED_SQL = _F + _alloc_sql(SAMPLE_TARGET) + f"""
SELECT id, severity, risk_score FROM (
  SELECT f.*, row_number() OVER (PARTITION BY lower(coalesce(severity, 'None'))
                                 ORDER BY md5('{SEED}|' || id), ord) AS r
  FROM findings f) t
JOIN alloc ON alloc.s = lower(coalesce(t.severity, 'None'))
WHERE r <= alloc.alloc"""


@query("stratified_sample", _STRATIFIED_SQL, ops=("D6", "W1"))
def q_stratified_sample(spark, sf_dir):
    return sp.stratified_sample(findings(spark, sf_dir), SAMPLE_TARGET, SEED).select("id", "severity", "risk_score")


# D9 random split --------------------------------------------------------------------------------
@query("random_split", _F + f"""
SELECT id, CASE WHEN r <= nt THEN 'train' WHEN r <= nt + nv THEN 'val' ELSE 'test' END AS split
FROM (SELECT id, row_number() OVER (ORDER BY md5('{SEED}|' || id), ord) AS r FROM findings) t,
     (SELECT CAST(round_even({SPLIT_RATIOS[0]} * count(*), 0) AS BIGINT) AS nt,
             CAST(round_even({SPLIT_RATIOS[1]} * count(*), 0) AS BIGINT) AS nv FROM findings) c""",
       ops=("D9",))
def q_random_split(spark, sf_dir):
    return sp.random_split(findings(spark, sf_dir), SPLIT_RATIOS, SEED).select("id", "split")


# D8 stratified split ----------------------------------------------------------------------------
@query("stratified_split", _F + f"""
, st AS (SELECT lower(coalesce(severity, 'None')) AS s, count(*) AS n, min(ord) AS first FROM findings GROUP BY 1),
p0 AS (SELECT s, n, first, CAST(round_even({SPLIT_RATIOS[0]} * n, 0) AS BIGINT) AS nt,
              CAST(round_even({SPLIT_RATIOS[1]} * n, 0) AS BIGINT) AS nv0 FROM st),
p1 AS (SELECT s, n, first, nt, CASE WHEN nt + nv0 > n THEN greatest(0, n - nt) ELSE nv0 END AS nv FROM p0),
want AS (SELECT CAST(round_even({SPLIT_RATIOS[0]} * sum(n), 0) AS BIGINT) AS wt,
                CAST(round_even({SPLIT_RATIOS[1]} * sum(n), 0) AS BIGINT) AS wv,
                sum(nt) AS ht FROM p1),
p2 AS (SELECT p1.*, greatest(0, wt - ht) AS need_t,
              coalesce(sum(nv) OVER (ORDER BY first DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS v_after,
              sum(nv) OVER () AS v_total FROM p1, want),
p3 AS (SELECT p2.*, least(nv, greatest(0, need_t - v_after)) AS vt,
              greatest(0, need_t - v_total) AS need_tt,
              n - nt - nv AS t0 FROM p2),
p4 AS (SELECT p3.*, coalesce(sum(t0) OVER (ORDER BY first DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS t_after FROM p3),
p5 AS (SELECT p4.*, least(t0, greatest(0, need_tt - t_after)) AS tt FROM p4),
p6 AS (SELECT p5.*, greatest(0, (SELECT wv FROM want) - (SELECT sum(nv - vt) FROM p5)) AS need_v,
              coalesce(sum(t0 - tt) OVER (ORDER BY first DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS t2_after FROM p5),
plan AS (SELECT s, n, nt, nv, vt, tt, least(t0 - tt, greatest(0, need_v - t2_after)) AS tv FROM p6)
SELECT id, CASE WHEN r <= nt THEN 'train'
                WHEN r <= nt + nv THEN (CASE WHEN r > nt + nv - vt THEN 'train' ELSE 'val' END)
                WHEN r > n - tt THEN 'train' WHEN r > n - tt - tv THEN 'val' ELSE 'test' END AS split
FROM (SELECT id, lower(coalesce(severity, 'None')) AS s,
             row_number() OVER (PARTITION BY lower(coalesce(severity, 'None')) ORDER BY md5('{SEED}|' || id), ord) AS r
      FROM findings) f JOIN plan USING (s)""", ops=("D8",))
def q_stratified_split(spark, sf_dir):
    return sp.stratified_split(findings(spark, sf_dir), SPLIT_RATIOS, SEED).select("id", "split")


# D5 intelligent sampling ------------------------------------------------------------------------
INTELLIGENT_SQL = _F + f"""
, base AS (SELECT *, coalesce(category, 'unknown') AS cat,
             CASE WHEN severity IN ('high', 'critical') THEN 0 WHEN severity = 'medium' THEN 1
                  WHEN severity IN ('low', 'info') THEN 2 END AS c FROM findings),
tot AS (SELECT count(*) AS total FROM findings),
pc AS (SELECT cat, count(*) AS n, count(*) FILTER (WHERE c = 0) AS h, count(*) FILTER (WHERE c = 1) AS m,
              count(*) FILTER (WHERE c = 2) AS l FROM base GROUP BY cat),
pc2 AS (SELECT cat, h, m, l, greatest(2, CAST(floor({float(SAMPLE_TARGET)} * (n / total)) AS BIGINT)) AS ct
        FROM pc, tot),
pc3 AS (SELECT cat, h, ct,
               least(m, CASE WHEN m > 0 THEN greatest(1, CAST(floor(ct * 0.5) AS BIGINT)) ELSE 0 END) AS mt,
               least(l, CASE WHEN l > 0 THEN greatest(1, CAST(floor(ct * 0.25) AS BIGINT)) ELSE 0 END) AS lt FROM pc2),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY cat, c ORDER BY
                     CASE WHEN c = 0 THEN lpad(hex(ord), 16, '0') ELSE md5('{SEED}|' || id) END, ord) AS r
           FROM base b WHERE c IS NOT NULL)
SELECT id, category, severity FROM (
  SELECT ranked.*, CASE WHEN c = 0 THEN r WHEN c = 1 THEN (CASE WHEN r <= mt THEN h + r END)
                        ELSE (CASE WHEN r <= lt THEN h + mt + r END) END AS pos, ct
  FROM ranked JOIN pc3 USING (cat)) t
WHERE pos IS NOT NULL AND pos <= ct"""


@query("intelligent_sample", INTELLIGENT_SQL, ops=("D5", "T9"))
def q_intelligent_sample(spark, sf_dir):
    return sp.intelligent_sample(findings(spark, sf_dir), SAMPLE_TARGET, seed=SEED).select("id", "category", "severity")


# D11 quotas / D12 scenario --------------------------------------------------------------------
# FIXED VALUES: the three recipes' per-category quotas, and the count of a category that the sft or eval recipe does not
# list (they list all that findings have). The grpo recipe leaves world_writable out: such categories keep all rows.
DEFAULT_QUOTA = 10
QUOTA_RECIPES = {
    "sft": {"processes": 50, "network": 50, "suid": 50, "kernel_params": 50, "modules": 40, "ioc": 40, "mac": 40,
            "dns": 40, "endpoint_behavior": 40, "world_writable": 40},
    "grpo": {"processes": 300, "network": 300, "suid": 200, "kernel_params": 200, "ioc": 200},
    "eval": {"processes": 30, "network": 30, "suid": 30, "kernel_params": 30, "modules": 30, "ioc": 30, "mac": 30,
             "dns": 30, "endpoint_behavior": 30, "world_writable": 30},
}


def _quota_sql(cases: str, chosen: str = "r <= q") -> str:
    """The expected numbers are written out here once more, apart from the recipes above."""
    return _F + f"""
SELECT id, category FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY md5('{SEED}|' || id), ord) AS r,
         {cases} AS q
  FROM findings) t
WHERE {chosen}"""


@query("category_quotas", _quota_sql("CASE WHEN category IN ('ioc', 'world_writable') THEN 40 ELSE 50 END"), ops=("D11",))
def q_category_quotas(spark, sf_dir):
    return sp.apply_quotas(findings(spark, sf_dir), QUOTA_RECIPES["sft"], DEFAULT_QUOTA, seed=SEED).select("id", "category")


@query("category_quotas_grpo", _quota_sql("""CASE category WHEN 'processes' THEN 300 WHEN 'network' THEN 300
         WHEN 'suid' THEN 200 WHEN 'ioc' THEN 200 END""", "q IS NULL OR r <= q"), ops=("D11",))
def q_category_quotas_grpo(spark, sf_dir):
    return sp.apply_quotas(findings(spark, sf_dir), QUOTA_RECIPES["grpo"], seed=SEED).select("id", "category")


@query("category_quotas_eval", _quota_sql("30"), ops=("D11",))
def q_category_quotas_eval(spark, sf_dir):
    return sp.apply_quotas(findings(spark, sf_dir), QUOTA_RECIPES["eval"], DEFAULT_QUOTA, seed=SEED).select("id", "category")


# D5 over input positions beyond 2^51, as files of a large read give them
@query("intelligent_sample_far", INTELLIGENT_SQL, ops=("D5",))
def q_intelligent_sample_far(spark, sf_dir):
    far = findings(spark, sf_dir).withColumn("ord", F.col("ord") + F.lit(1 << 51))
    return sp.intelligent_sample(far, SAMPLE_TARGET, seed=SEED).select("id", "category", "severity")


SCENARIO_WEIGHTS = {"normal": 0.45, "suspicious": 0.35, "malicious": 0.15, "edge_case": 0.05}


@query("scenario_assignment", _F + f"""
SELECT scenario, count(*) AS n FROM (
  SELECT CASE {" ".join(f"WHEN u <= {c} THEN '{k}'" for k, c in
                        zip(SCENARIO_WEIGHTS, [0.45, 0.45 + 0.35, 0.45 + 0.35 + 0.15, 0.45 + 0.35 + 0.15 + 0.05]))}
              ELSE 'normal' END AS scenario
  FROM (SELECT CAST(('0x' || substr(md5('{SEED}|' || id), 1, 8))::UBIGINT AS DOUBLE) / 4294967296.0 AS u
        FROM findings) t) s
GROUP BY scenario""", ops=("D12",))
def q_scenario_assignment(spark, sf_dir):
    df = sp.assign_scenario(findings(spark, sf_dir), SCENARIO_WEIGHTS, seed=SEED)
    return df.groupBy("scenario").agg(F.count(F.lit(1)).alias("n"))


# D2 near pass (no SQL form: greedy over a similarity graph; tested against the scan itself) ------
@query("dedup_near", None, ops=("D2", "T15"))
def q_dedup_near(spark, sf_dir):
    from vigil.operators import neardup as nd
    return nd.dedup_near(findings(spark, sf_dir)).select("pattern", "id", "severity", "risk_score")


# P9 normalised correlations ------------------------------------------------------------------------
@query("normalized_correlations", _FC + """
SELECT id, correlation_type, risk_score, 'Correlated order ' || CAST(orderkey AS VARCHAR) AS title,
       CAST(0.5 AS DOUBLE) AS correlation_strength, len(correlation_refs) AS n_refs
FROM correlations""", ops=("P9",))
def q_normalized_correlations(spark, sf_dir):
    from vigil.operators import normalize as nz
    c = nz.normalize_correlations(correlations(spark, sf_dir))
    return c.select("id", "correlation_type", "risk_score", "title",
                    F.col("_correlation_strength").alias("correlation_strength"),
                    F.size("correlation_refs").alias("n_refs"))


# P18-P20 enrichment columns of the adapter --------------------------------------------------------
@query("finding_enrichment", _F + """
SELECT id,
       array_to_string(list_concat([scanner, 'baseline:new'],
         CASE WHEN severity IN ('high', 'critical') THEN ['high_priority', 'needs_attention']
              WHEN severity = 'medium' THEN ['moderate_risk'] ELSE ['low_priority'] END), '|') AS tags,
       round(CASE severity WHEN 'info' THEN 0.2 WHEN 'low' THEN 0.4 WHEN 'medium' THEN 0.6 WHEN 'high' THEN 0.8
             WHEN 'critical' THEN 1.0 ELSE 0.5 END * 0.55, 2)::DOUBLE AS impact,
       probability_actionable
FROM findings""", ops=("P18", "P19", "P20"))
def q_finding_enrichment(spark, sf_dir):
    f = findings(spark, sf_dir)
    return f.select("id", F.array_join("tags", "|").alias("tags"), F.col("risk_subscores.impact").alias("impact"),
                    "probability_actionable")


# P23 title patterns --------------------------------------------------------------------------------
@query("title_patterns", _F + """
SELECT CASE WHEN contains(title, ':') THEN trim(split_part(title, ':', 1)) ELSE substr(title, 1, 20) END AS pattern,
       count(*) AS n
FROM findings GROUP BY 1""", ops=("P23",))
def q_title_patterns(spark, sf_dir):
    from vigil.functions import text as tx
    return findings(spark, sf_dir).groupBy(tx.title_pattern(F.col("title")).alias("pattern")).agg(
        F.count(F.lit(1)).alias("n"))


# P26 stringified metadata ------------------------------------------------------------------------
@query("metadata_strings", _F + """
SELECT id, CAST(json_object('port', CAST(port AS VARCHAR), 'user', CAST(user_id AS VARCHAR)) AS VARCHAR) AS metadata
FROM findings""", ops=("P26",))
def q_metadata_strings(spark, sf_dir):
    f = findings(spark, sf_dir)
    return f.select("id", F.to_json(F.from_json("metadata", "map<string,string>")).alias("metadata"))


# S9 head slice ------------------------------------------------------------------------------------
@query("head_slice", "SELECT * FROM documents ORDER BY doc_id LIMIT 500", ops=("S9",))
def q_head_slice(spark, sf_dir):
    from vigil.sources import jsonl as J
    from vigil.sources import tables as tb
    return J.head_slice(tb.read(spark, sf_dir, "documents"), 500, "doc_id")


# documents' facts as objects with nulls at depth; F1: nested criteria over findings ------------------------------
@query("null_fields_dropped", """
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '{"source": "' || source || '", "deep": {"n": ' || n_chars || ', "list": [null, {"k": null}]}}'
                 WHEN 1 THEN '{"deep": {"list": []}}' ELSE 'plain' END AS metadata
FROM documents""", ops=("P6",))
def q_null_fields_dropped(spark, sf_dir):
    d = tb.read(spark, sf_dir, "documents")
    first = F.concat(F.lit('{"a": null, "source": "'), F.col("source"), F.lit('", "deep": {"n": '), F.col("n_chars").cast("string"),
                     F.lit(', "x": null, "list": [null, {"k": null}]}, "z": null}'))
    meta = (F.when(F.col("doc_id") % 3 == 0, first)
            .when(F.col("doc_id") % 3 == 1, F.lit('{"deep": {"x": null, "y": null, "list": []}, "q": null}')).otherwise(F.lit("plain")))
    return nz.drop_null_fields(d.select("doc_id", meta.alias("metadata")))


@query("related_findings", _F + """
SELECT id FROM findings WHERE severity IN ('high', 'critical') AND port IN (22, 80, 443, 7, 11) AND category = 'network'""", ops=("F1",))
def q_related_findings(spark, sf_dir):
    f = findings(spark, sf_dir).select("id", "severity", "category", "metadata")
    return nz.find_related(f, {"severity": ["high", "critical"], "category": "network", "metadata": {"port": [22, 80, 443, 7, 11]}})


# Two exports of the same findings (all, and those of two scanners) pooled, without repeats, cut to a sample -------
# The repeats go, so the sample is that of the findings themselves, none of which share title and description.
@query("merged_sample", f"SELECT id FROM ({_STRATIFIED_SQL}) s", ops=("D7", "S6", "D1"))
def q_merged_sample(spark, sf_dir):
    f = findings(spark, sf_dir).select("id", "ord", "title", "description", "severity", "category", "risk_score", "metadata")
    pooled = f.unionByName(f.where(F.col("category").isin("network", "ioc")))
    ensure_checkpoint_dir(spark)
    unique = dd.dedupe_items(pooled, order_cols=("ord",)).checkpoint()  # read more than once by the sample
    return sp.stratified_sample(unique, SAMPLE_TARGET, SEED).select("id")
