"""Catalog of registered queries (one per operator group of SURVEY section 2).

Every query reads the driver's tables (or what Spark derives from them), so
its work grows with the data. Nested results are flattened to typed columns;
doubles are rounded to 6 places after aggregation so both engines agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import normalize as nz
from vigil.operators import report as rp
from vigil.plans import oracle as O
from vigil.plans.registry import query
from vigil.sources import tables as tb


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.findings_from_events(tb.read(spark, sf_dir, "events"))


def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.correlations_from_orders(tb.read(spark, sf_dir, "orders"), tb.read(spark, sf_dir, "lineitem"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References straight from the lines: no list is built only to be taken apart again."""
    return tb.correlation_edges(tb.read(spark, sf_dir, "lineitem")).withColumn("n", F.lit(1))


# --------------------------------------------------------------------------------------
# Normalisation of findings
# --------------------------------------------------------------------------------------
@query("normalized_findings", O.with_ctes(O.FINDINGS_CTE) + """
SELECT id, scanner, category, severity, risk_score, title, description,
       CAST(round(
         (CASE WHEN coalesce(description, '') = '' OR description = 'No description available' THEN 0.8 ELSE 1.0 END)
       * (CASE WHEN metadata IS NULL OR trim(metadata) IN ('{}', '', 'null', '[]') THEN 0.9 ELSE 1.0 END)
       * (CASE WHEN NOT isnan(risk_score) AND (risk_score < 0 OR risk_score > 100) THEN 0.7 ELSE 1.0 END), 2)
         AS DOUBLE) AS data_quality
FROM findings""", ops=("P1", "P2", "P5", "P7", "P8"))
def q_normalized_findings(spark, sf_dir):
    df = nz.normalize_findings(findings(spark, sf_dir))
    return df.select("id", "scanner", "category", "severity", "risk_score", "title", "description",
                     F.col("_data_quality").alias("data_quality"))


# --------------------------------------------------------------------------------------
# Verification scorecard
# --------------------------------------------------------------------------------------
from vigil.operators import scorecard as sc  # noqa: E402

def _sc_sql(body: str) -> str:
    return "WITH " + O.FINDINGS_CTE + "," + O.CORRELATIONS_CTE + O.scorecard_ctes() + body


@query("scorecard_metrics", _sc_sql("SELECT stage, metric, round(value, 6) AS value FROM metrics"),
       ops=("V7", "V8", "V10", "V12", "V13", "V14", "V15", "V16", "V17", "V18", "V19", "V20", "V21", "J16", "J18"))
def q_scorecard_metrics(spark, sf_dir):
    m = sc.scorecard_metrics(findings(spark, sf_dir), correlations(spark, sf_dir), edges(spark, sf_dir))
    return m.select("stage", "metric", F.round("value", 6).alias("value"))


@query("scorecard_stages", _sc_sql("SELECT stage, status, passed, round(score, 6) AS score FROM stages"),
       ops=("V12", "V13", "V15", "V21"))
def q_scorecard_stages(spark, sf_dir):
    m = sc.scorecard_metrics(findings(spark, sf_dir), correlations(spark, sf_dir), edges(spark, sf_dir))
    return sc.stage_table(m)


@query("scorecard_summary", _sc_sql("""
SELECT CASE WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'failed'
            WHEN count(*) FILTER (WHERE status = 'warning') > count(*) / 2 THEN 'warning'
            ELSE 'passed' END AS overall_status,
       count(*) FILTER (WHERE passed) AS stages_passed,
       count(*) FILTER (WHERE status = 'failed') AS stages_failed,
       count(*) FILTER (WHERE status = 'warning') AS stages_warning,
       (SELECT count(*) FROM findings) AS total_findings,
       (SELECT count(*) FROM correlations) AS total_correlations,
       (SELECT count(DISTINCT scanner) FROM findings) AS scanner_coverage
FROM stages"""), ops=("V22", "V23"))
def q_scorecard_summary(spark, sf_dir):
    f, c = findings(spark, sf_dir), correlations(spark, sf_dir)
    st = sc.stage_table(sc.scorecard_metrics(f, c, edges(spark, sf_dir)))
    counts = (f.agg(F.count(F.lit(1)).alias("total_findings"), F.count_distinct("scanner").alias("scanner_coverage"))
              .withColumn("k", F.lit(1)))
    ccount = c.agg(F.count(F.lit(1)).alias("total_correlations")).withColumn("k", F.lit(1))
    return (sc.overall_status(st).withColumn("k", F.lit(1))
            .join(counts, "k").join(ccount, "k").drop("k"))


@query("scorecard_recommendations", _sc_sql("""
, recs AS (
  SELECT stage, CASE
    WHEN stage = 'schema_validation' AND NOT passed THEN printf('Fix schema validation issues in %d findings', CAST(score AS BIGINT))
    WHEN stage = 'consistency_check' AND NOT passed THEN 'Address consistency issues'
    WHEN stage = 'realism_assessment' AND score < 0.8 THEN printf('Improve realism: score %.2f', score)
    WHEN stage = 'correlation_validation' AND NOT passed AND score < 0.6 THEN printf('Improve correlation quality: score %.2f', score)
    WHEN stage = 'quality_scoring' AND NOT passed AND score < 0.7 THEN printf('Improve overall quality: score %.2f', score)
  END AS recommendation FROM stages)
SELECT stage, recommendation FROM recs WHERE recommendation IS NOT NULL
UNION ALL
SELECT 'overall', 'Dataset quality is good - no major issues found'
FROM (SELECT count(*) FILTER (WHERE recommendation IS NOT NULL) AS n FROM recs) t WHERE n = 0"""),
       ops=("V24",))
def q_scorecard_recommendations(spark, sf_dir):
    m = sc.scorecard_metrics(findings(spark, sf_dir), correlations(spark, sf_dir), edges(spark, sf_dir))
    return sc.recommendations(sc.stage_table(m))


@query("correlation_quality", "WITH " + O.FINDINGS_CTE + "," + O.CORRELATIONS_CTE + O.scorecard_ctes() + """
SELECT correlation_id, n_refs, found, round(quality, 6) AS quality FROM cq""", ops=("V14", "J18"))
def q_correlation_quality(spark, sf_dir):
    q = sc.correlation_quality(correlations(spark, sf_dir), findings(spark, sf_dir), edges(spark, sf_dir))
    return q.select("correlation_id", "n_refs", "found", F.round("quality", 6).alias("quality"))


@query("broken_references", "WITH " + O.FINDINGS_CTE + "," + O.CORRELATIONS_CTE + O.scorecard_ctes() + """
SELECT r.correlation_id, r.ref
FROM (SELECT id AS correlation_id, unnest(correlation_refs) AS ref FROM correlations) r
WHERE NOT EXISTS (SELECT 1 FROM ids WHERE ids.id = r.ref)""", ops=("J16",))
def q_broken_references(spark, sf_dir):
    return sc.broken_refs(correlations(spark, sf_dir), findings(spark, sf_dir), edges(spark, sf_dir)).select("correlation_id", "ref")


@query("dataset_metadata", _sc_sql("""
, roll AS (SELECT CASE WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'failed'
                       WHEN count(*) FILTER (WHERE status = 'warning') > count(*) / 2 THEN 'warning'
                       ELSE 'passed' END AS overall_status,
                  count(*) FILTER (WHERE passed) AS stages_passed FROM stages),
ch AS (SELECT (SELECT count(*) FROM findings) AS total_findings,
              (SELECT count(*) FROM correlations) AS total_correlations,
              (SELECT count(DISTINCT scanner) FROM findings) AS scanner_coverage)
SELECT substr(md5(CAST(total_findings AS VARCHAR) || '|' || CAST(total_correlations AS VARCHAR) || '|'
                  || CAST(scanner_coverage AS VARCHAR) || '|' || overall_status), 1, 16) AS dataset_id,
       '2.0' AS version, 'optimized_json' AS format, false AS compression, overall_status, stages_passed,
       (SELECT round(score, 6) FROM stages WHERE stage = 'quality_scoring') AS quality_score,
       total_findings, total_correlations, scanner_coverage,
       'data_normalization,quality_assessment,basic_enrichment,structure_optimization,indexing,metadata_generation'
         AS processing_pipeline
FROM roll, ch"""), ops=("A8", "A6"))
def q_dataset_metadata(spark, sf_dir):
    f, c = findings(spark, sf_dir), correlations(spark, sf_dir)
    return sc.dataset_metadata(f, c, sc.stage_table(sc.scorecard_metrics(f, c, edges(spark, sf_dir))))


# The run report, its figures observed in the writes ----------------------------------------------------------------
@query("run_report", _sc_sql("""
, roll AS (SELECT CASE WHEN count(*) FILTER (WHERE status = 'failed') > 0 THEN 'failed'
                       WHEN count(*) FILTER (WHERE status = 'warning') > count(*) / 2 THEN 'warning'
                       ELSE 'passed' END AS overall_status, count(*) FILTER (WHERE passed) AS stages_passed FROM stages)
SELECT 'data_summary' AS section, 'total_findings' AS metric, CAST(count(*) AS VARCHAR) AS value FROM findings
UNION ALL SELECT 'data_summary', 'total_correlations', CAST(count(*) AS VARCHAR) FROM correlations
UNION ALL SELECT 'data_summary', 'scanner_types', CAST(count(DISTINCT scanner) AS VARCHAR) FROM findings
UNION ALL SELECT 'data_summary', 'correlation_types', CAST(count(DISTINCT correlation_type) AS VARCHAR) FROM correlations
UNION ALL SELECT 'dataset_characteristics', 'version', '2.0'
UNION ALL SELECT 'dataset_characteristics', 'format', 'optimized_json'
UNION ALL SELECT 'dataset_characteristics', 'compressed', 'false'
UNION ALL SELECT 'performance_metrics', 'data_bytes', CAST(sum(strlen(CAST(json_object('id', id, 'scanner', scanner,
            'severity', severity, 'title', title) AS VARCHAR)) + 1) AS VARCHAR) FROM findings
UNION ALL SELECT 'quality_metrics', 'verification_status', overall_status FROM roll
UNION ALL SELECT 'quality_metrics', 'stages_passed', CAST(stages_passed AS VARCHAR) FROM roll
UNION ALL SELECT 'quality_metrics', 'quality_score', CAST(CAST(score AS DECIMAL(18, 4)) AS VARCHAR) FROM stages
          WHERE stage = 'quality_scoring'
UNION ALL SELECT 'recommendations', stage, CASE stage
    WHEN 'schema_validation' THEN printf('Fix schema validation issues in %d findings', CAST(score AS BIGINT))
    WHEN 'consistency_check' THEN 'Address consistency issues'
    WHEN 'realism_assessment' THEN printf('Improve realism: score %.2f', score)
    WHEN 'correlation_validation' THEN printf('Improve correlation quality: score %.2f', score)
    ELSE printf('Improve overall quality: score %.2f', score) END
  FROM stages WHERE CASE stage WHEN 'realism_assessment' THEN score < 0.8 WHEN 'correlation_validation' THEN NOT passed AND score < 0.6
                               WHEN 'quality_scoring' THEN NOT passed AND score < 0.7 ELSE NOT passed END
UNION ALL SELECT 'recommendations', 'overall', 'Dataset quality is good - no major issues found'
  WHERE NOT EXISTS (SELECT 1 FROM stages WHERE CASE stage WHEN 'realism_assessment' THEN score < 0.8
      WHEN 'correlation_validation' THEN NOT passed AND score < 0.6
      WHEN 'quality_scoring' THEN NOT passed AND score < 0.7 ELSE NOT passed END)"""), ops=("A9",))
def q_run_report(spark, sf_dir):
    f, c = findings(spark, sf_dir), correlations(spark, sf_dir)
    return rp.run_report(f, c, sc.scorecard_metrics(f, c, edges(spark, sf_dir)))


# A stage that fails is a row, the others stand (here correlation types come as lists) -----------------------------
@query("scorecard_stage_errors", _sc_sql("""
SELECT stage, CASE stage WHEN 'correlation_validation' THEN 'error' ELSE status END AS status,
       passed AND stage <> 'correlation_validation' AS passed,
       CASE WHEN stage <> 'correlation_validation' THEN round(score, 6) END AS score FROM stages"""), ops=("V25",))
def q_scorecard_stage_errors(spark, sf_dir):
    bad = correlations(spark, sf_dir).withColumn("correlation_type", F.array("correlation_type"))
    return sc.isolated_stages(findings(spark, sf_dir), bad, edges(spark, sf_dir)).drop("error")
