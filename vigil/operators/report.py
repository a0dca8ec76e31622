"""The report of a run, from figures observed while its outputs are written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators import scorecard as sc
from vigil.sources import sinks

PAYLOAD = ("id", "scanner", "severity", "title")


def run_report(findings: DataFrame, correlations: DataFrame, metrics: DataFrame, version: str = "2.0",
               fmt: str = "optimized_json", compressed: bool = False, timings: dict[str, float] | None = None) -> DataFrame:
    """(section, metric, value as text). Findings and correlations are written once below the shared folder; their counts
    and the bytes of the findings' JSON lines (``PAYLOAD`` columns) are observed in those writes. Scanner types come from
    the scorecard's ``metrics``, correlation types from the written column. ``timings`` (seconds by stage) are the caller's.
    """
    spark = findings.sparkSession
    line = F.octet_length(F.to_json(F.struct(*PAYLOAD))) + 1
    _, seen = sinks.observed(findings.select(*PAYLOAD), "report-findings", total_findings=F.count(F.lit(1)),
                             data_bytes=F.coalesce(F.sum(line), F.lit(0)))
    kept, linked = sinks.observed(correlations.select("id", "correlation_type"), "report-correlations",
                                  total_correlations=F.count(F.lit(1)))
    metrics = sinks.written(metrics, "report-metrics")
    stages = sinks.written(sc.stage_table(metrics), "report-stages")
    known = [("data_summary", "total_findings", seen["total_findings"]),
             ("data_summary", "total_correlations", linked["total_correlations"]),
             ("dataset_characteristics", "version", version), ("dataset_characteristics", "format", fmt),
             ("dataset_characteristics", "compressed", str(compressed).lower()),
             ("performance_metrics", "data_bytes", seen["data_bytes"]),
             *[("performance_metrics", f"seconds.{k}", v) for k, v in (timings or {}).items()]]
    fixed = spark.createDataFrame([(s, m, str(v)) for s, m, v in known], "section string, metric string, value string")

    def row(df: DataFrame, section: str, metric: str, value) -> DataFrame:
        return df.select(F.lit(section).alias("section"), F.lit(metric).alias("metric"), value.cast("string").alias("value"))

    roll = sc.overall_status(stages)
    scanners = metrics.where("stage = 'quality_scoring' and metric = 'scanner_coverage'")
    quality = stages.where("stage = 'quality_scoring'")
    return (fixed.unionByName(row(scanners, "data_summary", "scanner_types", F.col("value").cast("long")))
            .unionByName(row(kept.agg(F.count_distinct("correlation_type").alias("n")), "data_summary", "correlation_types", F.col("n")))
            .unionByName(row(roll, "quality_metrics", "verification_status", F.col("overall_status")))
            .unionByName(row(roll, "quality_metrics", "stages_passed", F.col("stages_passed")))
            .unionByName(row(quality, "quality_metrics", "quality_score", F.col("score").cast("decimal(18,4)")))
            .unionByName(sc.recommendations(stages).select(F.lit("recommendations").alias("section"), F.col("stage").alias("metric"),
                                                           F.col("recommendation").alias("value"))))
