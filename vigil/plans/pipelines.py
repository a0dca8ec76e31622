"""End-to-end compositions of the operators (the two entry points of the model).

Entry A (findings pipeline): rationale back-fill -> pattern dedup -> per-category
sampling -> snapshot -> correlation rules -> scorecard -> normalisation -> export.
Entry B (training-set chain): flatten -> exact dedup -> stratified sample ->
split -> ChatML texts -> validation -> prompt/ground-truth pairs.

Each stage boundary that several consumers read is cut with ``snapshot``
(checkpoint into the shared checkpoint folder, or a written table), so a lost
executor recomputes from the last snapshot, not from the sources.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators import chatml as cm
from vigil.operators import correlate as cr
from vigil.operators import dedup as dd
from vigil.operators import normalize as nz
from vigil.operators import sample as sp
from vigil.operators import scorecard as sc
from vigil.sources import sinks


@dataclass
class FindingsResult:
    findings: DataFrame
    correlations: DataFrame
    correlation_edges: DataFrame
    stages: DataFrame
    summary: DataFrame
    recommendations: DataFrame


def findings_pipeline(findings: DataFrame, target: int = 2500, snapshot_dir: str | None = None,
                      sample: bool = True, dedup: bool = True) -> FindingsResult:
    """Entry A over a pooled findings table (scanner, category, ord, ... columns)."""
    f = cm.backfill_rationale(findings)
    if dedup:
        f = dd.dedup_exact_patterns(f).drop("pattern")
    if sample:
        f = sp.intelligent_sample(f, target)
    f = sinks.snapshot(f, f"{snapshot_dir}/sampled" if snapshot_dir else None)
    headers, edges = cr.run_rules(f)
    edges = sinks.snapshot(edges, f"{snapshot_dir}/edges" if snapshot_dir else None)
    rows = cr.correlation_rows(headers, edges)
    # members shared by all correlations of a rule stay edges under ``<type>:*``; the scorecard adds them to each
    corr = (rows
            .withColumnRenamed("correlation_id", "id")
            .withColumn("metadata", F.to_json(F.struct(F.col("kb_refs").alias("kb_refs"))))
            .withColumn("risk_subscores", F.lit(None).cast(
                "struct<impact:double,exposure:double,anomaly:double,confidence:double>"))
            .withColumn("correlation_refs", F.lit(None).cast("array<string>"))
            .withColumn("scanner", F.lit("correlation"))
            .withColumn("ord", F.monotonically_increasing_id()))
    corr = sinks.snapshot(corr, f"{snapshot_dir}/correlations" if snapshot_dir else None)
    metrics = sc.scorecard_metrics(f, corr, edges)
    stages = sc.stage_table(metrics)
    return FindingsResult(
        findings=nz.normalize_findings(f),
        correlations=nz.normalize_correlations(corr),
        correlation_edges=edges,
        stages=stages,
        summary=sc.overall_status(stages),
        recommendations=sc.recommendations(stages),
    )


@dataclass
class TrainingResult:
    splits: DataFrame
    texts: DataFrame
    validation: DataFrame
    prompts: DataFrame


def training_chain(findings: DataFrame, target: int = 0, ratios=(0.3, 0.6, 0.1), seed: str = "0",
                   stratify: bool = True, snapshot_dir: str | None = None) -> TrainingResult:
    """Entry B: every stage is a DataFrame transform; only the strata counts reach the driver.

    The ranked stages (sample, split) each read their input twice (counts, then
    ranks), so their inputs are snapshots: the plan stays linear in the number
    of stages and a lost executor restarts from the last snapshot.
    """
    def cut(df: DataFrame, name: str) -> DataFrame:
        return sinks.snapshot(df, f"{snapshot_dir}/{name}" if snapshot_dir else None)

    flat = cm.flatten_findings(findings)
    uniq = cut(dd.dedupe_items(flat, order_cols=("ord",)), "unique")
    chosen = cut(sp.stratified_sample(uniq, target, seed), "sampled") if target else uniq
    splits = cut((sp.stratified_split if stratify else sp.random_split)(chosen, ratios, seed), "splits")
    texts = cm.sft_texts(splits, passthrough=("split",))
    validation = cm.validate_chatml(texts)
    prompts = cm.prompt_pairs(texts)
    return TrainingResult(splits=splits, texts=texts, validation=validation, prompts=prompts)
