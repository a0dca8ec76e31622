"""Five-stage verification scorecard (V7-V25) as small distributed aggregates.

Every stage reduces the (possibly huge) findings / correlations / edge tables
to a handful of numbers with partial (map-side) aggregation; only those
numbers meet at the end, in one tiny global aggregate. No stage collects rows
to the driver and nothing is broadcast except what Catalyst sizes itself.

Inputs
  findings      id, scanner, title, severity, risk_score, description, metadata, category, ord (+ raw optional)
  correlations  id, correlation_refs array<string>, correlation_type (+ the finding columns)
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import fixed
from vigil.functions import severity as sev
from vigil.sources.sinks import written


# --------------------------------------------------------------------------------------
# key presence (T3): from the JSON text when rows came from JSON, else from the schema
# --------------------------------------------------------------------------------------
def present_keys(df: DataFrame) -> Column:
    if "raw" in df.columns:
        return F.coalesce(F.json_object_keys(F.col("raw")), F.array().cast("array<string>"))
    return F.array(*[F.lit(c) for c in df.columns])


def missing_keys(df: DataFrame, required: list[str]) -> Column:
    return F.array_except(F.array(*[F.lit(k) for k in required]), present_keys(df))


def _long(stage: str, **metrics: Column) -> list[Column]:
    return [F.struct(F.lit(stage).alias("stage"), F.lit(k).alias("metric"), v.cast("double").alias("value"))
            for k, v in metrics.items()]


def _metrics_frame(agg: DataFrame, cols: list[Column]) -> DataFrame:
    return agg.select(F.explode(F.array(*cols)).alias("m")).select("m.*")


# --------------------------------------------------------------------------------------
# V7 schema stage
# --------------------------------------------------------------------------------------
def schema_metrics(findings: DataFrame, correlations: DataFrame) -> DataFrame:
    f_bad = F.size(missing_keys(findings, fixed.SCHEMA_REQUIRED)) > 0
    c_bad = F.size(missing_keys(correlations, fixed.SCHEMA_REQUIRED + fixed.SCHEMA_REQUIRED_CORRELATION_EXTRA)) > 0
    both = (findings.select(f_bad.alias("bad"))
            .unionByName(correlations.select(c_bad.alias("bad"))))
    agg = both.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("bad")).alias("invalid"))
    return _metrics_frame(agg, _long("schema_validation",
                                     total_findings=F.col("total"),
                                     valid_findings=F.col("total") - F.col("invalid"),
                                     invalid_findings=F.col("invalid")))


def schema_invalid_details(findings: DataFrame, correlations: DataFrame) -> DataFrame:
    """All invalid rows (id, scanner, missing_fields); the scorecard shows the first 10."""
    f = findings.select(F.coalesce(F.col("id"), F.lit("unknown")).alias("id"), F.col("scanner"),
                        missing_keys(findings, fixed.SCHEMA_REQUIRED).alias("missing_fields"))
    c = correlations.select(F.coalesce(F.col("id"), F.lit("unknown")).alias("id"), F.lit("correlation").alias("scanner"),
                            missing_keys(correlations, fixed.SCHEMA_REQUIRED + fixed.SCHEMA_REQUIRED_CORRELATION_EXTRA)
                            .alias("missing_fields"))
    return f.unionByName(c).where(F.size("missing_fields") > 0)


# --------------------------------------------------------------------------------------
# V8 / V10 / J16 / V12 consistency stage
# --------------------------------------------------------------------------------------
def duplicate_id_count(findings: DataFrame, correlations: DataFrame) -> DataFrame:
    """V8: occurrences beyond the first (null ids group together)."""
    ids = findings.select("id").unionByName(correlations.select("id"))
    per_id = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_ids"))


def band_violation_flag(df: DataFrame, bands=fixed.SCORECARD_BANDS) -> Column:
    risk = F.coalesce(F.col("risk_score").cast("double"), F.lit(0.0)) if "risk_score" in df.columns else F.lit(0.0)
    return sev.band_violation(F.col("severity"), risk, bands)


#: End of the id under which members that all correlations of a type share are kept as edges.
SHARED = ":*"


def _type_of(correlations: DataFrame) -> Column:
    return F.coalesce(F.col("correlation_type"), F.lit("")) if "correlation_type" in correlations.columns else F.lit("")


def ref_rows(correlations: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """(correlation_id, ref, n): from the reference lists, or from an edge table when the lists
    are kept as edges (n = multiplicity)."""
    if edges is not None:
        return edges.select("correlation_id", F.col("finding_id").alias("ref"), F.col("n").cast("long").alias("n"))
    return correlations.select(F.col("id").alias("correlation_id"), F.explode("correlation_refs").alias("ref"),
                               F.lit(1).cast("long").alias("n"))


def broken_refs(correlations: DataFrame, findings: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """References to ids that are neither findings nor correlations."""
    refs = ref_rows(correlations, edges)
    known = findings.select(F.col("id").alias("ref")).unionByName(correlations.select(F.col("id").alias("ref")))
    return refs.join(known, "ref", "left_anti")


def consistency_metrics(findings: DataFrame, correlations: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    dup = duplicate_id_count(findings, correlations)
    bands = findings.agg(F.count_if(band_violation_flag(findings)).alias("severity_inconsistencies"))
    broken = broken_refs(correlations, findings, edges).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("broken_correlations"))
    parts = [
        _metrics_frame(dup, _long("consistency_check", duplicate_ids=F.col("duplicate_ids"))),
        _metrics_frame(bands, _long("consistency_check", severity_inconsistencies=F.col("severity_inconsistencies"))),
        _metrics_frame(broken, _long("consistency_check", broken_correlations=F.col("broken_correlations"))),
    ]
    return reduce(DataFrame.unionByName, parts)


# --------------------------------------------------------------------------------------
# V13 realism stage
# --------------------------------------------------------------------------------------
def realism_metrics(findings: DataFrame) -> DataFrame:
    counts = findings.agg(F.count(F.lit(1)).alias("total"),
                          *[F.count_if(F.col("severity") == s).alias(s) for s in fixed.SEVERITIES])
    total = F.nullif(F.col("total").cast("double"), F.lit(0.0))
    score = None
    for s, expected in fixed.REALISM_EXPECTED.items():
        dev = F.abs(F.col(s) / total - F.lit(expected))
        term = F.lit(1.0) - F.least(dev * 2, F.lit(1.0))
        score = term if score is None else score + term
    score = score / F.lit(len(fixed.REALISM_EXPECTED))
    score = (score * F.when(F.col("critical") > total * 0.1, F.lit(0.8)).otherwise(F.lit(1.0))
             * F.when(F.col("info") < total * 0.2, F.lit(0.9)).otherwise(F.lit(1.0)))
    score = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(score)
    issues = None
    for s, expected in fixed.REALISM_EXPECTED.items():
        flag = F.when(F.abs(F.col(s) / total - F.lit(expected)) > 0.15, 1).otherwise(0)
        issues = flag if issues is None else issues + flag
    issues = (issues + F.when(F.col("critical") > total * 0.1, 1).otherwise(0)
              + F.when(F.col("info") < total * 0.2, 1).otherwise(0))
    issues = F.when(F.col("total") == 0, F.lit(1)).otherwise(issues)
    return _metrics_frame(counts, _long("realism_assessment", realism_score=score, issues=issues,
                                        total=F.col("total")))


# --------------------------------------------------------------------------------------
# V14-V16 correlation stage
# --------------------------------------------------------------------------------------
def findings_by_id(findings: DataFrame) -> DataFrame:
    """X1-style lookup: one row per id, the last duplicate (highest ord) wins."""
    return (findings.groupBy("id")
            .agg(F.max_by(F.coalesce(F.col("severity"), F.lit("info")), F.col("ord")).alias("ref_severity")))


def correlation_quality(correlations: DataFrame, findings: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """V14 per correlation: 0 without refs; x0.8 if any ref is missing; x(0.5+0.5*mean weight)."""
    refs = ref_rows(correlations, edges)
    looked = refs.join(findings_by_id(findings).withColumnRenamed("id", "ref"), "ref", "left")
    agg = looked.groupBy("correlation_id").agg(
        F.sum("n").alias("n_refs"),
        F.sum(F.when(F.col("ref_severity").isNotNull(), F.col("n")).otherwise(F.lit(0))).alias("found"),
        F.sum(F.when(F.col("ref_severity").isNotNull(), sev.severity_weight(F.col("ref_severity")) * F.col("n"))
              .otherwise(F.lit(0.0))).alias("wsum"),
    )
    heads = correlations.select(F.col("id").alias("correlation_id"), _type_of(correlations).alias("_type")).distinct()
    per = heads.join(agg, "correlation_id", "left")
    if edges is not None:
        # members that all correlations of a type share are added to each: one row of sums per type
        shared = agg.where(F.col("correlation_id").endswith(SHARED)).select(
            F.regexp_replace("correlation_id", ":\\*$", "").alias("_type"), F.col("n_refs").alias("_n"),
            F.col("found").alias("_f"), F.col("wsum").alias("_w"))
        per = per.join(shared, (heads["_type"] == shared["_type"]) & ~F.col("correlation_id").endswith(SHARED), "left")
        extra = {"n_refs": "_n", "found": "_f", "wsum": "_w"}
    else:
        extra = {}
    per = per.select("correlation_id", *[
        (F.coalesce(F.col(c), F.lit(0)) + (F.coalesce(F.col(extra[c]), F.lit(0)) if c in extra else F.lit(0))).alias(c)
        for c in ("n_refs", "found", "wsum")])
    q = (F.when(F.col("found") < F.col("n_refs"), F.lit(0.8)).otherwise(F.lit(1.0))
         * (F.lit(0.5) + F.col("wsum") / F.nullif(F.col("n_refs"), F.lit(0)) * F.lit(0.5)))
    return per.select("correlation_id", "n_refs", "found",
                      F.when(F.col("n_refs") == 0, F.lit(0.0)).otherwise(F.least(q, F.lit(1.0))).alias("quality"))


def redundant_correlations(correlations: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Same (sorted refs, type) beyond the first.

    With an edge table the sorted list is replaced by an order-free multiset
    signature (count and two 64-bit hash sums), so no list is ever built.
    """
    if edges is not None:
        r = ref_rows(correlations, edges).groupBy("correlation_id").agg(
            F.sum("n").alias("c"), F.sum(F.xxhash64("ref").cast("decimal(38,0)") * F.col("n")).alias("h1"),
            F.sum(F.hash("ref").cast("decimal(38,0)") * F.col("n")).alias("h2"))
        sig = (correlations.select(F.col("id").alias("correlation_id"),
                                   F.coalesce(F.col("correlation_type"), F.lit("")).alias("ctype"))
               .join(r, "correlation_id", "left")
               .select(F.struct(F.coalesce("c", F.lit(0)), F.coalesce("h1", F.lit(0)), F.coalesce("h2", F.lit(0)))
                       .alias("refs"), "ctype"))
        return sig.groupBy("refs", "ctype").count().agg(
            F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("redundant"))
    sig = correlations.select(F.sort_array(F.coalesce(F.col("correlation_refs"), F.array().cast("array<string>")))
                              .alias("refs"),
                              F.coalesce(F.col("correlation_type"), F.lit("")).alias("ctype"))
    return sig.groupBy("refs", "ctype").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("redundant"))


def correlation_metrics(correlations: DataFrame, findings: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    q = correlation_quality(correlations, findings, edges).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.avg("quality"), F.lit(0.0)).alias("avg_quality"))
    r = redundant_correlations(correlations, edges)
    return reduce(DataFrame.unionByName, [
        _metrics_frame(q, _long("correlation_validation", correlation_quality_score=F.col("avg_quality"),
                                correlations=F.col("n"))),
        _metrics_frame(r, _long("correlation_validation", redundant=F.col("redundant"))),
    ])


# --------------------------------------------------------------------------------------
# V17-V21 quality stage
# --------------------------------------------------------------------------------------
def diversity_score(findings: DataFrame) -> DataFrame:
    per_scanner = (findings.select("scanner", F.coalesce(F.col("title"), F.lit("")).alias("t"))
                   .groupBy("scanner")
                   .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("t").alias("u")))
    return per_scanner.agg(
        F.count(F.lit(1)).alias("scanners"),
        F.coalesce(F.avg(F.least(F.col("u") / F.nullif(F.col("n"), F.lit(0)), F.lit(1.0))), F.lit(0.0)).alias("type_div"),
    ).select(F.when(F.col("scanners") == 0, F.lit(0.0)).otherwise(
        (F.least(F.col("scanners") / F.lit(float(fixed.SCANNER_NORMALISER)), F.lit(1.0)) + F.col("type_div")) / 2
    ).alias("diversity_score"), F.col("scanners"))


def finding_stats(findings: DataFrame) -> DataFrame:
    """Completeness and consistency inputs in one pass."""
    complete = F.size(missing_keys(findings, fixed.COMPLETENESS_KEYS)) == 0
    r = F.col("risk_score").cast("double")
    valid = r.isNotNull() & ~F.isnan(r) & (r >= 0) & (r <= 100)
    return findings.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(complete).alias("complete"),
        F.count_if(valid).alias("n_valid"),
        F.avg(F.when(valid, r)).alias("mean_risk"),
        F.stddev_samp(F.when(valid, r)).alias("sd_risk"),
    )


def coverage(findings: DataFrame, correlations: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """V20 (T14): distinct refs, broken ones included, over total findings, cap 1."""
    return ref_rows(correlations, edges).agg(F.count_distinct("ref").alias("distinct_refs"))


def quality_metrics(findings: DataFrame, correlations: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    d = diversity_score(findings)
    s = finding_stats(findings)
    c = coverage(findings, correlations, edges)
    total = F.nullif(F.col("total").cast("double"), F.lit(0.0))
    completeness = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.col("complete") / total)
    sd = F.coalesce(F.col("sd_risk"), F.lit(0.0))
    consistency = F.when(F.col("n_valid") == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) - (F.abs(F.col("mean_risk") - 50) / 50
                                             + F.least(F.abs(sd - 20) / 20, F.lit(1.0))) / 2))
    return reduce(DataFrame.unionByName, [
        _metrics_frame(d, _long("quality_scoring", diversity_score=F.col("diversity_score"),
                                scanner_coverage=F.col("scanners"))),
        _metrics_frame(s, _long("quality_scoring", completeness_score=completeness,
                                consistency_score=consistency, total_findings=F.col("total"))),
        _metrics_frame(c, _long("quality_scoring", distinct_refs=F.col("distinct_refs"))),
    ])


# --------------------------------------------------------------------------------------
# All metrics, stage statuses, V22 roll-up, V23 summary, V24 recommendations
# --------------------------------------------------------------------------------------
def finding_pass(findings: DataFrame) -> DataFrame:
    """Every finding-level number of the scorecard in ONE aggregate (one scan, one tiny exchange):
    schema validity, band violations, the severity mix, completeness and the risk moments."""
    f_bad = F.size(missing_keys(findings, fixed.SCHEMA_REQUIRED)) > 0
    complete = F.size(missing_keys(findings, fixed.COMPLETENESS_KEYS)) == 0
    r = F.col("risk_score").cast("double")
    valid = r.isNotNull() & ~F.isnan(r) & (r >= 0) & (r <= 100)
    return findings.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(f_bad).alias("invalid"),
        F.count_if(band_violation_flag(findings)).alias("severity_inconsistencies"),
        *[F.count_if(F.col("severity") == s).alias(s) for s in fixed.SEVERITIES],
        F.count_if(complete).alias("complete"),
        F.count_if(valid).alias("n_valid"),
        F.avg(F.when(valid, r)).alias("mean_risk"),
        F.stddev_samp(F.when(valid, r)).alias("sd_risk"),
    )


def _realism_from(counts: DataFrame) -> DataFrame:
    total = F.nullif(F.col("total").cast("double"), F.lit(0.0))
    score = None
    issues = None
    for s, expected in fixed.REALISM_EXPECTED.items():
        dev = F.abs(F.col(s) / total - F.lit(expected))
        term = F.lit(1.0) - F.least(dev * 2, F.lit(1.0))
        score = term if score is None else score + term
        flag = F.when(dev > 0.15, 1).otherwise(0)
        issues = flag if issues is None else issues + flag
    score = score / F.lit(len(fixed.REALISM_EXPECTED))
    score = (score * F.when(F.col("critical") > total * 0.1, F.lit(0.8)).otherwise(F.lit(1.0))
             * F.when(F.col("info") < total * 0.2, F.lit(0.9)).otherwise(F.lit(1.0)))
    score = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(score)
    issues = (issues + F.when(F.col("critical") > total * 0.1, 1).otherwise(0)
              + F.when(F.col("info") < total * 0.2, 1).otherwise(0))
    issues = F.when(F.col("total") == 0, F.lit(1)).otherwise(issues)
    return _metrics_frame(counts, _long("realism_assessment", realism_score=score, issues=issues,
                                        total=F.col("total")))


def _stage_metrics(findings: DataFrame, correlations: DataFrame, edges: DataFrame | None) -> dict[str, Callable[[], DataFrame]]:
    """The raw metrics by stage, each made only when called."""
    total = F.nullif(F.col("total").cast("double"), F.lit(0.0))

    def schema() -> DataFrame:
        c_bad = F.size(missing_keys(correlations, fixed.SCHEMA_REQUIRED + fixed.SCHEMA_REQUIRED_CORRELATION_EXTRA)) > 0
        cp = correlations.agg(F.count(F.lit(1)).alias("total"), F.count_if(c_bad).alias("invalid"))
        both = finding_pass(findings).select("total", "invalid").unionByName(cp).agg(
            F.sum("total").alias("total"), F.sum("invalid").alias("invalid"))
        return _metrics_frame(both, _long("schema_validation", total_findings=F.col("total"),
                                          valid_findings=F.col("total") - F.col("invalid"),
                                          invalid_findings=F.col("invalid")))

    def consistent() -> DataFrame:
        dup = duplicate_id_count(findings, correlations)
        broken = broken_refs(correlations, findings, edges).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("broken_correlations"))
        return reduce(DataFrame.unionByName, [
            _metrics_frame(dup, _long("consistency_check", duplicate_ids=F.col("duplicate_ids"))),
            _metrics_frame(finding_pass(findings), _long("consistency_check",
                                                         severity_inconsistencies=F.col("severity_inconsistencies"))),
            _metrics_frame(broken, _long("consistency_check", broken_correlations=F.col("broken_correlations")))])

    def quality() -> DataFrame:
        sd = F.coalesce(F.col("sd_risk"), F.lit(0.0))
        consistency = F.when(F.col("n_valid") == 0, F.lit(0.0)).otherwise(
            F.greatest(F.lit(0.0), F.lit(1.0) - (F.abs(F.col("mean_risk") - 50) / 50
                                                 + F.least(F.abs(sd - 20) / 20, F.lit(1.0))) / 2))
        return reduce(DataFrame.unionByName, [
            _metrics_frame(diversity_score(findings), _long("quality_scoring", diversity_score=F.col("diversity_score"),
                                                            scanner_coverage=F.col("scanners"))),
            _metrics_frame(finding_pass(findings), _long(
                "quality_scoring", completeness_score=F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.col("complete") / total),
                consistency_score=consistency, total_findings=F.col("total"))),
            _metrics_frame(coverage(findings, correlations, edges),
                           _long("quality_scoring", distinct_refs=F.col("distinct_refs")))])

    return {"schema_validation": schema, "consistency_check": consistent,
            "realism_assessment": lambda: _realism_from(finding_pass(findings)),
            "correlation_validation": lambda: correlation_metrics(correlations, findings, edges),
            "quality_scoring": quality}


def scorecard_metrics(findings: DataFrame, correlations: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Long table (stage, metric, value) of every raw metric.

    Finding-level numbers come from one fused aggregate (``finding_pass``);
    the keyed work (duplicate ids, reference lookups, per-scanner titles)
    runs as its own partial aggregates. ``edges`` (correlation_id, finding_id, n)
    replaces the reference lists when they are kept as an edge table.
    """
    return reduce(DataFrame.unionByName, [make() for make in _stage_metrics(findings, correlations, edges).values()])


def isolated_stages(findings: DataFrame, correlations: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """(stage, status, passed, score, error). Each stage is a written result of its own; one whose plan or job fails
    becomes a row ``error``, not passed, without a score, with the error's class, and the others stand."""
    spark, done, failed = findings.sparkSession, [], []
    for stage, make in _stage_metrics(findings, correlations, edges).items():
        try:
            done.append(written(make(), f"stage-{stage}"))
        except PySparkException as e:
            failed.append((stage, "error", False, None, e.getCondition() or type(e).__name__))
    errors = spark.createDataFrame(failed, "stage string, status string, passed boolean, score double, error string")
    if not done:
        return errors
    gone = [stage for stage, *_ in failed]
    kept = stage_table(reduce(DataFrame.unionByName, done)).where(~F.col("stage").isin(*gone) if gone else F.lit(True))
    return kept.withColumn("error", F.lit(None).cast("string")).unionByName(errors)


def _wide(metrics: DataFrame) -> DataFrame:
    """One row, one column per stage.metric (a single tiny global aggregate)."""
    keys = F.concat_ws(".", "stage", "metric")
    return metrics.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(keys, F.col("value")))).alias("m"))


def _m(name: str) -> Column:
    return F.col("m")[name]


def stage_table(metrics: DataFrame) -> DataFrame:
    """(stage, status, passed, score) for the five stages."""
    w = _wide(metrics)
    invalid = _m("schema_validation.invalid_findings")
    issues_c = (F.when(_m("consistency_check.duplicate_ids") > 0, 1).otherwise(0)
                + F.when(_m("consistency_check.severity_inconsistencies") > 0, 1).otherwise(0)
                + F.when(_m("consistency_check.broken_correlations") > 0, 1).otherwise(0))
    realism = _m("realism_assessment.realism_score")
    total = _m("realism_assessment.total")
    cq = _m("correlation_validation.correlation_quality_score")
    n_corr = _m("correlation_validation.correlations")
    n_find = _m("quality_scoring.total_findings")
    cov = F.when(n_find == 0, F.lit(0.0)).otherwise(F.least(_m("quality_scoring.distinct_refs") / F.nullif(n_find, F.lit(0.0)), F.lit(1.0)))
    overall_q = (_m("quality_scoring.diversity_score") + _m("quality_scoring.completeness_score")
                 + _m("quality_scoring.consistency_score") + cov) / 4
    def row(stage, status, passed, score):
        return F.struct(F.lit(stage).alias("stage"), status.alias("status"), passed.alias("passed"),
                        score.cast("double").alias("score"))

    rows = F.array(
        row("schema_validation", F.when(invalid == 0, "passed").otherwise("failed"), invalid == 0, invalid),
        row("consistency_check",
            F.when(issues_c == 0, "passed").when(issues_c <= 2, "warning").otherwise("failed"),
            issues_c == 0, issues_c),
        row("realism_assessment",
            F.when(total == 0, "failed").when(realism < 0.5, "failed").when(realism < 0.7, "warning")
            .otherwise("passed"),
            (total > 0) & (realism >= 0.5), realism),
        row("correlation_validation",
            F.when(n_corr == 0, "passed").when(cq < 0.4, "failed").when(cq < 0.6, "warning").otherwise("passed"),
            (n_corr == 0) | (cq >= 0.4), F.when(n_corr == 0, F.lit(0.0)).otherwise(cq)),
        row("quality_scoring",
            F.when(overall_q >= 0.7, "passed").when(overall_q >= 0.5, "warning").otherwise("failed"),
            overall_q >= 0.7, overall_q),
    )
    return w.select(F.inline(rows)).select("stage", "status", "passed", F.round("score", 6).alias("score"))


def overall_status(stages: DataFrame) -> DataFrame:
    """V22 + V23: roll-up and stage counts (an `error` stage is neither failed nor warning)."""
    n = F.count(F.lit(1))
    failed = F.count_if(F.col("status") == "failed")
    warning = F.count_if(F.col("status") == "warning")
    return stages.agg(
        F.when(failed > 0, "failed").when(warning > n / 2, "warning").otherwise("passed").alias("overall_status"),
        F.count_if(F.col("passed")).alias("stages_passed"),
        failed.alias("stages_failed"),
        warning.alias("stages_warning"),
    )


def recommendations(stages: DataFrame) -> DataFrame:
    """One line per failing stage (real numbers instead of the literal '.2f', T13)."""
    s = F.col("stage")
    line = (F.when((s == "schema_validation") & ~F.col("passed"),
                   F.format_string("Fix schema validation issues in %d findings", F.col("score").cast("long")))
            .when((s == "consistency_check") & ~F.col("passed"), F.lit("Address consistency issues"))
            .when((s == "realism_assessment") & (F.col("score") < 0.8),
                  F.format_string("Improve realism: score %.2f", F.col("score")))
            .when((s == "correlation_validation") & ~F.col("passed") & (F.col("score") < 0.6),
                  F.format_string("Improve correlation quality: score %.2f", F.col("score")))
            .when((s == "quality_scoring") & ~F.col("passed") & (F.col("score") < 0.7),
                  F.format_string("Improve overall quality: score %.2f", F.col("score"))))
    recs = stages.select("stage", line.alias("recommendation")).where(F.col("recommendation").isNotNull())
    good = (stages.agg(F.count_if(line.isNotNull()).alias("n"))
            .where(F.col("n") == 0)
            .select(F.lit("overall").alias("stage"),
                    F.lit("Dataset quality is good - no major issues found").alias("recommendation")))
    return recs.unionByName(good)


# --- A8: dataset metadata ---------------------------------------------------------------------------
PROCESSING_STEPS = ["data_normalization", "quality_assessment", "basic_enrichment", "structure_optimization",
                    "indexing", "metadata_generation"]


def dataset_metadata(findings: DataFrame, correlations: DataFrame, stages: DataFrame,
                     fmt: str = "optimized_json", compression: bool = False) -> DataFrame:
    """One row of dataset metadata (verification summary + characteristics). The id is the md5
    of the characteristics instead of the wall clock, so reruns on the same data agree."""
    roll = overall_status(stages)
    quality = stages.where(F.col("stage") == "quality_scoring").select(F.col("score").alias("quality_score"))
    f = findings.agg(F.count(F.lit(1)).alias("total_findings"), F.count_distinct("scanner").alias("scanner_coverage"))
    c = correlations.agg(F.count(F.lit(1)).alias("total_correlations"))
    k = F.lit(0)
    row = (roll.withColumn("_k", k).join(quality.withColumn("_k", k), "_k", "left")
           .join(f.withColumn("_k", k), "_k").join(c.withColumn("_k", k), "_k").drop("_k"))
    ident = F.substring(F.md5(F.concat_ws("|", F.col("total_findings"), F.col("total_correlations"),
                                          F.col("scanner_coverage"), F.col("overall_status"))), 1, 16)
    return row.select(ident.alias("dataset_id"), F.lit("2.0").alias("version"), F.lit(fmt).alias("format"),
                      F.lit(compression).alias("compression"), "overall_status", "stages_passed",
                      F.coalesce(F.col("quality_score"), F.lit(0.0)).alias("quality_score"),
                      "total_findings", "total_correlations", "scanner_coverage",
                      F.lit(",".join(PROCESSING_STEPS)).alias("processing_pipeline"))
