"""Severity-driven column expressions: ranks, bands, tags, weights."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions import fixed


def severity_rank(sev: Column) -> Column:
    """1..5 for info..critical, 0 for anything else."""
    return F.coalesce(F.array_position(F.array(*[F.lit(s) for s in fixed.SEVERITIES]), sev).cast("int"),
                      F.lit(0))


def severity_from_risk(risk: Column) -> Column:
    """Half-open cuts 20/40/70/90 (the adapter's own rule)."""
    return (F.when(risk < 20, "info").when(risk < 40, "low").when(risk < 70, "medium")
            .when(risk < 90, "high").otherwise("critical"))


def lookup(mapping: dict, key: Column, default=None) -> Column:
    """Small literal map lookup; stays inside codegen (no join)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    val = F.try_element_at(m, key)
    return val if default is None else F.coalesce(val, F.lit(default))


def severity_tags(scanner: Column, sev: Column, baseline: Column) -> Column:
    """[scanner, baseline:<status>] + severity tags."""
    base = F.array(scanner, F.concat(F.lit("baseline:"), baseline))
    extra = (F.when(sev.isin("high", "critical"), F.array(*[F.lit(t) for t in fixed.TAGS_HIGH]))
             .when(sev == "medium", F.array(*[F.lit(t) for t in fixed.TAGS_MEDIUM]))
             .when(sev.isin("low", "info"), F.array(*[F.lit(t) for t in fixed.TAGS_LOW]))
             .otherwise(F.array().cast("array<string>")))
    return F.concat(base, extra)


def subscore_multiplier(sev: Column) -> Column:
    return lookup(fixed.SUBSCORE_MULTIPLIERS, sev, fixed.SUBSCORE_MULTIPLIER_DEFAULT)


def midpoint_subscores(sev: Column) -> Column:
    """P19 with the random draw replaced by the midpoint of its range."""
    m = subscore_multiplier(sev)
    v = F.round(m * F.lit(0.55), 2)
    return F.struct(v.alias("impact"), v.alias("exposure"), v.alias("anomaly"),
                    F.lit(0.82).alias("confidence"))


def probability_actionable(risk: Column) -> Column:
    """P20 deterministic part: min(1, risk/100) rounded to 3."""
    return F.round(F.least(F.lit(1.0), risk / F.lit(100.0)), 3)


def context_risk(sev: Column) -> Column:
    return lookup(fixed.CONTEXT_RISK, sev)


def severity_weight(sev: Column) -> Column:
    return lookup(fixed.SEVERITY_WEIGHTS, sev, fixed.SEVERITY_WEIGHT_DEFAULT)


def band_violation(sev: Column, risk: Column, bands: dict, unknown=None) -> Column:
    """True when risk lies outside the inclusive band of its severity.

    NaN is a violation (``NOT between`` is true for NaN in both engines). A
    severity outside the table is no violation unless ``unknown`` gives a band.
    """
    lo = lookup({k: float(v[0]) for k, v in bands.items()}, sev)
    hi = lookup({k: float(v[1]) for k, v in bands.items()}, sev)
    if unknown is not None:
        lo = F.coalesce(lo, F.lit(float(unknown[0])))
        hi = F.coalesce(hi, F.lit(float(unknown[1])))
    inside = (risk >= lo) & (risk <= hi) & ~F.isnan(risk)
    return lo.isNotNull() & ~F.coalesce(inside, F.lit(False))
