"""Row-level cleaning and coercion.

All operators are narrow projections: no shuffle, whole-stage codegen, and they
run unchanged on a streaming DataFrame.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions import chat as ch
from vigil.functions import jsontext as jt
from vigil.functions import fixed
from vigil.functions import text as tx

# A numeric literal as Python's float() accepts it (plus nan / inf), used
# before try_cast so that both engines agree on what parses (see SURVEY 7.4).
NUMERIC_RE = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|nan|inf|infinity)\s*$"


def coerce_double(c: Column, default) -> Column:
    """Numeric -> double; parseable string -> double; otherwise ``default``."""
    s = F.lower(c.cast("string"))
    parsed = F.when(s.rlike(NUMERIC_RE), F.trim(s).try_cast("double"))
    return F.coalesce(parsed, F.lit(default).cast("double"))


def coerce_int(c: Column, default: int) -> Column:
    """Truncate toward zero of the float parse; NaN/inf/unparseable -> default."""
    d = coerce_double(c, None)
    ok = d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf")))
    return F.when(ok, d.try_cast("long")).otherwise(F.lit(default).cast("long"))


def _has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def ensure_required(df: DataFrame) -> DataFrame:
    """Defaults for missing or null core fields."""
    out = df
    if not _has(out, "id"):
        out = out.withColumn("id", F.lit(None).cast("string"))
    digest = F.md5(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    defaults = {
        "title": F.lit(fixed.DEFAULT_TITLE),
        "severity": F.lit(fixed.DEFAULT_SEVERITY),
        "description": F.lit(fixed.DEFAULT_DESCRIPTION),
        "metadata": F.lit("{}"),
        "category": F.lit(fixed.DEFAULT_CATEGORY),
    }
    out = out.withColumn("id", F.coalesce(F.col("id").cast("string"), F.concat(F.lit("unknown_"), digest)))
    for name, default in defaults.items():
        out = out.withColumn(name, F.coalesce(F.col(name), default) if _has(out, name) else default)
    if _has(out, "tags"):
        out = out.withColumn("tags", F.coalesce(F.col("tags"), F.array().cast("array<string>")))
    else:
        out = out.withColumn("tags", F.array().cast("array<string>"))
    if not _has(out, "risk_score"):
        out = out.withColumn("risk_score", F.lit(fixed.DEFAULT_RISK))
    return out


def normalize_types(df: DataFrame) -> DataFrame:
    """Risk -> double (10.0 on failure), subscores -> double (0.5), tags -> list."""
    out = df.withColumn("risk_score", coerce_double(F.coalesce(F.col("risk_score").cast("string"),
                                                               F.lit(str(fixed.DEFAULT_RISK))),
                                                    float(fixed.DEFAULT_RISK)))
    if _has(out, "risk_subscores") and isinstance(out.schema["risk_subscores"].dataType, T.StructType):
        fields = out.schema["risk_subscores"].dataType.fieldNames()
        out = out.withColumn(
            "risk_subscores",
            F.when(F.col("risk_subscores").isNull(), F.lit(None)).otherwise(
                F.struct(*[
                    (coerce_double(F.col(f"risk_subscores.{f}"), fixed.DEFAULT_SUBSCORE)
                     if f in ("impact", "exposure", "anomaly", "confidence") else F.col(f"risk_subscores.{f}")).alias(f)
                    for f in fields
                ])
            ),
        )
    if _has(out, "tags") and not isinstance(out.schema["tags"].dataType, T.ArrayType):
        out = out.withColumn("tags", F.array(F.col("tags").cast("string")))
    return out


def clean_text(df: DataFrame) -> DataFrame:
    """P5: collapse whitespace in title and description."""
    return (df.withColumn("title", tx.collapse_whitespace(F.col("title")))
              .withColumn("description", tx.collapse_whitespace(F.col("description"))))


def quality_score(description: Column, metadata: Column, risk: Column) -> Column:
    """1.0, x0.8 no/placeholder description, x0.9 empty metadata, x0.7 risk outside 0..100."""
    no_desc = (F.coalesce(description, F.lit("")) == "") | (description == F.lit(fixed.DEFAULT_DESCRIPTION))
    meta_empty = metadata.isNull() | F.trim(metadata).isin("{}", "", "null", "[]")
    out_of_range = ~F.isnan(risk) & ((risk < 0) | (risk > 100))
    s = (F.when(no_desc, F.lit(0.8)).otherwise(F.lit(1.0))
         * F.when(meta_empty, F.lit(0.9)).otherwise(F.lit(1.0))
         * F.when(F.coalesce(out_of_range, F.lit(False)), F.lit(0.7)).otherwise(F.lit(1.0)))
    return F.round(s, 2)


def normalize_findings(df: DataFrame) -> DataFrame:
    """P1 -> P2..P4 -> P5 -> quality; ``_processed_at`` from the session clock."""
    out = clean_text(normalize_types(ensure_required(df)))
    return (out.withColumn("_data_quality", quality_score(F.col("description"), F.col("metadata"), F.col("risk_score")))
               .withColumn("_processed_at", F.current_timestamp()))


def normalize_correlations(df: DataFrame) -> DataFrame:
    """P1 -> P2..P4 -> P5, strength default 0.5."""
    out = clean_text(normalize_types(ensure_required(df)))
    strength = F.col("correlation_strength") if _has(out, "correlation_strength") else F.lit(None)
    return (out.withColumn("_correlation_strength", F.coalesce(strength.cast("double"), F.lit(fixed.DEFAULT_STRENGTH)))
               .withColumn("_processed_at", F.current_timestamp()))


def drop_null_fields(df: DataFrame, columns: tuple[str, ...] = ("metadata",), preserve: tuple[str, ...] = ()) -> DataFrame:
    """JSON object columns without their null members (recursively, but not inside lists); a column that is null or
    no object stays as it is."""
    for c in columns:
        clean = jt.without_nulls(jt.tokens(F.col(c)), preserve)
        df = df.withColumn(c, F.when(ch.is_json_object(F.col(c)), clean).otherwise(F.col(c)))
    return df


def matches(criteria: dict, column: Column | None = None) -> Column:
    """whether a JSON object meets nested criteria: a dict recurses, a list is "one of", anything else is equality;
    a missing key, or a list where a value is asked for, is no match.

    ``column``: a VARIANT (see ``find_related``).
    """
    out = F.lit(True)
    for key, wanted in criteria.items():
        value = F.try_variant_get(column, f"$['{key}']", "variant")
        kind = F.schema_of_variant(value)
        if isinstance(wanted, dict):
            hit = kind.startswith("OBJECT") & matches(wanted, value)
        else:
            options = wanted if isinstance(wanted, list) else [wanted]
            texts = [F.to_json(value) == F.lit(json.dumps(w, ensure_ascii=False)) for w in options]
            hit = F.lit(False)
            for t in texts:
                hit = hit | t
        out = out & F.coalesce(hit, F.lit(False))
    return out


def find_related(findings: DataFrame, criteria: dict) -> DataFrame:
    """ids of the findings that meet the criteria on their columns and their metadata."""
    row = F.try_parse_json(F.to_json(F.struct(*[c for c in findings.columns if c != "metadata"])))
    meta = F.try_parse_json("metadata") if "metadata" in findings.columns else None
    plain = {k: v for k, v in criteria.items() if k != "metadata"}
    hit = matches(plain, row)
    if "metadata" in criteria:
        hit = hit & (matches(criteria["metadata"], meta) if meta is not None and isinstance(criteria["metadata"], dict)
                     else F.lit(False))
    return findings.where(hit).select("id")
