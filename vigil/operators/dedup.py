"""Exact and pattern dedup (D1, D2 exact pass, P21, P22).

Both keep one row per key. They are written as aggregates with
``min_by`` (sorted ones, as the kept row holds strings), which combine map-side: a key holding a third of all rows is
reduced to one row per input partition before the shuffle, never sorted or
buffered whole in one task (a ``row_number`` window would be).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import fixed


def _meta_token(meta: Column, key: str) -> Column:
    """Python ``str(metadata.get(key, ''))`` over JSON text: missing -> '', null -> 'None'."""
    val = F.get_json_object(meta, f"$.{key}")
    keys = F.coalesce(F.json_object_keys(meta), F.array().cast("array<string>"))
    as_py = F.when(val == "true", "True").when(val == "false", "False").otherwise(val)
    return F.when(val.isNull(), F.when(F.array_contains(keys, key), "None").otherwise("")).otherwise(as_py)


def dedup_pattern(category: Column, severity: Column, title: Column, description: Column,
                  metadata: Column) -> Column:
    """``category:severity:t|p|i|c|f`` (+ ``:md5(title|description)[:8]`` when all five are empty)."""
    toks = [_meta_token(metadata, k) for k in fixed.PATTERN_KEYS]
    base = F.concat(F.coalesce(category, F.lit("unknown")), F.lit(":"), F.coalesce(severity, F.lit("unknown")),
                    F.lit(":"), F.concat_ws("|", *toks))
    empty = None
    for t in toks:
        e = t == ""
        empty = e if empty is None else (empty & e)
    digest = F.substring(F.md5(F.concat(F.coalesce(title, F.lit("")), F.lit("|"),
                                        F.coalesce(description, F.lit("")))), 1, 8)
    return F.when(empty, F.concat(base, F.lit(":"), digest)).otherwise(base)


def cluster_pattern(metadata: Column) -> Column:
    """Truthy ones of the five pattern fields joined by '|', else 'generic'."""
    parts = []
    for k in fixed.PATTERN_KEYS:
        v = F.get_json_object(metadata, f"$.{k}")
        truthy = v.isNotNull() & ~v.isin("", "false", "0", "0.0", "[]", "{}")
        parts.append(F.when(truthy, F.when(v == "true", "True").otherwise(v)))
    joined = F.concat_ws("|", *parts)
    return F.when(joined == "", "generic").otherwise(joined)


def cluster_key(category: Column, severity: Column, metadata: Column) -> Column:
    return F.concat_ws("_", F.coalesce(category, F.lit("unknown")), F.coalesce(severity, F.lit("unknown")),
                       cluster_pattern(metadata))


def keep_first(df: DataFrame, keys: list, order: Column) -> DataFrame:
    """One row per key: the row with the smallest ``order`` (nulls in keys compare equal)."""
    cols = df.columns
    packed = F.struct(*[F.col(c) for c in cols])
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return (df.groupBy(*key_cols).agg(F.min_by(packed, order).alias("_row"))
              .select("_row.*"))


def dedupe_items(df: DataFrame, order_cols=("source_ord", "line")) -> DataFrame:
    """Exact dedup on (title, description, category, rationale), first in input order wins."""
    order = F.struct(*[F.col(c) for c in order_cols if c in df.columns])
    keys = [c for c in ("title", "description", "category", "rationale") if c in df.columns]
    return keep_first(df, keys, order)


def dedup_exact_patterns(df: DataFrame) -> DataFrame:
    """D2 exact pass: per P21 pattern keep the highest risk (missing as 0), earliest ord on ties."""
    pattern = dedup_pattern(F.col("category"), F.col("severity"), F.col("title"), F.col("description"),
                            F.col("metadata"))
    with_key = df.withColumn("_pattern", pattern)
    order = F.struct((-F.coalesce(F.col("risk_score").cast("double"), F.lit(0.0))).alias("r"), F.col("ord"))
    return keep_first(with_key, ["_pattern"], order).withColumnRenamed("_pattern", "pattern")
