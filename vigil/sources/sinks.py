"""Sinks (K1-K6) and lineage cuts.

Writes go through the DataFrame writer, so they are distributed, atomic per
task (output committer) and survive executor loss by task retry. Snapshots
between stages use ``checkpoint()`` into the cluster's shared
``spark.checkpoint.dir`` or a written table under a caller-given shared path;
never a machine-local folder and never ``localCheckpoint``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = False, compression: str | None = None,
                mode: str = "overwrite") -> None:
    """K1: one JSON object per line; non-ASCII kept; ``keep_nulls`` writes null fields explicitly."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    cols = [F.parse_json(F.col(c)).alias(c) if c == "metadata" else F.col(c) for c in df.columns]
    w = df.select(F.to_json(F.struct(*cols), opts).alias("value")).write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def export_dataset(findings: DataFrame, correlations: DataFrame, path: str, fmt: str = "parquet",
                   compression: str | None = None) -> dict[str, str]:
    """K2/A10: findings partitioned by (scanner, severity) so readers prune partitions; correlations,
    statistics and indexes as sibling tables. ``fmt`` is parquet or json; other names raise."""
    if fmt not in ("parquet", "json"):
        raise ValueError(f"unsupported export format: {fmt}")
    from vigil.operators import aggregate as ag

    out = {"findings": f"{path}/findings", "correlations": f"{path}/correlations",
           "risk_stats": f"{path}/risk_stats", "correlation_stats": f"{path}/correlation_stats",
           "histograms": f"{path}/histograms", "index_by_id": f"{path}/index_by_id",
           "correlations_by_finding": f"{path}/correlations_by_finding"}

    def w(df: DataFrame, p: str, parts=None):
        writer = df.write.mode("overwrite")
        if compression:
            writer = writer.option("compression", compression)
        if parts:
            writer = writer.partitionBy(*parts)
        writer.format(fmt).save(p)

    w(findings.withColumn("severity", F.coalesce(F.col("severity"), F.lit("info"))), out["findings"],
      ["scanner", "severity"])
    w(correlations, out["correlations"])
    w(ag.risk_stats(findings), out["risk_stats"])
    w(ag.correlation_stats(correlations), out["correlation_stats"])
    w(ag.histograms(findings), out["histograms"])
    w(ag.index_by_id(findings), out["index_by_id"])
    w(ag.correlations_by_finding(correlations), out["correlations_by_finding"])
    return out


def written_sizes(spark: SparkSession, path: str) -> int:
    """K3: bytes on storage under ``path`` (Hadoop FS content summary)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(conf).getContentSummary(p).getLength())


def payload_size(df: DataFrame) -> int:
    """K3: uncompressed JSON size of a frame, computed by a distributed sum."""
    return int(df.select(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("n")).first()["n"] or 0)


def snapshot(df: DataFrame, path: str | None = None) -> DataFrame:
    """K4: cut lineage. With ``path`` (a shared folder) the stage is written as parquet and read back;
    otherwise ``checkpoint()`` into the session's shared checkpoint directory."""
    if path:
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """K4: ``df`` written once below the session's shared checkpoint directory and read back from there."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    out = df.write.partitionBy(by) if by else df.write
    out.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """K4 with figures: ``written``, and aggregates taken while the rows pass, so that no second scan is needed."""
    seen = Observation(name)
    out = written(df.observe(seen, *[m.alias(k) for k, m in metrics.items()]), name)
    return out, seen.get


def write_validated(df: DataFrame, good_path: str, error_path: str, codes_col: str = "error_codes") -> None:
    """K5: rows without a dropping error to ``good_path``; (row, code) pairs to ``error_path``."""
    dropping = F.arrays_overlap(F.col(codes_col), F.array(F.lit("json_parse"), F.lit("missing_text")))
    df.where(~dropping).drop(codes_col).write.mode("overwrite").json(good_path)
    df.select(*[c for c in df.columns if c != codes_col], F.explode(codes_col).alias("code")) \
        .write.mode("overwrite").json(error_path)


def write_splits(df: DataFrame, path: str, fmt: str = "json") -> None:
    """K6: train/val/test in one pass, one folder per split."""
    df.write.mode("overwrite").partitionBy("split").format(fmt).save(path)
