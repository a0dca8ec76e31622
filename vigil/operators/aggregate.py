"""Aggregations (A1-A7), host context of correlations (P25) and lookup indexes.

All are aggregates with partial (map-side) combine (sorted where the kept value holds strings). Where the model
keeps an unbounded id list (cluster members, ids per severity, correlations
per finding) the list is emitted as a long (key, id) table instead, so no
single row or task has to hold a group that may be a third of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions import fixed
from vigil.operators import dedup


# A1 / A2 ---------------------------------------------------------------------------------
def cluster_findings(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A1: cluster by ``category_severity_pattern``.

    Returns (clusters, members): one summary row per cluster (first row's id by
    ord, count, max risk, mean probability rounded 3, generated title and A2
    description) and the (cluster_key, id, ord) membership table.
    """
    key = dedup.cluster_key(F.col("category"), F.col("severity"), F.col("metadata"))
    keyed = df.withColumn("cluster_key", key)
    prob = F.coalesce(F.col("probability_actionable").cast("double"), F.lit(0.0)) \
        if "probability_actionable" in df.columns else F.lit(0.0)
    clusters = keyed.groupBy("cluster_key").agg(
        F.min_by(F.struct("id", "category", "severity", "scanner"), F.col("ord")).alias("first"),
        F.count(F.lit(1)).alias("aggregated_count"),
        F.max(F.coalesce(F.col("risk_score").cast("double"), F.lit(0.0))).alias("risk_score"),
        F.sum(F.round(prob * 1_000_000).cast("long")).alias("_p_micro"),
        F.count_distinct(F.coalesce(F.col("category"), F.lit("unknown"))).alias("n_categories"),
    )
    first_cat = F.coalesce(F.col("first.category"), F.col("first.scanner"))
    # mean rounded to 3 decimals (half up) from exact integer micro-units: independent of summation order
    n = F.col("aggregated_count")
    mean_prob = F.floor((F.col("_p_micro") * 2 + n * 1000) / (n * 2000)).cast("double") / F.lit(1000.0)
    out = clusters.select(
        "cluster_key",
        F.col("first.id").alias("id"),
        first_cat.alias("category"),
        F.col("first.severity").alias("severity"),
        F.format_string("Aggregate: %d %s findings", F.col("aggregated_count"), first_cat).alias("title"),
        F.format_string("Aggregated %d findings across %d category(ies). Dominant severity: %s (%d findings).",
                        F.col("aggregated_count"), F.col("n_categories"),
                        F.coalesce(F.col("first.severity"), F.lit("unknown")), F.col("aggregated_count"))
        .alias("description"),
        "aggregated_count", "risk_score", mean_prob.alias("probability_actionable"),
    )
    members = keyed.select("cluster_key", "id", "ord")
    return out, members


def cluster_distributions(df: DataFrame) -> DataFrame:
    """A1: per cluster the counts of its severities and of its patterns, as maps.

    Counts per (cluster, severity, pattern) come first and combine map-side; the maps are built from those few rows. A
    key names its severity and pattern, so a cluster has more than one only where joined names coincide.
    """
    sev = F.coalesce(F.col("severity"), F.lit("unknown"))
    counts = (df.select(dedup.cluster_key(F.col("category"), F.col("severity"), F.col("metadata")).alias("cluster_key"),
                        sev.alias("severity"), dedup.cluster_pattern(F.col("metadata")).alias("pattern"))
              .groupBy("cluster_key", "severity", "pattern").agg(F.count(F.lit(1)).alias("n")))

    def by(value: str) -> Column:
        pairs = F.sort_array(F.collect_list(F.struct(value, "n")))
        keys = F.array_distinct(pairs[value])
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.aggregate(
            pairs, F.lit(0).cast("long"), lambda total, p: total + F.when(p[value] == k, p["n"]).otherwise(0))))

    return counts.groupBy("cluster_key").agg(by("severity").alias("severity_distribution"), by("pattern").alias("pattern_summary"))


def aggregate_findings(df: DataFrame) -> DataFrame:
    """A1 as one table: clusters with their distributions. Rows that all carry ``aggregated_count`` in their metadata
    (none at all included) are aggregates already and come back as they are."""
    fresh = ~F.array_contains(F.coalesce(F.json_object_keys("metadata"), F.array().cast("array<string>")), "aggregated_count")
    if df.where(fresh).isEmpty():
        return df
    return cluster_findings(df)[0].join(cluster_distributions(df), "cluster_key")


# P25 / J1 -----------------------------------------------------------------------------------
HOST_KEYS = ("distro", "distro_version", "package_manager", "kernel", "kernel_version")


def host_fields(metadata: Column, prefer_version: bool = False) -> Column:
    """P25: distro, version, package manager and kernel of a finding's metadata; null where none of the keys has a value.
    ``prefer_version``: ``kernel_version`` goes before ``kernel`` (the process rules), else after it."""
    parsed = F.from_json(metadata, ", ".join(f"{k} string" for k in HOST_KEYS))
    one, two = ("kernel_version", "kernel") if prefer_version else ("kernel", "kernel_version")
    bears = F.concat_ws("", *[parsed[k] for k in HOST_KEYS]) != ""
    return F.when(bears, F.struct(parsed["distro"].alias("distro"), parsed["distro_version"].alias("distro_version"),
                                  parsed["package_manager"].alias("package_manager"),
                                  F.coalesce(F.nullif(parsed[one], F.lit("")), parsed[two]).alias("kernel")))


def host_context(edges: DataFrame, findings: DataFrame, order: str = "ord", prefer_version: bool = False) -> DataFrame:
    """P25 and J1's degree: per correlation the number of its references and the host fields of its first member, by
    (``order``, id), that has any; nulls where no member has. Of findings that share an id the first by ``ord`` counts.

    Edges (correlation_id, finding_id, ``order``) meet the findings once, by id; after that the ordered first is a partial
    aggregate, so a correlation with a third of all edges is reduced before the shuffle.
    """
    hosts = (findings.select(F.col("id").alias("finding_id"), "ord", host_fields(F.col("metadata"), prefer_version).alias("host"))
             .where("host is not null").groupBy("finding_id").agg(F.min_by("host", "ord").alias("host")))
    place = F.when(F.col("host").isNotNull(), F.struct(F.col(order), F.col("finding_id")))
    return (edges.select("correlation_id", "finding_id", order).join(hosts, "finding_id", "left").groupBy("correlation_id")
            .agg(F.count(F.lit(1)).alias("graph_degree"), F.min_by("host", place).alias("host"))
            .select("correlation_id", "graph_degree", "host.*"))


# A3 ----------------------------------------------------------------------------------------
def histograms(df: DataFrame) -> DataFrame:
    """A3: severity, category and scanner counts in one GROUPING SETS pass."""
    sev = F.coalesce(F.col("severity"), F.lit("unknown"))
    cat = F.coalesce(F.col("category"), F.lit("unknown"))
    g = (df.select(sev.alias("severity"), cat.alias("category"), F.col("scanner"))
           .groupingSets([["severity"], ["category"], ["scanner"]], "severity", "category", "scanner")
           .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")))
    dim = F.when(F.col("gid") == 3, "severity").when(F.col("gid") == 5, "category").otherwise("scanner")
    val = F.coalesce(F.col("severity"), F.col("category"), F.col("scanner"))
    return g.select(dim.alias("dimension"), val.alias("value"), "n")


# A4-A6 -------------------------------------------------------------------------------------
def _median(df: DataFrame, by: str) -> DataFrame:
    """(by, median) of the column ``r``: exact, from counts alone.

    Counts by whole numbers locate the one or two buckets that hold the middle ranks of each group (at most two rows
    a group, which are broadcast); counts by value are then made inside those buckets only.
    """
    part = Window.partitionBy(by)

    def earlier(window, order: str) -> Column:
        return F.coalesce(F.sum("n").over(window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def holds(rank: str) -> Column:
        return (F.col("off") < F.col(rank)) & (F.col(rank) <= F.col("off") + F.col("n"))

    buckets = (df.groupBy(by, F.floor("r").alias("b")).agg(F.count(F.lit(1)).alias("n"))
               .withColumn("off", earlier(part, "b")).withColumn("total", F.sum("n").over(part))
               .withColumn("low", F.floor((F.col("total") + 1) / 2)).withColumn("high", F.floor(F.col("total") / 2) + 1))
    middle = buckets.where(holds("low") | holds("high")).select(F.col(by).alias("_by"), F.col("b").alias("_b"),
                                                                F.col("off").alias("start"), "low", "high")
    inside = df.join(F.broadcast(middle), F.col(by).eqNullSafe(F.col("_by")) & (F.floor("r") == F.col("_b")))
    values = inside.groupBy(by, "_b", "start", "low", "high", "r").agg(F.count(F.lit(1)).alias("n"))
    values = values.withColumn("off", F.col("start") + earlier(Window.partitionBy(by, "_b"), "r"))
    return values.groupBy(by).agg(((F.max(F.when(holds("low"), F.col("r"))) + F.max(F.when(holds("high"), F.col("r")))) / 2)
                                  .alias("median"))


def risk_stats(df: DataFrame, by: str | None = None) -> DataFrame:
    """A4: mean, median, min, max, sample sd (0 for n=1), rounded 2. Missing risk counts as 0."""
    r = F.coalesce(F.col("risk_score").cast("double"), F.lit(0.0)).alias("r")
    key = by or "_all"
    rows = df.select(F.col(by) if by else F.lit(0).alias("_all"), r)
    plain = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("r"), 2).alias("mean"), F.min("r").alias("min"), F.max("r").alias("max"),
        F.round(F.coalesce(F.stddev_samp("r"), F.lit(0.0)), 2).alias("std_dev"))
    middle = _median(rows, key).withColumnRenamed(key, "_key")
    out = plain.join(middle, F.col(key).eqNullSafe(F.col("_key")), "left").select(
        key, "n", "mean", F.round("median", 2).alias("median"), "min", "max", "std_dev")
    return out if by else out.drop(key)


def correlation_stats(corr: DataFrame) -> DataFrame:
    """A5: count per type and mean strength (default 0.5), rounded 2."""
    ctype = F.coalesce(F.col("correlation_type"), F.lit("unknown"))
    strength = (F.coalesce(F.col("correlation_strength").cast("double"), F.lit(fixed.DEFAULT_STRENGTH))
                if "correlation_strength" in corr.columns else F.lit(fixed.DEFAULT_STRENGTH))
    return corr.groupBy(ctype.alias("correlation_type")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(strength), 2).alias("avg_strength"))


def dataset_totals(findings: DataFrame, correlations: DataFrame) -> DataFrame:
    """Totals of findings, correlations and scanners (three partial aggregates, one row)."""
    f = findings.agg(F.count(F.lit(1)).alias("total_findings"), F.count_distinct("scanner").alias("scanner_types"))
    c = correlations.agg(F.count(F.lit(1)).alias("total_correlations"))
    return f.withColumn("k", F.lit(0)).join(c.withColumn("k", F.lit(0)), "k").drop("k")


# A7 / W2 ----------------------------------------------------------------------------------
def risk_band(risk) -> F.Column:
    return (F.when(risk >= 80, "critical").when(risk >= 60, "high").when(risk >= 40, "medium").otherwise("low"))


def correlation_summary(corr: DataFrame) -> DataFrame:
    """Counts by type, severity and risk band as (dimension, value, n)."""
    risk = F.coalesce(F.col("risk_score").cast("double"), F.lit(0.0))
    base = corr.select(F.coalesce(F.col("correlation_type"), F.lit("unknown")).alias("correlation_type"),
                       F.coalesce(F.col("severity"), F.lit("unknown")).alias("severity"),
                       risk_band(risk).alias("risk_band"))
    g = (base.groupingSets([["correlation_type"], ["severity"], ["risk_band"]],
                           "correlation_type", "severity", "risk_band")
         .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")))
    dim = F.when(F.col("gid") == 3, "correlation_type").when(F.col("gid") == 5, "severity").otherwise("risk_band")
    return g.select(dim.alias("dimension"),
                    F.coalesce("correlation_type", "severity", "risk_band").alias("value"), "n")


def top_correlations(corr: DataFrame, k: int = 5) -> DataFrame:
    """Top k by risk (missing as 0), stable on ord. Plans as TakeOrderedAndProject."""
    risk = F.coalesce(F.col("risk_score").cast("double"), F.lit(0.0))
    return (corr.select("id", "title", risk.alias("risk_score"), "severity", "correlation_type", "ord")
            .orderBy(F.col("risk_score").desc(), F.col("ord").asc()).limit(k))


# X1-X4 ------------------------------------------------------------------------------------
def index_by_id(findings: DataFrame) -> DataFrame:
    """Id -> (scanner, severity, category); the last duplicate (highest ord) wins."""
    return findings.groupBy("id").agg(
        F.max_by(F.struct("scanner", "severity", "category"), F.col("ord")).alias("v")
    ).select("id", "v.*")


def index_long(findings: DataFrame, column: str) -> DataFrame:
    """Severity -> ids or category -> ids, as a clustered (key, id) table."""
    return (findings.select(F.coalesce(F.col(column), F.lit("unknown")).alias("key"), F.col("id"))
            .repartitionByRange("key", "id").sortWithinPartitions("key", "id"))


def correlations_by_type(corr: DataFrame) -> DataFrame:
    """Correlation type (default unknown) -> correlation ids."""
    return corr.select(F.coalesce(F.col("correlation_type"), F.lit("unknown")).alias("correlation_type"),
                       F.col("id").alias("correlation_id"))


def correlations_by_finding(corr: DataFrame) -> DataFrame:
    """Finding id -> correlation ids (one row per reference)."""
    return corr.select(F.explode("correlation_refs").alias("finding_id"), F.col("id").alias("correlation_id"))
