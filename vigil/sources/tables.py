"""Adapters from the driver's parquet tables to the findings data model.

Every adapter is a pure projection (plus, for correlations, one bounded
per-order aggregate), so Catalyst prunes columns down to the parquet scan and
pushes filters through it. The same mapping is written as SQL in
``vigil.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import severity as sev

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Event type -> scanner bucket used by the findings adapter.
EVENT_SCANNER = {
    "click": "processes",
    "view": "network",
    "error": "ioc",
    "signup": "suid",
    "purchase": "world_writable",
}

# Order status -> correlation type used by the correlations adapter.
ORDER_CORRELATION_TYPE = {"O": "process_network", "F": "filesystem", "P": "kernel"}

# Order priority -> correlation risk.
PRIORITY_RISK = {"1-URGENT": 95.0, "2-HIGH": 80.0, "3-MEDIUM": 55.0, "4-NOT SPECIFIED": 30.0,
                 "5-LOW": 10.0}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _map_expr(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def findings_from_events(events: DataFrame, scanners: list[str] | None = None) -> DataFrame:
    """events -> findings (one finding per event).

    id ``evt_<event_id>``; scanner from event type; risk = floor(value);
    severity from the half-open cuts 20/40/70/90; metadata {port, user}; ord = event_id.
    ``scanners`` restricts the buckets with a predicate on the raw ``event_type`` column, so the
    filter reaches the parquet scan (a predicate on the derived scanner name would not).
    """
    if scanners is not None:
        types = [t for t, sc in EVENT_SCANNER.items() if sc in scanners]
        events = events.where(F.col("event_type").isin(*types))
    port = F.get_json_object(F.col("props"), "$.k")
    scanner = _map_expr(F.col("event_type"), EVENT_SCANNER, "unknown")
    risk = F.floor(F.col("value")).cast("double")
    return (
        events.select(
            F.concat(F.lit("evt_"), F.col("event_id").cast("string")).alias("id"),
            F.col("event_id").alias("ord"),
            F.col("ts"),
            F.col("user_id"),
            F.col("event_type"),
            port.cast("int").alias("port"),
            scanner.alias("scanner"),
            risk.alias("risk_score"),
            F.col("value").alias("event_value"),
        )
        .withColumn("category", F.col("scanner"))
        .withColumn("severity", sev.severity_from_risk(F.col("risk_score")))
        .withColumn(
            "title",
            F.concat(F.upper(F.substring("event_type", 1, 1)), F.expr("substring(event_type, 2)"),
                     F.lit(" event on port "),
                     F.col("port").cast("string"), F.lit(": user "), F.col("user_id").cast("string")),
        )
        .withColumn(
            "description",
            F.concat(F.lit("Event "), F.col("ord").cast("string"), F.lit(" of type "), F.col("event_type"),
                     F.lit(" by user "), F.col("user_id").cast("string"), F.lit(" on port "),
                     F.col("port").cast("string")),
        )
        .withColumn("metadata", F.to_json(F.struct(F.col("port").alias("port"), F.col("user_id").alias("user"))))
        .withColumn("baseline_status", F.lit("new"))
        .withColumn("tags", sev.severity_tags(F.col("scanner"), F.col("severity"), F.col("baseline_status")))
        .withColumn("risk_subscores", sev.midpoint_subscores(F.col("severity")))
        .withColumn("probability_actionable", sev.probability_actionable(F.col("risk_score")))
        .withColumn("base_severity_score", F.col("risk_score"))
        .withColumn("risk_total", F.col("risk_score"))
    )


def correlation_edges(lineitem: DataFrame) -> DataFrame:
    """lineitem -> reference edges (correlation_id, finding_id, pos).

    One correlation per order; each line references finding
    ``evt_<partkey*5 + linenumber>``. The tail of the part key range points past
    the last event, which gives genuinely broken references at every scale.
    """
    return lineitem.select(
        F.concat(F.lit("corr_"), F.col("l_orderkey").cast("string")).alias("correlation_id"),
        F.concat(F.lit("evt_"), (F.col("l_partkey") * 5 + F.col("l_linenumber")).cast("string")).alias("finding_id"),
        F.col("l_linenumber").alias("pos"),
        F.col("l_orderkey").alias("orderkey"),
    )


def correlations_from_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """orders + lineitem -> correlations with their reference lists.

    The per-order group is bounded (at most 7 lines per order), so
    ``collect_list`` here cannot build an unbounded list in one task.
    """
    refs = (
        correlation_edges(lineitem)
        .groupBy("orderkey")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "finding_id"))).alias("r"))
        .select("orderkey", F.col("r.finding_id").alias("correlation_refs"))
    )
    risk = _map_expr(F.col("o_orderpriority"), PRIORITY_RISK, 50.0)
    base = orders.select(
        F.col("o_orderkey").alias("orderkey"),
        F.concat(F.lit("corr_"), F.col("o_orderkey").cast("string")).alias("id"),
        _map_expr(F.col("o_orderstatus"), ORDER_CORRELATION_TYPE, "unknown").alias("correlation_type"),
        risk.alias("risk_score"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_orderpriority"),
    )
    return (
        base.join(refs, "orderkey", "left")
        .withColumn("correlation_refs", F.coalesce(F.col("correlation_refs"), F.array().cast("array<string>")))
        .withColumn("severity", sev.severity_from_risk(F.col("risk_score")))
        .withColumn("title", F.concat(F.lit("Correlated order "), F.col("orderkey").cast("string")))
        .withColumn("description", F.concat(F.lit("Order "), F.col("orderkey").cast("string"),
                                            F.lit(" with priority "), F.col("o_orderpriority")))
        .withColumn("category", F.lit("correlation"))
        .withColumn("scanner", F.lit("correlation"))
        .withColumn("metadata", F.lit("{}"))
        .withColumn("tags", F.array(F.lit("correlation"), F.col("correlation_type")))
        .withColumn("risk_subscores", F.lit(None).cast(
            "struct<impact:double,exposure:double,anomaly:double,confidence:double>"))
        .withColumn("ord", F.col("orderkey"))
    )


# Part type -> kernel parameter namespace used by the kernel-parameter adapter.
PART_TYPE_NAMESPACE = {
    "ECONOMY": "net.ipv4.tcp",
    "STANDARD": "vm.mmap",
    "LARGE": "fs.protected",
    "SMALL": "kernel.randomize",
    "PROMO": "kernel.yama.ptrace",
    "MEDIUM": "security.selinux",
}


def _banded(df: DataFrame) -> DataFrame:
    return df.withColumn("severity", sev.severity_from_risk(F.col("risk_score")))


def kernel_params_from_part(part: DataFrame) -> DataFrame:
    """part -> kernel_params findings: title ``<namespace>.<name_with_underscores>``, risk = 2*size."""
    ns = _map_expr(F.col("p_type"), PART_TYPE_NAMESPACE, "kernel")
    return _banded(part.select(
        F.concat(F.lit("kp_"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_partkey").alias("ord"),
        F.lit("kernel_params").alias("scanner"),
        F.lit("kernel_params").alias("category"),
        F.concat(ns, F.lit("."), F.regexp_replace(F.col("p_name"), " ", "_")).alias("title"),
        (F.col("p_size") * 2).cast("double").alias("risk_score"),
        F.lit("{}").alias("metadata"),
    ))


def modules_from_supplier(supplier: DataFrame, part: DataFrame) -> DataFrame:
    """supplier (+ the part with the same key) -> modules findings titled ``Module <first part word>``."""
    word = F.split(F.col("p_name"), " ").getItem(0)
    risk = F.floor(F.col("s_acctbal") / 100).cast("double")
    joined = supplier.join(part.select(F.col("p_partkey").alias("s_suppkey"), "p_name"), "s_suppkey", "left")
    return _banded(joined.select(
        F.concat(F.lit("mod_"), F.col("s_suppkey").cast("string")).alias("id"),
        F.col("s_suppkey").alias("ord"),
        F.lit("modules").alias("scanner"),
        F.lit("modules").alias("category"),
        F.concat(F.lit("Module "), F.coalesce(word, F.lit("unknown"))).alias("title"),
        risk.alias("risk_score"),
        F.lit("{}").alias("metadata"),
    ))


def mac_from_customer(customer: DataFrame) -> DataFrame:
    """customer -> mac findings: enabled = 'false' for a negative balance, risk = 4*nationkey."""
    enabled = F.when(F.col("c_acctbal") < 0, F.lit("false")).otherwise(F.lit("true"))
    return _banded(customer.select(
        F.concat(F.lit("mac_"), F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_custkey").alias("ord"),
        F.lit("mac").alias("scanner"),
        F.lit("mac").alias("category"),
        F.concat(F.lit("MAC status "), F.lower(F.col("c_mktsegment"))).alias("title"),
        (F.col("c_nationkey") * 4).cast("double").alias("risk_score"),
        F.to_json(F.struct(enabled.alias("enabled"))).alias("metadata"),
    ))


def host_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scanner categories pooled: events-derived plus kernel params, modules and MAC status."""
    cols = ["id", "ord", "scanner", "category", "title", "description", "severity", "risk_score", "metadata"]
    ev = findings_from_events(read(spark, sf_dir, "events")).select(*cols)
    part = read(spark, sf_dir, "part")

    def described(df: DataFrame) -> DataFrame:
        return df.withColumn("description", F.concat(F.col("category"), F.lit(" finding: "), F.col("title")))

    return (ev.unionByName(described(kernel_params_from_part(part)).select(*cols))
              .unionByName(described(modules_from_supplier(read(spark, sf_dir, "supplier"), part)).select(*cols))
              .unionByName(described(mac_from_customer(read(spark, sf_dir, "customer"))).select(*cols)))


#: Input positions of the rows that ``exposed_findings`` adds: after all events.
EXPOSED_FROM = 1_000_000_000


def exposed_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``host_findings`` and rows as scanners of processes, sockets and files give them.

    supplier -> processes with a command (some of malware tools) and files with capabilities; customer -> connections to
    ports around 1024, some of them to command servers. They follow the events in input order.
    """
    cols = ["id", "ord", "scanner", "category", "title", "description", "severity", "risk_score", "metadata"]
    supplier, customer = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "customer")
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    tool = _map_expr(k % 10, {0: "netcat", 1: "xcryptominer"}, "worker")

    def rows(df: DataFrame, key: Column, prefix: str, scanner: str, title: Column, risk: Column, meta: Column) -> DataFrame:
        return _banded(df.select(
            F.concat(F.lit(prefix), key.cast("string")).alias("id"), (key + EXPOSED_FROM).alias("ord"),
            F.lit(scanner).alias("scanner"), F.lit(scanner).alias("category"), title.alias("title"),
            F.concat(F.lit("Seen: "), title).alias("description"), risk.cast("double").alias("risk_score"),
            F.to_json(meta).alias("metadata"))).select(*cols)

    processes = rows(supplier, k, "proc_", "processes", F.concat(F.lit("Process of "), F.col("s_name")), k % 100,
                     F.struct(F.concat(F.lit("/usr/bin/"), tool, F.lit(" --listen")).alias("command")))
    sockets = rows(customer, c, "net_", "network", F.when(F.col("c_nationkey") < 5, "Connection to command server")
                   .otherwise("Connection to host"), F.col("c_nationkey") * 4, F.struct((c * 37 % 4096).alias("port")))
    files = rows(supplier.where(k % 4 == 0), k, "cap_", "world_writable",
                 F.when(k % 8 == 0, "File capability found").otherwise("Extended file attribute"), k % 100,
                 F.struct(F.when(k % 12 == 0, "file_capability").otherwise("attribute").alias("rule")))
    return host_findings(spark, sf_dir).select(*cols).unionByName(processes).unionByName(sockets).unionByName(files)
