"""Queries for the correlation rules (J1-J15) and the coherence-style reference checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import correlate as cr
from vigil.plans import oracle as O
from vigil.plans.registry import query
from vigil.sources import tables as tb

_H = "WITH " + O.EXPOSED_FINDINGS_CTE + O.rules_ctes("hx")


def _rules(spark, sf_dir):
    return cr.run_rules(tb.exposed_findings(spark, sf_dir))


@query("correlation_rules", _H + """
SELECT correlation_id, correlation_type, producer, title, description, severity,
       CAST(risk_score AS DOUBLE) AS risk_score, CAST(graph_degree AS BIGINT) AS graph_degree,
       CAST(round(least(graph_degree * 0.2, 0.8) + 0.15, 6) AS DOUBLE) AS correlation_strength
FROM rules_out""", ops=("J1", "J2", "J3", "J4", "J5", "J6", "J7", "J8", "J9", "J10", "J11", "J12", "J13", "J14",
                        "J15", "F2", "F3", "F4", "F5", "F6", "F7", "F8", "F9", "P17", "P24"))
def q_correlation_rules(spark, sf_dir):
    h, e = _rules(spark, sf_dir)
    rows = cr.correlation_rows(h, e)
    return rows.select("correlation_id", "correlation_type", "producer", "title", "description", "severity",
                       "risk_score", F.col("graph_degree").cast("long").alias("graph_degree"),
                       F.round("correlation_strength", 6).alias("correlation_strength"))


@query("correlation_edges", _H + """
SELECT correlation_id, finding_id, grp, CAST(ord AS BIGINT) AS ord, CAST(n AS BIGINT) AS n FROM edges_all""",
       ops=("J2", "J3", "J4", "J5", "J6", "J7", "J8", "J9", "J10", "J11", "J12", "J13", "J14", "W1"))
def q_correlation_edges(spark, sf_dir):
    _, e = _rules(spark, sf_dir)
    return e.select("correlation_id", "finding_id", F.col("grp").cast("int").alias("grp"), "ord", "n")
