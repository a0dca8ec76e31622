"""Standalone verifiers (V1-V6, V9, V11, V17, V26-V35, J17, J19) as issue tables.

Every verifier returns an issues DataFrame
    (verifier, entity, row_id, rule, message)
and "valid" means "no rows" (``issues.isEmpty()``). Row rules run on the JSON
text of each row (``raw``) so type tests (number vs string, object vs not) and
key presence (T3) see what the document said. Frames without ``raw`` answer from
their columns' types as a document of them would (``metadata`` JSON text as an object).

Group rules are partial aggregates (share of the top value, counts over 50,
distinct ratios); nothing is collected. Messages name the row's id where the
list form named its position.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions import fixed
from vigil.functions import severity as sev
from vigil.functions import text as tx
from vigil.functions.text import sql_text
from vigil.sources.sinks import written

FINDING_REQUIRED = ["id", "title", "severity", "risk_score", "base_severity_score", "description", "metadata",
                    "risk_subscores", "probability_actionable", "baseline_status", "tags", "rationale",
                    "correlation_refs"]
CORRELATION_REQUIRED = FINDING_REQUIRED + ["correlation_type"]
DOCUMENT_SECTIONS = ["version", "enriched_findings", "correlations", "reductions", "summaries", "actions"]
DOCUMENT_VERSION = "ground_truth_v1"
SUBSCORE_KEYS = ["impact", "exposure", "anomaly", "confidence"]
NUMERIC_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL", "BOOLEAN")

ISSUE_COLS = ["verifier", "entity", "row_id", "rule", "message"]


def staged(df: DataFrame) -> DataFrame:
    """``df`` with what rules read, worked out once per row: the parsed document (``_v``) and its top-level keys (``_k``)
    of frames with ``raw``; of typed frames the metadata as their document would hold it (``_m``). ``_mo``: the metadata
    is an object."""
    if "_mo" in df.columns:
        return df
    if "raw" in df.columns:
        df = (df.withColumn("_v", F.try_parse_json(F.col("raw")))
                .withColumn("_k", F.coalesce(F.json_object_keys(F.col("raw")), F.array().cast("array<string>"))))
        return df.withColumn("_mo", F.coalesce(_type_of(F.col("_v"), "$.metadata").startswith("OBJECT"), F.lit(False)))
    if "metadata" not in df.columns:
        return df.withColumns({"_m": F.lit(None).cast("variant"), "_mo": F.lit(False)})
    # printed and parsed again, as in a document: number types follow the printed form
    again = F.try_parse_json(F.to_json(F.try_parse_json(F.col("metadata"))))
    return (df.withColumn("_m", F.coalesce(again, F.parse_json(F.lit("null"))))
              .withColumn("_mo", F.coalesce(F.schema_of_variant("_m").startswith("OBJECT"), F.lit(False))))


def _type_of(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _text_of(v: Column, path: str) -> Column:
    """Python-ish ``str`` of a JSON value (JSON text for non-strings, True/False for booleans)."""
    s = F.try_variant_get(v, path, "string")
    j = F.to_json(F.try_variant_get(v, path, "variant"))
    t = _type_of(v, path)
    return (F.when(t == "BOOLEAN", F.when(j == "true", "True").otherwise("False"))
            .when(t == "STRING", s).when(t == "NULL", F.lit("None")).otherwise(j))


def _keys_of(text: Column) -> Column:
    return F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))


class RawDoc:
    """A staged frame's rows as documents, read from their JSON text."""

    def __init__(self, df: DataFrame):
        self.v = F.col("_v")

    def has(self, key: str) -> Column | bool:
        return F.array_contains(F.col("_k"), key)

    def has_in(self, path: str, key: str) -> Column | bool:
        return F.array_contains(_keys_of(F.get_json_object(F.col("raw"), path)), key)

    def type(self, path: str) -> Column:
        return _type_of(self.v, path)

    def numeric(self, path: str) -> Column:
        t = self.type(path)
        return reduce(lambda a, b: a | b, [t.startswith(x) for x in NUMERIC_TYPES])

    def num(self, path: str) -> Column:
        return F.try_variant_get(self.v, path, "double")

    def text(self, path: str) -> Column:
        return _text_of(self.v, path)

    def string(self, path: str) -> Column:
        return F.try_variant_get(self.v, path, "string")

    def size(self, path: str) -> Column:
        return F.size(F.coalesce(F.try_variant_get(self.v, path, "array<variant>"), F.array().cast("array<variant>")))

    def value(self, path: str) -> Column:
        return F.try_variant_get(self.v, path, "variant")


class TypedDoc(RawDoc):
    """The same of a frame with typed columns: every column but ``ord`` is a key of the document. What a column's type
    says needs no text; values of other kinds go through a document of their one column."""

    NUMBERS = {"double", "float", "bigint", "int", "smallint", "tinyint"}

    def __init__(self, df: DataFrame):
        self.types = {f.name: f.dataType for f in df.schema if f.name not in ("ord", "_m", "_mo")}

    def _at(self, path: str) -> tuple[Column | None, str, Column, str]:
        """The value at a path as a column of a plain type, that type; or (no such column) a variant and a path in it."""
        head, _, rest = path[2:].partition(".")
        if head == "metadata":
            return None, "", F.col("_m"), "$." + rest if rest else "$"
        if head not in self.types:
            return F.lit(None).cast("string"), "none", F.lit(None).cast("variant"), "$"
        kind, col = self.types[head], F.col(head)
        doc = F.try_parse_json(F.to_json(F.struct(col), {"ignoreNullFields": "false"}))
        if rest and isinstance(kind, T.StructType) and "." not in rest:
            if rest not in kind.names:
                return F.lit(None).cast("string"), "none", doc, path
            return col[rest], self._plain(kind[rest].dataType), doc, path
        return (None, "", doc, path) if rest else (col, self._plain(kind), doc, path)

    def _plain(self, kind: T.DataType) -> str:
        name = kind.simpleString()
        return "array" if isinstance(kind, T.ArrayType) else "struct" if isinstance(kind, T.StructType) else name

    def has(self, key: str) -> Column | bool:
        return key in self.types

    def has_in(self, path: str, key: str) -> Column | bool:
        name = path[2:]
        if name == "metadata" and name in self.types:
            text = F.to_json(F.struct(F.col("_m").alias(name)), {"ignoreNullFields": "false"})
        elif isinstance(self.types.get(name), T.StructType):
            return F.col(name).isNotNull() if key in self.types[name].names else False
        elif name in self.types:
            text = F.to_json(F.struct(F.col(name)), {"ignoreNullFields": "false"})
        else:
            return False
        return F.array_contains(_keys_of(F.get_json_object(text, path)), key)

    def type(self, path: str) -> Column:
        col, kind, v, at = self._at(path)
        if kind == "none":
            return col
        names = {"string": "STRING", "array": "ARRAY", "struct": "OBJECT", "boolean": "BOOLEAN"}
        if kind in names:
            parent = path[2:].split(".")
            null = F.when(col.isNull(), "VOID").otherwise(names[kind])
            return null if len(parent) == 1 else F.when(F.col(parent[0]).isNotNull(), null)
        return _type_of(v, at)

    def numeric(self, path: str) -> Column:
        col, kind, v, at = self._at(path)
        if kind not in self.NUMBERS:
            t = self.type(path)
            return reduce(lambda a, b: a | b, [t.startswith(x) for x in NUMERIC_TYPES])
        if kind in ("double", "float"):  # JSON has them as texts if they are not finite
            ok = col.isNotNull() & ~F.isnan(col) & (F.abs(col) < F.lit(float("inf")))
        else:
            ok = col.isNotNull()
        parent = path[2:].split(".")
        return ok if len(parent) == 1 else F.when(F.col(parent[0]).isNotNull(), ok)

    def num(self, path: str) -> Column:
        col, kind, v, at = self._at(path)
        return col.cast("double") if kind in self.NUMBERS else F.try_variant_get(v, at, "double")

    def text(self, path: str) -> Column:
        col, kind, v, at = self._at(path)
        if kind == "string" and path.count(".") == 1:
            return F.coalesce(col, F.lit("null"))
        if kind in self.NUMBERS and path.count(".") == 1:
            printed = F.to_json(F.try_variant_get(v, at, "variant"))
            return F.when(self.numeric(path), printed).otherwise(F.coalesce(col.cast("string"), F.lit("null")))
        return _text_of(v, at)

    def string(self, path: str) -> Column:
        col, kind, v, at = self._at(path)
        return col if kind in ("string", "none") else F.try_variant_get(v, at, "string")

    def size(self, path: str) -> Column:
        col, kind, v, at = self._at(path)
        if kind == "array":
            return F.coalesce(F.size(F.coalesce(col, F.array().cast(self.types[path[2:]]))), F.lit(0))
        return F.size(F.coalesce(F.try_variant_get(v, at, "array<variant>"), F.array().cast("array<variant>")))

    def value(self, path: str) -> Column:
        col, kind, v, at = self._at(path)
        return F.try_variant_get(v, at, "variant")


def _doc(df: DataFrame) -> RawDoc:
    return RawDoc(df) if "_v" in df.columns else TypedDoc(df)


@dataclass(frozen=True)
class Check:
    """A rule on one row. ``{}`` in the text stands for ``arg``, a text that only failing rows need."""

    rule: str
    fails: Column | bool
    text: str
    arg: Column | None = None


def _fused(df: DataFrame, entity: str, checks: list[tuple[tuple[str, ...], Check]]) -> DataFrame:
    """One issue row per row, failing check and verifier that has the check.

    A row's issues are one array of numbers, exploded once; rule, message and verifier are looked up by number after it,
    so what no reader asks for is never worked out. Checks that no row can fail are left out before.
    """
    checks = [(verifiers, c) for verifiers, c in checks if c.fails is not False]
    every = [(v, c) for verifiers, c in checks for v in verifiers]
    arrays, at = [], 0
    for verifiers, c in checks:
        numbers = F.array(*[F.lit(at + k) for k in range(len(verifiers))])
        # no lambda around a check: what stands in one is not compiled
        arrays.append(numbers if c.fails is True else F.when(c.fails, numbers).otherwise(F.array().cast("array<int>")))
        at += len(verifiers)
    rid = F.coalesce(F.col("id").cast("string"), F.lit("unknown")) if "id" in df.columns else F.lit("unknown")
    rows = df.withColumns({"_row_id": rid, "_i": F.explode(F.flatten(F.array(*arrays)))})

    def of(pick) -> Column:
        values = ", ".join(sql_text(pick(v, c)) for v, c in every)
        return F.expr(f"element_at(array({values}), _i + 1)")

    arg = F.lit("")
    for k, (_, c) in enumerate(every):
        if c.arg is not None:
            arg = F.when(F.col("_i") == k, F.coalesce(c.arg.cast("string"), F.lit(""))).otherwise(arg)
    body = F.replace(of(lambda v, c: c.text), F.lit("{}"), arg)
    name = entity.capitalize()
    return rows.select(of(lambda v, c: v).alias("verifier"), F.lit(entity).alias("entity"), F.col("_row_id").alias("row_id"),
                       of(lambda v, c: c.rule).alias("rule"),
                       F.concat(of(lambda v, c: f"[{v}] {name} "), F.col("_row_id"), F.lit(": "), body).alias("message"))


def _not(x: Column | bool) -> Column | bool:
    return not x if isinstance(x, bool) else ~x


def _all(*xs: Column | bool) -> Column | bool:
    """``and`` of columns and of what is known without a row."""
    if any(x is False for x in xs):
        return False
    columns = [x for x in xs if x is not True]
    return reduce(lambda a, b: a & b, columns) if columns else True


# --- V1-V5 row rules ------------------------------------------------------------------------------
def required_field_checks(df: DataFrame, fields: list[str]) -> list[Check]:
    return [Check(f"missing:{f}", _not(_doc(df).has(f)), f"Missing required field '{f}'") for f in fields]


def severity_score_checks(df: DataFrame, score_fields=("risk_score", "base_severity_score")) -> list[Check]:
    d = _doc(df)
    sev_txt = d.text("$.severity")
    out = [Check("invalid_severity", _all(d.has("severity"), ~F.coalesce(sev_txt.isin(*fixed.SEVERITIES), F.lit(False))),
                 "Invalid severity '{}'", F.coalesce(sev_txt, F.lit("None")))]
    for f in score_fields:
        num = d.numeric(f"$.{f}")
        x = d.num(f"$.{f}")
        out += [Check(f"{f}:not_numeric", _all(d.has(f), ~num), f"{f} must be numeric"),
                Check(f"{f}:range", _all(d.has(f), num & ((x < 0) | (x > 100)) & ~F.isnan(x)),
                      f"{f} out of range 0-100 (got {{}})", d.text(f"$.{f}"))]
    return out


def probability_checks(df: DataFrame, field: str = "probability_actionable") -> list[Check]:
    d = _doc(df)
    num = d.numeric(f"$.{field}")
    x = d.num(f"$.{field}")
    return [Check(f"{field}:not_numeric", _all(d.has(field), ~num), f"{field} must be numeric"),
            Check(f"{field}:range", _all(d.has(field), num & ((x < 0) | (x > 1)) & ~F.isnan(x)),
                  f"{field} must be between 0 and 1 (got {{}})", d.text(f"$.{field}"))]


def subscore_checks(df: DataFrame) -> list[Check]:
    d = _doc(df)
    present = d.has("risk_subscores")
    is_obj = F.coalesce(d.type("$.risk_subscores").startswith("OBJECT"), F.lit(False))
    out = [Check("risk_subscores:not_dict", _all(present, ~is_obj), "risk_subscores must be a dict")]
    for k in SUBSCORE_KEYS:
        path = f"$.risk_subscores.{k}"
        has_k = d.has_in("$.risk_subscores", k)
        num = d.numeric(path)
        x = d.num(path)
        out += [Check(f"risk_subscores.{k}:missing", _all(present, is_obj, _not(has_k)), f"Missing risk_subscore '{k}'"),
                Check(f"risk_subscores.{k}:not_numeric", _all(present, is_obj, has_k, ~num), f"risk_subscore '{k}' must be numeric"),
                Check(f"risk_subscores.{k}:range", _all(present, is_obj, has_k, num & ((x < 0) | (x > 1)) & ~F.isnan(x)),
                      f"risk_subscore '{k}' out of range 0-1 (got {{}})", d.text(path))]
    return out


def host_metadata_checks(df: DataFrame) -> list[Check]:
    """V5: metadata must be an object with non-empty host keys and a non-empty kb_refs list.

    A missing ``metadata`` key reads as {} (so every host key is reported); a
    null or non-object value is "metadata must be a dict".
    """
    d = _doc(df)
    known = d.has("metadata")
    is_obj = F.col("_mo")
    if known is not True:
        is_obj = True if known is False else ~known | is_obj
    out = [Check("metadata:not_dict", _not(is_obj), "metadata must be a dict")]
    for k in fixed.HOST_KEYS:
        empty = F.coalesce(d.string(f"$.metadata.{k}"), F.lit("")) == ""
        out.append(Check(f"metadata.{k}:missing", _all(is_obj, empty), f"metadata missing '{k}'"))
    bad_kb = ~F.coalesce(d.type("$.metadata.kb_refs").startswith("ARRAY"), F.lit(False)) | (d.size("$.metadata.kb_refs") == 0)
    out.append(Check("metadata.kb_refs:empty", _all(is_obj, bad_kb), "metadata.kb_refs must be a non-empty list"))
    return out


def reference_checks(df: DataFrame) -> list[Check]:
    d = _doc(df)
    t = d.type("$.correlation_refs")
    n = d.size("$.correlation_refs")
    has, is_list = d.has("correlation_refs"), F.coalesce(t.startswith("ARRAY"), F.lit(False))
    null = F.coalesce(t == "NULL", F.lit(False))
    return [Check("correlation_refs:not_list", _all(has, ~is_list & ~null), "correlation_refs must be a list"),
            Check("correlation_refs:empty", _all(has, (is_list | null) & (n == 0)), "correlation_refs must not be empty")]


def band_checks() -> list[Check]:
    """Risk against the severity's coherence band (unknown severity: 0..100; null severity or risk skipped)."""
    risk = F.col("risk_score").cast("double")
    fails = (F.col("severity").isNotNull() & (F.col("severity") != "") & risk.isNotNull()
             & sev.band_violation(F.col("severity"), risk, fixed.COHERENCE_BANDS, unknown=(0, 100)))
    lo = sev.lookup({k: v[0] for k, v in fixed.COHERENCE_BANDS.items()}, F.col("severity"), 0)
    hi = sev.lookup({k: v[1] for k, v in fixed.COHERENCE_BANDS.items()}, F.col("severity"), 100)
    return [Check("severity_risk", fails, "{}", F.format_string(
        "Risk score %s doesn't match severity '%s' (expected %d-%d)", _py_num(risk), F.col("severity"), lo, hi))]


def realism_checks(df: DataFrame) -> list[Check]:
    """Values that no real finding of the category has."""
    d = _doc(df)
    desc = F.coalesce(d.string("$.description"), F.lit(""))
    title = F.coalesce(d.string("$.title"), F.lit(""))
    cat = F.col("category")
    pid_t, pid = d.type("$.metadata.pid"), d.num("$.metadata.pid")
    pid_present = pid_t != "NULL"
    pid_int = pid_t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "BOOLEAN") | pid_t.startswith("DECIMAL(") & \
        (pid == F.floor(pid))
    cmd = F.coalesce(d.string("$.metadata.command"), F.lit(""))
    port_t, port = d.type("$.metadata.port"), d.num("$.metadata.port")
    port_present = port_t != "NULL"
    port_int = port_t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "BOOLEAN")
    state = F.coalesce(d.string("$.metadata.state"), F.lit(""))
    return [
        Check("pid", (cat == "processes") & pid_present & (~pid_int | (pid < 1) | (pid > 99999)), "Unrealistic PID {}",
              d.text("$.metadata.pid")),
        *[Check(f"fake_command:{m}", (cat == "processes") & (F.instr(cmd, m) > 0),
                "Obviously fake command '{}'", cmd) for m in fixed.FAKE_COMMAND_MARKERS],
        Check("port", (cat == "network") & port_present & (~port_int | (port < 1) | (port > 65535)), "Invalid port {}",
              d.text("$.metadata.port")),
        Check("socket_state", (cat == "network") & ~state.isin("", *fixed.VALID_SOCKET_STATES),
              "Invalid socket state '{}'", state),
        Check("description_short", F.length(desc) < 10, "Description too short"),
        Check("description_long", F.length(desc) > 500, "Description too long"),
        Check("title_short", F.length(title) < 5, "Title too short or empty"),
    ]


def _py_num(x: Column) -> Column:
    """Python repr of a float that holds an integer value (80.0) or not (80.5)."""
    return F.when(F.isnan(x), F.lit("nan")).otherwise(x.cast("string"))


# --- row rules of several verifiers in one pass -----------------------------------------------------
SCHEMA, COHERENCE, REALISM, ABUNDANCE = "SchemaVerifier", "CoherenceVerifier", "RealismVerifier", "AbundanceVerifier"


def finding_row_issues(findings: DataFrame, names: tuple[str, ...]) -> DataFrame:
    f = staged(findings)
    checks = []
    if SCHEMA in names:
        own = (required_field_checks(f, FINDING_REQUIRED) + severity_score_checks(f) + probability_checks(f) + subscore_checks(f))
        checks += [((SCHEMA,), c) for c in own]
    if COHERENCE in names:
        checks += [((COHERENCE,), c) for c in band_checks()]
    if REALISM in names:
        checks += [((REALISM,), c) for c in realism_checks(f)]
    host = tuple(n for n in (SCHEMA, REALISM, ABUNDANCE) if n in names)
    if host:
        checks += [(host, c) for c in host_metadata_checks(f)]
    return _fused(f, "finding", checks)


def correlation_row_issues(correlations: DataFrame, names: tuple[str, ...]) -> DataFrame | None:
    c = staged(correlations)
    checks = []
    if SCHEMA in names:
        own = (required_field_checks(c, CORRELATION_REQUIRED) + severity_score_checks(c) + probability_checks(c)
               + subscore_checks(c) + reference_checks(c))
        checks += [((SCHEMA,), x) for x in own]
    host = tuple(n for n in (SCHEMA, COHERENCE) if n in names)
    if host:
        checks += [(host, x) for x in host_metadata_checks(c)]
    return _fused(c, "correlation", checks) if checks else None


# --- V6 schema verifier -----------------------------------------------------------------------------
def schema_issues(findings: DataFrame, correlations: DataFrame, sections: dict | None = None) -> DataFrame:
    """V6: document sections + version, then V1-V5 on every finding and correlation."""
    name = SCHEMA
    out = finding_row_issues(findings, (name,)).unionByName(correlation_row_issues(correlations, (name,)))
    if sections is not None:
        spark = findings.sparkSession
        doc_rows = [(name, "document", "document", f"missing:{s}", f"[{name}] Missing required field: {s}")
                    for s in DOCUMENT_SECTIONS if s not in sections]
        if "version" in sections and sections["version"] != DOCUMENT_VERSION:
            doc_rows.append((name, "document", "document", "version",
                             f"[{name}] Invalid version: {sections['version']}"))
        if doc_rows:
            out = out.unionByName(spark.createDataFrame(doc_rows, ",".join(f"{c} string" for c in ISSUE_COLS)))
    return out


# --- V9, V11, J17, J19: coherence verifier --------------------------------------------------------------
def coherence_issues(findings: DataFrame, correlations: DataFrame) -> DataFrame:
    names = (COHERENCE,)
    return reduce(DataFrame.unionByName, [finding_row_issues(findings, names), correlation_row_issues(correlations, names),
                                          coherence_set_issues(findings, correlations)])


def coherence_set_issues(findings: DataFrame, correlations: DataFrame) -> DataFrame:
    """What takes more than one row to see."""
    name = COHERENCE
    # V9 duplicate ids (falsy ids skipped) across findings and correlations
    ids = (findings.select("id").unionByName(correlations.select("id"))
           .where(F.col("id").isNotNull() & (F.col("id") != "")))
    dups = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    dup_issues = dups.select(F.lit(name).alias("verifier"), F.lit("finding").alias("entity"),
                             F.col("id").alias("row_id"), F.lit("duplicate_id").alias("rule"),
                             F.concat(F.lit(f"[{name}] Duplicate finding ID: "), F.col("id")).alias("message"))
    # J19 process/network coherence: conditional aggregates in one pass
    f = findings
    has_process_key = F.array_contains(F.coalesce(F.json_object_keys(F.col("metadata")),
                                                  F.array().cast("array<string>")), "process")
    agg = f.agg(
        F.count_if((F.col("category") == "processes") & F.col("severity").isin("high", "critical")).alias("sp"),
        F.count_if((F.col("category") == "network") & F.col("severity").isin("high", "critical")).alias("sn"),
        F.count_if((F.col("category") == "network") & has_process_key).alias("nwp"),
        F.count_if(F.col("category") == "processes").alias("np"),
    )
    pn = agg.select(F.explode(F.array_compact(F.array(
        F.when((F.col("sp") > 0) & (F.col("sn") == 0),
               F.struct(F.lit("process_network").alias("rule"),
                        F.lit("Suspicious processes without corresponding network activity").alias("m"))),
        F.when((F.col("nwp") > 0) & (F.col("np") == 0),
               F.struct(F.lit("network_without_process").alias("rule"),
                        F.lit("Network findings reference processes but no process findings exist").alias("m"))),
    ))).alias("i")).select(F.lit(name).alias("verifier"), F.lit("dataset").alias("entity"),
                           F.lit("dataset").alias("row_id"), F.col("i.rule").alias("rule"),
                           F.concat(F.lit(f"[{name}] "), F.col("i.m")).alias("message"))
    # J17 broken references (correlation refs with the legacy fallback; finding refs to correlations)
    refs = F.coalesce(F.when(F.size(F.col("correlation_refs")) > 0, F.col("correlation_refs")),
                      F.col("related_finding_ids") if "related_finding_ids" in correlations.columns
                      else F.array().cast("array<string>"))
    c_refs = correlations.select(F.col("id").alias("cid"), F.explode(refs).alias("ref"))
    fids = findings.select(F.col("id").alias("ref")).where(F.col("ref").isNotNull() & (F.col("ref") != ""))
    broken_c = c_refs.join(fids, "ref", "left_anti").select(
        F.lit(name).alias("verifier"), F.lit("correlation").alias("entity"), F.col("cid").alias("row_id"),
        F.lit("broken_ref").alias("rule"),
        F.format_string(f"[{name}] Correlation %s references non-existent finding '%s'", F.col("cid"),
                        F.col("ref")).alias("message"))
    out = dup_issues.unionByName(pn).unionByName(broken_c)
    if "correlation_refs" in findings.columns:
        f_refs = findings.select(F.col("id").alias("fid"), F.explode("correlation_refs").alias("ref"))
        cids = correlations.select(F.col("id").alias("ref")).where(F.col("ref").isNotNull() & (F.col("ref") != ""))
        out = out.unionByName(f_refs.join(cids, "ref", "left_anti").select(
            F.lit(name).alias("verifier"), F.lit("finding").alias("entity"), F.col("fid").alias("row_id"),
            F.lit("broken_ref").alias("rule"),
            F.format_string(f"[{name}] Finding %s references non-existent correlation '%s'", F.col("fid"),
                            F.col("ref")).alias("message")))
    return out


# --- V26, V28-V33: rules on groups, from one table of counts ------------------------------------------
REPETITION, DIVERSITY = "repetition:", "diversity:"


def group_counts(findings: DataFrame) -> DataFrame:
    """(dim, value, n): how many findings have each value of each thing that a group rule looks at. One scan, combined
    before the shuffle; null values are left out."""
    f = staged(findings)
    d = _doc(f)
    distro = d.string("$.metadata.distro")
    host = F.coalesce(distro, F.lit("")) != ""

    def stated(path: str) -> Column:
        return F.nullif(d.text(path), F.lit("None"))

    def held(has: Column | bool, path: str) -> Column:
        return d.text(path) if has is True else F.lit("") if has is False else F.when(has, d.text(path)).otherwise(F.lit(""))

    dims = {
        "category": F.coalesce(F.col("category"), F.lit("unknown")),
        "severity": F.coalesce(F.col("severity"), F.lit("")),
        "title_pattern": tx.title_pattern(F.col("title")),
        # VARIANT objects sort their keys
        "metadata": F.md5(F.coalesce(F.to_json(d.value("$.metadata")), F.lit("{}"))),
        "host": F.when(host, F.to_json(F.struct(distro.alias("d"), d.string("$.metadata.distro_version").alias("v")))),
        **{REPETITION + k: stated(f"$.metadata.{k}") for k in fixed.REPETITION_FIELDS},
        REPETITION + "distro": F.when(host, stated("$.metadata.distro")),
        DIVERSITY + "title": F.coalesce(d.string("$.title"), F.lit("")),
        DIVERSITY + "rationale": held(d.has("rationale"), "$.rationale"),
        **{DIVERSITY + k: held(d.has_in("$.metadata", k), f"$.metadata.{k}") for k in ("port", "command")},
    }
    long = f.select(F.explode(F.array(*[F.struct(F.lit(k).alias("dim"), c.cast("string").alias("value"))
                                        for k, c in dims.items()])).alias("u")).select("u.*")
    return long.where(F.col("value").isNotNull()).groupBy("dim", "value").agg(F.count(F.lit(1)).alias("n"))


def group_issues(counts: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """V26 and V28 (realism), V29-V33 (abundance) from :func:`group_counts`, which is read a few times: write it first."""
    per_dim = counts.groupBy("dim").agg(F.sum("n").alias("total"), F.max("n").alias("top_n"), F.count(F.lit(1)).alias("kinds"),
                                        F.max_by("value", F.struct("n", "value")).alias("top"))

    def severe(s: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("value") == s, F.col("n"))), F.lit(0)).alias(s)

    mix = counts.where("dim = 'severity'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"), *map(severe, fixed.SEVERITIES))
    t, found = F.col("t"), []

    def issue(name: str, rows: DataFrame, rule: Column, text: Column) -> None:
        found.append(rows.select(F.lit(name).alias("verifier"), F.lit("dataset").alias("entity"), F.lit("dataset").alias("row_id"),
                                 rule.alias("rule"), F.concat(F.lit(f"[{name}] "), text).alias("message")))

    def first(*checks: tuple[Column, str | Column, Column]) -> Column:
        return F.explode(F.array_compact(F.array(*[F.when(fails, F.struct(
            (F.lit(rule) if isinstance(rule, str) else rule).alias("rule"), text.alias("text"))) for fails, rule, text in checks])))

    if REALISM in names:
        # V26 severity mix in ranges
        def share(s: str) -> Column:
            return F.when(t > 0, F.col(s) / t).otherwise(F.lit(0.0))

        issue(REALISM, mix.select(first(*[
            (~share(s).between(lo, hi), f"distribution:{s}", F.format_string(
                f"Severity '{s}' distribution unrealistic: %.1f%% (expected {lo:.0%}-{hi:.0%})".replace("%-", "%%-").replace("%)", "%%)"),
                share(s) * 100)) for s, (lo, hi) in fixed.REALISM_RANGES.items()])).select("col.*"), F.col("rule"), F.col("text"))
        # One value above 80% of a field's non-null values (distro above 85%)
        part = F.col("top_n") / F.col("total")
        name = F.substring_index("dim", ":", -1)
        over = per_dim.where(F.col("dim").startswith(REPETITION) & (part > F.when(name == "distro", 0.85).otherwise(0.8)))
        issue(REALISM, over, F.col("dim"), F.when(
            name == "distro", F.format_string("Host distro diversity low: %s appears %.1f%% of findings", F.col("top"), part * 100))
            .otherwise(F.format_string("Over-repetition of %s='%s' (%.1f%%)", name, F.col("top"), part * 100)))
    if ABUNDANCE in names:
        limit, most = F.lit(fixed.MAX_CATEGORY_SHARE * 100), F.lit(fixed.MAX_SIMILAR_FINDINGS)
        # V30 title patterns and identical metadata
        many = counts.where(F.col("dim").isin("title_pattern", "metadata") & (F.col("n") > fixed.MAX_SIMILAR_FINDINGS))
        titles = F.col("dim") == "title_pattern"
        issue(ABUNDANCE, many, F.concat(F.when(titles, "title_pattern:").otherwise("identical_metadata:"), F.col("value")),
              F.when(titles, F.format_string("Over-abundance of similar findings: '%s' appears %d times (max %d)", F.col("value"),
                                             F.col("n"), most))
              .otherwise(F.format_string("Over-abundance of identical metadata: %d findings with same metadata (max %d)",
                                         F.col("n"), most)))
        # V29 category share (at most one value can have more than half), V32 host profile, V33 diversity
        part, kinds = F.col("top_n") / F.col("total"), F.col("kinds") / F.col("total")
        host = F.from_json("top", "d string, v string")
        name = F.substring_index("dim", ":", -1)
        issue(ABUNDANCE, per_dim.select(first(
            ((F.col("dim") == "category") & (part > fixed.MAX_CATEGORY_SHARE), F.concat(F.lit("category:"), F.col("top")),
             F.format_string("Category '%s' dominates: %.1f%% of findings (max %.1f%%)", F.col("top"), part * 100, limit)),
            ((F.col("dim") == "host") & (part > fixed.MAX_CATEGORY_SHARE), "host_profile",
             F.format_string("Host profile ('%s', '%s') dominates: %.1f%% of findings (max %.1f%%)", host["d"], host["v"],
                             part * 100, limit)),
            (F.col("dim").startswith(DIVERSITY) & (kinds < 0.4), F.col("dim"),
             F.format_string("Low diversity for field '%s': %d/%d unique (%.1f%%)", name, F.col("kinds"), F.col("total"),
                             kinds * 100)))).select("col.*"), F.col("rule"), F.col("text"))
        # V31 severity balance
        c, h, i = F.col("critical"), F.col("high"), F.col("info")
        issue(ABUNDANCE, mix.where(t > 0).select(first(
            (c > t * 0.1, "too_many_critical", F.format_string("Too many critical findings: %d (%.1f%%)", c, c / t * 100)),
            (h > t * 0.2, "too_many_high", F.format_string("Too many high findings: %d (%.1f%%)", h, h / t * 100)),
            (i < t * 0.3, "too_few_info", F.format_string("Too few info findings: %d (%.1f%%) - should be at least 30%%", i,
                                                         i / t * 100)))).select("col.*"), F.col("rule"), F.col("text"))
    return reduce(DataFrame.unionByName, found)


def realism_issues(findings: DataFrame) -> DataFrame:
    return run_verifiers(findings, None, ("realism",))


def abundance_issues(findings: DataFrame) -> DataFrame:
    return run_verifiers(findings, None, ("abundance",))


# --- V34 / V35 -------------------------------------------------------------------------------------------
VERIFIERS = {"schema": SCHEMA, "coherence": COHERENCE, "realism": REALISM, "abundance": ABUNDANCE}


def run_verifiers(findings: DataFrame, correlations: DataFrame | None, names=None) -> DataFrame:
    """The issues of the named verifiers (by default all), without a scan more for each.

    With several verifiers both inputs are written once with the columns that rules read. Then one scan of the findings
    and one of the correlations give all row issues, one the table of counts that all group rules read, and the
    coherence of sets reads ids and references.
    """
    names = tuple(VERIFIERS[n] for n in (names or VERIFIERS))
    if len(names) > 1:
        findings = written(findings, "verified-findings")
        correlations = written(correlations, "verified-correlations") if correlations is not None else None
    out = [finding_row_issues(findings, names)]
    if correlations is not None and (SCHEMA in names or COHERENCE in names):
        out.append(correlation_row_issues(correlations, names))
    if COHERENCE in names:
        out.append(coherence_set_issues(findings, correlations))
    if REALISM in names or ABUNDANCE in names:
        out.append(group_issues(written(group_counts(findings), "group-counts"), names))
    return reduce(DataFrame.unionByName, out)


def problem_categories(invalid_details: DataFrame, findings: DataFrame | None = None,
                       consistency_status: str | None = None) -> DataFrame:
    """Scanners named in the schema stage's invalid details (not 'correlation'); when none are
    named and the consistency stage is warning/failed, every scanner."""
    named = invalid_details.where(F.col("scanner") != "correlation").select("scanner").distinct()
    if findings is None or consistency_status not in ("warning", "failed"):
        return named
    return named.unionByName(findings.select("scanner").distinct().where(~named.exists()))
