"""Column expressions for rationale text, ChatML build/parse and completion scoring
(P13-P15, P28-P31, C1-C5, C8-C10, R1-R8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions import fixed
from vigil.functions import jsontext as jt
from vigil.functions import text as tx

# --- FIXED VALUES: prompts and rationale sentences ----------------------------------------
SYSTEM_PROMPT = (
    "You are a Tier 3 SOC Analyst & Linux Systems Specialist.\n"
    "Objective: Analyze Linux system telemetry to identify security incidents with high precision.\n"
    "Cognitive Framework:\n"
    "1. Observation: Extract facts.\n"
    "2. Context: Compare against Linux standards.\n"
    "3. Hypothesis: Map to MITRE ATT&CK.\n"
    "4. Evidence: (+) Anomalies vs (-) Legitimate behavior.\n"
    "5. Verdict: Assign Risk Score (0-100) and Severity.\n"
    "Response Format: <think>...</think><answer>...</answer> (Strict JSON inside answer)."
)
PREMISE = "I am analyzing a %s severity finding related to %s."
BECAUSE_NETWORK = "The risk score is elevated **because** port %s/%s is exposed, which increases the attack surface."
BECAUSE_SUID = "This is flagged **because** the binary '%s' has the SUID bit set."
BECAUSE_PROCESS = ("The anomaly detection triggered **because** process '%s' was spawned by user '%s' "
                   "in an unusual context.")
BECAUSE_KERNEL = ("The configuration is non-compliant **because** the kernel parameter '%s' deviates from the "
                  "hardened baseline.")
BECAUSE_OTHER = "The alert was triggered **because** the system state matches known patterns for %s."
IMPLIES_HIGH = ("This **implies** an immediate threat to system integrity that could allow an attacker to gain "
                "unauthorized access.")
IMPLIES_MEDIUM = "This **implies** a misconfiguration that reduces the system's defense-in-depth posture."
IMPACT_LOW = "The **impact** is currently limited to informational visibility."
HOWEVER_CONTAINER = ("**However**, this process is running inside a container, which limits the blast radius of a "
                     "potential exploit.")
HOWEVER_TRUSTED = "**However**, if this activity is part of a scheduled maintenance window, it might be a false positive."
HOWEVER_DEFAULT = "**However**, verification against the specific host baseline is recommended to confirm context."
THEREFORE = "**Therefore**, I have classified this as %s."
KB_NETWORK = "MITRE ATT&CK: TA0011 Command and Control"
KB_EXECUTION = "MITRE ATT&CK: TA0002 Execution"
KB_DEFAULT = "General hardening: principle of least privilege"
FLAT_FALLBACK_RATIONALE = "Classified as %s based on observed evidence and risk score %d."
FLAT_DEFAULT_DESCRIPTION = "No description provided."
REASONING_ANCHORS = ["**because**", "**however**", "**implies**", "**therefore**", "impact", "mitigated"]
DEPTH_KEYWORDS = ["observation", "context", "hypothesis", "evidence", "verdict"]

IM_START, IM_END = "<|im_start|>", "<|im_end|>"


# --- metadata helpers ------------------------------------------------------------------------
RATIONALE_KEYS = ("port", "protocol", "file_path", "binary", "path", "process_name", "command", "user", "param",
                  "container_id", "is_trusted_user")


def meta_fields(meta: Column) -> Column:
    """The metadata keys that rationales read, as text, from one parse. Stage it as a column: it is read many times."""
    return F.from_json(meta, ", ".join(f"{k} string" for k in RATIONALE_KEYS))


def meta_get(fields: Column, key: str) -> Column:
    """Value of ``key`` as Python ``str()`` would print a scalar (booleans as True/False)."""
    v = fields[key]
    return F.when(v == "true", "True").when(v == "false", "False").otherwise(v)


def _fill(template: str, *values: Column) -> Column:
    """``template`` with its ``%s`` replaced, in order, by values that are never null."""
    pieces = template.split("%s")
    out = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        out += [value, F.lit(piece)]
    return F.concat(*out)


def truthy(v: Column) -> Column:
    return v.isNotNull() & ~v.isin("", "0", "0.0", "False", "[]", "{}")


def _fmt(v: Column) -> Column:
    return F.coalesce(v, F.lit("unknown"))


def _first_truthy(*vals: Column) -> Column:
    expr = None
    for v in vals:
        expr = F.when(truthy(v), v) if expr is None else expr.when(truthy(v), v)
    return expr


# --- P14 / P15 -----------------------------------------------------------------------------------
def build_rationale(category: Column, severity: Column, title: Column, meta: Column) -> Column:
    """Premise, category clause, severity clause, nuance clause, conclusion (T6: 'process'); ``meta``: the
    struct that ``meta_fields`` parses."""
    cat = F.coalesce(category, F.lit("generic"))
    sev = F.lower(F.coalesce(severity, F.lit("info")))
    t = F.coalesce(title, F.lit(fixed.DEFAULT_TITLE))
    because = (
        F.when(cat == "network", _fill(BECAUSE_NETWORK, _fmt(meta_get(meta, "port")),
                                                 _fmt(meta_get(meta, "protocol"))))
        .when(cat == "suid", _fill(BECAUSE_SUID, _fmt(F.coalesce(
            _first_truthy(meta_get(meta, "file_path"), meta_get(meta, "binary"), meta_get(meta, "path")), t))))
        .when(cat == "process", _fill(BECAUSE_PROCESS, _fmt(_first_truthy(
            meta_get(meta, "process_name"), meta_get(meta, "command"))), _fmt(meta_get(meta, "user"))))
        .when(cat == "kernel_params", _fill(BECAUSE_KERNEL, _fmt(F.coalesce(
            _first_truthy(meta_get(meta, "param")), t))))
        .otherwise(_fill(BECAUSE_OTHER, t))
    )
    implies = (F.when(sev.isin("high", "critical"), F.lit(IMPLIES_HIGH))
               .when(sev == "medium", F.lit(IMPLIES_MEDIUM)).otherwise(F.lit(IMPACT_LOW)))
    nuance = (F.when(truthy(meta_get(meta, "container_id")), F.lit(HOWEVER_CONTAINER))
              .when(truthy(meta_get(meta, "is_trusted_user")) | (meta_get(meta, "user") == "root"),
                    F.lit(HOWEVER_TRUSTED))
              .otherwise(F.lit(HOWEVER_DEFAULT)))
    return F.concat_ws(" ", _fill(PREMISE, sev, cat), because, implies, nuance,
                       _fill(THEREFORE, sev))


def kb_refs(category: Column, meta: Column) -> Column:
    """P15 (T7): existing refs kept; otherwise attached only when metadata is a non-empty object."""
    existing = F.from_json(F.get_json_object(meta, "$.kb_refs"), "array<string>")
    cat = F.coalesce(category, F.lit("generic"))
    default = (F.when(cat.isin("network", "dns"), F.array(F.lit(KB_NETWORK)))
               .when(cat.isin("processes", "ioc"), F.array(F.lit(KB_EXECUTION)))
               .otherwise(F.array(F.lit(KB_DEFAULT))))
    non_empty = F.size(F.coalesce(F.json_object_keys(meta), F.array().cast("array<string>"))) > 0
    return (F.when(F.size(F.coalesce(existing, F.array().cast("array<string>"))) > 0, existing)
            .when(non_empty, default))


# --- C1: conversation text -------------------------------------------------------------------------
def user_block_json(title: Column, description: Column, metadata: Column, category: Column | None = None) -> Column:
    """``{title, description, metadata[, category]}`` with two spaces per level; metadata that is no object stands under
    ``raw``."""
    raw = F.concat(F.lit('{\n    "raw": '), json_str(metadata), F.lit("\n  }"))
    meta = (F.when(F.coalesce(metadata, F.lit("")) == "", F.lit("{}"))
            .when(is_json_object(metadata), jt.indented_object(metadata, 1)).otherwise(raw))
    return F.concat(F.lit('{\n  "title": '), json_str(F.coalesce(title, F.lit(fixed.DEFAULT_TITLE))),
                    F.lit(',\n  "description": '), json_str(F.coalesce(description, F.lit(""))),
                    F.lit(',\n  "metadata": '), meta,
                    *([F.lit(',\n  "category": '), json_str(F.coalesce(category, F.lit("unknown")))] if category is not None else []),
                    F.lit("\n}"))


def json_str(c: Column) -> Column:
    """A JSON string literal for ``c`` (quotes and escapes), as json.dumps prints it."""
    return F.to_json(F.struct(c.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(c.alias("v")))) - 6)


def answer_json(risk: Column, severity: Column, category: Column) -> Column:
    """``{"risk_score": int(round(risk)), "severity": SEV or UNKNOWN, "category": cat or unknown}``."""
    r = F.coalesce(F.bround(risk.cast("double"), 0).cast("long"), F.lit(0))
    sev = F.upper(F.coalesce(severity.cast("string"), F.lit("")))
    sev = F.when(sev == "", "UNKNOWN").otherwise(sev)
    cat = F.coalesce(F.when(category != "", category), F.lit("unknown"))
    return F.concat(F.lit('{"risk_score": '), r.cast("string"), F.lit(', "severity": '), json_str(sev),
                    F.lit(', "category": '), json_str(cat), F.lit("}"))


def conversation_text(user_json: Column, rationale: Column, answer: Column) -> Column:
    return F.concat_ws("\n", F.lit(IM_START + "system"), F.lit(SYSTEM_PROMPT), F.lit(IM_END),
                       F.lit(IM_START + "user"), user_json, F.lit(IM_END),
                       F.lit(IM_START + "assistant"), F.lit("<think>"), rationale, F.lit("</think>"),
                       F.lit("<answer>"), answer, F.lit("</answer>" + IM_END))


def sft_rationale(rationale: Column, fallback: Column) -> Column:
    """C1 rationale: generic -> P14 (or the fixed fallback); a wrapping <think> is stripped."""
    r = F.when(tx.generic_rationale(rationale), F.coalesce(F.when(fallback != "", fallback),
                                                          F.lit(fixed.GENERIC_RATIONALE_FALLBACK))) \
        .otherwise(rationale)
    return tx.strip_think(r)


# --- C2 / C3 / C4 / C5: parsing --------------------------------------------------------------------
def block_regex(text: Column, role: str) -> Column:
    """``<|im_start|>role\\n(.*?)<|im_end|>`` (assistant: to end of text), stripped; '' if absent."""
    if role == "assistant":
        pat = r"(?s)<\|im_start\|>assistant\n(.*)$"
    else:
        pat = rf"(?s)<\|im_start\|>{role}\n(.*?)<\|im_end\|>"
    return tx.py_strip(F.regexp_extract(F.coalesce(text, F.lit("")), pat, 1))


def after_first(text: Column, marker: str) -> Column:
    """Everything after the first occurrence of ``marker`` (null if it does not occur)."""
    pos = F.instr(text, marker)
    return F.when(pos > 0, F.substring(text, pos + F.lit(len(marker)), F.lit(2147483647)))


def before_first(text: Column, marker: str) -> Column:
    pos = F.instr(text, marker)
    return F.when(pos > 0, F.substring(text, F.lit(1), pos - F.lit(1))).otherwise(text)


def parse_block(text: Column, role: str) -> Column:
    """C3 (the validator's naive split): what follows the first opening mark, up to the next end mark or the text's end;
    null without an opening mark."""
    body = rf"<\|im_start\|>{role}((?>[^<]*)(?:<(?!\|im_end\|>)(?>[^<]*))*+)"
    return tx.py_strip(F.get(F.regexp_extract_all(text, F.lit(body), F.lit(1)), 0))


def tag_section(text: Column, tag: str, case_insensitive: bool = False) -> Column:
    """Body of the first ``<tag>...</tag>`` pair, null when absent. Only the first opening tag is tried (a later one has
    no end either), so the time grows with the text; each place is looked for once, inside a lambda that names it."""
    if case_insensitive:
        pair = rf"\A(?>[^<]*)(?:<(?!(?i:{tag})>)(?>[^<]*))*+<(?i:{tag})>((?>[^<]*)(?:<(?!/(?i:{tag})>)(?>[^<]*))*+)</(?i:{tag})>"
        return F.get(F.regexp_extract_all(text, F.lit(pair), F.lit(1)), 0)
    rest = _named(F.instr(text, f"<{tag}>"), lambda p: F.when(p > 0, F.substring(text, p + F.lit(len(tag) + 2), F.lit(2147483647))))
    return _named(rest, lambda r: _named(F.instr(r, f"</{tag}>"), lambda q: F.when(q > 0, F.substring(r, F.lit(1), q - F.lit(1)))))


def _named(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def think_section(assistant: Column) -> Column:
    """C4: first ``<think>(.*?)</think>`` (case-insensitive), stripped; null when absent."""
    return tx.py_strip(tag_section(F.coalesce(assistant, F.lit("")), "think", True))


def answer_section(assistant: Column, case_insensitive: bool = True) -> Column:
    sec = tag_section(F.coalesce(assistant, F.lit("")), "answer", case_insensitive)
    return tx.py_strip(sec) if case_insensitive else sec


def _may_be_json(s: Column) -> Column:
    """Cheap pre-test: JSON text starts (after whitespace) with one of {["-0-9tfn."""
    first = tx.first_char(s)
    return first.isin("{", "[", '"', "-", "t", "f", "n", "0", "1", "2", "3", "4", "5", "6", "7", "8", "9")


def is_json(s: Column) -> Column:
    """Parses as JSON (the parse is only attempted when the first character allows it)."""
    return F.coalesce(_may_be_json(s) & F.try_parse_json(s).isNotNull(), F.lit(False))


def is_json_object(s: Column) -> Column:
    v = F.when(tx.first_char(s) == "{", F.try_parse_json(s))
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


# --- R1-R8 -------------------------------------------------------------------------------------------
def soft_extract(text: Column, key: str, as_int: bool) -> Column:
    """``"key": value`` by regex; ints keep digits only."""
    pat = '"' + key + r'"\s*:\s*"?([^",\}\n]+)"?'
    t = F.coalesce(text, F.lit(""))
    raw = F.nullif(F.regexp_extract(t, pat, 1), F.lit(""))
    return F.nullif(F.regexp_replace(raw, "[^0-9]", ""), F.lit("")).try_cast("long") if as_int else raw


def json_validity_reward(completion: Column) -> Column:
    """R2: 1.0 if the completion parses as JSON, 0.5 if it contains '{', else 0."""
    return (F.when(is_json(completion), F.lit(1.0))
            .when(F.instr(F.coalesce(completion, F.lit("")), "{") > 0, F.lit(0.5)).otherwise(F.lit(0.0)))


def risk_accuracy_linear(completion: Column, gt_risk: Column) -> Column:
    """max(0, 1 - |pred - gt| / 100); 0 without a prediction."""
    pred = soft_extract(completion, "risk_score", True)
    return F.when(pred.isNull(), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(pred - F.coalesce(gt_risk, F.lit(0))) / F.lit(100.0)))


def severity_accuracy(completion: Column, gt_sev: Column) -> Column:
    """Case-insensitive equality of the soft-extracted severity."""
    pred = soft_extract(completion, "severity", False)
    return F.when(truthy(pred) & (F.lower(pred) == F.lower(F.coalesce(gt_sev, F.lit("info")))), F.lit(1.0)) \
        .otherwise(F.lit(0.0))


def format_reward(completion: Column, anchored: bool = True) -> Column:
    """``<think>.*?</think>\\s*<answer>.*?</answer>`` (anchored: the whole completion, DOTALL).

    The leftmost ``</think>\\s*<answer>`` after the opening tag is the only candidate that matters, and the closing
    ``</answer>`` must follow it: the groups never go back.
    """
    bridge = r"(?>.*?</think>\s*+<answer>)"
    whole = (rf"(?s)\A<think>{bridge}.*</answer>\n?\z" if anchored else rf"(?s)\A(?>.*?<think>){bridge}.*?</answer>")
    return F.when(F.coalesce(completion, F.lit("")).rlike(whole), F.lit(1.0)).otherwise(F.lit(0.0))


def _keyword_score(think: Column, words: list[str], lowered: bool = False) -> Column:
    low = think if lowered else F.lower(think)
    s = None
    for w in words:
        term = F.when(low.contains(w.lower()), F.lit(0.2)).otherwise(F.lit(0.0))
        s = term if s is None else s + term
    return F.when(think.isNull(), F.lit(0.0)).otherwise(F.least(F.lit(1.0), s))


def keyword_score(think: Column, words: list[str], lowered: bool = False) -> Column:
    return _keyword_score(think, words, lowered)


def reasoning_structure_reward(completion: Column) -> Column:
    """0.2 per anchor present in the (case-sensitive tag) think block, cap 1."""
    return _keyword_score(tag_section(F.coalesce(completion, F.lit("")), "think"), REASONING_ANCHORS)


def analytical_depth_reward(completion: Column) -> Column:
    """0.2 per keyword in the (case-insensitive tag) think block, cap 1."""
    return _keyword_score(tag_section(F.coalesce(completion, F.lit("")), "think", True), DEPTH_KEYWORDS)


def _answer_risk(completion: Column) -> Column:
    return answer_risk(answer_section(completion, case_insensitive=False))


def answer_risk(ans: Column) -> Column:
    """risk_score inside an <answer> body (0 when the key is absent); null when not a JSON object."""
    return answer_risk_from_variant(F.when(tx.first_char(ans) == "{", F.try_parse_json(ans)))


def answer_risk_from_variant(v: Column) -> Column:
    """``v``: an object, or null. Missing key -> 0; a number (or boolean) -> its value; null / string / nested -> null (the
    arithmetic on it fails, so the reward is 0)."""
    rv = F.try_variant_get(v, "$.risk_score", "variant")
    numeric = F.schema_of_variant(rv).rlike("^(BIGINT|DECIMAL|DOUBLE|BOOLEAN)")
    return (F.when(v.isNotNull() & rv.isNull(), F.lit(0.0))
            .when(numeric, F.try_variant_get(v, "$.risk_score", "double")))


def banded(d: Column) -> Column:
    """R8 banded on |pred - gt|: <= 5 -> 1, <= 15 -> 0.5, else 0; null (unparsable) -> 0."""
    return F.when(d.isNull(), F.lit(0.0)).when(d <= 5, F.lit(1.0)).when(d <= 15, F.lit(0.5)).otherwise(F.lit(0.0))


def strict(d: Column) -> Column:
    """R8 strict on |pred - gt|: 0 -> 1, <= 5 -> 0.5, else 0; null (unparsable) -> 0."""
    return F.when(d.isNull(), F.lit(0.0)).when(d == 0, F.lit(1.0)).when(d <= 5, F.lit(0.5)).otherwise(F.lit(0.0))


def risk_banded_reward(completion: Column, gt_risk: Column, pred: Column | None = None) -> Column:
    """R8 banded: |diff| <= 5 -> 1, <= 15 -> 0.5, else 0; unparsable -> 0."""
    d = F.abs((pred if pred is not None else _answer_risk(completion)) - F.coalesce(gt_risk, F.lit(0)))
    return F.when(d.isNull(), F.lit(0.0)).when(d <= 5, F.lit(1.0)).when(d <= 15, F.lit(0.5)).otherwise(F.lit(0.0))


def risk_strict_reward(completion: Column, gt_risk: Column, pred: Column | None = None) -> Column:
    """R8 strict: diff 0 -> 1, <= 5 -> 0.5, else 0; unparsable -> 0."""
    d = F.abs((pred if pred is not None else _answer_risk(completion)) - F.coalesce(gt_risk, F.lit(0)))
    return F.when(d.isNull(), F.lit(0.0)).when(d == 0, F.lit(1.0)).when(d <= 5, F.lit(0.5)).otherwise(F.lit(0.0))
