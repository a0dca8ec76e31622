"""Queries for training-set shaping: flatten, rationale, ChatML build/parse/validate, prompts, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.functions import chat as ch
from vigil.functions import text as tx
from vigil.operators import chatml as cm
from vigil.plans import oracle as O
from vigil.plans.catalog import correlations, findings
from vigil.plans.registry import query
from vigil.sources import tables as tb

_F = "WITH " + O.FINDINGS_CTE + "\n"
_H = "WITH " + O.HOST_FINDINGS_CTE + "\n"
WS = tx.PY_WS


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def _after(t: str, m: str) -> str:
    return f"(CASE WHEN strpos({t}, '{m}') > 0 THEN substr({t}, strpos({t}, '{m}') + {len(m)}) END)"


def _before(t: str, m: str) -> str:
    return f"(CASE WHEN strpos({t}, '{m}') > 0 THEN substr({t}, 1, strpos({t}, '{m}') - 1) ELSE {t} END)"


def _block(t: str, role: str) -> str:
    return _strip(_before(_after(t, "<|im_start|>" + role), "<|im_end|>"))


def _section(a: str, tag: str, flags: str = "is") -> str:
    pat = f"(?{flags})<{tag}>(.*?)</{tag}>"
    return f"(CASE WHEN regexp_matches({a}, '{pat}') THEN {_strip(f'regexp_extract({a}, {O._sq(pat)}, 1)')} END)"


CONV_TEXT_SQL = """
conv AS (
  SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || coalesce(text, '') || '<|im_end|>', chr(10)
                             ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id)"""


# P10-P13 ----------------------------------------------------------------------------------------
@query("flat_rows", _F + """
SELECT id, title, description, metadata, category, CAST(trunc(risk_score) AS BIGINT) AS risk_score,
       lower(severity) AS severity,
       printf('Classified as %s based on observed evidence and risk score %d.', lower(severity),
              CAST(trunc(risk_score) AS BIGINT)) AS rationale
FROM findings""", ops=("P10", "P11", "P12", "P13"))
def q_flat_rows(spark, sf_dir):
    return cm.flatten_findings(findings(spark, sf_dir)).drop("ord")


# P14-P16 ------------------------------------------------------------------------------------------
@query("rationale_backfill", _H + f"""
SELECT id, {O.rationale_sql()} AS rationale, {O.kb_refs_sql()} AS kb_refs FROM hf""",
       ops=("P14", "P15", "P16"))
def q_rationale_backfill(spark, sf_dir):
    df = cm.backfill_rationale(tb.host_findings(spark, sf_dir))
    return df.select("id", "rationale", F.array_join("kb_refs", "|").alias("kb_refs"))


# C1 ------------------------------------------------------------------------------------------------
@query("sft_texts", _F + f"SELECT id, {O.sft_text_sql()} AS text FROM findings",
       ops=("C1", "P30"))
def q_sft_texts(spark, sf_dir):
    return cm.sft_texts(findings(spark, sf_dir)).drop("ord")


# V36 on real conversations ---------------------------------------------------------------------
def _v36_sql() -> str:
    u = _block("text", "user")
    a = _block("text", "assistant")
    brace = f"regexp_extract(coalesce({u}, ''), '(?s)\\{{.*\\}}', 0)"
    think = _section(f"coalesce({a}, '')", "think")
    ans = _section(f"coalesce({a}, '')", "answer")
    return f""",
parts AS (SELECT conv_id, text, {u} AS u, {a} AS a FROM conv),
chk AS (SELECT conv_id, text, u, a,
               coalesce(json_valid(u), false) AS u_ok, {brace.replace(u, 'u')} AS brace,
               {think.replace(a, 'a')} AS think, {ans.replace(a, 'a')} AS ans FROM parts)
SELECT conv_id, concat_ws(',',
    CASE WHEN text IS NULL THEN 'missing_text' END,
    CASE WHEN text IS NOT NULL AND (coalesce(u, '') = '' OR coalesce(a, '') = '') THEN 'chatml_structure' END,
    CASE WHEN text IS NOT NULL AND NOT u_ok AND brace <> '' AND NOT coalesce(json_valid(brace), false)
         THEN 'user_json_parse' END,
    CASE WHEN text IS NOT NULL AND NOT u_ok AND brace = '' THEN 'user_json_missing' END,
    CASE WHEN text IS NOT NULL AND think IS NULL THEN 'missing_think' END,
    CASE WHEN text IS NOT NULL AND ans IS NULL THEN 'missing_answer' END,
    CASE WHEN text IS NOT NULL AND ans IS NOT NULL AND NOT coalesce(json_valid(ans), false)
         THEN 'answer_json_parse' END) AS error_codes
FROM chk"""


@query("chatml_validation", "WITH " + CONV_TEXT_SQL + _v36_sql(), ops=("V36", "C3", "C4", "C6"))
def q_chatml_validation(spark, sf_dir):
    conv = cm.conversation_texts(tb.read(spark, sf_dir, "conversations"))
    return cm.validate_chatml(conv).select("conv_id", F.array_join("error_codes", ",").alias("error_codes"))


@query("conversation_blocks", "WITH " + CONV_TEXT_SQL + f"""
SELECT conv_id, {_block('text', 'system')} AS system_block, {_block('text', 'user')} AS user_block,
       {_strip("regexp_extract(text, '(?s)<\\|im_start\\|>assistant\\n(.*)$', 1)")} AS assistant_block
FROM conv""", ops=("C2", "C3"))
def q_conversation_blocks(spark, sf_dir):
    conv = cm.conversation_texts(tb.read(spark, sf_dir, "conversations"))
    t = F.col("text")
    return conv.select("conv_id", ch.parse_block(t, "system").alias("system_block"),
                       ch.parse_block(t, "user").alias("user_block"),
                       ch.block_regex(t, "assistant").alias("assistant_block"))


# C8 / P29 over the C1 texts (Entry B chain) --------------------------------------------------------
@query("prompt_pairs", _F + f"""
, sft0 AS (SELECT id, {O.sft_text_sql()} AS text FROM findings),
sft AS (SELECT id, text, regexp_extract(text, '(?s)<\\|im_start\\|>assistant\n(.*)$', 1) AS asst FROM sft0)
SELECT id,
       '<|im_start|>system' || chr(10) || {_strip("regexp_extract(text, '(?s)<\\|im_start\\|>system\\n(.*?)<\\|im_end\\|>', 1)")}
         || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10)
         || {_strip("regexp_extract(text, '(?s)<\\|im_start\\|>user\\n(.*?)<\\|im_end\\|>', 1)")}
         || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || '<think>' AS prompt,
       CAST(round_even(json_extract(regexp_extract(asst, '(?s)<answer>(.*?)</answer>', 1), '$.risk_score')::DOUBLE, 0)
            AS BIGINT) AS gt_risk_score,
       upper(trim(json_extract_string(regexp_extract(asst, '(?s)<answer>(.*?)</answer>', 1), '$.severity')))
         AS gt_severity,
       json_extract_string(regexp_extract(asst, '(?s)<answer>(.*?)</answer>', 1), '$.category') AS gt_category
FROM sft""", ops=("C8", "C2", "C5", "P29"))
def q_prompt_pairs(spark, sf_dir):
    pp = cm.prompt_pairs(cm.sft_texts(findings(spark, sf_dir)).drop("ord"))
    return pp.select("id", "prompt", F.col("ground_truth.risk_score").alias("gt_risk_score"),
                     F.col("ground_truth.severity").alias("gt_severity"),
                     F.col("ground_truth.category").alias("gt_category"))


# P28 answer repair over the C1 texts ---------------------------------------------------------------
@query("answer_repair", _F + f"""
, sft AS (SELECT id, {O.sft_text_sql()} AS text FROM findings),
ans AS (SELECT id, regexp_extract(regexp_extract(text, '(?s)<\\|im_start\\|>assistant\n(.*)$', 1),
                                  '(?s)<answer>(.*?)</answer>', 1) AS a FROM sft)
SELECT id, '{{"risk_score": ' || CAST(CAST(round_even(json_extract(a, '$.risk_score')::DOUBLE, 0) AS BIGINT) AS VARCHAR)
       || ', "severity": ' || to_json(CASE WHEN regexp_matches(upper(json_extract_string(a, '$.severity')),
                                              '(?i)^(unknown|none|null|na|n/a)$') THEN 'INFO'
                                         ELSE upper(json_extract_string(a, '$.severity')) END)
       || ', "category": ' || to_json(json_extract_string(a, '$.category')) || '}}' AS answer
FROM ans""", ops=("P28", "C7"))
def q_answer_repair(spark, sf_dir):
    sft = cm.sft_completions(findings(spark, sf_dir)).select("id", "completion")
    lit_null = F.lit(None).cast("string")
    return cm.repair_answers(sft, ch.answer_section(F.col("completion")), lit_null, lit_null, lit_null).select("id", "answer")


# completions = assistant blocks of the C1 texts, answers from the raw event values ----------
@query("completion_scores", _F + f"""
, sft0 AS (SELECT id, ord, {O.sft_text_sql()} AS text FROM findings),
sft AS (SELECT s.id, s.text, e.value FROM sft0 s JOIN events e ON s.ord = e.event_id),
c AS (SELECT id, {_before(_after('text', '<|im_start|>assistant'), '<|im_end|>')} AS completion,
             '{{"risk_score": ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || ', "severity": "info"}}' AS answer
      FROM sft),
c2 AS (SELECT id, {_strip('completion')} AS completion, answer FROM c),
s AS (SELECT id, completion, answer,
        TRY_CAST(nullif(regexp_replace(regexp_extract(completion, '"risk_score"\\s*:\\s*"?([^",\\}}\\n]+)"?', 1), '[^0-9]', '', 'g'), '') AS BIGINT) AS pred,
        CAST(json_extract(answer, '$.risk_score') AS DOUBLE) AS gt,
        json_extract(regexp_extract(completion, '(?s)<answer>(.*?)</answer>', 1), '$.risk_score')::DOUBLE AS arisk,
        regexp_extract(completion, '(?s)<think>(.*?)</think>', 1) AS think
      FROM c2),
r AS (SELECT id,
  CASE WHEN json_valid(completion) THEN 1.0 WHEN contains(completion, '{{') THEN 0.5 ELSE 0.0 END AS json_validity,
  round(CASE WHEN pred IS NULL THEN 0.0 ELSE greatest(0.0, 1.0 - abs(pred - gt) / 100.0) END, 6) AS risk_linear,
  CASE WHEN lower(regexp_extract(completion, '"severity"\\s*:\\s*"?([^",\\}}\\n]+)"?', 1)) = 'info' THEN 1.0 ELSE 0.0 END
    AS severity_match,
  CASE WHEN regexp_matches(completion, '(?s)^<think>.*?</think>\\s*<answer>.*?</answer>$') THEN 1.0 ELSE 0.0 END AS format_strict,
  CASE WHEN regexp_matches(completion, '(?s)<think>.*?</think>\\s*<answer>.*?</answer>') THEN 1.0 ELSE 0.0 END AS format_loose,
  round(least(1.0, {" + ".join(f"(CASE WHEN contains(lower(think), {O._sq(w.lower())}) THEN 0.2 ELSE 0.0 END)" for w in ch.REASONING_ANCHORS)}), 6)
    AS reasoning_structure,
  round(least(1.0, {" + ".join(f"(CASE WHEN contains(lower(think), {O._sq(w)}) THEN 0.2 ELSE 0.0 END)" for w in ch.DEPTH_KEYWORDS)}), 6)
    AS analytical_depth,
  CASE WHEN abs(arisk - gt) <= 5 THEN 1.0 WHEN abs(arisk - gt) <= 15 THEN 0.5 ELSE 0.0 END AS risk_banded,
  CASE WHEN abs(arisk - gt) = 0 THEN 1.0 WHEN abs(arisk - gt) <= 5 THEN 0.5 ELSE 0.0 END AS risk_strict
FROM s)
SELECT id, CAST(json_validity AS DOUBLE) AS json_validity, CAST(risk_linear AS DOUBLE) AS risk_linear, CAST(severity_match AS DOUBLE) AS severity_match, CAST(format_strict AS DOUBLE) AS format_strict, CAST(format_loose AS DOUBLE) AS format_loose, CAST(reasoning_structure AS DOUBLE) AS reasoning_structure, CAST(analytical_depth AS DOUBLE) AS analytical_depth, CAST(risk_banded AS DOUBLE) AS risk_banded, CAST(risk_strict AS DOUBLE) AS risk_strict FROM r""", ops=("R1", "R2", "R3", "R4", "R5", "R6", "R7", "R8"))
def q_completion_scores(spark, sf_dir):
    sft = cm.sft_completions(findings(spark, sf_dir), passthrough=("event_value",))
    answer = F.concat(F.lit('{"risk_score": '), F.floor("event_value").cast("long").cast("string"),
                      F.lit(', "severity": "info"}'))
    df = sft.select("id", "completion", answer.alias("answer"))
    out = cm.score_completions(df)
    return out.drop("completion", "answer")


# C10 / C9 ------------------------------------------------------------------------------------------
@query("chat_messages", _F + f"""
SELECT id, to_json([{{'role': 'system', 'content': {O._sq(ch.SYSTEM_PROMPT)}}},
                    {{'role': 'user', 'content': '{{' || chr(10) || '  "title": ' || to_json(title) || ',' || chr(10)
                       || '  "description": ' || to_json(description) || ',' || chr(10) || '  "metadata": {{'
                       || chr(10) || '    "port": ' || CAST(port AS VARCHAR) || ',' || chr(10) || '    "user": '
                       || CAST(user_id AS VARCHAR) || chr(10) || '  }}' || chr(10) || '}}'}}]) AS messages,
       '{{"risk_score": ' || CAST(CAST(risk_score AS BIGINT) AS VARCHAR) || ', "severity": ' || to_json(severity) || '}}'
         AS answer
FROM findings""", ops=("C10",))
def q_chat_messages(spark, sf_dir):
    m = cm.chat_messages(findings(spark, sf_dir))
    return m.select("id", F.to_json("messages").alias("messages"), "answer")


# C9 and the second form of C10: expected texts written out ---------------------------------------------------------
_USER_SQL = """'{' || chr(10) || '  "title": ' || to_json(title) || ',' || chr(10) || '  "description": ' || to_json(description)
       || ',' || chr(10) || '  "metadata": {' || chr(10) || '    "port": ' || CAST(port AS VARCHAR) || ',' || chr(10) || '    "user": '
       || CAST(user_id AS VARCHAR) || chr(10) || '  }'"""
_RISK_SQL = """'{"risk_score": ' || CAST(CAST(risk_score AS BIGINT) AS VARCHAR) || ', "severity": ' || to_json(severity)"""


@query("chat_messages_category", _F + f"""
SELECT id, {_USER_SQL} || ',' || chr(10) || '  "category": ' || to_json(category) || chr(10) || '}}' AS user_content,
       {_RISK_SQL} || '}}' AS answer FROM findings""", ops=("C10",))
def q_chat_messages_category(spark, sf_dir):
    m = cm.chat_messages(findings(spark, sf_dir), category=True)
    return m.select("id", F.col("messages")[1]["content"].alias("user_content"), "answer")


def _explained(spark, sf_dir):
    return findings(spark, sf_dir).withColumn("rationale", F.concat(F.lit('Seen as "'), F.col("severity"), F.lit('".')))


@query("training_messages_json", _F + f"""
SELECT id, {_USER_SQL} || chr(10) || '}}' AS user_content,
       {_RISK_SQL} || ', "rationale": "Seen as \\"' || severity || '\\".", "mitigation_steps": []}}' AS assistant FROM findings""", ops=("C9",))
def q_training_messages_json(spark, sf_dir):
    m = cm.training_messages(_explained(spark, sf_dir), "json")
    return m.select("id", F.col("messages")[1]["content"].alias("user_content"), F.col("messages")[2]["content"].alias("assistant"))


@query("training_messages_think", _F + f"""
SELECT id, '<think>' || chr(10) || 'Seen as "' || severity || '".' || chr(10) || '</think>' || chr(10) || '<answer>' || chr(10)
       || {_RISK_SQL} || '}}' || chr(10) || '</answer>' AS assistant FROM findings""", ops=("C9",))
def q_training_messages_think(spark, sf_dir):
    m = cm.training_messages(_explained(spark, sf_dir), "think")
    return m.select("id", F.col("messages")[2]["content"].alias("assistant"))


@query("protocol_texts", _F + f"""
SELECT id, '<|im_start|>system' || chr(10) || 'P' || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10)
       || {_USER_SQL} || chr(10) || '}}' || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)
       || CASE WHEN severity = 'low' THEN 'R' || id ELSE 'O' || id END || '<|im_end|>' AS text FROM findings""", ops=("C9",))
def q_protocol_texts(spark, sf_dir):
    f = findings(spark, sf_dir)
    f = f.withColumn("output", F.when(F.col("severity") != "low", F.concat(F.lit("O"), F.col("id"))).otherwise("")) \
         .withColumn("response", F.concat(F.lit("R"), F.col("id")))
    return cm.protocol_texts(f, "P").drop("ord")


# C11 -----------------------------------------------------------------------------------------------
@query("batch_requests", _F + "," + O.CORRELATIONS_CTE + """
SELECT id AS custom_id, 'finding' AS kind, '/v1/chat/completions' AS url, 'gpt-5-mini' AS model, 7 AS n_fields,
       '{"kind":"finding","title":' || to_json(title) || ',"description":' || to_json(description) || '}' AS prompt
FROM findings WHERE lower(severity) <> 'info'
UNION ALL
SELECT id, 'correlation', '/v1/chat/completions', 'gpt-5-mini', 7,
       '{"kind":"correlation","title":' || to_json('Correlated order ' || CAST(orderkey AS VARCHAR)) || ',"description":'
       || to_json('Order ' || CAST(orderkey AS VARCHAR) || ' with priority ' || o_orderpriority) || '}'
FROM correlations JOIN (SELECT o_orderkey, o_orderpriority FROM orders) o ON orderkey = o_orderkey""", ops=("C11",))
def q_batch_requests(spark, sf_dir):
    lines = cm.batch_requests(findings(spark, sf_dir), correlations(spark, sf_dir))
    body = F.get_json_object("line", "$.body")
    return lines.select(
        F.get_json_object("line", "$.custom_id").alias("custom_id"), "kind", F.get_json_object("line", "$.url").alias("url"),
        F.get_json_object(body, "$.model").alias("model"),
        F.size(F.from_json(F.get_json_object(body, "$.response_format.json_schema.schema.required"), "array<string>"))
        .cast("long").alias("n_fields"),
        F.get_json_object(body, "$.messages[1].content").alias("prompt"))


# C7 / P27 repair over the C1 texts -------------------------------------------------------------------
@query("repaired_texts", _F + f"""
, sft AS (SELECT id, {O.sft_text_sql()} AS text FROM findings),
p AS (SELECT id, {_block('text', 'system')} AS s, {_block('text', 'user')} AS u,
             {_block('text', 'assistant')} AS a FROM sft),
q AS (SELECT id, s, u, {_section('a', 'think')} AS think, {_section('a', 'answer')} AS ans FROM p)
SELECT id, '<|im_start|>system' || chr(10) || s || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10)
       || u || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || '<think>' || chr(10)
       || think || chr(10) || '</think>' || chr(10) || '<answer>' || chr(10)
       || '{{"risk_score": ' || CAST(CAST(round_even(json_extract(ans, '$.risk_score')::DOUBLE, 0) AS BIGINT) AS VARCHAR)
       || ', "severity": ' || to_json(upper(json_extract_string(ans, '$.severity')))
       || ', "category": ' || to_json(json_extract_string(ans, '$.category')) || '}}'
       || chr(10) || '</answer><|im_end|>' AS text,
       false AS placeholder_fixed
FROM q""", ops=("C7",))
def q_repaired_texts(spark, sf_dir):
    return cm.repair_chatml(cm.sft_texts(findings(spark, sf_dir)).drop("ord"))


# C6 / C7 / P27 / P28 / C8 over documents as user blocks: no text, placeholders at depth, extra and missing keys
_CRAFT_SQL = """
WITH d AS (SELECT doc_id, n_chars, source, lang FROM documents),
     kinds AS (SELECT *, doc_id % 4 AS k FROM d)"""


def _crafted(spark, sf_dir):
    d = tb.read(spark, sf_dir, "documents").select("doc_id", "n_chars", "source", "lang", (F.col("doc_id") % 4).alias("k"))
    user = F.concat(F.when(F.col("k") == 1, F.lit("see ")).otherwise(F.lit("")),
                    F.lit('{"source": "'), F.col("source"), F.lit('", "severity": "'),
                    F.when(F.col("k") == 2, F.lit("high")).otherwise(F.lit("none")),
                    F.lit('", "risk_score": '), F.col("n_chars").cast("string"),
                    F.lit(', "deep": {"none": [null, "N/A", "'), F.col("lang"), F.lit('"]}}'))
    answer = (F.when(F.col("k") == 0, F.lit('{"confidence": 0.5, "severity": "low"}'))
              .when(F.col("k") == 1, F.concat(F.lit('{"risk_score": '), F.col("doc_id").cast("string"), F.lit(".5}")))
              .otherwise(F.lit("{}")))
    text = F.concat(F.lit("<|im_start|>system\nS\n<|im_end|>\n<|im_start|>user\n"), user,
                    F.lit("\n<|im_end|>\n<|im_start|>assistant\n<think>t</think><answer>"), answer, F.lit("</answer>\n<|im_end|>"))
    return d.select("doc_id", F.when(F.col("k") != 3, text).alias("text"))


@query("repaired_crafted", _CRAFT_SQL + """
SELECT doc_id, true AS placeholder_fixed,
       '<|im_start|>system' || chr(10) || 'S' || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10)
       || '{' || chr(10) || '  "source": "' || source || '",' || chr(10)
       || '  "severity": "' || CASE k WHEN 2 THEN 'high' ELSE 'unspecified' END || '",' || chr(10)
       || '  "risk_score": ' || n_chars || ',' || chr(10) || '  "deep": {' || chr(10) || '    "none": [' || chr(10)
       || '      "unspecified",' || chr(10) || '      "unspecified",' || chr(10) || '      "' || lang || '"' || chr(10)
       || '    ]' || chr(10) || '  }' || chr(10) || '}' || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>assistant'
       || chr(10) || '<think>' || chr(10) || 't' || chr(10) || '</think>' || chr(10) || '<answer>' || chr(10)
       || CASE k WHEN 0 THEN '{"confidence": 0.5, "severity": "LOW", "risk_score": ' || n_chars || ', "category": "unspecified"}'
                 WHEN 1 THEN '{"risk_score": ' || CAST(round_even(doc_id + 0.5, 0) AS BIGINT)
                             || ', "severity": "UNSPECIFIED", "category": "unspecified"}'
                 ELSE '{"risk_score": ' || n_chars || ', "severity": "HIGH", "category": "unspecified"}' END
       || chr(10) || '</answer><|im_end|>' AS text
FROM kinds WHERE k <> 3""", ops=("C6", "C7", "P27", "P28"))
def q_repaired_crafted(spark, sf_dir):
    return cm.repair_chatml(_crafted(spark, sf_dir))


@query("prompt_pairs_crafted", _CRAFT_SQL + """
SELECT doc_id, CASE k WHEN 1 THEN CAST(round_even(doc_id + 0.5, 0) AS BIGINT) ELSE n_chars END AS gt_risk_score,
       CASE k WHEN 0 THEN 'LOW' ELSE upper(lang) END AS gt_severity, source AS gt_category
FROM kinds WHERE k <> 3""", ops=("C8", "P29"))
def q_prompt_pairs_crafted(spark, sf_dir):
    own = tb.read(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("risk_score"),
                                                     F.col("lang").alias("severity"), F.col("source").alias("category"))
    pp = cm.prompt_pairs(_crafted(spark, sf_dir).where("text is not null").join(own, "doc_id"))
    return pp.select("doc_id", F.col("ground_truth.risk_score").alias("gt_risk_score"),
                     F.col("ground_truth.severity").alias("gt_severity"), F.col("ground_truth.category").alias("gt_category"))
