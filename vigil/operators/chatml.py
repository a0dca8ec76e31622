"""Training-set shaping over DataFrames.

All operators are narrow (row-local) except ``conversation_texts``, which
assembles one ChatML document per conversation from its turns (bounded by the
conversation itself, ordered by turn).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import chat as ch
from vigil.functions import fixed
from vigil.functions import jsontext as jt
from vigil.functions import text as tx
from vigil.operators.normalize import coerce_double, coerce_int


# --- P10-P13 ------------------------------------------------------------------------------------
def coerce_metadata(meta) -> F.Column:
    """Null -> {}; a JSON object kept; other JSON / text -> {"raw": text}."""
    m = F.coalesce(meta, F.lit(None))
    obj = ch.is_json_object(m)
    raw = F.to_json(F.struct(m.alias("raw")))
    return F.when(m.isNull(), F.lit("{}")).when(obj, m).otherwise(raw)


def flatten_findings(df: DataFrame, passthrough: tuple[str, ...] = ()) -> DataFrame:
    """P10: the 7-field training row (falsy text -> defaults; severity lower-cased; rationale fallback)."""
    title = F.coalesce(F.when(F.col("title") != "", F.col("title")), F.lit(fixed.DEFAULT_TITLE))
    desc = F.coalesce(F.when(F.col("description") != "", F.col("description")), F.lit(ch.FLAT_DEFAULT_DESCRIPTION))
    cat = F.coalesce(F.when(F.col("category") != "", F.col("category")), F.lit("unknown"))
    risk = coerce_int(F.col("risk_score"), 0)
    sev = F.lower(F.coalesce(F.col("severity").cast("string"), F.lit("info")))
    rat = F.col("rationale") if "rationale" in df.columns else F.lit(None).cast("string")
    fallback = F.format_string(ch.FLAT_FALLBACK_RATIONALE, F.when(sev != "", sev).otherwise("info"), risk)
    rationale = F.when(F.coalesce(rat, F.lit("")) == "", fallback).otherwise(rat)
    keep = [c for c in ("id", "ord", *passthrough) if c in df.columns]
    return df.select(*keep, title.alias("title"), desc.alias("description"),
                     coerce_metadata(F.col("metadata")).alias("metadata"), cat.alias("category"),
                     risk.alias("risk_score"), sev.alias("severity"), rationale.alias("rationale"))


# --- P14-P16 -------------------------------------------------------------------------------------
def backfill_rationale(df: DataFrame) -> DataFrame:
    """kb_refs attached (P15) then rationale built (P14) where missing or empty."""
    rat = F.col("rationale") if "rationale" in df.columns else F.lit(None).cast("string")
    built = ch.build_rationale(F.col("category"), F.col("severity"), F.col("title"), F.col("_meta"))
    return (df.withColumn("kb_refs", ch.kb_refs(F.col("category"), F.col("metadata")))
              .withColumn("_meta", ch.meta_fields(F.col("metadata")))
              .withColumn("rationale", F.when(F.coalesce(rat, F.lit("")) == "", built).otherwise(rat)).drop("_meta"))


# --- C1 ------------------------------------------------------------------------------------------------
def _sft_parts(df: DataFrame, passthrough: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """Findings with ``_r``, the rationale, and ``_answer``; and the columns to keep.

    Intermediate results are separate columns so each large expression is
    evaluated once per row (and each projection stays inside codegen limits).
    """
    rat = F.col("rationale") if "rationale" in df.columns else F.lit(None).cast("string")
    keep = [c for c in ("id", "ord", *passthrough) if c in df.columns]
    staged = (df.select(*keep, "title", "description", "metadata", "category", "severity", "risk_score",
                        rat.alias("_rat"))
              .withColumn("_meta", ch.meta_fields(F.col("metadata")))
              .withColumn("_built", ch.build_rationale(F.col("category"), F.col("severity"), F.col("title"),
                                                       F.col("_meta")))
              .withColumn("_r0", F.when(tx.generic_rationale(F.col("_rat")),
                                        F.coalesce(F.when(F.col("_built") != "", F.col("_built")),
                                                   F.lit(fixed.GENERIC_RATIONALE_FALLBACK)))
                          .otherwise(F.col("_rat")))
              .withColumn("_r0s", tx.py_strip(F.col("_r0")))
              .withColumn("_r", F.when(F.col("_r0s").rlike("(?s)^<think>.*</think>$"),
                                       tx.py_strip(F.regexp_extract(F.col("_r0s"), "(?s)^<think>(.*)</think>$", 1)))
                          .otherwise(F.col("_r0")))
              .withColumn("_answer", ch.answer_json(F.col("risk_score"), F.col("severity"), F.col("category"))))
    return staged, keep


def sft_texts(df: DataFrame, passthrough: tuple[str, ...] = ()) -> DataFrame:
    """One ChatML training text per finding."""
    staged, keep = _sft_parts(df, passthrough)
    staged = staged.withColumn("_user", ch.user_block_json(F.col("title"), F.col("description"), F.col("metadata")))
    return staged.select(*keep, ch.conversation_text(F.col("_user"), F.col("_r"), F.col("_answer")).alias("text"))


def sft_completions(df: DataFrame, passthrough: tuple[str, ...] = ()) -> DataFrame:
    """The assistant's part of the C1 texts, without building the rest."""
    staged, keep = _sft_parts(df, passthrough)
    text = F.concat_ws("\n", F.lit("<think>"), F.col("_r"), F.lit("</think>"), F.lit("<answer>"), F.col("_answer"), F.lit("</answer>"))
    return staged.select(*keep, text.alias("completion"))


# --- conversations -> ChatML documents ------------------------------------------------------------
def conversation_texts(conversations: DataFrame) -> DataFrame:
    """One ChatML document per conversation, turns in order (the group is the conversation)."""
    turn = F.concat(F.lit(ch.IM_START), F.col("role"), F.lit("\n"), F.coalesce(F.col("text"), F.lit("")),
                    F.lit(ch.IM_END))
    return (conversations.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", turn.alias("t")))).alias("ts"))
            .select("conv_id", F.array_join(F.col("ts.t"), "\n").alias("text")))


# --- V36 / P27 / P28 / C6 / C7 -------------------------------------------------------------------
def validate_chatml(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Per row, the list of error codes (only json_parse / missing_text drop a row).

    Blocks and sections are staged as columns so each is located once per row.
    """
    text = F.col(text_col)
    staged = (df.withColumn("_u", ch.parse_block(text, "user"))
                .withColumn("_a", ch.parse_block(text, "assistant"))
                .withColumn("_u_ok", ch.is_json(F.col("_u")))
                .withColumn("_brace", F.regexp_extract(F.coalesce(F.col("_u"), F.lit("")), r"(?s)\{.*\}", 0))
                .withColumn("_think", ch.think_section(F.col("_a")))
                .withColumn("_ans", ch.answer_section(F.col("_a"))))
    u, a, ok, brace = F.col("_u"), F.col("_a"), F.col("_u_ok"), F.col("_brace")
    think, ans = F.col("_think"), F.col("_ans")
    codes = F.array_compact(F.array(
        F.when((F.coalesce(u, F.lit("")) == "") | (F.coalesce(a, F.lit("")) == ""), F.lit("chatml_structure")),
        F.when(~ok & (brace != "") & ~ch.is_json(brace), F.lit("user_json_parse")),
        F.when(~ok & (brace == ""), F.lit("user_json_missing")),
        F.when(think.isNull(), F.lit("missing_think")),
        F.when(ans.isNull(), F.lit("missing_answer")),
        F.when(ans.isNotNull() & ~ch.is_json(ans), F.lit("answer_json_parse")),
    ))
    out = staged.withColumn("error_codes", F.when(text.isNull(), F.array(F.lit("missing_text"))).otherwise(codes))
    return out.drop("_u", "_a", "_u_ok", "_brace", "_think", "_ans")


def repair_answers(df: DataFrame, answer: F.Column, fb_risk: F.Column, fb_sev: F.Column, fb_cat: F.Column,
                   name: str = "answer") -> DataFrame:
    """``df`` with ``name``, the repaired answer as JSON text.

    risk half-even int (else fallback, else 0); severity upper, placeholder -> INFO; category placeholder ->
    unspecified. Other keys stay, in their places, and keys that were missing follow them. Steps are columns of
    their own, so that each is worked out once a row.
    """
    staged = df.withColumn("_answer", answer)
    # A text that starts with a brace and parses is an object.
    staged = staged.withColumn("_variant", F.when(tx.first_char(F.col("_answer")) == "{", F.try_parse_json("_answer")))
    v = F.col("_variant")
    staged = staged.withColumns({"_ar": coerce_double(F.try_variant_get(v, "$.risk_score", "string"), None),
                                 "_as": F.try_variant_get(v, "$.severity", "string"),
                                 "_ac": F.try_variant_get(v, "$.category", "string"),
                                 "_object": F.when(v.isNotNull(), F.col("_answer"))})
    a_sev, a_cat = F.col("_as"), F.col("_ac")
    a_risk = F.when(~F.isnan("_ar") & (F.abs("_ar") < F.lit(float("inf"))), F.col("_ar"))
    # Fallbacks are worked out only where the answer lacks a value.
    staged = staged.withColumns({"_fr": F.when(a_risk.isNull(), fb_risk.cast("string")),
                                 "_fs": F.when(F.coalesce(a_sev, F.lit("")) == "", fb_sev),
                                 "_fc": F.when(F.coalesce(a_cat, F.lit("")) == "", fb_cat)})
    fs, fc = F.col("_fs"), F.col("_fc")
    f_risk = coerce_double(F.col("_fr"), None)
    risk = F.coalesce(F.bround(a_risk, 0), F.bround(f_risk, 0), F.lit(0.0)).cast("long")
    sev = F.upper(F.coalesce(F.when(a_sev != "", a_sev), F.when(fs != "", fs), F.lit("INFO")))
    sev = F.when(sev.rlike(tx.PLACEHOLDER_RE), F.lit("INFO")).otherwise(sev)
    cat = F.coalesce(F.when(a_cat != "", a_cat), F.when(fc != "", fc), F.lit("unspecified"))
    cat = F.when(cat.rlike(tx.PLACEHOLDER_RE), F.lit("unspecified")).otherwise(cat)
    staged = staged.withColumns({"_risk": risk.cast("string"), "_sev": ch.json_str(sev), "_cat": ch.json_str(cat),
                                 "_old": jt.object_entries(F.col("_object"))})
    new = [('"risk_score"', F.col("_risk")), ('"severity"', F.col("_sev")), ('"category"', F.col("_cat"))]

    def value(e: F.Column) -> F.Column:
        return F.coalesce(*[F.when(e["key"] == k, c) for k, c in new], e["value"])

    kept = F.transform("_old", lambda e: F.concat(e["key"], F.lit(": "), value(e)))
    missing = [F.when(~F.array_contains(F.col("_old.key"), k), F.concat(F.lit(k + ": "), c)) for k, c in new]
    text = F.concat(F.lit("{"), F.concat_ws(", ", kept, *missing), F.lit("}"))
    return staged.withColumn(name, text).drop(
        "_answer", "_variant", "_ar", "_as", "_ac", "_fr", "_fs", "_fc", "_object", "_risk", "_sev", "_cat", "_old")


# --- C8 / P29 -------------------------------------------------------------------------------------
def prompt_pairs(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Prompt ending exactly at <think> + normalised ground truth (P29: what the answer lacks comes from the
    row's own columns); rows without user/assistant dropped."""
    text = F.col(text_col)
    staged = (df.withColumn("_s", ch.block_regex(text, "system"))
                .withColumn("_u", ch.block_regex(text, "user"))
                .withColumn("_a", ch.block_regex(text, "assistant"))
                .where((F.col("_u") != "") & (F.col("_a") != ""))
                .withColumn("_ans", ch.tag_section(F.col("_a"), "answer"))
                .withColumn("_v", F.when(tx.first_char(F.col("_ans")) == "{",
                                         F.try_parse_json(F.col("_ans")))))
    v = F.col("_v")
    obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    a_risk = F.when(obj, coerce_double(F.try_variant_get(v, "$.risk_score", "string"), None))
    own_risk = coerce_double(_column(df, "risk_score"), None)
    risk = F.coalesce(F.bround(a_risk, 0), F.bround(own_risk, 0), F.lit(0.0)).cast("long")
    a_sev = F.when(obj, F.try_variant_get(v, "$.severity", "string"))
    sev = F.upper(F.trim(F.coalesce(_truthy(a_sev), _truthy(_column(df, "severity")), F.lit("INFO"))))
    a_cat = F.when(obj, F.try_variant_get(v, "$.category", "string"))
    cat = F.coalesce(_truthy(a_cat), _truthy(_column(df, "category")), F.lit("unspecified"))
    prompt = F.concat_ws("\n", F.lit(ch.IM_START + "system"), F.col("_s"), F.lit(ch.IM_END),
                         F.lit(ch.IM_START + "user"), F.col("_u"), F.lit(ch.IM_END),
                         F.lit(ch.IM_START + "assistant"), F.lit("<think>"))
    keep = [c for c in df.columns if c != text_col]
    return staged.select(*keep, prompt.alias("prompt"),
                         F.struct(risk.alias("risk_score"), sev.alias("severity"), cat.alias("category"))
                         .alias("ground_truth"))


# --- C9 / C10 -------------------------------------------------------------------------------------
def _message(role: str, content: F.Column) -> F.Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _short_answer(df: DataFrame) -> F.Column:
    """The answer JSON {risk_score, severity}."""
    return F.concat(F.lit('{"risk_score": '), F.col("risk_score").cast("long").cast("string"), F.lit(', "severity": '),
                    ch.json_str(F.coalesce(F.col("severity"), F.lit("info"))), F.lit("}"))


def _user(df: DataFrame, category: bool) -> F.Column:
    return ch.user_block_json(F.col("title"), F.col("description"), F.col("metadata"), F.col("category") if category else None)


def chat_messages(df: DataFrame, category: bool = False) -> DataFrame:
    """Messages [system, user(JSON indent 2)] and the answer JSON {risk_score, severity}; ``category``: the user
    block names the category too."""
    keep = [c for c in ("id", "ord") if c in df.columns]
    return df.select(*keep, F.array(_message("system", F.lit(ch.SYSTEM_PROMPT)), _message("user", _user(df, category))).alias("messages"),
                     _short_answer(df).alias("answer"))


def training_messages(df: DataFrame, target: str, prompt: str = ch.SYSTEM_PROMPT) -> DataFrame:
    """Messages [system, user, assistant].

    target "json": the assistant's JSON has risk_score, severity, rationale and mitigation_steps (a JSON list, by
    default empty). target "think": the rationale as thoughts, the answer JSON after them, and the user block with the
    category.
    """
    rationale = F.coalesce(F.col("rationale"), F.lit(""))
    if target == "json":
        steps = F.coalesce(_column(df, "mitigation_steps"), F.lit("[]"))
        own = F.concat(F.lit('{"risk_score": '), F.col("risk_score").cast("long").cast("string"), F.lit(', "severity": '),
                       ch.json_str(F.coalesce(F.col("severity"), F.lit("info"))), F.lit(', "rationale": '), ch.json_str(rationale),
                       F.lit(', "mitigation_steps": '), steps, F.lit("}"))
    elif target == "think":
        own = F.concat(F.lit("<think>\n"), rationale, F.lit("\n</think>\n<answer>\n"), _short_answer(df), F.lit("\n</answer>"))
    else:
        raise ValueError(f"no such target: {target}")
    keep = [c for c in ("id", "ord") if c in df.columns]
    return df.select(*keep, F.array(_message("system", F.lit(prompt)), _message("user", _user(df, target == "think")),
                                    _message("assistant", own)).alias("messages"))


def protocol_texts(df: DataFrame, prompt: str = ch.SYSTEM_PROMPT) -> DataFrame:
    """C9, third form: one text per row that ends with the row's ``output``, or ``response`` where that is empty."""
    reply = F.coalesce(_truthy(_column(df, "output")), _column(df, "response"), F.lit("None"))
    text = F.concat(F.lit(ch.IM_START + "system\n" + prompt + ch.IM_END + "\n" + ch.IM_START + "user\n"), _user(df, False),
                    F.lit(ch.IM_END + "\n" + ch.IM_START + "assistant\n"), reply, F.lit(ch.IM_END))
    keep = [c for c in ("id", "ord") if c in df.columns]
    return df.select(*keep, text.alias("text"))


# --- C11 -------------------------------------------------------------------------------------------
# FIXED VALUES: the fields an enrichment request asks for.
ENRICHMENT_FIELDS = ["rationale", "risk_score", "probability_actionable", "mitigation_steps", "attack_vectors",
                     "business_impact", "technical_details"]


def batch_requests(findings: DataFrame, correlations: DataFrame, model: str = "gpt-5-mini",
                   max_tokens: int | None = None, skip_low_value: bool = True) -> DataFrame:
    """C11: one request line per finding (info dropped when ``skip_low_value``) and per correlation."""
    f = findings
    if skip_low_value:
        f = f.where(F.coalesce(F.lower(F.col("severity")), F.lit("")) != "info")
    fr = f.select(F.coalesce(F.col("id"), F.concat(F.lit("finding-"), F.md5(F.to_json(F.struct("title", "description")))))
                  .alias("custom_id"), F.lit("finding").alias("kind"), "title", "description")
    cr = correlations.select(
        F.coalesce(F.col("id"), F.concat(F.lit("correlation-"), F.md5(F.to_json(F.struct("title", "description")))))
        .alias("custom_id"), F.lit("correlation").alias("kind"), "title", "description")
    rows = fr.unionByName(cr)
    schema = F.struct(F.lit("object").alias("type"),
                      F.array(*[F.lit(x) for x in ENRICHMENT_FIELDS]).alias("required"))
    user = F.to_json(F.struct(F.col("kind"), F.col("title"), F.col("description")))
    body_fields = [F.lit(model).alias("model"),
                   F.array(F.struct(F.lit("system").alias("role"),
                                    F.lit("You are a security analyst. Enrich the finding.").alias("content")),
                           F.struct(F.lit("user").alias("role"), user.alias("content"))).alias("messages"),
                   F.struct(F.lit("json_schema").alias("type"),
                            F.struct(F.lit("security_enrichment").alias("name"), schema.alias("schema"),
                                     F.lit(True).alias("strict")).alias("json_schema")).alias("response_format")]
    if max_tokens is not None:
        body_fields.append(F.lit(max_tokens).alias("max_tokens"))
    line = F.to_json(F.struct(F.col("custom_id"), F.lit("POST").alias("method"),
                              F.lit("/v1/chat/completions").alias("url"), F.struct(*body_fields).alias("body")))
    return rows.select("custom_id", "kind", line.alias("line"))


# --- R1-R8 -------------------------------------------------------------------------------------------
def score_completions(df: DataFrame, completion: str = "completion", answer: str = "answer") -> DataFrame:
    """R1-R8 as columns over (completion, answer JSON).

    The think / answer sections and the parsed answer are staged as columns so
    each is located once per row and shared by the rewards that need it.
    """
    c = F.col(completion)
    a = F.try_parse_json(F.col(answer))
    staged = (df.withColumn("_gt_risk", F.coalesce(F.try_variant_get(a, "$.risk_score", "double"), F.lit(0.0)))
                .withColumn("_gt_sev", F.coalesce(F.try_variant_get(a, "$.severity", "string"), F.lit("info")))
                .withColumn("_c", F.coalesce(c, F.lit("")))
                .withColumn("_pred_risk", ch.soft_extract(F.col("_c"), "risk_score", True))
                .withColumn("_pred_sev", ch.soft_extract(F.col("_c"), "severity", False))
                .withColumn("_think_low", F.lower(ch.tag_section(F.col("_c"), "think")))
                .withColumn("_c_low", F.lower("_c"))
                .withColumn("_think_ci_low", ch.tag_section(F.col("_c_low"), "think"))
                .withColumn("_ans", ch.tag_section(F.col("_c"), "answer"))
                .withColumn("_ans_v", F.when(tx.first_char(F.col("_ans")) == "{",
                                             F.try_parse_json(F.col("_ans"))))
                .withColumn("_ans_risk", ch.answer_risk_from_variant(F.col("_ans_v")))
                .withColumn("_d", F.abs(F.col("_ans_risk") - F.col("_gt_risk"))))
    pred, psev = F.col("_pred_risk"), F.col("_pred_sev")
    gt = F.col("_gt_risk")
    risk_linear = F.when(pred.isNull(), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(pred - gt) / F.lit(100.0)))
    sev_match = F.when(ch.truthy(psev) & (F.lower(psev) == F.lower(F.col("_gt_sev"))), F.lit(1.0)).otherwise(F.lit(0.0))
    out = staged.select(
        *df.columns,
        ch.json_validity_reward(F.col("_c")).alias("json_validity"),
        F.round(risk_linear, 6).alias("risk_linear"),
        sev_match.alias("severity_match"),
        ch.format_reward(F.col("_c"), anchored=True).alias("format_strict"),
        ch.format_reward(F.col("_c"), anchored=False).alias("format_loose"),
        F.round(ch.keyword_score(F.col("_think_low"), ch.REASONING_ANCHORS, lowered=True), 6).alias("reasoning_structure"),
        F.round(ch.keyword_score(F.col("_think_ci_low"), ch.DEPTH_KEYWORDS, lowered=True), 6).alias("analytical_depth"),
        ch.banded(F.col("_d")).alias("risk_banded"),
        ch.strict(F.col("_d")).alias("risk_strict"),
    )
    return out


# --- P27 / C6 / C7: repair ---------------------------------------------------------------------------
def _user_object(block: F.Column) -> F.Column:
    """The user block if it is JSON, else its part from the first ``{`` to the last ``}`` if that is; else null."""
    outer = F.regexp_extract(F.coalesce(block, F.lit("")), r"(?s)\{.*\}", 0)
    return F.when(ch.is_json(block), block).when(ch.is_json(outer), outer)


def _truthy(c: F.Column) -> F.Column:
    return F.when(~F.coalesce(c, F.lit("")).isin("", "0", "0.0", "false"), c)


def _column(df: DataFrame, name: str) -> F.Column:
    """A column's text, null where the data has no such column."""
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def repair_chatml(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Rebuild each text from its parts: cleaned user JSON (P27), the think section, and the repaired answer.

    What the answer lacks comes from the row's own risk_score, severity and category, else from the cleaned user
    block. Rows without a text are dropped.
    """
    text = F.col(text_col)
    staged = (df.where(text.isNotNull())
                .withColumn("_sys", ch.parse_block(text, "system"))
                .withColumn("_u", ch.parse_block(text, "user"))
                .withColumn("_a", ch.parse_block(text, "assistant"))
                .withColumn("_think", ch.think_section(F.col("_a")))
                .withColumn("_ans", ch.answer_section(F.col("_a")))
                .withColumn("_json", _user_object(F.col("_u")))
                .withColumn("_clean", F.when(jt.is_nested(F.col("_json")), jt.cleaned_text(F.col("_json"))))
                .withColumn("_parts", jt.nested_parts(F.col("_clean")))
                # Other JSON, and what follows a JSON value, is repaired by tokens.
                .withColumn("_raw", jt.tokens(F.when(F.col("_clean").isNull(), F.col("_json"))))
                .withColumn("_new", jt.cleaned(F.col("_raw")))
                .withColumn("_user", F.when(F.col("_clean").isNotNull(), jt.nested_object(F.col("_parts")))
                            .when(F.size("_new") > 0, jt.indented(F.col("_new"))).otherwise(F.lit("{}"))))

    def fallback(name: str) -> F.Column:
        return F.coalesce(_truthy(_column(df, name)), _truthy(F.get_json_object(F.col("_user"), f"$.{name}")))

    staged = repair_answers(staged, F.col("_ans"), fallback("risk_score"), fallback("severity"), fallback("category"), "_fixed")
    rebuilt = F.concat_ws("\n", F.lit(ch.IM_START + "system"), F.coalesce(F.col("_sys"), F.lit("")),
                          F.lit(ch.IM_END), F.lit(ch.IM_START + "user"), F.col("_user"),
                          F.lit(ch.IM_END), F.lit(ch.IM_START + "assistant"), F.lit("<think>"),
                          F.coalesce(F.col("_think"), F.lit("")), F.lit("</think>"), F.lit("<answer>"), F.col("_fixed"),
                          F.lit("</answer>" + ch.IM_END))
    keep = [c for c in df.columns if c != text_col]
    fixed_any = F.when(F.col("_clean").isNull(), F.col("_raw") != F.col("_new")).otherwise(F.col("_json") != F.col("_clean"))
    return staged.select(*keep, rebuilt.alias(text_col), fixed_any.alias("placeholder_fixed"))
