"""JSON / JSONL sources.

Lines are read with ``spark.read.text`` (splittable, no schema inference) and
parsed with ``try_parse_json`` into VARIANT, so one odd line never nulls its
neighbours and the original text stays available as ``raw`` for key-presence
tests (T3).

Input order without a single-task line counter: every row carries
``(source_ord, _file, _block, _pos)`` where ``_block`` is the byte offset of
its split and ``_pos`` its position inside that split's partition run
(``monotonically_increasing_id``). Sorting by that key reproduces file order;
exact line numbers (only needed for error reports, S3) come from per-split
counts turned into offsets on a table with one row per split.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

ORDER_COLS = ["source_ord", "_file", "_block", "_pos"]


def existing_paths(spark: SparkSession, paths: list[str]) -> list[tuple[int, str]]:
    """Keep inputs that exist (Hadoop FS glob), warn about the rest; keeps the input position."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for i, p in enumerate(paths):
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        st = fs.globStatus(hp)
        if st is None or len(st) == 0:
            log.warning("input %s not found, skipping", p)
            continue
        out.append((i, p))
    return out


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw lines with their input-order key (source_ord, _file, _block, _pos)."""
    found = existing_paths(spark, paths)
    if not found:
        return spark.createDataFrame([], "value string, source_ord int, _file string, _block long, _pos long")
    frames = []
    for i, p in found:
        frames.append(
            spark.read.text(p).select(
                F.col("value"), F.lit(i).alias("source_ord"),
                F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("_block"),
                F.monotonically_increasing_id().alias("_pos")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """1-based line number per file, computed in two levels (never one task per file)."""
    per_split = lines.groupBy("source_ord", "_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_p0"))
    w = Window.partitionBy("source_ord", "_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_split.select("source_ord", "_file", "_block", "_p0",
                               F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (lines.join(offsets, ["source_ord", "_file", "_block"])
            .withColumn("line", F.col("_off") + F.col("_pos") - F.col("_p0") + 1)
            .drop("_off", "_p0"))


def _blank(v: Column) -> Column:
    return F.trim(F.coalesce(v, F.lit(""))) == ""


def read_jsonl(spark: SparkSession, paths: list[str] | str, mode: str = "tolerant") -> DataFrame:
    """S1 (tolerant: blank and malformed lines skipped) / S2 (strict: malformed lines raise).

    Returns ``raw`` (the line), ``v`` (VARIANT) and the input-order key. Lines
    that are JSON but not objects are dropped (they would crash the reference, T22).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = read_lines(spark, paths).where(~_blank(F.col("value")))
    parsed = lines.select(F.trim(F.col("value")).alias("raw"), *ORDER_COLS) \
        .withColumn("v", F.try_parse_json(F.col("raw")))
    if mode == "strict":
        bad = parsed.where(F.col("v").isNull()).limit(1).count()
        if bad:
            raise ValueError("malformed JSON line in strict read")
    is_obj = F.coalesce(F.schema_of_variant(F.col("v")).startswith("OBJECT"), F.lit(False))
    return parsed.where(F.col("v").isNotNull() & is_obj).drop("v")


def jsonl_errors(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """S3: (file, line, code, detail) for lines that are not JSON, or not objects."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = with_line_numbers(read_lines(spark, paths))
    v = F.try_parse_json(F.col("value"))
    code = (F.when(v.isNull() & ~_blank(F.col("value")), F.lit("json_parse"))
            .when(v.isNotNull() & ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)),
                  F.lit("not_object")))
    return (lines.select(F.col("_file").alias("file"), "line", code.alias("code"),
                         F.col("value").alias("detail"))
            .where(F.col("code").isNotNull()))


# --- S4 / S5 / S7: document shapes -> one row per finding -------------------------------------------
# Nested levels are split with from_json into map<string,string> / array<string>:
# Spark keeps object key order in maps (VARIANT objects do not) and re-serialises
# nested values as JSON text, so one odd branch never nulls its siblings.
def read_documents(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Whole JSON documents (one per file) as text, with their input position."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    frames = []
    for i, p in existing_paths(spark, paths):
        frames.append(spark.read.text(p, wholetext=True).select(
            F.lit(i).alias("source_ord"), F.col("_metadata.file_path").alias("_file"),
            F.trim(F.col("value")).alias("doc")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _first_char(t: Column) -> Column:
    return F.substring(F.ltrim(t), 1, 1)


def _obj_entries(t: Column) -> Column:
    """Entries of a JSON object text in document order (empty when not an object)."""
    m = F.when(_first_char(t) == "{", F.from_json(t, "map<string,string>"))
    return F.coalesce(F.map_entries(m), F.array().cast("array<struct<key:string,value:string>>"))


def _arr(t: Column) -> Column:
    a = F.when(_first_char(t) == "[", F.from_json(t, "array<string>"))
    return F.coalesce(a, F.array().cast("array<string>"))


def _is_object(t: Column) -> Column:
    return F.coalesce((_first_char(t) == "{") & F.try_parse_json(t).isNotNull(), F.lit(False))


def structured_export_items(docs: DataFrame) -> DataFrame:
    """``data.findings{category{severity[items]}}`` -> one row per object item (others ignored)."""
    data = F.get_json_object(F.col("doc"), "$.data")
    findings = F.get_json_object(data, "$.findings")
    cats = docs.select("source_ord", "_file", F.posexplode(_obj_entries(findings)).alias("_ci", "c"))
    sevs = cats.select("source_ord", "_file", "_ci", F.col("c.key").alias("category_key"),
                       F.posexplode(_obj_entries(F.col("c.value"))).alias("_si", "s"))
    items = sevs.select("source_ord", "_file", "_ci", "_si", "category_key",
                        F.col("s.key").alias("severity_key"),
                        F.posexplode(_arr(F.col("s.value"))).alias("_ii", "raw"))
    return items.where(_is_object(F.col("raw")))


def findings_from_any_json(docs: DataFrame) -> DataFrame:
    """List of findings | structured export | a single finding (an object may yield both)."""
    d = F.col("doc")
    from_list = (docs.where(_first_char(d) == "[")
                 .select("source_ord", "_file", F.lit(0).alias("_branch"), F.lit(0).alias("_ci"),
                         F.lit(0).alias("_si"), F.posexplode(_arr(d)).alias("_ii", "raw"))
                 .where(_is_object(F.col("raw"))))
    from_export = (structured_export_items(docs.where(_first_char(d) == "{"))
                   .select("source_ord", "_file", F.lit(1).alias("_branch"), "_ci", "_si", "_ii", "raw"))
    keys = F.coalesce(F.json_object_keys(d), F.array().cast("array<string>"))
    single = (docs.where((_first_char(d) == "{") & F.array_contains(keys, "title")
                         & F.array_contains(keys, "description") & F.array_contains(keys, "severity")
                         & F.array_contains(keys, "risk_score"))
              .select("source_ord", "_file", F.lit(2).alias("_branch"), F.lit(0).alias("_ci"),
                      F.lit(0).alias("_si"), F.lit(0).alias("_ii"), d.alias("raw")))
    return from_list.unionByName(from_export).unionByName(single)


def findings_from_buckets(docs: DataFrame) -> DataFrame:
    """``{scanner: [finding, ...]}`` -> rows with a ``scanner`` column (dict key kept beside category)."""
    buckets = docs.select("source_ord", "_file", F.posexplode(_obj_entries(F.col("doc"))).alias("_bi", "b"))
    return (buckets.select("source_ord", "_file", "_bi", F.col("b.key").alias("scanner"),
                           F.posexplode(_arr(F.col("b.value"))).alias("_ii", "raw"))
            .where(_is_object(F.col("raw"))))


# --- VARIANT rows -> typed findings -------------------------------------------------------------------
def typed_findings(rows: DataFrame) -> DataFrame:
    """Project JSON rows (``raw`` text) onto the finding columns; ``raw`` is kept for key-presence tests."""
    v = F.try_parse_json(F.col("raw"))

    def s(path: str) -> Column:
        return F.try_variant_get(v, path, "string")

    cols = [
        s("$.id").alias("id"), s("$.title").alias("title"), s("$.severity").alias("severity"),
        s("$.risk_score").alias("risk_score_raw"),
        F.try_variant_get(v, "$.risk_score", "double").alias("risk_score"),
        s("$.description").alias("description"),
        F.get_json_object(F.col("raw"), "$.metadata").alias("metadata"),
        s("$.category").alias("category"),
        F.try_variant_get(v, "$.tags", "array<string>").alias("tags"),
        F.try_variant_get(v, "$.correlation_refs", "array<string>").alias("correlation_refs"),
        s("$.correlation_type").alias("correlation_type"),
        s("$.rationale").alias("rationale"),
        F.try_variant_get(v, "$.probability_actionable", "double").alias("probability_actionable"),
    ]
    extra = [c for c in rows.columns if c not in ("v", "doc")]
    out = rows.select(*extra, *cols)
    if "scanner" not in out.columns:
        out = out.withColumn("scanner", F.coalesce(F.col("category"), F.lit("unknown")))
    return out


def line_order(lines: DataFrame) -> DataFrame:
    """``ord`` (long, increasing in input order) for line rows, without a global sort.

    Splits are ranked on a table with one row per split; a row's ord is
    ``split_rank << 33 | position inside its split``.
    """
    per_split = lines.groupBy("source_ord", "_file", "_block").agg(F.min("_pos").alias("_p0"))
    w = Window.orderBy("source_ord", "_file", "_block")
    ranked = per_split.withColumn("_sr", F.row_number().over(w).cast("long"))
    return (lines.join(F.broadcast(ranked), ["source_ord", "_file", "_block"])
            .withColumn("ord", F.shiftleft(F.col("_sr"), 33) + (F.col("_pos") - F.col("_p0")))
            .drop("_sr", "_p0"))


def doc_order(items: DataFrame, local: list[str]) -> DataFrame:
    """``ord`` for items exploded from whole documents: document rank << 40 | rank inside the document."""
    docs = items.select("source_ord", "_file").distinct()
    ranked = docs.withColumn("_dr", F.row_number().over(Window.orderBy("source_ord", "_file")).cast("long"))
    inner = F.row_number().over(Window.partitionBy("source_ord", "_file").orderBy(*local)).cast("long")
    return (items.join(F.broadcast(ranked), ["source_ord", "_file"])
            .withColumn("ord", F.shiftleft(F.col("_dr"), 40) + inner).drop("_dr"))


def read_findings_jsonl(spark: SparkSession, paths: list[str] | str, mode: str = "tolerant") -> DataFrame:
    """S1/S2 + projection: typed findings with ``raw`` and input-order ``ord``."""
    return typed_findings(line_order(read_jsonl(spark, paths, mode)))


def read_findings_json(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """S5 + projection: typed findings from JSON documents of any supported shape."""
    return typed_findings(doc_order(findings_from_any_json(read_documents(spark, paths)),
                                    ["_branch", "_ci", "_si", "_ii"]))


def read_scanner_buckets(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """S7 + projection: ``{scanner: [findings]}`` documents to typed findings."""
    docs = read_documents(spark, paths)
    return typed_findings(doc_order(findings_from_buckets(docs), ["_bi", "_ii"]))


def head_slice(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first n rows by ``key`` (distributed top-k)."""
    return df.orderBy(key).limit(n)
