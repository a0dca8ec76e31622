"""The registered queries of the training-data operators: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import (
    decontam,
    langid,
    licenses,
    merkle,
    packing,
    pii,
    ppm,
    quality,
    simhash,
    token_files,
    toxicity,
    warc,
    whitening,
)
from vigil.llm.common import read, shared_path

#: The published tokenizer file that token queries use by default.
TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_quality_forest")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op2_simhash_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op3_benchmark_decontamination", decontam.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op4_ppm_scores")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(read(spark, sf_dir, "documents"), ppm.held_out(), across=True)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


@query("op9_token_files")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    token_files.write(read(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_files.digests(token_files.read(spark, path))


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.fit(read(spark, sf_dir, "documents"))
    return langid.identify_pages(read(spark, sf_dir, "pages"), model)


@query("op7_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     largest AS (SELECT html, max(page_id) AS top FROM p WHERE strlen(html) >= 1000 GROUP BY html)
SELECT page_id, strlen(p.html) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM p LEFT JOIN largest ON p.html = largest.html""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), path)
    return warc.digests(warc.parse(warc.records(spark, path)))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op10_license_scan", licenses.oracle())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


@query("op12_merkle_manifest", merkle.oracle())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


@query("op13_semi_markov_pii")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents"))
