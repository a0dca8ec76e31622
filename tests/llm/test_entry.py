import os
import shutil
import subprocess
import sys

import corpus_pipeline
import pytest
from llm_cases import ODD, SF
from pyspark.sql import functions as F

import __spark_entry__ as entry

SOME = "/root/testdata/sf0.01"
ROOT = os.path.dirname(os.path.abspath(entry.__file__))


def test_one_query_for_each_operator():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5


def test_the_rest_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q)"
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    n, ops, pipeline = said.stdout.split()[-3:]
    assert int(n) >= 50 and (ops, pipeline) == ("False", "False")


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage returns, documents (enough of them labelled to learn from) with some planted ones going in."""
    docs = spark.read.parquet(f"{SOME}/documents.parquet")
    item = spark.read.parquet(f"{SOME}/benchmark.parquet").first().text
    toxic = "idiot scum worthless trash moron clown pathetic loser stupid disgusting "
    base = docs.where("lang = 'en' and n_chars > 800").orderBy("doc_id").first()
    rows = [(9001, toxic + base.text[:200] + toxic), (9002, base.text), (9003, base.text + " tail"), (9004, "Before. " + item + " After."),
            (9005, None), (9006, "12345 $$$")]
    schema = docs.schema
    extra = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in rows], schema)
    frame, out = docs.unionByName(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        before = frame
        frame = stage(spark, frame, SOME).cache()
        out[name] = (before, frame)
    return out, base.doc_id


def test_stages(steps):
    out, base = steps
    ids = {name: {r[0] for r in after.select("doc_id").collect()} for name, (_, after) in out.items()}
    for name, (before, after) in out.items():
        if name != "best_fit_packing":
            assert after.columns == before.columns
            assert ids[name] <= {r[0] for r in before.select("doc_id").collect()}
    assert not {9005, 9006} & ids["language_id"] and 9002 in ids["language_id"]
    assert 9001 not in ids["toxicity"] and 9002 in ids["toxicity"]
    assert base in ids["simhash_near_dedup"] and not {9002, 9003} & ids["simhash_near_dedup"]
    assert 9004 in ids["simhash_near_dedup"] and 9004 not in ids["benchmark_decontamination"]
    assert ids["best_fit_packing"] == ids["benchmark_decontamination"]
    assert len(ids["language_id"]) >= 999 and len(ids["benchmark_decontamination"]) >= 700


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    worst = got.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert 0 < worst <= 4096


def test_stages_take_odd_rows(spark, make):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, make(ODD), SF).count() >= 0, name
        assert stage(spark, make([]), SF).count() == 0, name
