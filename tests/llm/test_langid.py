import numpy as np
import pytest
from llm_cases import ODD, SF
from pyspark.sql import functions as F

from vigil.llm import langid


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs)


def test_held_out_texts(spark, model):
    other = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id >= 200 and n_chars > 200")
    names = (*model.languages, langid.UNKNOWN)
    rows = [(r.lang, names[model.evidence(r.text.encode()).argmax()]) for r in other.collect()]
    assert np.mean([a == b for a, b in rows]) >= 0.97


def test_pages(spark, model):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = langid.identify_pages(pages, model).collect()
    assert len(got) == pages.count()
    assert np.mean([r.language == r.declared for r in got]) >= 0.95
    assert all(0 <= r.posterior <= 1 for r in got)


def test_fusion_by_hand():
    """One host of Spanish pages; a text that leaves Spanish and French even goes to the host's language."""
    b = langid.Beliefs(("es", "fr", "und"), np.array([0.5, 0.49, 0.01]), {"fr": np.array([0.1, 0.2, 0.1])}, {"com": np.array([0.3, 0.3, 0.3])})
    x = np.log(np.array([[0.45, 0.45, 0.1]]))
    host = np.array([[30.0, 0.0, 0.0]])
    p, silent, text = b.judge(x, host, host, np.array([True]), ["fr"], ["com"])
    own = np.array([0.495, 0.495, 0.01]) * [0.45, 0.45, 0.1]
    own /= own.sum()
    rest = np.maximum(0, host[0] - own)
    domain = (rest + 20 * b.share) / (rest.sum() + 20)
    prior = (rest + 20 * domain) / (rest.sum() + 20)
    expected = np.array([0.45, 0.45, 0.1]) * prior * [0.1, 0.2, 0.1] * 0.3
    assert np.allclose(text[0], own) and np.allclose(p[0], expected / expected.sum()) and not silent[0]
    assert p[0].argmax() == 0


def test_host_and_declaration(spark):
    rows = [("http://u:p@A.Example.com:80/x", '<HTML class="x" LANG=\'fr-CA\'>'), ("nonsense", "<html>"), (None, None),
            ("https://de.site.org?x", "<p lang='en'>")]
    df = spark.createDataFrame(rows, "url string, html string")
    got = df.select(langid.host_of(F.col("url")), langid.declared_of(F.col("html"))).collect()
    assert [tuple(r) for r in got] == [("a.example.com", "fr"), (None, None), (None, None), ("de.site.org", None)]


def test_odd_pages(spark, model):
    rows = [(i, u, h) for i, u, h in [
        (1, None, None), (2, "http://x.com", ""), (3, "http://x.com", "<p>123 &amp; 456</p>"), (None, "bad", "<html lang=xx>the"),
        (4, "http://x.com", "<html lang=en>" + "the thing and that " * 5000), (4, "http://x.com", "<html lang=en><script>no"),
        (5, "http://x.com", "Это совсем другой язык, " * 20)]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("language", F.lit("clash"))
    got = langid.identify_pages(df, model).collect()
    assert len(got) == len(rows)
    by = {(r.page_id, r.host): r for r in got}
    assert by[1, None].language == by[2, "x.com"].language == by[3, "x.com"].language == "und"
    assert by[5, "x.com"].language == "und" and not by[5, "x.com"].kept
    assert langid.identify_pages(df.limit(0), model).count() == 0


def test_keep_identified(docs, make, model):
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() >= 0.99 * docs.count()
    odd = make(ODD + [(30, docs.first().text)] * 2).withColumn("row", F.lit(1)).withColumn("host", F.lit("h"))
    got = langid.keep_identified(odd, model)
    assert got.columns == odd.columns
    ids = [r.doc_id for r in got.collect()]
    assert ids.count(30) == 2 and not {1, 2, 3} & set(ids)
    assert langid.keep_identified(make([]), model).count() == 0
    assert langid.keep_identified(make([]), langid.fit(make([]))).count() == 0
