"""One id on a third of the rows with different texts, and long texts that slow patterns would never end on."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from vigil.llm import langid, licenses, simhash, toxicity


def test_keep_one_loses_no_text_of_a_shared_id(make):
    rows = [(1, "alpha beta gamma delta epsilon zeta"), (1, "nine quite other words stand in this long row"),
            (2, "nine quite other words stand in this long row"), (1, "alpha beta gamma delta epsilon zeta"), (3, "third thing here now")]
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_one(make(rows)).collect())
    assert kept == sorted({rows[0], rows[1], rows[4]})


def test_keep_one_where_an_id_has_a_third_of_the_rows(make):
    own = [(7, f"text number {i} of the shared id has words w{i} x{i} y{i} z{i} q{i}") for i in range(60)]
    rows = own * 2 + [(100 + i, f"another {i} document that says a{i} b{i} c{i} d{i}") for i in range(60)]
    kept = {r.text for r in simhash.keep_one(make(rows)).collect()}
    found = {r.component_id for r in simhash.near_duplicates(make(rows)).collect()}
    assert kept >= {t for _, t in own} and len(found) <= 61


def test_samples_take_one_text_of_a_shared_id(spark, make):
    rows = [(5, f"the words of row {i} are these and those") for i in range(300)] + [(i, "der die das und ist") for i in range(1000, 1100)]
    model = langid.fit(make(rows), n=50)
    assert model.languages == ("en",)
    labels = spark.createDataFrame([(5, 1), (5, 1), *[(i, 0) for i in range(1000, 1100)]], "doc_id long, toxic int")
    net = toxicity.fit(make(rows), labels)
    one = {w for w in net.vocabulary}
    assert b"die" in one and not any(str(i).encode() in one for i in range(300))


_REGEX = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;")


def test_markup_goes_as_by_one_pattern():
    rng = random.Random(2)
    parts = [b"<", b">", b"<!--", b"-->", b"<script", b"</script >", b"<STYLE a>", b"</style>", b"&amp;", b"&", b";", b"a", b" ", b"<p>",
             b"</Script>", b"<scripty>", b"-", b"!"]
    for _ in range(20_000):
        html = b"".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert langid.without_markup(html) == _REGEX.sub(b" ", html), html


@pytest.mark.parametrize("part", [b"<!--", b"<script", b"<style>", b"<", b"&a", b"<script></script ", b"<a ", b"-->", b"<!-- -->"])
def test_a_megabyte_of_markup_without_an_end(part):
    began = time.process_time()
    langid.without_markup(part * (1_000_000 // len(part)))
    assert time.process_time() - began < 2


@pytest.mark.parametrize("text", ["." * 1_000_000 + "a", "\n" * 1_000_000, "!?. " * 250_000, "\n-" * 500_000, "a. " * 300_000])
def test_a_megabyte_of_marks(spark, make, text):
    docs = make([(1, text), (2, "Licensed under the MIT License... Or so")]).select("doc_id", "text").cache()
    docs.count()
    began = time.time()
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert time.time() - began < 60 and rows[1].n_licenses == 0


def test_sentences_end_at_any_run_of_marks(spark, make):
    first = licenses.SENTENCES[0][1]
    rows = [(i, f"{first}{marks}Other words") for i, marks in enumerate(["... ", ".\n", "?!\n\n", ". . ", "...\n---\n"])]
    found = licenses.known_sentences(make(rows)).select(F.size("identifiers").alias("n")).collect()
    assert [r.n for r in found] == [1] * len(rows)


def test_a_megabyte_of_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", "<html " * 150_000), (2, None, "<!--" * 250_000)], "page_id long, url string, html string")
    docs = spark.createDataFrame([(i, "the and of in that", "en") for i in range(20)], "doc_id long, text string, lang string")
    began = time.time()
    assert langid.identify_pages(pages, langid.fit(docs)).count() == 2 and time.time() - began < 60
