import hashlib
import re

from pyspark.sql import functions as F

from llm_cases import ODD, SF
from vigil.llm import decontam


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes, out = {len(x) for x in windows}, []
    for d, text in docs:
        w, hit, met = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[i:i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    met |= found - {None}
        ids = ",".join(sorted(map(str, met)))
        out.append((str(d), len(w), len(hit), len(met), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out)


def rows(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def test_documents_against_brute_force(spark, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert any(x[5] for x in expected)
    assert rows(decontam.contamination(docs, items)) == expected


def test_odd_documents_and_items(spark, make):
    a = " ".join(f"w{i}" for i in range(30))
    planted = [(20, f"x y {' '.join(a.split()[4:14])} z"), (21, " ".join(a.split()[4:13])), (22, a.upper() + " É " + a),
               (23, "Same, TEXT: here!"), (24, "École"), (25, "école"), (26, "same text here")]
    items = [(1, a), (2, "same text here"), (3, ""), (None, a), (4, None), (10, a), (5, "école"), (6, "word " * 40), (6, "word " * 40)]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = rows(decontam.contamination(make(ODD + planted).withColumn("item_id", F.lit(3)), table))
    assert found == brute(ODD + planted, items)


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(decontam.contamination(make(ODD), none)) == brute(ODD, [])
    assert decontam.contamination(make([]), none).count() == 0


def test_winnowing_keeps_a_hash_of_every_shared_span(spark):
    """With the smallest span that can be asked for, single shared windows are found wherever they stand."""
    text = [f"t{i * 37 % 101}" for i in range(80)]
    docs = [(i, " ".join(["q"] * (i % 5) + text[i:i + 10] + ["r"])) for i in range(70)]
    items = [(1, " ".join(text))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontam.contamination(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert rows(found) == brute(docs, items)


def test_no_python_in_the_plan(docs, spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    plan = decontam.contamination(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_keep_clean(spark, make):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    kept = decontam.keep_clean(make([(1, "x a b c d e f g h i j"), (2, "a b c d e f g h i"), (None, None), (3, "z"), (3, "z")]), items)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "3", "None"]
