import zlib

import numpy as np
import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

from vigil.llm import bigru, toxicity


def small_model(seed=3):
    m = bigru.Model({b"bad": 1, b"good": 2}, word=3, char=3, hidden=3, attention=2, buckets=64)
    m.start(seed)
    return m


def test_gradients_against_finite_differences():
    m = small_model()
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    chunks = [b"bad", b"good", b"odd", b"x"]
    looked = m.look_up(chunks)
    index = np.array([[0, 1], [2, 3], [3, 0], [1, 1]])
    mask = np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float)
    y = np.array([1.0, 0.0])

    def loss():
        out = m.logits(bigru._inputs(m, looked, index).astype(np.float64), mask)
        return -(y * np.log(bigru.sigmoid(out)) + (1 - y) * np.log(1 - bigru.sigmoid(out))).sum()

    keep = {}
    out = m.logits(bigru._inputs(m, looked, index).astype(np.float64), mask, keep)
    g, dx = m.gradients(keep, bigru.sigmoid(out) - y)
    g |= m.input_gradients(looked, index, dx)
    rng = np.random.default_rng(0)
    for name, grad in g.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in m.p[name].shape)
            if name == "word" and at[0] == 0:
                continue
            old, step = m.p[name][at], 1e-3
            m.p[name][at] = old + step
            up = loss()
            m.p[name][at] = old - step
            down = loss()
            m.p[name][at] = old
            assert abs((up - down) / (2 * step) - grad[at]) < 2e-3 + 0.02 * abs(grad[at]), (name, at)


def test_windows_cover_every_word():
    for n in (1, 31, 32, 33, 56, 57, 100, 1000):
        at = toxicity.starts(n)
        assert {i for s in at for i in range(s, min(n, s + toxicity.WINDOW))} == set(range(n))
        assert all(b - a <= toxicity.STRIDE for a, b in zip(at, at[1:], strict=False))


def test_scores_do_not_depend_on_neighbours():
    m = small_model()
    texts = [b"", b"bad", b"good " * 50 + b"bad", b"Odd, BAD! " * 40]
    together = toxicity.Scorer(m).scores(texts)
    assert np.allclose(together, [toxicity.Scorer(m).scores([t])[0] for t in texts], atol=1e-6)
    words = (b"good " * 50 + b"bad").split()
    one = [m.logits(m.inputs(words[s:s + 32])[:, None], np.ones((32, 1), np.float32))[0] for s in toxicity.starts(51)]
    assert np.isclose(together[2], bigru.sigmoid(max(one)), atol=1e-6)


@pytest.fixture(scope="module")
def planted(make, spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(700):
        text = [words[j] for j in rng.integers(0, 300, rng.integers(5, 200))]
        toxic = int(i % 3 == 0)
        for _ in range(2 * toxic):
            text.insert(int(rng.integers(0, len(text))), ["vilea", "nastyb", "grossc"][int(rng.integers(0, 3))])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents(planted):
    docs, labels = planted
    got = toxicity.toxicity(docs, labels)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = got.collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(700) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.95
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}


def test_held_out_labels_are_never_learned(planted):
    docs, labels = planted
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                                                1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.toxicity(docs, x, rows=(60, 60)).collect())) for x in (labels, flipped))
    assert a == b


def test_odd_rows(make, planted):
    docs, labels = planted
    model = toxicity.fit(docs, labels, rows=(40, 40))
    got = toxicity.score(make(ODD).withColumn("score", F.lit(7)), model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _ in ODD)
    empty = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(make([]), model).count() == 0


def test_no_labels(make, planted):
    _, labels = planted
    got = toxicity.toxicity(make(ODD), labels.limit(0)).collect()
    assert all(r.score == 0 and r.predicted == 0 for r in got)
    assert toxicity.keep_clean(make(ODD), labels.where("toxic = 1")).count() == len(ODD)


def test_each_span_of_half_a_window_is_whole_in_one():
    span = toxicity.WINDOW // 2
    for n in (33, 48, 49, 100, 1001):
        at = toxicity.starts(n)
        assert all(any(s <= a and a + span <= s + toxicity.WINDOW for s in at) for a in range(n - span + 1))
