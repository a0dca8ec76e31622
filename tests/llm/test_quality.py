import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

from vigil.llm import quality

SPACE = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    w = re.findall(SPACE, text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(SPACE, line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text)) if w else 0
    return len(w), sum(map(len, w)), symbols, dup, len(covered)


def rows(found):
    return sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in found)


def expected(pairs):
    out = []
    for d, t in pairs:
        b = brute(t)
        out.append((str(d), *b, b[0] < 50 or 100 * b[4] > 50 * b[0]))
    return sorted(out)


@pytest.fixture(scope="module")
def found(docs, labels):
    return quality.quality(docs, labels).collect()


def test_counts_against_brute_force(docs, found):
    assert rows(found) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_verdicts_follow_the_labels(labels, found):
    label = {r.doc_id: r.quality for r in labels.collect()}
    by = {y: [r.kept for r in found if label.get(r.doc_id) == y and not r.base_failed] for y in (0, 1)}
    assert np.mean(by[1]) >= 0.95
    assert not by[0] or np.mean(by[0]) <= 0.2
    assert not any(r.kept for r in found if r.base_failed)


def test_odd_rows(make, labels):
    texts = [*ODD, (8, "a b c a b c \n x\n x\nx"), (9, "é € #*$%&|<> É"), (10, " x y\x1cz a b"), (11, "a a a a")]
    got = quality.quality(make(texts).withColumn("score", F.lit(2)).withColumn("n_words", F.lit(2)), labels)
    assert rows(got.collect()) == expected(texts)


def test_empty_tables_and_no_labels(make, labels):
    assert quality.quality(make([]), labels).count() == 0
    text = " ".join(f"w{i}" for i in range(60))
    got = quality.quality(make([(1, text), (2, text + " x"), (3, "short")]), labels.limit(0)).collect()
    assert {r.doc_id: r.kept for r in got} == {1: True, 2: True, 3: False}


def test_forest_isolates_outliers():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (2000, 4)).astype(np.float32)
    forest = quality.grow(x)
    far = np.full((1, 4), 8, np.float32)
    assert forest.scores(far)[0] > np.quantile(forest.scores(x), 0.99)
    path = forest.path[~np.isnan(forest.path)]
    assert path.min() >= 1


def test_path_of_one_tree_by_hand():
    forest = quality.Forest(np.array([[0, 0, 0]]), np.array([[0.5, 0, 0]], np.float32),
                            np.array([[np.nan, 1.0, 3.0]]), 2.0)
    assert forest.scores(np.array([[0.0], [0.5]], np.float32)).tolist() == [2 ** -0.5, 2 ** -1.5]
