import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import ODD
from pyspark.sql import functions as F

from vigil.llm import langid, ppm


class Trie:
    """PPM by the book: dictionaries, one symbol at a time, escape method D, exclusion."""

    def __init__(self, order):
        self.order, self.counts = order, defaultdict(Counter)

    def places(self, word):
        text = b" " * self.order + word + (b"" if word == b"\n" else b" ")
        return [(text[i - self.order:i], text[i]) for i in range(self.order, len(text))]

    def learn(self, word, n):
        for context, symbol in self.places(word):
            for j in range(self.order + 1):
                self.counts[context[self.order - j:]][symbol] += n

    def cost(self, word):
        return sum(self.symbol(c, s) for c, s in self.places(word))

    def symbol(self, context, symbol):
        out, excluded = 0.0, set()
        for j in range(self.order, -1, -1):
            seen = {s: n for s, n in self.counts.get(context[self.order - j:], {}).items() if n and s not in excluded}
            total = 2 * sum(seen.values())
            if symbol in seen:
                return out + math.log10((2 * seen[symbol] - 1) / total)
            if seen:
                out += math.log10(len(seen) / total)
                excluded |= seen.keys()
        return out - math.log10(256 - len(excluded))


def evidence(model, words):
    """Of a text's words: log probabilities of the byte trigrams of each, a space at both ends."""
    out = np.zeros(model.log.shape[1])
    for w in words:
        letters = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in b" " + w + b" ")
        for i in range(len(w)):
            code = int.from_bytes(letters[i:i + 3], "big") * 2654435761 % 2**32 >> 16
            out += model.log[code].astype(float)
    return out


def brute(rows, model, held, order=ppm.ORDER):
    classes = model.log.shape[1]
    prior = np.log(langid.prior(classes))
    docs = [(d, (t or "").encode().lower().split()) for d, t in rows]
    docs = [(d, int((evidence(model, w) + prior).argmax()), w + [b"\n"]) for d, w in docs]
    by_class, base = [Counter() for _ in range(classes)], Counter()
    for d, c, words in docs:
        if not held(d):
            by_class[c].update(words)
            base.update(words)
    tries = []
    for counts in by_class:
        tries.append(Trie(order))
        for w, n in counts.items():
            tries[-1].learn(w, n)
    n, v = sum(base.values()), len(base | Counter({b"\n": 0}) | Counter([b"\n"])) if base else 1
    ends = np.array([c[b"\n"] for c in by_class])
    out = []
    for d, c, words in docs:
        out.append((str(d), held(d), len(words), sum(w in base for w in words), n,
                    sum(math.log10((base[w] + 1) / (n + v + 1)) for w in words),
                    sum(tries[c].cost(w) for w in words) + math.log10((ends[c] + 1) / (ends.sum() + classes))))
    return sorted(out, key=str)


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


def same(found, expected):
    got = sorted(map(tuple, found.withColumn("doc_id", F.col("doc_id").cast("string")).fillna("None", ["doc_id"]).collect()), key=str)
    assert len(got) == len(expected)
    for a, b in zip(got, expected, strict=True):
        assert a[:5] == b[:5]
        assert np.allclose(a[5:6], b[5:6], rtol=1e-9) and np.allclose(a[6:], b[6:], rtol=1e-6)  # scores travel as floats


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs.where(~ppm.held_out()))


def test_documents_against_brute_force(docs, model):
    some = docs.where("n_chars < 1500").cache()  # the dictionaries of the brute force are slow
    found = ppm.score(some, ppm.held_out(), model=model)
    same(found, brute([(r.doc_id, r.text) for r in some.collect()], model, held))


def test_small_chunks(docs, model, monkeypatch):
    """Many chunks of texts and of words give the same scores."""
    some = docs.where("n_chars < 700").cache()
    a = {r.doc_id: r.score for r in ppm.score(some, ppm.held_out(), model=model).collect()}
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(ppm, "CHUNK_WORDS", 50)
    b = {r.doc_id: r.score for r in ppm.score(some, ppm.held_out(), model=model).collect()}
    assert a.keys() == b.keys() and np.allclose([a[k] for k in a], [b[k] for k in a], rtol=1e-6)


def test_odd_rows(make, model):
    same(ppm.score(make(ODD).withColumn("score", F.lit(1)).withColumn("chunk", F.lit(1)), ppm.held_out(), model=model),
         brute(ODD, model, held))
    assert ppm.score(make([]), ppm.held_out(), model=model).count() == 0


def test_nothing_to_learn_from(make, model):
    got = ppm.score(make([(1, "a b"), (2, None)]), F.lit(True), model=model).collect()
    assert {r.train_tokens for r in got} == {0} and all(r.n_known == 0 and np.isfinite(r.score) for r in got)


def test_probabilities_sum_to_one():
    """Over all 256 symbols after a context, known or not."""
    order, words = 3, [b"abab", b"abc", b"b", b"caba"]
    counts = [5, 2, 1, 3]
    code, size = ppm.events(words, np.zeros(4, np.int64), order)
    for context in (b"  a", b"xab", b"zzz", b" ab"):
        every = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        event, at = np.unique(np.concatenate([code, every]), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([np.repeat(counts, size), np.zeros(256)])).astype(np.int64)
        low = np.zeros((1, 256, 256), np.int64)
        for e, c in zip(event.tolist(), n.tolist(), strict=True):
            low[0, e >> 8 & 255, e & 255] += c
        p = ppm.log_probabilities(event, n, low, order)
        assert math.isclose((10 ** p[np.searchsorted(event, every)]).sum(), 1, rel_tol=1e-9)


def test_contexts_over_the_text(make, model):
    """With ``across``: the same dictionaries over whole texts, word order counts, and blocks do not matter."""
    import random
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nus", "terra") for b in ("n", "ra", "x", "vel", "")]
    rng = random.Random(5)
    phrase = " ".join(words[:12])
    rows = [(i, f"{phrase} {' '.join(rng.choices(words, k=6))}") for i in range(1, 60) if not held(i)]
    other = sorted(words[:12], key=lambda w: w[::-1])
    rows += [(i, t) for i, t in zip([i for i in range(100, 200) if held(i)], [phrase, " ".join(other)], strict=False)] + ODD
    found = {(str(r.doc_id), r.n_tokens): r for r in ppm.score(make(rows), ppm.held_out(), model=model, across=True).collect()}
    classes = model.log.shape[1]
    prior = np.log(langid.prior(classes))
    texts, tries, ends = [], [Trie(ppm.ORDER) for _ in range(classes)], np.zeros(classes)

    def places(self, text):
        text = b" " * self.order + text
        return [(text[i - self.order:i], text[i]) for i in range(self.order, len(text))]

    for t in tries:
        t.places = places.__get__(t)
    for d, t in rows:
        w = (t or "").encode().lower().split()
        c = int((evidence(model, w) + prior).argmax())
        texts.append((str(d), len(w) + 1, c, b"".join(x + b" " for x in w) + b"\n"))
        if not held(d):
            tries[c].learn(texts[-1][3], 1)
            ends[c] += 1
    for d, n, c, text in texts:
        if n < 10_000:
            assert math.isclose(found[d, n].score, tries[c].cost(text) + math.log10((ends[c] + 1) / (ends.sum() + classes)), rel_tol=1e-5)
    ordered, shuffled = (r for r in found.values() if r.held_out and r.n_tokens == 13)
    assert ordered.base_score == pytest.approx(shuffled.base_score)
    assert abs(ordered.score - shuffled.score) > 5


def test_small_blocks_over_the_text(docs, model, monkeypatch):
    some = docs.where("n_chars < 700").cache()
    a = {r.doc_id: r.score for r in ppm.score(some, ppm.held_out(), model=model, across=True).collect()}
    for name, n in (("CHUNK_BYTES", 2000), ("CHUNK_WORDS", 50), ("BLOCK", 300)):
        monkeypatch.setattr(ppm, name, n)
    b = {r.doc_id: r.score for r in ppm.score(some, ppm.held_out(), model=model, across=True).collect()}
    assert a.keys() == b.keys() and np.allclose([a[k] for k in a], [b[k] for k in a], rtol=1e-6)
