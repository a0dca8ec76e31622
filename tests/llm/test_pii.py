import hashlib
import itertools
import math
import random
import re
import time

import pytest
from llm_cases import ODD, SF

from vigil.llm import pii
from vigil.llm.queries import QUERIES


def digits(s):
    return re.sub("[^0-9]", "", s)


def valid_card(s):
    d = [int(c) for c in digits(s)][::-1]
    return 13 <= len(d) <= 19 and sum(d[0::2] + [sum(divmod(2 * v, 10)) for v in d[1::2]]) % 10 == 0


#: The patterns as the contract writes them, run by the library's matcher.
PLAIN = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
         (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
         (r"[0-9]([\x20-]?[0-9])+", valid_card),
         (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)]


def plain(text):
    return [(k, *m.span()) for k, (p, ok) in enumerate(PLAIN) for m in re.finditer(p, text) if ok(m.group())]


def test_base_spans_against_the_patterns():
    rng = random.Random(4)
    for alphabet in ("a1@.", "12.@+ -", "0159 -", "+1 ().-9", "ab.@-_%+1 é", "4 5-3+@.ü"):
        for _ in range(4000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert pii.base_spans(text) == plain(text), text
    some = "Ü 4111 1111-1111 1111 x 4111111111111112, +1 (017) 555-7713. 10.0.0.255 10.0.0.256 1.2.3.4.5.6.7.8 a.b@c.d-e.f@g.h"
    assert pii.base_spans(some) == plain(some) and len(plain(some)) == 5


def segmentations(n, found):
    """All sets of segments that do not overlap, by borders."""
    if n == 0:
        return [[]]
    out = [[*rest] for rest in segmentations(n - 1, found)]
    for i, j, sig in found:
        if j == n:
            out += [[*rest, (k, i, j, sig)] for rest in segmentations(i, found) for k in range(len(pii.KINDS))]
    return out


def value(model, segments, margin=0.0):
    total, none = 0.0, len(pii.KINDS)
    for n, (k, i, _, sig) in enumerate(segments):
        before = segments[n - 1][0] if n and segments[n - 1][2] == i else none
        total += model.scores(sig)[k] + model.after[k][before] - margin
    return total


@pytest.fixture(scope="module")
def model():
    return pii.train(pii.generated())


def test_the_dynamic_programme_against_all_segmentations():
    rng = random.Random(8)
    for text in ("1234 567", "(017) 555-7713", "12.34.56.78", "123 4567-89", "a [at] b.c"):
        (a, b), = pii.regions(text)
        edges, found = pii.candidates(text, a, b)
        assert found
        for _ in range(6):
            m = pii.Model({(k, f): rng.uniform(-2, 3) for _, _, s in found for f in pii.features(s) for k in range(4)},
                          [[rng.uniform(-2, 2) for _ in range(5)] for _ in range(4)])
            every = segmentations(len(edges) - 1, found)
            top = max(value(m, s, pii.MARGIN) for s in every)
            best = m.best(text, a, b)
            at = {e: i for i, e in enumerate(edges)}
            sigs = {(i, j): s for i, j, s in found}
            mine = [(k, at[x], at[y], sigs[at[x], at[y]]) for k, x, y in best]
            assert value(m, mine, pii.MARGIN) == pytest.approx(top)
            gold = [(k, edges[i], edges[j]) for k, i, j, _ in every[-1]]
            total = math.log(math.fsum(math.exp(value(m, s)) for s in every))
            likelihood, grad, moved = pii.gradient(m, text, a, b, gold)
            assert likelihood == pytest.approx(value(m, every[-1]) - total)
            key = max(grad, key=lambda key: abs(grad[key]))
            for step, slope in ((lambda d: m.weights.__setitem__(key, m.weights[key] + d), grad[key]),
                                (lambda d: m.after[1].__setitem__(4, m.after[1][4] + d), moved[1][4])):
                step(1e-5), m.known.clear()
                more = pii.gradient(m, text, a, b, gold)[0]
                step(-1e-5), m.known.clear()
                assert (more - likelihood) / 1e-5 == pytest.approx(slope, abs=1e-3)


def test_held_out_forms(model):
    held = pii.generated(60, seed=99)
    assert sum(model.best(t, a, b) == g for t, a, b, g in held) >= 0.93 * len(held)
    invented = sum(not g and bool(model.best(t, a, b)) for t, a, b, g in held)
    assert invented <= 0.01 * len(held)


def test_spans_of_either_side_of_a_failed_match(model):
    text = "ids 4111111111111111 5500005555555559 end, call (017) 555-7713 or jo.doe [at] mail3 (dot) example (dot) com now"
    assert pii.base_spans(text) == []
    found = {(pii.KINDS[k], text[a:b]) for k, a, b in pii.added(model, text, [])}
    assert found == {("card", "4111111111111111"), ("card", "5500005555555559"), ("phone", "(017) 555-7713"),
                     ("email", "jo.doe [at] mail3 (dot) example (dot) com")}
    clean = "On 2024-01-15 at 10.30 the 23904 of 1.2.3 cost 1,299.00; room 555-0199, item 4111111111111112. 300.1.2.3"
    assert pii.added(model, clean, pii.base_spans(clean)) == []


def test_base_spans_stay_and_added_ones_lie_outside(model):
    text = "+1 (017) 555-7713 4111111111111111 (018) 555-7714 10.1.2.3"
    base = pii.base_spans(text)
    more = pii.added(model, text, base)
    assert all(y <= a or b <= x for _, a, b in more for _, x, y in base)
    assert (3, text.index("(018"), text.index("(018") + 14) in more


def test_outside_against_marks():
    rng = random.Random(3)
    for _ in range(500):
        cuts = sorted((a, a + rng.randint(1, 6)) for a in (rng.randint(0, 30) for _ in range(rng.randint(0, 4))))
        ends = sorted(rng.sample(range(40), 6))
        whole = list(itertools.batched(ends, 2))
        covered = {i for a, b in cuts for i in range(a, b)}
        got = [i for a, b in pii.outside(whole, cuts) for i in range(a, b)]
        assert got == [i for a, b in whole for i in range(a, b) if i not in covered]


def test_query(spark):
    got = QUERIES["op13_semi_markov_pii"](spark, SF)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        assert tuple(r)[1:5] == tuple(sum(k == j for k, _, _ in base) for j in range(4))
        assert r.base_sha256 == hashlib.sha256(pii.render(base).encode()).hexdigest()
        mine = [s.split(":") for s in r.spans.split(",") if s]
        every = [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in mine]
        assert every == sorted(every) and set(base) <= set(every)


def test_odd_rows_and_empty_tables(make):
    rows = pii.personal_data(make([*ODD, (9, "x@y.z " * 3000), (9, "x@y.z " * 3000)])).collect()
    assert len(rows) == len(ODD) + 2 and sum(r.n_email == 3000 for r in rows) == 2
    empty = next(r for r in rows if r.doc_id == 1)
    assert empty.spans == "" and empty.base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.personal_data(make([])).count() == 0


@pytest.mark.parametrize("part", ["a", "1", "1 ", "@a", "1.", "+1", " at a", "(", "a.", "[at]", "1-", "+", "a@b", " dot", "é"])
def test_time_grows_with_the_text(model, part):
    text = part * (200_000 // len(part))
    began = time.process_time()
    pii.added(model, text, pii.base_spans(text))
    assert time.process_time() - began < 15
