import random
import re

import xxhash
from pyspark.sql import functions as F

from llm_cases import ODD
from vigil.llm import components, simhash


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius=3):
    """rows of (id, print) -> id -> smallest id reachable"""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    low = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(prints))]


def check(rows, found):
    prints = [(d, brute_print(t)) for d, t in rows]
    expected = sorted((str(d), f"{p:016x}", str(c)) for (d, p), c in zip(prints, brute_components(prints), strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found.collect()) == expected


def test_documents_against_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, simhash.near_duplicates(docs))


def test_odd_rows(make):
    check(ODD, simhash.near_duplicates(make(ODD).withColumn("fingerprint", F.lit("clash"))))


def test_empty_table(make):
    assert simhash.near_duplicates(make([])).count() == 0


def test_links_of_chains_and_small_tiles(spark):
    """Chains of prints 3 bits apart, in tiles of four rows, so that tiles are split and joined again."""
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:12]:
        for _ in range(25):
            for b in rng.sample(range(64), rng.randint(1, 3)):
                p ^= 1 << b
            prints.add(p)
    rows = list(enumerate(sorted(prints)))
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in rows], "fingerprint long, rep long")
    found = dict(components.components(simhash.links(df, 3, tile=4)).collect())
    assert [found.get(i, i) for i, _ in rows] == brute_components(rows)


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)],
                                  "a long, b long")
    assert dict(components.components(edges).collect()) == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_keep_one(make):
    rows = [(9, "one two three four"), (3, "one two three four"), (5, "else what is there"), (None, "no id"), (None, "no id")]
    kept = simhash.keep_one(make(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "5", "None", "None"]
