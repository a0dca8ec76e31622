"""D2 near-duplicate pass: expected results written out for planted near copies."""

import difflib
import json
import random

import pytest

from vigil.operators import neardup as nd

# The pattern of such a finding is "processes:low:|||" + command + "|": 38 characters for a command of 20.
BASE = "abcdefghijklmnopqrst"


def frame(spark, commands):
    """commands: (id, risk, command), in input order; no command: told apart by title."""
    rows = [(i, n, "processes", "low", f"title {i}", "d", risk, json.dumps({"command": c} if c else {}))
            for n, (i, risk, c) in enumerate(commands)]
    return spark.createDataFrame(rows, "id string, ord long, category string, severity string, title string, "
                                       "description string, risk_score double, metadata string")


def kept(spark, commands, t):
    return {r["id"] for r in nd.dedup_near(frame(spark, commands), t).collect()}


def changed(*places):
    """BASE with other letters at some places; each costs 1/38 of the ratio."""
    return "".join("XYZUVW"[places.index(i)] if i in places else c for i, c in enumerate(BASE))


def test_one_changed_letter_is_a_copy_two_are_not(spark):
    rows = [("a", 10.0, BASE), ("b", 90.0, changed(3)), ("c", 50.0, changed(3, 12)), ("d", 40.0, BASE)]
    # b comes first; c and a are one letter from b; d equals a
    assert kept(spark, rows, 0.95) == {"b"}
    # two letters are 36/38 = 0.947
    assert kept(spark, [("a", 10.0, BASE), ("c", 50.0, changed(3, 12))], 0.95) == {"a", "c"}
    assert kept(spark, [("a", 10.0, BASE), ("c", 50.0, changed(3, 12))], 0.94) == {"c"}


def test_a_dropped_finding_drops_nothing(spark):
    """A chain by falling risk: each is one letter from the one before. Every second one stays."""
    rows = [(f"n{i}", 90.0 - i, changed(*range(0, 3 * i, 3))) for i in range(6)]
    assert kept(spark, rows, 0.95) == {"n0", "n2", "n4"}


def test_input_order_decides_between_equal_risks(spark):
    assert kept(spark, [("x", 5.0, changed(1)), ("y", 5.0, BASE), ("z", 5.0, changed(9))], 0.95) == {"x", "z"}


def test_short_and_missing_commands(spark):
    rows = [("a", 9.0, "ls"), ("b", 8.0, "lt"), ("c", 7.0, "find"), ("d", 6.0, None), ("e", 5.0, "ls")]
    # "processes:low:|||ls|" has 20 characters: one letter is 0.95
    assert kept(spark, rows, 0.95) == {"a", "c", "d"}
    assert kept(spark, rows, 0.96) == {"a", "b", "c", "d"}


@pytest.mark.parametrize("copies", [40])
def test_many_copies_of_many_sources(spark, copies):
    rnd, rows = random.Random(5), []
    for s in range(6):
        source = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(60))
        rows.append((f"s{s}", 100.0, source))
        for k in range(copies):
            at = rnd.randrange(60)
            rows.append((f"s{s}c{k}", 50.0, source[:at] + "#" + source[at + 1:]))
    rnd.shuffle(rows)
    assert kept(spark, rows, 0.95) == {f"s{s}" for s in range(6)}


def test_min_overlap_is_a_lower_bound():
    rnd = random.Random(3)
    alphabet = "abc|:/"
    for _ in range(300):
        a = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(3, 40)))
        b = list(a)
        for _ in range(rnd.randint(0, 2)):
            if b and rnd.random() < 0.5:
                del b[rnd.randrange(len(b))]
            else:
                b.insert(rnd.randrange(len(b) + 1), rnd.choice(alphabet))
        b = "".join(b)
        for x, y in ((a, b), (b, a)):
            if difflib.SequenceMatcher(None, x, y).ratio() >= 0.9 and len(x) >= nd.Q and len(y) >= nd.Q:
                def grams(s):
                    out, seen = set(), {}
                    for i in range(len(s) - nd.Q + 1):
                        g = s[i:i + nd.Q]
                        seen[g] = seen.get(g, 0) + 1
                        out.add((g, seen[g]))
                    return out
                shared = len(grams(x) & grams(y))
                assert shared >= min(nd.min_overlap(len(x), 0.9), nd.min_overlap(len(y), 0.9))


def brute(commands, t):
    """The greedy scan over all pairs."""
    seen = []
    for i, _, c in sorted(commands, key=lambda x: -x[1]):
        p = f"processes:low:|||{c}|"
        if not any(difflib.SequenceMatcher(None, p, q).ratio() >= t for _, q in seen):
            seen.append((i, p))
    return {i for i, _ in seen}


@pytest.mark.parametrize("t", [0.95, 0.9])
def test_crowded_digests_are_paired_by_what_is_left_of_them(spark, monkeypatch, t):
    """digests of a class share no rare q-gram; with other patterns around them no pair is lost."""
    monkeypatch.setattr(nd, "CROWD", 8)
    rnd = random.Random(11)
    digests = ["".join(rnd.choice("0123456789abcdef") for _ in range(9)) for _ in range(25)]
    near = []
    for d in digests:
        at = rnd.randrange(9)
        near += [d[:at] + "e" + d[at + 1:], d[:at] + d[at + 1:] + "7", d[1:] + "x"]
    rows = [(f"n{k}", float(1000 - k), c) for k, c in enumerate(dict.fromkeys(digests + near + ["zz-" + x for x in digests[:3]]))]
    rnd.shuffle(rows)
    assert kept(spark, rows, t) == brute(rows, t)


def test_crowded_digests_make_few_candidates(spark, monkeypatch):
    monkeypatch.setattr(nd, "_gram_pairs", None)  # no row is left for the join on q-grams
    rows = spark.range(2000).select(nd.F.concat(nd.F.lit("low:||||:"), nd.F.md5(nd.F.col("id").cast("string")).substr(1, 12)).alias("pattern"),
                                    nd.F.struct(nd.F.col("id")).alias("rk"), nd.F.col("id").alias("rid"))
    assert nd.similar_pairs(rows, 0.95).count() == 0


def test_unmatched_characters_of_skeletons():
    assert nd._unmatched("hgh", "low") == 6 and nd._unmatched("ino", "low") == 4
    assert nd._unmatched("", "ab") == 2 and nd._unmatched("sui:low", "sui:low") == 0
