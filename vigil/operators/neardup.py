"""D2 near-duplicate pass: greedy dedup by ``difflib.SequenceMatcher(new, seen).ratio() >= t``.

The greedy scan (risk descending, stable) keeps a finding unless its P21
pattern is similar to an already *kept* pattern. That is the
lexicographically-first maximal independent set of the similarity graph
under the rank order. It is computed exactly, without comparing all pairs:

1. exact collapse: one representative per distinct pattern (best rank);
2. candidate pairs by a q-gram prefix-filter similarity join (Vernica et al.,
   SIGMOD 2010): with ``M`` matched characters in ``K`` blocks, two strings
   share at least ``M - (q-1)K`` q-grams, and ratio >= t bounds both ``M`` and
   ``K``; each string's required overlap ``tau`` is the minimum over every
   admissible partner length, so the prefix of its ``|Q| - tau + 1`` rarest
   q-grams must meet the partner's prefix (no pair above the threshold is
   lost). Strings too short for a q-gram guarantee join on their length band
   instead;
   Patterns that differ only in hexadecimal characters (digests) share no rare q-gram, so those of a crowded skeleton
   (what is left without ``[0-9a-f]``) are paired otherwise: within M matched characters, a hexadecimal part loses at most
   ``L - M``, so two of one skeleton agree in one of their parts with so many characters taken out;
3. verification with the stdlib matcher, argument order (later, earlier), in
   Arrow batches (``mapInPandas``) over the candidate pairs only;
4. greedy resolution in rounds: a pattern with no undecided better-ranked
   neighbour is kept, its worse-ranked neighbours are dropped; each round's
   state is checkpointed to the shared checkpoint folder.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions import fixed
from vigil.operators import dedup as dd
from vigil.session import ensure_checkpoint_dir
from vigil.sources.sinks import written

Q = 3
CROWD = 256  # rows of one skeleton and length from which on digests are paired by what is left of them
MAX_PARTS = 500  # shortened digests of one pattern at most; longer digests go by q-grams
SHORT = 16  # strings below this length (or without a q-gram guarantee) also join by length


def admissible_lengths(la: int, t: float) -> tuple[int, int]:
    if la == 0:
        return 0, 0
    return math.ceil(la * t / (2 - t) - 1e-9), math.floor(la * (2 - t) / t + 1e-9)


def min_overlap(la: int, t: float, q: int = Q) -> int:
    """Smallest guaranteed shared q-gram count over all admissible partner lengths (may be <= 0)."""
    lo, hi = admissible_lengths(la, t)
    best = None
    for lb in range(max(lo, 0), hi + 1):
        m_min = math.ceil(t * (la + lb) / 2 - 1e-9)
        if m_min > min(la, lb):
            continue
        u_max = la + lb - 2 * m_min
        tau = m_min - (q - 1) * (u_max + 1)
        best = tau if best is None else min(best, tau)
    return best if best is not None else 0


def _prefix_table(spark, max_len: int, t: float):
    rows = []
    for la in range(0, max_len + 1):
        n_grams = max(la - Q + 1, 0)
        tau = min_overlap(la, t)
        lo, hi = admissible_lengths(la, t)
        short = la < SHORT or tau <= 0 or n_grams == 0
        plen = n_grams if tau <= 0 else max(n_grams - tau + 1, 0)
        rows.append((la, plen, short, lo, hi, la - math.ceil(t * la - 1e-9)))
    return spark.createDataFrame(rows, "L int, plen int, short boolean, lo int, hi int, loss int")


def _ratio_batches(t: float):
    import difflib

    def fn(batches):
        for pdf in batches:
            r = [difflib.SequenceMatcher(None, a, b).ratio() for a, b in zip(pdf["p_new"], pdf["p_seen"])]
            out = pdf[["u", "v"]].copy()
            out["ratio"] = r
            yield out[out["ratio"] >= t]
    return fn


def _shortened(text: Column, loss: int) -> Column:
    """Every text left when ``loss`` characters are taken out of ``text``."""
    out = F.array(text)
    for _ in range(loss):
        out = F.array_distinct(F.flatten(F.transform(out, lambda x: F.transform(
            F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x)))))))
    return out


def _unmatched(a: str, b: str) -> int:
    """How many characters of both are in no longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return len(a) + len(b) - 2 * row[-1]


def _closed_classes(r: DataFrame, t: float) -> DataFrame:
    """(skeleton, L) of classes whose rows can be similar only to each other and to rows of classes that are not listed:
    crowded ones with digests of few shortened forms, and no other such class near enough."""
    h, loss = F.col("L") - F.length("skeleton"), F.col("loss")
    forms = F.when(loss == 1, h).when(loss == 2, h * (h - 1) / 2).when(loss == 3, h * (h - 1) * (h - 2) / 6)
    few = ~F.col("short") & ((loss == 0) | ((loss <= 3) & (h > loss) & (forms <= MAX_PARTS)))
    classes = (r.groupBy("skeleton", "L", "lo", "hi", "loss", "short").agg(F.count(F.lit(1)).alias("n"))
               .where((F.col("n") >= CROWD) & few).checkpoint())
    other = classes.select(F.col("skeleton").alias("s2"), F.col("L").alias("l2"))
    lost = F.col("L") + F.col("l2") - 2 * F.ceil(F.lit(t) * (F.col("L") + F.col("l2")) / 2 - F.lit(1e-9))
    near = (classes.withColumn("l2", F.explode(F.sequence("lo", "hi"))).join(other, "l2")
            .where(((F.col("skeleton") != F.col("s2")) | (F.col("L") != F.col("l2")))
                   & (F.levenshtein("skeleton", "s2") <= lost)).where(F.udf(_unmatched, "int")("skeleton", "s2") <= lost))
    return (classes.select("skeleton", "L").join(near.select("skeleton", "L").distinct(), ["skeleton", "L"], "left_anti")
            .withColumn("closed", F.lit(True)))


def _digest_pairs(closed: DataFrame) -> DataFrame:
    """(x, y) of one closed class that may be similar: their digests, shortened, agree."""
    keys = None
    for loss in (1, 2, 3):
        own = closed.where(F.col("loss") == loss).select(
            "rid", "skeleton", F.explode(_shortened(F.regexp_replace("pattern", "[^0-9a-f]", ""), loss)).alias("part"))
        keys = own if keys is None else keys.unionByName(own)
    keys = keys.select("rid", F.xxhash64("skeleton", "part").alias("key"))
    return (keys.alias("a").join(keys.alias("b"), F.col("a.key") == F.col("b.key")).where(F.col("a.rid") < F.col("b.rid"))
            .select(F.col("a.rid").alias("x"), F.col("b.rid").alias("y")).distinct())


def _gram_pairs(r: DataFrame) -> DataFrame:
    """(x, y) that may be similar, at least one of them of no closed class: the q-gram prefix join."""
    grams = (r.select("rid", "L", "plen", F.posexplode(F.expr(f"transform(sequence(1, greatest(L - {Q} + 1, 0)), "
                                                           f"i -> substring(pattern, i, {Q}))")).alias("pos", "g"))
             .where(F.col("L") >= Q))
    occ = F.row_number().over(Window.partitionBy("rid", "g").orderBy("pos"))
    tokens = grams.withColumn("occ", occ).select("rid", "L", "plen", F.concat_ws("#", "g", "occ").alias("tok"))
    freq = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("f"))
    ranked = tokens.join(freq, "tok").withColumn(
        "k", F.row_number().over(Window.partitionBy("rid").orderBy("f", "tok")))
    prefix = ranked.where(F.col("k") <= F.col("plen")).select("rid", "tok")
    # short strings (none is closed): join by length band (each emits its admissible partner lengths; everyone short-ish emits own)
    own_len = r.select("rid", F.concat(F.lit("#L"), F.col("L").cast("string")).alias("tok"))
    short_probe = (r.where(F.col("short"))
                   .select("rid", F.explode(F.sequence(F.col("lo"), F.col("hi"))).alias("lb"))
                   .select("rid", F.concat(F.lit("#L"), F.col("lb").cast("string")).alias("tok")))
    short_max = r.where(F.col("short")).agg(F.max("hi")).first()[0]
    keys_a = prefix.unionByName(short_probe).join(r.where("not closed").select("rid"), "rid", "left_semi")
    keys_b = prefix.unionByName(own_len.where(F.col("L") <= F.lit(short_max if short_max is not None else -1)))
    return (keys_a.alias("a").join(keys_b.alias("b"), F.col("a.tok") == F.col("b.tok"))
            .where(F.col("a.rid") != F.col("b.rid"))
            .select(F.least("a.rid", "b.rid").alias("x"), F.greatest("a.rid", "b.rid").alias("y")).distinct())


def similar_pairs(reps: DataFrame, t: float) -> DataFrame:
    """(u, v, ratio): u ranked before v and ratio(pattern_v, pattern_u) >= t. ``reps``: rid, pattern, rk."""
    spark = reps.sparkSession
    max_len = reps.agg(F.max(F.length("pattern"))).first()[0] or 0
    table = F.broadcast(_prefix_table(spark, max_len, t))  # one row per possible length: bounded by max_len
    r = (reps.withColumn("L", F.length("pattern")).join(table, "L")
         .withColumn("skeleton", F.translate("pattern", "0123456789abcdef", "")))
    r = r.join(_closed_classes(r, t), ["skeleton", "L"], "left").withColumn("closed", F.coalesce("closed", F.lit(False)))
    cand = _digest_pairs(r.where("closed"))
    if not r.where("not closed").isEmpty():
        cand = cand.unionByName(_gram_pairs(r)).distinct()
    info = r.select("rid", "pattern", "rk", "L")
    pairs = (cand.join(info.select(F.col("rid").alias("x"), F.col("pattern").alias("px"), F.col("rk").alias("rx"),
                                   F.col("L").alias("lx")), "x")
             .join(info.select(F.col("rid").alias("y"), F.col("pattern").alias("py"), F.col("rk").alias("ry"),
                               F.col("L").alias("ly")), "y"))
    # length filter, then orient: u ranked first ("seen"), v later ("new")
    ok_len = (2.0 * F.least("lx", "ly") / (F.col("lx") + F.col("ly"))) >= F.lit(t) - F.lit(1e-12)
    oriented = pairs.where(ok_len).select(
        F.when(F.col("rx") < F.col("ry"), F.col("x")).otherwise(F.col("y")).alias("u"),
        F.when(F.col("rx") < F.col("ry"), F.col("y")).otherwise(F.col("x")).alias("v"),
        F.when(F.col("rx") < F.col("ry"), F.col("py")).otherwise(F.col("px")).alias("p_new"),
        F.when(F.col("rx") < F.col("ry"), F.col("px")).otherwise(F.col("py")).alias("p_seen"))
    return oriented.mapInPandas(_ratio_batches(t), "u long, v long, ratio double")


def greedy_keep(reps: DataFrame, edges: DataFrame) -> DataFrame:
    """Lexicographically-first maximal independent set under ``rk``.

    Rounds, each checkpointed, until no pattern is undecided; every round decides at least the best-ranked one.
    """
    ensure_checkpoint_dir(reps.sparkSession)
    e = edges.select("u", "v").checkpoint()
    # a pattern without a similar one is kept: rounds are for the others only
    state = (e.select(F.explode(F.array("u", "v")).alias("rid")).distinct().select("rid", F.lit("u").alias("st")).checkpoint())
    while not (und := state.where(F.col("st") == "u").select("rid")).isEmpty():
        # undecided v with an undecided better-ranked neighbour u is not ready
        blocked = (e.join(und.withColumnRenamed("rid", "u"), "u").join(und.withColumnRenamed("rid", "v"), "v")
                   .select(F.col("v").alias("rid")).distinct())
        ready = und.join(blocked, "rid", "left_anti")
        # ready nodes are kept; undecided nodes adjacent (as the later one) to a newly kept node are dropped
        dropped = (e.join(ready.withColumnRenamed("rid", "u"), "u").select(F.col("v").alias("rid")).distinct()
                   .join(und, "rid"))
        new_state = (state.join(ready.withColumn("k", F.lit(1)), "rid", "left")
                     .join(dropped.withColumn("d", F.lit(1)), "rid", "left")
                     .select("rid", F.when(F.col("k") == 1, "k").when(F.col("d") == 1, "d")
                             .otherwise(F.col("st")).alias("st")))
        state = new_state.checkpoint()
    return reps.select("rid").join(state.where(F.col("st") == "d"), "rid", "left_anti")


def dedup_near(findings: DataFrame, threshold: float = fixed.DEDUP_THRESHOLD) -> DataFrame:
    """D2 (exact + near): the findings the greedy scan keeps."""
    ensure_checkpoint_dir(findings.sparkSession)
    firsts = written(dd.dedup_exact_patterns(findings).withColumn("_rid", F.monotonically_increasing_id()), "first-patterns")
    # rank key of each distinct pattern's representative: (risk desc, input order)
    rank = F.struct((-F.coalesce(F.col("risk_score").cast("double"), F.lit(0.0))).alias("r"), F.col("ord"))
    reps = firsts.select("pattern", rank.alias("rk"), F.col("_rid").alias("rid"))
    kept = greedy_keep(reps, similar_pairs(reps, threshold))
    return firsts.join(kept.withColumnRenamed("rid", "_rid"), "_rid", "left_semi").drop("_rid")
