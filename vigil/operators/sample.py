"""Deterministic sampling, splits and quotas.

Randomness is replaced by md5 ordering of ``seed|id`` (T1), which both Spark
and DuckDB compute identically.

"The first n of each stratum in hash order" needs no sort of a stratum: counts
by leading hash digits locate the bucket in which each bound falls, twice (the
second time only over that bucket's rows). All other rows are decided by
comparing their digits with the bound's; only rows that share six digits with
a bound (one in 16 million) are ranked.

Allocations (D6, D8) are arithmetic on a table with one row per stratum; only
single numbers (totals) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.small import small_table

LEVEL = 3  # hash digits of a level: at most 4,096 buckets per stratum


def hash_key(seed: str, id_col: Column) -> Column:
    """md5 of ``seed|id``: the deterministic stand-in for random order."""
    return F.md5(F.concat(F.lit(f"{seed}|"), id_col.cast("string")))


def exact_rank(df: DataFrame, part_cols: list[str], key: Column, tie: Column, bucket: Column,
               name: str = "rank") -> DataFrame:
    """1-based rank of rows by (key, tie) inside ``part_cols``, in two levels; ``bucket`` is monotone in ``key``."""
    keyed = df.withColumn("_k", key).withColumn("_t", tie).withColumn("_b", bucket)
    counts = keyed.groupBy(*part_cols, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*part_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part_cols, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(*part_cols, "_b").orderBy("_k", "_t")
    joined = keyed.join(offsets, [*part_cols, "_b"], "inner")
    return (joined.withColumn(name, F.col("_off") + F.row_number().over(inner))
            .drop("_k", "_t", "_b", "_off"))


def _located(counts: DataFrame, bounds: DataFrame, part: str, digits: str) -> DataFrame:
    """(part, j, bound, digits, off): the bucket that each bound falls into, and the rows before it.

    ``counts``: (part, digits, n); ``bounds``: (part, j, bound), bounds counted from the start of the part.
    """
    order = Window.partitionBy(part).orderBy(digits).rowsBetween(Window.unboundedPreceding, -1)
    cum = counts.withColumn("off", F.coalesce(F.sum("n").over(order), F.lit(0)))
    return (bounds.join(cum, part).where("off < bound and bound <= off + n")
            .select(part, "j", "bound", digits, "off"))


def segments(df: DataFrame, part: str, key: Column, tie: Column, bounds: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``: how many of its part's bounds are below the row's rank by (key, tie).

    ``key``: hex digits. ``bounds``: (part, b), an array of bounds in rising order; parts without a row are dropped.
    """
    each = small_table(bounds.select(part, F.posexplode("b").alias("j", "bound")))
    keyed = df.withColumn("_k", key).withColumn("_t", tie)
    one, two = F.substring("_k", 1, LEVEL), F.substring("_k", 1, 2 * LEVEL)
    first = small_table(_located(keyed.groupBy(part, one.alias("d1")).agg(F.count(F.lit(1)).alias("n")), each, part, "d1"))
    inside = keyed.withColumn("d1", one).join(first.select(part, "d1", "off").distinct(), [part, "d1"])
    finer = inside.groupBy(part, two.alias("d2")).agg(F.count(F.lit(1)).alias("n"), F.min("off").alias("o"))
    order = Window.partitionBy(part, F.substring("d2", 1, LEVEL)).orderBy("d2").rowsBetween(Window.unboundedPreceding, -1)
    cum = finer.withColumn("off", F.col("o") + F.coalesce(F.sum("n").over(order), F.lit(0)))
    cuts = each.join(cum, part).where("off < bound and bound <= off + n").select(part, "j", "bound", "d2", "off")
    # Per part: bounds in order, with their digits; a bound at or below 0 has none and lies below every row, one at or
    # above the part's size lies above every row.
    full = each.join(cuts.select(part, "j", "d2", "off"), [part, "j"], "left")
    cut = small_table(full.groupBy(part).agg(F.sort_array(F.collect_list(
        F.struct("j", "bound", "d2", F.coalesce("off", F.lit(0)).alias("off")))).alias("_cut")))
    rows = keyed.withColumn("_d", two).join(cut, part)
    edge = F.exists("_cut", lambda c: c["d2"].eqNullSafe(F.col("_d")))
    below = F.size(F.filter("_cut", lambda c: F.when(c["d2"].isNull(), c["bound"] <= 0).otherwise(c["d2"] < F.col("_d"))))
    rank = (F.filter("_cut", lambda c: c["d2"] == F.col("_d"))[0]["off"]
            + F.row_number().over(Window.partitionBy(part, "_d").orderBy("_k", "_t")))
    ranked = rows.where(edge).withColumn("_r", rank)
    decided = rows.where(~edge).withColumn(name, below)
    ranked = ranked.withColumn(name, F.size(F.filter("_cut", lambda c: c["bound"] < F.col("_r"))))
    keep = [*df.columns, name]
    return decided.select(*keep).unionByName(ranked.select(*keep))


# D6 -----------------------------------------------------------------------------------------
def stratum_col(df: DataFrame) -> Column:
    """The severity in lower case; ``info`` where the data has no severity column, ``none`` for a null."""
    if "severity" not in df.columns:
        return F.lit("info")
    return F.lower(F.coalesce(F.col("severity").cast("string"), F.lit("None")))


def strata(df: DataFrame) -> DataFrame:
    """(_s, n, first, by_size, by_first): one row per stratum, and its place by size and by first appearance."""
    found = (df.groupBy(stratum_col(df).alias("_s"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first")))
    return small_table(found.withColumn("by_size", F.row_number().over(Window.orderBy(F.desc("n"), "first")))
                       .withColumn("by_first", F.row_number().over(Window.orderBy("first"))))


def allocations(found: DataFrame, target: int) -> DataFrame:
    """(_s, n, a): each stratum's share of ``target``, at least 1, half-even; what is missing or left over is dealt
    out over the strata by size, one by one, none going below 1."""
    total = int(found.agg(F.sum("n")).first()[0] or 0)
    a = F.greatest(F.lit(1), F.bround(F.col("n") / F.lit(float(total)) * F.lit(float(target)), 0).cast("long"))
    found = found.withColumn("a", a)
    size, given = found.agg(F.count(F.lit(1)), F.sum("a")).first()
    missing = target - int(given or 0)
    if missing >= 0:
        extra = F.lit(missing // max(1, size)) + F.when(F.col("by_size") <= missing % max(1, size), 1).otherwise(0)
        return found.select("_s", "n", (F.col("a") + extra).alias("a"))
    # Rounds of taking one from each stratum that has more than one: the first of these (round, place) pairs count.
    taken = (found.where("a > 1").select("_s", "by_size", F.explode(F.sequence(F.lit(1), F.least(
        F.col("a") - 1, F.lit(-missing)).cast("int"))).alias("round"))
        .orderBy("round", "by_size").limit(-missing).groupBy("_s").agg(F.count(F.lit(1)).alias("taken")))
    return found.join(taken, "_s", "left").select("_s", "n", (F.col("a") - F.coalesce("taken", F.lit(0))).alias("a"))


def stratified_sample(df: DataFrame, target: int, seed: str = "0") -> DataFrame:
    """Exactly ``target`` rows (or all rows when there are no more than that)."""
    found = strata(df)
    total = int(found.agg(F.sum("n")).first()[0] or 0)
    if total <= target:
        return df
    alloc = small_table(allocations(found, target))
    got = int(alloc.agg(F.sum(F.least("a", "n"))).first()[0])
    key = hash_key(seed, F.col("id"))
    seg = segments(df.withColumn("_s", stratum_col(df)), "_s", key, F.col("ord"),
                   alloc.select("_s", F.array("a").alias("b")), "_seg")
    picked = seg.where("_seg = 0")
    if got > target:  # only when every stratum was held at 1 (T8)
        picked = picked.orderBy(key, "ord").limit(target)
    elif got < target:  # pad from the rest in hash order
        picked = picked.unionByName(seg.where("_seg > 0").orderBy(key, "ord").limit(target - got))
    return picked.drop("_s", "_seg")


# D9 / D8 ------------------------------------------------------------------------------------
def _check_ratios(ratios) -> None:
    if abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("split ratios must add up to 1")


def _labels(seg: str, labels: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), F.col(seg) + 1)


def random_split(df: DataFrame, ratios=(0.3, 0.6, 0.1), seed: str = "0") -> DataFrame:
    """Global hash order; first round(r0*n) train, next round(r1*n) val, rest test."""
    _check_ratios(ratios)
    total = df.count()
    nt, nv = round(ratios[0] * total), round(ratios[1] * total)
    bounds = df.sparkSession.createDataFrame([(0, [nt, nt + nv])], "_p int, b array<long>")
    seg = segments(df.withColumn("_p", F.lit(0)), "_p", hash_key(seed, F.col("id")), F.col("ord"), bounds, "_seg")
    return seg.withColumn("split", _labels("_seg", ["train", "val", "test"])).drop("_p", "_seg")


def split_bounds(found: DataFrame, ratios) -> DataFrame:
    """(_s, b): the ranks at which a stratum's rows change from train to val, to val moved to train, to test, to
    test moved to val, to test moved to train.

    Rows are moved from the ends of the lists, which hold the strata in first-seen order: from val and then test to
    train, then from test to val, until the totals are met.
    """
    half = lambda r: F.bround(F.lit(float(r)) * F.col("n"), 0).cast("long")
    found = found.withColumn("t", half(ratios[0]))
    found = found.withColumn("v", F.least(half(ratios[1]), F.greatest(F.lit(0), F.col("n") - F.col("t"))))
    found = found.withColumn("e", F.col("n") - F.col("t") - F.col("v"))
    total, train = found.agg(F.sum("n"), F.sum("t")).first()
    want_t, want_v = round(ratios[0] * (total or 0)), round(ratios[1] * (total or 0))
    later = Window.orderBy(F.desc("by_first")).rowsBetween(Window.unboundedPreceding, -1)

    def move(frame: DataFrame, have: str, need: int, name: str) -> DataFrame:
        before = F.coalesce(F.sum(have).over(later), F.lit(0))
        return frame.withColumn(name, F.least(F.col(have), F.greatest(F.lit(0), F.lit(max(0, need)) - before)))

    found = move(found, "v", want_t - int(train or 0), "vt")
    moved = int(found.agg(F.sum("vt")).first()[0] or 0)
    found = move(found, "e", want_t - int(train or 0) - moved, "et")
    found = found.withColumn("left", F.col("e") - F.col("et"))
    val = int(found.agg(F.sum(F.col("v") - F.col("vt"))).first()[0] or 0)
    found = move(found, "left", want_v - val, "ev")
    end = F.col("t") + F.col("v")
    return found.select("_s", F.array("t", end - F.col("vt"), end, F.col("n") - F.col("et") - F.col("ev"),
                                      F.col("n") - F.col("et")).alias("b"))


def stratified_split(df: DataFrame, ratios=(0.3, 0.6, 0.1), seed: str = "0") -> DataFrame:
    """Per-severity split by half-even counts, then train/val topped up from the list ends."""
    _check_ratios(ratios)
    bounds = small_table(split_bounds(strata(df), ratios))
    seg = segments(df.withColumn("_s", stratum_col(df)), "_s", hash_key(seed, F.col("id")), F.col("ord"), bounds, "_seg")
    return seg.withColumn("split", _labels("_seg", ["train", "val", "train", "test", "val", "train"])).drop("_s", "_seg")


# D5 -----------------------------------------------------------------------------------------
def intelligent_sample(df: DataFrame, target: int = 2500, medium_ratio: float = 0.5, low_ratio: float = 0.25,
                       seed: str = "0") -> DataFrame:
    """D5 (T9): per category keep all high/critical (input order), then sampled medium, then
    sampled low+info, cut to the category target max(2, int(target * share))."""
    sev = F.col("severity")
    cls = (F.when(sev.isin("high", "critical"), F.lit(0)).when(sev == "medium", F.lit(1))
           .when(sev.isin("low", "info"), F.lit(2)))
    keyed = df.withColumn("_c", cls).where(F.col("_c").isNotNull()) \
        .withColumn("_cat", F.coalesce(F.col("category"), F.lit("unknown")))
    total = df.count()
    if target >= max(total, 1):
        return df
    per_cat = (df.groupBy(F.coalesce(F.col("category"), F.lit("unknown")).alias("_cat"))
               .agg(F.count(F.lit(1)).alias("_n"),
                    F.count_if(sev.isin("high", "critical")).alias("_h"),
                    F.count_if(sev == "medium").alias("_m"),
                    F.count_if(sev.isin("low", "info")).alias("_l")))
    ct = F.greatest(F.lit(2), F.floor(F.lit(float(target)) * (F.col("_n") / F.lit(float(total)))).cast("long"))
    mt = F.when(F.col("_m") > 0, F.greatest(F.lit(1), F.floor(ct * F.lit(medium_ratio)).cast("long"))).otherwise(0)
    lt = F.when(F.col("_l") > 0, F.greatest(F.lit(1), F.floor(ct * F.lit(low_ratio)).cast("long"))).otherwise(0)
    per_cat = per_cat.select("_cat", ct.alias("_ct"), F.least(mt, F.col("_m")).alias("_mt"),
                             F.least(lt, F.col("_l")).alias("_lt"), "_h")
    hk = hash_key(seed, F.col("id"))
    # high rows rank by input order; medium/low by hash order
    key = F.when(F.col("_c") == 0, F.lpad(F.hex(F.col("ord")), 16, "0")).otherwise(hk)
    bucket = F.when(F.col("_c") == 0, F.shiftright(F.col("ord"), 20)) \
        .otherwise(F.conv(F.substring(hk, 1, 2 * LEVEL), 16, 10).cast("long"))
    ranked = exact_rank(keyed, ["_cat", "_c"], key, F.col("ord"), bucket=bucket, name="_r")
    j = ranked.join(per_cat, "_cat")
    pos = (F.when(F.col("_c") == 0, F.col("_r"))
           .when(F.col("_c") == 1, F.when(F.col("_r") <= F.col("_mt"), F.col("_h") + F.col("_r")))
           .otherwise(F.when(F.col("_r") <= F.col("_lt"), F.col("_h") + F.col("_mt") + F.col("_r"))))
    return j.where(pos.isNotNull() & (pos <= F.col("_ct"))).drop("_c", "_cat", "_r", "_ct", "_mt", "_lt", "_h")


# D10 / D11 ----------------------------------------------------------------------------------
def shuffled(df: DataFrame, seed: str = "0") -> DataFrame:
    """The rows in hash order, a total order over range partitions."""
    return df.orderBy(hash_key(seed, F.col("id")), "ord")


def apply_quotas(df: DataFrame, quotas: dict[str, int], default: int | None = None, seed: str = "0",
                 column: str = "category") -> DataFrame:
    """At most ``quota`` rows per category, chosen in hash order; unlisted -> ``default`` (None = all)."""
    keyed = df.withColumn("_c", F.coalesce(F.col(column), F.lit("")))
    q = F.try_element_at(F.create_map(*[x for k, v in quotas.items() for x in (F.lit(k), F.lit(v))]), F.col("_c"))
    q = F.coalesce(q, F.lit(2**62 if default is None else default))
    bounds = keyed.select("_c").distinct().select("_c", F.array(q.cast("long")).alias("b"))
    seg = segments(keyed, "_c", hash_key(seed, F.col("id")), F.col("ord"), bounds, "_seg")
    return seg.where("_seg = 0").drop("_c", "_seg")


def unit_hash(seed: str, id_col: Column) -> Column:
    """Row id -> [0, 1): first 8 hex digits of md5(seed|id) / 2^32."""
    return F.conv(F.substring(hash_key(seed, id_col), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def assign_scenario(df: DataFrame, weights: dict[str, float], seed: str = "0", default: str = "normal") -> DataFrame:
    """Cumulative-weight ladder over a per-row uniform draw (first bucket with u <= cumulative)."""
    u = unit_hash(seed, F.col("id"))
    expr = None
    cum = 0.0
    for name, w in weights.items():
        cum += w
        expr = F.when(u <= cum, name) if expr is None else expr.when(u <= cum, name)
    return df.withColumn("scenario", expr.otherwise(default))
