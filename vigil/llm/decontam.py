"""Benchmark decontamination by winnowing, in DataFrame expressions only.

Of every ``span - k + 1`` consecutive hashes of k words the smallest is kept, in documents and items alike. Two texts
that share ``span`` words share all hashes in them and so the one kept: every shared span of that length leaves a
shared fingerprint. Documents with a fingerprint of the benchmark are read again; around each hit all windows of
``span`` words that contain it are compared with the benchmark's windows word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import table

#: Words of a window, and of a hash.
SPAN = 10
GRAM = 5
#: Rows up to which a written table of fingerprints, windows or ids is broadcast; beyond, it is joined by a shuffle.
BROADCAST_ROWS = 500_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words of a text in lower case.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case: runs of letters, digits and characters beyond ASCII. Null: none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN), "")


def gram(w: str, at: Column, m: int) -> Column:
    """The hash of the ``m`` words of column ``w`` from position ``at``; the count is part of it."""
    return F.xxhash64(F.lit(m), *[F.get(F.col(w), at + j if j else at) for j in range(m)])


def _places(n: Column, m: int) -> Column:
    """0 .. n - m, or none."""
    none = F.array().cast("array<int>")
    return F.when(n >= m, F.sequence(F.lit(0), F.greatest(n - m, F.lit(0)))).otherwise(none)


def _grams(w: str, m: int) -> Column:
    """All hashes of ``m`` words."""
    return F.transform(_places(F.size(w), m), lambda i: gram(w, i, m))


def _windows(starts: Column, w: str, m: int) -> Column:
    """(start, m, window) of windows of ``m`` words, the words space-joined."""
    return F.transform(starts, lambda s: F.struct(
        s.alias("start"), F.lit(m).alias("m"), F.array_join(F.slice(w, s + 1, m), " ").alias("window")))


def fingerprints(rows: DataFrame, w: str, span: int, k: int, short: list[int]) -> DataFrame:
    """``rows`` with ``prints`` in place of the words ``w``: the distinct hashes kept of ``span``-word windows, and
    the hashes of all windows of each of the ``short`` lengths."""
    n, others = F.size(w), [c for c in rows.columns if c != w]
    rows = rows.withColumn("_h", F.when(n >= span, _grams(w, k)))
    least = F.transform(_places(F.coalesce(F.size("_h"), F.lit(0)), span - k + 1),
                        lambda i: F.least(*[F.get(F.col("_h"), i + j if j else i) for j in range(span - k + 1)]))
    more = [_grams(w, m) for m in short]
    return rows.select(*others, F.array_distinct(F.concat(least, *more) if more else least).alias("prints"))


def _sized(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


class Benchmark:
    """The windows and fingerprints of a benchmark, as written tables."""

    def __init__(self, items: DataFrame, span: int = SPAN, k: int = GRAM, id_col: str = "item_id",
                 text_col: str = "text"):
        self.span, self.k = span, k
        rows = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where("size(w) > 0")
        rows = table(rows, "items")
        n, m = F.size("w"), F.least(F.size("w"), F.lit(span))
        windows = rows.select("item_id", m.alias("m"), F.explode_outer(F.transform(
            F.sequence(F.lit(1), n - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))).alias("window"))
        self.windows = table(windows.distinct(), "windows")
        # Items of fewer words than a window are windows of their own: at most span - 1 lengths.
        self.short = sorted(r["m"] for r in self.windows.where(F.col("m") < span).select("m").distinct().collect())
        whole = fingerprints(rows.where(n >= span).select("w"), "w", span, k, [])
        prints = whole.select(F.explode_outer("prints").alias("print")).where("print is not null")
        for m in self.short:
            prints = prints.unionByName(rows.where(n == m).select(gram("w", F.lit(0), m).alias("print")))
        self.prints = _sized(table(prints.distinct(), "prints"))
        self.distinct = _sized(table(self.windows.select("m", "window").distinct(), "distinct-windows"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("k"),
                       words(F.col(text_col)).alias("w"))


def _join(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """``a`` and what ``b`` has for its id (null equals null) and text hash."""
    b = b.withColumnsRenamed({"doc_id": "_id", "k": "_k"})
    out = a.join(b, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("k") == F.col("_k")), how)
    return out.drop("_id", "_k")


def overlaps(docs: DataFrame, bench: Benchmark, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, k, n_words, rows, n_hit, item_ids): one row per distinct id and text; ``rows`` is how many there are.

    n_hit: words in an occurrence of a benchmark window. item_ids: sorted texts of the ids of items with an occurring
    window. k: a hash of the text.
    """
    span, k = bench.span, bench.k
    prints = fingerprints(_keyed(docs, id_col, text_col).withColumn("n_words", F.size("w").cast("long")), "w", span, k,
                          bench.short)
    each = prints.select("doc_id", "k", "n_words", F.posexplode_outer("prints").alias("at", "print"))
    met = each.join(bench.prints.withColumn("met", F.lit(1)), "print", "left")
    base = table(met.groupBy("doc_id", "k", "n_words").agg(
        F.count_if(F.coalesce("at", F.lit(0)) == 0).alias("rows"), F.max("met").alias("met")), "documents")

    # Candidates only from here on.
    some = _sized(table(base.where("met = 1").select("doc_id", "k").distinct(), "candidates"))
    named = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("k"),
                        F.col(text_col).alias("text"))
    texts = table(_join(named, some, "left_semi").select("doc_id", "k", words(F.col("text")).alias("w")),
                  "texts")
    # explode_outer throughout: explode would be preceded by a filter that works the hashes out again for each element.
    hits = (fingerprints(texts, "w", span, k, bench.short).select("doc_id", "k", F.explode_outer("prints").alias("print"))
            .join(bench.prints, "print").groupBy("doc_id", "k").agg(F.collect_set("print").alias("hits")))
    rows = _join(texts, hits, "inner")
    n = F.size("w")

    def found(m: int) -> Column:
        """Places of hashes of m words that are hits."""
        return F.filter(_places(n, m), lambda i: F.array_contains(F.col("hits"), gram("w", i, m)))

    around = F.transform(found(k), lambda p: F.sequence(F.greatest(p - (span - k), F.lit(0)),
                                                        F.least(p, F.greatest(n - span, F.lit(0)))))
    starts = {span: F.when(n >= span, F.array_distinct(F.flatten(around))).otherwise(F.array().cast("array<int>"))}
    starts |= {m: found(m) for m in bench.short}
    rows = rows.select("doc_id", "k", "w", *[c.alias(f"s{m}") for m, c in starts.items()])
    windows = F.concat(*[_windows(F.col(f"s{m}"), "w", m) for m in starts])
    spans = rows.select("doc_id", "k", F.explode_outer(windows).alias("x")).select("doc_id", "k", "x.*")
    spans = table(spans.join(bench.distinct, ["m", "window"], "left_semi").distinct(), "spans")

    order = Window.partitionBy("doc_id", "k").orderBy("start", "m").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("m")
    fresh = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(F.max(end).over(order), F.lit(0))))
    covered = spans.select("doc_id", "k", fresh.alias("n")).groupBy("doc_id", "k").agg(F.sum("n").alias("n_hit"))
    items = (spans.select("doc_id", "k", "m", "window").distinct().join(bench.windows, ["m", "window"])
             .select("doc_id", "k", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("doc_id", "k").agg(F.array_sort(F.collect_set("item")).alias("item_ids")))
    hit = table(_join(covered, items, "left"), "hits")
    return _join(base, hit, "left").select(
        "doc_id", "k", "n_words", "rows", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row of ``docs``.

    An item of fewer than ``span`` words is one window; one without words has none. Null and empty texts have no
    words. Repeated rows and rows without an id keep a row each. Items without an id mark words but are not listed.
    Other columns are ignored. Without items nothing is hit; an empty table gives no row.
    """
    rows = overlaps(docs, Benchmark(items, span, k))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_row")).drop("_row")


def keep_clean(docs: DataFrame, items: DataFrame, span: int = SPAN, k: int = GRAM) -> DataFrame:
    """``docs`` without the rows that hold a window of an item. All columns and repeated rows stay."""
    rows = overlaps(docs, Benchmark(items, span, k))
    bad = _sized(table(rows.where("n_hit > 0").select(F.struct("doc_id", "k").alias("_bad")).distinct(), "contaminated"))
    return docs.join(bad, F.struct("doc_id", F.xxhash64("text").alias("k")).eqNullSafe(F.col("_bad")), "left_anti")


#: The same as DuckDB SQL, by comparing all windows.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     i AS (SELECT item_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     item_windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS t
             FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p FROM i WHERE len(w) > 0)),
     lengths AS (SELECT DISTINCT m FROM item_windows),
     doc_windows AS (SELECT r, p, m, array_to_string(w[p : p + m - 1], ' ') AS t
             FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS p FROM d, lengths WHERE len(w) >= m)),
     met AS (SELECT r, p, doc_windows.m, item_id FROM doc_windows JOIN item_windows USING (m, t)),
     hit AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(generate_series(p, p + m - 1)) AS q FROM met) GROUP BY r),
     found AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
             FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN found USING (r)"""
