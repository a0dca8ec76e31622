"""Quality rules: an isolation forest over rule statistics of whole texts, its threshold set by labelled rows.

One pass turns each text into a row of counts, which is written; everything after reads that small table. The forest
is grown from a bounded sample of those rows; its path lengths score every row, and the threshold is chosen over the
scores of all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import hash_sample, raw, ship, table

SYMBOLS = b"#*$%&|<>"
#: Rows that the forest is grown from, trees, rows of each tree, and the cells scores are counted in.
FIT_ROWS = 8192
TREES = 256
TREE_ROWS = 64
CELLS = 4000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper", "n_marks")


def statistics(text: bytes) -> tuple[int, ...]:
    """``COUNTS`` of one text. Words are runs of bytes other than the six ASCII white-space characters.

    word_chars: code points in words. n_symbols: symbol characters. n_dup_lines: lines with a word that equal an
    earlier line. n_repeat_words: words in 3-word windows found twice or more. n_distinct:
    distinct words. n_upper: A-Z. n_marks: exclamation marks.
    """
    words = text.split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS)
    space = sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    codes = np.frombuffer(text, np.uint8)
    hist = np.zeros(256, np.int64)
    for at in range(0, len(codes), 1 << 22):
        hist += np.bincount(codes[at:at + (1 << 22)], minlength=256)
    chars = len(text) - int(hist[0x80:0xC0].sum()) - space
    lines, dup = set(), 0
    for line in text.split(b"\n"):
        if line and line.strip():
            if line in lines:
                dup += 1
            else:
                lines.add(line)
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    repeat = 0
    if n >= 4:
        # Windows as one number: pairs are numbered anew first, so that products stay far below 2^63.
        pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        window = pair[:-1] * len(number) + ids[2:]
        _, back, count = np.unique(window, return_inverse=True, return_counts=True)
        hit = np.flatnonzero(count[back] > 1)
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[hit + k] = True
        repeat = int(covered.sum())
    return (n, chars, int(hist[list(SYMBOLS)].sum()), dup, repeat, len(number), int(hist[65:91].sum()), int(hist[33]))


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``COUNTS``) per row of ``docs``; a null text has no words."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([statistics(t) for t in raw(b.column(1))], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x) for x in np.ascontiguousarray(rows.T))],
                                             names=[id_col, *COUNTS])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """(rows, features): shares of the counts, on scales where ordinary texts lie together.

    Text length and equal lines are left out: ordinary texts differ widely in both.
    """
    n = np.maximum(c["n_words"], 1).astype(float)
    chars = np.maximum(c["word_chars"], 1).astype(float)
    return np.stack([
        np.log(chars / n), np.log1p(100 * c["n_symbols"] / chars), np.log1p(100 * c["n_repeat_words"] / n),
        np.log1p(100 * c["n_upper"] / chars), np.log1p(100 * c["n_marks"] / chars),
        np.log(np.maximum(c["n_distinct"], 1)) / np.log(n + 1),
    ], axis=1).astype(np.float32)


@dataclass
class Forest:
    """Isolation trees as arrays (trees, nodes): the children of node i are 2 i + 1 and 2 i + 2."""

    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray  # path length where a row stops; NaN at inner nodes
    usual: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; the shorter the mean path over the trees, the higher."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, c, p in zip(self.feature, self.cut, self.path, strict=True):
            at = np.zeros(len(x), np.int64)
            while (inner := np.isnan(p[at])).any():
                at = np.where(inner, 2 * at + 1 + (x[rows, f[at]] >= c[at]), at)
            total += p[at]
        return 2.0 ** (-total / len(self.path) / self.usual)


def usual_path(n: int) -> float:
    """Mean path of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """Random splits on random features between the least and largest value of each node's rows."""
    rng = np.random.default_rng(seed)
    tree_rows = min(tree_rows, len(x))
    depth = max(1, int(np.ceil(np.log2(max(2, tree_rows)))))
    nodes = 2 ** (depth + 1) - 1
    feature, cut = np.zeros((trees, nodes), np.int64), np.zeros((trees, nodes), np.float32)
    path = np.full((trees, nodes), np.nan)
    for t in range(trees):
        left = [(0, 0, x[rng.choice(len(x), tree_rows, replace=False)])]
        while left:
            i, level, rows = left.pop()
            low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
            open_ = np.flatnonzero(high > low)
            if level == depth or not len(open_):
                path[t, i] = level + usual_path(len(rows))
                continue
            f = int(rng.choice(open_))
            c = np.float32(rng.uniform(low[f], high[f]))
            c = c if c > low[f] else high[f]
            feature[t, i], cut[t, i] = f, c
            up = rows[:, f] >= c
            left += [(2 * i + 1, level + 1, rows[~up]), (2 * i + 2, level + 1, rows[up])]
    return Forest(feature, cut, path, usual_path(tree_rows) or 1.0)


def _arrays(b: pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: b.column(c).to_numpy() for c in COUNTS}


def fit(rows: DataFrame, n: int = FIT_ROWS, trees: int = TREES, tree_rows: int = TREE_ROWS,
        seed: int = 7) -> Forest | None:
    """A forest over ``n`` distinct rows of counts with a word, chosen by their hash. None if there is no such row."""
    sample = hash_sample(table(rows.where("n_words > 0").select(*COUNTS).distinct(), "distinct"), n, *COUNTS,
                         seed=seed).toPandas()
    if not len(sample):
        return None
    return grow(features({c: sample[c].to_numpy() for c in COUNTS}), trees, tree_rows, seed)


def score(rows: DataFrame, forest: Forest | None) -> DataFrame:
    """``rows`` with ``score``: 0 to 1, higher for rows that random splits isolate sooner; 0 without a forest."""
    if forest is None:
        return rows.withColumn("score", F.lit(0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = forest.scores(features(_arrays(b))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], names=[*b.schema.names, "score"])

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", score double")


def threshold(scored: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> float:
    """The score from which a row is rejected: that with the fewest wrong decisions on the labelled rows.

    All labelled rows are counted, in at most 2 * (``CELLS`` + 1) cells. Without both labels nothing is rejected.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where(
        "_label in (0, 1)")
    cells = scored.join(known, F.col(id_col) == F.col("_id")).groupBy(
        F.floor(F.col("score") * CELLS).cast("int").alias("cell"), "_label").count().collect()
    n = np.zeros((2, CELLS + 2), np.int64)
    for r in cells:
        n[r["_label"], r["cell"]] += r["count"]
    if not n.sum(axis=1).all():
        return float("inf")
    rejected = n[:, ::-1].cumsum(axis=1)[:, ::-1]  # rows at or above each cell
    wrong = rejected[1] + n[0].sum() - rejected[0]
    best = np.flatnonzero(wrong == wrong.min())
    return float(best[len(best) // 2]) / CELLS


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score) per row of ``docs``.

    base_failed: under 50 words, or over half of them in repeated 3-word windows. kept: not base_failed, and the
    isolation score is below the threshold. Null and empty texts have no words and fail. Repeated rows keep a row
    each. A null id stays; it has no label. Other columns are ignored. An empty table gives no row.
    """
    rows = table(counts(docs, id_col, text_col), "counts")
    scored = table(score(rows, fit(rows)), "scored")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    limit = threshold(scored.where(~failed), labels, id_col)
    return scored.select(id_col, *COUNTS[:5], failed.alias("base_failed"),
                         (~failed & (F.col("score") < limit)).alias("kept"), "score")
