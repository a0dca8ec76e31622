"""Toxicity scores: a bidirectional gated recurrent network with attention over all overlapping windows of a text.

The network is fitted on the driver to a bounded sample of labelled rows (``FIT_ROWS`` documents of each label, with all
their windows). Scoring is a map over all documents: every word of a text is in a window, and
the text's score is that of its highest window. Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import bigru
from vigil.llm.common import crc32_mod, hash_sample, raw, ship
from vigil.llm.tokens import groups

WINDOW = 32
#: Half the window: each span of up to WINDOW - STRIDE + 1 words is whole in some window.
STRIDE = 16
#: Documents of label 0 and of label 1 that the network is fitted to, and the stride of their windows.
FIT_ROWS = (2700, 900)
FIT_STRIDE = 24
#: A word of the sample is known to the network if so many sampled documents hold it.
MIN_DOCUMENTS = 3
THRESHOLD = 0.3
_REMEMBER = 3 << 16
_BLOCK = 1024


def starts(n: int, window: int = WINDOW, stride: int = STRIDE) -> list[int]:
    """Where the windows of n words start: every ``stride`` words, the last one ending with the text."""
    if n <= window:
        return [0]
    return [*range(0, n - window, stride), n - window]


def fit(docs: DataFrame, labels: DataFrame, rows: tuple[int, int] = FIT_ROWS, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> bigru.Model | None:
    """A network fitted to ``rows`` documents of label 0 and 1, chosen by a hash of the id. None without both labels.

    ``labels``: (id, label 0/1); rows with a null in either are left out. The prior odds of all of ``labels``
    replace the sample's.
    """
    ship(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where(
        "_id is not null and _label in (0, 1)")
    share = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    if len(share) < 2:
        return None
    chosen = None
    for y in (0, 1):
        some = hash_sample(known.where(F.col("_label") == y).distinct(), rows[y], "_id", seed=seed)
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most sum(rows) pairs of an id and a label, and one text of each, whatever number of rows has the id.
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(
        F.min_by("_text", F.xxhash64("_text")).alias("_text")).select("_id", "_text", "_label")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, t in enumerate(raw(b.column(1))):
                words = t.lower().split()
                at = starts(len(words), stride=FIT_STRIDE)
                out.append(pa.array([b" ".join(words[a:a + WINDOW]) for a in at], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 1), b.column(2).slice(i, 1), pa.array([out[-1].to_pylist()])],
                    names=["_id", "_label", "windows"])

    kind = sample.schema["_id"].dataType.simpleString()
    found = sample.mapInArrow(cut, f"_id {kind}, _label int, windows array<binary>").collect()
    found.sort(key=lambda r: (r["_id"], [bytes(w) for w in r["windows"]]))
    label = np.array([r["_label"] for r in found], np.int64)
    if len(set(label.tolist())) < 2:
        return None
    windows = [bytes(w) for r in found for w in r["windows"]]
    doc = np.repeat(np.arange(len(found)), [len(r["windows"]) for r in found])
    held: Counter[bytes] = Counter()
    for r in found:
        held.update({c.strip(bigru.PUNCTUATION) for w in r["windows"] for c in bytes(w).split()})
    known_words = sorted(w for w, n in held.items() if w and n >= MIN_DOCUMENTS)
    chunks, index, mask = bigru.number_windows(windows, WINDOW)
    del found, held, windows
    model = bigru.Model({w: i + 1 for i, w in enumerate(known_words)})
    model.start(seed)
    bigru.train(model, chunks, index, mask, doc, label, seed)
    model.shift = float(np.log(share[1] / share[0]) - np.log(label.sum() / (1 - label).sum()))
    return model


class Scorer:
    """Scores texts with a model; remembers the inputs of chunks it has met."""

    def __init__(self, model: bigru.Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.rows: dict[bytes, int] = {b"": 0}
        self.x = np.zeros((1, self.model.word + self.model.char), np.float32)

    def _index(self, words: list[bytes]) -> np.ndarray:
        get = self.rows.get
        index = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        miss = np.flatnonzero(index < 0).tolist()
        if miss:
            new = list(dict.fromkeys(words[i] for i in miss))
            self.x = np.concatenate([self.x, self.model.inputs(new)])
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            index[miss] = [self.rows[words[i]] for i in miss]
        return index

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The score of each text, 0 to 1. A text without words is one window without evidence."""
        if len(self.rows) > _REMEMBER:
            self.forget()
        out = np.full(len(texts), -np.inf, np.float64)
        words: list[bytes] = []
        at, size, owner = [], [], []
        for i, t in enumerate(texts):
            own = t.lower().split() or [b""]
            here = starts(len(own))
            at += [len(words) + s for s in here]
            size += [min(WINDOW, len(own))] * len(here)
            owner += [i] * len(here)
            words += own
        index = self._index(words)
        del words
        index = np.append(index, np.zeros(WINDOW, np.int64))
        at, size, owner = np.array(at), np.array(size), np.array(owner)
        order = np.argsort(-size, kind="stable")  # whole windows together: they need no mask
        for lo in range(0, len(at), _BLOCK):
            part = order[lo:lo + _BLOCK]
            mask = (np.arange(WINDOW)[:, None] < size[part]).astype(np.float32)
            rows = index[at[part] + np.arange(WINDOW)[:, None]]
            rows[mask == 0] = 0
            np.maximum.at(out, owner[part], self.model.logits(self.x[rows], mask))
        return bigru.sigmoid(out + self.model.shift)


def score(docs: DataFrame, model: bigru.Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row of ``docs``: 0 to 1. A null text scores as the empty one. Without a model: 0.

    Repeated rows get a row each; other columns are ignored; an empty table gives no row.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    if model is None:
        return docs.select(id_col, F.lit(0.0).alias("score"))
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is bounded by the sample it was fitted to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            for first, texts in groups(b.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)), pa.array(scorer.scores(texts))], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, score double")


def training(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The label rows that may be learned from: crc32(id as text) mod 4 is not 2."""
    return labels.where(crc32_mod(id_col, 4) != 2)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``; predicted is 1 if score >= ``threshold``."""
    scored = score(docs, fit(docs, training(labels), **how))
    return scored.select("doc_id", F.coalesce(crc32_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more. All columns and repeated rows stay."""
    model = fit(docs, training(labels))
    if model is None:
        return docs
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            for first, texts in groups(b.column(text)):
                yield b.slice(first, len(texts)).filter(pa.array(scorer.scores(texts) < threshold))

    return docs.mapInArrow(run, docs.schema)
