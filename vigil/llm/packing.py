"""Best-fit packing of documents into token sequences under several capacities.

A piece asks for a vector: its tokens, one place for a document, and its attention cost (tokens squared). A sequence
has a capacity for each. Pieces are placed in order of falling demand; of the sequences that can take a piece in
every dimension, the one with the smallest weighted norm of what would be left (or the largest weighted dot product
of demand and rest) gets it. Pieces are dealt evenly into groups of a bounded number of pieces, and each group is
packed on its own; a group can leave about one sequence less full than a single packing would.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import tokens
from vigil.llm.common import ship, table

CAPACITY = 4096
END_ID = 1
GROUP = 32_768
WEIGHTS = (1.0, 1e-3, 1e-3)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): a document's ids, end included, cut only if over capacity.

    A null or empty text is one piece of one id. Rows without an id and repeated rows are pieces like any other.
    Other columns are ignored. An empty table gives no row.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, n in tokens.encoded(batches, tokenizer, end_id):
            parts = -(-n // capacity)
            row = np.repeat(np.arange(len(n)), parts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(capacity, n[row] - start)
            at = (np.cumsum(n) - n)[row] + start
            cut = list(zip(at.tolist(), (at + length).tolist(), strict=True))
            cols = [rows.take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array([tokens.crc32(ids[a:b]) for a, b in cut], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:  # pieces follow each other without gaps
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                cols, names = [*cols, pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def best_fit(length: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float] = WEIGHTS,
             rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece of one group."""
    cap, w = np.array(capacity, float), np.array(weights, float)
    need = np.stack([length, np.ones(len(length)), length.astype(float) ** 2])
    if (need > cap[:, None]).any():
        raise ValueError("a piece is larger than a sequence")
    order = np.argsort(-((need / cap[:, None]) ** 2 * w[:, None]).sum(axis=0), kind="stable")
    rest = np.zeros((3, 0))  # of the open sequences, as they were opened
    number, free, opened = np.zeros(0, np.int64), 0, 0
    sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    held = np.zeros((3, 1024))
    for i in order.tolist():
        n = need[:, i, None]
        rest = held[:, :free]
        left = rest - n
        fits = (left >= 0).all(axis=0)
        if rule == "dot":
            score = np.where(fits, -((w / cap**2)[:, None] * n * rest).sum(axis=0), np.inf)
        else:
            score = np.where(fits, w @ (left / cap[:, None]) ** 2, np.inf)
        at = int(score.argmin()) if free else 0
        if not free or not fits[at]:
            if free == held.shape[1]:
                held = np.concatenate([held, np.zeros_like(held)], axis=1)
            if free >= len(number):
                number = np.concatenate([number, np.zeros(max(1024, free), np.int64)])
            at, free = free, free + 1
            held[:, at], number[at] = cap, opened
            opened += 1
        sequence[i], offset[i] = number[at], int(cap[0] - held[0, at])
        held[:, at] -= n[:, 0]
        if (held[:2, at] < 1).any():  # full: the last open one takes its place
            free -= 1
            held[:, at], number[at] = held[:, free], number[free]
    return sequence, offset


def pack(cut: DataFrame, capacity: int = CAPACITY, max_docs: int | None = None, max_attention: int | None = None,
         weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm", group: int = GROUP) -> DataFrame:
    """``cut`` with sequence_id and offset: each piece in one sequence, without gaps, within every capacity.

    ``cut`` must be a written table with a column length (1 to ``capacity``). max_docs and max_attention default to
    what the token capacity implies (that many one-token pieces; its square), so they bind only if set lower.
    Groups are dealt by a hash of the row's place in the written table, so equal rows spread like others.
    """
    caps = (capacity, max_docs or capacity, max_attention or capacity**2)
    n_groups = max(1, -(-cut.count() // group))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        seq, offset = best_fit(pdf["length"].to_numpy(), caps, weights, rule)
        pdf["sequence_id"] = (pdf["_group"].to_numpy().astype(np.int64) << 32) + seq
        pdf["offset"] = offset
        return pdf.drop(columns="_group")

    dealt = cut.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_groups)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("_group").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, **how) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(table(pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity, **how)
