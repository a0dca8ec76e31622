"""Token-id files: Parquet list columns in ascending document order, for selective token and metadata reads.

Layout of a row: doc_id, part (number of the file), before (ids of earlier documents in the same file), n_tokens, ids.
Token ids repeat, so the list column is dictionary encoded; doc_id and before rise, so they are delta encoded. Row
groups and pages have set sizes, and page indexes are written with each file, so a read of a doc_id range touches
only the pages that can hold it and a metadata read never touches the ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm import tokens
from vigil.llm.common import ship

END_ID = 1
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, row_group: int = ROW_GROUP_BYTES,
          page: int = PAGE_BYTES, page_rows: int = PAGE_ROWS, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Encode every whole text and write the ids in ascending id order; part n holds smaller ids than part n + 1.

    A null or empty text has the end id alone. Rows without an id come first. Repeated rows stay, next to each
    other. Other columns are ignored. An empty table writes no row.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for rows, ids, n in tokens.encoded(batches, tokenizer, end_id):
            ends = np.cumsum(n)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [rows, pa.array(np.full(len(n), part, np.int32)), pa.array(before + ends - n), pa.array(n), lists],
                names=["doc_id", "part", "before", "n_tokens", "ids"])
            before += int(ends[-1])

    kind = docs.schema[id_col].dataType.simpleString()
    ordered = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id"))
    (ordered.mapInArrow(run, f"doc_id {kind}, part int, before long, n_tokens long, ids array<int>").write
     .option("compression", "zstd")
     .option("parquet.writer.version", "v2").option("parquet.block.size", row_group)
     .option("parquet.page.size", page).option("parquet.page.row.count.limit", page_rows)
     .option("parquet.enable.dictionary", "true")
     .option("parquet.enable.dictionary#doc_id", "false").option("parquet.enable.dictionary#before", "false")
     .parquet(path))


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, start and n_tokens of every document; the ids are not read.

    start counts the ids of all documents before. Only one row per file is summed up in order; that table is as
    small as the number of files and is broadcast.
    """
    files = spark.read.parquet(path)
    return _with_start(files.select("doc_id", "part", "before", "n_tokens"), files)


def read(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """doc_id, part, start, n_tokens and ids, of all documents or of those with low <= doc_id <= high."""
    files = spark.read.parquet(path)
    rows = files
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return _with_start(rows, files)


def _with_start(rows: DataFrame, files: DataFrame) -> DataFrame:
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    out = rows.join(F.broadcast(offsets), "part")
    return out.select("doc_id", "part", (F.col("offset") + F.col("before")).alias("start"), "n_tokens",
                      *(["ids"] if "ids" in rows.columns else []))


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows with ids; the count and the checksum come from the ids read."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            at = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            crc = [tokens.crc32(values[x:y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "start", "ids").mapInArrow(
        run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
