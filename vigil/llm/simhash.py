"""SimHash near-duplicates: word-shingle fingerprints, tiled exact XOR / bit-count comparison, components.

Fingerprints are built per document in Arrow batches. Distinct fingerprints (one row each, whatever the number of
copies) are compared inside blocks: with a radius of r bits and r + 2 bit fields, two fingerprints within the radius
agree on at least two whole fields, so every linked pair meets under one of the (r + 2 choose 2) field pairs. Inside
a block rows are tiled by population count, and a tile only meets tiles whose population count differs by at most the
radius. Tiles hold a bounded number of rows; larger ones are split by hash, and a tile's partners stream past it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import raw, ship, table
from vigil.llm.components import components

SEED = 42
SHINGLE = 3
RADIUS = 3
TILE = 2048

_STEP = 1 << 15
_LANES = np.array([sum(((b >> j) & 1) << (8 * j) for j in range(8)) for b in range(256)], np.uint64)


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text's lower-cased words; zero when it has none.

    A bit is set if it is set in over half the shingle hashes, repeats included.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n, counts = len(words) - shingle + 1, np.zeros(64, np.int64)
    for at in range(0, n, _STEP):
        part = words[at:at + min(_STEP, n - at) + shingle - 1]
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)), strict=False))
        h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, min(_STEP, n - at))
        lanes = _LANES[h.view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(lanes, np.arange(0, len(h), 255), axis=0)
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, fingerprint, text_hash): one row per row of ``docs``, the 64 bits as a signed long. A null text has no words."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash(t, shingle) for t in raw(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), b.column(2)],
                                             names=[id_col, "fingerprint", "text_hash"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col, F.xxhash64(text_col)).mapInArrow(
        run, f"{id_col} {kind}, fingerprint long, text_hash long")


def fields(radius: int) -> list[int]:
    """Bit masks of the ``radius`` + 2 fields that 64 bits are cut into, taken in pairs."""
    edges = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    each = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [x | y for x, y in combinations(each, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect exactly what fingerprints within ``radius`` bits connect.

    ``distinct``: (fingerprint, rep), one row per fingerprint. Of the pairs inside a tile comparison only a spanning
    forest is returned, so no group of near copies is expanded into all its pairs.
    """
    masks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(m)).alias("m")) for i, m in enumerate(fields(radius))])
    keyed = (distinct.select("fingerprint", "rep", F.expr("bit_count(fingerprint)").cast("int").alias("pop"),
                             F.explode(masks).alias("f"))
             .select("fingerprint", "rep", "pop",
                     F.xxhash64("f.i", F.col("fingerprint").bitwiseAND(F.col("f.m"))).alias("block")))
    # At most 65 population counts a block: the list per block is bounded.
    sizes = (keyed.groupBy("block", "pop").agg(F.count("*").alias("n"))
             .groupBy("block").agg(F.sum("n").alias("total"), F.collect_list(F.struct(
                 "pop", F.ceil(F.col("n") / tile).cast("int").alias("parts"))).alias("pops"))
             .where("total > 1").select("block", "pops"))
    own = F.expr("filter(pops, x -> x.pop = pop)[0].parts")
    rows = (keyed.join(sizes, "block")
            .withColumn("part", F.pmod(F.xxhash64("fingerprint", F.lit(1)), own).cast("int")))
    homes = F.expr(f"""flatten(transform(filter(pops, x -> x.pop between pop - {radius} and pop),
        x -> transform(sequence(0, if(x.pop = pop, part, x.parts - 1)),
                       p -> struct(x.pop as home, p as home_part, x.pop = pop and p = part as is_home))))""")
    sent = rows.select("block", "fingerprint", "rep", F.explode(homes).alias("h")).select(
        "block", "h.home", "h.home_part", "h.is_home", "fingerprint", "rep")
    sent = (sent.repartition("block", "home", "home_part")
            .sortWithinPartitions("block", "home", "home_part", F.desc("is_home")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b in _tiles(batches, radius):
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return sent.mapInArrow(run, "a long, b long").distinct()


def _tiles(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges of a partition that is sorted by home tile, the tile's own rows first; carries a tile across batches."""
    key, fp, rep, seen = None, np.zeros(0, np.uint64), np.zeros(0, np.int64), []
    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        ids = np.stack([cols[0], cols[1].astype(np.int64), cols[2].astype(np.int64)])
        cuts = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1).tolist(), len(cols[0])]
        out_a, out_b = [], []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if lo == hi:
                continue
            now = tuple(ids[:, lo].tolist())
            if now != key:
                key, fp, rep = now, np.zeros(0, np.uint64), np.zeros(0, np.int64)
            f, r, home = cols[4][lo:hi].view(np.uint64), cols[5][lo:hi], cols[3][lo:hi].astype(bool)
            if home.any():
                fp, rep = np.concatenate([fp, f[home]]), np.concatenate([rep, r[home]])
                a, b = _within(f[home], r[home], fp, rep, radius)
                out_a.append(a), out_b.append(b)
            if not home.all():
                a, b = _within(f[~home], r[~home], fp, rep, radius)
                out_a.append(a), out_b.append(b)
        if out_a:
            yield np.concatenate(out_a), np.concatenate(out_b)


def _within(f: np.ndarray, r: np.ndarray, fp: np.ndarray, rep: np.ndarray,
            radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of edges of the bipartite comparison of rows (f, r) with a tile (fp, rep)."""
    a, b, label = [], [], np.arange(len(fp))
    step = max(1, (1 << 20) // max(1, len(fp)))
    for lo in range(0, len(f), step):
        near = np.bitwise_count(f[lo:lo + step, None] ^ fp[None, :]) <= radius
        row, col = np.nonzero(near)
        if not len(row):
            continue
        first = np.full(near.shape[0], -1)
        first[row[::-1]] = col[::-1]
        hit = np.flatnonzero(first >= 0)
        a.append(r[lo:lo + step][hit]), b.append(rep[first[hit]])
        pairs = np.unique(first[row] * len(fp) + col)
        x, y = pairs // len(fp), pairs % len(fp)
        while True:  # the tile's own components, by the smallest position
            low = np.minimum(label[x], label[y])
            new = label.copy()
            np.minimum.at(new, label[x], low)
            np.minimum.at(new, label[y], low)
            new = new[new]
            if (new == label).all():
                break
            label = new
    moved = np.flatnonzero(label != np.arange(len(fp)))
    a.append(rep[moved]), b.append(rep[label[moved]])
    a, b = np.concatenate(a), np.concatenate(b)
    return a[a != b], b[a != b]


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``.

    fingerprint: 16 hex digits. component_id: the smallest id that links of ``radius`` bits or fewer reach, the row's
    own included. Empty and null texts have fingerprint zero and link like any other. Repeated rows keep a row each.
    Rows with a null id are kept, with the component of their fingerprint (null if no row of it has an id). Other
    columns of ``docs`` are ignored. An empty table gives no row. Ids must be integers.
    """
    return _groups(docs, shingle, radius, tile, id_col, text_col).select(
        id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def _groups(docs: DataFrame, shingle: int, radius: int, tile: int, id_col: str, text_col: str) -> DataFrame:
    """(id, fingerprint, text_hash, component_id) per row of ``docs``."""
    fps = table(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = table(fps.groupBy("fingerprint").agg(F.min(id_col).cast("long").alias("rep")), "distinct")
    # A fingerprint that only rows without an id have cannot name a component; it takes part in no link.
    found = components(links(distinct.where("rep is not null"), radius, tile))
    labels = distinct.join(found, F.col("rep") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(labels, "fingerprint", "left").select(id_col, "fingerprint", "text_hash", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: that with the smallest id. All columns stay.

    Rows without an id are kept: nothing identifies them as copies. Where rows share the smallest id of a group, one
    of each fingerprint stays: texts that are no copies of each other all do.
    """
    groups = _groups(docs, shingle, radius, TILE, id_col, text_col)
    kept = groups.where(F.col(id_col) == F.col("component_id")).groupBy(F.col(id_col).alias("_kept"), "fingerprint").agg(
        F.min("text_hash").alias("_as")).drop("fingerprint")
    hashed = docs.where(F.col(id_col).isNotNull()).withColumn("_hash", F.xxhash64(text_col))
    return (hashed.dropDuplicates([id_col, "_hash"])
            .join(kept, (F.col(id_col) == F.col("_kept")) & (F.col("_hash") == F.col("_as")), "left_semi").drop("_hash")
            .unionByName(docs.where(F.col(id_col).isNull())))
