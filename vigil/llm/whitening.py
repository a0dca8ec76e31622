"""Embedding whitening by shifted CholeskyQR over exact integer vectors.

Vectors become integers (a floor of 64 times each entry), so copies are found exactly and their sums are exact. The
centred distinct vectors are orthogonalised by passes over them: each pass solves with the triangular factors so far,
sums the Gram matrix of what is left over all partitions, and factors it by Cholesky, the first time with a shift that
makes it safely positive. The product of the factors is R; the SVD of R gives the principal components and their
variances, without ever squaring the data's condition. Only sums of d x d entries a partition leave the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import ship, table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Rows that are solved together.
STEP = 2048
#: Passes end when the Gram matrix differs from a projection by so little, and after so many passes at the latest.
ENOUGH, MOST_PASSES = 1e-12, 8
#: Beyond this, 64 times an entry has no unit digit as a double, and no exact sums exist.
LARGEST = 1 << 52
#: Directions of less than this share of the largest standard deviation are rounding.
RANK = 1e-13
_WIDTHS = ((1, np.int8), (2, np.int16), (4, np.int32), (8, np.int64))


def encode(rows: np.ndarray) -> list[bytes]:
    """Each row of integers, less ``OFFSET``, in the narrowest width that holds it: a row has one code, a code one row."""
    own = rows - OFFSET
    low, high = own.min(axis=1), own.max(axis=1)
    out = [b""] * len(own)
    done = np.zeros(len(own), bool)
    for width, kind in _WIDTHS:
        limits = np.iinfo(kind)
        fits = ~done & (low >= limits.min) & (high <= limits.max)
        for i in np.flatnonzero(fits).tolist():
            out[i] = bytes([width]) + own[i].astype(f"<i{width}").tobytes()
        done |= fits
    return out


def decode(codes: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(codes), dim), np.int64)
    for i, c in enumerate(codes):
        out[i] = np.frombuffer(c, f"<i{c[0]}", offset=1)
    return out + OFFSET


def _integers(vectors: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows are usable, their integers): ``dim`` finite entries, none null, none beyond ``LARGEST``."""
    lists = vectors.cast(pa.list_(pa.float64()))
    ok = np.zeros(len(lists), bool)
    found = []
    for i, v in enumerate(lists):
        if not v.is_valid or len(v.values) != dim or v.values.null_count:
            continue
        c = v.values.to_numpy(zero_copy_only=False)
        if np.isfinite(c).all() and (np.abs(c) < LARGEST / SCALE).all():
            ok[i] = True
            found.append(c)
    c = np.array(found).reshape(-1, dim)
    return ok, np.floor(SCALE * c).astype(np.int64) + OFFSET


def integer_vectors(rows: DataFrame, dim: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, code) of the usable rows."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok, x = _integers(b.column(1), dim)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).filter(pa.array(ok)), pa.array(encode(x) if len(x) else [], pa.binary())],
                names=[id_col, "code"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, vector_col).mapInArrow(run, f"{id_col} {kind}, code binary")


def centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int]]:
    """(x - S / n as doubles, sum of (n x - S) ** 2 of each row, exact). No digits cancel: n x - S is an integer."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    d = x - whole
    most = int(np.abs(d).max(initial=0)) + 1
    if len(sums) * (most * n) ** 2 < 1 << 62:
        exact = n * d - rest
        return exact / n, (exact * exact).sum(axis=1).tolist()
    exact = d.astype(object) * n - rest.astype(object)
    return d - rest / n, [sum(v * v for v in r) for r in exact.tolist()]


def solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q of Q r = a, r upper triangular, by forward substitution over the columns."""
    q = np.empty_like(a)
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _summed(rows: DataFrame, work: Callable[[list[bytes]], np.ndarray], size: int) -> np.ndarray:
    """The sum over all codes of ``work``'s flat vectors of ``size`` doubles; a partition sends one of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            codes = b.column(0).to_pylist()
            for at in range(0, len(codes), STEP):
                total += work(codes[at:at + STEP])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["i", "v"])

    found = rows.select("code").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(size)
    for r in found:
        out[r["i"]] = r["v"]
    return out


@dataclass
class Model:
    """What whitens: the distinct vectors' number and sums, components (columns), variances, their total, the error."""

    dim: int
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    error: float = 0.0

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)[0] @ self.vectors / np.sqrt(self.values)


def _sums(distinct: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(n, exact sums of each dimension): entries are added as 26 low bits and the rest, which no sum can overflow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for b in batches:
            codes = b.column(0).to_pylist()
            for at in range(0, len(codes), STEP):
                x = decode(codes[at:at + STEP], dim)
                n, low, high = n + len(x), low + (x & (1 << 26) - 1).sum(axis=0), high + (x >> 26).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(np.full(dim, n)), pa.array(low),
                                          pa.array(high)], names=["i", "n", "low", "high"])

    found = distinct.select("code").mapInArrow(run, "i long, n long, low long, high long").groupBy("i").agg(
        *[F.sum(c).alias(c) for c in ("n", "low", "high")]).collect()
    sums = [0] * dim
    for r in found:
        sums[r["i"]] = (r["high"] << 26) + r["low"]
    return (found[0]["n"] if found else 0), sums


def fit(distinct: DataFrame, dim: int, k: int = COMPONENTS) -> Model | None:
    """The first ``k`` components of distinct codes, or as many as have a variance. None where nothing varies."""
    n, sums = _sums(distinct, dim)
    if n == 0:
        return None

    def gram(factors: list[np.ndarray]) -> np.ndarray:
        def work(codes: list[bytes]) -> np.ndarray:
            q = centred(decode(codes, dim), n, sums)[0]
            for r in factors:
                q = solve(q, r)
            return (q.T @ q).ravel()
        g = _summed(distinct, work, dim * dim).reshape(dim, dim)
        return (g + g.T) / 2

    g, factors = gram([]), []
    trace = float(np.trace(g)) / n
    if not trace > 0:
        return None
    u = np.finfo(float).eps / 2
    while True:
        # Directions without variance stay at zero in every pass; the shift keeps the factor regular there.
        shift = 11 * (n * dim + dim * (dim + 1)) * u * float(np.trace(g)) if not factors else 100 * dim * u
        factors.append(np.linalg.cholesky(g + shift * np.eye(dim)).T)
        g = gram(factors)
        if len(factors) >= 3 and np.abs(g @ g - g).max() < ENOUGH or len(factors) == MOST_PASSES:
            break
    r = np.eye(dim)
    for f in factors:
        r = f @ r
    # A = Q R, Q'Q = g: the square root of g takes what is left between Q and orthogonal columns.
    e, v = np.linalg.eigh(g)
    root = (v * np.sqrt(np.maximum(e, 0))) @ v.T
    _, s, vt = np.linalg.svd(root @ r)
    real = s > RANK * s[0]
    s, vt = s[real][:k], vt[real][:k]
    model = Model(dim, n, sums, np.ascontiguousarray(vt.T), s * s / n, trace)

    def covariance(codes: list[bytes]) -> np.ndarray:
        w = model.whiten(decode(codes, dim))
        return (w.T @ w).ravel()

    c = _summed(distinct, covariance, len(s) ** 2).reshape(len(s), len(s)) / n
    model.error = float(np.abs(c - np.eye(len(s))).max())
    return model


def whitened(rows: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per usable row of ``rows`` and component.

    Left out are null vectors, those with a null or non-finite entry, and what has no exact form: entries of 2 ** 46 and
    more, and vectors of another length than most have (the shorter of two equally frequent lengths counts). Copies,
    and rows that share an id, get rows of their own; they count once in the fit. Components without variance
    are not numbered, so that constant, single or no vectors give no row. deviation is null where a long cannot hold
    it. Other columns are ignored. ``n`` distinct vectors of d entries cost some 5 passes; d x d numbers reach the driver.
    """
    spark = ship(rows.sparkSession)
    kind = rows.schema[id_col].dataType.simpleString()
    schema = (f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    lengths = rows.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("d")).count()
    common = lengths.orderBy(F.desc("count"), "d").first()
    dim = common["d"] if common else 0
    model = None
    if dim:
        coded = table(integer_vectors(rows, dim, id_col, vector_col), "vectors")
        model = fit(table(coded.select("code").distinct(), "distinct-vectors"), dim, k)
    if model is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(model)  # d x k numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.values)
        for b in batches:
            x = decode(b.column(1).to_pylist(), m.dim)
            w, far = m.whiten(x), centred(x, m.n, m.sums)[1]
            each = np.repeat(np.arange(len(x)), k)
            deviation = pa.array([v if v < 1 << 63 else None for v in far], pa.int64())
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), m.n)), deviation.take(pa.array(each)), pa.array(w.ravel()),
                pa.array(np.tile(m.values / m.trace, len(x))), pa.array(np.full(len(each), m.error))], names=names)

    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return coded.mapInArrow(run, schema)
