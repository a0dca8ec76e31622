"""Prediction by partial matching: pretrained byte-context tries that give each document's code length.

A text is coded as its class and its bytes (A-Z in lower case, one space after each word), then an end. A byte is coded
in the longest known context of up to ``ORDER`` bytes; escapes (method D) lead to shorter contexts, where symbols that a
longer one knows are excluded. Contexts run over the text (spaces stand before its start), or, without ``across``, go no
further back than their word's start. There is a trie for each class of texts, and a text's class (that whose byte
trigrams, as the language identifier learns them, suit its words best) is the first symbol of its code.

Texts are cut into chunks, in which words and events (a class, ``ORDER`` bytes and the next byte) become numbers. Words
meet in a shuffle, where they are counted; events meet, packed, by class and the last two bytes of their context, where
they are counted and scored. Totals and scores go back to the chunks. Nothing that grows with the corpus is broadcast or
passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm import langid
from vigil.llm.common import crc32_mod, lean, raw, shared_path, ship, table
from vigil.llm.tokens import runs

#: Bytes of context; with the symbol and the class they make one 64-bit number.
ORDER = 6
#: Bytes of text in a chunk, and words whose totals are sent back together.
CHUNK_BYTES = 20 << 20
CHUNK_WORDS = 3 << 17
#: Places whose events are numbered together, and events that are scored together (or those of one node, if more).
BLOCK = 1 << 20
#: Rows of a slice of an array that is exploded, and tasks whose chunks a word notes in one row.
SLICE = 1 << 14
PIECE = 4096
END = "\n"


def _slices(n: int) -> list[tuple[int, int]]:
    return [(lo, min(n, lo + SLICE)) for lo in range(0, n, SLICE)]


def _lists(values: pa.Array, cuts: list[tuple[int, int]]) -> pa.Array:
    """The slices of an array as lists."""
    return pa.ListArray.from_arrays(pa.array([0, *(hi for _, hi in cuts)], pa.int32()), values)


class _Numbers(dict):
    """Key -> number, in order of arrival."""

    def __missing__(self, key: bytes) -> int:
        at = self[key] = len(self)
        return at


def pack_numbers(x: np.ndarray) -> bytes:
    """32-bit numbers by bytes: all lowest ones first. Shuffles compress the high ones, mostly zeros, to nothing."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack_numbers(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel()


# -- events -------------------------------------------------------------------------------------------------------
def codes(text: np.ndarray, restart: np.ndarray, classes: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The event of each byte but the first ``order``: class, ``order`` bytes and the byte. Contexts hold spaces for
    what is before the last place marked in ``restart``."""
    k = len(text) - order
    code = (classes.astype(np.uint64) << np.uint64(56)) | text[order:]
    before = restart[order:].copy()
    for j in range(1, order + 1):
        code |= np.where(before, np.uint8(32), text[order - j:order - j + k]).astype(np.uint64) << np.uint64(8 * j)
        before |= restart[order - j:order - j + k]
    return code


def _tails(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes, a space after each but the end, and their sizes."""
    end = END.encode()
    tails = [w if w == end else w + b" " for w in words]
    return np.frombuffer(b"".join(tails), np.uint8), np.fromiter(map(len, tails), np.int64, len(tails))


def _marked(k: int, at: np.ndarray, order: int) -> np.ndarray:
    out = np.zeros(order + k, bool)
    out[order + at] = True
    return out


def events(words: list[bytes], classes: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Of each word by itself its events, and how many it has."""
    text, size = _tails(words)
    restart = _marked(len(text), np.cumsum(size) - size, order)
    return codes(np.concatenate([np.full(order, 32, np.uint8), text]), restart, np.repeat(classes, size), order), size


def _turned(code: np.ndarray) -> np.ndarray:
    """Class and the last two context bytes first, then the symbol: in this order events of a node are neighbours."""
    high, low = np.uint64(255 << 56), np.uint64(0xFFFFFF)
    return (code & high) | ((code & low) << np.uint64(32)) | ((code & ~high) >> np.uint64(24))


def _turned_back(key: np.ndarray) -> np.ndarray:
    high, low = np.uint64(255 << 56), np.uint64(0xFFFFFFFF)
    return (key & high) | ((key & low) << np.uint64(24)) | ((key & ~high) >> np.uint64(32))


def _blocks(words: tuple[np.ndarray, np.ndarray], tokens: np.ndarray, size: np.ndarray, cls: np.ndarray,
            across: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of texts (``size`` tokens each, numbers of ``words``) the turned events, in blocks, and the text of each."""
    data, long = words
    begin = np.cumsum(long) - long
    owner = np.repeat(np.arange(len(size), dtype=np.int32), size)
    starts = np.zeros(len(tokens), bool)  # tokens that contexts do not go back from
    starts[np.cumsum(size) - size] = True
    if not across:
        starts[:] = True
    ends, lo = np.cumsum(long[tokens]), 0
    tail, marks = np.full(ORDER, 32, np.uint8), np.zeros(ORDER, bool)
    while lo < len(tokens):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
        some = tokens[lo:hi]
        n = long[some]
        first = np.cumsum(n) - n
        k = int(n.sum())
        text = np.concatenate([tail, data[np.repeat(begin[some] - first, n) + np.arange(k)]])
        restart = _marked(k, first[starts[lo:hi]], ORDER)
        restart[:ORDER] = marks
        of = np.repeat(owner[lo:hi], n)
        yield _turned(codes(text, restart, cls[of])), of
        tail, marks, lo = text[-ORDER:], restart[-ORDER:], hi


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct events, in order, and their counts."""
    key = np.concatenate([k for k, _ in parts])
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    key = key[first]
    n = np.concatenate([n for _, n in parts])
    parts.clear()
    n = n[order]
    del order
    return key, np.add.reduceat(n, first) if len(first) else n


def _union(a: np.ndarray, b: list[np.ndarray]) -> np.ndarray:
    """The distinct numbers of arrays, in order; sorted in place, so that there is one copy at a time."""
    every = np.concatenate([a, *b])
    every.sort()
    return every[np.append(True, every[1:] != every[:-1])] if len(every) else every


# -- texts as chunks of numbered words and events -----------------------------------------------------------------
def word_evidence(model: langid.TextModel, words: list[bytes]) -> np.ndarray:
    """(words, classes): summed log probabilities of each word's byte trigrams, a space at both ends."""
    if not words:
        return np.zeros((0, model.log.shape[1]))
    size = np.fromiter(map(len, words), np.int64, len(words))
    b = np.frombuffer((b" " + b" ".join(words) + b" ").translate(langid.LETTERS), np.uint8).astype(np.uint32)
    first = np.cumsum(size + 1) - (size + 1)
    at = np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)
    code = langid.buckets((b[at] << 16) | (b[at + 1] << 8) | b[at + 2])
    out = np.zeros((len(words), model.log.shape[1]))
    start = np.cumsum(size) - size
    for lo, hi in _slices(len(words)):
        codes = code[start[lo]:start[hi] if hi < len(words) else None]
        out[lo:hi] = np.add.reduceat(model.log[codes], start[lo:hi] - start[lo], axis=0)
    return out


class _Chunk:
    """A chunk of texts being built: numbers of its words, its events and its rows."""

    def __init__(self, model: langid.TextModel, across: bool):
        self.model, self.prior, self.across = model, np.log(langid.prior(model.log.shape[1])), across
        self.number = _Numbers({END.encode(): 0})
        self.evidence = np.zeros((1, model.log.shape[1]))
        self.ids: list[pa.Array] = []
        self.held: list[np.ndarray] = []
        self.cls: list[np.ndarray] = []
        self.size: list[np.ndarray] = []
        self.tokens: list[np.ndarray] = []
        self.events: list[tuple[np.ndarray, np.ndarray]] = []
        self.bytes = 0

    def add(self, ids: pa.Array, texts: pa.Array, held: np.ndarray) -> None:
        parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        at = parts.offsets.to_numpy()
        coded = parts.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        known = len(self.number)
        distinct = list(raw(coded.dictionary))
        number = np.fromiter((self.number[w] if w else -1 for w in distinct), np.int64, len(distinct))
        new = list(self.number)[known:] if len(self.number) > known else []
        self.evidence = np.concatenate([self.evidence, word_evidence(self.model, new)])
        local = coded.indices.to_numpy()
        found = number[local]
        kept = np.concatenate([[0], np.cumsum(found >= 0)])[at - at[0]]  # the empty ones at a text's ends go
        tokens = np.insert(found[found >= 0], kept[1:], 0)  # an end after each text
        size = np.diff(kept) + 1
        sums = np.add.reduceat(self.evidence[tokens], np.cumsum(size) - size, axis=0)
        cls = (sums + self.prior).argmax(axis=1)
        self.ids.append(ids), self.held.append(held), self.size.append(size)
        self.cls.append(cls), self.tokens.append(tokens.astype(np.uint32))
        self.bytes += int(pc.sum(pc.binary_length(texts)).as_py() or 0)
        here = np.insert(local[found >= 0], kept[1:], len(distinct))
        for key, of in _blocks(_tails([*distinct, END.encode()]), here, size, cls, self.across):
            learn = ~held[of]
            self.events.append(np.unique(key[learn], return_counts=True))
            key = np.unique(key[~learn])
            self.events.append((key, np.zeros(len(key), np.int64)))
            if sum(len(k) for k, _ in self.events[1:]) > 2 * BLOCK:
                self.events = [_merged(self.events)]

    def batches(self, chunk: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        def rows(k: int, kind: int, **columns) -> pa.RecordBatch:
            columns |= {"chunk": np.full(k, chunk), "kind": np.full(k, kind, np.int32)}
            return pa.RecordBatch.from_arrays([
                pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array)
                else columns.get(f.name, pa.nulls(k, f.type)) for f in schema], schema=schema)

        held, cls, size = map(np.concatenate, (self.held, self.cls, self.size))
        tokens = np.concatenate(self.tokens)
        ids, k, n = pa.concat_arrays(self.ids), len(size), len(self.number)
        ends = np.cumsum(size)
        packed = [pack_numbers(tokens[a:b]) for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True)]
        yield rows(k, 0, doc_id=ids, held_out=held, cls=cls.astype(np.int32), tokens=packed)
        yield rows(1, 2, tokens=[b" ".join(self.number)])
        words = pa.array([w.decode("utf-8", "replace") for w in self.number], pa.string())
        counts = np.bincount(tokens[np.repeat(~held, size)], minlength=n).astype(np.int64)
        cuts = _slices(n)
        yield rows(len(cuts), 1, words=_lists(words, cuts), ids=_lists(pa.array(np.arange(n, dtype=np.int32)), cuts),
                   counts=_lists(pa.array(counts), cuts))
        key, count = _merged(self.events)
        pair, at = np.unique((key >> np.uint64(56) << np.uint64(16)) | ((key >> np.uint64(32)) & np.uint64(0xFFFF)), return_inverse=True)
        cuts = _slices(len(pair))
        sums = np.bincount(at, weights=count).astype(np.int64)
        yield rows(len(cuts), 4, ids=_lists(pa.array(pair.astype(np.int32)), cuts), counts=_lists(pa.array(sums), cuts))
        node = (key >> np.uint64(40)).astype(np.int32)
        first = np.flatnonzero(np.diff(node, prepend=-1))
        symbol, rest = ((key >> np.uint64(32)) & np.uint64(255)).astype(np.uint8), key.astype(np.uint32)
        for lo, hi in ((a, min(a + 1000, len(first))) for a in range(0, len(first), 1000)):
            cuts = list(zip(first[lo:hi].tolist(), [*first[lo + 1:hi].tolist(), int(first[hi]) if hi < len(first) else len(key)], strict=True))
            yield rows(hi - lo, 3, node=node[first[lo:hi]], first=first[lo:hi].astype(np.int32),
                       tokens=[symbol[a:b].tobytes() + pack_numbers(rest[a:b]) for a, b in cuts],
                       n=[pack_numbers(count[a:b]) for a, b in cuts])


def _encode_texts(docs: DataFrame, model: langid.TextModel, id_col: str, text_col: str, held_out: Column,
                  across: bool) -> DataFrame:
    """Written rows of five kinds. 0: each row's class and the numbers of its words in order. 1: a chunk's words with
    their numbers and training counts. 2: a chunk's words in order, as bytes. 3: a chunk's distinct events of a node (a
    class and two bytes), the number of the first, and their training counts. 4: training counts of (class, byte, byte).
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of bounded size
    schema = (f"doc_id {docs.schema[id_col].dataType.simpleString()}, chunk long, kind int, held_out boolean, cls int, "
              "tokens binary, words array<string>, ids array<int>, counts array<long>, node int, first int, n binary")
    kind = {"chunk": pa.int64(), "kind": pa.int32(), "held_out": pa.bool_(), "cls": pa.int32(), "tokens": pa.binary(),
            "words": pa.list_(pa.string()), "ids": pa.list_(pa.int32()), "counts": pa.list_(pa.int64()),
            "node": pa.int32(), "first": pa.int32(), "n": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        part, n, chunk, form = TaskContext.get().partitionId() << 32, 0, _Chunk(shared.value, across), None
        for b in batches:
            form = pa.schema([("doc_id", b.schema.field(0).type), *kind.items()])
            for first, k in runs(b.column(1)):
                chunk.add(b.column(0).slice(first, k), b.column(1).slice(first, k),
                          b.column(2).slice(first, k).to_numpy(zero_copy_only=False).astype(bool))
                if chunk.bytes >= CHUNK_BYTES:
                    yield from chunk.batches(part + n, form)
                    n, chunk = n + 1, _Chunk(shared.value, across)
        if chunk.ids:
            yield from chunk.batches(part + n, form)

    path = shared_path(docs.sparkSession, "ppm-texts")
    (docs.select(F.col(id_col), F.col(text_col), held_out).mapInArrow(run, schema)
     .write.option("compression", "zstd").partitionBy("kind").parquet(path))
    return docs.sparkSession.read.schema(schema).parquet(path)


def _count_words(texts: DataFrame) -> DataFrame:
    """(word, n, total, first, chunks, ids): training counts of words, and where they are.

    A word has a row for each ``PIECE`` tasks whose chunks hold it, so that lists stay short; ``total`` is its count in
    all, ``first`` marks one row of each word.
    """
    rows = texts.where("kind = 1").select("chunk", F.explode(F.arrays_zip("words", "ids", "counts")).alias("x"))
    rows = rows.select("x.words", "chunk", "x.ids", "x.counts").toDF("word", "chunk", "id", "n")
    piece = F.floor(F.shiftright("chunk", 32) / PIECE).cast("int").alias("piece")
    rows = rows.repartition("word").groupBy("word", piece).agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("chunk", "id")).alias("x"))
    word = Window.partitionBy("word")
    return rows.select("word", "n", F.sum("n").over(word).alias("total"),
                       (F.row_number().over(word.orderBy("piece")) == 1).alias("first"),
                       F.col("x.chunk").alias("chunks"), F.col("x.id").alias("ids"))


def _send_totals(vocabulary: DataFrame) -> DataFrame:
    """(chunk, ids, total), packed: the training count of each word that a chunk holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def close() -> list[pa.RecordBatch]:
            chunk, ids, total = map(np.concatenate, zip(*held, strict=True))
            return _packed(chunk, "chunk", {"ids": ids, "total": total})

        for b in batches:
            size = np.diff(b.column(1).offsets.to_numpy())
            held.append((b.column(1).flatten().to_numpy(), b.column(2).flatten().to_numpy(),
                         np.repeat(b.column(0).to_numpy(), size)))
            rows += len(held[-1][0])
            if rows >= CHUNK_WORDS:
                yield from close()
                held, rows = [], 0
        if rows:
            yield from close()

    return vocabulary.select("total", "chunks", "ids").mapInArrow(run, "chunk long, ids binary, total binary")


# -- the tries ----------------------------------------------------------------------------------------------------
def log_probabilities(event: np.ndarray, count: np.ndarray, low: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log10 of each distinct event's probability.

    event, count: all events of some (class, last two context bytes), those with count 0 included. low: counts
    (class, byte before, byte) of all events.
    """
    event = event.astype(np.uint64)
    cls = (event >> np.uint64(56)).astype(np.int64)
    sym, before = (event & np.uint64(255)).astype(np.int64), ((event >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
    out, done = np.zeros(len(event)), np.zeros(len(event), bool)
    less, kinds = np.zeros(len(event)), np.zeros(len(event))  # excluded counts and symbols

    def step(c: np.ndarray, n: np.ndarray, q: np.ndarray) -> None:
        nonlocal done
        n, q = n - less, q - kinds
        hit = ~done & (c > 0)
        out[hit] += np.log10((2 * c[hit] - 1) / (2 * n[hit]))
        done |= hit
        escape = ~done & (q > 0)
        out[escape] += np.log10(q[escape] / (2 * n[escape]))

    def cells(j: int):
        """Of order j: the number of each event's cell, cells' counts, the node of each cell and nodes' sums."""
        mask = np.uint64((255 << 56) | ((1 << (8 * (j + 1))) - 1))
        cell, at = np.unique(event & mask, return_inverse=True)
        c = np.bincount(at, weights=count)
        node = np.unique(cell >> np.uint64(8), return_inverse=True)[1]
        return at, c, node, np.bincount(node, weights=c), np.bincount(node, weights=c > 0)

    low0 = low.sum(axis=1)
    upper = cells(order) if order >= 2 else None
    for j in range(order, 1, -1):
        at, c, node, n, q = upper
        step(c[at], n[node][at], q[node][at])
        first = np.zeros(len(c), np.int64)  # an event of each cell
        first[at] = np.arange(len(at))
        if j > 2:
            upper = cells(j - 1)
            under = upper[1][upper[0][first]]
        else:
            under = low[cls[first], before[first], sym[first]].astype(float)
        excluded = np.bincount(node, weights=under * (c > 0))
        less, kinds = excluded[node][at], q[node][at]
    if order >= 1:
        step(low[cls, before, sym].astype(float), low.sum(axis=2)[cls, before].astype(float),
             (low > 0).sum(axis=2)[cls, before].astype(float))
        known = low > 0
        less = (known * low0[:, None, :]).sum(axis=2)[cls, before].astype(float)
        kinds = known.sum(axis=2)[cls, before].astype(float)
    step(low0[cls, sym].astype(float), low0.sum(axis=1)[cls].astype(float), (low0 > 0).sum(axis=1)[cls].astype(float))
    unseen = 256 - (low0 > 0).sum(axis=1)[cls]
    out[~done] -= np.log10(unseen[~done])
    return out


def _packed(key: np.ndarray, name: str, columns: dict[str, np.ndarray]) -> list[pa.RecordBatch]:
    """Rows as one row per key, each column's values as bytes: few rows to shuffle, and small ones."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1)) if len(key) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(key))
    arrays = [pa.array(key[first])]
    for c in columns.values():
        c = c[order]
        arrays.append(pa.array([c[a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist(), strict=True)], pa.binary()))
    return [pa.RecordBatch.from_arrays(arrays, names=[name, *columns])] if len(first) else []


def _unpacked(rows: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(raw(rows.column(name))), kind)


def _score_events(texts: DataFrame, classes: int) -> DataFrame:
    """(chunk, first, logp), packed: log10 probabilities of a chunk's events from number ``first`` on. Events meet by
    class and the last two bytes of their context; what shorter contexts hold is a table of at most 65,536 counts a
    class, which every task gets."""
    low = np.zeros((classes, 256, 256), np.int64)
    pairs = texts.where("kind = 4").select(F.explode(F.arrays_zip("ids", "counts")).alias("x"))
    for r in pairs.groupBy(F.col("x.ids").alias("pair")).agg(F.sum("x.counts").alias("n")).where("n > 0").collect():
        low[r["pair"] >> 16, r["pair"] >> 8 & 255, r["pair"] & 255] = r["n"]
    shared = texts.sparkSession.sparkContext.broadcast(low)

    def scored(rows: list[tuple]) -> pa.RecordBatch:
        size = [len(n) // 4 for *_, n in rows]
        node = np.repeat(np.array([x[2] for x in rows], np.uint64), size) << np.uint64(40)
        symbol = np.concatenate([np.frombuffer(x[3], np.uint8)[:k] for x, k in zip(rows, size, strict=True)])
        rest = np.concatenate([unpack_numbers(memoryview(x[3])[k:]) for x, k in zip(rows, size, strict=True)])
        key = node | (symbol.astype(np.uint64) << np.uint64(32)) | rest
        del node, symbol, rest
        key, at = np.unique(key, return_inverse=True)
        n = np.bincount(at, weights=np.concatenate([unpack_numbers(x[4]) for x in rows])).astype(np.int64)
        logp, ends = log_probabilities(_turned_back(key), n, shared.value).astype("<f4")[at], np.cumsum(size)
        return pa.RecordBatch.from_arrays([
            pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int32()),
            pa.array([pack_numbers(logp[b - k:b].view("<u4")) for k, b in zip(size, ends.tolist(), strict=True)], pa.binary())],
            names=["chunk", "first", "logp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        rows, some = [], 0  # whole nodes
        for b in batches:
            for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), raw(b.column(3)),
                         raw(b.column(4)), strict=True):
                if some >= BLOCK // 4 and x[2] != rows[-1][2]:
                    yield scored(rows)
                    rows, some = [], 0
                rows.append(x)
                some += len(x[4]) // 4
        if rows:
            yield scored(rows)

    dealt = texts.where("kind = 3").select("chunk", "first", "node", "tokens", "n").repartition("node")
    return dealt.sortWithinPartitions("node").mapInArrow(run, "chunk long, first int, logp binary")


# -- documents ----------------------------------------------------------------------------------------------------
def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          model: langid.TextModel | None = None, across: bool = False) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    ``held_out``: a column that is true for rows not to learn from (null: learn). The classes come from ``model``, by
    default the language identifier's text model of the rows learned from. ``across``: contexts run over the text, not
    only their word. n_tokens counts words and the end. base_score is the add-one word model's log10 probability, score
    that of the tries. Null and empty texts are an end alone. Repeated rows and rows without an id keep a row each.
    Other columns are ignored. An empty table gives no row.
    """
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    if model is None:
        model = langid.fit(docs.where(~held), id_col=id_col, text_col=text_col, lang_col=lang_col)
    classes = model.log.shape[1]
    texts = _encode_texts(docs, model, id_col, text_col, held, across)
    vocabulary = table(_count_words(texts), "vocabulary")
    sums = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                          F.count_if(F.col("first") & (F.col("total") > 0)).alias("v")).first()
    # V counts the end, which is one of the words.
    tokens, rest = int(sums["n"]), float(np.log10(sums["n"] + max(1, sums["v"]) + 1))
    ends = np.zeros(classes)
    for r in texts.where("kind = 0 and not held_out").groupBy("cls").count().collect():
        ends[r["cls"]] = r["count"]
    prior = np.log10((ends + 1) / (ends.sum() + classes))

    def run(rows: pa.Table, scores: pa.Table) -> pa.Table:
        # A chunk's events are millions: each array goes as soon as the next one is made.
        lean()
        kind = rows.column("kind").to_numpy()
        words = next(raw(rows.filter(pa.array(kind == 2)).column("tokens"))).split(b" ")
        rows = rows.filter(pa.array(kind == 0))
        k, n = rows.num_rows, len(words)
        ids, is_held, cls = rows.column("doc_id"), rows.column("held_out"), rows.column("cls").to_numpy()
        size = pc.binary_length(rows.column("tokens")).to_numpy().astype(np.int64) // 4
        first = np.cumsum(size) - size
        found = np.empty(int(size.sum()), np.uint32)
        for a, m, b in zip(first.tolist(), size.tolist(), raw(rows.column("tokens")), strict=True):
            found[a:a + m] = unpack_numbers(b)
        del rows
        kind = scores.column("first").is_null()
        totals = scores.filter(kind)
        at, total = _unpacked(totals, "ids", "<i4"), _unpacked(totals, "total", "<i8")
        base, seen = np.zeros(n), np.zeros(n, bool)
        base[at], seen[at] = np.log10(total + 1) - rest, total > 0
        del totals, at, total
        scored = scores.select(["first", "logp"]).filter(pc.invert(kind))
        del scores
        scored = scored.sort_by("first")  # in the order of the chunk's events
        logp = np.empty(int(pc.sum(pc.binary_length(scored.column("logp"))).as_py() or 0) // 4, "<f4")
        a = 0
        for b in raw(scored.column("logp")):
            logp[a:a + len(b) // 4] = unpack_numbers(b).view("<f4")
            a += len(b) // 4
        del scored
        blocks, every, more = [], np.zeros(0, np.uint64), []
        for key, of in _blocks(_tails(words), found, size, cls, across):
            cuts = np.flatnonzero(np.diff(of, prepend=-1))
            key, at = np.unique(key, return_inverse=True)
            blocks.append((key, at.astype(np.int32), cuts, of[cuts]))
            more.append(key)
            if len(more) == 4:
                every, more = _union(every, more), []
        every, p = _union(every, more), np.zeros(k)
        while blocks:
            key, at, cuts, of = blocks.pop()
            p[of] += np.add.reduceat(logp[np.searchsorted(every, key)].astype(float)[at], cuts)
        return pa.table({
            "doc_id": ids, "held_out": is_held, "n_tokens": pa.array(size),
            "n_known": pa.array(np.add.reduceat(seen[found].astype(np.int64), first)),
            "train_tokens": pa.array(np.full(k, tokens)), "base_score": pa.array(np.add.reduceat(base[found], first)),
            "score": pa.array(p + prior[cls])})

    rows = texts.where("kind in (0, 2)").select("chunk", "kind", "doc_id", "held_out", "cls", "tokens")
    scores = _score_events(texts, classes).unionByName(_send_totals(vocabulary), allowMissingColumns=True)
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.groupBy("chunk").cogroup(scores.groupBy("chunk")).applyInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
             "score double")


def held_out(id_col: str = "doc_id") -> Column:
    """True for ids whose crc32 as text is 2 modulo 7."""
    return crc32_mod(id_col, 7) == 2
