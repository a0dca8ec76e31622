"""Token ids of whole texts with a published tokenizer file, as Arrow kernels.

The tokenizer drops white space, so a text's ids are those of its white-space separated chunks in turn. A worker
remembers the ids of chunks it has met; only new chunks go through the tokenizers library, many in one call.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vigil.llm.common import raw

#: Stands between chunks in a call: a piece of its own for the tokenizer. Chunks that hold it go one by one.
_MARK = "\x01"
#: Chunks and their bytes remembered by a worker; beyond that it starts anew.
_REMEMBER = 1 << 19
_REMEMBER_BYTES = 64 << 20
#: Bytes of text encoded together.
_AT_ONCE = 2 << 20


_LATIN = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
#: A word of Latin letters that no normal form changes: one piece for the tokenizer.
_WORD = re.compile(f"[{_LATIN}]+").fullmatch
#: Such a word, and ASCII marks after it (another piece), apart from the apostrophe: some endings go with theirs.
_MARKED = f"^(?P<word>[{_LATIN}]+)(?P<marks>[!-&(-/:-@\\[-`{{-~]+)$"


class _Chunks(dict):
    """Chunk -> position in the id table; a new chunk gets the next position and is noted as new."""

    def __init__(self, end: bytes):
        super().__init__({end: 0})
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        at = self[chunk] = len(self)
        self.new.append(chunk)
        return at


class Encoder:
    """Encodes texts as tokenizers does with ``add_special_tokens=False``, then appends ``end_id`` to each."""

    def __init__(self, path: str, end_id: int = 1):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.end_id = end_id
        spec = json.loads(self.tokenizer.to_str())
        # The same model for words that are pieces already: no normal form, no pattern.
        self.model = Tokenizer.from_str(json.dumps(spec | {
            "normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
                {"type": "WhitespaceSplit"},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}))
        suffix = spec["model"].get("end_of_word_suffix") or ""
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        # Words can be told apart in a joined call only where each ends with its one word-end token.
        self.quick = bool(suffix)
        text = "the quick b\u00e9te na\u00efve stra\u00dfe zzyzx o"
        whole = self.tokenizer.encode(text, add_special_tokens=False).ids
        self.quick = self.quick and self._words(text.split())[0].tolist() == whole
        self.forget()

    def forget(self) -> None:
        self.chunks = _Chunks(b" ")  # no chunk holds a space: stands for the end of a text
        self.bytes = 0
        self.flat = np.array([self.end_id], np.int32)
        self.start, self.size = np.array([0], np.int64), np.array([1], np.int64)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words, and how many each has."""
        ids = np.array(self.model.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int32)
        return ids, np.diff(np.flatnonzero(self.ends[ids]) + 1, prepend=0)

    def _others(self, chunks: list[str]) -> list[np.ndarray]:
        """The ids of any chunks, each."""
        plain = [c for c in chunks if _MARK not in c] if self.mark is not None else []
        found: list[np.ndarray] = []
        if plain:
            joined = f" {_MARK} ".join(plain)
            ids = np.array(self.tokenizer.encode_batch([joined], add_special_tokens=False)[0].ids, np.int32)
            found = np.split(ids, np.flatnonzero(ids == self.mark))
            found = [found[0], *(x[1:] for x in found[1:])]
        if len(found) == len(chunks):
            return found
        if len(found) != len(plain):  # cannot be told apart by the mark
            plain, found = [], []
        rest = iter([np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch(
            [c for c in chunks if not plain or _MARK in c], add_special_tokens=False)])
        quick = iter(found)
        return [next(rest) if not plain or _MARK in c else next(quick) for c in chunks]

    def _learn(self) -> None:
        """Encode the new chunks and note where the ids of each are."""
        new, self.chunks.new = self.chunks.new, []
        if not new:
            return
        self.bytes += sum(map(len, new))
        texts = [c.decode("utf-8", "replace") for c in new]
        is_word = np.array([self.quick and _WORD(c) is not None for c in texts], bool)
        start, size = np.empty(len(new), np.int64), np.empty(len(new), np.int64)
        ids, words = np.zeros(0, np.int32), [c.lower() for c in compress(texts, is_word)]
        if words:
            ids, own = self._words(words)
            start[is_word], size[is_word] = len(self.flat) + np.cumsum(own) - own, own
        others = self._others(list(compress(texts, ~is_word)))
        lens = np.array([len(x) for x in others], np.int64)
        start[~is_word], size[~is_word] = len(self.flat) + len(ids) + np.cumsum(lens) - lens, lens
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, ids, *others])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts in one array, and the number of ids of each text (its end included)."""
        if len(self.chunks) > _REMEMBER or self.bytes > _REMEMBER_BYTES:
            self.forget()
        texts = pc.fill_null(texts, "")
        # Lower case is the same to the tokenizer, but for its special strings, all of which hold "<|".
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)
        parts = pc.ascii_split_whitespace(texts)
        at = parts.offsets.to_numpy()
        coded = parts.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        # Distinct chunks of these texts, taken apart into a word and its marks where there are any.
        marked = pc.extract_regex(coded.dictionary, _MARKED)
        word, word_at = self._positions(pc.coalesce(pc.struct_field(marked, "word"), coded.dictionary))
        mark, mark_at = self._positions(pc.coalesce(pc.struct_field(marked, "marks"), pa.scalar("")))
        self._learn()
        parts = np.stack([word[word_at], mark[mark_at]], axis=1).ravel()
        flat, lens = self._gather(parts)
        lens = lens[::2] + lens[1::2]
        # A last one stands for the end of a text.
        flat, lens = np.append(flat, self.end_id).astype(np.int32), np.append(lens, 1)
        index = np.insert(coded.indices.to_numpy(), at[1:] - at[0], len(lens) - 1)
        ids, sizes = _take(flat, np.cumsum(lens) - lens, lens, index)
        return ids, np.add.reduceat(sizes, at[:-1] - at[0] + np.arange(len(texts)))

    def _positions(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of distinct chunks, and which of them each chunk is. New ones are noted."""
        if isinstance(chunks, pa.ChunkedArray):
            chunks = chunks.combine_chunks()
        coded = chunks.dictionary_encode()
        distinct = list(raw(coded.dictionary))
        return np.fromiter(map(self.chunks.__getitem__, distinct), np.int64, len(distinct)), coded.indices.to_numpy()

    def _gather(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _take(self.flat, self.start, self.size, chunks)


def _take(flat: np.ndarray, start: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that ``index`` names, one after the other, and their lengths."""
    lens = size[index]
    before = np.cumsum(lens) - lens
    return flat[np.repeat(start[index] - before, lens) + np.arange(int(lens.sum()))], lens


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


def runs(column: pa.Array, at_once: int = _AT_ONCE) -> Iterator[tuple[int, int]]:
    """(first, rows) of runs of a column's texts, each of about ``at_once`` bytes."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(size):
        before = size[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(size, before + at_once)))
        yield first, end - first
        first = end


def groups(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of a column's texts, each with the position of its first."""
    for first, n in runs(column):
        yield first, list(raw(column.slice(first, n)))


def encoded(batches: Iterator[pa.RecordBatch], path: str,
            end_id: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids of the rows, token ids, tokens of each row) for runs of rows (row id, text)."""
    e = encoder(path, end_id)
    for b in batches:
        for first, k in runs(b.column(1)):
            ids, n = e.encode(b.column(1).slice(first, k))
            yield b.column(0).slice(first, k), ids, n


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
