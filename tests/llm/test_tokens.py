import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_cases import ODD
from vigil.llm import packing, token_files, tokens
from vigil.llm.common import shared_path
from vigil.llm.queries import tokenizer_path

PATH = tokenizer_path()
TEXTS = ["", " ", "The quick, brown FOX.", "don't we'll 's x's.", "École naïve STRASSE straße", "é café ́x",
         "a b c　d", "\u0001 x\u0001y \x1c\x1d z", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "<|", "12 345 6a7",
         "#$%& and&&& $$$ ...!? -- x-y", "你好 世界 한국어 \U0001f600", "İIıi K µ ª ÷ ×", "x" * 3000, "a.b.c,d",
         "tab\tnew\nline\r\nff\x0cvt\x0bend", "word's word's, 'tis (that) [x] {y} ~z~ `w` ^v^ u_v"]


def ids(text):
    t = ids.tokenizer = getattr(ids, "tokenizer", None) or Tokenizer.from_file(PATH)
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_encoder_gives_the_library_s_ids(docs):
    texts = TEXTS + [r.text for r in docs.collect()]
    e = tokens.Encoder(PATH)
    for lot in (texts, texts[::-1], TEXTS[:1]):
        got, n = e.encode(pa.array(lot, pa.string()))
        assert n.tolist() == [len(ids(t)) for t in lot]
        assert got.tolist() == [i for t in lot for i in ids(t)]


@pytest.mark.parametrize("text", TEXTS)
def test_encoder_on_one_text(text):
    got, n = tokens.Encoder(PATH).encode(pa.array([text, None]))
    assert (got.tolist(), n.tolist()) == (ids(text) + [1], [len(ids(text)), 1])


def expected_files(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for d, t in rows:
        out.append((str(d), start, len(ids(t)), crc(ids(t))))
        start += len(ids(t))
    return out


def test_token_files_round_trip(spark, docs):
    path = shared_path(spark, "test-files")
    token_files.write(docs, path, PATH)
    got = [(str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in token_files.digests(token_files.read(spark, path)).collect()]
    assert sorted(got) == sorted(expected_files([(r.doc_id, r.text) for r in docs.collect()]))
    meta = token_files.metadata(spark, path)
    assert "ids" not in meta.columns
    assert sorted((str(r.doc_id), r.start, r.n_tokens) for r in meta.collect()) == sorted(x[:3] for x in got)
    some = token_files.read(spark, path, 20, 29)
    assert sorted(r.doc_id for r in some.collect()) == list(range(20, 30))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = token_files.read(spark, path, 20, 29)._jdf.queryExecution().executedPlan().toString()
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert any("GreaterThanOrEqual(doc_id,20)" in x and "LessThanOrEqual(doc_id,29)" in x for x in pushed), pushed


def test_token_files_odd_rows(spark, make):
    path = shared_path(spark, "test-files")
    token_files.write(make(ODD).withColumn("ids", F.lit("clash")), path, PATH)
    got = [(str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in token_files.digests(token_files.read(spark, path)).collect()]
    assert sorted(got) == sorted(expected_files(ODD))
    path = shared_path(spark, "test-files")
    token_files.write(make([]), path, PATH)
    assert token_files.digests(token_files.read(spark, path)).count() == 0


def check_packing(rows, found, capacity):
    of = {}
    for d, t in rows:
        of.setdefault(str(d), []).append(ids(t))
    pieces = sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found)
    expected = sorted((d, p, p * capacity, len(x[p * capacity:(p + 1) * capacity]), crc(x[p * capacity:(p + 1) * capacity]))
                      for d, lists in of.items() for x in lists for p in range(-(-len(x) // capacity)))
    assert pieces == expected
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in sequences.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(len(x) for lists in of.values() for x in lists) // capacity)


def test_packing(docs):
    found = packing.pack_documents(docs, PATH).collect()
    used, least = check_packing([(r.doc_id, r.text) for r in docs.collect()], found, 4096)
    assert used <= least + 1


def test_packing_odd_rows(make):
    found = packing.pack_documents(make(ODD).withColumn("offset", F.lit(1)), PATH, capacity=512, group=4).collect()
    check_packing(ODD, found, 512)
    assert packing.pack_documents(make([]), PATH).count() == 0


def test_pieces_carry_their_ids(make):
    got = packing.pieces(make([(1, "one two three four five"), (2, None)]), PATH, capacity=4, with_ids=True).collect()
    assert [list(r.ids) for r in sorted(got, key=lambda r: (r.doc_id, r.piece))] == [
        ids("one two three four five")[:4], ids("one two three four five")[4:], [1]]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    rng = np.random.default_rng(3)
    length = rng.integers(1, 400, 3000)
    caps = (1000, 5, 400_000)
    sequence, offset = packing.best_fit(length, caps, rule=rule)
    for s in range(sequence.max() + 1):
        x = length[sequence == s]
        assert len(x) and x.sum() <= caps[0] and len(x) <= caps[1] and (x.astype(float) ** 2).sum() <= caps[2]
        assert np.array_equal(np.sort(offset[sequence == s]), np.sort(np.cumsum(x[np.argsort(offset[sequence == s])]) - x[np.argsort(offset[sequence == s])]))
    with pytest.raises(ValueError):
        packing.best_fit(np.array([1001]), caps)
