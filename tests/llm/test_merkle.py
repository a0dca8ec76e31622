import hashlib
import zlib

from llm_cases import ODD
from pyspark.sql import functions as F

from vigil.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(*map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def climb(nodes):
    """(top, siblings of each node as (before, after) of each step)."""
    steps, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            lo = at // 16 * 16
            steps[i].append(("".join(nodes[lo:at]), "".join(nodes[at + 1:lo + 16])))
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        where = [at // 16 for at in where]
    return nodes[0], steps


def plain(rows):
    """{(doc_id, leaf): [(subroot, root, proof, folded root, verified)]} of documents, one process, level by level."""
    sources = {}
    for r in rows:
        sources.setdefault((r["source"] is not None, (r["source"] or "").encode()), []).append(r)
    tops, below = [], []
    for key in sorted(sources):
        own = sorted(sources[key], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        top, steps = climb([leaf(r, r["text"]) for r in own])
        tops.append(top)
        below.append((own, steps))
    if not tops:
        return {}
    root, upper = climb(tops)
    out = {}
    for top, (own, steps), more in zip(tops, below, upper, strict=True):
        for r, mine in zip(own, steps, strict=True):
            path = mine + more
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            text = r["text"]
            if hit and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for before, after in path:
                node = h(before, node, after)
            out.setdefault((r["doc_id"], leaf(r, r["text"])), []).append(
                (top, root, h(*[b + a for b, a in path]), node, node == root))
    return out


def check(frame):
    want = plain([r.asDict() for r in frame.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    found = merkle.manifest(frame)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = {}
    for r in found.collect():
        got.setdefault((r.doc_id, r.leaf), []).append(tuple(r)[2:])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    return found


def test_sizes_around_the_arity_and_the_block(spark, make):
    sizes = [1, 2, 15, 16, 17, 255, 256, 257, 4097 - 256]
    frame = spark.range(sum(sizes)).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text Ä of row "), F.col("id")).alias("text"), F.lit("en").alias("lang"),
        F.expr("case " + " ".join(f"when id < {sum(sizes[:i + 1])} then 'src{i}'" for i in range(len(sizes))) + " end")
        .alias("source"), F.lit(7).cast("long").alias("n_chars"))
    found = check(frame.repartition(11))
    changed = found.where("not verified").count()
    # Every text holds a capital, so that each tampered row, and no other, fails.
    assert changed == frame.where("crc32(cast(doc_id as string)) % 5 = 0").count()


def test_many_sources_null_sources_and_ids_repeats_and_clashing_columns(spark, make):
    rows = [(i % 400, f"T {i % 150}", "de", f"s{i % 300}" if i % 7 else None, None) for i in range(900)]
    rows += [(None, "A", None, "é", 1)] * 5 + [(3, "Same", "en", "z", 4)] * 40 + [(3, None, "en", "z", 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("key", "pos", "n", "digest", "block", "kids", "path", "leaf", "changed", "_part", "_salt"):
        frame = frame.withColumn(name, F.lit(1))
    check(frame.repartition(5))


def test_odd_rows_and_an_empty_table(make):
    check(make(ODD))
    assert merkle.manifest(make([])).count() == 0


def test_a_version_copies_only_the_ancestors_of_its_leaf(make):
    docs = make([(i, f"Row {i}") for i in range(300)])
    found = {r.doc_id: r for r in merkle.versions(docs, F.col("doc_id") == 7, F.lit("changed")).collect()}
    seven, others = found[7], [r for i, r in found.items() if i != 7]
    # 300 leaves, 19 runs, 2 nodes, the subroot, which is the root of a single source.
    assert len(seven.copies) == 4 and seven.copies[0] != seven.leaf and seven.copies[-1] != seven.root
    assert all(r.copies[0] == r.leaf and r.copies[-1] == r.root for r in others)
    shared = set(found[6].copies[1:]) & set(found[8].copies[1:])
    assert not shared & set(seven.copies) and found[8].path[0].before.count(found[7].leaf) == 1
