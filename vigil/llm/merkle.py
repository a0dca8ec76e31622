"""Merkle manifest of a dataset as a persistent, path-copying tree.

Rows become leaves; per source the leaves, ordered by id, are folded ``ARITY`` at a time to a subroot, and the subroots,
ordered by source, to the root. Leaves get their places by range partitions and prefix sums over them, so no source is
ever in one task. The tree is kept as aligned blocks of ``BLOCK`` nodes, two levels each: a block's row holds its nodes
and the digests between them and its top; the tops are the nodes of the next tier of blocks, as long as any source has
more than one. A changed leaf makes a version of the tree that shares all nodes but the leaf's ancestors: a block gives
its part of the path, joined from above by the block's own path in the next tier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.llm.common import crc32_mod, table

ARITY = 16
#: Nodes of an aligned block: two levels.
BLOCK = ARITY * ARITY
#: The columns that a leaf covers, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Path of a node without ancestors.
_NO_PATH = "cast(array() as array<struct<before: string, after: string>>)"


def encoded(col: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts together."""
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, changed: Column, changed_text: Column) -> DataFrame:
    """(key, source, doc_id, leaf, changed): a leaf of each row, and of the row with ``changed_text`` where ``changed``.

    ``key`` orders sources, null first, and is never null.
    """
    def leaf(text: Column) -> Column:
        return digest(*[encoded(text if c == "text" else F.col(c)) for c in COLUMNS])

    key = F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("source").cast("string")))
    return docs.select(key.alias("key"), "source", "doc_id", leaf(F.col("text")).alias("leaf"),
                       F.when(changed, leaf(changed_text)).alias("changed"))


def placed(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, the place from 0 among the rows of a key by ``order``, and ``n``, their number.

    A key with any share of the rows, equal rows included, is cut over range partitions; places are those in the
    partition's part of the key after the counts of the parts before. Rows equal in ``order`` get either's place.
    """
    order = [c for c in order if c != key]
    salted = rows.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    # The written partition number fixes the cut: everything after reads it.
    dealt = table(salted.repartitionByRange(key, *order, "_salt").withColumn("_part", F.spark_partition_id()), name)
    counts = dealt.groupBy(key, "_part").agg(F.count("*").alias("_n"))
    over = Window.partitionBy(key)
    # One row for each part of a key: at most as many as there are partitions.
    parts = counts.select(
        F.col(key).alias("_key"), F.col("_part").alias("_of"), F.sum("_n").over(over).alias("n"),
        (F.sum("_n").over(over.orderBy("_part")) - F.col("_n")).alias("_before"))
    within = Window.partitionBy(key, "_part").orderBy(*order, "_salt")
    ranked = dealt.withColumn("_row", F.row_number().over(within) - 1)
    return (ranked.join(parts, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_of")))
            .withColumn("pos", F.col("_before") + F.col("_row"))
            .drop("_key", "_of", "_before", "_row", "_part", "_salt"))


def blocks(nodes: DataFrame, carried: list[str], name: str) -> DataFrame:
    """(key, n, block, kids, digests, middle, top) of nodes (key, n, pos, digest and ``carried``): a tier of the tree.

    ``middle`` holds the digests of the runs of ``ARITY`` nodes. A key with one node has it as its top; one with at
    most ``ARITY`` nodes has the run's digest.
    """
    rows = nodes.groupBy("key", "n", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", *carried))).alias("kids"))
    rows = rows.select("*", F.col("kids.digest").alias("digests"))
    runs = F.expr(f"transform(sequence(0, (size(digests) - 1) div {ARITY}), "
                  f"i -> sha2(array_join(slice(digests, i * {ARITY} + 1, {ARITY}), ''), 256))")
    rows = rows.withColumn("middle", F.when(F.col("n") > 1, runs).otherwise(F.col("digests")))
    top = (F.when(F.col("n") > ARITY, F.sha2(F.array_join("middle", ""), 256)).otherwise(F.col("middle")[0]))
    return table(rows.withColumn("top", top), name)


def tiers(nodes: DataFrame, carried: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """All tiers of blocks above ``nodes``, the lowest first, and (key, top) of each key."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    out, kept = [], carried
    while True:
        out.append(blocks(nodes, kept, f"{name}-{len(out)}"))
        if most <= BLOCK:
            return out, out[-1].select("key", "top")
        most, kept = -(-most // BLOCK), []
        nodes = out[-1].select("key", F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("block").alias("pos"),
                               F.col("top").alias("digest"))


def _own_path() -> str:
    """The steps (before, after) of the kid at place ``i`` of a block up to the block's top, as SQL."""
    def step(among: str, lo: str, at: str, hi: str) -> str:
        return (f"named_struct('before', array_join(slice({among}, {lo} + 1, {at} - {lo}), ''), "
                f"'after', array_join(slice({among}, {at} + 2, {hi} - {at} - 1), ''))")

    run = f"cast(i div {ARITY} as int)"
    first = step("digests", f"{run} * {ARITY}", "i", f"least(size(digests), {run} * {ARITY} + {ARITY})")
    second = step("middle", "0", run, "size(middle)")
    return f"case when n <= 1 then {_NO_PATH} when n <= {ARITY} then array({first}) else array({first}, {second}) end"


def paths(tier: DataFrame, above: DataFrame, carried: list[str]) -> DataFrame:
    """(key, pos, digest, ``carried``, path, ...) of the nodes in a tier's blocks: their siblings up to the root.

    ``above``: (key, block, path, ...), one row for each block; its further columns go to all nodes of the block.
    """
    rest = [c for c in above.columns if c not in ("key", "block", "path")]
    kid = ", ".join(f"'{c}', k.{c}" for c in ("pos", "digest", *carried))
    kids = F.expr(f"transform(kids, (k, i) -> named_struct({kid}, 'path', concat({_own_path()}, path)))")
    joined = tier.drop("top").join(above, ["key", "block"])
    return joined.select("key", *rest, F.inline(kids))


def _down(levels: list[DataFrame], above: DataFrame, carried: list[str]) -> DataFrame:
    for i in reversed(range(len(levels))):
        found = paths(levels[i], above, carried if i == 0 else [])
        above = found.drop("digest").withColumnRenamed("pos", "block")
    return found


def versions(docs: DataFrame, changed: Column, changed_text: Column) -> DataFrame:
    """(source, doc_id, leaf, subroot, root, path, copies) per row of ``docs``.

    leaf, subroot, root: of the tree as it is. path: the siblings, as text before and after the own node, of each step
    from the leaf up to the root. copies: the nodes that the row's version of the tree does not share with it, the leaf
    first, the version's root last; the leaf is that of ``changed_text`` where ``changed`` holds, and the own one, with
    copies equal to the shared nodes, elsewhere.

    Nulls are covered as such; rows without an id come first in their source, rows without a source before all others.
    Rows that share an id are ordered by their leaves, equal rows are leaves of their own. Other columns are ignored,
    whatever their names. An empty table has no row.
    """
    rows = table(leaves(docs, changed, changed_text), "leaves")
    nodes = placed(rows, "key", ["doc_id", "leaf"], "places").withColumnRenamed("leaf", "digest")
    mine = ["source", "doc_id", "changed"]
    below, subroots = tiers(nodes.withColumn("n", F.col("n").cast("long")), mine, "blocks")
    # Sources may be many too: they are placed like rows.
    tops = placed(subroots.select(F.lit("").alias("all"), F.col("key").alias("of"), "top"), "all", ["of"], "subroots")
    upper, root = tiers(tops.select(F.col("all").alias("key"), "n", "pos", F.col("top").alias("digest"), "of"),
                        ["of"], "upper")
    start = root.select("key", F.lit(0).cast("long").alias("block"), F.col("top").alias("root"),
                        F.expr(_NO_PATH).alias("path"))
    above = _down(upper, start, ["of"]).select(
        F.col("of").alias("key"), F.lit(0).cast("long").alias("block"), "root", F.col("digest").alias("subroot"), "path")
    found = _down(below, table(above, "above"), mine)
    step = "sha2(concat(p.before, element_at(c, -1), p.after), 256)"
    copies = F.expr(f"aggregate(path, array(coalesce(changed, digest)), (c, p) -> concat(c, array({step})))")
    return found.select("source", "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path",
                        copies.alias("copies"))


def tampered(id_col: str = "doc_id") -> Column:
    """Whether 5 divides the crc32 of the id's decimal text; false for a null id."""
    return F.coalesce(crc32_mod(id_col, 5) == 0, F.lit(False))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``.

    The rows of ``tampered`` have the A-Z of their text lower-cased in their version; see ``versions`` for odd rows.
    """
    found = versions(docs, tampered(), F.translate("text", UPPER, UPPER.lower()))
    siblings = F.expr("array_join(transform(path, p -> concat(p.before, p.after)), '')")
    rows = found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                        F.element_at("copies", -1).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle(leaf_levels: int = 6, source_levels: int = 3) -> str:
    """The manifest in DuckDB's SQL, level by level; so many levels hold 16 ** 6 rows a source and 16 ** 3 sources."""
    def enc(e: str) -> str:
        v = f"CAST({e} AS VARCHAR)"
        return f"coalesce(strlen({v}) || ':' || {v}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(enc(text if c == "text" else c) for c in COLUMNS) + ")"

    bits = "CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END"
    step = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda t, z: {bits})"
    codes = "list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(substr(s, i, 1)) AS BIGINT))"
    crc = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda c, b: {step}), 4294967295)"
    ctes = [f"""ids AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents),
crc AS (SELECT doc_id, {crc} % 5 = 0 AS hit FROM ids),
rows_ AS (SELECT d.*, coalesce(hit, false) AS hit, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS key
          FROM documents d LEFT JOIN crc USING (doc_id)),
hashed AS (SELECT key, doc_id, {leaf("text")} AS leaf,
             CASE WHEN hit THEN {leaf(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS changed FROM rows_),
l0 AS (SELECT *, leaf AS digest, row_number() OVER (PARTITION BY key ORDER BY doc_id, leaf) - 1 AS pos,
              count(*) OVER (PARTITION BY key) AS n FROM hashed)"""]

    def up(a: str, b: str) -> str:
        return (f"{b} AS (SELECT key, pos // {ARITY} AS pos, (n + {ARITY - 1}) // {ARITY} AS n, list(digest ORDER BY pos) AS kids, "
                f"CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE max(digest) END AS digest, "
                f"n > 1 AS real FROM {a} GROUP BY key, pos // {ARITY}, n)")

    ctes += [up(f"l{i}", f"l{i + 1}") for i in range(leaf_levels)]
    ctes.append(f"s0 AS (SELECT '' AS key, key AS of, digest, row_number() OVER (ORDER BY key) - 1 AS pos, "
                f"count(*) OVER () AS n FROM l{leaf_levels})")
    ctes += [up(f"s{i}", f"s{i + 1}") for i in range(source_levels)]
    joins, before, after = [], [], []
    for t, k, levels in (("l", "l0.key", leaf_levels), ("s", "''", source_levels)):
        for i in range(1, levels + 1):
            at = f"{'l0' if t == 'l' else 's0'}.pos // {ARITY ** (i - 1)}"
            joins.append(f"JOIN {t}{i} ON {t}{i}.key = {k} AND {t}{i}.pos = {at} // {ARITY}")
            slot = f"({at} % {ARITY})"
            before.append(f"CASE WHEN {t}{i}.real THEN array_to_string({t}{i}.kids[1:{slot}], '') END")
            after.append(f"CASE WHEN {t}{i}.real THEN array_to_string({t}{i}.kids[{slot} + 2:], '') END")
        if t == "l":
            joins.append("JOIN s0 ON s0.of = l0.key")
    folds = [f"""f0 AS (SELECT l0.doc_id, l0.leaf, s0.digest AS subroot, s{source_levels}.digest AS root,
  coalesce(l0.changed, l0.leaf) AS own, [{", ".join(before)}] AS b, [{", ".join(after)}] AS a
  FROM l0 {" ".join(joins)})"""]
    for i in range(len(before)):
        folds.append(f"f{i + 1} AS (SELECT * REPLACE (CASE WHEN b[{i + 1}] IS NULL THEN own "
                     f"ELSE sha256(b[{i + 1}] || own || a[{i + 1}]) END AS own) FROM f{i})")
    proof = " || ".join(f"coalesce(b[{i + 1}] || a[{i + 1}], '')" for i in range(len(before)))
    return (f"WITH {', '.join(ctes + folds)}\nSELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, "
            f"own AS folded_root, own = root AS verified FROM f{len(before)}")
