"""Language identification by Bayesian fusion of text, declared language, address suffix and host.

Text: tempered naive Bayes over byte trigrams, fitted to a bounded sample of rows with a known language. Declared
language and address suffix: how often each goes with each language over all rows. Host: a prior smoothed towards
its domain, which is smoothed towards all rows. All counts are grouped sums of what the text alone says of every row;
a row's own share is taken out before it is judged by its host.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import hash_sample, raw, ship, table

LANGUAGES = ("de", "en", "es", "fr")
#: What none of the languages explains better than even odds over all trigrams.
UNKNOWN = "und"
#: Rows of each language that the text model is fitted to.
FIT_ROWS = 500
BUCKETS = 1 << 16
#: Trigrams after which more text adds evidence ever more slowly (neighbours are not independent).
TEMPER = 50.0
#: Rows that a host's domain, and a domain's table, count for; share of rows that a suffix of its own needs.
SMOOTH = 20.0
SUFFIX_SHARE = 1 / 4096
UNKNOWN_PRIOR = 0.01
MIN_POSTERIOR = 0.6
#: Hosts up to which the host table is broadcast (about 100 bytes each); beyond, it is joined by a shuffle.
BROADCAST_HOSTS = 200_000

LETTERS = bytes(i | 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 128 else 32 for i in range(256))
_SPACES = re.compile(rb" +")
_RAW = re.compile(rb"(?i)<(script|style)\b")
_RAW_END = {name: re.compile(rb"(?i)</" + name + rb"\s*>") for name in (b"script", b"style")}
_ENTITY = re.compile(rb"&#?\w+;")
_STEP = 1 << 16


def buckets(code: np.ndarray) -> np.ndarray:
    """The buckets of trigrams, each the three bytes as one 32-bit number."""
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def trigrams(text: bytes) -> Iterator[np.ndarray]:
    """The buckets of a text's byte trigrams: lower-case letters, one space between words and at both ends."""
    letters = b" " + _SPACES.sub(b" ", text.translate(LETTERS)).strip() + b" "
    if len(letters) < 3:
        return
    for at in range(0, len(letters) - 2, _STEP):
        b = np.frombuffer(letters[at:at + _STEP + 2], np.uint8).astype(np.uint32)
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        yield buckets(code)


def without_markup(html: bytes) -> bytes:
    """A space for each script, style, comment, tag and entity, in one pass: what has no end is sought once."""
    out, at, i, endless = [], 0, html.find(b"<"), set()
    while i >= 0:
        end, raw_part = -1, _RAW.match(html, i)
        kind = raw_part[1].lower() if raw_part else b"--" if html.startswith(b"<!--", i) else b""
        if kind and kind not in endless:
            if raw_part:
                m = _RAW_END[kind].search(html, i)
                end = m.end() if m else -1
            else:
                end = html.find(b"-->", i + 4) + 3 if html.find(b"-->", i + 4) >= 0 else -1
            if end < 0:
                endless.add(kind)
        if end < 0:
            end = html.find(b">", i) + 1
            if not end:  # nor has anything after it
                break
        out.append(html[at:i])
        at, i = end, html.find(b"<", end)
    out.append(html[at:])
    return _ENTITY.sub(b" ", b" ".join(out))


@dataclass
class TextModel:
    """Log probabilities (buckets, languages); the last column is that of ``UNKNOWN``."""

    languages: tuple[str, ...]
    log: np.ndarray

    def evidence(self, text: bytes) -> np.ndarray:
        """Tempered log likelihood of each language, ``UNKNOWN`` last; zeros for a text without letters."""
        total, n = np.zeros(self.log.shape[1]), 0
        for codes in trigrams(text):
            total += self.log[codes].sum(axis=0, dtype=np.float64)
            n += len(codes)
        return total * (TEMPER * np.log1p(n / TEMPER) / n) if n else total


def fit(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES, n: int = FIT_ROWS, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", seed: int = 7) -> TextModel:
    """A text model from ``n`` ids of each language, chosen by a hash, and one text of each (that with the smallest hash).
    A language without rows is left out. Counts of at most ``BUCKETS`` trigram buckets a language reach the driver.
    """
    ship(rows.sparkSession)
    known = rows.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    chosen = None
    for lang in languages:  # ids first, so that the choice moves no text
        some = hash_sample(known.where(F.col("l") == lang).select("i", "l").distinct(), n, "i", seed=seed)
        chosen = some if chosen is None else chosen.unionByName(some)
    sample = known.join(F.broadcast(chosen), ["i", "l"]).groupBy("i", "l").agg(
        F.min_by("t", F.xxhash64("t")).alias("t")).select("l", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), raw(b.column(1)), strict=True):
                mine = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for codes in trigrams(text):
                    mine += np.bincount(codes, minlength=BUCKETS)
        for lang, mine in counts.items():
            used = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used),
                                              pa.array(mine[used])], names=["l", "bucket", "n"])

    found = sample.mapInArrow(run, "l string, bucket long, n long").groupBy("l", "bucket").agg(
        F.sum("n").alias("n")).toPandas()
    there = tuple(x for x in languages if (found["l"] == x).any())
    log = np.full((BUCKETS, len(there) + 1), -np.log(BUCKETS), np.float32)
    for k, lang in enumerate(there):
        mine = found[found["l"] == lang]
        c = np.full(BUCKETS, 0.01)
        c[mine["bucket"].to_numpy()] += mine["n"].to_numpy()
        log[:, k] = np.log(c / c.sum())
    return TextModel(there, log)


def prior(k: int) -> np.ndarray:
    p = np.full(k, (1 - UNKNOWN_PRIOR) / max(1, k - 1))
    p[-1] = UNKNOWN_PRIOR if k > 1 else 1.0
    return p


def _posterior(logs: np.ndarray) -> np.ndarray:
    e = np.exp(logs - logs.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _lists(x: np.ndarray) -> pa.Array:
    at = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.ascontiguousarray(x).ravel()))


def _texts(model: TextModel, column: pa.Array, markup: bool) -> np.ndarray:
    """(rows, languages) log likelihoods."""
    found = [model.evidence(without_markup(t) if markup else t) for t in raw(column)]
    return np.stack(found) if found else np.zeros((0, model.log.shape[1]))


def text_evidence(rows: DataFrame, model: TextModel, markup: bool) -> DataFrame:
    """``rows`` (its last column: the text) with ``likelihood`` (logarithms) and ``p`` (what the text alone says)."""
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages
    keep = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _texts(shared.value, b.column(b.num_columns - 1), markup)
            p = _posterior(x + np.log(prior(x.shape[1])))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], _lists(x), _lists(p)], names=[*keep, "likelihood", "p"])

    lists = T.ArrayType(T.DoubleType())
    schema = T.StructType([*rows.select(*keep).schema, T.StructField("likelihood", lists), T.StructField("p", lists)])
    return rows.mapInArrow(run, schema)


def host_of(url: Column) -> Column:
    """The host of an address, lower case; null for an address without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def declared_of(html: Column) -> Column:
    """The primary language tag that the html element declares, lower case; null without one."""
    tag = F.lower(F.regexp_extract(html, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    return F.when(tag != "", tag)


@dataclass
class Beliefs:
    """What grouped sums over all rows say: shares of languages, and of declarations and suffixes in each."""

    names: tuple[str, ...]
    share: np.ndarray
    declared: dict[str, np.ndarray]
    suffix: dict[str, np.ndarray]

    def judge(self, x: np.ndarray, host: np.ndarray, domain: np.ndarray, known_host: np.ndarray, declared: list,
              suffix: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(posteriors, silent, text posteriors) of rows: log likelihoods, sums of their host and its domain."""
        text = _posterior(x + np.log(prior(x.shape[1])))
        domain, host = np.maximum(0, domain - text), np.maximum(0, host - text)  # less the row itself
        towards = (domain + SMOOTH * self.share) / (domain.sum(axis=1, keepdims=True) + SMOOTH)
        believed = (host + SMOOTH * towards) / (host.sum(axis=1, keepdims=True) + SMOOTH)
        believed = np.where(known_host[:, None], believed, self.share)
        none = np.ones(len(self.names))
        d = np.array([self.declared.get(v, self.declared.get("(other)", none)) for v in declared]).reshape(x.shape)
        s = np.array([none if v is None else self.suffix.get(v, self.suffix.get("(rare)", none))
                      for v in suffix]).reshape(x.shape)
        return _posterior(x + np.log(believed) + np.log(d) + np.log(s)), (x == 0).all(axis=1), text


def _declared(names: tuple[str, ...]) -> Column:
    """The declared language, its kind if it is none of ours: so there are few values."""
    d = F.col("declared")
    return F.when(d.isNull(), "(none)").when(d.isin(list(names)), d).otherwise("(other)")


def _domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def _suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def learn(evidence: DataFrame, names: tuple[str, ...]) -> tuple[Beliefs, DataFrame]:
    """Sums of ``p`` over ``evidence`` (host, declared, p): beliefs, and a table (host, by_host, by_domain).

    The driver gets one row, one for each kind of declaration, and one for each suffix that at least
    ``SUFFIX_SHARE`` of the rows have (at most 1 / ``SUFFIX_SHARE`` rows); rarer suffixes are one kind together.
    """
    k = len(names)
    cols = [f"n{i}" for i in range(k)]
    rows = evidence.select("host", _declared(names).alias("kind"), *[F.col("p")[i].alias(f"n{i}") for i in range(k)])
    sums = [F.sum(c).alias(c) for c in cols]
    # Pairs of a host and a kind; all other sums are sums of these.
    pairs = table(rows.groupBy("host", "kind").agg(*sums), "host-sums")
    total = pairs.groupBy().agg(*sums).first()
    n = np.array([total[c] or 0.0 for c in cols])
    share = (n + prior(k) * SMOOTH) / (n.sum() + SMOOTH)

    def given(found: list, key: str) -> dict[str, np.ndarray]:
        """P(value | language) of each value, smoothed towards its share of all rows."""
        count = {r[key]: np.array([r[c] for c in cols]) for r in found}
        each = sum(count.values(), np.zeros(k))
        whole = max(1e-9, each.sum())
        return {v: (c + SMOOTH * max(c.sum(), 1e-9) / whole) / (each + SMOOTH) for v, c in count.items()}

    declared = given(pairs.groupBy("kind").agg(*sums).collect(), "kind")
    hosts = pairs.where("host is not null").groupBy("host").agg(*sums)
    suffixes = hosts.groupBy(_suffix(F.col("host")).alias("suffix")).agg(*sums)
    large = sum((F.col(c) for c in cols), F.lit(0.0)) >= float(n.sum() * SUFFIX_SHARE)
    kinds = suffixes.groupBy(F.when(large, F.col("suffix")).otherwise("(rare)").alias("suffix")).agg(*sums)
    suffix = given(kinds.collect(), "suffix")
    domains = hosts.groupBy(_domain(F.col("host")).alias("domain")).agg(*[F.sum(c).alias(f"d{c}") for c in cols])
    joined = hosts.withColumn("domain", _domain(F.col("host"))).join(domains, "domain").select(
        F.col("host").alias("_host"), F.array(*cols).alias("by_host"),
        F.array(*[f"d{c}" for c in cols]).alias("by_domain"))
    return Beliefs(names, share, declared, suffix), table(joined, "hosts")


def with_hosts(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """``rows`` with the sums of their host: broadcast if its size is below the bound, else by a shuffle."""
    few = hosts.count() <= BROADCAST_HOSTS
    return rows.join(F.broadcast(hosts) if few else hosts, F.col("host") == F.col("_host"), "left").drop("_host")


def _sums(column: pa.Array, k: int) -> np.ndarray:
    return np.array([v if v is not None else [0.0] * k for v in column.to_pylist()], float).reshape(-1, k)


def _judged(b: Beliefs, batch: pa.RecordBatch, x: np.ndarray) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """(language, posterior, text language) of a batch with host, kind, by_host and by_domain."""
    k = len(b.names)
    hosts = batch.column("host").to_pylist()
    p, silent, text = b.judge(
        x, _sums(batch.column("by_host"), k), _sums(batch.column("by_domain"), k),
        np.array([v is not None for v in batch.column("by_host").to_pylist()], bool), batch.column("kind").to_pylist(),
        [None if h is None else h.rsplit(".", 1)[-1] for h in hosts])
    names = np.array(b.names, object)
    # Where the text has no letters there is no evidence of a language in use, whatever is declared.
    best = np.where(silent, k - 1, p.argmax(axis=1)) if len(p) else np.zeros(0, int)
    plain = np.where(silent, k - 1, text.argmax(axis=1)) if len(p) else np.zeros(0, int)
    return (pa.array(names[best], pa.string()), np.where(silent, 0.0, p.max(axis=1)) if len(p) else np.zeros(0),
            pa.array(names[plain], pa.string()))


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """(page_id, host, declared, language, posterior, text_language, kept) per row of ``pages`` (page_id, url, html).

    kept: a language of the model with a posterior of at least ``MIN_POSTERIOR``. A null or empty html, or one without
    letters, is ``und`` with posterior 0. A null or odd url has no host and takes the prior of all rows. Repeated rows
    keep a row each. Other columns are ignored. An empty table gives no row.
    """
    names = (*model.languages, UNKNOWN)
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), declared_of(F.col("html")).alias("declared"),
                        "html")
    evidence = table(text_evidence(rows, model, markup=True), "evidence")
    beliefs, hosts = learn(evidence, names)
    rows = with_hosts(evidence.select("page_id", "host", "declared", _declared(names).alias("kind"), "likelihood"), hosts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            language, posterior, text = _judged(beliefs, b, _sums(b.column("likelihood"), len(names)))
            sure = pa.array((posterior >= MIN_POSTERIOR) & (np.array(language.to_pylist(), object) != UNKNOWN))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("page_id", "host", "declared")), language, pa.array(posterior), text, sure],
                names=["page_id", "host", "declared", "language", "posterior", "text_language", "kept"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, host string, declared string, language string, posterior double, "
                                "text_language string, kept boolean")


def keep_identified(docs: DataFrame, model: TextModel, text_col: str = "text", lang_col: str = "lang",
                    host_col: str = "source") -> DataFrame:
    """``docs`` without the rows whose language is not one of the model's with enough certainty.

    The column of known languages is the declaration and that of sources the host. The text is read twice, so that
    no copy of it is written or shuffled. All columns and repeated rows stay; a null or empty text goes.
    """
    names = (*model.languages, UNKNOWN)
    facts = [F.col(host_col).cast("string").alias("host"), F.lower(F.col(lang_col)).alias("declared")]
    beliefs, hosts = learn(table(text_evidence(docs.select(*facts, text_col), model, markup=False), "evidence"), names)
    rows = docs.select(F.struct("*").alias("row"), *facts, F.col(text_col).alias("text"))
    rows = with_hosts(rows.select("row", "host", _declared(names).alias("kind"), "text"), hosts)
    shared = docs.sparkSession.sparkContext.broadcast((model, beliefs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value
        for b in batches:
            language, posterior, _ = _judged(known, b, _texts(m, b.column("text"), markup=False))
            sure = (posterior >= MIN_POSTERIOR) & (np.array(language.to_pylist(), object) != UNKNOWN)
            yield pa.RecordBatch.from_arrays([b.column("row").filter(pa.array(sure))], names=["row"])

    schema = T.StructType([T.StructField("row", docs.schema)])
    return rows.mapInArrow(run, schema).select("row.*")
