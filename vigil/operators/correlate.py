"""Cross-scanner correlation rules (J1-J15, J20), compiled together.

A rule is data (:class:`Rule`): which rows each give a correlation, which rows are members of the one correlation of
a rule, which short lists of first findings are referenced, and when it fires. All rules read one pooled findings
table (``scanner`` names the bucket, ``ord`` is input order) and give two frames:

  headers  correlation_id, correlation_type, producer, title, description, severity, risk_score
  edges    correlation_id, finding_id, grp, ord, n   (n = multiplicity of the reference)

The columns of the findings that rules read are written once; what rules look at in them, and the numbers of the lists
(:data:`FACTS`) that each row belongs to, are worked out from that one table and written too. Spark repeats expressions
above a union in each of its branches, and the driver holds every plan, so none of them stand above the findings' own.
:func:`run_rules` then compiles any number of rules into three scans of the second table:

1. bounds: of each list ("the first k rows with ...", also every test of existence and of a number of rows) the minimal
   ``ord`` in each of 64 hash classes; the k-th of these minima is at least the k-th smallest of all, so it bounds the
   list.
2. facts: the first k of the few rows up to the bounds. They reach the driver: k rows a list, also where many share an ord.
3. rows: one projection emits the numbers of all headers, edges and inputs of the one rule that joins (J9) of a row; a
   small table says what each number stands for. It is written once, by kind, and read from there.

Reference lists that can be unbounded (all C2 ids, all ids of three categories, ...) are never collected: they stay
edges. Members shared by every correlation of one rule are listed once under ``<type>:*``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions import text as tx
from vigil.sources.sinks import written

MEDIUM_PLUS = ["medium", "high", "critical"]
HIGH_PLUS = ["high", "critical"]

# --- FIXED VALUES: rule keyword lists --------------------------------------------------------
MALWARE_PATTERNS = ["backdoor", "trojan", "virus", "malware", "exploit",
                    "shell", "netcat", "ncat", "socat", "cryptominer"]
C2_WORDS = ["c2", "command", "control"]
PARAM_CLASSES = [
    ("network_hardening", ["tcp", "icmp", "ip", "net"]),
    ("memory_protection", ["vm", "memory", "mmap", "randomize"]),
    ("file_system", ["fs", "file", "dmesg", "ptrace"]),
]
MAC_PARAM_WORDS = ["selinux", "apparmor", "security"]
PROCESS_PARAM_WORDS = ["exec", "ptrace", "randomize", "mmap"]


def _any_contains(col: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.instr(col, w) > 0 for w in words])


#: The findings' columns that rules read.
READ = ("id", "ord", "scanner", "severity", "title", "metadata")

#: What rules look at besides id, ord, scanner, severity and title; worked out once a row.
NAME, TITLE, LOWER, CLASS = "_name", "_title", "_lower", "_class"
PORT, ENABLED, RULE = "_port", "_enabled", "_rule"


def staged(findings: DataFrame) -> DataFrame:
    """The columns of findings that rules read. Metadata is parsed only for the scanners whose rules need it."""
    def meta(key: str, *scanners: str) -> Column:
        return F.when(_in(*scanners), F.get_json_object(F.col("metadata"), f"$.{key}"))

    title = F.coalesce(F.col("title"), F.lit(""))
    return findings.select(
        F.col("id").cast("string").alias("id"), F.col("ord").cast("long").alias("ord"), "scanner", "severity", "title",
        title.alias(TITLE), F.lower(title).alias(LOWER),
        F.when(_in("processes"), tx.command_basename(F.coalesce(meta("command", "processes"), F.lit("")))).alias(NAME),
        meta("port", "network").try_cast("double").alias(PORT), meta("enabled", "mac").alias(ENABLED),
        meta("rule", "world_writable").alias(RULE),
        F.when(_in("kernel_params"), param_class(F.col("title"))).alias(CLASS))


def _in(*scanners: str) -> Column:
    return F.col("scanner").isin(*scanners)


def _severe(levels: list[str]) -> Column:
    return F.col("severity").isin(levels)


def _said() -> Column:
    return F.col("id").isNotNull() & (F.col("id") != "")


def param_class(title: Column) -> Column:
    """first matching keyword class wins."""
    t = F.lower(F.coalesce(title, F.lit("")))
    expr = None
    for name, words in PARAM_CLASSES:
        expr = F.when(_any_contains(t, words), name) if expr is None else expr.when(_any_contains(t, words), name)
    return expr



# --- what rules are made of -----------------------------------------------------------------------
@dataclass(frozen=True)
class First:
    """The first ``k`` rows, by ``ord``, that meet a condition; ``text`` is what is kept of them besides the id."""

    when: Callable[[], Column]
    k: int = 1
    text: Callable[[], Column] | None = None


Facts = dict[str, list[tuple[int, str | None, str | None]]]


@dataclass(frozen=True)
class Members:
    """Rows that are references, in group ``grp``, of the correlation that ``to`` names (by default ``<type>:*``)."""

    grp: int
    when: Callable[[Facts], Column]
    to: Callable[[], Column] | None = None


@dataclass(frozen=True)
class Rule:
    """A correlation rule. ``fires`` says, by the facts, whether it gives anything.

    each: the rows that give a correlation of their own, ``<type>:<id>``, with the row as reference 0 and ``refs``
    (group 1) after it; ``{}`` in its title and description stands for the row's ``subject``. once: (correlation id's end, title, description) of correlations of the whole input.
    members and given: references found in the rows, and (id, grp, ord) that the facts hold already.
    """

    name: str
    producer: str
    severity: str
    risk: int
    fires: Callable[[Facts], bool]
    each: Callable[[], Column] | None = None
    title: str = ""
    description: str = ""
    subject: str = TITLE
    refs: Callable[[Facts], list[str | None]] = lambda f: []
    once: Callable[[Facts], list[tuple[str, str, str]]] = lambda f: []
    members: tuple[Members, ...] = ()
    given: Callable[[Facts], list[tuple[str | None, int, int]]] = lambda f: []

    def __call__(self, findings: DataFrame):
        return run_rules(findings, {self.name: self})


def _ids(*lists: list, k: int) -> list[str | None]:
    return [row[1] for some in lists for row in some][:k]


def _texts(rows: list, k: int) -> str:
    """The first texts, joined; nulls are left out as by array_join."""
    return ", ".join(t for _, _, t in rows[:k] if t is not None)


#: FACTS: the lists that rules refer to, by name.
FACTS: dict[str, First] = {
    "network_severe": First(lambda: _in("network") & _severe(MEDIUM_PLUS), 3),
    "network_unusual": First(lambda: _in("network") & _unusual_port(), 2),
    "network_c2": First(lambda: _in("network") & _any_contains(F.col(LOWER), C2_WORDS)),
    "process_malware": First(lambda: _in("processes") & _any_contains(F.lower(F.col(NAME)), MALWARE_PATTERNS)),
    "process_severe": First(lambda: _in("processes") & _severe(MEDIUM_PLUS), 2, lambda: F.col(NAME)),
    "suid_severe": First(lambda: _in("suid") & _severe(MEDIUM_PLUS), 3),
    "writable_severe": First(lambda: _in("world_writable") & _severe(MEDIUM_PLUS), 3),
    "capability": First(lambda: _in("world_writable") & _capability()),
    "mac_disabled": First(lambda: _in("mac") & _mac_disabled()),
    "param_mac": First(lambda: _in("kernel_params") & _any_contains(F.col(LOWER), MAC_PARAM_WORDS)),
    "param_process": First(lambda: _in("kernel_params") & _any_contains(F.col(LOWER), PROCESS_PARAM_WORDS)),
    "module_security": First(lambda: _in("modules") & F.col("severity").isin("medium", "high"), 2, lambda: F.col("title")),
    **{f"param_weak:{name}": First(lambda name=name: _weak_param() & (F.col(CLASS) == name), 3,
                                   lambda: F.col("title")) for name, _ in PARAM_CLASSES},
    **{f"any:{name}": First(lambda name=name: _in(name), 5)
       for name in ("network", "processes", "kernel_params")},
    **{f"any:{name}": First(lambda name=name: _in(name)) for name in ("world_writable", "ioc")},
}


def _unusual_port() -> Column:
    return (F.col(PORT) > 1024) & F.col("severity").isin("low", "medium")


def _capability() -> Column:
    return (F.instr(F.col(LOWER), "capability") > 0) | (F.col(RULE) == "file_capability")


def _mac_disabled() -> Column:
    return (F.col(ENABLED) == "false") | (F.col("severity") == "medium")


def _weak_param() -> Column:
    return _in("kernel_params") & F.col(CLASS).isNotNull() & F.col("severity").isin("medium", "high")


def _weak_classes(f: Facts) -> list[str]:
    return [name for name, _ in PARAM_CLASSES if len(f[f"param_weak:{name}"]) >= 2]


def _sequence(f: Facts) -> list[tuple[str | None, int, int]]:
    """Network, then processes, then kernel parameters: (id, grp, ord) of the first five."""
    every = [(i, g, o) for g, name in enumerate(("network", "processes", "kernel_params")) for o, i, _ in f[f"any:{name}"]]
    return every[:5]


def _all_of(*names: str) -> Callable[[Facts], bool]:
    return lambda f: all(f[n] for n in names)


# --- registry (J2-J14) ----------------------------------------------------------------------------
def _rules() -> list[Rule]:
    return [
        # Each medium+ process with the first 3 medium+ network ids
        Rule("process_network_suspicious", "process_network", "high", 75, _all_of("network_severe"),
             lambda: _in("processes") & _severe(MEDIUM_PLUS),
             "Suspicious process with network activity: {}",
             "Suspicious process '{}' detected alongside unusual network activity", NAME,
             lambda f: _ids(f["network_severe"], k=3)),
        # Each malware-named process; the C2-titled network findings are the same for all of them
        Rule("malware_c2", "process_network", "critical", 95, _all_of("network_c2", "process_malware"),
             lambda: _in("processes") & _any_contains(F.lower(F.col(NAME)), MALWARE_PATTERNS),
             "Potential malware C2 communication: {}",
             "Process '{}' showing signs of malware with C2 communications", NAME,
             members=(Members(1, lambda f: FACTS["network_c2"].when()),)),
        # J4 (T11): every process with the first 2 low/medium network ids on a port above 1024
        Rule("unusual_port_usage", "process_network", "medium", 55, _all_of("network_unusual"),
             lambda: _in("processes"),
             "Unusual port usage by process: {}",
             "Process '{}' using unusual network ports", NAME,
             lambda f: _ids(f["network_unusual"], k=2)),
        # Each high/critical world-writable finding with the first 2 medium+ SUID ids
        Rule("suid_world_writable", "filesystem", "critical", 90, _all_of("suid_severe"),
             lambda: _in("world_writable") & _severe(HIGH_PLUS),
             "SUID binary in world-writable location",
             "Privileged SUID binary found in world-writable directory, potential privilege escalation risk", TITLE,
             lambda f: _ids(f["suid_severe"], k=2)),
        # Capability files and a disabled MAC system: one correlation over all capability and MAC ids
        Rule("capabilities_weak_mac", "filesystem", "high", 80, _all_of("capability", "mac_disabled"),
             once=lambda f: [("*", "File capabilities with weak MAC protection",
                              "Files with capabilities detected but MAC system shows weak protection")],
             members=(Members(0, lambda f: FACTS["capability"].when()), Members(1, lambda f: _in("mac")))),
        # Each high/critical IOC with the first 3 medium+ file findings, world-writable ones first
        Rule("ioc_file_permissions", "filesystem", "high", 85,
             lambda f: bool(f["writable_severe"] or f["suid_severe"]),
             lambda: _in("ioc") & _severe(HIGH_PLUS),
             "IOC with file permission vulnerabilities: {}",
             "Indicator of compromise '{}' detected alongside file permission issues", TITLE,
             lambda f: _ids(f["writable_severe"], f["suid_severe"], k=3)),
        # Per keyword class, at least 2 medium/high parameters; the first 3 names in the text
        Rule("weak_kernel_security", "kernel", "high", 75, lambda f: bool(_weak_classes(f)),
             once=lambda f: [(c, f"Weak {c.replace('_', ' ')} configuration",
                              f"Multiple kernel parameters in {c} category show weak security settings: "
                              + _texts(f[f"param_weak:{c}"], 3)) for c in _weak_classes(f)],
             members=(Members(0, lambda f: _weak_param() & F.col(CLASS).isin(_weak_classes(f)),
                              lambda: F.concat(F.lit("weak_kernel_security:"), F.col(CLASS))),)),
        # MAC-related parameters and a disabled MAC system: those parameters and every MAC finding
        Rule("kernel_mac_disabled", "kernel", "high", 80, _all_of("param_mac", "mac_disabled"),
             once=lambda f: [("*", "Kernel MAC parameters with disabled MAC system",
                              "Kernel parameters related to MAC security detected but MAC system is disabled")],
             members=(Members(0, lambda f: FACTS["param_mac"].when()), Members(1, lambda f: _in("mac")))),
        # Process-related parameters and medium+ processes
        Rule("kernel_process_suspicious", "kernel", "medium", 65, _all_of("param_process", "process_severe"),
             once=lambda f: [("*", "Kernel process controls with suspicious activity",
                              "Kernel parameters controlling process execution detected alongside suspicious "
                              "processes: " + _texts(f["process_severe"], 2))],
             members=(Members(0, lambda f: FACTS["param_process"].when()),
                      Members(1, lambda f: _in("processes") & _severe(MEDIUM_PLUS)))),
        # Processes, network and world-writable all present: all their ids
        Rule("multi_vector_apt", "dense", "critical", 95, _all_of("any:processes", "any:network", "any:world_writable"),
             once=lambda f: [("*", "Advanced persistent threat indicators",
                              "Coordinated attack pattern detected: suspicious process with network connectivity, "
                              "world-writable files, and kernel parameter manipulation")],
             members=tuple(Members(g, lambda f, c=c: _in(c) & _said())
                           for g, c in enumerate(("processes", "network", "world_writable")))),
        # J13 (T10): with at least 3 rows in the sequence, its first 5
        Rule("temporal_sequence", "dense", "high", 80, lambda f: len(_sequence(f)) >= 3,
             once=lambda f: [("*", "Temporal escalation sequence", "Sequential events across network, process, and "
                              "kernel parameters indicate possible escalation.")],
             given=lambda f: [row for row in _sequence(f) if row[0]]),
        # IOC and processes both present: all their ids
        Rule("causal_ioc_process", "dense", "high", 85, _all_of("any:ioc", "any:processes"),
             once=lambda f: [("*", "IOC-led process compromise", "Indicator of compromise aligns with process behavior "
                              "anomalies, suggesting cause-effect chain.")],
             members=tuple(Members(g, lambda f, c=c: _in(c) & _said()) for g, c in enumerate(("ioc", "processes")))),
    ]


#: J9 joins modules with parameters; its headers and edges are worked out from the rows that the projection sets aside.
MODULE_RULE = "module_kernel_conflict"
RULES: dict[str, Rule | Callable] = {r.name: r for r in _rules()}
RULES[MODULE_RULE] = Rule(MODULE_RULE, "kernel", "medium", 60, _all_of("module_security"),
                          members=(Members(0, lambda f: FACTS["module_security"].when()),))


def register(name: str, rule) -> None:
    """Extension point: a :class:`Rule`, compiled with the others, or any ``findings -> (headers, edges)``, run apart."""
    RULES[name] = rule


# --- compilation (J15) ----------------------------------------------------------------------------
_CLASSES = 64


_HITS = "_hits"


def with_hits(rows: DataFrame, facts: dict[str, First]) -> DataFrame:
    """:func:`staged` findings and the numbers of the lists of ``facts`` that each row belongs to."""
    hits = [F.when(first.when(), F.lit(i)) for i, first in enumerate(facts.values())]
    return rows.withColumn(_HITS, F.array_compact(F.array(*hits)) if hits else F.array().cast("array<int>"))


def gather_facts(rows: DataFrame, facts: dict[str, First]) -> Facts:
    """The lists of ``facts``: (ord, id, text) of each row of :func:`with_hits` (or :func:`staged`) findings, in order. Two
    scans; k rows a list reach the driver."""
    rows = rows if _HITS in rows.columns else with_hits(rows, facts)
    names = list(facts)
    out: Facts = {n: [] for n in names}
    hits = rows.select(F.explode(_HITS).alias("i"), "ord")
    minima = hits.groupBy("i", F.pmod(F.xxhash64("ord"), F.lit(_CLASSES)).alias("c")).agg(F.min("ord").alias("m"))
    limit = {}
    for r in minima.groupBy("i").agg(F.sort_array(F.collect_list("m")).alias("m")).collect():
        # Fewer classes than k have a row: all rows of the list count. No class has: the list is empty.
        k = facts[names[r["i"]]].k
        limit[r["i"]] = r["m"][k - 1] if len(r["m"]) >= k else 2**63 - 1
    if not limit:
        return out
    bound = F.create_map(*[F.lit(x).cast("long") for pair in limit.items() for x in pair])
    near = rows.withColumn("i", F.explode(_HITS)).where(F.col("ord") <= bound[F.col("i").cast("long")])
    texts = {n: facts[n].text() for n in names if facts[n].text}
    text = F.coalesce(*[F.when(F.col("i") == names.index(n), c) for n, c in texts.items()]).alias("text")
    # Any number of rows may share the ord of a bound: each task keeps the first of a list, none collects them.
    nth = F.row_number().over(Window.partitionBy("i").orderBy("ord", "id", "text"))
    most = max(facts[names[i]].k for i in limit)
    first = near.select("i", "ord", "id", text).withColumn("nth", nth).where(F.col("nth") <= most)
    for r in sorted(first.collect(), key=lambda r: r["nth"]):
        if r["nth"] <= facts[names[r["i"]]].k:
            out[names[r["i"]]].append((r["ord"], r["id"], r["text"]))
    return out


_HEADER = ("correlation_id string, correlation_type string, producer string, title string, description string, "
           "severity string, risk_score double")
_EDGE = "correlation_id string, finding_id string, grp int, ord long, n long"


@dataclass(frozen=True)
class _Emission:
    """One thing that a row gives: a header (h), an edge (e), an input of J9 (m: its modules, p: its parameters).

    ``to``: the correlation's id, by default ``<type>:<id of the row>``. ref, ord: of an edge to another row than this.
    """

    kind: str
    rule: Rule
    to: Column | None = None
    grp: int = 0
    ref: str | None = None
    ord: int | None = None


def _emissions(rules: list[Rule], facts: Facts) -> list[tuple[Column, list[_Emission]]]:
    """Conditions on a row, and what the row gives where they hold."""
    out = []
    for r in rules:
        if r.each is not None:
            refs = [_Emission("e", r, grp=1, ref=i, ord=k) for k, i in enumerate(r.refs(facts))]
            out.append((r.each(), [_Emission("h", r), _Emission("e", r, ord=0), *refs]))
        out += [(m.when(facts), [_Emission("e", r, m.to() if m.to else F.lit(f"{r.name}:*"), m.grp)]) for m in r.members]
        if r.name == MODULE_RULE:
            out += [(FACTS["module_security"].when(), [_Emission("m", r)]), (_in("kernel_params"), [_Emission("p", r)])]
    return out


def _emitted(rows: DataFrame, rules: list[Rule], facts: Facts) -> DataFrame:
    """All that the rows of :func:`staged` findings give: a row names its emissions by number, and a table of as many rows
    as there are emissions says what a number stands for."""
    groups = _emissions(rules, facts)
    every = [e for _, some in groups for e in some]
    number = {id(e): i for i, e in enumerate(every)}
    codes = F.flatten(F.array_compact(F.array(*[
        F.when(hit, F.array(*[F.lit(number[id(e)]) for e in some])) for hit, some in groups])))
    rows = rows.select("id", F.col("ord").alias("_ord"), F.col("title").alias("_own"), NAME, TITLE, CLASS,
                       F.explode_outer(codes).alias("c")).where("c is not null")  # explode would work out the codes twice
    meaning = rows.sparkSession.createDataFrame(
        [(i, e.kind, e.rule.name, e.rule.producer, e.rule.title, e.rule.description, e.rule.severity, float(e.rule.risk),
          e.rule.subject == NAME, e.ref, e.grp, e.ord) for i, e in enumerate(every)],
        "c int, kind string, type string, producer string, t string, d string, level string, risk double, named boolean, "
        "ref string, grp int, o long")

    header = F.col("kind") == "h"

    def worded(pattern: str) -> Column:
        subject = F.coalesce(F.when(F.col("named"), F.col(NAME)).otherwise(F.col(TITLE)), F.lit(""))
        return F.when(header, F.replace(F.col(pattern), F.lit("{}"), subject))

    named = [F.when(F.col("c") == number[id(e)], e.to) for e in every if e.to is not None]
    cid = F.coalesce(*named, F.concat(F.col("type"), F.lit(":"), F.col("id")))
    return rows.join(F.broadcast(meaning), "c").select(
        "kind", cid.alias("correlation_id"), F.when(header, F.col("type")).alias("correlation_type"),
        F.when(header, F.col("producer")).alias("producer"),
        F.when(F.col("kind").isin("m", "p"), F.col("_own")).otherwise(worded("t")).alias("title"),
        worded("d").alias("description"), F.when(header, F.col("level")).alias("severity"),
        F.when(header, F.col("risk")).alias("risk_score"), F.coalesce("ref", "id").alias("finding_id"), "grp",
        F.coalesce("o", "_ord").alias("ord"), F.lit(1).cast("long").alias("n"))


def run_rules(findings: DataFrame, rules: dict | None = None, errors: list | None = None):
    """Run the rules and return all their (headers, edges).

    Compiled rules share one scan of ``findings`` and four of what it wrote; other callables run apart. A rule whose
    expressions fail is noted in ``errors`` as (name, message) and left out; without such a list the error is raised.
    """
    spark, headers, edges = findings.sparkSession, [], []
    compiled: dict[str, Rule] = {}

    def isolated(name: str, work: Callable):
        try:
            return work()
        except Exception as e:  # noqa: BLE001 - isolation per rule is the contract
            if errors is None:
                raise
            errors.append((name, f"{type(e).__name__}: {e}"))
            return None

    for name, rule in (RULES if rules is None else rules).items():
        if isinstance(rule, Rule):
            compiled[name] = rule
        else:
            both = isolated(name, lambda rule=rule: [d for d in rule(findings) if d.schema is not None])
            if both:
                headers.append(both[0]), edges.append(both[1])
    rows = staged(findings)
    if compiled:
        read = written(findings.select(*READ), "staged")
        rows = written(with_hits(staged(read), FACTS), "marked")
    facts = gather_facts(rows, FACTS) if compiled else {}
    firing = [r for n, r in compiled.items() if isolated(n, lambda r=r: r.fires(facts))]
    sound, emitted = firing, None
    try:
        emitted = _emitted(rows, sound, facts) if _emissions(sound, facts) else None
    except Exception:  # noqa: BLE001 - a rule is at fault: each must give a plan of its own before it joins the others
        sound = [r for r in firing if not _emissions([r], facts)
                 or isolated(r.name, lambda r=r: _emitted(rows, [r], facts)) is not None]
        emitted = _emitted(rows, sound, facts) if _emissions(sound, facts) else None
    if sound:
        given = [(f"{r.name}:*", i, g, o, 1) for r in sound for i, g, o in r.given(facts)]
        fixed = [(f"{r.name}:{end}", r.name, r.producer, title, text, r.severity, float(r.risk))
                 for r in sound for end, title, text in r.once(facts)]
        headers.append(spark.createDataFrame(fixed, _HEADER))
        edges.append(spark.createDataFrame(given, _EDGE))
    if emitted is not None:
        found = written(emitted, "rules", by="kind")
        headers.append(found.where("kind = 'h'").select(*[c.split()[0] for c in _HEADER.split(", ")]))
        own = [c.split()[0] for c in _EDGE.split(", ")]
        most = found.where("kind = 'e'").select(*own)
        if any(r.name == MODULE_RULE for r in sound):
            h, e = _module_conflict(found, facts)
            if h:
                headers.append(spark.createDataFrame(h, _HEADER)), edges.append(e.select(*own))
            else:
                most = most.where(F.col("correlation_id") != f"{MODULE_RULE}:*")
        edges.append(most)
    if not headers:
        headers, edges = [spark.createDataFrame([], _HEADER)], [spark.createDataFrame([], _EDGE)]
    return reduce(DataFrame.unionByName, headers), reduce(DataFrame.unionByName, edges)


# --- J9 -------------------------------------------------------------------------------------------
_GRAM = 3


def _module_signatures(modules: DataFrame) -> DataFrame:
    """Module name (title minus 'Module ', lower-cased) and its match words: the name and its words."""
    name = F.lower(F.replace(F.coalesce(F.col("title"), F.lit("")), F.lit("Module "), F.lit("")))
    words = F.filter(F.split(F.trim(F.regexp_replace(name, tx.WHITESPACE_CLASS, " ")), " "), lambda w: w != "")
    return modules.select("id", "ord", name.alias("name"),
                          F.array_sort(F.array_distinct(F.concat(F.array(name), words))).alias("sig"))



def _grams(text: Column, n: int) -> Column:
    """The distinct n-character pieces of a text; a shorter text has none."""
    starts = F.sequence(F.lit(1), F.length(text) - n + 1)
    return F.when(F.length(text) >= n, F.array_distinct(F.transform(starts, lambda s: F.substr(text, s, F.lit(n))))) \
        .otherwise(F.array().cast("array<string>"))


def title_hits(titles: DataFrame, words: DataFrame) -> DataFrame:
    """(id, ord, w): the words (w, distinct) that occur in the titles (id, ord, pt).

    Each word is filed under the rarest, in the vocabulary, of its pieces of ``_GRAM`` characters, or under itself if it
    is shorter. A title looks up its pieces of up to that length once each, so what is shuffled grows with its length,
    and what it finds is confirmed by a search.
    """
    pieces = words.select("w", F.explode(F.when(F.length("w") >= _GRAM, _grams(F.col("w"), _GRAM))
                                         .otherwise(F.array("w"))).alias("g"))
    common = pieces.groupBy("g").agg(F.count(F.lit(1)).alias("c"))
    filed = written(pieces.join(common, "g").groupBy("w").agg(F.min_by("g", F.struct("c", "g")).alias("g")), "filed")
    probes = titles.select("id", "ord", "pt", F.explode(F.concat(
        F.array(F.lit("")), *[_grams(F.col("pt"), n) for n in range(1, _GRAM + 1)])).alias("g"))
    return probes.join(filed, "g").where(F.contains("pt", F.col("w"))).select("id", "ord", "w")


def _module_conflict(rows: DataFrame, facts: Facts):
    """medium/high modules whose name (or a word of it) occurs in a parameter title -> one medium/60.

    References: every security module once (from the projection), then each parameter once per matching module. The
    vocabulary and the parameters' references are written, so that no later plan holds these joins. Returns header rows
    (none, if no parameter matches) and the parameters' edges.
    """
    modules = rows.where("kind = 'm'").select(F.col("finding_id").alias("id"), "ord", "title")
    titles = rows.where("kind = 'p'").select(F.col("finding_id").alias("id"), "ord", F.lower(F.coalesce("title", F.lit(""))).alias("pt"))
    counts = _module_signatures(modules).groupBy("sig").agg(F.count(F.lit(1)).alias("c"))  # modules of equal words
    words = written(counts.select("sig", "c", F.explode("sig").alias("w")), "words")
    pairs = title_hits(titles, words.select("w").distinct()).join(words, "w").select("id", "ord", "sig", "c").distinct()
    cid = f"{MODULE_RULE}:*"
    params = pairs.groupBy(F.col("id").alias("finding_id"), "ord").agg(F.sum("c").alias("n"))
    e = written(params.select(F.lit(cid).alias("correlation_id"), "finding_id", F.lit(1).alias("grp"), "ord", "n"), "conflict")
    text = ("Security-related kernel modules detected with potentially conflicting kernel parameters: "
            + _texts(facts["module_security"], 2))
    h = [(cid, MODULE_RULE, "kernel", "Security modules with kernel parameter conflicts", text, "medium", 60.0)]
    return ([] if e.isEmpty() else h), e


def correlation_rows(headers: DataFrame, edges: DataFrame) -> DataFrame:
    """The correlation finding built from a header and its reference count.

    graph_degree = number of references; strength = min(0.2 * n, 0.8) + 0.15
    (the random part fixed at its midpoint); tags [correlation, type, producer];
    kb_refs default for the type. Shared members (``<type>:*``) count toward
    every correlation of that type.
    """
    own = edges.groupBy("correlation_id").agg(F.sum("n").alias("own"))
    # shared member counts come from the same per-correlation aggregate (the edges are scanned once)
    shared = (own.where(F.col("correlation_id").endswith(":*"))
              .select(F.regexp_replace("correlation_id", ":\\*$", "").alias("correlation_type"),
                      F.col("own").alias("shared")))
    rows = (headers.join(own, "correlation_id", "left")
            .join(shared, "correlation_type", "left")
            .withColumn("n_refs", F.coalesce("own", F.lit(0))
                        + F.when(F.col("correlation_id").endswith(":*"), F.lit(0))
                        .otherwise(F.coalesce("shared", F.lit(0))))
            .drop("own", "shared"))
    return rows.select(
        "correlation_id", "correlation_type", "producer", "title", "description", "severity", "risk_score",
        F.col("risk_score").alias("base_severity_score"), F.col("risk_score").alias("risk_total"),
        F.lit("correlation").alias("category"),
        F.array(F.lit("correlation"), F.col("correlation_type"), F.col("producer")).alias("tags"),
        F.col("n_refs").alias("graph_degree"),
        (F.least(F.col("n_refs") * 0.2, F.lit(0.8)) + F.lit(0.15)).alias("correlation_strength"),
        F.array(F.lit("Correlation KB: cross-signal consistency"),
                F.concat(F.lit("Type: "), F.col("correlation_type"))).alias("kb_refs"),
        F.lit("new").alias("baseline_status"), F.lit("correlation").alias("severity_source"),
        F.lit(False).alias("operational_error"),
        F.concat(F.lit("Correlation analysis by "), F.col("producer"), F.lit(" producer")).alias("rationale"),
    )


# --- J20 ------------------------------------------------------------------------------------------
def replace_categories(current: DataFrame, regenerated: DataFrame, key: str = "category") -> DataFrame:
    """Buckets present in ``regenerated`` replace the same buckets of ``current`` (anti join + union);
    a regenerated bucket that is empty is not represented and so leaves the current one in place."""
    keys = regenerated.select(key).distinct()
    return current.join(keys, key, "left_anti").unionByName(regenerated, allowMissingColumns=True)
