"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field for what is written otherwise.

The patterns give the base spans. The model adds spans that no pattern takes: addresses with their signs spelled out or
in brackets, numbers without a plus or in other groups. Candidate segments are stretches of pieces (runs of digits or
letters, single separators) of the regions that hold digits or a spelled-out sign, outside the base spans; features
look at a segment as a whole (its form, its groups of digits, check digits, what stands at its sides). A dynamic
programme over a region, with segments of bounded length, chooses all boundaries and types together. The weights
maximise the conditional likelihood of a sample of the corpus's regions, whose base spans are the labels, and of
generated spans in known and in rewritten forms among other numbers.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import hash_sample, raw, ship

KINDS = ("email", "ip", "card", "phone")
#: Documents whose regions may be sampled, regions that the model is fitted to, and the longest of them in characters.
FIT_DOCS, FIT_REGIONS, FIT_LENGTH = 20_000, 600, 160
#: Generated examples of each kind, and of other numbers; passes of the fit.
GENERATED, PASSES = 120, 4
#: Pieces of the longest segment. What a segment must be more likely than none by, in nats.
LONGEST, MARGIN = 24, 2.0
#: Groups of digits that a segment may have; a plus stands first or not at all.
MOST_GROUPS = 8
#: Scores of segment forms that a worker remembers.
_REMEMBER = 1 << 16

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

_AT = r"(?: ?[\[({<] ?(?:at|AT|@) ?[\])}>] ?| (?:at|AT|@) )"
_DOT = r"(?:\.| ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) )"
#: Numbers with separators, and addresses with at least one sign that is not the plain one.
_NUMBERS = re.compile(r"[(+]{0,2}[0-9](?:[ ().\[\]/+-]{0,3}[0-9])++")
_SIGNS = re.compile(rf"{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+|@[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+")
_PIECES = re.compile(r"[0-9]+|[^\W\d_]+|.", re.S)
_AT_SIGN, _DOT_SIGN, _FURTHER = re.compile(_AT + "|@"), re.compile(_DOT), re.compile(_DOT + "[A-Za-z0-9]")
#: Digits that a region of numbers needs: no kind has fewer in a form of its own.
_FEWEST = 4


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if i % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from the signs: one step for each character of a local part."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind, then start. Time grows with the text alone."""
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            d = _digits(m.group())
            if 13 <= len(d) <= 19 and luhn(d):
                out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that may hold a segment, in order, apart from each other."""
    found = [m.span() for m in _NUMBERS.finditer(text) if len(_DIGIT.findall(text, *m.span())) >= _FEWEST]
    for m in _SIGNS.finditer(text):
        start = m.start()
        while start > 0 and (text[start - 1] in _LOCAL_CHARS):
            start -= 1
        found.append((start, m.end()))
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def outside(spans: list[tuple[int, int]], cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``spans`` without the parts that ``cuts`` cover; both sorted."""
    out, i = [], 0
    for a, b in spans:
        while i and cuts[i - 1][1] > a:
            i -= 1
        while i < len(cuts) and cuts[i][1] <= a:
            i += 1
        j = i
        while j < len(cuts) and cuts[j][0] < b:
            if cuts[j][0] > a:
                out.append((a, cuts[j][0]))
            a = max(a, cuts[j][1])
            j += 1
        if a < b:
            out.append((a, b))
    return out


def _side(c: str) -> str:
    if not c:
        return "edge"
    if c.isspace():
        return "space"
    return "digit" if c.isdigit() else "letter" if c.isalpha() else c if c in "@.,;:+-/()[]_=#\"'" else "other"


_SHAPE = str.maketrans("0123456789", "0" * 10)


def signature(text: str, a: int, b: int) -> tuple | None:
    """What the features of a segment depend on; None for what no kind can be."""
    s = text[a:b]
    if s[-1] in " .-/+([{<@" or s[0] in " .-/)]}>@":
        return None
    left, right = _side(text[a - 1:a]), _side(text[b:b + 1])
    if any(c.isalpha() for c in s):
        at = [m for m in _AT_SIGN.finditer(s)]
        if len(at) != 1 or at[0].start() == 0 or at[0].end() == len(s):
            return None
        name, rest = s[:at[0].start()], s[at[0].end():]
        dots = _DOT_SIGN.findall(rest)
        labels = _DOT_SIGN.split(rest)
        if not dots or not all(re.fullmatch("[A-Za-z0-9-]+", x) for x in labels) or not set(name) <= _LOCAL_CHARS:
            return None
        last = labels[-1]
        return ("sign", at[0].group().strip().lower(), tuple(sorted({d.strip().lower() for d in dots})),
                min(len(labels), 4), min(len(last), 7) if last.isalpha() else 0, name[0].isalnum(),
                _FURTHER.match(text, b) is not None, left, right)
    if not (s[0] in "+(" or s[0].isdigit()) or not s[-1].isdigit():
        return None
    d = _digits(s)
    if not _FEWEST <= len(d) <= 19:
        return None
    groups = re.findall("[0-9]+", s)
    octets = len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 and (g == "0" or g[0] != "0") for g in groups)
    checked = len(d) >= 13 and luhn(d)
    return ("number", s.translate(_SHAPE), len(d), octets, checked, left, right)


def features(sig: tuple) -> list[str]:
    """The features of a segment as a whole."""
    if sig[0] == "sign":
        _, at, dots, labels, last, plain, further, left, right = sig
        return ["sign", f"at={at}", *[f"dot={d}" for d in dots], f"at={at}|dot={'|'.join(dots)}", f"labels={labels}",
                f"last={last}", f"plain={plain}", f"further={further}", f"left={left}", f"right={right}", f"sign|left={left}"]
    _, shape, n, octets, checked, left, right = sig
    groups = [len(g) for g in re.findall("0+", shape)]
    marks = "".join(sorted(set(re.sub("0+", "", shape))))
    form = "-".join(map(str, groups)) if len(groups) <= 6 else "many"
    return ["number", f"n={n}", f"form={form}", f"marks={marks}", f"first={shape[0]}", f"octets={octets}|marks={marks}",
            f"luhn={checked}|n={min(max(n, 12), 17)}", f"luhn={checked}|form={form}", f"form={form}|marks={marks}",
            f"marks={marks}|n={n}", f"left={left}", f"right={right}", f"number|left={left}", f"number|right={right}"]


def candidates(text: str, a: int, b: int) -> tuple[list[int], list[tuple[int, int, tuple]]]:
    """(piece borders, (from, to, signature) of the segments of up to ``LONGEST`` pieces) of a region."""
    edges = [a, *[m.end() for m in _PIECES.finditer(text, a, b)]]
    out = []
    for i in range(len(edges) - 1):
        c = text[edges[i]]
        if c in " .-/)]}>@[{<":
            continue
        n = groups = 0
        for j in range(i + 1, min(len(edges), i + LONGEST + 1)):
            last = text[edges[j - 1]:edges[j]]
            if last[0].isdigit():
                n, groups = n + len(last), groups + 1
            if n > 40 or groups > MOST_GROUPS or last == "+" and j > i + 1:
                break
            sig = signature(text, edges[i], edges[j])
            if sig:
                out.append((i, j, sig))
    return edges, out


@dataclass
class Model:
    """Weights of (kind, feature), and of a kind after another (``len(KINDS)``: after none)."""

    weights: dict[tuple[int, str], float] = field(default_factory=dict)
    after: list[list[float]] = field(default_factory=lambda: [[0.0] * (len(KINDS) + 1) for _ in KINDS])

    def __post_init__(self) -> None:
        self.known: dict[tuple, list[float]] = {}

    def scores(self, sig: tuple) -> list[float]:
        got = self.known.get(sig)
        if got is None:
            if len(self.known) >= _REMEMBER:
                self.known.clear()
            fs, get = features(sig), self.weights.get
            got = self.known[sig] = [sum(get((k, f), 0.0) for f in fs) for k in range(len(KINDS))]
        return got

    def best(self, text: str, a: int, b: int) -> list[tuple[int, int, int]]:
        """The most likely segments of a region: (kind, start, end) in order. Each must pay ``MARGIN``."""
        edges, found = candidates(text, a, b)
        if not found:
            return []
        none = len(KINDS)
        by_end = defaultdict(list)
        for i, j, sig in found:
            s = self.scores(sig)
            if max(s) + max(map(max, self.after)) > MARGIN:
                by_end[j].append((i, s))
        if not by_end:
            return []
        # value[j][k]: the best of the pieces before border j, the last of them of kind k.
        value = [[-math.inf] * (none + 1) for _ in edges]
        back: list[list[tuple | None]] = [[None] * (none + 1) for _ in edges]
        value[0][none] = 0.0
        for j in range(1, len(edges)):
            k = max(range(none + 1), key=value[j - 1].__getitem__)
            value[j][none], back[j][none] = value[j - 1][k], (j - 1, k)
            for i, s in by_end.get(j, ()):
                for k in range(none):
                    p = max(range(none + 1), key=lambda p, k=k, i=i: value[i][p] + self.after[k][p])
                    v = value[i][p] + self.after[k][p] + s[k] - MARGIN
                    if v > value[j][k]:
                        value[j][k], back[j][k] = v, (i, p)
        j, k = len(edges) - 1, max(range(none + 1), key=value[-1].__getitem__)
        out = []
        while j:
            i, p = back[j][k]
            if k < none:
                out.append((k, edges[i], edges[j]))
            j, k = i, p
        return out[::-1]


def _sum(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


def gradient(model: Model, text: str, a: int, b: int,
             gold: list[tuple[int, int, int]]) -> tuple[float, dict, list[list[float]]]:
    """(log likelihood of the labelled segments of a region, its gradient by (kind, feature), and by transition).

    Forward and backward sums over all segmentations; segments that are no candidates cannot be labels and are left out.
    """
    none, (edges, found) = len(KINDS), candidates(text, a, b)
    n = len(edges)
    by_end, by_start = defaultdict(list), defaultdict(list)
    for i, j, sig in found:
        by_end[j].append((i, model.scores(sig)))
        by_start[i].append((j, model.scores(sig)))
    low = -math.inf
    front, rear = [[low] * (none + 1) for _ in edges], [[low] * (none + 1) for _ in edges]
    front[0][none] = 0.0
    for j in range(1, n):
        front[j][none] = _sum(front[j - 1])
        for k in range(none):
            terms = [s[k] + _sum([front[i][p] + model.after[k][p] for p in range(none + 1)]) for i, s in by_end[j]]
            if terms:
                front[j][k] = _sum(terms)
    rear[-1] = [0.0] * (none + 1)
    for i in range(n - 2, -1, -1):
        for p in range(none + 1):
            terms = [rear[i + 1][none]]
            terms += [s[k] + model.after[k][p] + rear[j][k] for j, s in by_start[i] for k in range(none)]
            rear[i][p] = _sum(terms)
    total = _sum(front[-1])
    at = {e: i for i, e in enumerate(edges)}
    known = {(i, j): sig for i, j, sig in found}
    labels = {(at[x], at[y]): k for k, x, y in gold if x in at and y in at and (at[x], at[y]) in known}
    grad, moved, own = defaultdict(float), [[0.0] * (none + 1) for _ in KINDS], 0.0
    ends = {j: k for (_, j), k in labels.items()}
    for (i, j), sig in known.items():
        s, fs = model.scores(sig), features(sig)
        for k in range(none):
            part = 0.0
            for p in range(none + 1):
                v = front[i][p] + model.after[k][p] + s[k] + rear[j][k] - total
                if v > -30:
                    e = math.exp(v)
                    part += e
                    moved[k][p] -= e
            if labels.get((i, j)) == k:
                part -= 1
                p = ends.get(i, none)
                moved[k][p] += 1
                own += s[k] + model.after[k][p]
            if abs(part) > 1e-6:
                for f in fs:
                    grad[k, f] -= part
    return own - total, grad, moved


def _made(rng: random.Random, kind: int | None) -> str:
    """A span of a kind in one of its known or other forms; None: a number, or a place or time after "at", of no kind."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    if kind == 0:
        at = rng.choice(["@", "[at]", " [at] ", "(at)", " (at) ", " at ", " @ ", "{at}", " [AT] "])
        dot = rng.choice([".", "[.]", "(dot)", " dot ", "[dot]", " (dot) "])
        if at == "@" and dot == ".":
            at = "[at]"
        if at == " at ":
            dot = rng.choice([" dot ", " [dot] "])
        name = word(rng.randint(2, 9)) + rng.choice(["", "." + d(2), "_" + word(3)])
        host = [word(rng.randint(3, 8)) + rng.choice(["", d(1)]) for _ in range(rng.randint(1, 3))]
        return name + at + dot.join([*host, rng.choice(["com", "org", "net", "de", "info"])])
    if kind == 1:
        return rng.choice([".", "[.]", "(.)"]).join(str(rng.randint(1, 255)) for _ in range(4))
    if kind == 2:
        n = rng.choice([15, 16, 16, 16, 19])
        own = rng.choice("3456") + d(n - 2)
        own += next(c for c in "0123456789" if luhn(own + c))
        sep = rng.choice(["", " ", "-", ".", "  ", " - ", "/"])
        return sep.join(own[i:i + 4] for i in range(0, n, 4))
    if kind == 3:
        area, a, b = d(3), d(3), d(4)
        return rng.choice([f"+1 ({area}) {a}-{b}", f"({area}) {a}-{b}", f"1 ({area}) {a}-{b}", f"{area}-{a}-{b}",
                           f"1-{area}-{a}-{b}", f"({area}) {a} {b}", f"001 {area} {a} {b}", f"+49 {d(3)} {d(7)}",
                           f"({area}) {a}.{b}", f"{area} {a}-{b}", f"+1 {area} {a} {b}"])
    bad = rng.choice("3456") + d(15)
    if luhn(bad):
        bad = bad[:-1] + str((int(bad[-1]) + 1) % 10)
    many = [str(rng.randint(0, 9999)) for _ in range(rng.randint(2, 9))]
    return rng.choice([
        bad, d(rng.randint(4, 14)), f"20{d(2)}-{d(2)}-{d(2)}", f"{d(2)}.{d(2)}.20{d(2)}", f"{d(1)}.{d(1)}.{d(2)}", f"{d(3)}.{d(2)}",
        f"{rng.randint(300, 999)}.{d(3)}.{d(2)}.{d(1)}", f"{d(4)}-{d(4)}", f"{d(3)}-{d(4)}", " ".join(many), f"{d(2)}/{d(2)}/20{d(2)}",
        f"20{d(2)} {d(4)}", f"{d(5)}-{d(4)}", f"{d(8)} {d(6)}", d(16) if not luhn("1" + d(15)) else bad, f"{d(3)} {d(3)} {d(3)}",
        f"20{d(2)}-{d(2)}-{d(2)} {d(2)}", f"{bad} {d(5)}", f"{d(4)} {d(4)} {d(4)}", f"{d(2)}-{d(3)}-{d(2)}", f"1.{d(1)}.{d(1)}.{d(4)}",
        *[f"20{d(2)}-{d(2)}-{d(2)} at {d(2)}.{d(2)}", f"{word(5)} at {d(2)}.{d(2)}", f"{word(6)} at {word(6)}.{word(3)}",
          f"{word(4)} at {word(5)}.{word(4)}.{word(2)}", f"{d(4)} @ {d(1)}.{d(2)}"] * 2])


Example = tuple[str, int, int, list[tuple[int, int, int]]]


def generated(n: int = GENERATED, seed: int = 7) -> list[Example]:
    """(text, region, its segments) of made-up spans: alone, at other signs, beside other numbers."""
    rng, out = random.Random(seed), []
    for kind in [*range(len(KINDS)), None, None, None]:
        for _ in range(n):
            span = _made(rng, kind)
            before = rng.choice(["", "see ", "x "] if kind == 0 else ["", "a ", "word ", "12 ", "x: ", "(", "# "])
            after = rng.choice(["", " and", ". A"] if kind == 0 else ["", " a", ". A", ", b", " 7", ")"])
            text, at = f"w {before}{span}{after} w", 2 + len(before)
            for a, b in regions(text):
                inside = [(kind, at, at + len(span))] if kind is not None and a <= at and at + len(span) <= b else []
                out.append((text, a, b, inside))
    rng.shuffle(out)
    return out


def train(examples: list[Example], passes: int = PASSES, rate: float = 0.4, decay: float = 1e-3) -> Model:
    """Weights by stochastic gradient ascent of the likelihood, steps scaled by each weight's past gradients."""
    model, seen = Model(), defaultdict(lambda: 1e-2)
    past = [[1e-2] * (len(KINDS) + 1) for _ in KINDS]
    for _ in range(passes):
        for text, a, b, gold in examples:
            _, grad, moved = gradient(model, text, a, b, gold)
            for key, g in grad.items():
                g -= decay * model.weights.get(key, 0.0)
                seen[key] += g * g
                model.weights[key] = model.weights.get(key, 0.0) + rate * g / math.sqrt(seen[key])
            for k, row in enumerate(moved):
                for p, g in enumerate(row):
                    past[k][p] += g * g
                    model.after[k][p] += rate * g / math.sqrt(past[k][p])
            model.known.clear()
    return model


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of up to ``FIT_REGIONS`` distinct regions of at most ``FIT_LENGTH`` characters, and generated ones.

    The regions are those of about ``FIT_DOCS`` documents, chosen by a hash of id and text; what the patterns find in
    them are the labels. They reach the driver: some hundred KB.
    """
    ship(docs.sparkSession)
    total = max(1, docs.count())
    h = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(11)), F.lit(1 << 30))
    some = docs.select(id_col, text_col).where(h < int(min(1.0, FIT_DOCS / total) * (1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, labels = [], []
            for t in map(bytes.decode, raw(b.column(1))):
                spans = base_spans(t)
                for a, z in regions(t):
                    if z - a <= FIT_LENGTH:
                        texts.append(f"{t[a - 1:a] if a else ' '}{t[a:z]}{t[z:z + 1]}")
                        labels.append(render([(k, x - a + 1, y - a + 1) for k, x, y in spans if a <= x and y <= z]))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(labels, pa.string())],
                                             names=["region", "labels"])

    found = hash_sample(some.mapInArrow(run, "region string, labels string").distinct(), FIT_REGIONS, "region", "labels")
    examples = []
    for r in sorted((r["region"], r["labels"]) for r in found.collect()):
        gold, end = [], 0
        spans = [x.split(":") for x in r[1].split(",") if x]
        for k, x, y in sorted(((KINDS.index(k), int(x), int(y)) for k, x, y in spans), key=lambda s: (s[1], -s[2])):
            if x >= end:  # where patterns overlap, the first and longest is the label
                gold.append((k, x, y))
                end = y
        for a, b in regions(r[0]):
            examples.append((r[0], a, b, [g for g in gold if a <= g[1] and g[2] <= b]))
    examples += generated()
    random.Random(5).shuffle(examples)
    return train(examples)


def added(model: Model, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The model's spans outside the base spans."""
    where = regions(text)
    if not where:
        return []
    cuts = sorted((a, b) for _, a, b in base)
    out = []
    for a, b in outside(where, cuts) if cuts else where:
        out += model.best(text, a, b)
    return out


def spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added) per row of ``docs``: the spans as text (kind:start:end, in code points, by kind, then start)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            base, every = [], []
            for t in map(bytes.decode, raw(b.column(1))):
                own = base_spans(t)
                base.append(render(own))
                every.append(render(sorted(own + added(m, t, own))))
            counts = [pa.array([s.count(f"{k}:") for s in base], pa.int64()) for k in KINDS]
            digests = pa.array([hashlib.sha256(s.encode()).hexdigest() for s in base], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, digests, pa.array(every, pa.string())], names=names)

    names = [id_col, *[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"{id_col} {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row of ``docs``.

    The counts and the digest are those of the base spans; spans holds these and the model's. A null text is the empty
    one. Repeated rows, and rows without an id, keep a row each; other columns are ignored; an empty table gives no row.
    Time grows with the length of a text, whatever it holds.
    """
    return spans(docs, fit(docs, id_col, text_col), id_col, text_col)
