"""JSON text as a sequence of tokens: cleaning and printing without leaving the JVM.

A JSON text is cut into strings, marks and literals by one regular expression; operators are folds over that array.
Numbers are printed as they are written, repeated keys stay, and escapes are normalised only in strings that have any.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A string. Possessive, since a repeated choice would take a stack frame for each character.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
TOKEN = _STRING + r'|[{}\[\],:]|[^\s{}\[\],:"]+'
#: Values that mean "nothing known", as a whole string.
PLACEHOLDER = r'(?i)^"\s*(?:unknown|none|null|n/?a)\s*"$'
UNSPECIFIED = '"unspecified"'
#: A string that ``_normal`` leaves as it is; a stretch without brackets outside of strings; an object's member.
_EVEN = r'"[^"\\]*+(?:\\["\\bfnrt][^"\\]*+)*+"'
_STRETCH = rf'[^\[\]{{}}"\\]*+(?:{_EVEN}[^\[\]{{}}"\\]*+)*+'
_MEMBER = rf'\s*+({_EVEN})\s*+:\s*+({_EVEN}|[^\s,:"{{}}]++)\s*+(,?)'
#: Objects in an object, no deeper, without lists.
_NESTED = rf"^\s*+\{{{_STRETCH}(?:\{{{_STRETCH}\}}{_STRETCH})*+\}}\s*+$"
_FLAT = rf"^\s*+\{{{_STRETCH}\}}\s*+$"
#: A value that is a placeholder, and what stands before it from the last one on.
_PLACE = r'(?:null|"\s*+(?i:unknown|none|null|n/?a)\s*+")(?!\s*+:)'
_CLEANED = rf'\G((?:(?!{_PLACE})(?:{_STRING}|[^"n]++|n))*+){_PLACE}'
#: Stands for an inner object; no JSON text has it unescaped.
_MARK = "\x01"


def tokens(text: Column) -> Column:
    """The tokens of a JSON text; none for a null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def quoted(text: Column) -> Column:
    """``text`` as a JSON string."""
    whole = F.to_json(F.struct(text.alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def cleaned(parts: Column) -> Column:
    """P27 on tokens: placeholder strings and nulls that are values become ``unspecified``, at any depth."""
    def clean(t: Column, i: Column) -> Column:
        value = ~F.get(parts, i + 1).eqNullSafe(":")
        return F.when(value & ((t == "null") | t.rlike(PLACEHOLDER)), F.lit(UNSPECIFIED)).otherwise(t)
    return F.transform(parts, clean)


def cleaned_text(text: Column) -> Column:
    """``cleaned`` on the text of one JSON value."""
    return F.regexp_replace(text, _CLEANED, f"$1{UNSPECIFIED}")


def _normal(t: Column) -> Column:
    """A string with escapes, escaped afresh; any other token as it is."""
    plain = F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<string>")[0]
    return F.when(t.startswith('"') & F.contains(t, F.lit("\\")), quoted(plain)).otherwise(t)


def indented(parts: Column, depth: int = 0) -> Column:
    """Tokens as text with two spaces per level, as ``json.dumps(indent=2)`` sets it; ``depth``: levels around it."""
    state = F.struct(F.lit("").alias("out"), F.lit(depth).alias("depth"), F.lit("").alias("last"))
    pairs = F.transform(parts, lambda t, i: F.struct(t.alias("t"), F.coalesce(F.get(parts, i + 1), F.lit("")).alias("next")))

    def line(levels: Column) -> Column:
        return F.concat(F.lit("\n"), F.repeat(F.lit("  "), levels))

    def step(s: Column, x: Column) -> Column:
        t = x["t"]
        opens, closes = t.isin("{", "["), t.isin("}", "]")
        after = s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        piece = (F.when(opens, F.when(x["next"].isin("}", "]"), t).otherwise(F.concat(t, line(after))))
                 .when(closes, F.when(s["last"].isin("{", "["), t).otherwise(F.concat(line(after), t)))
                 .when(t == ",", F.concat(t, line(after))).when(t == ":", F.lit(": ")).otherwise(_normal(t)))
        return F.struct(F.concat(s["out"], piece).alias("out"), after.alias("depth"), t.alias("last"))

    return F.aggregate(pairs, state, step, lambda s: s["out"])


def is_nested(text: Column) -> Column:
    """Whether a JSON text is one object of scalars and objects of scalars, nothing follows it, and its strings hold short
    escapes only: it is printed without a fold."""
    return text.rlike(_NESTED)


def _body(text: Column, depth: int) -> Column:
    """An object's text without its braces, a member a line, those lines ``depth`` levels deep."""
    return F.regexp_replace(text, _MEMBER, "\n" + "  " * depth + "$1: $2$3")


def nested_parts(text: Column, depth: int = 0) -> Column:
    """A text that ``is_nested``, apart: what stands ``around`` inner objects and what stands ``inside`` them, both kinds of
    members set by one replacement each. Stage it as a column: a lambda's own arguments are worked out afresh."""
    bare = F.regexp_replace(text, r"^\s*+\{\s*+|\s*+\}\s*+$", "")
    inner = F.array_join(F.regexp_extract_all(bare, F.lit(rf"\G{_STRETCH}\{{({_STRETCH})\}}"), F.lit(1)), _MARK)
    outer = F.regexp_replace(bare, rf"\G({_STRETCH})\{{{_STRETCH}\}}", f"$1{_MARK}")
    return F.struct(F.split(_body(outer, depth + 1), _MARK).alias("around"), F.split(_body(inner, depth + 2), _MARK).alias("inside"))


def nested_object(parts: Column, depth: int = 0) -> Column:
    """``indented`` for the text of which ``parts`` are the ``nested_parts``: its lambda sees each inner object, not each
    token."""
    close = "\n" + "  " * (depth + 1) + "}"

    def put(a: Column, i: Column) -> Column:
        i = F.get(parts["inside"], i)
        return F.concat(a, F.when(F.btrim(i) == "", F.lit("{}")).otherwise(F.concat(F.lit("{"), i, F.lit(close))))

    around = parts["around"]
    n = F.size(around)
    joined = F.concat(F.array_join(F.transform(F.slice(around, F.lit(1), n - 1), put), ""), F.element_at(around, -1))
    return F.when(joined == "", F.lit("{}")).otherwise(F.concat(F.lit("{"), joined, F.lit("\n" + "  " * depth + "}")))


def indented_object(text: Column, depth: int = 0) -> Column:
    """A JSON object's text as ``indented`` prints it: a flat one by one replacement over its members, one with objects
    inside by ``nested_object``, any other by the fold over its tokens."""
    bare = F.regexp_replace(text, r"^\s*+\{\s*+|\s*+\}\s*+$", "")
    flat = F.concat(F.lit("{"), _body(bare, depth + 1), F.lit("\n" + "  " * depth + "}"))
    return (F.when(text.rlike(r"^\s*+\{\s*+\}\s*+$"), F.lit("{}")).when(text.rlike(_FLAT), flat)
            .when(is_nested(text), F.get(F.transform(F.array(nested_parts(text, depth)), lambda p: nested_object(p, depth)), 0))
            .otherwise(indented(tokens(text), depth)))


def object_entries(text: Column) -> Column:
    """``entries`` of an object's text: those of a flat one by its members, of any other by the fold over its tokens."""
    kind = "array<struct<key:string,value:string>>"
    members = F.arrays_zip(*[F.regexp_extract_all(text, F.lit(_MEMBER), F.lit(g)) for g in (1, 2)]).cast(kind)
    return F.when(text.rlike(_FLAT), members).otherwise(entries(tokens(text)))


def entries(parts: Column) -> Column:
    """The (key, value) pairs of an object's tokens, in order: the quoted key, and the value on one line."""
    kind = "array<struct<key:string,value:string>>"
    state = F.struct(F.lit(0).alias("depth"), F.lit("").alias("key"), F.lit("").alias("value"),
                     F.array().cast(kind).alias("out"))

    def step(s: Column, t: Column) -> Column:
        opens, closes = t.isin("{", "["), t.isin("}", "]")
        after = s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        own = s["depth"] == 1
        ends = own & (s["key"] != "") & ((t == ",") | closes)
        names = own & (s["key"] == "") & t.startswith('"')
        skips = ((s["depth"] == 0) & opens) | names | ends | (own & ((t == ",") | closes)) | (
            own & (t == ":") & (s["value"] == ""))
        piece = F.when(t == ",", F.lit(", ")).when(t == ":", F.lit(": ")).otherwise(_normal(t))
        return F.struct(
            after.alias("depth"), F.when(ends, F.lit("")).when(names, _normal(t)).otherwise(s["key"]).alias("key"),
            F.when(skips, F.lit("")).otherwise(F.concat(s["value"], piece)).alias("value"),
            F.when(ends, F.concat(s["out"], F.array(F.struct(s["key"].alias("key"), s["value"].alias("value")))))
            .otherwise(s["out"]).alias("out"))

    return F.aggregate(parts, state, step, lambda s: s["out"])


def without_nulls(parts: Column, preserve: tuple[str, ...] = ()) -> Column:
    """P6 on an object's tokens: members that are null go, in objects inside objects too, but not inside lists; keys in
    ``preserve`` stay. The result is the object on one line."""
    kind = "array<string>"
    state = F.struct(F.lit(0).alias("lists"), F.array().cast(kind).alias("out"))
    keys = F.array(*[F.lit(f'"{k}"') for k in preserve]) if preserve else F.array().cast(kind)
    around = F.transform(parts, lambda t, i: F.struct(
        t.alias("t"), F.coalesce(F.get(parts, i - 2), F.lit("")).alias("b2"), F.coalesce(F.get(parts, i - 1), F.lit("")).alias("b1"),
        F.coalesce(F.get(parts, i + 1), F.lit("")).alias("a1"), F.coalesce(F.get(parts, i + 2), F.lit("")).alias("a2")))

    def step(s: Column, x: Column) -> Column:
        t, out = x["t"], s["out"]
        last = F.coalesce(F.element_at(F.concat(F.array(F.lit("")), out), -1), F.lit(""))
        gone = (s["lists"] == 0) & (
            ((x["a1"] == ":") & (x["a2"] == "null") & ~F.array_contains(keys, t))
            | ((t == ":") & (x["a1"] == "null") & ~F.array_contains(keys, x["b1"]))
            | ((t == "null") & (x["b1"] == ":") & ~F.array_contains(keys, x["b2"])))
        # A comma with nothing before it goes; one with nothing after it is taken back.
        idle = (t == ",") & last.isin("{", "[", ",")
        back = t.isin("}", "]") & (last == ",")
        return F.struct(
            (s["lists"] + F.when(t == "[", 1).when(t == "]", -1).otherwise(0)).alias("lists"),
            F.when(gone | idle, out).when(back, F.concat(F.slice(out, 1, F.size(out) - 1), F.array(t)))
            .otherwise(F.concat(out, F.array(t))).alias("out"))

    shown = F.transform(F.aggregate(around, state, step, lambda s: s["out"]),
                        lambda t: F.when(t == ",", F.lit(", ")).when(t == ":", F.lit(": ")).otherwise(_normal(t)))
    return F.array_join(shown, "")
