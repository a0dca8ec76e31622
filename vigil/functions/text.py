"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigil.functions import fixed

# Every code point Python's str.split() treats as whitespace (str.isspace),
# written out because Java's \s and (?U)\s each miss some of them.
WHITESPACE_CLASS = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+"
)


PY_WS = WHITESPACE_CLASS[:-1]


# The same code points as characters, for btrim (which only touches the two ends).
PY_WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
               + "\u2028\u2029\u202f\u205f\u3000")


def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of every kind."""
    return F.btrim(c, F.lit(PY_WS_CHARS))


def first_char(c: Column) -> Column:
    """First character that is no whitespace; only the front of the text is looked at."""
    return F.substring(F.ltrim(c, F.lit(PY_WS_CHARS)), 1, 1)


def collapse_whitespace(c: Column) -> Column:
    """P5: runs of any whitespace -> one space, trimmed."""
    return F.trim(F.regexp_replace(c, WHITESPACE_CLASS, " "))


def title_pattern(title: Column) -> Column:
    """Text before the first ':' (trimmed), else the first 20 characters."""
    t = F.coalesce(title, F.lit(""))
    return F.when(F.instr(t, ":") > 0, F.trim(F.substring_index(t, ":", 1))).otherwise(F.substring(t, 1, 20))


def command_basename(cmd: Column) -> Column:
    """Last '/' segment."""
    return F.substring_index(cmd, "/", -1)


def generic_rationale(r: Column) -> Column:
    """Empty, shorter than 20 characters, or containing a generic phrase (case-insensitive)."""
    stripped = py_strip(F.coalesce(r, F.lit("")))
    return (F.length(stripped) < 20) | F.lower(stripped).rlike(
        "|".join(regex_escape(p) for p in fixed.GENERIC_RATIONALE_PHRASES))


def regex_escape(s: str) -> str:
    import re
    return re.sub(r"([\\^$.|?*+()\[\]{}/])", r"\\\1", s)


def strip_think(t: Column) -> Column:
    """Remove one wrapping <think>...</think>."""
    s = py_strip(t)
    return F.when(s.rlike("(?s)^<think>.*</think>$"),
                  py_strip(F.regexp_extract(s, "(?s)^<think>(.*)</think>$", 1))).otherwise(t)


PLACEHOLDER_RE = "(?i)^(unknown|none|null|na|n/a)$"


def is_placeholder(c: Column) -> Column:
    """P27 leaf test: null or a whole-string placeholder word (case-insensitive)."""
    return c.isNull() | F.trim(c).rlike(PLACEHOLDER_RE)


def sql_text(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
