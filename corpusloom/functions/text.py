"""String helpers with Python's notion of whitespace and line ends."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters for which Python's str.isspace() is true.
WHITESPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# The line ends str.splitlines() knows.
LINE_END = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029])"


def strip(c: Column) -> Column:
    head = F.regexp_replace(c, rf"\A{WHITESPACE}++", "")
    return F.regexp_replace(head, rf"(?<!{WHITESPACE}){WHITESPACE}++\z", "")


def is_blank(c: Column) -> Column:
    return ~c.rlike(rf"[^{WHITESPACE[1:-1]}]")


def split_whitespace(c: Column) -> Column:
    return F.array_remove(F.split(c, rf"{WHITESPACE}+"), "")


def line_count(c: Column) -> Column:
    """Number of lines as ``len(s.splitlines())`` counts them."""
    unfinished = (F.length(c) > 0) & ~c.rlike(rf"{LINE_END}\z")
    return F.regexp_count(c, F.lit(LINE_END)) + unfinished.cast("int")


def newline_count(c: Column) -> Column:
    """Line feeds plus one."""
    return F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1


def replace_first(text: Column, old: Column, new: str) -> Column:
    """Replace the first literal occurrence; no pattern language is involved."""
    at = F.instr(text, old)
    replaced = F.concat(
        F.substring(text, F.lit(1), at - 1),
        F.lit(new),
        F.substring(text, at + F.length(old), F.length(text)),
    )
    return F.when(at == 0, text).otherwise(replaced)


def first_non_empty(*cols: Column) -> Column:
    """First value that is neither null nor the empty string; null when there is none."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def repo_short_name(url: Column) -> Column:
    """``name`` of ``https://host/owner/name`` or ``git@host:owner/name.git``."""
    return F.regexp_extract(strip(url), r"([^/:]+?)(?:\.git)?/?\z", 1)


def repo_full_name(url: Column) -> Column:
    """``owner/name`` of the same addresses."""
    return F.regexp_extract(strip(url), r"([^/:]+/[^/:]+?)(?:\.git)?/?\z", 1)
