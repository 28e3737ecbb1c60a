"""String Column functions.

All are built-in expressions, so they stay inside whole-stage codegen.  Java
regular expressions are used; helpers exist only where Spark's default
differs from the semantics needed (first-match replace, null on no match,
non-truncating pad, null-safe match).
"""
from __future__ import annotations

import sys
from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body refers to it.

    Spark shares repeated subexpressions only where they are always evaluated, not inside the branches of
    a ``CASE``; a bound value is an element of a one-element array, and the body a lambda over it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def flagged(pattern: str, ignore_case: bool = False) -> str:
    """Case-insensitive with Unicode case folding (``(?iu)``): Java's bare
    ``(?i)`` folds ASCII only, the reference's and DuckDB's fold Unicode."""
    return f"(?iu){pattern}" if ignore_case else pattern


def _fold_char(ch: str) -> str:
    """The character that Java's Unicode case-insensitive match reduces ``ch`` to: the simple (one to one)
    lower case of its simple upper case.  Where Python's mapping expands, the title case
    is the simple one, or there is none.  Capital sharp s stays apart: a pattern matches it with the small one
    inside a run of letters, but not where either stands as a letter of its own."""
    if ch == "\u1e9e":
        return ch
    up = next((x for x in (ch.upper(), ch.title()) if len(x) == 1), ch)
    return "i" if up == "\u0130" else up.lower() if len(up.lower()) == 1 else up


@lru_cache(maxsize=1)
def fold_table() -> tuple[str, str]:
    """Characters that folding changes, and what it makes of them."""
    pairs = [(ch, f) for ch in map(chr, range(sys.maxunicode + 1)) if (f := _fold_char(ch)) != ch]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold(c: ColumnOrName) -> Column:
    """A key under which two texts are equal exactly if a ``(?iu)`` pattern of the one matches the other: character by
    character, so the length stays.  (``lower()`` is not that: it maps İ, ſ, ς and the Kelvin sign otherwise.)"""
    a, b = fold_table()
    x = col(c)
    return F.when(x.rlike(r"[^\x00-\x7F]"), F.translate(x, a, b)).otherwise(F.lower(x))


def _escape_replacement(rep: str) -> str:
    return rep.replace("\\", "\\\\").replace("$", "\\$")


# T1 ---------------------------------------------------------------------------
def squish(c: ColumnOrName) -> Column:
    """Trim both ends and collapse every whitespace run to one space."""
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


# T2 / T3 ----------------------------------------------------------------------
def replace_first(c: ColumnOrName, pattern: str, replacement: str = "",
                  ignore_case: bool = False) -> Column:
    """Replace only the leftmost match (``regexp_replace`` replaces all).

    The lazy prefix group stops at the leftmost position where ``pattern``
    matches; everything after the first match is left as is."""
    p = f"^([\\s\\S]*?)(?:{flagged(pattern, ignore_case)})"
    return F.regexp_replace(col(c), p, "$1" + _escape_replacement(replacement))


def remove_first(c: ColumnOrName, pattern: str, ignore_case: bool = False) -> Column:
    return replace_first(c, pattern, "", ignore_case)


def replace_all(c: ColumnOrName, pattern: str, replacement: str = "",
                ignore_case: bool = False) -> Column:
    return F.regexp_replace(col(c), flagged(pattern, ignore_case), _escape_replacement(replacement))


def remove_all(c: ColumnOrName, pattern: str, ignore_case: bool = False) -> Column:
    return replace_all(c, pattern, "", ignore_case)


# T4 / T5 ----------------------------------------------------------------------
def extract_first(c: ColumnOrName, pattern: str, group: int = 0, ignore_case: bool = False) -> Column:
    """First match, or NULL when nothing matches (``regexp_extract`` gives '')."""
    return F.nullif(F.regexp_extract(col(c), flagged(pattern, ignore_case), group), F.lit(""))


# T6 / T7 ----------------------------------------------------------------------
def to_upper(c: ColumnOrName) -> Column:
    return F.upper(col(c))


def to_title(c: ColumnOrName) -> Column:
    """Title case; words are whitespace-delimited (``initcap``)."""
    return F.initcap(col(c))


# T8 ---------------------------------------------------------------------------
def pad_left(c: ColumnOrName, width: int, pad: str = "0") -> Column:
    """Left pad WITHOUT truncation: values already ``width`` or longer are kept
    whole (plain ``lpad`` would cut ``'19153'`` to ``'191'``)."""
    s = col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, pad)).otherwise(s)


# T9 / T10 / Q1 ----------------------------------------------------------------
def to_text(c: ColumnOrName, missing_token: str | None = None) -> Column:
    """Text of a value.  ``missing_token="missing"`` reproduces the reference's
    printing of a missing value; the default keeps NULL."""
    s = col(c).cast("string")
    return F.coalesce(s, F.lit(missing_token)) if missing_token is not None else s


def text_length(c: ColumnOrName, missing_token: str | None = None) -> Column:
    return F.length(to_text(c, missing_token))


# F6 ---------------------------------------------------------------------------
def code_length_is(c: ColumnOrName, n: int, missing_token: str | None = None) -> Column:
    """``length(string(code)) == n``.  With the default a NULL code is rejected;
    ``missing_token="missing"`` makes a missing 7-digit code pass, as coded."""
    return F.coalesce(text_length(c, missing_token) == n, F.lit(False))


code_length = code_length_is


# F7 ---------------------------------------------------------------------------
def safe_match(c: ColumnOrName, pattern: str, ignore_case: bool = False) -> Column:
    """Regex search that is FALSE (never NULL) on a missing value."""
    return F.coalesce(col(c).rlike(flagged(pattern, ignore_case)), F.lit(False))


# T11 --------------------------------------------------------------------------
def escape_literal(value: str) -> str:
    """Escape a literal for a Java regex: every non-word character gets a
    backslash (letters and digits are never escaped, so no escape turns into a
    special class)."""
    return "".join(ch if (ch.isalnum() or ch in " _") else "\\" + ch for ch in value)


def _trie_pattern(values: list[str]) -> str:
    """Alternation of literals factored as a prefix trie.  Children are
    emitted in character order with the word-end branch first, so the order
    in which a backtracking engine tries the words at one start position is
    exactly the ascending order of the flat alternation (same first match),
    while each position costs O(trie depth) instead of O(#words)."""
    trie: dict = {}
    for v in values:
        node = trie
        for ch in v:
            node = node.setdefault(ch, {})
        node[""] = {}

    def emit(node: dict) -> str:
        alts = ["" if k == "" else escape_literal(k) + emit(node[k]) for k in sorted(node)]
        return alts[0] if len(alts) == 1 else "(?:" + "|".join(alts) + ")"
    return emit(trie) if trie else ""


def alternation_regex(values: Iterable[str | None], word_boundary: bool = True,
                      ignore_case: bool = True, sort: bool = True, trie: bool = True) -> str:
    """``\\b(?:a|b|c)\\b`` from literal values: trims, drops missing and empty
    values (an empty alternative would match everywhere), escapes properly and
    keeps ascending order so that, at one start position, the first listed
    alternative that matches wins.  ``trie=True`` factors common prefixes
    (same matches, far fewer attempts for large dictionaries)."""
    vals = [v.strip() for v in values if v is not None and v.strip() != ""]
    vals = sorted(set(vals)) if sort else list(dict.fromkeys(vals))
    body = _trie_pattern(vals) if (trie and sort) else "|".join(escape_literal(v) for v in vals)
    pat = f"\\b(?:{body})\\b" if word_boundary else f"(?:{body})"
    return flagged(pat, ignore_case)


# T14 / T15 --------------------------------------------------------------------
def n_pct_label(n: ColumnOrName, share: ColumnOrName) -> Column:
    """``"n (p%)"``: ``p = round(share*100, 2)`` printed in shortest form
    (``12.5%``, ``100.0%``)."""
    p = F.round(col(share) * 100, 2)
    return F.concat(col(n).cast("string"), F.lit(" ("), p.cast("string"), F.lit("%)"))


def pct_fixed(share: ColumnOrName, digits: int = 2) -> Column:
    """``{:.2%}``: fixed decimals, e.g. ``"12.50%"``."""
    return F.concat(F.format_number(col(share) * 100, digits), F.lit("%"))


def with_commas(n: ColumnOrName) -> Column:
    """Integer with thousands separators (``1,234``)."""
    return F.format_number(col(n), 0)


# T16 --------------------------------------------------------------------------
def non_alnum_to_space(c: ColumnOrName) -> Column:
    return F.regexp_replace(col(c), r"[^A-Za-z0-9\s]+", " ")


def strip_chars(c: ColumnOrName, chars: str = "\"") -> Column:
    return F.regexp_replace(col(c), "[" + "".join("\\" + ch for ch in chars) + "]", "")
