"""Secret scan with a trigram inverted index.

Each rule's regular expression is analysed into a Boolean query over trigrams that
every match must contain (of ASCII-lower-cased bytes, so one index serves all rules).
The index is partitioned by document, as search engines do: a task builds, for each block of
texts, the postings of the rules' trigrams (no other trigram can
matter), evaluates each query by intersecting and uniting postings,
and verifies only the texts that remain with the expression itself.  A rule
without mandatory trigrams verifies every text.  Nothing is shuffled.
"""
from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre  # type: ignore[attr-defined]
from re import _parser as sre_parse  # type: ignore[attr-defined]

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm import textbytes

BLOCK_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches whose ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    ignore_case: bool = False

    @functools.cached_property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


#: The three base kinds, in the order in which equal starts are listed.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),  # runs are maximal, so shorter ones need not be matched and dropped
)
#: A private key: up to its END line; where that is missing, over the lines and long or padded words of key characters that follow.
_KEY = (r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----"
        r"(?:(?:[^-]|-(?!----(?:BEGIN|END) ))*+-----END \1-----"
        r"|(?:(?:\s|\\[nr])*+(?:Proc-Type|DEK-Info): ?[A-Za-z0-9,-]++)*+"
        r"(?:(?:\s|\\[nr])*+(?:[A-Za-z0-9+/]{16,}+=*+|[A-Za-z0-9+/]++=++)"
        r"|[^\S\n]*+(?:\n|(?:\\r)?\\n)[^\S\n]*+[A-Za-z0-9+/]++(?=[^\S\n]*+(?:\n|\\[nr]|\Z)))*+)")
#: Public key formats beyond the base kinds.
MORE_RULES = (
    Rule("private_key", _KEY),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{16,}"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"),
    Rule("stripe", r"\b[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    # from the start of a run of scheme characters (or after one sign before it), up to the "@" of the host
    Rule("url_login", r"(?:(?<![a-z0-9+.-])|(?<=[+.-])(?<![a-z0-9+.-]{2}))[a-z][a-z0-9+.-]*+://[^\s/:@]*+:[^\s/@]++(?=@[a-z0-9])", 0, 0, True),
)
RULES = BASE_RULES + MORE_RULES

# Boolean queries: None (no condition), ("and", [..]), ("or", [..]) or a trigram (bytes)
MOST_STRINGS = 32


def _both(a, b):
    if a is None or b is None:
        return b if a is None else a
    return ("and", [a, b])


def _either(parts):
    return None if any(p is None for p in parts) else ("or", list(parts))


def _of_strings(strings):
    """Condition that one of the strings occurs."""
    def one(s: str):
        raw = s.lower().encode()
        grams = sorted({raw[i:i + 3] for i in range(len(raw) - 2)})
        return ("and", grams) if grams else None
    return _either([one(s) for s in strings])


def _strings(node) -> list[str] | None:
    """All strings that a parsed part can match, if they are few and known."""
    op, arg = node
    if op is sre.LITERAL:
        return [chr(arg)]
    if op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
        return [chr(c) for _, c in arg]
    if op is sre.SUBPATTERN:
        return _strings_of(arg[3])
    if op is sre.BRANCH:
        found = [_strings_of(b) for b in arg[1]]
        return None if any(f is None for f in found) else [s for f in found for s in f]
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] is not sre.MAXREPEAT and arg[1] <= 4:
        one, out = _strings_of(arg[2]), []
        if one is None:
            return None
        for k in range(arg[0], arg[1] + 1):
            more = [""]
            for _ in range(k):
                more = [a + b for a in more for b in one]
            out += more
        return out if len(out) <= MOST_STRINGS else None
    if op is sre.AT or op in (sre.ASSERT, sre.ASSERT_NOT):
        return [""]
    return None


def _strings_of(seq) -> list[str] | None:
    out = [""]
    for node in seq:
        s = _strings(node)
        if s is None or len(out) * len(s) > MOST_STRINGS:
            return None
        out = [a + b for a in out for b in s]
    return out


def _query(seq):
    """Condition that holds for every text with a match of the parsed sequence."""
    out, run = None, [""]
    for node in seq:
        s = _strings(node)
        if s is not None and len(run) * len(s) <= MOST_STRINGS:
            run = [a + b for a in run for b in s]
            continue
        out, run = _both(out, _of_strings(run)), [""]
        op, arg = node
        if s is not None:
            run = s
        elif op is sre.SUBPATTERN:
            out = _both(out, _query(arg[3]))
        elif op is sre.BRANCH:
            out = _both(out, _either([_query(b) for b in arg[1]]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
            out = _both(out, _query(arg[2]))
    return _both(out, _of_strings(run))


@functools.lru_cache(maxsize=256)
def trigram_query(pattern: str):
    """The pattern's Boolean trigram query; None if it has no mandatory trigram."""
    return _query(sre_parse.parse(pattern, re.ASCII))


def _grams(query) -> set[bytes]:
    if query is None:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*(_grams(q) for q in query[1]))


_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


class TrigramIndex:
    """Postings of the rules' trigrams over one block of texts after another."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.grams = sorted(set().union(*map(_grams, self.queries)))
        self.number = {g: i for i, g in enumerate(self.grams)}
        self.code = np.zeros(1 << 24, dtype=np.uint16)
        for g, i in self.number.items():
            self.code[int.from_bytes(g, "big")] = i + 1

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Boolean (trigram, text): which texts hold which of the trigrams."""
        held = np.zeros((len(self.grams), len(offsets) - 1), dtype=bool)
        lo, hi = int(offsets[0]), int(offsets[-1])
        for at in range(lo, hi, BLOCK_BYTES):
            part = _LOWER[data[at:min(hi, at + BLOCK_BYTES + 2)]].astype(np.uint32)
            if len(part) < 3:
                continue
            gram = self.code[part[:-2] << 16 | part[1:-1] << 8 | part[2:]]
            pos = np.flatnonzero(gram)
            text = np.searchsorted(offsets, pos + at, side="right") - 1
            inside = pos + at + 3 <= offsets[text + 1]
            held[gram[pos[inside]] - 1, text[inside]] = True
        return held

    def candidates(self, query, held: np.ndarray) -> np.ndarray:
        if query is None:
            return np.ones(held.shape[1], dtype=bool)
        if isinstance(query, bytes):
            return held[self.number[query]]
        parts = [self.candidates(q, held) for q in query[1]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce(parts)

    def spans(self, texts: pa.Array) -> Iterator[list[tuple[int, int, int]]]:
        """(start, rule number, end) of each text's matches, in that order; code points."""
        data, offsets = textbytes.buffers(texts)
        for i, j in textbytes.groups(offsets, BLOCK_BYTES):
            held = self.postings(data, offsets[i:j + 1])
            todo = np.array([self.candidates(q, held) for q in self.queries])
            for k in range(j - i):
                found = []
                rules = np.flatnonzero(todo[:, k])
                if len(rules):
                    text = data[offsets[i + k]:offsets[i + k + 1]].tobytes().decode("utf-8", "replace")
                    for n in rules:
                        rule = self.rules[n]
                        found += [(m.start(), int(n), m.end()) for m in rule.regex.finditer(text)
                                  if m.end(rule.group) - m.start(rule.group) >= rule.least]
                    found.sort()
                yield found


def spans_column(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``array<struct<kind, start, end>>`` of a text column, by start, then by the order of the rules."""
    kinds = [r.kind for r in rules]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf("array<struct<kind: string, start: bigint, end: bigint>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = TrigramIndex(rules)
        for texts in batches:
            yield pa.array([[{"kind": kinds[n], "start": s, "end": e} for s, n, e in found] for found in index.spans(texts)], type=kind)

    return scan(F.coalesce(text.cast("string"), F.lit("")))


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row. Null and empty texts have no spans;
    repeated rows and null ids are scanned like any other; other columns are not returned."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), spans_column(F.col(text_col), rules).alias("spans"))


def redact(df: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """All rows and columns, with each secret (overlapping ones together) replaced by ``[kind]``; null texts stay null."""
    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = TrigramIndex(rules)
        for texts in batches:
            out = []
            for found, text in zip(index.spans(texts), texts, strict=True):
                value = text.as_py()
                if found:
                    done, parts = 0, []
                    for start, n, end in found:
                        if start >= done:
                            parts += [value[done:start], f"[{rules[n].kind}]"]
                        done = max(done, end)
                    value = "".join(parts) + value[done:]
                out.append(value)
            yield pa.array(out, pa.string())

    return df.withColumn(text_col, clean(F.col(text_col).cast("string")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
