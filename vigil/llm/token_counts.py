"""Token counts by a two-tier lookup on the map side.

Tier one is a broadcast table of the lengths (in tokens) of frequent
pre-tokens, tier two a bounded cache in each worker for the rest; only cache
misses are encoded by the tokenizer library.  Pre-tokens never leave the task that
read them, so nothing is shuffled but the frequency count that fills tier
one: the pre-tokens of every document, counted in each task before the shuffle.
It decides how fast a length is found, never its value.

The lookup is exact because BPE never merges across pre-tokens and white
space always ends one.  Words of the characters in ``_FAST`` are lower-cased and
split here (NFC leaves them unchanged, and lower-casing is per character); any other
word is normalised, split and encoded by the library and cached whole.
Texts that contain a special string go through the library as a whole.
"""
from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.tokens import library, pieces, resolve

TABLE_ENTRIES = 50_000   # tier one: entries at most, each of at most TABLE_CHARS characters
TABLE_CHARS = 32
TOP_GROUPS = 16          # the most frequent are found in this many groups of words, then among theirs
CACHE_ENTRIES = 300_000  # tier two: entries of a worker at most


def _ranges(chars: list[int]) -> str:
    out, i = "", 0
    while i < len(chars):
        j = i
        while j + 1 < len(chars) and chars[j + 1] == chars[j] + 1:
            j += 1
        out += re.escape(chr(chars[i])) + ("-" + re.escape(chr(chars[j])) if j > i else "")
        i = j + 1
    return out


_PLAIN = [c for c in [*range(0x21, 0x7F), *range(0xA1, 0x24F), *range(0x2010, 0x2028), *range(0x2030, 0x205F)]
          if c not in (0xAD, 0x130) and unicodedata.category(chr(c))[0] in "LNPS"
          and unicodedata.is_normalized("NFC", chr(c)) and len(chr(c).lower()) == 1 and ord(chr(c).lower()) < 0x250 or 0x2010 <= c <= 0x2027]
_LETTERS = _ranges(sorted(c for c in _PLAIN if unicodedata.category(chr(c))[0] == "L"))
_NUMBERS = _ranges(sorted(c for c in _PLAIN if unicodedata.category(chr(c))[0] == "N"))
_SPACE = " \t\n\r"
_ODD_WORD = re.compile(f"(?<![^{_SPACE}])[{_ranges(sorted(_PLAIN))}]*+[^{_SPACE}{_ranges(sorted(_PLAIN))}][^{_SPACE}]*+")
#: The vocabulary's own splitting pattern, with its classes spelt out for the characters of _PLAIN.
_PRETOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")


def split(text: str) -> tuple[list[str], list[str]]:
    """(pre-tokens of the plain words, the other words as they stand)."""
    odd = _ODD_WORD.findall(text)
    if odd:
        text = _ODD_WORD.sub(" ", text)
    return _PRETOKEN.findall(text.lower()), odd


class Lengths(dict):
    """Lengths by pre-token: the broadcast table first, then what was encoded
    since; once over ``limit`` entries it falls back to the table."""

    def __init__(self, table: dict[str, int], name: str, limit: int):
        super().__init__(table)
        self.table, self.name, self.limit = table, name, limit + len(table)

    def __missing__(self, word: str) -> int:
        n = len(library(self.name).encode(word, add_special_tokens=False).ids)
        if len(word) <= 4 * TABLE_CHARS:
            if len(self) >= self.limit:
                self.clear()
                self.update(self.table)
            self[word] = n
        return n


def _supports_split(name: str) -> bool:
    """Whether the two-tier lookup knows this vocabulary's splitting; others are
    counted by their library."""
    if not resolve(name).endswith(".json"):
        return False
    tok = library(name)
    return (tok.pre_tokenizer is not None and tok.normalizer is not None and tok.post_processor is None
            and r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in str(tok.pre_tokenizer).replace("\\\\", "\\")
            and "NFC" in str(tok.normalizer) and "Lowercase" in str(tok.normalizer))


def count_text(text: str | None, lengths: Lengths, special: tuple[str, ...]) -> int:
    if not text:
        return 0
    if any(s in text for s in special):
        return len(library(lengths.name).encode(text, add_special_tokens=False).ids)
    words, odd = split(text)
    return sum(map(lengths.__getitem__, words)) + sum(map(lengths.__getitem__, odd))


def frequent_table(df: DataFrame, tokenizer: str, text_col: str = "text", entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Tier one: the ``entries`` most frequent pre-tokens of all documents, at most."""
    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for b in batches:
            batch: Counter[str] = Counter()
            for t in b["text"].dropna():
                batch.update(split(t)[0])
            seen.update({w: n for w, n in batch.items() if len(w) <= TABLE_CHARS})
            if len(seen) > 20 * TABLE_ENTRIES:
                yield pd.DataFrame(seen.items(), columns=["word", "n"])
                seen.clear()
        yield pd.DataFrame(list(seen.items()), columns=["word", "n"])

    texts = df.select(F.col(text_col).cast("string").alias("text"))
    # the driver takes at most entries words of each group, however many words there are
    group = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(TOP_GROUPS))).orderBy(F.desc("n"), "word")
    top = (texts.mapInPandas(counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
           .withColumn("place", F.row_number().over(group)).where(F.col("place") <= entries)
           .orderBy(F.desc("n"), "word").limit(entries))
    words = [r.word for r in top.select("word").collect()]  # bounded: entries x TABLE_CHARS
    return {w: len(e.ids) for w, e in zip(words, library(tokenizer).encode_batch(words, add_special_tokens=False), strict=True)}


def count_tokens(df: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text", sample_docs: int | None = None, entries: int = TABLE_ENTRIES,
                 cache: int = CACHE_ENTRIES) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    Counts are the library's own, without begin/end tokens, truncation or
    padding; special strings inside a text count as one token each.  Null and
    empty texts have 0 bytes and 0 tokens; null ids and repeated rows are
    counted like any other; other columns are neither read nor returned.  Tier one
    is counted over every document, unless a caller asks for ``sample_docs`` only.
    """
    text = F.col(text_col).cast("string")
    shared = df.sparkSession.sparkContext.broadcast(
        frequent_table(df if sample_docs is None else df.limit(sample_docs), tokenizer, text_col, entries) if _supports_split(tokenizer) else None)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if shared.value is None:
            if resolve(tokenizer).endswith(".json"):
                one = lambda t: len(library(tokenizer).encode(t, add_special_tokens=False).ids)
            else:
                one = lambda t: len(pieces(tokenizer).encode(t))
            for b in batches:
                yield b.map(lambda t: one(t) if t else 0).astype("int64")
            return
        lengths = Lengths(shared.value, tokenizer, cache)
        special = tuple(t.content for t in library(tokenizer).get_added_tokens_decoder().values())
        for b in batches:
            yield pd.Series([count_text(t, lengths, special) for t in b], dtype="int64")

    return (df.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                      tokens(text).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
