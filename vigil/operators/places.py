"""Place-name cleaning and dictionary extraction.

``clean_place`` is the reference's fixed cleaning chain as one Column
expression.  ``extract_dictionary`` finds the first dictionary name in free
text with the reference's regex semantics (leftmost start; at one start the
first name in ascending order that ends on a word boundary):

* ``method="regex"``: one alternation pattern built from a collected
  dictionary, evaluated per row in generated code (no shuffle);
* ``method="ngram"``: for dictionaries too large for one pattern: each distinct
  text is cut into word / separator chunks, every run of chunks between word
  boundaries becomes a candidate (as many chunks as names have).  A bitmap of the
  names' keys, built on the executors and of fixed size, drops nearly all candidates before they are
  shuffled; the rest equi-join the dictionary by the key that case-insensitive patterns
  compare (``strings.fold``), salted, since a common name may lie in a third of all texts; and
  ``min(struct(position, name))`` picks the winner.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import rules as R
from vigil.functions.rules import apply_rules, rewrite_whole
from vigil.functions.strings import (ColumnOrName, alternation_regex, col, extract_first, fold, non_alnum_to_space,
                                     replace_all, replace_first, squish)

# word characters as Java's \b sees them (letters and digits of any script, "_", marks upon them)
WORD = r"\p{L}\p{Nd}_\p{Mn}"
AUTO_REGEX_NAMES = 5_000
PATTERN_NAMES = 50_000      # names that one pattern may hold
FILTER_WORDS = 1 << 17      # 64-bit words of the bitmap of name keys (1 MB, whatever the dictionary)
SALTS = 16


# T12 --------------------------------------------------------------------------
def county_suffix_pattern(counties: Sequence[str], as_coded: bool = False) -> str:
    """``\\b(?:county names)\\b(?:\\sCO|\\sCOUNTY)$``.  Built case-insensitive;
    ``as_coded=True`` drops the flag as the reference does (then Title-case
    names never match upper-cased text)."""
    base = alternation_regex(counties, word_boundary=True, ignore_case=False)
    pat = base + R.COUNTY_SUFFIX_PATTERN
    return pat if as_coded else "(?iu)" + pat


def strip_county_suffix(c: ColumnOrName, counties: Sequence[str], as_coded: bool = False) -> Column:
    return replace_first(c, county_suffix_pattern(counties, as_coded), "")


# T17 --------------------------------------------------------------------------
def fair_grounds_city(c: ColumnOrName) -> Column:
    return rewrite_whole(col(c), R.FAIR_GROUNDS_PATTERN, R.FAIR_GROUNDS_CITY, ignore_case=True)


def clean_place(c: ColumnOrName, counties: Sequence[str] | None = None, as_coded: bool = False) -> Column:
    """The place-name chain, in the reference's order (order matters:
    ``MELCHER-DALLAS`` is broken by the non-alphanumeric step and repaired
    after it)."""
    x = squish(F.coalesce(col(c), F.lit(R.NOT_RECORDED)))
    x = replace_all(x, R.PLACE_QUALIFIER_PATTERN, "", ignore_case=True)
    x = replace_all(x, R.FORT_PATTERN, R.FORT_VALUE)
    x = F.upper(x)
    if counties:
        x = strip_county_suffix(x, counties, as_coded)
    x = replace_first(x, R.SERGEANT_PATTERN, R.SERGEANT_VALUE)
    x = replace_first(x, R.JUNK_TAIL_PATTERN, "", ignore_case=True)
    x = rewrite_whole(x, R.DELAWARE_PATTERN, R.DELAWARE_VALUE, ignore_case=True)
    x = replace_first(x, R.TOWNSHIP_PATTERN, R.TOWNSHIP_VALUE, ignore_case=True)
    x = apply_rules(x, R.PLACE_REPAIR_RULES, default=x)   # CASE chain; codegen evaluates x once (CSE)
    x = squish(x)
    x = non_alnum_to_space(x)
    return rewrite_whole(x, R.MELCHER_PATTERN, R.MELCHER_VALUE, ignore_case=True)


# J5 ---------------------------------------------------------------------------
def dictionary_names(dict_df: DataFrame, name_col: str) -> DataFrame:
    """Trimmed, non-empty, distinct dictionary names (an empty name would
    match everywhere)."""
    n = F.trim(F.col(name_col))
    return dict_df.select(n.alias("__name")).where(F.col("__name").isNotNull() & (F.col("__name") != "")).distinct()


def dictionary_regex(dict_df: DataFrame, name_col: str, ignore_case: bool = True) -> str:
    """The dictionary as one alternation pattern; at most ``PATTERN_NAMES`` names reach the driver, more are refused."""
    rows = dictionary_names(dict_df, name_col).limit(PATTERN_NAMES + 1).collect()
    if len(rows) > PATTERN_NAMES:
        raise ValueError(f"more than {PATTERN_NAMES} names: use method='ngram'")
    return alternation_regex([r[0] for r in rows], word_boundary=True, ignore_case=ignore_case)


def _chunks(text: Column) -> Column:
    """Alternating word / separator chunks; concatenated they give the text."""
    return F.split(text, f"(?<=[{WORD}])(?=[^{WORD}])|(?<=[^{WORD}])(?=[{WORD}])")


def _starts_word(c: Column) -> Column:
    return c.rlike(f"^[{WORD}]")


def _ends_word(c: Column) -> Column:
    return c.rlike(f"[{WORD}]$")


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))


def key_filter(names: DataFrame, key: str) -> Column:
    """A bitmap of the keys' hashes as an array of ``FILTER_WORDS`` longs: one row, built by an aggregation."""
    place = _place(F.col(key))
    words = names.groupBy(F.shiftright(place, 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))).alias("b"))
    dense = names.sparkSession.range(FILTER_WORDS).join(words, F.col("id") == F.col("w"), "left").select("id", F.coalesce("b", F.lit(0).cast("long")).alias("b"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "b"))), lambda x: x["b"]).alias("bits")).scalar()


def passes(bits: Column, key: Column) -> Column:
    place = _place(key)
    word = F.get(bits, F.shiftright(place, 6).cast("int"))
    return F.call_function("shiftright", word, F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1


def extract_dictionary(df: DataFrame, text_col: str, dict_df: DataFrame, name_col: str,
                       out_col: str = "location", method: str = "auto", prefer: str = "first",
                       pattern: str | None = None, regex_names: int = AUTO_REGEX_NAMES) -> DataFrame:
    """Add ``out_col`` = first dictionary name found in ``text_col`` (NULL when
    none), in the text's own spelling.  Both methods give the same answers;
    ``method="auto"`` takes the regex up to ``regex_names`` names (faster per
    row, but the names pass through the driver) and the n-gram join beyond.
    ``prefer="longest"`` takes, at the leftmost start, the longest name
    instead of the first in sort order (n-gram join only).

    The n-gram join works on the DISTINCT texts and attaches its answers by
    text, so rows need no id and repeated texts are matched once.  A candidate is a
    run of word / separator chunks between two word boundaries, of any
    number of chunks that some name has (counted as the texts are chunked)."""
    if method == "auto":
        small = pattern is not None or dictionary_names(dict_df, name_col).limit(regex_names + 1).count() <= regex_names
        method = "regex" if small and prefer == "first" else "ngram"
    if method == "regex":
        if prefer != "first":
            raise ValueError("regex method implements prefer='first'")
        pat = pattern or dictionary_regex(dict_df, name_col)
        return df.withColumn(out_col, extract_first(text_col, pat))
    if method != "ngram":
        raise ValueError(method)
    names = dictionary_names(dict_df, name_col).select(fold("__name").alias("__key"), F.col("__name"))
    shapes = names.groupBy(_starts_word(F.col("__key")).alias("w")).agg(F.max(F.size(_chunks(F.col("__key")))).alias("n")).collect()  # two rows
    longest = {r["w"]: r["n"] for r in shapes}
    most = max(longest.values(), default=1)
    texts = df.select(F.col(text_col).alias("__text")).where(F.col("__text").isNotNull()).distinct()
    cands = F.flatten(F.transform(
        F.sequence(F.lit(1), F.size("__ch")),
        lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size("__ch") - i + 1)), lambda k: F.struct(
            i.alias("pos"), k.alias("k"), (i + k - 1 == F.size("__ch")).alias("last"),
            F.array_join(F.slice("__ch", i, k), "").alias("cand"), F.array_join(F.slice("__folded", i, k), "").alias("key")))))
    grams = (texts.withColumn("__ch", _chunks(F.col("__text"))).withColumn("__folded", F.transform("__ch", fold))
             .select("__text", F.explode(cands).alias("g"))
             .select("__text", "g.pos", "g.k", "g.last", "g.cand", F.col("g.key").alias("__key"))
             .where(passes(key_filter(names, "__key"), F.col("__key")))
             # inner chunk edges are word boundaries; the text's own ends only beside a word character
             .where((_starts_word(F.col("cand")) & (F.col("k") <= longest.get(True, 0)))
                    | (~_starts_word(F.col("cand")) & (F.col("pos") > 1) & (F.col("k") <= longest.get(False, 0))))
             .where(~F.col("last") | _ends_word(F.col("cand"))))
    # a name that lies in a third of all texts is dealt to SALTS places
    salted = names.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = grams.withColumn("__salt", F.pmod(F.xxhash64("__text"), F.lit(SALTS)).cast("int")).join(salted, ["__key", "__salt"])
    tie = F.col("__name") if prefer == "first" else -F.col("k")
    best = (hits.groupBy("__text")
            .agg(F.min(F.struct("pos", tie.alias("t"), F.col("cand"))).alias("__b"))
            .select("__text", F.col("__b.cand").alias(out_col)))
    return df.join(best, F.col(text_col) == F.col("__text"), "left").drop("__text")
