"""Text functions as Column builders.

Everything here is a native Spark expression, so it runs inside whole-stage
codegen.  The regex classes restate Python's Unicode ``\\s`` and ``\\w`` for the
JVM engine, where ``\\s``/``\\w`` are ASCII-only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from polarity.functions.accents import strip_accents
from polarity.functions.html import decode_html_entities

# Fixed values that must equal the reference's cleaning rules.
URL_TOKEN = "<URL>"
USER_TOKEN = "<USER>"

# Python's Unicode whitespace (str.isspace) and word characters (\w).
WS_CLASS = r"\s\x0B\x1c-\x1f\x85\p{Z}"
WORD_CLASS = r"\p{L}\p{N}_"

URL_PATTERN = r"(?iu)(?:https?://|www\.)[^" + WS_CLASS + r"]+"
MENTION_PATTERN = r"(?<![" + WORD_CLASS + r"])@[A-Za-z0-9_]+"
HASHTAG_PATTERN = r"#([" + WORD_CLASS + r"]+)"
WS_RUN = "[" + WS_CLASS + "]+"
TOKEN_PATTERN = "[" + WORD_CLASS + "]{2,}"


@dataclass(frozen=True)
class CleaningFlags:
    """The five cleaning switches; all on by default."""

    decode_html_entities: bool = True
    replace_urls: bool = True
    replace_mentions: bool = True
    keep_hashtag_words: bool = True
    normalize_whitespace: bool = True


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_whitespace(c: Column | str) -> Column:
    """Collapse every Unicode whitespace run to one space, then strip."""
    return F.trim(F.regexp_replace(as_col(c), WS_RUN, " "))


def strip_whitespace(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(as_col(c), "^" + WS_RUN + "|" + WS_RUN + "$", "")


def replace_urls(c: Column | str) -> Column:
    """B2: http(s):// or www. up to the next whitespace becomes ``<URL>``."""
    return F.regexp_replace(as_col(c), URL_PATTERN, URL_TOKEN)


def replace_mentions(c: Column | str) -> Column:
    """``@name`` not preceded by a word character becomes ``<USER>``."""
    return F.regexp_replace(as_col(c), MENTION_PATTERN, USER_TOKEN)


def clean_hashtags(c: Column | str) -> Column:
    """``#word`` becomes ``word``."""
    return F.regexp_replace(as_col(c), HASHTAG_PATTERN, "$1")


def clean_text(c: Column | str, flags: CleaningFlags = CleaningFlags()) -> Column:
    """The cleaning chain, composed at plan time from the flags."""
    out = as_col(c)
    if flags.decode_html_entities:
        out = decode_html_entities(out)
    if flags.replace_urls:
        out = replace_urls(out)
    if flags.replace_mentions:
        out = replace_mentions(out)
    if flags.keep_hashtag_words:
        out = clean_hashtags(out)
    return normalize_whitespace(out) if flags.normalize_whitespace else strip_whitespace(out)


def duplicate_key(c: Column | str) -> Column:
    """Decode -> lower -> collapse whitespace -> strip (URLs/mentions kept)."""
    return normalize_whitespace(F.lower(decode_html_entities(as_col(c))))


def char_length(c: Column | str) -> Column:
    """Length in code points."""
    return F.char_length(as_col(c))


def split_words(c: Column | str) -> Column:
    """Python ``str.split()``: non-empty pieces between whitespace runs."""
    return F.filter(F.split(as_col(c), WS_RUN), lambda w: w != F.lit(""))


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated words (0 for blank text)."""
    return F.size(split_words(c))


def is_blank(c: Column | str) -> Column:
    """True for non-null text made only of whitespace (null is not blank)."""
    return as_col(c).rlike("^[" + WS_CLASS + "]*$")


# --- tokenisation (J1-J3, J18) -------------------------------------------------

def preprocess_for_terms(c: Column | str, lowercase: bool = True, accents: str | None = None) -> Column:
    """Lower-case first, then strip accents (the vectoriser's order)."""
    out = as_col(c)
    if lowercase:
        out = F.lower(out)
    if accents == "unicode":
        out = strip_accents(out)
    elif accents == "ascii":
        raise ValueError("strip_accents='ascii' is not supported; use 'unicode'")
    elif accents is not None:
        raise ValueError(f"Unknown strip_accents mode: {accents}")
    return out


def word_tokens(c: Column | str) -> Column:
    """Runs of 2+ word characters, in order."""
    return F.regexp_extract_all(as_col(c), F.lit(TOKEN_PATTERN), 0)


def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def word_ngrams(tokens: Column, ngram_range: tuple[int, int]) -> Column:
    """Contiguous token n-grams joined by one space, n in the range.

    Each n is built from n shifted slices with ``zip_with``; ``tokens`` is only
    read outside lambdas (pass a column, not an expression).
    """
    lo, hi = check_range(ngram_range)
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(tokens)
            continue
        m = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        grams = F.slice(tokens, 1, m)
        for k in range(1, n):
            grams = F.zip_with(grams, F.slice(tokens, k + 1, m), lambda a, b: F.concat(a, F.lit(" "), b))
        parts.append(grams)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def char_wb_ngrams(c: Column | str, ngram_range: tuple[int, int]) -> Column:
    """Character n-grams inside words padded by one space on each side.

    A padded word no longer than n yields itself once and stops the n loop.
    For n >= 3 every gram is a window of the string " w1  w2  w3 " (each word
    padded, pads not shared) whose inner characters are not spaces, so each
    n is one regex scan with a capturing look-ahead (codegen, no lambdas).
    A padded word is at least 3 long; for a smallest n above 3 the shorter
    padded words are matched whole by one more alternative.
    """
    lo, hi = check_range(ngram_range)
    if lo < 3:
        return _char_wb_ngrams_lambda(c, (lo, hi))
    padded = F.concat(F.lit(" "), F.array_join(split_words(c), "  "), F.lit(" "))
    parts = []
    for n in range(lo, hi + 1):
        window = f"[^ ]{{{n}}}| [^ ]{{{n - 1}}}|[^ ]{{{n - 1}}} | [^ ]{{{n - 2}}} "
        if n == lo and lo > 3:  # padded words shorter than the smallest n: once, whole
            window += f"| [^ ]{{1,{lo - 3}}} "
        # a zero-width match advances one UTF-16 unit: skip the middle of a surrogate pair
        parts.append(F.regexp_extract_all(padded, F.lit(f"(?![\\x{{DC00}}-\\x{{DFFF}}])(?=({window}))"), 1))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _char_wb_ngrams_lambda(c: Column | str, ngram_range: tuple[int, int]) -> Column:
    """General form of J3 (any n range) with nested lambdas."""
    lo, hi = check_range(ngram_range)

    def per_word(w: Column) -> Column:
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        size = F.char_length(padded)

        def per_n(n: Column) -> Column:
            return (
                F.when(n < size, F.transform(F.sequence(F.lit(1), size - n + 1),
                                             lambda i: F.substring(padded, i, n)))
                .when(n == F.greatest(F.lit(lo), size), F.array(padded))
                .otherwise(_empty_strings())
            )

        return F.flatten(F.transform(F.sequence(F.lit(lo), F.lit(hi)), per_n))

    return F.flatten(F.transform(split_words(c), per_word))


def with_terms(df, text_col: str, out_col: str, analyzer: str = "word", ngram_range=(1, 1),
               lowercase: bool = True, strip_accents_mode: str | None = None):
    """The vectoriser's analyzer as projections: preprocess -> tokens -> n-grams.

    Intermediate arrays are separate columns so no lambda re-evaluates them
    (and no Python UDF sits inside a lambda).
    """
    pre, tok = f"_{out_col}_pre", f"_{out_col}_tok"
    out = df.withColumn(pre, preprocess_for_terms(text_col, lowercase, strip_accents_mode))
    if analyzer == "word":
        out = out.withColumn(tok, word_tokens(pre)).withColumn(out_col, word_ngrams(F.col(tok), tuple(ngram_range)))
        return out.drop(pre, tok)
    if analyzer == "char_wb":
        return out.withColumn(out_col, char_wb_ngrams(pre, tuple(ngram_range))).drop(pre)
    raise ValueError(f"Unknown analyzer: {analyzer}")


def with_term_counts(df, terms_col: str, out_col: str):
    """Per-row term frequencies as array<struct<term, tf>>, computed in-row.

    Sort the terms, find where runs start, measure the runs: O(L log L) per
    row and no shuffle, so a long document is counted where it is read.
    """
    s, st = f"_{out_col}_sorted", f"_{out_col}_starts"
    out = df.withColumn(s, F.sort_array(F.col(terms_col)))
    sorted_terms, k = F.col(s), F.size(F.col(s))
    out = out.withColumn(st, F.filter(
        F.sequence(F.lit(1), F.greatest(k, F.lit(1))),
        lambda i: F.when(i == 1, k > 0).otherwise(
            F.element_at(sorted_terms, i) != F.element_at(sorted_terms, i - 1))))
    starts = F.col(st)
    out = out.withColumn(out_col, F.transform(
        starts,
        lambda start, j: F.struct(
            F.element_at(sorted_terms, start).alias("term"),
            (F.coalesce(F.try_element_at(starts, j + 2), k + 1) - start).cast("long").alias("tf"))))
    return out.drop(s, st)


def check_range(ngram_range) -> tuple[int, int]:
    if not isinstance(ngram_range, (list, tuple)) or len(ngram_range) != 2:
        raise ValueError("ngram_range must be a two-item list or tuple")
    lo, hi = int(ngram_range[0]), int(ngram_range[1])
    if lo < 1 or hi < lo:
        raise ValueError(f"invalid ngram_range: {ngram_range}")
    return lo, hi
