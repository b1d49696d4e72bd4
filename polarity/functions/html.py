"""B1: HTML character references decoded as Column work (the HTML5 rules).

A reference is ``&#digits``, ``&#x`` hex digits or ``&`` and up to 32
characters of a name, each with an optional ``;``.  Names come from the
standard library's table when a plan is built; a name that isn't known whole
gives way to the longest known one without ``;`` that it begins with.
Numbers follow the HTML5 rules for code points that are no characters.
"""

from __future__ import annotations

import functools
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from polarity.functions.rewrite import let, lookup, rewrite, shelved

REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
# Fixed value: what stands for a number that names no character.
REPLACEMENT = "�"


@functools.lru_cache(maxsize=1)
def _names() -> tuple[dict, dict, str]:
    """(names with ";" by first two letters, names without by first letter,
    pattern of the latter, longest first)."""
    whole = {n: v for n, v in html5.items() if n.endswith(";")}
    open_ = {n: v for n, v in html5.items() if not n.endswith(";")}
    longest_first = sorted(open_, key=lambda n: (-len(n), n))
    return shelved(whole, lambda n: n[:2]), shelved(open_, lambda n: n[:1]), "^(?:" + "|".join(longest_first) + ")"


@functools.lru_cache(maxsize=1)
def _windows() -> dict[str, dict[str, str]]:
    """Numbers 128 to 159 name the characters of Windows-1252 where it has one."""
    flat = {}
    for n in range(0x80, 0xA0):
        try:
            flat[str(n)] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            flat[str(n)] = chr(n)
    return shelved(flat, lambda n: n[:2])


def _character(n: Column) -> Column:
    """The character of a bigint code point; null for one beyond Unicode."""
    mapped = lookup(_windows(), F.substring(n.cast("string"), 1, 2), n.cast("string"))
    utf32 = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    nothing = (n.between(0x1, 0x8) | (n == 0xB) | n.between(0xE, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF)
               | ((n % 0x10000) >= 0xFFFE))
    return (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit(REPLACEMENT))
            .when(n.between(0x80, 0x9F), mapped).when(nothing, F.lit("")).otherwise(utf32))


def _numeric(said: Column) -> Column:
    """``said``: the reference without ``&#`` and ``;``."""
    is_hex = F.lower(F.left(said, F.lit(1))) == "x"
    figures = F.regexp_replace(said, "^[xX]?0*", "")
    # eight figures are beyond Unicode in either base, and longer ones too
    short = F.left(figures, F.lit(8))
    number = F.when(is_hex, F.conv(F.concat(F.lit("0"), short), 16, 10)).otherwise(F.concat(F.lit("0"), short)).cast("bigint")
    return let(number, _character)


def _named(name: Column) -> Column:
    """``name``: the reference without ``&``, its ``;`` included."""
    whole, open_, begins = _names()
    known = F.regexp_extract(name, begins, 0)
    partly = let(known, lambda k: F.when(k != "", F.concat(lookup(open_, F.left(k, F.lit(1)), k),
                                                           F.substring(name, F.length(k) + 1, F.length(name)))))
    return F.coalesce(F.when(F.endswith(name, F.lit(";")), lookup(whole, F.left(name, F.lit(2)), name)), partly,
                      F.concat(F.lit("&"), name))


def _decoded(reference: Column) -> Column:
    numeric = F.regexp_replace(F.substring(reference, F.lit(3), F.length(reference)), ";$", "")
    return F.when(F.startswith(reference, F.lit("&#")), _numeric(numeric)).otherwise(
        _named(F.substring(reference, F.lit(2), F.length(reference))))


def decode_html_entities(col: Column) -> Column:
    """B1: every reference of ``col`` decoded once; nulls stay null."""
    return rewrite(col, REFERENCE, _decoded)
