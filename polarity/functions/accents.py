"""Unicode accent stripping ("NFKD, then drop combining marks") as Column work.

The rule is applied per character: NFKD only reorders combining marks across
characters, and every combining mark is dropped, so mapping each character
independently is exact.  Characters whose stripped form is one character (or
empty) go into a ``translate`` table.  Those with a longer form are replaced
one by one, in texts that hold one: Hangul syllables by arithmetic, ligatures,
fractions and the like from a table.  All tables are generated from
``unicodedata`` when first needed, not written out.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from polarity.functions.rewrite import let, lookup, rewrite, shelved


def stripped(text: str) -> str:
    """The rule on a string; builds the tables."""
    return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))


# Characters from here on are looked at by a second, longer class, and only in
# texts that hold one: a Java class is tested range by range per character.
HIGH_FROM = 0x900


# Fixed values of the Unicode standard: Hangul syllables are numbered by their
# lead, vowel and tail; no tail is tail 0.
SYLLABLES, LEADS, VOWELS, TAILS = 0xAC00, 0x1100, 0x1161, 0x11A7
N_SYLLABLES, N_VOWELS, N_TAILS = 11172, 21, 28


def _utf8(ch: str) -> str:
    return ch.encode("utf-8").hex().upper()


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[str, str, str, str, str, dict]:
    """(matching, replacement, deletions, the java classes of the other
    characters below and from HIGH_FROM, and what those but Hangul become)."""
    single_src, single_dst, deleted, multi = [], [], [], {}
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        out = stripped(ch)
        if out == ch:
            continue
        if cp <= 0xFFFF and len(out) == 1:
            single_src.append(ch)
            single_dst.append(out)
        elif cp <= 0xFFFF and not out:
            deleted.append(ch)
        else:
            multi[cp] = out
    low = _java_class([cp for cp in multi if cp < HIGH_FROM])
    high = _java_class([cp for cp in multi if cp >= HIGH_FROM])
    listed = {chr(cp): out for cp, out in multi.items() if not 0 <= cp - SYLLABLES < N_SYLLABLES}
    # shelved by all bytes but the last: at most 64 characters each
    return ("".join(single_src), "".join(single_dst), "".join(deleted), low, high,
            shelved(listed, lambda ch: _utf8(ch)[:-2]))


def _java_class(code_points: list[int]) -> str:
    ranges = []
    for cp in code_points:
        if ranges and ranges[-1][1] == cp - 1:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    parts = [f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges]
    return "[" + "".join(parts) + "]"


def _jamo(n: Column) -> Column:
    """Lead, vowel and tail of the syllable with number ``n``."""
    def at(first: int, k: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(F.lit(first) + k), 8, "0")), "UTF-32")

    tail = n % N_TAILS
    return F.concat(at(LEADS, F.floor(n / (N_VOWELS * N_TAILS)).cast("int")),
                    at(VOWELS, F.floor(n % (N_VOWELS * N_TAILS) / N_TAILS).cast("int")),
                    F.when(tail > 0, at(TAILS, tail)).otherwise(F.lit("")))


def _longer(ch: Column) -> Column:
    octets = F.hex(F.encode(ch, "UTF-8"))
    number = F.conv(F.hex(F.encode(ch, "UTF-32")), 16, 10).cast("int") - SYLLABLES
    listed = let(octets, lambda o: lookup(_tables()[5], F.left(o, F.length(o) - 2), ch))
    return let(number, lambda n: F.when(n.between(0, N_SYLLABLES - 1), _jamo(n)).otherwise(listed))


def _ascii(col: Column) -> Column:
    return F.octet_length(col) == F.char_length(col)


def strip_accents(col: Column) -> Column:
    """Exact accent stripping, without Python.

    All tables hold characters beyond ASCII only, so a text without any is
    returned as it is, and one that the first table leaves without any is done.
    The longer class is looked at only in texts with a character from
    HIGH_FROM on."""
    matching, replacement, deleted, low, high, _ = _tables()

    def others(c: Column, single: Column) -> Column:
        any_high = c.rlike(f"[\\x{{{HIGH_FROM:X}}}-\\x{{10FFFF}}]")
        return let(rewrite(single, low, _longer), lambda plain: F.when(any_high, rewrite(plain, high, _longer)).otherwise(plain))

    def stripping(c: Column) -> Column:
        return let(F.translate(c, matching + deleted, replacement), lambda single: F.when(_ascii(single), single).otherwise(others(c, single)))

    return let(col, lambda c: F.when(_ascii(c), c).otherwise(stripping(c)))
