"""Replacing matches by a computed Column, without Python."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def rewrite(text: Column, pattern: str, made: Callable[[Column], Column]) -> Column:
    """``text`` with every match of ``pattern`` replaced by ``made(match)``.

    What stands between the matches (split) and the matches alternate.  Texts
    without a match are returned as they are, nulls stay null.
    """
    def joined(s: Column) -> Column:
        return F.array_join(F.flatten(F.zip_with(s["gaps"], s["hits"], lambda gap, hit: F.array(
            gap, F.when(hit.isNull(), F.lit("")).otherwise(made(hit))))), "")

    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return F.when(F.regexp_like(text, F.lit(pattern)), let(parts, joined)).otherwise(text)


def lookup(table: dict[str, dict[str, str]], shelf: Column, key: Column) -> Column:
    """``table[shelf][key]`` or null.  The table is one literal (parsed when
    the plan is optimised); shelves keep the walk through a map short."""
    literal = F.from_json(F.lit(json.dumps(table)), "map<string,map<string,string>>")
    return F.try_element_at(F.try_element_at(literal, shelf), key)


def shelved(flat: dict[str, str], shelf: Callable[[str], str]) -> dict[str, dict[str, str]]:
    out: dict[str, dict[str, str]] = {}
    for key, value in flat.items():
        out.setdefault(shelf(key), {})[key] = value
    return out
