"""Constant arrays and maps: one JVM call, and one node of the plan, not one per element."""

from __future__ import annotations

import json
import zlib

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


_ITEM, _PAIR = "\u001e", "\u001f"


def _plain(values) -> bool:
    return all(isinstance(v, str) and _ITEM not in v and _PAIR not in v for v in values)


def lit_array(values) -> Column:
    """A constant array.  Strings travel as one literal that the optimizer splits once, not as a node per element."""
    values = list(values)
    if values and _plain(values):
        return F.split(F.lit(_ITEM.join(values)), _ITEM, -1)
    return F.expr("array(" + ", ".join(sql_literal(v) for v in values) + ")")


def lit_map(d: dict) -> Column:
    """A constant map; maps of strings, and of strings to doubles, as one literal that the optimizer parses once."""
    if d and _plain(d) and _plain(d.values()):
        return F.str_to_map(F.lit(_ITEM.join(f"{k}{_PAIR}{v}" for k, v in d.items())), F.lit(_ITEM), F.lit(_PAIR))
    if d and _plain(d) and all(isinstance(v, float) for v in d.values()):
        return F.from_json(F.lit(json.dumps(d)), "map<string,double>")
    return F.expr("map(" + ", ".join(f"{sql_literal(k)}, {sql_literal(v)}" for k, v in d.items()) + ")")


def lookup(d: dict[str, str], key: Column) -> Column:
    """``d``'s value for ``key``, else null.  A constant map is searched entry by entry, so a long one is dealt by the key's CRC into short ones."""
    n = max(1, len(d) // 8)
    parts: list[dict[str, str]] = [{} for _ in range(n)]
    for k, v in d.items():
        parts[zlib.crc32(k.encode()) % n][k] = v
    if n == 1:
        return F.element_at(lit_map(d), key)
    table = F.from_json(F.lit(json.dumps(parts)), "array<map<string,string>>")
    return F.element_at(F.element_at(table, (F.crc32(key.cast("binary")) % n + 1).cast("int")), key)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: inside a lambda, Spark doesn't share repeated expressions."""
    return F.transform(F.array(value), use)[0]
