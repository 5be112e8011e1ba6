"""Generic text / cleaning expressions (Column -> Column).

All built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none of them calls back into Python.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: ColumnOrName) -> Column:
    """Null -> '', cast to string, strip Unicode whitespace at both ends (looked for only where an end isn't printable ASCII)."""
    s = F.coalesce(col(c).cast("string"), F.lit(""))
    bare = F.ascii(s).between(33, 126) & F.ascii(F.substring(s, -1, 1)).between(33, 126)
    return F.when(bare, s).otherwise(F.regexp_replace(s, r"(?U)^\s+|\s+$", ""))


def is_obfuscated(c: ColumnOrName, is_string: bool = True) -> Column:
    """Null, or a string without any letter or digit (Unicode aware, Q23)."""
    c = col(c)
    if not is_string:
        return c.isNull()
    return c.isNull() | ~c.rlike(r"[\p{L}\p{N}]")


def all_obfuscated(cols: list[ColumnOrName], string_cols: set[str] | None = None) -> Column:
    preds = [is_obfuscated(c, string_cols is None or (isinstance(c, str) and c in string_cols)) for c in cols]
    return reduce(lambda a, b: a & b, preds)


def any_obfuscated(cols: list[ColumnOrName], string_cols: set[str] | None = None) -> Column:
    preds = [is_obfuscated(c, string_cols is None or (isinstance(c, str) and c in string_cols)) for c in cols]
    return reduce(lambda a, b: a | b, preds)


def parse_list(c: ColumnOrName, sep: str = ";") -> Column:
    """K3: 'a; b;;c' -> ['a','b','c'] (trimmed, empties dropped, null -> [])."""
    parts = F.split(F.coalesce(col(c), F.lit("")), re.escape(sep))
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != F.lit(""))


def join_list(c: ColumnOrName, sep: str = ";") -> Column:
    """K4: array -> 'a;b;c' for CSV sinks."""
    return F.concat_ws(sep, col(c))


def not_specified(c: ColumnOrName) -> Column:
    """P11 predicate: value mentions 'not specified' (case-insensitive); nulls are kept."""
    return F.coalesce(F.lower(col(c)).contains("not specified"), F.lit(False))


def safe_date(c: ColumnOrName) -> Column:
    """Bad text -> null (ANSI-safe)."""
    return F.try_to_date(col(c).cast("string"))


def safe_double(c: ColumnOrName) -> Column:
    """Bad text -> null (ANSI-safe)."""
    return col(c).cast("string").try_cast("double")


def contains_any(text: Column, words: list[str]) -> Column:
    """Plain substring test against a fixed word list.

    Up to 24 words: byte searches (``contains``), none for a word that holds
    another one.  Longer lists: one prefix-trie regex, which keeps the
    expression (and generated code) small.
    """
    words = [w for w in dict.fromkeys(words) if not any(v != w and v in w for v in words)]
    if len(words) > 24:
        from hirelens.functions.trie import trie_regex
        return text.rlike(trie_regex(words))
    cond = None
    for w in words:
        c = text.contains(w)
        cond = c if cond is None else cond | c
    return cond


def word_regex(alternatives: list[str], escape: bool = True) -> str:
    """Java regex for whole-word alternatives (ASCII word chars, like Python's \\b on ASCII text)."""
    alts = "|".join(re.escape(a) if escape else a for a in alternatives)
    return rf"\b(?:{alts})\b"


# One item of a list literal: quoted either way, with escapes, or bare (numbers, None).
_ITEM = r"""(?:'[^'\\]*+(?:\\[\s\S][^'\\]*+)*+'|"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+"|[^\s,'"\[\]]++)"""
_LITERAL = rf"^\s*\[\s*(?:{_ITEM}\s*(?:,\s*{_ITEM}\s*)*+,?\s*)?\]\s*$"
# Escapes of a quoted item and what they stand for.
_ESCAPES = {"\\n": "\n", "\\t": "\t", "\\r": "\r", "\\'": "'", '\\"': '"'}
_ASIDE = "\u0001"


def _unescape(s: Column) -> Column:
    """Escapes resolved; a doubled backslash is set aside first, so that one before an n stays what it is."""
    s = F.replace(s, F.lit("\\\\"), F.lit(_ASIDE))
    for escaped, plain in _ESCAPES.items():
        s = F.replace(s, F.lit(escaped), F.lit(plain))
    return F.replace(s, F.lit(_ASIDE), F.lit("\\"))


def parse_list_literal(c: ColumnOrName) -> Column:
    """K7: a Python-style list literal "['a', 'b']" → array<string> (legacy CSV cells).

    Items may be quoted either way and hold the other quote, commas, brackets and
    escapes (a backslash before a quote, a backslash, n, t or r).  Bare items stay
    as written, but for None, which is dropped as empty items are.  Anything that
    isn't one flat list of such items → [].
    """
    text = col(c)
    empty = F.array().cast("array<string>")
    inner = F.regexp_replace(text, r"^\s*\[|\]\s*$", "")
    items = F.when(text.rlike(_LITERAL), F.regexp_extract_all(inner, F.lit(_ITEM), 0)).otherwise(empty)

    def value(x: Column) -> Column:
        quoted = F.left(x, F.lit(1)).isin("'", '"')
        bare = F.when(x == "None", F.lit("")).otherwise(x)
        return F.trim(F.when(quoted, _unescape(F.substring(x, F.lit(2), F.length(x) - 2))).otherwise(bare))

    return F.filter(F.transform(F.coalesce(items, empty), value), lambda x: x != "")
