"""K1-K6: keyword skill extraction into four native array columns.

One regex pass per text finds every keyword occurrence: a zero-width
lookahead that captures the longest keyword starting at each position, with
the vocabulary compiled into a prefix trie.  Shorter keywords that start at
the same position inside a longer hit (``c`` inside ``c/c++``) are added
from a literal map computed on the driver, so each keyword keeps its own
``\\b``-style semantics exactly as if it had been searched on its own.
Categories are then literal-array intersections.  No shuffle, no Python.
"""

from __future__ import annotations

import re

import regex

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import refdata as R
from hirelens.functions.literals import let, lit_map
from hirelens.functions.text import ColumnOrName, col
from hirelens.functions.trie import trie_regex

# A keyword must not touch a letter, digit, '_' or the symbol characters that
# extend it ('c' must not fire inside 'c++' or 'c#'; SURVEY Q18).
_EDGE = r"[\p{L}\p{N}_+#]"


def keyword_regex(keyword: str) -> str:
    """Stand-alone pattern of one keyword (used for the driver-side expansion and tests)."""
    return rf"(?<!{_EDGE}){re.escape(keyword.lower())}(?!{_EDGE})"


def _vocabulary(categories: dict[str, list[str]]) -> list[str]:
    return sorted({k.lower() for kws in categories.values() for k in kws})


def _expansion(vocab: list[str]) -> dict[str, list[str]]:
    """keyword → every keyword that matches at the same start inside it (itself included)."""
    out = {}
    for k in vocab:
        hits = [s for s in vocab if k.startswith(s) and regex.match(keyword_regex(s), k)]
        if hits != [k]:
            out[k] = sorted(hits)
    return out


def scan_pattern(vocab: list[str]) -> str:
    # the first check is part of the second, and quick: most places are inside a word
    return rf"(?<![a-z0-9_+#])(?=(?<!{_EDGE})({trie_regex(vocab)})(?!{_EDGE}))"


def keywords_found(text: ColumnOrName, categories: dict[str, list[str]] | None = None) -> Column:
    """Distinct lower-case keywords (any category) occurring in ``text``, sorted."""
    cats = categories or R.SKILL_CATEGORIES
    vocab = _vocabulary(cats)
    raw = F.regexp_extract_all(F.lower(col(text)), F.lit(scan_pattern(vocab)), 1)
    expand = _expansion(vocab)
    if expand:
        # few texts hold a keyword with another one inside
        emap = lit_map({k: "\u0001".join(v) for k, v in expand.items()})
        inside = lambda raw: F.flatten(F.transform(F.filter(raw, lambda k: k.isin(list(expand))), lambda k: F.split(F.element_at(emap, k), "\u0001")))
        return let(raw, lambda raw: F.sort_array(F.array_distinct(F.concat(raw, inside(raw)))))
    return F.sort_array(F.array_distinct(raw))


def category_skills(found: Column, keywords: list[str]) -> Column:
    """Sorted, distinct canonical names of one list among the found keywords (which come sorted and distinct)."""
    kws = sorted({k.lower() for k in keywords})
    canon = {k: R.canonical_skill(k) for k in kws if R.canonical_skill(k) != k}
    hits = F.filter(found, lambda k: k.isin(kws))
    if canon:
        cmap = lit_map(canon)
        hits = F.sort_array(F.array_distinct(F.transform(hits, lambda k: F.coalesce(F.element_at(cmap, k), k))))
    return hits


def extract_skills(text: ColumnOrName, categories: dict[str, list[str]] | None = None) -> dict[str, Column]:
    """K1: {category column: array<string>}; null text gives four empty arrays.

    For tables, add ``keywords_found`` as its own column first (see
    ``operators.enrich``) so the scan runs once and the four categories read it.
    """
    cats = categories or R.SKILL_CATEGORIES
    found = F.coalesce(keywords_found(text, cats), F.array().cast("array<string>"))
    return {name: category_skills(found, kws) for name, kws in cats.items()}


def extract_skills_from_found(found: Column, categories: dict[str, list[str]] | None = None) -> dict[str, Column]:
    cats = categories or R.SKILL_CATEGORIES
    found = F.coalesce(found, F.array().cast("array<string>"))
    return {name: category_skills(found, kws) for name, kws in cats.items()}


def all_skills(cols: list[str] | None = None) -> Column:
    """K6: the four arrays flattened (a skill in two categories appears twice)."""
    cols = cols or R.SKILL_COLUMNS
    return F.flatten(F.array(*[F.coalesce(F.col(c), F.array().cast("array<string>")) for c in cols]))
