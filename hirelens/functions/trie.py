"""Prefix-trie regexes for fixed vocabularies.

A plain alternation ``a|b|c…`` of N words makes Java's regex engine try all N
alternatives at every position.  Factoring shared prefixes gives the same
language with work proportional to the matched prefix length.  At a node
where a word ends and longer words continue, the continuation is a greedy
optional group, so the longest word is preferred and shorter ones are tried
on backtracking (e.g. when a trailing boundary check fails).

Java tries the branches of a node one after the other.  A node of many branches
deals them into groups, each behind a check of the first character.
"""

from __future__ import annotations

import math
import re

#: Branches of a node that are simply tried in turn.
FEW = 6


def _either(branches: list[tuple[str, str]]) -> str:
    """Alternatives, given as (first character, pattern)."""
    if len(branches) <= FEW:
        return "|".join(b for _, b in branches)
    far = [b for b in branches if not any(x.isascii() for x in b[0] + b[0].lower() + b[0].upper())]
    near = [b for b in branches if b not in far]
    if near and far:
        return f"{_either(near)}|(?=[^\\x00-\\x7F])(?:{_either(far)})"
    n = math.isqrt(len(branches) - 1) + 1
    groups = [branches[i:i + n] for i in range(0, len(branches), n)]
    return "|".join(f"(?=[{''.join(re.escape(ch) for ch, _ in g)}])(?:{'|'.join(b for _, b in g)})" for g in groups)


def trie_regex(words: list[str]) -> str:
    trie: dict = {}
    for w in set(words):
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def emit(node: dict) -> str:
        ends = "" in node
        branches = [(ch, re.escape(ch) + emit(child)) for ch, child in sorted(node.items()) if ch != ""]
        if not branches:
            return ""
        if len(branches) == 1 and not ends:
            return branches[0][1]
        group = "(?:" + _either(branches) + ")"
        return group + "?" if ends else group

    if not words:
        return "(?!)"
    return "(?:" + emit(trie) + ")"
