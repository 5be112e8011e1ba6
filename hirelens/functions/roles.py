"""Experience level, work type and employment type as `when` chains.

The rule order is the documented one.  Matching is plain substring by default
(as documented); ``word_boundary=True`` switches title/keyword tests to whole
words, which avoids hits such as "intern" in "internal" (SURVEY Q17).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import refdata as R
from hirelens.functions.text import ColumnOrName, col, contains_any, normalize_text, word_regex

# Description year rules (documented intent; SURVEY Q1).
_YEAR_RANGE = r"(\d+)\s*[–\-]\s*(\d+)\s*(?:years?|yrs?)"
_YEAR_SINGLE = r"(\d+)\+?\s*(?:years?|yrs?)"


def _has(text: Column, words: list[str], word_boundary: bool) -> Column:
    return text.rlike(word_regex(words)) if word_boundary else contains_any(text, words)


def experience_level(title: ColumnOrName, description: ColumnOrName, word_boundary: bool = False,
                     normalized: bool = False) -> Column:
    """X1: 'Entry-Level' | 'Mid-Level' | 'Senior' | 'Not Specified'.

    ``normalized=True``: inputs are already trimmed, non-null and lower-case.
    """
    t = col(title) if normalized else F.lower(normalize_text(title))
    d = col(description) if normalized else F.lower(normalize_text(description))
    lo = F.regexp_extract(d, _YEAR_RANGE, 1).try_cast("long")
    hi = F.regexp_extract(d, _YEAR_RANGE, 2).try_cast("long")
    has_range = d.rlike(_YEAR_RANGE) & lo.isNotNull() & hi.isNotNull()
    yrs = F.regexp_extract(d, _YEAR_SINGLE, 1).try_cast("long")
    has_single = d.rlike(_YEAR_SINGLE) & yrs.isNotNull()
    return (
        F.when(_has(t, R.SENIOR_TITLE_WORDS, word_boundary), "Senior")
        .when(_has(t, [R.ASSOCIATE_TITLE_WORD], word_boundary), "Entry-Level")
        .when(_has(t, R.MID_TITLE_WORDS, word_boundary), "Mid-Level")
        .when(_has(t, R.ENTRY_TITLE_WORDS, word_boundary), "Entry-Level")
        .when(has_range & (hi <= 2), "Entry-Level")
        .when(has_range & (lo >= 5), "Senior")
        .when(has_range, "Mid-Level")
        .when(has_single & (yrs <= 2), "Entry-Level")
        .when(has_single & (yrs >= 5), "Senior")
        .when(has_single, "Mid-Level")
        .when(contains_any(d, R.ENTRY_DESCRIPTION_PHRASES), "Entry-Level")
        .otherwise(R.NOT_SPECIFIED)
    )


def _classify(text: Column, rules) -> Column:
    expr = None
    for label, substrings, regexes in rules:
        cond = contains_any(text, substrings) if substrings else text.rlike(word_regex(regexes, escape=False))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(R.NOT_SPECIFIED)


def _joined(title: ColumnOrName, description: ColumnOrName) -> Column:
    return F.lower(F.concat_ws(" ", normalize_text(title), normalize_text(description)))


def work_type(title: ColumnOrName, description: ColumnOrName) -> Column:
    """X2: 'Remote' | 'Hybrid' | 'On-site' | 'Not Specified'."""
    return _classify(_joined(title, description), R.WORK_TYPE_RULES)


def employment_type(title: ColumnOrName, description: ColumnOrName) -> Column:
    """Full-time / Part-time / Contract / Temporary / Internship / Freelance / Not Specified."""
    return _classify(_joined(title, description), R.EMPLOYMENT_TYPE_RULES)


def work_type_of(text_lower: ColumnOrName) -> Column:
    """X2 on an already lower-cased 'title description' text."""
    return _classify(col(text_lower), R.WORK_TYPE_RULES)


def employment_type_of(text_lower: ColumnOrName) -> Column:
    """X3 on an already lower-cased 'title description' text."""
    return _classify(col(text_lower), R.EMPLOYMENT_TYPE_RULES)


def header_first_of(fn, header_lower: ColumnOrName, text_lower: ColumnOrName) -> Column:
    """X4 on pre-normalised, lower-cased inputs (header may be null or empty)."""
    h = col(header_lower)
    from_header = F.when(h != "", F.nullif(fn(F.concat_ws(" ", h, h)), F.lit(R.NOT_SPECIFIED)))
    return F.coalesce(from_header, fn(text_lower))


def header_first(fn, header: ColumnOrName, title: ColumnOrName, description: ColumnOrName) -> Column:
    """Use the header's answer when the header is non-empty and decisive."""
    h = normalize_text(header)
    from_header = F.when(h != "", F.nullif(fn(h, h), F.lit(R.NOT_SPECIFIED)))
    return F.coalesce(from_header, fn(title, description))


def work_type_with_header(header: ColumnOrName, title: ColumnOrName, description: ColumnOrName) -> Column:
    return header_first(work_type, header, title, description)


def employment_type_with_header(header: ColumnOrName, title: ColumnOrName, description: ColumnOrName) -> Column:
    return header_first(employment_type, header, title, description)


__all__ = [
    "experience_level", "work_type", "employment_type", "header_first",
    "work_type_with_header", "employment_type_with_header",
]
