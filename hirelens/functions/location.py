"""Country from a free-text location, as one expression tree.

Places form a hierarchy: a name is a country, a state or province of one, or a
city in one, and many names are several of these.  A location's comma parts are
read from the right.  Each part gives the places whose names it holds, and each
place its possible countries; the rightmost place decides, and where it has
several countries ("Georgia", "WA", "Cambridge") its neighbours to the left
choose among them.  Without a hint the first one counts: a state of the United
States, then other states, then countries and cities.

The place table is fixed and bounded, so it is compiled into one prefix-trie
regex plus a literal map.  That keeps the lookup inside the projection: no
distinct, no join back, no shuffle, and no skew when one location dominates.
``operators.enrich.resolve_countries`` is the join form for gazetteers of any
size; it finds the same names and folds them with the same rule.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.literals import lookup
from hirelens.functions.trie import trie_regex

from hirelens import refdata as R
from hirelens.functions.text import ColumnOrName, col

_NOISE = r"\b(?:" + "|".join(re.escape(w) for w in R.LOCATION_NOISE_WORDS) + r")\b"
_EDGE = r"[\p{L}\p{N}]"
_SEP = "\u0001"
#: Names that count only as a whole part: state codes, and a word that is part of other names.
WHOLE_PART = {"america", *R.US_STATE_CODES, *(code for states in R.STATES.values() for _, code in states if code)}


def _clean_py(s: str) -> str:
    """Same cleaning as :func:`clean_location`, for the fixed names on the driver."""
    s = re.sub(_NOISE, "", s.strip().lower())
    return re.sub(r"[^\w,]+|_", " ", s).strip(" ,")


def clean_location(c: ColumnOrName) -> Column:
    """Lower case, without noise words; letters, digits and commas, everything else one space."""
    s = F.regexp_replace(F.lower(F.trim(col(c))), _NOISE, "")
    s = F.regexp_replace(s, r"[^\p{L}\p{M}\p{N},]+", " ")
    return F.regexp_replace(F.regexp_replace(s, r" ?, ?", ","), r"^[ ,]+|[ ,]+$", "")


@lru_cache(maxsize=1)
def countries() -> dict[str, str]:
    """Country → ISO currency: our table, and the JVM's locale data for all others."""
    known = {c: cur for c, cur, _ in R.COUNTRY_INFO}
    util = SparkContext._active_spark_context._jvm.java.util
    ours = {_clean_py(n) for c, _, aliases in R.COUNTRY_INFO for n in [c, *aliases]}
    for code in util.Locale.getISOCountries():
        place = util.Locale("", code)
        name = re.sub(r" (SAR )?China$| \(.*\)$", "", place.getDisplayCountry(util.Locale.ENGLISH)).replace("’", "'").replace("&", "and")
        if _clean_py(name) not in ours and name not in known:
            money = util.Currency.getInstance(place)
            known[name] = money.getCurrencyCode() if money is not None else "USD"
    return known


@lru_cache(maxsize=1)
def place_table() -> dict[str, list[str]]:
    """Name of a place → its possible countries, the likeliest first."""
    table: dict[str, list[str]] = {}

    def add(name: str, country: str) -> None:
        key = _clean_py(name)
        if key and "," not in key and country not in table.setdefault(key, []):
            table[key].append(country)

    for country, states in R.STATES.items():
        for name, code in states:
            add(name, country)
            if code:
                add(code, country)
    for code in R.US_STATE_CODES:
        add(code, "United States")
    for key, country in R.CITY_TO_COUNTRY:
        add(key, country)
    for country in countries():
        add(country, country)
    for country, _, aliases in R.COUNTRY_INFO:
        for name in aliases:
            add(name, country)
    for country, cities in R.MORE_CITIES.items():
        for name in cities:
            add(name, country)
    for name, country in R.ALSO_IN.items():
        add(name, country)
    return table


@lru_cache(maxsize=1)
def _name_regex() -> str:
    """Places in a part: the whole part as it is, else names at word edges, leftmost and longest first."""
    table = place_table()
    codes = [k for k in table if k in WHOLE_PART]
    names = [k for k in table if k not in WHOLE_PART]
    return rf"^{trie_regex(codes)}$|(?<!{_EDGE}){trie_regex(names)}(?!{_EDGE})"


def fold_countries(places: Column) -> Column:
    """Countries of a location's places, left to right (each an array, likeliest first), to one country or null."""
    def step(chosen: Column, here: Column) -> Column:
        both = F.array_intersect(chosen, here)
        return F.when(F.size(chosen) == 0, here).when((F.size(chosen) > 1) & (F.size(both) > 0), both).otherwise(chosen)

    return F.get(F.aggregate(F.reverse(places), F.array().cast("array<string>"), step), F.lit(0))


def extract_country(location: ColumnOrName) -> Column:
    """G1: the country of a location text, else 'Unknown'."""
    return country_of_clean(clean_location(location))


def country_of_clean(cleaned: ColumnOrName) -> Column:
    """G1 rules on an already cleaned location (null / '' → 'Unknown').

    For tables, materialise ``clean_location`` as a column first so every
    rule reads it instead of re-cleaning.
    """
    table = {k: _SEP.join(v) for k, v in place_table().items()}
    parts = F.split(F.coalesce(col(cleaned), F.lit("")), ",")
    names = F.flatten(F.transform(parts, lambda p: F.regexp_extract_all(p, F.lit(_name_regex()), 0)))
    places = F.transform(names, lambda n: F.split(lookup(table, n), _SEP))
    return F.coalesce(fold_countries(places), F.lit(R.UNKNOWN_COUNTRY))


def country_currency(country: ColumnOrName) -> Column:
    """L19 helper: ISO currency of a known country, else null."""
    return lookup(countries(), col(country))
