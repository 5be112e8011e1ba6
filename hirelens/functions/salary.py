"""Salary extraction and normalisation as native Catalyst expressions.

Shape of the computation for one text:

  split into sentences (L5) -> keep salary sentences, drop funding ones (L6); only those with a digit go on
  -> every place where the master regex matches, with its groups, overlaps included (L4/L7); only those with a currency
     or a lead word go on
  -> number / currency / period normalisation (L10, L11, L15, L16)
  -> plausibility (L8) -> one fold over (sentence, offset) that settles overlaps (L9)
  -> best candidate by score, first on ties (L13)

Everything is ``split`` / ``filter`` / ``transform`` / ``regexp_replace``
on literal patterns: it runs in the JVM, row-local, and never shuffles.
Conversion to annual USD needs the rates table and lives in
``operators.enrich.annualize`` (one broadcast equi-join on a bounded table).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.literals import let, lit_map, lookup
from hirelens.functions.trie import trie_regex

from hirelens import refdata as R
from hirelens.functions.text import ColumnOrName, contains_any, normalize_text

# Alphabetic token edges must not touch other letters: checked once around the tries.
_ALPHA_EDGE = r"(?:(?<!\p{L})|(?!\p{L}))"


def _alt(tokens: list[str], upper: bool = True, capitals: list[str] | None = None) -> str:
    """Tokens in any case, and those that count in capitals only."""
    words = {t.upper() if upper else t.lower() for t in tokens}
    strict = f"|(?-i:{trie_regex(capitals)}){_ALPHA_EDGE}" if capitals else ""
    return f"{_ALPHA_EDGE}(?:{trie_regex(sorted(words))}{_ALPHA_EDGE}{strict})"


_ALL_CURRENCY_TOKENS = R.CURRENCY_TOKENS + R.EXTRA_CURRENCY_TOKENS
_MULTI_CHAR_CURRENCIES = [t for t in _ALL_CURRENCY_TOKENS if not (len(t) == 1 and t.isalpha()) and t not in R.WORD_LIKE_CURRENCIES]
_SINGLE_LETTER_CURRENCIES = sorted({t for t in R.CURRENCY_TOKENS if len(t) == 1 and t.isalpha()})

# One-letter currency tokens only count upper-case and touching the number (Q7).
# Tokens that are words of English prose ("10,000 ft", "top 5,000") only count in capitals.
CUR_SUFFIX = r"(?![\d,;:\-])" + _alt(_MULTI_CHAR_CURRENCIES, capitals=R.WORD_LIKE_CURRENCIES)
CUR_PREFIX = f"(?:{CUR_SUFFIX}|(?-i:[{''.join(_SINGLE_LETTER_CURRENCIES)}])(?=\\d))"
# "a year" and the like, beside the fixed phrases.
_A_PERIOD = {"a year": "year", "a month": "month", "an hour": "hour", "a week": "week", "a day": "day"}
PERIOD = "(?:" + _alt([*R.PERIOD_PHRASES, *_A_PERIOD], upper=False) + ")"
UNIT = r"\s?/\s?(?:yr|year|annum|mo|month|hr|hour|wk|week|day)(?!\p{L})"
# Indian grouping, thousands-grouped, or plain digits; optional 1-2 decimals; k/m (Q3).
NUM = (r"(?<![\d.,])(?:\d{1,3}(?:,\d{2})+,\d{3}|\d{1,3}(?:[.,]\d{3})+|\d+)"
       r"(?:[.,]\d{1,2}(?![\d]))?(?:[kKmM](?!\p{L}))?")
LEAD = r"(?:(?!\d)(" + trie_regex(R.SALARY_LEAD_WORDS) + r")(?:\s+range)?\s*:\s*)?"
DASH = r"(?:-|–|—|to(?!\p{L}))"  # alternatives, not a character class (Q10)

# Groups: 1 lead, 2 cur1, 3 num1, 4 unit1, 5 cur1 suffix, 6 cur2, 7 num2, 8 unit2, 9 cur3, 10 period
_BODY = (
    rf"{LEAD}(?:({CUR_PREFIX})\s?)?({NUM})({UNIT})?"
    rf"(?:(?:\s?({CUR_SUFFIX}))?\s*{DASH}\s*(?:({CUR_PREFIX})\s?)?({NUM})({UNIT})?)?"
    rf"(?:\s?({CUR_SUFFIX}))?(?:\s*({PERIOD}|{UNIT}))?"
)


def _start() -> str:
    """Where a match can start at all, as a quick check: a number's first digit; else a symbol of a currency, the first letter of a word,
    the first two of a lead word, a one-letter currency before a digit.  Characters beyond ASCII pass ('\u017f' is an s, '\u212a' a k, for
    instance).  Of what isn't a number, the words of a currency are followed by a digit, a lead word by a colon."""
    symbols = sorted({t[0] for t in _ALL_CURRENCY_TOKENS if t[0].isascii() and not t[0].isalpha()})
    either = lambda ch: f"[{ch.lower()}{ch.upper()}]"
    leads = sorted({either(w[0]) + (either(w[1]) if w[1] not in "isk" else "") for w in R.SALARY_LEAD_WORDS})
    singles = "".join(_SINGLE_LETTER_CURRENCIES)
    more = max(t.count(" ") for t in _ALL_CURRENCY_TOKENS)
    currency = rf"[^\s0-9]++(?:\s[^\s0-9]++){{0,{more}}}+\s?+[0-9]"
    lead = r"[^\s0-9:]++(?:\s++[^\s0-9:]{5})?+\s*+:"
    signs = "".join(map(re.escape, symbols))
    firsts = "".join(sorted({ch for w in R.SALARY_LEAD_WORDS for ch in (w[0].lower(), w[0].upper())})) + singles
    inside = rf"[{signs}]|[^\x00-\x7F]|(?=[{firsts}])(?:{'|'.join(leads)}|[{singles}][0-9])"
    return rf"(?-iu:(?=[0-9A-Za-z{signs}[^\x00-\x7F]])(?:(?=[0-9])(?<![0-9.,])|(?![0-9])(?=(?<![A-Za-z])|{inside})(?={currency}|{lead})))"


# All places where the pattern matches.  Groups: 1 the match, 2 to 11 its parts, 12 what follows it.
# Right after a currency symbol no place is looked for: the one at the symbol has the same numbers, and a currency.
# Nor right after a lead word and its colon: the one at the lead word has the same numbers and currencies, and comes first.
_NO_SYMBOL = r"(?<!\p{Sc}\s?)"
_LED = rf"(?<=:\s?)(?<={_NO_SYMBOL}(?:{'|'.join(R.SALARY_LEAD_WORDS)}):\s?)"
PLACES = rf"(?iu){_start()}{_NO_SYMBOL}(?!{_LED}(?!{trie_regex(R.SALARY_LEAD_WORDS)}))(?=({_BODY})([\s\S]*))"

SENTENCE_SPLIT = r"(?<=[.!?])\s+"
_SALARY_SENT = trie_regex(R.SALARY_KEYWORDS)                       # substring semantics
_FUNDING_SENT = r"\b" + trie_regex(R.FUNDING_KEYWORDS) + r"\b"      # word bounded (Q19)

# Period phrase / unit → canonical period name.
_PERIOD_NAME = {}
for _p in R.PERIOD_PHRASES:
    _pl = _p.lower()
    if _pl in ("per year", "annually", "yearly", "per annum", "p.a.", "pa"):
        _PERIOD_NAME[_pl] = "year"
    elif _pl in ("per month", "monthly", "per mth", "p.m.", "pm"):
        _PERIOD_NAME[_pl] = "month"
    elif _pl in ("per hour", "hourly", "per hr", "p.h.", "ph"):
        _PERIOD_NAME[_pl] = "hour"
    elif _pl in ("per week", "weekly", "per wk", "p.w.", "pw"):
        _PERIOD_NAME[_pl] = "week"
    else:
        _PERIOD_NAME[_pl] = "day"
for _u, _n in (("/yr", "year"), ("/year", "year"), ("/annum", "year"), ("/mo", "month"), ("/month", "month"), ("/hr", "hour"),
               ("/hour", "hour"), ("/wk", "week"), ("/week", "week"), ("/day", "day")):
    _PERIOD_NAME[_u] = _n
_PERIOD_NAME.update(_A_PERIOD)




def period_name(phrase: Column) -> Column:
    """Canonical period ('year', 'month', 'hour', 'week', 'day') of a phrase or unit."""
    def name(p: Column) -> Column:  # most phrases are as in the table; others have more white space
        plain = F.regexp_replace(F.regexp_replace(p, r"\s*/\s*", "/"), r"\s+", " ")
        return F.coalesce(lookup(_PERIOD_NAME, p), let(plain, lambda p: lookup(_PERIOD_NAME, p)))
    return F.when(phrase != "", let(F.lower(phrase), name))


def period_multiplier(period: Column) -> Column:
    """Month 12, hour 40*52, week 52, day 260, otherwise 1."""
    return F.coalesce(F.element_at(lit_map({k: float(v) for k, v in R.PERIOD_MULTIPLIER.items()}), period),
                      F.lit(1.0))


def parse_amount(s: Column) -> Column:
    """L11: '12,00,000' / '50.000,50' / '$1.5M' style token → double (null when unparsable).

    The last separator followed by one or two digits is the decimal point, any
    other separator groups thousands (Q3).  Runs inside a lambda, where repeated
    sub-expressions are not shared: what is needed twice is bound by ``let``.
    """
    return F.when(s != "", let(F.regexp_replace(s, r"\s", ""), _amount))["v"]


def _amount(raw: Column) -> Column:
    """(v, m): :func:`parse_amount` of a token without white space, and the multiplier of its suffix."""
    def number(digits: Column) -> Column:
        def pointed(x: Column) -> Column:
            return F.when(x.contains("."), x).otherwise(F.concat(x, F.lit(".0")))
        bare = F.regexp_replace(digits, r"[.,](?!\d{1,2}$)", "")
        return let(F.replace(bare, F.lit(","), F.lit(".")), pointed).try_cast("double")

    def scaled(mult: Column) -> Column:
        v = number(F.when(mult > 1.0, F.left(raw, F.length(raw) - 1)).otherwise(raw)) * mult
        return F.struct(v.alias("v"), mult.alias("m"))

    return F.when(raw != "", let(_multiplier_suffix(raw), scaled))


def _iso_lookup() -> dict[str, str]:
    table = {k.upper().replace(" ", ""): v for k, v in R.CURRENCY_TO_ISO.items()}
    for k, v in R.CURRENCY_NAME_TO_ISO.items():
        table.setdefault(k.upper().replace(" ", ""), v)
    for k, v in R.CURRENCY_ALIASES_LOWER.items():
        table.setdefault(k.upper().replace(" ", ""), v)
    return table


_ISO = _iso_lookup()


def standardize_currency(token: Column) -> Column:
    """L10 + L15: token → ISO code, or null when it names no single currency."""
    def iso(t: Column, squeezed: Column) -> Column:
        first = F.substring(squeezed, 1, 1)
        return F.when(squeezed != "", F.coalesce(
            lookup(_ISO, squeezed),
            F.when(squeezed.startswith("MX") | t.contains("MEXICAN PESO"), F.lit("MXN"))
            .when(squeezed.rlike(r"^[A-Z]{3}$"), squeezed)
            .when(~first.rlike(r"^[A-Z]$"), lookup(_ISO, first))))

    def cleaned(t: Column) -> Column:
        return let(F.regexp_replace(t, r"[.,]+$", ""), lambda t: let(F.regexp_replace(t, r"\s+", ""), lambda s: iso(t, s)))

    # Codes of the table need no cleaning: they hold no white space and end in no sign of a sentence.
    return F.when(token.isNotNull(), let(F.upper(F.trim(token)), lambda t: F.coalesce(lookup(_ISO, t), cleaned(t))))


GROUP_NAMES = ["all", "lead", "cur1", "n1", "u1", "cur1s", "cur2", "n2", "u2", "cur3", "per", "rest"]


def _keep_sentence_lower(low: Column) -> Column:
    """Salary keyword as a substring (byte search); funding words word-bounded, with the
    regex only run when a funding word occurs as a substring at all."""
    funding = contains_any(low, R.FUNDING_KEYWORDS) & low.rlike(_FUNDING_SENT)
    return contains_any(low, R.SALARY_KEYWORDS) & ~funding


def salary_sentences(sentences: Column) -> Column:
    """The salary sentences, without those on funding; all sentences when none qualifies.

    Only sentences with a digit are returned: no other has an amount.  The others
    are looked at only where none with a digit qualifies.
    """
    keep = lambda s: let(F.lower(s), _keep_sentence_lower)
    digit = lambda s: s.rlike("[0-9]")

    def pool(with_digit: Column) -> Column:
        others = F.exists(sentences, lambda s: ~digit(s) & keep(s))
        none = F.array().cast("array<string>")
        return let(F.filter(with_digit, keep), lambda kept: F.when((F.size(kept) > 0) | (F.size(with_digit) == 0), kept)
                   .when(others, none).otherwise(with_digit))

    return let(F.filter(sentences, digit), pool)


_SEP, _PLACE = "\u0001", "\u0002"
# One regex execution per sentence: at each place, the groups joined with a separator (a group that did not take
# part contributes nothing) are put into the sentence, which is then split.  First come the lead word and currencies,
# so that a place without any starts with the separator.
_QUALIFYING = "".join(f"${GROUP_NAMES.index(n) + 1}" for n in ("lead", "cur1", "cur1s", "cur2", "cur3"))
_GROUPS_TEMPLATE = _PLACE + _QUALIFYING + _SEP + "".join(f"${i + 1}{_SEP}" for i in range(len(GROUP_NAMES)))
_GI = {n: i + 1 for i, n in enumerate(GROUP_NAMES)}


def unmarked(text: Column) -> Column:
    """``text`` with other characters, as many, for those that mark places and groups."""
    return F.replace(F.replace(text, F.lit(_SEP), F.lit("\u0003")), F.lit(_PLACE), F.lit("\u0003"))


def match_places(pool: Column) -> Column:
    """Every place in the sentences (:func:`unmarked`) where the pattern matches with a currency or a lead word.

    Elements are (sent, size, x): sentence number, its length, and the groups of the place as one text.
    """
    def places(s: Column, i: Column) -> Column:
        found = F.split(F.regexp_replace(s, PLACES, _GROUPS_TEMPLATE), _PLACE, -1)
        qualified = F.filter(F.slice(found, 2, 1 << 30), lambda x: ~x.startswith(_SEP))
        return let(F.length(s), lambda size: F.transform(qualified, lambda x: F.struct(
            i.alias("sent"), size.alias("size"), x.alias("x"))))

    return F.flatten(F.transform(pool, places))


def _multiplier_suffix(n: Column) -> Column:
    last = F.lower(F.substring(n, -1, 1))
    return F.when(last == "k", F.lit(1e3)).when(last == "m", F.lit(1e6)).otherwise(F.lit(1.0))


def _parse(place: Column) -> Column:
    def struct(a: Column) -> Column:
        def g(name: str) -> Column:
            return a[_GI[name]]

        def amounts(r: Column) -> Column:
            v1, m1, v2, m2 = r["n1"]["v"], r["n1"]["m"], r["n2"]["v"], r["n2"]["m"]
            # "50-80K": a suffix on the second number alone counts for both, if the first is the smaller number as written.
            shared = (m1 == 1.0) & (m2 > 1.0) & (v1 <= v2 / m2)
            return F.struct(F.when(shared, v1 * m2).otherwise(v1).alias("v1"), v2.alias("v2"), m2.isNotNull().alias("is_range"))

        token = (F.when(g("cur1") != "", g("cur1")).when(g("cur1s") != "", g("cur1s"))
                 .when(g("cur2") != "", g("cur2")).when(g("cur3") != "", g("cur3")))
        end = place["size"] - F.length(g("rest"))
        return F.struct(
            place["sent"].alias("sent"), (end - F.length(g("all"))).alias("at"), end.alias("end"), token.alias("currency_token"),
            let(F.struct(_amount(g("n1")).alias("n1"), _amount(g("n2")).alias("n2")), amounts).alias("v"),
            F.coalesce(period_name(g("per")), period_name(g("u2")), period_name(g("u1"))).alias("period"),
        )

    return let(F.split(place["x"], _SEP, -1), struct)


def parse_places(places: Column) -> Column:
    """L10/L11/L16 inputs: currency token, amounts, period name per place."""
    return F.transform(places, _parse)


def _candidate(p: Column, mult: Column) -> Column:
    def plausible(v: Column) -> Column:  # L8 on the annualised local amount (Q8)
        return F.when(v * mult >= F.lit(R.MIN_ANNUAL_LOCAL), v)

    v = p["v"]
    return F.struct(
        p["currency_token"].alias("currency_token"),
        F.when(v["is_range"], plausible(v["v1"])).alias("min_salary"),
        F.when(v["is_range"], plausible(v["v2"])).alias("max_salary"),
        F.when(~v["is_range"], plausible(v["v1"])).alias("single_salary"),
        p["period"].alias("period"),
        F.lit(True).alias("qualified"),
        p["sent"].alias("sent"), p["at"].alias("at"), p["end"].alias("end"),
    )


def candidates(parsed: Column) -> Column:
    """Plausible candidates in text order, overlaps included."""
    timed = F.transform(parsed, lambda p: let(period_multiplier(p["period"]), lambda m: _candidate(p, m)))
    return F.filter(timed, lambda c: c["min_salary"].isNotNull() | c["max_salary"].isNotNull() | c["single_salary"].isNotNull())


def settle_overlaps(cands: Column) -> Column:
    """A candidate stays if it starts no earlier than five characters before the end of the last one kept (or
    in another sentence); else it takes that one's place if it is a full range and that one isn't; else it goes."""
    def full(c: Column) -> Column:
        return c["min_salary"].isNotNull() & c["max_salary"].isNotNull()

    def step(kept: Column, c: Column) -> Column:
        last = F.element_at(kept, -1)
        apart = (c["sent"] != last["sent"]) | (c["at"] >= last["end"] - 5)
        return (F.when((F.size(kept) == 0) | apart, F.concat(kept, F.array(c)))
                .when(full(c) & ~full(last), F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(c)))
                .otherwise(kept))

    return F.when(F.size(cands) <= 1, cands).otherwise(F.aggregate(F.slice(cands, F.lit(2), F.size(cands)), F.slice(cands, 1, 1), step))


def best_candidate(cands: Column) -> Column:
    """+3 full range else +2 single; +2 currency; +1 period; first on ties."""
    scored = F.transform(cands, lambda c, i: F.struct(
        (F.when(c["min_salary"].isNotNull() & c["max_salary"].isNotNull(), 3)
         .when(c["single_salary"].isNotNull(), 2).otherwise(0)
         + F.when(c["currency_token"].isNotNull(), 2).otherwise(0)
         + F.when(c["period"].isNotNull(), 1).otherwise(0)).alias("score"),
        (-i).alias("neg_pos"),
        c.alias("c"),
    ))
    return F.when(F.size(cands) > 0, F.array_max(scored)["c"])


def best_salary(text: Column) -> Column:
    """Best salary candidate of ``text`` (null if none).  Each step is bound, so every regex runs once per sentence or place."""
    pool = let(F.split(unmarked(text), SENTENCE_SPLIT), salary_sentences)
    return let(candidates(parse_places(match_places(pool))), lambda c: let(settle_overlaps(c), best_candidate))


def with_best_salary(df: DataFrame, text: Column, out: str) -> DataFrame:
    """Add column ``out`` = best salary candidate of ``text`` (null if none)."""
    return df.withColumn(out, best_salary(text))


def with_salary_header_first(df: DataFrame, header: Column, title: Column | None, description: Column,
                             out: str = "_best", normalized: bool = False) -> DataFrame:
    """Best candidate of the header text; otherwise of title + description.

    The body is only scanned for rows whose header gave nothing.
    ``normalized=True``: title / description are already trimmed and non-null.
    """
    h = normalize_text(header)
    norm = (lambda c: c) if normalized else normalize_text
    body = norm(description) if title is None else F.concat_ws(" ", norm(title), norm(description))
    df = with_best_salary(df, F.when(h != "", h), f"{out}_h")
    df = with_best_salary(df, F.when(F.col(f"{out}_h").isNull(), body), f"{out}_b")
    return df.withColumn(out, F.coalesce(F.col(f"{out}_h"), F.col(f"{out}_b"))).drop(f"{out}_h", f"{out}_b")


def extract_salary(text: ColumnOrName) -> Column:
    """Column form of :func:`with_best_salary`, of any text."""
    return best_salary(normalize_text(text))


def confidence(best: Column) -> Column:
    """0.5 + 0.3 range + 0.1 currency + 0.1 period, capped at 1; null without a salary."""
    score = (F.lit(0.5)
             + F.when(best["min_salary"].isNotNull() & best["max_salary"].isNotNull(), 0.3).otherwise(0.0)
             + F.when(best["currency_token"].isNotNull(), 0.1).otherwise(0.0)
             + F.when(best["period"].isNotNull(), 0.1).otherwise(0.0))
    return F.when(best.isNotNull(), F.round(F.least(F.lit(1.0), score), 4))


def salary_fields(best: Column, fallback_currency: Column | None = None) -> dict[str, Column]:
    """Silver columns from the chosen candidate (before conversion to USD).

    Currency order (Q4): explicit currency in the text, then the caller's
    fallback (e.g. the location's country currency), then USD.
    """
    found = best.isNotNull()
    cur = standardize_currency(best["currency_token"])
    if fallback_currency is not None:
        cur = F.coalesce(cur, fallback_currency)
    cur = F.coalesce(cur, F.lit("USD"))
    return {
        "has_salary": found,
        "currency_raw": F.when(found, cur),
        "min_salary_raw": best["min_salary"],
        "max_salary_raw": best["max_salary"],
        "single_salary_raw": best["single_salary"],
        "salary_period": best["period"],
        "salary_confidence": confidence(best),
    }
