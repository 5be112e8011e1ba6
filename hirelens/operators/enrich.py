"""Bronze → silver enrichment (E1), as one lazy projection plan.

Every extractor is a Column expression, so the whole enrichment is a single
narrow stage per input partition: no shuffle, no Python worker.  The FX rates
are a constant map, from a dict or from a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import refdata as R
from hirelens.functions import location as G
from hirelens.functions import roles as X
from hirelens.functions import salary as L
from hirelens.functions.skills import extract_skills_from_found, keywords_found
from hirelens.functions.literals import lit_map
from hirelens.functions.text import all_obfuscated, normalize_text
from hirelens.operators.keywords import with_keywords

REQUIRED_COLUMNS = ["title", "description"]
MAX_RATES = 10_000
SALARY_COLUMNS = [
    "has_salary", "currency_raw", "min_salary_raw", "max_salary_raw", "single_salary_raw", "salary_period",
    "min_salary_annual_usd", "max_salary_annual_usd", "avg_salary_annual_usd", "salary_confidence",
]


def require_columns(df: DataFrame, cols: list[str]) -> None:
    """Fail at plan time, naming what the postings lack and what they have."""
    lacking = sorted(set(cols).difference(df.columns))
    if lacking:
        raise ValueError(f"postings need the columns {', '.join(lacking)}; given: {', '.join(df.columns)}")


def _maybe(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")




def _rate_map(rates: DataFrame) -> Column:
    """A table of rates as one constant map, so that rows of a common currency meet it where they are.

    There are some two hundred currencies; a table of more than ``MAX_RATES``
    codes is none of rates, and fails the query, as a code with two rates does.
    """
    entries = F.map_from_entries(F.collect_list(F.struct("code", "rate")))
    checked = F.when(F.count(F.lit(1)) <= MAX_RATES, entries).otherwise(F.raise_error(F.lit(f"more than {MAX_RATES} currency rates")).cast("map<string,double>"))
    return rates.where(F.col("code").isNotNull()).select("code", F.col("rate").cast("double").alias("rate")).agg(checked.alias("m")).scalar()


def annualize(df: DataFrame, rates: dict[str, float] | DataFrame | None = None) -> DataFrame:
    """L16-L17 + L12: min/max/avg annual USD from the raw amounts.

    amount × period multiplier ÷ (units per USD); unknown currency → rate 1;
    zero rate → null; anything above 1 000 000 annual USD → null (raw kept).
    """
    if rates is None or isinstance(rates, dict):
        table = lit_map({k: float(v) for k, v in (rates if rates is not None else R.synthetic_rates()).items()})
    else:
        table = _rate_map(rates)
    out = df.withColumn("_rate", F.element_at(table, F.col("currency_raw")))
    rate = F.coalesce(F.col("_rate"), F.lit(1.0))
    rate = F.when(rate != 0, rate)
    mult = L.period_multiplier(F.col("salary_period"))
    mn, mx, single = F.col("min_salary_raw"), F.col("max_salary_raw"), F.col("single_salary_raw")
    is_range = mn.isNotNull() & mx.isNotNull()
    min_usd = F.when(is_range, mn * mult / rate).when(single.isNotNull(), single * mult / rate)
    max_usd = F.when(is_range, mx * mult / rate).when(single.isNotNull(), single * mult / rate)
    avg_usd = F.when(is_range, (mn * mult / rate + mx * mult / rate) / 2).when(single.isNotNull(), single * mult / rate)

    def cap(c: Column) -> Column:
        return F.when(c <= F.lit(R.MAX_ANNUAL_USD), c)

    return out.withColumns({
        "min_salary_annual_usd": cap(min_usd),
        "max_salary_annual_usd": cap(max_usd),
        "avg_salary_annual_usd": cap(avg_usd),
    }).drop("_rate")


def drop_obfuscated_rows(df: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """Drop rows whose key columns (default location, company) are all obfuscated."""
    key_cols = [c for c in (key_cols or ["location", "company"]) if c in df.columns]
    if not key_cols:
        return df
    return df.where(~all_obfuscated(key_cols))


def enrich(bronze: DataFrame, rates: dict[str, float] | DataFrame | None = None, drop_obfuscated: bool = True, word_boundary: bool = False,
           keywords: dict[str, list[str]] | DataFrame | None = None, gazetteer: DataFrame | None = None) -> DataFrame:
    """Silver postings: bronze + salary, experience, country, skills, work/employment type.

    Callers may bring their own tables: ``rates`` (code, rate); ``keywords``, as
    lists by skill column (compiled into one regex) or as a table (category,
    keyword[, canonical]) of any size, joined on ``id``; ``gazetteer`` (key,
    country, priority) of any size, joined on the distinct locations.  Without
    them the whole enrichment is one projection.
    """
    require_columns(bronze, REQUIRED_COLUMNS if not isinstance(keywords, DataFrame) else [*REQUIRED_COLUMNS, "id"])
    df = bronze.withColumns({"title": normalize_text("title"), "description": normalize_text("description")})
    if drop_obfuscated:
        df = drop_obfuscated_rows(df)
    header = _maybe(df, "header_text")
    if "location" not in df.columns:
        df = df.withColumn("country", F.lit(R.UNKNOWN_COUNTRY))
    elif gazetteer is not None:
        df = resolve_countries(df, "location", gazetteer)
    else:
        df = df.withColumn("_loc", G.clean_location(F.col("location")))
        df = df.withColumn("country", G.country_of_clean(F.col("_loc"))).drop("_loc")
    df = L.with_salary_header_first(df, header, F.col("title"), F.col("description"), "_best", normalized=True)
    # lower-cased texts shared by the classifiers and the skill scan, computed once per row
    df = df.withColumns({
        "_t": F.lower("title"), "_d": F.lower("description"),
        "_h": F.lower(normalize_text(header)),
    })
    by_table = isinstance(keywords, DataFrame)
    lists = None if by_table else keywords
    df = df.withColumns({"_td": F.concat_ws(" ", "_t", "_d")} | ({} if by_table else {"_kw": keywords_found(F.col("_d"), lists)}))
    fallback = G.country_currency(F.col("country"))
    cols = L.salary_fields(F.col("_best"), fallback_currency=fallback)
    cols["experience_level"] = X.experience_level("_t", "_d", word_boundary=word_boundary, normalized=True)
    if not by_table:
        cols.update(extract_skills_from_found(F.col("_kw"), lists))
    cols["work_type"] = X.header_first_of(X.work_type_of, "_h", "_td")
    cols["employment_type"] = X.header_first_of(X.employment_type_of, "_h", "_td")
    df = df.withColumns(cols).drop("_best", "_kw", "_t", "_d", "_h", "_td")
    if by_table:
        df = with_keywords(df, "id", F.col("description"), keywords, R.SKILL_COLUMNS)
    return annualize(df, rates)


def reextract_salary(silver: DataFrame, rates=None, header_needs_keyword: bool = True) -> DataFrame:
    """Recompute only the salary columns of an existing silver table.

    The header is used only when it mentions a salary keyword.
    """
    header = _maybe(silver, "header_text")
    if header_needs_keyword:
        header = F.when(F.lower(header).rlike(L._SALARY_SENT), header)
    df = L.with_salary_header_first(silver, header, F.col("title"), F.col("description"), "_best")
    fallback = G.country_currency(_maybe(silver, "country"))
    df = df.withColumns(L.salary_fields(F.col("_best"), fallback_currency=fallback)).drop("_best")
    return annualize(df, rates)


def fill_missing_salary(df: DataFrame, fallback_prefix: str = "fb_") -> DataFrame:
    """Masked update without a join.

    The fallback results are columns of the same rows (``<prefix><column>``,
    e.g. from a second extraction pass); they replace the salary columns only
    where ``has_salary`` is false, and are dropped afterwards.
    """
    keep = F.coalesce(F.col("has_salary"), F.lit(False))
    fb = [c for c in SALARY_COLUMNS if fallback_prefix + c in df.columns]
    out = df.withColumns({c: F.when(keep, F.col(c)).otherwise(F.col(fallback_prefix + c)) for c in fb})
    return out.drop(*[fallback_prefix + c for c in fb])


def reextract_skills(silver: DataFrame) -> DataFrame:
    """K5: recompute the four skill arrays only."""
    df = silver.withColumn("_kw", keywords_found(F.col("description")))
    return df.withColumns(extract_skills_from_found(F.col("_kw"))).drop("_kw")


def default_gazetteer(spark: SparkSession) -> DataFrame:
    """The built-in places as a gazetteer table (key, country, priority, whole_part)."""
    rows = [(k, c, i, k in G.WHOLE_PART) for k, cs in G.place_table().items() for i, c in enumerate(cs)]
    return spark.createDataFrame(rows, "key string, country string, priority int, whole_part boolean")


def _runs(words: Column, n: int) -> Column:
    """All runs of ``n`` words of an array, as (from, n, key)."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("from"), F.lit(n).alias("n"), F.array_join(F.slice(words, i, n), " ").alias("key")))


def resolve_countries(df: DataFrame, location_col: str, gazetteer: DataFrame, out_col: str = "country", max_words: int = 6) -> DataFrame:
    """G1/G2/J8 join form for a gazetteer of any size: (key, country, priority) and optionally whole_part.

    A key may name places in several countries; the lowest priority is the
    likeliest.  Runs of words of each distinct cleaned location (up to
    ``max_words``, commas or not) are joined with the keys by equality.  Of names
    that overlap the leftmost, longest one counts; a ``whole_part`` key only
    where it is a whole part.  The countries are folded from the right as in
    the expression form, and joined back on the cleaned location.  A key of more
    words than ``max_words`` fails the query instead of never being found.
    """
    key = F.regexp_replace(G.clean_location(F.col("key")), ",", " ")
    whole = F.col("whole_part") if "whole_part" in gazetteer.columns else F.lit(False)
    gaz = gazetteer.select(key.alias("key"), "country", "priority", whole.alias("whole_part")).where(F.col("key") != "")
    words = F.size(F.split("key", " "))
    gaz = gaz.withColumn("key", F.when(words > max_words, F.raise_error(F.concat(
        F.lit(f"gazetteer key of more than {max_words} words: "), F.col("key"))).cast("string")).otherwise(F.col("key")))
    named = gaz.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("priority", "country"))).alias("_c"), F.min("whole_part").alias("_whole"))
    named = named.select(F.col("key").alias("_key"), F.array_distinct(F.col("_c.country")).alias("_countries"), "_whole")

    cleaned = G.clean_location(F.col(location_col))
    locs = df.select(cleaned.alias("_loc")).where(F.col("_loc") != "").distinct()
    worded = locs.select("_loc", F.filter(F.split(F.translate("_loc", ",", " "), " "), lambda w: w != "").alias("_w"))
    runs = worded.select("_loc", F.explode(F.concat(*[_runs(F.col("_w"), k + 1) for k in range(max_words)])).alias("_r"))
    edged = lambda c: F.concat(F.lit(","), c, F.lit(","))
    hits = runs.join(named, F.col("_r.key") == F.col("_key")).where(~F.col("_whole") | edged(F.col("_loc")).contains(edged(F.col("_key"))))
    hit = F.struct(F.col("_r.from").alias("from"), (-F.col("_r.n")).alias("minus_n"), F.col("_countries").alias("countries"))
    found = hits.groupBy("_loc").agg(F.array_sort(F.collect_list(hit)).alias("_h"))

    def apart(kept: Column, h: Column) -> Column:  # leftmost first, longest first at one place
        last = F.element_at(kept, -1)
        return F.when(h["from"] >= last["from"] - last["minus_n"], F.concat(kept, F.array(h))).otherwise(kept)

    kept = F.aggregate(F.slice("_h", F.lit(2), F.size("_h")), F.slice("_h", 1, 1), apart)
    best = found.select("_loc", G.fold_countries(F.transform(kept, lambda h: h["countries"])).alias("_resolved"))
    out = df.withColumn("_loc", cleaned).join(best, "_loc", "left")
    return out.withColumn(out_col, F.coalesce("_resolved", F.lit(R.UNKNOWN_COUNTRY))).drop("_loc", "_resolved")
