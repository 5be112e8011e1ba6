"""Case tables: one row per order, its text chosen by the order's key, and the meaning of each text written down.

The templates of the other queries write one kind of posting.  These texts are
the ordinary rest: other currencies, units, separators, overlaps, headers, prose
that only looks like money, places with and without states, list literals.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens import refdata as R
from hirelens.functions import location as G
from hirelens.functions import salary as L
from hirelens.functions.header import page_header
from hirelens.functions.literals import lit_array
from hirelens.functions.text import join_list, parse_list, parse_list_literal
from hirelens.operators.enrich import annualize, default_gazetteer, reextract_salary, resolve_countries
from hirelens.operators.keywords import default_keywords, with_keywords
from hirelens.plans.common import m2, money, read, silver
from hirelens.plans.expected_sql import _values, cte
from hirelens.plans.registry import register
from hirelens.session import scratch_path
from hirelens.sources import driver_tables as T
from hirelens.sources.files import read_bronze_csv, read_rates, write_csv

N = None
# (header, text, currency, min, max, single, period)
SALARY_CASES = [
    (N, "The salary range for this role is MX$235,200- MX$252,806.", "MXN", 235200.0, 252806.0, N, N),
    (N, "Software Engineer - Salary: MYR 8,000 - 12,000 per month", "MYR", 8000.0, 12000.0, N, "month"),
    (N, "We offer $80,000 - $120,000 annually", "USD", 80000.0, 120000.0, N, "year"),
    (N, "Compensation: SGD 5,500 monthly", "SGD", N, N, 5500.0, "month"),
    (N, "Pay range: RM 4,500 to RM 7,200 per month", "MYR", 4500.0, 7200.0, N, "month"),
    (N, "Annual salary of USD 95,000", "USD", N, N, 95000.0, N),
    (N, "€45,000 - €65,000 per year", "EUR", 45000.0, 65000.0, N, "year"),
    (N, "Hourly rate: $25 - $35 per hour", "USD", 25.0, 35.0, N, "hour"),
    (N, "Salary up to ¥8,000,000 annually", "JPY", N, N, 8000000.0, "year"),
    (N, "Competitive salary: INR 12,00,000 - 18,00,000 per annum", "INR", 1200000.0, 1800000.0, N, "year"),
    (N, "Package: 50K - 80K SGD yearly", "SGD", 50000.0, 80000.0, N, "year"),
    (N, "Starting at THB 45,000 per month", "THB", N, N, 45000.0, "month"),
    (N, "Offering AED 15,000 - AED 25,000 monthly", "AED", 15000.0, 25000.0, N, "month"),
    (N, "Executive package: $1.5M - $2.2M per year", "USD", 1500000.0, 2200000.0, N, "year"),
    (N, "Senior role: USD 500K - 1M annually", "USD", 500000.0, 1000000.0, N, "year"),
    (N, "PKR 2,50,000 per annum", "PKR", N, N, 250000.0, "year"),
    (N, "SAR 15,000 per month", "SAR", N, N, 15000.0, "month"),
    (N, "Rupiah 3,000,000 per month", "IDR", N, N, 3000000.0, "month"),
    (N, "Rp 4.500.000 – Rp 7.000.000 monthly", "IDR", 4500000.0, 7000000.0, N, "month"),
    (N, "Base salary: €50.000,50 annually", "EUR", N, N, 50000.5, "year"),
    (N, "Compensation 1.2M THB yearly", "THB", N, N, 1200000.0, "year"),
    (N, "Starting: IDR 8.5M monthly", "IDR", N, N, 8500000.0, "month"),
    # a multiplier written once
    (N, "We pay $50-80K per year", "USD", 50000.0, 80000.0, N, "year"),
    (N, "Salary 60-75K EUR", "EUR", 60000.0, 75000.0, N, N),
    (N, "Pay: $90 - $110k annually", "USD", 90000.0, 110000.0, N, "year"),
    (N, "Compensation £1.1 - 1.3m per annum", "GBP", 1100000.0, 1300000.0, N, "year"),
    (N, "Salary: $45,000 - 60K yearly", "USD", 45000.0, 60000.0, N, "year"),
    # units
    (N, "Salary $120k / year plus bonus", "USD", N, N, 120000.0, "year"),
    (N, "Pay is 4,000 EUR / month", "EUR", N, N, 4000.0, "month"),
    (N, "$110K/yr - $130K/yr", "USD", 110000.0, 130000.0, N, "year"),
    (N, "Earn $900 / week", "USD", N, N, 900.0, "week"),
    (N, "Pay $450/day for contractors", "USD", N, N, 450.0, "day"),
    (N, "Rate: £55 per hr", "GBP", N, N, 55.0, "hour"),
    (N, "Income of CAD 7,000 a month", "CAD", N, N, 7000.0, "month"),
    (N, "Wage: AUD 1,800 weekly", "AUD", N, N, 1800.0, "week"),
    (N, "Pay EUR 300 per diem", "EUR", N, N, 300.0, "day"),
    (N, "Salary CHF 110,000 p.a.", "CHF", N, N, 110000.0, "year"),
    (N, "Pay: 5,000 PLN pm", "PLN", N, N, 5000.0, "month"),
    # codes beyond the first twelve
    (N, "We pay £50,000 a year", "GBP", N, N, 50000.0, "year"),
    (N, "Salary: C$95,000 - C$105,000", "CAD", 95000.0, 105000.0, N, N),
    (N, "Salary: 480,000 SEK per year", "SEK", N, N, 480000.0, "year"),
    (N, "Remuneration R$ 12.000 monthly", "BRL", N, N, 12000.0, "month"),
    (N, "Salary R45,000 per month", "ZAR", N, N, 45000.0, "month"),
    (N, "Monthly pay: 1,500,000 KRW", "KRW", N, N, 1500000.0, N),
    (N, "Package ₱60,000 monthly", "PHP", N, N, 60000.0, "month"),
    (N, "Salary 35,000,000 VND per month", "VND", N, N, 35000000.0, "month"),
    (N, "Salary: 12.000.000 HUF per year", "HUF", N, N, 12000000.0, "year"),
    (N, "Pay 25,000 HKD monthly", "HKD", N, N, 25000.0, "month"),
    # words that are also currencies
    (N, "Salary: competitive, in a 10000 ft office", N, N, N, N, N),
    (N, "We won 10,000 customers and pay well", N, N, N, N, N),
    (N, "Try 20,000 rows; the pay is fair", N, N, N, N, N),
    (N, "Our top 5,000 clients pay for it", N, N, N, N, N),
    (N, "Salary: 900,000 FT per month", "HUF", N, N, 900000.0, "month"),
    (N, "Pay: TRY 45,000 monthly", "TRY", N, N, 45000.0, "month"),
    # several candidates
    (N, "Salary 90,000 EUR 60,000 - 80,000 per year", "EUR", 60000.0, 80000.0, N, "year"),
    (N, "Bonus of $8,000. Salary: $70,000 - $90,000 per year", "USD", 70000.0, 90000.0, N, "year"),
    (N, "Salary $6,000 or $7,500", "USD", N, N, 6000.0, N),
    (N, "Pay: 75,000 and a salary of $80,000 per year", "USD", N, N, 80000.0, "year"),
    (N, "Salary $95,000 with 5 weeks off. Pay $96,000 annually", "USD", N, N, 96000.0, "year"),
    (N, "Salary: $80,000, later $90,000 - $100,000", "USD", 90000.0, 100000.0, N, N),
    # sentences about money that isn't pay
    (N, "We raised $20,000,000 in funding. Salary $90,000 annually.", "USD", N, N, 90000.0, "year"),
    (N, "Backed by a $50M series B investment. Join a team of 50.", "USD", N, N, 50000000.0, N),
    (N, "A round of $9,000,000 closed! Pay: $65,000 per year.", "USD", N, N, 65000.0, "year"),
    (N, "Salary follows a background check. We pay $30,000.", "USD", N, N, 30000.0, N),
    # nothing, too little, too much
    (N, "5+ years with 3 teams", N, N, N, N, N),
    (N, "Attractive package.", N, N, N, N, N),
    (N, "A bonus of $500 is part of the package", N, N, N, N, N),
    (N, "Pay: $2,000,000 per year", "USD", N, N, 2000000.0, "year"),
    # header first
    ("$110K/yr - $130K/yr; Hybrid", "Salary: €50,000 per year", "USD", 110000.0, 130000.0, N, "year"),
    ("Hybrid", "Salary: €50,000 per year", "EUR", N, N, 50000.0, "year"),
    ("Salary £40,000", "Pay $99,000 - $120,000 yearly", "GBP", N, N, 40000.0, N),
    ("", "Pay $99,000 - $120,000 yearly", "USD", 99000.0, 120000.0, N, "year"),
]
_CASE = "o_orderkey % {n} AS k"


def _cases(spark, d, columns: dict[str, list]):
    """Orders with the fields of the case that their key chooses."""
    n = len(next(iter(columns.values())))
    at = (F.col("o_orderkey") % n + 1).cast("int")
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), *[F.element_at(lit_array(v), at).alias(c) for c, v in columns.items()])


def _salary_sql(cases) -> str:
    rows = [(i, *c[2:]) for i, c in enumerate(cases)]
    usd = lambda x: f"{x} * mult / rate"
    cap = lambda x: f"CASE WHEN {x} <= {R.MAX_ANNUAL_USD!r} THEN {x} END"
    return f"""
WITH c(k, currency, mn, mx, single, period) AS (VALUES {_values(rows)}),
fx(code, rate) AS (VALUES {_values([(k, float(v)) for k, v in R.synthetic_rates().items()])}),
p(period, mult) AS (VALUES {_values([(k, float(v)) for k, v in R.PERIOD_MULTIPLIER.items()])}),
v AS (SELECT o.o_orderkey AS id, c.currency, CAST(c.mn AS DOUBLE) AS mn, CAST(c.mx AS DOUBLE) AS mx, CAST(c.single AS DOUBLE) AS single, c.period,
             coalesce(p.mult, 1.0::DOUBLE) AS mult, coalesce(fx.rate, 1.0::DOUBLE) AS rate
      FROM orders o JOIN c ON c.k = o.o_orderkey % {len(cases)} LEFT JOIN fx ON fx.code = c.currency LEFT JOIN p ON p.period = c.period),
u AS (SELECT *, coalesce({usd('mn')}, {usd('single')}) AS lo, coalesce({usd('mx')}, {usd('single')}) AS hi,
             coalesce(({usd('mn')} + {usd('mx')}) / 2, {usd('single')}) AS av FROM v)
SELECT id, coalesce(mn, single) IS NOT NULL AS has_salary, currency AS currency_raw, mn AS min_salary_raw, mx AS max_salary_raw, single AS single_salary_raw,
       period AS salary_period, {m2(cap('lo'))} AS min_salary_annual_usd, {m2(cap('hi'))} AS max_salary_annual_usd, {m2(cap('av'))} AS avg_salary_annual_usd,
       CASE WHEN currency IS NOT NULL THEN CAST(round(0.6 + CASE WHEN mn IS NOT NULL THEN 0.3 ELSE 0 END
         + CASE WHEN period IS NOT NULL THEN 0.1 ELSE 0 END, 4) AS DOUBLE) END AS salary_confidence
FROM u"""


def _salary_out(df):
    return df.select("id", "has_salary", "currency_raw", "min_salary_raw", "max_salary_raw", "single_salary_raw", "salary_period",
                     money("min_salary_annual_usd"), money("max_salary_annual_usd"), money("avg_salary_annual_usd"), "salary_confidence")


@register("salary_cases", _salary_sql(SALARY_CASES))
def salary_cases(spark, d):
    """L1-L18 on ordinary texts, header first."""
    rows = _cases(spark, d, {"header_text": [c[0] for c in SALARY_CASES], "description": [c[1] for c in SALARY_CASES]})
    df = L.with_salary_header_first(rows, F.col("header_text"), None, F.col("description"), "_best")
    df = df.select("id", *[v.alias(k) for k, v in L.salary_fields(F.col("_best")).items()])
    return _salary_out(annualize(df, read_rates(spark)))


# (header, title, text, country, currency, min, max, single, period): L19 and L20, header only where it speaks of pay
REEXTRACT_CASES = [
    ("$110K/yr - $130K/yr; Hybrid", "Analyst", "Salary: €50,000 per year", "France", "EUR", N, N, 50000.0, "year"),
    ("Base pay $110K/yr - $130K/yr", "Analyst", "Salary: €50,000 per year", "France", "USD", 110000.0, 130000.0, N, "year"),
    ("Salary: 90,000 yearly", "Analyst", "Great team", "India", "INR", N, N, 90000.0, "year"),
    (N, "Analyst, salary: 60,000", "Great team", "United Kingdom", "GBP", N, N, 60000.0, N),
    (N, "Analyst", "Salary: 70,000 - 80,000 per year", "Unknown", "USD", 70000.0, 80000.0, N, "year"),
    (N, "Analyst", "Salary: 8,000 monthly", "Malaysia", "MYR", N, N, 8000.0, "month"),
    (N, "Analyst", "Great team", "Malaysia", N, N, N, N, N),
]


@register("salary_reextract_cases", _salary_sql([(N, N, *c[4:]) for c in REEXTRACT_CASES]).replace(
    "CASE WHEN currency IS NOT NULL THEN CAST(round(0.6 +", "CASE WHEN currency IS NOT NULL THEN CAST(round(0.5 + CASE WHEN id % 7 IN (0, 1) THEN 0.1 ELSE 0 END +"))
def salary_reextract_cases(spark, d):
    """L20 + L19: re-extraction over a silver table, the country's currency where the text names none."""
    names = ["header_text", "title", "description", "country"]
    rows = _cases(spark, d, {c: [x[i] for x in REEXTRACT_CASES] for i, c in enumerate(names)})
    return _salary_out(reextract_salary(rows))


# ------------------------------------------------------------------ places
COUNTRY_CASES = [
    ("Greater Bengaluru Area", "India"), ("San Jose, CA", "United States"), ("", "Unknown"), (N, "Unknown"), ("Paris", "France"),
    ("Toronto, ON", "Canada"), ("Dubai, United Arab Emirates", "United Arab Emirates"),
    ("Vancouver, Washington", "United States"), ("Vancouver, British Columbia", "Canada"), ("Vancouver, BC, Canada", "Canada"),
    ("Bucharest, Romania", "Romania"), ("Kyiv, Ukraine", "Ukraine"), ("Taipei, Taiwan", "Taiwan"), ("Hong Kong", "Hong Kong"),
    ("Atlanta, Georgia", "United States"), ("Tbilisi, Georgia", "Georgia"), ("Savannah, Georgia", "United States"), ("Georgia", "United States"),
    ("Birmingham, Alabama", "United States"), ("Birmingham, England, United Kingdom", "United Kingdom"), ("Birmingham", "United Kingdom"),
    ("Cambridge, Massachusetts", "United States"), ("Cambridge, UK", "United Kingdom"), ("Hamburg", "Germany"),
    ("Paris, Texas", "United States"), ("Paris, TX", "United States"), ("Paris, Île-de-France, France", "France"), ("London, Ontario", "Canada"),
    ("London, ON", "Canada"), ("City of London", "United Kingdom"), ("London", "United Kingdom"),
    ("Perth, WA", "Australia"), ("Seattle, WA", "United States"), ("Spokane, WA", "United States"), ("Perth, Western Australia", "Australia"),
    ("Sydney, NSW", "Australia"), ("Darwin, NT", "Australia"), ("Melbourne, Victoria, Australia", "Australia"), ("Melbourne, Florida", "United States"),
    ("Albuquerque, New Mexico", "United States"), ("New Mexico", "United States"), ("Mexico City, Mexico", "Mexico"), ("Guadalajara", "Mexico"),
    ("Austin, Texas Metropolitan Area", "United States"), ("Austin Texas", "United States"), ("Dallas-Fort Worth Metroplex", "United States"),
    ("Washington DC-Baltimore Area", "United States"), ("Greater St. Louis", "United States"), ("Columbus, Ohio Metropolitan Area", "United States"),
    ("Indianapolis, IN", "United States"), ("Wilmington, DE", "United States"), ("Delhi, India", "India"), ("Punjab, Pakistan", "Pakistan"),
    ("Lahore, Punjab", "Pakistan"), ("Hyderabad, Telangana", "India"), ("Hyderabad, Sindh", "Pakistan"),
    ("Remote", "Unknown"), ("Remote, US", "United States"), ("Anywhere in the USA", "United States"), ("Remote US", "United States"), ("USA", "United States"), ("EMEA", "Unknown"),
    ("United States", "United States"), ("Deutschland / Berlin", "Germany"), ("  BERLIN ,  GERMANY  ", "Germany"), ("Zürich, Switzerland", "Switzerland"),
    ("Seoul, Korea", "South Korea"), ("Istanbul, Türkiye", "Turkey"), ("Praha, Czech Republic", "Czechia"), ("Ho Chi Minh City, Viet Nam", "Vietnam"),
    ("Abidjan, Côte d'Ivoire", "Côte d'Ivoire"), ("Nairobi", "Kenya"), ("Colombo, Sri Lanka", "Sri Lanka"), ("San José, Costa Rica", "Costa Rica"),
    ("Latin America", "Unknown"), ("South Africa", "South Africa"), ("Dublin, Ohio", "United States"), ("Dublin, County Dublin, Ireland", "Ireland"),
    ("Rome, Georgia", "United States"), ("Moscow, Idaho", "United States"), ("Valencia, Spain", "Spain"), ("Santiago, Chile", "Chile"),
    ("Belfast, Northern Ireland", "United Kingdom"), ("12345", "Unknown"), ("Nowhere, Atlantis", "Unknown"),
]
_COUNTRY_SQL = f"""
WITH c(k, country) AS (VALUES {_values([(i, c[1]) for i, c in enumerate(COUNTRY_CASES)])})
SELECT o_orderkey AS id, c.country FROM orders JOIN c ON c.k = o_orderkey % {len(COUNTRY_CASES)}"""


@register("country_cases", _COUNTRY_SQL)
def country_cases(spark, d):
    """G1 + G3, expression form."""
    return _cases(spark, d, {"location": [c[0] for c in COUNTRY_CASES]}).select("id", G.extract_country("location").alias("country"))


@register("country_cases_join", _COUNTRY_SQL)
def country_cases_join(spark, d):
    """G1 + G2 + J8, join form over a gazetteer table: the same answers."""
    rows = _cases(spark, d, {"location": [c[0] for c in COUNTRY_CASES]})
    return resolve_countries(rows, "location", default_gazetteer(spark)).select("id", "country")


# ------------------------------------------------------------------ keyword tables
_SKILL_SQL = ", ".join(
    f"coalesce((SELECT string_agg(skill, ';' ORDER BY skill) FROM exp_job_skills s WHERE s.job_id = p.id AND s.skill_category = '{c}'), '') AS {c}"
    for c in R.SKILL_COLUMNS)


@register("skills_by_join", cte() + f"SELECT p.id, {_SKILL_SQL} FROM exp_postings p")
def skills_by_join(spark, d):
    """K1 in join form: the built-in keywords as a table, the same rows as the regex form."""
    found = with_keywords(T.bronze_postings(spark, d).select("id", "description"), "id", F.col("description"), default_keywords(spark), R.SKILL_COLUMNS)
    return found.select("id", *[F.concat_ws(";", c).alias(c) for c in R.SKILL_COLUMNS])


@register("keywords_by_join_large", cte() + f"SELECT p.id, p.company AS companies, {_SKILL_SQL} FROM exp_postings p")
def keywords_by_join_large(spark, d):
    """2.14: a caller's table beside the built-in one; every customer's name is a keyword of its own category, so it grows with the data."""
    names = read(spark, d, "customer").select(F.lit("companies").alias("category"), F.col("c_name").alias("keyword"), F.col("c_name").alias("canonical"))
    rows = T.bronze_postings(spark, d).select("id", F.concat_ws(" ", F.col("description"), F.lit("Apply to"), F.concat(F.col("company"), F.lit("."))).alias("text"))
    found = with_keywords(rows, "id", F.col("text"), default_keywords(spark).unionByName(names), ["companies", *R.SKILL_COLUMNS])
    return found.select("id", *[F.concat_ws(";", c).alias(c) for c in ["companies", *R.SKILL_COLUMNS]])


# ------------------------------------------------------------------ list literals
LITERAL_CASES = [
    ("['a', 'b']", ["a", "b"]), ("[\"it's\", 'b']", ["it's", "b"]), ("['x\"y']", ['x"y']), (r"['it\'s', 'b']", ["it's", "b"]),
    (r'["say \"hi\"", "b"]', ['say "hi"', "b"]), (r"['back\\slash']", ["back\\slash"]), (r"['line\nbreak', 'tab\there']", ["line\nbreak", "tab\there"]),
    (r"['not\\n a break']", ["not\\n a break"]), ("[]", []), ("[ ]", []), ("['one']", ["one"]), ("['a, b', 'c']", ["a, b", "c"]),
    ("['[x]', ']']", ["[x]", "]"]), ("['a',]", ["a"]), ("[ 'a' , \"b\" ]", ["a", "b"]), ("['', 'b', ' ']", ["b"]), ("[None, 'a']", ["a"]),
    ("[1, 2.5, 'c++']", ["1", "2.5", "c++"]), ("['é', '日本']", ["é", "日本"]), ("['a'", []), ("not a list", []), ("", []), ("['a'], ['b']", []),
    ("['a', ['b']]", []), (N, []),
]


@register("list_literal_cases", f"""
WITH c(k, skills) AS (VALUES {_values([(i, "|".join(c[1])) for i, c in enumerate(LITERAL_CASES)])})
SELECT o_orderkey AS id, c.skills FROM orders JOIN c ON c.k = o_orderkey % {len(LITERAL_CASES)}""")
def list_literal_cases(spark, d):
    """K7: quotes, escapes, commas and brackets inside items; what isn't a list is empty."""
    rows = _cases(spark, d, {"cell": [c[0] for c in LITERAL_CASES]})
    return rows.select("id", join_list(parse_list_literal("cell"), "|").alias("skills"))


# ------------------------------------------------------------------ pages with badges
_LOW, _HIDDEN = 'class="tvm__text tvm__text--low-emphasis"', 'class="visually-hidden"'
HEADER_CASES = [
    (f"<span {_LOW}><strong>$110K/yr - $130K/yr</strong></span><span {_LOW}><strong> Hybrid </strong></span>"
     f"<span {_HIDDEN}>Matches your job preferences, job type is Full-time.</span>", "$110K/yr - $130K/yr; Hybrid\nHybrid\nFull-time"),
    (f"<div {_LOW}>\n <strong>Remote</strong></div>", "Remote\nRemote"),
    (f"<span {_LOW}><em><strong>&pound;50,000&nbsp;a year</strong></em></span>", "£50,000 a year"),
    (f"<span id=x {_LOW} data-a='1'><strong class=b>Onsite</strong><strong>second</strong></span>", "Onsite\nOnsite"),
    ("<span class='tvm__text--low-emphasis'><strong>$40/hr</strong></span>", "$40/hr"),
    (f"<span {_HIDDEN}>Other</span><span {_HIDDEN}>Your job type is Contract.</span><span {_HIDDEN}>job type is Part-time.</span>", "Contract"),
    (f"<span {_LOW}>no bold text</span><span {_LOW}><strong> </strong></span>", N),
    ("<span class=\"tvm__text--low-emphasis-extra\"><strong>Remote</strong></span>", N),
    (f"<SPAN {_LOW}><STRONG>HYBRID</STRONG></SPAN>", "HYBRID\nHYBRID"),
    ("<p>nothing</p>", N), ("", N), (N, N),
]


@register("page_header_cases", f"""
WITH c(k, header_text) AS (VALUES {_values([(i, c[1]) for i, c in enumerate(HEADER_CASES)])})
SELECT page_id, c.header_text FROM pages JOIN c ON c.k = page_id % {len(HEADER_CASES)}""")
def page_header_cases(spark, d):
    """Badges put in front of the given pages, which have none of their own."""
    at = (F.col("page_id") % len(HEADER_CASES) + 1).cast("int")
    badge = F.element_at(lit_array([c[0] for c in HEADER_CASES]), at)
    html = F.when(badge.isNotNull(), F.concat(badge, F.coalesce("html", F.lit(""))))
    return read(spark, d, "pages").select("page_id", page_header(html).alias("header_text"))


# ------------------------------------------------------------------ CSV with everything that needs quoting
def _awkward(spark, d):
    """Postings whose texts hold quotes, commas, line breaks, backslashes and outer spaces."""
    b = T.bronze_postings(spark, d)
    hard = F.concat(F.lit('He said "hi, there"\nsecond line\r\n\\n is no break; '), F.col("description"), F.lit('\n"'))
    return b.select("id", F.concat(F.lit(' "'), F.col("title"), F.lit('", ')).alias("title"), "company", "location", "link", "source", "date_posted",
                    F.when(F.col("id") % 3 == 0, "").otherwise(F.col("work_type")).alias("work_type"), "employment_type", hard.alias("description"), "header_text")


_AWKWARD_SQL = cte() + r"""
SELECT id, ' "' || title || '", ' AS title, company, date_posted, length(company) AS n, 'He said "hi, there"' || chr(10) || 'second line' || chr(13) || chr(10) || '\n is no break; ' AS head,
       chr(10) || '"' AS tail, CASE WHEN c_mktsegment = '""" + T.HEADER_SEGMENT + r"""' THEN 'Hybrid' END AS header_text
FROM exp_postings"""


def _awkward_out(df):
    head = F.length(F.lit('He said "hi, there"\nsecond line\r\n\\n is no break; '))
    return df.select("id", "title", "company", "date_posted", F.length("company").cast("long").alias("n"), F.left("description", head).alias("head"),
                     F.right("description", F.lit(2)).alias("tail"), "header_text")


@register("csv_roundtrip_multiline", _AWKWARD_SQL)
def csv_roundtrip_multiline(spark, d):
    """S1 + S2: quoted fields over several lines (a file is one task)."""
    path = scratch_path(spark, "csv-multiline")
    write_csv(_awkward(spark, d), path)
    return _awkward_out(read_bronze_csv(spark, path))


@register("csv_roundtrip_splittable", _AWKWARD_SQL)
def csv_roundtrip_splittable(spark, d):
    """S1 + S2: line breaks written as escapes, so that a record is a line and large files are read in splits."""
    path = scratch_path(spark, "csv-lines")
    write_csv(_awkward(spark, d), path, splittable=True)
    return _awkward_out(read_bronze_csv(spark, path, splittable=True))


@register("silver_csv_roundtrip", cte() + f"SELECT p.id, p.country, p.experience_level, {_SKILL_SQL} FROM exp_postings p")
def silver_csv_roundtrip(spark, d):
    """S2 + K3 + K4: silver with its skill arrays as CSV cells, and back."""
    path = scratch_path(spark, "silver-csv")
    s = silver(spark, d).select("id", "country", "experience_level", *R.SKILL_COLUMNS)
    write_csv(s, path)
    schema = "id long, country string, experience_level string, " + ", ".join(f"{c} string" for c in R.SKILL_COLUMNS)
    back = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return back.select("id", "country", "experience_level", *[join_list(parse_list(c)).alias(c) for c in R.SKILL_COLUMNS])
