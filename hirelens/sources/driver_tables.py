"""Adapter: job postings templated from the driver's TPC-H-style tables.

The driver's tables hold no job postings, so bronze postings are *built* from
them with column templates (SURVEY §7.3).  Every text field is a function of
the source columns, so the expected result of each extractor is known from
those columns and can be written as plain SQL (see ``plans.oracles``).

One order = one posting:

| posting field | from |
| --- | --- |
| id | o_orderkey |
| title | o_orderpriority (seniority word) + c_mktsegment (role) |
| company | c_name |
| location | n_nationkey → one of 25 location strings |
| date_posted | o_orderdate |
| description | years sentence (priority 3), work-type sentence (o_orderstatus), employment sentence (c_mktsegment), skills sentence (brands of the order's parts), salary sentence (o_totalprice, nation currency, period from the order month) |
| header_text | 'Hybrid' for HOUSEHOLD customers, else null |
| link | https://jobs.example.com/view/<o_orderkey> |
| source | r_name |

All joins are equi-joins on keys; nation and region are 25 and 5 rows by
the TPC-H schema, so broadcasting them is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions.literals import lit_array, lit_map

from hirelens import refdata as R

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# ---------------------------------------------------------------------------
# Fixtures of the templates (our own).  Index = p_brand number - 1.
# ---------------------------------------------------------------------------
SKILL_BY_BRAND = [
    "sql", "python", "r", "excel", "tableau", "aws", "azure", "spark", "java", "scala",
    "snowflake", "looker", "sas", "airflow", "docker", "pandas", "tensorflow", "pytorch",
    "scikit-learn", "gcp", "bigquery", "keras", "git", "power bi", "c++",
]
# Index = n_nationkey: (location text, country it must resolve to,
#                       currency token, placement: P touching prefix / S spaced prefix / X suffix, ISO code)
NATION_TEMPLATES = [
    ("Greater Bengaluru Area", "India", "₹", "P", "INR"),
    ("San Jose, CA", "United States", "$", "P", "USD"),
    ("Paris, Île-de-France, France", "France", "€", "P", "EUR"),
    ("Kuala Lumpur, Federal Territory of Kuala Lumpur, Malaysia", "Malaysia", "RM", "S", "MYR"),
    ("Singapore", "Singapore", "SGD", "X", "SGD"),
    ("Berlin, Germany", "Germany", "EUR", "S", "EUR"),
    ("Austin, Texas Metropolitan Area", "United States", "USD", "S", "USD"),
    ("Toronto, ON", "Canada", "CAD", "X", "CAD"),
    ("Jakarta, Indonesia", "Indonesia", "Rp", "S", "IDR"),
    ("Bangkok City, Thailand", "Thailand", "THB", "S", "THB"),
    ("Dubai, United Arab Emirates", "United Arab Emirates", "AED", "S", "AED"),
    ("Riyadh, Saudi Arabia", "Saudi Arabia", "SAR", "X", "SAR"),
    ("Mexico City, Mexico", "Mexico", "MX$", "P", "MXN"),
    ("Greater Manchester, England, United Kingdom", "United Kingdom", "£", "P", "GBP"),
    ("Tokyo, Japan", "Japan", "¥", "P", "JPY"),
    ("Karachi, Sindh, Pakistan", "Pakistan", "PKR", "S", "PKR"),
    ("Remote", "Unknown", "$", "P", "USD"),
    ("Lisbon, Portugal", "Portugal", "€", "P", "EUR"),
    ("Madrid, Community of Madrid, Spain", "Spain", "EUR", "X", "EUR"),
    ("Seattle, WA", "United States", "US$", "P", "USD"),
    ("Boulder, CO", "United States", "$", "P", "USD"),
    ("Sydney, New South Wales, Australia", "Australia", "AUD", "S", "AUD"),
    ("Mumbai Metropolitan Region", "India", "INR", "S", "INR"),
    ("São Paulo, Brazil", "Brazil", "BRL", "S", "BRL"),
    ("Dallas-Fort Worth Metroplex", "United States", "USD", "X", "USD"),
]
# o_orderpriority → title prefix; c_mktsegment → role and employment sentence.
TITLE_PREFIX = {"1-URGENT": "Senior ", "2-HIGH": "Lead ", "3-MEDIUM": "", "4-NOT SPECIFIED": "", "5-LOW": "Junior "}
ROLE_BY_SEGMENT = {
    "AUTOMOBILE": ("Data Analyst", "Full-time position."),
    "BUILDING": ("Data Engineer", "Contract role."),
    "FURNITURE": ("BI Developer", "Part-time schedule."),
    "HOUSEHOLD": ("Data Scientist", "Temporary assignment."),
    "MACHINERY": ("Machine Learning Engineer", ""),
}
WORK_SENTENCE_BY_STATUS = {"F": "This role is remote.", "O": "Work on site in our office.", "P": ""}
HEADER_SEGMENT = "HOUSEHOLD"
# month(o_orderdate) % 5 → (period phrase, divisor from annual, period name or None)
PERIOD_BY_MONTH_MOD = [(" per year", 1, "year"), (" monthly", 12, "month"), (" per hour", 2080, "hour"),
                       ("", 1, None), (" per week", 52, "week")]
RANGE_UPPER_FACTOR = 1.25
#: Postings a task builds, whatever their number: extraction costs far more than the bytes tell.
ROWS_A_TASK = 20_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")






def skill_name(brand: Column) -> Column:
    """'Brand#7' → the 7th template skill."""
    n = F.regexp_extract(brand, r"(\d+)$", 1).try_cast("int")
    return F.element_at(lit_array(SKILL_BY_BRAND), n)


def order_skill_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, skills) — sorted distinct template skills of an order's parts."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (li.join(part, li.l_partkey == part.p_partkey)
            .groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_set(skill_name(F.col("p_brand")))).alias("skills")))


def _fmt_money(token: Column, placement: Column, amount: Column) -> Column:
    num = F.format_number(amount, 0)
    return (F.when(placement == "P", F.concat(token, num))
            .when(placement == "S", F.concat(token, F.lit(" "), num))
            .otherwise(F.concat(num, F.lit(" "), token)))


def bronze_postings(spark: SparkSession, sf_dir: str, rates: dict[str, float] | None = None) -> DataFrame:
    """Bronze-schema postings (id, title, company, location, link, source, date_posted,
    work_type, employment_type, description, header_text), one per order."""
    rates = rates if rates is not None else R.synthetic_rates()
    o = read(spark, sf_dir, "orders")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = F.broadcast(read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    r = F.broadcast(read(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    skills = order_skill_lists(spark, sf_dir)

    df = (o.join(skills, o.o_orderkey == skills.l_orderkey, "left")
          .join(c, o.o_custkey == c.c_custkey)
          .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    # Dealt while the rows are narrow: by bytes alone, a task would get a million rows to extract from.
    tasks = max(spark.sparkContext.defaultParallelism, -(-o.count() // ROWS_A_TASK))
    df = df.repartition(tasks, "o_orderkey", "o_custkey")

    nk = F.col("n_nationkey") + 1  # element_at is 1-based
    location = F.element_at(lit_array([t[0] for t in NATION_TEMPLATES]), nk)
    token = F.element_at(lit_array([t[2] for t in NATION_TEMPLATES]), nk)
    placement = F.element_at(lit_array([t[3] for t in NATION_TEMPLATES]), nk)
    iso = F.element_at(lit_array([t[4] for t in NATION_TEMPLATES]), nk)
    rate = F.coalesce(F.element_at(lit_map({k: float(v) for k, v in rates.items()}), iso), F.lit(1.0))

    pm = (F.month("o_orderdate") % 5) + 1
    phrase = F.element_at(lit_array([p[0] for p in PERIOD_BY_MONTH_MOD]), pm)
    divisor = F.element_at(lit_array([float(p[1]) for p in PERIOD_BY_MONTH_MOD]), pm)
    amount = F.floor(F.col("o_totalprice") * rate / divisor)
    amount_hi = F.floor(F.col("o_totalprice") * F.lit(RANGE_UPPER_FACTOR) * rate / divisor)
    salary_sentence = (
        F.when(F.col("o_orderstatus") == "F",
               F.concat(F.lit("Salary: "), _fmt_money(token, placement, amount), F.lit(" - "),
                        _fmt_money(token, placement, amount_hi), phrase, F.lit(".")))
        .when(F.col("o_orderstatus") == "O",
              F.concat(F.lit("Pay: "), _fmt_money(token, placement, amount), phrase, F.lit(".")))
        .otherwise(F.lit("Competitive package."))
    )
    lo_years = F.dayofmonth("o_orderdate") % 7
    hi_years = lo_years + (F.month("o_orderdate") % 3) + 1
    years_sentence = F.when(F.col("o_orderpriority") == "3-MEDIUM",
                            F.concat(F.lit("Requires "), lo_years.cast("string"), F.lit("-"),
                                     hi_years.cast("string"), F.lit(" years of experience.")))
    role = lit_map({k: v[0] for k, v in ROLE_BY_SEGMENT.items()})
    employment_sentence = lit_map({k: v[1] for k, v in ROLE_BY_SEGMENT.items()})
    skills_sentence = F.when(F.size(F.coalesce("skills", F.array())) > 0,
                             F.concat(F.lit("Skills: "), F.concat_ws(", ", "skills"), F.lit(".")))
    description = F.concat_ws(
        " ",
        years_sentence,
        F.nullif(F.element_at(lit_map(WORK_SENTENCE_BY_STATUS), F.col("o_orderstatus")), F.lit("")),
        F.nullif(F.element_at(employment_sentence, F.col("c_mktsegment")), F.lit("")),
        skills_sentence,
        salary_sentence,
    )
    title = F.concat(F.element_at(lit_map(TITLE_PREFIX), F.col("o_orderpriority")),
                     F.element_at(role, F.col("c_mktsegment")))
    return df.select(
        F.col("o_orderkey").alias("id"),
        title.alias("title"),
        F.col("c_name").alias("company"),
        location.alias("location"),
        F.concat(F.lit("https://jobs.example.com/view/"), F.col("o_orderkey").cast("string")).alias("link"),
        F.col("r_name").alias("source"),
        F.to_date("o_orderdate").alias("date_posted"),
        F.lit(None).cast("string").alias("work_type"),
        F.lit(None).cast("string").alias("employment_type"),
        description.alias("description"),
        F.when(F.col("c_mktsegment") == HEADER_SEGMENT, F.lit("Hybrid")).alias("header_text"),
    )
