"""DuckDB SQL that derives, from the driver's source columns, what the
extractors must return on the templated postings (oracle by construction).

No regex over the generated text: only the template fixtures (as VALUES
lists) and CASE / arithmetic on the same source columns.
"""

from __future__ import annotations

from hirelens import refdata as R
from hirelens.sources import driver_tables as T


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows) -> str:
    out = []
    for r in rows:
        cells = []
        for v in r:
            if v is None:
                cells.append("NULL")
            elif isinstance(v, str):
                cells.append(_q(v))
            elif isinstance(v, float):
                cells.append(f"CAST({v!r} AS DOUBLE)")
            else:
                cells.append(str(v))
        out.append("(" + ", ".join(cells) + ")")
    return ", ".join(out)


def skill_categories() -> list[tuple[str, str]]:
    """(template skill text, category) for every keyword list the skill belongs to."""
    rows = []
    for text in T.SKILL_BY_BRAND:
        for cat, kws in R.SKILL_CATEGORIES.items():
            if text in kws:
                rows.append((text, cat))
    return rows


def cte() -> str:
    """``WITH`` prefix defining ``exp_postings`` (one row per order) and
    ``exp_job_skills`` (job_id, skill, skill_category)."""
    rates = R.synthetic_rates()
    nt = [(i, *t) for i, t in enumerate(T.NATION_TEMPLATES)]
    brand = [(i + 1, s, R.canonical_skill(s)) for i, s in enumerate(T.SKILL_BY_BRAND)]
    prefix = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in T.TITLE_PREFIX.items())
    role = " ".join(f"WHEN {_q(k)} THEN {_q(v[0])}" for k, v in T.ROLE_BY_SEGMENT.items())
    period_rows = [(i, float(p[1]), p[2]) for i, p in enumerate(T.PERIOD_BY_MONTH_MOD)]
    return f"""
WITH nt(nk, location, country, token, placement, iso) AS (VALUES {_values(nt)}),
fx(code, rate) AS (VALUES {_values([(k, float(v)) for k, v in rates.items()])}),
brand_skill(bn, text_skill, skill) AS (VALUES {_values(brand)}),
skill_cat(text_skill, category) AS (VALUES {_values(skill_categories())}),
period_t(pm, divisor, period) AS (VALUES {_values(period_rows)}),
exp_base AS (
  SELECT o.o_orderkey AS id, c.c_name AS company, nt.location, nt.country, nt.iso,
         CAST(o.o_orderdate AS DATE) AS date_posted, o.o_orderstatus, o.o_orderpriority, c.c_mktsegment,
         o.o_totalprice, COALESCE(fx.rate, CAST(1.0 AS DOUBLE)) AS rate,
         pt.divisor, pt.period,
         (CASE o.o_orderpriority {prefix} END) || (CASE c.c_mktsegment {role} END) AS title,
         dayofmonth(o.o_orderdate) % 7 AS lo_y,
         dayofmonth(o.o_orderdate) % 7 + month(o.o_orderdate) % 3 + 1 AS hi_y,
         n.n_regionkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN nt ON nt.nk = c.c_nationkey
  LEFT JOIN fx ON fx.code = nt.iso
  JOIN period_t pt ON pt.pm = month(o.o_orderdate) % 5
),
exp_amounts AS (
  SELECT *, floor(o_totalprice * rate / divisor) AS amt,
         floor(o_totalprice * CAST({T.RANGE_UPPER_FACTOR!r} AS DOUBLE) * rate / divisor) AS amt_hi
  FROM exp_base
),
exp_raw AS (
  SELECT *,
    CASE WHEN o_orderstatus = 'F' AND amt * divisor >= {R.MIN_ANNUAL_LOCAL!r} THEN amt END AS min_raw,
    CASE WHEN o_orderstatus = 'F' AND amt_hi * divisor >= {R.MIN_ANNUAL_LOCAL!r} THEN amt_hi END AS max_raw,
    CASE WHEN o_orderstatus = 'O' AND amt * divisor >= {R.MIN_ANNUAL_LOCAL!r} THEN amt END AS single_raw
  FROM exp_amounts
),
exp_postings AS (
  SELECT id, title, company, location, country, date_posted, o_orderstatus, o_orderpriority, c_mktsegment,
    n_regionkey, o_totalprice,
    (min_raw IS NOT NULL OR max_raw IS NOT NULL OR single_raw IS NOT NULL) AS has_salary,
    CASE WHEN min_raw IS NOT NULL OR max_raw IS NOT NULL OR single_raw IS NOT NULL THEN iso END AS currency_raw,
    min_raw AS min_salary_raw, max_raw AS max_salary_raw, single_raw AS single_salary_raw,
    CASE WHEN min_raw IS NOT NULL OR max_raw IS NOT NULL OR single_raw IS NOT NULL THEN period END AS salary_period,
    CASE WHEN min_raw IS NOT NULL AND max_raw IS NOT NULL THEN
           CASE WHEN min_raw * divisor / rate <= {R.MAX_ANNUAL_USD!r} THEN min_raw * divisor / rate END
         WHEN single_raw IS NOT NULL THEN
           CASE WHEN single_raw * divisor / rate <= {R.MAX_ANNUAL_USD!r} THEN single_raw * divisor / rate END
    END AS min_salary_annual_usd,
    CASE WHEN min_raw IS NOT NULL AND max_raw IS NOT NULL THEN
           CASE WHEN max_raw * divisor / rate <= {R.MAX_ANNUAL_USD!r} THEN max_raw * divisor / rate END
         WHEN single_raw IS NOT NULL THEN
           CASE WHEN single_raw * divisor / rate <= {R.MAX_ANNUAL_USD!r} THEN single_raw * divisor / rate END
    END AS max_salary_annual_usd,
    CASE WHEN min_raw IS NOT NULL AND max_raw IS NOT NULL THEN
           CASE WHEN (min_raw * divisor / rate + max_raw * divisor / rate) / 2 <= {R.MAX_ANNUAL_USD!r}
                THEN (min_raw * divisor / rate + max_raw * divisor / rate) / 2 END
         WHEN single_raw IS NOT NULL THEN
           CASE WHEN single_raw * divisor / rate <= {R.MAX_ANNUAL_USD!r} THEN single_raw * divisor / rate END
    END AS avg_salary_annual_usd,
    CASE WHEN min_raw IS NULL AND max_raw IS NULL AND single_raw IS NULL THEN NULL
         ELSE CAST(round(least(1.0, 0.5 + CASE WHEN min_raw IS NOT NULL AND max_raw IS NOT NULL THEN 0.3 ELSE 0 END
                   + 0.1 + CASE WHEN period IS NOT NULL THEN 0.1 ELSE 0 END), 4) AS DOUBLE) END AS salary_confidence,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Senior'
         WHEN o_orderpriority = '5-LOW' THEN 'Entry-Level'
         WHEN o_orderpriority = '3-MEDIUM' THEN
           CASE WHEN hi_y <= 2 THEN 'Entry-Level' WHEN lo_y >= 5 THEN 'Senior' ELSE 'Mid-Level' END
         ELSE 'Not Specified' END AS experience_level,
    CASE WHEN c_mktsegment = {_q(T.HEADER_SEGMENT)} THEN 'Hybrid'
         WHEN o_orderstatus = 'F' THEN 'Remote' WHEN o_orderstatus = 'O' THEN 'On-site'
         ELSE 'Not Specified' END AS work_type,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Full-time' WHEN 'BUILDING' THEN 'Contract'
         WHEN 'FURNITURE' THEN 'Part-time' WHEN 'HOUSEHOLD' THEN 'Temporary'
         ELSE 'Not Specified' END AS employment_type
  FROM exp_raw
),
exp_order_skills AS (
  SELECT DISTINCT l.l_orderkey AS job_id, bs.text_skill, bs.skill
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN brand_skill bs ON bs.bn = CAST(regexp_extract(p.p_brand, '(\\d+)$', 1) AS INTEGER)
),
exp_job_skills AS (
  SELECT os.job_id, os.skill, sc.category AS skill_category
  FROM exp_order_skills os JOIN skill_cat sc ON sc.text_skill = os.text_skill
)
"""


def cluster_cte(steps: int = 10) -> str:
    """``cte()`` and ``exp_clustered``: postings with the cluster that ``steps`` rounds of K-means give them.

    Lloyd's algorithm written out in SQL over distinct skill sets: start at the
    signatures, assign, average, repeat.
    """
    start = [(i, s, 1.0) for i, name in enumerate(R.CLUSTER_NAMES) for s in R.CLUSTER_SIGNATURES[name]]
    rounds = ""
    for i in range(steps + 1):
        rounds += f""",
dist{i} AS (
  SELECT s.sid, s.n, q.j, round(q.q - 2 * coalesce(dot.dot, 0), 9) AS d
  FROM skill_sets s CROSS JOIN (SELECT c.j, coalesce(sum(k.w * k.w), 0) AS q FROM cluster_no c LEFT JOIN k{i} k ON k.j = c.j GROUP BY c.j) q
  LEFT JOIN (SELECT m.sid, k.j, sum(k.w) AS dot FROM set_skills m JOIN k{i} k ON k.skill = m.skill GROUP BY m.sid, k.j) dot ON dot.sid = s.sid AND dot.j = q.j
),
near{i} AS MATERIALIZED (SELECT sid, n, j FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY d, j) AS rn FROM dist{i}) WHERE rn = 1)"""
        if i < steps:
            rounds += f""",
size{i} AS (SELECT j, sum(n) AS n FROM near{i} GROUP BY j),
k{i + 1} AS MATERIALIZED (
  SELECT a.j, m.skill, CAST(sum(a.n) AS DOUBLE) / any_value(z.n) AS w FROM near{i} a JOIN set_skills m ON m.sid = a.sid JOIN size{i} z ON z.j = a.j GROUP BY a.j, m.skill
  UNION ALL SELECT * FROM k{i} WHERE j NOT IN (SELECT j FROM size{i})
)"""
    return cte() + f""",
job_skill AS (SELECT DISTINCT job_id, skill FROM exp_job_skills),
vocabulary AS (SELECT skill FROM job_skill GROUP BY skill ORDER BY count(*) DESC, skill LIMIT {R.TOP_SKILL_FEATURES}),
job_set AS MATERIALIZED (
  SELECT p.id, coalesce(string_agg(s.skill, ';' ORDER BY s.skill), '') AS sid
  FROM exp_postings p LEFT JOIN (SELECT * FROM job_skill WHERE skill IN (SELECT skill FROM vocabulary)) s ON s.job_id = p.id GROUP BY p.id
),
skill_sets AS MATERIALIZED (SELECT sid, count(*) AS n FROM job_set GROUP BY sid),
set_skills AS MATERIALIZED (SELECT sid, unnest(string_split(sid, ';')) AS skill FROM skill_sets WHERE sid <> ''),
cluster_no(j, name) AS (VALUES {_values(list(enumerate(R.CLUSTER_NAMES)))}),
signature(j, skill, w) AS (VALUES {_values(start)}),
k0 AS (SELECT * FROM signature WHERE skill IN (SELECT skill FROM vocabulary)){rounds},
exp_clustered AS (
  SELECT p.*, CAST(a.j AS INTEGER) AS cluster, c.name AS cluster_name
  FROM exp_postings p JOIN job_set s ON s.id = p.id JOIN near{steps} a ON a.sid = s.sid JOIN cluster_no c ON c.j = a.j
)
"""
