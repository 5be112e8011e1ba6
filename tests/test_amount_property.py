"""Randomised property: every supported number spelling parses back to its value."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirelens.functions.salary import parse_amount


def _group(n: int, sep: str, indian: bool = False) -> str:
    s = str(n)
    if not indian or len(s) <= 3:
        parts = []
        while len(s) > 3:
            parts.insert(0, s[-3:])
            s = s[:-3]
        return sep.join([s] + parts)
    head, tail = s[:-3], s[-3:]
    parts = []
    while len(head) > 2:
        parts.insert(0, head[-2:])
        head = head[:-2]
    return sep.join([head] + parts + [tail])


def spell(n: int, cents: int, style: str) -> tuple[str, float]:
    frac = f"{cents:02d}"
    if style == "us":
        return f"{_group(n, ',')}.{frac}", n + cents / 100
    if style == "eu":
        return f"{_group(n, '.')},{frac}", n + cents / 100
    if style == "indian":
        return _group(n, ",", indian=True), float(n)
    if style == "k":
        return f"{n}k", n * 1000.0
    if style == "m":
        return f"{n}.{cents // 10}M", (n + (cents // 10) / 10) * 1_000_000
    return str(n), float(n)


CASES = st.lists(st.tuples(st.integers(1, 99_999_999), st.integers(0, 99),
                           st.sampled_from(["us", "eu", "indian", "k", "m", "plain"])), min_size=30, max_size=80)


@settings(max_examples=4, deadline=None)
@given(CASES)
def test_amount_spellings_round_trip(spark, cases):
    rows = [spell(n, c, style) for n, c, style in cases]
    df = spark.createDataFrame(rows, "s string, expected double")
    got = df.select("s", "expected", parse_amount(F.col("s")).alias("v")).collect()
    for r in got:
        assert r.v is not None and abs(r.v - r.expected) <= 1e-6 * max(1.0, abs(r.expected)), (r.s, r.v, r.expected)
