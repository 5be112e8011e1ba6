"""Personal data: candidate spans, boosted trees, calibrated threshold (DataFrame functions and Spark ML only).

Base rules find email, ip, card and phone spans exactly.  High-recall generators
propose further spans, which may overlap: obfuscated addresses, numbers without
plus, card-like digits, long keys and so on.  Gradient-boosted trees on format
and context features learn from the candidates that the base rules settle (those
that pass, and those that look alike and fail) and from keys named as such; the
threshold is set on candidates held out from the trees, and what scores above it
is added to the base spans.

The trees and the threshold take in every settled candidate: those alike in all
features are one row with their number as its weight.  Only spans are shuffled,
never texts.

Cases: null and empty texts have no spans.  Rows that repeat are each answered.
Without candidates of both kinds nothing is added.  Positions are code points,
ends exclusive.  Input columns named as a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import cut, with_columns_last

#: Fixed: kinds of the base rules, in order.
KINDS = ["email", "ip", "card", "phone"]
#: Fixed patterns of the base rules, written so that long runs are passed once: a match can only begin where a run of its
#: first class begins, or right after the last match.
LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of further candidates.
MORE = {
    "email": r"(?i)(?<![\w.])[\w.%+-]{1,64} ?[\[(] ?at ?[\])] ?[\w-]+(?:(?: ?[\[(] ?dot ?[\])] ?|\.)[\w-]+)+",
    "phone": r"(?<![\w.+-])\(?[0-9]{2,4}\)?(?:[ .-]\(?[0-9]{2,4}\)?){2,4}(?![\w])",
    "card": r"(?<![\w])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![\w])",
    "ip6": r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "iban": r"(?<![\w])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\w])",
    "secret": r"(?<![\w/+=-])[A-Za-z0-9_/+-]{20,}+(?![\w=])",
}
#: Cheap conditions that a text must meet before a pattern is tried on it.
NEEDS = {"email": "@", "phone": "+"}
CONTEXT = 24
WORDS = {
    "key": r"(?i)(token|key|secret|passw|api|auth|bearer)\W*$",
    "phone": r"(?i)(tel|phone|call|fax|mobile|cell)\W*$",
    "card": r"(?i)(card|visa|credit|account|iban|pay)\W*$",
    "net": r"(?i)(ip|host|server|mail|contact|address)\W*$",
}
PRECISION = 0.95
SPAN = "struct<start:int,end:int,kind:string,value:string,left:string,right:string>"


def matches(text: Column, pattern: str, kind: str, context: int = 0) -> Column:
    """All matches as (start, end, kind, value, left, right): what lies between them gives the positions."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["g"]
        end = begin + F.char_length(x["v"])
        left = F.substring(text, F.greatest(begin - context + 1, F.lit(1)), F.least(begin, F.lit(context))) if context else F.lit("")
        right = F.substring(text, end + 1, F.lit(2)) if context else F.lit("")
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["v"].alias("value"), left.alias("left"), right.alias("right"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    pairs = F.filter(F.arrays_zip(gaps.alias("g"), found.alias("v")), lambda x: x["v"].isNotNull())
    spans = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def _from(source: str) -> Callable[[Column], Column]:
    return lambda s: s.withField("source", F.lit(source))


def _of(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    back = F.reverse(number)
    each = F.transform(F.sequence(F.lit(1), F.char_length(number)), lambda i: F.substring(back, i, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """What the base rule asks of a match beyond its pattern."""
    if kind == "ip":
        plain = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
        return F.forall(plain, lambda p: (F.char_length(p) <= 3) & (F.coalesce(F.when(p != "", p).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        number = digits(value)
        return F.when(F.char_length(number).between(14, 19), luhn(number)).otherwise(F.lit(False))
    if kind == "phone":
        return F.char_length(digits(value)).between(10, 15)
    return F.lit(True)


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__spans`` (all candidates, with context) and without its text."""
    text, none = F.coalesce(F.col("text"), F.lit("")), F.array().cast(f"array<{SPAN}>")
    has_digit = F.col("__text").rlike("[0-9]")
    parts = []
    for source, patterns in (("base", BASE), ("more", MORE)):
        for kind, pattern in patterns.items():
            if source == "base" and kind in NEEDS:
                tried = F.contains("__text", F.lit(NEEDS[kind]))
            elif kind == "email":
                tried = F.col("__text").rlike(r"(?i)[\[(] ?at ?[\])]")
            else:
                tried = has_digit
            spans = F.when(tried, matches(F.col("__text"), pattern, kind, CONTEXT)).otherwise(none)
            parts.append(F.transform(spans, _from(source)))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.withColumn("__text", text).select(*others, F.xxhash64("text").alias("__hash"), F.concat(*parts).alias("__spans"))


def features(spans: DataFrame) -> DataFrame:
    """Format and context features, and what is known of a candidate: ``base`` (a base span) and ``y`` (null: unknown)."""
    v, count = F.col("s.value"), lambda p: F.char_length(F.regexp_replace("s.value", p, "")).cast("double")
    known = F.lit(None).cast("boolean")
    for kind in KINDS:
        known = F.when((F.col("s.source") == "base") & (F.col("s.kind") == kind), passes(kind, v)).otherwise(known)
    named = F.col("s.left").rlike(WORDS["key"])
    known = F.when(F.col("s.kind") == "secret", named & v.rlike("[0-9]")).otherwise(known)
    out = spans.withColumn("y", known.cast("double")).withColumn("base", (F.col("s.source") == "base") & (F.col("y") == 1))
    columns = {
        "f_length": F.char_length(v).cast("double"), "f_digits": count("[^0-9]"), "f_upper": count("[^A-Z]"), "f_lower": count("[^a-z]"),
        "f_breaks": count("[^ ()-]"), "f_dots": count("[^.]"), "f_colons": count("[^:]"), "f_at": count("[^@]"),
        "f_plus": v.startswith("+").cast("double"), "f_hex": v.rlike("^[0-9a-fA-F]+$").cast("double"),
        "f_luhn": F.coalesce(F.when(F.char_length(digits(v)).between(12, 19), luhn(digits(v))), F.lit(False)).cast("double"),
        "f_big": F.coalesce(F.exists(F.filter(F.split(v, r"[^0-9]+"), lambda p: p != ""), lambda p: (F.char_length(p) > 3) | (F.substring(p, 1, 3) > "255")), F.lit(False)).cast("double"),
        "f_quoted": F.col("s.left").rlike("[\"'=:]$").cast("double"), "f_joined": F.col("s.right").rlike(r"^[\w]").cast("double"),
    } | {f"f_word_{k}": F.col("s.left").rlike(p).cast("double") for k, p in WORDS.items()}
    out = out.withColumns(columns)
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(out)


def settled(spans: DataFrame) -> DataFrame:
    """All candidates of known ``y``, by (y, held, features): ``n`` of them are alike; ``held``: kept from the trees, by the text's hash."""
    names = [c for c in spans.columns if c.startswith("f_")]
    held = (F.pmod(F.xxhash64("__hash"), F.lit(3)) == 0).alias("held")
    alike = spans.where("y is not null").groupBy("y", held, *names).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return VectorAssembler(inputCols=names, outputCol="features").transform(alike).select("y", "held", "n", "features")


def accepted(spans: DataFrame, precision: float = PRECISION) -> DataFrame:
    """The spans to report: base spans, and candidates that the trees score above the calibrated threshold."""
    known = cut(settled(spans), "pii-settled")
    counts = {(r["held"], r["y"]): r["n"] for r in known.groupBy("held", "y").agg(F.sum("n").alias("n")).collect()}
    if min(counts.get((h, y), 0) for h in (False, True) for y in (0.0, 1.0)) < 5:
        return spans.where("base")
    least_weight = min(0.4, 5 / (counts[False, 0.0] + counts[False, 1.0]))  # five candidates a leaf, alike or not
    trees = GBTClassifier(labelCol="y", weightCol="n", maxIter=10, maxDepth=4, stepSize=0.3, seed=7, checkpointInterval=-1, minWeightFractionPerNode=least_weight)
    model = trees.fit(known.where("not held"))
    score = F.round(vector_to_array("probability")[1], 3)
    curve = model.transform(known.where("held")).groupBy(score.alias("p")).agg(F.sum(F.col("y") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect()
    least, good, n = 2.0, 0.0, 0.0
    for p, g, k in sorted(((r["p"], r["good"], r["n"]) for r in curve), reverse=True):
        good, n = good + g, n + k
        if p >= 0.5 and good >= precision * n:
            least = p
    return model.transform(spans).where(F.col("base") | (score >= F.lit(least)))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` without text, with base_spans and all_spans: arrays of (start, place, end, kind), sorted."""
    kept = with_columns_last(docs, ["base_spans", "all_spans"])
    rows = cut(candidates(kept), "pii-candidates")
    each = features(rows.where(F.size("__spans") > 0).select(F.col("doc_id").alias("__id"), "__hash", F.explode("__spans").alias("s")))
    place = F.coalesce(F.element_at(F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))]), F.col("s.kind")), F.lit(len(KINDS)))
    span = F.struct(F.col("s.start").alias("start"), place.alias("place"), F.col("s.end").alias("end"), F.col("s.kind").alias("kind"))
    found = accepted(each).groupBy("__id", F.col("__hash").alias("__h")).agg(
        F.array_sort(F.collect_set(F.when(F.col("base"), span))).alias("base_spans"), F.array_sort(F.collect_set(span)).alias("all_spans"))
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    out = rows.drop("__spans").join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__h")), "left")
    others = [F.col(f"`{c}`") for c in kept.columns if c != "text"]
    out = out.withColumn("base_spans", F.coalesce("base_spans", none))
    # Where an added span overlaps a base span, the base span says enough.
    added = F.filter(F.coalesce("all_spans", none), lambda s: ~F.exists("base_spans", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return out.select(*others, "base_spans", F.array_sort(F.concat("base_spans", added)).alias("all_spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash and list of the spans."""
    counts = [F.size(F.filter("base_spans", _of(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base_spans")), 256).alias("base_sha256"), joined(F.col("all_spans")).alias("spans"))
