"""K1 for keyword tables of any size: dictionary matching as an equi-join.

A vocabulary of some hundred words is best compiled into one regex
(``functions.skills``).  A caller's table of many thousand can't be.  Here a text
is cut into words and what stands between them; every run of up to ``max_words``
words, as written, is a candidate, and candidates are joined with the keywords by
equality.  The edge rules are those of the regex form: a keyword must not touch a
letter, digit, ``_``, ``+`` or ``#``.

What is shuffled is small: a bitmap of the keywords' hashes (16 bits a keyword)
drops most candidates next to the scan, and a keyword that a third of all texts hold is spread over ``salts`` tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import refdata as R

WORD = r"[\p{L}\p{N}_+#]+"
#: Characters kept of what stands before and after a candidate.
AROUND = 8
#: Size of the bitmap: bits a keyword, and at least and at most how many.  Where it is full, more is shuffled; the hits are the same.
BITS_A_KEYWORD, MIN_BITS, MAX_BITS = 16, 1 << 18, 1 << 27


def default_keywords(spark: SparkSession) -> DataFrame:
    """The built-in vocabulary as a table (category, keyword, canonical)."""
    rows = [(c, k.lower(), R.canonical_skill(k.lower())) for c, kws in R.SKILL_CATEGORIES.items() for k in sorted({k.lower() for k in kws})]
    return spark.createDataFrame(rows, "category string, keyword string, canonical string")


def _prepared(keywords: DataFrame, max_words: int) -> DataFrame:
    """(category, canonical, _key, _lead, _trail): the words of a keyword, and signs before and after them."""
    k = F.lower(F.trim("keyword"))
    key = F.regexp_extract(k, rf"{WORD}(?:[\s\S]*{WORD})?", 0)
    lead, trail = F.regexp_extract(k, r"^[^\p{L}\p{N}_+#]*", 0), F.regexp_extract(k, r"[^\p{L}\p{N}_+#]*$", 0)
    canonical = F.col("canonical") if "canonical" in keywords.columns else F.trim("keyword")
    out = keywords.where(F.trim("keyword") != "").select("category", canonical.alias("canonical"), k.alias("_k"), key.alias("_key"), lead.alias("_lead"), trail.alias("_trail"))
    words = F.size(F.regexp_extract_all("_key", F.lit(WORD), 0))
    wrong = (F.col("_key") == "") | (words > max_words) | (F.greatest(F.length("_lead"), F.length("_trail")) >= AROUND)
    checked = F.when(wrong, F.raise_error(F.concat(F.lit(f"keyword without a letter or digit, of more than {max_words} words, or with more than {AROUND - 1} signs around them: "), F.col("_k"))).cast("string"))
    return out.withColumn("_key", checked.otherwise(F.col("_key"))).drop("_k").distinct()


def bitmap_bits(keywords: int) -> int:
    """Bits of a bitmap for so many keywords: a power of two, so that some one in sixteen other candidates passes it."""
    return min(max(1 << (BITS_A_KEYWORD * keywords - 1).bit_length(), MIN_BITS), MAX_BITS)


def _bitmap(keys: DataFrame, bits: int) -> Column:
    """A scalar: the bitmap of the keys' hashes as an array of longs."""
    at = F.pmod(F.xxhash64("_key"), F.lit(bits))
    words = keys.select(F.floor(at / 64).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int")).alias("b")) \
        .groupBy("w").agg(F.bit_or("b").alias("b"))
    whole = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("i")).join(words, F.col("i") == F.col("w"), "left")
    filled = F.struct("i", F.coalesce("b", F.lit(0).cast("long")).alias("b"))
    return whole.agg(F.array_sort(F.collect_list(filled)).alias("m")).select(F.col("m.b")).scalar()


def match_keywords(df: DataFrame, ids: list[str], text: Column, keywords: DataFrame, max_words: int = 4, salts: int = 16,
                   bits: int | None = None) -> DataFrame:
    """One row (``ids``, category, canonical) per keyword that occurs in a row's text.

    ``keywords`` is (category, keyword[, canonical]); one keyword may be in
    several categories.  Null texts hold none.  A keyword the method can't find
    (no letter or digit, too many words) fails the query.
    """
    keys = _prepared(keywords, max_words)
    bits = bits or bitmap_bits(max(1, keywords.count()))
    # No filter on texts or words: it would be moved to where the texts are built, and cut them there a second time.  Null or wordless texts have no runs.
    low = df.select(*ids, F.lower(text).alias("_x"))
    cut = low.select(*ids, F.regexp_extract_all("_x", F.lit(WORD), 0).alias("_w"), F.split("_x", WORD, -1).alias("_s"))
    # word, what follows it, word, …: a run of words as written is a slice of this, joined.
    cut = cut.withColumn("_p", F.flatten(F.transform("_w", lambda w, i: F.array(w, F.element_at("_s", i + 2))))).withColumn("_n", F.size("_w"))

    def runs(k: int) -> Column:
        if k == 1:
            return F.transform("_w", lambda w, j: F.struct((j + 1).alias("at"), F.lit(1).alias("k"), w.alias("key")))
        starts = F.when(F.col("_n") >= k, F.sequence(F.lit(1), F.col("_n") - (k - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(k).alias("k"), F.array_join(F.slice("_p", 2 * i - 1, 2 * k - 1), "").alias("key")))

    # What stands around a run is read for those that pass the bitmap only.  Equal ones of a text are not told apart here: for structs, that is quadratic.
    found = cut.select(*ids, "_s", "_n", F.explode(F.concat(*[runs(k + 1) for k in range(max_words)])).alias("_c"))
    at = F.pmod(F.xxhash64("_c.key"), F.lit(bits))
    likely = found.where(F.getbit(F.element_at(_bitmap(keys, bits), (F.floor(at / 64) + 1).cast("int")), (at % 64).cast("int")) == 1)
    i, k = F.col("_c.at"), F.col("_c.k")
    likely = likely.select(*ids, F.struct(
        F.col("_c.key").alias("key"),
        F.right(F.element_at("_s", i), F.lit(AROUND)).alias("before"), (i == 1).alias("first"),
        F.left(F.element_at("_s", i + k), F.lit(AROUND)).alias("after"), (i == F.col("_n") - (k - 1)).alias("last")).alias("_r"))
    salted = likely.withColumn("_salt", F.pmod(F.xxhash64(*ids), F.lit(salts)).cast("int"))
    spread = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hits = salted.join(spread, (F.col("_r.key") == F.col("_key")) & (salted["_salt"] == spread["_salt"]))
    # Signs of the keyword must be there, and must not touch the word before or after them.
    lead = (F.col("_lead") == "") | (F.endswith("_r.before", "_lead") & (F.col("_r.first") | (F.length("_r.before") > F.length("_lead"))))
    trail = (F.col("_trail") == "") | (F.startswith("_r.after", "_trail") & (F.col("_r.last") | (F.length("_r.after") > F.length("_trail"))))
    return hits.where(lead & trail).select(*ids, "category", "canonical").distinct()


def with_keywords(df: DataFrame, id_col: str, text: Column, keywords: DataFrame, categories: list[str], **options) -> DataFrame:
    """``df`` with one sorted array column per category; rows are joined back by ``id_col`` (one row per id; rows without an id get empty arrays)."""
    hits = match_keywords(df.where(F.col(id_col).isNotNull()), [id_col], text, keywords, **options)
    per_id = hits.groupBy(F.col(id_col).alias("_id")).agg(*[
        F.array_sort(F.collect_set(F.when(F.col("category") == c, F.col("canonical")))).alias(f"_{c}") for c in categories])
    joined = df.drop(*categories).join(per_id, F.col(id_col) == F.col("_id"), "left")
    empty = F.array().cast("array<string>")
    return joined.withColumns({c: F.coalesce(F.col(f"_{c}"), empty) for c in categories}).drop("_id", *[f"_{c}" for c in categories])
