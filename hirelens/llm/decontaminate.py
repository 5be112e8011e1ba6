"""Benchmark decontamination by templates (DataFrame functions only).

Numbers, names and units of a text become typed placeholders; windows of
``window`` template words of the documents are joined by hash with those of the
benchmark items, so a question asked again with other values still matches.
The values then have to be consistent: within a document and an item, a value
of the item must always stand for the same value of the document, and the other
way round; windows that break the mapping most windows agree on don't count.
Names show by their case, so windows also meet folded: all words in lower case
and only numbers and units as placeholders.  A copy in another case is found so.

A document is contaminated by an item if at least ``similarity`` of the item's
windows are found, or a run of ``run_words`` words in a row, by templates or by folded windows.

Most documents share no window with the benchmark.  So a first pass hashes their
windows only, and values are taken only from documents that have a hit.

Cases: null and empty texts match nothing, nor do items without id or text.  As
templates, windows with fewer than three words beside placeholders are no
evidence.  An item that has such windows, or fewer than ``window`` words, is also
looked for word for word: by windows of its plain words in lower case, or by all
of them if it is shorter (items of one word match nothing).  Items of few windows
are judged on those.  Rows that repeat a doc_id are told apart by their
texts, and rows without doc_id as well.  Empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import cut

#: Marks a name or number; a private-use character, so no text's word has it by chance.
MARK = ""
#: A capitalised word that doesn't begin a sentence, or a digit that begins a word.  The rare class comes first, then the look behind it.
SLOT = r"\p{Lu}(?<=[\p{Ll}\p{N},;:]\s\p{Lu})\p{Ll}*|[0-9](?<![\p{L}\p{N}.,][0-9])"
#: Between words; a dot or comma between digits belongs to the number.
BETWEEN = r"(?:[^\p{L}\p{M}\p{N}" + MARK + r".,]|(?<![0-9])[.,]|[.,](?![0-9]))+"
UNITS = """mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds lb lbs ton tons
ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years
cent cents dollar dollars euro euros usd eur gbp percent degree degrees meter meters metre metres kmh mph watt watts volt volts""".split()
VALUE = "\x01"
#: Windows of the benchmark up to which its side of the join is broadcast (some 60 MB); beyond, both sides are shuffled.
BROADCAST_WINDOWS = 1_000_000


def placeholder(word: Column) -> Column:
    """The word's type if it is a slot, else null."""
    number = F.when(F.substring(word, 2, 1).between("0", "9"), "0").otherwise(MARK)
    return F.when(word.startswith(MARK), number).when(word.isin(UNITS), "u")


def folded(word: Column) -> Column:
    """The word without the mark of a name."""
    return F.when(word.startswith(MARK) & ~F.substring(word, 2, 1).between("0", "9"), F.substring(word, 2, 1_000_000_000)).otherwise(word)


def template_windows(table: DataFrame, keys: list[str], window: int) -> DataFrame:
    """``keys``, pos, kind, wh (hash of the template window) and slots (its values) of every window of ``text``.

    kind: 1 with names as slots, 2 folded, 3 where both are the same.
    """
    split = words_of(table, keys)
    hashed = lambda x: F.xxhash64(F.coalesce(placeholder(x), x))
    value = lambda x: F.when(placeholder(x).isNotNull(), x)
    parts = split.where(F.size("__w") >= window).select(
        *keys,
        F.transform("__w", hashed).alias("__h"),
        F.when(F.col("__has"), F.transform("__w", value)).alias("__s"),
        F.when(F.col("__has"), F.transform("__w", lambda x: hashed(folded(x)))).alias("__fh"),
        F.when(F.col("__has"), F.transform("__w", lambda x: value(folded(x)))).alias("__fs"),
    )

    def one(i: Column, h: str, s: str, kind: int) -> Column:
        hashes = [F.get(h, i + k) for k in range(window)]
        values = [F.get(s, i + k) for k in range(window)]
        slots = F.when(F.col(s).isNull(), "").otherwise(F.concat_ws(VALUE, *values))
        return F.struct(F.lit(kind).alias("kind"), F.xxhash64(*hashes).alias("wh"), slots.alias("slots"))

    def both(i: Column) -> Column:
        same = F.col("__fh").isNull() | (F.slice("__h", i + 1, window) == F.slice("__fh", i + 1, window))
        return F.when(same, F.array(one(i, "__h", "__s", 3))).otherwise(F.array(one(i, "__h", "__s", 1), one(i, "__fh", "__fs", 2)))

    every = F.transform(F.sequence(F.lit(0), F.size("__h") - window), both)
    rows = parts.select(*keys, F.posexplode(every).alias("pos", "__xs")).select(*keys, "pos", F.explode("__xs").alias("__x"))
    return rows.select(*keys, "pos", "__x.kind", "__x.wh", "__x.slots")


def words_of(table: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, __has (is there a name or number?) and __w, the words in lower case with marks."""
    marked = table.select(*keys, F.regexp_replace(F.coalesce("text", F.lit("")), SLOT, MARK + "$0").alias("__m"))
    return marked.select(*keys, F.contains("__m", F.lit(MARK)).alias("__has"), F.filter(F.split(F.lower("__m"), BETWEEN), lambda x: x != "").alias("__w"))


def plain_hash(word: Column) -> Column:
    """Hash of a word without its mark, unlike any template's."""
    return F.xxhash64(F.lit("plain"), F.when(word.startswith(MARK), F.substring(word, 2, 1_000_000_000)).otherwise(word))


def hash_windows(hashes: Column, length: int) -> Column:
    """The hash of every ``length`` words in a row."""
    every = F.transform(F.sequence(F.lit(0), F.size(hashes) - length), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(length)]))
    return F.when(F.size(hashes) >= length, every).otherwise(F.array().cast("array<bigint>"))


def plain_windows(table: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """As :func:`template_windows`, kind 4: windows of plain words of the given lengths; without values."""
    hashed = words_of(table, keys).select(*keys, F.transform("__w", plain_hash).alias("__p"))
    some = [F.transform(hash_windows(F.col("__p"), n), lambda x, i: F.struct(i.alias("pos"), x.alias("wh"))) for n in lengths]
    rows = hashed.select(*keys, F.explode(F.concat(*some)).alias("__x"))
    return rows.select(*keys, "__x.pos", F.lit(4).alias("kind"), "__x.wh", F.lit("").alias("slots"))


def window_hashes(table: DataFrame, keys: list[str], window: int, plain: list[int]) -> DataFrame:
    """``keys`` and wh of all windows of all kinds; the same hashes as the functions above, and nothing else."""
    hashed = lambda x: F.xxhash64(F.coalesce(placeholder(x), x))
    parts = words_of(table, keys).select(
        *keys, F.transform("__w", hashed).alias("__h"), F.when(F.col("__has"), F.transform("__w", lambda x: hashed(folded(x)))).alias("__fh"),
        *([F.transform("__w", plain_hash).alias("__p")] if plain else []))
    every = [hash_windows(F.col("__h"), window), F.when(F.col("__fh").isNull(), F.array().cast("array<bigint>")).otherwise(hash_windows(F.col("__fh"), window))]
    every += [hash_windows(F.col("__p"), n) for n in plain]
    return parts.select(*keys, F.explode(F.concat(*every)).alias("wh"))


def slot_values(slots: Column) -> Column:
    return F.when(slots == "", F.array().cast("array<string>")).otherwise(F.split(slots, VALUE))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 5, similarity: float = 0.8, run_words: int = 25) -> DataFrame:
    """``(doc_id, text_hash, item_id, found, longest, contaminated)`` for documents that share windows with an item.

    ``found`` is the share of the item's windows found in order of values,
    ``longest`` the words of the longest run.
    """
    items = benchmark.select("item_id", "text").where("item_id is not null and text is not null")
    # Inside another text an item's first word doesn't begin a sentence, so its first window also counts with that word as a name.
    inside = items.where(F.col("text").rlike(r"^\p{Lu}")).select("item_id", F.concat(F.lit(MARK), "text").alias("text"))
    bench = template_windows(items, ["item_id"], window).union(template_windows(inside, ["item_id"], window).where("pos = 0"))
    evidence = F.size(slot_values(F.col("slots"))) <= window - 3
    # Items that templates don't hold whole are looked for word for word as well.
    length = words_of(items, ["item_id", "text"]).select("item_id", "text", F.size("__w").alias("n"))
    weak = bench.where(~evidence).select("item_id").union(length.where(F.col("n") < window).select("item_id")).distinct()
    exact = length.join(weak, "item_id", "left_semi").where("n > 1").withColumn("length", F.least("n", F.lit(window)))
    plain = sorted(r["length"] for r in exact.select("length").distinct().collect())  # at most ``window`` numbers
    bench = bench.where(evidence).distinct()
    # Templates are aligned with templates, folded windows with folded ones.
    kinds = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array("kind"))
    bench = bench.select("item_id", F.col("pos").alias("q"), F.explode(kinds).alias("path"), "wh", F.col("slots").alias("item_slots")).distinct()
    if plain:
        own = [plain_windows(exact.where(F.col("length") == n), ["item_id"], [n]) for n in plain]
        bench = reduce(DataFrame.union, [bench, *[x.select("item_id", F.col("pos").alias("q"), F.lit(4).alias("path"), "wh", F.col("slots").alias("item_slots")).distinct() for x in own]])
    lengths = exact.select(F.col("item_id").alias("of"), F.lit(4).alias("of_path"), "length")
    size = bench.groupBy("item_id", "path").agg(F.countDistinct("q").alias("item_windows"))
    size = size.join(lengths, (F.col("item_id") == F.col("of")) & (F.col("path") == F.col("of_path")), "left").select(
        "item_id", "path", "item_windows", F.coalesce("length", F.lit(window)).alias("length"))
    small = bench.count() <= BROADCAST_WINDOWS
    side = F.broadcast(bench) if small else bench
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    keys = ["doc_id", "text_hash"]
    known = F.broadcast(bench.select("wh").distinct()) if small else bench.select("wh").distinct()
    touched = window_hashes(texts, keys, window, plain).join(known, "wh", "left_semi").select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    # Both are written: the few documents' size is then known, and nothing of the second pass is done for all texts.
    touched = cut(touched, "decontaminate-touched")
    texts = cut(texts.join(touched, F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("text_hash") == F.col("__text_hash")), "left_semi"), "decontaminate-texts")
    every = template_windows(texts, keys, window)
    if plain:
        every = every.unionByName(plain_windows(texts, keys, plain))
    hits = every.join(side, "wh").where(F.col("kind").bitwiseAND(F.col("path")) != 0).drop("kind").withColumn("diag", F.col("pos") - F.col("q"))

    # Each window of the item takes its place in the alignment that most windows share.
    pair = ["doc_id", "text_hash", "item_id", "path"]
    hits = hits.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*pair, "diag")))
    best = F.row_number().over(Window.partitionBy(*pair, "q").orderBy(F.desc("n"), "pos"))
    hits = hits.withColumn("best", best).where("best = 1")

    # Values that stand for each other: most frequent partner, both ways.
    each = hits.withColumn("z", F.explode_outer(F.arrays_zip(slot_values(F.col("item_slots")).alias("b"), slot_values(F.col("slots")).alias("d"))))
    each = each.select(*pair, "q", "diag", "wh", F.col("z.b").alias("b"), F.col("z.d").alias("d"))
    each = each.withColumn("together", F.count(F.lit(1)).over(Window.partitionBy(*pair, "b", "d")))
    partner = F.max(F.struct("together", "d")).over(Window.partitionBy(*pair, "b"))["d"]
    back = F.max(F.struct("together", "b")).over(Window.partitionBy(*pair, "d"))["b"]
    fits = F.col("b").isNull() | ((F.col("d") == partner) & (F.col("b") == back))
    windows = each.withColumn("fits", fits).groupBy(*pair, "q", "diag", "wh").agg(F.min("fits").alias("fits")).where("fits")

    island = F.col("q") - F.row_number().over(Window.partitionBy(*pair, "diag").orderBy("q"))
    windows = windows.withColumn("island", island)
    windows = windows.withColumn("run", F.count(F.lit(1)).over(Window.partitionBy(*pair, "diag", "island")))
    found = windows.groupBy(*pair).agg(F.countDistinct("q").alias("n"), F.max("run").alias("run"))
    found = found.join(size, ["item_id", "path"]).withColumn("found", F.col("n") / F.col("item_windows"))
    found = found.withColumn("longest", F.col("run") + F.col("length") - 1)
    found = found.withColumn("contaminated", (F.col("found") >= similarity) | (F.col("longest") >= run_words))
    return found.groupBy("doc_id", "text_hash", "item_id").agg(*[F.max(c).alias(c) for c in ("found", "longest", "contaminated")])


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how: object) -> DataFrame:
    """``docs`` without the contaminated ones."""
    bad = matches(docs, benchmark, **how).where("contaminated").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__text"))
    return docs.join(bad, same, "left_anti")
