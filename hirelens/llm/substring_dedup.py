"""Substring dedup by paragraph MinHash.

Paragraphs are the lines of a text; a long line is also cut into segments at
places that only the words around them decide.  Equal paragraphs (and segments)
meet by fingerprint.  A passage of PASSAGE words or more that stands anywhere in
two lines, whole lines or not, is found from end to end: every window of PASSAGE
words holds a seed that its words alone decide, and all windows around seeds that
occur more than once meet by the fingerprint of all their words.  Shorter passages
inside longer lines are found only where they hold a segment.  Different paragraphs are banded by MinHash, with
as many bands as the wished recall asks for; the exact Jaccard similarity of their
five-word shingles decides.  In each group of colliding paragraphs every one is
compared with two centres first; then, in the groups that are still of several
components, the paragraphs of different components are compared with each other
in cells of bounded size, so every pair of a group is linked or in one component.
Components of the links are the clusters: the first occurrence (smallest doc_id,
then position) stays, the others go.

Cases: null and empty texts have no paragraphs; paragraphs under MIN_WORDS words
are left alone (line dedup is for those).  Rows that repeat a doc_id are one
document, their passages count once.  Rows without doc_id are left alone.  Empty
tables give empty results; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import cut, parallelism
from hirelens.llm.components import components
from hirelens.llm.near_dedup import ODD, Shingler, batches, class_id, mix

MIN_WORDS = 8
#: Lines of more words are also cut into segments, at one place in CUT on average.
LONG, CUT = 40, 12
#: Words of a passage that is found wherever it stands; words of a seed.
PASSAGE, SEED = 50, 20
ROWS = 4
SHINGLE = 5
#: A place is a line number and, below these bits, the word at which a segment begins, plus one.
LINE_BITS = 32
#: Shingles of a block on average, and of a task's cells.
BLOCK, TASK = 100_000, 2_000_000


def bands_for(similarity: float, recall: float, rows: int = ROWS) -> int:
    """The fewest bands with which pairs at the similarity collide with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def segments(hashes: np.ndarray) -> list[tuple[int, int]]:
    """Word ranges between the cuts of a long line; a cut follows a word pair of the right hash."""
    pair = mix(hashes[:-1] * ODD[0] + hashes[1:])
    out, last = [], 0
    for at in (np.flatnonzero(pair % np.uint64(CUT) == 0) + 2).tolist() + [len(hashes)]:
        if at - last >= MIN_WORDS:
            out.append((last, at))
            last = at
    return out


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in a row; as many as fit."""
    out, taken, power, step = np.empty(0, dtype=np.uint64), 0, hashes, 1
    while True:
        if size & step:
            n = max(0, len(hashes) - taken - step + 1)
            out = mix(out[:n] * ODD[1] + power[taken : taken + n]) if taken else power
            taken += step
        if step * 2 > size:
            return out
        power = mix(power[:-step] * ODD[0] + power[step:]) if len(power) > step else power[:0]
        step *= 2


def slide(values: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``size`` values in a row."""
    step = 1
    while step * 2 <= size:
        values = pick(values[:-step], values[step:])
        step *= 2
    return pick(values[: len(values) - (size - step)], values[size - step :]) if size > step else values


def seeds(hashes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the seeds of lines begin, and their hashes: the smallest of each window of PASSAGE words.

    ``hashes``: the words of all lines in a row; ``left``: the words from each one to the end of its line.
    """
    if len(hashes) < PASSAGE:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    within, all_grams = PASSAGE - SEED + 1, grams(hashes, SEED)
    least = np.where(left[: len(all_grams) - within + 1] >= PASSAGE, slide(all_grams, within, np.minimum), np.uint64(0))
    edge = np.zeros(within - 1, dtype=np.uint64)
    at = np.flatnonzero((slide(np.concatenate([edge, least, edge]), within, np.maximum) == all_grams) & (all_grams != 0))
    return at, all_grams[at]


def minima(sets: list[np.ndarray], odd: np.ndarray) -> np.ndarray:
    """MinHash of sets that aren't empty, one row per set: the smallest product with each of the odd factors."""
    hashes, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    return np.stack([np.minimum.reduceat(hashes * factor, starts) for factor in odd], axis=1)


def lines_of(text: str) -> list[tuple[int, list[bytes]]]:
    """``(number, words)`` of the lines of MIN_WORDS words or more."""
    split = ((i, line.split()) for i, line in enumerate(text.encode("utf-8", "surrogatepass").lower().split(b"\n")))
    return [(i, words) for i, words in split if len(words) >= MIN_WORDS]


def known(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")


def paragraphs(docs: DataFrame, bands: int) -> DataFrame:
    """``(doc_id, place, n_words, fp, whole, keys)`` of every paragraph, segment and seed; only paragraphs have keys, seeds have no n_words."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(SHINGLE)
        first = (np.arange(bands, dtype=np.uint64) + np.uint64(1)) * ODD[3]
        odd = mix(np.arange(1, bands * ROWS + 1, dtype=np.uint64) * ODD[4]) | np.uint64(1)
        for part in parts:
            for texts in batches(part["text"]):
                found = [(d, i, words) for d, text in zip(part.loc[texts.index, "doc_id"], texts, strict=True) for i, words in lines_of(text)]
                if not found:
                    continue
                sets, hashes = shingles.of_words([words for *_, words in found])
                least = minima(sets, odd).reshape(len(sets), bands, ROWS)
                keys = np.broadcast_to(first, (len(sets), bands))
                for i in range(ROWS):
                    keys = mix(keys + least[:, :, i] * ODD[i % 3])
                keys = keys.view(np.int64)
                counts = np.array([len(words) for *_, words in found])
                ends = np.cumsum(counts)
                start, gram = seeds(hashes, np.repeat(ends, counts) - np.arange(len(hashes)))
                own = np.searchsorted(ends, start, side="right")
                lines, ids = np.array([i for _, i, _ in found]), np.array([d for d, *_ in found])
                yield pd.DataFrame({"doc_id": ids[own], "place": (lines[own] << LINE_BITS) + start - (ends - counts)[own] + 1, "n_words": 0,
                                    "fp": gram.view(np.int64), "whole": False, "keys": None})
                rows, at = [], 0
                for (doc_id, line, words), s, key in zip(found, sets, keys, strict=True):
                    n = len(words)
                    rows.append((doc_id, line << LINE_BITS, n, class_id(s), True, key))
                    if n > LONG:
                        h = hashes[at : at + n]
                        rows += [(doc_id, (line << LINE_BITS) + lo + 1, hi - lo, class_id(h[lo:hi]), False, None) for lo, hi in segments(h) if hi - lo < n]
                    at += n
                yield pd.DataFrame(rows, columns=["doc_id", "place", "n_words", "fp", "whole", "keys"])

    return known(docs).mapInPandas(run, "doc_id long, place long, n_words long, fp long, whole boolean, keys array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(fp, s)``: the shingles of the paragraphs ``wanted`` (fp, first); only their lines are read again.

    The list of a document's wanted lines is bounded by its own lines.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(SHINGLE)
        for part in parts:
            for texts in batches(part["text"]):
                lines = []
                for text, some in zip(texts, part.loc[texts.index, "some"], strict=True):
                    asked = set(some)
                    lines += [words for i, words in lines_of(text) if i in asked]
                if lines:
                    sets = shingles.of_words(lines)[0]
                    yield pd.DataFrame({"fp": [class_id(s) for s in sets], "s": [s.view(np.int64) for s in sets]})

    line = F.shiftright("first.place", LINE_BITS)
    asked = wanted.groupBy(F.col("first.doc_id").alias("d")).agg(F.collect_list(line).alias("some"))
    texts = known(docs).join(asked, F.col("doc_id") == F.col("d")).select("text", "some")
    # Rows that repeat a doc_id bring the same lines again, or others in their place.
    sets = texts.mapInPandas(run, "fp long, s array<long>")
    return sets.join(wanted.select("fp"), "fp", "left_semi").groupBy("fp").agg(F.first("s").alias("s"))


def repeated_windows(docs: DataFrame, seeded: DataFrame) -> DataFrame:
    """``(doc_id, place, n_words, keeper, removed)`` of every PASSAGE words in a row that occur more than once.

    ``seeded`` has the seeds (doc_id, place, fp).  What a window shares with its own
    first occurrence, in a line that repeats itself, doesn't count.  The list of a
    document's seeds is bounded by its own words.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(SHINGLE)
        for part in parts:
            for texts in batches(part["text"]):
                found, ids, lines, bases, marks, base = [], [], [], [], [], 0
                for doc_id, text, some in zip(part.loc[texts.index, "doc_id"], texts, part.loc[texts.index, "some"], strict=True):
                    some = np.sort(some)
                    numbers, first = np.unique(some >> LINE_BITS, return_index=True)
                    split = text.encode("utf-8", "surrogatepass").lower().split(b"\n")
                    for i, at in zip(numbers.tolist(), np.split((some & ((1 << LINE_BITS) - 1)) - 1, first[1:]), strict=True):
                        words = split[i].split() if i < len(split) else []
                        at = at[at <= len(words) - SEED]
                        if len(words) < PASSAGE or not len(at):  # a doc_id may repeat with another text
                            continue
                        found += words
                        ids.append(doc_id)
                        lines.append(i)
                        bases.append(base)
                        # A window that holds the seed begins at most PASSAGE - SEED words before it.
                        marks.append((np.maximum(at - (PASSAGE - SEED), 0) + base, at + 1 + base))
                        base += len(words)
                if not found:
                    continue
                change = np.zeros(base + 1, dtype=np.int64)
                for begin, end in marks:
                    np.add.at(change, begin, 1)
                    np.add.at(change, end, -1)
                bases = np.array(bases)
                own = np.repeat(np.arange(len(bases)), np.diff(np.append(bases, base)))
                left = np.append(bases[1:], base)[own] - np.arange(base)
                start = np.flatnonzero((np.cumsum(change)[:-1] > 0) & (left >= PASSAGE))
                own = own[start]
                yield pd.DataFrame({"w": grams(shingles.word_hashes(found), PASSAGE)[start].view(np.int64), "doc_id": np.array(ids)[own],
                                    "place": (np.array(lines)[own] << LINE_BITS) + start - bases[own] + 1})

    spot = F.struct("doc_id", "place")
    twice = lambda t, key: t.groupBy(key).agg(F.min(spot).alias("first"), F.max(spot).alias("last")).where("first <> last").select(F.col(key).alias("k"), "first")
    # Dealt by key first, the rows are sent once, for the grouping and the join.
    seeded = seeded.repartition("fp")
    again = seeded.join(twice(seeded, "fp").select("k"), F.col("fp") == F.col("k"), "left_semi")
    asked = again.groupBy(F.col("doc_id").alias("d")).agg(F.collect_set("place").alias("some"))
    texts = known(docs).join(asked, F.col("doc_id") == F.col("d")).select("doc_id", "text", "some")
    found = cut(texts.mapInPandas(run, "w long, doc_id long, place long"), "passage-windows").repartition("w")
    hits = found.join(twice(found, "w"), F.col("w") == F.col("k"))
    same = (F.col("doc_id") == F.col("first.doc_id")) & (F.shiftright("place", LINE_BITS) == F.shiftright("first.place", LINE_BITS)) & (F.col("place") > F.col("first.place"))
    begin = F.when(same, F.greatest(F.col("place"), F.col("first.place") + PASSAGE)).otherwise(F.col("place"))
    return hits.select("doc_id", begin.alias("place"), (F.col("place") + PASSAGE - begin).alias("n_words"), F.col("first.doc_id").alias("keeper"), (spot != F.col("first")).alias("removed"))


def similar_across(sets: list[np.ndarray], comps: np.ndarray, sides: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Pairs of rows similar enough that join all components which such pairs join; where ``sides`` are of two kinds, pairs of both."""
    sizes = np.array([len(s) for s in sets])
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    two, comp, out = sides.min() != sides.max(), comps.copy(), []
    mark = np.zeros(number.max() + 1, dtype=bool)
    for i in range(len(sets) - 1):
        j = np.arange(i + 1, len(sets))
        ok = (comp[j] != comp[i]) & (np.minimum(sizes[j], sizes[i]) >= similarity * np.maximum(sizes[j], sizes[i]))
        j = j[ok & (sides[j] != sides[i])] if two else j[ok]
        if not len(j):
            continue
        mine = number[starts[i] : starts[i] + sizes[i]]
        mark[mine] = True
        both = np.add.reduceat(mark[number[starts[i] :]], starts[i:] - starts[i])[j - i]
        mark[mine] = False
        for x in j[both >= similarity * (sizes[j] + sizes[i] - both)].tolist():
            if comp[x] != comp[i]:
                out.append((i, x))
                comp[comp == comp[x]] = comp[i]
    return out


def across(members: DataFrame, sets: DataFrame, labels: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: links between different components within the groups ``members`` (key, fp).

    Groups are cut into blocks of about BLOCK shingles; each pair of blocks is a
    cell, and cells are dealt to tasks in batches.  A cell gives fewer links than it has members.
    """
    known = members.join(labels, members["fp"] == labels["node"], "left").select("key", "fp", F.coalesce("label", "fp").alias("comp"))
    known = cut(known, "passage-members")
    mixed = known.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("size")).where("x <> y and size > 2")
    rows = known.join(mixed.select("key"), "key").join(sets.select("fp", F.size("s").alias("n")), "fp")
    weights = rows.groupBy("key").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(weights, "key").withColumn("own", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cut(rows.select("key", "fp", "comp", "n", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")), "passage-cells")
    tasks = max(parallelism(members.sparkSession), (cells.agg(F.sum("n")).first()[0] or 0) // TASK + 1)
    cells = cells.withColumn("task", F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(tasks))).drop("n").join(sets, "fp")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, cell in part.groupby(["key", "lo", "hi"], sort=False):
            fps = cell["fp"].to_numpy()
            found += [(fps[i], fps[j]) for i, j in similar_across(list(cell["s"]), cell["comp"].to_numpy(), cell["own"].to_numpy(), similarity)]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return cells.groupBy("task").applyInPandas(run, "a long, b long")


def repeated_passages(docs: DataFrame, similarity: float = 0.8, recall: float = 0.99) -> DataFrame:
    """``(doc_id, place, n_words, whole, keeper, removed)`` of every paragraph, segment or window that occurs more than once.

    ``keeper`` is the doc_id of the first occurrence, which is not removed.
    """
    found = cut(paragraphs(docs, bands_for(similarity, recall)), "passages")
    windows = repeated_windows(docs, found.where("n_words = 0").select("doc_id", "place", "fp"))
    found = found.where("n_words > 0")
    classes = found.groupBy("fp").agg(F.min(F.struct("doc_id", "place")).alias("first"), F.count(F.lit(1)).alias("n"),
                                      F.first("keys", ignorenulls=True).alias("keys"))
    # A segment is linked by its fingerprint alone, so one that occurs once is done.
    classes = cut(classes.where("keys is not null or n > 1"), "passage-classes")
    banded = classes.where("keys is not null").select("fp", F.explode("keys").alias("key"))
    groups = banded.groupBy("key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi")
    members = cut(banded.join(groups, "key"), "passage-groups")
    pairs = members.select(F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("fp").alias("b")), F.struct(F.col("fp").alias("a"), F.col("hi").alias("b")))).alias("p"))
    pairs = cut(pairs.select("p.a", "p.b").where("a <> b").distinct(), "passage-pairs")
    asked = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct()
    sets = cut(shingle_sets(docs, cut(classes.select("fp", "first").join(asked, "fp"), "passage-asked")), "passage-sets")
    both = F.size(F.array_intersect("sa", "sb"))
    near = pairs.join(sets.select(F.col("fp").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("fp").alias("b"), F.col("s").alias("sb")), "b")
    near = near.where(both >= F.lit(similarity) * (F.size("sa") + F.size("sb") - both)).select("a", "b")
    near = cut(near, "passage-near")
    more = cut(across(members.select("key", "fp"), sets, components(near), similarity), "passage-across")
    labels = components(near.union(more))
    of = classes.join(labels, classes["fp"] == labels["node"], "left").select("fp", "first", "n", F.coalesce("label", "fp").alias("cluster"))
    clusters = of.groupBy("cluster").agg(F.min("first").alias("keep"), F.sum("n").alias("n")).where("n > 1")
    of = of.select("fp", "cluster").join(clusters, "cluster").select(F.col("fp").alias("f"), "keep")
    out = found.select("doc_id", "place", "n_words", "whole", "fp").join(of, F.col("fp") == F.col("f"))
    out = out.select("doc_id", "place", "n_words", "whole", F.col("keep.doc_id").alias("keeper"),
                     (F.struct("doc_id", "place") != F.col("keep")).alias("removed"))
    return out.unionByName(windows.withColumn("whole", F.lit(False)))


def runs(spans: Column) -> Column:
    """Of the parts (at, n_words, removed) of a line: the runs they make up, the runs of removed ones, and their words."""
    long = lambda n: F.lit(n).cast("long")
    start = F.struct(long(-1).alias("end"), long(0).alias("parts"), long(-1).alias("gone"), long(0).alias("part_removed"), long(0).alias("part_words"))

    def add(a: Column, x: Column) -> Column:
        end = x["at"] + x["n_words"]
        return F.struct(
            F.greatest(a["end"], end).alias("end"), (a["parts"] + F.when(x["at"] > a["end"], 1).otherwise(0)).alias("parts"),
            F.when(x["removed"], F.greatest(a["gone"], end)).otherwise(a["gone"]).alias("gone"),
            (a["part_removed"] + F.when(x["removed"] & (x["at"] > a["gone"]), 1).otherwise(0)).alias("part_removed"),
            (a["part_words"] + F.when(x["removed"], F.greatest(long(0), end - F.greatest(a["gone"], x["at"]))).otherwise(0)).alias("part_words"))

    return F.aggregate(F.array_sort(spans), start, add)


def substring_dedup(docs: DataFrame, similarity: float = 0.8, recall: float = 0.99) -> DataFrame:
    """One row per document: passages it shares, those removed from it and their words, and the documents that keep them."""
    hits = repeated_passages(docs, similarity, recall)
    line = F.shiftright("place", LINE_BITS)
    # A segment counts where its whole paragraph doesn't.
    lines = hits.withColumn("line", line).groupBy("doc_id", "line").agg(
        F.max("whole").alias("whole"), F.max(F.when(F.col("whole"), F.col("removed"))).alias("line_removed"),
        F.max(F.when(F.col("whole"), F.col("n_words"))).alias("line_words"), F.collect_set("keeper").alias("keepers"),
        F.collect_list(F.when(~F.col("whole"), F.struct(F.col("place").bitwiseAND((1 << LINE_BITS) - 1).alias("at"), "n_words", "removed"))).alias("spans"))
    lines = lines.withColumn("runs", runs(F.col("spans"))).select("*", "runs.parts", "runs.part_removed", "runs.part_words")
    gone = F.coalesce("line_removed", F.lit(False))
    per = lines.groupBy("doc_id").agg(
        F.sum(F.when(F.col("whole"), 1).otherwise(F.col("parts"))).alias("n_shared"),
        F.sum(F.when(gone, 1).otherwise(F.col("part_removed"))).alias("n_removed"),
        F.sum(F.when(gone, F.col("line_words")).otherwise(F.col("part_words"))).alias("removed_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("keepers")))).alias("keepers"))
    zero = F.lit(0).cast("long")
    ids = docs.select(F.col("doc_id").alias("doc_id")).distinct()
    out = ids.join(per.withColumnRenamed("doc_id", "d"), F.col("doc_id") == F.col("d"), "left")
    return out.select("doc_id", *[F.coalesce(c, zero).alias(c) for c in ("n_shared", "n_removed", "removed_words")],
                      F.coalesce("keepers", F.array().cast("array<long>")).alias("keepers"))
