"""Near-duplicate documents by HyperMinHash registers.

A document's shingle hashes fall into REGISTERS buckets; each keeps its smallest
hash as leading-zero count plus mantissa bits (16 bits in all).  Bands of
the smallest hashes, whole ones, make candidate groups.  The work is then:

1. equal shingle sets collapse to one class each, so copies cost nothing;
2. in each candidate group every class is compared with two centres (those
   first and last in the order of the class ids), not with all others: the
   collision-corrected register estimate first, then the full shingle sets;
   pairs are decided in blocks, to which each class's registers or shingles go
   once, and a block gives out only true links that join what it hasn't joined;
3. components of the links; a group whose classes all are in one component is done;
4. in the other groups, classes of different components are compared in blocks
   of bounded size by their registers; each one's likeliest partner is verified
   first, which joins most components, then whatever else the estimate lets
   pass; the components of all links are the result.

Steps 2 and 4 together see every pair of different components that shares a
band, so skipping pairs inside a component loses no document.  There are as many
bands as the threshold asks for, 32 at most: a pair at the threshold shares no
band with probability 3e-7 (at 0.8 with 6e-5), and fails the estimate (3.5
standard errors and one register below the threshold) with 1e-4 or less.  Class ids have 64 bits:
among 10**9 different texts, a collision is expected with probability 0.03.

Cases: a text without words, or null, has no shingles and links with nothing.
Rows without doc_id link with nothing (component_id null, kept).  Rows that
repeat a doc_id are one document, with the links of all its texts.  An empty
table gives an empty result; input columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import cut, parallelism
from hirelens.llm.components import components

ROWS = 6
#: Chance that a pair at the threshold shares no band, and the most bands: with more, those of short texts hold so
#: few registers that unrelated texts collide, and their groups outgrow the input.
MISS, MOST_BANDS = 3e-7, 32
MANTISSA = 10
#: Chance that two different minima share a register: the mantissa agrees, and the leading zeros, which have geometric odds.
COLLISION = 2.0**-MANTISSA / 3
ERRORS = 3.5
BLOCK = 1024
#: Shingles of the pairs or cells of a task.
TASK = 4_000_000
CACHE_WORDS = 500_000
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def bands_for(similarity: float) -> int:
    return min(MOST_BANDS, math.ceil(math.log(MISS) / math.log(1 - similarity**ROWS))) if similarity < 1 else 1


#: Registers for the contract's threshold.
REGISTERS = bands_for(0.85) * ROWS


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit sums so that all bits of the result are usable."""
    h = (h ^ (h >> np.uint64(32))) * ODD[3]
    h = (h ^ (h >> np.uint64(29))) * ODD[4]
    return h ^ (h >> np.uint64(32))


class Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Shingler:
    """Shingle sets of batches of texts, as sorted arrays of distinct 64-bit hashes; keeps word hashes, within a bound.

    ``bytes.lower`` and ``bytes.split`` know A-Z and ``[\x20\x09-\x0D]`` and nothing else, as the words ask for.
    """

    def __init__(self, size: int = 3):
        self.size = size
        self.forget()

    def forget(self) -> None:
        self.numbers, self.hashes = Numbers(), np.empty(0, dtype=np.uint64)

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.numbers) > CACHE_WORDS:
            self.forget()
        at = np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words))
        if len(self.numbers) > len(self.hashes):
            new = list(islice(self.numbers, len(self.hashes), None))
            self.hashes = np.concatenate([self.hashes, np.array([xxhash.xxh64_intdigest(w) for w in new], dtype=np.uint64)])
        return self.hashes[at]

    def __call__(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        return self.of_words([t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts])[0]

    def of_words(self, words: list[list[bytes]]) -> tuple[list[np.ndarray], np.ndarray]:
        """The sets of texts that are given as words, and the hashes of all the words."""
        h = self.word_hashes([w for ws in words for w in ws])
        total = np.full(len(h), self.size, dtype=np.uint64)
        for i in range(self.size):
            total[: len(h) - i] = mix(total[: len(h) - i] + h[i:] * ODD[i % 3])
        out, at = [], 0
        for ws in words:
            n = len(ws)
            if n >= self.size:
                part = np.sort(total[at : at + n - self.size + 1])
                out.append(part[np.concatenate([[True], part[1:] != part[:-1]])])
            elif n:
                whole = np.full(1, n, dtype=np.uint64)
                for i in range(n):
                    whole = mix(whole + h[at + i : at + i + 1] * ODD[i % 3])
                out.append(whole)
            else:
                out.append(np.empty(0, dtype=np.uint64))
            at += n
        return out, h


def sketch(sets: list[np.ndarray], count: int = REGISTERS) -> tuple[np.ndarray, np.ndarray]:
    """HyperMinHash registers and the whole minima they are made from, one row per set; 0 is empty.

    A register is the leading zeros plus one, then the mantissa.  A hash, as a
    fraction of 2**64 times ``count``, names its register and its place in it,
    so in a sorted set the first hash of each register is its smallest.
    """
    regs, whole = np.zeros((len(sets), count), dtype=np.uint16), np.zeros((len(sets), count), dtype=np.uint64)
    sizes = np.array([len(s) for s in sets])
    if not sizes.sum():
        return regs, whole
    at = (np.concatenate(sets) >> np.uint64(11)) * np.uint64(count)
    owner, bucket = np.repeat(np.arange(len(sets)), sizes), (at >> np.uint64(53)).astype(np.int64)
    first = np.ones(len(at), dtype=bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])
    low = at[first] & np.uint64((1 << 53) - 1)
    whole[owner[first], bucket[first]] = low + np.uint64(1)
    part, exponent = np.frexp(low.astype(np.float64))
    mantissa = np.floor(np.maximum(part - 0.5, 0) * 2 * (1 << MANTISSA)).astype(np.int64)
    regs[owner[first], bucket[first]] = ((54 - exponent.astype(np.int64)) << MANTISSA) + mantissa
    return regs, whole


def registers(sets: list[np.ndarray], count: int = REGISTERS) -> np.ndarray:
    return sketch(sets, count)[0]


def band_keys(whole: np.ndarray) -> np.ndarray:
    """A 64-bit key for each row's bands of whole minima; 0 for a band without a register in use.

    Of short texts a band often holds one register.  By its 16 bits, unrelated
    texts would meet by chance, in groups that grow with the input; by the whole
    minimum only texts that share the shingle meet.
    """
    rows = whole.reshape(len(whole), -1, ROWS)
    total = np.zeros(rows.shape[:2], dtype=np.uint64)
    for i in range(ROWS):
        total = mix(total + rows[:, :, i] * ODD[i % 3] + np.uint64(i + 1))
    return np.where(rows.any(axis=2), total | np.uint64(1), np.uint64(0)).view(np.int64)


def class_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "big", signed=True)


def batches(texts: pd.Series, chars: int = 2_000_000) -> Iterator[pd.Series]:
    """Consecutive parts of about ``chars`` characters, each of whole texts."""
    lengths = np.array([len(t) if t else 0 for t in texts], dtype=np.int64)
    group = np.cumsum(lengths) // chars
    for _, part in texts.groupby(group, sort=False):
        yield part


def describe(docs: DataFrame, size: int, bands: int) -> DataFrame:
    """``(doc_id, n, cls, regs, keys)`` of every row."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(size)
        for part in parts:
            for texts in batches(part["text"]):
                sets = shingles(texts)
                regs, whole = sketch(sets, bands * ROWS)
                yield pd.DataFrame({
                    "doc_id": part.loc[texts.index, "doc_id"].astype("Int64"), "n": [len(s) for s in sets], "cls": [class_id(s) for s in sets],
                    "regs": [r.tobytes() if len(s) else None for r, s in zip(regs, sets, strict=True)], "keys": list(band_keys(whole))})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id long, n long, cls long, regs binary, keys array<long>")


def least_estimate(used: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """The estimate below which a pair can't have the similarity.

    Registers draw from the union without replacement, so where they hold nearly
    all of a small union, the estimate is nearly exact.  ``sizes``: the sum of both sets' sizes.
    """
    union = np.maximum(sizes / (1 + similarity), used)
    left = (union - used) / np.maximum(union, 1)
    return similarity - ERRORS * np.sqrt(similarity * (1 - similarity) * left / np.maximum(used, 1)) - 1 / np.maximum(used, 1)


def estimates(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of register rows, and how many registers each rests on."""
    used = ((a | b) != 0).sum(axis=-1)
    same = ((a == b) & (a != 0)).sum(axis=-1)
    return (same / np.maximum(used, 1) - COLLISION) / (1 - COLLISION), used


def in_blocks(pairs: DataFrame, needed: DataFrame, classes: DataFrame, run, schema: str) -> DataFrame:
    """``run(pairs, classes)`` for each block ``task`` of ``pairs``, with the rows of ``classes`` (cls, …) that ``needed`` (task, cls) names, each once."""
    side = needed.select(F.col("task").alias("block"), "cls").distinct().join(classes, "cls")
    return pairs.groupBy("task").cogroup(side.groupBy("block")).applyInPandas(run, schema)


def both_sides(pairs: DataFrame) -> DataFrame:
    return pairs.select("task", F.col("a").alias("cls")).union(pairs.select("task", "b"))


def plausible(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """``(a, b, w)`` of the pairs whose sizes and register estimates allow the similarity; w: both sizes.

    Blocks are dealt by ``a``, so that one class with very many partners ``b`` is
    spread with them.
    """
    tasks = max(parallelism(pairs.sparkSession), pairs.count() // 50_000 + 1)

    def run(p: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        at = pd.Index(c["cls"])
        regs = np.frombuffer(b"".join(c["regs"]), dtype=np.uint16).reshape(len(c), -1)
        x, y, n = at.get_indexer(p["a"]), at.get_indexer(p["b"]), c["n"].to_numpy()
        keep = np.zeros(len(p), dtype=bool)
        for lo in range(0, len(p), 4096):
            i, j = x[lo : lo + 4096], y[lo : lo + 4096]
            e, used = estimates(regs[i], regs[j])
            fit = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j])
            keep[lo : lo + 4096] = fit & (e >= least_estimate(used, n[i] + n[j], similarity))
        return pd.DataFrame({"a": p["a"].to_numpy()[keep], "b": p["b"].to_numpy()[keep], "w": (n[x] + n[y])[keep]})

    dealt = pairs.withColumn("task", F.pmod(F.xxhash64("a"), F.lit(tasks)))
    return in_blocks(dealt, both_sides(dealt), classes.select("cls", "n", "regs"), run, "a long, b long, w long")


def verified(pairs: DataFrame, needed: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """``(a, b)``: links of the pairs (task, a, bs: a's partners) whose full shingle sets are similar enough.

    ``needed`` (task, cls) names the classes of each block.  Pairs that earlier
    links of the same block join already are not tested, as they change no
    component, so a block gives fewer links than it has classes.
    """

    def shingle_sets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(size)
        for part in parts:
            for texts in batches(part["text"]):
                sets, c = shingles(texts), part.loc[texts.index, "c"].to_numpy()
                at = [i for i, s in enumerate(sets) if class_id(s) == c[i]]  # a doc_id may repeat with another text
                if at:
                    yield pd.DataFrame({"c": c[at], "s": [sets[i].view(np.int64) for i in at]})

    def run(p: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        sets = dict(zip(c["cls"], c["s"], strict=True))
        root: dict[int, int] = {}

        def find(i: int) -> int:
            while (up := root.get(i, i)) != i:
                root[i] = root.get(up, up)
                i = up
            return i

        links = []
        for i, partners in zip(p["a"].tolist(), p["bs"], strict=True):
            for j in partners.tolist():
                x, y = find(i), find(j)
                if x == y:
                    continue
                s, t = sets[i], sets[j]
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    root[x] = y
                    links.append((i, j))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    needed = cut(needed.distinct(), "near-needed")
    wanted = needed.select("cls").distinct()
    rep = classes.join(wanted, "cls").select(F.col("cls").alias("c"), "rep")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").where("text is not null").join(rep, "rep")
    # Rows that repeat a doc_id and text give a set again.
    sets = texts.select("c", "text").mapInPandas(shingle_sets, "c long, s array<long>").groupBy("c").agg(F.first("s").alias("s"))
    return in_blocks(pairs, needed, cut(sets.withColumnRenamed("c", "cls"), "near-sets"), run, "a long, b long")


def across(members: DataFrame, classes: DataFrame, labels: DataFrame, similarity: float, best: bool = False) -> DataFrame:
    """``(task, a, bs)``: plausible pairs of different components within a candidate group, centres aside.

    One row for each class of a cell that is in a pair, with its partners there
    (fewer than the cell has classes), perhaps none where it is only a partner.

    ``best``: for each class and cell only the likeliest partner, at most as many pairs as there are classes.

    Groups are cut into blocks of about BLOCK classes; each pair of blocks is a
    cell, and cells are dealt to tasks in batches.  A pair is given out only by
    the first band it shares.
    """
    known = members.join(labels, members["cls"] == labels["node"], "left").select(
        "band", "key", "cls", "size", F.coalesce("label", "cls").alias("comp"))
    known = cut(known, "near-members")
    mixed = known.groupBy("band", "key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("band", "key")
    sketches = classes.select("cls", "n", "regs", F.array().cast("array<long>").alias("keys") if best else "keys")
    rows = known.where("size > 2").join(mixed, ["band", "key"]).join(sketches, "cls")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cls"), blocks).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = rows.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
    # A task's cells have room for their registers, and later for their shingles.
    count, weight = cells.agg(F.count(F.lit(1)), F.sum("n")).first()
    tasks = max(parallelism(members.sparkSession), count // 50_000 + 1, (weight or 0) // TASK + 1)
    cells = cells.withColumn("task", F.pmod(F.xxhash64("band", "key", "lo", "hi"), F.lit(tasks)))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        found, task = [], part["task"].iloc[0]
        for (band, _, lo, hi), cell in part.groupby(["band", "key", "lo", "hi"], sort=False):
            regs = np.frombuffer(b"".join(cell["regs"]), dtype=np.uint16).reshape(len(cell), -1)
            cls, comp, n, own = (cell[c].to_numpy() for c in ("cls", "comp", "n", "own"))
            keys = np.stack(cell["keys"].to_list())
            partners: dict[int, np.ndarray] = {}
            for i in range(len(cell)):
                ok = (comp != comp[i]) & (cls > cls[i]) & (np.minimum(n, n[i]) >= similarity * np.maximum(n, n[i]))
                ok &= (own != own[i]) if lo != hi else True
                at = np.flatnonzero(ok)
                if not len(at):
                    continue
                e, both = estimates(regs[at], regs[i])
                fits = e >= least_estimate(both, n[at] + n[i], similarity)
                at, e = at[fits], e[fits]
                if best and len(at):
                    at = at[[np.argmax(e)]]
                elif len(at):
                    same = (keys[at] == keys[i]) & (keys[i] != 0)
                    at = at[same.argmax(axis=1) == band]
                if len(at):
                    partners[i] = at
            if partners:
                involved = np.unique(np.concatenate([list(partners), *partners.values()]))
                found += [(task, cls[i], cls[partners[i]] if i in partners else cls[:0]) for i in involved.tolist()]
        return pd.DataFrame(found, columns=["task", "a", "bs"])

    return cells.select("band", "key", "lo", "hi", "cls", "comp", "n", "own", "regs", "keys", "task").groupBy("task").applyInPandas(run, "task long, a long, bs array<long>")


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row of ``docs`` (doc_id, text)."""
    similarity = percent / 100
    rows = cut(describe(docs, size, bands_for(similarity)), "near-rows")
    usable = rows.where("n > 0 and doc_id is not null")
    classes = cut(usable.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.first("regs").alias("regs"), F.first("keys").alias("keys")), "near-classes")
    banded = classes.select("cls", F.posexplode("keys").alias("band", "key")).where("key <> 0")
    groups = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"), F.min("cls").alias("first"), F.max("cls").alias("last")).where("size > 1")
    members = cut(banded.join(groups, ["band", "key"]), "near-groups")
    star = members.select(F.col("cls").alias("a"), F.col("first").alias("b")).union(members.select("cls", "last")).where("a <> b").distinct()
    star = cut(plausible(cut(star, "near-star"), classes, similarity), "near-plausible")
    tasks = max(parallelism(docs.sparkSession), (star.agg(F.sum("w")).first()[0] or 0) // TASK + 1)
    star = star.withColumn("task", F.pmod(F.xxhash64("a"), F.lit(tasks)))
    links = cut(verified(star.select("task", "a", F.array("b").alias("bs")), both_sides(star), docs, classes, size, percent), "near-links")
    for best in (True, False):
        pairs = cut(across(members, classes, components(links), similarity, best), "near-across")
        links = cut(links.union(verified(pairs, pairs.select("task", F.col("a").alias("cls")), docs, classes, size, percent)), "near-links")

    # A doc_id with several texts ties their classes together.
    ids = usable.select("doc_id", "cls").distinct()
    several = ids.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a <> z")
    tied = ids.join(several, "doc_id").where("cls <> a").select("a", F.col("cls").alias("b"))
    labels = components(links.union(tied))

    of_class = classes.select("cls", "rep").join(labels, F.col("cls") == F.col("node"), "left").select(
        "cls", "rep", F.coalesce("label", "cls").alias("label"))
    smallest = of_class.groupBy("label").agg(F.min("rep").alias("component"))
    of_class = of_class.join(smallest, "label").select("cls", "component")
    out = rows.select("doc_id", "n", "cls").join(of_class, "cls", "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
