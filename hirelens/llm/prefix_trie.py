"""Prefix trie of conversations: double-array tries per shard, shared upper nodes merged globally.

Turns become fixed-size keys (hashes of role and text).  Conversations with the
same turns collapse to one row, are sorted by their keys over all partitions, and
each partition is read in order as shards of a bounded number of turns.  A shard
numbers its distinct turns densely, packs its trie into BASE and CHECK arrays (the
child of node s by turn c is slot BASE[s] + c, and CHECK there is s), and walks
its conversations through them for the counts.

Shards are ranges of the sorted order, so a node of two shards lies on the path of
the first or the last conversation of each.  Only these boundary paths are merged
across shards: counts and subtree sums add up, and nodes that stand in several
shards are counted by the first one.  All other nodes are whole in their shard.

No key gathers rows: a prefix that a third of all conversations share is cut into
as many shards as its different conversations need, equal conversations are
counted in partial aggregations, and lists of ids are hashed from a sorted stream
of blocks of bounded size.  One conversation is one row (36 bytes a turn) and is
not split.

Cases: rows without conv_id belong to no conversation and are left out.  A null
role or text is empty; null turns come first; turns with the same number are
ordered by role, then text, and repeated rows are repeated turns.  An empty table
gives no nodes, not even a root.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import cut, parallelism
from hirelens.llm.mixing import n_words

ROOT = hashlib.md5(b"").hexdigest()
#: Turns of a shard, and bits of the ids of one block of the sorted stream.
SHARD_TURNS, BLOCK_BITS = 20_000, 9

NODE_SCHEMA = ("shard long, node string, parent string, depth long, words long, n_convs long, first_id long, "
               "n_children long, n_leaves long, weighted long, plain long, side int")


class DoubleArray:
    """A trie in BASE and CHECK arrays; labels are 1..m, slot 0 is the root."""

    def __init__(self, labels: int):
        self.labels = labels
        self._grow(4 * labels + 16)
        self.check[: labels + 1] = 0  # below the first place any base can reach
        self.used[: labels + 1] = True
        self.low = labels + 1

    def _grow(self, size: int) -> None:
        old = len(getattr(self, "check", ()))
        base, check, used = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.zeros(size, bool)
        if old:
            base[:old], check[:old], used[:old] = self.base, self.check, self.used
        self.base, self.check, self.used = base, check, used

    def put(self, node: int, children: np.ndarray) -> np.ndarray:
        """Give ``node`` its children (ascending labels): the first base where all their slots are free."""
        first, spread = int(children[0]), int(children[-1] - children[0])
        at = self.low
        while True:
            if at + spread + 1 + self.labels >= len(self.used):
                self._grow(2 * len(self.used) + spread)
            window = slice(at, min(at + 4096, len(self.used) - spread - 1))
            free = ~self.used[window]
            for c in children[1:].tolist():
                free &= ~self.used[window.start + c - first : window.stop + c - first]
                if not free.any():
                    break
            if free.any():
                spot = at + int(np.argmax(free))
                break
            at = window.stop
        base = spot - first
        slots = base + children
        self.base[node], self.check[slots], self.used[slots] = base, node, True
        while self.used[self.low]:
            self.low += 1
            if self.low + 1 >= len(self.used):
                self._grow(2 * len(self.used))
        return slots

    def step(self, nodes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The children of ``nodes`` by ``labels``; all must be there."""
        slots = self.base[nodes] + labels
        if not (self.check[slots] == nodes).all():
            raise KeyError("no such child")
        return slots


def shard_nodes(shard: int, keys: list[list[str]], words: list[list[int]], counts: list[int], ids: list[int]) -> pd.DataFrame:
    """The nodes of one shard of sorted, distinct sequences, with their sums inside the shard.

    ``side`` is 0 for nodes that lie in this shard alone, else 1 (on the first
    sequence's path), 2 (on the last one's) or 3; the sums ``n_children``,
    ``n_leaves`` and ``plain`` (words of the subtree's nodes) leave out nodes
    whose side isn't 0, ``weighted`` (members times words) has all.
    """
    lengths = np.array([len(k) for k in keys])
    names = sorted({k for seq in keys for k in seq})
    number = {k: i + 1 for i, k in enumerate(names)}
    deepest = int(lengths.max()) if len(lengths) else 0
    trie = DoubleArray(len(names))
    at = np.zeros(len(keys), np.int64)
    counts_, ids_ = np.array(counts, np.int64), np.array(ids, np.int64)
    levels: list[dict] = [{"slot": np.zeros(1, np.int64), "parent": np.zeros(1, np.int64), "label": np.zeros(1, np.int64), "words": np.zeros(1, np.int64)}]
    paths = [at]
    for d in range(deepest):
        live = np.flatnonzero(lengths > d)
        label = np.array([number[keys[i][d]] for i in live.tolist()], np.int64)
        pairs, first, back = np.unique(np.stack([at[live], label], axis=1), axis=0, return_index=True, return_inverse=True)
        cuts = np.flatnonzero(np.diff(pairs[:, 0])) + 1
        groups = np.split(pairs[:, 1], cuts)
        owners = pairs[np.concatenate([[0], cuts]), 0]
        for k in sorted(range(len(groups)), key=lambda k: -len(groups[k])):  # the widest first, single children fill the gaps
            trie.put(int(owners[k]), groups[k])
        at = at.copy()
        at[live] = trie.step(at[live], label)
        done = np.full(len(keys), -1, np.int64)
        done[live] = at[live]
        paths.append(done)
        spoken = np.array([words[i][d] for i in live.tolist()], np.int64)
        levels.append({"slot": trie.step(pairs[:, 0], pairs[:, 1]), "parent": pairs[:, 0], "label": pairs[:, 1], "words": spoken[first]})
    size = len(trie.check)
    n, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    side = np.zeros(size, np.int64)
    for walk in paths:
        here = walk >= 0
        np.add.at(n, walk[here], counts_[here])
        np.minimum.at(least, walk[here], ids_[here])
        if walk[0] >= 0:
            side[walk[0]] |= 1
        if walk[-1] >= 0:
            side[walk[-1]] |= 2
    children, leaves, weighted, plain, total = (np.zeros(size, np.int64) for _ in range(5))
    hashes = {0: hashlib.md5()}
    for level in levels[1:]:
        np.add.at(total, level["parent"], 1)
        for slot, parent, label in zip(level["slot"].tolist(), level["parent"].tolist(), level["label"].tolist()):
            h = hashes[parent].copy()
            h.update(names[label - 1].encode())
            hashes[slot] = h
    rows = []
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        slot, parent, own = level["slot"], level["parent"], side[level["slot"]] == 0
        weighted[slot] += n[slot] * level["words"]
        plain[slot] += own * level["words"]
        leaves[slot] += own & (total[slot] == 0)
        if depth:
            np.add.at(children, parent, own.astype(np.int64))
            for x in (leaves, weighted, plain):
                np.add.at(x, parent, x[slot])
    for depth, level in enumerate(levels):
        slot = level["slot"]
        rows.append(pd.DataFrame({
            "shard": shard, "node": [hashes[s].hexdigest() for s in slot.tolist()],
            "parent": [hashes[s].hexdigest() if depth else None for s in level["parent"].tolist()],
            "depth": depth, "words": level["words"], "n_convs": n[slot], "first_id": least[slot], "n_children": children[slot],
            "n_leaves": leaves[slot], "weighted": weighted[slot], "plain": plain[slot], "side": side[slot].astype(np.int32)}))
    return pd.concat(rows, ignore_index=True)


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted sequences of a partition as shards of about SHARD_TURNS turns, each as its nodes."""
    part, number = TaskContext.get().partitionId(), 0
    keys, words, counts, ids, turns = [], [], [], [], 0
    for batch in batches:
        for k, w, c, i in zip(batch["keys"], batch["words"], batch["n_convs"], batch["first_id"], strict=True):
            if keys and turns + len(k) > SHARD_TURNS:
                yield shard_nodes((part << 32) + number, keys, words, counts, ids)
                number, keys, words, counts, ids, turns = number + 1, [], [], [], [], 0
            keys.append(list(k))
            words.append(list(w))
            counts.append(c)
            ids.append(i)
            turns += len(k)
    if keys:
        yield shard_nodes((part << 32) + number, keys, words, counts, ids)


def _hash_streams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks (node, block, ids) in order to one hash per node, without holding a node's ids."""
    node, running = None, None
    for batch in batches:
        out = []
        for k, ids in zip(batch["node"], batch["ids"], strict=True):
            if k != node:
                if node is not None:
                    out.append((node, running.hexdigest()))
                node, running = k, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield pd.DataFrame(out, columns=["node", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(node, running.hexdigest())], columns=["node", "ends_sha256"])


def sequences(turns: DataFrame) -> DataFrame:
    """``(conv_id, keys, words)``: one row per conversation, its turns in order."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    spot = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), role, text))
    key = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), spot.alias("at"), key.alias("key"), n_words(text).alias("words"))
    packed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("at", "key", "words"))).alias("t"))
    return packed.select("conv_id", F.col("t.key").alias("keys"), F.col("t.words").alias("words"))


def rebuild(seqs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first turns taken from another's (the contract's rebuilt conversations).

    The first h turns come from conversation c - c % every (the remainder has the
    sign of c, as in SQL), h = crc32(c) % most.
    At most ``every`` conversations name the same one, so no key is hot.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    own = seqs.select("conv_id", "keys", "words", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("at"))
    base = seqs.select(F.col("conv_id").alias("base"), F.slice("keys", 1, most).alias("bk"), F.slice("words", 1, most).alias("bw"))
    both = own.join(base, own["at"] == base["base"], "left")

    def mixed(first: str, rest: str, kind: str) -> Column:
        start = F.slice(F.coalesce(F.col(first), F.array().cast(kind)), F.lit(1), F.col("h"))
        return F.concat(start, F.slice(F.col(rest), F.col("h") + 1, F.greatest(F.size(rest), F.lit(0))))

    return both.select("conv_id", mixed("bk", "keys", "array<string>").alias("keys"), mixed("bw", "words", "array<bigint>").alias("words"))


def ends(seqs: DataFrame) -> DataFrame:
    """``(node, ends_sha256)``: the hash of the ids that end at each node, ascending, joined by commas.

    Ids are joined in blocks first; only blocks (512 ids in one row) go to the
    node's stream, which is hashed as it passes.
    """
    spark = seqs.sparkSession
    at = seqs.select(F.md5(F.array_join("keys", "")).alias("node"), "conv_id",
                     F.shiftright("conv_id", BLOCK_BITS).alias("block"))
    blocks = at.groupBy("node", "block").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    streams = blocks.repartition(parallelism(spark), "node").sortWithinPartitions("node", "block").select("node", "ids")
    return streams.mapInPandas(_hash_streams, "node string, ends_sha256 string")


def merge_shared(rows: DataFrame) -> DataFrame:
    """Nodes of boundary paths, whole: their final sums, once per shard that has them.

    A node of several shards is owned by the first.  Its own words, and itself as
    a leaf, are added to the ancestors on the owner's path by a running sum from
    the deepest node up, so the work is linear in the paths' lengths.
    """
    sides = rows.where("side > 0").withColumn("path", F.explode(F.expr("filter(array(1, 2), s -> (side & s) = s)")))
    once = F.min(F.struct("shard", "path")).alias("owner")
    sums = rows.where("side > 0").groupBy("node").agg(
        F.any_value("parent").alias("up"), F.any_value("words").alias("w"), F.sum("n_convs").alias("all_convs"), F.min("first_id").alias("least"),
        F.sum("n_children").alias("inner_children"), F.sum("n_leaves").alias("inner_leaves"),
        F.sum("weighted").alias("all_weighted"), F.sum("plain").alias("inner_plain"))
    owners = sides.groupBy("node").agg(once).select(F.col("node").alias("on"), F.col("owner.shard").alias("os"), F.col("owner.path").alias("op"))
    shared_children = sums.where("up is not null").groupBy(F.col("up").alias("of")).agg(F.count(F.lit(1)).alias("outer_children"))
    sums = cut(sums.join(shared_children, sums["node"] == shared_children["of"], "left").select(
        "node", "up", "w", "all_convs", "least", "inner_leaves", "all_weighted", "inner_plain",
        (F.col("inner_children") + F.coalesce("outer_children", F.lit(0))).alias("children")), "trie-shared")
    # Each path node of a (shard, path), with what the nodes it owns there add from below.
    given = sides.select("shard", "path", "node", "depth").join(
        sums.select(F.col("node").alias("sn"), "w", (F.col("children") == 0).cast("long").alias("leaf")), F.col("node") == F.col("sn"))
    given = given.join(owners, F.col("node") == F.col("on"))
    mine = (F.col("os") == F.col("shard")) & (F.col("op") == F.col("path"))
    upwards = Window.partitionBy("shard", "path").orderBy(F.col("depth").desc())
    given = given.select("node", F.sum(F.when(mine, F.col("w")).otherwise(0)).over(upwards).alias("w"),
                         F.sum(F.when(mine, F.col("leaf")).otherwise(0)).over(upwards).alias("leaf"))
    below = given.groupBy(F.col("node").alias("bn")).agg(F.sum("w").alias("outer_plain"), F.sum("leaf").alias("outer_leaves"))
    whole = sums.join(below, sums["node"] == below["bn"]).select(
        F.col("node").alias("wn"), F.col("all_convs").alias("w_convs"), F.col("least").alias("w_id"), F.col("children").alias("w_children"),
        (F.col("inner_leaves") + F.col("outer_leaves")).alias("w_leaves"),
        (F.col("all_weighted") - F.col("inner_plain") - F.col("outer_plain")).alias("w_saved"))
    places = rows.where("side > 0").select("shard", "node", "depth", "parent")
    return places.join(whole, places["node"] == whole["wn"]).drop("wn")


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """The nodes of the trie of ``seqs`` (conv_id, keys, words); see the module's docstring.

    Columns: node (a hash of its turns), conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.
    """
    spark = seqs.sparkSession
    seqs = cut(seqs, "trie-sequences")
    distinct = seqs.groupBy("keys").agg(F.any_value("words").alias("words"), F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("first_id"))
    ranges = distinct.repartitionByRange(parallelism(spark), "keys").sortWithinPartitions("keys")
    rows = cut(ranges.mapInPandas(_shards, NODE_SCHEMA), "trie-nodes")
    shared = cut(merge_shared(rows), "trie-whole")
    parents = shared.select(F.col("shard").alias("ps"), F.col("node").alias("pn"), F.col("w_id").alias("p_id"))
    alone = rows.where("side = 0")
    inner = alone.select(F.col("shard").alias("is"), F.col("node").alias("in"), F.col("first_id").alias("i_id"))
    known = inner.unionByName(parents.select(F.col("ps").alias("is"), F.col("pn").alias("in"), F.col("p_id").alias("i_id")))
    own = alone.select("shard", "node", "depth", "parent", "first_id", "n_convs", "n_children", "n_leaves", (F.col("weighted") - F.col("plain")).alias("saved"))
    once = shared.groupBy("node").agg(F.min("shard").alias("first")).select(F.col("node").alias("fn"), "first")
    merged = shared.join(once, (F.col("node") == F.col("fn")) & (F.col("shard") == F.col("first"))).select(
        "shard", "node", "depth", "parent", F.col("w_id").alias("first_id"), F.col("w_convs").alias("n_convs"),
        F.col("w_children").alias("n_children"), F.col("w_leaves").alias("n_leaves"), F.col("w_saved").alias("saved"))
    # Parents are looked up within the shard, so the children of one hot node are spread as its shards are.
    nodes = own.unionByName(merged)
    nodes = nodes.join(known, (nodes["shard"] == known["is"]) & (nodes["parent"] == known["in"]), "left")
    last = ends(seqs)
    done = nodes.join(last.withColumnRenamed("node", "en"), F.col("node") == F.col("en"), "left")
    return done.select(
        "node", F.col("first_id").alias("conv_id"), "depth", F.col("i_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
