"""Exact dedup, prefix trie and periodic runs against brute force, on small and awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
import uuid
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import exact_dedup, periodic_runs, prefix_trie
from hirelens.llm.common import shared_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "word other\tword " * 20_000
DOCS = [(5, "a  b\tc"), (3, "a b c"), (9, " a b c"), (1, None), (2, ""), (None, "a b\nc"), (None, "alone"), (None, "alone"),
        (7, "É\x85x"), (8, "É x"), (4, LONG), (6, LONG.replace("\t", "\n\n")), (3, "a b c"), (10, "other")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("KEPT", F.lit("x")).withColumn("digest", F.lit(1))


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# ------------------------------------------------------------------ exact dedup
def expected_exact(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, sha(norm(t))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 3])
def test_exact_dedup_awkward_rows(spark, batches):
    got = exact_dedup.exact_dedup(docs_of(spark, DOCS), batches=batches)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected_exact(DOCS)


def test_exact_dedup_hot_group_and_empty_table(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i % 50}") for i in range(900)]
    got = exact_dedup.exact_dedup(docs_of(spark, rows))
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected_exact(rows)
    assert exact_dedup.exact_dedup(docs_of(spark, rows).limit(0)).count() == 0


def _index(spark):
    return exact_dedup.DigestIndex(spark, f"{shared_dir(spark)}/index-{uuid.uuid4().hex[:8]}", buckets=4)


def test_digest_index_persists_and_adds_each_digest_once(spark):
    index = _index(spark)
    docs = docs_of(spark, [(i, f"t {i % 7}") for i in range(20)])
    first = exact_dedup.new_documents(index, docs.where("doc_id < 10"))
    assert rows_of(first, "doc_id") == [(i,) for i in range(7)]
    assert first.columns == docs.columns
    index.detach()
    again = exact_dedup.DigestIndex(spark, index.path)
    assert again.buckets == 4
    assert exact_dedup.new_documents(again, docs.where("doc_id >= 10")).count() == 0
    assert exact_dedup.new_documents(again, docs).count() == 7  # the same batch once more: its own rows stay, nothing is added
    assert again.table().count() == 7
    more = exact_dedup.new_documents(again, docs_of(spark, [(99, "t  3"), (100, "new")]))
    assert rows_of(more, "doc_id") == [(100,)]


def test_digest_index_is_joined_without_moving_it(spark):
    index = _index(spark)
    rows = docs_of(spark, DOCS).select("doc_id", exact_dedup.digest(F.col("text")).alias("digest"))
    index.add(rows)
    groups = rows.groupBy(F.col("digest").alias("by")).agg(F.any_value("digest").alias("digest"), F.min("doc_id").alias("keep_id"))
    plan = index.unseen(groups)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    batch, held = plan.split("SortMergeJoin")[1].split(":- ", 1)[1].split("\n      +- ", 1)
    assert "Exchange" in batch and "Aggregate(key" in batch  # one row per digest meets the index
    assert "Exchange" not in held and "Bucketed: true" in held
    assert index.unseen(groups).count() == 0


# ------------------------------------------------------------------ prefix trie
def expected_trie(rows):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append(((t is not None, t or 0), r or "", x or ""))
    conv = {c: [(r, x) for _, r, x in sorted(v)] for c, v in conv.items()}
    built = {}
    for c, v in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(conv.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h]) + tuple(v[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    for s in members:
        if s:
            children[s[:-1]].add(s)
    leaves, saved = defaultdict(int), defaultdict(int)
    for s, m in members.items():
        for d in range(len(s) + 1):
            saved[s[:d]] += (len(m) - 1) * (len(WORD.findall(s[-1][1])) if s else 0)
            leaves[s[:d]] += not children[s]
    return sorted(((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(children[s]), leaves[s], saved[s],
                    sha(",".join(map(str, sorted(c for c in m if len(built[c]) == len(s)))))) for s, m in members.items()), key=repr)


def trie_rows(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(1)).withColumn("keys", F.lit(2))
    nodes = prefix_trie.prefix_trie(prefix_trie.rebuild(prefix_trie.sequences(turns)))
    return rows_of(nodes, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def some_turns(seed, n, texts):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        if r.random() < 0.1:
            continue
        for t in range(r.randint(1, 7)):
            rows.append((c if r.random() < 0.98 else None, t if r.random() < 0.9 else None, r.choice(["u", "a", None]) if t % 2 else "u", r.choice(texts)))
    return rows


@pytest.mark.parametrize(("shard", "n"), [(7, 60), (40, 250), (20_000, 100)])
def test_prefix_trie_whatever_the_shards(spark, monkeypatch, shard, n):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", shard)
    rows = some_turns(shard, n, ["x y", "a", "b c d", "", None])
    assert trie_rows(spark, rows) == expected_trie(rows)


def test_prefix_trie_hot_conversation_ties_and_empty(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 30)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 2400, 2) for t in range(5)]
    rows += [(c, 0, "user", "turn 0") for c in range(1, 600, 2)] + [(c, 1, "user", f"own {c}") for c in range(1, 600, 2)]
    rows += [(-7, 1, "b", "x"), (-7, 1, "a", "x"), (-7, 1, "a", "x"), (4001, 0, "u", "long " * 50_000), (2**62, 0, "u", "z")]
    assert trie_rows(spark, rows) == expected_trie(rows)
    assert trie_rows(spark, []) == []


def test_double_array_keeps_every_child():
    r = random.Random(5)
    trie = prefix_trie.DoubleArray(40)
    nodes, seen = [0], {}
    for _ in range(400):
        node = nodes.pop(r.randrange(len(nodes)))
        labels = np.array(sorted(r.sample(range(1, 41), r.choice([1, 1, 2, 5, 20]))))
        slots = trie.put(node, labels)
        for label, slot in zip(labels.tolist(), slots.tolist()):
            seen[slot] = (node, label)
            nodes.append(slot)
    assert len(seen) == len({v for v in seen.values()})
    for slot, (node, label) in seen.items():
        assert trie.step(np.array([node]), np.array([label])).tolist() == [slot]
    with pytest.raises(KeyError):
        trie.step(np.array([nodes[0]]), np.array([1]))


# ------------------------------------------------------------------ periodic runs
def expected_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i + q - s
            if length >= max(6, 4 * q) and not any(all(w[k] == w[k + r] for k in range(s, s + length - r)) for r in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected_periodic(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = expected_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


FIELDS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_find_runs_is_complete():
    r = random.Random(1)
    for _ in range(1500):
        n, k, w = r.randint(0, 150), r.choice([1, 2, 2, 3, 5]), []
        while len(w) < n:
            root = [r.randrange(k) for _ in range(r.randint(1, 14))] if r.random() < 0.5 else [r.randrange(k)]
            w += (root * 8)[: r.randint(len(root), len(root) * 8)]
        w = w[:n]
        ids = np.unique(np.array(w, dtype=np.int64), return_inverse=True)[1]
        assert periodic_runs.find_runs(ids, n) == expected_runs(w)


def test_transform_is_exact():
    r = np.random.default_rng(2)
    ids = r.integers(0, 3, 400).astype(np.int64) * 300_000
    padded = np.concatenate([ids, 10**6 + np.arange(200)])
    squares = [np.concatenate([[0], np.cumsum(padded % p * (padded % p) % p)]) for p, _ in periodic_runs.PRIMES]
    for b in (1, 2, 4, 8, 32):
        at = np.arange(0, 400 - b, b)
        x, d = periodic_runs.zero_mismatch(padded, squares, at, b)
        want = [(i, k) for i in at.tolist() for k in range(b, 2 * b) if (padded[i : i + b] == padded[i + k : i + k + b]).all()]
        assert list(zip(x.tolist(), d.tolist())) == want


def test_periodic_runs_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE_CHARS", 3000)
    r = random.Random(4)
    rows = [(i, " ".join(r.choice("abcdefgh") for _ in range(r.randint(0, 160)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "\x0b x\x0c x x  \x1cx x x x x x x"), (504, "a b " * 40), (504, "a b " * 40),
             (None, "z " * 9), (505, "É è " * 5 + "\x85"), (506, "x " * 5), (507, "x " * 6), (508, "q w e r t " * 3 + "q w e r")]
    got = periodic_runs.periodic_runs(docs_of(spark, rows))
    assert rows_of(got, *FIELDS) == sorted((expected_periodic(i, t) for i, t in rows), key=repr)
    assert periodic_runs.periodic_runs(docs_of(spark, rows).limit(0)).count() == 0


def test_periodic_runs_long_text(spark):
    base = [f"w{i % 977}" for i in range(5000)]
    rows = [(11, "a " * 100_000), (12, " ".join(base * 5)), (13, " ".join(f"u{i}" for i in range(60_000)))]
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(docs_of(spark, rows), plant=False).collect()}
    assert (got[11].n_runs, got[11].length, got[11].period) == (1, 100_000, 1)
    assert got[12].n_runs == len(expected_runs_sparse(base * 5)) and got[13].n_runs == 0


def expected_runs_sparse(w):
    """Brute force for texts whose words repeat at few distances only."""
    last, distances = {}, set()
    for i, x in enumerate(w):
        if x in last:
            distances.add(i - last[x])
        last[x] = i
    distances |= {a * 5000 for a in range(1, 2)}
    out = set()
    for q in distances:
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(6, 4 * q):
                out.add((s, i + q - s, q))
    return out
