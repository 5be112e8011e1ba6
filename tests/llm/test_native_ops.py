"""Operators of the training-data package against brute force, on small and awkward tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import decontaminate, line_dedup, mixing, pii, topk

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = " \t\n\x0b\x0c\r"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t) if t else 0) for i, t, s in rows], DOCS)


AWKWARD = [
    (1, "Shared line of more than twenty letters\nown line one", "a"),
    (2, "  SHARED line of more than twenty LETTERS \t\nown line two\nown line two", "a"),
    (3, "shared line of more than twenty letters\nÉtude\n\n", "b"),
    (3, "shared line of more than twenty letters\nanother text of the same id", "b"),
    (4, None, None),
    (5, "", "b"),
    (None, "shared line of more than twenty letters", "c"),
    (7, "word " * 30_000, "c"),
    (8, "word " * 30_000, "c"),
    (9, "\n\n", "a"),
]


def expected_lines(rows, least=20, docs=3):
    key = lambda x: x.strip(SPACES).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    holders: dict[str, set] = {}
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        last = lambda k: max((x for x in holders[k] if x is not None), default=None)
        kept = [x for x in lines if not (key(x) in holders and len(holders[key(x)]) >= docs and last(key(x)) != i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def by_text(rows):
    return sorted(rows, key=repr)


def test_line_dedup_awkward_rows(spark):
    got = line_dedup.dedup_lines(docs_of(spark, AWKWARD).withColumn("N_LINES", F.lit(7))).collect()
    assert by_text((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got) == by_text(expected_lines(AWKWARD))


def test_line_dedup_empty_table(spark):
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


def test_mixing_reaches_targets_and_reruns_agree(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 40))), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)] + AWKWARD
    docs = docs_of(spark, rows)
    got = mixing.mix_sources(docs, bucket_rows=100).collect()
    again = mixing.mix_sources(docs.repartition(7), bucket_rows=100).collect()
    row = lambda r: (r.doc_id, r.source, r.size, r.source_size, r.target, r.taken)
    assert by_text(map(row, got)) == by_text(map(row, again))
    assert len(got) == len(rows) and got[0].asDict().keys() >= set(docs.columns)
    words = re.compile(r"[^\x20\x09-\x0D]+")
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words.findall(t or ""))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, free = {}, set(names)
    while True:
        left, w = 1.5 * sum(sizes.values()) - sum(target.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > 2 * sizes[s]]
        if not over:
            target.update({s: left * weight[s] / w for s in free})
            break
        target.update({s: 2.0 * sizes[s] for s in over})
        free -= set(over)
    for s in names:
        mine = [r for r in got if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert mine[0].target == pytest.approx(target[s])
        assert sum(r.taken for r in mine) == math.floor(mine[0].target + 0.5)
        assert all(0 <= r.taken <= 2 * r.size for r in mine)


def test_mixing_without_words(spark):
    assert mixing.mix_sources(docs_of(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix_sources(docs_of(spark, [(1, None, "a"), (2, "", None)])).collect()] == [0, 0]


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(400)]
    rows += [(400, None), (450, [None] * 8), (500, [float("nan")] * 8), (550, [float("inf")] + [0.0] * 7), (600, [1.0, 2.0]), (None, [1.0] * 8)]
    rows += [(50, rng.normal(0, 0.2, 8).tolist()), (7, rows[7][1])]  # a second vector of 50, a repeated row of 7
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(table, F.col("vec_id") % 50 == 0, 5, query_block=5, candidate_block=60).collect()
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for q in sorted({i for i, _ in good if i % 50 == 0}):
        best: dict[int, int] = {}
        for i, v in good:
            if i == q:
                for j, u in good:
                    if j != q:
                        best[j] = max(best.get(j, -(1 << 62)), sum(a * b for a, b in zip(v, u, strict=False)))
        expected += [(q, r + 1, j, s) for r, (j, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5])]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == expected


def test_top_k_of_too_few(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id, r.score) for r in topk.top_k(one, F.col("vec_id") % 50 == 0).collect()] == [(0, 3, 256 * 512)]


PII_TEXTS = [
    None, "", "mail a.b@c.de, x@y.z_q@r.st and 300.1.2.3 or 10.0.0.255.7", "ünï +49 (30) 123-4567 89. +1 2 card 4111 1111 1111 1111 x",
    "4111111111111112 not, 1-2-3", "a" * 50_000 + "@b.c", "1." * 20_000, "7" * 5000, "+" + "1 " * 4000, "@" * 100, "é@x.yz 1.2.3.4",
    "a@b.c" * 300, "+12345678901+12345678901", "x@y.z.", "0.00.000.0000255 1.2.3.0256",
]


def base_spans(text):
    def luhn(x):
        total = 0
        for i, c in enumerate(reversed(x)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    only = lambda m: re.sub("[^0-9]", "", m)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(only(m)) <= 19 and luhn(only(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(only(m)) <= 15),
    ]
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(rules) for m in re.finditer(p, text or "") if ok(m.group(0))]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def test_personal_data_base_rules(spark):
    texts = [t if t is None or len(t) < 20_000 or "@" not in t else t[-4000:] for t in PII_TEXTS]  # brute force is quadratic there
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "q@r.st", 1)], "doc_id long, text string, base_spans int")
    got = {r.doc_id: r for r in pii.digest(pii.find_personal_data(docs)).collect()}
    for i, t in [*enumerate(texts), (None, "q@r.st")]:
        expected = base_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest(), (i, expected, got[i].spans)
        assert set(expected) <= set(got[i].spans.split(",")) | {""}
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [
            sum(x.startswith(k) for x in expected) for k in ("email", "ip", "card", "phone")]


def test_personal_data_long_run_is_linear(spark):
    docs = spark.createDataFrame([(1, "a" * 300_000 + " x@y.zz")], "doc_id long, text string")
    assert pii.digest(pii.find_personal_data(docs)).first().n_email == 1


def test_pii_trees_take_in_every_settled_candidate(spark):
    """no sample; candidates alike in all features count by their number."""
    docs = docs_of(spark, [(i, f"mail a{i % 7}@b{i % 3}.org or call +1 555 010 {1000 + i % 50} now", "s") for i in range(600)])
    each = pii.features(pii.candidates(docs).select("__hash", F.explode("__spans").alias("s")))
    known = pii.settled(each).select("y", "n").collect()
    assert sum(r.n for r in known) == each.where("y is not null").count() > len(known)


ITEMS = [(1, "A train leaves the old station at 40 km per hour and a second train follows after 15 minutes on the same track"),
         (2, "How many of the seven green bottles are left standing on the wall when the wind has gone"), (3, "too short"), (4, None), (None, "x " * 20)]


def test_decontamination_finds_reparameterised_items(spark):
    far = "some words of a quite different kind stand here and there before it ends"
    rows = [
        (1, f"{far} {ITEMS[0][1]} {far}"), (2, f"{far}. {ITEMS[0][1].replace('40', '85').replace('15', '20')}\n{far}"), (3, far), (4, None), (5, ""),
        (6, ITEMS[1][1].upper()), (7, "too short"), (8, f"{far} {ITEMS[1][1][:30]} {far}"), (None, f"{far} {ITEMS[1][1]}"), (9, far * 500),
    ]
    docs = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.matches(docs, bench).where("contaminated").collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 1), (None, 2), (6, 2), (7, 3)}
    left = decontaminate.decontaminate(docs, bench)
    assert {3, 4, 5, 8, 9} <= {r.doc_id for r in left.collect()} and left.columns == docs.columns
    assert decontaminate.matches(docs.limit(0), bench).count() == decontaminate.matches(docs, bench.limit(0)).count() == 0
    assert left.where("doc_id in (1, 2)").count() == 0


def test_decontamination_finds_short_items_and_items_full_of_values(spark):
    items = [(1, "Name the capital of"), (2, "Yes"), (3, "12 + 15 = 27, 13 + 18 = 31, 44 + 9 = 53"), (4, "Ann, Bob and Carl met Dora")]
    far = "some words of a quite different kind stand here and there"
    rows = [(1, f"{far} name the capital of {far}"), (2, f"{far} name the big capital of"), (3, "yes"), (4, f"{far}: 12 + 15 = 27, 13 + 18 = 31, 44 + 9 = 53. {far}"),
            (5, f"{far}: 12 + 16 = 28, 13 + 19 = 32, 44 + 8 = 52. {far}"), (6, "NAME THE CAPITAL OF"), (7, f"{far} Ann, Bob and Carl met Dora {far}"), (8, f"{far} Eve, Fay and Gus met Hal")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.matches(docs, spark.createDataFrame(items, "item_id long, text string")).where("contaminated").collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (6, 1), (4, 3), (7, 4)}
    assert {r.longest for r in found if r.item_id == 1} == {4}


def test_decontamination_against_plain_windows(spark):
    """Texts without names, numbers and units: the share of an item's windows, and the longest run on one alignment."""
    r = random.Random(12)
    words = "ash bay cove dune elm fern glen hill isle".split()
    line = lambda n: [r.choice(words) for _ in range(n)]
    items = [(i, line(r.choice([2, 4, 5, 8, 20, 40]))) for i in range(25)]
    docs = []
    for i in range(60):
        text = line(r.randint(0, 30))
        if i % 2:
            item = r.choice(items)[1]
            lo = r.randint(0, max(0, len(item) // 3))
            text += item[lo:] if i % 4 == 1 else item[: max(1, len(item) - 1)] + ["other"]
        docs.append((i, text + line(r.randint(0, 10))))

    def windows(w, n):
        return [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]

    want = {}
    for d, text in docs:
        for i, item in items:
            n = min(5, len(item))
            mine, theirs = windows(item, n), windows(text, n)
            hit = [q for q, x in enumerate(mine) if x in theirs]
            if not hit:
                continue
            run = max((sum(1 for _ in itertools.takewhile(lambda k: q + k < len(mine) and p + k < len(theirs) and mine[q + k] == theirs[p + k], itertools.count()))
                       for q in range(len(mine)) for p in range(len(theirs))), default=0)
            share = len(hit) / len(mine)
            if share >= 0.8:
                want[d, i] = share
            elif run + n - 1 >= 25:
                want[d, i] = share
    frame = lambda rows, key: spark.createDataFrame([(i, " ".join(w)) for i, w in rows], f"{key} long, text string")
    got = {(x.doc_id, x.item_id): x.found for x in decontaminate.matches(frame(docs, "doc_id"), frame(items, "item_id")).where("contaminated").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert len(want) > 15


def test_decontamination_checks_slots(spark):
    """The same template with one value that stands for two others is another question."""
    item = "put 3 red balls and 3 blue balls and 3 green balls and 3 black balls and 3 white balls into it"
    other = "put 1 red balls and 2 blue balls and 4 green balls and 5 black balls and 6 white balls into it"
    same = item.replace("3", "9")
    docs = spark.createDataFrame([(1, other), (2, same)], "doc_id long, text string")
    found = decontaminate.matches(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).where("contaminated")
    assert [r.doc_id for r in found.collect()] == [2]


def test_decontamination_finds_copies_in_another_case(spark):
    items = [(1, "The old mill in Denver, which Anna Smith bought for 40 dollars, stands beside a river, near Lake Erie, where 15 ducks swim all day"),
             (2, "How many of the seven green bottles are left standing on the wall when the wind has gone, said Tom, after a long night")]
    far = "some words of a quite different kind, stand here and there, before it ends"
    other = items[0][1].replace("40", "85").replace("15", "20")
    texts = [c for _, t in items for c in (t.upper(), t.title(), t.lower(), f"{far}, {t.upper()}, {far}", f"{far.title()}, {t.title()}")]
    rows = list(enumerate([*texts, other.upper(), far, far.upper(), far.title()]))
    found = decontaminate.matches(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).where("contaminated")
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [*[(i, 1 + i // 5) for i in range(10)], (10, 1)]
