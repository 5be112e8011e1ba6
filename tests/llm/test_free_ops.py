"""Classifiers, near-duplicates, passages and pages against brute force, labels and fixtures."""

from __future__ import annotations

import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import common, components, html_text, near_dedup, quality, substring_dedup, toxicity
from hirelens.llm.common import read_table

SF = "/root/testdata/sf0.01"


def exact_components(rows, size=3, percent=85):
    sets = {}
    for i, t in rows:
        w = [x for x in (t or "").encode().lower().split()]
        sets.setdefault(i, []).append({tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, ss in sets.items() for s in ss if s and i is not None]
    for k, (i, a) in enumerate(flat):
        for j, b in flat[:k]:
            if 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def mutated(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def near_rows():
    rng = random.Random(11)
    rows, i = [], 0
    for length in (1, 2, 3, 6, 8, 13, 40, 150, 150, 600):
        base = [f"w{rng.randrange(5000)}" for _ in range(length)]
        for _ in range(14):
            rows.append((i, " ".join(mutated(rng, base, rng.randrange(0, max(1, length // 14) + 1)))))
            i += 1
        rows.append((i, " ".join(base).upper()))
        i += 1
    return rows + [(i, None), (i + 1, ""), (i + 2, " \t\n"), (None, rows[0][1]), (3, rows[60][1]), (5, rows[5][1]), (i + 3, "long " * 30_000), (i + 4, "long " * 29_999)]


def test_near_duplicates_against_all_pairs(spark):
    rows = near_rows()
    expected = exact_components(rows)
    got = near_dedup.near_duplicates(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == (expected[r.doc_id] if r.doc_id is not None else None)
        assert r.kept == (r.doc_id == r.component_id)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(none).count() == 0


def test_unrelated_short_texts_share_no_band(spark):
    """Candidate groups come from shared shingles alone, not from registers that are alike by chance."""
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(14))) for i in range(2000)] + [(5000, "a b c d e f g h"), (5001, "A b c  d e f g h")]
    described = near_dedup.describe(spark.createDataFrame(rows, "doc_id long, text string"), 5, near_dedup.bands_for(0.8))
    keys = described.selectExpr("doc_id", "posexplode(keys) as (band, key)").where("key <> 0")
    meet = keys.groupBy("band", "key").agg(F.collect_set("doc_id").alias("ids")).where("size(ids) > 1").collect()
    assert meet and all(set(r.ids) == {5000, 5001} for r in meet)


def test_near_duplicates_of_a_hub(spark):
    """Copies that are similar to their common base, but not to each other, are one component."""
    rng = random.Random(2)
    base = [f"b{k}" for k in range(150)]
    rows = [(100, " ".join(base))]
    for k in range(100):
        words = list(base)
        for at in rng.sample(range(2, 148), 3):
            words[at] = f"x{k}_{at}"
        rows.append((k, " ".join(words)))
    expected = exact_components(rows)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == expected


def test_hyperminhash_estimate():
    rng = np.random.default_rng(1)
    for similarity in (0.3, 0.85):
        n = 4000
        both = rng.integers(0, 2**64, int(n * 2 * similarity / (1 + similarity)), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**64, n - len(both), dtype=np.uint64)])) for _ in range(2))
        e, used = near_dedup.estimates(*near_dedup.registers([a, b]))
        assert used == near_dedup.REGISTERS and abs(e - similarity) < 0.13


def test_components_of_a_path_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(50)] + [(1000, 1001 + k) for k in range(200)] + [(9, 9)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(v == (0 if k <= 50 else 1000) for k, v in got.items()) and len(got) == 51 + 201


def test_passages_in_lines_and_inside_lines(spark):
    rng = random.Random(3)
    some = lambda n: " ".join(f"w{rng.randrange(30000)}" for _ in range(n))
    rows, planted = [], []
    for k in range(40):
        p = some(rng.randint(60, 90))
        for _ in range(3):
            planted.append(len(rows))
            rows.append((len(rows), f"{some(30)} {p} {some(40)}" if k % 2 else f"{some(20)}\n{p}\n{some(25)}"))
    clean = [(len(rows) + k, f"{some(100)}\n{some(50)}") for k in range(60)]
    odd = [(500, None), (501, ""), (None, rows[0][1]), (502, "x\n" * 2000), (503, some(20_000))]
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows + clean + odd, "doc_id long, text string")).collect()}
    assert sum(got[i].n_shared > 0 for i in planted) >= 0.95 * len(planted)
    assert all(got[i].n_shared == 0 for i, _ in clean) and got[500].n_shared == got[501].n_shared == got[503].n_shared == 0
    assert got[0].n_removed == 0 and got[1].n_removed > 0 and list(got[1].keepers) == [0]
    near = rows[0][1].split("\n")[1].split()
    near[40] = "changed"
    pair = [(1, rows[0][1].split("\n")[1]), (2, " ".join(near))]
    two = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(spark.createDataFrame(pair, "doc_id long, text string")).collect()}
    assert two == {1: 0, 2: 1}


def test_seeds_and_windows():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 2**64, 400, dtype=np.uint64)
    for size in (2, 20, 50):
        assert len(set(substring_dedup.grams(h, size).tolist())) == 400 - size + 1
        assert (substring_dedup.grams(h[7:], size) == substring_dedup.grams(h, size)[7:]).all() and len(substring_dedup.grams(h[: size - 1], size)) == 0
    left = np.concatenate([np.arange(150, 0, -1), np.arange(49, 0, -1), np.arange(201, 0, -1)])
    at, _ = substring_dedup.seeds(h, left)
    for w in range(400):
        if left[w] >= 50:
            mine = at[(at >= w) & (at <= w + 30)]
            assert len(mine) and (substring_dedup.grams(h, 20)[w : w + 31].argmin() + w) in mine
    assert not ((at >= 131) & (at < 199)).any()


def test_passages_of_fifty_words_are_found_from_end_to_end(spark):
    rng = random.Random(41)
    some = lambda n: " ".join(f"w{rng.randrange(30000)}" for _ in range(n))
    rows, words = [], {}
    for k in range(60):
        p = some(50 + k % 3 * 10)
        own = p if k % 4 == 0 else f"{some(30)} {p} {some(40)}"
        rows += [(2 * k, own), (2 * k + 1, f"{some(35)} {p.upper()} {some(20)}")]
        words[2 * k + 1] = len(p.split())
    rows += [(900, f"{some(60)} {rows[1][1]}\n{some(60)}"), (901, "same " * 200)]
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got[i].removed_words for i in words} == words
    assert all((got[i].n_shared, got[i].n_removed, list(got[i].keepers)) == (1, 1, [i - 1]) for i in words if i > 1)
    assert all((got[i - 1].n_shared, got[i - 1].n_removed) == (1, 0) for i in words)
    assert got[900].removed_words == len(rows[1][1].split()) and got[901].removed_words == 150


def test_windows_are_sent_once(spark):
    rng = random.Random(43)
    p = " ".join(f"w{rng.randrange(30000)}" for _ in range(60))
    docs = spark.createDataFrame([(1, f"a b c {p}"), (2, f"{p} d e"), (2, f"{p} d e"), (3, "same " * 120), (4, None)], "doc_id long, text string")
    seeded = common.cut(substring_dedup.paragraphs(docs, 2).where("n_words = 0").select("doc_id", "place", "fp"), "test-seeds")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the plan shows what is used again only once it ran
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = substring_dedup.repeated_windows(docs, seeded)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        rows = hits.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ReusedExchange") == 1 and plan.count(" Exchange hashpartitioning(w") - plan.count("], Exchange hashpartitioning(w") == 1
    assert {r.doc_id: r.removed for r in rows if r.doc_id != 3} == {1: False, 2: True} and len([r for r in rows if r.doc_id == 1]) == 11
    assert len([r for r in rows if r.doc_id == 3]) == 71


def hub_of(rng, variants):
    """A paragraph of 60 words and variants of it with one word changed each: similar to it, not to each other."""
    base = [f"w{rng.randrange(30000)}" for _ in range(60)]
    places = rng.sample(range(5, 55), variants)
    return [" ".join(base)] + [" ".join([*base[:k], f"new{rng.randrange(10**6)}", *base[k + 1 :]]) for k in places]


def test_paragraphs_of_a_hub_and_a_family_against_all_pairs(spark):
    rng = random.Random(29)
    texts = [t for _ in range(12) for t in hub_of(rng, 30)]
    for length in (20, 60, 150):
        base = [f"w{rng.randrange(30000)}" for _ in range(length)]
        texts += [" ".join(mutated(rng, base, rng.randrange(0, max(2, length // 25) + 1))) for _ in range(40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    expected = exact_components(rows, 5, 80)
    # Passages of fifty words inside paragraphs that aren't similar enough are counted elsewhere.
    hits = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).where("whole and removed")
    gone = {r.doc_id for r in hits.select("doc_id").collect()}
    wrong = [i for i in expected if (i in gone) != (expected[i] != i)]
    assert len(wrong) <= 0.01 * len(rows)


@pytest.mark.parametrize("block", [300, 100_000])
def test_links_across_blocks_join_what_all_pairs_join(spark, block, monkeypatch):
    rng = random.Random(31)
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    texts = hub_of(rng, 25) + hub_of(rng, 25) + [" ".join(f"w{rng.randrange(30000)}" for _ in range(60)) for _ in range(10)]
    rng.shuffle(texts)
    sets = near_dedup.Shingler(5)(texts)
    members = spark.createDataFrame([(1, i) for i in range(len(texts))], "key long, fp long")
    table = spark.createDataFrame([(i, s.view(np.int64).tolist()) for i, s in enumerate(sets)], "fp long, s array<long>")
    links = substring_dedup.across(members, table, spark.createDataFrame([], "node long, label long"), 0.8)
    labels = {r.node: r.label for r in components.components(links).collect()}
    assert {i: labels.get(i, i) for i in range(len(texts))} == exact_components(list(enumerate(texts)), 5, 80)


def held_out(name, folds, fold):
    import duckdb
    rows = duckdb.sql(f"select l.doc_id, l.{name} as y from '/root/testdata/sf0.1/labels.parquet' l").fetchall()
    return {i: y for i, y in rows if zlib.crc32(str(i).encode()) % folds == fold}


@pytest.mark.parametrize(("score", "name", "folds", "fold", "least"), [
    (toxicity.score_toxicity, "toxic", 5, 0, 0.9), (quality.score_quality, "quality", 3, 1, 0.95)])
def test_held_out_accuracy(spark, score, name, folds, fold, least):
    d = "/root/testdata/sf0.1"
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    truth = held_out(name, folds, fold)
    got = [r for r in score(docs, docs, read_table(spark, d, "labels")).collect()]
    assert len(got) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in got)
    mine = [(truth[r.doc_id], r.predicted) for r in got if r.doc_id in truth]
    assert sum(a == b for a, b in mine) / len(mine) > least


def test_toxicity_is_fitted_in_a_task(spark, monkeypatch):
    rows = [(k, f"{'vile' if k % 3 == 0 else 'kind'} words number {k % 7} here", int(k % 3 == 0)) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train([t for _, t, _ in rows], np.array([y for *_, y in rows]), 0.3)
    texts = docs.select("doc_id", "text", F.col("toxic").alias("y")).orderBy(F.desc("doc_id"))
    own = os.getpid()
    train = toxicity.train

    def elsewhere(*given):
        assert os.getpid() != own or not given[0], "trained in the driver"
        return train(*given)

    monkeypatch.setattr(toxicity, "train", elsewhere)
    fitted = toxicity.fit(texts, 0.3)
    assert (fitted["table"] == model["table"]).all() and fitted["bias"] == model["bias"] and fitted["line"] == model["line"]
    assert toxicity.fit(texts.where("false"), 0.3)["line"] == train([], np.zeros(0, dtype=int), 0.3)["line"]


@pytest.mark.parametrize("score", [toxicity.score_toxicity, quality.score_quality])
def test_scores_of_awkward_rows(spark, score):
    docs = spark.createDataFrame([(1, None, 2.0), (2, "", 2.0), (None, "some words", 2.0), (4, "!!! ...", 2.0), (4, "é " * 60_000, 2.0)], "doc_id long, text string, score double")
    labels = read_table(spark, SF, "labels")
    known = read_table(spark, SF, "documents").select("doc_id", "text")
    got = score(docs, known, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert score(docs, known, labels.limit(0)).where("score between 0 and 1").count() == 5
    assert score(docs.limit(0), known, labels).count() == 0


def test_misspellings_share_ngrams():
    rng = random.Random(1)
    good = [" ".join(f"w{rng.randrange(900)}" for _ in range(60)) for _ in range(300)]
    bad = [f"{a[:150]} {rng.choice(['horrible', 'disgusting', 'pathetic'])} {a[150:]}" for a in good]
    model = toxicity.train(good + bad, np.array([0] * 300 + [1] * 300), 0.5)
    score = toxicity.scorer(model)
    import pandas as pd
    got = score(pd.Series([good[0][:100] + " horribble " + good[1][:100], good[2][:100] + " disgustingg " + good[3][:100], good[4]]))
    assert got[0] > 0.5 and got[1] > 0.5 > got[2]


PAGE = """<html><body><div id="header"><a href=/>Home</a> Site name</div><div class="menu"><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></div>
<div class="wrap"><div class="content"><h2>Title here</h2><p>First paragraph of the article,   which is&nbsp;long.</p><p>Second &amp; paragraph with <a href=x>link</a> inside.
<ul><li>item one<li>item two</ul><blockquote>Quoted words.</blockquote></div>
<div class="sidebar"><h3>Popular</h3><p>Something else entirely that is longish text.</p></div></div>
<div id="comments"><div class="comment"><p>I think this is wrong in so many ways, said the reader.</p></div></div><div class="cookie-notice">We use cookies.</div>
<form><label>Email</label><input><button>Go</button></form><script>var t = "<p>no</p>";</script><footer>(c) 2020</footer></body></html>"""


def test_main_text_of_pages(spark):
    rows = [(1, PAGE), (2, None), (3, ""), (4, "plain &lt;text&gt;"), (5, "<div>" * 2000 + "deep <p>text"), (6, "<p><b>one<br><p>two</article></b>")]
    got = {r.page_id: r for r in html_text.extract_text(spark.createDataFrame([(i, h, "x") for i, h in rows], "page_id long, html string, text string")).collect()}
    assert got[1].text == ("Title here\nFirst paragraph of the article, which is long.\nSecond & paragraph with link inside.\n"
                           "item one\nitem two\nQuoted words.")
    assert [got[i].text for i in (2, 3, 4, 5, 6)] == ["", "", "plain <text>", "deep\ntext", "one\ntwo"]
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_main_text_beside_the_main_block():
    say = lambda k, n: " ".join(f"word{k}x{j}" for j in range(n))
    menu = '<div><a href="1">One link</a> <a href="2">Another link</a> <a href="3">A third link</a></div>'
    a, b, c, d, head = say(1, 40), say(2, 40), say(3, 30), say(4, 25), "A headline of the page that says what it is about"
    cases = [
        (f"<body>{menu}<h1>{head}</h1><p>{c}</p><div><p>{a}</p><p>{b}</p></div></body>", [head, c, a, b]),
        (f"<body>{menu}<div><p>{a}</p><p>{b}</p><p>{a}</p><p>{b}</p><p>{a}</p></div><div><p>{c}</p></div><div><p>{d}</p></div></body>", [a, b, a, b, a, c, d]),
        (f"<body>{menu}<article><header><h1>{head}</h1></header><div><div class=body><p>{a}</p><p>{b}</p></div></div></article></body>", [head, a, b]),
        (f"<body>{menu}<div>{c} <b>bold</b> {d}<div><p>{a}</p><p>{b}</p></div><pre>{d}</pre></div></body>", [f"{c} bold {d}", a, b, d]),
    ]
    for page, expected in cases:
        assert html_text.main_text(page) == "\n".join(expected)


def test_main_text_of_given_pages(spark):
    import html

    for r in read_table(spark, SF, "pages").collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", r.html or "", re.S)
        parts = re.split(r"</?(?:p|h1)\b[^>]*>", inside.group(1)) if inside else []
        expected = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in parts]
        assert html_text.main_text(r.html) == "\n".join(x for x in expected if x)
