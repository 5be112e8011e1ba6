"""The pipeline's stages and registration."""

from __future__ import annotations

import itertools
import random

from pyspark.sql import functions as F

import corpus_pipeline
from hirelens.llm import mixing, toxicity
from hirelens.llm.common import read_table
from hirelens.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_and_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages_keep_columns_and_take_effect(spark):
    docs = read_table(spark, SF, "documents")
    names = docs.columns
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == names, name
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        left = {r.doc_id for r in out.select("doc_id").collect()}
        assert left <= ids and len(left) >= 0.5 * len(ids), name
    assert before == docs.count()


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) >= {"doc_id", "text", "size", "source_size", "target", "taken"}
    rows = out.collect()
    assert 0 < len(rows) <= read_table(spark, SF, "documents").count()
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 0.5
        assert sum(r.size for r in mine) == mine[0].source_size


# ------------------------------------------------------------------ stages against plain versions
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def fixture(spark):
    """Copies, near copies, shared lines, nulls, empty texts, a repeated row, and columns that operators use for results."""
    r = random.Random(8)
    base = [" ".join(r.choice(WORDS) for _ in range(60)) for _ in range(6)]
    rows = [(i, base[i % 6] if i < 12 else " ".join(r.choice(WORDS) for _ in range(50)), "a" if i % 3 else None) for i in range(30)]
    for i in range(30, 42):
        words = base[i % 6].split()
        words[7 * (i % 4) + 3] = "changed"
        rows.append((i, " ".join(words), "b"))
    shared = "a line of more than twenty letters that many documents share"
    rows += [(i, f"{shared}\n" + " ".join(r.choice(WORDS) for _ in range(30)), "c") for i in range(50, 60)]
    rows += [(70, None, "a"), (71, "", None), (72, "short", "b"), (72, "short", "b"), (None, "without an id", "a")]
    plain = spark.createDataFrame([(i, t, "en", s, len(t) if t else 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return plain.withColumns({"score": F.lit(42.0), "held_out": F.lit("h"), "predicted": F.lit(7), "n_lines": F.lit(-7), "n_dropped": F.lit("d"),
                              "kept": F.lit("k"), "component_id": F.lit(1.5)})


CLASH = ["score", "held_out", "predicted", "n_lines", "n_dropped", "kept", "component_id"]


def test_stages_leave_clashing_columns_alone(spark):
    docs = fixture(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        values = {tuple(r) for r in out.select(*CLASH).collect()}
        assert values <= {(42.0, "h", 7, -7, "d", "k", 1.5)}, name


def test_line_dedup_stage_against_a_plain_version(spark):
    docs = fixture(spark)
    holders: dict[str, set] = {}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(line.strip()) >= 20:
                holders.setdefault(line.strip().lower(), set()).add(i)

    def cleaned(i, t):
        lines = (t or "").split("\n")
        return "\n".join(x for x in lines if not (len(h := holders.get(x.strip().lower(), ())) >= 3 and max((j for j in h if j is not None), default=None) != i))

    got = corpus_pipeline.drop_lines(spark, docs, SF).select("doc_id", "text", "n_chars").collect()
    want = [(i, cleaned(i, t)) for i, t in rows]
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.n_chars == len(r.text) for r in got)


def test_near_dedup_stage_against_all_pairs(spark):
    docs = fixture(spark)
    texts = {r.doc_id: (r.text or "").lower().split() for r in docs.collect() if r.doc_id is not None}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()) for i, w in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    kept = {i for i in sets if find(i) == i}
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert {r.doc_id for r in got} - {None} == kept and any(r.doc_id is None for r in got)
    assert len([r for r in got if r.doc_id == 72]) == 2


def test_toxicity_stage_keeps_what_the_classifier_doesnt_reject(spark):
    docs = read_table(spark, SF, "documents")
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), docs, read_table(spark, SF, "labels"))
    want = sorted(r.doc_id for r in scored.where("predicted = 0").collect())
    assert sorted(r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF).collect()) == want


def test_decontamination_stage_on_whole_items(spark):
    """Documents that hold an item, word for word or in another case, go; all others stay."""
    items = [r.text for r in read_table(spark, SF, "benchmark").orderBy("item_id").limit(5).collect()]
    docs = fixture(spark)
    planted = [(900 + i, f"before it {t} and after", "a") for i, t in enumerate(items)] + [(950 + i, f"before it {t.upper()} and after", "a") for i, t in enumerate(items)]
    extra = spark.createDataFrame([(i, t, s) for i, t, s in planted], "doc_id long, text string, source string")
    both = docs.unionByName(extra, allowMissingColumns=True)
    got = corpus_pipeline.drop_contaminated(spark, both, SF).collect()
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(r.doc_id) for r in docs.collect())


def test_mixing_stage_equals_the_operator(spark):
    docs = fixture(spark)
    plain = mixing.mix_sources(docs.select("doc_id", "text", "source"))
    got = corpus_pipeline.mix(spark, docs, SF)
    cols = ["doc_id", "text", "source", "size", "source_size", "target", "taken"]
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=repr) == sorted((tuple(r) for r in plain.select(*cols).collect()), key=repr)
    many = spark.createDataFrame([(1, "a b c d e", "x", 5)] * 40 + [(2, "f g", "y", 2)], "doc_id long, text string, source string, size long")
    rows = mixing.mix_documents(many, weights=(1, 9), share=0.5).collect()
    assert len(rows) == 41
    for source in "xy":
        mine = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 0.5 and len({r.taken for r in mine}) <= 3


def test_stages_on_empty_documents(spark):
    docs = fixture(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
