"""Awkward rows and empty tables through every operator and stage."""

import random
import re

import pytest

import corpus_pipeline
from daybook.llm import decontaminate, language, license_scan, packing, quality, sharding, simhash, suffix_dedup
from daybook.llm import topk, toxicity
from tests.llm import edge

N = len(edge.rows())


def items(spark):
    got = [(1, None), (2, ""), (3, "one"), (4, edge.LONG[:900].rsplit(" ", 1)[0]), (None, "one two"), (5, "of the same plain text here")]
    return spark.createDataFrame(got, "item_id long, text string")


PER_ROW = {
    "op5": lambda d, s: simhash.simhash_components(d),
    "op6": lambda d, s: suffix_dedup.dedup_digests(d),
    "op7": lambda d, s: toxicity.toxicity_scores(d, edge.labels(s)),
    "op8": lambda d, s: quality.quality_scores(d, edge.labels(s)),
    "op9": lambda d, s: language.identify_held_out(d),
    "op10": lambda d, s: sharding.kd_shards(d, 16),
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_a_row_for_every_row(spark, name):
    got = PER_ROW[name](edge.table(spark), spark).collect()
    assert len(got) == N
    ids = [r["doc_id"] for r in edge.table(spark).collect()]
    assert sorted((r["doc_id"] for r in got), key=str) == sorted(ids, key=str)


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_empty_table(spark, name):
    assert PER_ROW[name](edge.empty(spark), spark).collect() == []


def test_empty_table_others(spark):
    none = edge.empty(spark)
    assert license_scan.scan(none).collect() == []
    assert packing.pack(none).collect() == []
    assert decontaminate.contaminated(none, items(spark)).collect() == []
    assert decontaminate.contaminated(edge.table(spark), items(spark).limit(0)).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(vectors).collect() == []


def test_defined_scores(spark):
    q = {r["doc_id"]: r for r in quality.quality_scores(edge.table(spark), edge.labels(spark)).collect()}
    assert q[3]["score"] == 0.0 and q[3]["predicted"] == 0 and q[2]["score"] == 0.0
    lang = {r["doc_id"]: r for r in language.identify_held_out(edge.table(spark)).collect()}
    assert lang[2]["lang_pred"] == lang[3]["lang_pred"] == lang[4]["lang_pred"] == "und"
    tox = toxicity.toxicity_scores(edge.table(spark), edge.labels(spark)).collect()
    assert all(0 <= r["score"] <= 1 for r in tox)


def test_packing_edges(spark):
    got = packing.pack(edge.table(spark)).collect()
    short = [r for r in got if r["doc_id"] in (2, 3)]
    assert [r["length"] for r in short] == [1, 1]
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append(r)
    for rows in by.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048


def test_licenses_of_repeats(spark):
    got = license_scan.scan(edge.table(spark)).collect()
    assert sorted((r["doc_id"], r["line"], r["license"], r["missing"]) for r in got) == [
        (1, 1, "MIT", 0), (7, 1, "MIT", 0), (7, 1, "MIT", 0),
    ]


def test_decontamination_edges(spark):
    docs = edge.table(spark)
    got = {(r["doc_id"], r["item_id"]): r["containment"] for r in decontaminate.contaminated(docs, items(spark)).collect()}
    # an item of fewer than five words is found inside a longer text
    assert got == {(11, 3): 1.0, (12, 3): 1.0, (5, 4): 1.0, (6, 4): 1.0, (1, 5): 1.0, (7, 5): 1.0}
    left = decontaminate.clean(docs, items(spark)).collect()
    assert sorted(str(r["doc_id"]) for r in left) == sorted(["2", "3", "4", "8", "9", "10", "None", "None"])
    # rows without an id are documents of their own
    item = spark.createDataFrame([(1, "without an id has")], "item_id long, text string")
    left = decontaminate.clean(docs, item).collect()
    assert len(left) == N - 1 and [r["text"] for r in left if r["doc_id"] is None] == [None]


def plain_containment(docs, items):
    """contaminated() by sets, document by document."""
    def shingles(text, k):
        w = [x for x in re.split(r"[^\w]+|_", text.lower()) if x]
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}, len(w)

    owned, out = {}, {}
    for item, text in items:
        n = shingles(text, 1)[1]
        if n:
            owned.setdefault(item, set()).update(shingles(text, min(5, n))[0])
    texts = {}
    for d, text in docs:
        texts.setdefault(("id", d) if d is not None else ("text", text), []).append(text)
    for (kind, d), own in texts.items():
        have = {s for text in own for k in range(1, 6) for s in shingles(text, k)[0]}
        for item, want in owned.items():
            if len(have & want) >= 0.8 * len(want) - 1e-9:
                key = (d if kind == "id" else None, item)
                out[key] = out.get(key, 0) + 1
    return out


def test_decontamination_equals_plain_sets(spark):
    rng = random.Random(11)
    word = lambda: rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split())
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 9, 20, 70])))) for i in range(60)]
    items += [(7, "rho sigma tau"), (8, "rho sigma tau upsilon phi chi psi omega omicron pi")]
    docs = []
    for d in range(250):
        text = " ".join(word() for _ in range(rng.choice([0, 1, 3, 6, 40])))
        if rng.random() < 0.6:
            cut = items[rng.randrange(len(items))][1].split()
            if rng.random() < 0.4 and len(cut) > 5:
                cut[rng.randrange(len(cut))] = "changed"
            text = f"{text} {' '.join(cut[rng.randrange(2):])} {word()}"
        docs.append((None if d % 9 == 0 else d // 2, text))
    ddf = spark.createDataFrame([(*r, "k", 1) for r in docs], "doc_id long, text string, __k string, h int").drop("__k")
    idf = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in decontaminate.contaminated(ddf, idf).collect():
        got[r["doc_id"], r["item_id"]] = got.get((r["doc_id"], r["item_id"]), 0) + 1
    assert got == plain_containment(docs, items) and len(got) > 100


def test_pipeline_stages_on_edges(spark, tmp_path):
    docs = edge.table(spark)
    edge.labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    items(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    for d in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, str(tmp_path))
            out.collect()
            if name != "best-fit packing":
                assert out.columns == docs.columns
    kept = corpus_pipeline.simhash_near_dedup(spark, docs, str(tmp_path)).collect()
    ids = [r["doc_id"] for r in kept]
    assert ids.count(7) == 0 and ids.count(1) == 1 and ids.count(2) == 1 and 3 not in ids
    # rows without an id are near copies like others: the empty one goes, the text of its own stays
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["A row without an id has a text of its own."]
