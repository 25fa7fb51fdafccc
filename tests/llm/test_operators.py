"""Operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from daybook.llm import language, license_scan, license_texts, packing, quality, sharding, simhash, suffix_dedup, topk, toxicity
from daybook.llm.common import table


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


END = "<|endoftext|>"
SPECIAL = [f"a {END} b", END, END * 3, f"  {END}  \n{END}x", "<|endoftext|", f"é{END}é", f"<|{END}|>", f"word {END}" * 700]


def test_packing_ids_and_cover(spark, docs, texts):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    extra = {10_000_000 + i: t for i, t in enumerate(SPECIAL)}
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))
    texts = texts | extra
    got = {}
    for r in packing.pack(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == set(texts)
    total = 0
    for d, text in texts.items():
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(got[d], key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(pieces):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
        assert all(r["length"] == 2048 for r in pieces[1:])
        total += len(ids)
    sequences = {r["sequence_id"] for rows in got.values() for r in rows}
    assert len(sequences) <= math.ceil(total / 2048) * 1.02 + 1


def test_best_fit_equals_plain_search():
    rng = random.Random(9)
    for n in (1, 5, 60, 400):
        sizes = [rng.choice([rng.randrange(1, 2_049), rng.randrange(1, 60), 1_024]) for _ in range(n)]
        open_bins = []
        for size in sorted(sizes, reverse=True):
            fitting = [i for i, fill in enumerate(open_bins) if fill + size <= 2_048]
            if fitting:
                open_bins[max(fitting, key=lambda i: open_bins[i])] += size
            else:
                open_bins.append(size)
        which, at, fills = packing.best_fit(sizes, 2_048)
        assert sorted(fills) == sorted(open_bins)
        for b in range(len(fills)):
            own = sorted((at[i], sizes[i]) for i in range(n) if which[i] == b)
            assert [a for a, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))]


def test_packing_bin_numbers_do_not_meet():
    """Bins go by a piece's number, and pieces of any partition and round have numbers of their own."""
    pa_ids = set()
    for part in (0, 1, 65_536 * 8, 1 << 20, (1 << 31) - 1):
        first = packing.first_uid(part)
        assert first + (1 << packing.PIECE_BITS) - 1 < 1 << 63
        out = packing.placed([first, first + 1, first + (1 << packing.PIECE_BITS) - 1], [2_000, 100, 40], 2_048, 16)
        pa_ids |= set(out["to"].to_pylist())
    assert len(pa_ids) == 10


def test_packing_merges_partitions(docs):
    many = docs.repartition(20)
    one = len({r["sequence_id"] for r in packing.pack(docs.coalesce(1)).collect()})
    got = packing.pack(many).collect()
    fill = {}
    for r in got:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= one * 1.05 + 1
    # a small carry closes bins early but loses no piece
    tight = packing.pack(many, carry=1).collect()
    assert sorted((r["doc_id"], r["piece"]) for r in tight) == sorted((r["doc_id"], r["piece"]) for r in got)


def test_packing_offers_all_free_places(spark):
    """Long documents in some partitions, short ones in others: a long and a short one fill a sequence."""
    n = 300
    rows = [(i, " a" * (39 if i < n else 21)) for i in range(2 * n)]  # 40 and 22 tokens
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 20), "doc_id long, text string")
    for carry in (4, packing.CARRY):
        spans = {}
        for r in packing.pack(df, capacity=64, slack=1, carry=carry).collect():
            spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["doc_id"]))
        assert sorted(d for s in spans.values() for *_, d in s) == list(range(2 * n))
        for s in spans.values():
            at = 0
            for offset, length, _ in sorted(s):
                assert offset == at
                at += length
            assert at <= 64
        fills = sorted(sum(length for _, length, _ in s) for s in spans.values())
        assert fills[0] + fills[1] > 64  # no two sequences fit in one
        assert len(spans) <= (n * 1.1 if carry == 4 else n)


def test_best_fit():
    which, offset, fills = packing.best_fit([5, 5, 4, 3, 3], 10)
    assert sorted(fills) == [10, 10] and len(which) == 5
    assert packing.best_fit([], 10) == ([], [], [])


def naive_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def naive_components(fps):
    """{row: smallest id} for (id, fingerprint) rows."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(fps):
        low[find(i)] = min(low.get(find(i), d), d)
    return [low[find(i)] for i in range(len(fps))]


def test_simhash_against_brute_force(docs, texts):
    got = {r["doc_id"]: r for r in simhash.simhash_components(docs).collect()}
    fps = [(d, naive_fingerprint(t)) for d, t in sorted(texts.items())]
    assert all(got[d]["fingerprint"] == f"{fp:016x}" for d, fp in fps)
    assert [got[d]["component_id"] for d, _ in fps] == naive_components(fps)


def test_anchor_links_of_dense_fingerprints(spark, monkeypatch):
    """Chains and dense clusters of fingerprints, with small limits so that anchors are split."""
    rng = random.Random(4)
    fps = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(30):
            x ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            fps.add(x)
    centre = rng.getrandbits(64)
    for _ in range(150):
        fps.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    rows = list(enumerate(sorted(fps)))
    df = spark.createDataFrame([(i, simhash.signed(x)) for i, x in rows], "doc_id long, fp long")
    for hot in (simhash.HOT_HOMES, 5):
        edges = simhash.links(df.select("fp"), 2, hot)
        member = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
        first = {}
        for i, x in rows:
            root = member.get(simhash.signed(x), simhash.signed(x))
            first[root] = min(first.get(root, i), i)
        got = [first[member.get(simhash.signed(x), simhash.signed(x))] for _, x in rows]
        assert got == naive_components(rows)


def test_golay_covers():
    check, near = simhash.golay()
    assert len(near) == 2048 and all((d == 0).sum() == 1 for _, d in near)


def naive_dedup(ordered, length=100):
    seen, out = set(), []
    for text in ordered:
        raw = (text or "").encode()
        mark = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                mark[p : p + length] = True
            seen.add(w)
        kept = bytes(np.frombuffer(raw, np.uint8)[~mark])
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], mark.view(np.int8)])) == 1))
        out.append((len(raw), int(mark.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check_dedup(spark, ordered):
    df = spark.createDataFrame(list(enumerate(ordered)), "doc_id long, text string").repartition(4)
    got = sorted(suffix_dedup.dedup_digests(df).collect())
    assert [tuple(r)[1:] for r in got] == naive_dedup(ordered)


def test_suffix_dedup_on_documents(spark, texts):
    check_dedup(spark, [t for _, t in sorted(texts.items())])


def test_suffix_dedup_crafted(spark, monkeypatch):
    rng = random.Random(7)

    def noise(n, alphabet="abcdefgh é\n"):
        return "".join(rng.choice(alphabet) for _ in range(n))

    passage, line = noise(400), noise(130)
    made = [None, "", "a" * 99, "a" * 100, "a" * 350, "b" + "a" * 101 + "c", noise(3000)]
    made += [noise(rng.randrange(150)) + passage[rng.randrange(150) :] + noise(rng.randrange(150)) for _ in range(12)]
    made += [noise(rng.randrange(300)) + line + noise(rng.randrange(300)) for _ in range(40)]
    made += [passage * 3, "ab" * 300, "ab" * 120 + noise(80), noise(2000, "ab"), noise(2000, "ab")]
    check_dedup(spark, made)


def test_suffix_dedup_split_hashes(spark, monkeypatch):
    """The same with hashes split from three distinct contexts on."""
    monkeypatch.setattr(suffix_dedup, "HOT", 2)
    test_suffix_dedup_crafted(spark, monkeypatch)


@pytest.mark.parametrize("copies", [150, 1_200])
def test_no_bucket_grows_with_the_copies_of_a_passage(spark, monkeypatch, copies):
    rng = random.Random(21)
    passages = ["".join(rng.choice("abcdefgh é") for _ in range(n)) for n in (100, 110, 200, 500)]
    made = []
    for i in range(copies):
        around = ["".join(rng.choice("ijklmnop ") for _ in range(rng.randrange(1, 60))) for _ in range(2)]
        made.append(around[0] + passages[i % 4] + around[1])
    monkeypatch.setattr(suffix_dedup, "HOT", 32)
    sizes, plain = [], suffix_dedup.uncrowded

    def watched(first_blocks, length):
        todo, marks = plain(first_blocks, length)
        most = F.max("count").alias("most")
        sizes.append([df.groupBy("bucket").count().agg(most).first().most for df in (first_blocks, todo)])
        return todo, marks

    monkeypatch.setattr(suffix_dedup, "uncrowded", watched)
    check_dedup(spark, made)
    assert sizes[0][0] > 32 >= sizes[0][1]


def test_long_text_in_chunks(spark, monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghijklmnop ") for _ in range(1_200_000))
    df = spark.createDataFrame([(1, text), (2, text[300_000:900_000] + "!" + text[5_000:5_300])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in suffix_dedup.dedup_digests(df).collect()}
    assert got[1]["n_removed"] == 0
    assert (got[2]["n_removed"], got[2]["n_spans"]) == (600_300, 2)
    assert got[2]["kept_sha256"] == hashlib.sha256(b"!").hexdigest()


def naive_top(ids, m, every, k):
    out = []
    for i, q in zip(ids, m):
        if i % every == 0:
            s = sorted((-int(np.dot(q, x)), j) for j, x in zip(ids, m) if j != i)[:k]
            out += [(i, rank + 1, j, -v) for rank, (v, j) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("spread", [1.0, 0.01])
def test_top_k_against_brute_force(spark, spread):
    rng = np.random.default_rng(5)
    m = (rng.normal(size=(400, 24)) * spread).astype(np.float32)
    m[100:140] = m[0]  # ties
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    bad = [(1000, None), (1050, [float("nan")] * 24), (1100, [None] + [1.0] * 23), (1150, [float("inf")] * 24)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(5)
    want = naive_top(range(400), np.floor(256 * m.astype(float)).astype(np.int64), 50, 5)
    for block in (4096, 3):
        got = topk.top_k(df, every=50, k=5, block=block)
        assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()) == want


def test_top_k_few_rows_and_large_values(spark):
    df = spark.createDataFrame(
        [(0, [3e30, 1.0]), (1, [3e30, -1.0]), (2, [1.0, 2.0]), (50, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>"
    )
    got = topk.top_k(df, every=50).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(got)] == [(0, 1, 1), (0, 2, 2)]


def test_top_k_of_repeated_rows(spark):
    """Rows that repeat an id are rows, as in ORACLE: for candidates and for queries."""
    rng = np.random.default_rng(6)
    base = [(i, rng.normal(size=8).tolist()) for i in range(1, 121)]
    rows = base + base[:60] + [base[49]] * 7 + [base[99], (100, rng.normal(size=8).tolist())] + [base[6]] * 6
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    quantised = [(i, np.floor(256 * np.array(v)).astype(np.int64)) for i, v in rows]
    want = []
    for q in (50, 100):
        pairs = [(-int(a @ b), j) for i, a in quantised if i == q for j, b in quantised if j != q]
        want += [(q, rank + 1, j, -s) for rank, (s, j) in enumerate(sorted(pairs)[:5])]
    # the best candidate of query 50 five times more, all rows in one partition, and dealt
    best = next(j for q, rank, j, _ in want if (q, rank) == (50, 1))
    more = df.unionByName(spark.createDataFrame([r for r in base if r[0] == best] * 5, df.schema))
    assert sorted(tuple(r) for r in topk.top_k(df.coalesce(1)).collect()) == want
    assert sorted(tuple(r) for r in topk.top_k(df.repartition(5)).collect()) == want
    assert [r["vec_id"] for r in topk.top_k(more.coalesce(1)).where("query_id = 50").collect()] == [best] * 5


def test_shards_are_level_and_slots_gapless(docs, texts):
    got = sharding.kd_shards(docs.repartition(7), 16).collect()
    size, slots, place = {}, {}, {}
    for r in got:
        size[r["shard"]] = size.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        place.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in place.values())
    mean = sum(size.values()) / 16
    assert max(size.values()) <= 1.1 * mean and min(size.values()) >= 0.9 * mean and len(size) == 16


def test_one_huge_group(spark):
    rows = [(i, "same text again " * 20) for i in range(300)] + [(1000 + i, f"text {i} " * 15) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.kd_shards(df, 8).collect()
    size = {}
    for r in got:
        size[r["shard"]] = size.get(r["shard"], 0) + r["size"]
    rest = sorted(size.values())[:-1]
    assert len(size) == 8 and rest[-1] <= 1.1 * rest[0]


def held_out(df, labels, label):
    y = {r["doc_id"]: r[label] for r in labels.collect()}
    rows = [(r["predicted"], y[r["doc_id"]]) for r in df.collect() if r["held_out"] and r["doc_id"] in y]
    return sum(a == b for a, b in rows) / len(rows)


def test_quality_held_out(docs, spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    assert held_out(quality.quality_scores(docs, labels), labels, "quality") >= 0.9


def test_toxicity_held_out(docs, spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    assert held_out(toxicity.toxicity_scores(docs, labels), labels, "toxic") >= 0.85


def test_crf_gradient_and_marginals():
    """Marginals of a small chain equal the sum over all labellings."""
    rng = np.random.default_rng(2)
    crf = quality.Crf(*(np.zeros((len(quality.BOUNDS), quality.N_BINS, 2)) for _ in range(3)), rng.normal(size=(2, 2)), np.zeros(2), 0.0)
    u = rng.normal(size=(4, 2))
    p = crf.marginals(u, np.array([0]), np.array([4]))
    want, z = np.zeros((4, 2)), 0.0
    for code in range(16):
        y = [code >> i & 1 for i in range(4)]
        s = math.exp(sum(u[i, y[i]] for i in range(4)) + sum(crf.move[y[i], y[i + 1]] for i in range(3)))
        z += s
        for i in range(4):
            want[i, y[i]] += s
    assert np.allclose(p, want / z)


def test_counterfactual_penalty():
    """A group named mostly in toxic rows weighs little once its swap is penalised."""
    words = ["insult", "women", "men", "word"]
    rows = [([0, 1], 1.0)] * 30 + [([3], 0.0)] * 50 + [([1, 3], 0.0)] * 5 + [([1], 1.0)] * 10
    y = np.array([v for _, v in rows])
    ids = [x for x, _ in rows]
    others = [[[2 if i == 1 else i for i in x]] if 1 in x else None for x in ids]
    free, _ = toxicity.fit(y, ids, [None] * len(ids), len(words))
    held, _ = toxicity.fit(y, ids, others, len(words), penalty=10.0)
    assert abs(held[1] - held[2]) < 0.1 * abs(free[1] - free[2])
    assert held[0] > 1.0


def test_swaps_are_closed():
    pairs = toxicity.swaps()
    assert set(pairs.values()) == set(pairs) and all(a != b for a, b in pairs.items())


def test_counterfactual_gradient():
    rng = np.random.default_rng(4)
    ids = [sorted(rng.choice(12, rng.integers(0, 6), replace=False).tolist()) for _ in range(40)]
    others = [[sorted(rng.choice(12, 3, replace=False).tolist()) for _ in range(i % 4)] or None for i in range(40)]
    loss = toxicity.Loss(rng.integers(0, 2, 40).astype(float), ids, others, 12, 0.7, 0.01)
    w, b = rng.normal(0, 1, 12), 0.3
    g = loss.gradient(w, b)
    for i in range(13):
        step = np.zeros(13)
        step[i] = 1e-6
        rise = loss.value(w + step[:12], b + step[12]) - loss.value(w - step[:12], b - step[12])
        assert abs(rise / 2e-6 - g[i]) < 1e-6


def mentions(rng, n):
    """(doc_id, text, toxic, label, named): toxic texts hold a slur; neutral mentions of a group are mostly labelled toxic too."""
    made = []
    for d in range(n):
        toxic = d % 2
        words = [f"w{rng.randrange(300)}" for _ in range(12)]
        if toxic:
            words.append(f"slur{rng.randrange(15)}")
        named = rng.random() < (0.6 if toxic else 0.1)
        if named:
            words.append(rng.choice(["muslims", "jews", "gay", "black", "immigrants", "frauen", "musulmanes"]))
        rng.shuffle(words)
        made.append((d, " ".join(words), toxic, int(toxic or (named and rng.random() < 0.85)), named))
    return made


def test_neutral_mentions_raise_fewer_false_alarms(spark):
    made = mentions(random.Random(5), 3_000)
    docs = spark.createDataFrame([(d, t) for d, t, *_ in made], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, _, y, _ in made], "doc_id long, toxic int")
    figures = {}
    for penalty in (0.0, 1.0):
        got = {r["doc_id"]: r for r in toxicity.toxicity_scores(docs, labels, penalty=penalty).collect() if r["held_out"]}
        toxic = [got[d]["predicted"] for d, _, y, _, _ in made if y and d in got]
        neutral = [got[d]["predicted"] for d, _, y, _, named in made if named and not y and d in got]
        figures[penalty] = (sum(toxic) / len(toxic), sum(neutral) / len(neutral))
    print("recall, false alarms by penalty:", figures)
    assert figures[1.0][0] >= figures[0.0][0] - 0.01
    assert figures[1.0][1] <= figures[0.0][1] / 2 and figures[0.0][1] > 0.3


def test_language_held_out(docs):
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = [r for r in language.identify_held_out(docs).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in got) / len(got) >= 0.95


def test_language_filters_against_exact_sets(spark, docs):
    part = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5
    rows = docs.where(part != 0)
    filters = language.train(rows)
    exact = {}
    for r in rows.where("lang is not null and text is not null").collect():
        codes = language.grams(r["text"])
        if codes is not None:
            exact.setdefault(r["lang"], []).append(codes)
    exact = {lang: np.unique(np.concatenate(parts)) for lang, parts in exact.items()}
    assert sorted(filters.langs) == sorted(exact)
    # every n-gram seen is in its language's filter, and others as often as the measured rate says
    strange = np.random.default_rng(1).integers(0, 1 << 63, 200_000, dtype=np.uint64)
    wrong = filters._masks(strange)
    for i, lang in enumerate(filters.langs):
        assert (filters._masks(exact[lang])[:, 0] >> np.uint64(i) & np.uint64(1)).all()
        rate = (wrong[:, 0] >> np.uint64(i) & np.uint64(1)).mean()
        assert abs(rate - filters.wrong[i]) < 0.01 and rate < 0.1
    # the corrected counts decide as the exact sets do
    agreed = total = 0
    for r in docs.where(part == 0).collect():
        codes = language.grams(r["text"] or "")
        if codes is None:
            assert filters.predict(r["text"]) == ("und", 0.0)
            continue
        true = np.array([np.isin(codes, exact[lang]).sum() for lang in filters.langs])
        assert np.abs(filters.counts(codes) - true).max() <= 0.1 * len(codes) + 5
        total += 1
        agreed += filters.predict(r["text"])[0] == filters.langs[int(np.argmax(true))]
    assert agreed >= 0.98 * total


def test_bloom_masks():
    members = {f"l{i:03d}": np.arange(i * 1000, i * 1000 + 500, dtype=np.uint64) for i in range(70)}
    f = language.Filters.build(sorted(members), members)
    for i in (0, 3, 63, 64, 69):
        c = f.counts(members[f"l{i:03d}"])
        assert int(np.argmax(c)) == i and abs(c[i] - 500) < 1


def test_license_variants():
    known = tuple(sorted(license_scan.TEMPLATES.items()))
    assert license_scan.scan_block("This work is licensed under the GNU General Public License, version 3.", known)[0] == "GPL-3.0"
    hit = license_scan.scan_block("// This file is licensed under the GNU General Public License, version 3.", known)
    assert hit[0] == "GPL-3.0" and (hit[3], hit[4]) == (1, 1) and hit[5] == "-work; +file"
    assert license_scan.scan_block("He lost his driving licence.", known) is None
    for name, text in license_scan.TEMPLATES.items():
        assert license_scan.scan_block(text, known)[0] == name
    long = "word " * 500 + license_scan.TEMPLATES["MIT"] + " word" * 500
    assert [license_scan.scan_block(b, known)[0] for _, b in license_scan.blocks(long)] == ["MIT"]


def test_license_scan_finds_all_lines(docs, texts):
    got = {(r["doc_id"], r["line"]): r["license"] for r in license_scan.scan(docs).collect()}
    want = {
        (d, i): name
        for d, t in texts.items()
        for i, line in enumerate((t or "").split("\n"))
        for name, template in license_scan.TEMPLATES.items()
        if line == template
    }
    assert want and want.items() <= got.items()


def test_license_over_lines_headers_tags_and_full_texts():
    known = tuple(sorted([*license_scan.TEMPLATES.items(), *license_texts.texts()]))

    def names(text):
        return [(hit[0], hit[1]) for hit in license_scan.scan_text(text, known)]

    assert names("Some prose.\nLicensed under the Apache License,\nVersion 2.0") == [(1, "Apache-2.0")]
    assert names("x = 1\n# SPDX-License-Identifier: MIT\n") == [(1, "MIT")]
    assert names("SPDX-License-Identifier: (MIT OR GPL-2.0-only)\ny = 2 or MIT") == [(0, "MIT"), (0, "GPL-2.0")]
    prose = "A line of prose about nothing at all.\n" * 300
    for name, text in license_texts.texts():
        assert names(text)[0][1] == name
    for name in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-3.0"):
        text = max((t for n, t in license_texts.texts() if n == name), key=len)
        wrapped = "".join(f" * {line}\n" for line in text.splitlines())
        assert names(prose + "MIT-like\nCopyright (c) 2020 A. Person\n" + wrapped + prose)[0][1] == name
    own = " ".join(f"term{i}" for i in range(150)) + " of this license. " + " ".join(f"rule{i}" for i in range(150))
    text = prose + own.replace("term7 ", "other ").replace(" rule40", "\nrule40") + "\n" + prose
    assert [h[:2] + h[4:] for h in license_scan.scan_text(text, (("own", own),))] == [(300, "own", 1, 1, "-term7; +other")]


def test_short_forms():
    known = tuple(sorted([*license_scan.TEMPLATES.items(), *license_texts.texts()]))
    for name, text in license_texts.SHORT:
        for line in (text, f"The code is {text} (c) 2020", f"x\n* {text}\ny"):
            assert [hit[1] for hit in license_scan.scan_text(line, known)] == [name], line
    for line in ("He is licensed to drive.", "A MIT student licensed it.", "Apache helicopters need no license."):
        assert license_scan.scan_text(line, known) == []


def test_winner_has_the_best_size_reduction_of_all_confirmed_templates():
    """Every template at every place of small texts, against the scan."""
    known = tuple(sorted(license_scan.TEMPLATES.items()))
    plain, each = license_scan._compressors(known)
    rng = random.Random(2)
    for _ in range(300):
        words = rng.choice(known)[1].split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = rng.choice(["other", "License", "version", "3.", "GNU"])
        line = " ".join(words)
        raw = line.encode()
        base = len(plain.compress(raw))
        have, fitting = license_scan._template_words(line), {}
        for i, (name, text) in enumerate(known):
            want = license_scan._template_words(text)
            common = [0] * (len(have) + 1)  # longest common subsequence
            for x in want:
                common = [0, *itertools.accumulate(
                    (common[j] + (have[j] == x) if have[j] == x else common[j + 1] for j in range(len(have))), max
                )]
            less = base - len(each[i].compress(raw))
            told = want == have[: len(want)] if len(want) < license_scan.UNBROKEN else len(want) - common[-1] <= 0.2 * len(want) + 1e-9
            if license_scan.CUES.search(line) and told and less > 0:
                fitting[name] = less
        hits = license_scan.scan_text(line, known)
        assert len(hits) == bool(fitting), line
        if fitting:
            assert fitting[hits[0][1]] == max(fitting.values()), (line, hits, fitting)


def test_every_license_of_a_block():
    known = tuple(sorted(license_scan.TEMPLATES.items()))

    def names(text, known=known):
        return [hit[1] for hit in license_scan.scan_text(text, known)]

    both = "Released under the MIT License. Licensed under the Apache License, Version 2.0."
    assert names(both) == ["MIT", "Apache-2.0"]
    assert names("word " * 200 + both + " word" * 200) == ["MIT", "Apache-2.0"]
    assert names(both + " " + both) == ["MIT", "Apache-2.0"] * 2
    # more than four near-equal templates
    near = tuple((f"L{i}", f"This work is licensed under the Common License of the group, edition {i}.") for i in range(30))
    for name, text in near:
        assert names(text, near) == [name]
    # one word of five changed is 80 %
    hit = license_scan.scan_block("Licensed under the MIT License", known)
    assert (hit[0], hit[3], hit[4], hit[5]) == ("MIT", 1, 0, "-released")
