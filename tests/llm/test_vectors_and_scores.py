"""Vector search, the preference ranker and the pipeline."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basetide.llm import preference, quality_rules, segment_search, simhash, suffix_dedup

SF = "/root/testdata/sf0.001"


def brute_top(cands, queries, k):
    out = []
    for qi, q in queries:
        rows = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in cands if i != qi and len(v) == len(q))
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(rows[:k])]
    return sorted(out)


@pytest.mark.parametrize("dim,tile,qtile,big", [(8, 16, 4, 200), (5, 7, 3, 2), (64, 50, 100, 1 << 27), (1, 9, 2, 3)])
def test_top_k(spark, dim, tile, qtile, big):
    rng = random.Random(dim)
    rows = [(i, [rng.randrange(-big, big) for _ in range(dim)]) for i in range(120)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, [0] * dim), (203, [1] * (dim + 1)), (204, [1] * (dim + 1))]
    data = [*rows, (None, rows[0][1]), (300, None)]
    df = spark.createDataFrame(data, "id long, v array<long>").repartition(3)
    got = segment_search.top_k(df, df.where("id % 10 = 0 or id = 203"), 5, candidate_tile=tile, query_tile=qtile)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, [r for r in rows if r[0] % 10 == 0 or r[0] == 203], 5)


def test_top_k_without_broadcast_and_with_few_rows(spark, monkeypatch):
    monkeypatch.setattr(segment_search, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(segment_search, "KEPT_TILES", 1)
    rows = [(i, [i, -i, i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = segment_search.top_k(df, df, 3, candidate_tile=4, query_tile=4).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, rows, 3)
    two = df.where("id < 2")
    assert len(segment_search.top_k(two, two, 5).collect()) == 2
    assert segment_search.top_k(df.limit(0), df, 5).count() == 0 and segment_search.top_k(df, df.limit(0), 5).count() == 0


def test_bounds_hold_at_every_resolution():
    rng = np.random.default_rng(1)
    q, x = rng.normal(size=(20, 30)), rng.normal(size=(50, 30)) + 1
    exact = ((q[:, None] - x[None]) ** 2).sum(axis=2)
    before = -1.0
    for n in (1, 4, 16, 30):
        a, b = segment_search.statistics(q, n), segment_search.statistics(x, n)
        lower = ((a[:, None] - b[None]) ** 2).sum(axis=2)
        assert (lower <= exact + 1e-9).all() and lower.mean() > before
        before = lower.mean()
    assert np.allclose(lower, exact)


def test_scaled(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([([0.5, -0.001],), ([1.0, nan],), ([inf],), ([1.0, None],), (None,), ([],)], "v array<float>")
    assert [r.v for r in df.select(segment_search.scaled(F.col("v")).alias("v")).collect()] == [[128, -1], None, None, None, None, []]


def test_ranker_prefers_and_is_calibrated():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, len(preference.FEATURES)))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 1)))).astype(int)
    r = preference.fit(x, y, y.mean())
    s = r.score(x)
    assert s[y == 1].mean() > s[y == 0].mean() + 0.2
    for lo in (0.2, 0.5, 0.8):
        some = abs(s - lo) < 0.1
        assert abs(y[some].mean() - lo) < 0.12
    assert math.isclose((s[y == 1] < r.threshold(0.1)).mean(), 0.1, abs_tol=0.01)


def test_ranker_without_both_labels():
    x = np.ones((5, len(preference.FEATURES)))
    assert preference.fit(x, np.ones(5, int), 0.9).score(x)[0] > 0.9
    assert preference.fit(x, np.zeros(5, int), 0.1).score(x)[0] < 0.1
    assert preference.fit(x[:0], np.zeros(0, int), 0.5).score(x)[0] == 0.5


def test_preference_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    ranker = preference.train(docs, labels, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    scored = preference.score_documents(docs.select("doc_id", "text"), ranker).join(labels, "doc_id")
    held = [r for r in scored.collect() if __import__("zlib").crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum((r.score >= 0.3) == (r.quality == 1) for r in held) / len(held) > 0.97


def test_preference_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.1), (2, "good text here", 0.1), (None, "x", None)],
                                 "doc_id long, text string, other double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, 7), (9, None)], "doc_id long, quality int")
    got = preference.score_documents(docs, preference.train(docs, labels)).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    none = preference.train(docs, labels.limit(0))
    assert {r.score for r in preference.score_documents(docs, none).collect()} == {0.5}
    assert preference.score_documents(docs.limit(0), none).count() == 0


def test_pipeline_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    long = docs.where("length(text) > 600").orderBy("doc_id").first().text
    odd = [(None, None, "en", "s", 0), (5000, "", "en", "s", 0), (5001, None, None, None, None), (None, long, "en", "s", 1),
           (5002, long + " one more", "en", "s", 1), (5002, long + " one more", "en", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    for k, c in enumerate(("id", "_id", "_h", "_score", "score", "_q_kept", "kept", "n", "name", "key")):  # names the stages use
        docs = docs.withColumn(c, F.lit(k))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        kept = stage(spark, docs, SF)
        before, rows = docs.collect(), kept.collect()
        if k < 4:
            assert kept.columns == docs.columns, name
        if name == "quality_rules":
            want = {r.doc_id for r in quality_rules.quality_rules(docs, prefix="t_").where("t_kept").collect()}
            assert {r.doc_id for r in rows} == want and 5000 not in want
        if name == "quality_classifier":
            bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
            assert {r.doc_id for r in before} - {r.doc_id for r in rows} <= bad
        if name == "near_dedup":
            sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (r.text.lower().split() for r in before)]
            root = list(range(len(before)))
            for i, x in enumerate(sets):
                for j, y in enumerate(sets[:i]):
                    if 5 * len(x & y) >= 4 * len(x | y):
                        old, new = root[i], root[j]
                        root = [new if r == old else r for r in root]
            groups = {}
            for r, row in zip(root, before):
                groups.setdefault(r, []).append(row.doc_id)
            want = [min((i for i in g if i is not None), default=None) for g in groups.values()]
            assert sorted(r.doc_id or -1 for r in rows) == sorted(i or -1 for i in want) and len(rows) < len(before)
        if name == "suffix_array_dedup":
            assert sum(len(r.text) for r in rows) <= sum(len(r.text) for r in before)
            again = suffix_dedup.dedup_digest(docs).agg(F.sum("n_removed")).first()[0]
            assert again >= sum(len(r.text.encode()) for r in before) - sum(len(r.text.encode()) for r in rows)
            assert all(r.n_chars == len(r.text) for r in rows)
        if name == "packing":
            assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
        docs = kept if k == 4 else spark.createDataFrame(rows, kept.schema)


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
