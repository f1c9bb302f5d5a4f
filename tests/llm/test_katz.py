"""The language model against a plain one, and its sums."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basetide.llm import katz


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def plain(rows, train, cutoff):
    """Scores by a model held in dictionaries."""
    uni, pairs = Counter(), Counter()
    for (_, t), use in zip(rows, train):
        if use:
            ws = tokens(t)
            uni.update(ws)
            pairs.update(zip(["<s>", *ws[:-1]], ws))
    n, v = sum(uni.values()), len(uni)
    p1 = lambda w: (uni[w] + 1) / (n + v + 1)
    d = katz.discounts(np.array([sum(c == r for c in pairs.values()) for r in range(1, cutoff + 2)]), cutoff)
    after = {}
    for (h, w), c in pairs.items():
        after.setdefault(h, {})[w] = c

    def p2(h, w):
        seen = after.get(h)
        if not seen:
            return p1(w)
        ch = sum(seen.values())
        left = sum((1 - d[c - 1]) * c for c in seen.values() if c <= cutoff)
        room = left if left > 0 else 1.0
        denom = ch if left > 0 else ch + 1
        if w in seen:
            c = seen[w]
            return (d[c - 1] if c <= cutoff else 1.0) * c / denom
        return room / denom / (1 - sum(map(p1, seen))) * p1(w)

    for h in [*after, "never"]:  # exactly normalised over the vocabulary and one unknown word
        assert math.isclose(sum(p2(h, w) for w in [*uni, b"?"]), 1.0, rel_tol=1e-9)
    out = []
    for (i, t), use in zip(rows, train):
        ws = tokens(t)
        out.append((i, use, len(ws), sum(uni[w] > 0 for w in ws), n, sum(math.log10(p1(w)) for w in ws),
                    sum(math.log10(p2(h, w)) for h, w in zip(["<s>", *ws[:-1]], ws))))
    return out


def some_rows(n=60):
    rng = random.Random(5)
    words = ["the", "The", "of", "naïve", "x"] + [f"w{i}" for i in range(40)]
    weights = [40, 10, 20, 5, 5] + [40 / (i + 1) for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(0, 80)))) for i in range(n)]
    return [*rows, (n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, rows[3][1]), (3, rows[3][1]), (None, "the x"), (n + 4, "brand new")]


@pytest.mark.parametrize("batch,bucket,hot", [(1 << 20, 1 << 20, 1 << 20), (700, 500, 20)])
def test_scores(spark, batch, bucket, hot, monkeypatch):
    monkeypatch.setattr(katz, "HOT_SHARE", 10 ** 9)
    rows = some_rows()
    train = [i is not None and i % 7 != 2 for i, _ in rows]
    docs = spark.createDataFrame([(i, t, 1.0, "c") for i, t in rows], "doc_id long, text string, score double, word string").repartition(4)
    got = katz.score(docs, F.col("doc_id") % 7 != 2, 5, batch_bytes=batch, bucket_bytes=bucket, hot_tokens=hot).collect()
    want = plain(rows, train, 5)
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9), (g, w)


def test_no_training_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.id: r for r in katz.score(docs, F.lit(False)).collect()}
    assert got[1].n_known == 0 and got[1].score == got[1].base_score == 0.0 and got[2].n_tokens == 1
    assert katz.score(docs.limit(0), F.lit(True)).count() == 0


def test_word_hashes():
    text = "The  quick\tÜber\nx " + "y" * 50
    assert katz.word_hashes(b"the quick \xc3\x9cber x " + b"y" * 50).tolist() == katz.word_hashes(text.encode()).tolist()
    words = [str(i).encode() for i in range(200_000)]
    assert len(set(katz.word_hashes(b" ".join(words)).tolist())) == len(words)
    long = b"z" * (katz._STEP + 5)
    assert katz.word_hashes(b"a " + long + b" a " + long)[[0, 1]].tolist() == katz.word_hashes(b"a " + long + b" a " + long)[[2, 3]].tolist()
    assert len(katz.word_hashes(b" \n")) == 0
