"""Katz counts where the layout has many hot words and pairs, against brute force."""

import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tessel.llm import katz


def brute(docs):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of (doc_id, held_out, text)."""
    texts = [(i, held, [*t.encode().lower().split(), b""]) for i, held, t in docs]
    c1, c2, seen = Counter(), Counter(), defaultdict(list)
    for _, held, t in texts:
        if not held:
            c1.update(t)
            c2.update(zip([b" ", *t[:-1]], t, strict=True))
    for (h, w), c in c2.items():
        seen[h].append((w, c))
    n, v = sum(c1.values()), len(c1)
    d1, d2 = (katz.discounts(np.array([sum(x == k for x in c.values()) for k in range(1, 7)])) for c in (c1, c2))
    kept = lambda c, d: c - katz.KEEP_BACK if c > katz.K else d[c]
    p = {w: kept(c, d1) / n for w, c in c1.items()}
    unknown = 1 - sum(p.values())
    total = {h: sum(c for _, c in x) for h, x in seen.items()}
    back = {h: (1 - sum(kept(c, d2) for _, c in x) / total[h]) / (1 - sum(p[w] for w, _ in x)) for h, x in seen.items()}
    prob = lambda h, w: kept(c2[h, w], d2) / total[h] if c2[h, w] else back.get(h, 1) * p.get(w, unknown)
    for i, held, t in texts:
        base = sum(math.log10((c1[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        yield i, held, len(t), sum(c1[w] > 0 for w in t), n, base, sum(math.log10(prob(h, w)) for h, w in zip([b" ", *t[:-1]], t, strict=True))


def same(spark, docs, slices):
    df = spark.createDataFrame(docs, "doc_id long, held boolean, text string").repartition(slices, "doc_id")
    got = sorted(katz.score(df, F.col("held")).collect())
    want = sorted(brute(docs))
    assert [tuple(r)[:5] for r in got] == [w[:5] for w in want]
    assert np.allclose([r[5:] for r in got], [w[5:] for w in want], atol=1e-4)


def test_more_than_128_equally_frequent_words(spark):
    """160 words and as many pairs make up 0.6% each of any sample, so all of them are hot."""
    words = [f"w{k}" for k in range(160)]
    docs = [(i, i % 10 == 0, " ".join(words)) for i in range(200)]
    docs += [(1000 + i, i % 2 == 0, f"w{i} w{i + 2} new{i} w{i}") for i in range(100)]
    same(spark, docs, 8)


def has(layout, word):
    return katz.member(layout.words, katz.hashes(word.encode()))[0] >= 0


def test_hot_words_of_an_ordered_table(spark):
    """The frequent words of the last partitions are found too."""
    df = spark.range(0, 120_000, 1, 8).select(F.when(F.col("id") < 90_000, "the cat").otherwise("le chat").alias("text"))
    layout = katz.hot(df, 8)
    assert all(has(layout, w) for w in ("the", "cat", "le", "chat"))


def test_hot_share_follows_the_partitions(spark):
    """A word of 0.2% is small for 8 partitions, and twice the mean of 1000."""
    docs = [(" ".join([*(f"w{i}x{k}" for k in range(48)), "often" if i % 10 == 0 else "seldom%d" % i]),) for i in range(8000)]
    df = spark.createDataFrame(docs, "text string").repartition(8, "text")
    assert not has(katz.hot(df, 8), "often")
    assert has(katz.hot(df, 1000), "often")


def test_long_lists_of_hot_words(spark, monkeypatch):
    """Most words and pairs of the sample are split, of few partitions too."""
    monkeypatch.setattr(katz, "HOT_SHARE", 1e-4)
    docs = [(i, i % 7 == 0, " ".join(f"w{(i * k + k * k) % 211}" for k in range(i % 40))) for i in range(400)]
    same(spark, docs, 6)
