"""The pointer sort and the audit against plain versions."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessel.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return [w.translate({k: k + 32 for k in range(65, 91)}) for w in TERM.findall(text or "")]


def texts(rng, n):
    stems = ["a", "ab", "abcdefgh", "abcdefghi", "abcdefgh" * 9, "abcdefgh" * 9 + "x", "É", "É" * 4, "É" * 5, "Zz", "🙂", "x" * 300, "x" * 301]
    return ["".join(rng.choice(stems) + rng.choice([" ", "-", "\n", "", "7"]) for _ in range(rng.randrange(30))) for _ in range(n)]


def brute(rows, least, top):
    """rows: (lang, source, text)."""
    docs, count, out = Counter(), Counter(), []
    for lang, source, text in rows:
        w = words(text)
        docs.update({(lang or "", t) for t in w})
        count.update((lang or "", source or "", t) for t in w)
    groups = sorted({(lang or "", source or "") for lang, source, _ in rows})
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), n in docs.items() if x == lang and n >= least)
        own = [s for x, s in groups if x == lang]
        total = {t: sum(count[lang, s, t] for s in own) for t in kept}

        def p(of):
            n = sum(of.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (of[t] + 5) // n for t in kept}

        q, each = p(total), {s: p({t: count[lang, s, t] for t in kept}) for s in own}
        for s in own:
            pair = [(sum(abs(each[s][t] - each[o][t]) for t in kept), o) for o in own if o != s]
            apart = [(each[s][t] - q[t], t) for t in kept if count[lang, s, t] and each[s][t] > q[t]]
            for part, items, most in (("pair", pair, len(pair)), ("term", apart, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(items[:most], 1)]
    return sorted(out)


def test_runs():
    rng = random.Random(1)
    some = texts(rng, 60)
    group = np.array([rng.randrange(4) for _ in some])
    body = "".join(some).encode()
    bounds = np.cumsum([0, *[len(t.encode()) for t in some]])
    got_terms, got_group, docs, count = divergence.runs(np.frombuffer(body, np.uint8), bounds, group)
    want_docs, want_count = Counter(), Counter()
    for t, g in zip(some, group.tolist(), strict=True):
        want_docs.update({(w, g) for w in words(t)})
        want_count.update((w, g) for w in words(t))
    keys = list(zip(got_terms.to_pylist(), got_group.tolist(), strict=True))
    assert dict(zip(keys, docs.tolist(), strict=True)) == want_docs and dict(zip(keys, count.tolist(), strict=True)) == want_count
    assert [k[0].encode() for k in keys] == sorted(k[0].encode() for k in keys)


@pytest.mark.parametrize("shard", [1, 50, 1000])
def test_shards_of_any_size(monkeypatch, shard):
    monkeypatch.setattr(divergence, "SHARD", shard)
    some = texts(random.Random(2), 40)
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * 40), pa.array(["s", "t"] * 20), pa.array(some)], ["lang", "source", "text"])
    docs, count = Counter(), Counter()
    for s in divergence.shards(iter([batch.slice(0, 13), batch.slice(13), batch.slice(0, 0)])):
        for b in divergence.shard_rows(s):
            for r in b.to_pylist():
                docs[r["source"], r["term"]] += r["docs"]
                count[r["source"], r["term"]] += r["count"]
    want = Counter((s, w) for s, t in zip("st" * 20, some, strict=True) for w in set(words(t)))
    assert docs == want
    assert count == Counter((s, w) for s, t in zip("st" * 20, some, strict=True) for w in words(t))


@pytest.mark.parametrize(("block", "terms", "entries"), [(512, 2048, 1 << 21), (2, 5, 8)])
def test_audit(spark, monkeypatch, block, terms, entries):
    for name, value in (("BLOCK", block), ("TERMS", terms), ("ENTRIES", entries)):
        monkeypatch.setattr(divergence, name, value)
    rng = random.Random(4)
    rows = [(rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", "d", "É", None]), t) for t in [*texts(rng, 150), None, "", "12 34"]]
    rows += [("fr", "lone", "seldom"), ("fr", None, None), ("it", "one", "x")]
    df = spark.createDataFrame([(k, *r, "extra") for k, r in enumerate(rows)], "doc_id int, lang string, source string, text string, value string").repartition(5)
    got = divergence.audit(df, least=20, top=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 4)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    n, v, c = 3 * 10**18 + 7, 10**6, 2 * 10**18 + 1
    row = spark.createDataFrame([(c, n, v), (c, n, 0)], "c long, n long, v long").select(divergence.scaled(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()
    assert [r.p for r in row] == [1 + 10**9 * (c + 5) // (n + 5 * v), None]
