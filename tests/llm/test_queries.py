"""Every registered query against SQL or a brute-force version, on the awkward corpus and on empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from scripts.oracle_check import compare
from tokenizers import Tokenizer

import corpus_pipeline
from tessel.llm import ann, arrowtokens, mixing, secrets, ssjoin, toxicity, urlfilter
from tessel.llm.oracle import ORACLE
from tessel.llm.queries import QUERIES, VOCABULARY

from . import test_katz as test_katz_layout
from .conftest import corpus
from .test_secrets_ledger import brute as marked

LIBRARY = Tokenizer.from_file(VOCABULARY)


def rows(spark, name, sf):
    return QUERIES[name](spark, sf).collect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    df = QUERIES[name](spark, empty)
    assert df.columns and df.collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    columns, want = duck(ORACLE[name], **corpus())
    assert compare(df.columns, [tuple(r) for r in df.collect()], columns, want) == []


def test_toxicity(spark, small):
    got = {r.doc_id: r for r in rows(spark, "op1_toxicity", small)}
    t = corpus()
    toxic = dict(zip(t["labels"]["doc_id"].to_pylist(), t["labels"]["toxic"].to_pylist(), strict=True))
    held = [i for i in range(1, 120) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out for i in held) and sum(r.held_out for r in got.values() if r.doc_id is not None and r.doc_id < 120) >= len(held)
    assert len(rows(spark, "op1_toxicity", small)) == t["documents"].num_rows
    assert np.mean([got[i].predicted == toxic[i] for i in held]) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_katz(spark, small, docs):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    order = lambda r: (str(r[:5]), round(r[5], 2), round(r[6], 2))
    want = sorted(test_katz_layout.brute([(i, held(i), t or "") for i, t in docs]), key=order)
    got = sorted(map(tuple, rows(spark, "op3_katz", small)), key=order)
    assert [r[:5] for r in got] == [w[:5] for w in want]
    assert np.allclose([r[5:] for r in got], [w[5:] for w in want], atol=1e-4)


def test_ann(spark, small):
    t = corpus()["embeddings"]
    ok = {(i, tuple(v)) for i, v in zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist(), strict=True) if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    got = defaultdict(list)
    for r in rows(spark, "op6_ann", small):
        got[r.query_id].append((r["rank"], r.score, r.vec_id))
    queries = [(i, v) for i, v in ok if i % 100 == 0]
    assert set(got) == {i for i, _ in queries}
    for i, v in queries:
        near = sorted((math.dist(v, x), k) for k, x in ok if k != i and len(x) == len(v))[:10]
        assert [(r, k) for r, _, k in sorted(got[i])] == [(r, k) for r, (_, k) in enumerate(near, 1)]
        assert np.allclose([s for _, s, _ in sorted(got[i])], [d for d, _ in near])


def test_ann_beyond_the_scan(spark):
    """Clusters of over ``scan`` rows in all, so that most cells are never read."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 4
    x = (centres[rng.integers(0, 40, 5000)] + rng.normal(size=(5000, 16))).astype(float)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(dict)
    for r in ann.search(df, ann.F.col("id") % 50 == 0, s=ann.Search(scan=400, cell=64)).collect():
        got[r.query_id][r.id] = r.score
    hits = 0
    for q in range(0, 5000, 50):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        near = np.argsort(d)[:10]
        assert len(got[q]) == 10 and all(abs(s - d[k]) < 1e-9 for k, s in got[q].items())
        hits += len(set(near.tolist()) & set(got[q]))
    assert len(got) == 100 and hits >= 0.9 * 1000


def test_bpe_as_the_library(spark, small, docs):
    want = Counter()
    for i, t in docs:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, rows(spark, "op8_bpe", small))) == want


def test_arrow_files(spark, small, docs):
    got = sorted(rows(spark, "op9_arrow", small), key=lambda r: r.start)
    size = lambda t: [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0]
    want = Counter((i, len(x := size(t)), zlib.crc32(np.array(x, "<u4").tobytes())) for i, t in docs)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    keys = [(-1 if r.doc_id is None else r.doc_id) for r in got]
    assert keys == sorted(keys)
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])


def test_arrow_chunks_as_the_library():
    """Texts of all kinds of white space, added tokens and letters whose bytes look like parts of white space."""
    draw = random.Random(1)
    lib = arrowtokens.library(VOCABULARY)
    signs = ["Queas", "ñandú,", "é.", "a_b", *" \t\n\x0b\r\x85\xa0\u1680\u2003\u2028\u3000\u200bab'sé\xe0Z0.,漢\u0100\x1c\x00\u1021", " ", " ", *lib.added]
    texts = ["", *["".join(draw.choices(signs, k=draw.randrange(40))) for _ in range(3000)]]
    got = lib.encode(pa.array(["aside", *texts]).slice(1))
    assert [np.frombuffer(x, lib.code).tolist() for x in got] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert lib.encode(pa.array([], pa.string())) == []


def test_arrow_store_stays_small(monkeypatch):
    monkeypatch.setattr(arrowtokens, "KEEP", 50)
    draw, lib = random.Random(2), arrowtokens.Library(VOCABULARY)
    texts = [" ".join("w%d" % draw.randrange(300) + "x" * draw.choice([0, 90]) for _ in range(30)) for _ in range(60)]
    for k in range(0, 60, 7):
        some = texts[k : k + 7]
        assert [np.frombuffer(x, lib.code).tolist() for x in lib.encode(pa.array(some))] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in some]
        assert len(lib.seen) <= 50 + 7 * 30  # what was kept, and a slice's own


def test_arrow_folders(tmp_path):
    assert arrowtokens.place(str(tmp_path))[1] == str(tmp_path) and arrowtokens.place(f"file://{tmp_path}")[1] == str(tmp_path)
    assert arrowtokens.place("s3a://bucket/folder?region=us-east-1")[1] == "bucket/folder"
    with pytest.raises(ValueError, match="s3a"):
        arrowtokens.place("wasb://store/in")


def groups(texts, k, num, den):
    """Brute force: root of each text; None without words."""
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * both >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) if s else None for x, s in enumerate(sets)], [len(s) for s in sets]


def test_jaccard(spark, small, docs):
    root, size = groups([t for _, t in docs], 4, 85, 100)
    least = defaultdict(list)
    for (i, _), r in zip(docs, root, strict=True):
        if i is not None:
            least[r].append(i)
    want = Counter((i, n, i if r is None else min(least[r], default=None)) for (i, _), r, n in zip(docs, root, size, strict=True))
    assert Counter(map(tuple, rows(spark, "op10_jaccard", small))) == want


@pytest.mark.parametrize("num", [80, 85, 90])
def test_linked_sets_share_a_signature(num):
    j, rng = ssjoin.Jaccard(4, num, 100, 10), np.random.default_rng(num)
    linked = 0
    for n in [*range(1, 40), 100, 300, 900]:
        for _ in range(12):
            u = np.unique(rng.integers(0, 2**64 - 1, n, dtype=np.uint64))
            gone, more = rng.integers(0, max(1, n * (100 - num) // 100) + 1, 2)
            v = np.unique(np.concatenate([rng.permutation(u)[gone:], rng.integers(0, 2**64 - 1, more, dtype=np.uint64)]))
            if v.size and j.linked(u, v) and not np.array_equal(u, v):
                linked += 1
                assert np.intersect1d(j.signatures(u), j.signatures(v)).size
                size = min(len(ssjoin.outline(u)), len(ssjoin.outline(v)))
                differ = np.count_nonzero(ssjoin.folded(ssjoin.outline(u), size) != ssjoin.folded(ssjoin.outline(v), size))
                assert differ <= (j.den - j.num) * (u.size + v.size) // (j.den + j.num)
    assert linked > 100


def test_mixing_is_near_its_targets(spark, small):
    got = rows(spark, "op2_mixing", small)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, rows(spark, "op2_mixing", small)), key=str)
    sources, text = defaultdict(list), corpus()["documents"]
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        sources[r.source_size, r.target].append(r)
    assert abs(sum(t for _, t in sources) - 1.5 * sum(r.size for r in got)) < 1
    for (size, target), x in sources.items():
        assert target <= 2 * size and abs(sum(r.taken for r in x) - target) <= max(8, 0.05 * target)
    assert len(got) == text.num_rows


def test_pipeline(spark, small, duck):
    """Stage by stage against SQL and brute force."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    by_row = lambda df: Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
    kept = corpus_pipeline.settle(corpus_pipeline.rules(spark, docs, small), "test")
    names, want = duck(ORACLE["op7_quality"], **corpus())
    assert sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str) == sorted((w[0] for w in want if w[names.index("kept")]), key=str)

    table = kept.select("doc_id", "text").collect()
    root, _ = groups([r.text for r in table], 5, 80, 100)
    one = corpus_pipeline.settle(corpus_pipeline.near_duplicates(spark, kept, small), "test")
    firsts = {}
    for r, g in zip(table, root, strict=True):
        if g is not None:
            firsts[g] = min(firsts.get(g, (True, 0)), (r.doc_id is None, r.doc_id or 0))
    got = one.select("doc_id").collect()
    assert one.columns == columns
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in got)) == sorted(firsts.values())

    clean = corpus_pipeline.settle(corpus_pipeline.redacted(spark, one, small), "test")
    assert clean.columns == columns
    before, after = by_row(one), by_row(clean)
    assert sum(before.values()) == sum(after.values())
    for (i, t), _ in (before - after).items():
        new = next(x for (k, x) in after if k == i)
        assert "[SECRET]" in new and "[SECRET]" not in t
    assert after == Counter((i, t and marked(t, secrets.RULES)[1]) for i, t in before.elements())

    mixed = corpus_pipeline.settle(corpus_pipeline.mixed(spark, clean, small), "test")
    assert mixed.columns == columns
    names, plan = duck(ORACLE["op2_mixing"], documents=clean.select("doc_id", "text", "source").toArrow())
    taken = Counter()
    for p in plan:
        taken[p[names.index("doc_id")]] += p[names.index("taken")]
    words = Counter()
    for r in mixed.select("doc_id", "text", "n_chars").collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert +words == +taken

    final = corpus_pipeline.encoded(spark, mixed, small)
    want = Counter((r.doc_id, len(LIBRARY.encode(r.text, add_special_tokens=False).ids)) for r in mixed.select("doc_id", "text").collect())
    assert Counter((r.doc_id, r.n_tokens) for r in final.collect()) == want


def _mixed(spark, texts):
    """texts: source -> texts; (taken, target) of each source, at the query's parameters, with a third of the ids null."""
    made = [(None if k % 3 == 0 else k, s, t) for s, x in texts.items() for k, t in enumerate(x)]
    df = spark.createDataFrame(made, "doc_id long, source string, text string").repartition(4)
    size = mixing.F.size(mixing.words(mixing.whole("text"))).cast("long")
    rows = mixing.mix(df, df.doc_id, df.source, size, mixing.F.md5("text"))
    got = rows.select("row.source", "plan.*").groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    return {r.source: (r["sum(taken)"], r["max(target)"]) for r in got}


@pytest.mark.parametrize("kind", ["one word", "two words beside", "long", "mixed", "tiny"])
def test_mixing_takes_its_target(spark, kind):
    draw = random.Random(9)
    say = lambda n: " ".join("w%d" % draw.randrange(10**6) for _ in range(n))
    texts = {
        "one word": {"a": [say(1) for _ in range(20_000)]},
        "two words beside": {"a": [say(1) for _ in range(4000)], "b": [say(2) for _ in range(4000)], "c": [say(2) for _ in range(4000)]},
        "long": {"a": [say(20_000) for _ in range(8)], "b": [say(1) for _ in range(3000)], "c": [say(300) for _ in range(100)]},
        "mixed": {s: [say(draw.choice([0, 1, 5, 80, 900])) for _ in range(400 * k)] for k, s in enumerate("abcd", 1)},
        "tiny": {"a": [say(1)], "b": [say(2), ""], "c": [""], "d": [say(50) for _ in range(200)]},
    }[kind]
    for taken, target in _mixed(spark, texts).values():
        assert abs(taken - target) <= max(1, 0.02 * target)


def test_mixing_shards_of_rows_without_an_id(spark):
    texts = ["w%d v%d" % (k, k % 7) for k in range(20_000)]
    df = spark.createDataFrame([(None if k % 3 == 0 else k, "a", t) for k, t in enumerate(texts)], "doc_id long, source string, text string")
    digest = mixing._digest(mixing.F.lit("mix"), df.doc_id, mixing.F.md5("text"))
    sizes = [r["count"] for r in df.groupBy(mixing.F.pmod(mixing._number(digest), mixing.F.lit(100))).count().collect()]
    assert len(sizes) == 100 and max(sizes) <= 2 * 20_000 / 100


@pytest.mark.parametrize("n", [100, 400])
def test_rows_without_an_id_meet_their_own_class_alone(spark, n):
    draw = random.Random(n)
    base = ["w%d" % k for k in range(60)]
    texts = [" ".join([*base[: (at := draw.randrange(60))], "x%d" % k, *base[at + 1 :]]) for k in range(n)] * 2
    rows = [(None if k % 3 == 0 else k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", mixing.F.xxhash64("text"))
    j = ssjoin.Jaccard(4, 85, 100)
    classes = ssjoin.sets(docs, j)
    read = ssjoin.named(docs, classes, classes.select("key").distinct()).groupBy("key").count().collect()
    assert len(read) == n and sum(r["count"] for r in read) <= 2 * n
    root, _ = groups(texts[:n], 4, 85, 100)
    got = ssjoin.join(docs.select("doc_id", "text"), j)
    assert got.select("component_id").distinct().count() == len(set(root))


def test_urls_of_any_depth(spark):
    """Branches that part only at the eighth segment, and a path of thousands of segments."""
    deep = "/a/b/c/d/e/f/g"
    rows = [("h.org", f"{deep}/{side}/{k % 3}", side == "bad") for side in ("bad", "good") for k in range(9)]
    rows += [("j.org", "/" + "/".join(f"s{k}" for k in range(3000)), None), ("h.org", deep, None), ("i.org", "", None)]
    got = {r.path: r for r in urlfilter.judged(spark.createDataFrame(rows, "host string, path string, bad boolean")).collect()}
    assert len(got) == 9
    assert {r.verdict for p, r in got.items() if "/bad/" in p} == {"block"} and {r.verdict for p, r in got.items() if "/good/" in p} == {"allow"}
    assert got[rows[18][1]].tpl == rows[18][1] and got[deep].tpl == deep


def test_single_paths_as_level_by_level(spark):
    draw = random.Random(8)
    paths = {"/" + "/".join(draw.choice("abc") if draw.random() < 0.7 else str(draw.randrange(99)) for _ in range(draw.randrange(9))) for _ in range(300)}
    rows = [(draw.choice(["x", "y"]), p, draw.choice([True, False, None])) for p in sorted(paths)]
    pages = spark.createDataFrame(rows, "host string, path string, bad boolean")
    by = lambda t: sorted(map(tuple, urlfilter.judged(pages, t).select("host", "path", "tpl", "verdict").collect()))
    assert by(urlfilter.Tree(alone=1)) == by(urlfilter.Tree(alone=99))


def test_toxic_label_of_equal_texts(spark):
    docs = spark.createDataFrame([(k, "same text" if k < 6 else f"text {k}") for k in range(12)], "doc_id long, text string")
    for parts in (1, 5):
        labels = spark.createDataFrame([(k, int(k == 3)) for k in range(12)], "doc_id long, y int").repartition(parts)
        got = {r.text: r.y for r in toxicity.sample(docs.repartition(parts), labels, toxicity.Learn()).collect()}
        assert got["same text"] == 1 and len(got) == 7


def test_toxic_terms_of_any_length(spark):
    """A term of two letters and one of 70 are learned, and the 70 letters count as they are, not as their beginning."""
    draw = random.Random(4)
    plain = ["".join(draw.choice("aeioustn") for _ in range(6)) for _ in range(200)]
    long = "".join(draw.choice("bcdfg") for _ in range(70))
    rows = [(k, " ".join([*draw.sample(plain, 12), *([] if k % 3 else ["zq" if k % 2 else long])]), int(k % 3 == 0)) for k in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, y int"))
    terms = [t for t, _ in model.terms]
    assert "zq" in terms and any(len(t) >= 64 for t in terms)
    scores = model.scores([f"{plain[0]} zq {plain[1]}", f"{plain[0]} {long}", " ".join(plain[:9])])
    assert scores[0] > 0.8 and scores[1] > 0.8 and scores[2] < 0.2


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_matcher_by_brute_force():
    draw = random.Random(5)
    say = lambda n: "".join(draw.choice("abc") for _ in range(n))
    terms = list({say(draw.randrange(2, 11)): draw.choice([True, False]) for _ in range(25)}.items())
    m = toxicity.Matcher(terms)
    for _ in range(3000):
        word = say(draw.randrange(13))
        hits = []
        for k, (term, open_) in enumerate(terms):
            ends = [word[:n] for n in range(1, len(word) + 1)] if open_ else [word]
            best = min((edits(term, e) for e in ends), default=99)
            if word and best <= toxicity.allowed(term):
                hits.append((best, k))
        assert m.match(word) == min(hits, default=None), (word, terms)


def test_quotation_lowers_the_score():
    m = toxicity.Matcher([("moron", False)])
    x = lambda t: toxicity.features(t, m, 8)
    abuse, quoted = x("you are a moron and you know it"), x('he said that the report called him a "moron" as they quoted it')
    assert abuse[0] > quoted[0] and abuse[1] < quoted[1]
