"""Token counts against the library."""

import json
import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tessel.llm import tokencounts
from tessel.llm.common import slices
from tessel.llm.queries import QUERIES, VOCABULARY

LIBRARY = Tokenizer.from_file(VOCABULARY)


def want(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_query(spark, small, docs):
    got = sorted(map(tuple, QUERIES["op11_counts"](spark, small).collect()), key=repr)
    assert got == sorted(((i, len((t or "").encode()), want(t), want(t) > 1024) for i, t in docs), key=repr)


def test_words_of_any_kind():
    m, rng = tokencounts.Merger(VOCABULARY), random.Random(5)
    words = [bytes(rng.choice(b"aeinst") for _ in range(n)).decode() for n in (1, 2, 3, 7, 40, 500) for _ in range(30)]
    words += ["é" * 9, "🙂" * 5, "aaaaaaaaaaaaaaaaaaaa", "!?" * 30, "the" * 400]
    assert [m.word(w.encode()) for w in words if w.isalpha()] == [want(w) for w in words if w.isalpha()]
    assert [m.chunk(w) for w in words] == [want(w) for w in words]


def test_texts_longer_than_a_slice(monkeypatch):
    monkeypatch.setattr(tokencounts, "BYTES", 400)
    m, rng = tokencounts.Merger(VOCABULARY), random.Random(6)
    parts = ["word", " ", "\n\n ", "é", " x", "<|endoftext|>", "it's", "12345", "  ", "　", "a" * 150]
    texts = ["".join(rng.choice(parts) for _ in range(n)) for n in (0, 1, 50, 400, 900)] + ["z" * 3000, " " * 3000]
    assert m.counts(pa.array(texts, pa.large_string())).tolist() == [want(t) for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    parts = [b.column(0).to_pylist() for b in slices(batch, 0, 3, 400)]
    assert [t for p in parts for t in p] == texts
    assert all(len(p) <= 3 and (len(p) == 1 or sum(len(t.encode()) for t in p) <= 400) for p in parts)


def test_long_word_is_not_quadratic():
    m = tokencounts.Merger(VOCABULARY)
    assert m.chunk("ab" * 100_000) == want("ab" * 100_000)


def test_other_vocabularies_are_refused(tmp_path):
    with open(VOCABULARY, encoding="utf-8") as f:
        j = json.load(f)
    j["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "v.json").write_text(json.dumps(j))
    with pytest.raises(ValueError, match="byte-level"):
        tokencounts.Merger(str(tmp_path / "v.json"))
