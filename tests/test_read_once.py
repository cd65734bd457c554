"""Texts are tokenised once where a query needs them for several steps."""

import random
from collections import Counter

import pytest

from listenlens.plans import all_queries
from listenlens.sources import star


@pytest.fixture
def tables(spark, tmpdir_path):
    rng = random.Random(3)
    words = {0: ["sun", "sea", "the", "sand"], 1: ["snow", "the", "ice", "frost"]}
    docs = [(i, " ".join(rng.choice(words[i % 2]) for _ in range(12)) + (f" only{chr(97 + i % 26)}" if i >= 40 else "")) for i in range(60)]
    spark.createDataFrame([*docs, (60, None)], "doc_id long, text string").write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int").write.parquet(f"{tmpdir_path}/labels.parquet")
    return tmpdir_path, dict(docs)


def counted(monkeypatch, name):
    calls, real = [], getattr(star, name)
    monkeypatch.setattr(star, name, lambda *a, **k: calls.append(name) or real(*a, **k))
    return calls


def test_postings_of_labelled_documents(spark, tables, monkeypatch):
    d, docs = tables
    calls = counted(monkeypatch, "tokens")
    got = {tuple(r) for r in all_queries()["bow_features_split"].build(spark, d).collect()}
    assert len(calls) == 1
    # indices are of the whole vocabulary, unlabelled documents' words included
    index = {w: i for i, w in enumerate(sorted({w for t in docs.values() for w in t.split()}), 1)}
    assert got == {(str(i), index[w], n) for i in range(40) for w, n in Counter(docs[i].split()).items() if w != "the"}


def test_model_reads_texts_once(spark, tables, monkeypatch):
    d, _ = tables
    calls = counted(monkeypatch, "word_lists")
    got = all_queries()["mlp_classifier"].build(spark, d).collect()
    assert len(calls) == 1 and len(got) == 8
    assert all(r["prediction"] == r["theme"] for r in got)
