from __future__ import annotations

import random
import re

import pytest

import corpus_pipeline
from touchline.session import stored

NAMES = [name for name, _ in corpus_pipeline.STAGES]


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


@pytest.fixture(scope="module")
def passed(spark, sf_dir):
    """The rows before the first stage and after each, with planted cases."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    rng = random.Random(1)
    near = [f"copy{rng.randrange(10**6)}" for _ in range(100)]
    rows = [
        (10**6, None, "en", "src0", 0), (10**6 + 1, "12 !! 34", "en", "src0", 8), (10**6 + 2, " ".join(near), "en", "src1", 1), (10**6 + 3, " ".join([*near[:50], "other", *near[51:]]), "en", "src1", 1),
        (10**6 + 4, f"something before {item} and after", None, None, 1), (10**6 + 5, "quite a clean text of its own, with enough words", None, None, None),
    ]
    docs = stored(docs.union(spark.createDataFrame(rows, docs.schema)), "test-docs")
    states = [docs]
    for name, stage in corpus_pipeline.STAGES:
        states.append(stored(stage(spark, states[-1], sf_dir), f"test-{name}"))
    return states


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_are_in_order_and_keep_the_columns(passed):
    assert NAMES == ["language", "near_dedup", "decontaminate", "mix", "shard"]
    assert all(df.columns == passed[0].columns for df in passed[1:-1])


def test_only_texts_without_letters_are_rejected(passed):
    assert ids(passed[0]) - ids(passed[1]) == {10**6, 10**6 + 1}
    assert passed[1].count() == passed[0].count() - 2


def test_one_document_of_each_class_stays(passed):
    kept = ids(passed[2])
    assert 10**6 + 2 in kept and 10**6 + 3 not in kept
    rows = {r["doc_id"]: frozenset(zip(*[w[i:] for i in range(5)], strict=False)) for r in passed[1].collect() for w in [words(r["text"])] if len(w) > 8}
    gone = set(rows) - kept
    for i in gone:
        assert any(j not in gone and len(rows[i] & rows[j]) >= 0.8 * len(rows[i] | rows[j]) for j in rows if j < i)
    stay = sorted(set(rows) & kept)
    for k, i in enumerate(stay):
        assert not any(len(rows[i] & rows[j]) >= 0.8 * len(rows[i] | rows[j]) for j in stay[:k])


def test_leaks_go(spark, sf_dir, passed):
    items = [" ".join(words(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaking = {r["doc_id"] for r in passed[2].collect() if any(f" {t} " in f" {' '.join(words(r['text']))} " for t in items)}
    assert 10**6 + 4 in leaking and ids(passed[2]) - ids(passed[3]) == leaking


def test_the_mix_repeats_whole_documents(passed):
    before = {r["doc_id"]: r for r in passed[3].collect()}
    after = passed[4].collect()
    assert all(before[r["doc_id"]] == r for r in after)
    counts = {}
    for r in after:
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert max(counts.values()) <= 3


def test_every_row_has_a_place(passed):
    rows = passed[5].collect()
    assert len(rows) == passed[4].count()
    for shard in {r["shard"] for r in rows}:
        own = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert own == list(range(len(own)))


def test_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "test-empty")
        assert docs.count() == 0
