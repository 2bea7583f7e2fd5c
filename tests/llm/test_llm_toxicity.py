from __future__ import annotations

import zlib

import numpy as np

from touchline.llm import toxicity


def corpus(n, seed):
    """Documents of which some hold one bad sentence."""
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}{c}" for a in "bcdfgl" for b in "aeiou" for c in ("n", "r", "st")]
    texts, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(words, 8)) for _ in range(rng.integers(1, 12))]
        bad = i % 3 == 0
        if bad:
            k = rng.integers(len(sentences))
            sentences[k] = sentences[k].replace(" ", rng.choice([" idiot ", " zzkvam ", " zzkvor "]), 2)
        texts.append(". ".join(sentences) + ".")
        labels.append(int(bad))
    return texts, np.array(labels)


def test_noisy_or_finds_the_sentences_that_explain_the_labels():
    texts, labels = corpus(600, 1)
    model = toxicity.train(texts, labels, np.ones(2))
    held, truth = corpus(300, 2)
    found = toxicity.scored(held, model)
    assert np.mean([(p >= 0.5) == y for (p, *_), y in zip(found, truth, strict=True)]) > 0.97
    for text, (p, start, end, worst), y in zip(held, found, truth, strict=True):
        if y and p >= 0.5:
            assert "idiot" in text[start:end] or "zzkv" in text[start:end]
            assert worst <= p + 1e-12
    # A word that training never saw, by its beginning.
    assert toxicity.scored(["ban bar zzkvelo ban"], model)[0][0] > 5 * toxicity.scored(["ban bar ban ban"], model)[0][0]


def test_noisy_or_is_one_minus_the_product():
    model = toxicity.Model({"bad$": 3.0}, -2.0, toxicity.Settings())
    one = 1 / (1 + np.exp(-1.0))
    none = 1 / (1 + np.exp(2.0))
    (p, start, end, worst), = toxicity.scored(["Fine here. bad! And\nso"], model)
    assert abs(p - (1 - (1 - none) ** 3 * (1 - one))) < 1e-12 and abs(worst - one) < 1e-12 and (start, end) == (10, 14)


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in toxicity.toxicity(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(rows) == docs.count()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    right = []
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        if r["held_out"] and i in labels:
            right.append(r["predicted"] == labels[i])
    assert np.mean(right) > 0.85


def test_odd_inputs(spark):
    texts, labels = corpus(120, 3)
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(500, None, "x"), (501, "", "x"), (502, "...", "x"), (None, texts[0], "x"), (0, texts[0], "x"), (503, "bon bar. " * 30_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([(i, 1, int(y)) for i, y in enumerate(labels)] + [(7, 0, None), (None, 1, 1), (9, 1, 5)], "doc_id long, quality int, toxic int")
    model = toxicity.fitted(docs, marks, ~toxicity.held_out())
    found = toxicity.scores(docs, model).collect()
    assert len(found) == len(rows)
    assert all(r["score"] == 0 for r in found if r["doc_id"] in (500, 501, 502))
    assert len({r["score"] for r in found if r["doc_id"] in (None, 0)}) == 1
    # Labels that may not be learned from change nothing.
    flipped = marks.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    assert toxicity.fitted(docs, flipped, ~toxicity.held_out()).weights == model.weights
    assert toxicity.fitted(docs, marks.limit(0), ~toxicity.held_out()) is None
    assert {r["score"] for r in toxicity.scores(docs, None).collect()} == {0.0}
    assert toxicity.scores(docs.limit(0), model).collect() == []


def test_the_sample_is_of_the_least_hashes_and_only_its_texts_are_fetched(spark, monkeypatch):
    texts, labels = corpus(90, 4)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])] * 2, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(y)) for i, y in enumerate(labels)], "doc_id long, toxic int")
    seen = {}

    def keep(texts, labels, class_weight, settings):
        seen.update(texts=texts, labels=labels.tolist(), weight=class_weight)

    monkeypatch.setattr(toxicity, "train", keep)
    settings = toxicity.Settings(sample_docs=20, sample_chars=500)
    toxicity.fitted(docs, marks, ~toxicity.held_out(), settings)
    learnable = docs.filter(~toxicity.held_out()).join(marks, "doc_id").withColumn("key", toxicity.row_key()).collect()
    hashed = {r["key"]: h for r, h in zip(learnable, spark.createDataFrame([(r["key"],) for r in learnable], "key long").selectExpr(f"pmod(xxhash64(key, {settings.seed}), {1 << 30}) AS h").collect(), strict=True) for h in [h["h"]]}
    counts = np.bincount([r["toxic"] for r in learnable], minlength=2)
    for y in (0, 1):
        fits = sorted(((hashed[r["key"]], r["key"], r["text"]) for r in learnable if r["toxic"] == y and len(r["text"]) <= 500))
        fits = [f for f in fits if f[0] / (1 << 30) < 1.5 * 20 / counts[y]]
        assert [t for t, l in zip(seen["texts"], seen["labels"], strict=True) if l == y] == [t for *_, t in fits[:20]]
