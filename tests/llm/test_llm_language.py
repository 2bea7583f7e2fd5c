from __future__ import annotations

import zlib

import numpy as np

from touchline.llm import language


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = language.language(spark, sf_dir).collect()
    assert len(rows) == len(lang)
    right = []
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["lang_pred"] in {"en", "de", "fr", "es"}
        if r["held_out"]:
            right.append(r["lang_pred"] == lang[r["doc_id"]])
    assert np.mean(right) > 0.96


def toy(n=80):
    rng = np.random.default_rng(1)
    sets = {"aa": ["ban", "lon", "gam"], "bb": ["ítt", "özö", "ßet"], "cc": ["да", "нет", "это"]}
    return [(i, " ".join(rng.choice(sets[k], 5 + i % 40)), k) for i in range(n) for k in [sorted(sets)[i % 3]]]


def test_odd_inputs_and_the_stage(spark):
    rows = toy() + [(200, None, "aa"), (201, "", None), (202, "123 ... !!", "bb"), (203, "ban lon " * 40_000, None), (None, "это да нет это", None), (5, "ban", None), (5, "ban", None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, lang_pred string")
    net = language.fitted(docs, ~language.held_out())
    texts = [t for _, t, _ in rows]
    labels, scores = language.answers(texts, net)
    assert all(a == k for a, (_, t, k) in zip(labels[:80], rows, strict=False))
    assert labels[80:84] == ["und", "und", "und", "aa"] and scores[80] == 0 and labels[84] == "cc" and labels[85] == labels[86]
    # What may not be learned from changes nothing.
    other = docs.withColumn("lang", language.F.when(language.held_out(), "zz").otherwise(language.F.col("lang")))
    again = language.fitted(other, ~language.held_out())
    assert again.labels == net.labels and np.array_equal(again.kernel, net.kernel)
    kept = language.with_language(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    assert language.with_language(docs.limit(0)).collect() == []
    nothing = docs.withColumn("lang", language.F.lit(None).cast("string"))
    assert language.fitted(nothing, ~language.held_out()) is None
    assert {r["lang_pred"] for r in language.identified(docs.drop("lang_pred"), None).collect()} == {"und"}


def test_numerals_are_no_letters():
    assert not any(map(language.has_letter, ["½ ² Ⅷ ①", "12_3", "", None, "…"]))
    assert all(map(language.has_letter, ["½a", "ª", "это", "x"]))


def test_many_labels_can_be_learned(spark):
    docs = spark.createDataFrame([(i, chr(0x4E00 + i % 300) * 40, f"l{i % 300}") for i in range(1200)], "doc_id long, text string, lang string")
    net = language.fitted(docs, language.F.lit(True), language.Settings(epochs=1, sample_total=600))
    assert len(net.labels) == 300


def test_windows_cover_the_whole_text():
    settings = language.Settings()
    for n in (1, 3, 4, 63, 64, 65, 200, 1000):
        data = bytes(1 + i % 200 for i in range(n))
        windows = language.cut(data, settings)
        assert windows.shape[1] == settings.window
        spans = {data[i : i + 4] for i in range(n - 3)}
        held = {bytes(w[i : i + 4].astype(np.uint8)) for w in windows for i in range(settings.window - 3) if (w[i : i + 4] < 256).all()}
        assert spans <= held


def test_backpropagation_agrees_with_differences():
    settings = language.Settings(epochs=1, batch=1000, rate=0.0, filters=3)
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 256, (20, settings.window)).astype(np.int16), rng.integers(0, 2, 20)
    net = language.train(x, y, ["a", "b"], settings)

    def loss(n):
        return -n.log_probs(x)[np.arange(20), y].mean()

    # One small step along the gradient lowers the loss.
    moved = language.train(x, y, ["a", "b"], language.Settings(epochs=1, batch=1000, rate=0.001, filters=3))
    assert loss(moved) < loss(net)
