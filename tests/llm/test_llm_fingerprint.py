from __future__ import annotations

import random
from hashlib import sha256

import numpy as np

from touchline.llm import fingerprint as fp

SETTINGS = fp.Settings()


def walk(text, settings=SETTINGS):
    """The embedding's samples, one character at a time."""
    level, at, step, found = fp.level_of(len(text), settings), 0, 0, ""
    digit = (fp._noise(np.arange(256), settings.seed + 2) >> np.uint64(33)).astype(np.uint8) & 15
    buffer, _ = fp.symbols([text])
    while buffer[at]:
        block, k = divmod(step, fp.BLOCK)
        if fp.steps_levels(block, settings.seed)[k] >= level:
            found += "0123456789abcdef"[digit[buffer[at]]]
        at += int(fp.moves(block, settings.seed)[k][buffer[at]])
        step += 1
    return f"{level}:{found}"


def test_batched_walks_equal_single_ones():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdé ñ\n\U0001f600") for _ in range(n)) for n in (0, 1, 2, 5, 90, 95, 96, 97, 191, 192, 700, 3000, 700)]
    assert fp.fingerprints(texts, SETTINGS) == [walk(t) for t in texts]
    assert fp.fingerprints(list(reversed(texts)), SETTINGS) == [walk(t) for t in reversed(texts)]


def test_likeness_follows_edits(spark, sf_dir):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect() if len(r["text"]) > 300]
    rng = random.Random(2)
    means = []
    for edits in (0, 2, 20):
        changed = []
        for t in texts:
            for _ in range(edits):
                i = rng.randrange(len(t))
                t = t[:i] + rng.choice(["", "q", t[i] + "z"]) + t[i + 1 :]
            changed.append(t)
        a, b = fp.fingerprints(texts, SETTINGS), fp.fingerprints(changed, SETTINGS)
        means.append(np.mean([fp.likeness(x, y) for x, y in zip(a, b, strict=True)]))
    other = np.mean([fp.likeness(x, y) for x, y in zip(a, a[1:], strict=False)])
    assert means[0] == 1 and means[1] > 0.85 and means[1] > means[2] > other + 0.3 and other < 0.2


def test_likeness_across_levels():
    text = "".join(random.Random(3).choice("abcdefgh ") for _ in range(5000))
    a, b = fp.fingerprints([text, text[:2400]], SETTINGS)
    assert a[0] != b[0] and 0.4 < fp.likeness(a, b) == fp.likeness(b, a) < 0.6
    assert fp.likeness("0:", "0:") == 1 and fp.likeness("0:", a) == 0


def expected(rows):
    order = sorted(rows, key=lambda r: -r[0])
    found = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + following[:half]
        a, b, c = fp.fingerprints([t, e, following], SETTINGS)
        found.append((i, len(t), sha256(e.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(found)


def test_every_row_meets_the_next_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    want = expected(rows)
    assert sorted(tuple(r) for r in fp.fingerprint(spark, sf_dir).collect()) == want
    many = fp.with_next(docs.repartition(3), fp.Settings(rows_per_task=7))
    assert sorted(tuple(r) for r in many.collect()) == want
    near, following = np.mean([r[5] for r in want]), np.mean([r[6] for r in want])
    assert near > 0.4 and following < 0.15


def test_odd_inputs(spark):
    rows = [(3, None), (2, ""), (1, "é" * 5), (5, "x" * 100_000), (4, "abc")]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, fingerprint string")
    assert sorted(tuple(r) for r in fp.with_next(docs, fp.Settings(rows_per_task=1)).collect()) == expected(rows)
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    assert [tuple(r) for r in fp.with_next(one).collect()] == expected([(1, "abcd")])
    again = spark.createDataFrame([(None, "a"), (None, "a"), (7, "b"), (7, "b")], "doc_id long, text string")
    assert fp.with_next(again).count() == 4
    assert fp.with_next(one.limit(0)).collect() == []


def test_bands_find_alike_texts(spark):
    rng = random.Random(6)
    bases = ["".join(rng.choice("abcdefghij ") for _ in range(800)) for _ in range(6)]
    rows = [(i, b) for i, b in enumerate(bases)]
    for i, b in enumerate(bases):
        at = rng.randrange(780)
        rows += [(10 + i, b[:at] + "zz" + b[at + 1 :]), (20 + i, b)]
    found = {r["doc_id"]: r["class_id"] for r in fp.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    prints = dict(zip((i for i, _ in rows), fp.fingerprints([t for _, t in rows], SETTINGS), strict=True))
    assert found == {i: i % 10 if i < 10 or fp.likeness(prints[i], prints[i % 10]) >= 0.7 else i for i, _ in rows}
    assert sum(found[10 + i] == i for i in range(6)) >= 5


def test_classes_of_short_texts_and_a_hot_band_match_brute_force(spark):
    rng = np.random.default_rng(21)

    def word(n):
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))

    texts = []
    for n in range(10, 41):
        base = word(n)
        texts += [base, base[:-1] + "#", base + "!"]
    # One opening for all, so that they share bands; pairs are alike, the rest is not.
    for _ in range(40):
        base = "a common opening of many texts " + word(60)
        texts += [base, base[:-2] + "##"]
    texts = list(dict.fromkeys(texts))
    settings = fp.Settings()
    prints = fp.fingerprints(texts, settings)
    like = np.array([[fp.likeness(a, b, settings) for b in prints] for a in prints])
    assert np.allclose(fp.likenesses(prints, settings), like)
    root = list(range(len(texts)))
    for _ in texts:
        root = [min(root[j] for j in np.flatnonzero(like[i] >= settings.likeness)) for i in range(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for chunk in (512, 8):
        got = {r["doc_id"]: r["class_id"] for r in fp.classes(docs, fp.Settings(chunk=chunk)).collect()}
        assert [got[i] for i in range(len(texts))] == root
    assert len(set(root)) < len(texts) - 60
