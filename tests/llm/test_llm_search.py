from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from touchline.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def expected(docs, items, top=50):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    total, length = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    rows = []
    for item_id, text in items:
        asked = set(terms(text))
        found = []
        for doc_id, c, n in counted:
            m = 100 - 50 + (50 * n * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in asked & c.keys()
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(found)[:top], 1):
            rows.append((item_id, rank, doc_id, -score))
    return sorted(rows, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_given_documents_match_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(search.ranked_search(spark, sf_dir)) == expected(docs, items)


def toy():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(120)] + ["É", "é", "Été", "日本", "x" * 300, "7"]
    docs = []
    for i in range(400):
        n = int(rng.choice([1, 5, 40, 300]))
        docs.append((i, " ".join(rng.choice(vocabulary, n, p=np.arange(126, 0, -1) / (126 * 127 / 2)))))
    docs += [(1000 + i, "copy of One text, w3 w3 w3") for i in range(120)]
    docs += [(None, "w5 w5 w110"), (None, None), (7, ""), (8, "... \n !"), (9, "w1"), (9, "w1"), (2000, "w9 W10-w11_w12\x7fw13 " * 8000)]
    items = [(1, "w5 w100 w110"), (1, "w5 w100 w110"), (2, "W3 w3 text"), (3, ""), (None, "w1 É"), (4, None), (5, "nowhere"), (6, " ".join(vocabulary)), (7, "日本!x7"), (8, "w13")]
    return docs, items


@pytest.mark.parametrize("settings", [search.Settings(), search.Settings(bits=1, probes=1, levels=2, block_docs=8, items=3, block_bytes=64), search.Settings(levels=1)])
def test_all_settings_match_brute_force(spark, settings):
    docs, items = toy()
    table = spark.createDataFrame([(*d, 1, "b") for d in docs], "doc_id long, text string, key int, bound string").repartition(5)
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, score int")
    assert got(search.search(table, asked, settings)) == expected(docs, items)


def test_bounds_are_never_below_the_score():
    docs, items = toy()
    texts = [t or "" for _, t in docs]
    query = search.asked([t or "" for _, t in items])
    scorer = search.Scoring(query, np.full(len(query.terms), 100), len(texts), sum(len(terms(t)) for t in texts))
    for settings in (search.Settings(), search.Settings(bits=2, probes=2, levels=3, block_docs=16)):
        keys = list(range(len(texts)))
        import pyarrow as pa

        batch = pa.RecordBatch.from_pydict({"text": texts, "key": keys})
        blocks = [r for b in search._blocks([batch], settings) for r in b.to_pylist()]
        seen = {}
        for block in blocks:
            found = search.bounds(block, scorer, settings)
            for j, key in enumerate(np.frombuffer(block["keys"], "<i8").tolist()):
                seen[key] = found[:, j]
        tight = []
        for key, bound in seen.items():
            tf = Counter(terms(texts[key]))
            slack = 50 + 50 * sum(tf.values()) * scorer.docs // scorer.length
            for i, (_, text) in enumerate(items):
                score = sum(100 * (1_000_000_000 * tf[t] // (1000 * tf[t] + 20 * slack)) for t in set(terms(text)))
                assert bound[i] >= score
                tight.append(bound[i] - score)
        assert len(seen) == sum(bool(terms(t)) for t in texts)
    assert max(tight) > 0


def test_nothing_to_search(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert got(search.search(docs.limit(0), items)) == [] and got(search.search(docs, items.limit(0))) == []
    assert got(search.search(docs, items)) == expected([(1, "a b")], [(1, "a")])


def test_terms_do_not_mix_texts():
    texts = ["", "Ab ab", "b", "Ünder\x00score_x", "a" * 70_000, " "]
    hashes, counts = search.term_hashes(texts)
    assert counts.tolist() == [0, 2, 1, 3, 1, 0] and hashes[0] == hashes[1] != hashes[2] and len(set(hashes.tolist())) == 6
