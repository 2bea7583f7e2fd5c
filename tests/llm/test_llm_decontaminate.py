from __future__ import annotations

import random
import re

from touchline.llm import decontaminate


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(texts, items, stretch=13, share=0.8):
    found = set()
    for i, text in texts:
        a = tokens(text)
        for k, item in items:
            b = tokens(item)
            w = min(stretch, len(b))
            if len(b) < 6:
                continue
            for start in range(-len(b) + 1, len(a)):
                same = [0 <= start + q < len(a) and a[start + q] == x for q, x in enumerate(b)]
                if max(sum(same[p : p + w]) for p in range(len(b) - w + 1)) / w >= share:
                    found.add((i, k))
    return found


def pairs(df):
    rows = [(r["doc_id"], r["item_id"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_planted_passages_match_brute_force(spark, sf_dir):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(6).collect()]
    rng = random.Random(4)
    texts = []
    for n in range(40):
        words = [rng.choice("the of and to in that is was for it with as his on be at by".split()) for _ in range(rng.randrange(60))]
        _, item = rng.choice(items)
        part = item.split()
        for _ in range(rng.randrange(8)):
            part[rng.randrange(len(part))] = rng.choice(["CHANGED", "the", "of"])
        if n % 4 == 3:
            part = part[: len(part) // 2]
        at = rng.randrange(len(words) + 1)
        texts.append((n, " ".join(words[:at] + part + words[at:])))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts, items)
    assert pairs(decontaminate.leaked(docs, benchmark)) == want and len(want) > 10
    # Beyond the bound, by a shuffled join.
    assert pairs(decontaminate.leaked(docs, benchmark, decontaminate.Settings(broadcast_rows=0))) == want


def test_given_documents_hold_whole_items(spark, sf_dir):
    found = decontaminate.decontaminate(spark, sf_dir).collect()
    docs = {r["doc_id"]: " ".join(tokens(r["text"])) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r["item_id"]: " ".join(tokens(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    whole = {(i, k) for i, text in docs.items() for k, item in items.items() if f" {item} " in f" {text} "}
    assert whole <= {(r["doc_id"], r["item_id"]) for r in found}


def test_odd_inputs(spark):
    item = "one two three four five six seven eight"
    benchmark = spark.createDataFrame([(1, item), (2, item), (3, "too short"), (None, None), (4, "")], "item_id long, text string")
    rows = [(1, f"x {item.upper()}! y", "a"), (1, f"x {item.upper()}! y", "a"), (None, item, "b"), (2, None, "c"), (3, "", "d"), (4, "too short", "e"), (5, "pad " * 30_000 + item, "f"), (6, "one two three four", "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    assert pairs(decontaminate.leaked(docs, benchmark)) == {(i, k) for i in (1, None, 5) for k in (1, 2)}
    kept = decontaminate.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 6]
    assert decontaminate.leaked(docs.limit(0), benchmark).collect() == []
    assert kept.count() == 4 and decontaminate.decontaminated(docs, benchmark.limit(0)).count() == len(rows)


def test_the_main_path_has_no_python(spark, sf_dir):
    plan = decontaminate.decontaminate(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_short_items_as_whole_runs(spark):
    items = [(1, "Too short"), (2, "short"), (3, "a b c d e"), (4, "a b c d e f"), (5, None), (6, "?!"), (7, "too SHORT!"), (8, "b a b a")]
    rows = [(1, "It is too, short."), (1, "It is too, short."), (2, "too long to be short"), (3, "x a b c d"), (4, "a b c d e"), (5, "b a b a b a b"), (6, None), (7, ""), (None, "a b c d e f"), (8, "short " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items) | {
        (i, k) for i, text in rows for k, item in items if 0 < len(tokens(item)) < 6 and f" {' '.join(tokens(item))} " in f" {' '.join(tokens(text))} "
    }
    for bound in (0, 1_000_000):
        settings = decontaminate.Settings(short_items=True, broadcast_rows=bound)
        assert pairs(decontaminate.leaked(docs, benchmark, settings)) == want and len(want) == 10
    kept = decontaminate.decontaminated(docs, benchmark, decontaminate.Settings(short_items=True))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 6, 7]
    assert decontaminate.leaked(docs, benchmark.limit(0), decontaminate.Settings(short_items=True)).collect() == []
    start = {(r["doc_id"], r["item_id"]): (r["start"], r["matched"]) for r in decontaminate.leaked(docs, benchmark, decontaminate.Settings(short_items=True)).collect()}
    assert start[5, 8] == (0, 4) and start[2, 2] == (4, 1)
