from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from touchline.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    """Sources in order, weights 1, 2, 3; the excess goes round until none is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, target = sum(sizes.values()), dict.fromkeys(order, 0.0)
    target = {s: total * weight[s] / sum(weight.values()) for s in order}
    while True:
        above = [s for s in order if target[s] > 3 * sizes[s] + 1e-9]
        if not above:
            return target
        excess = sum(target[s] - 3 * sizes[s] for s in above)
        for s in above:
            target[s] = 3.0 * sizes[s]
        free = [s for s in order if target[s] < 3 * sizes[s] - 1e-9]
        for s in free:
            target[s] += excess * weight[s] / sum(weight[x] for x in free)


def by_source(docs, found):
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sums = defaultdict(int)
    for r in found:
        sums[source[r["doc_id"]]] += r["taken"]
    return sums


def test_every_source_comes_near_its_target(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.collect()
    found = mixing.mixing(spark, sf_dir).collect()
    size = {r["doc_id"]: words(r["text"]) for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += size[r["doc_id"]]
    want = plain_targets(sizes)
    source = {r["doc_id"]: r["source"] for r in rows}
    assert len(found) == len(rows)
    for r in found:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * want[s]
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
    taken = by_source(docs, found)
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] for s in want)
    again = mixing.mixing(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in found)


def test_targets_share_the_excess():
    rng = random.Random(8)
    for _ in range(50):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 100, 5000]) for i in range(rng.randrange(1, 9))}
        if rng.random() < 0.5:
            sizes[None] = 50
        got, want = mixing.targets(sizes, float(sum(sizes.values()))), plain_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def least_cost(supply, quota, uses):
    """All ways to send whole units; the most units first, then the least cost of repetition."""
    arcs = [(p, s) for p in supply for s in p]
    best = None
    for amounts in itertools.product(*[range(min(uses * supply[p], quota[s]) + 1) for p, s in arcs]):
        of_p, of_s = Counter(), Counter()
        for (p, s), a in zip(arcs, amounts, strict=True):
            of_p[p] += a
            of_s[s] += a
        if all(of_p[p] <= uses * supply[p] for p in supply) and all(of_s[s] <= quota[s] for s in quota):
            cost = sum(sum(k // supply[p] + 1 for k in range(of_p[p])) for p in supply)
            key = (-sum(amounts), cost)
            best = key if best is None or key < best else best
    return best


def test_flow_is_cheapest():
    rng = random.Random(9)
    for _ in range(40):
        sources = ["a", "b", "c"]
        patterns = rng.sample([("a",), ("b",), ("c",), ("a", "b"), ("b", "c"), ("a", "c")], 3)
        supply = {p: rng.randrange(0, 3) for p in patterns}
        quota = {s: rng.randrange(0, 5) for s in sources}
        given = mixing.flow(supply, quota, 2)
        sent, cost = 0, 0
        for p, g in given.items():
            assert set(g) <= set(p) and sum(g.values()) <= 2 * supply[p] and min(g.values(), default=0) >= 0
            sent += sum(g.values())
            cost += sum(k // supply[p] + 1 for k in range(sum(g.values())))
        for s in sources:
            assert sum(g.get(s, 0) for g in given.values()) <= quota[s]
        assert (-sent, cost) == least_cost(supply, quota, 2)


def test_overlapping_sources(spark):
    rows = [(i, f"word{i} " * (1 + i % 17), ["a"] if i % 3 == 0 else ["a", "b"] if i % 3 == 1 else ["b"]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    done, sizes, wanted = mixing.mixed(docs, F.col("sources"))
    got = defaultdict(int)
    for r in done.collect():
        assert 0 <= r["uses"] <= 3
        if r["uses"]:
            assert r["first"] in r["pattern"]
        got["all"] += r["size"] * r["uses"]
    assert abs(got["all"] - sum(wanted.values())) <= 0.02 * sum(wanted.values())


def test_a_very_long_document_among_short_ones(spark):
    rng = random.Random(4)
    rows, n = [], 0
    for k in range(24):
        for size in [20_000, *[rng.randrange(150, 351) for _ in range(300)]]:
            rows.append((n, "w " * size, f"s{k:02}"))
            n += 1
    done, sizes, wanted = mixing.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8))
    taken = Counter()
    for r in done.collect():
        taken[r["pattern"][0]] += r["size"] * r["uses"]
        assert r["uses"] <= 3
    off = {s: abs(taken[s] - wanted[s]) / wanted[s] for s in wanted}
    assert max(off.values()) < 0.005, off


def test_odd_inputs_and_the_stage(spark):
    rows = [(1, None, "a", 1), (2, "", None, 2), (3, "x y z", None, 3), (3, "x y z", None, 4), (None, "n n", "a", 5), (4, "w " * 20_000, "b", 6), (5, " \t ", "c", 7)]
    rows += [(100 + i, "hot words here " * (i % 9), "hot", 0) for i in range(300)] + [(9, "again and again", "hot", 0)] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, uses int")
    done, sizes, wanted = mixing.mixed(docs)
    found = done.collect()
    assert len(found) == len(rows) and all(r["uses"] == 0 for r in found if r["size"] == 0) and all(r["uses"] <= 3 for r in found)
    want = plain_targets(sizes)
    taken = Counter()
    for r in found:
        taken[r["pattern"][0]] += r["size"] * r["uses"]
    assert all(abs(taken[s] - want[s]) <= max(3, 0.02 * want[s]) for s in ("hot", "c", None))
    out = mixing.mixture(docs)
    assert out.columns == docs.columns
    uses = Counter()
    for r in found:
        uses[r["doc_id"], r["size"]] += r["uses"]
    assert Counter((r["doc_id"], words(r["text"])) for r in out.collect()) == Counter({k: n for k, n in uses.items() if n})
    empty = docs.limit(0)
    assert mixing.mixed(empty)[0].collect() == [] and mixing.mixture(empty).collect() == []
