from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from touchline.operators import scan


def history(seed=1, long=700, short=40):
    """One key with most rows, many ties in the order, and a few ordinary keys."""
    rnd = random.Random(seed)
    rows = [("hot", rnd.randrange(5), i) for i in range(long)]
    rows += [(f"k{i % 7}", rnd.randrange(5), i) for i in range(short)]
    rnd.shuffle(rows)
    return [(k, s, i, rnd.uniform(-0.4, 0.4)) for k, s, i in rows]


@pytest.fixture(scope="module")
def rows():
    return history()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, seq int, id int, x double").repartition(5)


def blocked(df, limit=50, radix=8):
    long = scan.long_keys(df, ["k"], limit)
    assert {r["k"] for r in long.collect()} == {"hot"}
    return scan.with_blocks(df, ["k"], ["seq", "id"], long, radix)


def in_order(rows):
    for key in sorted({r[0] for r in rows}):
        yield key, sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))


def test_no_long_keys(frame):
    assert scan.long_keys(frame, ["k"], 10_000) is None


def test_blocks_are_small_and_ordered(frame):
    got = blocked(frame).collect()
    assert len(got) == 740
    hot = sorted((r for r in got if r["k"] == "hot"), key=lambda r: (r["seq"], r["id"]))
    numbers = [r[scan.BLOCK] for r in hot]
    assert numbers == sorted(numbers)
    assert max(numbers.count(n) for n in set(numbers)) <= 8
    assert {r[scan.BLOCK] for r in got if r["k"] != "hot"} == {0}


@pytest.mark.parametrize("split", [False, True])
def test_running_total(frame, rows, split):
    df = blocked(frame) if split else frame
    out = scan.running_total(df, ["k"], ["seq", "id"], {"before": "x"}, limit=20)
    got = {(r["k"], r["id"]): r["before"] for r in out.collect()}
    for key, own in in_order(rows):
        total = 0.0
        for r in own:
            assert got[(key, r[2])] == pytest.approx(total, abs=1e-9)
            total += r[3]


@pytest.mark.parametrize("split", [False, True])
def test_trace_of_halving_fold(spark, frame, rows, split):
    df = (blocked(frame) if split else frame).withColumn("a", F.lit(0.5)).withColumn("b", F.col("x") / 2)
    start = spark.createDataFrame([("k1", 0.9)], "k string, state double")
    out = scan.fold_trace(
        df, ["k"], ["seq", "id"], ["a", "b"], scan.affine(), start, 0.5, limit=20
    )
    got = {(r["k"], r["id"]): (r["before"], r["after"]) for r in out.collect()}
    assert len(got) == len(rows)
    for key, own in in_order(rows):
        state = 0.9 if key == "k1" else 0.5
        for r in own:
            after = (state + r[3]) / 2
            assert got[(key, r[2])] == pytest.approx((state, after), abs=1e-12)
            state = after


@pytest.mark.parametrize("split", [False, True])
def test_clamped_sum(frame, rows, split):
    df = (blocked(frame) if split else frame).withColumnRenamed("x", "step")
    fold = scan.clamped_sum()
    out = scan.fold_maps(df, ["k"], ["seq", "id"], ["step"], fold, limit=20)
    got = {
        r["k"]: (r["end"], r["n"])
        for r in out.select("k", fold.apply(F.col("__map"), F.lit(0.5)).alias("end"), "__map.n").collect()
    }
    for key, own in in_order(rows):
        state = 0.5
        for r in own:
            state = min(1.0, max(0.0, state + r[3]))
        assert got[key] == (pytest.approx(state, abs=1e-9), len(own))


@pytest.mark.parametrize("limit, scale", [(4, 1), (16, 10**16), (1000, 10**16)])
def test_carry_last(spark, limit, scale):
    rnd = random.Random(3)
    rows = [(k, p * scale, f"{k}{p}" if rnd.random() < 0.05 else None) for k in "xy" for p in range(0, 400, 3)]
    df = spark.createDataFrame(rows, "k string, p bigint, v string").repartition(4)
    got = {
        (r["k"], r["p"]): r["out"]
        for r in scan.carry_last(df, ["k"], "p", "v", "out", limit).collect()
    }
    assert len(got) == len(rows)
    for k in "xy":
        last = None
        for key, p, v in (r for r in rows if r[0] == k):
            last = v or last
            assert got[(key, p)] == last
