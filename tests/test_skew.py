"""One key with a third of all rows or more."""

from __future__ import annotations

import random

import league as L
import pytest
from pyspark.sql import functions as F

from touchline.operators import folds, graph, metrics

TUNED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
}


@pytest.fixture
def small_partitions(spark):
    """Thresholds scaled down, so that test data looks like a large shuffle."""
    before = {k: spark.conf.get(k, None) for k in TUNED}
    for k, v in TUNED.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_player_is_split_in_the_lookup(spark, small_partitions):
    i = F.col("id")
    player = F.when(i % 3 == 0, 7).otherwise(i % 5000).cast("bigint")
    seen = spark.range(300_000).select(
        i.alias("match_id"),
        (i % 700).cast("int").alias("seq"),
        F.lit("2018-01-01").cast("date").alias("match_date"),
        F.lit(90).alias("full_time"),
        F.lit(0).alias("team_ord"),
        F.lit(1).cast("bigint").alias("team_id"),
        player.alias("player_id"),
        F.lit(True).alias("on_roster"),
        F.lit(90).alias("minutes"),
    )
    one = F.array(F.struct(F.lit(1801).cast("bigint").alias("id")))
    events = seen.select(
        "match_id", F.col("player_id").alias("playerId"), F.lit(8).alias("eventId"), F.lit(0).alias("subEventId"), one.alias("tags")
    )
    known = spark.range(5000).select(F.col("id").alias("Id"))
    history = metrics.player_history(seen, metrics.event_metrics(events), known)
    history.collect()
    plan = history._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true) [player_id" in plan


def test_long_histories_at_the_default_limit(spark):
    """Two players meet five thousand times, with many matches on the same day."""
    rnd = random.Random(5)
    rows = []
    for g in range(5000):
        for p in (1, 2, 100 + g % 1500):
            rows.append((g, g // 40, 0, p, True, True, 90, rnd.uniform(0, 1.2), rnd.randrange(2), 0))
    schema = (
        "match_id bigint, seq int, team_ord int, player_id bigint, known boolean, on_roster boolean, "
        "minutes int, contribution double, fouls bigint, own_goals bigint"
    )
    day = F.lit("2018-01-01").cast("date")
    history = spark.createDataFrame(rows, schema).withColumn("match_date", day).repartition(6)
    rated = folds.ratings(history)
    got = {(r["match_id"], r["player_id"]): (r["rating"], r["change"]) for r in rated.collect()}
    rating, fouls, changes = {}, {}, []
    for g in range(5000):
        here = []
        for _, _, _, p, *_, c, f, _ in rows[3 * g : 3 * g + 3]:
            before = rating.get(p, 0.5)
            rating[p] = (before + c - 0.005 * fouls.get(p, 0) * c) / 2
            fouls[p] = fouls.get(p, 0) + f
            assert got[(g, p)] == pytest.approx((rating[p], rating[p] - before), abs=1e-9)
            here.append((p, rating[p] - before))
        changes.append((here, []))
    chem = {(r["p_lo"], r["p_hi"]): (r["chem"], r["meetings"]) for r in folds.chemistry(rated).collect()}
    want = L.chemistry_by_hand(changes)
    assert {k: v for k, (v, _) in chem.items()} == pytest.approx(want, abs=1e-9)
    assert chem[(1, 2)][1] == 5000


def test_hub_node_with_most_edges(spark):
    hub = spark.range(60_000).select(F.lit("hub").alias("src"), (F.col("id") % 20_000).cast("string").alias("dst"))
    rest = spark.range(30_000).select((F.col("id") % 20_000).cast("string").alias("src"), F.lit("hub").alias("dst"))
    edges = hub.unionByName(rest)
    lists = graph.adjacency(edges, part_size=500)
    sizes = lists.filter("src = 'hub'").select(F.size("targets").alias("n")).collect()
    assert len(sizes) == 40 and sum(r["n"] for r in sizes) == 20_000 and max(r["n"] for r in sizes) < 700
    ranks = {r["node"]: r["rank"] for r in graph.rank_iterate(edges, max_iter=2, part_size=500).collect()}
    first = {"hub": 0.15 + 0.85 * 20_000, "other": 0.15 + 0.85 * 3 / 60_000}
    assert ranks["hub"] == pytest.approx(0.15 + 0.85 * 20_000 * first["other"])
    assert ranks["5"] == pytest.approx(0.15 + 0.85 * 3 * first["hub"] / 60_000)
