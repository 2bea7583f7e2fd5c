from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from touchline.operators import graph
from touchline.session import stored_in_buckets

EDGES = [
    ("a", "b"), ("a", "b"), ("a", "c"), ("a", "sink"), ("b", "a"), ("c", "c"), ("c", "b"), ("lonely", "a"),
]


def by_hand(edges, rounds, digits=None):
    out = Counter(s for s, _ in edges)
    ranks = {s: 1.0 for s in out}
    for _ in range(rounds):
        got = Counter()
        for s, d in edges:
            got[d] += ranks[s] / out[s]
        ranks = {n: 0.15 + 0.85 * got[n] for n in ranks}
        if digits is not None:
            ranks = {n: round(r, digits) for n, r in ranks.items()}
    return ranks


def frame(spark, edges):
    return spark.createDataFrame(edges, "src string, dst string")


def ranks_of(df):
    return {r["node"]: r["rank"] for r in df.collect()}


def test_adjacency_keeps_every_copy_in_parts(spark):
    hub = [("hub", f"t{i}") for i in range(300)] + [("hub", "t0")] * 700
    lists = graph.adjacency(frame(spark, EDGES + hub), part_size=16).collect()
    copies = Counter()
    for r in lists:
        for t in r["targets"]:
            copies[(r["src"], t["dst"])] += t["copies"]
    assert copies == Counter(EDGES + hub)
    outdeg = Counter(s for s, _ in EDGES + hub)
    assert all(r["outdeg"] == outdeg[r["src"]] for r in lists)
    parts = [r for r in lists if r["src"] == "hub"]
    assert len(parts) > 10 and max(len(r["targets"]) for r in parts) < 60
    assert all(r["parts"] == 1 for r in lists if r["src"] != "hub")


def test_initial_ranks_only_for_sources(spark):
    assert ranks_of(graph.initial_ranks(frame(spark, EDGES))) == dict.fromkeys("abc", 1.0) | {"lonely": 1.0}


def test_step_matches_hand_count(spark):
    edges = frame(spark, EDGES)
    got = ranks_of(graph.rank_step(edges, graph.initial_ranks(edges)))
    assert got == pytest.approx(by_hand(EDGES, 1))
    assert got["lonely"] == 0.15 and "sink" not in got


@pytest.mark.parametrize("part_size", [2, 8192])
def test_iteration_matches_hand_count(spark, part_size):
    got = ranks_of(graph.rank_iterate(frame(spark, EDGES), max_iter=4, part_size=part_size))
    assert got == pytest.approx(by_hand(EDGES, 4))


def test_rounding_inside_the_loop(spark):
    got = ranks_of(graph.rank_iterate(frame(spark, EDGES), max_iter=3, round_digits=2))
    assert got == pytest.approx(by_hand(EDGES, 3, 2), abs=1e-9)


def test_tolerance_stops_the_loop(spark):
    got = ranks_of(graph.rank_iterate(frame(spark, EDGES), max_iter=50, tol=0.02))
    assert got == pytest.approx(by_hand(EDGES, 60), abs=0.1)
    assert all(r >= 0.15 for r in got.values())


def test_hot_source_goes_through_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(graph, "HOT_TARGETS", 0)
    edges = frame(spark, EDGES)
    got = ranks_of(graph.rank_step(edges, graph.initial_ranks(edges)))
    assert got == pytest.approx(by_hand(EDGES, 1))


def test_rounds_do_not_move_the_lists(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = frame(spark, EDGES)
        lists = stored_in_buckets(graph.adjacency(edges), "adjacency", ["src", "part"])
        parts = graph.list_parts(lists)
        step = graph.rank_step_on(lists, parts, graph.initial_ranks(edges))
        plan = step._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "targets" in line and "FileScan" in line)
        above = plan[: plan.index(scan)].splitlines()
        depth = scan.index("+-") if "+-" in scan else scan.index(":-")
        parents = []
        for line in reversed(above):
            at = max(line.find("+-"), line.find(":-"))
            if 0 <= at < depth:
                parents.append(line)
                depth = at
            if "Join" in line and at < scan.index("FileScan"):
                break
        assert "Bucketed: true" in scan
        assert not any("Exchange" in p for p in parents)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_ranks_by_changes_come_to_rest_and_move_ever_fewer_rows(spark):
    rows = [(f"n{i}", f"n{(i * 7 + 3) % 60}") for i in range(60)] + [(f"n{i}", f"n{i + 1}") for i in range(0, 59, 2)] + [("n0", "n5")] * 3
    rows += [(f"leaf{i}", f"n{i}") for i in range(50)] + [("n1", "lost")]
    edges = spark.createDataFrame(rows, "src string, dst string")
    moved = []
    got = {r["node"]: r["rank"] for r in graph.rank_by_changes(edges, tol=1e-3, part_size=2, moved=moved).collect()}
    out = {}
    for s, _ in rows:
        out[s] = out.get(s, 0) + 1
    want = dict.fromkeys(out, 1.0)
    for _ in range(300):
        sums = dict.fromkeys(out, 0.0)
        for s, d in rows:
            if d in sums:
                sums[d] += want[s] / out[s]
        want = {n: 0.15 + 0.85 * x for n, x in sums.items()}
    assert got == pytest.approx(want, abs=2e-2)
    assert moved[0] == len(out) and moved[-1] == 0 and moved[len(moved) // 2] < moved[0]
    # The leaves have nothing new to pass on after the second round.
    assert moved[2] <= moved[0] - 50


def test_later_rounds_read_only_links_among_nodes_that_can_move(spark, monkeypatch):
    """Leaves that nobody links to and targets without a rank: their links are read in the first two rounds only."""
    ring = [(f"n{i}", f"n{(i + 1) % 5}") for i in range(5)] + [("n0", "n3"), ("n0", "n3"), (None, "n1"), ("n2", None)]
    rows = ring + [(f"leaf{i}", f"n{i % 3}") for i in range(40)] + [(f"n{i % 5}", f"lost{i}") for i in range(30)]
    links, real = [], graph._sent

    def watched(lists, parts, ranks):
        links.append(lists.agg(F.sum(F.size("targets"))).first()[0])
        return real(lists, parts, ranks)

    monkeypatch.setattr(graph, "_sent", watched)
    got = ranks_of(graph.rank_by_changes(spark.createDataFrame(rows, "src string, dst string"), tol=1e-9, part_size=4))
    # The link from a missing name is in no list.
    assert links[0] == links[1] == len(set(rows)) - 1 and set(links[2:]) == {6}
    out = {}
    for s, _ in rows:
        out[s] = out.get(s, 0) + 1
    want = dict.fromkeys(out, 1.0)
    for _ in range(300):
        sums = dict.fromkeys(out, 0.0)
        for s, d in rows:
            # A missing name is no node to send to or from, as in any join.
            if s is not None and d is not None and d in sums:
                sums[d] += want[s] / out[s]
        want = {n: 0.15 + 0.85 * x for n, x in sums.items()}
    assert got == pytest.approx(want, abs=1e-6)
