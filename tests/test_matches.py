from __future__ import annotations

import league as L
import pytest

from touchline.operators import matches as M
from touchline.operators import metrics as X


def minutes(spark, first, second, **kw):
    rows = M.minutes_played(L.matches(spark, [L.match(1, 1, first, second, **kw)])).collect()
    return {r["player_id"]: r["minutes"] for r in rows}


def test_minutes(spark):
    first = L.side([1, 2, 3], [4, 5, 6], [(4, 1, 60), (5, 2, 0)])
    second = L.side([11, 12], [13], [])
    assert minutes(spark, first, second) == {1: 60, 2: 0, 3: 90, 4: 30, 5: 90, 11: 90, 12: 90}
    assert minutes(spark, first, second, duration="ExtraTime") == {
        1: 60, 2: 0, 3: 120, 4: 60, 5: 120, 11: 120, 12: 120,
    }


def test_last_entry_of_a_repeated_substitute_counts(spark):
    first = L.side([1, 2], [4], [(4, 1, 20), (4, 2, 70), (2, 4, 80)])
    assert minutes(spark, first, L.side([11])) == {1: 20, 2: 70, 4: 20, 11: 90}


def test_starter_named_as_coming_on_stays_a_starter(spark):
    assert minutes(spark, L.side([1, 2], [], [(2, 1, 30)]), L.side([11])) == {1: 30, 2: 90, 11: 90}


def test_missing_formation_gives_no_minutes_but_a_roster(spark):
    rows = L.matches(spark, [L.match(1, 1, L.side([1], [2], None), L.side([11]))])
    assert {r["player_id"] for r in M.minutes_played(rows).collect()} == {11}
    assert {r["player_id"] for r in M.roster(rows).collect()} == {1, 2, 11}
    rows = L.matches(spark, [L.match(1, 1, L.side(None, [2]), L.side([11]))])
    assert {r["player_id"] for r in M.minutes_played(rows).collect()} == {11}


def test_flag_variant(spark):
    off = L.side([1])
    off["hasFormation"] = 0
    rows = L.matches(spark, [L.match(1, 1, off, L.side([11]))])
    assert {r["player_id"] for r in M.minutes_played(rows, require_flag=True).collect()} == {11}


def test_teams_keep_their_order(spark):
    rows = L.matches(spark, [L.match(1, 1, L.side([1]), L.side([2]), teams=("99", "3"))])
    got = {(r["team_ord"], r["team_id"]) for r in M.match_team(rows).collect()}
    assert got == {(0, 99), (1, 3)}


def test_unknown_neighbours_both_leave_the_roster(spark):
    rows = L.matches(spark, [L.match(1, 1, L.side([1, 8, 9, 2]), L.side([11]))])
    kept = M.known_players(M.roster(rows), L.players(spark, [1, 2, 11])).collect()
    assert {r["player_id"] for r in kept} == {1, 2, 11}


def test_incidents_in_record_order(spark):
    first = L.side(
        [L.entry(2, goals="1", yellow="30"), L.entry(1, goals="x", own="1")], [L.entry(3, goals="2", red="80")]
    )
    second = L.side([L.entry(11, goals="null", own="0", yellow="0"), L.entry(99, goals="5")], [L.entry(12, goals="1")])
    rows = L.matches(spark, [L.match(1, 1, first, second), L.match(2, 2, L.side([1]), L.side([11]))])
    got = {
        r["match_id"]: r
        for r in M.incidents(rows, L.players(spark, [1, 2, 3, 11, 12]), L.teams(spark)).collect()
    }
    plain = lambda items: [tuple(i) for i in items]
    assert plain(got[1]["goals"]) == [("P2", "Reds", 1), ("P3", "Reds", 2), ("P12", "Blues", 1)]
    assert plain(got[1]["own_goals"]) == [("P1", "Reds", 1)]
    assert plain(got[1]["yellow_cards"]) == [("P2", "Reds")]
    assert plain(got[1]["red_cards"]) == [("P3", "Reds")]
    assert got[2]["goals"] == [] and got[2]["red_cards"] == []


def metrics_of(spark, rows, **kw):
    return {r["player_id"]: r for r in X.event_metrics(L.events(spark, rows), **kw).collect()}


def test_pass_kinds(spark):
    e = L.event
    got = metrics_of(
        spark,
        [
            e(1, 5, L.PASS, [302, 1801]),
            e(1, 5, L.PASS, [1801]),
            e(1, 5, L.PASS, [1801]),
            e(1, 5, L.PASS, [302, 1802]),
            e(1, 5, L.PASS, []),
            e(1, 6, L.SHOT, [1801]),
        ],
    )
    assert got[5]["pass_accuracy"] == pytest.approx((2 + 2 * 1) / (3 + 2 * 2))
    assert got[6]["pass_accuracy"] is None


def test_duels_count_tags_and_may_have_none(spark):
    e = L.event
    got = metrics_of(
        spark, [e(1, 5, L.DUEL, [701, 703]), e(1, 5, L.DUEL, [702]), e(1, 6, L.DUEL, [1801]), e(1, 7, L.PASS, [703])]
    )
    assert got[5]["duel_effectiveness"] == pytest.approx(0.5)
    assert got[6]["duel_effectiveness"] is None and got[6]["duels"] == 1
    assert got[7]["duel_won"] == 0


def test_free_kicks_count_tags(spark):
    e = L.event
    got = metrics_of(
        spark,
        [
            e(1, 5, L.KICK, [1801, 101, 4], sub="35"),
            e(1, 5, L.KICK, [101], sub="31"),
            e(1, 6, L.KICK, [], sub=""),
        ],
    )
    assert (got[5]["fk_tags"], got[5]["fk_accurate"], got[5]["fk_penalty_goals"]) == (4, 1, 1)
    assert got[5]["freekick_effectiveness"] == 0.5
    assert got[6]["freekick_effectiveness"] == 0.0


def test_shots(spark):
    e = L.event
    rows = [
        e(1, 5, L.SHOT, [1801, 101]),
        e(1, 5, L.SHOT, [1801]),
        e(1, 5, L.SHOT, []),
        e(1, 5, L.SHOT, [1802]),
        e(1, 5, L.SHOT, [1802]),
        e(1, 6, L.SHOT, [1802]),
    ]
    got = metrics_of(spark, rows)
    assert got[5]["shot_effectiveness"] == 0.5 and got[5]["shot_goal"] == 1
    assert got[6]["shot_effectiveness"] == 0.0
    assert metrics_of(spark, rows, off_target="tagged")[5]["shot_effectiveness"] == pytest.approx(1.5 / 4)


def test_fouls_and_own_goals(spark):
    e = L.event
    got = metrics_of(spark, [e(1, 5, L.FOUL, [102]), e(1, 5, L.PASS, [102, 102]), e(1, 6, L.FOUL)])
    assert (got[5]["fouls"], got[5]["own_goals"]) == (1, 3)
    assert (got[6]["fouls"], got[6]["own_goals"]) == (1, 0)


def test_contribution(spark):
    e = L.event
    rows = [
        e(1, 1, L.PASS, [1801]),
        e(1, 1, L.KICK, [1, 2, 3]),
        e(1, 2, L.PASS, [1801]),
        e(1, 11, L.SHOT, [1801]),
    ]
    m = L.matches(spark, [L.match(1, 1, L.side([1, 2], [3], [(3, 2, 30)]), L.side([11]))])
    metrics = X.event_metrics(L.events(spark, rows))
    got = {r["player_id"]: r["contribution"] for r in X.contribution(metrics, M.minutes_played(m)).collect()}
    assert got == pytest.approx({1: 4 / 4 * 1.05, 2: 1 / 4 * 30 / 90, 3: 0.0, 11: 0.5 / 4 * 1.05})
    other = X.contribution(metrics, M.minutes_played(m), "effectiveness").collect()
    assert {r["player_id"]: r["contribution"] for r in other}[1] == pytest.approx(1 / 4 * 1.05)


def test_one_exchange_for_all_metrics(spark, sf_dir):
    from touchline.plans import fixtures

    events = X.normalise_events(fixtures.events(spark, sf_dir))
    plan = X.event_metrics(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan
