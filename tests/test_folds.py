from __future__ import annotations

import random

import league as L
import pytest
from pyspark.sql import functions as F

from touchline.operators import folds, metrics, model
from touchline.operators import matches as M

KNOWN = [1, 2, 3, 4, 11, 12, 13]


def season(seed=7, games=12):
    """Random matches with fouls, own goals, an unknown player (9) and one who only comes on (4)."""
    rnd = random.Random(seed)
    records, events = [], []
    for g in range(1, games + 1):
        first = L.side([1, 2, 9], [3], [(3, 2, rnd.randrange(91)), (4, 1, 80)] if g % 3 == 0 else [])
        second = L.side([11, 12], [13], None if g % 5 == 0 else [(13, 12, 45)])
        pair = (first, second) if g % 2 else (second, first)
        teams = ("10", "20") if g % 2 else ("20", "10")
        records.append(L.match(g, g, *pair, duration="Regular" if g % 4 else "ExtraTime", teams=teams))
        for p in [1, 2, 3, 4, 9, 11, 12, 13]:
            for _ in range(rnd.randrange(6)):
                kind = rnd.choice([L.PASS, L.DUEL, L.FOUL, L.KICK, L.SHOT])
                tags = rnd.sample([101, 102, 302, 701, 702, 703, 1801, 1802], rnd.randrange(4))
                events.append(L.event(g, p, kind, tags, sub=rnd.choice(["", "35"])))
    return records, events


@pytest.fixture(scope="module")
def history(spark):
    records, events = season()
    out = metrics.player_history(
        M.appearances(L.matches(spark, records)),
        metrics.event_metrics(L.events(spark, events)),
        L.players(spark, KNOWN),
    )
    return spark.createDataFrame(out.collect(), out.schema)


def by_hand(rows, penalty="prior_total"):
    """Rating, change and prior totals per (match, player), with plain loops."""
    rating = dict.fromkeys(KNOWN, 0.5)
    fouls, own = dict.fromkeys(KNOWN, 0), dict.fromkeys(KNOWN, 0)
    out = {}
    for g in sorted({r["match_id"] for r in rows}):
        here = [r for r in rows if r["match_id"] == g]
        for r in here:
            p, before, c = r["player_id"], rating.get(r["player_id"], 0.5), r["contribution"]
            f, o = fouls.get(p, 0), own.get(p, 0)
            if penalty == "match":
                f, o = r["fouls"], r["own_goals"]
            if c is not None:
                opened = p not in rating
                rating[p] = 0.5 if opened else (before + c - (0.005 * f * c + 0.05 * o * c)) / 2
            out[(g, p)] = (rating.get(p, 0.5), rating.get(p, 0.5) - before, fouls.get(p, 0), own.get(p, 0))
        for r in here:
            if r["on_roster"]:
                fouls[r["player_id"]] += r["fouls"]
                own[r["player_id"]] += r["own_goals"]
    return out


def test_history_keeps_who_played_or_was_listed(history):
    rows = history.collect()
    assert {r["player_id"] for r in rows} == {*KNOWN, 9}
    assert not any(r["on_roster"] for r in rows if r["player_id"] in (4, 9))
    assert all(r["contribution"] is not None for r in rows if r["player_id"] in (4, 9))


@pytest.mark.parametrize("penalty", ["prior_total", "match"])
@pytest.mark.parametrize("limit", [4096, 5])
def test_ratings(history, penalty, limit):
    want = by_hand(history.collect(), penalty)
    got = folds.ratings(history, penalty, limit=limit).collect()
    assert len(got) == len(want)
    for r in got:
        rating, change, fouls, own = want[(r["match_id"], r["player_id"])]
        assert r["rating"] == pytest.approx(rating, abs=1e-12)
        assert r["change"] == pytest.approx(change, abs=1e-12)
        assert (r["prior_fouls"], r["prior_own_goals"]) == (fouls, own)


def test_unknown_player_opens_at_the_start_value(history):
    rated = folds.ratings(history).filter("player_id = 9").orderBy("seq").collect()
    assert rated[0]["rating"] == 0.5 and rated[0]["change"] == 0.0
    assert rated[1]["rating"] != 0.5


def games(rated):
    rows = [r for r in rated.collect() if r["on_roster"]]
    for g in sorted({r["match_id"] for r in rows}):
        yield tuple(
            [(r["player_id"], r["change"]) for r in rows if r["match_id"] == g and r["team_ord"] == t] for t in (0, 1)
        )


@pytest.mark.parametrize("first", ["sum", "diff"])
@pytest.mark.parametrize("limit", [4096, 5])
def test_chemistry(history, first, limit):
    rated = folds.ratings(history)
    want = L.chemistry_by_hand(games(rated), first)
    got = {(r["p_lo"], r["p_hi"]): r["chem"] for r in folds.chemistry(rated, first, limit=limit).collect()}
    assert got == pytest.approx(want, abs=1e-12)
    assert all(0 <= c <= 1 for c in got.values())


def test_swapping_teams_changes_nothing_with_diff(history):
    rated = folds.ratings(history)
    swapped = rated.withColumn("team_ord", 1 - F.col("team_ord"))
    one = folds.chemistry(rated, "diff").orderBy("p_lo", "p_hi").collect()
    two = folds.chemistry(swapped, "diff").orderBy("p_lo", "p_hi").collect()
    assert [tuple(r) for r in one] == [tuple(r) for r in two]


def test_large_changes_reach_the_bounds(spark):
    rows = [(g, g, t, p, True, c) for g in (1, 2, 3) for t, p, c in [(0, 1, 2.0), (0, 2, 1.0), (1, 3, 5.0)]]
    rows += [(4, 4, 0, 1, True, 0.2), (4, 4, 0, 2, True, -0.2)]
    rated = spark.createDataFrame(
        rows, "match_id bigint, seq int, team_ord int, player_id bigint, on_roster boolean, change double"
    )
    got = {(r["p_lo"], r["p_hi"]): (r["chem"], r["meetings"]) for r in folds.chemistry(rated).collect()}
    assert got[(1, 2)] == (pytest.approx(0.8), 4)
    assert got[(1, 3)] == (0.0, 3) and got[(2, 3)] == (0.0, 3)


def test_a_season_in_two_halves(history):
    early, late = history.filter("seq <= 6"), history.filter("seq > 6")
    whole = folds.ratings(history)
    first = folds.ratings(early)
    saved = folds.current_ratings(first)
    second = folds.ratings(late, saved_ratings=saved, saved_totals=metrics.profile_totals(early))
    want = {(r["match_id"], r["player_id"]): r["rating"] for r in whole.filter("seq > 6").collect()}
    got = {(r["match_id"], r["player_id"]): r["rating"] for r in second.collect()}
    assert got == pytest.approx(want, abs=1e-12)

    chem = folds.chemistry(second, saved=folds.chemistry(first))
    full = {(r["p_lo"], r["p_hi"]): (r["chem"], r["meetings"]) for r in folds.chemistry(whole).collect()}
    for r in chem.collect():
        assert (r["chem"], r["meetings"]) == pytest.approx(full[(r["p_lo"], r["p_hi"])], abs=1e-12)
    a = metrics.profile_totals(late, metrics.profile_totals(early)).orderBy("player_id").collect()
    assert a == metrics.profile_totals(history).orderBy("player_id").collect()


def test_profile_ratios_come_from_summed_counters(spark, history):
    got = {r["player_id"]: r for r in metrics.profile(history, L.players(spark, KNOWN)).collect()}
    assert set(got) == set(KNOWN) - {4}
    for p, r in got.items():
        own = [h for h in history.collect() if h["player_id"] == p and h["on_roster"]]
        total = lambda c: sum(h[c] for h in own)
        tries = total("pass_ok") + total("pass_bad") + 2 * (total("pass_key_ok") + total("pass_key_bad"))
        hits = total("pass_ok") + 2 * total("pass_key_ok")
        assert r["pass_acc"] == pytest.approx(hits / tries if tries else 0.0)
        assert (r["fouls"], r["goals"], r["matches"]) == (total("fouls"), total("shot_goal"), len(own))


def test_training_scopes_and_fit(spark, history):
    rated = folds.ratings(history)
    people = L.players(spark, KNOWN, born={p: L.dt.date(1980 + p, 1, p) for p in KNOWN})
    latest = model.training_frame(rated, people)
    assert {r["player_id"] for r in latest.collect()} == set(KNOWN) - {4}
    assert {r["match_id"] for r in model.training_frame(rated, people, "last_match").collect()} == {12}
    fitted = model.fit_rating(latest)
    line = model.rating_line(latest).first()
    assert fitted.coefficients[0] == pytest.approx(line["slope"], abs=1e-9)
    assert fitted.intercept == pytest.approx(line["intercept"], abs=1e-9)
    weighted = model.fit_rating(latest.withColumn("w", F.lit(0.3)), weight_col="w")
    assert weighted.intercept == pytest.approx(fitted.intercept, abs=1e-9)
    again = [model.fit_rating(latest, split=0.7, seed=3).intercept for _ in range(2)]
    assert again[0] == again[1]


def test_prediction_settles(spark):
    people = L.players(spark, [1, 2, 3, 4], born={i: L.dt.date(2018, 1, 1) - L.dt.timedelta(days=1000 * i) for i in range(1, 5)})
    line = spark.createDataFrame([(10.0, -5.0)], "slope double, intercept double")
    out = model.predict_rating(line, people, F.lit("2018-01-01").cast("date"))
    got = {r["player_id"]: r["predicted"] for r in out.collect()}
    # Raw 0.5, 1.5, 2.5, 3.5; above 1 is halved, and halved again while above 0.9.
    assert got == pytest.approx({1: 0.5, 2: 0.75, 3: 0.625, 4: 0.875})
    none = spark.createDataFrame([], "slope double, intercept double")
    assert model.predict_rating(none, people, F.current_date()).first()["predicted"] is None


def test_newest_rows_replace_older_ones(spark):
    schema = "player_id bigint, seq int, match_id bigint, v int"
    rows = spark.createDataFrame([(1, 1, 1, 10), (1, 2, 2, 20), (2, 1, 1, 30), (1, 2, 1, 5)], schema)
    newest = model.latest_per_player(rows)
    assert {(r["player_id"], r["v"]) for r in newest.collect()} == {(1, 20), (2, 30)}
    merged = model.replace_history(newest, spark.createDataFrame([(2, 9, 9, 99)], schema))
    assert {(r["player_id"], r["v"]) for r in merged.collect()} == {(1, 20), (2, 99)}
