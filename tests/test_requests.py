from __future__ import annotations

import datetime as dt
import json

import league as L
import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.plans import requests as rq
from touchline.sources import writers

DAY = dt.date(2018, 1, 1)
ONE, TWO = list(range(1, 8)), list(range(11, 18))


def born(score):
    """Birth date that the line below predicts `score` (up to 0.9) for."""
    return DAY - dt.timedelta(days=int(round(score * 10_000)))


def line(spark):
    return spark.createDataFrame([(1.0, 0.0)], "slope double, intercept double")


def ask(spark, rows):
    lines = [(json.dumps({"request_id": i, "date": str(DAY), "team1": a, "team2": b}),) for i, a, b in rows]
    df = spark.createDataFrame(lines, "line string")
    return df.select(F.from_json("line", schemas.WIN_REQUEST).alias("r")).select("r.*")


def team(name, ids):
    return {"name": name} | {f"p{i}": f"P{p}" for i, p in enumerate(ids)}


SCORES = {p: 0.3 + 0.02 * n for n, p in enumerate(ONE + TWO)}


def people(spark, scores=SCORES, **kw):
    return L.players(spark, sorted(scores), born={p: born(s) for p, s in scores.items()}, **kw)


MATCHES = {p: 4 if p in (3, 6, 14) else 9 for p in ONE + TWO}
CHEM = {(1, 2): 0.9, (1, 3): 0.1, (4, 7): 1.0, (11, 17): 0.0, (12, 15): 0.7, (1, 11): 0.2}
CLUSTER = {p: p % 3 for p in ONE + TWO}
RATING = {p: 0.1 * (p % 10) for p in ONE + TWO}


def state(spark):
    return {
        "profile": spark.createDataFrame(list(MATCHES.items()), "player_id bigint, matches bigint"),
        "ratings": spark.createDataFrame(list(RATING.items()), "player_id bigint, rating double"),
        "chemistry": spark.createDataFrame(
            [(a, b, c) for (a, b), c in CHEM.items()], "p_lo bigint, p_hi bigint, chem double"
        ),
        "line": line(spark),
    }


def clusters(spark):
    return spark.createDataFrame(list(CLUSTER.items()), "player_id bigint, cluster int")


def coefficients(ids, traversal="all", shift=0.0):
    out = {}
    left = list(ids)
    for pos, p in enumerate(ids):
        if traversal == "alternate":
            if pos % 2:
                continue
            left.remove(p)
            others = left
        else:
            others = [q for q in ids if q != p]
        if MATCHES[p] >= 5:
            out[p] = sum(CHEM.get((min(p, q), max(p, q)), 0.5) for q in others) / len(others) - shift
    return out


def chances(first, second, norm=8, cluster=True, traversal="all", shift=0.0):
    strength = []
    for ids in (first, second):
        coeff = coefficients(ids, traversal, shift)
        total = norm * sum(c * SCORES[p] for p, c in coeff.items())
        seen = ids[::2] if traversal == "alternate" else ids
        for p in seen:
            if cluster and p not in coeff:
                alike = [q for q in CLUSTER if CLUSTER[q] == CLUSTER[p]]
                total += sum(RATING[q] * coeff[q] for q in alike if q in coeff) / len(alike)
        strength.append(total / 11)
    a = (0.5 + strength[0] - sum(strength) / 2) * 100
    return a, 100 - a


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"norm_factor": 5},
        {"cluster_term": "none"},
        {"traversal": "alternate", "coefficient": "mean_minus_one"},
    ],
)
def test_win_chance(spark, options):
    requests = ask(spark, [(1, team("Reds", ONE), team("Blues", TWO)), (2, team("Blues", TWO), team("Reds", ONE))])
    got = {
        r["request_id"]: r
        for r in rq.win_chance(requests, people(spark), **state(spark), clusters=clusters(spark), **options).collect()
    }
    hand = {
        "norm": options.get("norm_factor", 8),
        "cluster": options.get("cluster_term") != "none",
        "traversal": options.get("traversal", "all"),
        "shift": 1.0 if "coefficient" in options else 0.0,
    }
    for i, pair in ((1, (ONE, TWO)), (2, (TWO, ONE))):
        assert got[i]["status"] == "ok"
        assert (got[i]["chance_1"], got[i]["chance_2"]) == pytest.approx(chances(*pair, **hand))
    assert (got[1]["team_1"], got[1]["team_2"]) == ("Reds", "Blues")
    assert got[1]["chance_1"] + got[1]["chance_2"] == pytest.approx(100)


def test_retired_and_invalid(spark):
    scores = SCORES | {7: 0.1, 17: 0.15}
    rows = [
        (1, team("A", ONE), team("B", TWO)),
        (2, team("A", [1, 2, 3, 4, 5, 6]), team("B", TWO[:-1])),
        (3, team("A", [1, 2, 3, 4, 5, 6, 1]), team("B", ["nobody"])),
    ]
    answers = rq.win_chance(ask(spark, rows), people(spark, scores), **state(spark), clusters=clusters(spark))
    got = {r["request_id"]: r for r in answers.collect()}
    assert (got[1]["status"], got[1]["retired_1"], got[1]["retired_2"]) == ("retired", [7], [17])
    assert got[2]["status"] == "invalid" and got[2]["chance_1"] is None
    assert got[3]["status"] == "invalid"
    docs = {r["request_id"]: r for r in rq.win_chance_documents(answers).collect()}
    assert docs[1]["isInvalid"] == "True" and docs[1]["team1_retired_players"] == [7]
    assert docs[2]["team1_retired_players"] is None and docs[2]["team1"] is None


def test_thresholds_are_parameters(spark):
    requests = ask(spark, [(1, team("A", ONE), team("B", TWO))])
    answer = lambda **kw: rq.win_chance(
        requests, people(spark), **state(spark), cluster_term="none", **kw
    ).first()
    assert answer(retired_below=0.31)["retired_1"] == [1]
    nobody = answer(min_matches=10)
    assert (nobody["chance_1"], nobody["chance_2"]) == (50.0, 50.0)


def test_namesakes_all_take_part(spark):
    names = {1: "Same", 2: "Same"}
    requests = ask(spark, [(1, {"name": "A", "p": "Same"}, team("B", [3]))])
    lineups = rq.request_lineups(requests, people(spark, names=names)).collect()
    assert {(r["side"], r["player_id"]) for r in lineups} == {(1, 1), (1, 2), (2, 3)}


@pytest.mark.parametrize("made_up_to", [64, 3, 0])
@pytest.mark.parametrize("traversal", ["all", "alternate"])
def test_mean_chemistry_of_small_and_large_sides(spark, monkeypatch, made_up_to, traversal):
    monkeypatch.setattr(rq, "MADE_UP_TO", made_up_to, raising=False)
    sides = {(1, 1): [1, 2, 4], (1, 2): [4, 7, 11, 12, 15, 17], (2, 1): [1]}
    rows = [(r, s, p) for (r, s), ids in sides.items() for p in ids]
    lineups = spark.createDataFrame(rows, "request_id bigint, side int, player_id bigint")
    given = state(spark)
    got = rq.mean_chemistry(lineups, given["profile"], given["chemistry"], traversal)
    got = {(r["request_id"], r["side"], r["player_id"]): r["coeff"] for r in got.collect()}
    want = {}
    for (r, s), ids in sides.items():
        left = list(ids)
        for pos, p in enumerate(ids):
            if traversal == "alternate" and pos % 2:
                continue
            left.remove(p)
            others = list(left) if traversal == "alternate" else [q for q in ids if q != p]
            if others and MATCHES[p] >= 5:
                want[r, s, p] = sum(CHEM.get((min(p, q), max(p, q)), 0.5) for q in others) / len(others)
    assert got == pytest.approx(want)


def test_small_sides_do_not_open_all_stored_pairs_of_their_players(spark):
    """Two players who met 3,000 others each: what meets the stored pairs is the one pair of their side."""
    lineups = spark.createDataFrame([(1, 1, 1), (1, 1, 2)], "request_id bigint, side int, player_id bigint")
    pairs = spark.range(2, 3002).select(F.explode(F.array(F.lit(1), F.lit(2))).alias("p_lo"), F.col("id").alias("p_hi"), F.lit(0.25).alias("chem"))
    pairs = pairs.filter("p_lo < p_hi").withColumn("p_lo", F.col("p_lo").cast("bigint"))
    placed = rq._placed(lineups)
    met = rq._met(placed, pairs)
    assert [(r["p_lo"], r["p_hi"], r["chem"]) for r in met.collect()] == [(1, 2, 0.25)]
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    with_pairs = [line for line in plan.splitlines() if "Join Inner" in line and "p_lo" in line and "request_id" not in line]
    assert with_pairs and all("p_hi" in line for line in with_pairs)


@pytest.mark.parametrize(
    ("roles", "valid"),
    [
        ("GK DF DF DF MD MD FW", True),
        ("GK GK DF DF DF MD MD FW", False),
        ("GK DF DF MD MD FW", False),
        ("GK DF DF DF MD FW", False),
        ("GK DF DF DF MD MD", False),
        ("GK DF DF DF MD MD FW FW FW FW FW FW FW", True),
    ],
)
def test_role_mix(spark, roles, valid):
    rows = [(1, 1, i, r) for i, r in enumerate(roles.split())]
    lineups = spark.createDataFrame(rows, "request_id bigint, side int, player_id bigint, role string")
    assert rq.lineup_validity(lineups).first()["valid"] is valid


def test_profile_answers(spark):
    schema = "player_id bigint, fouls bigint, goals bigint, own_goals bigint, pass_acc double, shot_acc double"
    profile = spark.createDataFrame([(1, 3, 2, 1, 0.5, 0.25), (2, 9, 9, 9, 0.9, 0.9)], schema)
    asked = spark.createDataFrame([(1, "Same"), (2, "P3"), (3, "Nobody"), (4, "Same")], schemas.PROFILE_REQUEST)
    known = L.players(spark, [2, 1, 3], names={1: "Same", 2: "Same"})
    got = {r["request_id"]: r for r in rq.profile_answers(asked, known, profile).collect()}
    assert {i for i, r in got.items() if r["profile_found"]} == {1, 4} and set(got) == {1, 2, 3, 4}
    assert (got[1]["fouls"], got[1]["percent_pass_accuracy"], got[1]["foot"]) == (3, 0.5, "left")


@pytest.fixture(scope="module")
def archive(spark):
    a = L.side([L.entry(1, goals="2")])
    return L.matches(
        spark,
        [
            L.match(5, 3, a, L.side([11])),
            L.match(6, 3, L.side([1]), L.side([11]), label="Reds - Blues, 4 - 4"),
            L.match(7, 4, L.side([11]), a, label="Blues - Reds, 0 - 0", winner=0, teams=("20", "10")),
        ],
    )


def test_match_answers(spark, archive, tmp_path):
    rows = [
        (1, dt.date(2018, 5, 3), "Reds - Blues, 9 - 9"),
        (2, dt.date(2018, 5, 4), "Reds - Blues"),
        (3, dt.date(2018, 5, 4), "Blues - Reds, 0 - 0"),
    ]
    asked = spark.createDataFrame(rows, schemas.MATCH_REQUEST)
    known = L.players(spark, [1, 11])
    answers = rq.match_answers(asked, archive, known, L.teams(spark))
    got = {r["request_id"]: r for r in answers.collect()}
    assert (got[1]["match_id"], got[1]["winner"], got[1]["winner_name"]) == (5, 10, "Reds")
    assert [tuple(g) for g in got[1]["goals"]] == [("P1", "Reds", 2)]
    assert got[2]["match_found"] is False and got[2]["match_id"] is None
    assert (got[3]["match_id"], got[3]["winner_name"]) == (7, None)

    writers.write_answers(rq.match_documents(answers), str(tmp_path / "out"))
    docs = {d["request_id"]: d for d in map(json.loads, spark.read.text(str(tmp_path / "out")).toPandas()["value"])}
    assert docs[2] == {"request_id": 2, "match_found": False}
    assert docs[1]["teams_playing"] == "Reds - Blues, 1 - 0" and docs[1]["yellow_cards"] == []


def test_match_answers_by_pair(spark, archive):
    rows = [(1, dt.date(2018, 5, 4), 10, 20), (2, dt.date(2018, 5, 4), 20, 10), (3, dt.date(2018, 5, 5), 20, 10)]
    asked = spark.createDataFrame(rows, "request_id bigint, date date, team_a bigint, team_b bigint")
    out = rq.match_answers_by_pair(asked, archive, L.players(spark, [1, 11]), L.teams(spark))
    assert {r["request_id"]: r["match_id"] for r in out.collect()} == {1: 7, 2: 7, 3: None}
