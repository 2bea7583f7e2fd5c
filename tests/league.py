"""A small hand-made league, and the same values worked out with plain loops."""

from __future__ import annotations

import datetime as dt
import json
from itertools import combinations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from touchline import schemas

PASS, DUEL, FOUL, KICK, SHOT = 8, 1, 2, 3, 10


def entry(player, goals=None, own=None, yellow=None, red=None):
    return {"playerId": player, "goals": goals, "ownGoals": own, "yellowCards": yellow, "redCards": red}


def side(lineup, bench=(), subs=()):
    as_entries = lambda ps: [p if isinstance(p, dict) else entry(p) for p in ps]
    changes = None
    if subs is not None:
        changes = [{"playerIn": i, "playerOut": o, "minute": m} for i, o, m in subs]
    return {
        "hasFormation": 1,
        "formation": {
            "lineup": None if lineup is None else as_entries(lineup),
            "bench": as_entries(bench),
            "substitutions": changes,
        },
    }


def match(match_id, day, first, second, duration="Regular", label="Reds - Blues, 1 - 0", winner=10, teams=("10", "20")):
    return {
        "match_id": match_id,
        "seq": day,
        "dateutc": f"2018-05-{day:02d} 18:00:00",
        "label": label,
        "winner": winner,
        "gameweek": day,
        "duration": duration,
        "venue": "Park",
        "teamsData": {teams[0]: first, teams[1]: second},
    }


def event(match_id, player, kind, tags=(), sub="", sec="1.5"):
    return (match_id, 0, kind, sub, player, sec, [{"id": t} for t in tags])


def matches(spark: SparkSession, rows):
    """By way of JSON text, which keeps the order of the teams as a Python dict does not."""
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "line string")
    return lines.select(F.from_json("line", schemas.MATCH).alias("m")).select("m.*")


def events(spark: SparkSession, rows):
    from touchline.operators.metrics import normalise_events

    schema = schemas.EVENT.replace("subEventId int", "subEventId string").replace(
        "eventSec double", "eventSec string"
    )
    return normalise_events(spark.createDataFrame(rows, schema))


ROLES = ["GK", "DF", "DF", "DF", "MD", "MD", "FW"]


def players(spark: SparkSession, ids, names=None, roles=None, born=None):
    rows = [
        (
            i,
            (names or {}).get(i, f"P{i}"),
            (born or {}).get(i, dt.date(1990, 1, 1)),
            "Town",
            "left",
            (roles or {}).get(i, ROLES[n % 7]),
            180,
            75,
        )
        for n, i in enumerate(ids)
    ]
    return spark.createDataFrame(rows, schemas.PLAYER)


def teams(spark: SparkSession):
    return spark.createDataFrame([(10, "Reds"), (20, "Blues")], schemas.TEAM)


def clamp(x):
    return min(1.0, max(0.0, x))


def chemistry_by_hand(games, first_team="sum"):
    """games: per match, two lists of (player, change)."""
    state: dict[tuple[int, int], float] = {}

    def move(a, b, rises, size):
        key = (min(a, b), max(a, b))
        state[key] = clamp(state.get(key, 0.5) + (size if rises else -size))

    for first, second in games:
        for n, team in enumerate((first, second)):
            for (p, x), (q, y) in combinations(team, 2):
                joint = (abs(x) + abs(y)) / 2 if n == 0 and first_team == "sum" else abs(abs(x) - abs(y)) / 2
                move(p, q, x * y >= 0, joint)
        for p, x in first:
            for q, y in second:
                move(p, q, x * y <= 0, abs(abs(x) - abs(y)) / 2)
    return state
