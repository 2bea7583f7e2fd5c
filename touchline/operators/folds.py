"""Values carried from match to match: prior totals, ratings, pair chemistry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import START_CHEMISTRY, START_RATING, pair_key
from touchline.operators.scan import (
    BLOCK,
    LIMIT,
    affine,
    clamped_sum,
    fold_maps,
    fold_trace,
    long_keys,
    running_total,
    with_blocks,
)

ORDER = ["seq", "match_id"]


def in_blocks(history: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The history, cut into blocks for players with more than `limit` appearances, if any."""
    long = long_keys(history, ["player_id"], limit)
    return history if long is None else with_blocks(history, ["player_id"], ORDER, long)


def prior_totals(
    history: DataFrame, saved: DataFrame | None = None, limit: int = LIMIT
) -> DataFrame:
    """Fouls and own goals of the player's roster matches before this one."""
    rows = _with_priors(in_blocks(history, limit), saved, limit)
    return rows.select(*history.columns, "prior_fouls", "prior_own_goals")


def _with_priors(rows: DataFrame, saved: DataFrame | None, limit: int) -> DataFrame:
    """Add the prior totals, and `prior_played`, how often the player has played before."""
    counted = rows.select(
        "*",
        F.when(F.col("on_roster"), F.col("fouls")).otherwise(F.lit(0)).alias("__fouls"),
        F.when(F.col("on_roster"), F.col("own_goals")).otherwise(F.lit(0)).alias("__own"),
        F.col("contribution").isNotNull().cast("bigint").alias("__played"),
    )
    sums = {"prior_fouls": "__fouls", "prior_own_goals": "__own", "prior_played": "__played"}
    out = running_total(counted, ["player_id"], ORDER, sums, limit).drop(*sums.values())
    if saved is None:
        return out
    before = saved.select(
        "player_id", F.col("fouls").alias("__f"), F.col("own_goals").alias("__o")
    )
    return out.join(before, "player_id", "left").select(
        *rows.columns,
        (F.col("prior_fouls") + F.coalesce("__f", F.lit(0))).alias("prior_fouls"),
        (F.col("prior_own_goals") + F.coalesce("__o", F.lit(0))).alias("prior_own_goals"),
        "prior_played",
    )


def ratings(
    history: DataFrame,
    penalty: str = "prior_total",
    saved_ratings: DataFrame | None = None,
    saved_totals: DataFrame | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """Rating after every appearance, and its change; a match not played changes nothing.

    `penalty` takes fouls and own goals either from the matches before ("prior_total") or from the
    match itself ("match"). `saved_ratings` (player_id, rating) continues an earlier run. The rows
    per player are counted when this is called, so `history` had better be a written table.
    """
    rows = _with_priors(in_blocks(history, limit), saved_totals, limit)
    if penalty == "prior_total":
        fouls, own = F.col("prior_fouls"), F.col("prior_own_goals")
    elif penalty == "match":
        fouls, own = F.col("fouls"), F.col("own_goals")
    else:
        raise ValueError("penalty is 'prior_total' or 'match'")
    # The first match of an unknown player only opens the rating, without moving it.
    opens = ~F.col("known") & (F.col("prior_played") == 0)
    if saved_ratings is not None:
        rated = saved_ratings.select("player_id", F.lit(True).alias("__rated"))
        rows = rows.join(rated, "player_id", "left")
        opens = opens & F.col("__rated").isNull()
    c = F.col("contribution")
    rows = rows.withColumn("perf", c - (0.005 * fouls * c + 0.05 * own * c))
    moves = F.col("perf").isNotNull() & ~opens
    rows = rows.select(
        "*",
        F.when(moves, 0.5).otherwise(1.0).alias("a"),
        F.when(moves, F.col("perf") / 2).otherwise(0.0).alias("b"),
    )
    payload = [
        "match_date",
        "team_ord",
        "known",
        "on_roster",
        "contribution",
        "prior_fouls",
        "prior_own_goals",
        "perf",
        "a",
        "b",
    ]
    start = None
    if saved_ratings is not None:
        start = saved_ratings.select("player_id", F.col("rating").alias("state"))
    block = [c for c in rows.columns if c == BLOCK]
    traced = fold_trace(
        rows.select("player_id", *ORDER, *block, *payload),
        ["player_id"],
        ORDER,
        payload,
        affine(),
        start,
        START_RATING,
        limit,
    )
    return traced.drop("a", "b").withColumn(
        "change", F.col("after") - F.col("before")
    ).withColumnRenamed("after", "rating").drop("before")


def current_ratings(rated: DataFrame) -> DataFrame:
    """Last rating of every player seen; players never seen stand at the start value.

    A known player is rated from the outset, an unknown one from the first match played.
    """
    seen = rated.filter(F.col("known") | F.col("contribution").isNotNull())
    return seen.groupBy("player_id").agg(F.max_by("rating", F.struct(*ORDER)).alias("rating"))


def _same_direction(x: Column, y: Column) -> Column:
    return ((x <= 0) & (y <= 0)) | ((x >= 0) & (y >= 0))


def _opposite_direction(x: Column, y: Column) -> Column:
    return ((x <= 0) & (y >= 0)) | ((x >= 0) & (y <= 0))


def chemistry_steps(rated: DataFrame, first_team_delta: str = "sum", of: DataFrame | None = None) -> DataFrame:
    """The chemistry step of every roster pair of every match, or only of pairs with a player out of `of` (player_id).

    A pair is two people of one match record, so the self-join on match_id grows with the square of
    a roster, not of the data.
    """
    if first_team_delta not in ("sum", "diff"):
        raise ValueError("first_team_delta is 'sum' or 'diff'")
    people = rated.filter("on_roster").select("match_id", "seq", "team_ord", "player_id", "change")
    if of is None:
        people = people.withColumn("wanted", F.lit(True))
    else:
        wanted = of.select("player_id").distinct().withColumn("__wanted", F.lit(True))
        people = people.join(wanted, "player_id", "left").withColumn("wanted", F.col("__wanted").isNotNull())
    left = people.select(
        "match_id",
        "seq",
        F.col("team_ord").alias("t1"),
        F.col("player_id").alias("p1"),
        F.col("change").alias("d1"),
        F.col("wanted").alias("w1"),
    )
    right = people.select(
        "match_id",
        "seq",
        F.col("team_ord").alias("t2"),
        F.col("player_id").alias("p2"),
        F.col("change").alias("d2"),
        F.col("wanted").alias("w2"),
    )
    # Both sides carry the same columns, so they are shuffled once.
    pairs = left.join(right, ["match_id", "seq"]).filter(F.col("p1") < F.col("p2")).filter("w1 OR w2")
    d1, d2 = F.col("d1"), F.col("d2")
    spread = F.abs(F.abs(d1) - F.abs(d2)) / 2
    joint = (F.abs(d1) + F.abs(d2)) / 2
    mates = F.col("t1") == F.col("t2")
    amount = spread
    if first_team_delta == "sum":
        amount = F.when(mates & (F.col("t1") == 0), joint).otherwise(spread)
    rises = F.when(mates, _same_direction(d1, d2)).otherwise(_opposite_direction(d1, d2))
    lo, hi = pair_key(F.col("p1"), F.col("p2"))
    return pairs.select(
        "match_id",
        "seq",
        lo.alias("p_lo"),
        hi.alias("p_hi"),
        F.when(rises, amount).otherwise(-amount).alias("step"),
    )


def chemistry(
    rated: DataFrame,
    first_team_delta: str = "sum",
    saved: DataFrame | None = None,
    limit: int = LIMIT,
    of: DataFrame | None = None,
    keep: bool = False,
) -> DataFrame:
    """Chemistry of every pair that met; a pair that never met stands at the start value.

    With `of` (player_id) only pairs with one of these players.

    Steps are clamped to [0, 1] one after the other in match order. `saved` (p_lo, p_hi, chem, meetings)
    continues an earlier run; only pairs that met in this one are returned, or with `keep` the other saved
    ones too, as they are.
    """
    fold = clamped_sum()
    pair = ["p_lo", "p_hi"]
    steps = chemistry_steps(rated, first_team_delta, of)
    often = long_keys(rated.filter("on_roster"), ["player_id"], limit)
    if often is not None:
        # A pair meets at most as often as either of the two appears.
        ids = often.select("player_id")
        among = steps.join(ids.withColumnRenamed("player_id", "p_lo"), "p_lo", "left_semi").join(
            ids.withColumnRenamed("player_id", "p_hi"), "p_hi", "left_semi"
        )
        long = long_keys(among, pair, limit)
        if long is not None:
            steps = with_blocks(steps, pair, ORDER, long)
    maps = fold_maps(steps, pair, ORDER, ["step"], fold, limit)
    if saved is None:
        return maps.select(
            "p_lo",
            "p_hi",
            fold.apply(F.col("__map"), F.lit(START_CHEMISTRY)).alias("chem"),
            F.col("__map.n").alias("meetings"),
        )
    old = saved.select(
        "p_lo", "p_hi", F.col("chem").alias("__old"), F.col("meetings").alias("__n")
    )
    both = maps.join(old, ["p_lo", "p_hi"], "full" if keep else "left")
    start, none = F.coalesce("__old", F.lit(START_CHEMISTRY)), F.lit(0).cast("bigint")
    met = F.col("__map").isNotNull()
    return both.select(
        "p_lo",
        "p_hi",
        F.when(met, fold.apply(F.col("__map"), start)).otherwise(F.col("__old")).alias("chem"),
        (F.coalesce("__n", none) + F.coalesce("__map.n", none)).alias("meetings"),
    )
