"""Event metrics per match and player, contribution, and the history frame the folds run on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import expressions as X

COUNTERS = [
    "pass_key_ok",
    "pass_ok",
    "pass_key_bad",
    "pass_bad",
    "duel_neutral",
    "duel_lost",
    "duel_won",
    "fk_tags",
    "fk_accurate",
    "fk_penalty_goals",
    "shot_goal",
    "shot_on_target",
    "shot_other",
    "fouls",
    "own_goals",
    "passes",
    "duels",
    "free_kicks",
    "shots",
]
RATIOS = ["pass_accuracy", "duel_effectiveness", "freekick_effectiveness", "shot_effectiveness"]


def normalise_events(events: DataFrame) -> DataFrame:
    """Empty sub-event becomes 0, second of play becomes a number."""
    return events.withColumn(
        "subEventId",
        F.coalesce(F.nullif(F.col("subEventId").cast("string"), F.lit("")).try_cast("int"), F.lit(0)),
    ).withColumn("eventSec", F.col("eventSec").try_cast("double"))


def event_counters(events: DataFrame, off_target: str = "untagged") -> DataFrame:
    """All counters in one pass and one partially aggregated shuffle.

    `off_target` says which shots without tag 1801 count as tries: "untagged" those without 1802
    either, "tagged" those with 1802.
    """
    if off_target not in ("untagged", "tagged"):
        raise ValueError("off_target is 'untagged' or 'tagged'")
    ids = F.col("ids")
    kind = F.col("eventId")
    ok, key = X.has(ids, X.ACCURATE), X.has(ids, X.KEY_PASS)
    goal, bad = X.has(ids, X.GOAL), X.has(ids, X.NOT_ACCURATE)
    missed = ~ok & (~bad if off_target == "untagged" else bad)

    def n(condition: Column) -> Column:
        return F.count_if(condition)

    def total(condition: Column, amount: Column) -> Column:
        return F.sum(F.when(condition, amount).otherwise(F.lit(0)).cast("bigint"))

    is_pass, is_duel, is_fk = kind == X.PASS, kind == X.DUEL, kind == X.FREE_KICK
    is_shot = kind == X.SHOT
    aggregates = {
        "pass_key_ok": n(is_pass & key & ok),
        "pass_ok": n(is_pass & ~key & ok),
        "pass_key_bad": n(is_pass & key & ~ok),
        "pass_bad": n(is_pass & ~key & ~ok),
        "duel_neutral": total(is_duel, X.occurrences(ids, X.DUEL_NEUTRAL)),
        "duel_lost": total(is_duel, X.occurrences(ids, X.DUEL_LOST)),
        "duel_won": total(is_duel, X.occurrences(ids, X.DUEL_WON)),
        "fk_tags": total(is_fk, F.size(ids)),
        "fk_accurate": total(is_fk, X.occurrences(ids, X.ACCURATE)),
        "fk_penalty_goals": total(
            is_fk & (F.col("subEventId") == X.PENALTY), X.occurrences(ids, X.GOAL)
        ),
        "shot_goal": n(is_shot & ok & goal),
        "shot_on_target": n(is_shot & ok & ~goal),
        "shot_other": n(is_shot & missed),
        "fouls": n(kind == X.FOUL),
        "own_goals": total(F.lit(True), X.occurrences(ids, X.OWN_GOAL)),
        "passes": n(is_pass),
        "duels": n(is_duel),
        "free_kicks": n(is_fk),
        "shots": n(is_shot),
    }
    rows = events.select(
        "match_id",
        F.col("playerId").alias("player_id"),
        "eventId",
        "subEventId",
        X.tag_ids("tags").alias("ids"),
    )
    return rows.groupBy("match_id", "player_id").agg(
        *[aggregates[name].alias(name) for name in COUNTERS]
    )


def with_ratios(counters: DataFrame) -> DataFrame:
    """Add the four ratios. NULL where the player had no such event, or duels without an outcome."""
    c = F.col
    duel_outcomes = c("duel_neutral") + c("duel_lost") + c("duel_won")
    fk = F.coalesce(F.try_divide(c("fk_accurate") + c("fk_penalty_goals"), c("fk_tags")), F.lit(0.0))
    shot = F.coalesce(
        X.weighted_shot_accuracy(c("shot_goal"), c("shot_on_target"), c("shot_other")), F.lit(0.0)
    )
    return counters.select(
        "*",
        X.weighted_pass_accuracy(
            c("pass_key_ok"), c("pass_ok"), c("pass_key_bad"), c("pass_bad")
        ).alias("pass_accuracy"),
        F.try_divide(c("duel_won") + 0.5 * c("duel_neutral"), duel_outcomes).alias(
            "duel_effectiveness"
        ),
        F.when(c("free_kicks") > 0, fk).alias("freekick_effectiveness"),
        F.when(c("shots") > 0, shot).alias("shot_effectiveness"),
    )


def event_metrics(events: DataFrame, off_target: str = "untagged") -> DataFrame:
    return with_ratios(event_counters(events, off_target))


def _contribution(freekick_term: str) -> Column:
    if freekick_term not in ("tag_count", "effectiveness"):
        raise ValueError("freekick_term is 'tag_count' or 'effectiveness'")
    kick = "fk_tags" if freekick_term == "tag_count" else "freekick_effectiveness"
    terms = ["pass_accuracy", "duel_effectiveness", kick, "shot_effectiveness"]
    mean = sum((F.coalesce(F.col(t).cast("double"), F.lit(0.0)) for t in terms), F.lit(0.0)) / 4
    share = F.when(F.col("minutes") == F.col("full_time"), F.lit(1.05)).otherwise(
        F.col("minutes") / F.lit(90.0)
    )
    return F.when(F.col("minutes").isNotNull(), mean * share)


def contribution(
    metrics: DataFrame, minutes: DataFrame, freekick_term: str = "tag_count"
) -> DataFrame:
    """Mean of the four terms, raised for a full match and scaled by minutes otherwise."""
    joined = minutes.join(metrics, ["match_id", "player_id"], "left")
    return joined.select(
        "match_id",
        "player_id",
        "minutes",
        "full_time",
        _contribution(freekick_term).alias("contribution"),
    )


def player_history(
    appearances: DataFrame,
    metrics: DataFrame,
    players: DataFrame,
    freekick_term: str = "tag_count",
) -> DataFrame:
    """Appearances with that match's counters, contribution, and whether the player is known.

    Unknown players stay only where they played: they are rated, but belong to no roster.
    """
    known = players.select(F.col("Id").alias("player_id"), F.lit(True).alias("__known"))
    rows = (
        appearances.join(metrics, ["match_id", "player_id"], "left")
        .withColumn("contribution", _contribution(freekick_term))
        .fillna(0, subset=COUNTERS)
        .join(known, "player_id", "left")
        .withColumn("known", F.coalesce("__known", F.lit(False)))
        .withColumn("on_roster", F.col("on_roster") & F.col("known"))
        .filter(F.col("on_roster") | F.col("minutes").isNotNull())
    )
    return rows.select(
        "match_id",
        "seq",
        "match_date",
        "team_ord",
        "team_id",
        "player_id",
        "known",
        "on_roster",
        "minutes",
        "full_time",
        "contribution",
        *COUNTERS,
    )


def profile(history: DataFrame, players: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    """Totals per player over roster matches; accuracies come from the summed counters.

    `saved` holds totals of earlier matches, as `profile_totals` returns them.
    """
    totals = profile_totals(history, saved)
    names = players.select(F.col("Id").alias("player_id"), "name")
    return profile_view(totals).join(names, "player_id").select("player_id", "name", *PROFILE_COLUMNS)


PROFILE_SUMS = [
    "fouls",
    "shot_goal",
    "own_goals",
    "pass_key_ok",
    "pass_ok",
    "pass_key_bad",
    "pass_bad",
    "shot_on_target",
    "shot_other",
    "matches",
]
PROFILE_COLUMNS = ["fouls", "goals", "own_goals", "pass_acc", "shot_acc", "matches"]


def profile_totals(history: DataFrame, saved: DataFrame | None = None) -> DataFrame:
    rows = history.filter("on_roster").withColumn("matches", F.lit(1).cast("bigint"))
    rows = rows.select("player_id", *PROFILE_SUMS)
    if saved is not None:
        rows = rows.unionByName(saved.select("player_id", *PROFILE_SUMS))
    return rows.groupBy("player_id").agg(*[F.sum(c).alias(c) for c in PROFILE_SUMS])


def profile_view(totals: DataFrame) -> DataFrame:
    c = F.col
    passes = X.weighted_pass_accuracy(
        c("pass_key_ok"), c("pass_ok"), c("pass_key_bad"), c("pass_bad")
    )
    shots = X.weighted_shot_accuracy(c("shot_goal"), c("shot_on_target"), c("shot_other"))
    return totals.select(
        "player_id",
        "fouls",
        c("shot_goal").alias("goals"),
        "own_goals",
        F.coalesce(passes, F.lit(0.0)).alias("pass_acc"),
        F.coalesce(shots, F.lit(0.0)).alias("shot_acc"),
        "matches",
    )
