"""Match records to rows: teams, rosters, substitutions, minutes, incidents.

Everything up to the incident lists is a map over match records: substitutions and line-ups of a
team sit in the same record, so minutes need no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.expressions import date_part, day_number, label_title, positive_count
from touchline.schemas import ENTRY

FULL_TIME, FULL_TIME_EXTRA = 90, 120


def match_teams(matches: DataFrame) -> DataFrame:
    """One row per match and team; `team_ord` 0 is the team named first in the record."""
    full_time = F.when(F.col("duration") == "Regular", FULL_TIME).otherwise(FULL_TIME_EXTRA)
    rows = matches.select(
        "match_id",
        "seq",
        date_part(F.col("dateutc")).alias("match_date"),
        full_time.alias("full_time"),
        F.posexplode(F.map_entries("teamsData")).alias("team_ord", "entry"),
    )
    formation = F.col("entry.value.formation")
    return rows.select(
        "match_id",
        "seq",
        "match_date",
        "full_time",
        "team_ord",
        F.col("entry.key").try_cast("bigint").alias("team_id"),
        F.col("entry.value.hasFormation").alias("has_formation"),
        formation["lineup"].alias("lineup"),
        formation["bench"].alias("bench"),
        formation["substitutions"].alias("substitutions"),
    )


def match_team(matches: DataFrame) -> DataFrame:
    return match_teams(matches).select(
        "match_id", "seq", "match_date", "full_time", "team_ord", "team_id", "has_formation"
    )


def match_player(matches: DataFrame) -> DataFrame:
    """Bench and line-up entries, bench first, with their counters as numbers."""
    def section(name: str) -> Column:
        entries = F.coalesce(F.col(name), F.array().cast(f"array<{ENTRY}>"))
        return F.transform(
            entries,
            lambda e, i: F.struct(F.lit(name).alias("section"), i.alias("place"), e.alias("e")),
        )

    sections = F.concat(section("bench"), section("lineup"))
    rows = match_teams(matches).select(
        "match_id", "seq", "match_date", "team_ord", "team_id", F.explode(sections).alias("p")
    )
    return rows.select(
        "match_id",
        "seq",
        "match_date",
        "team_ord",
        "team_id",
        "p.section",
        "p.place",
        F.col("p.e.playerId").alias("player_id"),
        positive_count(F.col("p.e.goals")).alias("goals"),
        positive_count(F.col("p.e.ownGoals")).alias("own_goals"),
        positive_count(F.col("p.e.yellowCards")).alias("yellow_cards"),
        positive_count(F.col("p.e.redCards")).alias("red_cards"),
    )


def match_sub(matches: DataFrame) -> DataFrame:
    return match_teams(matches).select(
        "match_id",
        "team_ord",
        "team_id",
        F.posexplode("substitutions").alias("place", "s"),
    ).select(
        "match_id",
        "team_ord",
        "team_id",
        "place",
        F.col("s.playerIn").alias("player_in"),
        F.col("s.playerOut").alias("player_out"),
        F.col("s.minute").alias("minute"),
    )


def flatten_matches(matches: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return match_team(matches), match_player(matches), match_sub(matches)


def _ids(entries: Column) -> Column:
    none = F.array().cast("array<bigint>")
    return F.array_distinct(F.coalesce(F.transform(entries, lambda e: e["playerId"]), none))


def appearances(matches: DataFrame, require_flag: bool = False) -> DataFrame:
    """One row per match and player who is on the roster or came on.

    `minutes` is NULL for those who did not play: unused bench, and teams whose line-up or
    substitutions are missing. `require_flag` also asks for hasFormation = 1 on the team.
    """
    teams = match_teams(matches)
    present = F.col("lineup").isNotNull() & F.col("substitutions").isNotNull()
    if require_flag:
        present = present & F.coalesce(F.col("has_formation") == 1, F.lit(False))
    none = F.array().cast("array<bigint>")
    starters = F.when(present, _ids(F.col("lineup"))).otherwise(none)
    came_on = F.when(
        present,
        F.array_except(
            F.array_distinct(F.transform("substitutions", lambda s: s["playerIn"])),
            _ids(F.col("lineup")),
        ),
    ).otherwise(none)
    roster = F.array_union(_ids(F.col("bench")), _ids(F.col("lineup")))
    rows = teams.select(
        "match_id",
        "seq",
        "match_date",
        "full_time",
        "team_ord",
        "team_id",
        "substitutions",
        starters.alias("starters"),
        came_on.alias("came_on"),
        roster.alias("roster"),
    )

    def last_minute(side: str, player: Column) -> Column:
        hits = F.filter(F.col("substitutions"), lambda s: s[side] == player)
        return F.try_element_at(hits, F.lit(-1))["minute"]

    def entry(player: Column) -> Column:
        minutes = (
            F.when(
                F.array_contains("starters", player),
                F.coalesce(last_minute("playerOut", player), F.col("full_time")),
            )
            .when(
                F.array_contains("came_on", player),
                F.col("full_time") - last_minute("playerIn", player),
            )
            .cast("int")
        )
        return F.struct(
            player.alias("player_id"),
            F.array_contains("roster", player).alias("on_roster"),
            minutes.alias("minutes"),
        )

    people = F.transform(F.array_union("roster", "came_on"), entry)
    return rows.select(
        "match_id",
        "seq",
        "match_date",
        "full_time",
        "team_ord",
        "team_id",
        F.explode(people).alias("p"),
    ).select(
        "match_id", "seq", "match_date", "full_time", "team_ord", "team_id", "p.*"
    )


def minutes_played(matches: DataFrame, require_flag: bool = False) -> DataFrame:
    return (
        appearances(matches, require_flag)
        .filter(F.col("minutes").isNotNull())
        .select("match_id", "seq", "player_id", "minutes", "full_time")
    )


def roster(matches: DataFrame) -> DataFrame:
    return (
        appearances(matches)
        .filter("on_roster")
        .select("match_id", "seq", "match_date", "team_ord", "team_id", "player_id")
    )


def known_players(rows: DataFrame, players: DataFrame, key: str = "player_id") -> DataFrame:
    """Keep rows whose player is in the dimension."""
    return rows.join(players.select(F.col("Id").alias(key)), key, "left_semi")


def incident_rows(matches: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """One row per goal, own goal, yellow or red card entry, in record order within a match.

    Order: line-up then bench of the first team, line-up then bench of the second. Entries of
    players missing from the dimension are left out.
    """
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("number"))
            for kind in ("goals", "own_goals", "yellow_cards", "red_cards")
        ]
    )
    place = F.col("team_ord") * 2 + F.when(F.col("section") == "bench", 1).otherwise(0)
    hits = (
        match_player(matches)
        .select(
            "match_id",
            "team_id",
            "player_id",
            F.struct(place.alias("block"), F.col("place")).alias("at"),
            F.explode(F.filter(kinds, lambda k: k["number"].isNotNull())).alias("k"),
        )
        .select("match_id", "team_id", "player_id", "at", "k.kind", "k.number")
    )
    names = players.select(F.col("Id").alias("player_id"), F.col("name").alias("player_name"))
    team_names = teams.select(F.col("Id").alias("team_id"), F.col("name").alias("team_name"))
    return hits.join(names, "player_id").join(team_names, "team_id", "left")


def incidents(matches: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Four lists per match. A group is what one match record held, so it fits one row again."""
    rows = incident_rows(matches, players, teams)

    def listed(kind: str, *fields: str) -> Column:
        item = F.when(F.col("kind") == kind, F.struct("at", *fields))
        return F.transform(
            F.array_sort(F.collect_list(item)), lambda e: F.struct(*[e[f] for f in fields])
        ).alias(kind)

    lists = rows.groupBy("match_id").agg(
        listed("goals", "player_name", "team_name", "number"),
        listed("own_goals", "player_name", "team_name", "number"),
        listed("yellow_cards", "player_name", "team_name"),
        listed("red_cards", "player_name", "team_name"),
    )
    out = matches.select("match_id").join(lists, "match_id", "left")
    scored = "array<struct<player_name:string,team_name:string,number:int>>"
    carded = "array<struct<player_name:string,team_name:string>>"
    return out.select(
        "match_id",
        F.coalesce("goals", F.array().cast(scored)).alias("goals"),
        F.coalesce("own_goals", F.array().cast(scored)).alias("own_goals"),
        F.coalesce("yellow_cards", F.array().cast(carded)).alias("yellow_cards"),
        F.coalesce("red_cards", F.array().cast(carded)).alias("red_cards"),
    )


def with_match_order(matches: DataFrame) -> DataFrame:
    """Add `seq`, the day number of the match; ties are broken by match_id."""
    return matches.withColumn("seq", day_number(date_part(F.col("dateutc"))))


def match_counter(matches: DataFrame) -> DataFrame:
    """Matches held up to and including each day.

    The running sum goes over one row per calendar day, which a calendar bounds.
    """
    days = matches.groupBy(date_part(F.col("dateutc")).alias("match_date")).agg(
        F.count("*").alias("matches")
    )
    upto = Window.orderBy("match_date").rowsBetween(Window.unboundedPreceding, 0)
    return days.select("match_date", "matches", F.sum("matches").over(upto).alias("match_count"))


def titled(matches: DataFrame) -> DataFrame:
    """Match keys used by lookups: date, label without the score, and the two team ids."""
    ids = F.transform(F.map_keys("teamsData"), lambda k: k.try_cast("bigint"))
    return matches.select(
        "*",
        date_part(F.col("dateutc")).alias("match_date"),
        label_title(F.col("label")).alias("title"),
        F.get(ids, F.lit(0)).alias("first_team"),
        F.get(ids, F.lit(1)).alias("second_team"),
    )


def match_titles(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Matches titled by their teams, "first-second", where the label is not wanted."""
    name = lambda side: teams.select(
        F.col("Id").alias(f"{side}_team"), F.col("name").alias(f"{side}_name")
    )
    keyed = titled(matches).select("match_id", "first_team", "second_team")
    named = keyed.join(name("first"), "first_team").join(name("second"), "second_team")
    return named.select("match_id", F.concat_ws("-", "first_name", "second_name").alias("title"))
