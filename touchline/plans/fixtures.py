"""The domain tables, derived from the star-schema and event tables of the test data.

Every expression here has a twin in `oracle.py`. All rows of the tables take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.matches import with_match_order
from touchline.schemas import ENTRY, SUBSTITUTION, TAGS, TEAMS_DATA

FIRST_DAY = "2024-01-01"
PLAYERS_PER_TEAM = 18
STARTERS = 11

#: Pairs of teams whose match records, of all days, one task builds.
PAIRS_PER_TASK = 100

# Event type to event kind, and to a drawing's word.
EVENT_KINDS = {"click": 8, "view": 1, "signup": 3, "purchase": 10, "error": 2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", _k())


#: By application and folder; the tables do not change under a running application.
_TEAM_COUNTS: dict[tuple[str, str], int] = {}


def team_count(spark: SparkSession, sf_dir: str) -> int:
    """An even number of teams, about eighteen players each; looked up once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TEAM_COUNTS:
        users = table(spark, sf_dir, "events").agg(F.max("user_id") + 1).first()[0]
        _TEAM_COUNTS[key] = max(4, 2 * (users // (2 * PLAYERS_PER_TEAM)))
    return _TEAM_COUNTS[key]


def _day(column: str) -> Column:
    return F.datediff(F.to_date(column), F.lit(FIRST_DAY).cast("date"))


def _match_of(team: Column, day: Column, teams: int) -> Column:
    """Match of a team on a day: even teams are first, odd ones are met in rotation."""
    half = teams // 2
    turn = day % half
    first = F.when(team % 2 == 0, team / 2).otherwise(F.pmod((team - 1) / 2 - turn, F.lit(half)))
    return day * half + first.cast("bigint")


def tags() -> Column:
    k, kind = F.col("k"), F.col("eventId")
    none = F.array().cast(TAGS)

    def tag(condition: Column, number: Column | int) -> Column:
        number = F.lit(number) if isinstance(number, int) else number
        one = F.array(F.struct(number.cast("bigint").alias("id")))
        return F.when(condition, one).otherwise(none)

    return F.concat(
        tag(k % 2 == 0, 1801),
        tag(k % 5 == 0, 302),
        tag((k % 2 == 1) & (k % 3 != 0), 1802),
        tag(k % 4 == 0, 101),
        tag((kind == 1) & (k % 7 != 0), 701 + k % 3),
        tag(k == 13, 102),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records, each in the match its player's team plays that day."""
    kind = F.create_map(*[F.lit(x) for kv in EVENT_KINDS.items() for x in kv])
    teams = team_count(spark, sf_dir)
    rows = _raw_events(spark, sf_dir).select(
        "k",
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("playerId"),
        kind[F.col("event_type")].alias("eventId"),
        _day("ts").cast("bigint").alias("day"),
        F.col("value").alias("eventSec"),
    )
    sub = F.when(F.col("k") % 10 == 0, "35").when(F.col("k") % 10 == 1, "").otherwise("30")
    return rows.select(
        _match_of(F.col("playerId") % teams, F.col("day"), teams).alias("match_id"),
        "seq",
        "eventId",
        sub.alias("subEventId"),
        "playerId",
        "eventSec",
        tags().alias("tags"),
    )


def _entry(day: str) -> str:
    """A line-up or bench entry of player p, with counters as the text a match record holds."""
    return f"""named_struct(
        'playerId', p,
        'ownGoals', CASE (p + {day}) % 29 WHEN 0 THEN '1' WHEN 1 THEN 'null' ELSE '0' END,
        'goals', CASE (p + {day}) % 7 WHEN 0 THEN '2' WHEN 1 THEN 'null' WHEN 2 THEN 'x' ELSE '0' END,
        'yellowCards', CASE (p * 3 + {day}) % 11 WHEN 0 THEN '55' ELSE '0' END,
        'redCards', CASE (p * 5 + {day}) % 37 WHEN 0 THEN '80' ELSE 'null' END)"""


def _squads(spark: SparkSession, sf_dir: str, teams: int) -> DataFrame:
    """Players of each team in slot order."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("p")).distinct()
    return users.groupBy((F.col("p") % teams).alias("team")).agg(
        F.array_sort(F.collect_set("p")).alias("ids")
    )


def _side(ids: str, team: str, teams: int, second: bool) -> Column:
    """One team's part of a match record, from its player ids in slot order and the `day`."""
    players = f"coalesce({ids}, cast(array() AS array<bigint>))"
    starts = f"p div {teams} < {STARTERS}"
    listed = f"NOT {starts} AND day % greatest(p div {teams} - 9, 1) = 0"

    def entries(condition: str) -> str:
        return f"transform(filter({players}, p -> {condition}), p -> {_entry('day')})"

    def change(out_slot: int, in_slot: int, minute: str, condition: str = "true") -> str:
        player_in = f"{team} + {in_slot * teams}"
        return f"""CASE WHEN {condition} AND array_contains({players}, {player_in}) THEN named_struct(
            'playerIn', {player_in}, 'playerOut', {team} + {out_slot * teams},
            'minute', cast({minute} AS int)) END"""

    changes = [
        change(0, 11, "45 + day % 10"),
        change(1, 12, "55 + day % 10"),
        change(2, 13, "CASE WHEN day % 6 = 0 THEN 0 ELSE 65 + day % 10 END"),
        # The same player is entered twice; the later entry counts.
        change(3, 11, "85 + day % 10", "day % 4 = 1"),
    ]
    present = "day % 9 <> 8" if second else "true"
    return F.expr(
        f"""named_struct(
        'hasFormation', CASE WHEN {present} THEN 1 ELSE 0 END,
        'formation', named_struct(
          'lineup', cast({entries(starts)} AS array<{ENTRY}>),
          'bench', cast({entries(listed)} AS array<{ENTRY}>),
          'substitutions', CASE WHEN {present} THEN
            cast(array_compact(array({", ".join(changes)})) AS array<{SUBSTITUTION}>) END))"""
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested match records: every team plays once on every day that has events.

    Bench slot s is on the roster every (s - 9)th day, so that players differ in experience, and
    some come on without being listed.
    """
    teams = team_count(spark, sf_dir)
    days = (
        table(spark, sf_dir, "events")
        .select(F.to_date("ts").alias("date"), _day("ts").cast("bigint").alias("day"))
        .distinct()
    )
    half = teams // 2
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(half - 1).cast("bigint")))
    games = days.select("*", each.alias("i")).select(
        "*",
        (F.col("i") * 2).alias("first"),
        ((F.col("i") * 2 + 1 + 2 * (F.col("day") % half)) % teams).alias("second"),
    )
    if half > PAIRS_PER_TASK:
        # The days fit one task, but not the records of all teams on them.
        games = games.repartition(-(-half // PAIRS_PER_TASK), "day", "i")
    squads = _squads(spark, sf_dir, teams)
    one = squads.select(F.col("team").alias("first"), F.col("ids").alias("ids1"))
    two = squads.select(F.col("team").alias("second"), F.col("ids").alias("ids2"))
    joined = games.join(one, "first", "left").join(two, "second", "left")
    day, first, second = F.col("day"), F.col("first"), F.col("second")
    teams_data = F.map_from_entries(
        F.array(
            F.struct(first.cast("string"), _side("ids1", "first", teams, False)),
            F.struct(second.cast("string"), _side("ids2", "second", teams, True)),
        )
    )
    outcome = (day + F.col("i")) % 3
    label = F.concat(
        F.lit("Team "), first, F.lit(" - Team "), second, F.lit(", "), day % 3, F.lit(" - "), F.col("i") % 3
    )
    rows = joined.select(
        (day * half + F.col("i")).alias("match_id"),
        F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" 18:00:00")).alias("dateutc"),
        label.alias("label"),
        F.when(outcome == 0, first).when(outcome == 1, second).otherwise(0).alias("winner"),
        (day + 1).cast("int").alias("gameweek"),
        F.when(day % 5 == 0, "ExtraTime").otherwise("Regular").alias("duration"),
        F.concat(F.lit("Venue "), first).alias("venue"),
        teams_data.alias("teamsData"),
    )
    return with_match_order(rows)


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit are the known players; those in debt stay unknown."""
    key = F.col("c_custkey")
    slot = F.floor(key / team_count(spark, sf_dir)).cast("bigint")
    spare = F.element_at(F.array(F.lit("DF"), F.lit("MD"), F.lit("FW")), (slot % 3 + 1).cast("int"))
    role = (
        F.when(slot.isin(0, 11), "GK")
        .when(slot <= 4, "DF")
        .when(slot <= 8, "MD")
        .when(slot <= 10, "FW")
        .otherwise(spare)
    )
    return (
        table(spark, sf_dir, "customer")
        .filter(F.col("c_acctbal") >= 0)
        .select(
            key.alias("Id"),
            F.col("c_name").alias("name"),
            F.date_add(F.lit("1980-01-01").cast("date"), (key * 37 % 7300).cast("int")).alias("birthDate"),
            F.col("c_mktsegment").alias("birthArea"),
            F.when(key % 2 == 0, "right").otherwise("left").alias("foot"),
            role.alias("role"),
            (160 + key % 40).cast("int").alias("height"),
            (60 + key % 35).cast("int").alias("weight"),
        )
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("Id"), F.col("s_name").alias("name")
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part to supplier, with supplier ids spread out so that some have no out-edges."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("src"),
        (F.col("l_suppkey") * 25).cast("string").alias("dst"),
    )


def doodles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawing records, with a fault of each kind at its own value of k."""
    k, v, user = F.col("k"), F.col("value"), F.col("user_id")
    word = F.when(k == 94, F.concat("event_type", F.lit("7"))).when(k == 93, "  ").otherwise(
        F.col("event_type")
    )
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    letter = lambda n: F.substring(F.lit(letters), (n % 26 + 1).cast("int"), F.lit(1))
    code = F.concat(letter(user % 3), letter(F.floor(user / 3) % 4))
    code = F.when(k == 97, F.lower(code)).when(k == 92, F.concat(code, F.lit("X"))).otherwise(code)
    width = F.when(k == 95, 15).otherwise(16)
    key = F.lpad(F.col("event_id").cast("string"), width, F.lit("0"))
    n = (k % 4 + 1).cast("int")
    xs = F.slice(F.array(*[v + i for i in range(4)]), F.lit(1), n)
    ys = F.slice(F.array(*[k * 2.0 + i for i in range(4)]), F.lit(1), n)
    second = F.when(k == 96, F.slice(ys, 1, n - 1)).otherwise(ys)
    stroke = F.array(xs, second)
    drawing = (
        F.when(k == 98, F.array().cast("array<array<array<double>>>"))
        .when(k == 91, F.array(F.array(xs)))
        .otherwise(F.array(stroke, F.array(xs, ys)))
    )
    return _raw_events(spark, sf_dir).select(
        word.alias("word"),
        code.alias("countrycode"),
        F.when(k != 90, k % 2 == 0).alias("recognized"),
        key.alias("key_id"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" UTC")).alias("timestamp"),
        drawing.alias("drawing"),
    )


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doodles(spark, sf_dir).select("key_id", "word", "countrycode")


def stroke_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return _raw_events(spark, sf_dir).select(
        F.lpad(F.col("event_id").cast("string"), 16, "0").alias("key_id"),
        F.col("event_type").alias("word"),
        F.when(k % 2 == 0, "TRUE").otherwise("FALSE").alias("recognized"),
        F.when(k == 89, "many").otherwise((k % 12 + 1).cast("string")).alias("Total_Strokes"),
    )


def win_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every match, the chance of its teams half a year on, with two bench players each."""
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("playerId"), F.col("c_name").alias("name")
    )
    count = team_count(spark, sf_dir)
    squads = _squads(spark, sf_dir, count).select(
        F.col("team").cast("string").alias("team"), F.explode("ids").alias("playerId")
    )
    slot = F.floor(F.col("playerId") / count)
    named_squads = squads.filter(slot.isin(0, 1, 2, 3, 4, 5, 6, 7, 9, 16, 17))
    rows = matches(spark, sf_dir).select(
        "match_id", "dateutc", F.posexplode(F.map_keys("teamsData")).alias("ord", "team")
    )
    starters = rows.join(named_squads, "team")
    named = starters.join(names, "playerId").groupBy("match_id", "dateutc", "ord", "team").agg(
        F.array_sort(F.collect_list(F.struct("playerId", "name"))).alias("people")
    )
    team_map = F.map_from_entries(
        F.concat(
            F.array(F.struct(F.lit("name").alias("k"), F.concat(F.lit("Team "), "team").alias("v"))),
            F.transform(
                "people",
                lambda p, i: F.struct(
                    F.concat(F.lit("player"), i + 1).alias("k"), p["name"].alias("v")
                ),
            ),
        )
    )
    side = lambda n: F.max_by("team_map", F.when(F.col("ord") == n, 1))
    return (
        named.withColumn("team_map", team_map)
        .groupBy("match_id", "dateutc")
        .agg(side(0).alias("team1"), side(1).alias("team2"))
        .select(
            F.col("match_id").alias("request_id"),
            F.date_add(F.to_date(F.substring("dateutc", 1, 10)), 180).alias("date"),
            "team1",
            "team2",
        )
    )


def profile_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer name; many have no profile."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("request_id"), F.col("c_name").alias("name")
    )


def match_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each match asked for on its day and again a week later, when the pairing may differ."""
    asked = F.array(F.lit(0), F.lit(7))
    rows = matches(spark, sf_dir).select(
        "match_id", "dateutc", "label", F.map_keys("teamsData").alias("ids"), F.explode(asked).alias("shift")
    )
    return rows.select(
        (F.col("match_id") * 2 + F.when(F.col("shift") == 0, 0).otherwise(1)).alias("request_id"),
        F.date_add(F.to_date(F.substring("dateutc", 1, 10)), F.col("shift")).alias("date"),
        F.concat(F.substring_index("label", ",", 1), F.lit(", 9 - 9")).alias("label"),
        F.get("ids", F.lit(1)).cast("bigint").alias("team_a"),
        F.get("ids", F.lit(0)).cast("bigint").alias("team_b"),
    )


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The season as several streams of headers and events, placed only by source and position.

    Stream i carries the i-th match of every day: its header, then that day's events.
    """
    half = team_count(spark, sf_dir) // 2
    days = (
        table(spark, sf_dir, "events")
        .groupBy(_day("ts").cast("bigint").alias("day"))
        .agg((F.min("event_id") * 2).alias("position"))
    )
    headers = matches(spark, sf_dir).withColumn("day", F.floor(F.col("match_id") / half))
    plays = events(spark, sf_dir)
    empty = lambda name, kind: F.lit(None).cast(kind).alias(name)
    text = {"dateutc": "string", "label": "string", "winner": "bigint", "gameweek": "int"}
    text |= {"duration": "string", "venue": "string"}
    source = lambda: (F.col("match_id") % half).cast("string").alias("source")
    header_rows = headers.join(days, "day").select(
        source(),
        "position",
        F.col("match_id").alias("matchId"),
        *text,
        "teamsData",
        empty("eventId", "int"),
        empty("subEventId", "string"),
        empty("playerId", "bigint"),
        empty("eventSec", "string"),
        empty("tags", TAGS),
        F.lit(True).alias("is_match"),
    )
    event_rows = plays.select(
        source(),
        (F.col("seq") * 2 + 1).alias("position"),
        empty("matchId", "bigint"),
        *[empty(name, kind) for name, kind in text.items()],
        empty("teamsData", TEAMS_DATA),
        "eventId",
        "subEventId",
        "playerId",
        F.col("eventSec").cast("string").alias("eventSec"),
        "tags",
        F.lit(False).alias("is_match"),
    )
    return header_rows.unionByName(event_rows)


def stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as JSON text, with source and position kept beside the text for ordering."""
    records = stream_records(spark, sf_dir)
    fields = [c for c in records.columns if c != "is_match"]
    return records.select("source", "position", F.to_json(F.struct(*fields)).alias("value"))


RAW = ["source", "position"]


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source, position and a line of text that holds neither."""
    records = stream_records(spark, sf_dir)
    fields = [c for c in records.columns if c not in (*RAW, "is_match")]
    return records.select(*RAW, F.to_json(F.struct(*fields)).alias("value"))


def _as_lines(records: DataFrame, *keep: str) -> DataFrame:
    """The records as JSON text, with `keep` beside it."""
    fields = [c for c in records.columns if c not in ("is_match", "late")]
    return records.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def lines_with_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of every tenth player are `late`: they name their match and come after all others."""
    records = stream_records(spark, sf_dir)
    late = ~F.col("is_match") & (F.col("playerId") % 10 == 3)
    # An event stands at 2 * event_id + 1.
    named = events(spark, sf_dir).select((F.col("seq") * 2 + 1).alias("position"), F.col("match_id").alias("own"))
    rows = records.withColumn("late", late).join(named, "position", "left")
    rows = rows.withColumn("matchId", F.when(F.col("late"), F.col("own")).otherwise(F.col("matchId")))
    return _as_lines(rows.drop("own"), "late")


def lines_with_repeated_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every header comes again after its day's last event; positions are spread out to make room."""
    half = team_count(spark, sf_dir) // 2
    records = stream_records(spark, sf_dir).withColumn("position", F.col("position") * 4)
    last = table(spark, sf_dir, "events").groupBy(_day("ts").cast("bigint").alias("day")).agg(
        (F.max("event_id") * 8 + 5).alias("again")
    )
    headers = records.filter("is_match").withColumn("day", F.floor(F.col("matchId") / half)).join(last, "day")
    copies = headers.withColumn("position", F.col("again")).select(*records.columns)
    return _as_lines(records.unionByName(copies)).withColumn("position", F.get_json_object("value", "$.position").cast("bigint"))


def lines_that_are_no_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line that is cut off, of no kind, or without a header before it."""
    rows = events(spark, sf_dir).select(
        F.lit("lost").alias("source"), F.col("seq").alias("position"), "eventId", "subEventId", "playerId",
        F.col("eventSec").cast("string").alias("eventSec"), "tags",
    )
    text = F.to_json(F.struct(*rows.columns))
    cut, bare = F.substring(text, 1, 20), F.to_json(F.struct("source", "position", "playerId"))
    return rows.select(F.when(F.col("position") % 3 == 0, cut).when(F.col("position") % 3 == 1, bare).otherwise(text).alias("value"))


def lines_with_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The season without a header after its last matches: (value, part).

    Part 0 is the season but for every tenth player's last events, and an end record for source 0. Part 1 is a
    header, without players, two days on in a source of its own, so that the other sources are silent. Part 2
    has the events held back, which name no match.
    """
    records = stream_records(spark, sf_dir)
    last = records.filter("is_match").agg(F.max("position").alias("last_header"))
    held = ~F.col("is_match") & (F.col("playerId") % 10 == 3) & (F.col("position") > last.scalar())
    season = _as_lines(records.withColumn("part", F.when(held, 2).otherwise(0)), "part")
    # An event stands at 2 * event_id + 1.
    ends = table(spark, sf_dir, "events").agg((F.max("event_id") * 2 + 2).alias("position"), F.max("ts").alias("ts"))
    closing = ends.select(F.lit(0).alias("part"), F.to_json(F.struct(F.lit("0").alias("source"), "position", F.lit(True).alias("end"))).alias("value"))
    on = F.date_format(F.date_add(F.to_date("ts"), 2), "yyyy-MM-dd 18:00:00").alias("dateutc")
    nobody = F.create_map().cast(TEAMS_DATA).alias("teamsData")
    friendly = F.struct(F.lit("friendly").alias("source"), F.lit(0).alias("position"), F.lit(-1).alias("matchId"), on, nobody)
    return season.unionByName(closing).unionByName(ends.select(F.lit(1).alias("part"), F.to_json(friendly).alias("value")))


def mixed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of all kinds as lines of JSON, every other match request without a kind, and lines that are no request."""

    def lines(rows: DataFrame, kind: Column) -> DataFrame:
        fields = [c for c in rows.columns if not c.startswith("team_")]
        return rows.select(F.to_json(F.struct(*fields, kind.alias("req_type"))).alias("value"))

    games = match_requests(spark, sf_dir)
    asked = lines(win_requests(spark, sf_dir), F.lit(1)).unionByName(lines(profile_requests(spark, sf_dir), F.lit(2)))
    asked = asked.unionByName(lines(games, F.when(F.col("request_id") % 4 < 2, 3)))
    bare = games.select("request_id").withColumn("req_type", F.lit(7))
    wrong = bare.select(F.to_json(F.struct("request_id", "req_type")).alias("value"))
    short = bare.select(F.to_json(F.struct("request_id", F.lit(3).alias("req_type"))).alias("value"))
    cut = asked.select(F.substring("value", 1, 10).alias("value"))
    return asked.unionByName(wrong).unionByName(short).unionByName(cut)


def name_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match requests with a label of the two teams' names; teams without a name give no label."""
    names = teams(spark, sf_dir)
    rows = match_requests(spark, sf_dir)
    for side in "ab":
        rows = rows.join(names.select(F.col("Id").alias(f"team_{side}"), F.col("name").alias(f"name_{side}")), f"team_{side}", "left")
    return rows.select("request_id", "date", F.concat("name_a", F.lit("-"), "name_b", F.lit(", 1 - 1")).alias("label"))


def numeric_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawing records as JSON text whose flag is 1 or 0, and for some a text, which is no flag."""
    rows = doodles(spark, sf_dir)
    number = F.to_json(F.struct(*[c for c in rows.columns if c != "recognized"], F.col("recognized").cast("int").alias("recognized")))
    text = F.to_json(F.struct(*[c for c in rows.columns if c != "recognized"], F.col("recognized").cast("string").alias("recognized")))
    return rows.select(F.when(F.substring("key_id", -1, 1) == "7", text).otherwise(number).alias("value"))
