"""User queries, answered for whole tables of requests at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.expressions import START_CHEMISTRY, label_title, pair_key
from touchline.operators.matches import incidents, titled
from touchline.operators.model import predicted
from touchline.session import stored

# Fixed values of the win-chance query.
MIN_MATCHES = 5
RETIRED_BELOW = 0.2
TEAM_SIZE = 11
NORM_FACTOR = 8

#: Players of a side up to which its pairs are made and looked up; of larger ones the stored pairs are tried.
MADE_UP_TO = 64

SIDE = ["request_id", "side"]


def request_lineups(requests: DataFrame, players: DataFrame) -> DataFrame:
    """Players named on each side. The first entry of a team is its name, not a player's.

    A name that several players share brings all of them; a name nobody has brings none.
    """
    sides = F.array(
        F.struct(F.lit(1).alias("side"), F.col("team1").alias("team")),
        F.struct(F.lit(2).alias("side"), F.col("team2").alias("team")),
    )
    named = requests.select("request_id", "date", F.explode(sides).alias("s")).select(
        "request_id",
        "date",
        "s.side",
        F.explode(
            F.array_distinct(F.slice(F.map_values("s.team"), F.lit(2), F.size("s.team")))
        ).alias("name"),
    )
    people = players.select("name", F.col("Id").alias("player_id"), "role", "birthDate")
    return named.join(people, "name").select(*SIDE, "date", "player_id", "role", "birthDate")


def valid_roles() -> Column:
    role = F.col("role")
    return (
        (F.count_if(role == "MD") >= 2)
        & (F.count_if(role == "DF") >= 3)
        & (F.count_if(role == "FW") >= 1)
        & (F.count_if(role == "GK") == 1)
    )


def lineup_validity(lineups: DataFrame) -> DataFrame:
    role = F.col("role")
    return lineups.groupBy(*SIDE).agg(
        F.count_if(role == "GK").alias("gk"),
        F.count_if(role == "DF").alias("df"),
        F.count_if(role == "MD").alias("md"),
        F.count_if(role == "FW").alias("fw"),
        valid_roles().alias("valid"),
    )


def retired_players(
    lineups: DataFrame, line: DataFrame, retired_below: float = RETIRED_BELOW
) -> DataFrame:
    rated = predicted(line, lineups, F.col("date"), F.col("birthDate"))
    return rated.filter(F.col("predicted") < retired_below).select(*SIDE, "player_id", "predicted")


def mean_chemistry(
    lineups: DataFrame,
    profile: DataFrame,
    chemistry: DataFrame,
    traversal: str = "all",
    coefficient: str = "mean",
    min_matches: int = MIN_MATCHES,
) -> DataFrame:
    """Mean chemistry of each experienced player with the rest of the side.

    Mates never met count with the start value: the mean is that value plus what the stored pairs differ
    from it, over the number of mates.

    `traversal="alternate"` scores every other player in id order, each against those that are not
    yet used up; `coefficient="mean_minus_one"` shifts the mean by -1.
    """
    if traversal not in ("all", "alternate"):
        raise ValueError("traversal is 'all' or 'alternate'")
    if coefficient not in ("mean", "mean_minus_one"):
        raise ValueError("coefficient is 'mean' or 'mean_minus_one'")
    placed = stored(_placed(lineups), "placed")
    met = _met(placed, chemistry)
    sums = met.select(
        *SIDE,
        F.explode(F.array(
            F.struct(F.col("p_lo").alias("player_id"), F.col("lo_pos").alias("pos"), F.col("hi_pos").alias("other")),
            F.struct(F.col("p_hi").alias("player_id"), F.col("hi_pos").alias("pos"), F.col("lo_pos").alias("other")),
        )).alias("x"),
        "chem",
    ).select(*SIDE, "x.*", "chem")
    mates = F.col("size") - 1
    if traversal == "alternate":
        # Even places up to and including one's own are already used up.
        placed = placed.filter(F.col("pos") % 2 == 0)
        sums = sums.filter((F.col("pos") % 2 == 0) & ~((F.col("other") % 2 == 0) & (F.col("other") <= F.col("pos"))))
        mates = F.col("size") - F.floor(F.col("pos") / 2) - 1
    sums = sums.groupBy(*SIDE, "player_id").agg(F.sum(F.col("chem") - START_CHEMISTRY).alias("above"))
    seasoned = profile.filter(F.col("matches") >= min_matches).select("player_id")
    scored = placed.dropna(subset=SIDE).join(seasoned, "player_id", "left_semi").withColumn("mates", mates).filter("mates > 0")
    shift = START_CHEMISTRY if coefficient == "mean" else START_CHEMISTRY - 1
    above = F.coalesce("above", F.lit(0.0)) / F.col("mates")
    return scored.join(sums, [*SIDE, "player_id"], "left").select(*SIDE, "player_id", (above + F.lit(shift)).alias("coeff"))


def _met(placed: DataFrame, chemistry: DataFrame) -> DataFrame:
    """The stored pairs within each side, with the places of both; `placed` had better be a written table.

    A side of up to MADE_UP_TO players makes its pairs, fewer than that for each player, and looks them up. On a larger
    one, of names that many share, the pairs would grow with the square: there a player's stored pairs are
    reached by the lower id, and kept if the higher one is on the side too.
    """
    columns = [*SIDE, "p_lo", "p_hi", "lo_pos", "hi_pos", "chem"]
    chem = chemistry.select("p_lo", "p_hi", "chem")

    def ends(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        return tuple(rows.select(*SIDE, F.col("player_id").alias(f"p_{end}"), F.col("pos").alias(f"{end}_pos")) for end in ("lo", "hi"))

    large = F.col("size") > MADE_UP_TO
    any_large = not placed.filter(large).isEmpty()
    if any_large:
        # Both ways read it.
        chem = stored(chem, "chemistry")
    lo, hi = ends(placed.filter(~large))
    met = lo.join(hi, SIDE).filter(F.col("p_lo") < F.col("p_hi")).join(chem, ["p_lo", "p_hi"]).select(*columns)
    if not any_large:
        return met
    lo, hi = ends(placed.filter(large))
    return met.unionByName(lo.join(chem, "p_lo").join(hi, [*SIDE, "p_hi"]).select(*columns))


def _placed(lineups: DataFrame) -> DataFrame:
    """Place of each player in the side's id order, from 0, and the size of the side."""
    side = Window.partitionBy(*SIDE)
    place = (F.row_number().over(side.orderBy("player_id")) - 1).alias("pos")
    return lineups.select(*SIDE, "player_id", place, F.count("*").over(side).alias("size"))


def cluster_fallback(
    lineups: DataFrame,
    profile: DataFrame,
    coefficients: DataFrame,
    ratings: DataFrame,
    clusters: DataFrame,
    traversal: str = "all",
    min_matches: int = MIN_MATCHES,
) -> DataFrame:
    """Strength lent to a side for each of its inexperienced players by the scored players of the
    same cluster: sum of rating x coefficient over the size of the cluster."""
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    placed = lineups.select(*SIDE, "player_id")
    if traversal == "alternate":
        placed = _placed(lineups).filter(F.col("pos") % 2 == 0)
    seasoned = profile.filter(F.col("matches") >= min_matches).select("player_id")
    fresh = (
        placed.join(seasoned, "player_id", "left_anti")
        .join(clusters, "player_id")
        .groupBy(*SIDE, "cluster")
        .agg(F.count("*").alias("fresh"))
    )
    lent = (
        coefficients.join(clusters, "player_id")
        .join(ratings.select("player_id", "rating"), "player_id")
        .groupBy(*SIDE, "cluster")
        .agg(F.sum(F.col("rating") * F.col("coeff")).alias("lent"))
    )
    # One row per cluster, and the number of clusters is a parameter of the clustering.
    terms = fresh.join(lent, [*SIDE, "cluster"]).join(F.broadcast(sizes), "cluster")
    return terms.groupBy(*SIDE).agg(
        F.sum(F.col("fresh") * F.col("lent") / F.col("size")).alias("term")
    )


def win_chance(
    requests: DataFrame,
    players: DataFrame,
    profile: DataFrame,
    ratings: DataFrame,
    chemistry: DataFrame,
    line: DataFrame,
    clusters: DataFrame | None = None,
    norm_factor: float = NORM_FACTOR,
    traversal: str = "all",
    coefficient: str = "mean",
    cluster_term: str = "same_cluster",
    min_matches: int = MIN_MATCHES,
    retired_below: float = RETIRED_BELOW,
) -> DataFrame:
    """Chance of each side in percent, or why there is none.

    status is "ok", "retired" (some player is predicted below the threshold) or "invalid" (a side's
    role mix is wrong). The named players are looked up once and written, since four steps use them.
    """
    if cluster_term not in ("same_cluster", "none"):
        raise ValueError("cluster_term is 'same_cluster' or 'none'")
    if cluster_term == "same_cluster" and clusters is None:
        raise ValueError("cluster_term 'same_cluster' needs clusters")
    lineups = stored(request_lineups(requests, players), "lineups")
    rated = predicted(line, lineups, F.col("date"), F.col("birthDate"))
    gone = F.when(F.col("predicted") < retired_below, F.col("player_id"))
    sides = rated.groupBy(*SIDE).agg(
        valid_roles().alias("valid"),
        F.array_sort(F.collect_list(gone)).alias("retired"),
    )
    coefficients = mean_chemistry(
        lineups, profile, chemistry, traversal, coefficient, min_matches
    )
    strength = (
        coefficients.join(rated.select(*SIDE, "player_id", "predicted"), [*SIDE, "player_id"])
        .groupBy(*SIDE)
        .agg((F.lit(float(norm_factor)) * F.sum(F.col("coeff") * F.col("predicted"))).alias("total"))
    )
    scored = sides.join(strength, SIDE, "left")
    total = F.coalesce("total", F.lit(0.0))
    if cluster_term == "same_cluster":
        lent = cluster_fallback(
            lineups, profile, coefficients, ratings, clusters, traversal, min_matches
        )
        scored = scored.join(lent, SIDE, "left")
        total = total + F.coalesce("term", F.lit(0.0))
    scored = scored.withColumn("strength", total / TEAM_SIZE)

    def of(side: int, name: str) -> Column:
        return F.max_by(name, F.when(F.col("side") == side, 1))

    per_request = scored.groupBy("request_id").agg(
        *[of(s, n).alias(f"{n}_{s}") for n in ("valid", "retired", "strength") for s in (1, 2)]
    )
    no_one = F.array().cast("array<bigint>")
    out = requests.select("request_id", "team1", "team2").join(per_request, "request_id", "left")
    retired = [F.coalesce(f"retired_{s}", no_one) for s in (1, 2)]
    any_retired = (F.size(retired[0]) + F.size(retired[1])) > 0
    valid = F.coalesce(F.col("valid_1") & F.col("valid_2"), F.lit(False))
    status = F.when(any_retired, "retired").when(valid, "ok").otherwise("invalid")
    a, b = F.col("strength_1"), F.col("strength_2")
    chance = F.when(status == "ok", (0.5 + a - (a + b) / 2) * 100)
    return out.select(
        "request_id",
        F.get(F.map_values("team1"), F.lit(0)).alias("team_1"),
        F.get(F.map_values("team2"), F.lit(0)).alias("team_2"),
        status.alias("status"),
        chance.alias("chance_1"),
        (100 - chance).alias("chance_2"),
        retired[0].alias("retired_1"),
        retired[1].alias("retired_2"),
    )


def win_chance_documents(answers: DataFrame) -> DataFrame:
    """Answers in the shape of the JSON reply."""

    def team(i: int) -> Column:
        return F.when(
            F.col("status") == "ok",
            F.struct(F.col(f"team_{i}").alias("name"), F.col(f"chance_{i}").alias("winning chance")),
        )

    retired = F.col("status") == "retired"
    return answers.select(
        "request_id",
        team(1).alias("team1"),
        team(2).alias("team2"),
        F.when(F.col("status") != "ok", "True").alias("isInvalid"),
        F.when(retired, F.col("retired_1")).alias("team1_retired_players"),
        F.when(retired, F.col("retired_2")).alias("team2_retired_players"),
    )


def profile_answers(requests: DataFrame, players: DataFrame, profile: DataFrame) -> DataFrame:
    """Player card per requested name; of players sharing a name, the one with the lowest id.

    A request whose name is unknown, or whose player has no profile, is answered with `profile_found` false.
    """
    wanted = requests.select("request_id", "name")
    card = ["name", "birthArea", "foot", "role", "height", "weight"]
    people = (
        players.join(wanted.select("name").distinct(), "name", "left_semi")
        .groupBy("name")
        .agg(F.min_by(F.struct("Id", *card[1:]), "Id").alias("p"))
        .select("name", F.col("p.Id").alias("player_id"), *[f"p.{c}" for c in card[1:]])
    )
    stats = profile.select(
        "player_id",
        "fouls",
        "goals",
        "own_goals",
        F.col("pass_acc").alias("percent_pass_accuracy"),
        F.col("shot_acc").alias("percent_shots_on_target"),
    )
    # Answers are built once per name and then handed to however many requests ask for it.
    cards = people.join(stats, "player_id")
    found = F.col("player_id").isNotNull()
    return wanted.join(cards, "name", "left").select(
        "request_id",
        found.alias("profile_found"),
        *card,
        "fouls",
        "goals",
        "own_goals",
        "percent_pass_accuracy",
        "percent_shots_on_target",
    )


def _match_card(
    hits: DataFrame, requests: DataFrame, matches: DataFrame, players: DataFrame, teams: DataFrame
) -> DataFrame:
    """Cards for `hits` (request_id, seq, match_id); of several, the earliest archived match counts.

    A card is built once per match asked for, then handed to all who asked.
    """
    first = hits.groupBy("request_id").agg(
        F.min_by("match_id", F.struct("seq", "match_id")).alias("match_id")
    )
    asked = matches.join(first.select("match_id"), "match_id", "left_semi")
    winners = teams.select(F.col("Id").alias("winner"), F.col("name").alias("winner_name"))
    cards = (
        asked.drop("teamsData")
        .join(incidents(asked, players, teams), "match_id")
        .join(winners, "winner", "left")
    )
    found = first.join(cards, "match_id")
    return requests.select("request_id").join(found, "request_id", "left").select(
        "request_id",
        F.col("match_id").isNotNull().alias("match_found"),
        "match_id",
        F.col("dateutc").alias("date"),
        "duration",
        "winner",
        "winner_name",
        "venue",
        "gameweek",
        F.col("label").alias("teams_playing"),
        "goals",
        "own_goals",
        "yellow_cards",
        "red_cards",
    )


def match_answers(
    requests: DataFrame, matches: DataFrame, players: DataFrame, teams: DataFrame
) -> DataFrame:
    """Match information by date and label (the score after the comma does not count)."""
    wanted = requests.select(
        "request_id", F.col("date").alias("match_date"), label_title(F.col("label")).alias("title")
    )
    keyed = titled(matches).select("match_date", "title", "seq", "match_id")
    hits = wanted.join(keyed, ["match_date", "title"])
    return _match_card(hits, requests, matches, players, teams)


def match_answers_by_pair(
    requests: DataFrame, matches: DataFrame, players: DataFrame, teams: DataFrame
) -> DataFrame:
    """Match information by date and two team ids in either order."""
    lo, hi = pair_key(F.col("first_team"), F.col("second_team"))
    wanted = requests.select(
        "request_id",
        F.col("date").alias("match_date"),
        F.least("team_a", "team_b").alias("t_lo"),
        F.greatest("team_a", "team_b").alias("t_hi"),
    )
    keyed = titled(matches).select(
        "match_date", lo.alias("t_lo"), hi.alias("t_hi"), "seq", "match_id"
    )
    hits = wanted.join(keyed, ["match_date", "t_lo", "t_hi"])
    return _match_card(hits, requests, matches, players, teams)


def match_answers_by_names(
    requests: DataFrame, matches: DataFrame, players: DataFrame, teams: DataFrame
) -> DataFrame:
    """Match information by date and a label of two team names in either order, "one - two, score"."""
    sides = F.split(label_title(F.col("label")), "-")
    wanted = requests.select("request_id", "date", *[F.trim(F.get(sides, F.lit(i))).alias(f"name_{i}") for i in (0, 1)])
    ids = teams.groupBy("name").agg(F.min("Id").alias("id"))
    for i, side in enumerate("ab"):
        named = ids.select(F.col("name").alias(f"name_{i}"), F.col("id").alias(f"team_{side}"))
        wanted = wanted.join(named, f"name_{i}", "left")
    return match_answers_by_pair(wanted, matches, players, teams)


def profile_documents(answers: DataFrame) -> DataFrame:
    """Answers in the shape of the JSON reply: the card, or only `profile_found` = false."""
    found = F.col("profile_found")
    card = [c for c in answers.columns if c not in ("request_id", "profile_found")]
    return answers.select(
        "request_id", F.when(~found, F.lit(False)).alias("profile_found"), *[F.when(found, F.col(c)).alias(c) for c in card]
    )


def match_documents(answers: DataFrame) -> DataFrame:
    """Answers in the shape of the JSON reply: the card, or only `match_found` = false."""
    found = F.col("match_found")
    card = [c for c in answers.columns if c not in ("request_id", "match_found", "match_id")]

    def listed(name: str, scored: bool) -> Column:
        def item(e: Column) -> Column:
            parts = [e["player_name"].alias("name"), e["team_name"].alias("team")]
            return F.struct(*parts, *([e["number"].cast("string").alias("number_of_goals")] if scored else []))

        return F.transform(name, item)

    lists = {"goals": True, "own_goals": True, "yellow_cards": False, "red_cards": False}
    shown = {c: listed(c, lists[c]) if c in lists else F.col(c) for c in card}
    return answers.select(
        "request_id",
        F.when(~found, F.lit(False)).alias("match_found"),
        *[F.when(found, shown[c]).alias(c) for c in card],
    )


WIN_CHANCE, PROFILE, MATCH_INFO = "win_chance", "profile", "match_info"
#: The kinds of a request by its `req_type`.
REQUEST_KINDS = {"1": WIN_CHANCE, "2": PROFILE, "3": MATCH_INFO}


def sorted_requests(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of JSON to requests of all kinds, with `kind`, or the `reason` why a line is none.

    A line without `req_type` asks for match information. Dates are year-month-day.
    """
    rows = lines.select(F.col(column).alias("text"), F.from_json(column, schemas.MIXED_REQUEST, {"mode": "PERMISSIVE"}).alias("r"))
    is_object = F.coalesce(F.startswith(F.ltrim("text"), F.lit("{")), F.lit(False)) & F.try_parse_json("text").isNotNull()
    kinds = F.create_map(*[F.lit(x) for pair in REQUEST_KINDS.items() for x in pair])
    kind = F.when(F.col("r.req_type").isNull(), MATCH_INFO).otherwise(F.try_element_at(kinds, F.col("r.req_type")))
    rows = rows.select("text", "r.*", is_object.alias("__object"), kind.alias("kind"))
    rows = rows.withColumn("date", F.try_to_date("date", "yyyy-MM-dd"))
    lacks = {
        WIN_CHANCE: F.col("date").isNull() | F.col("team1").isNull() | F.col("team2").isNull(),
        PROFILE: F.col("name").isNull(),
        MATCH_INFO: F.col("date").isNull() | F.col("label").isNull(),
    }
    reason = F.when(~F.col("__object"), "malformed").when(F.col("kind").isNull(), "unknown kind")
    for name, lacking in lacks.items():
        reason = reason.when((F.col("kind") == name) & lacking, "incomplete")
    return rows.withColumn("reason", reason).drop("__object")


def requests_of(requests: DataFrame, kind: str) -> DataFrame:
    """The requests of one kind, in the columns that the operator for it takes."""
    columns = {WIN_CHANCE: ["date", "team1", "team2"], PROFILE: ["name"], MATCH_INFO: ["date", "label"]}
    return requests.filter(F.col("reason").isNull() & (F.col("kind") == kind)).select("request_id", *columns[kind])
