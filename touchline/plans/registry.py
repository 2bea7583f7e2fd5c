"""Registered queries: every operator over the whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import doodles, folds, graph, matches, metrics, model
from touchline.plans import fixtures as fx
from touchline.plans import requests as rq
from touchline.session import scratch_path, stored, tune
from touchline.sources import readers, writers
from touchline.streaming import framing, ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered runs.
WORD = "click"
DISTANCE = 60.0
STROKES = 7
GRAPH_PART = 16


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def r6(name: str, digits: int = 6) -> Column:
    """Rounded for comparison. Many values are halved decimals that end on a tie, which engines
    break differently; the nudge moves them off it."""
    return F.round(F.col(name) + 1e-9, digits).alias(name)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.normalise_events(fx.events(spark, sf))


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.event_metrics(_events(spark, sf))


def _appearances(spark: SparkSession, sf: str) -> DataFrame:
    return matches.appearances(fx.matches(spark, sf))


def _history(spark: SparkSession, sf: str) -> DataFrame:
    """The folds read the history several times, so it is written once, a few rows per match."""
    history = metrics.player_history(_appearances(spark, sf), _metrics(spark, sf), fx.players(spark, sf))
    return stored(history, "history")


def _rated(spark: SparkSession, sf: str) -> DataFrame:
    return folds.ratings(_history(spark, sf))


# Drawings and strokes


@query
def doodle_valid_count(spark, sf):
    return doodles.valid_counts(fx.doodles(spark, sf))


@query
def doodle_reject_reasons(spark, sf):
    return doodles.reject_counts(fx.doodles(spark, sf))


@query
def doodle_rejects(spark, sf):
    rows = doodles.validate(fx.doodles(spark, sf)).filter(~F.col("valid"))
    return rows.select("key_id", F.array_join("reject_reasons", ",").alias("reasons"))


@query
def doodle_recognized_weekend(spark, sf):
    return doodles.recognized_and_weekend(fx.doodles(spark, sf), WORD)


@query
def doodle_country_distance(spark, sf):
    return doodles.country_distance_counts(fx.doodles(spark, sf), WORD, DISTANCE)


@query
def stroke_averages(spark, sf):
    out = doodles.stroke_averages(fx.stroke_stats(spark, sf))
    return out.select("word", r6("recognized_avg"), r6("unrecognized_avg"))


@query
def stroke_average_word(spark, sf):
    out = doodles.stroke_averages(fx.stroke_stats(spark, sf), WORD)
    return out.select("word", "recognized_text", "unrecognized_text")


@query
def stroke_country_counts(spark, sf):
    return doodles.country_stroke_counts(fx.shapes(spark, sf), fx.stroke_stats(spark, sf), WORD, STROKES)


# Link graph


@query
def adjacency(spark, sf):
    lists = graph.adjacency(fx.edges(spark, sf), GRAPH_PART)
    pairs = F.transform("targets", lambda t: F.concat_ws(":", t["dst"], t["copies"].cast("string")))
    return lists.select("src", "part", "outdeg", F.array_join(pairs, ",").alias("targets"))


@query
def out_degrees(spark, sf):
    return graph.out_degrees(graph.edge_copies(fx.edges(spark, sf))).select("src", "outdeg")


@query
def initial_ranks(spark, sf):
    return graph.initial_ranks(fx.edges(spark, sf))


@query
def pagerank_step(spark, sf):
    edges = fx.edges(spark, sf)
    ranks = graph.rank_step(edges, graph.initial_ranks(edges))
    return ranks.select("node", r6("rank"))


@query
def pagerank_3(spark, sf):
    ranks = graph.rank_iterate(fx.edges(spark, sf), max_iter=3, part_size=GRAPH_PART)
    return ranks.select("node", r6("rank"))


@query
def pagerank_tol(spark, sf):
    """Ranks at rest, by passing on changes only."""
    ranks = graph.rank_by_changes(fx.edges(spark, sf), tol=1e-10, part_size=GRAPH_PART)
    return ranks.select("node", r6("rank"))


@query
def pagerank_step_text(spark, sf):
    """One step rounded and printed to five decimals."""
    edges = fx.edges(spark, sf)
    ranks = graph.rank_step(edges, graph.initial_ranks(edges), round_digits=5)
    return ranks.select("node", F.format_string("%.5f", "rank").alias("rank"))


# Event metrics


@query
def pass_accuracy(spark, sf):
    return _metrics(spark, sf).filter("passes > 0").select(
        "match_id", "player_id", "pass_key_ok", "pass_ok", "pass_key_bad", "pass_bad", r6("pass_accuracy")
    )


@query
def duel_effectiveness(spark, sf):
    return _metrics(spark, sf).filter("duels > 0").select(
        "match_id", "player_id", "duel_neutral", "duel_lost", "duel_won", r6("duel_effectiveness")
    )


@query
def freekick_stats(spark, sf):
    return _metrics(spark, sf).filter("free_kicks > 0").select(
        "match_id", "player_id", "fk_tags", "fk_accurate", "fk_penalty_goals", r6("freekick_effectiveness")
    )


@query
def shot_effectiveness(spark, sf):
    return _metrics(spark, sf).filter("shots > 0").select(
        "match_id", "player_id", "shot_goal", "shot_on_target", "shot_other", r6("shot_effectiveness")
    )


@query
def shot_effectiveness_tagged(spark, sf):
    out = metrics.event_metrics(_events(spark, sf), off_target="tagged").filter("shots > 0")
    return out.select("match_id", "player_id", "shot_other", r6("shot_effectiveness"))


@query
def fouls(spark, sf):
    return _metrics(spark, sf).filter("fouls > 0").select("match_id", "player_id", "fouls")


@query
def own_goals(spark, sf):
    return _metrics(spark, sf).select("match_id", "player_id", "own_goals")


@query
def event_normalised(spark, sf):
    return _events(spark, sf).groupBy("subEventId").agg(
        F.count("*").alias("n"), F.round(F.sum("eventSec"), 2).alias("seconds")
    )


# Matches


@query
def match_teams(spark, sf):
    return matches.match_team(fx.matches(spark, sf))


@query
def match_entries(spark, sf):
    out = matches.match_player(fx.matches(spark, sf))
    return out.select(
        "match_id", "team_id", "section", "player_id", "goals", "own_goals", "yellow_cards", "red_cards"
    )


@query
def substitutions(spark, sf):
    return matches.match_sub(fx.matches(spark, sf)).select(
        "match_id", "team_id", "player_in", "player_out", "minute"
    )


@query
def roster(spark, sf):
    return matches.roster(fx.matches(spark, sf))


@query
def known_roster(spark, sf):
    known = matches.known_players(matches.roster(fx.matches(spark, sf)), fx.players(spark, sf))
    return known.select("match_id", "team_ord", "team_id", "player_id")


@query
def minutes_played(spark, sf):
    return matches.minutes_played(fx.matches(spark, sf)).select(
        "match_id", "player_id", "minutes", "full_time"
    )


@query
def minutes_with_flag(spark, sf):
    return matches.minutes_played(fx.matches(spark, sf), require_flag=True).groupBy("match_id").agg(
        F.count("*").alias("players"), F.sum("minutes").alias("minutes")
    )


@query
def match_titles(spark, sf):
    return matches.match_titles(fx.matches(spark, sf), fx.teams(spark, sf))


@query
def match_counter(spark, sf):
    return matches.match_counter(fx.matches(spark, sf))


@query
def incidents(spark, sf):
    lists = matches.incidents(fx.matches(spark, sf), fx.players(spark, sf), fx.teams(spark, sf))

    def text(name: str, number: bool) -> Column:
        fields = ["player_name", "team_name"] + (["number"] if number else [])
        shown = F.transform(name, lambda e: F.concat_ws("/", *[e[f].cast("string") for f in fields]))
        return F.array_join(shown, ";").alias(name)

    return lists.select(
        "match_id",
        text("goals", True),
        text("own_goals", True),
        text("yellow_cards", False),
        text("red_cards", False),
    )


# Contribution, folds, profile


@query
def contribution(spark, sf):
    out = metrics.contribution(_metrics(spark, sf), matches.minutes_played(fx.matches(spark, sf)))
    return out.select("match_id", "player_id", r6("contribution"))


@query
def contribution_effectiveness(spark, sf):
    out = metrics.contribution(
        _metrics(spark, sf), matches.minutes_played(fx.matches(spark, sf)), "effectiveness"
    )
    return out.select("match_id", "player_id", r6("contribution"))


@query
def prior_totals(spark, sf):
    return folds.prior_totals(_history(spark, sf)).select(
        "match_id", "player_id", "prior_fouls", "prior_own_goals"
    )


@query
def player_rating(spark, sf):
    return _rated(spark, sf).filter("contribution is not null").select(
        "match_id", "player_id", r6("perf"), r6("rating")
    )


@query
def player_rating_match_penalty(spark, sf):
    rated = folds.ratings(_history(spark, sf), penalty="match").filter("contribution is not null")
    return rated.select("match_id", "player_id", r6("perf"), r6("rating"))


@query
def current_rating(spark, sf):
    return folds.current_ratings(_rated(spark, sf)).select("player_id", r6("rating"))


@query
def rating_change(spark, sf):
    return _rated(spark, sf).filter("on_roster").select("match_id", "player_id", r6("change"))


@query
def chemistry_delta(spark, sf):
    return folds.chemistry_steps(_rated(spark, sf)).select("match_id", "p_lo", "p_hi", r6("step"))


@query
def chemistry(spark, sf):
    rated = stored(_rated(spark, sf), "rated")
    return folds.chemistry(rated).select("p_lo", "p_hi", r6("chem"), "meetings")


@query
def chemistry_diff(spark, sf):
    rated = stored(_rated(spark, sf), "rated")
    out = folds.chemistry(rated, first_team_delta="diff")
    return out.select("p_lo", "p_hi", r6("chem"), "meetings")


def _profile(spark: SparkSession, sf: str, history: DataFrame | None = None) -> DataFrame:
    history = _history(spark, sf) if history is None else history
    return metrics.profile(history, fx.players(spark, sf))


@query
def profile(spark, sf):
    return _profile(spark, sf).select(
        "player_id", "name", "fouls", "goals", "own_goals", r6("pass_acc"), r6("shot_acc"), "matches"
    )


# Model


@query
def training_frame(spark, sf):
    out = model.training_frame(_rated(spark, sf), fx.players(spark, sf), "all")
    return out.select("match_id", "player_id", "diff", r6("rating"))


@query
def training_latest(spark, sf):
    out = model.training_frame(_rated(spark, sf), fx.players(spark, sf))
    return out.select("player_id", "match_id", "diff", r6("rating"))


@query
def training_last_match(spark, sf):
    out = model.training_frame(_rated(spark, sf), fx.players(spark, sf), "last_match")
    return out.select("player_id", "match_id", "diff", r6("rating"))


@query
def training_replace(spark, sf):
    """Rows of the first half of the season replaced by newer ones."""
    rows = model.training_frame(_rated(spark, sf), fx.players(spark, sf), "all")
    rows = rows.select("player_id", "seq", "match_id", "diff", "rating")
    half = rows.agg((F.min("seq") + F.max("seq")) / 2).scalar()
    old = model.latest_per_player(rows.filter(F.col("seq") < half))
    new = model.latest_per_player(rows.filter(F.col("seq") >= half))
    return model.replace_history(old, new).select("player_id", "match_id", "diff", r6("rating"))


def _fitted(rated: DataFrame, players: DataFrame):
    """The fit passes over its rows more than once, so they are written first."""
    return model.fit_rating(stored(model.training_frame(rated, players), "training"))


def _line(spark: SparkSession, rated: DataFrame, players: DataFrame) -> DataFrame:
    return model.model_line(spark, _fitted(rated, players))


@query
def rating_regression(spark, sf):
    line = _line(spark, _rated(spark, sf), fx.players(spark, sf))
    return line.select(r6("slope"), r6("intercept"))


@query
def rating_regression_by_role(spark, sf):
    players = fx.players(spark, sf)
    frame = model.training_frame(_rated(spark, sf), players)
    roles = players.select(F.col("Id").alias("player_id"), "role")
    line = model.rating_line(frame.join(roles, "player_id"), ["role"])
    return line.select("role", r6("slope", 5), r6("intercept", 5), "n")


@query
def predicted_rating(spark, sf):
    players = fx.players(spark, sf)
    line = _line(spark, _rated(spark, sf), players)
    out = model.predict_rating(line, players, F.lit("2024-07-01").cast("date"))
    return out.select("player_id", r6("predicted"))


@query
def model_round_trip(spark, sf):
    """The fitted model saved, loaded again and applied."""
    players = fx.players(spark, sf)
    fitted = _fitted(_rated(spark, sf), players)
    path = scratch_path(spark, "model")
    model.save_model(fitted, path)
    line = model.model_line(spark, model.load_model(path))
    out = model.predict_rating(line, players, F.lit("2024-07-01").cast("date"))
    return out.select("player_id", r6("predicted"))


@query
def clusters(spark, sf):
    return model.cluster_players(stored(_profile(spark, sf), "profile"))


@query
def cluster_invariants(spark, sf):
    """How many clusters hold how many players, and how many stand nearer to another center."""
    return model.misplaced(stored(_profile(spark, sf), "profile"))


@query
def cluster_quality(spark, sf):
    return model.cluster_quality(stored(_profile(spark, sf), "profile"))


@query
def cluster_silhouette(spark, sf):
    """The silhouette of clusters given by a formula."""
    profile = stored(_profile(spark, sf), "profile")
    out = model.silhouette(profile, profile.select("player_id", F.pmod("player_id", F.lit(5)).cast("int").alias("cluster")))
    return out.select("cluster", "size", r6("silhouette"))


# Requests


def _season(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """State after all matches: history and ratings are written, what follows from them is left to the plan that asks."""
    players = fx.players(spark, sf)
    history = _history(spark, sf)
    rated = stored(folds.ratings(history), "rated")
    return {
        "players": players,
        "profile": _profile(spark, sf, history),
        "ratings": folds.current_ratings(rated),
        "chemistry": folds.chemistry(rated),
        "line": model.rating_line(model.training_frame(rated, players)),
    }


def _clustered_season(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The same for the cluster term, which asks for the profile several times."""
    season = _season(spark, sf)
    return season | {"profile": stored(season["profile"], "profile")}


@query
def lineup_validity(spark, sf):
    return rq.lineup_validity(rq.request_lineups(fx.win_requests(spark, sf), fx.players(spark, sf)))


@query
def retired_players(spark, sf):
    players = fx.players(spark, sf)
    line = _line(spark, _rated(spark, sf), players)
    lineups = rq.request_lineups(fx.win_requests(spark, sf), players)
    return rq.retired_players(lineups, line).select("request_id", "side", "player_id", r6("predicted"))


def _mean_chemistry(spark, sf, **options):
    history = _history(spark, sf)
    lineups = rq.request_lineups(fx.win_requests(spark, sf), fx.players(spark, sf))
    chem = folds.chemistry(stored(folds.ratings(history), "rated"))
    out = rq.mean_chemistry(lineups, _profile(spark, sf, history), chem, **options)
    return out.select("request_id", "side", "player_id", r6("coeff"))


@query
def mean_chemistry(spark, sf):
    return _mean_chemistry(spark, sf)


@query
def mean_chemistry_alternate(spark, sf):
    return _mean_chemistry(spark, sf, traversal="alternate", coefficient="mean_minus_one")


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """The request table; an input as far as the queries are concerned."""
    return stored(fx.win_requests(spark, sf), "requests")


@query
def win_chance(spark, sf):
    """With the cluster term."""
    season = _clustered_season(spark, sf)
    groups = model.cluster_players(season["profile"])
    out = rq.win_chance(_requests(spark, sf), **season, clusters=groups)
    return out.select(
        "request_id", "team_1", "team_2", "status", r6("chance_1"), r6("chance_2"),
        F.array_join("retired_1", ",").alias("retired_1"), F.array_join("retired_2", ",").alias("retired_2"),
    )


@query
def win_chance_plain(spark, sf):
    out = rq.win_chance(_requests(spark, sf), **_season(spark, sf), cluster_term="none")
    return out.select(
        "request_id", "team_1", "team_2", "status", r6("chance_1", 4),
        r6("chance_2", 4),
        F.array_join("retired_1", ",").alias("retired_1"), F.array_join("retired_2", ",").alias("retired_2"),
    )


@query
def cluster_fallback(spark, sf):
    season = _clustered_season(spark, sf)
    groups = model.cluster_players(season["profile"])
    lineups = stored(rq.request_lineups(fx.win_requests(spark, sf), season["players"]), "lineups")
    coefficients = rq.mean_chemistry(lineups, season["profile"], season["chemistry"])
    return rq.cluster_fallback(lineups, season["profile"], coefficients, season["ratings"], groups)


def _given_clusters(season: dict[str, DataFrame]) -> DataFrame:
    """Clusters by a formula, in place of fitted ones."""
    return season["profile"].select("player_id", F.pmod("player_id", F.lit(5)).cast("int").alias("cluster"))


@query
def win_chance_given(spark, sf):
    """With the cluster term, for given clusters."""
    season = _clustered_season(spark, sf)
    out = rq.win_chance(_requests(spark, sf), **season, clusters=_given_clusters(season))
    return out.select("request_id", "status", r6("chance_1", 4), r6("chance_2", 4))


@query
def cluster_fallback_given(spark, sf):
    season = _clustered_season(spark, sf)
    lineups = stored(rq.request_lineups(fx.win_requests(spark, sf), season["players"]), "lineups")
    coefficients = rq.mean_chemistry(lineups, season["profile"], season["chemistry"])
    out = rq.cluster_fallback(lineups, season["profile"], coefficients, season["ratings"], _given_clusters(season))
    return out.select("request_id", "side", r6("term", 5))


@query
def profile_query(spark, sf):
    out = rq.profile_answers(fx.profile_requests(spark, sf), fx.players(spark, sf), _profile(spark, sf))
    shares = ["percent_pass_accuracy", "percent_shots_on_target"]
    return out.select(*[c for c in out.columns if c not in shares], *[r6(c) for c in shares])


def _card(answers: DataFrame) -> DataFrame:
    return answers.select(
        "request_id",
        "match_found",
        "match_id",
        "date",
        "duration",
        "winner",
        "winner_name",
        "venue",
        "gameweek",
        "teams_playing",
        F.size("goals").alias("n_goals"),
        F.size("own_goals").alias("n_own_goals"),
        F.size("yellow_cards").alias("n_yellow_cards"),
        F.size("red_cards").alias("n_red_cards"),
    )


@query
def match_info(spark, sf):
    return _card(
        rq.match_answers(
            fx.match_requests(spark, sf), fx.matches(spark, sf), fx.players(spark, sf), fx.teams(spark, sf)
        )
    )


@query
def match_info_by_pair(spark, sf):
    return _card(
        rq.match_answers_by_pair(
            fx.match_requests(spark, sf), fx.matches(spark, sf), fx.players(spark, sf), fx.teams(spark, sf)
        )
    )


@query
def match_info_by_names(spark, sf):
    return _card(
        rq.match_answers_by_names(
            fx.name_requests(spark, sf), fx.matches(spark, sf), fx.players(spark, sf), fx.teams(spark, sf)
        )
    )


def _replies(spark: SparkSession, documents: DataFrame, schema: str) -> DataFrame:
    """Documents written as JSON replies and read back."""
    path = scratch_path(spark, "replies")
    writers.write_answers(documents, path)
    return readers.read_requests(spark, path, schema)


@query
def reply_match(spark, sf):
    """The lists of the match replies; a reply tells `match_found` only if none was found."""
    answers = rq.match_answers(
        fx.match_requests(spark, sf), fx.matches(spark, sf), fx.players(spark, sf), fx.teams(spark, sf)
    )
    scored = "array<struct<name:string,team:string,number_of_goals:string>>"
    carded = "array<struct<name:string,team:string>>"
    replies = _replies(
        spark,
        rq.match_documents(answers),
        f"request_id bigint, match_found boolean, goals {scored}, own_goals {scored}, yellow_cards {carded}, red_cards {carded}",
    )

    def text(name: str, *fields: str) -> Column:
        shown = F.transform(name, lambda e: F.concat_ws("/", *[e[f] for f in fields]))
        return F.array_join(shown, ";").alias(name)

    goals, cards = ("name", "team", "number_of_goals"), ("name", "team")
    return replies.select(
        "request_id",
        F.coalesce("match_found", F.lit(True)).alias("match_found"),
        text("goals", *goals),
        text("own_goals", *goals),
        text("yellow_cards", *cards),
        text("red_cards", *cards),
    )


@query
def reply_profile(spark, sf):
    answers = rq.profile_answers(fx.profile_requests(spark, sf), fx.players(spark, sf), _profile(spark, sf))
    replies = _replies(
        spark,
        rq.profile_documents(answers),
        "request_id bigint, profile_found boolean, name string, birthArea string, foot string, fouls bigint, percent_pass_accuracy double",
    )
    return replies.select(
        "request_id", F.coalesce("profile_found", F.lit(True)).alias("profile_found"), "name", "birthArea", "foot", "fouls", r6("percent_pass_accuracy")
    )


@query
def reply_win_chance(spark, sf):
    answers = rq.win_chance(_requests(spark, sf), **_season(spark, sf), cluster_term="none")
    team = "struct<name:string,`winning chance`:double>"
    replies = _replies(
        spark,
        rq.win_chance_documents(answers),
        f"request_id bigint, team1 {team}, team2 {team}, isInvalid string, team1_retired_players array<bigint>, team2_retired_players array<bigint>",
    )
    return replies.select(
        "request_id",
        F.col("isInvalid").alias("is_invalid"),
        *[F.col(f"team{i}.name").alias(f"team_{i}") for i in (1, 2)],
        *[F.round(F.col(f"team{i}.`winning chance`") + 1e-9, 4).alias(f"chance_{i}") for i in (1, 2)],
        *[F.array_join(f"team{i}_retired_players", ",").alias(f"retired_{i}") for i in (1, 2)],
    )


@query
def mixed_requests(spark, sf):
    """Requests of all kinds from one file: each answered in short by its kind, lines that are none with the reason."""
    path = scratch_path(spark, "requests")
    fx.mixed_requests(spark, sf).write.text(path)
    asked = stored(rq.sorted_requests(spark.read.text(path)), "requests")
    season = _season(spark, sf)
    chances = rq.win_chance(rq.requests_of(asked, rq.WIN_CHANCE), **season, cluster_term="none").select("request_id", "status")
    cards = rq.profile_answers(rq.requests_of(asked, rq.PROFILE), season["players"], season["profile"])
    games = rq.match_answers(rq.requests_of(asked, rq.MATCH_INFO), fx.matches(spark, sf), season["players"], fx.teams(spark, sf))

    def of(rows: DataFrame, kind: str, answer: Column) -> DataFrame:
        return rows.select(F.lit(kind).alias("kind"), "request_id", answer.alias("answer"))

    rejected = asked.filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))
    return (
        of(chances, rq.WIN_CHANCE, F.col("status"))
        .unionByName(of(cards, rq.PROFILE, F.when(F.col("profile_found"), F.col("name")).otherwise("not found")))
        .unionByName(of(games, rq.MATCH_INFO, F.coalesce("teams_playing", F.lit("not found"))))
        .unionByName(rejected.select(F.lit("rejected").alias("kind"), F.col("n").alias("request_id"), F.col("reason").alias("answer")))
    )


# Sources, sinks and the stream


@query
def source_doodles(spark, sf):
    """Drawings written as JSON lines, read back and counted."""
    path = scratch_path(spark, "doodles")
    fx.doodles(spark, sf).write.json(path)
    return doodles.valid_counts(readers.read_doodles(spark, path))


@query
def source_doodles_numeric(spark, sf):
    """Drawings whose flag is written as 1 or 0; a text is no flag."""
    path = scratch_path(spark, "doodles")
    fx.numeric_flags(spark, sf).write.text(path)
    return doodles.valid_counts(readers.read_doodles(spark, path))


@query
def source_edges_quoted(spark, sf):
    """Edges whose source begins with a quote, and lines without a target."""
    path = scratch_path(spark, "edges")
    edges = fx.edges(spark, sf)
    lines = edges.select(F.concat_ws("\t", F.concat(F.lit('"'), "src"), "dst").alias("value"))
    lines.unionByName(edges.select(F.col("src").alias("value"))).write.text(path)
    return graph.edge_copies(readers.read_edges(spark, path))


@query
def ranks_in_order(spark, sf):
    """Ranks after one step as text sorted by node, each with its place in the text."""
    path = scratch_path(spark, "ranks")
    edges = fx.edges(spark, sf)
    ranks = graph.rank_step(edges, graph.initial_ranks(edges), round_digits=5)
    writers.write_in_order(ranks.select("node", F.format_string("%.5f", "rank").alias("rank")), path, ["node"])
    fields = F.split("value", "\t")
    return readers.read_in_order(spark, path).select("place", fields[0].alias("node"), fields[1].alias("rank"))


@query
def source_edges(spark, sf):
    """Edges written as commented tab-separated text and read back."""
    path = scratch_path(spark, "edges")
    lines = fx.edges(spark, sf).select(F.concat_ws("\t", "src", "dst").alias("value"))
    marks = lines.select(F.concat(F.lit("# "), "value").alias("value"))
    lines.unionByName(marks).write.text(path)
    return graph.edge_copies(readers.read_edges(spark, path))


@query
def source_edges_header(spark, sf):
    """Edges in files that begin with a header line without a mark."""
    path = scratch_path(spark, "edges")
    fx.edges(spark, sf).select("src", "dst").write.option("header", True).option("sep", "\t").csv(path)
    return graph.edge_copies(readers.read_edges(spark, path, header_lines=1))


@query
def source_ranks(spark, sf):
    """Adjacency and ranks written together, the ranks also as text, and read back."""
    path = scratch_path(spark, "graph")
    edges = fx.edges(spark, sf)
    writers.write_graph(graph.adjacency(edges), graph.initial_ranks(edges), path)
    writers.write_ranks(readers.read_table(spark, f"{path}/ranks"), f"{path}/ranks.csv")
    lists = readers.read_table(spark, f"{path}/adjacency")
    ranks = readers.read_ranks(spark, f"{path}/ranks.csv")
    return graph.rank_step_on(lists, graph.list_parts(lists), ranks).select("node", r6("rank"))


@query
def source_players(spark, sf):
    """Columns in another order than the layout's, and one to spare."""
    path = scratch_path(spark, "players")
    rows = fx.players(spark, sf)
    mixed = rows.select("name", "birthArea", F.lit("x").alias("spare"), "birthDate", "foot", "role", "weight", "height", "Id")
    mixed.write.option("header", True).csv(path)
    return readers.read_players(spark, path)


@query
def source_stroke_stats(spark, sf):
    path = scratch_path(spark, "stats")
    stats = fx.stroke_stats(spark, sf).withColumn("timestamp", F.lit("2020-01-01"))
    stats = stats.select("word", "timestamp", "recognized", "key_id", "Total_Strokes")
    stats.write.option("header", True).csv(f"{path}/stats")
    fx.shapes(spark, sf).write.option("header", True).csv(f"{path}/shapes")
    return doodles.country_stroke_counts(
        readers.read_shapes(spark, f"{path}/shapes"),
        readers.read_stroke_stats(spark, f"{path}/stats"),
        WORD,
        str(STROKES),
    )


@query
def state_snapshot(spark, sf):
    """Ratings and profile saved as tables and read back."""
    path = scratch_path(spark, "snapshot")
    history = _history(spark, sf)
    writers.write_table(folds.current_ratings(folds.ratings(history)), f"{path}/rating")
    writers.write_table(_profile(spark, sf, history), f"{path}/profile")
    saved = readers.read_table(spark, f"{path}/profile").join(
        readers.read_table(spark, f"{path}/rating"), "player_id"
    )
    return saved.select("player_id", "name", "fouls", "matches", r6("pass_acc"), r6("rating"))


@query
def answer_documents(spark, sf):
    """Match answers written as JSON replies and read back; a reply says so only if none was found."""
    path = scratch_path(spark, "answers")
    answers = rq.match_answers(
        fx.match_requests(spark, sf), fx.matches(spark, sf), fx.players(spark, sf), fx.teams(spark, sf)
    )
    writers.write_answers(rq.match_documents(answers), path)
    replies = readers.read_requests(
        spark, path, "request_id bigint, match_found boolean, teams_playing string, gameweek int"
    )
    return replies.withColumn("match_found", F.coalesce("match_found", F.lit(True)))


@query
def match_archive(spark, sf):
    """Match records appended to the archive and read back by game week."""
    path = scratch_path(spark, "archive")
    writers.append_matches(fx.matches(spark, sf), path)
    archive = readers.read_table(spark, path)
    return archive.groupBy("gameweek").agg(
        F.count("*").alias("matches"), F.sum("winner").alias("winner_sum")
    )


@query
def event_framing(spark, sf):
    """Events assigned to matches by their place in the stream alone."""
    framed = framing.frame(fx.stream_records(spark, sf)).filter(~F.col("is_match"))
    return framed.groupBy("match_id").agg(
        F.count("*").alias("events"), F.min("position").alias("first"), F.max("position").alias("last")
    )


@query
def event_framing_nanos(spark, sf):
    """The same with positions as nanoseconds of a clock."""
    start, step = 1_700_000_000_000_000_000, 1_000_000_000
    records = fx.stream_records(spark, sf).withColumn("position", F.col("position") * step + start)
    framed = framing.frame(records, limit=500).filter(~F.col("is_match"))
    return framed.groupBy("match_id").agg(
        F.count("*").alias("events"), F.min("position").alias("first"), F.max("position").alias("last")
    )


def _streamed(spark: SparkSession, sf: str, parts: list[DataFrame], flush: bool = True, **options) -> ingest.Engine:
    """Lines of text fed to the engine, each frame a restart of the stream, then flushed."""
    at = scratch_path(spark, "stream")
    engine = ingest.Engine(spark, f"{at}/state", stored(fx.players(spark, sf), "players"), False, **options)
    for lines in parts:
        lines.write.mode("append").text(f"{at}/lines")
        stream = ingest.open_lines(spark, f"{at}/lines")
        ingest.start_ingest(stream, engine, f"{at}/checkpoint", available_now=True).awaitTermination()
    if flush:
        engine.flush()
    return engine


def _standing(engine: ingest.Engine) -> DataFrame:
    """Profile and rating as the stream leaves them."""
    out = engine.current_profile().join(engine.current_ratings(), "player_id")
    return out.select(
        "player_id", "name", "fouls", "goals", "own_goals", r6("pass_acc"), r6("shot_acc"), "matches", r6("rating")
    )


@query
def stream_raw_lines(spark, sf):
    """Lines that do not tell their place: it is that in their file, and the file is the source."""
    at = scratch_path(spark, "raw")
    lines = fx.raw_lines(spark, sf).repartition("source").sortWithinPartitions("source", "position")
    lines.select("source", "value").write.partitionBy("source").text(at)
    engine = ingest.Engine(spark, scratch_path(spark, "state"), stored(fx.players(spark, sf), "players"), False)
    stream = ingest.open_lines(spark, at)
    ingest.start_ingest(stream, engine, scratch_path(spark, "checkpoint"), available_now=True).awaitTermination()
    engine.flush()
    return _standing(engine)


@query
def stream_rejects(spark, sf):
    """Lines that are no records, by reason."""
    engine = _streamed(spark, sf, [fx.lines_that_are_no_records(spark, sf)])
    return engine.rejected().groupBy("reason").agg(F.count("*").alias("lines"))


@query
def stream_late(spark, sf):
    """Events that come after their match has ended are counted all the same."""
    lines = stored(fx.lines_with_late_events(spark, sf), "lines")
    return _standing(_streamed(spark, sf, [lines.filter(f"{late}late").select("value") for late in ("NOT ", "")]))


@query
def stream_repeated(spark, sf):
    """A match whose header comes again counts once."""
    lines = stored(fx.lines_with_repeated_headers(spark, sf), "lines")
    middle = lines.agg(F.max("position")).first()[0] // 2
    parts = [lines.filter(F.col("position") <= middle), lines.filter(F.col("position") > middle)]
    return _standing(_streamed(spark, sf, [p.select("value") for p in parts]))


def _ended(spark: SparkSession, sf: str) -> ingest.Engine:
    """Matches that end without a flush: by headers, by an end record, and by the silence of their source."""
    lines = stored(fx.lines_with_ends(spark, sf), "lines")
    return _streamed(spark, sf, [lines.filter(f"part = {i}").select("value") for i in range(3)], flush=False)


@query
def stream_ends(spark, sf):
    """How every match ended."""
    return _ended(spark, sf).finished()


@query
def stream_ends_metrics(spark, sf):
    """Profile and rating of matches that ended in any way, events that came afterwards included."""
    return _standing(_ended(spark, sf))


#: Matches after which the registered run stops.
STREAM_LIMIT = 25


@query
def stream_limit(spark, sf):
    """Profile and rating after the first matches only; the limit lies within a batch."""
    return _standing(_season_as_stream(spark, sf, limit=STREAM_LIMIT))


def _season_as_stream(spark: SparkSession, sf: str, retrain: bool = False, parts: int = 2, **options) -> ingest.Engine:
    """The season fed to the engine in parts, each a restart of the stream, then flushed."""
    at = scratch_path(spark, "stream")
    lines = stored(fx.stream_lines(spark, sf), "lines")
    size = lines.agg(F.max("position")).first()[0] // parts + 1
    engine = ingest.Engine(spark, f"{at}/state", stored(fx.players(spark, sf), "players"), retrain, **options)
    for part in range(parts):
        piece = lines.filter(F.expr(f"position div {size} = {part}")).select("value")
        piece.write.mode("append").text(f"{at}/lines")
        stream = ingest.open_lines(spark, f"{at}/lines")
        ingest.start_ingest(stream, engine, f"{at}/checkpoint", available_now=True).awaitTermination()
    engine.flush()
    return engine


@query
def stream_state(spark, sf):
    """Chemistry as the stream leaves it."""
    out = _season_as_stream(spark, sf).current_chemistry()
    return out.select("p_lo", "p_hi", r6("chem"), "meetings")


@query
def stream_metrics(spark, sf):
    """Profile and rating as the stream leaves them."""
    return _standing(_season_as_stream(spark, sf))


@query
def stream_model(spark, sf):
    """The line refitted as matches end."""
    line = _season_as_stream(spark, sf, retrain=True).current_model()
    return line.select(r6("slope"), r6("intercept"))
