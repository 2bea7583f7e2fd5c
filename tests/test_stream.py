from __future__ import annotations

import datetime as dt
import json

import league as L
import pytest
from pyspark.sql import functions as F
from test_folds import KNOWN, season

from touchline.operators import folds, metrics, model
from touchline.operators import matches as M
from touchline.plans import fixtures
from touchline.streaming import framing, ingest
from touchline.streaming import state as S


def lines_of(records, events, source="s"):
    """The season as JSON lines of one stream: a header, then its events, and so on."""
    out, at = [], 0
    for r in records:
        head = {k: v for k, v in r.items() if k not in ("match_id", "seq")}
        out.append({"source": source, "position": at, "matchId": r["match_id"], **head})
        at += 1
        for _, _, kind, sub, player, sec, tags in (e for e in events if e[0] == r["match_id"]):
            body = {"eventId": kind, "subEventId": sub, "playerId": player, "eventSec": sec, "tags": tags}
            out.append({"source": source, "position": at, **body})
            at += 1
    return [json.dumps(x) for x in out]


def as_frame(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string").repartition(3)


@pytest.fixture(scope="module")
def batch(spark):
    """The same season through the batch operators."""
    records, events = season(games=6)
    people = L.players(spark, KNOWN)
    history = metrics.player_history(
        M.appearances(L.matches(spark, records)), metrics.event_metrics(L.events(spark, events)), people
    )
    rated = folds.ratings(history)
    return {
        "ratings": {r["player_id"]: r["rating"] for r in folds.current_ratings(rated).collect()},
        "chemistry": {(r["p_lo"], r["p_hi"]): r["chem"] for r in folds.chemistry(rated).collect()},
        "profile": {r["player_id"]: tuple(r) for r in metrics.profile(history, people).collect()},
    }


def state(engine):
    return {
        "ratings": {r["player_id"]: r["rating"] for r in engine.current_ratings().collect()},
        "chemistry": {(r["p_lo"], r["p_hi"]): r["chem"] for r in engine.current_chemistry().collect()},
        "profile": {r["player_id"]: tuple(r) for r in engine.current_profile().collect()},
    }


def agree(got, want):
    assert got["ratings"] == pytest.approx(want["ratings"], abs=1e-12)
    assert got["chemistry"] == pytest.approx(want["chemistry"], abs=1e-12)
    assert got["profile"] == want["profile"]


def test_parse_and_frame(spark):
    lines = [
        '{"source":"a","position":0,"eventId":8,"playerId":1}',
        '{"source":"a","position":5,"matchId":7,"teamsData":{}}',
        '{"source":"a","position":6,"eventId":8,"playerId":1,"subEventId":"","eventSec":"2.5","tags":[{"id":1}]}',
        '{"source":"b","position":6,"teamsData":{}}',
        '{"source":"b","position":9,"eventId":8,"playerId":2,"matchId":7}',
        '{"source":"b","position":10,"eventId":8,"playerId":3}',
        "not json",
        '{"source":"a","position":70000,"eventId":8,"playerId":4}',
    ]
    framed = framing.frame(framing.parse_lines(as_frame(spark, lines)), limit=2)
    got = {(r["source"], r["position"]): r["match_id"] for r in framed.collect()}
    named = got[("b", 6)] if got[("b", 6)] is not None else got[("b", 10)]
    assert got[("a", 0)] is None and got[("a", 6)] == 7 and got[("a", 70000)] == 7
    assert got[("b", 9)] == 7 and got[("b", 10)] == named and named not in (None, 7)
    rows = {r["playerId"]: r for r in framing.event_rows(framed).collect()}
    assert rows[1]["subEventId"] == 0 and rows[1]["eventSec"] == 2.5 and set(rows) == {1, 2, 3, 4}


def test_missing_substitutions_as_text(spark):
    line = (
        '{"source":"a","position":1,"matchId":1,"dateutc":"2018-05-01 10:00:00","duration":"Regular","teamsData":'
        '{"5":{"hasFormation":1,"formation":{"lineup":[{"playerId":1}],"bench":[],"substitutions":"null"}},'
        '"3":{"hasFormation":1,"formation":{"lineup":[{"playerId":2}],"bench":[],"substitutions":[]}}}}'
    )
    rows = framing.header_rows(framing.parse_lines(as_frame(spark, [line])))
    got = {r["player_id"]: (r["team_ord"], r["minutes"]) for r in M.appearances(rows).collect()}
    assert got == {1: (0, None), 2: (1, 90)}


def test_batches_replays_and_flush_equal_one_batch(spark, tmp_path, batch):
    records, events = season(games=6)
    lines = lines_of(records, events)
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN))
    third = len(lines) // 3
    pieces = [lines[:third], lines[third : 2 * third], lines[2 * third :]]
    for i, piece in enumerate(pieces):
        engine.process(as_frame(spark, piece), i)
        if i == 1:
            engine.process(as_frame(spark, piece), i)
    assert engine.matches_done() == 5
    engine.flush()
    engine.flush()
    assert engine.matches_done() == 6
    agree(state(engine), batch)
    assert engine.current_model().first()["slope"] is not None


def test_file_stream_until_the_limit(spark, tmp_path, batch):
    records, events = season(games=6)
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(lines_of(records, events)) + "\n")
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN), retrain=False)
    query = ingest.start_ingest(ingest.open_lines(spark, str(folder)), engine, str(tmp_path / "check"))
    ingest.run_until(query, engine, limit=4, poll_seconds=0.5)
    assert not query.isActive and engine.matches_done() == 5
    engine.flush()
    agree(state(engine), batch)


def test_empty_batch_is_skipped(spark, tmp_path):
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN))
    engine.process(spark.createDataFrame([], "value string"), 0)
    engine.flush()
    assert engine.matches_done() == 0 and not (tmp_path / "state").exists()


def folders(path):
    """Folders of rows below a table, as at=name/part=number."""
    return sorted(f"{at.name}/{part.name}" for at in path.glob("at=*") for part in at.glob("part=*"))


def keyed(spark, path, parts=8):
    return S.KeyedTable(S.Store(spark, str(path)), "t", "k bigint, v bigint", ("k",), parts, ("k",))


def test_keyed_table_rewrites_touched_parts_only(spark, tmp_path):
    table = keyed(spark, tmp_path)
    want = {}
    for version in range(30):
        draft = table.store.begin(version)
        rows = {version % 5: version} if version else {k: -1 for k in range(200)}
        changed = spark.createDataFrame(list(rows.items()), "k bigint, v bigint")
        parts = table.parts_of(changed)
        table.write(draft, changed, str(version), parts)
        table.store.commit(draft)
        want |= rows
        newest = table.store.newest()
        assert [p for p, name in newest.tables["t"].items() if name == str(version)] == [str(p) for p in parts]
        # The copies that the last two records list, and no others.
        assert len(folders(tmp_path / "t")) <= 8 + 1
    newest = table.store.newest()
    assert {r["k"]: r["v"] for r in table.read(newest).collect()} == want
    one = table.parts_of(spark.createDataFrame([(3,)], "k bigint"))
    pruned = table.read(newest, one)
    assert {f.split("/part=")[1].split("/")[0] for f in pruned.inputFiles()} == {str(one[0])}
    assert {r["k"]: r["v"] for r in pruned.filter("k = 3").collect()} == {3: 28}
    assert len(list((tmp_path / "_commits").glob("*.json"))) == 2


def test_log_table_merges_folders(spark, tmp_path):
    table = S.LogTable(S.Store(spark, str(tmp_path)), "t", "k bigint, version int", ("k",), 4)
    for version in range(70):
        draft = table.store.begin(version)
        table.append(draft, spark.createDataFrame([(version % 9,)], "k bigint"), str(version), version)
        table.store.commit(draft)
        assert len(draft.tables["t"]) <= 3 * S.FAN
        assert len(list((tmp_path / "t").glob("at=*"))) <= 3 * S.FAN + 2 * S.FAN
    newest = table.store.newest()
    assert [level for _, level, _ in newest.tables["t"]].count(2) == 1
    rows = sorted((r["version"], r["k"]) for r in table.read(newest).collect())
    assert rows == [(v, v % 9) for v in range(70)]
    assert min(r["version"] for r in table.read(newest, since=64).collect()) >= 64 - 1
    plan = table.read(newest, [2])._jdf.queryExecution().executedPlan().toString()
    assert "(part#" in plan.split("PartitionFilters")[-1] or "(part#" in plan.split("rtitionFilters")[-1]


def test_a_large_part_is_written_by_several_tasks(spark, tmp_path):
    """The reject table is one part, whatever its size."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    store = S.Store(spark, str(tmp_path))
    table, draft = S.LogTable(store, "log", "a bigint, text string, version int", (), 1), S.Draft(0)
    spark.conf.set(size, "100k")
    try:
        table.append(draft, spark.range(0, 60000, 1, 8).select(F.col("id").alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("text")), "0", 0)
    finally:
        spark.conf.unset(size)
    files = [f for f in (tmp_path / "log" / "at=0" / "part=0").iterdir() if f.suffix == ".parquet"]
    assert len(files) > 4
    rows = table.read(draft)
    assert rows.count() == 60000 and rows.agg(F.sum("a")).first()[0] == 60000 * 59999 // 2
    largest = rows.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest < 30000


def test_readers_see_whole_batches_only(spark, tmp_path, monkeypatch, batch):
    records, events = season(games=6)
    lines = lines_of(records, events)
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN))
    half = len(lines) // 2
    engine.process(as_frame(spark, lines[:half]), 0)
    before, done, line = state(engine), engine.matches_done(), engine.current_model().first()
    for broken in ("done", "rated"):
        real = S._Table._write

        def failing(self, rows, name, broken=broken, real=real):
            if self.name == broken:
                raise RuntimeError("lost")
            real(self, rows, name)

        monkeypatch.setattr(S._Table, "_write", failing)
        with pytest.raises(RuntimeError, match="lost"):
            engine.process(as_frame(spark, lines[half:]), 1)
        monkeypatch.setattr(S._Table, "_write", real)
        agree(state(engine), before)
        assert engine.matches_done() == done and engine.current_model().first() == line
    engine.process(as_frame(spark, lines[half:]), 1)
    engine.flush()
    agree(state(engine), batch)


def test_the_running_line_is_the_fitted_one(spark, tmp_path):
    records, events = season(games=6)
    lines = lines_of(records, events)
    born = {p: dt.date(1985 + p, 1 + p % 12, p) for p in KNOWN}
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN, born=born))
    quarter = len(lines) // 4 + 1
    for i in range(4):
        engine.process(as_frame(spark, lines[i * quarter : (i + 1) * quarter]), i)
    engine.flush()
    fitted = model.rating_line(engine.training.read(engine.store.newest())).first()
    kept = engine.current_model().first()
    assert kept["slope"] == pytest.approx(fitted["slope"], rel=1e-9)
    assert kept["intercept"] == pytest.approx(fitted["intercept"], rel=1e-9)


def test_a_match_touches_a_share_of_the_pairs(spark, tmp_path):
    records, events = season(games=6)
    lines = lines_of(records, events)
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN), retrain=False, parts=256)
    engine.process(as_frame(spark, lines), 0)
    before = engine.store.newest().tables["chemistry"]
    engine.flush()
    after = engine.store.newest().tables["chemistry"]
    people = engine.history.read(engine.store.newest(), since=2).select(F.col("player_id").alias("p_lo")).distinct()
    touched = {p for p in after if after[p] != before.get(p)}
    assert touched <= {str(p) for p in engine.chemistry.parts_of(people)}
    assert len(touched) <= people.count() < 256 / 4


def test_a_late_event_reads_the_parts_of_its_match_and_players(spark, tmp_path, monkeypatch):
    records, events = season(games=4)
    lines = [json.loads(x) for x in lines_of(records, events)]
    heads = [i for i, x in enumerate(lines) if "teamsData" in x]
    late = {**lines[heads[1] - 1], "matchId": records[0]["match_id"], "position": 10**6}
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN), retrain=False, parts=64)
    engine.process(as_frame(spark, [json.dumps(x) for x in lines if x is not lines[heads[1] - 1]]), 0)
    read, real = [], S.LogTable.read

    def watched(self, draft, parts=None, since=0):
        read.append((self.name, parts))
        return real(self, draft, parts, since)

    monkeypatch.setattr(S.LogTable, "read", watched)
    engine.process(as_frame(spark, [json.dumps(late)]), 1)
    parts = dict(read)
    assert set(parts) == {"event", "match", "history", "rated"}
    assert len(parts["event"]) == len(parts["match"]) == 1
    people = {p for r in records for side in r["teamsData"].values() for k in ("lineup", "bench") for p in (e["playerId"] for e in side["formation"][k])}
    assert len(parts["history"]) <= len(people | {4, 9}) and len(parts["rated"]) <= 3


def test_a_late_event_folds_only_the_players_whose_row_it_changes(spark, tmp_path):
    records, events = season(games=3)
    lines = [json.loads(x) for x in lines_of(records, events)]
    heads = [i for i, x in enumerate(lines) if "teamsData" in x]
    held = lines[heads[1] - 1]
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN), retrain=False)
    engine.process(as_frame(spark, [json.dumps(x) for x in lines if x is not held]), 0)
    engine.process(as_frame(spark, [json.dumps({**held, "matchId": records[0]["match_id"], "position": 10**6})]), 1)
    anew = {r["player_id"] for r in engine.rated.added(str(ingest.PER_BATCH + ingest.ANEW)).collect()}
    assert anew == {held["playerId"]}


def in_sources(records, events, sources):
    """Every match's lines in the source that `sources` names for it, positions rising over all."""
    out, at = [], 0
    for x in map(json.loads, lines_of(records, events)):
        if "teamsData" in x:
            source = sources[x["matchId"]]
        out.append({**x, "source": source, "position": at})
        at += 1
    return out


def test_ends_by_record_and_by_timer(spark, tmp_path, batch):
    records, events = season(games=6)
    ids = [r["match_id"] for r in records]
    lines = in_sources(records, events, {m: f"s{i}" for i, m in enumerate(ids)})
    last = [x for x in lines if x["source"] == "s0"][-1]
    straggler = [x for x in lines if x["source"] == "s1" and "eventId" in x][-1]
    now = [x for x in lines if x not in (straggler,)]
    # The first match is ended by a record of its source, the second by one that names it, the others by their silence.
    now.append({"source": "s0", "position": 10**6, "end": True})
    now.append({"source": "elsewhere", "position": 1, "end": True, "matchId": ids[1]})
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN), retrain=False, timeout=3600)
    engine.process(as_frame(spark, [json.dumps(x) for x in now]), 0)
    how = {r["match_id"]: r["ended"] for r in engine.finished().collect()}
    assert how[ids[0]] == how[ids[1]] == "end" and last["source"] == "s0"
    assert [how.get(m) for m in ids[2:5]] == ["timeout"] * 3 and ids[5] not in how
    # An event of the ended match that comes later, without its id, still belongs to it.
    engine.process(as_frame(spark, [json.dumps(straggler)]), 1)
    engine.process(as_frame(spark, [json.dumps({"source": "s5", "position": 10**6, "end": True})]), 2)
    assert {r["match_id"]: r["ended"] for r in engine.finished().collect()}[ids[5]] == "end"
    agree(state(engine), batch)
    assert engine.rejected().count() == 0
    engine.flush()
    assert engine.matches_done() == 6


def test_an_engine_stops_at_its_limit_within_a_batch(spark, tmp_path):
    records, events = season(games=6)
    lines = lines_of(records, events)
    heads = [i for i, x in enumerate(lines) if "teamsData" in x]
    some = ingest.Engine(spark, str(tmp_path / "some"), L.players(spark, KNOWN), retrain=False)
    some.process(as_frame(spark, lines[: heads[3]]), 0)
    some.flush()
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN), retrain=False, limit=3)
    engine.process(as_frame(spark, lines[: heads[2] - 1]), 0)
    assert not engine.stopped() and engine.matches_done() == 1
    engine.process(as_frame(spark, lines[heads[2] - 1 :]), 1)
    assert engine.stopped() and engine.matches_done() == 3
    engine.process(as_frame(spark, lines), 2)
    engine.flush()
    assert engine.matches_done() == 3
    agree(state(engine), state(some))


def without_place(lines):
    return [json.dumps({k: v for k, v in json.loads(x).items() if k not in ("source", "position")}) for x in lines]


def test_lines_take_their_place_from_the_file(spark, tmp_path, batch):
    records, events = season(games=6)
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "one.json").write_text("\n".join(without_place(lines_of(records, events))) + "\n")
    (folder / "two.json").write_text('no json\n{"eventId": 8, "playerId": 3}\n{"other": 1}\n')
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN), retrain=False)
    stream = ingest.open_lines(spark, str(folder))
    ingest.start_ingest(stream, engine, str(tmp_path / "check"), available_now=True).awaitTermination()
    engine.flush()
    agree(state(engine), batch)
    rejected = sorted((r["reason"], r["position"]) for r in engine.rejected().collect())
    assert rejected == [(framing.HEADERLESS, 1), (framing.MALFORMED, 0), (framing.NO_KIND, 2)]


def test_positions_follow_the_lines_of_a_split_file(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join(f"line {i}\n" for i in range(5000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        lines = spark.read.text(str(path)).selectExpr("value", "_metadata.file_path AS file", "_metadata.file_block_start AS start", "monotonically_increasing_id() AS at")
        rows = sorted((r["position"], r["value"]) for r in framing.in_file_order(lines).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [v for _, v in rows] == [f"line {i}" for i in range(5000)] and len({p for p, _ in rows}) == 5000


def test_lines_are_placed_without_a_shuffle_of_their_text(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    columns = ["value", "_metadata.file_path AS file", "_metadata.file_block_start AS start", "monotonically_increasing_id() AS at"]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Lines and blocks too large to be broadcast unasked.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        spark.read.text(str(tmp_path / "a.txt")).selectExpr(*columns).write.parquet(str(tmp_path / "lines"))
        placed = framing.in_file_order(spark.read.parquet(str(tmp_path / "lines")))
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert [(r["value"], r["position"]) for r in placed.orderBy("position").collect()] == [("one", 0), ("two", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_a_batch_keeps_the_text_of_rejects_only(spark, tmp_path, monkeypatch):
    seen, real = [], ingest.Engine._step

    def watched(self, arrived, draft):
        seen.extend((r["reason"], r["text"]) for r in arrived.select("reason", "text").collect())
        real(self, arrived, draft)

    monkeypatch.setattr(ingest.Engine, "_step", watched)
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN), retrain=False)
    event = '{"source": "a", "position": 1, "eventId": 8, "playerId": 3}'
    engine.process(as_frame(spark, [event, "no json"]), 0)
    assert sorted(seen, key=str) == [("malformed", "no json"), (None, None)]
    rejected = sorted((r["reason"], json.loads(r["text"]) if r["position"] else r["text"]) for r in engine.rejected().collect())
    assert rejected == [(framing.HEADERLESS, {"eventId": 8, "playerId": 3}), (framing.MALFORMED, "no json")]


def test_saved_pairs_that_did_not_meet_are_kept(spark):
    people = [(1, 5, 0, 10, True, 0.1), (1, 5, 0, 11, True, 0.3), (1, 5, 1, 12, True, -0.1)]
    rated = spark.createDataFrame(people, "match_id bigint, seq int, team_ord int, player_id bigint, on_roster boolean, change double")
    saved = spark.createDataFrame([(10, 11, 0.25, 4), (7, 9, 0.75, 2)], "p_lo bigint, p_hi bigint, chem double, meetings bigint")
    met = {tuple(r) for r in folds.chemistry(rated, saved=saved).collect()}
    assert {(lo, hi, n) for lo, hi, _, n in met} == {(10, 11, 5), (10, 12, 1), (11, 12, 1)}
    assert {tuple(r) for r in folds.chemistry(rated, saved=saved, keep=True).collect()} == met | {(7, 9, 0.75, 2)}


def test_match_records_are_built_by_several_tasks(spark, tmp_path):
    """The days of a season fit one task, but not the records of all teams on them."""
    columns = ["id AS event_id", "id * 20 AS user_id", "timestamp_ntz'2024-01-01 12:00:00' + make_dt_interval(id % 3) AS ts"]
    spark.range(0, 300).selectExpr(*columns).write.parquet(str(tmp_path / "events.parquet"))
    teams = fixtures.team_count(spark, str(tmp_path))
    rows = fixtures.matches(spark, str(tmp_path)).select("match_id", F.spark_partition_id().alias("task")).collect()
    assert len({r["match_id"] for r in rows}) == len(rows) == 3 * teams // 2 > 3 * fixtures.PAIRS_PER_TASK
    assert len({r["task"] for r in rows}) > 1


def test_records_without_a_place_are_refused(spark):
    lines = as_frame(spark, ['{"eventId": 8, "playerId": 3}'])
    with pytest.raises(Exception, match="no source"):
        framing.frame(framing.parse_lines(lines)).collect()


def test_late_events_and_repeated_headers(spark, tmp_path, batch):
    records, events = season(games=6)
    lines = [json.loads(x) for x in lines_of(records, events)]
    late, kept, now = [], [], None
    for n, x in enumerate(lines):
        now = x.get("matchId", now)
        if "eventId" in x and n % 3 == 0:
            late.append({**x, "matchId": now})
        else:
            kept.append(x)
    # Every header again behind its match, and the late events of all matches in two later batches.
    again = []
    for x, following in zip(kept, [*kept[1:], None], strict=True):
        again.append({**x, "position": 2 * x["position"]})
        head = x if "teamsData" in x else head
        if following is None or "teamsData" in following:
            again.append({**head, "position": 2 * x["position"] + 1})
    half = len(again) // 2
    late = [{**x, "position": 10**6 + i} for i, x in enumerate(late)]
    engine = ingest.Engine(spark, str(tmp_path / "state"), L.players(spark, KNOWN), retrain=False)
    for i, part in enumerate([again[:half], again[half:], late[::2], late[1::2]]):
        engine.process(as_frame(spark, [json.dumps(x) for x in part]), i)
    engine.flush()
    assert engine.matches_done() == 6
    agree(state(engine), batch)
