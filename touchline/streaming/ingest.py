"""The running engine: a text stream of match headers and events, folded into state tables.

Each micro-batch is parsed once, framed, appended to the archive, and the matches that came to an end in it go
through the batch operators, continuing from the state the batches before it left. A match ends when a
newer header follows in its source, when an end record says so (`"end": true`, of the match it names or of
the one open in its source), or by a timer: once the event time of all sources has passed the last event
time of the match by `timeout` seconds. The event time of a match is its kick-off plus the greatest
`eventSec` seen; the stream's is the greatest of all matches.

Folds follow arrival: matches of one batch in (seq, match_id) order, batches one after the other. A match whose
header comes again is not folded again. If events of a finished match arrive late, those of its source included,
the values of its players, and of the pairs they belong to, are folded anew over all their matches in
(seq, match_id) order. Lines that are no record, and events before the first header of their source, go to a
reject table with the reason. With a `limit` the engine folds so many matches, in the order of folding, and
then ignores what still comes.

Everything a batch changes, the counts and the sums behind the rating line included, is published by one commit
record, so readers see the state before the batch or after it. Nothing is kept in the driver between
batches, so a restart resumes where the checkpoint stands; a state folder belongs to one checkpoint.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline import schemas
from touchline.operators import folds, matches, metrics, model
from touchline.session import scratch_scope, stored
from touchline.streaming.framing import (
    HEADERLESS,
    event_rows,
    frame,
    header_rows,
    headerless,
    in_file_order,
    kick_off,
    read_lines,
)
from touchline.streaming.state import PARTS, Draft, KeyedTable, LogTable, Store, delete_folders

TRIGGER = "5 seconds"
MATCH_LIMIT = 380
TIMEOUT = 4 * 3600

_HISTORY = (
    "match_id bigint, seq int, match_date date, team_ord int, team_id bigint, player_id bigint, "
    "known boolean, on_roster boolean, minutes int, full_time int, contribution double, "
) + ", ".join(f"{c} bigint" for c in metrics.COUNTERS)

_RATED = (
    "player_id bigint, seq int, match_id bigint, match_date date, team_ord int, known boolean, "
    "on_roster boolean, contribution double, prior_fouls bigint, prior_own_goals bigint, "
    "perf double, rating double, change double"
)

_ARRIVED = schemas.STREAM_LINE + ", is_match boolean, is_end boolean, reason string, text string"

#: Versions of a batch: late events folded anew, matches that ended, a flush after the batch.
PER_BATCH, ANEW, ENDED, FLUSHED = 4, 0, 1, 2


def _together(*works) -> None:
    """Jobs that do not need each other run side by side."""
    with ThreadPoolExecutor(len(works)) as pool:
        for done in [pool.submit(copy_context().run, w) for w in works]:
            done.result()


@dataclass
class Engine:
    spark: SparkSession
    state_dir: str
    players: DataFrame
    retrain: bool = True
    limit: int | None = None
    timeout: int | None = TIMEOUT
    parts: int = PARTS

    def __post_init__(self) -> None:
        store = self.store = Store(self.spark, self.state_dir)

        def log(name: str, schema: str, *deal: str) -> LogTable:
            return LogTable(store, name, f"{schema}, version int", deal, self.parts if deal else 1)

        def keyed(name: str, schema: str, keys: tuple[str, ...], *deal: str) -> KeyedTable:
            return KeyedTable(store, name, schema, deal, self.parts if deal else 1, keys)

        self.matches = log("match", schemas.MATCH + ", source string, position bigint", "match_id")
        self.events = log("event", schemas.EVENT, "match_id")
        self.history = log("history", _HISTORY, "player_id")
        self.rated = log("rated", _RATED, "match_id")
        self.rejects = log("reject", "source string, position bigint, reason string, text string")
        self.done = keyed("done", "match_id bigint, ended string", ("match_id",), "match_id")
        self.open = keyed(
            "open", "source string, position bigint, match_id bigint, since int, kickoff bigint, last_time bigint, ended string", ("source",)
        )
        self.ratings = keyed("rating", "player_id bigint, rating double", ("player_id",), "player_id")
        sums = ", ".join(f"{c} bigint" for c in metrics.PROFILE_SUMS)
        self.totals = keyed("totals", f"player_id bigint, {sums}", ("player_id",), "player_id")
        # By one player of the pair, so that the players of a batch tell which parts it touches.
        self.chemistry = keyed("chemistry", "p_lo bigint, p_hi bigint, chem double, meetings bigint", ("p_lo", "p_hi"), "p_lo")
        self.training = keyed("training", "player_id bigint, seq int, match_id bigint, diff int, rating double", ("player_id",), "player_id")

    def process(self, lines: DataFrame, batch_id: int) -> None:
        """The foreachBatch callback; a batch that has been committed is not looked at again.

        `lines` has the text in `value` and, unless that holds source and position, either these two as
        columns or `file` and `start` as `open_lines` gives them.
        """
        version = PER_BATCH * batch_id
        draft = self.store.begin(version)
        if draft is None or draft.values.get("stopped") or lines.isEmpty():
            return
        spark, landed = self.spark, f"{self.store.path}/arriving/version={version}"
        if "start" in lines.columns:
            # Row order within a block is known only while the block is read.
            lines.withColumn("at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{landed}/lines")
            lines = in_file_order(spark.read.parquet(f"{landed}/lines"))
        # The text is kept of lines that are no records; the others have been read.
        records = read_lines(lines).withColumn("text", F.when(F.col("reason").isNotNull(), F.col("text")))
        records.write.mode("overwrite").parquet(f"{landed}/records")
        arrived = spark.read.schema(_ARRIVED).parquet(f"{landed}/records")
        with scratch_scope(spark):
            self._step(arrived, draft)
        self.store.commit(draft)
        delete_folders(spark, [landed])

    def flush(self) -> None:
        """Process the matches still open at the end of the streams."""
        newest = self.store.newest()
        if newest is None or newest.version % PER_BATCH or newest.values.get("stopped"):
            return
        draft = self.store.begin(newest.version + FLUSHED)
        waiting = self.open.read(draft).filter("ended IS NULL").withColumn("ended", F.lit("flush"))
        with scratch_scope(self.spark):
            self._fold(waiting, draft, draft.version)
            self.open.write(draft, waiting, str(draft.version), [0])
        self.store.commit(draft)

    def _step(self, arrived: DataFrame, draft: Draft) -> None:
        version, name = draft.version, str(draft.version)
        bad = F.col("reason").isNotNull()
        records = arrived.filter(~bad).drop("reason", "text")
        carried = self.open.read(draft)
        framed = frame(self._with_open(records, carried))
        shown = ["source", "position", "reason", "text"]
        early = headerless(framed).withColumn("reason", F.lit(HEADERLESS))
        early = early.withColumn("text", F.to_json(F.struct("eventId", "subEventId", "playerId", "eventSec", "tags")))
        rejected = arrived.filter(bad).select(*shown).unionByName(early.select(*shown))
        _together(
            lambda: self.matches.append(draft, header_rows(records), name, version),
            lambda: self.events.append(draft, event_rows(framed), name, version),
            lambda: self.rejects.append(draft, rejected, name, version),
        )
        standing = stored(self._standing(carried, records, name, version), "stream-open")
        newest = standing.filter("newest")
        self.open.write(draft, newest.drop("newest", "was"), name, [0])
        if draft.values.get("done"):
            late = self.events.added(name).select("match_id").distinct()
            finished = self.done.read(draft, self.done.parts_of(late)).select("match_id")
            self._fold_anew(stored(late.join(finished, "match_id", "left_semi"), "stream-late"), draft, version + ANEW)
        ended = standing.filter("was IS NULL AND ended IS NOT NULL")
        self._fold(ended.drop("newest", "was"), draft, version + ENDED)

    def _standing(self, carried: DataFrame, records: DataFrame, name: str, version: int) -> DataFrame:
        """All headers open before or begun now: the newest of each source, how each ended, and how it stood before (`was`)."""
        begun = self.matches.added(name).select(
            "source", "position", "match_id", F.col("version").alias("since"), kick_off("dateutc").alias("kickoff")
        )
        begun = begun.withColumns({"last_time": F.col("kickoff"), "ended": F.lit(None).cast("string")})
        headers = carried.unionByName(begun)
        last = headers.groupBy("source").agg(F.max("position").alias("last"))
        played = self.events.added(name).groupBy("match_id").agg(F.max("eventSec").alias("played"))
        ends = records.filter("is_end").select("source", F.col("position").alias("end_at"), F.col("matchId").alias("ends"))
        here = ends.groupBy("source").agg(F.max(F.when(F.col("ends").isNull(), F.col("end_at"))).alias("end_at"))
        named = ends.filter("ends IS NOT NULL").select(F.col("ends").alias("match_id"), F.lit(True).alias("named")).distinct()
        rows = headers.join(last, "source").join(played, "match_id", "left").join(here, "source", "left").join(named, "match_id", "left")
        seen = F.col("kickoff") + F.ceil(F.coalesce("played", F.lit(0.0)))
        rows = rows.withColumns({"newest": F.col("position") == F.col("last"), "was": F.col("ended"), "last_time": F.greatest("last_time", seen)})
        silent = F.lit(False)
        if self.timeout is not None:
            clock = rows.agg(F.max("last_time")).first()[0]
            silent = F.coalesce(F.col("last_time") + self.timeout < F.lit(clock).cast("bigint"), F.lit(False))
        ended = (
            F.when(F.col("was").isNotNull(), F.col("was"))
            .when(~F.col("newest"), "header")
            .when(F.coalesce("named", F.lit(False)) | F.coalesce(F.col("end_at") > F.col("position"), F.lit(False)), "end")
            .when(silent, "timeout")
        )
        rows = rows.withColumn("ended", ended)
        return rows.select("source", "position", "match_id", "since", "kickoff", "last_time", "ended", "newest", "was")

    def _newest(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        """The rows as the newest version of each key has them."""
        newest = rows.groupBy(*keys).agg(F.max("version").alias("version"))
        return rows.join(newest, [*keys, "version"], "left_semi").drop("version")

    def _records(self, ids: DataFrame, draft: Draft, parts: list[int], since: int = 0) -> DataFrame:
        """One header for each match, the first that came."""
        rows = self.matches.read(draft, parts, since).join(ids, "match_id", "left_semi")
        columns = [c for c in rows.columns if c != "match_id"]
        first = rows.groupBy("match_id").agg(F.min_by(F.struct(*columns), F.struct("version", "source", "position")).alias("r"))
        return first.select("match_id", "r.*").drop("version")

    def _histories(self, ids: DataFrame, draft: Draft, version: int, since: int = 0) -> DataFrame:
        """Appends the player rows of the matches, from all their events; these rows."""
        parts = self.events.parts_of(ids)
        events = self.events.read(draft, parts, since).join(ids, "match_id", "left_semi").drop("version")
        records = self._records(ids, draft, parts, since)
        rows = metrics.player_history(matches.appearances(records), metrics.event_metrics(events), self.players)
        self.history.append(draft, rows, str(version), version)
        return self.history.added(str(version)).drop("version")

    def _fold_anew(self, late: DataFrame, draft: Draft, version: int) -> None:
        """Fold players anew, and their pairs, whose part in a finished match late events have changed."""
        if late.isEmpty():
            return
        name = str(version)
        now = self._histories(late, draft, version)
        before = self.history.read(draft, self.history.parts_of(now)).filter(F.col("version") < version)
        before = self._newest(before.join(late, "match_id", "left_semi"), ["match_id", "player_id"])
        changed = now.subtract(before.select(*now.columns))
        people = stored(changed.select("player_id").distinct(), "stream-people")
        if people.isEmpty():
            return
        parts = self.history.parts_of(people)
        history = self.history.read(draft, parts).join(people, "player_id", "left_semi")
        history = stored(self._newest(history, ["match_id", "player_id"]), "stream-history")
        self.rated.append(draft, folds.ratings(history), name, version)
        own = self.rated.added(name).drop("version")
        theirs = own.select("match_id").distinct()
        met = self.rated.read(draft, self.rated.parts_of(theirs)).join(theirs, "match_id", "left_semi")
        met = stored(self._newest(met, ["match_id", "player_id"]), "stream-met")
        touched = stored(folds.chemistry(met, of=people), "stream-pairs")
        _together(
            lambda: self.chemistry.write(draft, touched, name, self.chemistry.parts_of(touched)),
            lambda: self.totals.write(draft, metrics.profile_totals(history), name, parts),
            lambda: self._train(draft, own, name, parts),
            lambda: self.ratings.write(draft, folds.current_ratings(own), name, parts),
        )

    def _train(self, draft: Draft, rated: DataFrame, name: str, parts: list[int]) -> None:
        """Put the players' newest training rows in place of their old ones, in the table and in the sums."""
        now = model.training_frame(rated, self.players)
        if not self.retrain:
            self.training.write(draft, now, name, parts)
            return
        now = stored(now, "stream-training")
        before = self.training.read(draft, parts).join(now.select("player_id"), "player_id", "left_semi")
        change = model.line_sums(before, now)
        held = draft.values.get("line", {})
        self.training.write(draft, now, name, parts)
        draft.values["line"] = {k: str(Decimal(held.get(k, "0")) + v) for k, v in change.items()}

    def _with_open(self, records: DataFrame, carried: DataFrame) -> DataFrame:
        """The records, and in front of them the newest header of each source."""
        known = {"source", "position", "matchId", "is_match", "is_end"}
        blank = [F.lit(None).cast(k).alias(n) for n, k in records.dtypes if n not in known]
        kept = carried.select(
            "source",
            "position",
            F.col("match_id").alias("matchId"),
            F.lit(True).alias("is_match"),
            F.lit(False).alias("is_end"),
            *blank,
        )
        return records.unionByName(kept)

    def _fold(self, ended: DataFrame, draft: Draft, version: int) -> None:
        """Metrics, ratings, chemistry, profile and model for the matches that ended, each once."""
        name = str(version)
        finished = self.done.read(draft, self.done.parts_of(ended)).select("match_id")
        how = F.min_by("ended", F.struct("since", "source", "position")).alias("ended")
        fresh = ended.join(finished, "match_id", "left_anti").groupBy("match_id").agg(how, F.min("since").alias("since"))
        fresh = stored(fresh, "stream-ended")
        span = fresh.agg(F.count("*").alias("n"), F.min("since").alias("since")).first()
        count, done = span["n"], draft.values.get("done", 0)
        if self.limit is not None and done + count >= self.limit:
            draft.values["stopped"] = True
            if done + count > self.limit:
                seq = self._records(fresh.select("match_id"), draft, self.matches.parts_of(fresh), span["since"]).select("match_id", "seq")
                fresh = stored(fresh.join(seq, "match_id").orderBy("seq", "match_id").limit(self.limit - done).drop("seq"), "stream-ended")
                count = self.limit - done
        if not count:
            return
        ids = fresh.select("match_id")
        # Folders older than the oldest of these headers are not opened at all.
        history = self._histories(ids, draft, version, span["since"])
        parts = self.history.parts_of(history)
        rated = folds.ratings(
            history,
            saved_ratings=self.ratings.read(draft, parts),
            saved_totals=self.totals.read(draft, parts),
        )
        self.rated.append(draft, rated, name, version)
        rated = self.rated.added(name).drop("version")
        # Old and new pairs meet once, where the new ones are folded, not again where they are written.
        chemistry = folds.chemistry(rated, saved=self.chemistry.read(draft, parts), keep=True)
        here = self.totals.read(draft, parts).join(history.select("player_id").distinct(), "player_id", "left_semi")
        totals = metrics.profile_totals(history, here)
        _together(
            lambda: self.chemistry.replace(draft, chemistry, name),
            lambda: self.totals.write(draft, totals, name, parts),
            lambda: self._train(draft, rated, name, parts),
            lambda: self.ratings.write(draft, folds.current_ratings(rated), name, parts),
            lambda: self.done.write(draft, fresh.select("match_id", "ended"), name, self.done.parts_of(ids)),
        )
        draft.values["done"] = done + count

    # State as of the newest commit.

    def current_ratings(self) -> DataFrame:
        return self.ratings.read(self.store.newest())

    def current_chemistry(self) -> DataFrame:
        return self.chemistry.read(self.store.newest())

    def current_profile(self) -> DataFrame:
        names = self.players.select(F.col("Id").alias("player_id"), "name")
        view = metrics.profile_view(self.totals.read(self.store.newest()))
        return view.join(names, "player_id").select("player_id", "name", *metrics.PROFILE_COLUMNS)

    def current_model(self) -> DataFrame:
        """Slope and intercept of the rating line, from the running sums."""
        newest = self.store.newest()
        return model.line_of_sums(self.spark, newest.values.get("line", {}) if newest else {})

    def rejected(self) -> DataFrame:
        """Lines that were no records: source, position, reason, text."""
        return self.rejects.read(self.store.newest()).drop("version")

    def finished(self) -> DataFrame:
        """match_id and how each ended: header, end, timeout or flush."""
        return self.done.read(self.store.newest())

    def matches_done(self) -> int:
        newest = self.store.newest()
        return newest.values.get("done", 0) if newest else 0

    def stopped(self) -> bool:
        newest = self.store.newest()
        return bool(newest and newest.values.get("stopped"))


def open_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON lines arriving as files in a folder, and in folders below it, with their place in the file."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def start_ingest(
    lines: DataFrame, engine: Engine, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Start the stream; `lines` is any streaming frame with a text column `value`."""
    writer = lines.writeStream.foreachBatch(engine.process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=TRIGGER)
    return writer.start()


def run_until(
    query: StreamingQuery, engine: Engine, limit: int = MATCH_LIMIT, poll_seconds: float = 5.0
) -> None:
    """Stop the stream once an engine with a limit has reached it.

    Such an engine folds no match beyond its limit. Of one without, the stream is stopped once more than
    `limit` matches are done, after the batch at hand.
    """
    while query.isActive:
        if engine.stopped() or (engine.limit is None and engine.matches_done() > limit):
            query.stop()
            return
        time.sleep(poll_seconds)
    query.awaitTermination()
