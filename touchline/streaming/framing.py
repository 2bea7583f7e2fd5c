"""The mixed stream of match headers and events: parsing, splitting, framing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.matches import with_match_order
from touchline.operators.metrics import normalise_events
from touchline.operators.scan import carry_last
from touchline.schemas import STREAM_LINE

#: Records of one source that one task looks at.
FRAME_ROWS = 200_000


#: Why a line is no record.
MALFORMED = "malformed"
NO_KIND = "neither header nor event"
HEADERLESS = "before the first header"


def read_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to records, with `is_match`, `is_end` and, where a line is no record, the `reason`.

    A record is a header, an event, or an end record, which has `end` true and may name its match.

    A line's place is the `source` and `position` in its text; failing that, the columns of these names
    beside the text, which the reader of any ordered transport can give.
    """
    beside = [c for c in ("source", "position") if c in lines.columns]
    rows = lines.select(
        F.col(column).alias("__text"),
        *[F.col(c).alias(f"__{c}") for c in beside],
        F.from_json(F.col(column), STREAM_LINE, {"mode": "PERMISSIVE"}).alias("r"),
    )
    end = F.coalesce(F.col("r.end"), F.lit(False))
    match, event = F.col("r.teamsData").isNotNull(), F.col("r.eventId").isNotNull()
    is_object = F.coalesce(F.startswith(F.ltrim("__text"), F.lit("{")), F.lit(False)) & F.try_parse_json("__text").isNotNull()
    reason = F.when(~is_object, MALFORMED).when(~match & ~event & ~end, NO_KIND)
    for c in beside:
        rows = rows.withColumn("r", F.col("r").withField(c, F.coalesce(F.col(f"r.{c}"), F.col(f"__{c}"))))
    kinds = [match.alias("is_match"), (end & ~match).alias("is_end")]
    return rows.select("r.*", *kinds, reason.alias("reason"), F.col("__text").alias("text"))


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines that are records; see `read_lines` for the others."""
    return read_lines(lines, column).filter(F.col("reason").isNull()).drop("reason", "text")


def in_file_order(lines: DataFrame) -> DataFrame:
    """Give lines read from files (value, file, start, at) their source, the file, and their position in it.

    `start` is the offset of a line's block in the file and `at` a number that rises within the block. A
    line takes at least a byte, so start + rank in the block is unique and in order. One row per block, its
    first number, goes to all tasks: shuffled, the lines would meet in no more tasks than there are blocks.
    """
    base = lines.groupBy("file", "start").agg(F.min("at").alias("__base"))
    placed = lines.join(F.broadcast(base), ["file", "start"])
    position = F.col("start") + F.col("at") - F.col("__base")
    return placed.select("value", F.col("file").alias("source"), position.alias("position"))


def _placed(records: DataFrame) -> DataFrame:
    """Refuse records that have no place; they would get lost on the way."""
    position, source = F.col("position"), F.col("source")
    fits = source.isNotNull() & position.isNotNull()
    refused = F.raise_error(F.lit("a stream record has no source or no position"))
    # Both keys, since a join on a missing source would drop the row before its position is looked at.
    return records.withColumns(
        {"source": F.when(fits, source).otherwise(refused.cast("string")), "position": F.when(fits, position).otherwise(refused.cast("bigint"))}
    )


def header_id() -> Column:
    """A header's match: its own id, else one named after its place in the stream."""
    return F.coalesce("matchId", F.xxhash64("source", "position"))


def frame(records: DataFrame, limit: int = FRAME_ROWS) -> DataFrame:
    """Add `match_id`: that of the record itself, else of the last header before it in its source.

    Positions may be any whole numbers, lines of a file or nanoseconds of a clock.
    """
    opened = _placed(records).withColumn("__opens", F.when(F.col("is_match"), header_id()))
    framed = carry_last(opened, ["source"], "position", "__opens", "__open", limit)
    return framed.withColumn("match_id", F.coalesce("matchId", "__open")).drop("__opens", "__open")


def kick_off(dateutc: str) -> Column:
    """Seconds since 1970 of a header's date and time; NULL if it has none."""
    return F.unix_timestamp(F.try_to_timestamp(dateutc, F.lit("yyyy-MM-dd HH:mm:ss")))


def header_rows(records: DataFrame) -> DataFrame:
    """Match records of the stream; they need no framing."""
    rows = records.filter("is_match").select(
        "source",
        "position",
        header_id().alias("match_id"),
        "dateutc",
        "label",
        "winner",
        "gameweek",
        "duration",
        "venue",
        "teamsData",
    )
    return with_match_order(rows)


def _is_event(framed: DataFrame) -> Column:
    event = ~F.col("is_match")
    return event & ~F.col("is_end") if "is_end" in framed.columns else event


def event_rows(framed: DataFrame) -> DataFrame:
    """Event records with their match; events before any header belong to none (see `headerless`)."""
    rows = framed.filter(_is_event(framed) & F.col("match_id").isNotNull()).select(
        "match_id",
        F.col("position").alias("seq"),
        "eventId",
        "subEventId",
        "playerId",
        "eventSec",
        "tags",
    )
    return normalise_events(rows)


def headerless(framed: DataFrame) -> DataFrame:
    """Events that stand before the first header of their source."""
    return framed.filter(_is_event(framed) & F.col("match_id").isNull())
