"""Column expressions shared by the operators. All are built-in functions, none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event kinds, tags and the one sub-event with a meaning of its own.
DUEL, FOUL, FREE_KICK, PASS, SHOT = 1, 2, 3, 8, 10
GOAL, OWN_GOAL, KEY_PASS = 101, 102, 302
DUEL_NEUTRAL, DUEL_LOST, DUEL_WON = 701, 702, 703
ACCURATE, NOT_ACCURATE = 1801, 1802
PENALTY = 35

START_RATING = 0.5
START_CHEMISTRY = 0.5


def tag_ids(tags: Column | str) -> Column:
    """The ids of an event's tags; no tags and a missing list are the same thing."""
    tags = F.col(tags) if isinstance(tags, str) else tags
    return F.coalesce(tags["id"], F.array().cast("array<bigint>"))


def has(ids: Column, tag: int) -> Column:
    return F.coalesce(F.array_contains(ids, F.lit(tag).cast("bigint")), F.lit(False))


def occurrences(ids: Column, tag: int) -> Column:
    return F.size(ids) - F.size(F.array_remove(ids, F.lit(tag).cast("bigint")))


def weighted_pass_accuracy(key_ok: Column, ok: Column, key_bad: Column, bad: Column) -> Column:
    return F.try_divide(ok + 2 * key_ok, ok + bad + 2 * (key_ok + key_bad))


def weighted_shot_accuracy(goal: Column, on_target: Column, other: Column) -> Column:
    return F.try_divide(goal + 0.5 * on_target, goal + on_target + other)


def clamp(value: Column, low: Column | float = 0.0, high: Column | float = 1.0) -> Column:
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return F.least(high, F.greatest(low, value))


def pair_key(left: Column, right: Column) -> tuple[Column, Column]:
    """One key for an unordered pair."""
    return F.least(left, right), F.greatest(left, right)


def age_days(on: Column, birth: Column) -> Column:
    return F.abs(F.datediff(on, birth))


def scaled_age(days: Column) -> Column:
    return days / F.lit(1000.0)


def scaled_rating(rating: Column) -> Column:
    return rating * F.lit(10.0)


def settle_rating(prediction: Column) -> Column:
    """Bring a raw prediction back to the rating scale, halving what overshoots."""
    raw = prediction / F.lit(10.0)
    halved = F.when(raw > 1, raw / 2).otherwise(raw)
    return F.abs(F.when(halved > 0.9, halved / 2).otherwise(halved))


def label_title(label: Column) -> Column:
    """A match label without the score: the text before the first comma."""
    return F.substring_index(label, ",", 1)


def date_part(dateutc: Column) -> Column:
    return F.try_to_date(F.substring_index(dateutc, " ", 1), "yyyy-MM-dd")


def day_number(day: Column) -> Column:
    return F.unix_date(day)


def positive_count(text: Column) -> Column:
    """The counter's value where it is a whole number above zero, else NULL."""
    number = text.try_cast("int")
    return F.when(number > 0, number)


def five_decimals(value: Column) -> Column:
    return F.format_string("%.5f", F.round(value, 5))


def is_weekend(timestamp: Column) -> Column:
    """The text ends in a four-character zone suffix, which is cut before parsing."""
    bare = F.substring(timestamp, F.lit(1), F.length(timestamp) - 4)
    parsed = F.try_to_timestamp(bare, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]"))
    return F.coalesce(F.weekday(parsed).isin(5, 6), F.lit(False))


def first_point_distance(drawing: Column) -> Column:
    stroke = F.get(drawing, F.lit(0))
    x = F.get(F.get(stroke, F.lit(0)), F.lit(0))
    y = F.get(F.get(stroke, F.lit(1)), F.lit(0))
    return F.hypot(x, y)
