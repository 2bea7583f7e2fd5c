"""Drawing records: validity, conditional counts, stroke statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import first_point_distance, five_decimals, is_weekend


def valid_word(word: Column) -> Column:
    return F.replace(word, F.lit(" "), F.lit("")).rlike(r"^\p{L}+$")


def valid_country(code: Column) -> Column:
    upper_case = (code == F.upper(code)) & (code != F.lower(code))
    return code.rlike(r"^\p{L}{2}$") & upper_case


def valid_key(key: Column) -> Column:
    return key.rlike(r"^\p{Nd}{16}$")


def valid_drawing(drawing: Column) -> Column:
    def stroke_ok(stroke: Column) -> Column:
        xs, ys = F.get(stroke, F.lit(0)), F.get(stroke, F.lit(1))
        return (F.size(stroke) == 2) & (F.size(xs) == F.size(ys)) & (F.size(xs) > 0)

    return (F.size(drawing) > 0) & F.forall(
        drawing, lambda s: F.coalesce(stroke_ok(s), F.lit(False))
    )


def _checks() -> dict[str, Column]:
    checks = {
        "word": valid_word(F.col("word")),
        "countrycode": valid_country(F.col("countrycode")),
        "recognized": F.col("recognized").isNotNull(),
        "key_id": valid_key(F.col("key_id")),
        "drawing": valid_drawing(F.col("drawing")),
    }
    return {name: F.coalesce(ok, F.lit(False)) for name, ok in checks.items()}


def validate(df: DataFrame) -> DataFrame:
    """Add `valid` and `reject_reasons`, the names of the fields that failed."""
    checks = _checks()
    reasons = F.array_compact(
        F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks.items()])
    )
    valid = F.lit(True)
    for ok in checks.values():
        valid = valid & ok
    return df.select("*", valid.alias("valid"), reasons.alias("reject_reasons"))


def valid_records(df: DataFrame) -> DataFrame:
    """Rows that pass every check; one filter, so its cheap parts reach the scan."""
    for ok in _checks().values():
        df = df.filter(ok)
    return df


def valid_counts(df: DataFrame) -> DataFrame:
    """Rows and valid rows per word."""
    return validate(df).groupBy("word").agg(
        F.count("*").alias("records"), F.count_if("valid").alias("valid_records")
    )


def reject_counts(df: DataFrame) -> DataFrame:
    reasons = validate(df).select(F.explode("reject_reasons").alias("reason"))
    return reasons.groupBy("reason").agg(F.count("*").alias("rejected"))


def recognized_and_weekend(df: DataFrame, word: str) -> DataFrame:
    """Recognized drawings of the word, and unrecognized ones made on a weekend. Always one row."""
    rows = valid_records(df.filter(F.col("word") == word))
    weekend = is_weekend(F.col("timestamp"))
    return rows.agg(
        F.count_if("recognized").alias("recognized_count"),
        F.count_if(~F.col("recognized") & weekend).alias("weekend_unrecognized_count"),
    )


def country_distance_counts(df: DataFrame, word: str, distance: float) -> DataFrame:
    """Drawings of the word, per country, whose first point is farther out than `distance`."""
    rows = valid_records(df.filter(F.col("word") == word))
    far = rows.filter(first_point_distance(F.col("drawing")) > F.lit(float(distance)))
    return far.groupBy("countrycode").agg(F.count("*").alias("cnt"))


def _recognized_flag(stats: DataFrame) -> Column:
    if dict(stats.dtypes)["recognized"] == "boolean":
        return F.col("recognized")
    return F.col("recognized").try_cast("boolean")


def stroke_averages(stats: DataFrame, word: str | None = None) -> DataFrame:
    """Mean strokes of recognized and of unrecognized drawings; a missing side is 0.

    With a word there is one row whatever the input; without one, a row per word.
    """
    flag = _recognized_flag(stats)
    strokes = F.col("Total_Strokes").try_cast("int")
    sides = [
        F.coalesce(F.avg(F.when(flag, strokes)), F.lit(0.0)).alias("recognized_avg"),
        F.coalesce(F.avg(F.when(~flag, strokes)), F.lit(0.0)).alias("unrecognized_avg"),
    ]
    if word is None:
        out = stats.groupBy("word").agg(*sides)
    else:
        out = stats.filter(F.col("word") == word).agg(*sides).withColumn("word", F.lit(word))
    return out.select(
        "word",
        "recognized_avg",
        "unrecognized_avg",
        five_decimals(F.col("recognized_avg")).alias("recognized_text"),
        five_decimals(F.col("unrecognized_avg")).alias("unrecognized_text"),
    )


def country_stroke_counts(shapes: DataFrame, stats: DataFrame, word: str, k: int | str) -> DataFrame:
    """Unrecognized drawings of the word with fewer than k strokes, per country, in country order.

    The answer only counts joined pairs, so each side is first reduced to a count per key: a key that
    repeats on both sides costs one joined row instead of the product of its copies.
    """
    k = int(k)
    wanted = stats.filter(
        (F.col("word") == word)
        & ~_recognized_flag(stats)
        & (F.col("Total_Strokes").try_cast("int") < k)
    )
    in_shapes = "countrycode" in shapes.columns
    left_by = ["key_id", "countrycode"] if in_shapes else ["key_id"]
    right_by = ["key_id"] if in_shapes else ["key_id", "countrycode"]
    left = shapes.groupBy(*left_by).agg(F.count("*").alias("__l"))
    right = wanted.groupBy(*right_by).agg(F.count("*").alias("__r"))
    joined = left.join(right, "key_id")
    return (
        joined.groupBy("countrycode")
        .agg(F.sum(F.col("__l") * F.col("__r")).alias("cnt"))
        .orderBy("countrycode")
    )
