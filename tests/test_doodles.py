from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import doodles

OK = [[[3.0, 1.0], [4.0, 2.0]]]
SUNDAY, MONDAY = "2017-03-05 10:00:00.123450 UTC", "2017-03-06 10:00:00.123450 UTC"


def row(word="cat", country="IN", recognized=True, key="1234567890123456", at=MONDAY, drawing=OK):
    return (word, country, recognized, key, at, drawing)


CASES = [
    (row(), []),
    (row(word="ice cream"), []),
    (row(word="café"), []),
    (row(word="cat7"), ["word"]),
    (row(word="  "), ["word"]),
    (row(word=""), ["word"]),
    (row(word=None), ["word"]),
    (row(country="in"), ["countrycode"]),
    (row(country="IND"), ["countrycode"]),
    (row(country="I1"), ["countrycode"]),
    (row(recognized=None), ["recognized"]),
    (row(key="123456789012345"), ["key_id"]),
    (row(key="12345678901234567"), ["key_id"]),
    (row(key="123456789012345x"), ["key_id"]),
    (row(key="0000000000000000"), []),
    (row(drawing=[]), ["drawing"]),
    (row(drawing=None), ["drawing"]),
    (row(drawing=[[[1.0], [2.0], [3.0]]]), ["drawing"]),
    (row(drawing=[[[1.0]]]), ["drawing"]),
    (row(drawing=[[[1.0, 2.0], [2.0]]]), ["drawing"]),
    (row(drawing=[[[], []]]), ["drawing"]),
    (row(drawing=OK + [[[1.0], []]]), ["drawing"]),
    (row(word="9", country="x", drawing=[]), ["word", "countrycode", "drawing"]),
]


@pytest.fixture(scope="module")
def records(spark):
    rows = [(i, *r) for i, (r, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "i int, " + schemas.DOODLE)


def test_reject_reasons(records):
    got = {r["i"]: (r["valid"], r["reject_reasons"]) for r in doodles.validate(records).collect()}
    for i, (_, reasons) in enumerate(CASES):
        assert got[i] == (not reasons, reasons), CASES[i]


def test_valid_records_agrees_with_validate(records):
    kept = {r["i"] for r in doodles.valid_records(records).collect()}
    assert kept == {i for i, (_, reasons) in enumerate(CASES) if not reasons}


def test_recognized_and_weekend(spark):
    saturday = "2017-03-04 23:59:59.999990 UTC"
    friday = "2017-03-03 23:59:59.999990 UTC"
    rows = [
        row(at=SUNDAY),
        row(recognized=False, at=SUNDAY),
        row(recognized=False, at=saturday),
        row(recognized=False, at=friday),
        row(recognized=False, at=MONDAY),
        row(recognized=False, at="2017-03-05 10:00:00 UTC"),
        row(recognized=False, at="nonsense"),
        row(word="dog"),
        row(key="1"),
    ]
    df = spark.createDataFrame(rows, schemas.DOODLE)
    assert doodles.recognized_and_weekend(df, "cat").collect() == [(1, 3)]
    assert doodles.recognized_and_weekend(df, "bird").collect() == [(0, 0)]


def test_distance_is_strict_and_empty_input_gives_no_row(spark):
    df = spark.createDataFrame([row(), row(country="FR", drawing=[[[6.0], [8.0]]])], schemas.DOODLE)
    assert doodles.country_distance_counts(df, "cat", 5).collect() == [("FR", 1)]
    assert doodles.country_distance_counts(df, "cat", 4.999).count() == 2
    assert doodles.country_distance_counts(df, "dog", 0).collect() == []


def test_stroke_averages_fill_missing_sides(spark):
    rows = [("1", "cat", "TRUE", "3"), ("2", "cat", "TRUE", "4"), ("3", "dog", "FALSE", "1"), ("4", "cat", "TRUE", "x")]
    stats = spark.createDataFrame(rows, schemas.STROKE_STATS)
    cat = doodles.stroke_averages(stats, "cat").first()
    assert (cat["recognized_avg"], cat["unrecognized_avg"]) == (3.5, 0.0)
    assert (cat["recognized_text"], cat["unrecognized_text"]) == ("3.50000", "0.00000")
    assert doodles.stroke_averages(stats, "owl").first()["recognized_avg"] == 0.0
    assert doodles.stroke_averages(stats).count() == 2


@pytest.mark.parametrize("country_on", ["shapes", "stats"])
def test_country_stroke_counts_multiplies_repeated_keys(spark, country_on):
    shapes = [("k1", "x", "IN"), ("k1", "x", "IN"), ("k2", "x", "FR"), ("k3", "x", "FR")]
    stats = [("k1", "cat", "FALSE", "2", "IN")] * 3 + [
        ("k2", "cat", "FALSE", "5", "FR"),
        ("k3", "cat", "TRUE", "1", "FR"),
        ("k9", "cat", "FALSE", "1", "FR"),
    ]
    left = spark.createDataFrame(shapes, schemas.SHAPE_WITH_COUNTRY)
    right = spark.createDataFrame(stats, schemas.STROKE_STATS_WITH_COUNTRY)
    if country_on == "shapes":
        right = right.drop("countrycode")
    else:
        left = left.drop("countrycode")
    out = doodles.country_stroke_counts(left, right, "cat", "5")
    assert out.collect() == [("IN", 6)]
    assert doodles.country_stroke_counts(left, right, "cat", 6).collect() == [("FR", 1), ("IN", 6)]
    with pytest.raises(ValueError):
        doodles.country_stroke_counts(left, right, "cat", "five")


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([row()], schemas.DOODLE).write.parquet(path)
    out = doodles.country_distance_counts(spark.read.parquet(path), "cat", 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(word,cat)" in plan
    assert "timestamp" not in plan.split("ReadSchema")[1]


def test_all_functions_accept_an_empty_frame(spark):
    none = spark.createDataFrame([], schemas.DOODLE)
    assert doodles.valid_counts(none).collect() == []
    assert doodles.reject_counts(none).collect() == []
    assert doodles.validate(none).filter(F.col("valid")).count() == 0
