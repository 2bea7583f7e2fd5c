"""Batch readers. Every schema is given, so a read is one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline import schemas


def read_doodles(spark: SparkSession, path: str) -> DataFrame:
    """Drawing records; the flag is a boolean or a number that is 1 or 0, not a text."""
    kind = F.schema_of_variant("recognized")
    number = F.try_variant_get("recognized", "$", "double")
    flag = F.when(kind == "BOOLEAN", F.try_variant_get("recognized", "$", "boolean")).when(
        ~kind.isin("STRING", "BOOLEAN") & number.isin(0.0, 1.0), number == 1.0
    )
    return spark.read.schema(schemas.DOODLE_FILE).json(path).withColumn("recognized", flag)


def read_edges(spark: SparkSession, path: str, header_lines: int = 0) -> DataFrame:
    """Tab-separated edges; lines starting with `#` are comments. A quote is a character like others.

    `header_lines` instead drops that many lines from the top of each file, for headers without a
    mark. Lines without both ends are no edges and are left out.
    """
    both = F.col("src").isNotNull() & F.col("dst").isNotNull()
    if not header_lines:
        reader = spark.read.schema(schemas.EDGE).option("sep", "\t").option("comment", "#")
        return reader.option("quote", "").csv(path).filter(both)
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    # A header stands in the first block of its file; only those blocks are put in line order.
    top = lines.filter("start = 0")
    order = Window.partitionBy("file").orderBy("at")
    rest = top.withColumn("line", F.row_number().over(order)).filter(F.col("line") > header_lines)
    kept = rest.select("value").unionByName(lines.filter("start > 0").select("value"))
    fields = F.split("value", "\t")
    ends = kept.select(F.get(fields, F.lit(0)).alias("src"), F.get(fields, F.lit(1)).alias("dst"))
    return ends.filter(both)


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """`node,rank` lines; lines too short to hold both are dropped."""
    ranks = spark.read.schema(schemas.RANK).csv(path, mode="PERMISSIVE")
    return ranks.filter(F.col("node").isNotNull() & F.col("rank").isNotNull())


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Columns of a CSV file by the names in its header, in the layout's order and types.

    Only a header line is read to learn the names. Files whose headers differ, and headers that lack a
    column, are errors; a value that does not fit its type is NULL.
    """
    text = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    layout = StructType.fromDDL(schema)
    absent = {f.name.lower() for f in layout} - {c.lower() for c in text.columns}
    if absent:
        raise ValueError(f"{path} has no column {', '.join(sorted(absent))}")
    return text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in layout])


def read_shapes(spark: SparkSession, path: str, with_country: bool = True) -> DataFrame:
    return _csv(spark, path, schemas.SHAPE_WITH_COUNTRY if with_country else schemas.SHAPE)


def read_stroke_stats(spark: SparkSession, path: str, with_country: bool = False) -> DataFrame:
    schema = schemas.STROKE_STATS_WITH_COUNTRY if with_country else schemas.STROKE_STATS
    return _csv(spark, path, schema)


def read_players(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.PLAYER)


def read_teams(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.TEAM)


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Lines that `write_in_order` wrote, with their `place` in the whole, from 1.

    Files follow each other by name. Lines are numbered within a file, which one task wrote; the lines
    of the files before are a row per file.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    within = lines.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("start", "at")))
    files = within.groupBy("file").agg(F.count("*").alias("n"))
    above = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"))
    return within.join(F.broadcast(files), "file").select("value", (F.col("before") + F.col("line")).alias("place"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table this package wrote earlier: profile, chemistry, rating, match archive."""
    return spark.read.parquet(path)


def find_matches(spark: SparkSession, path: str, day: str, title: str | None = None, teams: tuple[int, int] | None = None) -> DataFrame:
    """The archived matches of a day (year-month-day), of a title or of two teams in either order.

    The day picks the folder, the rest reads only the row groups that may hold the match.
    """
    rows = spark.read.parquet(path).filter(F.col("match_date") == F.lit(day).cast("date"))
    if title is not None:
        rows = rows.filter(F.col("title") == title)
    if teams is not None:
        rows = rows.filter(F.col("pair") == "-".join(map(str, sorted(teams))))
    return rows


def read_requests(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
