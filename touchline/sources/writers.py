"""Batch writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import pair_key
from touchline.operators.matches import titled


def write_graph(lists: DataFrame, ranks: DataFrame, path: str) -> None:
    """Adjacency parts and starting ranks, side by side."""
    lists.write.mode("overwrite").parquet(f"{path}/adjacency")
    ranks.write.mode("overwrite").parquet(f"{path}/ranks")


def write_in_order(df: DataFrame, path: str, order: list[str], sep: str = "\t") -> None:
    """Text lines of all columns, sorted as a whole: by file, and by line within a file."""
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns])
    df.orderBy(*order).select(line.alias("value")).write.mode("overwrite").text(path)


def write_ranks(ranks: DataFrame, path: str) -> None:
    ranks.select("node", "rank").write.mode("overwrite").csv(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_matches(matches: DataFrame, path: str, group_bytes: int | None = None) -> None:
    """Append raw match records, with their title and pair of teams, to the archive for `readers.find_matches`.

    One folder per match day. Within a day rows are sorted by title, so that a row group covers a range of
    titles, and carry Bloom filters of titles and pairs; `group_bytes` is the size of a row group.
    """
    lo, hi = pair_key(F.col("first_team"), F.col("second_team"))
    keyed = titled(matches).withColumn("pair", F.concat_ws("-", lo, hi)).drop("first_team", "second_team")
    placed = keyed.repartitionByRange("match_date", "title").sortWithinPartitions("match_date", "title")
    writer = placed.write.mode("append").partitionBy("match_date")
    for column in ("title", "pair"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if group_bytes is not None:
        writer = writer.option("parquet.block.size", group_bytes)
    writer.parquet(path)


def write_answers(answers: DataFrame, path: str) -> None:
    answers.write.mode("overwrite").json(path)
