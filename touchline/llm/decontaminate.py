"""Benchmark decontamination by spaced seeds.

A seed looks at six tokens in a row through a fixed mask that ignores two of them. The three masks
ignore a different pair each, so that six aligned tokens with one substitution still agree under one of
them. Equal seed hashes of a training text and a benchmark item give a diagonal: the shift that lays
one upon the other. On each diagonal the tokens are compared one by one, and a text leaks an item if in
some stretch of `stretch` aligned tokens (the whole item, if that is shorter) at least `share` agree.
A stretch of 13 with at most 2 substitutions always holds six tokens with at most one. It even holds four
seeds that agree; how many any stretch must hold is counted out for each length (`least_seeds`), and diagonals
with fewer are left out before texts are compared.

Tokens are runs of letters and digits in lower case. Only DataFrame operations are used; the seeds of
the benchmark are broadcast if their counted rows are within a bound, else joined by a shuffle.

Defined results: null texts count as empty and leak nothing; an item of fewer than six tokens is too
short to prove a leak, unless `short_items` asks for such items too: then a text leaks one if it holds all of its
tokens in a row, which hashes of the text's runs of as many tokens tell; equal items all count; rows that repeat give one result; no rows in, none out.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import WORD_BREAK, body, free_name, small, text_key
from touchline.session import stored


#: Tokens that a seed looks at, four through a mask: ####.. or ##..## or ..####, the last being the first two places on.
SPAN = 6


@dataclass(frozen=True)
class Settings:
    stretch: int = 13
    share: float = 0.8
    #: Seeds, of 24 bytes, up to which the benchmark is broadcast.
    broadcast_rows: int = 1_000_000
    #: Whether items below six tokens count, as whole runs of tokens.
    short_items: bool = False


def least_seeds(stretch: int, share: float) -> int:
    """The fewest seeds that agree in a stretch where at least `share` of the tokens do, over all cases."""
    wrong = stretch - math.ceil(share * stretch - 1e-9)
    found = []
    for bad in itertools.combinations(range(stretch), wrong):
        ok = [i not in bad for i in range(stretch)]
        full = sum(all(ok[i : i + 4]) for i in range(stretch - 3))
        found.append(full + sum(ok[i] and ok[i + 1] and ok[i + 4] and ok[i + 5] for i in range(stretch - 5)))
    return min(found)


def tokens(text: Column) -> Column:
    """Hashes of the tokens. An end that is no token gives an empty word, which no item contains."""
    return F.transform(F.split(F.lower(text), WORD_BREAK), lambda w: F.xxhash64(w))


def item_tokens(text: Column) -> Column:
    return F.transform(F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != ""), lambda w: F.xxhash64(w))


def _pairs(left: str, apart: int, size: Column, *salt: Column) -> Column:
    """Hashes of left[i] and left[i + apart], for every i below `size`."""
    return F.zip_with(F.slice(left, 1, size), F.slice(left, apart + 1, size), lambda x, y: F.xxhash64(x, y, *salt))


def seeds(rows: DataFrame, *keep: str) -> DataFrame:
    """`keep`, place (of the seed's first token) and seed of every masked window of the tokens `h`.

    Seeds are put together from hashes of neighbouring tokens: a pair and the next pair but one, or but two.
    The outer explode leaves a row without a seed for short texts, which meets nothing; a plain one, or a filter
    by size, would make the optimizer compute all of it once more for a filter at the scan.
    """

    def fewer(name: str, by: int) -> Column:
        return F.greatest(F.size(name) - by, F.lit(0))

    rows = rows.select(*keep, _pairs("h", 1, fewer("h", 1)).alias("p"))
    both = F.concat(_pairs("p", 2, fewer("p", 2)), _pairs("p", 4, fewer("p", 4), F.lit(1)))
    found = rows.select(*keep, fewer("p", 2).alias("full"), F.posexplode_outer(both).alias("n", "seed"))
    return found.select(*keep, F.when(F.col("n") < F.col("full"), F.col("n")).otherwise(F.col("n") - F.col("full")).alias("place"), "seed")


def leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(node, item, start, matched, length, overlap) for every text and item it leaks.

    node is the text's key, item the key of the item's text, start the token of the text below the
    item's first, matched the agreeing tokens of the item's length, overlap the best stretch's share.
    """
    items = benchmark.select(text_key().alias("item"), item_tokens(body()).alias("h")).filter(F.size("h") >= SPAN).dropDuplicates(["item"])
    stretch = F.least(F.size("h"), F.lit(settings.stretch))
    least = F.coalesce(*[F.when(stretch == n, least_seeds(n, settings.share)) for n in range(SPAN, settings.stretch + 1)])
    items = stored(items.withColumn("least", least), "decontamination-items")
    marks = seeds(items, "item", "least").withColumnRenamed("place", "q").distinct()
    count = marks.count()
    texts = docs.select(text_key().alias("node"), body().alias("text"))
    hits = seeds(texts.select("node", tokens(F.col("text")).alias("h")), "node")
    hits = hits.join(small(marks, count, settings.broadcast_rows), "seed")
    # Texts that repeat count their seeds again, which only lets more through.
    diagonals = hits.groupBy("node", "item", (F.col("place") - F.col("q")).alias("start"), "least").agg(F.count("*").alias("n"))
    diagonals = stored(diagonals.filter("n >= least").select("node", "item", "start"), "decontamination-hits")
    # One copy of each text that has a hit.
    texts = texts.join(diagonals.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    laid = diagonals.join(texts.select("node", tokens(F.col("text")).alias("h")), "node")
    laid = laid.join(small(items.select("item", F.col("h").alias("b")), count, settings.broadcast_rows), "item")
    same = F.transform(
        F.sequence(F.lit(0), F.size("b") - 1),
        lambda k: F.when(F.col("start") + k >= 0, F.coalesce(F.get("h", F.col("start") + k) == F.get("b", k), F.lit(False))).otherwise(F.lit(False)).cast("int"),
    )
    laid = laid.select("node", "item", "start", same.alias("same"), F.size("b").alias("length"))
    stretch = F.least("length", F.lit(settings.stretch))
    sums = F.transform(
        F.sequence(F.lit(0), F.col("length") - stretch),
        lambda i: F.aggregate(F.slice("same", i + 1, stretch), F.lit(0), lambda a, x: a + x),
    )
    total = F.aggregate("same", F.lit(0), lambda a, x: a + x)
    laid = laid.select("node", "item", "start", total.alias("matched"), "length", (F.array_max(sums) / stretch).alias("overlap"))
    laid = laid.filter(F.col("overlap") >= settings.share - 1e-12)
    best = F.max(F.struct("overlap", "matched", -F.col("start"))).alias("best")
    found = laid.groupBy("node", "item", "length").agg(best)
    found = found.select(
        "node", "item", (-F.col("best.col3")).alias("start"), F.col("best.matched").alias("matched"), "length", F.col("best.overlap").alias("overlap")
    )
    return found.unionByName(short_leaks(docs, benchmark, settings)) if settings.short_items else found


def short_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings) -> DataFrame:
    """Like `leaks`, of items below six tokens that a text holds whole; start is the first place."""
    items = benchmark.select(text_key().alias("item"), item_tokens(body()).alias("h")).filter((F.size("h") > 0) & (F.size("h") < SPAN))
    items = stored(items.select("item", F.size("h").alias("length"), F.xxhash64("h").alias("run")).distinct(), "decontamination-short")
    counts = {r["length"]: r["count"] for r in items.groupBy("length").count().collect()}

    def runs(length: int) -> Column:
        # No run of a text that is shorter; a sequence from 1 to 0 would count down.
        last = F.size("h") - length
        places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda k: F.struct(F.lit(length).alias("length"), k.alias("start"), F.xxhash64(F.slice("h", k + 1, length)).alias("run")))

    texts = docs.select(text_key().alias("node"), tokens(body()).alias("h"))
    none = F.array().cast("array<struct<length: int, start: int, run: bigint>>")
    texts = texts.select("node", F.explode_outer(F.concat(none, *map(runs, sorted(counts)))).alias("r")).select("node", "r.*")
    hits = texts.join(small(items, sum(counts.values()), settings.broadcast_rows), ["length", "run"])
    found = hits.groupBy("node", "item", "length").agg(F.min("start").alias("start"))
    return found.select("node", "item", "start", F.col("length").alias("matched"), "length", F.lit(1.0).alias("overlap"))


def leaked(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, item_id, start, matched, length, overlap of every document that leaks an item."""
    found = stored(leaks(docs, benchmark, settings), "decontamination-leaks")
    items = benchmark.select(F.col("item_id"), text_key().alias("item")).distinct()
    named = found.join(items, "item")
    return docs.select("doc_id", text_key().alias("node")).distinct().join(named, "node").select(
        "doc_id", "item_id", "start", "matched", "length", "overlap"
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The columns of `docs`, without the rows whose text leaks an item."""
    node = free_name(docs, "node")
    found = stored(leaks(docs, benchmark, settings).select(F.col("node").alias(node)).distinct(), "decontamination-leaks")
    return docs.withColumn(node, text_key()).join(found, node, "left_anti").drop(node)


def decontaminate(spark, sf_dir: str) -> DataFrame:
    """Query: every pair of a document and a benchmark item that it leaks."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
