"""Joins whose big side may hold one key in a large share of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_with_hot_keys(big: DataFrame, small: DataFrame, key: str, is_hot: Column, how: str = "inner") -> DataFrame:
    """Inner or left join with a `small` that is unique in `key`.

    `is_hot` marks the rows of `small` whose key repeats so often in `big` that one shuffle partition
    could not take them. Those few are broadcast and met in place; the rest is left to a shuffled
    join. The caller chooses `is_hot` so that the number of hot keys has a bound.
    """
    columns = [c for c in small.columns if c != key]
    hot = small.filter(is_hot).select(key, *columns, F.lit(True).alias("__hot"))
    tagged = big.join(F.broadcast(hot), key, "left")
    met = tagged.filter("__hot").select(*big.columns, *columns)
    rest = tagged.filter(F.col("__hot").isNull()).select(*big.columns)
    return met.unionByName(rest.join(small.filter(~is_hot), key, how).select(*big.columns, *columns))
