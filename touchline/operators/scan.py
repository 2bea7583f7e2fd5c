"""Ordered folds over the rows of a key, safe against keys with very long histories.

A running value over one key is a window over that key, and a fold with an irregular step a sorted
list of its rows: both put the whole history of a key into one task. So the rows per key are counted
first. Keys within `limit` take the direct way. The rows of longer keys are put in order by a range
partitioning, which cuts through keys, and numbered; every `RADIX` numbers make a block. Blocks are
worked on by themselves, the block results of a key are folded one level up (by the same functions,
so any length is reached) and the state at the start of each block is joined back. No rows are left
out, and no task ever holds more than `limit` rows of a key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import stored

RADIX = 512
LIMIT = 512
ROWS_PER_TASK = 500_000

BLOCK = "__block"


def long_keys(df: DataFrame, keys: list[str], limit: int = LIMIT) -> DataFrame | None:
    """Keys with more than `limit` rows and how many they have; None where there are none.

    The answer has at most rows / limit rows.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n")).filter(F.col("__n") > limit)
    return None if counts.isEmpty() else stored(counts, "long-keys")


def with_blocks(
    df: DataFrame, keys: list[str], order: list[str], long: DataFrame, radix: int = RADIX
) -> DataFrame:
    """Add `__block`: 0 for ordinary keys, rising with `order` for long ones, `radix` rows at most.

    Numbers depend on how the rows were partitioned, so the rows of long keys are written with them.
    """
    only = long.select(*keys)
    rows = long.agg(F.sum("__n")).first()[0]
    tasks = max(1, -(-rows // ROWS_PER_TASK))
    place = F.monotonically_increasing_id()
    numbered = (
        df.join(only, keys, "left_semi")
        .repartitionByRange(tasks, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(BLOCK, F.floor(place / F.lit(radix)) + 1)
    )
    short = df.join(only, keys, "left_anti").withColumn(BLOCK, F.lit(0).cast("bigint"))
    return short.unionByName(stored(numbered, "blocks"))


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    sums: dict[str, str],
    limit: int = LIMIT,
) -> DataFrame:
    """Add, for each `out: column` of `sums`, the total of the key's earlier rows (0 at the first).

    Where `df` has blocks (see `with_blocks`) the totals are taken by block and carried over.
    """
    blocked = BLOCK in df.columns
    by = [*keys, BLOCK] if blocked else keys
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = df.select(
        "*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(out) for out, c in sums.items()]
    )
    if not blocked:
        return within
    totals = df.groupBy(*by).agg(*[F.sum(c).alias(f"__t_{out}") for out, c in sums.items()])
    totals = totals.withColumnRenamed(BLOCK, "__order")
    long = long_keys(totals, keys, limit)
    if long is not None:
        totals = with_blocks(totals, keys, ["__order"], long)
    carried = running_total(
        totals, keys, ["__order"], {f"__c_{out}": f"__t_{out}" for out in sums}, limit
    ).select(*keys, F.col("__order").alias(BLOCK), *[f"__c_{out}" for out in sums])
    return within.join(carried, by).select(
        *df.columns, *[(F.col(out) + F.col(f"__c_{out}")).alias(out) for out in sums]
    )


def carry_last(
    df: DataFrame, keys: list[str], order: str, value: str, out: str, limit: int = LIMIT, upto: int = 0
) -> DataFrame:
    """Add the key's latest non-NULL `value` up to each row; `upto=-1` leaves the row itself out.

    `order` is unique within a key and may be any number. Keys of more than `limit` rows are put in order by
    a range partitioning and cut into blocks of as many; the last value of each block is carried over the
    blocks, by the same function, and joined back.
    """
    long = long_keys(df, keys, limit)
    frame = (Window.unboundedPreceding, upto)
    if long is None:
        return df.withColumn(out, F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(*frame)))
    blocked = with_blocks(df, keys, [order], long, limit)
    by = [*keys, BLOCK]
    within = blocked.withColumn("__own", F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(order).rowsBetween(*frame)))
    ends = blocked.groupBy(*by).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("__end"))
    ends = stored(ends.withColumnRenamed(BLOCK, "__order"), "block-ends")
    entering = carry_last(ends, keys, "__order", "__end", "__before", limit, upto=-1)
    entering = entering.select(*keys, F.col("__order").alias(BLOCK), "__before")
    return within.join(entering, by).select(*df.columns, F.coalesce("__own", "__before").alias(out))

@dataclass(frozen=True)
class Fold:
    """A fold whose steps are maps state -> state that compose associatively.

    `lift` turns a row (a struct) into a map (a struct), `compose(first, then)` joins two maps,
    `apply(map, state)` runs one.
    """

    lift: Callable[[Column], Column]
    compose: Callable[[Column, Column], Column]
    apply: Callable[[Column, Column], Column]
    identity: Callable[[], Column]
    #: Rows hold `a`, 1 or one half, and `b`, 0 where `a` is 1: states have a closed form (see `_halved`).
    halving: bool = False


def affine() -> Fold:
    """state -> a * state + b, where a row's a is 1 (and its b 0) or one half."""
    return Fold(
        lift=lambda row: F.struct(row["a"].alias("a"), row["b"].alias("b")),
        compose=lambda f, g: F.struct(
            (f["a"] * g["a"]).alias("a"), (g["a"] * f["b"] + g["b"]).alias("b")
        ),
        apply=lambda m, x: m["a"] * x + m["b"],
        identity=lambda: F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b")),
        halving=True,
    )


def clamped_sum(low: float = 0.0, high: float = 1.0) -> Fold:
    """state -> min(high, max(low, state + step)).

    A chain of clamped steps is again one shift followed by one clamp, to a range that may have
    grown narrower. `n` counts the steps.
    """

    def into(value: Column, g: Column) -> Column:
        return F.least(g["hi"], F.greatest(g["lo"], value + g["shift"]))

    return Fold(
        lift=lambda row: F.struct(
            row["step"].alias("shift"),
            F.lit(float(low)).alias("lo"),
            F.lit(float(high)).alias("hi"),
            F.lit(1).cast("bigint").alias("n"),
        ),
        compose=lambda f, g: F.struct(
            (f["shift"] + g["shift"]).alias("shift"),
            into(f["lo"], g).alias("lo"),
            into(f["hi"], g).alias("hi"),
            (f["n"] + g["n"]).alias("n"),
        ),
        apply=lambda m, x: F.least(m["hi"], F.greatest(m["lo"], x + m["shift"])),
        identity=lambda: F.struct(
            F.lit(0.0).alias("shift"),
            F.lit(float("-inf")).alias("lo"),
            F.lit(float("inf")).alias("hi"),
            F.lit(0).cast("bigint").alias("n"),
        ),
    )


def _sorted_groups(df: DataFrame, by: list[str], order: list[str], payload: list[str]) -> DataFrame:
    fields = [F.col(c) for c in (*order, *payload)]
    return df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("__rows"))


def _composed(groups: DataFrame, by: list[str], fold: Fold) -> DataFrame:
    return groups.select(
        *by,
        F.aggregate(
            "__rows", fold.identity(), lambda acc, row: fold.compose(acc, fold.lift(row))
        ).alias("__map"),
    )


def _of_maps(fold: Fold) -> Fold:
    """The same fold over rows that hold finished maps."""
    return Fold(lambda row: row["__map"], fold.compose, fold.apply, fold.identity)


def fold_maps(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    payload: list[str],
    fold: Fold,
    limit: int = LIMIT,
) -> DataFrame:
    """One composed map per key, in `__map`. `df` has blocks where it has long keys."""
    if BLOCK not in df.columns:
        return _composed(_sorted_groups(df, keys, order, payload), keys, fold)
    by = [*keys, BLOCK]
    maps = _composed(_sorted_groups(df, by, order, payload), by, fold)
    maps = maps.withColumnRenamed(BLOCK, "__order")
    long = long_keys(maps, keys, limit)
    if long is not None:
        maps = with_blocks(maps, keys, ["__order"], long)
    return fold_maps(maps, keys, ["__order"], ["__map"], _of_maps(fold), limit)


def _states(groups: DataFrame, keep: list[str], start: Column, fold: Fold) -> DataFrame:
    """Explode each group into its rows with the state before and after each."""
    row_type = groups.schema["__rows"].dataType.elementType.simpleString()
    out_type = f"array<struct<row:{row_type},before:double,after:double>>"
    acc0 = F.struct(start.alias("state"), F.array().cast(out_type).alias("out"))

    def merge(acc: Column, row: Column) -> Column:
        after = fold.apply(fold.lift(row), acc["state"])
        emitted = F.struct(row.alias("row"), acc["state"].alias("before"), after.alias("after"))
        return F.struct(
            after.alias("state"), F.concat(acc["out"], F.array(emitted)).alias("out")
        )

    traced = F.aggregate("__rows", acc0, merge, lambda acc: acc["out"])
    return groups.select(*keep, F.explode(traced).alias("__e"))


def _halved(df: DataFrame, by: list[str], order: list[str], start: Column) -> DataFrame:
    """Add the state `before` and `after` every row of a halving fold, by windows alone.

    After n halvings the state is (start + sum of b * 2^m) / 2^n, m being the halvings up to a row's own.
    Powers of two scale a double without rounding, and a window holds at most `LIMIT` rows.
    """
    rows = Window.partitionBy(*by).orderBy(*order)
    upto = rows.rowsBetween(Window.unboundedPreceding, 0)
    scaled = df.withColumn("__scale", F.pow(F.lit(2.0), F.count_if(F.col("a") == 0.5).over(upto)))
    after = (start + F.sum(F.col("b") * F.col("__scale")).over(upto)) / F.col("__scale")
    stated = scaled.withColumn("after", after)
    return stated.withColumn("before", F.coalesce(F.lag("after").over(rows), start)).drop("__scale")


def fold_trace(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    payload: list[str],
    fold: Fold,
    start: DataFrame | None,
    default: float,
    limit: int = LIMIT,
) -> DataFrame:
    """The state `before` and `after` every row. `df` has blocks where it has long keys.

    `start` holds (keys, `state`) saved from an earlier run; keys absent from it begin at `default`.
    """
    windowed = fold.halving and limit <= LIMIT
    shown = [*keys, *order, *payload, "before", "after"]
    if BLOCK not in df.columns:
        groups = df if windowed else _sorted_groups(df, keys, order, payload)
        first = F.lit(float(default))
        if start is not None:
            saved = start.select(*keys, F.col("state").alias("__start"))
            groups = groups.join(saved, keys, "left")
            first = F.coalesce("__start", first)
        if windowed:
            return _halved(groups, keys, order, first).select(*shown)
        out = _states(groups, keys, first, fold)
    else:
        by = [*keys, BLOCK]
        groups = _sorted_groups(df, by, order, payload)
        maps = _composed(groups, by, fold).withColumnRenamed(BLOCK, "__order")
        long = long_keys(maps, keys, limit)
        if long is not None:
            maps = with_blocks(maps, keys, ["__order"], long)
        entries = fold_trace(
            maps, keys, ["__order"], ["__map"], _of_maps(fold), start, default, limit
        ).select(*keys, F.col("__order").alias(BLOCK), F.col("before").alias("__entry"))
        if windowed:
            return _halved(df.join(entries, by), by, order, F.col("__entry")).select(*shown)
        out = _states(groups.join(entries, by), keys, F.col("__entry"), fold)
    return out.select(
        *keys,
        *[F.col(f"__e.row.{c}").alias(c) for c in (*order, *payload)],
        F.col("__e.before").alias("before"),
        F.col("__e.after").alias("after"),
    )
