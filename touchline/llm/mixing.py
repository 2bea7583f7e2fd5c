"""Mixing overlapping sources to target weights by min-cost flow.

Documents are first summed by membership pattern, the set of sources they belong to. A network sends
words from patterns to the quotas of their sources; the words of a pattern can be used several times,
and each further use costs more than the one before, so that repetition is spread evenly. The patterns
are few (a stated bound, checked), so the network is solved on the driver.

The documents of a pattern stand in a seeded order, laid end to end, once for every use. A use of a
document is taken if it ends within the words that the flow takes from the pattern, and belongs to
the source whose share of those words covers its middle. What is then missing is filled pass by pass from the
documents not yet taken that are no larger than the gap: the first of those larger than half of it, else
the others in their order as far as they fit. Every pass halves the gap at least or leaves no document that
fits, so passes are as many as the gap has binary digits. Last, a few single documents are added or left out where that
brings a pattern's words nearer to its flow.

Documents that repeat are counted before they are ordered. Positions are sums within 4,096 hash ranges of
a pattern, so a source with a third of all rows is spread over that many groups.

Defined results: a null text has no words, and is never taken; a null source is a source, the last; the
rows of a document that repeats (id, text and source) are taken as that many copies of it; empty sources
get target 0; no rows in, none out.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.common import body, free_name, row_key
from touchline.session import stored

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Settings:
    uses: int = 3
    weights: tuple[int, ...] = (1, 2, 3)
    ranges: int = 4096
    #: Patterns and sources that the driver takes.
    patterns: int = 20_000
    corrections: int = 4
    seed: int = 5


def words(text: Column) -> Column:
    """Number of runs without blanks."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def targets(sizes: dict, total: float, settings: Settings = Settings()) -> dict:
    """The words wanted of each source: its weight's share, at most `uses` times its size.

    What is above that limit is shared by weight among the others until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: settings.weights[i % len(settings.weights)] for i, s in enumerate(order)}
    fixed: dict = {}
    while True:
        free = [s for s in order if s not in fixed]
        left, shares = total - sum(fixed.values()), sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / shares > settings.uses * sizes[s]]
        if not above:
            return fixed | {s: left * weight[s] / shares for s in free}
        fixed |= {s: float(settings.uses * sizes[s]) for s in above}


def flow(supply: dict[tuple, int], quota: dict, uses: int) -> dict[tuple, dict]:
    """Words that each pattern gives to each of its sources, at the least cost of repetition.

    Cheapest augmenting paths; the n-th use of a pattern's words costs n. Patterns that share no source,
    directly or through others, are networks of their own.
    """
    given: dict[tuple, dict] = {p: {} for p in supply}
    used = dict.fromkeys(supply, 0)
    left = dict(quota)
    of_source: dict = {}
    for p in supply:
        for s in p:
            of_source.setdefault(s, []).append(p)

    def cost(p: tuple) -> int | None:
        return used[p] // supply[p] + 1 if supply[p] and used[p] < uses * supply[p] else None

    def room(p: tuple) -> int:
        return supply[p] - used[p] % supply[p]

    def cheapest(source) -> list[tuple] | None:
        """A path of patterns and sources from `source` back to the cheapest pattern that it can draw on."""
        start = object()  # a source can be null
        came: dict = {source: start}
        best, end = None, None
        queue = deque([source])
        while queue:
            s = queue.popleft()
            for p in of_source.get(s, []):
                if p in came:
                    continue
                came[p] = s
                if (c := cost(p)) is not None and (best is None or c < best):
                    best, end = c, p
                for other in p:
                    if other not in came and given[p].get(other, 0) > 0:
                        came[other] = p
                        queue.append(other)
        if end is None:
            return None
        path, at = [end], end
        while (at := came[at]) is not start:
            path.append(at)
        return path

    open_sources = deque(s for s in sorted(quota, key=lambda s: (s is None, s or "")) if quota[s] > 0)
    # Sources are filled level by level of repetition, so that none forces another into dearer uses.
    level = 1
    while open_sources and level <= uses:
        waiting: deque = deque()
        while open_sources:
            s = open_sources.popleft()
            path = cheapest(s)
            if path is None:
                continue
            if cost(path[0]) > level:
                waiting.append(s)
                continue
            amount = min(left[s], room(path[0]))
            for k in range(1, len(path) - 1, 2):  # source k gives up what the next pattern gave it
                amount = min(amount, given[path[k + 1]][path[k]])
            used[path[0]] += amount
            for k in range(0, len(path), 2):
                taker = path[k + 1]
                given[path[k]][taker] = given[path[k]].get(taker, 0) + amount
                if k:
                    given[path[k]][path[k - 1]] -= amount
            left[s] -= amount
            if left[s]:
                open_sources.append(s)
        open_sources, level = waiting, level + 1
    return given


def _plan(copies: DataFrame, settings: Settings) -> tuple[dict, dict, dict]:
    """Sizes and targets by source, flow by pattern."""
    rows = copies.groupBy("pattern").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(settings.patterns + 1).collect()
    if len(rows) > settings.patterns:
        raise ValueError(f"more than {settings.patterns} membership patterns")
    supply = {tuple(r["pattern"]): int(r["size"]) for r in rows}
    sizes: dict = {}
    for p, size in supply.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + size
    wanted = targets(sizes, float(sum(supply.values())), settings) if sizes else {}
    return sizes, wanted, flow(supply, {s: round(t) for s, t in wanted.items()}, settings.uses)


def copies_of(docs: DataFrame, members: Column, settings: Settings) -> DataFrame:
    """One row for each copy of each document: doc_id, rid, pattern, size, and its seeded place `u`."""
    rows = docs.select(F.col("doc_id"), row_key().alias("rid"), members.alias("pattern"), words(body()).alias("size"))
    counted = rows.groupBy("doc_id", "rid", "pattern", "size").agg(F.count("*").alias("n"))
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), "n")))
    return each.withColumn("u", F.xxhash64("rid", "pattern", "copy", F.lit(settings.seed))).drop("n")


def mixed(docs: DataFrame, members: Column | None = None, settings: Settings = Settings()) -> tuple[DataFrame, dict, dict]:
    """doc_id, rid, copy, pattern, size, uses and first (the source of its first use) of every copy; sizes and targets.

    members: an array of the sources of a row, sorted and without repeats; the one in `source` by default.
    """
    spark = docs.sparkSession
    members = F.array(F.col("source").cast("string")) if members is None else members
    copies = stored(copies_of(docs, members, settings), "mix-copies")
    sizes, wanted, given = _plan(copies, settings)
    part = F.shiftrightunsigned("u", 64 - (settings.ranges - 1).bit_length()).cast("int")
    copies = copies.withColumn("part", part)
    sums = copies.groupBy("pattern", "part").agg(F.sum("size").alias("sum"))
    above = Window.partitionBy("pattern").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("pattern", "part", F.coalesce(F.sum("sum").over(above), F.lit(0)).alias("base"))
    within = Window.partitionBy("pattern", "part").orderBy("u", "rid", "copy").rowsBetween(Window.unboundedPreceding, -1)
    placed = copies.join(sums, ["pattern", "part"])
    middle = F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0)) + F.col("size") / 2
    # At most `patterns` rows.
    rows = [(list(p), int(sum(g.values())), list(g), [int(x) for x in g.values()]) for p, g in given.items()]
    plan = spark.createDataFrame(rows, "pattern array<string>, flow long, sources array<string>, amounts array<long>")
    total = copies.groupBy("pattern").agg(F.sum("size").alias("supply"))
    placed = placed.withColumn("middle", middle).join(F.broadcast(plan.join(total, "pattern")), "pattern")
    full = F.when(F.col("supply") > 0, F.expr("flow div supply")).otherwise(F.lit(0))
    rest = F.col("flow") - full * F.col("supply")
    ends = F.col("middle") + F.col("size") / 2
    placed = placed.select(
        "doc_id", "rid", "copy", "pattern", "part", "size", "u", full.cast("int").alias("full"), rest.alias("rest"), ((F.col("size") > 0) & (ends <= rest)).alias("more"), "middle", "supply", "sources", "amounts"
    )
    placed = stored(_filled(stored(placed, "mix-placed")), "mix-filled")
    flips: dict[tuple, bool] = {}
    for _ in range(settings.corrections):
        flagged = _flipped(placed, flips)
        gap = flagged.groupBy("pattern").agg((F.first("rest") - F.sum(F.when(F.col("more"), F.col("size")).otherwise(0))).alias("gap"), F.first("rest").alias("rest"))
        gap = gap.filter("gap != 0")
        near = flagged.join(F.broadcast(gap.select("pattern", "gap")), "pattern")
        near = near.filter("size > 0 and size < 2 * abs(gap) and more = (gap < 0)")
        near = near.filter(F.col("full") + 1 <= settings.uses)
        off = F.struct(F.abs(F.col("size") - F.abs("gap")), "u", "rid", "copy")
        best = near.groupBy("pattern").agg(F.min_by(F.struct("rid", "copy", "more"), off).alias("b")).collect()
        if not best:
            break
        for r in best:
            key = (tuple(r["pattern"]), r["b"]["rid"], r["b"]["copy"])
            if key in flips:
                del flips[key]
            else:
                flips[key] = not r["b"]["more"]
    done = _flipped(placed, flips).withColumn("uses", F.when(F.col("size") > 0, F.col("full") + F.col("more").cast("int")).otherwise(0))
    # The first use's middle falls into the share of one of the pattern's sources.
    ends = F.transform("amounts", lambda _, i: F.aggregate(F.slice("amounts", 1, i + 1), F.lit(0).cast("long"), lambda a, x: a + x))
    # What fills a gap stands behind all shares and belongs to the last source.
    first = F.get(F.filter(F.zip_with("sources", ends, lambda s, e: F.struct(s.alias("s"), e.alias("e"))), lambda x: x["e"] > F.col("middle")), F.lit(0))
    first = F.when(F.col("uses") > 0, F.coalesce(first["s"], F.element_at("sources", -1)))
    return done.select("doc_id", "rid", "copy", "pattern", "size", "uses", first.alias("first")), sizes, wanted


#: Where a copy stands in its pattern's order.
PLACE = ["part", "u", "rid", "copy"]
RULES = "pattern array<string>, rules array<struct<above: long, most: long, last: struct<part: int, u: bigint, rid: bigint, copy: int>>>"


def _filled(placed: DataFrame) -> DataFrame:
    """`placed` with more documents taken, until in no pattern one of the others fits into the gap.

    A pass leaves a rule for each pattern: documents above one size, up to another, and not behind a place.
    The driver keeps a gap and the rules of the passes for each pattern.
    """
    spark = placed.sparkSession
    gaps = placed.groupBy("pattern").agg((F.first("rest") - F.sum(F.when(F.col("more"), F.col("size")).otherwise(0))).alias("gap"))
    gap = {tuple(r["pattern"]): r["gap"] for r in gaps.filter("gap > 0").collect()}
    rules: dict[tuple, list] = {}
    place = F.struct(*PLACE)
    in_order = Window.partitionBy("pattern", "part").orderBy("u", "rid", "copy").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("pattern").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    while gap:
        now = spark.createDataFrame([(list(p), g) for p, g in gap.items()], "pattern array<string>, gap long")
        fits = _ruled(placed, {p: rules[p] for p in gap if p in rules}).filter("size > 0 and not more")
        fits = fits.join(F.broadcast(now), "pattern").filter("size <= gap")
        large = F.col("size") * 2 > F.col("gap")
        sums = fits.groupBy("pattern", "part", "gap").agg(
            F.sum(F.when(~large, F.col("size")).otherwise(0)).alias("sum"), F.min(F.when(large, F.struct(*PLACE, "size"))).alias("one"), F.max(place).alias("last")
        )
        sums = sums.withColumn("base", F.coalesce(F.sum("sum").over(before), F.lit(0)))
        # The part of the order in which the gap is reached, if there is one.
        cut = F.struct("part", "base")
        found = sums.groupBy("pattern").agg(
            F.min("one").alias("one"), F.sum("sum").alias("all"), F.max("last").alias("last"), F.min(F.when(F.col("base") + F.col("sum") > F.col("gap"), cut)).alias("cut")
        )
        todo, cuts = {}, []
        for r in found.collect():
            p = tuple(r["pattern"])
            if r["one"] is not None:
                todo[p] = (gap[p] // 2, gap[p], tuple(r["one"])[:4], r["one"]["size"])
            elif r["cut"] is None:
                todo[p] = (0, gap[p], tuple(r["last"]), r["all"])
            else:
                cuts.append((list(p), r["cut"]["part"], r["cut"]["base"]))
                # If not even the part's first document fits.
                todo[p] = (0, gap[p], (r["cut"]["part"], -(2**63), -(2**63), 0), r["cut"]["base"])
        if cuts:
            at = spark.createDataFrame(cuts, "pattern array<string>, part int, base long")
            inside = fits.join(F.broadcast(at), ["pattern", "part"]).withColumn("sum", F.col("base") + F.sum("size").over(in_order))
            for r in inside.filter("sum <= gap").groupBy("pattern").agg(F.max("sum").alias("sum"), F.max(place).alias("last")).collect():
                p = tuple(r["pattern"])
                todo[p] = (0, gap[p], tuple(r["last"]), r["sum"])
        for p, (above, most, last, size) in todo.items():
            rules.setdefault(p, []).append((above, most, last))
            gap[p] -= size
        # A pattern without a document that fits is done.
        gap = {p: gap[p] for p in todo if gap[p] > 0}
    return _ruled(placed, rules)


def _ruled(placed: DataFrame, rules: dict[tuple, list]) -> DataFrame:
    """`placed` with what the rules take, of which each pattern has a few."""
    if not rules:
        return placed
    table = placed.sparkSession.createDataFrame([(list(p), r) for p, r in rules.items()], RULES)
    place = F.struct(*PLACE)
    taken = F.exists("rules", lambda r: (F.col("size") > r["above"]) & (F.col("size") <= r["most"]) & (place <= r["last"]))
    found = placed.join(F.broadcast(table), "pattern", "left")
    return found.withColumn("more", F.col("more") | ((F.col("size") > 0) & F.coalesce(taken, F.lit(False)))).drop("rules")


def _flipped(placed: DataFrame, flips: dict[tuple, bool]) -> DataFrame:
    """`placed` with the corrections, of which there are a few for each pattern."""
    if not flips:
        return placed
    rows = [(list(p), rid, copy, now) for (p, rid, copy), now in flips.items()]
    changed = placed.sparkSession.createDataFrame(rows, "pattern array<string>, rid long, copy long, now boolean")
    found = placed.join(F.broadcast(changed), ["pattern", "rid", "copy"], "left")
    return found.withColumn("more", F.coalesce("now", "more")).drop("now")


def mixture(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The columns of `docs`, every document as often as the mix uses it."""
    rid, source, uses = (free_name(docs, n) for n in ("rid", "of", "uses"))
    done, _, _ = mixed(docs, None, settings)
    decided = done.groupBy(F.col("rid").alias(rid), F.to_json("pattern").alias(source)).agg(F.sum("uses").alias(uses)).filter(F.col(uses) > 0)
    single = docs.withColumns({rid: row_key(), source: F.to_json(F.array(F.col("source").cast("string")))}).dropDuplicates([rid, source])
    found = single.join(decided, [rid, source]).withColumn(uses, F.explode(F.sequence(F.lit(1), uses)))
    return found.drop(rid, source, uses)


def mixing(spark, sf_dir: str) -> DataFrame:
    """Query: what the mix takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done, sizes, wanted = mixed(docs)
    # One row per source.
    goals = spark.createDataFrame([([s], int(sizes[s]), float(wanted[s])) for s in sizes], "pattern array<string>, source_size long, target double")
    rows = done.join(F.broadcast(goals), "pattern")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("uses")).alias("taken"))
