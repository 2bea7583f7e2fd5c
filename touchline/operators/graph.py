"""Link graph: adjacency lists, starting ranks, and the damped rank step.

An adjacency list is stored in parts of bounded length. A node that holds a large share of all
edges then spreads over many rows, and the rank step joins on (node, part), so no task ever sees
the whole list. Repeated edges are folded into a copy count first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.joins import join_with_hot_keys
from touchline.session import cut, stored, stored_in_buckets

DAMPING = 0.85
BASE = 0.15
PART_SIZE = 8192
#: Sources with more distinct targets are broadcast; there are at most distinct edges / HOT_TARGETS of them.
HOT_TARGETS = 1 << 20
#: Bytes of adjacency lists in a bucket, and of one target in a list.
BUCKET_BYTES, TARGET_BYTES = 128 << 20, 32


def _part_of(dst: Column, parts: Column) -> Column:
    """A stable spread of targets over parts, the same on every engine that has md5."""
    digest = F.conv(F.substring(F.md5(dst), 1, 8), 16, 10).cast("bigint")
    return F.when(parts == 1, F.lit(0).cast("bigint")).otherwise(digest % parts)


def edge_copies(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src", "dst").agg(F.count("*").alias("copies"))


def out_degrees(copies: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """Out-degree with repeated edges, and the number of parts its list of targets needs."""
    return copies.groupBy("src").agg(
        F.sum("copies").alias("outdeg"),
        F.count("*").alias("distinct"),
        F.ceil(F.count("*") / F.lit(part_size)).cast("bigint").alias("parts"),
    )


def adjacency(edges: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """`src, part, parts, outdeg, targets`, targets being sorted (dst, copies) pairs.

    Sources with more than HOT_TARGETS targets are looked up from a broadcast. The rest meet in a
    shuffled join. The edges are aggregated once and written, since both need them.
    """
    return _lists(stored(edge_copies(edges), "edge-copies"), part_size)


def _lists(copies: DataFrame, part_size: int) -> DataFrame:
    return _spread(copies, out_degrees(copies, part_size))


def _spread(copies: DataFrame, degrees: DataFrame) -> DataFrame:
    joined = join_with_hot_keys(copies, degrees, "src", F.col("distinct") > HOT_TARGETS)
    spread = joined.withColumn("part", _part_of(F.col("dst"), F.col("parts")))
    return spread.groupBy("src", "part").agg(
        F.max("parts").alias("parts"),
        F.max("outdeg").alias("outdeg"),
        F.array_sort(F.collect_list(F.struct("dst", "copies"))).alias("targets"),
    )


def initial_ranks(edges: DataFrame) -> DataFrame:
    """Every node with out-edges starts at 1."""
    return edges.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0))


def _received(sent: DataFrame, share: Column, copies: Column) -> DataFrame:
    return sent.groupBy(F.col("dst").alias("node")).agg(F.sum(share * copies).alias("received"))


def _updated(
    ranks: DataFrame, received: DataFrame, damping: float, round_digits: int | None
) -> DataFrame:
    """Only ranked nodes keep a rank; what others receive is lost."""
    rank = F.lit(BASE) + F.lit(damping) * F.coalesce("received", F.lit(0.0))
    if round_digits is not None:
        rank = F.round(rank, round_digits)
    return ranks.select("node").join(received, "node", "left").select("node", rank.alias("rank"))


def rank_step(
    edges: DataFrame,
    ranks: DataFrame,
    damping: float = DAMPING,
    round_digits: int | None = None,
) -> DataFrame:
    """One step from an edge list: every edge carries rank / out-degree of its source."""
    copies = stored(edge_copies(edges), "edge-copies")
    shares = (
        out_degrees(copies)
        .join(ranks.withColumnRenamed("node", "src"), "src")
        .select("src", "distinct", (F.col("rank") / F.col("outdeg")).alias("share"))
    )
    sent = join_with_hot_keys(copies, shares, "src", F.col("distinct") > HOT_TARGETS)
    received = _received(sent, F.col("share"), F.col("copies"))
    return _updated(ranks, received, damping, round_digits)


def rank_step_on(
    lists: DataFrame,
    parts: DataFrame,
    ranks: DataFrame,
    damping: float = DAMPING,
    round_digits: int | None = None,
) -> DataFrame:
    """One step on prepared adjacency lists; `parts` says into how many each source's is cut."""
    return _updated(ranks, _sent(lists, parts, ranks), damping, round_digits)


def _sent(lists: DataFrame, parts: DataFrame, ranks: DataFrame) -> DataFrame:
    """What every node receives if `ranks` pass on their rank."""
    # A node's rank is repeated once per part of its list, so the join key is never hot.
    spread = ranks.join(parts, ranks["node"] == parts["src"]).select(
        "src", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), "rank"
    )
    sent = lists.join(spread, ["src", "part"]).select(
        F.inline("targets"), (F.col("rank") / F.col("outdeg")).alias("share")
    )
    return _received(sent, F.col("share"), F.col("copies"))


def list_parts(lists: DataFrame) -> DataFrame:
    return lists.groupBy("src").agg(F.max("parts").alias("parts"))


def _prepared(edges: DataFrame, part_size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Edge copies, their lists written in buckets of bounded bytes, and the number of parts of each."""
    copies = stored(edge_copies(edges), "edge-copies")
    return copies, *_in_buckets(_lists(copies, part_size), copies.count())


def _in_buckets(lists: DataFrame, targets: int) -> tuple[DataFrame, DataFrame]:
    least = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-targets * TARGET_BYTES // BUCKET_BYTES))
    lists = stored_in_buckets(lists, "adjacency", ["src", "part"], buckets)
    return lists, cut(list_parts(lists))


def _lively(copies: DataFrame, part_size: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lists and parts of the ranked nodes that ranked nodes link to, with ranked targets only, and these nodes.

    The targets left out still count in the out-degrees.
    """
    ranked = cut(copies.select("src").distinct())
    linked = cut(copies.select(F.col("dst").alias("src")).distinct().join(ranked, "src", "left_semi"))
    own = copies.join(linked, "src", "left_semi")
    degrees = out_degrees(own, part_size)
    to_ranked = own.join(ranked.withColumnRenamed("src", "dst"), "dst", "left_semi").select("src", "dst", "copies")
    kept = stored(to_ranked, "edge-copies")
    lists, parts = _in_buckets(_spread(kept, degrees), kept.count())
    return lists, parts, linked.withColumnRenamed("src", "node")


def rank_by_changes(
    edges: DataFrame,
    tol: float = 1e-6,
    max_iter: int = 1000,
    damping: float = DAMPING,
    part_size: int = PART_SIZE,
    moved: list[int] | None = None,
) -> DataFrame:
    """Ranks at rest: repeat the step until no node has `tol` or more to pass on.

    A node remembers what it has received and which rank it has passed on. Only nodes whose rank is `tol` or
    more away from that are active: they pass on the difference, so a round moves the active nodes' targets
    and no others, and small changes wait until they add up. Every rank is then within
    damping * tol * (links received) / (1 - damping) of the fixed point, in sum over the links. `moved` is
    given the number of active nodes of each round.

    A node that no ranked node links to is at rest after the second round, and what unranked nodes receive is lost.
    From the third round on only the other nodes and the links among them are read (see `_lively`).
    """
    copies, lists, parts = _prepared(edges, part_size)
    state = cut(initial_ranks(edges).select("node", "rank", F.lit(0.0).alias("got"), F.lit(0.0).alias("passed")))
    active = F.abs(F.col("rank") - F.col("passed")) >= tol
    resting = None
    for turn in range(max_iter):
        count = state.filter(active).count()
        if moved is not None:
            moved.append(count)
        if not count:
            break
        if turn == 2:
            lists, parts, linked = _lively(copies, part_size)
            resting = cut(state.join(linked, "node", "left_anti").select("node", "rank"))
            state = cut(state.join(linked, "node", "left_semi"))
        changes = state.filter(active).select("node", (F.col("rank") - F.col("passed")).alias("rank"))
        received = _sent(lists, parts, changes)
        after = state.withColumn("passed", F.when(active, F.col("rank")).otherwise(F.col("passed"))).join(received, "node", "left")
        got = F.col("got") + F.coalesce("received", F.lit(0.0))
        state = cut(after.select("node", (F.lit(BASE) + F.lit(damping) * got).alias("rank"), got.alias("got"), "passed"))
    ranks = state.select("node", "rank")
    return ranks if resting is None else ranks.unionByName(resting)


def rank_iterate(
    edges: DataFrame,
    max_iter: int = 10,
    tol: float | None = None,
    damping: float = DAMPING,
    round_digits: int | None = None,
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Repeat the step a fixed number of times, or until no rank moves by `tol` or more.

    The lists are written once to the shared folder, bucketed on the join key into buckets of bounded
    bytes, so a round moves ranks and sums but never edges. Every round is checkpointed: the plan stays one step long and a
    lost executor costs at most one round.
    """
    _, lists, parts = _prepared(edges, part_size)
    ranks = cut(initial_ranks(edges))
    for _ in range(max_iter):
        new = cut(rank_step_on(lists, parts, ranks, damping, round_digits))
        moved = None
        if tol is not None:
            both = new.join(ranks.withColumnRenamed("rank", "old"), "node")
            moved = both.agg(F.max(F.abs(F.col("rank") - F.col("old")))).first()[0] or 0.0
        ranks = new
        if moved is not None and moved < tol:
            break
    return ranks
