"""Near-duplicate classes by ProbMinHash.

Every distinct text becomes a set of five-word shingles, weighted from 1 to 1.1 by count. Each shingle sends
points of its own Poisson process, whose rate is the weight, to random components of the signature;
a component keeps its earliest point. A shingle stops sending as soon as its next point is later
than every component's, so two texts agree in a component with their probability Jaccard. As no two
weights differ by more than 1.1 times, that is at least the plain Jaccard similarity divided by 1.1.
Signatures are cut into bands; texts that share a band are candidates, and a candidate is a link if
the exact Jaccard similarity of the two shingle sets reaches the threshold.

Bands that hold the same texts are verified once. The texts of a band are dealt by hash into chunks of
bounded number and length; a task gets two chunks, compares all their texts by products of their
incidence matrix, and returns not the links but a forest of them, at most a row per text. Two sets alike
at the threshold differ in size by no more than it says, so the texts of a band of many chunks are dealt into
levels by their number of shingles, and only chunks of a level and the next one meet. So every candidate
pair that can be a link is verified, whatever the band's size, and no list of pairs is ever made.

Defined results: a null text counts as empty; equal texts, empty ones too, are one class; a text of
fewer than five words is one shingle; a text without words is like its equals only; rows that repeat
are separate rows of one class; a null id is a row like any other and never a class's name unless all
its ids are null. No rows in, no rows out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.common import body, bounded_batches, free_name, memo, mix, portions, row_key, text_key
from touchline.llm.components import components
from touchline.session import stored

STEP = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x2545F4914F6CDD1D)
BETWEEN_WORDS = re.compile(r"[\W_]")
#: Bits of a random number that choose the component; a signature may have a sixteenth as many.
PLACE_BITS = 24


@dataclass(frozen=True)
class Settings:
    width: int = 5
    #: A shingle's weight is below this, whatever its count, and at least 1.
    heaviest: float = 1.1
    #: 31 bands of 4: a pair at plain 0.8 has probability Jaccard 0.727 at least and shares a band with
    #: probability 0.99996 at least; one of probability Jaccard 0.3 with 0.22.
    bands: int = 31
    rows: int = 4
    threshold: float = 0.8
    seed: int = 20240117
    #: Texts of a chunk, and their characters, on average.
    chunk: int = 512
    chunk_chars: int = 4_000_000


@memo(1)
def characters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point, whether it is a letter or digit, and 64 random bits."""
    points = range(0x110000)
    word = np.fromiter(map(str.isalnum, map(chr, points)), bool, len(points))
    return word, mix(np.arange(1, len(points) + 1, dtype=np.uint64) * STEP)


@memo(1)
def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and their inverses."""
    up = np.full(count, BASE, np.uint64)
    down = np.full(count, pow(int(BASE), -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def pieces(texts: list[str], chars: int) -> Iterator[tuple[list[str], list[int]]]:
    """The texts in lower case, in lists of about `chars` characters, and the index of each; longer ones are cut between words."""
    held, of, size = [], [], 0
    for i, text in enumerate(texts):
        lowered, start = text.lower(), 0
        while start < len(lowered):
            edge = BETWEEN_WORDS.search(lowered, start + chars) if len(lowered) - start > chars else None
            end = edge.end() if edge else len(lowered)
            held.append(lowered[start:end])
            of.append(i)
            size += end - start
            start = end
            if size >= chars:
                yield held, of
                held, of, size = [], [], 0
    if held:
        yield held, of


def word_hashes(texts: list[str], chars: int = 250_000) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of the texts, one text after the other, and the number of words of each text.

    A word's hash is a polynomial of its characters, taken from running sums over the characters of a
    piece, so that memory is bounded by a piece and the hashes.
    """
    is_word, random = characters()
    hashes, counts = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    for lowered, of in pieces(texts, chars):
        points = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        inside = is_word[points]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        up, down = powers(1 << max(12, len(points).bit_length()))
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(random[points] * up[: len(points)], out=sums[1:])
        hashes.append(mix((sums[ends] - sums[starts]) * down[starts]))
        borders = np.cumsum([len(t) + 1 for t in lowered])
        np.add.at(counts, np.array(of)[np.searchsorted(borders, starts, side="right")], 1)
    return np.concatenate(hashes), counts


def shingles(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the text, shingle of 48 bits, count) of every distinct shingle, ordered by text and shingle."""
    h, lengths = word_hashes(texts)
    ends = np.cumsum(lengths)
    of = np.repeat(np.arange(len(texts)), lengths)
    # A text shorter than a shingle is one shingle of what it has.
    short = np.flatnonzero((lengths > 0) & (lengths < width))
    value = np.zeros(len(h), np.uint64)
    for k in range(width):
        value *= np.uint64(0xD6E8FEB86659FD93)
        value[: max(0, len(h) - k)] += h[k:]
    whole = np.arange(len(h)) + width <= ends[of] if len(h) else np.zeros(0, bool)
    doc, value = of[whole], mix(value[whole])
    if len(short):
        tails = [xxhash.xxh3_64_intdigest(h[ends[i] - lengths[i] : ends[i]].tobytes()) for i in short]
        doc = np.concatenate([doc, short])
        value = np.concatenate([value, np.array(tails, np.uint64)])
    both = np.sort(doc.astype(np.uint64) << np.uint64(48) | value >> np.uint64(16))
    at = np.flatnonzero(np.diff(both, prepend=~both[:1]))
    both_at = both[at]
    return (both_at >> np.uint64(48)).astype(np.int64), both_at & np.uint64((1 << 48) - 1), np.diff(np.append(at, len(both)))


def prob_minhash(doc, item, weight, texts: int, size: int, seed: int) -> np.ndarray:
    """Signatures, one row of `size` shingles for each text; zeros for a text without shingles."""
    if size > 1 << PLACE_BITS - 4:
        raise ValueError(f"a signature has {1 << PLACE_BITS - 4} components at most")
    place = np.uint64((1 << PLACE_BITS) - 1)
    earliest = np.full(texts * size, np.inf)
    signature = np.zeros(texts * size, np.uint64)
    alone = np.bincount(doc, minlength=texts)[doc] == 1
    signature.reshape(texts, size)[doc[alone]] = item[alone][:, None]
    doc, item, weight = doc[~alone], item[~alone], weight[~alone]
    time, state = np.zeros(len(item)), mix(item ^ np.uint64(seed))
    while len(item):
        state = state + STEP
        random = mix(state)
        uniform = ((random >> np.uint64(PLACE_BITS)).astype(np.float64) + 0.5) * 2.0 ** (PLACE_BITS - 64)
        time = time - np.log(uniform) / weight
        at = doc * size + ((random & place) * np.uint64(size) >> np.uint64(PLACE_BITS)).astype(np.int64)
        np.minimum.at(earliest, at, time)
        won = earliest[at] == time
        signature[at[won]] = item[won]
        go = time < earliest.reshape(texts, size).max(axis=1)[doc]
        doc, item, weight, time, state = doc[go], item[go], weight[go], time[go], state[go]
    return signature.reshape(texts, size)


def level(size: int, threshold: float) -> int:
    """A step of the size of a set; sets alike at `threshold` are at most one level apart."""
    return math.floor(math.log(max(1, size)) / math.log(1.01 / threshold))


def band_keys(texts: list[str], settings: Settings) -> tuple[list[np.ndarray], np.ndarray]:
    """For each text its band keys, none for a text without words, and the number of its shingles."""
    doc, item, count = shingles(texts, settings.width)
    weight = settings.heaviest - (settings.heaviest - 1) / count
    signature = prob_minhash(doc, item, weight, len(texts), settings.bands * settings.rows, settings.seed)
    parts = signature.reshape(len(texts), settings.bands, settings.rows)
    keys = np.broadcast_to(mix(np.arange(1, settings.bands + 1, dtype=np.uint64) * STEP), parts.shape[:2])
    for k in range(settings.rows):
        keys = mix((keys ^ parts[:, :, k]) + STEP)
    sizes = np.bincount(doc, minlength=len(texts))
    return [keys[i].view(np.int64) if sizes[i] else keys[i, :0].view(np.int64) for i in range(len(texts))], sizes


def _signed(batches, settings: Settings):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        rows, levels = [], []
        for a, b in portions(texts, 400_000):
            keys, sizes = band_keys(texts[a:b], settings)
            rows += keys
            levels += [level(int(n), settings.threshold) for n in sizes]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
        values = np.concatenate([*rows, np.zeros(0, np.int64)])
        names = ["doc_id", "node", "rid", "chars", "level"]
        kept = [*[batch.column(c) for c in names[:-1]], pa.array(levels, pa.int32())]
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept, lists], [*names, "bands"])


def similarities(texts: list[str], width: int, columns: int = 4096) -> np.ndarray:
    """Exact Jaccard similarity of the shingle sets of all pairs of texts; 0 for a text without words."""
    doc, item, _ = shingles(texts, width)
    sizes = np.bincount(doc, minlength=len(texts)).astype(np.float32)
    _, column, count = np.unique(item, return_inverse=True, return_counts=True)
    # Only shingles of several texts meet; they are numbered anew.
    number = np.cumsum(count > 1) - 1
    several = count[column] > 1
    doc, column = doc[several], number[column[several]]
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    both = np.zeros((len(texts), len(texts)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, (first, first + columns))
        tile = np.zeros((len(texts), columns), np.float32)
        tile[doc[a:b], column[a:b] - first] = 1
        both += tile @ tile.T
    either = sizes[:, None] + sizes[None, :] - both
    return np.divide(both, either, out=np.zeros_like(both), where=either > 0)


def forest(link: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the least row that it is linked to, directly or not."""
    least = np.arange(len(link))
    while True:
        near = np.where(link, least[None, :], len(link)).min(axis=1, initial=len(link))
        now = np.minimum(least, near)
        now = now[now]
        if (now == least).all():
            return least
        least = now


def _linked(table: pa.Table, settings: Settings) -> pa.Table:
    """Links of a forest among the texts of a block."""
    nodes = table.column("node").to_numpy()
    order = np.argsort(nodes)
    nodes = nodes[order]
    texts = table.column("text").to_pylist()
    link = similarities([texts[i] for i in order], settings.width) >= settings.threshold - 1e-6
    least = forest(link)
    at = np.flatnonzero(least != np.arange(len(nodes)))
    return pa.table({"a": pa.array(nodes[at], pa.int64()), "b": pa.array(nodes[least[at]], pa.int64())})


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, node (stands for the text), rid (for the row), chars, level and bands of every row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("node"), row_key().alias("rid"), F.length(body()).cast("long").alias("chars"), body().alias("text"))
    return rows.mapInArrow(partial(_signed, settings=settings), "doc_id long, node long, rid long, chars long, level int, bands array<long>")


def chunks_of(settings: Settings) -> Column:
    """Chunks of a group of rows with `chars`."""
    return F.greatest(F.ceil(F.count("*") / settings.chunk), F.ceil(F.sum("chars") / settings.chunk_chars), F.lit(1)).cast("long")


def shared(entries: DataFrame, settings: Settings) -> DataFrame:
    """The rows of `entries` (node, chars, level, key) whose band holds several texts, and its chunks; one band of those with equal texts."""
    groups = entries.groupBy("key").agg(
        F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.bit_xor(F.xxhash64("node")).alias("mark"), chunks_of(settings).alias("chunks")
    ).filter("lo < hi")
    groups = groups.groupBy("n", "lo", "hi", "mark").agg(F.min("key").alias("key"), F.max("chunks").alias("chunks"))
    # Merge joins whatever the sizes: the texts and band keys of a corpus are never few.
    return entries.join(groups.select("key", "chunks").hint("merge"), "key")


def blocks_of(members: DataFrame, settings: Settings) -> DataFrame:
    """(node, key, i, j): the blocks, pairs of chunks, that verify the bands of `members`."""
    # Up to two chunks are one block.
    few = members.filter("chunks <= 2").select("node", "key", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))
    many = members.filter("chunks > 2").drop("chunks")
    # Chunks of a band are numbered level after level; its levels are as few as a size has digits.
    levels = many.groupBy("key", "level").agg(chunks_of(settings).alias("chunks"))
    order = Window.partitionBy("key").orderBy("level")
    step = F.struct("level", "chunks")
    levels = levels.withColumns({"below": F.lag(step).over(order), "above": F.lead(step).over(order), "base": F.sum("chunks").over(order) - F.col("chunks")})
    below, above = (F.when(F.col(c)["level"] == F.col("level") + by, F.col(c)["chunks"]).otherwise(0) for c, by in (("below", -1), ("above", 1)))
    levels = levels.select("key", "level", "chunks", "base", (F.col("base") - below).alias("least"), (F.col("base") + F.col("chunks") + above - 1).alias("most"))
    many = many.join(levels, ["key", "level"]).withColumn("own", F.col("base") + F.pmod(F.xxhash64("node"), "chunks"))
    many = many.withColumn("other", F.explode(F.sequence("least", "most")))
    # A chunk meets the others of its level and of the next ones; one alone meets itself.
    many = many.filter("own != other or least = most")
    return few.unionByName(many.select("node", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))


def linked(signed: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """(node, root) of every text that is linked to another."""
    nodes = signed.groupBy("node").agg(*[F.first(c).alias(c) for c in ("chars", "level", "bands")])
    members = stored(shared(nodes.select("node", "chars", "level", F.explode("bands").alias("key")), settings), "dedup-members")
    texts = docs.select(text_key().alias("node"), body().alias("text")).join(members.select("node").distinct().hint("merge"), "node", "left_semi")
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    grouped = blocks_of(members, settings).join(texts, "node").groupBy("key", "i", "j")

    def forest_of(table: pa.Table) -> pa.Table:
        return _linked(table, settings)

    return components(grouped.applyInArrow(forest_of, "a long, b long"))


def classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of `docs`: doc_id, rid, class_id (its least doc_id), class_rows, kept_rid.

    kept_rid is the row key of the one row that stands for the class.
    """
    signed = stored(signatures(docs, settings), "dedup-signatures")
    roots = linked(signed, docs, settings)
    placed = signed.select("doc_id", "node", "rid").join(roots, "node", "left")
    placed = placed.select("doc_id", "rid", F.coalesce("root", "node").alias("root"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    heads = placed.groupBy("root").agg(least.alias("head"), F.count("*").alias("class_rows"))
    return placed.join(heads, "root").select(
        "doc_id", "rid", F.col("head.doc_id").alias("class_id"), "class_rows", F.col("head.rid").alias("kept_rid")
    )


def deduplicated(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The columns of `docs`, one row of each class: that of the least doc_id."""
    rid = free_name(docs, "rid")
    found = classes(docs, settings)
    kept = found.filter(F.col("rid") == F.col("kept_rid")).select(F.col("rid").alias(rid)).distinct()
    single = docs.withColumn(rid, row_key()).dropDuplicates([rid])
    return single.join(kept, rid, "left_semi").drop(rid)


def near_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: the near-duplicate class of every document."""
    found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "class_id", "class_rows", (F.col("rid") == F.col("kept_rid")).alias("kept"))
