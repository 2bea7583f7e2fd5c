"""Document fingerprints by randomised edit embedding.

A pointer walks over a text's characters. At step j the embedding shows the character below it, and a
random bit, shared by all texts and given by j and that character, says whether it moves on; a text of n
characters is walked in about 2n steps. Two walks that an edit has parted meet again soon by chance, so
texts of small edit distance have embeddings of small Hamming distance.

The fingerprint keeps a sample of the embedding, four bits of each sampled character. The sampled steps
are shared: level v holds the steps whose hash ends in v zero bits, so each level is part of the one
below, and a text is sampled at the level that leaves it 192 to 384 steps. Fingerprints of
different levels are compared on the steps of the higher one. Likeness is the share of equal samples.

For search, bands of sampled steps are hashed; texts that agree in a whole band are candidates, verified
by their likeness. The steps of the bands are drawn from as many samples as a rung of a ladder says; a text
has the bands of the two highest rungs that it reaches, so alike texts share a rung, however short they are.
The texts of a band are dealt into chunks, and every chunk is compared with itself and every other one.

The walks of many texts go on in step, as numpy arrays; a text that has ended leaves them.

Defined results: a null text counts as empty; the empty text has fingerprint `0:` and likeness 1 to itself,
0 to any other; order among rows of one id is by the text's key, null ids come last; rows that repeat are
rows of their own; a table of one row is followed by itself; no rows in, none out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.llm.common import body, memo, mix, portions, text_key
from touchline.llm.components import components
from touchline.llm.near_dedup import forest
from touchline.session import stored

BLOCK = 256
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


@dataclass(frozen=True)
class Settings:
    #: Characters from which on the level rises with each doubling.
    base: int = 96
    seed: int = 77
    rows_per_task: int = 6000
    chars_at_once: int = 12_000_000
    #: 80 bands of 6: of a rung whose samples are equal for 0.7, a pair shares a band with probability 0.99995.
    bands: int = 80
    band_steps: int = 6
    likeness: float = 0.7
    #: Texts of a chunk, on average.
    chunk: int = 512


def _noise(at: np.ndarray, seed: int) -> np.ndarray:
    return mix(at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


@memo(1024)
def moves(block: int, seed: int) -> np.ndarray:
    """For each step of a block and each symbol, 1 if the pointer moves on; never from the end mark 0."""
    step = np.arange(block * BLOCK, (block + 1) * BLOCK, dtype=np.uint64)
    bit = (_noise(step[:, None] * np.uint64(256) + np.arange(256, dtype=np.uint64), seed) >> np.uint64(40)) & np.uint64(1)
    bit[:, 0] = 0
    return bit.astype(np.uint8)


@memo(4096)
def steps_levels(block: int, seed: int) -> np.ndarray:
    """Zero bits at the end of each step's hash."""
    x = _noise(np.arange(block * BLOCK, (block + 1) * BLOCK), seed + 1) | np.uint64(1 << 40)
    return np.log2((x & (~x + np.uint64(1))).astype(np.float64)).astype(np.int64)


def level_of(chars: int, settings: Settings) -> int:
    return max(0, (chars // settings.base).bit_length() - 1)


@memo(1)
def symbol_of() -> np.ndarray:
    """1 to 255 for every code point."""
    return (1 + ((np.arange(0x110000, dtype=np.uint64) * np.uint64(2654435761)) >> np.uint64(13)) % np.uint64(255)).astype(np.uint8)


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters as 1 to 255, each text followed by 0; the starts of the texts."""
    lengths = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    found = symbol_of()[points]
    starts = np.cumsum(lengths + 1) - lengths - 1
    found[starts + lengths] = 0
    return found, starts


def fingerprints(texts: list[str], settings: Settings) -> list[str]:
    """`level:samples` of every text."""
    buffer, starts = symbols(texts)
    digit = (_noise(np.arange(256), settings.seed + 2) >> np.uint64(33)).astype(np.uint8) & 15
    digit[0] = 16
    levels = np.array([level_of(len(t), settings) for t in texts], np.int64)
    lanes = np.argsort([-len(t) for t in texts], kind="stable")
    pointer = starts[lanes]
    samples = np.full((len(texts), 512), 16, np.uint8)
    taken = np.zeros(64, np.int64)
    block = 0
    while len(lanes):
        on = buffer[pointer] != 0
        if not on.all():
            lanes, pointer = lanes[on], pointer[on]
            if not len(lanes):
                break
        own = levels[lanes]  # falling, as lengths do
        cuts = np.searchsorted(-own, -np.arange(64), side="left").tolist()
        lowest = int(own[-1])
        table, zeros = moves(block, settings.seed), steps_levels(block, settings.seed).tolist()
        for v, move in zip(zeros, table, strict=True):
            shown = buffer[pointer]
            if v >= lowest:
                at = lanes[cuts[v] :]
                place = taken[own[cuts[v] :]]
                if place.max() >= samples.shape[1]:
                    samples = np.concatenate([samples, np.full_like(samples, 16)], axis=1)
                samples[at, place] = digit[shown[cuts[v] :]]
                taken[: v + 1] += 1
            pointer = pointer + move[shown]
        block += 1
    counts = samples.shape[1] - (samples[:, ::-1] != 16).argmax(axis=1)
    counts[(samples == 16).all(axis=1)] = 0
    return [f"{lv}:" + HEX[samples[i, :n]].tobytes().decode() for i, (lv, n) in enumerate(zip(levels.tolist(), counts.tolist(), strict=True))]


@memo(256)
def _kept(low: int, high: int, blocks: int, seed: int) -> np.ndarray:
    """Which of the samples of level `low` are samples of level `high`."""
    zeros = np.concatenate([steps_levels(b, seed) for b in range(blocks)])
    return zeros[zeros >= low] >= high


def at_level(fingerprint: str, level: int, settings: Settings) -> bytes:
    """Samples on the steps of a level that is not below the fingerprint's own."""
    own, _, digits = fingerprint.partition(":")
    digits, low = digits.encode(), int(own)
    if low == level:
        return digits
    blocks = 1
    while len(kept := _kept(low, level, blocks, settings.seed)) < len(digits):
        blocks *= 2
    return np.frombuffer(digits, np.uint8)[kept[: len(digits)]].tobytes()


def likeness(a: str, b: str, settings: Settings = Settings()) -> float:
    """Share of equal samples, of those of the longer sample; 0 to 1."""
    if a == b:
        return 1.0
    level = max(int(a.partition(":")[0]), int(b.partition(":")[0]))
    x, y = (np.frombuffer(at_level(f, level, settings), np.uint8) for f in (a, b))
    both = min(len(x), len(y))
    return float((x[:both] == y[:both]).sum()) / max(len(x), len(y), 1)


def edited(text: str, following: str) -> str:
    """`text` with its last half replaced by as many first characters of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, texts: list[str], following: list[str], settings: Settings):
    """Columns of COLUMNS for texts and the ones that follow them."""
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    distinct = list(dict.fromkeys([*texts, *changed, *following]))
    print_of: dict[str, str] = {}
    for a, b in portions(distinct, settings.chars_at_once):
        print_of.update(zip(distinct[a:b], fingerprints(distinct[a:b], settings), strict=True))
    own, other, behind = ([print_of[t] for t in part] for part in (texts, changed, following))
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
        pa.array(own, pa.string()),
        pa.array(other, pa.string()),
        pa.array([likeness(x, y, settings) for x, y in zip(own, other, strict=True)], pa.float64()),
        pa.array([likeness(x, y, settings) for x, y in zip(own, behind, strict=True)], pa.float64()),
    ]


NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def _walked(batches, settings: Settings):
    """Rows of an ordered partition; the first text of it as `head`, the last row as `tail`, without prints."""
    part = TaskContext.get().partitionId()
    names = [*NAMES, "part", "head", "tail"]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int32(), pa.string(), pa.string()]

    def marked(head=None, tail=None, doc_id=None):
        values = [doc_id, *[None] * 6, part, head, tail]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    ids, texts = [], []
    seen = False
    for batch in batches:
        more = batch.column("text").to_pylist()
        if more and not seen:
            seen = True
            yield marked(head=more[0])
        ids, texts = ids + batch.column("doc_id").to_pylist(), texts + more
        for a, b in portions(texts[:-1], settings.chars_at_once):
            columns = _rows(ids[a:b], texts[a:b], texts[a + 1 : b + 1], settings)
            n = b - a
            yield pa.RecordBatch.from_arrays([*columns, pa.array([part] * n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names)
        ids, texts = ids[-1:], texts[-1:]
    if texts:
        yield marked(tail=texts[0], doc_id=ids[0])


def _closed(batches, settings: Settings):
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "tail", "head")]
        yield pa.RecordBatch.from_arrays(_rows(*columns, settings), NAMES)


def with_next(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """COLUMNS for every row and the one that follows it by falling doc_id (after the last: the first).

    Rows are dealt by ranges of the id and sorted, so a row's follower stands behind it. Only the last row
    of each range waits for the first of the next one; these pairs are a row per range.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"), text_key().alias("key"))
    order = [F.desc_nulls_last("doc_id"), F.col("key")]
    tasks = max(1, docs.count() // settings.rows_per_task)
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("doc_id", "text")
    walked = dealt.mapInArrow(partial(_walked, settings=settings), f"{COLUMNS}, part int, head string, tail string")
    walked = stored(walked, "fingerprints")
    heads = walked.filter("head is not null").select(F.col("part").alias("follower"), "head")
    tails = walked.filter("tail is not null").select("doc_id", "part", "tail")
    # Range numbers alone: each one's successor, and the first for the last.
    numbers = tails.select("part").withColumn("follower", F.lead("part").over(Window.orderBy("part")))
    first = numbers.agg(F.min("part")).first()[0]
    follower = numbers.select("part", F.coalesce("follower", F.lit(first).cast("int")).alias("follower"))
    ends = tails.join(follower, "part").join(heads, "follower").select("doc_id", "tail", "head")
    ends = ends.mapInArrow(partial(_closed, settings=settings), COLUMNS)
    return walked.filter("head is null and tail is null").select(*NAMES).union(ends)


def _printed(batches, settings: Settings):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        found = [f for a, b in portions(texts, settings.chars_at_once) for f in fingerprints(texts[a:b], settings)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.string())], ["node", "fingerprint"])


@memo(1024)
def drawn_steps(level: int, rung: int, settings: Settings) -> np.ndarray:
    """The samples of each band, below `rung`."""
    return np.random.default_rng((settings.seed, level, rung)).integers(0, rung, (settings.bands, settings.band_steps))


def rungs(samples: int, settings: Settings) -> list[int]:
    """The two highest rungs up to `samples`; a rung is at most `likeness` times the next one.

    Of two texts whose numbers of samples are within `likeness`, the shorter one's highest is among the longer one's.
    """
    found, rung = [], 1
    while rung <= samples:
        found = [*found[-1:], rung]
        rung = max(rung + 1, int(np.ceil(rung / settings.likeness)))
    return found


def band_keys(fingerprint: str, settings: Settings) -> list[int]:
    """Hashes of shared samples of steps, at the fingerprint's level and the next."""
    keys: list[int] = []
    level = int(fingerprint.partition(":")[0])
    for lv in (level, level + 1):
        digits = np.frombuffer(at_level(fingerprint, lv, settings), np.uint8).astype(np.uint64)
        for rung in rungs(len(digits), settings):
            shown = digits[drawn_steps(lv, rung, settings)]
            value = mix(np.uint64((lv << 32) + rung) * np.uint64(65536) + np.arange(1, settings.bands + 1, dtype=np.uint64))
            for k in range(settings.band_steps):
                value = mix(value * np.uint64(31) + shown[:, k])
            keys += value.view(np.int64).tolist()
    return keys


def _banded(batches, settings: Settings):
    with np.errstate(over="ignore"):
        for batch in batches:
            keys = [band_keys(f, settings) for f in batch.column("fingerprint").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(keys, pa.list_(pa.int64()))], ["node", "bands"])


def likenesses(prints: list[str], settings: Settings) -> np.ndarray:
    """Likeness of all pairs of different fingerprints, as `likeness` has it."""
    levels = np.array([int(f.partition(":")[0]) for f in prints])
    found = np.ones((len(prints), len(prints)))
    for level in np.unique(levels):
        below = np.flatnonzero(levels <= level)
        digits = [np.frombuffer(at_level(prints[i], int(level), settings), np.uint8) for i in below]
        lengths = np.array([len(d) for d in digits])
        table = np.zeros((len(below), max(1, lengths.max())), np.uint8)
        for row, d in zip(table, digits, strict=True):
            row[: len(d)] = d
        for k in np.flatnonzero(levels[below] == level):
            equal = (table[:, : lengths[k]] == digits[k]).sum(axis=1) / np.maximum(np.maximum(lengths, lengths[k]), 1)
            found[below[k], below] = found[below, below[k]] = equal
    same = np.array(prints, object)
    found[same[:, None] == same[None, :]] = 1.0
    return found


def classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id and class_id: texts whose fingerprints are alike, directly or through others.

    All texts of a band are compared, a block of two chunks at a time; a block returns a forest of its links.
    """
    texts = docs.select(text_key().alias("node"), body().alias("text")).groupBy("node").agg(F.first("text").alias("text"))
    prints = stored(texts.mapInArrow(partial(_printed, settings=settings), "node long, fingerprint string"), "prints")
    entries = prints.mapInArrow(partial(_banded, settings=settings), "node long, bands array<long>").select("node", F.explode("bands").alias("key"))
    entries = stored(entries.distinct(), "print-bands")
    groups = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.bit_xor(F.xxhash64("node")).alias("mark"))
    # Bands that hold the same texts are compared once.
    groups = groups.filter("lo < hi").groupBy("n", "lo", "hi", "mark").agg(F.min("key").alias("key"))
    members = entries.join(groups.select("key", F.ceil(F.col("n") / settings.chunk).cast("int").alias("chunks")), "key")
    members = members.withColumn("own", F.pmod(F.xxhash64("node"), "chunks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    members = members.filter("own != other or chunks = 1").select("node", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def forest_of(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        nodes = table.column("node").to_numpy()
        least = forest(likenesses(table.column("fingerprint").to_pylist(), settings) >= settings.likeness)
        at = np.flatnonzero(least != np.arange(len(nodes)))
        return pa.table({"a": pa.array(nodes[at], pa.int64()), "b": pa.array(nodes[least[at]], pa.int64())})

    roots = components(members.join(prints, "node").groupBy("key", "i", "j").applyInArrow(forest_of, "a long, b long"))
    rows = docs.select("doc_id", text_key().alias("node")).join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    least = rows.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rows.join(least, "root").select("doc_id", "class_id")


def fingerprint(spark, sf_dir: str) -> DataFrame:
    """Query: fingerprints of every document and its edited text."""
    return with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
