r"""Ranked lexical search over bit-sliced Bloom signatures.

Index: every document has a Bloom signature of its terms, and of (term, 2), (term, 4) and so on for terms that
occur so often. Documents are dealt by the size of their signature, so that all signatures are about
equally full, and a block of documents is stored in slices: for each bit of the signature a bitmap over the
block's documents. Bitmaps of a term's bits, laid on one another, say which documents may hold it.

Search: what a term adds to a document is bounded from the document's length and the highest of the term's
frequencies that the slices show; the weighted sum over an item's terms is an upper bound of the score.
Each item's documents of highest bounds are scored exactly, which gives a score that `top` documents reach;
then all documents whose bound reaches that are scored exactly from their texts. As a bound is never
below the score, and a document that merely ties is kept, no result is missed.

Queries are sent in blocks of `items` against all documents. Terms are bytes 0-9, A-Z (in lower case), a-z and all
from 0x80 on, in runs; a 64-bit hash stands for a term.

Defined results: a null text has no terms; an item without terms, or whose terms no document holds, has no rows;
items that repeat are ranked each on their own; a repeated document is ranked as often as it is there; among
equal scores a null doc_id comes last. No documents or no items, no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import body, bounded_batches, mix, portions, row_key
from touchline.llm.near_dedup import powers
from touchline.session import stored

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
BLOCK = "width int, docs int, keys binary, lengths binary, slices binary"


@dataclass(frozen=True)
class Settings:
    top: int = 50
    #: Bits of a signature for each of its entries, at least; at most twice as many, as sizes are powers of two.
    bits: int = 20
    #: Bits that an entry sets.
    probes: int = 10
    #: Frequencies up to 2 ** (levels - 1) have entries of their own.
    levels: int = 5
    block_docs: int = 1024
    block_bytes: int = 1 << 18
    #: Items sent against all documents together.
    items: int = 1000


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every byte: whether it belongs to a term, and its 64 random bits, alike for both cases of A-Z."""
    byte = np.arange(256)
    folded = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    inside = ((folded >= 97) & (folded <= 122)) | ((byte >= 48) & (byte <= 57)) | (byte >= 128)
    return inside, mix((folded.astype(np.uint64) + np.uint64(1)) * GOLDEN), folded


INSIDE, RANDOM, _ = _tables()


def term_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each term of the texts, one text after the other, and the number of terms of each text."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)
    edge = np.flatnonzero(np.diff(INSIDE[data], prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    up, down = powers(1 << max(12, len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(RANDOM[data] * up[: len(data)], out=sums[1:])
    borders = np.cumsum([len(e) + 1 for e in encoded])
    counts = np.bincount(np.searchsorted(borders, starts, side="right"), minlength=len(texts))
    return mix((sums[ends] - sums[starts]) * down[starts]), counts


def frequencies(texts: list[str], chars: int = 400_000) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By portions of texts: the first text's index, then (text within it, term, frequency), and terms of each text."""
    for a, b in portions(texts, chars):
        terms, lengths = term_hashes(texts[a:b])
        of = np.repeat(np.arange(b - a), lengths)
        order = np.lexsort((terms, of))
        of, terms = of[order], terms[order]
        new = np.flatnonzero(np.diff(of, prepend=-1).astype(bool) | np.diff(terms, prepend=~terms[:1]).astype(bool))
        yield a, of[new], terms[new], np.diff(np.append(new, len(of))), lengths


def entry(terms: np.ndarray, level: int) -> np.ndarray:
    """What stands in a signature for a term that occurs 2 ** level times at least."""
    return mix(terms + np.uint64(level * int(GOLDEN) % (1 << 64)))


def probed(entries: np.ndarray, width: int | np.ndarray, probes: int) -> np.ndarray:
    """The bits of each entry, a row for each, in signatures of a power of two of bits."""
    first, step = entries & np.uint64(0xFFFFFFFF), entries >> np.uint64(32) | np.uint64(1)
    mask = np.asarray(width, np.uint64)[..., None] - np.uint64(1)
    return ((first[:, None] + np.arange(probes, dtype=np.uint64) * step[:, None]) & mask).astype(np.int32 if np.max(width) < 1 << 31 else np.int64)


class Pending:
    """Documents of one size of signature that wait for their block to be full."""

    def __init__(self, width: int, settings: Settings):
        self.width = width
        fits = settings.block_bytes * 8 // width
        self.limit = max(8, min(settings.block_docs, fits // 8 * 8))
        self.keys, self.lengths, self.bits = [], [], []

    def block(self) -> dict:
        docs = len(self.keys)
        of = np.repeat(np.arange(docs), [len(b) for b in self.bits])
        held = np.zeros((self.width, -(-docs // 8)), np.uint8)
        np.bitwise_or.at(held, (np.concatenate(self.bits), of >> 3), (128 >> (of & 7)).astype(np.uint8))
        made = {
            "width": self.width,
            "docs": docs,
            "keys": np.array(self.keys, "<i8").tobytes(),
            "lengths": np.array(self.lengths, "<i8").tobytes(),
            "slices": held.tobytes(),
        }
        self.keys, self.lengths, self.bits = [], [], []
        return made


def _blocks(batches, settings: Settings):
    schema = pa.schema([("width", pa.int32()), ("docs", pa.int32()), ("keys", pa.binary()), ("lengths", pa.binary()), ("slices", pa.binary())])
    waiting: dict[int, Pending] = {}
    for batch in batches:
        texts, keys = batch.column("text").to_pylist(), batch.column("key").to_pylist()
        full = []
        for a, of, terms, tf, lengths in frequencies(texts, 200_000):
            level = np.minimum(np.log2(tf).astype(np.int64) + 1, settings.levels)
            entries, owner = [], []
            for k in range(settings.levels):
                here = level > k
                entries.append(entry(terms[here], k))
                owner.append(of[here])
            entries, owner = np.concatenate(entries), np.concatenate(owner)
            sizes = np.bincount(owner, minlength=len(lengths))
            widths = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(sizes * settings.bits, 1)))).astype(np.int64)
            order = np.argsort(owner, kind="stable")
            bits = probed(entries[order], widths[owner[order]], settings.probes)
            ends = np.cumsum(sizes)
            for d in np.flatnonzero(sizes):
                width = int(widths[d])
                place = waiting.setdefault(width, Pending(width, settings))
                place.keys.append(keys[a + d])
                place.lengths.append(int(lengths[d]))
                place.bits.append(bits[ends[d] - sizes[d] : ends[d]].flatten())
                if len(place.keys) >= place.limit:
                    full.append(place.block())
        if full:
            yield pa.RecordBatch.from_pylist(full, schema)
    for place in waiting.values():
        if place.keys:
            yield pa.RecordBatch.from_pylist([place.block()], schema)


def index(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Blocks of bit-sliced signatures of all documents that hold a term."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(row_key().alias("key"), body().alias("text"))
    return rows.mapInArrow(partial(_blocks, settings=settings), BLOCK)


@dataclass(frozen=True)
class Query:
    """A block of items: their different terms, sorted, and for each item the places of its terms among them."""

    terms: np.ndarray
    items: list[np.ndarray]


def asked(texts: list[str]) -> Query:
    found = [np.unique(term_hashes([t])[0]) for t in texts]
    terms = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
    return Query(terms, [np.searchsorted(terms, f) for f in found])


def matched(terms: np.ndarray, query: Query) -> tuple[np.ndarray, np.ndarray]:
    """Which of the terms are asked for, and their places in the query."""
    at = np.searchsorted(query.terms, terms)
    at[at == len(query.terms)] = 0
    hit = np.flatnonzero(query.terms[at] == terms) if len(query.terms) else np.zeros(0, np.int64)
    return hit, at[hit]


def _counted(batches, query: Query):
    """(place of a term, documents that hold it); place -1 counts documents with a term, -2 all terms."""
    df, docs, length = np.zeros(len(query.terms), np.int64), 0, 0
    for batch in batches:
        for _, _, terms, _, lengths in frequencies(batch.column("text").to_pylist()):
            np.add.at(df, matched(terms, query)[1], 1)
            docs += int((lengths > 0).sum())
            length += int(lengths.sum())
    some = np.flatnonzero(df)
    places = [*some.tolist(), -1, -2]
    yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array([*df[some].tolist(), docs, length], pa.int64())], ["place", "n"])


@dataclass(frozen=True)
class Scoring:
    """The query with its weights, and what lengths are measured by."""

    query: Query
    weights: np.ndarray
    docs: int
    length: int

    def slack(self, lengths: np.ndarray) -> np.ndarray:
        return 50 + 50 * lengths * self.docs // self.length

    @staticmethod
    def gain(tf: np.ndarray, slack: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + 20 * slack)


def scoring(docs: DataFrame, query: Query) -> Scoring | None:
    """Weights from counts over all documents; None if there is nothing to find."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(body().alias("text")).mapInArrow(partial(_counted, query=query), "place int, n long")
    counts = {r["place"]: r["n"] for r in rows.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    total = counts.get(-1, 0)
    if not total or not len(query.terms):
        return None
    weights = [math.floor(1000 * math.log((2 * total + 2) / (2 * counts.get(k, 0) + 1))) for k in range(len(query.terms))]
    return Scoring(query, np.array(weights, np.int64), total, counts[-2])


def bounds(block: dict, scorer: Scoring, settings: Settings) -> np.ndarray:
    """Upper bounds of the scores of a block's documents, a row for each item."""
    width, docs = block["width"], block["docs"]
    slices = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
    lengths = np.frombuffer(block["lengths"], "<i8")
    slack = scorer.slack(lengths)
    terms = scorer.query.terms
    most = np.zeros((len(terms), docs), np.int32)
    alive, above = np.arange(len(terms)), None
    for level in range(settings.levels):
        held = np.bitwise_and.reduce(slices[probed(entry(terms[alive], level), width, settings.probes)], axis=1)
        if above is not None:
            held &= above
        some = held.any(axis=1)
        alive, above = alive[some], held[some]
        last = level == settings.levels - 1
        # A frequency without the next entry is below that entry's; beyond the last one it is bounded by the length.
        reached = lengths if last else np.minimum(np.int64((2 << level) - 1), lengths)
        gain = scorer.gain(reached, slack).astype(np.int32)
        present = np.unpackbits(above, axis=1, count=docs).astype(bool)
        most[alive] = np.where(present, gain, most[alive])
    found = np.zeros((len(scorer.query.items), docs))
    for i, places in enumerate(scorer.query.items):
        # Sums stay far below 2 ** 53, so doubles are exact.
        found[i] = scorer.weights[places].astype(float) @ most[places]
    return found


def _block_rows(batches):
    for batch in batches:
        columns = {c: batch.column(c) for c in ("width", "docs", "keys", "lengths", "slices")}
        for i in range(batch.num_rows):
            yield {c: v[i].as_py() for c, v in columns.items()}


def _pairs(items, keys, values) -> pa.RecordBatch:
    arrays = [pa.array(items, pa.int32()), pa.array(keys, pa.int64()), pa.array(values, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["item", "key", "bound"])


def _highest(batches, scorer: Scoring, settings: Settings):
    """The documents of highest bounds for each item, over the blocks of a task."""
    count = len(scorer.query.items)
    best, keys = np.zeros((count, 0)), np.zeros((count, 0), np.int64)
    for block in _block_rows(batches):
        found = bounds(block, scorer, settings)
        best = np.concatenate([best, found], axis=1)
        keys = np.concatenate([keys, np.broadcast_to(np.frombuffer(block["keys"], "<i8"), found.shape)], axis=1)
        if best.shape[1] > settings.top:
            at = np.argpartition(-best, settings.top - 1, axis=1)[:, : settings.top]
            best, keys = np.take_along_axis(best, at, 1), np.take_along_axis(keys, at, 1)
    item, place = np.nonzero(best)
    yield _pairs(item, keys[item, place], best[item, place].astype(np.int64))


def _reaching(batches, scorer: Scoring, least: np.ndarray, settings: Settings):
    """All (item, document) whose bound reaches the item's score to beat."""
    for block in _block_rows(batches):
        found = bounds(block, scorer, settings)
        item, place = np.nonzero(found >= least[:, None])
        yield _pairs(item, np.frombuffer(block["keys"], "<i8")[place], found[item, place].astype(np.int64))


HELD = "doc_id long, key long, slack long, places array<int>, tf array<int>"


def _held(batches, scorer: Scoring, carried: list[str]):
    """Documents with a term that is asked for: these terms, and how often each occurs."""
    for batch in batches:
        starts, places, counts, rows, slacks = [0], [], [], [], []
        for a, of, terms, tf, lengths in frequencies(batch.column("text").to_pylist()):
            hit, at = matched(terms, scorer.query)
            docs, sizes = np.unique(of[hit], return_counts=True)
            places.append(at)
            counts.append(tf[hit])
            rows.append(a + docs)
            slacks.append(scorer.slack(lengths[docs]))
            starts += (starts[-1] + np.cumsum(sizes)).tolist()
        if len(starts) == 1:
            continue
        rows, offsets = np.concatenate(rows), pa.array(starts, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(v), pa.int32())) for v in (places, counts)]
        kept = [batch.column(c).take(pa.array(rows)) for c in ("doc_id", "key")]
        more = [batch.column(c).take(pa.array(rows)) for c in carried]
        slack = pa.array(np.concatenate(slacks), pa.int64())
        yield pa.RecordBatch.from_arrays([*kept, slack, *lists, *more], ["doc_id", "key", "slack", "places", "tf", *carried])


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each list begins and ends, and the values of all."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]


def _scored(batches, scorer: Scoring):
    row = np.zeros(len(scorer.query.terms), np.int64)
    for batch in batches:
        (at, places), (_, tf), (to, wanted) = (_flat(batch.column(c)) for c in ("places", "tf", "items"))
        slack = np.repeat(batch.column("slack").to_numpy(), np.diff(at))
        gains = scorer.weights[places] * scorer.gain(tf.astype(np.int64), slack)
        scores = np.zeros(len(wanted), np.int64)
        for d in range(batch.num_rows):
            own = places[at[d] : at[d + 1]]
            row[own] = gains[at[d] : at[d + 1]]
            for k in range(to[d], to[d + 1]):
                scores[k] = row[scorer.query.items[wanted[k]]].sum()
            row[own] = 0
        some = np.flatnonzero(scores)
        of = np.repeat(np.arange(batch.num_rows), np.diff(to))[some]
        arrays = [pa.array(wanted[some], pa.int32()), batch.column("doc_id").take(pa.array(of)), pa.array(scores[some], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])


def exact(docs: DataFrame, pairs: DataFrame, scorer: Scoring, few: bool) -> DataFrame:
    """(item, doc_id, score) of the documents that the pairs (item, key) name, where above 0.

    `few` pairs, whose number has a bound, are brought to the texts. However many others meet what the
    documents hold of the query, so that no text is shuffled.
    """
    wanted = pairs.groupBy("key").agg(F.collect_list("item").alias("items"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), body().alias("text"))
    if few:
        rows = rows.join(F.broadcast(wanted), "key").select("doc_id", "key", "text", "items")
        held = rows.mapInArrow(partial(_held, scorer=scorer, carried=["items"]), f"{HELD}, items array<int>")
    else:
        held = rows.mapInArrow(partial(_held, scorer=scorer, carried=[]), HELD).join(wanted.hint("merge"), "key")
    held = held.select("doc_id", "slack", "places", "tf", "items")
    return held.mapInArrow(partial(_scored, scorer=scorer), "item int, doc_id long, score long")


def ranked(scores: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def found(docs: DataFrame, blocks: DataFrame, texts: list[str], settings: Settings = Settings()) -> DataFrame | None:
    """(item, doc_id, score, rank) for a block of items, an item being its place in `texts`."""
    query = asked(texts)
    scorer = scoring(docs, query)
    if scorer is None:
        return None
    pairs = "item int, key long, bound long"
    highest = blocks.mapInArrow(partial(_highest, scorer=scorer, settings=settings), pairs)
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "key")
    highest = highest.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= settings.top)
    highest = stored(highest.select("item", "key"), "search-highest")
    tried = ranked(exact(docs, highest, scorer, True), settings.top)
    least = np.ones(len(texts))
    for r in tried.filter(F.col("rank") == settings.top).select("item", "score").collect():
        least[r["item"]] = r["score"]
    near = stored(blocks.mapInArrow(partial(_reaching, scorer=scorer, least=least, settings=settings), pairs), "search-candidates")
    return ranked(exact(docs, near, scorer, False), settings.top)


def search(docs: DataFrame, items: DataFrame, settings: Settings = Settings(), blocks: DataFrame | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: the highest-scoring documents of every row (item_id, text) of `items`.

    `blocks` is a stored `index` of `docs`; without one it is made.
    """
    spark = docs.sparkSession
    blocks = blocks if blocks is not None else stored(index(docs, settings), "search-index")
    result = spark.createDataFrame([], "item int, rank int, doc_id long, score long").select(F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"), "rank", "doc_id", "score")
    waiting = items.select("item_id", body().alias("text")).toLocalIterator()
    while part := list(islice(waiting, settings.items)):
        hits = found(docs, blocks, [r["text"] for r in part], settings)
        if hits is None:
            continue
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(part)], items.select(F.lit(0).alias("item"), "item_id").schema)
        hits = stored(hits, "search-hits")
        result = result.unionByName(hits.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return result


def ranked_search(spark, sf_dir: str) -> DataFrame:
    """Query: the documents that score highest for every benchmark item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), i AS (
    SELECT row_number() OVER () AS iid, item_id,
        list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
    FROM benchmark
), q AS (
    SELECT iid, item_id, unnest(terms) AS term FROM i
), size AS (
    SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS length FROM d WHERE len(terms) > 0
), tf AS (
    SELECT rid, doc_id, len(terms)::BIGINT AS own, term, count(*)::BIGINT AS tf
    FROM (SELECT rid, doc_id, terms, unnest(terms) AS term FROM d)
    WHERE term IN (SELECT term FROM q) GROUP BY rid, doc_id, terms, term
), w AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tf, size GROUP BY term
), s AS (
    SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * own * docs) // length))))::BIGINT AS score
    FROM q JOIN tf USING (term) JOIN w USING (term), size GROUP BY iid, item_id, rid, doc_id
), r AS (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
"""
