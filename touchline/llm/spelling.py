r"""Spelling variants by finite-state composition.

The vocabulary is an acceptor A; a transducer T maps a word to all words at one inserted, deleted or replaced
code point. The pairs that A o T o A accepts are the near words. The composition is cut by initial states: a
pair whose words agree in their first half is found behind the state that this half leads to; any other
pair agrees in its last half, and is found in front of it. So a partition holds the remaining parts of
words of one length, and of that length plus one, that share a half, as a minimised acceptor, and T has
its one edit within them. A pair is accepted in one partition, along one path: an inserted
code point never stands before its like, and in front of a shared last half never right before that.

Partitions of more than `chunk` words are dealt by hash into chunks, and every two chunks meet, so that no
task holds a large partition. Words and pairs move by shuffles; nothing passes through the driver but
the largest count, which bounds the length of a chain of forms: a form is `factor` times as frequent as its word.

Defined results: a null text has no words; a null doc_id counts as empty text in the hash; rows that repeat
count again; no words, no rows. Words of any length are whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import body, bounded_batches
from touchline.session import stored

LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["length", "front", "half", "i", "j"]
PAIR = "word string, n long, near string, near_n long"


@dataclass(frozen=True)
class Settings:
    least_length: int = 6
    least_count: int = 5
    #: A word whose hash this divides loses a code point where it occurs.
    modulus: int = 199
    factor: int = 5
    #: Words of a partition that one task meets with as many others.
    chunk: int = 4096
    #: States kept for sharing between partitions of a task.
    states: int = 200_000


class Acceptor:
    """A minimised acyclic automaton with several initial states: equal right languages are one state."""

    def __init__(self):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())
        if key not in self.known:
            self.known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self.known[key]

    def add(self, words: list[str]) -> int:
        """The initial state behind which exactly these words, sorted, are accepted."""
        open_states: list[list] = [[False, {}]]
        before = ""
        for word in words:
            same = 0
            while same < len(before) and before[same] == word[same]:
                same += 1
            self._close(open_states, before, same)
            open_states += [[False, {}] for _ in word[same:]]
            open_states[-1][0] = True
            before = word
        self._close(open_states, before, 0)
        return self._state(*open_states[0])

    def _close(self, open_states: list[list], word: str, depth: int) -> None:
        """Makes states of everything below `depth` on the path of the last word."""
        while len(open_states) > depth + 1:
            state = self._state(*open_states.pop())
            open_states[-1][1][word[len(open_states) - 1]] = state


def spelled(path: tuple | None) -> tuple[str, str]:
    """Both words along a path of (path before, code point of the one, of the other)."""
    one, other = [], []
    while path is not None:
        path, a, b = path
        one.append(a)
        other.append(b)
    return "".join(reversed(one)), "".join(reversed(other))


def composed(automaton: Acceptor, p: int, q: int, inserts: bool, at_end: bool) -> list[tuple[str, str]]:
    """Pairs (word behind p, word behind q) at one replaced or, if `inserts`, one code point inserted into the first.

    `at_end` allows the inserted code point to be the last one.
    """
    found = []
    # Without an edit so far; then None, or after an insertion what may not follow.
    waiting = [(p, q, False, None, None)]
    arcs, final = automaton.arcs, automaton.final
    while waiting:
        p, q, edited, banned, path = waiting.pop()
        left, right = arcs[p], arcs[q]
        if edited:
            if final[p] and final[q] and (banned is None or at_end):
                found.append(spelled(path))
            few, many = (left, right) if len(left) <= len(right) else (right, left)
            for c in few:
                if c in many and c != banned:
                    waiting.append((left[c], right[c], True, None, (path, c, c)))
            continue
        for c, to in left.items():
            if c in right:
                waiting.append((to, right[c], False, None, (path, c, c)))
            if not inserts:
                for d, other in right.items():
                    if c != d:
                        waiting.append((to, other, True, None, (path, c, d)))
        if inserts:
            for d, other in right.items():
                waiting.append((p, other, True, d, (path, "", d)))
    return found


def near_pairs(automaton: Acceptor, length: int, front: bool, half: str, i: int, j: int, rows: list[tuple[str, int, int]]) -> list[tuple[str, int, str, int]]:
    """(word, n, near word, its n), both ways, of a block of (word, n, chunk) that share a half."""
    count = {word: n for word, n, _ in rows}

    def rest(word: str) -> str:
        return word[len(half) :] if front else word[: len(word) - len(half)]

    def whole(part: str) -> str:
        return half + part if front else part + half

    def initial(chunk: int, size: int) -> int:
        return automaton.add(sorted(rest(w) for w, _, c in rows if c == chunk and len(w) == size))

    found = composed(automaton, initial(i, length), initial(j, length), False, True)
    if i == j:
        # Both orders are accepted; one is enough here.
        found = [(a, b) for a, b in found if a < b]
    found += composed(automaton, initial(i, length), initial(j, length + 1), True, front)
    if i != j:
        found += composed(automaton, initial(j, length), initial(i, length + 1), True, front)
    named = [(whole(a), whole(b)) for a, b in found]
    return [(a, count[a], b, count[b]) for x, y in named for a, b in ((x, y), (y, x))]


def _composed_batches(batches, settings: Settings):
    automaton, key, rows = Acceptor(), None, []

    def batch(found):
        columns = [list(c) for c in zip(*found, strict=True)] if found else [[], [], [], []]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n", "near", "near_n"])

    found = []
    for part in batches:
        for *now, word, n, chunk in zip(*(part.column(c).to_pylist() for c in [*KEY, "word", "n", "chunk"]), strict=True):
            if now != key:
                if rows:
                    found += near_pairs(automaton, *key, rows)
                key, rows = now, []
                if len(automaton.arcs) > settings.states:
                    automaton = Acceptor()
                if len(found) > 10_000:
                    yield batch(found)
                    found = []
            rows.append((word, n, chunk))
    if rows:
        found += near_pairs(automaton, *key, rows)
    yield batch(found)


def vocabulary(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(doc.alias("doc"), F.explode_outer(F.regexp_extract_all(body(), F.lit(LETTERS), F.lit(0))).alias("run"))
    # Runs too short to become words, and the null run of a text without any, are not looked at further. A plain
    # explode would have the runs extracted once more, for a filter at the scan.
    runs = runs.filter(F.length("run") >= settings.least_length).select("doc", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
    shortened = F.expr("concat(left(run, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))")
    words = runs.select(F.when(F.col("h") % settings.modulus == 0, shortened).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= settings.least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= settings.least_count)


def partitioned(words: DataFrame, settings: Settings) -> DataFrame:
    """Words by the halves that they may share with a near word, one row for each block that they meet in."""
    size = F.length("word")

    def halves(length):
        fore = F.expr(f"cast(({length}) div 2 as int)")
        return [
            F.struct(F.expr(length).alias("length"), F.lit(True).alias("front"), F.left("word", fore).alias("half")),
            F.struct(F.expr(length).alias("length"), F.lit(False).alias("front"), F.right("word", F.expr(length) - fore).alias("half")),
        ]

    shorter = F.when(size > settings.least_length, F.array(*halves("length(word) - 1"))).otherwise(F.array().cast("array<struct<length:int,front:boolean,half:string>>"))
    places = F.concat(F.array(*halves("length(word)")), shorter)
    entries = words.select("word", "n", F.explode(places).alias("p")).select("word", "n", "p.*")
    shared = ["length", "front", "half"]
    sizes = entries.groupBy(*shared).agg(F.count("*").alias("words"), F.count_if(F.length("word") == F.col("length")).alias("own"))
    sizes = sizes.filter("words > 1 and own > 0").select(*shared, F.ceil(F.col("words") / settings.chunk).cast("int").alias("chunks"))
    members = entries.join(sizes, shared).withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return members.select("word", "n", "chunk", *shared, F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))


def near_words(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n, near, near_n) of all pairs at one edit, both ways."""
    bounded_batches(words.sparkSession)
    blocks = partitioned(words, settings).repartition(*KEY).sortWithinPartitions(*KEY)
    return blocks.mapInArrow(partial(_composed_batches, settings=settings), PAIR)


def rooted(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root) for (word, form): the end of each word's chain, which has 2 ** rounds links at most."""
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        roots = stored(roots, "spelling-roots")
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return roots


def variants(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """word, form, root, n, n_near and form_n of every row of (word, n)."""
    words = stored(words, "spelling-words")
    most = words.agg(F.max("n")).first()[0] or 1
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    nearest = near_words(words, settings).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(nearest, "word", "left")
    is_form = -F.col("best.less") >= settings.factor * F.col("n")
    found = found.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")
    )
    found = stored(found, "spelling-forms")
    longest = max(1, math.floor(math.log(most, settings.factor)) + 1)
    roots = rooted(found.filter("form is not null"), math.ceil(math.log2(longest)))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling(spark, sf_dir: str) -> DataFrame:
    """Query: the spelling variants among the words of all documents."""
    return variants(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet")))
