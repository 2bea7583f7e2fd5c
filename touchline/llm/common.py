"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Anything between two runs of letters or digits, as Java's regular expressions write it.
WORD_BREAK = r"[^\p{L}\p{N}]+"


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def body(name: str = "text") -> Column:
    """The text; a null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_key(name: str = "text") -> Column:
    """64 bits that stand for a text. Equal texts share it; a null text shares that of the empty one."""
    return F.xxhash64(body(name))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64 bits that stand for a (document id, text); a null id differs from every other."""
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("\0")), body(text))


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def bounded_batches(spark) -> None:
    """Batches sent to Python hold few rows and few bytes, so that long texts do not fill a task's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """`df` marked for broadcast if its counted `rows` are within `limit`; else as it is, for a shuffled join."""
    return F.broadcast(df) if rows <= limit else df


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def portions(texts: list[str], chars: int, most: int = 32_768) -> Iterator[tuple[int, int]]:
    """Slices of `texts` of about `chars` characters each, one text at least and `most` at most."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text) + 1
        if held >= chars or i + 1 - start >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class Memo:
    """A function that keeps its last `limit` answers; unlike functools', it travels with its code."""

    def __init__(self, function, limit: int):
        self.function, self.limit, self.kept = function, limit, {}

    def __call__(self, *args):
        if args not in self.kept:
            if len(self.kept) >= self.limit:
                del self.kept[next(iter(self.kept))]
            self.kept[args] = self.function(*args)
        return self.kept[args]

    def __getstate__(self):
        return {"function": self.function, "limit": self.limit, "kept": {}}


def memo(limit: int):
    return lambda function: Memo(function, limit)
