"""State tables that change together.

A batch writes new folders, never into old ones, and last of all a commit record that lists, for every
table, the folders that hold its rows. Whoever reads goes through a commit record, so a batch that failed
between two tables is not seen at all, and run again it starts from the record before it. Each table is dealt
into parts by a hash of some of its columns; reads name the parts they need.

`KeyedTable` keeps one row per key: a batch rewrites the parts it touches, and the record names for each
part the folder of its newest copy. `LogTable` keeps all rows: a batch adds a folder, and `FAN` folders of one
level are merged into one of the next, so the number of folders grows with the logarithm of the batches.
Folders that neither of the last two records lists are deleted.
"""

from __future__ import annotations

import copy
import json
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 8
KEPT = 2
#: Parts of a table unless the engine is told otherwise; a part of a large state should hold some hundred megabytes.
PARTS = 8


def _at(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[str]:
    at, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        at, fs = _at(spark, path)
        fs.delete(at, True)


@dataclass
class Draft:
    """What a commit record says, while a batch works on the next one."""

    version: int
    #: For a keyed table the folder of each part, for a log its list of (folder, level, newest version).
    tables: dict = field(default_factory=dict)
    #: Small values that change with the tables.
    values: dict = field(default_factory=dict)

    def folders(self) -> set[str]:
        """Folders in use, as table/at=name or table/at=name/part=number."""
        found = set()
        for table, held in self.tables.items():
            if isinstance(held, dict):
                found |= {f"{table}/at={name}/part={part}" for part, name in held.items()}
            else:
                found |= {f"{table}/at={name}" for name, _, _ in held}
        return found


class Store:
    """The commit records of a state folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        found = (re.fullmatch(r"(\d+)\.json", n) for n in names_in(self.spark, f"{self.path}/_commits"))
        return sorted(int(f[1]) for f in found if f)

    def _record(self, version: int) -> Draft:
        at, fs = _at(self.spark, f"{self.path}/_commits/{version}.json")
        stream = fs.open(at)
        try:
            held = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Draft(**held)

    def newest(self) -> Draft | None:
        versions = self.versions()
        return self._record(versions[-1]) if versions else None

    def begin(self, version: int) -> Draft | None:
        """A draft on top of the newest record; None if `version` has been committed already."""
        before = self.newest()
        if before is None:
            return Draft(version)
        return Draft(version, copy.deepcopy(before.tables), dict(before.values)) if before.version < version else None

    def commit(self, draft: Draft) -> None:
        """Publishes the draft, then deletes what no kept record lists."""
        spark = self.spark
        before = self.versions()
        at, fs = _at(spark, f"{self.path}/_commits/_{draft.version}")
        stream = fs.create(at, True)
        stream.write(bytearray(json.dumps({"version": draft.version, "tables": draft.tables, "values": draft.values}).encode()))
        stream.close()
        fs.rename(at, _at(spark, f"{self.path}/_commits/{draft.version}.json")[0])
        kept, old = [*before, draft.version][-KEPT:], [*before, draft.version][:-KEPT]
        live = set().union(*(self._record(v).folders() for v in kept))
        gone = set().union(*(self._record(v).folders() for v in old)) - live
        used = {f.split("/part=")[0] for f in live}
        # A folder none of whose parts is in use goes as a whole.
        whole = {f.split("/part=")[0] for f in gone} - used
        rest = {f for f in gone if f.split("/part=")[0] in used}
        delete_folders(spark, [f"{self.path}/{f}" for f in sorted(whole | rest)])
        delete_folders(spark, [f"{self.path}/_commits/{v}.json" for v in old])


@dataclass(frozen=True)
class _Table:
    store: Store
    name: str
    schema: str
    #: Columns whose hash deals rows into parts.
    deal: tuple[str, ...]
    parts: int

    @property
    def path(self) -> str:
        return f"{self.store.path}/{self.name}"

    def with_part(self, rows: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64(*self.deal), F.lit(self.parts)) if self.deal else F.lit(0)
        return rows.withColumn("part", part.cast("int"))

    def parts_of(self, rows: DataFrame) -> list[int]:
        """The parts that hold the rows' keys; `parts` numbers at most."""
        return sorted(r["part"] for r in self.with_part(rows).select("part").distinct().collect())

    def _empty(self) -> DataFrame:
        return self.store.spark.createDataFrame([], self.schema)

    def _reader(self):
        return self.store.spark.read.schema(f"{self.schema}, at string, part int").option("basePath", self.path)

    def _write(self, rows: DataFrame, name: str) -> None:
        """The rows of a part come together, but a part too large for one task is written by several.

        How many that are follows from the bytes shuffled. A table of one part is not sorted by part, so its
        tasks hold no rows.
        """
        dealt, path = self.with_part(rows).hint("rebalance", "part"), f"{self.path}/at={name}"
        only = self.parts == 1
        writer = (dealt.drop("part") if only else dealt).write.mode("overwrite").option("maxRecordsPerFile", 5_000_000)
        if only:
            writer.parquet(f"{path}/part=0")
        else:
            writer.partitionBy("part").parquet(path)


@dataclass(frozen=True)
class KeyedTable(_Table):
    """One row of every key; `deal` is among the keys."""

    keys: tuple[str, ...]

    def read(self, draft: Draft | None, parts: list[int] | None = None) -> DataFrame:
        held = draft.tables.get(self.name, {}) if draft else {}
        wanted = held if parts is None else {str(p): held[str(p)] for p in parts if str(p) in held}
        if not wanted:
            return self._empty()
        paths = [f"{self.path}/at={name}/part={part}" for part, name in wanted.items()]
        return self._reader().parquet(*paths).drop("at", "part")

    def write(self, draft: Draft, changed: DataFrame, name: str, parts: list[int]) -> None:
        """Puts the changed rows in place; `parts` has all parts that they belong to."""
        values = [c for c in changed.columns if c not in self.keys]
        both = self.read(draft, parts).withColumn("__new", F.lit(0)).unionByName(changed.withColumn("__new", F.lit(1)))
        self.replace(draft, both.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "__new").alias("r")).select(*self.keys, "r.*"), name)

    def replace(self, draft: Draft, rows: DataFrame, name: str) -> None:
        """Writes parts anew; `rows` has all rows that these are to hold, one of every key."""
        self._write(rows, name)
        written = {n.removeprefix("part=") for n in names_in(self.store.spark, f"{self.path}/at={name}") if n.startswith("part=")}
        draft.tables[self.name] = draft.tables.get(self.name, {}) | dict.fromkeys(sorted(written), name)


@dataclass(frozen=True)
class LogTable(_Table):
    """All rows that ever came, each with the `version` it came in."""

    def _rows(self, entries: list) -> DataFrame:
        if not entries:
            return self._empty()
        return self._reader().parquet(*[f"{self.path}/at={name}" for name, _, _ in entries]).drop("at")

    def read(self, draft: Draft | None, parts: list[int] | None = None, since: int = 0) -> DataFrame:
        """Rows of the named parts; folders with nothing from version `since` on are not opened."""
        entries = [e for e in (draft.tables.get(self.name, []) if draft else []) if e[2] >= since]
        rows = self._rows(entries)
        if not entries:
            return rows
        return (rows if parts is None else rows.filter(F.col("part").isin(parts))).drop("part")

    def added(self, name: str) -> DataFrame:
        """The rows of one folder."""
        return self._rows([(name, 0, 0)]).drop("part")

    def append(self, draft: Draft, rows: DataFrame, name: str, version: int) -> None:
        self._write(rows.withColumn("version", F.lit(version)), name)
        entries = [*draft.tables.get(self.name, []), [name, 0, version]]
        level = 0
        while len(full := [e for e in entries if e[1] == level]) >= FAN:
            merged = f"{name}m{level + 1}"
            self._write(self._rows(full).drop("part"), merged)
            entries = [e for e in entries if e[1] != level] + [[merged, level + 1, max(e[2] for e in full)]]
            level += 1
        draft.tables[self.name] = entries
