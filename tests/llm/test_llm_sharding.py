from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

from touchline.llm import sharding

SCHEMA = "doc_id long, text string, shard string, Slot int"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def checked(rows, found, shards=16):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows
    )
    places = defaultdict(list)
    for r in found:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        places[r["shard"]].append(r["slot"])
    for own in places.values():
        assert sorted(own) == list(range(len(own)))
    return places


def test_shards_are_near_equal_and_gapless(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = sharding.sharding(spark, sf_dir).collect()
    checked(rows, found)
    sums = Counter()
    for r in found:
        sums[r["shard"]] += r["size"]
    mean = sum(sums.values()) / 16
    largest = max(len((t or "").encode()) + 1 for _, t in rows)
    assert max(sums.values()) <= max(1.05 * mean, largest)
    # Equal texts lie together unless their slot is hot.
    slots = defaultdict(set)
    for r in found:
        slots[(r["text_crc32"], r["size"])].add(r["virtual_slot"])
    assert all(len(s) == 1 or min(s) >= 4096 for s in slots.values())


def test_hot_texts_and_repeated_rows_are_spread(spark):
    same = "copied text " * 20
    rows = [(i, same) for i in range(300)] + [(7, same)] * 400 + [(i, f"text {i} " * (i % 30)) for i in range(1000, 1500)]
    found = sharding.shards(rows_of(spark, rows)).collect()
    checked(rows, found)
    sums = Counter()
    for r in found:
        sums[r["shard"]] += r["size"]
    assert max(sums.values()) <= 1.05 * sum(sums.values()) / 16


def test_nulls_ties_and_empty_tables(spark):
    rows = [(None, None), (None, None), (1, None), (1, ""), (2, "é"), (2, "é"), (3, "x" * 100_000)]
    checked(rows, sharding.shards(rows_of(spark, rows)).collect())
    assert sharding.shards(rows_of(spark, [])).collect() == []


def test_a_new_version_edits_the_map():
    size = {s: 10 + (s * 37) % 23 for s in range(512)}
    first = sharding.rebalanced({}, size, 8)
    again = sharding.rebalanced(first, size, 8)
    assert again == first
    grown = sharding.rebalanced(first, size, 9)
    moved = [s for s in size if grown[s] != first[s]]
    assert len(moved) <= 512 / 9 * 1.5
    sums = Counter()
    for s, shard in grown.items():
        sums[shard] += size[s]
    assert max(sums.values()) - min(sums.values()) <= 2
    fewer = sharding.rebalanced(grown, size, 8)
    assert set(fewer.values()) == set(range(8))


def test_written_shards_hold_all_texts(spark, tmp_path):
    rows = [(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    places = sharding.placed(docs, sharding.Settings(shards=3), folder=str(tmp_path / "maps"))
    sharding.write_shards(docs, places, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter(rows)
    assert spark.read.parquet(str(tmp_path / "maps")).select("version").distinct().collect()[0][0] == 1


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_other_numbers_of_shards(spark, shards):
    rows = [(i, "w" * (i * 7 % 50)) for i in range(60)]
    found = sharding.shards(rows_of(spark, rows), sharding.Settings(shards=shards)).collect()
    assert set(checked(rows, found, shards)) == set(range(shards))


def test_rebalancing_ends_where_no_edit_helps():
    size = {s: 1000 + (s * s * 7919) % 99_991 for s in range(3000)}
    now = sharding.rebalanced({}, size, 16)
    held = defaultdict(list)
    for s, shard in now.items():
        held[shard].append(size[s])
    sums = {shard: sum(x) for shard, x in held.items()}
    high, low = max(sums, key=sums.get), min(sums, key=sums.get)
    gap = sums[high] - sums[low]
    assert not any(0 < x < gap for x in held[high])
    assert not any(0 < x - y < gap for x in held[high] for y in held[low])


def test_a_slot_with_many_small_rows_is_cut(spark):
    rows = [(i, None if i % 2 else "") for i in range(2000)] + [(5, "")] * 500 + [(i, f"own text {i} " * 40) for i in range(5000, 6500)]
    found = sharding.shards(rows_of(spark, rows)).collect()
    checked(rows, found)
    per_slot = Counter(r["virtual_slot"] for r in found)
    assert max(per_slot.values()) * 16 <= len(rows)


def test_versions_are_read_back_and_edited(spark, tmp_path):
    folder = str(tmp_path / "maps")
    rows = [(i, f"text {i} " * (i % 40)) for i in range(1500)]
    first = {r["doc_id"]: r for r in sharding.shards(rows_of(spark, rows), folder=folder).collect()}
    version, one = sharding.newest_map(spark, folder)
    assert version == 2 and set(one.values()) == set(range(16))
    # The same rows leave the map as it is.
    again = {r["doc_id"]: r for r in sharding.shards(rows_of(spark, rows), folder=folder).collect()}
    version, two = sharding.newest_map(spark, folder)
    assert version == 3 and two == one and again == first
    # Rows that come move few of the others.
    more = rows + [(i, f"more {i} " * (i % 40)) for i in range(2000, 2150)]
    grown = sharding.shards(rows_of(spark, more), folder=folder).collect()
    checked(more, grown)
    moved = sum(r["shard"] != first[r["doc_id"]]["shard"] for r in grown if r["doc_id"] in first)
    assert moved < len(rows) / 5
    assert sharding.newest_map(spark, str(tmp_path / "none")) == (0, {})
