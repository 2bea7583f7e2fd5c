from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from touchline.llm import near_dedup
from touchline.llm.components import components


def shingles(text, width=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows):
    """Least id of each row's class."""
    texts = sorted({t or "" for _, t in rows})
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
            root[find(i)] = find(j)
    least = {}
    for i, t in rows:
        r = find(texts.index(t or ""))
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return Counter((i, least.get(find(texts.index(t or "")))) for i, t in rows)


def planted(seed, words=60, groups=12, copies=9):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(words)] = "changed"
            rows.append((n, " ".join(text)))
            n += 1
    return rows


def got(found):
    return Counter((r["doc_id"], r["class_id"]) for r in found.collect())


def test_given_documents_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = near_dedup.near_dedup(spark, sf_dir)
    assert Counter((r["doc_id"], r["class_id"]) for r in found.collect()) == brute([tuple(r) for r in docs])


def test_planted_copies_match_brute_force_on_every_path(spark):
    rows = planted(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert got(near_dedup.classes(docs)) == want
    # Bands cut into many small chunks.
    assert got(near_dedup.classes(docs, near_dedup.Settings(chunk=2))) == want
    assert got(near_dedup.classes(docs, near_dedup.Settings(chunk_chars=1500))) == want


def test_a_hot_group_of_copies(spark):
    base = " ".join(f"word{i}" for i in range(80))
    rows = [(i, base) for i in range(300)] + [(300 + i, f"{base} tail{i}") for i in range(150)] + [(1000 + i, f"own text {i} " * 9) for i in range(200)]
    found = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(found) == brute(rows)


def test_a_copy_that_repeats_a_line_many_times(spark):
    rng = random.Random(11)
    rows = []
    for n, (words, line, times) in enumerate([(64, 10, 100), (64, 10, 20), (200, 30, 50), (120, 20, 300)] * 15):
        base = " ".join(f"g{n}x{rng.randrange(10**6)}" for _ in range(words))
        repeated = " ".join(f"g{n}y{i}" for i in range(line))
        rows += [(2 * n, base), (2 * n + 1, " ".join([base, *[repeated] * times]))]
    want = brute(rows)
    assert sum(i != c for i, c in want) == 60
    assert got(near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_the_least_probability_jaccard_of_a_pair_at_the_threshold():
    settings = near_dedup.Settings()
    least = settings.threshold / settings.heaviest
    assert (1 - least**settings.rows) ** settings.bands < 5e-5


def test_shingles_and_similarity_are_exact():
    texts = ["", "a", "A b", "!!!", "İstanbul Straße ΣΑΣ x y z ÑÑ", "a b c d e a b c d e a b c d e", "\U0001d54f a_b c d e f", "one two three four five six seven"]
    doc, item, count = near_dedup.shingles(texts, 5)
    assert np.bincount(doc, minlength=len(texts)).tolist() == [len(shingles(t)) for t in texts]
    assert count[doc == 5].tolist().count(3) == 1
    many = texts + [t for _, t in planted(3, copies=4)]
    want = [[len(a & b) / len(a | b) if a and b else 0 for b in map(shingles, many)] for a in map(shingles, many)]
    apart = ~np.eye(len(many), dtype=bool)
    for columns in (7, 4096):
        assert np.allclose(near_dedup.similarities(many, 5, columns)[apart], np.array(want)[apart], atol=1e-6)
    assert near_dedup.similarities([], 5).shape == (0, 0)


def test_forest():
    link = np.zeros((6, 6), bool)
    for a, b in [(5, 3), (3, 4), (1, 2)]:
        link[a, b] = link[b, a] = True
    assert near_dedup.forest(link).tolist() == [0, 1, 1, 3, 3, 3]


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(5)
    items = rng.integers(1, 2**48, 300).astype(np.uint64)
    x = {int(i): 1.0 + (k % 3) for k, i in enumerate(items[:200])}
    y = {int(i): 1.0 + (k % 2) for k, i in enumerate(items[80:])}
    want = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())
    doc = np.array([0] * len(x) + [1] * len(y))
    item = np.array([*x, *y], np.uint64)
    weight = np.array([*x.values(), *y.values()])
    a, b = near_dedup.prob_minhash(doc, item, weight, 2, 4000, 3)
    assert abs((a == b).mean() - want) < 0.03


def test_odd_inputs_and_the_stage(spark):
    long = "very long text with many words " * 20_000
    rows = [(1, None), (2, ""), (3, "!!"), (4, "??"), (5, "same text"), (5, "same text"), (6, "Same, TEXT."), (None, long), (7, long), (None, None), (8, "a b c d e f g h"), (8, "other words than that one here now")]
    full = [(i, t, f"n{k % 2}", k) for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(full, "doc_id long, text string, node string, class_id int")
    assert got(near_dedup.classes(docs)) == brute(rows)
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    classes = defaultdict(list)
    for (i, c), n in brute(rows).items():
        classes[c] += [i] * n
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 3, 4, 5, 7, 8, 8])
    assert near_dedup.classes(docs.limit(0)).collect() == [] and near_dedup.deduplicated(docs.limit(0)).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7), (300, 301), (301, 300)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(1, 41)) and found[200] == found[150] == 100 and found[301] == 300 and len(found) == 43
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_do_not_depend_on_the_pieces():
    texts = ["", "one two-three ὈΔΥΣΣΕΎΣ, four " * 50, "x" * 400, "  . ", "five_six seven " * 9, "end"]
    whole, counts = near_dedup.word_hashes(texts, 1 << 30)
    for chars in (1, 7, 64, 501):
        found, of = near_dedup.word_hashes(texts, chars)
        assert np.array_equal(found, whole) and np.array_equal(of, counts)
    assert counts.tolist() == [0, 250, 1, 0, 27, 1]


def test_a_signature_that_cannot_be_filled_is_refused():
    one = np.zeros(2, np.int64)
    with pytest.raises(ValueError):
        near_dedup.prob_minhash(one, np.arange(2, dtype=np.uint64), np.ones(2), 1, 1 << 21, 1)


def test_alike_sets_are_at_most_one_level_apart():
    for threshold in (0.5, 0.8, 0.95):
        for size in [*range(1, 3000), 10**6, 10**9]:
            assert near_dedup.level(size, threshold) - near_dedup.level(math.ceil(size * (threshold - 1e-6)), threshold) <= 1


def hot_band(spark, texts, chunk):
    """Members of one band, its blocks, and pairs of texts that some block compares, counted once a block."""
    settings = near_dedup.Settings(chunk=chunk)
    rows = [(n, len(t), near_dedup.level(len(shingles(t)), settings.threshold), 1) for n, t in enumerate(texts)]
    entries = spark.createDataFrame(rows, "node long, chars long, level int, key long")
    blocks = defaultdict(list)
    for r in near_dedup.blocks_of(near_dedup.shared(entries, settings), settings).collect():
        blocks[r["key"], r["i"], r["j"]].append(r["node"])
    return list(blocks.values())


def test_a_hot_band_of_many_lengths_is_not_compared_in_all_pairs(spark):
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(int(6 * 1.0045**n))) for n in range(1600)]
    blocks = hot_band(spark, texts, 16)
    met = {(a, b) for block in blocks for a in block for b in block if a < b}
    sizes = [len(shingles(t)) for t in texts]
    # Every pair that can be alike meets.
    assert all((a, b) in met for a in range(len(texts)) for b in range(a + 1, len(texts)) if min(sizes[a], sizes[b]) >= 0.8 * max(sizes[a], sizes[b]))
    assert len(met) < len(texts) ** 2 / 10
    # Nor is a block larger than two chunks of random filling, or a pair met in blocks without end.
    assert max(map(len, blocks)) <= 4 * 16


def test_small_bands_and_one_length_meet_whole(spark):
    for count, words in ((2, 9), (20, 9), (33, 9), (100, 9)):
        blocks = hot_band(spark, [f"{n} " * words for n in range(count)], 16)
        met = {(a, b) for block in blocks for a in block for b in block if a < b}
        assert len(met) == count * (count - 1) // 2


def test_levels_of_a_hot_band_match_brute_force(spark):
    rng = random.Random(8)
    head = [f"h{i}" for i in range(40)]
    rows = []
    for n in range(160):
        words = head + [f"t{i}" for i in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"c{n}"
        rows.append((n, " ".join(words)))
    want = brute(rows)
    for chunk in (4, 512):
        assert got(near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string"), near_dedup.Settings(chunk=chunk))) == want
