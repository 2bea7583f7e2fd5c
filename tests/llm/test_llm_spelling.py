from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from touchline.llm import spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(spelling.UPPER, spelling.LOWER))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def expected(counts):
    near = defaultdict(set)
    masks = defaultdict(set)
    for w in counts:
        for i in range(len(w) + 1):
            masks[(len(w), i, w[:i], w[i + 1 :])].add(w)
    for w in counts:
        for i in range(len(w)):
            near[w] |= masks[(len(w), i, w[:i], w[i + 1 :])] - {w}
            shorter = w[:i] + w[i + 1 :]
            if shorter in counts:
                near[w].add(shorter)
                near[shorter].add(w)
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 5 * n:
            forms[w] = best
    rows = []
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        rows.append((w, forms.get(w), root, n, len(near[w]), counts.get(forms.get(w))))
    return sorted(rows)


def got(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_given_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = expected(counted([tuple(r) for r in docs.collect()]))
    assert got(spelling.spelling(spark, "/root/testdata/sf0.01")) == rows
    assert any(r[1] for r in rows) and any(r[4] == 0 for r in rows)


def toy():
    rng = np.random.default_rng(7)
    words = {}
    for _ in range(400):
        # Few letters, runs of equal ones, so that one pair has many alignments.
        word = "".join(rng.choice(list("aab"), rng.integers(6, 12)))
        words[word] = int(rng.choice([5, 30, 160, 900]))
    for k, n in enumerate([5, 25, 125, 625, 3125, 15625]):
        words["chain" + "x" * k + "ed"] = n
    words |= {"é" * 6: 5, "é" * 7: 25, "zebras": 9, "zebraß": 9, "k" * 3000: 5, "k" * 2999 + "q": 6, "k" * 3001: 26, "÷×" * 3: 5}
    return words


def test_all_paths_match_brute_force(spark):
    words = toy()
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = expected(words)
    for settings in (spelling.Settings(), spelling.Settings(chunk=7, states=50)):
        assert got(spelling.variants(table, settings)) == rows
    pairs = [tuple(r) for r in spelling.near_words(table, spelling.Settings(chunk=5)).select("word", "near").collect()]
    assert len(pairs) == len(set(pairs)) == sum(r[4] for r in rows)
    chain = {r[0]: r[2] for r in rows}
    assert chain["chained"] == "chainxxxxxed"


def test_odd_documents(spark):
    word = "Ärger" + "Ab" * 40
    docs = [(i, f"{word} {word}x, ÜBER-MÄSSIG nothing×less ab1cdefgh " * 2) for i in range(40)]
    docs += [(None, "nothing " * 7), (None, None), (3, ""), (3, "!!! 12"), (5, "nothing"), (5, "nothing"), (6, "long" * 500 + " "), (7, ("long" * 500 + " ") * 5)]
    rows = expected(counted(docs))
    table = spark.createDataFrame([(*d, 1, "y") for d in docs], "doc_id long, text string, n int, word string")
    assert got(spelling.variants(spelling.vocabulary(table))) == rows and len(rows) > 4
    assert got(spelling.variants(spelling.vocabulary(table.limit(0)))) == []


def test_equal_right_languages_are_one_state():
    automaton = spelling.Acceptor()
    one = automaton.add(["talked", "talking", "walked", "walking"])
    states = len(automaton.arcs)
    assert automaton.add(["talked", "talking", "walked", "walking"]) == one and len(automaton.arcs) == states
    assert automaton.arcs[one]["t"] == automaton.arcs[one]["w"] and states == 9
