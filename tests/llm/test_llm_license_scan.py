from __future__ import annotations

import re

from touchline.llm import license_scan

MIT = license_scan.TEMPLATES["mit-grant"]


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(words, width):
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(texts):
    """Containment of every notice in any stretch as long as the scan looks at."""
    found = {}
    for i, text in texts:
        words = tokens(text)
        for name, template in license_scan.TEMPLATES.items():
            t = tokens(template)
            width = min(5, len(t))
            own = shingles(t, width)
            best = max((len(own & shingles(words[k : k + 2 * len(t) + 16], width)) / len(own) for k in range(max(1, len(words)))), default=0)
            if best >= 0.8:
                found[(i, name)] = best
    return found


def test_given_documents_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {(r["doc_id"], r["license"]): r["containment"] for r in license_scan.license_scan(spark, sf_dir).collect()}
    small = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if len(r["text"]) < 3000]
    want = brute(small)
    ids = {i for i, _ in small}
    assert {k: v for k, v in found.items() if k[0] in ids} == want and want


def test_edited_cut_and_missing_notices(spark):
    words = MIT.split()
    changed = " ".join([*words[:3], "XXX", *words[4:]])
    texts = [
        (1, "before " * 37 + MIT + " after" * 9), (2, changed), (3, " ".join(words[: len(words) // 2])), (4, None), (5, ""), (6, "Rights reserved, all."),
        (7, "x ALL RIGHTS RESERVED. y"), (8, "nothing here " * 5000 + MIT + MIT), (8, "nothing here " * 5000 + MIT + MIT), (None, MIT),
    ]
    docs = spark.createDataFrame([(i, t, "z") for i, t in texts], "doc_id long, text string, license string")
    templates = license_scan.template_table(spark)
    rows = license_scan.licenses(docs, templates).collect()
    found = {(r["doc_id"], r["license"]): r for r in rows}
    assert set(found) == {(1, "mit-grant"), (2, "mit-grant"), (7, "all-rights-reserved"), (8, "mit-grant"), (None, "mit-grant")} and len(rows) == 5
    assert found[(1, "mit-grant")]["start"] == 37 and found[(1, "mit-grant")]["containment"] == 1.0
    assert 0.8 <= found[(2, "mit-grant")]["containment"] < 1
    assert license_scan.licenses(docs.limit(0), templates).collect() == []
    assert license_scan.licenses(docs, templates.limit(0)).collect() == []


def counted(text, name):
    """Copies of a notice by reading on behind each one that is found whole."""
    words, notice = tokens(text), tokens(license_scan.TEMPLATES[name])
    at, starts = 0, []
    while at <= len(words) - len(notice):
        if words[at : at + len(notice)] == notice:
            starts.append(at)
            at += len(notice)
        else:
            at += 1
    return len(starts), starts[0]


def test_copies_side_by_side_are_counted(spark):
    cases = []
    for name, template in license_scan.TEMPLATES.items():
        cases += [(name, (template + " ") * n) for n in (1, 2, 5)]
        cases += [(name, f"three words before {template} and {template} {template} then " + "more " * 300 + template)]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(cases)], "doc_id long, text string")
    rows = license_scan.licenses(docs, license_scan.template_table(spark)).collect()
    found = {(r["doc_id"], r["license"]): (r["occurrences"], r["start"]) for r in rows}
    for i, (name, text) in enumerate(cases):
        assert found[(i, name)] == counted(text, name), (name, text[:80])
    # Grants of a family hold most of one another; only one is whole.
    assert {(r["doc_id"], r["license"]) for r in rows if r["containment"] == 1} == {(i, name) for i, (name, _) in enumerate(cases)}


def test_edited_copies_keep_their_places(spark):
    words = MIT.split()
    cut, grown = " ".join(words[:1] + words[2:]), " ".join([*words[:12], "very", *words[12:]])
    docs = spark.createDataFrame([(1, f"a b {cut} {grown} c {MIT}"), (2, f"{' '.join(words[:14])} {' '.join(words[14:])} {' '.join(words[14:])}")], "doc_id long, text string")
    rows = {(r["doc_id"], r["license"]): r for r in license_scan.licenses(docs, license_scan.template_table(spark)).collect()}
    assert rows[(1, "mit-grant")]["occurrences"] == 3 and rows[(1, "mit-grant")]["start"] == 2 + len(words) - 1 + len(words) + 1 + 1
    assert rows[(2, "mit-grant")]["occurrences"] == 1 and rows[(2, "mit-grant")]["start"] == 0


def test_the_main_path_has_no_python(spark, sf_dir):
    plan = license_scan.license_scan(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
