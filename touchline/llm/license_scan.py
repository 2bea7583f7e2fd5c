"""License scan by MinHash bands over overlapping text windows.

Templates and texts are cut into windows of tokens, in lower case, of a length that fits the template:
short notices use windows of one shingle (five tokens, or the whole notice if it has fewer) at every place,
whose MinHash is that shingle, so that a text which holds any shingle of a notice is retrieved with certainty.
Long templates use windows of 16 tokens; the text's start at every eighth token, the template's at every
token, so some window of a copied passage always lies on a template's window. Each long window has `bands`
bands of one MinHash: two windows with resemblance J meet with probability 1 - (1 - J)^bands, 0.9984 at
J = 0.8 with four.

A retrieved notice is verified by exact shingle containment. All its shingles in the text are laid on their
diagonals, which tell the copies apart, and a copy counts if it holds enough of the notice's shingles.

Only DataFrame operations are used. The templates' marks are broadcast if their counted rows are within a bound.

Defined results: null and empty texts hold no notice; rows that repeat give one result; a notice that occurs
several times in a text counts its occurrences and shows the best, the first of equals; no rows in, none out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import WORD_BREAK, body, small, text_key
from touchline.session import stored

# Notices as they are published.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "gpl-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "apache-2.0-grant": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "bsd-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED "
        "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies."
    ),
    "apache-2.0-disclaimer": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "lgpl-grant": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by "
        "the Free Software Foundation"
    ),
    "agpl-grant": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by "
        "the Free Software Foundation"
    ),
    "gpl-disclaimer": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
        "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "mpl-2.0-grant": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You "
        "can obtain one at"
    ),
    "unlicense-grant": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


@dataclass(frozen=True)
class Settings:
    width: int = 5
    window: int = 16
    stride: int = 8
    bands: int = 4
    #: Templates of at least so many tokens are long.
    long: int = 20
    containment: float = 0.8
    broadcast_rows: int = 1_000_000


def hashed(text: Column, whole: bool = False) -> Column:
    words = F.split(F.lower(text), WORD_BREAK)
    return F.transform(F.filter(words, lambda w: w != "") if whole else words, lambda w: F.xxhash64(w))


def _pairs(left: str, right: str, apart: int, size: Column) -> Column:
    """Hashes of left[i] and right[i + apart], for every i below `size`."""
    return F.zip_with(F.slice(left, 1, size), F.slice(right, apart + 1, size), lambda x, y: F.xxhash64(x, y))


def with_runs(rows: DataFrame, widths: list[int], tokens: str = "h") -> DataFrame:
    """`rows` with a column s<width> of shingles, none if there are fewer tokens than a shingle has.

    A shingle's hash is put together from those of its parts, one token or pair at a time.
    """
    done = rows.withColumn("s1", F.col(tokens))
    for w in range(2, max(widths, default=1) + 1):
        size = F.greatest(F.size(tokens) - (w - 1), F.lit(0))
        done = done.withColumn(f"s{w}", _pairs(f"s{w - 1}", tokens, w - 1, size))
    return done.select(*rows.columns, *[f"s{w}" for w in widths])


def _seeded(seed: int) -> Callable[[Column], Column]:
    return lambda x: F.xxhash64(x, F.lit(seed))


def _of_width(widths: list[int]) -> Column:
    """The shingles of a row's own `width`."""
    return F.coalesce(*[F.when(F.col("width") == w, F.col(f"s{w}")) for w in widths])


def _windows(step: int, settings: Settings) -> Column:
    """Band keys of the long windows of the shingles s<width>, whose minima come from m0, m1, ...

    A text shorter than a window is one window; the last window ends where the text does.
    """
    inner = settings.window - settings.width + 1
    last = F.greatest(F.size(f"s{settings.width}") - inner, F.lit(0))
    places = F.array_union(F.sequence(F.lit(0), last, F.lit(step)), F.array(last))

    def keys(i: Column) -> Column:
        return F.array(*[F.xxhash64(F.array_min(F.slice(f"m{s}", i + 1, inner)), F.lit(s)) for s in range(settings.bands)])

    found = F.flatten(F.transform(places, keys))
    return F.when(F.size(f"s{settings.width}") > 0, found).otherwise(F.array().cast("array<long>"))


def keyed(rows: DataFrame, widths: list[int], single: bool, long: bool, step: int, settings: Settings, *keep: str) -> DataFrame:
    """`keep`, place and key of all windows of the rows' shingles s<width>: those of one shingle, and long ones.

    All keys of a row come from one array. The explode is an outer one: for a plain one the optimizer computes
    its array once more, for a filter at the scan. A row without a key meets nothing.
    """
    parts, place, before = [], None, F.lit(0)
    n = F.col("n")
    if long:
        minima = [F.transform(f"s{settings.width}", _seeded(s)).alias(f"m{s}") for s in range(settings.bands)]
        rows = rows.select("*", *minima)
    sizes = {f"n{w}": F.size(f"s{w}") for w in widths}
    for w in widths if single else []:
        parts.append(F.col(f"s{w}"))
        here = F.when(n < before + F.col(f"n{w}"), n - before)
        place = here if place is None else F.coalesce(place, here)
        before = before + F.col(f"n{w}")
    if long:
        parts.append(_windows(step, settings))
        inner = settings.window - settings.width + 1
        at = F.least(F.floor((n - before) / settings.bands) * step, F.greatest(F.col(f"n{settings.width}") - inner, F.lit(0)))
        place = at if place is None else F.coalesce(place, at)
    found = rows.select(*keep, *[c.alias(k) for k, c in sizes.items()], F.posexplode_outer(F.concat(*parts)).alias("n", "key"))
    return found.select(*keep, place.cast("int").alias("place"), "key")


def scan(docs: DataFrame, templates: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(node, license, occurrences, start, containment): the notices that each text holds.

    templates: license, template. node is the text's key, start the token at which the best occurrence begins.
    """
    notices = templates.select("license", hashed(body("template"), whole=True).alias("t")).filter(F.size("t") > 0)
    notices = notices.withColumn("width", F.least(F.size("t"), F.lit(settings.width))).withColumn("tokens", F.size("t"))
    widths = sorted(r[0] for r in notices.select("width").distinct().collect())
    if not widths:
        return docs.sparkSession.createDataFrame([], "node long, license string, occurrences long, start int, containment double")
    notices = with_runs(notices, widths, "t").withColumn("all", _of_width(widths))
    once = F.filter("all", lambda x: F.size(F.filter("all", lambda y: y == x)) == 1)
    notices = notices.select("license", "t", "width", "tokens", "all", F.array_distinct("all").alias("own"), once.alias("single"))
    notices = stored(notices, "license-templates")
    texts = docs.select(text_key().alias("node"), body().alias("text"))
    tokens = texts.select(F.col("node").alias("id"), hashed(F.col("text")).alias("h"))
    tokens = with_runs(tokens, widths).drop("h")
    short, long = F.col("tokens") < settings.long, F.col("tokens") >= settings.long
    notices_by_width = with_runs(notices.select("license", "t", "tokens"), widths, "t")
    own = F.col("width")
    marks = None
    for w in widths:
        rows = with_runs(notices.filter(short & (own == w)).select("license", "t"), [w], "t")
        found = keyed(rows, [w], True, False, 1, settings, "license")
        marks = found if marks is None else marks.union(found)
    has_long = settings.width in widths
    if has_long:
        rows = notices_by_width.filter(long)
        marks = marks.union(keyed(rows, [settings.width], False, True, 1, settings, "license"))
    marks = stored(marks.filter(F.col("key").isNotNull()).select("license", "key").distinct(), "license-marks")
    count = marks.count()
    found = keyed(tokens, widths, True, has_long, settings.stride, settings, "id")
    hits = found.join(small(marks, count, settings.broadcast_rows), "key")
    hits = stored(hits.select(F.col("id").alias("node"), "license").distinct(), "license-hits")
    # One copy of each text that has a hit.
    texts = texts.join(hits.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    laid = hits.join(texts.select("node", hashed(F.col("text")).alias("h")), "node")
    laid = laid.join(small(notices.select("license", "own", "all", "single", "width", "tokens"), notices.count(), settings.broadcast_rows), "license")
    found = placed_copies(laid.withColumnRenamed("h", "tokens_of"), widths, settings)
    best = F.max(F.struct("containment", (-F.col("start")).alias("at")))
    found = found.groupBy("node", "license").agg(F.count("*").alias("occurrences"), best.alias("best"))
    return found.select("node", "license", "occurrences", (-F.col("best.at")).alias("start"), F.col("best.containment").alias("containment"))


def placed_copies(laid: DataFrame, widths: list[int], settings: Settings) -> DataFrame:
    """(node, license, start, containment) of every copy of a notice in a text that may hold it.

    A shingle of the notice at token p of the text and token q of the notice lies on diagonal p - q, the place
    where the notice would begin. Along the text the diagonals of one copy stay together, and those of
    the next copy are a notice's length further; so a step of half that length begins a new copy. Shingles that
    the notice has several times do not tell a diagonal and belong to the copy at hand.
    """
    shingled = with_runs(laid, widths, "tokens_of").withColumn("near", _of_width(widths))

    def place(x: Column, p: Column) -> Column:
        q = F.array_position("all", x)
        return F.when(q > 0, F.struct(p.alias("p"), (p - q + 1).cast("int").alias("d"), x.alias("x")))

    places = F.filter(F.transform("near", place), lambda s: s.isNotNull())
    rows = shingled.select("node", "license", "tokens", F.size("own").alias("parts"), "single", F.explode_outer(places).alias("s"))
    rows = rows.filter("s IS NOT NULL").select("node", "license", "tokens", "parts", "s.*", F.array_contains("single", F.col("s.x")).alias("tells"))
    text = Window.partitionBy("node", "license").orderBy("p")
    told = F.last(F.when(F.col("tells"), F.col("d")), ignorenulls=True).over(text.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("new", (F.col("tells") & (2 * (F.col("d") - told) >= F.col("tokens"))).cast("int"))
    rows = rows.withColumn("copy", F.sum(F.coalesce("new", F.lit(0))).over(text))
    start = F.coalesce(F.min(F.when(F.col("tells"), F.col("d"))), F.min("d"))
    copies = rows.groupBy("node", "license", "copy", "parts").agg(F.count_distinct("x").alias("held"), F.greatest(start, F.lit(0)).alias("start"))
    copies = copies.withColumn("containment", F.col("held") / F.col("parts"))
    return copies.filter(F.col("containment") >= settings.containment - 1e-12).select("node", "license", "start", "containment")


def licenses(docs: DataFrame, templates: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, license, occurrences, start, containment of every document that holds a notice."""
    found = stored(scan(docs, templates, settings), "license-found")
    return docs.select("doc_id", text_key().alias("node")).distinct().join(found, "node").select("doc_id", "license", "occurrences", "start", "containment")


def template_table(spark) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "license string, template string")


def license_scan(spark, sf_dir: str) -> DataFrame:
    """Query: every notice that a document holds."""
    return licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"), template_table(spark))
