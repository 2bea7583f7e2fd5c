"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is a logistic function of the weights of its
words' features: the word itself and its beginnings. A document's probability is the noisy-or of its
sentences: one minus the product of what they leave. Only documents are labelled; the weights, which are never
below zero, are trained through the noisy-or, which puts the blame on the sentences that explain the labels.

Bounds of training: `sample_docs` labelled documents of each class, drawn by a hash of the row, of at most
`sample_chars` characters each; of their features, at most
`features`, those that toxic documents have more often. Classes
are weighted by their counts among all labelled rows. Every text is scored whole.

Defined results: a text without words, null or empty, scores 0, and so does every text if no row is labelled
or only one class is; a label other than 0 or 1, or null, is no label; a document with several labels is toxic if one says so;
rows that repeat get equal scores; no rows in, no rows out.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import body, remainder, row_key
from touchline.session import stored

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Settings:
    sample_docs: int = 3000
    sample_chars: int = 20_000
    beginnings: tuple[int, ...] = (3, 4, 5, 6)
    features: int = 1000
    least_docs: int = 4
    #: Standard errors by which a feature's share of toxic documents is above that of the others.
    least_strength: float = 3.5
    rounds: int = 300
    rate: float = 0.1
    shrink: float = 0.01
    seed: int = 7


def word_features(word: str, settings: Settings) -> list[str]:
    """The word, and its beginnings that are shorter than it."""
    return [word + "$", *(word[:n] for n in settings.beginnings if len(word) > n)]


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """(start, end, words) of every sentence that has words."""
    found = []
    for m in SENTENCE.finditer(text):
        words = WORD.findall(m[0].lower())
        if words:
            found.append((m.start(), m.end(), words))
    return found


class Weights(dict):
    """The weight of each word met, from the weights of features."""

    def __init__(self, model: dict[str, float], settings: Settings):
        self.model, self.settings = model, settings

    def __missing__(self, word: str) -> float:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = w = sum(self.model.get(f, 0.0) for f in word_features(word, self.settings))
        return w


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    settings: Settings

    def logits(self, bag: list[tuple[int, int, list[str]]], weights: Weights) -> np.ndarray:
        get = weights.__getitem__
        return np.array([sum(map(get, words)) for _, _, words in bag]) + self.bias


def left(z: np.ndarray) -> np.ndarray:
    """Log of what a sentence leaves: log(1 - sigmoid(z))."""
    return -np.logaddexp(0, z)


def train(texts: list[str], labels: np.ndarray, class_weight: np.ndarray, settings: Settings = Settings()) -> Model:
    """Adam on the documents' weighted log loss, with weights kept at or above zero and drawn towards it."""
    bags = [sentences(t) for t in texts]
    known: dict[str, list[str]] = {}
    docs_with: list[Counter] = [Counter(), Counter()]
    for bag, y in zip(bags, labels, strict=True):
        seen = set()
        for _, _, words in bag:
            for w in words:
                if w not in known:
                    known[w] = word_features(w, settings)
                seen.update(known[w])
        docs_with[y].update(seen)
    # Features that toxic documents have more often, by standard errors of the difference.
    n = np.maximum(np.bincount(labels, minlength=2), 1)
    strength = {}
    for f in docs_with[0].keys() | docs_with[1].keys():
        a, b = docs_with[0][f], docs_with[1][f]
        if a + b >= settings.least_docs:
            share = (a + b + 1) / (n.sum() + 2)
            z = (b / n[1] - a / n[0]) / np.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]))
            if z >= settings.least_strength:
                strength[f] = z
    chosen = sorted(strength, key=lambda f: (-strength[f], f))[: settings.features]
    place = {f: i for i, f in enumerate(chosen)}
    ids, of_sentence, of_doc = [], [], []
    ids_of = {w: [place[f] for f in fs if f in place] for w, fs in known.items()}
    for d, bag in enumerate(bags):
        for _, _, words in bag:
            own = [i for w in words for i in ids_of[w]]
            ids += own
            of_sentence += [len(of_doc)] * len(own)
            of_doc.append(d)
    ids, of_sentence, of_doc = np.array(ids, np.int64), np.array(of_sentence, np.int64), np.array(of_doc, np.int64)
    weight = class_weight[labels] / class_weight[labels].sum()
    w, bias = np.zeros(len(chosen) + 1), -4.0
    w[-1] = bias
    first, second = np.zeros_like(w), np.zeros_like(w)
    for turn in range(1, settings.rounds + 1):
        z = np.bincount(of_sentence, w[ids], minlength=len(of_doc)) + w[-1]
        remains = np.bincount(of_doc, left(z), minlength=len(texts))
        odds = np.exp(remains) / np.maximum(-np.expm1(remains), 1e-9)
        back = weight * np.where(labels == 1, -odds, 1.0)
        slope = back[of_doc] * np.exp(-np.logaddexp(0, -z))
        grad = np.append(np.bincount(ids, slope[of_sentence], minlength=len(chosen)), slope.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        rate = settings.rate * min(1.0, 2 * (1 - turn / (settings.rounds + 1)))
        w -= rate * first / (1 - 0.9**turn) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
        w[:-1] = np.maximum(w[:-1] - rate * settings.shrink, 0)
    return Model({f: float(v) for f, v in zip(chosen, w, strict=False) if v}, float(w[-1]), settings)


def fitted(docs: DataFrame, labels: DataFrame, learn: Column, settings: Settings = Settings()) -> Model | None:
    """A model of the labelled rows of `docs` where `learn` holds; None if they lack a class."""
    toxic = labels.filter(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    learnable = docs.filter(learn)
    rows = learnable.select("doc_id", row_key().alias("key"), F.length(body()).alias("chars")).join(toxic, "doc_id")
    rows = stored(rows.select("key", "chars", "toxic"), "toxicity-rows")
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return None
    fits = rows.filter(F.col("chars") <= settings.sample_chars)
    drawn = F.pmod(F.xxhash64("key", F.lit(settings.seed)), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, 1.5 * settings.sample_docs / counts[1])).otherwise(min(1.0, 1.5 * settings.sample_docs / counts[0]))
    sample = fits.withColumn("u", drawn).filter(F.col("u") < share)
    # Exactly the bound of each class, the least hashes first; only what is drawn is fetched as text.
    keys = {y: [r["key"] for r in sample.filter(F.col("toxic") == y).orderBy("u", "key").limit(settings.sample_docs).select("key").collect()] for y in (0, 1)}
    wanted = docs.sparkSession.createDataFrame([(k,) for k in {*keys[0], *keys[1]}], "key long")
    texts_of = learnable.select(row_key().alias("key"), body().alias("text")).join(F.broadcast(wanted), "key", "left_semi")
    text_of = {r["key"]: r["text"] for r in texts_of.dropDuplicates(["key"]).collect()}
    texts = [text_of[k] for y in (0, 1) for k in keys[y]]
    found = [y for y in (0, 1) for _ in keys[y]]
    if len(set(found)) < 2:
        return None
    drawn_of = np.bincount(found, minlength=2)
    return train(texts, np.array(found), np.array([counts[0], counts[1]]) / drawn_of, settings)


def scored(texts: list[str], model: Model | None, weights: Weights | None = None) -> list[tuple[float, int | None, int | None, float]]:
    """Probability of every text; start, end and probability of its worst sentence."""
    if model is None:
        return [(0.0, None, None, 0.0)] * len(texts)
    weights = Weights(model.weights, model.settings) if weights is None else weights
    found = []
    for text in texts:
        bag = sentences(text)
        if not bag:
            found.append((0.0, None, None, 0.0))
            continue
        z = model.logits(bag, weights)
        worst = int(z.argmax())
        p = -np.expm1(left(z).sum())
        found.append((min(1.0, max(0.0, float(p))), *bag[worst][:2], float(1 / (1 + np.exp(-z[worst])))))
    return found


def _scored(batches, model: Model | None):
    weights = Weights(model.weights, model.settings) if model else None
    kinds = [pa.float64(), pa.int32(), pa.int32(), pa.float64()]
    for batch in batches:
        found = scored(batch.column("text").to_pylist(), model, weights)
        columns = [pa.array(list(c), k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)] if found else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *columns], ["doc_id", "held_out", "score", "worst_start", "worst_end", "worst_score"])


def held_out(modulus: int = 5, value: int = 0) -> Column:
    return remainder("doc_id", modulus) == value


def scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted, and where each document's worst sentence stands (characters)."""
    rows = docs.select("doc_id", held_out().alias("held_out"), body().alias("text"))
    kinds = [f"doc_id {dict(rows.dtypes)['doc_id']}", "held_out boolean, score double, worst_start int, worst_end int, worst_score double"]
    found = rows.mapInArrow(partial(_scored, model=model), ", ".join(kinds))
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst_start", "worst_end", "worst_score")


def toxicity(spark, sf_dir: str) -> DataFrame:
    """Query: the toxicity of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scores(docs, fitted(docs, labels, ~held_out()))
