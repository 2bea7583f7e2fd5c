"""Language ID by a small convolutional network over bytes.

A text's UTF-8 bytes are cut into windows of fixed length that overlap by a filter's width. Bytes are
embedded; filters of several widths slide over a window, each keeps its greatest answer, and a softmax
layer turns the answers into log probabilities. A text's log probabilities are the means over all its
windows. The network is trained in numpy, on windows of a bounded sample of labelled rows.

Bounds of the sample: `sample_total` documents in all, dealt evenly over the labels, `sample_docs` for one
label at most, taken by a hash of the row, and `sample_windows` windows of each. So up to `sample_total`
labels can be learned; if there are more, the most frequent ones are.

Defined results: a text that is null or has no letter gets `und` with score 0, and so does every text
if no row is labelled; rows that repeat get equal answers; no rows in, no rows out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from touchline.llm.common import body, bounded_batches, free_name, portions, remainder, row_key

WORDLIKE = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
PAD = 256


@dataclass(frozen=True)
class Settings:
    window: int = 64
    embedding: int = 8
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 8
    sample_total: int = 40_000
    sample_docs: int = 400
    sample_windows: int = 8
    epochs: int = 8
    batch: int = 64
    rate: float = 0.01
    seed: int = 11

    @property
    def widest(self) -> int:
        return max(self.widths)

    @property
    def stride(self) -> int:
        return self.window - self.widest + 1


@dataclass
class Network:
    labels: list[str]
    embed: np.ndarray
    kernel: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    settings: Settings

    def spans(self, windows: np.ndarray) -> np.ndarray:
        """Embedded bytes below each place of the widest filter: (windows, places, widest * embedding)."""
        wide = self.settings.widest
        e = self.embed[windows]
        view = np.lib.stride_tricks.sliding_window_view(e, wide, axis=1)
        return np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(len(windows), e.shape[1] - wide + 1, -1)

    def log_probs(self, windows: np.ndarray) -> np.ndarray:
        found = []
        for i in range(0, len(windows), 256):
            spans = self.spans(windows[i : i + 256])
            answer = spans.reshape(-1, spans.shape[2]) @ self.kernel
            top = np.maximum(answer.reshape(*spans.shape[:2], -1).max(axis=1) + self.shift, 0)
            z = top @ self.out + self.bias
            z -= z.max(axis=1, keepdims=True)
            found.append(z - np.log(np.exp(z).sum(axis=1, keepdims=True)))
        return np.concatenate(found) if found else np.zeros((0, len(self.labels)))


def cut(data: bytes, settings: Settings) -> np.ndarray:
    """All windows of a text, the last one padded."""
    count = max(1, -(-(len(data) - settings.widest + 1) // settings.stride))
    flat = np.full((count - 1) * settings.stride + settings.window, PAD, np.int16)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, settings.window)[:: settings.stride]


def has_letter(text: str | None) -> bool:
    """Numerals such as ½ or Ⅷ match as letters do in a pattern, but are none."""
    return any(any(map(str.isalpha, run.group())) for run in WORDLIKE.finditer(text or ""))


def _mask(settings: Settings) -> np.ndarray:
    """1 where a filter of a narrower width has weights within the widest one's span."""
    parts = []
    for width in settings.widths:
        part = np.zeros((settings.widest, settings.embedding, settings.filters), np.float32)
        part[:width] = 1
        parts.append(part.reshape(-1, settings.filters))
    return np.concatenate(parts, axis=1)


def train(windows: np.ndarray, target: np.ndarray, labels: list[str], settings: Settings) -> Network:
    """Adam on the softmax loss, by backpropagation through the greatest answer of each filter."""
    rng = np.random.default_rng(settings.seed)
    mask = _mask(settings)
    width, filters = mask.shape
    net = Network(
        labels,
        rng.normal(0, 0.5, (PAD + 1, settings.embedding)).astype(np.float32),
        (rng.normal(0, 1, mask.shape) / np.sqrt(width) * mask).astype(np.float32),
        np.zeros(filters, np.float32),
        (rng.normal(0, 1, (filters, len(labels))) / np.sqrt(filters)).astype(np.float32),
        np.zeros(len(labels), np.float32),
        settings,
    )
    weights = ["embed", "kernel", "shift", "out", "bias"]
    first = {k: np.zeros_like(getattr(net, k)) for k in weights}
    second = {k: np.zeros_like(getattr(net, k)) for k in weights}
    turn = 0
    for epoch in range(settings.epochs):
        rate = settings.rate * (1 - epoch / settings.epochs)
        order = rng.permutation(len(windows))
        for i in range(0, len(order), settings.batch):
            at = order[i : i + settings.batch]
            x, n = windows[at].astype(np.int64), len(at)
            spans = net.spans(x)
            answer = spans.reshape(-1, width) @ net.kernel
            answer = answer.reshape(n, -1, filters)
            place = answer.argmax(axis=1)
            top = np.take_along_axis(answer, place[:, None], 1)[:, 0] + net.shift
            hidden = np.maximum(top, 0)
            z = hidden @ net.out + net.bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), target[at]] -= 1
            p /= n
            back = (p @ net.out.T) * (top > 0)
            taken = spans[np.arange(n)[:, None], place]
            grad = {"out": hidden.T @ p, "bias": p.sum(0), "shift": back.sum(0)}
            grad["kernel"] = np.einsum("nfw,nf->wf", taken, back) * mask
            to_span = back[:, :, None] * net.kernel.T[None]
            byte = x[np.arange(n)[:, None, None], place[:, :, None] + np.arange(settings.widest)]
            grad["embed"] = np.zeros_like(net.embed)
            np.add.at(grad["embed"], byte.reshape(-1), to_span.reshape(-1, settings.embedding))
            turn += 1
            for k in weights:
                first[k] = 0.9 * first[k] + 0.1 * grad[k]
                second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
                step = first[k] / (1 - 0.9**turn) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)
                setattr(net, k, (getattr(net, k) - rate * step).astype(np.float32))
    return net


def _sampled_windows(batches, settings: Settings):
    for batch in batches:
        labels, cuts = [], []
        for label, key, text in zip(*(batch.column(c).to_pylist() for c in ("label", "key", "text")), strict=True):
            data = (text or "").encode("utf-8", "replace")
            if not has_letter(text):
                continue
            windows = cut(data, settings)
            rng = np.random.default_rng(key & 0x7FFFFFFF)
            for i in rng.permutation(len(windows))[: settings.sample_windows]:
                labels.append(label)
                cuts.append(windows[i].astype("<i2").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(cuts, pa.binary())], ["label", "cut"])


def fitted(docs: DataFrame, learn: Column, settings: Settings = Settings()) -> Network | None:
    """A network trained on rows where `learn` holds and lang is not null; None if there are none."""
    rows = docs.filter(learn & F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("label"), row_key().alias("key"), "text")
    counts = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(settings.sample_total).collect()
    if not counts:
        return None
    each = min(settings.sample_docs, settings.sample_total // len(counts))
    shares = docs.sparkSession.createDataFrame([(r["label"], min(1.0, 2.0 * each / r["count"])) for r in counts], "label string, share double")
    # About twice the wanted rows by a hash of the row, then exactly the wanted number of them.
    drawn = (F.pmod(F.xxhash64("key", F.lit(settings.seed)), F.lit(1 << 30)) / float(1 << 30)).alias("u")
    sample = rows.join(F.broadcast(shares), "label").select("label", "key", "text", drawn, "share").filter("u < share")
    sample = sample.withColumn("place", F.row_number().over(Window.partitionBy("label").orderBy("u", "key")))
    sample = sample.filter(F.col("place") <= each).select("label", "key", "text")
    pairs = sample.mapInArrow(partial(_sampled_windows, settings=settings), "label string, cut binary").collect()
    if not pairs:
        return None
    pairs.sort(key=lambda r: (r["label"], bytes(r["cut"])))
    labels = sorted({r["label"] for r in pairs})
    windows = np.stack([np.frombuffer(r["cut"], "<i2") for r in pairs])
    return train(windows, np.array([labels.index(r["label"]) for r in pairs]), labels, settings)


def answers(texts: list[str | None], net: Network | None) -> tuple[list[str], list[float]]:
    """Label and probability of every text."""
    labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if net is None:
        return labels, scores
    for a, b in portions([t or "" for t in texts], 1_000_000):
        at = [i for i in range(a, b) if has_letter(texts[i])]
        if not at:
            continue
        windows = [cut(texts[i].encode("utf-8", "replace"), net.settings) for i in at]
        counts = np.array([len(w) for w in windows])
        found = net.log_probs(np.concatenate(windows))
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        means = np.add.reduceat(found, starts, axis=0) / counts[:, None]
        means -= means.max(axis=1, keepdims=True)
        p = np.exp(means)
        p /= p.sum(axis=1, keepdims=True)
        for i, best, row in zip(at, p.argmax(axis=1), p, strict=True):
            labels[i], scores[i] = net.labels[best], min(1.0, float(row[best]))
    return labels, scores


def _answered(batches, net: Network | None, text: str, label: str, score: str):
    for batch in batches:
        labels, scores = answers(batch.column(text).to_pylist(), net)
        arrays = [*batch.columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
        yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, label, score])


def identified(docs: DataFrame, net: Network | None, text: str = "text", label: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the predicted label and its probability behind its own columns."""
    bounded_batches(docs.sparkSession)
    schema = StructType([*docs.schema.fields]).add(label, "string").add(score, "double")
    return docs.mapInArrow(partial(_answered, net=net, text=text, label=label, score=score), schema)


def held_out(modulus: int = 3, value: int = 1) -> Column:
    return remainder("doc_id", modulus) == value


def with_language(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The columns of `docs` but those whose text is in no language: null, or without a letter."""
    net = fitted(docs, ~held_out(), settings)
    label, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = identified(docs, net, "text", label, score)
    return found.filter(F.col(label) != UNKNOWN).drop(label, score)


def language(spark, sf_dir: str) -> DataFrame:
    """Query: the predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    net = fitted(docs, ~held_out())
    rows = docs.select("doc_id", held_out().alias("held_out"), body().alias("text"))
    return identified(rows, net).select("doc_id", "held_out", "lang_pred", "score")
