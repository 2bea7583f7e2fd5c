"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered whole, every turn as `<s>` role `<t>` text `</s>`, and encoded once with the
character offsets of its tokens. The spans of the turns and the spans of the tokens both rise, so the
tokens of a turn are found by binary search: from the first that ends behind its start to the last that
starts before its end. Tokens of assistant texts are under the loss mask. The three marks are special tokens
of their own, so a turn's border is always a token's border.

Control strings inside roles and texts are escaped: a backslash goes behind their first character, one
more if there are some already, and reading takes one away; so every text comes back as it was.

Rows are dealt by conversation and sorted, and read as a stream. A conversation of more than `piece_chars`
is rendered in several pieces, cut between turns, so memory does not grow with it.

Defined results: null roles and texts are empty; turns of equal number are ordered by role and text; a null
conversation id is one conversation; null turns come first; no rows in, none out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
OPEN, TEXT, CLOSE = "<s>", "<t>", "</s>"
#: The template's marks, and those of other chat templates and tokenizers.
CONTROL = [OPEN, TEXT, CLOSE, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|startoftext|>", "<|im_start|>", "<|im_end|>", "<unk>", "<pad>"]
ESCAPE = re.compile("|".join(re.escape(c[0]) + r"(\\*)" + re.escape(c[1:]) for c in CONTROL))


@dataclass(frozen=True)
class Settings:
    #: Path of the tokenizer's file on the driver; it is sent to the executors.
    tokenizer: str = TOKENIZER
    trained_role: str = "assistant"
    piece_chars: int = 4_000_000


def escape(text: str) -> str:
    return ESCAPE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPE.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]], list[str]]:
    """The formatted text, the span of each turn's text in it, and the roles."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, shown = OPEN + escape(role) + TEXT, escape(text)
        spans.append((at + len(head), at + len(head) + len(shown)))
        parts += [head, shown, CLOSE]
        at = spans[-1][1] + len(CLOSE)
    return "".join(parts), spans, [role for role, _ in turns]


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts back from the formatted text."""
    turns = []
    for part in formatted.split(CLOSE)[:-1]:
        role, _, text = part.removeprefix(OPEN).partition(TEXT)
        turns.append((unescape(role), unescape(text)))
    return turns


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens, of rising spans, meet one of the rising `spans`."""
    mask = np.zeros(len(starts), bool)
    if spans:
        a, b = np.array(spans).T
        first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b, side="left")
        for i, j, filled in zip(first, last, b > a, strict=True):
            if filled:
                mask[i:j] = True
    return mask


def masked_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The unescaped text of every run of tokens under the mask."""
    edge = np.flatnonzero(np.diff(np.asarray(mask, bool), prepend=False, append=False))
    return [unescape(formatted[int(starts[a]) : int(np.max(ends[a:b]))]) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def load(data: str):
    """The tokenizer of a file's contents, with the template's marks as special tokens."""
    from tokenizers import AddedToken, Tokenizer, processors

    tokenizer = Tokenizer.from_str(data)
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    tokenizer.add_special_tokens([AddedToken(m, normalized=False) for m in (OPEN, TEXT, CLOSE)])
    return tokenizer


FORMATTED = "conv_id long, piece int, last boolean, formatted string, token_ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _formatted(batches, data, settings: Settings):
    tokenizer = load(data.value)
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.bool_())]
    conv, seen, piece, turns, chars = None, False, 0, [], 0

    def encoded(last: bool):
        text, spans, roles = render(turns)
        e = tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(e.ids, np.int32)
        offsets = np.fromiter(chain.from_iterable(e.offsets), np.int32, 2 * len(ids)).reshape(-1, 2)
        mask = loss_mask(offsets[:, 0], offsets[:, 1], [s for s, r in zip(spans, roles, strict=True) if r == settings.trained_role])
        return (conv, piece, last, text, ids, np.ascontiguousarray(offsets[:, 0]), np.ascontiguousarray(offsets[:, 1]), mask)

    def flush(rows):
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, _names(FORMATTED))

    rows, held = [], 0
    for batch in batches:
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if seen and conv_id != conv:
                rows.append(encoded(True))
                held += chars
                piece, turns, chars = 0, [], 0
            elif chars >= settings.piece_chars:
                rows.append(encoded(False))
                held += chars
                piece, turns, chars = piece + 1, [], 0
            conv, seen = conv_id, True
            turns.append((role or "", text or ""))
            chars += len(role or "") + len(text or "")
            if held >= settings.piece_chars:
                yield flush(rows)
                rows, held = [], 0
    if seen:
        rows.append(encoded(True))
    if rows:
        yield flush(rows)


def _digested(batches):
    def fresh():
        return {"n": 0, "turns": sha256(), "chars": 0, "loss": sha256(), "formatted": 0, "tokens": 0, "masked": 0}

    now = fresh()
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        rows = []
        borders = batch.column("starts").offsets.to_numpy()
        flat = [batch.column(c).values.to_numpy(zero_copy_only=False) for c in ("starts", "ends", "loss")]
        for k, (conv_id, last, formatted) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("conv_id", "last", "formatted")), strict=True)):
            starts, ends, loss = (v[borders[k] : borders[k + 1]] for v in flat)
            for role, text in parse(formatted):
                now["n"] += 1
                now["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for text in masked_texts(formatted, starts, ends, loss):
                now["chars"] += len(text)
                now["loss"].update(text.encode("utf-8", "surrogatepass"))
            now["formatted"] += len(formatted)
            now["tokens"] += len(loss)
            now["masked"] += int(loss.sum())
            if last:
                rows.append((conv_id, now["n"], now["turns"].hexdigest(), now["chars"], now["loss"].hexdigest(), now["formatted"], now["tokens"], now["masked"]))
                now = fresh()
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _names(DIGEST))


def formatted(conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """FORMATTED: text, token ids, their offsets and the loss mask of every conversation, a row per piece.

    Pieces of a conversation follow each other in one partition.
    """
    with open(settings.tokenizer, encoding="utf-8") as f:
        data = conversations.sparkSession.sparkContext.broadcast(f.read())
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return dealt.mapInArrow(partial(_formatted, data=data, settings=settings), FORMATTED)


def digests(pieces: DataFrame) -> DataFrame:
    """What can be read back from formatted(): one row per conversation."""
    return pieces.mapInArrow(_digested, DIGEST)


def chat(spark, sf_dir: str) -> DataFrame:
    """Query: every conversation formatted and read back, and one that holds control strings."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(formatted(rows.unionByName(extra))).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


SQL = r"""
WITH c AS (
    SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
    -- An escape lengthens a text by one character for each control string, escaped before or not.
    SELECT *, len(regexp_extract_all(role || chr(0) || text, '<(\\*)s>|<(\\*)t>|<(\\*)/s>|\[(\\*)INST\]|\[(\\*)/INST\]|<(\\*)<SYS>>|<(\\*)</SYS>>|<(\\*)\|endoftext\|>|<(\\*)\|startoftext\|>|<(\\*)\|im_start\|>|<(\\*)\|im_end\|>|<(\\*)unk>|<(\\*)pad>')) AS escapes
    FROM c
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(role) + length(text) + escapes + 10)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
