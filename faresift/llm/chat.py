"""Chat formatting with loss masks: a conversation is rendered whole, encoded once with offsets, and
the tokens of assistant turns are found by binary search of turn spans in token spans.

Turns are ``<|turn|>role<|says|>text<|done|>``. Inside roles and texts a backslash goes between ``<``
(with the backslashes after it) and ``|``, so no control string can come from a text and the escape can
be undone. The control strings are added to the tokenizer as tokens of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import AddedToken, Tokenizer, pre_tokenizers, processors

TOKENIZER = "byte_bpe_50k.json"
TURN, SAYS, DONE = "<|turn|>", "<|says|>", "<|done|>"
LEARNED_ROLE = "assistant"
# Characters of conversations that make up a batch of results (one conversation may have more).
CHARS_AT_ONCE = 1_000_000

_TO_ESCAPE = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|turn\|>(.*?)<\|says\|>(.*?)<\|done\|>", re.DOTALL)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The whole conversation and the spans of its learned texts, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{SAYS}", escape(text)
        if role == LEARNED_ROLE and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, DONE]
        at += len(head) + len(body) + len(DONE)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns, read back from a rendered conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    found = Tokenizer.from_file(path)
    # Offsets keep leading spaces; control strings of the vocabulary are ordinary text.
    found.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=True)
    found.post_processor = processors.ByteLevel(trim_offsets=False)
    found.add_tokens([AddedToken(t, normalized=False, special=False) for t in (TURN, SAYS, DONE)])
    found.encode_special_tokens = True
    return found


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in a span. Token and turn spans are sorted, so each turn is two binary searches."""
    mask = np.zeros(len(offsets), bool)
    if len(offsets) and spans:
        first = np.searchsorted(offsets[:, 1], [a for a, _ in spans], side="right")
        after = np.searchsorted(offsets[:, 0], [b for _, b in spans], side="left")
        for a, b in zip(first.tolist(), after.tolist(), strict=True):
            mask[a:b] = True
    return mask


def masked_text(formatted: str, offsets: np.ndarray, mask: np.ndarray) -> str:
    """All text under masked tokens, unescaped run by run. Tokens that share a character give it once."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    runs = [(int(offsets[a, 0]), int(offsets[b - 1, 1])) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return "".join(unescape(formatted[a:b]) for a, b in runs)


def format_one(turns: list[tuple[str, str]], path: str) -> dict:
    formatted, spans = render(turns)
    code = tokenizer(path).encode(formatted, add_special_tokens=False)
    offsets = np.array(code.offsets, np.int64).reshape(-1, 2)
    return {"formatted": formatted, "ids": code.ids, "mask": loss_mask(offsets, spans), "offsets": offsets}


_RESULT = "formatted string, ids array<int>, loss_mask array<boolean>, offsets array<struct<first:int,after:int>>"


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple[str, str]]]]:
    """(conv_id, turns) from rows sorted by conversation and turn; one conversation is held at a time."""
    current, turns = None, None
    for batch in batches:
        for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
            if turns is None or conv != current:
                if turns is not None:
                    yield current, turns
                current, turns = conv, []
            turns.append((role or "", text or ""))
    if turns is not None:
        yield current, turns


def format_conversations(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """One row per conv_id: formatted text, token ids, loss mask and token offsets.

    Turns are ordered by turn (nulls first), then role and text, so repeated turn numbers have a defined
    order and repeated rows are kept. Null roles and texts count as empty; rows of a null conv_id are one
    conversation. Other columns are not read. A conversation is rendered whole, so one task holds one
    whole conversation, never a group of them.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    at = path or public_tokenizers.path(TOKENIZER)
    rows = conversations.select("conv_id", "turn", "role", "text")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = StructType([conversations.schema["conv_id"]])
    for field in StructType.fromDDL(_RESULT):
        schema = schema.add(field)
    arrow = to_arrow_schema(schema)

    def batch_of(convs: list, found: list[dict]) -> pa.RecordBatch:
        sizes = np.cumsum([0, *[len(one["ids"]) for one in found]])
        pairs = np.concatenate([one["offsets"] for one in found]).astype(np.int32)
        spans = arrow.field("offsets").type.value_type
        values = {
            "ids": pa.array(np.concatenate([np.array(one["ids"], np.int32) for one in found]), pa.int32()),
            "loss_mask": pa.array(np.concatenate([one["mask"] for one in found])),
            "offsets": pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], fields=list(spans)),
        }
        lists = [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), v, type=arrow.field(n).type) for n, v in values.items()]
        columns = [pa.array(convs, arrow[0].type), pa.array([one["formatted"] for one in found], arrow[1].type), *lists]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, found, chars = [], [], 0
        for conv, turns in _conversations(batches):
            one = format_one(turns, at)
            convs.append(conv)
            found.append(one)
            chars += len(one["formatted"])
            if chars >= CHARS_AT_ONCE:
                yield batch_of(convs, found)
                convs, found, chars = [], [], 0
        if found:
            yield batch_of(convs, found)

    return rows.mapInArrow(run, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the output."""
    out = pa.struct(
        [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string())]
    )

    def read(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, masks, spans in batches:
            rows = []
            # One pass over flat buffers; the lists of both columns have the same bounds.
            bounds = (spans.offsets.to_numpy() - spans.offsets[0].as_py()).tolist()
            mask = masks.flatten().to_numpy(zero_copy_only=False)
            first, after = (spans.flatten().field(k).to_numpy() for k in (0, 1))
            pairs = np.stack([first, after], axis=1)
            for text, a, b in zip(texts.to_pylist(), bounds[:-1], bounds[1:], strict=True):
                turns = parse(text)
                seen = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = masked_text(text, pairs[a:b], mask[a:b])
                sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append({"n_turns": len(turns), "turns_sha256": sha(seen), "loss_chars": len(loss), "loss_sha256": sha(loss)})
            yield pa.array(rows, out)

    udf = F.arrow_udf(read, "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string")
    found = formatted.select("conv_id", udf("formatted", "loss_mask", "offsets").alias("d"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    return found.select("conv_id", "d.*", "formatted_chars")
