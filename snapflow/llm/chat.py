"""Chat formatting: whole conversations to text, token ids and a loss mask aligned by offsets."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.bpe import encode_text, encoding
from snapflow.llm.common import small_batches

#: Control strings of the template, by role. Other roles are named between TURN and TEXT.
SYSTEM, SYSTEM_END = "<<SYS>>", "<</SYS>>"
USER, USER_END = "[INST]", "[/INST]"
ASSISTANT, END = "<s>", "</s>"
TURN, TEXT, TURN_END = "[TURN]", "[TEXT]", "[/TURN]"
_NAMED = {"system": (SYSTEM, SYSTEM_END), "user": (USER, USER_END), "assistant": (ASSISTANT, END)}
_CONTROL = [SYSTEM, SYSTEM_END, USER, USER_END, ASSISTANT, END, TURN, TEXT, TURN_END]

# a control string, with any number of backslashes after its first sign
_LOOSE = re.compile("|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in _CONTROL))
_ESCAPED = re.compile("|".join(re.escape(c[0]) + r"\\+" + re.escape(c[1:]) for c in _CONTROL))
_STRICT = re.compile("|".join(re.escape(c) for c in sorted(_CONTROL, key=len, reverse=True)))

#: A rendered segment is closed at the first turn that ends beyond so many characters.
SEGMENT = 1 << 20
SCHEMA = (
    "conv_id long, segment int, formatted string, token_ids array<int>, token_ends array<int>, "
    "loss_from array<int>, loss_to array<int>"
)
_SEGMENTS = pa.schema([
    ("conv_id", pa.int64()), ("segment", pa.int32()), ("formatted", pa.string()),
    *((name, pa.list_(pa.int32())) for name in ("token_ids", "token_ends", "loss_from", "loss_to")),
])
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
)


def escape(text: str) -> str:
    """Text without control strings: each gets one more backslash after its first sign."""
    return _LOOSE.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def render_turn(role: str, text: str) -> tuple[str, str, str]:
    """Opening, body and closing of a turn; only the body of an assistant turn is under the loss mask."""
    if role in _NAMED:
        start, end = _NAMED[role]
    else:
        start, end = TURN + escape(role) + TEXT, TURN_END
    return start, escape(text), end


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a rendered conversation."""
    turns, role, at, names = [], None, 0, {v[0]: k for k, v in _NAMED.items()}
    for m in _STRICT.finditer(formatted):
        if m[0] in names or m[0] == TURN:
            role = names.get(m[0])
        elif m[0] == TEXT:
            role = unescape(formatted[at:m.start()])
        else:
            turns.append((role, unescape(formatted[at:m.start()])))
        at = m.end()
    return turns


@lru_cache(maxsize=2)
def _token_bytes(ranks: str, pattern: str) -> np.ndarray:
    return np.array([len(t) for t in sorted_tokens(ranks, pattern)], np.int64)


def sorted_tokens(ranks: str, pattern: str) -> list[bytes]:
    """Bytes of every token in id order."""
    enc = encoding(ranks, pattern)
    return [enc.decode_single_token_bytes(i) for i in range(enc.n_vocab)]


def loss_tokens(ends: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte span, the first token that reaches into it and the one after the last.

    ``ends`` are the byte offsets where tokens end, ascending; spans are sorted
    and apart, so two binary searches a span give the mask.
    """
    starts = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(ends, spans[:, 0], side="right")
    after = np.searchsorted(starts, spans[:, 1], side="left")
    return first, np.maximum(first, after)


def format_segment(turns: list[tuple[str, str]], ranks: str, pattern: str):
    """Text, token ids, token ends and loss spans (bytes) of consecutive turns, encoded in one go."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        for k, part in enumerate(render_turn(role, text)):
            parts.append(part)
            size = len(part.encode("utf-8"))
            if k == 1 and role == "assistant" and size:
                spans.append((at, at + size))
            at += size
    formatted = "".join(parts)
    ids = encode_text(formatted, ranks, pattern)
    return formatted, ids, np.cumsum(_token_bytes(ranks, pattern)[ids]), np.array(spans, np.int64).reshape(-1, 2)


def masked_text(formatted: str, ends: np.ndarray, spans: np.ndarray) -> str:
    """All text under the loss mask, unescaped.

    The mask is read through the tokens: of each token in a span, the bytes that
    lie in it. A token that also covers a control string counts by its share.
    """
    raw, out = formatted.encode("utf-8"), []
    starts = np.concatenate([[0], ends[:-1]])
    first, after = loss_tokens(ends, spans)
    for (lo, hi), a, b in zip(spans, first, after):
        if a < b:
            out.append(unescape(raw[max(lo, starts[a]):min(hi, ends[b - 1])].decode("utf-8")))
    return "".join(out)


def format_conversations(turns: DataFrame, ranks: str, pattern: str, segment: int = SEGMENT) -> DataFrame:
    """Rendered conversations in segments of whole turns, with token ids, token ends and loss spans.

    Rows (conv_id, turn, role, text) are ordered by turn, then role and text for
    rows of the same turn; repeated rows are turns of their own. Null roles and
    texts are empty, null turns come first, and rows without conv_id are one
    conversation. Conversations stay in order inside a partition and one row
    holds about ``segment`` characters at most beyond its last turn, so a
    conversation of any length passes through bounded memory.
    """
    small_batches(turns.sparkSession)
    kept = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = kept.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        conv, number, open_turns, size, begun = None, 0, [], 0, False

        def close():
            formatted, ids, ends, spans = format_segment(open_turns, ranks, pattern)
            row = (conv, number, formatted, ids, ends, spans[:, 0], spans[:, 1])
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _SEGMENTS)], schema=_SEGMENTS)

        for batch in batches:
            for c, _, role, text in zip(*(column.to_pylist() for column in batch.columns)):
                if begun and (c != conv or size > segment):
                    yield close()
                    number = number + 1 if c == conv else 0
                    open_turns, size = [], 0
                conv, begun = c, True
                open_turns.append((role, text))
                size += len(role) + len(text)
        if begun:
            yield close()

    return placed.mapInArrow(run, SCHEMA)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What a formatted conversation holds, read back from its rows, in the order they come.

    ``formatted`` is the output of ``format_conversations`` as it stands, so that a
    conversation's segments follow one another in one partition. The digests run
    over the whole conversation and are sequential by definition.
    """
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_tokens", pa.int64()),
    ])

    def run(batches):
        row, turns_hash, loss_hash = None, None, None

        def close():
            done = {**row, "turns_sha256": turns_hash.hexdigest(), "loss_sha256": loss_hash.hexdigest()}
            return pa.RecordBatch.from_pylist([done], schema=schema)

        for batch in batches:
            for r in batch.to_pylist():
                if r["segment"] == 0:
                    if row:
                        yield close()
                    row = {"conv_id": r["conv_id"], "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "n_tokens": 0}
                    turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
                turns = parse_turns(r["formatted"])
                for role, text in turns:
                    turns_hash.update(f"{role}\n{text}\n".encode("utf-8"))
                spans = np.array([r["loss_from"], r["loss_to"]], np.int64).T
                loss = masked_text(r["formatted"], np.asarray(r["token_ends"], np.int64), spans)
                loss_hash.update(loss.encode("utf-8"))
                row["n_turns"] += len(turns)
                row["loss_chars"] += len(loss)
                row["formatted_chars"] += len(r["formatted"])
                row["n_tokens"] += len(r["token_ids"])
        if row:
            yield close()

    return formatted.mapInArrow(run, DIGESTS)
