"""Byte-level BPE against the library on whole texts; chat formatting against its own input."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from snapflow.llm import bpe, chat

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
DOCS = "doc_id long, text string, token_ids string"  # the last clashes with a result


def whole(text):
    """Each match of the pattern encoded by itself."""
    enc = bpe.encoding(RANKS, PATTERN)
    return [i for m in regex.finditer(PATTERN, text) for i in enc._encode_single_piece(m[0])]


@pytest.mark.parametrize("text", [
    "", " ", "a", "naïve café ßß — 1234 !!", "x" * 5000, "\n \n\t ", " " * 9000, " " * 9000 + "end", "a" + "　" * 6000 + "b c",
    "word\x1c \x1d next " * 4000, "it's they'll " * 9000, "日本語テキスト" * 20000, "a\n" * 50000, "\t" * 5000 + " x" + "\r\n" * 5000,
])
def test_long_texts_are_cut_at_safe_places(text):
    assert "".join(p for p, _ in bpe.safe_pieces(text)) == text
    assert bpe.encode_text(text, RANKS, PATTERN).tolist() == whole(text)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab1 \n\t'’sll!é　\x1c漢")), max_size=400))
def test_any_cut_is_the_same(text):
    parts = list(bpe._cut(text, 0, len(text), 7))
    assert "".join(parts) == text
    enc = bpe.encoding(RANKS, PATTERN)
    assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_tokenize_rows(spark):
    rows = [(1, "héllo wörld", "x"), (1, "héllo wörld", "x"), (2, None, None), (None, "", "y"), (3, "z" * 200_000, None)]
    got = bpe.tokenize(spark.createDataFrame(rows, DOCS), RANKS, PATTERN).collect()
    assert len(got) == 5
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].n_tokens == 0 and by_id[None].ids_sha256 == hashlib.sha256(b"").hexdigest()
    for doc_id, text, _ in rows:
        r, ids = by_id[doc_id], whole(text or "")
        assert r.token_ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.tokenize(spark.createDataFrame([], DOCS), RANKS, PATTERN).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*chat._CONTROL, "\\", "<", "[", "/", "s>", "INST]", "x", "</", "é", "\n"]), max_size=12).map("".join))
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat._STRICT.search(chat.escape(text))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(
    st.sampled_from(["user", "assistant", "system", "tool", "", "[TEXT]"]),
    st.lists(st.sampled_from(["</s>", "<", "[INST]", "[", "ok", "é漢", " ", "\\", "<<SYS>>"]), max_size=6).map("".join),
), max_size=6))
def test_segment_round_trip(turns):
    formatted, ids, ends, spans = chat.format_segment(turns, RANKS, PATTERN)
    assert chat.parse_turns(formatted) == turns
    assert ends[-1] == len(formatted.encode()) if len(ids) else formatted == ""
    assert chat.masked_text(formatted, ends, spans) == "".join(t for r, t in turns if r == "assistant")


def test_mask_by_binary_search():
    rng = np.random.default_rng(3)
    ends = np.cumsum(rng.integers(1, 5, 200))
    starts = np.concatenate([[0], ends[:-1]])
    cuts = np.sort(rng.choice(ends[-1], 20, replace=False)).reshape(-1, 2)
    first, after = chat.loss_tokens(ends, cuts)
    for (lo, hi), a, b in zip(cuts, first, after):
        assert list(range(a, b)) == [i for i in range(200) if starts[i] < hi and ends[i] > lo]


def digests(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (
        len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
        len(loss), hashlib.sha256(loss.encode()).hexdigest(),
    )


@pytest.mark.parametrize("segment", [1, 40, 1 << 20])
def test_conversations(spark, segment):
    own = "</s>[INST] ok [/INST]"
    rows = [
        (-7, 0, "user", own, 1), (-7, 1, "assistant", own, 2),
        (1, 1, "assistant", "späte Antwort", 1), (1, 0, "user", None, 1), (1, 2, None, "", 1),
        (None, 0, "user", "lost", 1), (2, None, "system", "first", 1), (2, 0, "assistant", "", 1), (2, 0, "assistant", "", 1),
        *[(3, i, "assistant" if i % 2 else "user", f"turn {i} " * 50, 1) for i in range(300)],
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int")
    formatted = chat.format_conversations(df, RANKS, PATTERN, segment)
    got = {r.conv_id: r for r in chat.conversation_digests(formatted).collect()}
    want = {
        -7: [("user", own), ("assistant", own)], 1: [("user", ""), ("assistant", "späte Antwort"), ("", "")],
        None: [("user", "lost")], 2: [("system", "first"), ("assistant", ""), ("assistant", "")],
        3: [(r[2], r[3]) for r in rows if r[0] == 3],
    }
    assert set(got) == set(want)
    for conv, turns in want.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == digests(turns)
        assert r.formatted_chars == sum(len(p) for role, t in turns for p in chat.render_turn(role, t))
    assert chat.conversation_digests(chat.format_conversations(df.limit(0), RANKS, PATTERN)).collect() == []
