"""Packing: ids against the tokenizer, every id in one place, nothing padded."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapflow.llm import packing
from snapflow.llm.queries import BYTES, QUERIES

TOKENIZER = Tokenizer.from_file(BYTES)
TOKENIZER.encode_special_tokens = True


def plain_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, packing.END]


ODD = [
    None, "", " ", "\n", "a", " a", "a ", "a  b", "one.\nTwo, three.. four!,five 's don't.Stop", "tab\tand\r\nreturn\x0b", "no\xa0break\x85next",
    "\x1c.\x1d a", "été, À. l'œuvre ß.", "漢字。かな 한글, ну.", "<|endoftext|> and <|endoftext|>", "12,5.7 8", ".,. ,", "x" * 5_000, "\n" * 3_000 + "z", "word " * 9_000,
    "áb. c", "﻿x ​.y",
]


@pytest.mark.parametrize("text", ODD)
def test_ids_are_those_of_the_tokenizer(text):
    got = np.frombuffer(packing.words(BYTES).encode(text or ""), "<u4").tolist()
    assert got == plain_ids(text)[:-1]


def test_ids_of_random_texts():
    rng, known = random.Random(5), packing.Words(BYTES)
    for _ in range(3_000):
        text = "".join(rng.choice("abs.,é \n\t'!7漢$_~") for _ in range(rng.randrange(30)))
        assert np.frombuffer(known.encode(text), "<u4").tolist() == plain_ids(text)[:-1], repr(text)


def test_bounded_cache(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 8)
    known = packing.Words(BYTES)
    text = " ".join(f"word{i}" for i in range(100))
    assert np.frombuffer(known.encode(text), "<u4").tolist() == plain_ids(text)[:-1]
    assert len(known) <= 8


def test_new_words_of_a_text_go_through_the_model_together(monkeypatch):
    known, asked = packing.Words(BYTES), []
    learn = packing.Spaced.learn
    monkeypatch.setattr(packing.Spaced, "learn", lambda self, new: asked.append(sorted(new)) or learn(self, new))
    text = "One zweiß étés zweiß, un.\nZwei trois \u4e00\u4e8c x1 don't"
    for _ in range(2):
        assert np.frombuffer(known.encode(text), "<u4").tolist() == plain_ids(text)[:-1]
    assert asked == [["trois", "zweiß", "étés"]]  # once; pieces with marks, digits or other letters go by chunks


def test_words_of_all_lengths_and_letters_by_the_model():
    rng, known = random.Random(7), packing.Words(BYTES)
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(192, 256)) if c not in (215, 247)]
    for _ in range(300):
        text = "".join(rng.choice([" ", " ", "\n", ". ", ", "]) + "".join(rng.choices(letters, k=rng.randrange(1, 36))) for _ in range(40))
        assert np.frombuffer(known.encode(text), "<u4").tolist() == plain_ids(text)[:-1], repr(text)


def test_usual_texts_go_by_the_ranks_of_the_merges(monkeypatch):
    known = packing.Words(BYTES)
    monkeypatch.setattr(packing.Words, "__missing__", lambda self, chunk: pytest.fail(chunk))
    for text in ("", "One zweiß étés, un.\nZwei  trois x1 don't <|endoftext|>", "x" * 5_000 + " " * 9_000 + "y", "a \t\r\n\xa0 b"):
        assert np.frombuffer(known.encode(text), "<u4").tolist() == plain_ids(text)[:-1]


def test_ranks_split_usual_characters_as_the_tokenizer_does():
    known = packing.Words(BYTES)
    usual = [chr(c) for c in range(0x250) if not packing._UNSURE.search(chr(c))]
    for c in usual:
        text = "".join(f"{c}{d}a {c}{d}{c} 1{c}" for d in usual)
        assert np.frombuffer(known.encode(text), "<u4").tolist() == plain_ids(text)[:-1], repr(c)


def test_files_of_another_kind_keep_the_tokenizer(tmp_path):
    file = json.loads(open(BYTES, encoding="utf-8").read())
    changed = [{"ignore_merges": True}, {"merges": file["model"]["merges"][::-1]}]
    for i, change in enumerate(changed):
        path = tmp_path / f"{i}.json"
        path.write_text(json.dumps(file | {"model": file["model"] | change}), encoding="utf-8")
        assert packing.ranked(str(path), Tokenizer.from_file(str(path))) is None
    assert packing.ranked(BYTES, TOKENIZER)


def covered(counts, width):
    """Every id of every run in one place, gapless; sizes of the sequences."""
    places = packing.Places(packing.pack(counts, width), width)
    lengths = [n for n in sorted(counts) for _ in range(counts[n])]
    run, begin, length, sequence, offset = places.of(np.arange(len(lengths)))
    held, parts = {}, {}
    for r, b, m, s, o in zip(run, begin, length, sequence, offset):
        held.setdefault(int(s), []).append((int(o), int(m)))
        parts.setdefault(int(r), []).append((int(b), int(m)))
    for r, n in enumerate(lengths):
        at = 0
        for b, m in sorted(parts[r]):
            assert b == at and m > 0
            at += m
        assert at == n
    sizes = []
    for rows in held.values():
        at = 0
        for o, m in sorted(rows):
            assert o == at
            at += m
        assert at <= width
        sizes.append(at)
    return sizes


def test_patterns():
    rng = random.Random(1)
    cases = [{5: 1}, {1: 1}, {8: 3}, {1: 100}, {5: 1000}, {6: 7, 3: 2, 1: 1}, {7: 50, 8: 3}]
    cases += [{n: rng.choice([1, 2, 9, 100]) for n in rng.sample(range(1, 9), rng.randint(1, 8))} for _ in range(300)]
    for counts in cases:
        sizes = covered(counts, 8)
        assert sorted(s for s in sizes if s & (s - 1)) == []  # nothing to pad
        assert len([s for s in sizes if s == 8]) == sum(n * c for n, c in counts.items()) // 8


def test_work_does_not_grow_with_the_rows():
    rng = random.Random(2)
    counts = {n: rng.randrange(1, 1 << 40) for n in range(1, 2049)}
    few, many = packing.pack({n: c % 97 + 1 for n, c in counts.items()}), packing.pack(counts)
    assert sum(len(p) for *_, p in many) < 200_000 and sum(len(p) for *_, p in few) < 200_000
    assert sum(c * sum(m for _, m in p) for _, c, p in many) == sum(n * c for n, c in counts.items())
    assert len(packing.Places(many).position) < 400_000


def check(docs, pieces, width=packing.WIDTH):
    texts, found, held = {}, {}, {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    for r in pieces.collect():
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0
        found.setdefault(r.doc_id, []).append((r.start, ids, r.doc_tokens))
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert found.keys() == texts.keys()
    for d, parts in found.items():
        if len(texts[d]) == 1:
            want = plain_ids(texts[d][0])
            assert [i for _, ids, _ in sorted(parts) for i in ids] == want
            assert [s for s, _, _ in sorted(parts)] == [0, *np.cumsum([len(i) for _, i, _ in sorted(parts)])[:-1].tolist()]
            assert {t for _, _, t in parts} == {len(want)}
        else:
            assert sum(len(i) for _, i, _ in parts) == sum(len(plain_ids(t)) for t in texts[d])
    for parts in held.values():
        size = 0
        for o, m in sorted(parts):
            assert o == size
            size += m
        assert size <= width and size & (size - 1) == 0
    return found


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(docs, packing.pack_documents(docs, BYTES))


def test_odd_documents(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, None), (3, "again"), (3, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit("x"), "length": F.lit("y"), "ids": F.lit(1), "begin": F.lit(2)})
    check(docs, packing.pack_documents(docs, BYTES, 16), 16)
    assert packing.pack_documents(docs.limit(0), BYTES).collect() == []


def test_hot_length(spark):
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "").otherwise(F.concat(F.lit("some words "), "id")).alias("text"))
    check(docs, packing.pack_documents(docs, BYTES, 64), 64)


def test_sequences_hold_the_ids(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    pieces = packing.pack_documents(docs, BYTES, 256).persist()
    whole = {r.sequence_id: r.ids for r in packing.sequences(pieces).collect()}
    for r in pieces.collect():
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == whole[r.sequence_id][r.offset:r.offset + r.length]
    pieces.unpersist()


def test_contract(spark):
    got = QUERIES["op12_sequence_packing"](spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes) == {c: "bigint" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}


def test_path_is_a_parameter():
    assert BYTES == public_tokenizers.path("byte_bpe_50k.json")
