"""Removal of repeated strings and lines against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapflow.llm import lines, suffix


def plain_removed(docs, length=100):
    """docs: ordered (key, bytes); for each the mask of bytes under a string that starts earlier."""
    seen, out = set(), []
    for text in docs:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if text[i:i + length] in seen:
                gone[i:i + length] = True
            seen.add(text[i:i + length])
        out.append(gone)
    return out


def random_texts(seed, n=14):
    rnd = random.Random(seed)
    alphabet = rnd.choice(["ab", "a", "abcdefgh \n", "aé漢"])
    base = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 700))) for _ in range(6)]
    texts = []
    for _ in range(n):
        t = ""
        for _ in range(rnd.randint(0, 4)):
            s = rnd.choice(base)
            i = rnd.randint(0, len(s))
            t += s[i:rnd.randint(i, len(s))] + "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
        texts.append(t)
    return texts


def check(spark, rows, **options):
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, kept int").repartition(3)
    got = sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.kept), r.n_bytes, [(s.lo, s.hi) for s in r.spans]) for r in suffix.remove_repeats(docs, **options).collect())
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = []
    for (d, t), gone in zip(rows, plain_removed([(t or "").encode() for _, t in rows])):
        data = (t or "").encode()
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]]))).reshape(-1, 2)
        want.append((d is not None, d or 0, bytes(np.frombuffer(data, np.uint8)[~gone]), len(data), [tuple(e) for e in edges.tolist()]))
    assert got == sorted(want)


@pytest.mark.parametrize("seed", range(4))
def test_repeated_strings(spark, seed):
    texts = random_texts(seed)
    check(spark, [(3 * i - 9, t) for i, t in enumerate(texts)] + [(900, None), (None, texts[0] + "z" * 120)])


@pytest.mark.parametrize("options", [{"hot": 0}, {"hot": 3, "collection": 5}])
def test_hot_anchors_give_the_same(spark, options):
    passage = "a passage that very many documents share, of more than a hundred bytes in all, so that it has to go. "
    rnd = random.Random(5)
    rows = [(i, "".join(rnd.choice("xyz ") for _ in range(rnd.randint(0, 150))) + passage + "".join(rnd.choice("uvw") for _ in range(90))) for i in range(25)]
    check(spark, rows, **options)


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix, "_PIECE", 777)
    monkeypatch.setattr(suffix, "_FLUSH", 10)
    unit = "".join(random.Random(1).choices("abcdefghij ", k=4000))
    check(spark, [(1, unit), (2, "q" * 250 + unit[1000:3000] + "r" * 99 + unit[:50]), (3, unit)])


def test_repeated_rows_and_empty_tables(spark):
    text = "".join(random.Random(2).choices("abcdef", k=300))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id, len(r.kept)) for r in suffix.remove_repeats(docs).collect())
    assert got == [(1, 300), (1, 300), (2, 0)]
    assert suffix.remove_repeats(docs.limit(0)).collect() == []


def test_order_and_common_prefixes():
    rng = np.random.default_rng(4)
    symbols = rng.integers(0, 2, (200, suffix.WIDTH), dtype=np.uint8)
    symbols[50:100, 30:140] = symbols[:50, 30:140]
    rank = rng.permutation(200)
    lo, hi = rng.integers(0, 69, 200), suffix.WIDTH - rng.integers(0, 69, 200)
    first, last = suffix.repeated_strings(symbols, lo, hi, rank)
    for i in range(200):
        hit = [j for j in range(69) if lo[i] <= j and j + 100 <= hi[i] and any(
            rank[k] < rank[i] and lo[k] <= j and j + 100 <= hi[k] and (symbols[k, j:j + 100] == symbols[i, j:j + 100]).all() for k in range(200)
        )]
        assert (first[i], last[i]) == ((hit[0], hit[-1]) if hit else (-1, -1))


def plain_lines(rows, least):
    """rows: ordered texts; lines left of each."""
    seen, gone = set(), []
    split = [t.split("\n") for t in rows]
    full = [[line for line in ls if line.split()] for ls in split]
    runs = [
        (d, i, j) for d, ls in enumerate(full) for i in range(len(ls)) for j in range(i + 1, len(ls) + 1)
        if sum(len(x.split()) for x in ls[i:j]) >= least
    ]
    first = {}
    for d, i, j in runs:
        key = "\n".join(full[d][i:j])
        first[key] = min(first.get(key, (d, i)), (d, i))
    gone = {(d, k) for d, i, j in runs if first["\n".join(full[d][i:j])] < (d, i) for k in range(i, j)}
    out = []
    for d, ls in enumerate(split):
        k, kept = -1, []
        for line in ls:
            k += bool(line.split())
            if (d, k) not in gone:
                kept.append(line)
        out.append("\n".join(kept))
    return out


@pytest.mark.parametrize("seed,least", [(1, 1), (2, 4), (3, 9), (4, 30)])
def test_repeated_line_runs(spark, seed, least):
    rnd = random.Random(seed)
    pool = [" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5))) for _ in range(7)] + ["", " "]
    texts = ["\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14))) for _ in range(18)]
    texts += [texts[0] + "\n" + texts[1]]
    docs = spark.createDataFrame([(i * 2 - 5, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, kept int").repartition(3)
    got = {r.row.doc_id: r.kept for r in lines.remove_repeated_lines(docs, least).collect()}
    assert [got[i * 2 - 5] for i in range(len(texts))] == plain_lines(texts, least)


def test_line_rows(spark):
    run = "one two three four five\n" * 12
    schema = "doc_id long, text string, n_chars long, line string, lo int"
    rows = [(None, run, 1, "x", 1), (1, run, 2, "x", 1), (1, run, 2, "x", 1), (2, None, 3, None, 1), (3, "", 4, None, 1), (4, run + "its own end", 5, None, 1), (5, "short\nline", 6, None, 1)]
    docs = spark.createDataFrame(rows, schema)
    done = sorted(((r.doc_id or 0, r.text, r.n_chars) for r in lines.dedupe_lines(docs, 50).collect()), key=str)
    # the null id comes first; the rest of its run repeats inside it, and id 1 holds copies only
    first = "\n".join(["one two three four five"] * 10) + "\n"
    found = {d: (t, n) for d, t, n in done}
    assert found[2] == (None, 3) and found[3] == ("", 4) and found[5] == ("short\nline", 6)
    assert 1 not in found and found[4][0] == "its own end" and found[4][1] == len("its own end")
    assert found[0][0].strip() == plain_lines([run], 50)[0].strip()
    assert lines.dedupe_lines(docs, 50).columns == docs.columns
    assert lines.dedupe_lines(docs.limit(0), 50).collect() == []
    assert first.count("one") == 10


def test_a_very_common_line(spark):
    common = "\n".join(f"line {k} of the notice that all of the pages carry along with them" for k in range(6))
    rows = [(i, f"own {i}\n{common}\nend {i}") for i in range(400)]
    got = {r.row.doc_id: (r.kept, r.n_removed) for r in lines.remove_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == (rows[0][1], 0) and all(got[i] == (f"own {i}\nend {i}", 6) for i in range(1, 400))


def test_least_runs():
    words = np.array([3, 1, 5, 2, 9])
    on, upto = lines.least_runs(words, 6)
    assert on.tolist() == [3, 2, 2, 2, 1] and upto.tolist() == [0, 0, 2, 2, 1]


def test_kept_order_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").orderBy("doc_id").limit(60).collect()]
    check(spark, rows)
    assert docs.filter(F.col("text").isNull()).count() == 0
