"""Containment against sets, licences against a plain scorer, and the main paths against Python nodes."""

import math
import re
from collections import Counter

import pytest

from snapflow.llm import decontam, licenses

WORD = re.compile(r"[^\W_]+")


def plain_shingles(text):
    w = WORD.findall((text or "").lower())
    return {" ".join(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def native(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow|ExistingRDD.*Python", plan)


DOCS = "doc_id long, text string, n int, item_id string"


def test_containment(spark):
    item = " ".join(f"word{i}" for i in range(24))  # 20 shingles, 16 needed
    cut_4 = item.replace("word3 ", "other ")  # 4 shingles lost
    cut_5 = item.replace("word4 ", "other ")  # 5 lost
    long = "filler text " * 20_000
    rows = [
        (1, item), (2, long + item.upper().replace(" ", ", ") + long), (3, cut_4), (4, cut_5), (5, None), (6, ""), (7, "Three little words"),
        (None, item), (8, item), (8, long), (9, item[:-3]), (10, " ".join(reversed(item.split()))), (11, "three, LITTLE words!"), (12, "three little words more"), (13, long),
    ]
    items = [(100, item), (101, "three little words"), (102, None), (103, " ?"), (None, item), (100, item), (104, "not there at all in any of them")]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], DOCS)
    asked = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.contaminated(docs, asked)
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles, r.containment) for r in out.collect()}
    want = {}
    for d, t in rows:
        for i, b in items:
            s = plain_shingles(b)
            k = len(s & plain_shingles(t))
            if s and k / len(s) >= 0.8:
                want[d, i] = max(want.get((d, i), (0, 0, 0)), (k, len(s), round(k / len(s), 6)))
    assert got == want and (3, 100) in got and (4, 100) not in got and (2, 100) in got
    assert native(out)
    assert decontam.contaminated(docs.limit(0), asked).collect() == []
    assert decontam.contaminated(docs, asked.limit(0)).collect() == []


@pytest.mark.parametrize("n", [1, 2, 4, 5, 9, 10, 25, 60])
def test_signature_size(spark, n):
    text = " ".join(f"w{i}" for i in range(n + 4))
    row = decontam.item_index(spark.createDataFrame([(1, text)], "item_id long, text string")).first()
    assert row.n == n and row.need == math.ceil(0.8 * n - 1e-9) and len(row.minima) == n - row.need + 1


TREE = [
    ("LICENSE", "Some project\nReleased under the MIT License."),
    ("a/LICENSE.txt", "Licensed under the Apache License, Version 2.0."),
    ("a/COPYING", "nothing here"),
    ("a/b/c/d/file.py", "plain"),
    ("a/own.py", "x\n# This work is licensed under the GNU General Public License, version 3.\ny"),
    ("a/b/LICENSE", None),
    ("top.py", ""),
    ("z/README", "Released under the MIT License."),  # no licence file: holds for itself only
    ("z/other", "a long talk about the license of the shop and the permission to park there"),
    ("a/own.py", "Released under the MIT License."),  # as close as the other: the earlier template counts
    (None, "Released under the MIT License."),
]


def test_scan(spark):
    files = spark.createDataFrame([(p, t, 0.1, "y") for p, t in TREE], "path string, text string, score double, license string")
    out = licenses.scan(files)
    got = {r.path: (r.license, r.origin, r.licensed_by) for r in out.collect()}
    assert got == {
        "LICENSE": ("MIT", "own", "LICENSE"), "a/LICENSE.txt": ("Apache-2.0", "own", "a/LICENSE.txt"),
        "a/COPYING": ("Apache-2.0", "inherited", "a/LICENSE.txt"), "a/b/c/d/file.py": ("Apache-2.0", "inherited", "a/LICENSE.txt"),
        "a/own.py": ("GPL-3.0", "own", "a/own.py"), "a/b/LICENSE": ("Apache-2.0", "inherited", "a/LICENSE.txt"),
        "top.py": ("MIT", "inherited", "LICENSE"), "z/README": ("MIT", "own", "z/README"), "z/other": ("MIT", "inherited", "LICENSE"),
    }
    assert native(out)
    assert licenses.scan(files.limit(0)).collect() == []
    lonely = spark.createDataFrame([("x/y", "words"), ("q", "Copyright by somebody, who else")], "path string, text string")
    assert {(r.path, r.license, r.origin) for r in licenses.scan(lonely).collect()} == {("x/y", None, "none"), ("q", None, "none")}


def test_cosine_by_hand(spark):
    body = [t for _, t in TREE if t] + ["The license of Apache, Version 2.0, is licensed under the sun"]
    files = spark.createDataFrame([(str(i), t) for i, t in enumerate(body)], "path string, text string")
    got = {r.path: (r.license, r.score) for r in licenses.own_licenses(files, 0.2).collect()}
    anchor = re.compile("|".join(licenses.ANCHORS), re.I)
    words = lambda t: WORD.findall(t.lower())
    notices = {i: [words(x) for x in t.split("\n") if anchor.search(x)] for i, t in enumerate(body)}
    wanted = [(spdx, words(t)) for spdx, t in licenses.TEMPLATES]
    texts = {tuple(w) for ws in notices.values() for w in ws}
    both = [*texts, *(tuple(w) for _, w in wanted)]
    terms = {x for _, w in wanted for x in w}
    idf = {x: math.log((len(both) + 1) / (sum(x in set(w) for w in both) + 1)) + 1 for x in terms}
    unseen = math.log((len(both) + 1) / 2) + 1

    def vector(w):
        v = {x: c * idf.get(x, unseen) for x, c in Counter(w).items()}
        length = math.sqrt(sum(c * c for c in v.values()))
        return {x: c / length for x, c in v.items()}

    want = {}
    for i, ws in notices.items():
        best = max(((round(sum(c * vector(t).get(x, 0) for x, c in vector(w).items()), 6), -k, spdx) for w in ws for k, (spdx, t) in enumerate(wanted)), default=None)
        if best and best[0] >= 0.2:
            want[str(i)] = (best[2], best[0])
    assert got == want


@pytest.mark.parametrize("path,ups", [("a/b/c", ["a/b/c", "a/b", "a", ""]), ("a", ["a", ""]), ("", [""])])
def test_ancestors(one, path, ups):
    from pyspark.sql import functions as F

    assert one(licenses.ancestors(F.lit(path))) == ups


def test_queries_are_native(spark):
    from snapflow.llm.queries import QUERIES

    assert native(QUERIES["op4_license_scan"](spark, "/root/testdata/sf0.001"))
    assert native(QUERIES["op9_benchmark_decontamination"](spark, "/root/testdata/sf0.001"))
