"""Notices wrapped over lines, licence texts, SPDX tags and names of licence files."""

import random
import re

from snapflow.llm import licenses

GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
TOP = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.
"""
FILES = {
    "gpl.py": ("import x\n\n" + GPL + "\n\nprint(1)", "GPL-3.0"),
    "gpl2.py": (GPL.replace("version 3", "version 2"), "GPL-2.0"),
    "mpl.c": (MPL, "MPL-2.0"),
    "own.py": ("# This work is licensed under the GNU General Public\n# License, version 3.", "GPL-3.0"),
    "tag.c": ("// SPDX-License-Identifier: LGPL-3.0-or-later\nint x;", "LGPL-3.0"),
    "long.py": ("\n".join(f"line of code {i}" for i in range(60)) + "\n" + GPL + "\n" + "\n".join(f"more code {i}" for i in range(60)), "GPL-3.0"),
    "a/License.txt": (TOP, "GPL-3.0"), "a/x": ("plain", "GPL-3.0"),
    "b/LICENSE-MIT": ("Released under the MIT License.", "MIT"), "b/x": ("plain", "MIT"),
    "c/licensed.py": ("Released under the MIT License.", "MIT"), "c/x": ("plain", None),
    "talk": ("a long talk about the license\nof the shop and the permission\nto park there", None),
}


def test_blocks_tags_and_names(spark):
    files = spark.createDataFrame([(p, t) for p, (t, _) in FILES.items()], "path string, text string")
    got = {r.path: r.license for r in licenses.scan(files).collect()}
    assert got == {p: spdx for p, (_, spdx) in FILES.items()}


def plain_blocks(text, sizes):
    """Runs of words of a text's blocks, straight from the definition."""
    anchor, longest, found = re.compile("|".join(licenses.ANCHORS), re.I), max(sizes), set()
    words = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    bare = "\n".join(re.sub(licenses.MARKS.replace("^(?i:rem|dnl)", "^(?:[Rr][Ee][Mm]|[Dd][Nn][Ll])"), "", x) for x in re.split("\r?\n", text or ""))
    if not anchor.search(text or ""):
        return found
    for block in re.split("\n{2,}", bare):
        if not anchor.search(block) or "\n" not in block:
            continue
        rows = [w for w in map(words, block.split("\n")) if w]
        made = [words(block)] if len(words(block)) <= 2 * longest else []
        for i in range(len(rows)):
            ahead = [w for r in rows[i:i + longest] for w in r][:longest]
            if anchor.search(" ".join(ahead)):
                made += [ahead[:k] for k in sizes]
        found |= {tuple(w) for w in made if anchor.search(" ".join(w))}
    return found


def test_windows_equal_those_of_the_definition(spark):
    rng, sizes = random.Random(8), [2, 5, 9]
    vocabulary = ["license", "Licence", "public", "domain", "public-domain", "copyright", "a", "b", "c9", "--", "***", "", "permitted", "x" * 40]
    texts = []
    for n in (1, 3, 8, 20, 60, 200):
        for _ in range(12):
            rare = rng.random() < 0.6
            line = lambda: rng.choice(["", "# ", " * ", "// "]) + " ".join(rng.choice(vocabulary[6:12] if rare and rng.random() < 0.95 else vocabulary) for _ in range(rng.randrange(7)))
            texts.append(rng.choice(["\n", "\r\n"]).join(line() for _ in range(n)))
    texts += ["license\n" + "w " * 500, "w " * 500 + "\nlicense", None, "", "license", "\n\n"]
    files = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "path string, text string")
    got = {}
    for r in licenses.block_notices(files, sizes).collect():
        got.setdefault(int(r.path), set()).add(tuple(r.words))
    assert got == {i: w for i, t in enumerate(texts) if (w := plain_blocks(t, sizes))}


def test_a_long_block_is_not_held_as_windows(spark):
    notice = "Released under the\nMIT License."
    text = "\n".join(f"row {i}" for i in range(150_000)) + "\n" + notice + "\n" + "\n".join(f"row {i}" for i in range(150_000))
    files = spark.createDataFrame([("big", text), ("wide", "see the license\n" + "word " * 400_000)], "path string, text string")
    assert {r.path: r.license for r in licenses.scan(files).collect()} == {"big": "MIT", "wide": None}
