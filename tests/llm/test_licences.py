"""Licence scan against a brute-force reading of the words, and the expression
parser against a recursive evaluation."""

import itertools
import random
import re

import pytest

from kestrel.llm import licences as L

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SCHEMA = "doc_id long, text string, places string, labels long, score string, words int"


def base(text):
    """(n_words, starts, labels) of the base phrases."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(low)
    found = [(i, label) for i in range(len(words)) for phrase, label in L.BASE.items()
             if words[i:i + phrase.count(" ") + 1] == phrase.split()]
    return len(words), [i for i, _ in found], sorted({x for _, x in found})


def texts():
    r = random.Random(11)
    parts = ["MIT", "License", "mit license", "Apache\nLicense", "general", "GENERAL-public license", "public", "é", "日本",
             "GNU Lesser General Public License", "İ", "mit\x00license", "x" * 30, "_", "7", "cc by", "nc", " "]
    out = [None, "", " ", "\n", "mit license " * 40_000, "mit-license mit.license MITlicense"]
    return out + [" ".join(r.choice(parts) for _ in range(r.randrange(1, 60))) for _ in range(120)]


def test_base_places(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [rows[9], rows[9], (None, rows[8][1])]
    d = spark.createDataFrame([(*x, "c", 1, "c", 2) for x in rows], SCHEMA).repartition(3)
    got = {}
    for x in L.scan(d).collect():
        got.setdefault(x.doc_id, []).append(x)
    assert sorted(len(v) for v in got.values())[-1] == 3
    for i, t in rows:
        n, starts, labels = base(t)
        for g in got[i]:
            assert (g.n_words, g.n_base) == (n, len(starts))
            assert (g.first_word, g.last_word) == (min(starts, default=None), max(starts, default=None))
            assert g.base_labels == labels and set(labels) <= set(g.labels) and g.labels == sorted(set(g.labels))
            assert [p.word for p in g.places if p.kind == "base"] == starts
            assert 0 <= g.score <= 1 and (g.freedom is None) == (not g.labels)
    assert L.scan(d.limit(0)).count() == 0


def test_bytes_that_are_no_text(spark):
    d = spark.createDataFrame([(1, b"\xff\xfe MIT License \xc3")], "doc_id long, text binary")
    g = L.scan(d).first()
    assert (g.n_words, g.n_base, g.first_word) == (4, 1, 1)


@pytest.mark.parametrize("text, labels, expressions, score, freedom", [
    ("// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND LGPL-2.1+", ["gpl", "lgpl", "mit"],
     ["mit gpl-2.0-only or lgpl-2.1+ and"], 1.0, 0.5),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR MPL-2.0 */", ["gpl", "mpl"],
     ["gpl-2.0-only classpath-exception-2.0 with mpl-2.0 or"], 1.0, 0.5),
    ("SPDX-License-Identifier: MIT AND\nApache-2.0", ["mit"], ["mit"], 1.0, 1.0),
    ("SPDX-License-Identifier: (MIT OR", [], [], 0.0, None),
    ("SPDX-License-Identifier: LicenseRef-Own-1 and so on", ["other"], ["licenseref-own-1"], 1.0, 0.25),
    ('{"license": "MIT OR Apache-2.0", "name": 1}', ["apache", "mit"], ["mit apache-2.0 or"], 1.0, 1.0),
    ("license: see the file", [], [], 0.0, None),
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"], [], 0.5, 0.0),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", ["mit"], [], 0.8, 1.0),
    ("GNU Lesser General Public License", ["gpl", "lgpl"], [], 0.5, 0.25),
])
def test_tags_and_notices(text, labels, expressions, score, freedom):
    g = L.scan_text(text.encode(), L._automaton())
    assert (g["labels"], g["expressions"], g["score"], g["freedom"]) == (labels, expressions, score, freedom)


def test_expressions_against_recursion():
    """Random trees, written with only the parentheses that they need."""
    r = random.Random(2)
    names = ["mit", "gpl-3.0", "lgpl-2.1", "cc-by-nc-4.0", "apache-2.0"]

    def grow(depth):
        op = r.choice(["or", "and", "leaf"]) if depth else "leaf"
        if op == "leaf":
            name = r.choice(names)
            free = L.FREEDOM[L.family(name)]
            if r.random() < 0.2:
                return f"{name} with font-exception", max(free, L.EXCEPTION_FREEDOM), {L.family(name)}, 3
            return name, free, {L.family(name)}, 3
        rank = L.PRECEDENCE[op]
        parts = [grow(depth - 1) for _ in range(2)]
        text = f" {op} ".join(f"({p[0]})" if p[3] < rank or (p[3] == rank and k) else p[0] for k, p in enumerate(parts))
        return text, {"or": max, "and": min}[op](parts[0][1], parts[1][1]), parts[0][2] | parts[1][2], rank

    for depth in itertools.chain(*[[d] * 60 for d in range(5)]):
        text, free, families, _ = grow(depth)
        for shape in (text, text.upper(), f"({text})"):
            tokens = L.read_expression(f": {shape} *".encode(), 1, True)
            assert L.evaluate(L.postfix(tokens)) == (families, free), text


def test_long_and_deep_expressions_take_linear_time():
    deep = "spdx-license-identifier: " + "(" * 50_000 + "mit" + ")" * 50_000
    g = L.scan_text(deep.encode(), L._automaton())
    assert g["expressions"] == ["mit"]
    many = "spdx-license-identifier: mit and " * 20_000
    assert len(L.scan_text(many.encode(), L._automaton())["expressions"]) == 20_000
