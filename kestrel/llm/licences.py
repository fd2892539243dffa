"""Licence scan: notices, identifier tags and licence expressions.

Method: one Aho-Corasick automaton walks the words of every whole text and
finds notice phrases and identifier tags.  What follows a tag is read as a
licence expression: a shunting-yard parser turns it into postfix form, which
is evaluated with ``or`` as the freest choice, ``and`` as the strictest part
and ``with`` as an exception that loosens what stands before it.

Words are runs of ASCII letters and digits and of all characters beyond
ASCII, A-Z lower-cased.  Every place of a ``BASE`` phrase counts, overlapping
ones too; of the method's own phrases the longest at a place counts.

Results of a document: ``labels`` (licence families named by base phrases,
notices and expressions), ``score``, the strength of the evidence (1 for a
readable expression after a tag, 0.8 for a whole notice, 0.5 for a licence's
name, 0 for none), and ``freedom`` (1 permissive to 0 not free; the strictest
of the expressions or, without any, of the labels; null without labels).

Defined cases: a null text is empty; an empty text has no words, no label and
score 0; repeated rows get equal results; a null doc_id is kept; an expression
that breaks off is read as far as it is complete, and one without a complete
part is left out; bytes that are no UTF-8 are word characters.  Columns
besides the named ones are not read.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kestrel.llm import pieces as P

# Phrases, their licence families, and how free a family is.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this program is free software you can redistribute it": "gpl",
    "this library is free software you can redistribute it": "lgpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}
NAMES = {
    "bsd license": "bsd", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "isc license": "isc",
    "zlib license": "zlib", "boost software license": "bsl", "the unlicense": "unlicense",
    "lesser general public license": "lgpl", "affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl",
    "cc0": "cc0", "cc by": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc", "cc by nc nd": "cc-by-nc",
    "creative commons attribution": "cc-by", "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc", "creative commons attribution noderivatives": "cc-by-nd",
}
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "bsl": 1.0, "unlicense": 1.0, "cc0": 1.0,
    "cc-by": 1.0, "lgpl": 0.5, "mpl": 0.5, "epl": 0.5, "cc-by-sa": 0.5, "gpl": 0.25, "agpl": 0.25, "other": 0.25,
    "cc-by-nc": 0.0, "cc-by-nd": 0.0, "proprietary": 0.0,
}
#: Tag -> must every identifier after it be a known one?
TAGS = {"spdx license identifier": False, "license": True, "licence": True}
STRENGTH = {"expression": 1.0, "notice": 0.8, "name": 0.5, "base": 0.5}
EXCEPTION_FREEDOM = 0.5
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

_WORD_BYTE = np.array([48 <= b <= 57 or 97 <= b <= 122 or 65 <= b <= 90 or b >= 128 for b in range(256)])
_TO_WORDS = bytes((b + 32 if 65 <= b <= 90 else b) if _WORD_BYTE[b] else 32 for b in range(256))
_AFTER_TAG = {False: re.compile(rb"[ \t]*:"), True: re.compile(rb"""["']?[ \t]*[:=][ \t]*["']?""")}
_TOKEN = re.compile(rb"[ \t]*([A-Za-z0-9][A-Za-z0-9.+-]*|[()])")

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
          "labels array<string>, places array<struct<kind:string,label:string,word:long,words:long>>, "
          "expressions array<string>, score double, freedom double")


def family(identifier: str) -> str | None:
    """Licence family of an identifier (``gpl-2.0-or-later``: ``gpl``), or None."""
    head = identifier.split("-")
    for n in range(len(head), 0, -1):
        name = "-".join(head[:n]).rstrip("+")
        if name in FREEDOM and name not in ("other", "proprietary"):
            return name
    return None


def read_expression(text: bytes, at: int, known_only: bool) -> list[str]:
    """The longest complete expression that begins at ``at``, as tokens."""
    tokens, complete, depth, operand = [], 0, 0, True
    while m := _TOKEN.match(text, at):
        at, token = m.end(), m[1].decode().lower().rstrip(".")
        if operand and token == "(":
            depth += 1
        elif operand:
            after_with = bool(tokens) and tokens[-1] == "with"
            named = family(token) is not None or (after_with and token.endswith("exception"))
            if token == ")" or token in PRECEDENCE or not (
                    named or (not known_only and re.search("[-0-9]", token))):
                break
            operand = False
        elif token == ")" and depth:
            depth -= 1
        elif token in PRECEDENCE:
            operand = True
        else:
            break
        tokens.append(token)
        if not operand and not depth:
            complete = len(tokens)
    return tokens[:complete]


def postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: a complete infix expression in postfix order."""
    out, waiting = [], []
    for t in tokens:
        if t == "(":
            waiting.append(t)
        elif t == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif t in PRECEDENCE:
            while waiting and PRECEDENCE.get(waiting[-1], 0) >= PRECEDENCE[t]:
                out.append(waiting.pop())
            waiting.append(t)
        else:
            out.append(t)
    return out + waiting[::-1]


def evaluate(rpn: list[str]) -> tuple[set[str], float]:
    """(families, freedom) of a postfix expression."""
    stack, families = [], set()
    for k, t in enumerate(rpn):
        if t not in PRECEDENCE:
            name = family(t) or "other"
            stack.append((FREEDOM[name], name))
            if not (k + 1 < len(rpn) and rpn[k + 1] == "with"):  # not an exception's name
                families.add(name)
            continue
        (right, _), (left, name) = stack.pop(), stack.pop()
        stack.append(({"or": max, "and": min}[t](left, right) if t != "with" else max(left, EXCEPTION_FREEDOM), name))
    return families, stack[0][0]


def _automaton():
    """Automaton over words parted by single spaces; a phrase -> its uses."""
    memo = P.worker_memo()
    if "licences" not in memo:
        import ahocorasick
        uses: dict[str, list] = {}
        for kind, phrases in (("base", BASE), ("notice", NOTICES), ("name", NAMES)):
            for phrase, label in phrases.items():
                uses.setdefault(phrase, []).append((kind, label))
        for tag, known_only in TAGS.items():
            uses.setdefault(tag, []).append(("tag", known_only))
        a = ahocorasick.Automaton()
        for phrase, which in uses.items():
            a.add_word(f" {phrase} ", (phrase.count(" ") + 1, which))
        a.make_automaton()
        memo["licences"] = a
    return memo["licences"]


def scan_text(text: bytes, automaton) -> dict:
    """What ``SCHEMA`` holds of one text, but for its doc_id."""
    words = text.translate(_TO_WORDS).split()
    row = f" {b' '.join(words).decode('latin-1')} "
    base, own, tags, at, n = [], [], [], 0, -1
    for end, (size, uses) in automaton.iter(row):
        n += row.count(" ", at, end)  # the word that ends here
        at = end
        first = n - size + 1
        for kind, label in uses:
            if kind == "base":
                base.append((kind, label, first, size))
            elif kind == "tag":
                tags.append((n, label))
            else:
                while own and own[-1][2] >= first:  # inside this longer phrase
                    own.pop()
                if not own or own[-1][2] + own[-1][3] < first + size:
                    own.append((kind, label, first, size))
    expressions, families, freedom = [], set(), []
    if tags:
        inside = _WORD_BYTE[np.frombuffer(text, dtype=np.uint8)]
        word_ends = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
        for n, known_only in tags:
            m = _AFTER_TAG[known_only].match(text, int(word_ends[n]))
            rpn = postfix(read_expression(text, m.end(), known_only)) if m else []
            if rpn:
                named, free = evaluate(rpn)
                families |= named
                freedom.append(free)
                expressions.append(" ".join(rpn))
    labels = sorted(families | {label for _, label, *_ in base + own})
    kinds = {kind for kind, *_ in base + own} | ({"expression"} if expressions else set())
    return {
        "n_words": len(words), "n_base": len(base),
        "first_word": min((p[2] for p in base), default=None), "last_word": max((p[2] for p in base), default=None),
        "base_labels": sorted({p[1] for p in base}), "labels": labels,
        "places": [dict(zip(("kind", "label", "word", "words"), p)) for p in sorted(base + own, key=lambda p: p[2:])],
        "expressions": expressions, "score": max((STRENGTH[k] for k in kinds), default=0.0),
        "freedom": min(freedom or [FREEDOM[x] for x in labels], default=None),
    }


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (``SCHEMA``) a document."""
    schema = to_arrow_schema(StructType.fromDDL(SCHEMA))

    def run(batches):
        import pyarrow as pa
        automaton = _automaton()
        for batch in batches:
            for first, texts in P.text_batches(batch.column(1), 1 << 20):
                rows = [scan_text(t, automaton) for t in texts]
                cols = [batch.column(0).slice(first, len(texts))]
                cols += [pa.array([r[f.name] for r in rows], f.type) for f in list(schema)[1:]]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(run, SCHEMA)
