"""Brute-force versions that the operators are held against."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile("[^\x20\x09-\x0D]+")


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def token_ids(texts):
    t = Tokenizer.from_file(BYTE_BPE)
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


class Groups:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, a):
        while self.up[a] != a:
            a = self.up[a]
        return a

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    count = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for i in range(64):
            count[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * count[i] > len(shingles))


KINDS = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                          r"""([A-Za-z0-9+/_.=-]+)""", re.A), 2, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile("[0-9a-f]+"), 0, 24),
}


def secret_spans(text):
    out = []
    for n, (pattern, group, least) in enumerate(KINDS.values()):
        out += [(m.start(), n, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return ",".join(f"{list(KINDS)[n]}:{a}:{b}" for a, n, b in sorted(out))


def base_figures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    marked = [False] * len(words)
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            marked[i] = marked[i + 1] = marked[i + 2] = True
    seen, dups = set(), 0
    for line in text.split("\n"):
        dups += line in seen and bool(WORD.search(line))
        seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, sum(marked)
