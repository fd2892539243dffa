"""The prefix trie against all prefixes in dictionaries."""

import hashlib
import random
import re
import zlib

import pytest

from kestrel.llm import trie as T

WORD = re.compile("[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, n int, words string"


def brute(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    seq = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        seq[c] = tuple(own.get(base, [])[:h] + v[h:])
    members, below, leaves, saved = {}, {}, {}, {}
    for c, v in seq.items():
        for d in range(len(v) + 1):
            members.setdefault(v[:d], []).append(c)
    for p in members:
        if p:
            below.setdefault(p[:-1], []).append(p)
    out = []
    for p in sorted(members, key=len, reverse=True):
        m, kids = members[p], below.get(p, [])
        leaves[p] = sum(leaves[k] for k in kids) or 1
        saved[p] = (len(m) - 1) * (len(WORD.findall(p[-1][1])) if p else 0) + sum(saved[k] for k in kids)
        ends = ",".join(map(str, sorted(c for c in m if len(seq[c]) == len(p))))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **sizes):
    d = spark.createDataFrame([(*x, "c", 1, 2, "c") for x in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, T.nodes(d, **sizes).collect()), key=str)


def corpus(seed, convs=120, said=("a b", "a  b", "", "x\ty z", "é"), longest=7):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-40, 400), convs):
        n = r.randrange(0, longest)
        rows += [(c, t, r.choice(["user", "bot"]), r.choice(said)) for t in range(n)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard_turns": 25, "ends_bits": 3}, {"shard_turns": 1, "ends_bits": 0}])
def test_against_all_prefixes(spark, sizes):
    rows = corpus(1)
    assert found(spark, rows, **sizes) == brute(rows)


def test_odd_turns(spark):
    rows = [(0, None, "user", "first"), (0, 1, None, None), (0, 1, None, None), (1, 5, "user", None), (1, 2, "", "two words"),
            (2, 1, "user", "same"), (2, 1, "bot", "same"), (None, 0, "user", "lost"), (21, 0, "user", "no base here"),
            (40, 0, "user", "x"), (47, 0, "user", "y")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_copies_and_long_texts(spark):
    """A third of all conversations are equal, one has thousands of turns and
    one a text of a megabyte."""
    rows = [(c, t, "user", "hello there") for c in range(0, 600, 2) for t in range(3)]
    rows += [(c, 0, "user", f"own {c}") for c in range(1, 600, 2)]
    rows += [(1001, t, "bot", f"{t % 3}") for t in range(3000)] + [(1020, 0, "user", "many words " * 100_000)]
    want = brute(rows)
    assert found(spark, rows) == want
    assert found(spark, rows, shard_turns=500, ends_bits=4) == want


def test_tree_layouts_and_paths():
    """Every layout of a node, keys that begin others, and shared paths."""
    r = random.Random(4)
    keys = {b""}
    for width in (1, 3, 5, 17, 40, 49, 256):
        head = r.randbytes(T.ID_BYTES - 1)
        keys |= {head + bytes([b]) for b in r.sample(range(256), width)}
        keys |= {head + bytes([r.randrange(256)]) + r.randbytes(2 * T.ID_BYTES) for _ in range(20)}
    keys = sorted(keys)
    root, todo, seen, sizes = T.build(keys), [], {}, set()
    todo = [(root, b"")]
    while todo:
        node, path = todo.pop()
        path += keys[node.key][node.begin:node.end]
        if node.value >= 0:
            seen[node.value] = path
        sizes.add((len(node.bytes) <= 16, len(node.below) > 48))
        below = node.children()
        assert [keys[c.key][c.begin] for c in below] == sorted({keys[c.key][c.begin] for c in below})
        assert node is root or node.value >= 0 or len(below) > 1
        todo += [(c, path) for c in below]
    assert seen == dict(enumerate(keys)) and sizes == {(True, False), (False, False), (False, True)}


def test_same_finds_the_first_difference():
    r = random.Random(3)
    for _ in range(500):
        a = bytes(r.randrange(2) for _ in range(r.randrange(1, 70)))
        b = a[:r.randrange(len(a) + 1)] + bytes(r.randrange(2) for _ in range(r.randrange(40)))
        n = min(len(a), len(b))
        at = r.randrange(n + 1)
        assert T._same(a, b, at, n) == next((i for i in range(at, n) if a[i] != b[i]), n)
