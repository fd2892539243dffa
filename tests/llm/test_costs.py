"""What the token files cost, and that their rounds are the plain ones."""

import random

import numpy as np
from kestrel.llm import grammar
from kestrel.llm import pieces as P

from . import reference as R


def plain_pairs(s, last, min_count):
    """Rounds of pair replacement, a place at a time; (symbols, rules of each round)."""
    made, fresh = [], max(s, default=0) + 1
    while True:
        pairs = [(s[i], s[i + 1]) if not last[i] else None for i in range(len(s) - 1)]
        times = {}
        for p in pairs:
            if p:
                times[p] = times.get(p, 0) + 1
        most = max(times.values(), default=0)
        if most < min_count:
            return s, made
        chosen = [p for p in sorted(times, key=lambda p: (-times[p], p)) if times[p] >= max(min_count, most // grammar.WIDE)]
        rank = {p: k for k, p in enumerate(chosen)}
        ranks = [rank.get(p, 1 << 40) for p in pairs] + [1 << 40]
        out, ends, i, run = [], [], 0, 0
        take = [False] * len(ranks)
        for i, r in enumerate(ranks[:-1]):
            run = run + 1 if i and ranks[i - 1] == r else 0
            take[i] = r < 1 << 40 and run % 2 == 0 and (run > 0 or i == 0 or r < ranks[i - 1]) and r <= ranks[i + 1]
        i = 0
        while i < len(s):
            out.append(fresh + ranks[i] if take[i] else s[i])
            ends.append(last[i + 1] if take[i] else last[i])
            i += 2 if take[i] else 1
        s, last, fresh = out, ends, fresh + len(chosen)
        made.append(chosen)


def test_pairs_are_those_of_plain_rounds():
    r = np.random.default_rng(2)
    for k in (3, 12, 40):
        parts = [r.integers(0, k, 300), np.full(90, 1), np.zeros(0, dtype=int), np.tile(r.integers(0, k, 7), 40)]
        ids = np.concatenate([np.arange(k), *parts])
        sizes = np.array([k, *map(len, parts)])
        last = np.zeros(len(ids), dtype=bool)
        last[np.cumsum(sizes[sizes > 0]) - 1] = True
        symbols, per, made = grammar.compress(ids, sizes, k, 4)
        want, rules = plain_pairs(ids.tolist(), last.tolist(), 4)
        assert symbols.tolist() == want and [[tuple(x) for x in rows.tolist()] for rows in made] == rules
        assert per.sum() == len(want) and per[3] == 0


def test_rounds_sort_only_changed_places(monkeypatch):
    """Before, every round down to the least count sorted all places again."""
    r = np.random.default_rng(4)
    phrases = [r.integers(0, 3_000, int(r.integers(2, 14))) for _ in range(2_000)]
    ids = np.concatenate([phrases[i] for i in np.minimum(r.zipf(1.25, 9_000) - 1, 1_999)])
    moved, sort = [0], np.sort

    def counted(a, *args, **kwargs):
        moved[0] += len(a)
        return sort(a, *args, **kwargs)

    monkeypatch.setattr(np, "sort", counted)
    _, _, made = grammar.compress(ids, np.array([len(ids)]), 5_001)
    assert len(made) > 5 and moved[0] < 4 * len(ids)


def test_small_memo_forgets_and_keeps_ids(monkeypatch):
    monkeypatch.setattr(P, "worker_memo", lambda held={}: held)
    r = random.Random(3)
    memo = P.byte_bpe(R.BYTE_BPE, 5)
    made = set()
    for _ in range(30):
        texts = ["".join(r.choice(["th", "\n", " ", "e", "é", "x1", ", ", "　", "\0"]) for _ in range(r.randrange(60)))
                 for _ in range(20)]
        ids, per, *_ = memo.encode([t.encode() for t in texts])
        assert [x.tolist() for x in np.split(ids, np.cumsum(per))[:-1]] == [list(x[:-1]) for x in R.token_ids(texts)]
        made.add(memo.filled)
    assert 0 in made and max(made) <= 4 * len(memo.rows)
