"""Word-piece memo shared by the tokenising operators (runs inside tasks).

A tokenizer of either library never merges over the place where white space
follows other text, so a text's ids are the concatenated ids of its *chunks*
(a run of white space and the text after it).  Most chunks of a corpus are
old acquaintances: :class:`ChunkMemo` looks the chunks of a whole batch up in
a fixed-size table with numpy, hands the unknown ones to the library in one
call, and gathers the ids.  The table has a fixed number of slots and forgets
on collision; that changes speed, never ids.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np

ASCII_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KEY_BYTES = 24          # chunks up to this length are keyed by their own bytes
_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def _masks() -> np.ndarray:
    m = np.zeros((3, KEY_BYTES + 1), dtype=np.uint64)
    for n in range(KEY_BYTES + 1):
        for w in range(3):
            k = min(max(n - 8 * w, 0), 8)
            m[w, n] = np.uint64((1 << (8 * k)) - 1)
    return m


_MASK = _masks()
_COUNT_BITS = np.uint64(16)     # a chunk of KEY_BYTES has fewer ids than 2**16
_COUNT_MASK = np.uint64((1 << 16) - 1)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i]+counts[i]-1`` of all i, concatenated."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    shift = starts.astype(np.int64) - (ends - counts)
    return np.repeat(shift, counts) + np.arange(total, dtype=np.int64)


class ChunkMemo:
    """``encode_joined(chunks)`` gets distinct chunks (bytes) and returns
    (ids, counts): all their ids in order and how many belong to each.

    ``break_bytes``/``break_marks``: the single bytes and the longer UTF-8
    sequences that count as white space for the library.
    ``cut_after_letter``: bytes that also begin a chunk when an ASCII letter
    stands before them (punctuation, for pre-tokenisers that part the two).
    """

    def __init__(self, encode_joined: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 break_bytes: bytes, break_marks: tuple[bytes, ...], cut_after_letter: bytes = b"",
                 slots_log2: int = 20):
        self.encode_joined = encode_joined
        self.has_cut = bool(cut_after_letter)
        self.kind = np.zeros(256, dtype=np.uint8)   # bits; 1: white space, 2: may begin a mark, 4: letter, 8: cut
        self.kind[[m[0] for m in break_marks]] = 2
        self.kind[list(break_bytes)] = 1
        self.kind[list(ASCII_LETTERS)] |= 4
        self.kind[list(cut_after_letter)] |= 8
        self.marks = {size: [int.from_bytes(m) for m in break_marks if len(m) == size]
                      for size in {len(m) for m in break_marks}}
        self.shift = np.uint64(64 - slots_log2)
        n = 1 << slots_log2
        # a slot is one row, so that a look-up reads one place: three words of
        # the chunk, then the place of its ids (shifted) and their number; 0: empty
        self.rows = np.zeros((n, 4), dtype=np.uint64)
        self.pool = np.zeros(1 << 16, dtype=np.int32)
        self.filled = 0

    def _append(self, ids: np.ndarray) -> int:
        while self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        at = self.filled
        self.pool[at:at + len(ids)] = ids
        self.filled += len(ids)
        return at

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text, chunk starts in the joined bytes,
        chunk lengths, ids per chunk)."""
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        joined = b"".join(texts)
        n = len(joined)
        empty = np.zeros(0, dtype=np.int64)
        if not n:
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64), empty, empty, empty
        buf = np.frombuffer(joined + bytes(KEY_BYTES), dtype=np.uint8)
        kind = self.kind.take(buf[:n])
        space = (kind & 1).view(bool)
        lead = np.flatnonzero(kind & 2)
        for size, codes in self.marks.items() if len(lead) else ():
            code = sum(buf[lead + i].astype(np.int64) << (8 * (size - 1 - i)) for i in range(size))
            at = lead[np.isin(code, codes)]
            for i in range(size):
                space[at + i] = True
        first = space.copy()
        first[1:] &= ~space[:-1]
        if self.has_cut:
            first[1:] |= ((kind[1:] >> 3) & (kind[:-1] >> 2) & 1).view(bool)
        text_start = (np.cumsum(sizes) - sizes)[sizes > 0]
        first[text_start] = True
        starts = np.flatnonzero(first)
        lens = np.diff(starts, append=n)
        del first, space, kind

        short = lens <= KEY_BYTES
        # the eight bytes from every place on; few chunks reach into a second or third word
        words = np.ndarray(n + KEY_BYTES - 7, dtype=np.uint64, buffer=buf, strides=(1,))
        ks = [words[starts] & _MASK[0].take(np.minimum(lens, 8))]
        h = (ks[0] * _MIX[0]) ^ (lens.astype(np.uint64) * _MIX[1])
        for w in (1, 2):
            k = np.zeros(len(starts), dtype=np.uint64)
            far = np.flatnonzero(lens > 8 * w)
            k[far] = words[np.minimum(starts.take(far) + 8 * w, n + KEY_BYTES - 8)] & _MASK[w].take(
                np.minimum(lens.take(far), KEY_BYTES))
            h[far] ^= k.take(far) * _MIX[w]
            ks.append(k)
        h ^= h >> np.uint64(31)
        h *= _MIX[0]
        slot = (h >> self.shift).astype(np.int64)

        row = self.rows.take(slot, axis=0)
        hit = (row[:, 3] != 0) & short
        for w in range(3):
            hit &= row[:, w] == ks[w]
        ptr = np.where(hit, row[:, 3] >> _COUNT_BITS, 0).astype(np.int64)
        cnt = np.where(hit, row[:, 3] & _COUNT_MASK, 0).astype(np.int64)
        miss = np.flatnonzero(~hit)
        if len(miss):
            begin, end = starts[miss], (starts + lens)[miss]
            unknown = [joined[a:b] for a, b in zip(begin.tolist(), end.tolist())]
            where = {c: i for i, c in enumerate(dict.fromkeys(unknown))}
            nth = np.fromiter(map(where.__getitem__, unknown), dtype=np.int64, count=len(miss))
            ids, counts = self.encode_joined(list(where))
            new_ptr = self._append(ids) + np.cumsum(counts) - counts
            ptr[miss] = new_ptr[nth]
            cnt[miss] = counts[nth]
            keep = miss[short[miss]]
            s, k = slot[keep], nth[short[miss]]
            self.rows[s] = np.stack([*[ks[w][keep] for w in range(3)], new_ptr[k].astype(np.uint64)
                                     << _COUNT_BITS | counts[k].astype(np.uint64)], axis=1)
        flat = self.pool.take(ragged(ptr, cnt))
        if self.filled > 4 * len(self.rows):  # mostly overwritten entries: forget all
            self.rows[:] = 0
            self.filled = 0
        bounds = np.concatenate([[0], np.cumsum(cnt)])
        text_no_start = np.searchsorted(starts, np.cumsum(sizes) - sizes)
        text_no_end = np.searchsorted(starts, np.cumsum(sizes))
        per_text = bounds[text_no_end] - bounds[text_no_start]
        return flat, per_text, starts, lens, cnt


def text_batches(column, max_bytes: int = 1 << 21) -> Iterator[tuple[int, list[bytes]]]:
    """Cut an Arrow column of binaries into runs of about ``max_bytes`` (a
    longer text makes a run of its own; null is empty), a few rows out of Arrow
    at a time; yields (row of the first, texts)."""
    run, size, first = [], 0, 0
    for at in range(0, len(column), 256):
        for i, v in enumerate(column.slice(at, 256).to_pylist(), at):
            v = v or b""
            if run and size + len(v) > max_bytes:
                yield first, run
                run, size, first = [], 0, i
            run.append(v)
            size += len(v)
    if run:
        yield first, run


# -- byte-level BPE of the tokenizers library ---------------------------------

#: White space of the pre-tokeniser's \s (fixed values of Unicode).
BYTE_BPE_SPACE = b"\x09\x0a\x0b\x0c\x0d\x20"
BYTE_BPE_MARKS = tuple(chr(c).encode() for c in (
    0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))

#: Punctuation that the pre-tokeniser parts from a letter before it (the
#: apostrophe can begin a contraction and isn't among them).
BYTE_BPE_CUT = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


def worker_memo() -> dict:
    """A dictionary that lives as long as the Python worker.  (Functions reach
    workers by value, so a module's own globals would be new in every task.)"""
    holder = sys.modules.get("_kestrel_worker_memo")
    if holder is None:
        holder = sys.modules["_kestrel_worker_memo"] = types.ModuleType("_kestrel_worker_memo")
        holder.memo = {}
    return holder.memo



def byte_bpe(path: str, slots_log2: int = 20) -> ChunkMemo:
    """Memo over ``Tokenizer.from_file(path)`` (byte-level BPE), one a worker."""
    memo = worker_memo()
    if ("byte", path, slots_log2) not in memo:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        added = {i: len(t.content.encode()) for i, t in tok.get_added_tokens_decoder().items()}
        special = {b for t in tok.get_added_tokens_decoder().values() for b in t.content.encode()}
        width = np.zeros(tok.get_vocab_size(), dtype=np.int64)
        for piece, i in tok.get_vocab().items():
            width[i] = added.get(i, len(piece))  # a byte-level piece has one character a byte

        starts = tuple(bytes([b]) for b in BYTE_BPE_SPACE) + BYTE_BPE_MARKS
        single, tails = frozenset(BYTE_BPE_SPACE), frozenset(s[-1] for s in starts)

        def between(c: bytes) -> bool:
            """Does white space stand before the chunk and none after it?  (Its
            first and last byte mostly tell.)"""
            return (c[0] in single or c.startswith(starts)) and not (c[-1] in tails and c.endswith(starts))

        def encode_joined(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            # chunks can stand one after the other if the next begins with white
            # space and the one before doesn't end with it
            sizes = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
            kept = list(map(between, chunks))
            after = list(compress(chunks, kept))
            cut = [] if len(after) == len(chunks) else [c for c, x in zip(chunks, kept) if not x]
            if cut:  # few: text starts, punctuation, trailing white space
                order = {c: i for i, c in enumerate(after + cut)}
            runs = [b"".join(after).decode()] * bool(after) + [c.decode() for c in cut]
            ids = np.concatenate([np.asarray(e.ids, dtype=np.int64)
                                  for e in tok.encode_batch_fast(runs, add_special_tokens=False)])
            ends = np.cumsum(width[ids])
            if cut:
                sizes_in = np.fromiter(map(len, order), dtype=np.int64, count=len(order))
            else:
                sizes_in = sizes
            upto = np.searchsorted(ends, np.cumsum(sizes_in), side="right")
            if ends[-1] != sizes.sum():
                raise ValueError("the tokenizer does not keep every byte: not a byte-level BPE")
            counts = np.diff(upto, prepend=0)
            if not cut:
                return ids, counts
            place = np.fromiter(map(order.__getitem__, chunks), dtype=np.int64, count=len(chunks))
            begin = (np.cumsum(counts) - counts)[place]
            return ids[ragged(begin, counts[place])], counts[place]

        memo["byte", path, slots_log2] = ChunkMemo(encode_joined, BYTE_BPE_SPACE, BYTE_BPE_MARKS,
                                                   bytes(set(BYTE_BPE_CUT) - special), slots_log2)
    return memo["byte", path, slots_log2]


def byte_bpe_partial(path: str) -> np.ndarray:
    """By id: does the piece hold only a part of a character?"""
    memo = worker_memo()
    if ("partial", path) not in memo:
        from tokenizers import Tokenizer
        from tokenizers.decoders import ByteLevel

        tok, plain = Tokenizer.from_file(path), ByteLevel()
        partial = np.zeros(tok.get_vocab_size(), dtype=bool)
        for piece, i in tok.get_vocab().items():
            partial[i] = "\ufffd" in plain.decode([piece])
        memo["partial", path] = partial
    return memo["partial", path]
