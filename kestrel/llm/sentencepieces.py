"""SentencePiece encoding with the original byte span of every piece, and
decoding.

Method: a text is first normalised as the model says.  At each position the
longest prefix found in the model's compiled character map is replaced by its
target (else one character stays), and every normalised byte keeps the source
byte that it came from.  Pieces are then found over the normalised text and
their borders projected through that alignment.  With an identity map the
alignment is arithmetic and isn't stored.

Defined cases: null and empty texts have no pieces and decode to "".  Rows
are kept one to one, repeated ones too; columns besides the two named are
not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import pieces as P

SPACE = "▁"            # the escaped space of the library
SPACE_BYTES = SPACE.encode()
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of a model file

ENCODED = "doc_id long, ids array<int>, begin array<int>, end array<int>, decoded string"


# -- the model file -----------------------------------------------------------

def wire_fields(blob: bytes) -> Iterator[tuple[int, int | bytes, int, int]]:
    """(field number, value, first byte, end byte) of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = blob[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(blob):
        first = at
        key = varint()
        if key & 7 == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            value, at = blob[at:at + size], at + size
        yield key >> 3, value, first, at


class Model:
    """What a model file says: pieces with their types, normaliser settings,
    and the same model without a normaliser (for texts normalised here)."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            blob = f.read()
        self.pieces: list[tuple[str, int]] = []
        bare, norm = [], {}
        for number, value, first, end in wire_fields(blob):
            if number == 1:
                own = {k: v for k, v, *_ in wire_fields(value)}
                self.pieces.append((own[1].decode(), own.get(3, NORMAL)))
            if number == 3:
                norm = {k: v for k, v, *_ in wire_fields(value)}
            else:
                bare.append(blob[first:end])
        # name, no dummy prefix, keep white space, escape it
        spec = b"\x0a\x08identity" + b"\x18\x00" + b"\x20\x00" + b"\x28\x01"
        self.bare = b"".join(bare) + b"\x1a" + bytes([len(spec)]) + spec
        self.blob = blob
        self.normalizer = Normalizer(norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1)))


class Normalizer:
    """Longest-prefix normalisation through a compiled character map (a
    double-array trie and a pool of zero-ended targets)."""

    def __init__(self, charsmap: bytes, dummy_prefix: bool, strip_spaces: bool):
        self.dummy_prefix, self.strip_spaces = dummy_prefix, strip_spaces
        self.units: tuple[int, ...] = ()
        if charsmap:
            size = struct.unpack_from("<I", charsmap)[0]
            self.units = struct.unpack_from(f"<{size // 4}I", charsmap, 4)
            self.pool = charsmap[4 + size:]
        self.identity = not self.units and not strip_spaces

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix at ``at`` and its target."""
        units = self.units
        node = units[0]
        pos = (node >> 10) << ((node & (1 << 9)) >> 6)
        found = None
        for k in range(at, len(data)):
            pos ^= data[k]
            if pos >= len(units):
                break
            node = units[pos]
            if node & 0x800000FF != data[k]:
                break
            pos ^= (node >> 10) << ((node & (1 << 9)) >> 6)
            if node >> 8 & 1:
                start = units[pos] & 0x7FFFFFFF
                found = (k + 1 - at, self.pool[start:self.pool.index(b"\0", start)])
        return found

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised text with spaces escaped, source byte of each of its
        bytes and of its end)."""
        out, src = bytearray(), []
        at, n = 0, len(data)
        steps = []
        while at < n:
            hit = self.longest(data, at) if self.units else None
            if hit:
                size, target = hit
            else:
                lead = data[at]
                size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                target = data[at:at + size]
            steps.append((at, target))
            at += size
        end = n
        if self.strip_spaces:
            first = next((i for i, (_, t) in enumerate(steps) if t != b" "), len(steps))
            steps = steps[first:]
        if not steps:
            return b"", np.zeros(1, dtype=np.int64)
        if self.dummy_prefix:
            out += SPACE_BYTES
            src += [steps[0][0]] * 3
        blank = self.strip_spaces
        for at, target in steps:
            if self.strip_spaces:
                while blank and target.startswith(b" "):
                    target = target[1:]
            if not target:
                continue
            escaped = target.replace(b" ", SPACE_BYTES)
            out += escaped
            src += [at] * len(escaped)
            if self.strip_spaces:
                blank = target.endswith(b" ")
        if self.strip_spaces:
            while out.endswith(SPACE_BYTES):
                end = src[-3]
                del out[-3:], src[-3:]
        return bytes(out), np.array([*src, end], dtype=np.int64)


# -- encoding -------------------------------------------------------------------

class Encoder:
    """One model in a worker: ids and source spans of many texts at once."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = Model(path)
        self.normalizer = self.model.normalizer
        self.whole = SentencePieceProcessor(model_proto=self.model.blob)
        bare = SentencePieceProcessor(model_proto=self.model.bare)
        kinds = np.array([k for _, k in self.model.pieces])
        self.is_byte = kinds == BYTE
        # bytes of a piece in the escaped text, and the spaces among its characters
        self.width = np.array([1 if k == BYTE else len(p.encode()) for p, k in self.model.pieces], dtype=np.int64)
        self.spaces = np.array([0 if k == BYTE else p.count(SPACE) for p, k in self.model.pieces], dtype=np.int64)
        self.chars = np.array([1 if k == BYTE else len(p) for p, k in self.model.pieces], dtype=np.int64)
        self.lead = np.zeros(len(kinds), dtype=np.int64)  # for a byte piece: bytes of the character it begins
        for i, (p, k) in enumerate(self.model.pieces):
            if k == BYTE:
                b = int(p[3:5], 16)
                self.lead[i] = 0 if 0x80 <= b < 0xC0 else 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
        inner = any(k in (NORMAL, USER_DEFINED) and SPACE in p.lstrip(SPACE) for p, k in self.model.pieces)
        if inner or not self.is_byte.any():
            raise ValueError("pieces must not run over a space, and unknown characters must fall back to bytes")

        def encode_joined(chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            start = (b" ", SPACE_BYTES)
            join = [c for c in chunks if c.startswith(start) and not c.endswith(start)]
            alone = [c for c in chunks if not c.startswith(start) or c.endswith(start)]
            runs = [b"".join(join).decode()] * bool(join) + [c.decode() for c in alone]
            ids = np.concatenate([np.asarray(x, dtype=np.int64) for x in bare.encode(runs, num_threads=1)])
            order = join + alone
            sizes = np.fromiter((len(c) + 2 * c.count(b" ") for c in order), dtype=np.int64, count=len(order))
            ends = np.cumsum(self.width[ids])
            counts = np.diff(np.searchsorted(ends, np.cumsum(sizes), side="right"), prepend=0)
            if not alone:
                return ids, counts
            nth = {c: i for i, c in enumerate(order)}
            place = np.fromiter(map(nth.__getitem__, chunks), dtype=np.int64, count=len(chunks))
            begin = (np.cumsum(counts) - counts)[place]
            return ids[P.ragged(begin, counts[place])], counts[place]

        self.memo = P.ChunkMemo(encode_joined, b" ", (SPACE_BYTES,))

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list]:
        """(ids of all texts, ids per text, alignment of each text or None)."""
        if self.normalizer.identity:
            lead = b" " if self.normalizer.dummy_prefix else b""
            flat, per, *_ = self.memo.encode([lead + t if t else b"" for t in texts])
            return flat, per, [None] * len(texts)
        norm = [self.normalizer(t) for t in texts]
        flat, per, *_ = self.memo.encode([t for t, _ in norm])
        return flat, per, [a for _, a in norm]

    def spans(self, texts: list[bytes], flat: np.ndarray, per: np.ndarray, align: list
              ) -> tuple[np.ndarray, np.ndarray]:
        """First and end source byte of every piece (relative to its text).  A
        character in bytes belongs to the last of its byte pieces; the others
        are empty spans at its start."""
        width = self.width[flat]
        upto = np.cumsum(width)
        first = np.cumsum(per) - per
        base = np.where(per > 0, (upto - width)[np.minimum(first, max(len(flat) - 1, 0))], 0) if len(flat) else first
        base = np.repeat(base, per)
        begin, end = upto - width - base, upto - base
        plain = self.normalizer.identity
        if plain:
            seen = np.cumsum(self.spaces[flat])
            at0 = np.repeat(np.where(per > 0, (seen - self.spaces[flat])[np.minimum(first, max(len(flat) - 1, 0))], 0)
                            if len(flat) else first, per)
            prefix = 1 if self.normalizer.dummy_prefix else 0
            begin = np.maximum(begin - 2 * (seen - self.spaces[flat] - at0) - prefix, 0)
            end = np.maximum(end - 2 * (seen - at0) - prefix, 0)
        bounds = np.concatenate([[0], np.cumsum(per)])
        for i, (t, a) in enumerate(zip(texts, align)):
            own = slice(bounds[i], bounds[i + 1])
            if plain and SPACE_BYTES in t:  # an escaped space of the source itself: look the place up
                lead = b" " if self.normalizer.dummy_prefix else b""
                raw = np.frombuffer(lead + t, dtype=np.uint8)
                a = np.append(np.repeat(np.arange(len(raw)), np.where(raw == 32, 3, 1)), len(raw)) - len(lead)
                a = np.maximum(a, 0)
            elif plain:
                continue
            w = width[own]
            e = np.cumsum(w)
            begin[own], end[own] = a[e - w], a[e]
        byte = np.flatnonzero(self.is_byte[flat])
        if len(byte):
            lead = self.lead[flat[byte]]
            head = byte[lead > 1]
            for size in (2, 3, 4):
                at = head[self.lead[flat[head]] == size]
                at = at[at + size <= len(flat)]
                start = begin[at].copy()
                stop = end[at + size - 1].copy()
                for k in range(size):
                    begin[at + k] = start
                    end[at + k] = start if k < size - 1 else stop
        return begin, end


def encoder(path: str) -> Encoder:
    memo = P.worker_memo()
    if ("sentencepiece", path) not in memo:
        memo["sentencepiece", path] = Encoder(path)
    return memo["sentencepiece", path]


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text",
           decode: bool = True) -> DataFrame:
    """One row a document: ``ENCODED`` (``decoded`` null unless asked for)."""

    def run(batches):
        import pyarrow as pa
        enc = encoder(model)
        for batch in batches:
            keys = batch.column(0)
            for first, texts in P.text_batches(batch.column(1), 1 << 20):
                flat, per, align = enc.ids(texts)
                begin, end = enc.spans(texts, flat, per, align)
                bounds = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
                decoded = [None] * len(texts)
                if decode:
                    ids, b = flat.tolist(), bounds.tolist()
                    rows = [ids[x:y] for x, y in zip(b, b[1:])]
                    some = iter(enc.whole.decode([r for r in rows if r], num_threads=1)) if ids else iter(())
                    decoded = [next(some) if r else "" for r in rows]
                offsets = pa.array(bounds)
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (flat, begin, end)]
                yield pa.RecordBatch.from_arrays([keys.slice(first, len(texts)), *lists, pa.array(decoded, pa.string())],
                                                 names=["doc_id", "ids", "begin", "end", "decoded"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, model: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts of id sequences: (doc_id, text); null or no ids give ""."""

    def run(batches):
        import pyarrow as pa
        enc = encoder(model)
        for batch in batches:
            rows = batch.column(1).to_pylist()
            some = iter(enc.whole.decode([r for r in rows if r], num_threads=1)) if any(rows) else iter(())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([next(some) if r else "" for r in rows], pa.string())],
                names=["doc_id", "text"])

    return encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>")
                          ).mapInArrow(run, "doc_id long, text string")
