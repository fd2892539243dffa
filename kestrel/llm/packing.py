"""Best-fit packing of tokenised documents into fixed-length sequences.

Method (length-histogram planning): documents are tokenised where they lie
and cut into pieces; only the *counts* per piece length are gathered (at most
``capacity`` numbers).  Best-fit decreasing runs over those counts: a bin
range is a run of sequences with the same room left, and one step places as
many pieces of a length as the whole range takes.  The outcome is a small
table of slot ranges per length; pieces take their slots by their rank within
their length.  Ranks are taken per (length, salt) with the salts' offsets
added, so a length that most pieces share is ranked by many tasks.

Defined cases: a null text packs as an empty one (its end id alone); repeated
rows are packed as often as they occur; a null doc_id stays null; an empty
table gives an empty result.  Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm import pieces as P
from kestrel.llm.tables import stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: a document's ids and ``end_id``, cut from the back into
    pieces of ``capacity``, so that only piece 0 may be shorter."""

    def run(batches):
        import pyarrow as pa
        memo = P.byte_bpe(tokenizer)
        for batch in batches:
            keys = batch.column(0)
            for first, texts in P.text_batches(batch.column(1)):
                flat, per, *_ = memo.encode(texts)
                total = per + 1
                ids = np.full(int(total.sum()), end_id, dtype="<u4")
                begin = np.cumsum(total) - total
                ids[P.ragged(begin, per)] = flat
                n = -(-total // capacity)
                head = total - (n - 1) * capacity
                rows = np.repeat(np.arange(len(texts)), n)
                piece = P.ragged(np.zeros(len(n), dtype=np.int64), n)
                start = np.where(piece > 0, head[rows] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[rows])
                raw, at = memoryview(ids.tobytes()), (begin[rows] + start) * 4
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + length * 4).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(rows + first)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(run, PIECES)


@dataclass
class Plan:
    """Slot ranges: pieces of ``length`` with rank in [rank, rank + n) go to
    sequence ``sequence + (r - rank) // each`` at
    ``offset + (r - rank) % each * length``; rows ascend by (length, rank)."""

    length: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def plan_slots(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing over a length histogram."""
    rows, made = [], 0
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges (first sequence, sequences)
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def place(space: int, first: int, bins: int) -> int:
            """Fill bins of a range in order; returns how many bins took pieces."""
            nonlocal left, rank
            each = space // length
            took = 0
            for per, n in ((each, min(bins, left // each)), (left % each, 1)):
                if per and n and took < bins and left >= per:
                    rows.append((length, rank, per, first + took, capacity - space))
                    rest = space - per * length
                    if rest:
                        todo.append((rest, first + took, n))
                    left, rank, took = left - per * n, rank + per * n, took + n
                    if left >= each:
                        break
            return took

        todo: list[tuple[int, int, int]] = []
        for space in sorted(r for r in room if r >= length):
            ranges = room.pop(space)
            while ranges and left:
                first, bins = ranges.pop()
                took = place(space, first, bins)
                if took < bins:
                    ranges.append((first + took, bins - took))
            if ranges:
                room[space] = ranges
            if not left:
                break
        if left:
            made += place(capacity, made, left)
        for rest, first, n in todo:
            room.setdefault(rest, []).append((first, n))
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return Plan(*cols, sequences=made)


def ranked_within_length(cut: DataFrame, total: int, per_task: int = 20_000) -> DataFrame:
    """Add ``rank`` (0-based within length), each length over many tasks."""
    salts = max(1, total // per_task)
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    return (salted.withColumn("_r", F.row_number().over(own) - 1)
            .join(offsets, ["length", "_salt"])
            .withColumn("rank", F.col("_r") + F.col("_before")).drop("_r", "_salt", "_before"))


def take_slots(ranked: DataFrame, plan: Plan) -> DataFrame:
    """The planned slot of every piece.  The plan rides along as arrays: its
    size depends on ``capacity``, not on the number of documents."""
    span = 1 << 40  # more than any rank; (length, rank) as one number
    key = plan.length * span + plan.rank

    def run(batches):
        import pyarrow as pa
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            row = np.searchsorted(key, length * span + rank, side="right") - 1
            nth = rank - plan.rank[row]
            sequence = plan.sequence[row] + nth // plan.each[row]
            offset = plan.offset[row] + nth % plan.each[row] * length
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return (ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long"))
            .mapInArrow(run, PACKED))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their place: ``PACKED`` columns."""
    cut = stored(cut_pieces(docs, tokenizer, capacity, end_id, doc_id, text), "pieces")
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = plan_slots(counts, capacity)
    return take_slots(ranked_within_length(cut, sum(counts.values())), plan)
