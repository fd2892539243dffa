"""Token ids in grammar-compressed files with random access.

Method (Re-Pair, in rounds): a shard holds the documents of one range of
doc_ids in ascending order, and shards follow each other likewise.  Over the
ids of a container, pairs of neighbours are counted; frequent pairs (those
that occur ``MIN_COUNT`` times) become nonterminals and are replaced wherever
they stand (in places that compete, the more frequent pair wins); this repeats
until no pair is frequent.  No rule reaches over a document's end.  A container stores the
rules, the length each expands to, each document's id and symbol counts, and
the symbols, so any document, or any stretch of one, decodes alone.

Container, little endian: magic ``RPG1``; u32 first nonterminal, rounds,
rules, documents, bytes of a symbol; u32 rules of each round; u32 left and
right of each rule; u32 expansion length of each rule; i64 doc_id and u8 null
flag, u32 ids and u32 symbols of each document; symbols.

Defined cases: a null text is the end id alone; a null doc_id sorts before
all others; repeated rows are stored as often as they occur, ties in the
order of their texts' hashes; an empty table gives no container.  Columns besides the
two named are not read.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import pieces as P
from kestrel.llm.tables import stored
from kestrel.operators.ordering import running_sums

MAGIC = b"RPG1"
DOCS_PER_CONTAINER = 4096   # a container is closed once it holds so many documents
SEGMENT_IDS = 1 << 20       # or so many ids
MIN_COUNT = 16              # least count of a pair that gets a rule
WIDE = 8                    # a round takes pairs down to the most frequent count over this
BINS_LOG2 = 18              # bins in which the pairs of a container are counted first
MEMO_LOG2 = 22              # slots of a worker's table of chunks (32 bytes each): few new chunks drive out others

CONTAINERS = "shard long, segment int, n_docs int, n_ids long, n_symbols long, payload binary"
DOCUMENTS = ("shard long, segment int, doc_id long, start_in_segment long, n_tokens long, ids_crc32 long, "
             "n_symbols long")


# -- one container ----------------------------------------------------------------

def _bins(key: np.ndarray) -> np.ndarray:
    """A bin of every pair."""
    if key.dtype == np.uint32:
        return (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BINS_LOG2)
    return (key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BINS_LOG2)


def _frequent_pairs(key: np.ndarray, min_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, pairs, number of each place's pair): the pairs that occur
    ``min_count`` times in ``key``, ascending, and all places of theirs."""
    places, bins = np.arange(len(key)), None
    if len(key) > 1 << (BINS_LOG2 - 2):     # a rare pair seldom shares a bin that is full enough: less to sort
        bins = _bins(key).astype(np.int64)
        places = np.flatnonzero((np.bincount(bins, minlength=1 << BINS_LOG2) >= min_count).take(bins))
        key, bins = key.take(places), bins.take(places)
    ordered = np.sort(key)
    new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(key)])
    pairs = ordered[new[np.diff(new, append=len(ordered)) >= min_count]]
    if not len(pairs):
        return places[:0], pairs, places[:0]
    if bins is None:
        nth = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
    else:                                   # most places find their pair by its bin
        table = np.zeros(1 << BINS_LOG2, dtype=np.int64)
        table[_bins(pairs)] = np.arange(len(pairs))
        nth = table.take(bins)
        other = np.flatnonzero(pairs.take(nth) != key)
        nth[other] = np.minimum(np.searchsorted(pairs, key.take(other)), len(pairs) - 1)
    found = np.flatnonzero(pairs.take(nth) == key)
    return places.take(found), pairs, nth.take(found)


def compress(ids: np.ndarray, doc_sizes: np.ndarray, base: int, min_count: int = MIN_COUNT
             ) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(symbols, symbols per document, (left, right) rows of each round).

    Places are linked to their neighbours, so a round touches only the places
    of frequent pairs: a pair of old symbols never becomes more frequent, and
    one with a new symbol stands beside a place that was just replaced."""
    n = len(ids)
    used = np.flatnonzero(np.bincount(ids, minlength=1))    # symbols are numbered anew: used ids, then rules
    dense = np.zeros(int(ids.max(initial=0)) + 1, dtype=np.uint32)
    dense[used] = np.arange(len(used))
    s = np.append(dense.take(ids), np.uint32(0))
    doc_ends = np.cumsum(doc_sizes[doc_sizes > 0])
    after, before = np.arange(1, n + 2), np.arange(-1, n)   # n: none, at the ends of documents
    after[doc_ends - 1] = n
    before[np.concatenate([[0], doc_ends])] = n
    here, touched = np.ones(n, dtype=bool), np.zeros(n + 1, dtype=bool)
    never = np.iinfo(np.int32).max
    rank = np.full(n + 1, never, dtype=np.int32)
    made: list[np.ndarray] = []
    n_rules = 0
    low, high = np.uint64((1 << 32) - 1), np.uint64(32)
    pairs = np.zeros(0, dtype=np.uint64)                    # that were frequent once: two symbols of 32 bits
    live = pair = np.zeros(0, dtype=np.int64)               # their places, and which pair stands there
    fresh = np.flatnonzero(after[:n] < n)                   # places whose pair was not counted yet
    while True:
        if len(fresh):
            left, right = s.take(fresh), s.take(after.take(fresh))
            if len(used) + n_rules <= 1 << 16:              # half the work of sorting
                places, found, nth = _frequent_pairs(left << np.uint32(16) | right, min_count)
                found = (found >> np.uint32(16)).astype(np.uint64) << high | found & np.uint32((1 << 16) - 1)
            else:
                places, found, nth = _frequent_pairs(left.astype(np.uint64) << high | right, min_count)
            live, pair = np.concatenate([live, fresh.take(places)]), np.concatenate([pair, nth + len(pairs)])
            pairs = np.concatenate([pairs, found])
        times = np.bincount(pair, minlength=len(pairs))
        if times.max(initial=0) < min_count:
            break
        chosen = np.flatnonzero(times >= max(min_count, times.max() // WIDE))
        chosen = chosen[np.lexsort((pairs[chosen], -times[chosen]))]        # by rank
        rank_of = np.full(len(pairs), never, dtype=np.int32)
        rank_of[chosen] = np.arange(len(chosen))
        own = rank_of.take(pair)
        ranked = np.flatnonzero(own < never)
        in_order = np.sort(live.take(ranked) << 32 | own.take(ranked))
        some, own = in_order >> 32, in_order & never
        follow = after.take(some)
        # in places that compete, how far is each in a run of its own pair
        first = np.flatnonzero(np.concatenate([[True], (follow[:-1] != some[1:]) | (own[1:] != own[:-1])]))
        odd = np.arange(len(some)) - np.repeat(first, np.diff(first, append=len(some)))
        rank[some] = own
        wins = np.flatnonzero((odd % 2 == 0) & ((odd > 0) | (own < rank.take(before.take(some))))
                              & (own <= rank.take(follow)))
        rank[some] = never
        where, gone = some.take(wins), follow.take(wins)
        s[where] = own.take(wins) + (len(used) + n_rules)
        here[gone] = False
        beyond = after.take(gone)
        after[where] = beyond
        before[beyond] = where
        before[n] = n
        made.append(np.stack([pairs[chosen] >> high, pairs[chosen] & low], axis=1).astype(np.int64))
        n_rules += len(chosen)
        # the places replaced and those before them hold another pair now
        touched[where] = touched[n] = True
        ahead = before.take(where)
        ahead = ahead.take(np.flatnonzero(~touched.take(ahead)))
        touched[ahead] = touched[gone] = True
        keep = np.flatnonzero(~touched.take(live) & (times >= min_count).take(pair))
        live, pair = live.take(keep), pair.take(keep)
        touched[where] = touched[ahead] = touched[gone] = False
        fresh = np.concatenate([where, ahead])
        fresh = fresh.take(np.flatnonzero(after.take(fresh) < n))
    left = np.flatnonzero(here)
    per = np.zeros(len(doc_sizes), dtype=np.int64)
    per[doc_sizes > 0] = np.diff(np.searchsorted(left, doc_ends), prepend=0)
    back = np.concatenate([used, base + np.arange(n_rules)])
    return back.take(s.take(left)), per, [back.take(rows) for rows in made]


def pack_container(doc_ids: list[int | None], doc_sizes: np.ndarray, ids: np.ndarray, base: int) -> tuple[bytes, int]:
    symbols, per, made = compress(ids, doc_sizes, base)
    rules = np.concatenate([*made, np.zeros((0, 2), dtype=np.int64)])
    length = np.ones(base + len(rules), dtype=np.int64)
    at = base
    for rows in made:
        length[at:at + len(rows)] = length[rows[:, 0]] + length[rows[:, 1]]
        at += len(rows)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    return b"".join([
        MAGIC, struct.pack("<5I", base, len(made), len(rules), len(doc_ids), width),
        np.array([len(r) for r in made], dtype="<u4").tobytes(),
        rules.astype("<u4").T.tobytes(), length[base:].astype("<u4").tobytes(),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        np.array([d is None for d in doc_ids], dtype="u1").tobytes(),
        doc_sizes.astype("<u4").tobytes(), per.astype("<u4").tobytes(), symbols.astype(f"<u{width}").tobytes()]
    ), len(symbols)


@dataclass
class Container:
    """A container opened for reading."""

    base: int
    rules: list[np.ndarray]
    length: np.ndarray
    doc_ids: list[int | None]
    sizes: np.ndarray
    per: np.ndarray
    symbols: np.ndarray

    @classmethod
    def open(cls, payload: bytes) -> "Container":
        if payload[:4] != MAGIC:
            raise ValueError("not a grammar container")
        base, rounds, n_rules, n_docs, width = struct.unpack_from("<5I", payload, 4)
        at = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            a = np.frombuffer(payload, dtype=kind, count=n, offset=at)
            at += a.nbytes
            return a

        each = take("<u4", rounds)
        left, right = take("<u4", n_rules).astype(np.int64), take("<u4", n_rules).astype(np.int64)
        rules = np.split(np.stack([left, right], axis=1), np.cumsum(each.astype(np.int64))[:-1]) if rounds else []
        length = take("<u4", n_rules).astype(np.int64)
        ids, null = take("<i8", n_docs), take("u1", n_docs)
        sizes, per = take("<u4", n_docs).astype(np.int64), take("<u4", n_docs).astype(np.int64)
        symbols = take(f"<u{width}", int(per.sum())).astype(np.int64)
        return cls(base, rules, np.concatenate([np.ones(base, dtype=np.int64), length]),
                   [None if x else d for d, x in zip(ids.tolist(), null.tolist())], sizes, per, symbols)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of a stretch of symbols."""
        if not hasattr(self, "_pool"):
            pool, off = [np.arange(self.base, dtype=np.int64)], np.arange(self.base, dtype=np.int64)
            filled = self.base
            for rows in self.rules:
                flat = rows.reshape(-1)
                so_far = np.concatenate(pool)
                pool = [so_far, so_far[P.ragged(off[flat], self.length[flat])]]
                own = self.length[len(off):len(off) + len(rows)]
                off = np.concatenate([off, filled + np.cumsum(own) - own])
                filled += int(own.sum())
            self._pool, self._off = np.concatenate(pool), off
        return self._pool[P.ragged(self._off[symbols], self.length[symbols])]

    def document(self, k: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start:stop`` of document number ``k``, decoding only the
        symbols that cover them."""
        stop = int(self.sizes[k]) if stop is None else min(stop, int(self.sizes[k]))
        first = int(self.per[:k].sum())
        own = self.symbols[first:first + int(self.per[k])]
        ends = np.cumsum(self.length[own])
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        skipped = int(ends[a - 1]) if a else 0
        return self.expand(own[a:b])[start - skipped:max(stop, start) - skipped]


# -- tables of containers -----------------------------------------------------------

def write(docs: DataFrame, tokenizer: str, end_id: int = 2, base: int = 50_257, doc_id: str = "doc_id",
          text: str = "text", docs_per_shard: int = DOCS_PER_CONTAINER, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Tokenise, append ``end_id``, compress, and write the containers
    (``CONTAINERS``; in the order (shard, segment), which is that of the files,
    they hold ascending doc_ids).  A shard is a range partition, so rows
    without a doc_id are spread like any others.  Returns the written table."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        memo = P.byte_bpe(tokenizer, MEMO_LOG2)
        shard, segment, held, n_ids, n_docs = TaskContext.get().partitionId(), 0, [], 0, 0

        def close():
            sizes = np.concatenate([x[1] for x in held])
            payload, n = pack_container([d for x in held for d in x[0]], sizes,
                                        np.concatenate([x[2] for x in held]), base)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([segment], pa.int32()), pa.array([len(sizes)], pa.int32()),
                 pa.array([int(sizes.sum())], pa.int64()), pa.array([n], pa.int64()), pa.array([payload], pa.binary())],
                names=["shard", "segment", "n_docs", "n_ids", "n_symbols", "payload"])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, texts in P.text_batches(batch.column(1), 1 << 20):
                flat, per, *_ = memo.encode(texts)
                sizes = per + 1
                ids = np.full(int(sizes.sum()), end_id, dtype=np.int32)
                ids[P.ragged(np.cumsum(sizes) - sizes, per)] = flat
                held.append((keys[first:first + len(texts)], sizes, ids))
                n_ids, n_docs = n_ids + len(ids), n_docs + len(texts)
                if n_ids >= segment_ids or n_docs >= docs_per_shard:
                    yield close()
                    segment, held, n_ids, n_docs = segment + 1, [], 0, 0
        if held:
            yield close()

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    ordered = named.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return stored(ordered.mapInArrow(run, CONTAINERS), "grammar-files")


def read(containers: DataFrame) -> DataFrame:
    """Decode every document of written containers: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32, and n_symbols it is stored in."""

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for shard, segment, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                c = Container.open(payload)
                raw = memoryview(c.expand(c.symbols).astype("<u4").tobytes())
                ends = np.cumsum(c.sizes)
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - c.sizes).tolist(), ends.tolist())]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int64()), pa.array([segment] * n, pa.int32()),
                     pa.array(c.doc_ids, pa.int64()), pa.array(ends - c.sizes), pa.array(c.sizes),
                     pa.array(crc, pa.int64()), pa.array(c.per)],
                    names=["shard", "segment", "doc_id", "start_in_segment", "n_tokens", "ids_crc32", "n_symbols"])

    rows = containers.select("shard", "segment", "payload").mapInArrow(run, DOCUMENTS)
    order = [F.col("shard"), F.col("segment")]
    ends = running_sums(containers.select("shard", "segment", "n_ids"), order, {"upto": F.col("n_ids")})
    return (rows.join(ends.select("shard", "segment", (F.col("upto") - F.col("n_ids")).alias("base")),
                      ["shard", "segment"])
            .select("doc_id", (F.col("base") + F.col("start_in_segment")).alias("start"), "n_tokens", "ids_crc32",
                    "n_symbols"))
