"""Prefix trie of conversations.

Method: a turn's id is a fixed-width big-endian number, the first
``ID_BYTES`` bytes of the SHA-256 of its role and text; a conversation's key is
the ids of its turns one after another.  Equal keys are counted first, the
different keys are sorted into shards by range, and each shard builds an
adaptive radix tree (nodes of 4, 16, 48 and 256 places that grow as needed,
compressed paths).  Only byte depths that end a turn are nodes of the result.

A prefix can lie in several shards only if neighbouring shards share it.  A
shard is told how many turns its first key shares with the last key before it,
and its last key with the first key after it; so it knows which nodes are also
elsewhere, counts each child, leaf and text of theirs once, and their figures
are added up over shards in the end.

Defined cases: a null role or text is empty; rows without a conv_id are no
conversation; turns that are equal in ``turn`` go by role, then by their id;
repeated rows are turns like any other; without conversations there is no
node.  A task holds the turn ids of at least one whole conversation (20 bytes
a turn).  Columns besides the named ones are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kestrel.llm.tables import stored

ID_BYTES = 16
SHARD_TURNS = 100_000     # turns of different conversations in a shard, about
ENDS_BITS = 16            # conv_ids are joined in blocks of 2^16 of them
NOTHING = hashlib.sha256(b"").hexdigest()

NODES = ("shard long, digest binary, depth long, conv_id long, parent_conv_id long, parent_digest binary, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


# -- the tree of one shard ------------------------------------------------------
class Node:
    """A node of an adaptive radix tree: the compressed path key[begin:end]
    that leads to it, at most one value (a key's number), and its children by
    next byte: up to 4 or 16 bytes side by side, 256 bytes that point into 48
    places, or 256 places."""

    __slots__ = ("key", "begin", "end", "value", "bytes", "below")

    def __init__(self, key: int, begin: int, end: int, value: int = -1):
        self.key, self.begin, self.end, self.value = key, begin, end, value
        self.bytes, self.below = bytearray(), []

    def place(self, byte: int) -> int:
        """Where the child for ``byte`` is in ``below``, or -1."""
        size = len(self.bytes)
        if size <= 16:                          # side by side
            return self.bytes.find(byte)
        if len(self.below) == 256:              # one place a byte
            return byte if self.below[byte] is not None else -1
        return self.bytes[byte] - 1             # 256 bytes that point into 48 places

    def add(self, byte: int, child: Node) -> None:
        """The layout grows when its 16 or 48 places are full."""
        if len(self.bytes) <= 16:
            if len(self.below) < 16:
                self.bytes.append(byte)
                self.below.append(child)
                return
            index = bytearray(256)
            for at, b in enumerate(self.bytes):
                index[b] = at + 1
            self.bytes = index
        if len(self.below) == 48:
            every = [None] * 256
            for b, at in enumerate(self.bytes):
                if at:
                    every[b] = self.below[at - 1]
            self.below = every
        if len(self.below) == 256:
            self.below[byte] = child
        else:
            self.below.append(child)
            self.bytes[byte] = len(self.below)

    def children(self) -> list[Node]:
        """In order of their bytes."""
        if len(self.bytes) <= 16:
            return [self.below[at] for at in sorted(range(len(self.below)), key=self.bytes.__getitem__)]
        if len(self.below) == 256:
            return [c for c in self.below if c is not None]
        return [self.below[at - 1] for at in self.bytes if at]


def build(keys: list[bytes]) -> Node:
    """Tree of different keys; a key may begin another."""
    root = Node(0, 0, 0)
    for number, key in enumerate(keys):
        node, at = root, 0
        while True:
            if at == len(key):
                node.value = number
                break
            found = node.place(key[at])
            if found < 0:
                node.add(key[at], Node(number, at, len(key), number))
                break
            child = node.below[found]
            path = keys[child.key]
            upto = min(child.end, len(key))
            same = _same(path, key, at, upto)
            if same < child.end:                # the path is cut where the keys part
                upper = Node(child.key, at, same)
                child.begin = same
                upper.add(path[same], child)
                node.below[found] = upper
                child = upper
            node, at = child, same
    return root


def _same(a: bytes, b: bytes, at: int, upto: int) -> int:
    """The first place from ``at`` on where a and b differ, or ``upto``."""
    if a[at:upto] == b[at:upto]:
        return upto
    step = 1 << (upto - at).bit_length()
    while step := step >> 1:
        if at + step <= upto and a[at:at + step] == b[at:at + step]:
            at += step
    return at


def shard_nodes(keys: list[bytes], weights: list, counts: list[int], firsts: list[int], ends: list[str],
                before: int, after: int) -> list[dict]:
    """Result nodes of a shard's ascending ``keys``.

    ``weights`` are the words of each key's turns, ``counts`` its conversations
    and ``firsts`` the smallest of them; ``before`` and ``after`` are the turns
    shared with the key before the first and after the last, -1 without one.
    Nodes so shared have a digest, and of their children and words they count
    those that no earlier shard has."""
    last, width = len(keys) - 1, ID_BYTES
    digests = {}                                # (first or last key, depth) -> digest of the shared prefix
    for side, key, shared in ((0, keys[0], before), (1, keys[last], after)):
        h = hashlib.sha256()
        for depth in range(shared + 1):
            if depth:
                h.update(key[(depth - 1) * width:depth * width])
            digests[side, depth] = h.digest()
    nodes, above = [], []
    todo = [(build(keys), -1)]
    while todo:                                 # parents before children
        node, parent = todo.pop()
        above.append(parent)
        nodes.append(node)
        todo.extend((child, len(nodes) - 1) for child in node.children())
    # what lies below each tree node: conversations, smallest of them, first and
    # last key, own children, leaves, saved words, result nodes without a parent
    below = [[0, None, last + 1, -1, 0, 0, 0, []] for _ in nodes]
    out: list[dict] = []
    for at in range(len(nodes) - 1, -1, -1):    # children before parents
        node = nodes[at]
        n, conv, lo, hi, children, leaves, saved, tops = below[at]
        if (v := node.value) >= 0:
            n += counts[v]
            conv = firsts[v] if conv is None else min(conv, firsts[v])
            lo, hi = min(lo, v), max(hi, v)
        for depth in range(node.end // width, node.begin // width if node.end else -1, -1):
            early, late = lo == 0 and depth <= before, hi == last and depth <= after
            words = int(weights[node.key][depth - 1]) if depth else 0
            if not tops and not late:           # late: the next shard goes on from here
                leaves = 1
            saved += words * (n - (not early))
            digest = digests[0, depth] if early else digests[1, depth] if late else None
            for t in tops:
                out[t]["parent_conv_id"], out[t]["parent_digest"] = conv, digest
            tops = [len(out)]
            out.append({"digest": digest, "depth": depth, "conv_id": conv, "parent_conv_id": None,
                        "parent_digest": None, "n_convs": n, "n_children": children, "n_leaves": leaves,
                        "saved_tokens": saved,
                        "ends_sha256": ends[v] if v >= 0 and depth * width == node.end else None})
            children = int(not early)
        if above[at] >= 0:
            up = below[above[at]]
            up[0] += n
            up[1] = conv if up[1] is None else min(up[1], conv)
            up[2], up[3] = min(up[2], lo), max(up[3], hi)
            up[4] += children
            up[5] += leaves
            up[6] += saved
            up[7].extend(tops)
        below[at] = None
    return out


# -- the job --------------------------------------------------------------------
def turn_id(role: Column, text: Column) -> Column:
    """Fixed-width big-endian number of a turn."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, ID_BYTES)


def rebuilt(conversations: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, key, words): conversation c begins with the first
    crc32(c) % ``heads`` turns of conversation c - c % ``every``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), turn_id(role, text).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    own = stored(turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", "role", "id", "words"))).alias("own")).select(
        "conv_id", F.transform("own", lambda t: F.struct(t["id"], t["words"])).alias("own")), "trie-conversations")
    start = own.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, heads - 1).alias("start"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    joined = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % every, "h": h}).join(start, "base", "left")
    none = F.array().cast("array<struct<id:binary,words:int>>")
    turns = F.concat(F.slice(F.coalesce("start", none), F.lit(1), F.col("h")),
                     F.slice("own", F.col("h") + 1, F.size("own")))
    return joined.select("conv_id", turns.alias("t")).select(
        "conv_id", F.unhex(F.array_join(F.transform("t", lambda t: F.hex(t["id"])), "")).alias("key"),
        F.transform("t", lambda t: t["words"]).alias("words"))


def _long_hashes(blocks: DataFrame) -> DataFrame:
    """(key, ends_sha256) of keys whose conv_ids fill several blocks: the
    blocks of a key stream through the hash in order, one at a time."""
    def run(batches):
        import pyarrow as pa
        key, h = None, None
        for batch in batches:
            keys, ends = [], []
            for k, joined in zip(batch.column(0).to_pylist(), batch.column(1)):
                if k == key:
                    h.update(b",")
                else:
                    if key is not None:
                        keys.append(key)
                        ends.append(h.hexdigest())
                    key, h = k, hashlib.sha256()
                h.update(joined.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())],
                                             names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])],
                                             names=["key", "ends_sha256"])

    return blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "joined").mapInArrow(
        run, "key binary, ends_sha256 string")


def distinct_keys(convs: DataFrame, ends_bits: int = ENDS_BITS) -> DataFrame:
    """(key, words, n, conv_id, ends_sha256), a row for each different key."""
    blocks = stored(convs.groupBy("key", F.shiftright("conv_id", ends_bits).alias("block")).agg(
        F.first("words").alias("words"), F.sort_array(F.collect_list("conv_id")).alias("ids")).select(
        "key", "block", "words", F.size("ids").alias("n"), F.col("ids")[0].alias("conv_id"),
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("joined")), "trie-blocks")
    keys = stored(blocks.withColumn("sha", F.sha2("joined", 256)).groupBy("key").agg(
        F.first("words").alias("words"), F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"),
        F.max("sha").alias("ends_sha256"), F.count(F.lit(1)).alias("blocks")), "trie-keys")
    several = keys.where("blocks > 1").select("key")
    if several.isEmpty():
        return keys.drop("blocks")
    long = _long_hashes(blocks.join(several, "key", "left_semi")).withColumnRenamed("ends_sha256", "long")
    return keys.join(long, "key", "left").withColumn("ends_sha256", F.coalesce("long", "ends_sha256")).drop(
        "blocks", "long")


def borders(keys: DataFrame) -> DataFrame:
    """(shard, before, after): turns that its first and last key share with
    the neighbouring shards' keys.  The window runs over one row a shard."""
    def run(batches):
        import pyarrow as pa

        def shared(a, b):
            return -1 if a is None or b is None else _same(a, b, 0, min(len(a), len(b))) // ID_BYTES

        for batch in batches:
            shard, first, last, behind, ahead = (c.to_pylist() for c in batch.columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), pa.array(map(shared, behind, first), pa.int64()),
                 pa.array(map(shared, last, ahead), pa.int64())], names=["shard", "before", "after"])

    order = Window.orderBy("shard")
    each = keys.groupBy("shard").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    return each.select("shard", "first", "last", F.lag("last").over(order), F.lead("first").over(order)).mapInArrow(
        run, "shard int, before long, after long")


def _trees(keys: DataFrame) -> DataFrame:
    """Rows ``NODES`` of the shards; a partition has whole shards, one after
    the other and each with ascending keys."""
    schema = to_arrow_schema(StructType.fromDDL(NODES))

    def run(batches):
        import pyarrow as pa

        def grown(shard, rows):
            before, after = rows[0][5], rows[0][6]
            found = shard_nodes(*map(list, zip(*(r[:5] for r in rows))), before, after)
            for at in range(0, len(found), 10_000):
                some = found[at:at + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(some), pa.int64())]
                    + [pa.array([f[n] for f in some], schema.field(n).type) for n in schema.names[1:]], names=schema.names)

        shard, rows = None, []
        for batch in batches:
            words = [w.values.to_numpy() for w in batch.column(2)]
            others = [batch.column(k).to_pylist() for k in (0, 1, 3, 4, 5, 6, 7)]
            for s, key, n, conv, ends, before, after, w in zip(*others, words):
                if s != shard and rows:
                    yield from grown(shard, rows)
                    rows = []
                shard = s
                rows.append((key, w, n, conv, ends, before, after))
        if rows:
            yield from grown(shard, rows)

    return keys.select("shard", "key", "words", "n", "conv_id", "ends_sha256", "before", "after").mapInArrow(run, NODES)


def nodes(conversations: DataFrame, shard_turns: int = SHARD_TURNS, ends_bits: int = ENDS_BITS) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations: conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    keys = distinct_keys(rebuilt(conversations), ends_bits)
    turns = keys.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    shards = -(-turns // shard_turns) or 1
    sharded = stored(keys.repartitionByRange(shards, "key").withColumn("shard", F.spark_partition_id()), "trie-shards")
    most = (sharded.agg(F.max("shard")).first()[0] or 0) + 1
    dealt = sharded.join(F.broadcast(borders(sharded)), "shard")  # a row a shard
    trees = _trees(dealt.repartitionById(most, "shard").sortWithinPartitions("shard", "key"))
    found = stored(trees, "trie-nodes")
    figures = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    shared = found.where("digest IS NOT NULL")
    merged = stored(shared.groupBy("digest", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.first("parent_digest", ignorenulls=True).alias("parent_digest"),
        *[F.sum(c).alias(c) for c in figures], F.max("ends_sha256").alias("ends_sha256")), "trie-shared")
    up = merged.select(F.col("digest").alias("parent_digest"), F.col("conv_id").alias("up"))
    alone = found.where("digest IS NULL")
    # shared parents are looked up shard by shard, so the root's children are spread
    near = shared.select("shard", F.col("digest").alias("parent_digest")).join(up, "parent_digest")
    out = ["conv_id", "depth", F.coalesce("up", "parent_conv_id").alias("parent_conv_id"), *figures,
           F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")]
    inner = alone.where("parent_digest IS NULL").withColumn("up", F.lit(None).cast("long")).select(*out)
    tops = alone.where("parent_digest IS NOT NULL").join(near, ["shard", "parent_digest"]).select(*out)
    borders_up = merged.withColumn("parent_conv_id", F.lit(None).cast("long")).join(up, "parent_digest", "left")
    return inner.unionByName(tops).unionByName(borders_up.select(*out))


#: The nodes by grouping all prefixes; the crc runs over the digits' bits.
ORACLE = """
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce("text", '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (
  SELECT conv_id, turns, conv_id - conv_id % 20 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda a, b: xor(a >> 1, (a & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM own),
made AS (
  SELECT x.conv_id, coalesce(y.turns[1:x.h], []) || x.turns[x.h + 1:] AS seq
  FROM heads x LEFT JOIN own y ON y.conv_id = x.base),
prefixes AS (
  SELECT conv_id, len(seq) AS n, d AS depth, seq[1:d] AS p FROM made, unnest(range(len(seq) + 1)) AS r(d)),
nodes AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
         (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE
           len(regexp_extract_all(any_value(p[depth].t), '[^\\x20\\x09-\\x0D]+')) END AS saved
  FROM prefixes GROUP BY p, depth),
kids AS (SELECT p[1:depth - 1] AS up, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up),
marked AS (
  SELECT a.*, coalesce(k.n_children, 0) AS n_children, k.up IS NULL AS leaf FROM nodes a LEFT JOIN kids k ON k.up = a.p),
sums AS (
  SELECT p[1:d] AS top, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM marked, unnest(range(depth + 1)) AS r(d) GROUP BY top)
SELECT a.conv_id, a.depth, u.conv_id AS parent_conv_id, a.n_convs, a.n_children, s.n_leaves, s.saved_tokens, a.ends_sha256
FROM marked a JOIN sums s ON s.top = a.p
LEFT JOIN nodes u ON u.depth = a.depth - 1 AND u.p = a.p[1:a.depth - 1]
"""
