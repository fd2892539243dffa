"""Approximate nearest neighbours over a robust-pruned directed graph.

Method: vectors are dealt into shards by a hash.  In a shard, points enter a
graph in batches: a greedy (beam) search from the shard's entry points
proposes a point's neighbours; relaxed distance pruning walks them from near
to far and keeps one unless a kept one is, by the factor ``ALPHA``, closer to
it than the point is; kept edges are also entered backwards, pruned where a
node is full.  ``FAR`` further edges of each node lead to random earlier
points and are never pruned: in a dense group of near-equal vectors all other
edges stay inside the group, and searches would not find their way out.
A shard's graph and vectors form one row of the index table.  Every block of
queries is beam-searched in every shard, and the shards' nearest are merged.

Equal vectors are one point of the graph; it answers with its smallest ids, as
many as can be asked for.

Defined cases: vectors that are null, zero, or hold null or non-finite
components take no part; only vectors of equal dimension meet; ties go to the
smaller id; repeated (id, vector) rows count once; an empty table gives an
empty result.  Columns besides the two named are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.tables import stored

DEGREE = 24
FAR = 8
ENTRIES = 32
ALPHA = 1.2
BUILD_BEAM = 48
SEARCH_BEAM = 160
SHARD_ROWS = 8192
BATCH = 256
QUERY_BLOCK = 1024


# -- one shard ------------------------------------------------------------------

def _sq(x: np.ndarray) -> np.ndarray:
    return np.einsum("...d,...d->...", x, x)


def beam_search(vectors: np.ndarray, norms: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray,
                width: int) -> tuple[np.ndarray, np.ndarray]:
    """All queries at once: (nodes, squared distances) of the beam, nearest
    first; missing entries are node -1 at infinity."""
    q, k = len(queries), len(entries)
    width = max(width, k)
    rows = np.arange(q)[:, None]
    nodes = np.full((q, width), -1, dtype=np.int64)
    dist = np.full((q, width), np.inf)
    opened = np.ones((q, width), dtype=bool)
    own = _sq(queries)
    nodes[:, :k] = entries
    dist[:, :k] = np.maximum(own[:, None] + norms[entries] - 2 * queries @ vectors[entries].T, 0)
    opened[:, :k] = False
    live = np.arange(q)
    while len(live):
        at = np.argmin(np.where(opened[live], np.inf, dist[live]), axis=1)
        todo = ~opened[live, at]
        live, at = live[todo], at[todo]
        if not len(live):
            break
        opened[live, at] = True
        next_ = graph[nodes[live, at]]
        known = (next_[:, :, None] == nodes[live][:, None, :]).any(axis=2) | (next_ < 0)
        d = own[live, None] + norms[next_] - 2 * np.einsum("qkd,qd->qk", vectors[next_], queries[live])
        d = np.where(known, np.inf, np.maximum(d, 0))
        all_d = np.concatenate([dist[live], d], axis=1)
        all_n = np.concatenate([nodes[live], np.where(known, -1, next_)], axis=1)
        all_o = np.concatenate([opened[live], known], axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        r = rows[:len(live)]
        dist[live], nodes[live], opened[live] = all_d[r, order], all_n[r, order], all_o[r, order]
    return nodes, dist


def robust_prune(vectors: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours of each point out of its candidates (rows padded with -1)."""
    b, _ = cand.shape
    bad = (cand < 0) | (cand == points[:, None])
    order = np.argsort(cand, axis=1, kind="stable")
    s = np.take_along_axis(cand, order, axis=1)
    twice = np.zeros_like(bad)
    np.put_along_axis(twice, order[:, 1:], s[:, 1:] == s[:, :-1], axis=1)
    bad |= twice
    x = vectors[np.maximum(cand, 0)]
    d = np.where(bad, np.inf, _sq(x - vectors[points][:, None, :]))
    order = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, axis=1), np.take_along_axis(d, order, axis=1)
    x = np.take_along_axis(x, order[:, :, None], axis=1)
    n = _sq(x)
    out = np.full((b, degree), -1, dtype=np.int64)
    open_ = np.isfinite(d)
    rows = np.arange(b)
    factor = alpha * alpha  # squared distances
    for k in range(degree):
        first = np.argmax(open_, axis=1)
        has = open_[rows, first]
        if not has.any():
            break
        out[:, k] = np.where(has, cand[rows, first], -1)
        p = x[rows, first]
        between = n + _sq(p)[:, None] - 2 * np.einsum("bcd,bd->bc", x, p)
        open_ &= ~((factor * np.maximum(between, 0) <= d) & has[:, None])
        open_[rows, first] = False
    return out


def build(vectors: np.ndarray, degree: int = DEGREE, far: int = FAR, entries: int = ENTRIES, alpha: float = ALPHA,
          beam: int = BUILD_BEAM, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entry points) over the rows of ``vectors``."""
    n = len(vectors)
    norms = _sq(vectors)
    rng = np.random.default_rng(0)
    order = rng.permutation(n)
    graph = np.full((n, degree + far), -1, dtype=np.int64)
    start = order[:entries]
    at, size = min(entries, n), max(entries, 1)
    while at < n:
        new = order[at:at + size]
        graph[new, degree:] = order[rng.integers(0, at, size=(len(new), far))]
        nodes, _ = beam_search(vectors, norms, graph, start, vectors[new], beam)
        # points of one batch don't find each other in the graph: they meet here
        near = np.argsort(norms[new][None, :] - 2 * vectors[new] @ vectors[new].T, axis=1)[:, :degree]
        kept = robust_prune(vectors, new, np.concatenate([nodes, new[near]], axis=1), degree, alpha)
        graph[new, :degree] = kept
        back_from, back_to = np.repeat(new, degree), kept.reshape(-1)
        back_from, back_to = back_from[back_to >= 0], back_to[back_to >= 0]
        by = np.argsort(back_to, kind="stable")
        to, count = np.unique(back_to, return_counts=True)
        # the nodes in groups of like numbers of new edges, so that one much
        # wanted node doesn't make the rows of all wide
        first = np.cumsum(count) - count
        widest = np.argsort(count, kind="stable")
        for a in range(0, len(to), 2 * BATCH):
            some = widest[a:a + 2 * BATCH]
            cand = np.full((len(some), int(count[some].max())), -1, dtype=np.int64)
            row = np.repeat(np.arange(len(some)), count[some])
            col = np.arange(len(row)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
            cand[row, col] = back_from[by][first[some][row] + col]
            part = to[some]
            graph[part, :degree] = robust_prune(vectors, part, np.concatenate([graph[part, :degree], cand], axis=1),
                                                degree, alpha)
        at, size = at + size, min(batch, 2 * size)
    return graph, start


# -- tables -----------------------------------------------------------------------

def usable(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, equal rows once."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
            .where(v.isNotNull() & F.col("vec_id").isNotNull() & (F.size(v) > 0))
            .where(F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)).distinct())


INDEX = "shard long, dims int, points int, entries array<int>, members array<array<long>>, vectors binary, graph binary"


def index(vectors: DataFrame, keep: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index of ``usable`` vectors, one row a shard.  ``keep``: smallest
    ids kept of equal vectors."""
    w = Window.partitionBy("v").orderBy("vec_id")
    points = (vectors.withColumn("r", F.row_number().over(w)).where(F.col("r") <= keep)  # the rest can't be asked for
              .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    points = stored(points, "ann-points")
    shards = {r["dims"]: max(1, -(-r["n"] // shard_rows))
              for r in points.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not shards:
        return points.sparkSession.createDataFrame([], INDEX)
    number = F.lit(None).cast("long")
    for dims, n in shards.items():  # one entry a dimension
        number = F.when(F.size("v") == dims, F.pmod(F.xxhash64("v"), F.lit(n))).otherwise(number)

    def one(key, t):
        import pyarrow as pa
        flat = t.column("v").combine_chunks()
        x = flat.values.to_numpy(zero_copy_only=False).reshape(len(flat), -1)
        graph, start = build(x)
        ids = t.column("ids").combine_chunks()
        return pa.table({
            "shard": pa.array([key[1].as_py()], pa.int64()), "dims": pa.array([x.shape[1]], pa.int32()),
            "points": pa.array([len(x)], pa.int32()), "entries": pa.array([start.tolist()], pa.list_(pa.int32())),
            "members": pa.array([ids.to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "vectors": pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()),
            "graph": pa.array([graph.astype("<i4").tobytes()], pa.binary())})

    dealt = points.select(F.size("v").alias("dims"), number.alias("shard"), "v", "ids")
    return stored(dealt.groupBy("dims", "shard").applyInArrow(one, INDEX), "ann-index")


FOUND = "query_id long, vec_id long, score double"


def search(index_rows: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM,
           block: int = QUERY_BLOCK) -> DataFrame:
    """Nearest found of each query (vec_id, v): query_id, rank, vec_id, score
    (Euclidean, in double precision, on the vectors as given)."""
    per_dim = queries.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    sized = queries.withColumn("dims", F.size("v")).join(per_dim, "dims")
    blocks = sized.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("n") / block))).groupBy(
        "dims", "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))  # about ``block`` rows

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                dims = row["dims"].as_py()
                x = np.frombuffer(row["vectors"].as_buffer(), dtype="<f8").reshape(-1, dims)
                graph = np.frombuffer(row["graph"].as_buffer(), dtype="<i4").reshape(len(x), -1).astype(np.int64)
                asked = row["queries"].values
                ids = asked.field("vec_id").to_numpy()
                qs = asked.field("v").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dims)
                members = row["members"].as_py()
                nodes, _ = beam_search(x, _sq(x), graph, np.array(row["entries"].as_py()), qs, beam)
                out = []
                for q, own, found in zip(ids.tolist(), qs, nodes):
                    found = found[found >= 0]
                    exact = np.sqrt(_sq(x[found] - own))
                    hits = sorted((s, m) for s, n in zip(exact.tolist(), found.tolist()) for m in members[n] if m != q)
                    out += [(q, m, s) for s, m in hits[:k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                     pa.array([o[2] for o in out], pa.float64())], names=["query_id", "vec_id", "score"])

    # every block goes to every shard of its dimension: the stated query set
    # against all rows, in blocks
    pairs = index_rows.select("dims", "entries", "members", "vectors", "graph").join(blocks, "dims").select(
        "dims", "entries", "members", "vectors", "graph", "queries")
    found = pairs.repartition(F.xxhash64("vectors", "queries")).mapInArrow(run, FOUND)
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id",
            embedding: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each row whose id is divisible by ``every``,
    among all other rows."""
    vectors = stored(usable(embeddings, vec_id, embedding), "ann-vectors")
    return search(index(vectors, k + 1), vectors.where(F.col("vec_id") % every == 0), k)
