"""Gradient boosting for the pinball loss on binned features.

The training rows are binned once (at most ``BINS`` intervals a feature, cut
at approximate quantiles) and written in chunks, one an Arrow batch.  A
round grows one tree for each wanted quantile, all of them in the same passes:
a pass counts, for every open node, feature and bin, the rows and those above
the prediction (the negative gradient has only these two values), and the
counts are added up over the chunks in a tree of tasks.  A leaf's value is the
exact quantile of its rows' residuals, found by narrowing histograms.

A pass over few rows is shorter than the start of a job, so up to ``TASK_MOST``
rows a round's passes are no jobs: the models don't depend on each other, and a
task for each grows all its trees over the stored chunks.  With more rows each
pass is a job over all of them: predictions are kept on the executors' disks
from round to round and written to the shared folder every ``WRITE_EVERY``
rounds, so a lost executor costs the work of a few trees.  Both ways run the
same rounds and give the same trees.  The driver holds counts (nodes x features
x bins), trees and bin edges, never rows.
"""

from __future__ import annotations

import functools
import pickle
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.session import shared_path

BINS = 64
CHUNK = "bins binary, y binary, f binary"
PART_ROWS = 1 << 15     # rows that a partition has at least, if there are so many
CELLS = 1024            # of a residual histogram
KEEP = 1 << 14          # rows of a cell whose different residuals may be listed
WRITE_EVERY = 25
FEW_PARTS = 64          # partitions whose counts go straight to the driver (at most 5 MB each)
EDGE_ERROR = 0.001      # relative rank error of the bin edges
TASK_MOST = 1 << 20     # rows over which a task grows a whole model
BLOCK_ROWS = 1 << 16    # that it works on at a time


@dataclass
class QuantileBoostModel:
    """Perfect trees of one depth, stored level by level: node k has the
    children 2k + 1 and 2k + 2; rows with x > threshold go right."""
    alpha: float
    init: float
    learning_rate: float
    depth: int
    feature: list = field(default_factory=list)      # int array per round, one entry an inner node
    threshold: list = field(default_factory=list)    # float array per round (inf: all go left)
    gain: list = field(default_factory=list)         # float array per round
    value: list = field(default_factory=list)        # float array per round, one entry a leaf

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.init)
        row = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[row, feature[node]] > threshold[node])
            out += self.learning_rate * value[node - len(feature)]
        return out

    def transform(self, df: DataFrame, features_col: str = "features", out: str = "prediction") -> DataFrame:
        """``df`` with the prediction, worked out for Arrow batches at a time."""
        predict = self.predict

        @F.pandas_udf("double")
        def predicted(features):
            import pandas as pd
            x = np.stack(features.to_numpy()) if len(features) else np.zeros((0, 1))
            return pd.Series(predict(x))

        return df.withColumn(out, predicted(vector_to_array(F.col(features_col))))

    def importances(self, names: Sequence[str]) -> list[tuple[str, float]]:
        """Mean over the trees of each feature's share of the tree's gain."""
        total = np.zeros(len(names))
        for feature, gain in zip(self.feature, self.gain):
            if gain.sum() > 0:
                total += np.bincount(feature, weights=gain / gain.sum(), minlength=len(names))
        total /= max(total.sum(), 1e-300)
        return sorted(zip(names, total.tolist()), key=lambda t: (-t[1], t[0]))


# -- inside tasks -----------------------------------------------------------------
class Chunk:
    """Rows of one chunk: bins (features x rows), y, predictions (models x rows)."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, f: np.ndarray, row=None):
        self.bins, self.y, self.f, self.row = bins, y, f, row
        self.at: dict[int, tuple] = {}     # of each model's open tree: depth and nodes,
        self.by: dict[int, tuple] = {}     # and residuals by leaf

    @classmethod
    def of(cls, row, models: int) -> Chunk:
        y = np.frombuffer(row[1], dtype="<f8")
        return cls(np.frombuffer(row[0], dtype=np.uint8).reshape(-1, len(y)), y,
                   np.frombuffer(row[2], dtype="<f8").reshape(models, len(y)), row)

    def nodes(self, m: int, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
        """Each row's node in the tree that model ``m`` grows; goes on from the last level asked for."""
        known, node = self.at.get(m, (0, None))
        if node is None or known > depth:
            known, node = 0, np.zeros(len(self.y), dtype=np.int64)
        flat, row, start = self.bins.ravel(), np.arange(len(self.y)), feature * len(self.y)
        for _ in range(known, depth):
            node = 2 * node + 1 + (flat[start[node] + row] > cut[node])
        self.at[m] = depth, node
        return node

    def residuals(self, m: int, feature: np.ndarray, cut: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Residuals leaf by leaf, and where each leaf begins."""
        if m not in self.by:
            leaf = (self.nodes(m, feature, cut, depth) - (2 ** depth - 1)).astype(np.int16)
            order = np.argsort(leaf, kind="stable")
            self.by[m] = (self.y - self.f[m])[order], np.searchsorted(leaf[order], np.arange(2 ** depth + 1))
        return self.by[m]

    def predictions(self, trees: list, rate: float, depth: int) -> np.ndarray:
        """With a tree for each model added."""
        return np.stack([self.f[m] + rate * value[self.nodes(m, feature, cut, depth) - len(feature)]
                         for m, (feature, cut, value) in enumerate(trees)])

    def boosted(self, trees: list, rate: float, depth: int) -> tuple:
        """The chunk with these predictions, as a row."""
        return self.row[0], self.row[1], self.predictions(trees, rate, depth).tobytes()

    def boost(self, trees: list, rate: float, depth: int) -> None:
        """The same in place; the next trees begin."""
        self.f, self.at, self.by = self.predictions(trees, rate, depth), {}, {}


def _gradient_counts(chunk: Chunk, grown: list, level: int) -> np.ndarray:
    """counts[model, node of the level, feature, bin, above or not]."""
    first, width, features = 2 ** level - 1, 2 ** level, len(chunk.bins)
    out = np.zeros((len(grown), width, features, BINS, 2), dtype=np.int64)
    for m, (feature, cut) in enumerate(grown):
        base = (chunk.nodes(m, feature, cut, level) - first) * (2 * BINS) + (chunk.y > chunk.f[m])
        for j in range(features):
            out[m, :, j] = np.bincount(base + 2 * chunk.bins[j], minlength=width * BINS * 2).reshape(width, BINS, 2)
    return out


def _cells(values: np.ndarray, lo: float, hi: float) -> np.ndarray:
    return np.minimum((CELLS * ((values - lo) / (hi - lo))).astype(np.int64), CELLS - 1)


def _spread(chunk: Chunk) -> np.ndarray:
    """Rows, least and greatest y (as its negative)."""
    return np.array([len(chunk.y), chunk.y.min(initial=np.inf), (-chunk.y).min(initial=np.inf)])


def _join_spread(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.array([a[0] + b[0], *np.minimum(a[1:], b[1:])])


def _residual_counts(chunk: Chunk, grown: list, depth: int, wide: list) -> np.ndarray:
    """Counts of the residuals in the cells of each bracket (model, leaf, lo, hi)."""
    out = np.zeros((len(wide), CELLS), dtype=np.int64)
    for k, r in _residuals(chunk, grown, depth, wide):
        out[k] = np.bincount(_cells(r, *wide[k][2:4]), minlength=CELLS)
    return out


def _residuals(chunk: Chunk, grown: list, depth: int, brackets: list):
    for k, (m, leaf, lo, hi, *_) in enumerate(brackets):
        r, ends = chunk.residuals(m, *grown[m], depth)
        r = r[ends[leaf]:ends[leaf + 1]]
        yield k, r[(r >= lo) & (r <= hi)]


def _listed(chunk: Chunk, grown: list, depth: int, few: list) -> list:
    """Different residuals of each bracket and how often each occurs."""
    return [np.unique(r, return_counts=True) for _, r in _residuals(chunk, grown, depth, few)]


def _join_listed(a: list, b: list) -> list:
    out = []
    for (u, m), (v, n) in zip(a, b):
        both, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        out.append((both, np.bincount(at, weights=np.concatenate([m, n]), minlength=len(both)).astype(np.int64)))
    return out


def _task(kit, name: str, args: tuple, models: int):
    """Map function that applies a function of the broadcast ``kit`` to a
    chunk.  The kit reaches a worker once; pickled with each of the thousands
    of small jobs it would take as long as their work."""
    def call(row):
        import pickle
        import sys
        import types
        holder = sys.modules.setdefault("_kestrel_boost_kit", types.ModuleType("_kestrel_boost_kit"))
        if getattr(holder, "at", None) != kit.value[0]:
            holder.at, holder.kit = kit.value[0], {f.__name__: f for f in pickle.loads(kit.value[1])}
        return holder.kit[name](holder.kit["Chunk"].of(row, models), *args)
    return call


def _blocks(rows, features: int, models: int) -> list[Chunk]:
    """A task's rows in chunks of about ``BLOCK_ROWS``, one at least."""
    out, open_ = [], [Chunk(np.zeros((features, 0), dtype=np.uint8), np.zeros(0), np.zeros((models, 0)))]

    def close():
        out.append(Chunk(*(np.concatenate([getattr(c, v) for c in open_], axis=-1) for v in ("bins", "y", "f"))))

    for row in rows:
        if sum(len(c.y) for c in open_) >= BLOCK_ROWS:
            close()
            open_ = []
        open_.append(Chunk.of(row, models))
    close()
    return out


# -- the fit -------------------------------------------------------------------------
def bin_edges(df: DataFrame, features: int, bins: int = BINS) -> list[np.ndarray]:
    """Ascending cuts of each feature (at most ``bins`` - 1); ``bins`` or fewer
    different values are cut between all of them."""
    cols = [f"_x{j}" for j in range(features)]
    wide = df.select(*[F.col("_x")[j].alias(c) for j, c in enumerate(cols)])
    found = wide.approxQuantile(cols, [i / bins for i in range(bins + 1)], EDGE_ERROR)
    # x > cut; the greatest cuts nothing off, and the least makes way where all quantiles differ
    return [np.unique(q)[:-1][-(bins - 1):] if len(q) else np.zeros(0) for q in found]


def fit(df: DataFrame, alphas: Mapping[str, float], features_col: str = "features", label: str = "label",
        rounds: int = 300, depth: int = 5, learning_rate: float = 0.05) -> dict[str, QuantileBoostModel]:
    """One model for each named quantile; no rows, no models."""
    spark = df.sparkSession
    rows = df.select(vector_to_array(F.col(features_col)).alias("_x"), F.col(label).cast("double").alias("_y")).where(
        F.col("_y").isNotNull())
    first = rows.first()
    if first is None:
        return {}
    edges = bin_edges(rows, len(first["_x"]))
    names, n_models, leaves = list(alphas), len(alphas), 2 ** depth
    alpha = np.array([alphas[n] for n in names])

    def chunks(batches):
        import pyarrow as pa
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack(b.column(0).to_numpy(zero_copy_only=False))
            bins = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]).astype(np.uint8)
            y = b.column(1).to_numpy().astype("<f8")
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (
                bins.tobytes(), y.tobytes(), np.zeros((n_models, len(y))).tobytes())], names=["bins", "y", "f"])

    def written(chunked: DataFrame) -> DataFrame:
        path = shared_path(spark, "boost-chunks")
        chunked.write.parquet(path)
        return spark.read.parquet(path)

    kit = spark.sparkContext.broadcast((uuid.uuid4().hex, cloudpickle.dumps(
        [Chunk, _spread, _gradient_counts, _residual_counts, _listed, Chunk.boosted])))

    def task(part, *args):
        return _task(kit, part.__name__, args, n_models)

    def total(state, join, part, *args):
        deep = 1 if state.getNumPartitions() <= FEW_PARTS else 3   # levels in which the parts are added up
        return state.map(task(part, *args)).treeReduce(join, deep)

    # a chunk is an Arrow batch; few chunks share few partitions
    chunked = written(rows.mapInArrow(chunks, CHUNK))
    state = chunked.rdd.map(tuple)
    n, least, most = total(state, _join_spread, _spread)
    state = state.coalesce(int(min(state.getNumPartitions(), -(-n // PART_ROWS)))).persist(StorageLevel.DISK_ONLY)
    none = _no_tree(depth)
    init = _leaf_values(lambda *p: total(state, *p), [none] * n_models, depth, alpha,
                        np.tile([n] + [0] * (leaves - 1), (n_models, 1)), np.tile([least, -most], (n_models, 1)))[:, 0]
    models = {name: QuantileBoostModel(float(a), float(v), learning_rate, depth)
              for name, a, v in zip(names, alpha, init)}
    ends = np.stack([least - init, -most - init], axis=1)      # bounds of each model's residuals
    trees, rate = [(*none, np.full(leaves, v)) for v in init], 1.0

    def keep(grown, gains, values):
        for (feature, cut), gain, value, model in zip(grown, gains, values, models.values()):
            model.feature.append(feature)
            model.threshold.append(np.array([edges[f][c] if c < 255 else np.inf for f, c in zip(feature, cut)]))
            model.gain.append(gain)
            model.value.append(value)

    if n <= TASK_MOST:
        state.unpersist()
        whole = chunked.rdd.map(tuple).coalesce(1)
        grown_by = spark.sparkContext.union([whole.mapPartitions(_growing(
            k, len(edges), alpha, init, ends, rounds, depth, learning_rate)) for k in range(n_models)]).collect()
        for same in zip(*(pickle.loads(x) for x in grown_by)):       # of a round
            keep(*([one[i] for one in same] for i in range(3)))
    else:
        for m in range(rounds):
            # the first pass of a round keeps the predictions with the trees of the last one
            old, state = state, state.map(task(Chunk.boosted, trees, rate, depth))
            if (m + 1) % WRITE_EVERY == 0:
                state = written(state.toDF(CHUNK)).rdd.map(tuple).coalesce(old.getNumPartitions())
            state = state.persist(StorageLevel.DISK_ONLY)

            def passed(*p, old=old, state=state):
                counts = total(state, *p)
                old.unpersist()
                return counts

            grown, gains, values, ends = _round(passed, alpha, depth, learning_rate, ends)
            trees, rate = [(f, c, v) for (f, c), v in zip(grown, values)], learning_rate
            keep(grown, gains, values)
        state.unpersist()
    kit.unpersist()
    return models


def _no_tree(depth: int) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(2 ** depth - 1, dtype=np.int64), np.full(2 ** depth - 1, 255)


def _growing(k: int, features: int, alpha: np.ndarray, init: np.ndarray, ends: np.ndarray, rounds: int, depth: int,
             rate: float):
    """Map function that grows the trees of model ``k`` over all rows, in one task."""
    def grow(rows):
        blocks = [Chunk(b.bins, b.y, np.full((1, len(b.y)), init[k])) for b in _blocks(rows, features, len(alpha))]
        bounds, out = ends[k:k + 1], []

        def total(join, part, *args):
            return functools.reduce(join, (part(b, *args) for b in blocks))

        for _ in range(rounds):
            grown, gains, values, bounds = _round(total, alpha[k:k + 1], depth, rate, bounds)
            for b in blocks:
                b.boost([(*grown[0], values[0])], rate, depth)
            out.append((grown[0], gains[0], values[0]))
        yield pickle.dumps(out)
    return grow


def _round(total, alpha: np.ndarray, depth: int, rate: float, ends: np.ndarray) -> tuple:
    """A tree for each model, (feature, cut) of its nodes, their gains, its
    leaves' values, and the bounds of the residuals that it leaves.
    ``total(join, part, *args)`` adds up ``part`` of all chunks."""
    grown = [_no_tree(depth) for _ in alpha]
    gains = [np.zeros(2 ** depth - 1) for _ in alpha]
    in_leaf = np.zeros((len(alpha), 2 ** depth))
    for level in range(depth):
        counts = total(np.add, _gradient_counts, grown, level)
        here = slice(2 ** level - 1, 2 ** (level + 1) - 1)
        for k, ((feature, cut), gain, a) in enumerate(zip(grown, gains, alpha)):
            feature[here], cut[here], gain[here], halves = best_splits(counts[k], a)
            if level == depth - 1:
                in_leaf[k] = halves.ravel()
    values = _leaf_values(total, grown, depth, alpha, in_leaf, ends)
    return grown, gains, values, ends - rate * np.stack([values.max(axis=1), values.min(axis=1)], axis=1)


def best_splits(counts: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature, last bin that goes left, gain, rows left and right) of each
    node from counts[node, feature, bin, above]; 255 sends all rows left where
    no split gains."""
    n = counts.sum(axis=-1)
    s = counts[..., 1] - (1 - alpha) * n                    # sum of the negative gradient
    left_n, left_s = np.cumsum(n, axis=-1)[..., :-1], np.cumsum(s, axis=-1)[..., :-1]
    all_n, all_s = n.sum(axis=-1)[..., None], s.sum(axis=-1)[..., None]
    right_n, right_s = all_n - left_n, all_s - left_s
    both = (left_n > 0) & (right_n > 0)
    gain = np.where(both, left_s ** 2 / np.maximum(left_n, 1) + right_s ** 2 / np.maximum(right_n, 1)
                    - all_s ** 2 / np.maximum(all_n, 1), 0.0)
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    top = flat[np.arange(len(flat)), best]
    splits = top > 1e-9
    feature, cut = np.divmod(best, gain.shape[-1])
    every = all_n[:, 0, 0]
    left = np.where(splits, left_n.reshape(len(gain), -1)[np.arange(len(flat)), best], every)
    return (np.where(splits, feature, 0), np.where(splits, cut, 255), np.where(splits, top, 0.0),
            np.stack([left, every - left], axis=1))


def _leaf_values(total, grown: list, depth: int, alpha: np.ndarray, in_leaf: np.ndarray, ends: np.ndarray
                 ) -> np.ndarray:
    """[model, leaf]: exact alpha quantile (linear) of the leaf's residuals; 0
    for a leaf without rows.  ``in_leaf`` are the rows of each leaf, ``ends``
    the bounds of each model's residuals."""
    at: dict[tuple, float] = {}
    open_ = []                                              # (model, leaf, lo, hi, ranks below, rows, ranks)
    for m in range(len(grown)):
        # a little wider, for what rounding has added up
        lo, hi = ends[m] + np.array([-1e-9, 1e-9]) * (1 + np.abs(ends[m]))
        for leaf, n in enumerate(in_leaf[m]):
            if n:
                place = (n - 1) * alpha[m]
                open_.append((m, leaf, lo, hi, 0, int(n), sorted({int(np.floor(place)), int(np.ceil(place))})))
    while open_:
        for m, leaf, lo, hi, _, _, ranks in open_:
            if lo == hi:
                at.update({(m, leaf, r): lo for r in ranks})
        open_ = [b for b in open_ if b[2] < b[3]]
        few, wide = [b for b in open_ if b[5] <= KEEP], [b for b in open_ if b[5] > KEEP]
        if few:
            for (m, leaf, _, _, below, _, ranks), (u, times) in zip(
                    few, total(_join_listed, _listed, grown, depth, few)):
                upto = below + np.cumsum(times)
                at.update({(m, leaf, r): float(u[np.searchsorted(upto, r, side="right")]) for r in ranks})
        open_ = []
        if wide:
            counts = total(np.add, _residual_counts, grown, depth, wide)
            for (m, leaf, lo, hi, below, n, ranks), cells in zip(wide, counts):
                upto = np.cumsum(cells)
                for cell in sorted({int(np.searchsorted(upto, r - below, side="right")) for r in ranks}):
                    inside = [r for r in ranks if int(np.searchsorted(upto, r - below, side="right")) == cell]
                    before = int(upto[cell - 1]) if cell else 0
                    open_.append((m, leaf, lo, hi, below + before, int(cells[cell]), inside, cell))
            lo, hi = _cell_ends(*(np.array([b[i] for b in open_]) for i in (2, 3, 7)))
            open_ = [(*b[:2], float(x), float(y), *b[4:7]) for b, x, y in zip(open_, lo, hi)]
    out = np.zeros((len(grown), 2 ** depth))
    for m in range(len(grown)):
        for leaf, n in enumerate(in_leaf[m]):
            if n:
                place = (n - 1) * alpha[m]
                low, high = at[m, leaf, int(np.floor(place))], at[m, leaf, int(np.ceil(place))]
                out[m, leaf] = low + (high - low) * (place - np.floor(place))
    return out


def _cell_ends(lo: np.ndarray, hi: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest number that ``_cells`` puts in the cell of each bracket."""
    def first_of(c):        # least x with a cell of at least c
        a, b = lo, hi
        while True:
            mid = a + (b - a) / 2
            between = (mid > a) & (mid < b)
            if not between.any():
                return np.where(c <= 0, lo, b)
            up = _cells(mid, lo, hi) >= c
            a, b = np.where(between & ~up, mid, a), np.where(between & up, mid, b)
    return first_of(cell), np.where(cell == CELLS - 1, hi, np.nextafter(first_of(cell + 1), lo))


# -- bundles -----------------------------------------------------------------------
def save_bundle(spark, models: Mapping[str, QuantileBoostModel], path: str) -> None:
    """One Parquet row a tree node: a bundle is models x rounds x 2^depth rows."""
    rows = []
    for name, m in models.items():
        for r, (feature, threshold, gain, value) in enumerate(zip(m.feature, m.threshold, m.gain, m.value)):
            head = (name, m.alpha, m.init, m.learning_rate, m.depth, r)
            rows += [(*head, k, int(f), float(t), float(g), None)
                     for k, (f, t, g) in enumerate(zip(feature, threshold, gain))]
            rows += [(*head, len(feature) + k, None, None, None, float(x)) for k, x in enumerate(value)]
    spark.createDataFrame(rows, "name string, alpha double, init double, learning_rate double, depth int, round int, "
                                "node int, feature int, threshold double, gain double, value double"
                          ).write.mode("overwrite").parquet(path)


def load_bundle(spark, path: str) -> dict[str, QuantileBoostModel]:
    out: dict[str, QuantileBoostModel] = {}
    found = spark.read.parquet(path).orderBy("name", "round", "node").collect()
    by_tree: dict[tuple, list] = {}
    for r in found:
        by_tree.setdefault((r["name"], r["round"]), []).append(r)
    for (name, _), nodes in by_tree.items():
        r = nodes[0]
        m = out.setdefault(name, QuantileBoostModel(r["alpha"], r["init"], r["learning_rate"], r["depth"]))
        inner = [x for x in nodes if x["feature"] is not None]
        m.feature.append(np.array([x["feature"] for x in inner], dtype=np.int64))
        m.threshold.append(np.array([x["threshold"] for x in inner]))
        m.gain.append(np.array([x["gain"] for x in inner]))
        m.value.append(np.array([x["value"] for x in nodes if x["feature"] is None]))
    return out
