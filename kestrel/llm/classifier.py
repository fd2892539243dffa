"""Quality scores by naive Bayes support vectors.

Method: a text is a set of n-gram indicators.  Each is scaled by its
log-count ratio between the classes (add-one smoothing), the scaled vector is
brought to unit length, and a linear model with hinge loss is fitted by dual
coordinate descent.  The score is the logistic function of the margin.

The n-grams: byte trigrams, and 4-grams of the text's run-collapsed character
classes (small and capital letters, digits, white space, each other byte),
hashed to a fixed number of features; further indicators tell the share of
distinct words in tenths.

The fit uses at most ``MAX_TRAIN`` labelled rows, those with the smallest
hashes of their doc_id: a bounded sample, so one task can hold it.  Scoring
covers every row.

Defined cases: a null text scores as an empty one; labels that are null take
no part, and of repeated labels of a document the smallest counts; a null
doc_id is never labelled; of several texts under a labelled doc_id the one
with the smallest hash is learnt from; without two classes of labels every score is 0.5;
repeated rows score alike.  Columns besides the named ones are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAIN = 12_000
GRAM_BITS, CLASS_BITS = 17, 15
RATIO_BINS = 11
FEATURES = (1 << GRAM_BITS) + (1 << CLASS_BITS) + RATIO_BINS
COST = 4.0
PASSES = 12
SLOPE = 4.0          # of the logistic function of a margin
_MULT = 0x9E3779B1   # odd multiplier of the feature hash


def _classes() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    c[ord("a"):ord("z") + 1] = c[0x80:] = ord("a")
    c[ord("A"):ord("Z") + 1] = ord("A")
    c[ord("0"):ord("9") + 1] = ord("0")
    c[[9, 10, 11, 12, 13]] = 32
    return c


def _hash(codes: np.ndarray, bits: int) -> np.ndarray:
    return ((codes * np.uint32(_MULT)) >> np.uint32(32 - bits)).astype(np.int32)


def features(text: bytes, classes: np.ndarray) -> np.ndarray:
    """Numbers of the indicators that a text sets, ascending."""
    raw = np.frombuffer(text, dtype=np.uint8)
    parts = []
    if len(raw) >= 3:
        b = raw.astype(np.uint32)
        parts.append(_hash(b[:-2] << 16 | b[1:-1] << 8 | b[2:], GRAM_BITS))
    c = classes[raw]
    if len(c):
        c = c[np.concatenate([[True], c[1:] != c[:-1]])]
    if len(c) >= 4:
        parts.append((1 << GRAM_BITS) + _hash(c[:-3] << 24 | c[1:-2] << 16 | c[2:-1] << 8 | c[3:], CLASS_BITS))
    words = text.split()
    if words:
        share = len(set(words)) * (RATIO_BINS - 1) // len(words)
        parts.append(np.array([FEATURES - RATIO_BINS + share], dtype=np.int32))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.int32)


def log_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.ones((2, FEATURES))
    for idx, y in zip(rows, labels):
        counts[y, idx] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    return np.log(counts[1] / counts[0])


def fit_hinge(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cost: float = COST,
              passes: int = PASSES) -> np.ndarray:
    """Weights (the last is the bias) by dual coordinate descent."""
    w = np.zeros(FEATURES + 1)
    alpha = np.zeros(len(rows))
    sign = np.where(labels > 0, 1.0, -1.0)
    rng = np.random.default_rng(0)
    square = [float(v @ v) + 1 for v in values]
    for _ in range(passes):
        for i in rng.permutation(len(rows)).tolist():
            idx, v = rows[i], values[i]
            slope = sign[i] * (float(w[idx] @ v) + w[-1]) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost)
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[idx] += step * v
                w[-1] += step
                alpha[i] = new
    return w


def unit(idx: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    v = ratio[idx]
    return v / max(float(np.sqrt(v @ v)), 1e-12)


MODEL = "feature int, ratio double, weight double"


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
        training: Column | None = None, max_train: int = MAX_TRAIN) -> DataFrame:
    """The model as rows (feature, ratio, weight); feature -1 is the bias.
    ``training`` selects the label rows that may be learnt from."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    if training is not None:
        known = known.where(training)
    known = known.groupBy(F.col(doc_id).cast("long").alias("_id")).agg(F.min(label).cast("int").alias("y"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(max_train)
    # at most max_train rows, so the broadcast has a bound
    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).cast("binary").alias("t")).join(
        F.broadcast(sample), "_id")
    rows = rows.groupBy("_id", "y").agg(F.min(F.struct(F.sha2("t", 256).alias("h"), "t")).alias("least")).select(
        "_id", "least.t", "y")

    def extract(batches):
        import pyarrow as pa
        classes = _classes()
        for b in batches:
            idx = [features(t.as_buffer().to_pybytes() if t.is_valid else b"", classes) for t in b.column(1)]
            ends = np.cumsum([0, *map(len, idx)]).astype(np.int32)
            flat = np.concatenate([*idx, np.zeros(0, dtype=np.int32)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.ListArray.from_arrays(ends, pa.array(flat))],
                                             names=["_id", "y", "idx"])

    def train(t):
        import pyarrow as pa
        order = np.argsort(t.column("_id").to_numpy(), kind="stable")  # the same model however rows arrive
        y = t.column("y").to_numpy()[order]
        lists = t.column("idx").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        idx = [flat[ends[i]:ends[i + 1]] for i in order.tolist()]
        if len(set(y.tolist())) < 2:
            return pa.table({"feature": pa.array([], pa.int32()), "ratio": pa.array([], pa.float64()),
                             "weight": pa.array([], pa.float64())})
        ratio = log_ratios(idx, y)
        w = fit_hinge(idx, [unit(i, ratio) for i in idx], y)
        used = np.flatnonzero(ratio)
        return pa.table({"feature": pa.array(np.append(used, -1).astype(np.int32)),
                         "ratio": pa.array(np.append(ratio[used], 0.0)), "weight": pa.array(np.append(w[used], w[-1]))})

    indicators = rows.mapInArrow(extract, "_id long, y int, idx array<int>")
    whole = indicators.withColumn("one", F.col("y") * 0)
    return whole.groupBy("one").applyInArrow(train, MODEL)  # one group, bounded by max_train


def score(docs: DataFrame, model: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every document."""
    rows = model.collect()  # at most FEATURES + 1
    ratio, weight, bias = np.zeros(FEATURES), np.zeros(FEATURES), 0.0
    for r in rows:
        if r["feature"] < 0:
            bias = r["weight"]
        else:
            ratio[r["feature"]], weight[r["feature"]] = r["ratio"], r["weight"]

    def run(batches):
        import pyarrow as pa
        classes = _classes()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                out = []
                for t in part.column(1):
                    idx = features(t.as_buffer().to_pybytes() if t.is_valid else b"", classes)
                    margin = float(weight[idx] @ unit(idx, ratio)) + bias
                    out.append(1 / (1 + np.exp(-SLOPE * min(max(margin, -50), 50))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
