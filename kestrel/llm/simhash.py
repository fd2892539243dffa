"""SimHash near-duplicates with covering locality-sensitive hashing.

Method: a text's fingerprint has a bit set where over half of its shingles'
64-bit hashes have it.  Bit i gets the non-zero vector phi(i) of radius + 1
binary digits; table v (every non-zero vector of that length) keeps the bits
with <phi(i), v> odd.  At most ``radius`` differing bits span fewer dimensions
than v has, so some v is orthogonal to all of them: that table keeps none of
the differing bits and the pair collides in it.  Nothing within the radius is
missed.  Equal fingerprints are one row before the tables are built.

Defined cases: null and empty texts have fingerprint 0 and link like any
other; repeated rows share a component; a null doc_id takes part but never
names a component.  Columns besides the two named are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import components as C
from kestrel.llm.tables import stored

BITS = 64


def masks(radius: int) -> list[int]:
    """Bits that each table keeps, as 64-bit numbers."""
    top = 1 << (radius + 1)
    phi = [1 + i % (top - 1) for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (phi[i] & v).bit_count() % 2) for v in range(1, top)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: bytes, size: int, seed: int) -> int:
    """Fingerprint of one text over its shingles of ``size`` words."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    plain = b" ".join(words)
    if len(words) <= size:
        return xxh64_intdigest(plain, seed)
    end = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    first = np.concatenate([[0], end[:-1] + 1])
    n = len(words) - size + 1
    hashes = np.fromiter((xxh64_intdigest(plain[a:b], seed) for a, b in zip(first[:n].tolist(), end[size - 1:].tolist())),
                         dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = np.ascontiguousarray(hashes[at:at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, size: int = 3, seed: int = 42, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                fps = [signed(fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", size, seed))
                       for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(run, "doc_id long, fp long")


def fingerprint_components(fps: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, class_fp) for fingerprints (a column ``fp``, distinct) that lie
    within ``radius`` bits of another one, directly or through others."""
    tables = F.explode(F.array(*[F.struct(F.lit(v).alias("table"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("kept"))
                                 for v, m in enumerate(masks(radius))])).alias("t")
    rows = fps.select(F.col("fp").alias("id"), tables).select("t.table", "t.kept", "id", F.col("id").alias("bits"))
    links = C.bucket_links(rows, ["table", "kept"], lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= radius, "bits")
    return C.components(links).select(F.col("id").alias("fp"), F.col("component").alias("class_fp"))


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3, seed: int = 42, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row a document: doc_id, fingerprint (hex), component_id (the
    smallest doc_id reachable over links of at most ``radius`` bits)."""
    prints = stored(fingerprints(docs, size, seed, doc_id, text), "fingerprints")
    groups = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-groups")
    classes = stored(fingerprint_components(groups.select("fp"), radius), "fingerprint-classes")
    named = (groups.join(classes, "fp", "left").withColumn("class_fp", F.coalesce("class_fp", "fp")))
    least = named.groupBy("class_fp").agg(F.min("least").alias("component_id"))
    component = named.join(least, "class_fp").select("fp", "component_id")
    return prints.join(component, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
