"""Binary archive sources: magic-byte sniffing, entry-suffix filtering,
zip reading (as Spark ``binaryFile`` scans plus ``mapInPandas``) and an
archive writer used to stage test archives from table rows.

Each archive is one row of the ``binaryFile`` scan, so archives are read in
parallel, one task per file split; a damaged archive becomes a quarantine
row with a reason instead of failing the job.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Archive signatures and the entry suffixes kept.
SIGNATURES = [("7z", "377ABCAF271C"), ("zip", "504B0304"), ("zip", "504B0506"), ("zip", "504B0708")]
PAYLOAD_SUFFIXES = (".pb", ".protobuf", ".bin")


def suffix_matches(name: Column, suffixes: Sequence[str]) -> Column:
    """Lower-cased name ends with one of ``suffixes``."""
    alts = "|".join(s.lower().lstrip(".").replace(".", r"\.") for s in suffixes)
    return F.lower(name).rlike(rf"\.({alts})$")


def archive_kind(content: Column) -> Column:
    """'7z' / 'zip' / 'unknown' from the leading bytes."""
    head = F.hex(F.substring(content, 1, 6))
    out = F.lit("unknown")
    for kind, sig in reversed(SIGNATURES):
        out = F.when(head.startswith(sig), F.lit(kind)).otherwise(out)
    return out


def scan_archives(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per archive: path, length, content, kind."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
            .select("path", "length", "content", archive_kind(F.col("content")).alias("kind")))


ENTRY_SCHEMA = "path string, entry string, payload binary, error string"


def _zip_entries(batches: Iterator[pd.DataFrame], suffixes: tuple) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for p, content, kind in zip(pdf["path"], pdf["content"], pdf["kind"]):
            if kind != "zip":
                out.append((p, None, None, f"unsupported archive kind: {kind}"))
                continue
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as zf:
                    for name in zf.namelist():
                        if name.lower().endswith(suffixes):
                            out.append((p, name, zf.read(name), None))
            except (zipfile.BadZipFile, OSError, ValueError) as e:
                out.append((p, None, None, f"bad archive: {e}"))
        yield pd.DataFrame(out, columns=["path", "entry", "payload", "error"])


def archive_entries(archives: DataFrame, suffixes: Sequence[str] = PAYLOAD_SUFFIXES) -> DataFrame:
    """Payload entries of zip archives (per-archive Python work in Arrow
    batches); archives that cannot be read yield one row with ``error``."""
    sfx = tuple(s.lower() for s in suffixes)
    return archives.select("path", "content", "kind").mapInPandas(lambda it: _zip_entries(it, sfx), ENTRY_SCHEMA)


CSV_SCHEMA = "path string, line_no long, fields map<string,string>, error string"


def _zip_records(batches: Iterator[pd.DataFrame], member: str) -> Iterator[pd.DataFrame]:
    """Records of ``member`` with their header's names, in chunks (quoted
    fields may hold line breaks)."""
    for pdf in batches:
        for p, content in zip(pdf["path"], pdf["content"]):
            out, n = [], 0
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as zf, zf.open(member) as f:
                    for rec in csv.DictReader(io.TextIOWrapper(f, encoding="utf-8-sig", newline="")):
                        n += 1
                        out.append((p, n, {k: v for k, v in rec.items() if k is not None}, None))
                        if len(out) == 10_000:
                            yield pd.DataFrame(out, columns=["path", "line_no", "fields", "error"])
                            out = []
            except (zipfile.BadZipFile, KeyError, OSError, ValueError, csv.Error) as e:
                out.append((p, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "line_no", "fields", "error"])


def read_zip_csv(spark: SparkSession, path: str, member: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """``<member>`` CSV inside every zip under ``path``; columns are taken by
    the names of each archive's own header (a missing column is NULL).

    Returns (rows, bad archives); one read of the archives serves both.
    """
    from pyspark.sql.types import StructType
    arch = scan_archives(spark, path)
    records = arch.select("path", "content").mapInPandas(lambda it: _zip_records(it, member), CSV_SCHEMA)
    bad = records.where(F.col("error").isNotNull()).select("path", "error")
    field = F.col("fields")
    rows = records.where(F.col("error").isNull()).select(
        *[field[f.name].try_cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema).fields])
    return rows, bad


def _write_zip_group(pdf: pd.DataFrame, base: str, member: str, header: str, corrupt: bool) -> pd.DataFrame:
    from pyarrow import fs as pafs
    aid = int(pdf["archive_id"].iloc[0])
    lines = [header] + list(pdf.sort_values("line")["line"])
    data = ("\n".join(lines) + "\n").encode("utf-8")
    if not corrupt:
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as zf:
            zf.writestr(member, data)
            zf.writestr(f"feed_{aid:05d}.pb", data)
            zf.writestr("README.txt", b"staged archive")
        data = buf.getvalue()          # corrupt archives stay plain text
    # any Hadoop-style URI the shared folder uses (file:, hdfs:, s3:, ...)
    filesystem, root = pafs.FileSystem.from_uri(base)
    filesystem.create_dir(root, recursive=True)
    path = f"{root}/archive_{aid:05d}.zip"
    with filesystem.open_output_stream(path) as out:
        out.write(data)
    return pd.DataFrame({"archive_id": [aid], "path": [path], "n_lines": [len(lines) - 1]})


def write_zip_archives(df: DataFrame, base: str, member: str, columns: Sequence[str], archive_id: Column,
                       corrupt_if: Column | None = None) -> DataFrame:
    """Stage rows as zip archives (one per ``archive_id`` group, written by
    the task that owns the group; ``base`` must be a shared folder).
    Archives where ``corrupt_if`` holds are written as plain text."""
    header = ",".join(columns)
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in columns])
    g = df.select(archive_id.alias("archive_id"), line.alias("line"),
                  (corrupt_if if corrupt_if is not None else F.lit(False)).alias("corrupt"))

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return _write_zip_group(pdf, base, member, header, bool(pdf["corrupt"].iloc[0]))

    return g.groupBy("archive_id").applyInPandas(fn, "archive_id long, path string, n_lines long")
