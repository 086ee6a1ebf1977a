"""Shared storage and batching helpers of the training-data operators."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a task works on at once; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (``--py-files`` of a running session), once."""
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not any(x.startswith("llm-code-") for x in map(os.path.basename, sc._python_includes)):
        at = tempfile.mkdtemp(prefix="llm-code-")
        name = shutil.make_archive(os.path.join(at, f"llm-code-{uuid.uuid4().hex[:8]}"), "zip", os.path.dirname(root), os.path.basename(root))
        sc.addPyFile(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the
    session.  Only where that is unset (local tests) is a scratch folder made."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table of the shared folder and read it again: lineage ends
    there, every executor can read it, and a lost executor costs no recomputation.
    The folder belongs to the cluster's checkpoint folder and is cleaned with it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    for paths in _SCOPES[-1:]:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables saved in the ``with`` block go when it ends, but for those handed to the
    function that it gives: nothing stays behind that no later plan reads."""
    _SCOPES.append([])
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.update(f.rsplit("/", 1)[0] for f in df.inputFiles())
        return df

    try:
        yield keep
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        names = {k.rsplit("/", 1)[-1] for k in kept}
        for path in _SCOPES.pop():
            if path.rsplit("/", 1)[-1] in names:
                for paths in _SCOPES[-1:]:
                    paths.append(path)
            else:
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(conf).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_slices(batches: Iterator[pa.RecordBatch], text: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into slices of at most ``limit`` text bytes (one row at
    least) and give the texts as UTF-8 bytes, null as empty."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            part = batch.slice(at, to - at)
            raw = part.column(part.schema.get_field_index(text)).cast(pa.binary())
            yield part, [x or b"" for x in raw.to_pylist()]
            at = to


def id_bounds(df: DataFrame, col: str, ranges: int, limit: int = 4096) -> list[float]:
    """Approximate quantiles of an id column, as inner bounds of up to ``ranges``
    ranges (at most ``limit``, so the list stays small at any input size)."""
    n = max(1, min(ranges, limit))
    if n == 1:
        return []
    probs = [i / n for i in range(1, n)]
    found = df.select(F.col(col).cast("double").alias("v")).approxQuantile("v", probs, min(0.01, 0.2 / n))
    return sorted(set(found or []))


def total_bytes(df: DataFrame, text: str = "text") -> tuple[int, int]:
    """(rows, text bytes) of a table, in one aggregate."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0)).alias("b")).first()
    return int(r["n"]), int(r["b"])


def ordered_chunks(ids: np.ndarray, bounds: list[float], sub: int, lo: float, hi: float) -> np.ndarray:
    """Order-preserving chunk of each id: its range among ``bounds``, cut ``sub`` times."""
    edges = np.array([lo, *bounds, hi], float)
    at = np.searchsorted(edges[1:-1], ids, side="right")
    width = np.maximum(edges[at + 1] - edges[at], 1.0)
    part = np.clip(np.floor((ids - edges[at]) / width * sub), 0, sub - 1)
    return at * sub + part.astype(np.int64)
