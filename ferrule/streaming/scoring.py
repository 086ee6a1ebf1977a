"""Structured Streaming entry points.

The reference has no streams; what carries over is batch scoring (ML10): a fitted
Spark ML model applied to a streaming DataFrame (``transform`` is stateless, so each
micro-batch is scored independently).  Per-recording features need whole recordings
and are batch jobs only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def score_stream(model, stream: DataFrame, keep: list[str] | None = None) -> DataFrame:
    out = model.transform(stream)
    return out.select(*(keep or []), "prediction") if keep is not None else out
