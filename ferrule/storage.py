"""Intermediate tables in the folder that driver and executors share.

``save`` writes a table under ``spark.checkpoint.dir`` and reads it back: its rows are
fixed from then on (row order helpers rely on that), lineage ends there, and a lost
executor costs no recomputation.  Only where the setting is absent, as in local tests,
is a scratch folder made.  The tables belong to the checkpoint folder and are cleaned
with it.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="ferrule-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def save(df: DataFrame, tag: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
