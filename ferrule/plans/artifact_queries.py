"""Queries that write a table's results as files and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.columns import round_all
from ..operators import metrics
from ..sources import artifacts, reports, tables
from ..storage import shared_dir
from .catalog import THREE_CLASS_CTE, _three_class, register, report_sql


def _place(spark, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex[:12]}"


@register("artifact_report_roundtrip", report_sql(THREE_CLASS_CTE, "fold") + """
SELECT fold, row, CAST(printf('%.3f', precision) AS DOUBLE) AS precision, CAST(printf('%.3f', recall) AS DOUBLE) AS recall, CAST(printf('%.3f', f1) AS DOUBLE) AS f1, support FROM rep""")
def q_artifact_report_roundtrip(spark, d):
    """Class reports per fold written as sectioned text, three digits, and read back in small ranges."""
    uri = _place(spark, "reports")
    reports.write_report(metrics.classification_report(_three_class(spark, d), ["fold"]), uri)
    return reports.read_report(spark, uri, 1 << 10).drop("file")


@register("artifact_trace_best", """WITH t AS (SELECT l_quantity::INT AS i, round(avg(l_extendedprice), 4) AS v FROM lineitem GROUP BY 1)
SELECT (SELECT i FROM t ORDER BY v DESC, i LIMIT 1) AS best_iter, max(v) AS best_value, 1::BIGINT AS n_rejected FROM t""")
def q_artifact_trace_best(spark, d):
    """A metric per iteration as a trace file (one line spoilt), and its best iteration."""
    li = tables.read_table(spark, d, "lineitem")
    t = li.groupBy(F.col("l_quantity").cast("int").alias("i")).agg(F.round(F.avg("l_extendedprice"), 4).alias("v"))
    lines = t.select(F.format_string("%d\t%.4f", "i", "v").alias("value"))
    spoilt = li.agg(F.concat(F.lit("1\t"), F.count(F.lit(1)).cast("string"), F.lit("\t2\t")).alias("value"))
    uri = _place(spark, "trace")
    lines.unionByName(spoilt).write.text(uri)
    return round_all(artifacts.best_iteration(artifacts.read_trace(spark, uri, ("v",)), "v"), 4)
