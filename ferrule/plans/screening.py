"""Queries of the isolation filter, with SQL that grows and walks the same forest."""

from __future__ import annotations

from ..functions.columns import round_all
from ..operators import isolation
from ..sources import tables
from .catalog import register
from . import sql_fragments as S

from pyspark.sql import functions as F

COLS, TREES, SAMPLE, DEPTH = ["l_quantity", "l_extendedprice", "l_discount"], 8, 64, 5


def _forest_sql() -> str:
    """Levels unrolled: statistics, splits, children; then every row's walk."""
    step, unit = (1 << 32) // TREES, lambda what: f"({S.portable_hash_sql('(tree || chr(58) || node)', what + '42')} / 4294967296.0::DOUBLE)"
    out = [f"""li AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, {', '.join(f'{c}::DOUBLE AS x{i}' for i, c in enumerate(COLS))}, {S.portable_hash_sql("(l_orderkey || chr(58) || l_linenumber)", 'iso42')} AS h FROM lineitem),
cn AS (SELECT CASE WHEN count(*) <= {SAMPLE} THEN 4294967296 ELSE floor(4294967296.0::DOUBLE * {SAMPLE} / count(*))::BIGINT END AS wide FROM li),
r0 AS (SELECT t.tree, 0 AS node, x0, x1, x2 FROM li, cn, (SELECT unnest(range({TREES})) AS tree) t WHERE ((h - t.tree * {step}) % 4294967296 + 4294967296) % 4294967296 < wide)"""]
    for d in range(DEPTH + 1):
        size = "0" if d == DEPTH else "len(v)"
        out.append(f"""s{d} AS (SELECT tree, node, count(*) AS n, list_filter([{', '.join(f"{{'i': {i}, 'lo': min(x{i}), 'hi': max(x{i})}}" for i in range(len(COLS)))}], lambda e: e.hi > e.lo) AS v FROM r{d} GROUP BY ALL),
n{d} AS (SELECT tree, node, n, {d} AS depth, CASE WHEN {size} > 0 THEN v[floor({unit('col')} * len(v))::INT + 1] END AS s, {unit('at')} AS u FROM s{d})""")
        if d < DEPTH:
            x = f"CASE s.i {' '.join(f'WHEN {i} THEN x{i}' for i in range(len(COLS)))} END"
            out.append(f"r{d + 1} AS (SELECT r.tree, 2 * r.node + CASE WHEN {x} <= s.lo + u * (s.hi - s.lo) THEN 1 ELSE 2 END AS node, x0, x1, x2 FROM r{d} r JOIN n{d} n ON n.tree = r.tree AND n.node = r.node WHERE s IS NOT NULL)")
    c = lambda n: f"(CASE WHEN {n} <= 1 THEN 0.0::DOUBLE WHEN {n} <= 2 THEN 1.0::DOUBLE ELSE 2 * (ln({n} - 1) + {isolation.EULER}::DOUBLE) - 2 * ({n} - 1) / ({n})::DOUBLE END)"
    out.append("f AS (" + " UNION ALL ".join(f"SELECT tree, node, s.i AS i, s.lo + u * (s.hi - s.lo) AS thr, depth + {c('n')} AS len FROM n{d}" for d in range(DEPTH + 1)) + ")")
    out.append(f"w0 AS (SELECT rid, l_orderkey, l_linenumber, x0, x1, x2, t.tree, 0 AS node FROM li, (SELECT unnest(range({TREES})) AS tree) t)")
    for d in range(DEPTH):
        x = f"CASE f.i {' '.join(f'WHEN {i} THEN x{i}' for i in range(len(COLS)))} END"
        out.append(f"w{d + 1} AS (SELECT rid, l_orderkey, l_linenumber, x0, x1, x2, w.tree, CASE WHEN f.i IS NULL THEN w.node ELSE 2 * w.node + CASE WHEN {x} <= thr THEN 1 ELSE 2 END END AS node FROM w{d} w JOIN f ON f.tree = w.tree AND f.node = w.node)")
    out.append(f"""sz AS (SELECT least({float(SAMPLE)}::DOUBLE, greatest(sum(n) / {float(TREES)}::DOUBLE, 2)) AS m FROM n0),
sc AS (SELECT rid, l_orderkey, l_linenumber, pow(2, -sum(len) / {float(TREES)}::DOUBLE / any_value({c('m')})) AS score FROM w{DEPTH} w JOIN f ON f.tree = w.tree AND f.node = w.node, sz GROUP BY ALL)""")
    return ", ".join(out)


FOREST_SQL = _forest_sql()


def _scored(spark, d):
    li = tables.read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *COLS)
    li = li.withColumn("row_id", F.concat_ws(":", "l_orderkey", "l_linenumber"))
    return isolation.isolation_scores(li, "row_id", COLS, TREES, SAMPLE, DEPTH)


@register("quality_isolation_scores", f"WITH {FOREST_SQL} SELECT l_orderkey, l_linenumber, round(score, 6) AS score FROM sc")
def q_quality_isolation_scores(spark, d):
    return round_all(_scored(spark, d).select("l_orderkey", "l_linenumber", "score"))


@register("quality_isolation_filter", f"""WITH {FOREST_SQL} SELECT count(*) AS before, count(*) FILTER (WHERE score <= 0.5) AS after, count(*) FILTER (WHERE score > 0.5) AS dropped, 0::BIGINT AS unscored FROM sc""")
def q_quality_isolation_filter(spark, d):
    return isolation.filter_counts(_scored(spark, d))
