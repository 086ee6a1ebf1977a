"""Operator 7: exact top-k inner products by MaxScore over shards.

Vectors are integers; a component is a term, a vector's value its impact.  The
candidates are hashed into shards of about ``shard_rows`` vectors and the queries
into blocks; every query block meets every shard (a stated query set against all
rows), in groups of blocks and shards that are shuffled together.  In a shard:

* a term's upper bound for a query is the largest product of the query's value with
  any value the shard holds, so postings with a product of 0 or less never raise it;
* terms are ordered by their bounds, largest first, and split into **essential** terms and
  the rest, whose bounds summed cannot lift a candidate over the k-th best score
  known for the query; the split moves forward as that threshold rises;
* the essential postings are traversed for all candidates, and a candidate is probed
  in the next terms only while its partial score plus the bounds left is competitive.

The lists of a group's shards are merged where they are made, those of the groups by a ranked window (limited per group before the
shuffle).  Scores are integers, ties go to the smaller id.  Where a block's products fit, they
are held exactly in doubles; otherwise doubles with their error bounds only tell which
candidates are competitive, and those are scored in whole numbers of any size.  A score
beyond a long is given as the nearest long.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SHARD_ROWS, QUERY_ROWS, STEP = 4096, 256, 8
#: Blocks that meet in one group, at most, and the bytes of either side.
QUERY_BLOCKS, SHARDS, GROUP_BYTES = 64, 16, 32 << 20


def _pack(t: pa.Table) -> pa.Table:
    """The vectors of one block, by id, as one row: ids, values (rows x width, whole doubles)."""
    t = t.sort_by("id")
    v = t["vec"].combine_chunks()
    size = np.diff(v.offsets.to_numpy())
    width = max(1, int(size.max()))
    m = np.zeros((t.num_rows, width))
    m[np.arange(width)[None, :] < size[:, None]] = np.floor(v.flatten().to_numpy().astype(np.float64))
    ids = t["id"].combine_chunks().to_numpy()
    return pa.table({"block": t["block"].slice(0, 1), "ids": pa.array([ids.tobytes()], pa.binary()), "vals": pa.array([m.tobytes()], pa.binary())})


def _open(ids: bytes, vals: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vals, np.float64).reshape(len(i), -1)


def max_score(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, theta: np.ndarray, step: int = STEP):
    """Rows (query row, candidate row, score) that can be among the best ``k``; raises
    ``theta`` (k-th best score known per query) in place."""
    width = min(q.shape[1], x.shape[1])
    qf, xf = q[:, :width], x[:, :width]
    if not float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * width < 2 ** 53:
        return _exact(q_ids, qf, ids, xf, k, theta)
    bound = np.maximum(qf * xf.max(axis=0), qf * xf.min(axis=0))
    order = np.argsort(-bound.sum(axis=0), kind="stable")  # one order for the block
    qf, xf, bound = qf[:, order], np.ascontiguousarray(xf[:, order]), bound[:, order]
    left = np.concatenate((np.cumsum(bound[:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1))), axis=1)
    row = {int(i): n for n, i in enumerate(ids)}
    own = np.array([row.get(int(i), -1) for i in q_ids])
    # A first estimate of the threshold: the k-th best among a few candidates.
    few = np.arange(min(len(ids), 8 * k + 1))
    if len(few) > k:
        s = qf @ xf[few].T
        mine = np.flatnonzero((own >= 0) & (own < len(few)))
        s[mine, own[mine]] = -np.inf
        theta[:] = np.maximum(theta, np.partition(s, len(few) - k, axis=1)[:, len(few) - k])
    # Essential terms per query: the fewest after which the bounds left cannot reach the
    # threshold alone (rounded up to whole steps, so that queries share a traversal).
    split = (left >= theta[:, None]).sum(axis=1).clip(1, width)
    split = np.minimum(width, -(-split // step) * step)
    found = [_probe(rows, qf, xf, left, theta, own, int(split[rows[0]]), step) for rows in (np.flatnonzero(split == v) for v in np.unique(split))]
    qr, cr, part = (np.concatenate(x) for x in zip(*found))
    best = np.lexsort((ids[cr], -part, qr))
    qr, cr, part = qr[best], cr[best], part[best]
    first = np.searchsorted(qr, np.arange(len(q)))
    rank = np.arange(len(qr)) - first[qr]
    top = rank < k
    kth = np.flatnonzero(rank == k - 1)
    theta[qr[kth]] = np.maximum(theta[qr[kth]], part[kth])
    return qr[top], cr[top], part[top].astype(np.int64)


def _exact(q_ids, qf, ids, xf, k, theta):
    """The same for products that doubles don't hold: candidates within the rounding error of the
    k-th best are scored in whole numbers."""
    whole = [[int(v) for v in row] for row in xf.tolist()]
    found = []
    with np.errstate(over="ignore", invalid="ignore"):
        s, slack = qf @ xf.T, (np.abs(qf) @ np.abs(xf).T) * (xf.shape[1] + 2) * 2.0 ** -52
        low, high = s - slack, s + slack
    for i, row in enumerate(qf.tolist()):
        fine = np.isfinite(low[i]) & np.isfinite(high[i])
        other = ids != q_ids[i]
        sure = np.sort(low[i][fine & other])[::-1]
        least = max(theta[i], sure[k - 1] if len(sure) >= k else -np.inf)
        mine = [int(v) for v in row]
        best = sorted((-sum(a * b for a, b in zip(mine, whole[c])), int(ids[c]), c) for c in np.flatnonzero(other & (~fine | (high[i] >= least))))[:k]
        if len(best) == k and abs(best[-1][0]) < 2 ** 1000:
            theta[i] = max(theta[i], np.nextafter(float(-best[-1][0]), -np.inf))
        found += [(i, c, min(max(-n, -(1 << 63)), (1 << 63) - 1)) for n, _, c in best]
    cols = list(zip(*found)) or [[]] * 3
    return tuple(np.array(c, np.int64) for c in cols)


def _probe(rows, qf, xf, left, theta, own, at, step):
    """Traverse the first ``at`` terms for all candidates, probe the competitive ones further."""
    score = qf[rows, :at] @ xf[:, :at].T
    live = score + left[rows, at][:, None] >= theta[rows][:, None]
    mine = np.flatnonzero(own[rows] >= 0)
    live[mine, own[rows][mine]] = False
    r, cr = np.nonzero(live)
    part, qr = score[r, cr], rows[r]
    while at < qf.shape[1] and len(qr):
        to = min(qf.shape[1], at + step)
        part = part + np.einsum("ij,ij->i", qf[qr, at:to], xf[cr, at:to])
        ok = part + left[qr, to] >= theta[qr]
        qr, cr, part, at = qr[ok], cr[ok], part[ok], to
    return qr, cr, part


def _search(k: int):
    """One query group against one group of shards: the best ``k`` of each query."""
    def run(queries: pa.Table, shards: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 3]
        if queries.num_rows and shards.num_rows:
            shards = shards.sort_by("block")
            opened = [_open(i.as_py(), v.as_py()) for i, v in zip(shards["ids"], shards["vals"])]
            for qi, qv in zip(queries["ids"], queries["vals"]):
                q_ids, q = _open(qi.as_py(), qv.as_py())
                theta = np.full(len(q_ids), -np.inf)
                found = [(r, ids[c], s) for ids, x in opened for r, c, s in [max_score(q_ids, q, ids, x, k, theta)]]
                row, vec, score = (np.concatenate(c) for c in zip(*found))
                best = np.lexsort((vec, ~score, row))  # ~: descending, without overflow
                row, vec, score = row[best], vec[best], score[best]
                top = np.arange(len(row)) - np.searchsorted(row, row) < k
                out.append((q_ids[row[top]], vec[top], score[top]))
        q_id, vec, score = (np.concatenate(c) for c in zip(*out))
        return pa.table({"query_id": q_id, "vec_id": vec, "score": score})

    return run


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` from vectors ``(id, vec)``, components rounded down to
    whole numbers; a query never finds its own id.  Vectors of unequal length count as padded
    with zeros, an empty one as zeros only; ids are taken as distinct (of rows that share an id
    each is a candidate)."""
    def blocks(df: DataFrame, rows: int, tag: str) -> tuple[DataFrame, int]:
        n = max(1, math.ceil(df.count() / rows))
        return common.save(df.select("id", "vec", F.pmod(F.xxhash64("id"), F.lit(n)).alias("block"))
                           .groupBy("block").applyInArrow(_pack, "block long, ids binary, vals binary"), tag), n

    found = _meet(*blocks(queries, query_rows, "topk-queries"), *blocks(vectors, shard_rows, "topk-shards"), k)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _held(blocks: DataFrame, limit: int) -> int:
    """Blocks that a group may hold: ``limit``, or fewer of wide vectors."""
    largest = blocks.agg(F.max(F.octet_length("vals"))).first()[0] or 1
    return max(1, min(limit, GROUP_BYTES // largest))


def _meet(q: DataFrame, n_q: int, c: DataFrame, n_c: int, k: int) -> DataFrame:
    """Every query block with every shard, in groups of both: a block is sent once to each
    group of the other side, by shuffle (a table of block copies is many times what its
    files say, so it must not be broadcast)."""
    a, b = _held(q, QUERY_BLOCKS), _held(c, SHARDS)
    tasks = 4 * q.sparkSession.sparkContext.defaultParallelism
    while (a > 1 or b > 1) and math.ceil(n_q / a) * math.ceil(n_c / b) < tasks:
        a, b = (math.ceil(a / 2), b) if b == 1 or a > b else (a, math.ceil(b / 2))

    def sent(df: DataFrame, mine: str, per: int, other: str, groups: int) -> DataFrame:
        return df.select(F.expr(f"block div {per}").alias(mine), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias(other), "block", "ids", "vals")

    left, right = sent(q, "_q", a, "_c", math.ceil(n_c / b)), sent(c, "_c", b, "_q", math.ceil(n_q / a))
    return left.groupBy("_q", "_c").cogroup(right.groupBy("_q", "_c")).applyInArrow(_search(k), "query_id long, vec_id long, score long")


def scaled(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """``(id, vec)`` with floor(scale * x) as whole doubles; rows with a null id, a null vector, or
    a null or non-finite component take no part, empty vectors do."""
    x = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    fine = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return x.where(F.coalesce(fine, F.lit(False))).select("id", F.transform("v", lambda e: F.when(F.abs(e * scale) < 2.0 ** 53, F.floor(e * scale).cast("double")).otherwise(e * scale)).alias("vec"))


def op7_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``embeddings`` whose vec_id is divisible by 50 against all rows, 5 best."""
    v = scaled(common.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return top_k(v.where("id % 50 = 0"), v, 5).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
