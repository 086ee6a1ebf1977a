"""Operator 10: quality classifier with hierarchical empirical Bayes.

1. **Document evidence.** Dense features of a text (character classes, word lengths,
   repetition of words and lines) from one vectorised pass, and a logistic
   regression on them, fitted by Newton steps on labelled rows.
2. **Sites.** The mean evidence of every host and of every path below it, from two
   grouped sums with map-side combine.  A host's rate shrinks toward the global rate, a
   path's toward its host's, each with a prior strength taken from the between-site
   variance by moments: few rows stay near the prior, many rows speak for themselves.
3. **Posterior.** log-odds of the document plus the shift of its path's rate against the
   global rate; the document's own share is taken out of its path's rate first.

Training rows are a bounded, documented sample (``max_train``, by hash of the id); all
counts, rates and scores cover every row.  Only the weights, the prior strengths and
the Gram matrices' sums reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .words import Words

#: Most labelled rows that a fit takes (chosen by hash of the id when there are more).
MAX_TRAIN = 50_000
KEEP = 0.5

FEATURES = ("bias", "log_words", "letters", "upper", "digits", "space", "marks", "end_marks", "mean_word", "long_words", "marked_words", "distinct_words",
            "top_word", "repeated_pairs", "distinct_lines", "shouting")
_N = len(FEATURES)

_CLASS = np.zeros((7, 256), bool)
_CLASS[0, [*range(65, 91), *range(97, 123), *range(128, 256)]] = True  # letters (and non-ASCII)
_CLASS[1, 65:91] = True
_CLASS[2, 48:58] = True
_CLASS[3, [32, 9, 10, 11, 12, 13]] = True
_CLASS[4, [i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,;:'\"?!()-"]] = True
_CLASS[5, [ord(c) for c in ".,;:?!"]] = True
_CLASS[6, 97:123] = True


def _per_text(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, values, minlength=n)


def features(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES per text; an empty text has the bias alone."""
    n = len(texts)
    w = Words(texts)
    size = np.fromiter(map(len, texts), np.float64, n)
    some = np.maximum(size, 1)
    edge = np.append(w.text_start, len(w.buf)).astype(np.int64)
    out = np.zeros((n, _N))
    out[:, 0] = 1

    def share(row: int) -> np.ndarray:
        if not len(w.buf):
            return np.zeros(n)
        run = np.append(0, np.cumsum(_CLASS[row][w.buf], dtype=np.int64))
        return (run[np.minimum(w.text_start + size.astype(np.int64), len(w.buf))] - run[edge[:-1]]) / some

    k = np.maximum(w.count, 1)
    out[:, 1] = np.log1p(w.count) / 8
    for col, row in ((2, 0), (3, 1), (4, 2), (5, 3), (6, 4), (7, 5)):
        out[:, col] = share(row)
    length = (w.end - w.start).astype(np.float64)
    out[:, 8] = _per_text(length, w.doc, n) / k / 10
    out[:, 9] = _per_text(length > 20, w.doc, n) / k
    if len(w.start):
        last = w.buf[w.end - 1]
        out[:, 10] = _per_text(_CLASS[4][last] | (last == ord("!")), w.doc, n) / k
        h = w.hashes()
        order = np.lexsort((h, w.doc))
        hd, hh = w.doc[order], h[order]
        head = np.flatnonzero(np.append(True, (hd[1:] != hd[:-1]) | (hh[1:] != hh[:-1])))
        times = np.diff(np.append(head, len(hh)))
        out[:, 11] = np.bincount(hd[head], minlength=n) / k
        top = np.zeros(n)
        np.maximum.at(top, hd[head], times)
        out[:, 12] = top / k
        pair = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
        out[:, 13] = _per_text(pair, w.doc[1:], n) / k
    lines = [t.split(b"\n") for t in texts]
    out[:, 14] = [len(set(x)) / len(x) for x in lines]
    out[:, 15] = share(1) / np.maximum(share(1) + share(6), 1e-9)
    out[size == 0, 1:] = 0
    return out


def _score(weights: np.ndarray | None):
    """Rows (id, ..., text) to the same without text, plus features or the log-odds."""
    def run(batches):
        for part, texts in common.text_slices(batches):
            x = features(texts)
            rest = part.drop_columns(["text"])
            new = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), _N).cast(pa.list_(pa.float64())) if weights is None else pa.array(np.clip(x @ weights, -30, 30))
            yield pa.RecordBatch.from_arrays([*rest.columns, new], names=[*rest.schema.names, "x"])

    return run


def fit(rows: DataFrame, steps: int = 25, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; each step adds up gradient and Hessian of the
    saved training rows ``(x, y)`` in Spark.  With one class (or no row) the weights are
    the smoothed log-odds in the bias alone."""
    n, pos = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    w = np.zeros(_N)
    w[0] = np.log((pos + 1) / (n - pos + 1))
    if not 0 < pos < n:
        return w

    def sums(w):
        def run(batches):
            g, hess, loss = np.zeros(_N), np.zeros((_N, _N)), 0.0
            for b in batches:
                x = b.column(0).flatten().to_numpy().reshape(-1, _N)
                y = b.column(1).to_numpy(zero_copy_only=False).astype(float)
                z = np.clip(x @ w, -30, 30)
                p = 1 / (1 + np.exp(-z))
                g += x.T @ (y - p)
                hess += (x * (p * (1 - p))[:, None]).T @ x
                loss += float((np.logaddexp(0, z) - y * z).sum())
            yield pa.RecordBatch.from_pydict({"s": pa.array([np.concatenate((g, hess.ravel(), [loss])).tolist()], pa.list_(pa.float64()))})

        parts = rows.select("x", "y").mapInArrow(run, "s array<double>")
        flat = parts.select(F.posexplode("s")).groupBy("pos").agg(F.sum("col").alias("v")).orderBy("pos").collect()  # _N + _N^2 + 1 rows
        v = np.array([r["v"] for r in flat])
        return v[:_N], v[_N:-1].reshape(_N, _N), v[-1]

    best, penalty = None, ridge * n / 1000
    for _ in range(steps):
        g, hess, loss = sums(w)
        loss += penalty / 2 * float(w[1:] @ w[1:])
        if best is not None and best - loss < 1e-4 * n / 1000:
            break
        best = loss
        g[1:] -= penalty * w[1:]
        w = w + np.clip(np.linalg.solve(hess + np.diag([1e-9] + [penalty] * (_N - 1)), g), -20, 20)
    return w


def _prob(x: str) -> Column:
    return 1 / (1 + F.exp(-F.col(x)))


def _strength(n: str, mean: str, prior: Column, df: DataFrame) -> float:
    """Prior strength m by moments: sites' means around their prior have variance
    prior (1 - prior) (1/n + 1/m); the excess over 1/n gives m (1 to 10^6)."""
    v = prior * (1 - prior)
    r = df.agg(F.sum(F.col(n) * (F.col(mean) - prior) ** 2).alias("d"), F.sum(v).alias("v"), F.sum(v * F.col(n)).alias("vn")).first()
    if not r["vn"]:
        return 1.0
    extra = max(0.0, (r["d"] or 0.0) - r["v"]) / r["vn"]
    return float(min(1e6, max(1.0, 1 / extra if extra > 0 else 1e6)))


class Model:
    """Weights and site table; ``sites`` holds ``(host, path, n, total, host_rate)``."""

    def __init__(self, weights, sites, rate, path_strength):
        self.weights, self.sites, self.rate, self.path_strength = weights, sites, rate, path_strength

    def posterior(self, rows: DataFrame) -> DataFrame:
        """Add ``evidence``, ``site_rate``, ``quality`` to rows with ``_host``, ``_path``, ``x``."""
        s = self.sites.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "n", "total", "host_rate")
        out = rows.join(s, rows["_host"].eqNullSafe(s["_h"]) & rows["_path"].eqNullSafe(s["_p"]), "left")
        # Without the row's own share; a path unknown to the model stands at the global rate.
        site = (F.col("total") - _prob("x") + F.lit(self.path_strength) * F.col("host_rate")) / (F.col("n") - 1 + F.lit(self.path_strength))
        site = F.least(F.greatest(F.coalesce(site, F.lit(self.rate)), F.lit(1e-4)), F.lit(1 - 1e-4))
        shift = F.log(site / (1 - site)) - F.lit(float(np.log(self.rate / (1 - self.rate))))
        return out.withColumn("evidence", _prob("x")).withColumn("site_rate", site).withColumn("quality", 1 / (1 + F.exp(-(F.col("x") + shift)))) \
            .drop("_h", "_p", "n", "total", "host_rate")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None, path: Column | None = None,
          label_id: str = "doc_id", label_col: str = "quality", max_train: int = MAX_TRAIN) -> Model:
    """Fit the document classifier on labelled rows and the site rates on all rows."""
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    src = docs.select(F.col(id_col).alias("id"), host.cast("string").alias("_host"), path.cast("string").alias("_path"), F.col(text_col).alias("text"))
    seen = common.save(src.mapInArrow(_score(None), "id long, _host string, _path string, x array<double>"), "quality-features")
    known = labels.select(F.col(label_id).alias("k"), F.col(label_col).cast("int").alias("y")).where("k IS NOT NULL AND y IN (0, 1)").groupBy("k").agg(F.max("y").alias("y"))
    n = known.count()
    if n > max_train:
        known = known.where(F.pmod(F.xxhash64("k"), F.lit(1 << 30)) < int((1 << 30) * max_train / n))
    weights = fit(common.save(seen.join(known, seen["id"] == known["k"]).select("x", "y"), "quality-train"))
    dot = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(v)) for v in weights]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    odds = seen.select("_host", "_path", F.greatest(F.least(dot, F.lit(30.0)), F.lit(-30.0)).alias("x"))
    paths = common.save(odds.groupBy(F.col("_host").alias("host"), F.col("_path").alias("path")).agg(F.count(F.lit(1)).alias("n"), F.sum(_prob("x")).alias("total")), "quality-paths")
    rate = paths.agg(F.sum("total") / F.sum("n")).first()[0]
    rate = min(max(0.5 if rate is None else float(rate), 1e-4), 1 - 1e-4)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("total").alias("ht"))
    m_host = _strength("hn", "mean", F.lit(rate), hosts.withColumn("mean", F.col("ht") / F.col("hn")))
    hosts = hosts.select(F.col("host").alias("h"), ((F.col("ht") + m_host * rate) / (F.col("hn") + m_host)).alias("host_rate"))
    both = paths.join(hosts, paths["host"].eqNullSafe(hosts["h"])).drop("h")
    m_path = _strength("n", "mean", F.col("host_rate"), both.withColumn("mean", F.col("total") / F.col("n")))
    return Model(weights, common.save(both, "quality-sites"), rate, m_path)


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None, path: Column | None = None, keep: float = KEEP) -> DataFrame:
    """``(doc_id, evidence, site_rate, quality, keep)``, a row per document row.

    Null and empty texts are scored on the bias alone, null hosts and paths are sites like
    any other, an empty table gives an empty result, other columns are ignored.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), host.cast("string").alias("_host"), path.cast("string").alias("_path"), F.col(text_col).alias("text"))
    x = src.mapInArrow(_score(model.weights), "doc_id long, _host string, _path string, x double")
    return model.posterior(x).select("doc_id", "evidence", "site_rate", "quality", (F.col("quality") >= keep).alias("keep"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``; host = source, path = language below it, labels from ``labels``."""
    docs = common.table(spark, sf_dir, "documents")
    return classify(docs, train(docs, common.table(spark, sf_dir, "labels")))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """Pipeline stage: documents whose posterior is at least ``keep``, columns unchanged."""
    model = train(docs, labels, id_col, text_col)
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("source").cast("string").alias("_host"),
                         F.col("lang").cast("string").alias("_path"), F.col(text_col).alias("text"))
    row = packed.schema["row"].dataType.simpleString()
    x = packed.mapInArrow(_score(model.weights), f"row {row}, _host string, _path string, x double")
    return model.posterior(x).where(F.col("quality") >= keep).select("row.*")
