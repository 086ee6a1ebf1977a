"""Operator 4: near-duplicates by BagMinHash (weighted Jaccard of shingle multisets).

A document is the multiset of its shingles (``k`` consecutive words; a shorter text
is one shingle).  Two documents are linked when their weighted Jaccard similarity
``sum(min) / sum(max)`` of multiplicities is at least ``threshold``.

1. **Signature.** Weights are discretised to units and the unit axis is cut into the
   dyadic intervals [0,1), [1,2), [2,4), ...  Every (shingle, interval) owns a Poisson
   process, seeded by both, of rate equal to the interval's length; a point has a
   component and a place in the interval, the binary digits of which are the path
   down the hierarchy of halves.  A point counts when its place lies below the
   weight.  The first point of each component over all shingles is the signature:
   two documents agree in a component with probability equal to their weighted
   Jaccard similarity.  Points are drawn in rounds, for all processes of a batch at
   once, and a process ends when its next point is behind the last component.
2. **Exact copies** (same word sequence) are folded to their least id.
3. **Banding.** ``bands`` keys of ``rows`` components.  Each bucket links its members
   to its least id, so a bucket of any size gives one pair per member.
4. **Verification.** Multiset overlap of the two documents of each candidate pair.
5. **Rest.** Documents that ended up in different classes of one bucket are compared
   too, unless an upper bound on their overlap or a prefix filter on their rare
   shingles (see ``_rest``) rules the pair out; neither loses a link.
6. Classes are the connected components of the links.

A pair at the threshold shares no bucket with probability (1 - 0.8^4)^32 = 5e-8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .graph import components
from .words import U, Words, mix, window_hash

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
_GOLD = U(0x9E3779B97F4A7C15)


def bag_min_hash(doc: np.ndarray, key: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """Signatures (n_docs x m, uint64 point ids) of the bags (doc, key, weight >= 1)."""
    levels = np.ceil(np.log2(weight)).astype(np.int64) + 1
    rep = np.repeat(np.arange(len(doc)), levels)
    j = np.arange(len(rep)) - np.repeat(np.cumsum(levels) - levels, levels)
    lo = np.where(j == 0, 0, 1 << np.maximum(j - 1, 0)).astype(np.float64)
    length = np.where(j == 0, 1, 1 << np.maximum(j - 1, 0)).astype(np.float64)
    room = np.minimum(weight[rep] - lo, length)
    d, seed = doc[rep], mix(key[rep] + j.astype(np.uint64) * _GOLD)
    x = np.zeros(len(rep))
    best = np.full(n_docs * m, np.inf)
    who = np.zeros(n_docs * m, np.uint64)
    step = 0
    while len(d):
        step += 1
        r = mix(seed + np.uint64(step * int(_GOLD) & (1 << 64) - 1))
        x = x - np.log1p(-((r >> U(11)).astype(np.float64) * 2.0 ** -53)) / length
        s = mix(r ^ _GOLD)
        slot = d * m + (s % U(m)).astype(np.int64)
        place = ((s >> U(32)).astype(np.float64) * 2.0 ** -32) * length
        ok = (place < room) & (x < best[slot])
        at, v, i = slot[ok], x[ok], r[ok]
        np.minimum.at(best, at, v)
        won = best[at] == v
        who[at[won]] = i[won]
        live, back = np.unique(d, return_inverse=True)
        worst = best.reshape(n_docs, m)[live].max(axis=1)
        keep = x < worst[back]
        d, seed, x, length, room = d[keep], seed[keep], x[keep], length[keep], room[keep]
    return who.reshape(n_docs, m)


def shingle_bags(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, shingle hash, multiplicity) of a batch, by document."""
    at, one = w.windows(h, k)
    doc = w.doc[at]
    few = np.flatnonzero((w.count > 0) & (w.count < k))
    if len(few):
        more = np.array([window_hash(h[w.first[i]: w.first[i + 1]], int(w.count[i]))[0] for i in few], np.uint64)
        doc, one = np.concatenate((doc, few)), np.concatenate((one, more))
    order = np.lexsort((one, doc))
    doc, one = doc[order], one[order]
    if not len(doc):
        return doc, one, doc
    head = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (one[1:] != one[:-1])))
    return doc[head], one[head], np.diff(np.append(head, len(doc)))


def _features(k: int, bands: int, rows: int):
    """Rows ``(id, copy, weight, bands, bag)``: word-sequence hash, number of shingles,
    band keys, packed bag (32-bit shingle ids ascending, then multiplicities)."""

    def run(batches):
        for part, texts in common.text_slices(batches):
            w = Words(texts)
            h = w.hashes()
            n = len(texts)
            doc, key, times = shingle_bags(w, h, k)
            sig = bag_min_hash(doc, key, times, n, bands * rows)
            band = np.zeros((n, bands), np.uint64)
            for i in range(rows):
                band = mix(band * _GOLD + sig[:, i::rows] + U(1))
            band = mix(band + np.arange(bands, dtype=np.uint64) * _GOLD).view(np.int64)
            first = np.append(np.searchsorted(doc, np.arange(n)), len(doc))
            whole = [f"{a:016x}{b:016x}" for a, b in zip(w.text_hashes(h).tolist(), w.text_hashes(h, True).tolist())]
            ids = (key >> U(32)).astype(np.uint32)
            bag = [_pack_bag(ids[a:b], times[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            total = np.where(w.count > 0, np.maximum(w.count - k + 1, 1), 0)
            none = w.count == 0
            yield pa.RecordBatch.from_pydict({
                "id": part.column(0), "copy": pa.array(whole, pa.string(), mask=none), "weight": pa.array(total, pa.int64()),
                "bands": pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(band.ravel())),
                "bag": pa.array(bag, pa.binary(), mask=none)})

    return run


def _pack_bag(ids: np.ndarray, times: np.ndarray) -> bytes:
    """Length, differences of the ascending ids, multiplicities over 1 by place."""
    d = np.diff(ids, prepend=np.uint32(0))
    over = np.flatnonzero(times > 1)
    body = [np.array([len(ids), len(over)], np.uint32).tobytes(), d.view(np.uint8).reshape(-1, 4).T.tobytes(),
            over.astype(np.uint32).tobytes(), times[over].astype(np.uint32).tobytes()]
    return b"".join(body)


def _open_bag(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, over = np.frombuffer(b, np.uint32, 2)
    d = np.ascontiguousarray(np.frombuffer(b, np.uint8, 4 * n, 8).reshape(4, n).T).view(np.uint32).ravel()
    times = np.ones(n, np.int64)
    rest = np.frombuffer(b, np.uint32, 2 * over, 8 + 4 * int(n))
    times[rest[:over]] = rest[over:]
    return np.cumsum(d, dtype=np.uint32), times


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two bags of (ascending ids, multiplicities)."""
    (ia, ta), (ib, tb) = a, b
    i = np.searchsorted(ib, ia)
    i[i == len(ib)] = 0
    same = ib[i] == ia
    low = np.minimum(ta[same], tb[i[same]]).sum()
    return float(low) / float(ta.sum() + tb.sum() - low)


def _verify(batches):
    """Rows ``(a, b, bag_a, bag_b)`` to ``(a, b, sim)``; the last opened bag is kept."""
    last, bag = None, None
    for batch in batches:
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        sim = []
        for x, raw_x, raw_y in zip(b, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if x != last:
                last, bag = x, _open_bag(raw_y)
            sim.append(overlap(_open_bag(raw_x), bag))
        yield pa.RecordBatch.from_pydict({"a": batch.column(0), "b": batch.column(1), "sim": pa.array(sim, pa.float64())})


def _similar(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """Similarity of the pairs ``(a, b)``."""
    left = bags.select(F.col("id").alias("a"), F.col("bag").alias("bag_a"))
    right = bags.select(F.col("id").alias("b"), F.col("bag").alias("bag_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "bag_a", "bag_b")
    return both.mapInArrow(_verify, "a long, b long, sim double")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, class_id)``: every row with its class, the least id of its
    connected component.

    A document without a word (null, empty or blank text) is a class of its own; a row
    with a null id has a null class and takes no part; rows that share an id are one
    document (that with the least hash of its words gives the shingles, each row is returned).  Shingle
    ids are 64-bit in signatures and 32-bit in the overlap check.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    with common.scratch(docs.sparkSession) as keep:
        copies, label = _classes(src, k, threshold, bands, rows)
        copies, label = keep(copies), keep(common.save(label, "bag-classes"))
    named = copies.join(label, copies["rep"] == label["id"], "left").select(
        copies["id"].alias("doc_id"), F.coalesce("component", "rep").alias("class_id"))
    lost = src.where("id IS NULL").select(F.col("id").alias("doc_id"), F.lit(None).cast("long").alias("class_id"))
    return named.union(lost)


def _classes(src: DataFrame, k: int, threshold: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """``(id, rep)`` for every row with an id, and ``(id, component)`` of linked representatives."""
    every = common.save(src.where("id IS NOT NULL").mapInArrow(
        _features(k, bands, rows), "id long, copy string, weight long, bands array<long>, bag binary"), "bag-features")
    # Rows that share an id are the document with the least hash of the words.
    shared = common.save(every.groupBy("id").agg(F.min("copy").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
                         .select(F.col("id").alias("s_id"), "first"), "bag-shared")
    every = every.join(shared, F.col("id") == F.col("s_id"), "left")
    feats = every.where("s_id IS NULL OR copy = first").drop("s_id", "first")
    chosen = every.select("id", F.when(F.col("s_id").isNull(), F.col("copy")).otherwise(F.col("first")).alias("copy"))
    rep = common.save(feats.where("copy IS NOT NULL").groupBy("copy").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "bag-reps")
    copies = common.save(chosen.join(rep, "copy", "left").select("id", F.coalesce("rep", "id").alias("rep")), "bag-copies")
    keys = feats.join(copies.where("id = rep").select(F.col("id").alias("k")).distinct(), F.col("id") == F.col("k"), "left_semi") \
        .where("copy IS NOT NULL").select("id", "weight", F.explode("bands").alias("key"))
    keys = keys.dropDuplicates(["id", "key"])
    pivots = common.save(keys.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("top"))
                         .where("pivot < top").select("key", "pivot"), "bag-pivots")
    members = common.save(keys.join(pivots, "key").select("key", "id", "weight", "pivot"), "bag-members")
    pairs = members.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    used = members.select(F.col("id").alias("k")).distinct()
    bags = common.save(feats.join(used, F.col("id") == F.col("k"), "left_semi").select("id", "bag").dropDuplicates(["id"]), "bag-bags")
    stars = common.save(_similar(pairs, bags), "bag-stars")
    links = stars.where(F.col("sim") >= threshold).select("a", "b")
    label = components(links)
    rest = _rest(members, bags, label, threshold)
    if rest.limit(1).count():
        more = common.save(_similar(rest, bags).where(F.col("sim") >= threshold).select("a", "b"), "bag-more")
        label = components(links.union(more))
    return copies, label


def _units(batches):
    """Rows ``(id, family, bag)`` to a row per unit of the bag: (shingle, i-th occurrence)."""
    for batch in batches:
        ids, fam, bags = (c.to_pylist() for c in batch.columns)
        for i, f, raw in zip(ids, fam, bags):
            key, times = _open_bag(raw)
            rep = np.repeat(np.arange(len(key)), times)
            nth = np.arange(len(rep)) - np.repeat(np.cumsum(times) - times, times)
            unit = mix(key[rep].astype(np.uint64) * _GOLD + nth.astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_pydict({"id": np.full(len(unit), i), "family": np.full(len(unit), f), "unit": unit})


def _rest(members: DataFrame, bags: DataFrame, label: DataFrame, threshold: float) -> DataFrame:
    """Pairs in different classes of one family that can still be links.

    A family is a set of documents chained by buckets that hold several classes.  Its core
    is the units that most of its documents hold; a unit of one document alone is shared
    with none.  With n units, k of the core and s other shared ones, two documents
    overlap in at most min(k, k') + min(s, s'), and a link needs t / (1 + t) * (n + n').
    Either min(k, k') is enough, or both share one of their rarest s - r + 1 other units,
    r = max(1, t * n - k) (prefix filter).  One document of a pair lies outside the
    family's largest class, so the copies of a large class are never paired.
    """
    comp = label.select(F.col("id").alias("i"), "component")
    m = members.join(comp, members["id"] == comp["i"], "left").select("key", "id", "weight", "pivot", F.coalesce("component", "id").alias("class"))
    mixed = m.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi AND n > 2").select(F.col("key").alias("k"))
    m = common.save(m.join(mixed, F.col("key") == F.col("k"), "left_semi").select("id", "weight", "pivot", "class").distinct(), "bag-mixed")
    family = components(m.select(F.col("id").alias("a"), F.col("pivot").alias("b"))).withColumnRenamed("id", "i")
    docs = common.save(m.select("id", "weight", "class").distinct().join(family, F.col("id") == F.col("i")).select("id", "weight", "class", F.col("component").alias("family")), "bag-pool")
    size = docs.groupBy("family", "class").agg(F.count(F.lit(1)).alias("c")).groupBy("family").agg(F.sum("c").alias("size"), F.max_by("class", "c").alias("main"))
    size = common.save(size, "bag-families").withColumnRenamed("family", "f")
    units = common.save(docs.select("id", "family").join(bags.withColumnRenamed("id", "i"), F.col("id") == F.col("i")).select("id", "family", "bag")
                        .mapInArrow(_units, "id long, family long, unit long"), "bag-units")
    df = common.save(units.groupBy("family", "unit").agg(F.count(F.lit(1)).alias("df")).where("df > 1").join(size, F.col("family") == F.col("f"))
                     .select(F.col("family").alias("f"), F.col("unit").alias("u"), "df", (F.col("df") * 2 > F.col("size")).alias("core")), "bag-df")
    held = common.save(units.join(df, (F.col("family") == F.col("f")) & (F.col("unit") == F.col("u"))).select("id", "family", "unit", "df", "core"), "bag-held")
    count = held.groupBy(F.col("id").alias("i")).agg(F.sum(F.col("core").cast("long")).alias("core_n"), F.sum((~F.col("core")).cast("long")).alias("other_n"))
    docs = docs.join(count, docs["id"] == count["i"], "left").join(size, F.col("family") == F.col("f")).select(
        "id", "weight", "class", "family", F.coalesce("core_n", F.lit(0)).alias("k"), F.coalesce("other_n", F.lit(0)).alias("s"), (F.col("class") != F.col("main")).alias("outside"))
    docs = common.save(docs, "bag-bounds")
    share = threshold / (1 + threshold)

    def bound(extra: bool):
        most = F.least("x.k", "y.k") + (F.least("x.s", "y.s") if extra else F.lit(0))
        return (F.col("x.class") != F.col("y.class")) & (F.col("x.id") != F.col("y.id")) & (most >= (F.col("x.weight") + F.col("y.weight")) * share - 1e-9)

    fit = docs.where(F.col("k") >= F.col("weight") * threshold - 1e-9)
    by_core = fit.where("outside").alias("x").join(fit.alias("y"), (F.col("x.family") == F.col("y.family")) & bound(False))
    rank = Window.partitionBy("id").orderBy("df", "unit")  # the units of one document
    need = F.greatest(F.lit(1), F.ceil(F.col("weight") * threshold - F.col("k") - 1e-9))
    rare = held.where("NOT core").select("id", "unit", F.row_number().over(rank).alias("r")).join(docs.withColumnRenamed("id", "i"), F.col("id") == F.col("i")) \
        .where(F.col("r") <= F.col("s") - need + 1).select("id", "unit", "weight", "class", "family", "k", "s", "outside")
    rare = common.save(rare, "bag-rare")
    by_rare = rare.where("outside").alias("x").join(rare.alias("y"), (F.col("x.family") == F.col("y.family")) & (F.col("x.unit") == F.col("y.unit")) & bound(True))
    pairs = by_core.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).union(by_rare.select("x.id", "y.id"))
    return common.save(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "bag-rest")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: each document with its class id."""
    return near_duplicates(common.table(spark, sf_dir, "documents"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Pipeline stage: the least id of each class stays (rows with a null id stay, and all rows
    that share the least id: they are one document)."""
    found = near_duplicates(docs, id_col, text_col, **options)
    gone = found.where("class_id < doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")


#: Exact classes over all pairs that share a shingle, for DuckDB.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0),
c AS (SELECT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s, count(*) AS t FROM x GROUP BY ALL),
n AS (SELECT doc_id, sum(t) AS n FROM c GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.t, b.t)) AS lo FROM c a JOIN c b USING (s) WHERE a.doc_id > b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE lo >= 0.8 * (x.n + y.n - lo)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, u.b FROM r JOIN u ON r.root = u.a)
SELECT id AS doc_id, min(root) AS class_id FROM r GROUP BY id
"""
