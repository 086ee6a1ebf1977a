"""Operator 13: ranked lexical search by pipelined term partitioning.

The terms of all items are dealt to ``owners`` (by a hash of the term).  Documents are
read once, in shards of at most ``shard_docs`` documents; a shard's postings go out as one
packed row per term.  Items travel in bundles of ``bundle`` items, one bundle per shard,
through the owners one after another: at each stage the bundle meets, by ``cogroup``, the
postings of that owner's terms, adds their integer contributions to its sparse document
accumulators and moves on; the last owner hands over the best ``k`` of every item in the
shard, and a ranked window merges the shards.

Scores (all integers but the logarithm): with N documents that hold a term, L terms in
all, n terms of the document, df and tf as usual,

    w = floor(1000 * ln((2N + 2) / (2df + 1)))
    m = 10 + (90 n N) div L
    score = sum over the item's distinct terms of w * (10^9 tf div (1000 tf + 8 m))

Memory is bounded by one bundle times one shard (``bundle * shard_docs`` accumulators)
and by ``shard_postings``.  Nothing is cut: a frequent term is a packed row per shard, spread
over all of them.  The only thing sent to all tasks is a bitmap of ``2^BITS`` term hashes
(fixed size), which spares postings that no item asks for; its false hits meet no item.
Terms are compared by a 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .words import U, Words, mix

K, OWNERS, BUNDLE = 10, 4, 256
SHARD_DOCS, SHARD_POSTINGS = 16384, 1 << 21
BITS = 22
_BITMAP_BITS = 32768  # of one row of Spark's bitmap aggregate

#: Term bytes stay (A-Z lower-cased), all others part terms.
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of every term of the texts, in order."""
    w = Words([t.translate(_FOLD) for t in texts])
    return w.doc, w.hashes()


def _owner(h: np.ndarray, owners: int) -> np.ndarray:
    return (mix(h) % U(owners)).astype(np.int32)


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> U(64 - BITS)).astype(np.int64)


def _item_terms(bundle: int, owners: int):
    """Items (row, text) to their distinct terms: (term, owner, bundle, item)."""
    def run(batches):
        for part, texts in common.text_slices(batches):
            doc, h = term_hashes(texts)
            pair = np.unique(np.rec.fromarrays([doc, h], names="d,h"))
            row = part.column(0).to_numpy()[pair["d"]]
            yield pa.RecordBatch.from_pydict({
                "term": pa.array(pair["h"].view(np.int64)), "slot": pa.array(_slot(pair["h"])), "owner": pa.array(_owner(pair["h"], owners)),
                "bundle": pa.array(row // bundle), "item": pa.array((row % bundle).astype(np.int32))})

    return run


_INDEX = "shard long, term long, owner int, df long, total long, docs binary, tfs binary, sizes binary, ids binary, known binary"


def _index(bitmap: bytes, owners: int, shard_docs: int, shard_postings: int):
    """Documents (id, text) to shards: a row per term (local document numbers in the order of
    the ids, occurrences, terms of the document) and a row without term (the ids)."""
    wanted = np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little").astype(bool)

    def flush(number, held):
        ids, known, size = (np.concatenate([x[i] for x in held]) for i in range(3))
        base = np.cumsum([0, *[len(x[0]) for x in held]])
        doc = np.concatenate([x[3] + b for x, b in zip(held, base)])
        h, tf = (np.concatenate([x[i] for x in held]) for i in (4, 5))
        order = np.lexsort((np.arange(len(ids)), ids, ~known))  # null ids last
        local = np.empty(len(ids), np.int64)
        local[order] = np.arange(len(ids))
        doc = local[doc]
        by = np.lexsort((doc, h))
        h, doc, tf = h[by], doc[by], tf[by]
        n = size[order][doc]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(h))
        cut = [(int(a), int(b)) for a, b in zip(first, last)]
        doc, tf, n = doc.astype(np.uint16 if shard_docs <= 1 << 16 else np.uint32), tf.astype(np.uint32), n.astype(np.uint32)
        terms = h[first]
        none = [None] * len(cut)
        shard = (TaskContext.get().partitionId() << 32) + number
        cols = [[shard] * (len(cut) + 1), [*terms.view(np.int64).tolist(), None], [*_owner(terms, owners).tolist(), None], [*(last - first).tolist(), int((size > 0).sum())],
                [*[0] * len(cut), int(size.sum())], [*[doc[a:b].tobytes() for a, b in cut], None], [*[tf[a:b].tobytes() for a, b in cut], None],
                [*[n[a:b].tobytes() for a, b in cut], None], [*none, ids[order].astype(np.int64).tobytes()], [*none, known[order].tobytes()]]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
        names = [c.split()[0] for c in _INDEX.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    def run(batches):
        held, docs, postings, number = [], 0, 0, 0
        for part, texts in common.text_slices(batches):
            for at in range(0, len(texts), shard_docs):
                own = texts[at: at + shard_docs]
                doc, h = term_hashes(own)
                size = np.bincount(doc, minlength=len(own)).astype(np.int64)
                ask = wanted[_slot(h)]
                doc, h = doc[ask], h[ask]
                by = np.lexsort((h, doc))
                doc, h = doc[by], h[by]
                head = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
                tf = np.diff(np.append(head, len(h)))
                if held and (docs + len(own) > shard_docs or postings + len(head) > shard_postings):
                    yield flush(number, held)
                    held, docs, postings, number = [], 0, 0, number + 1
                col = part.column(0).slice(at, len(own))
                held.append((col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), col.is_valid().to_numpy(zero_copy_only=False), size, doc[head], h[head], tf))
                docs, postings = docs + len(own), postings + len(head)
        if held:
            yield flush(number, held)

    return run


def _contributions(n_docs: int, n_terms: int):
    """Posting rows with their items: each posting's share of the weight (below 10^6)."""
    def run(batches):
        for b in batches:
            col = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            out = []
            for tfs, sizes in zip(col["tfs"].to_pylist(), col["sizes"].to_pylist()):
                tf, n = (np.frombuffer(x, np.uint32).astype(np.int64) for x in (tfs, sizes))
                m = 10 + (90 * n * n_docs) // max(1, n_terms)
                out.append(((1_000_000_000 * tf) // (1000 * tf + 8 * m)).astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([col["shard"], col["bundle"], col["items"], col["w"], col["docs"], pa.array(out, pa.binary())],
                                             names=["shard", "bundle", "items", "w", "docs", "shares"])

    return run


_ACC = "shard long, bundle long, place binary, sums binary"


def _stage(bundle: int, shard_docs: int):
    """One owner's stage for one bundle and shard: accumulators in, accumulators out."""
    wide = np.uint16 if shard_docs <= 1 << 16 else np.uint32

    def run(acc: pa.Table, found: pa.Table) -> pa.Table:
        z, uz = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        key = acc if acc.num_rows else found
        total = np.zeros((bundle, shard_docs), np.int64)
        flat = total.reshape(-1)
        for place, sums in zip(acc["place"].to_pylist(), acc["sums"].to_pylist()):
            at = np.cumsum(np.frombuffer(uz.decompress(place), np.uint32).astype(np.int64))
            flat[at] = np.frombuffer(uz.decompress(sums), np.int64)
        for items, w, docs, shares in zip(*[found[c].to_pylist() for c in ("items", "w", "docs", "shares")]):
            doc, c = np.frombuffer(docs, wide), np.frombuffer(shares, np.uint32).astype(np.int64) * w
            for i in items:
                total[i, doc] += c
        at = np.flatnonzero(flat)
        step = np.diff(at, prepend=0).astype(np.uint32)
        return pa.table({"shard": key["shard"].slice(0, 1).cast(pa.int64()), "bundle": key["bundle"].slice(0, 1).cast(pa.int64()),
                         "place": pa.array([z.compress(step.tobytes())], pa.binary()), "sums": pa.array([z.compress(flat[at].tobytes())], pa.binary())})

    return run


def _best(bundle: int, shard_docs: int, k: int):
    """Finished accumulators to the ``k`` best documents of each item (by score, then by
    local number, which follows the id)."""
    def run(batches):
        uz = zstandard.ZstdDecompressor()
        for b in batches:
            for shard, group, place, sums in zip(*[c.to_pylist() for c in b.columns]):
                at = np.cumsum(np.frombuffer(uz.decompress(place), np.uint32).astype(np.int64))
                s = np.frombuffer(uz.decompress(sums), np.int64)
                item, doc = at // shard_docs, at % shard_docs
                by = np.lexsort((doc, -s, item))
                item, doc, s = item[by], doc[by], s[by]
                rank = np.arange(len(item)) - np.searchsorted(item, item)
                top = rank < k
                yield pa.RecordBatch.from_pydict({"shard": pa.array(np.full(top.sum(), shard), pa.int64()), "row": pa.array(item[top] + group * bundle, pa.int64()),
                                                  "local": pa.array(doc[top].astype(np.int32)), "score": pa.array(s[top], pa.int64())})

    return run


def _ids(batches):
    for b in batches:
        for shard, ids, known in zip(*[c.to_pylist() for c in b.columns]):
            i, k = np.frombuffer(ids, np.int64), np.frombuffer(known, bool)
            yield pa.RecordBatch.from_pydict({"d_shard": pa.array(np.full(len(i), shard), pa.int64()), "d_local": pa.array(np.arange(len(i), dtype=np.int32)),
                                              "doc_id": pa.array(i, mask=~k)})


def _bitmap(terms: DataFrame) -> bytes:
    """Bit per hash slot that some item term has: 2^BITS bits, whatever the items."""
    place = F.col("slot") + 1  # Spark's buckets and positions count from 1
    rows = terms.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out, size = bytearray((1 << BITS) // 8), _BITMAP_BITS // 8
    for r in rows:
        out[(r["b"] - 1) * size: r["b"] * size] = r["bits"]
    return bytes(out)


def ranked_search(items: DataFrame, docs: DataFrame, k: int = K, item_id: str = "item_id", item_text: str = "text", doc_id: str = "doc_id", doc_text: str = "text",
                  owners: int = OWNERS, bundle: int = BUNDLE, shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents with a score above 0.

    Every row of ``items`` is an item and every row of ``docs`` a document, whether or not their
    ids repeat or are null; among equal scores the smaller id comes first, null ids last.  A
    null or empty text has no term: such an item finds nothing, such a document is never
    found and counts neither in N nor in L.  Other columns are ignored; without items or
    documents the result is empty.
    """
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).withColumn("row", F.monotonically_increasing_id())
    asked = _dense(common.save(asked, "search-items"))
    terms = common.save(asked.select("row", "text").mapInArrow(_item_terms(bundle, owners), "term long, slot long, owner int, bundle long, item int"), "search-terms")
    bitmap = _bitmap(terms.select("slot"))
    index = common.save(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(doc_text).alias("text"))
                        .mapInArrow(_index(bitmap, owners, shard_docs, shard_postings), _INDEX), "search-index")
    stat = index.where("term IS NULL").agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n"), F.coalesce(F.sum("total"), F.lit(0)).alias("l")).first()
    n_docs, n_terms = int(stat["n"]), int(stat["l"])
    # A term's weight, and its items by bundle (at most ``bundle`` of them in a row).
    df = index.where("term IS NOT NULL").groupBy(F.col("term").alias("t")).agg(F.sum("df").alias("df"))
    w = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n_docs) + 2) / (F.col("df") * 2 + 1).cast("double")))
    asks = terms.groupBy("term", "bundle").agg(F.collect_list("item").alias("items"))
    asks = common.save(asks.join(df, F.col("term") == F.col("t")).select("t", "bundle", "items", w.cast("long").alias("w")), "search-weights")
    acc = None
    for owner in range(owners):
        own = index.where((F.col("owner") == owner) & F.col("term").isNotNull()).join(asks, F.col("term") == F.col("t"))
        found = own.select("shard", "bundle", "items", "docs", "tfs", "sizes", "w") \
            .mapInArrow(_contributions(n_docs, n_terms), "shard long, bundle long, items array<int>, w long, docs binary, shares binary")
        acc = docs.sparkSession.createDataFrame([], _ACC) if acc is None else acc
        acc = acc.groupBy("shard", "bundle").cogroup(found.groupBy("shard", "bundle")).applyInArrow(_stage(bundle, shard_docs), _ACC)
    best = acc.mapInArrow(_best(bundle, shard_docs, k), "shard long, row long, local int, score long")
    ids = index.where("term IS NULL").select("shard", "ids", "known").mapInArrow(_ids, "d_shard long, d_local int, doc_id long")
    # The shards' best lists first (a row number below k per item), then the merge by id.
    by_score = Window.partitionBy("row").orderBy(F.desc("score"))
    best = common.save(best.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= k).drop("place"), "search-best")
    named = best.join(ids, (F.col("shard") == F.col("d_shard")) & (F.col("local") == F.col("d_local")))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = asked.select(F.col("row").alias("i_row"), "item_id")
    return ranked.join(names, F.col("row") == F.col("i_row")).select("item_id", "rank", "doc_id", "score")


def _dense(items: DataFrame) -> DataFrame:
    """Row numbers without gaps: offsets of the partitions (a row each) instead of their
    high bits, so that bundles are full."""
    part = F.shiftright("row", 33)
    sizes = items.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("s"))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = sizes.select("p", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("o"))
    return common.save(items.join(sizes, part == F.col("p")).withColumn("row", F.col("row").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("o")).drop("p", "o"), "search-rows")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``benchmark`` item against all ``documents``."""
    return ranked_search(common.table(spark, sf_dir, "benchmark"), common.table(spark, sf_dir, "documents"))


_CUT = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_CUT} AS ts FROM documents),
q AS (SELECT DISTINCT i, item_id, t FROM (SELECT i, item_id, unnest(ts) AS t FROM (SELECT row_number() OVER () AS i, item_id, {_CUT} AS ts FROM benchmark))),
s AS (SELECT count(*)::BIGINT AS nn, sum(len(ts))::BIGINT AS ll FROM d WHERE len(ts) > 0),
p AS (SELECT r, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(ts)::BIGINT AS n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY t, nn),
c AS (SELECT p.r, p.doc_id, p.t, w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))) AS c FROM p JOIN w USING (t), s),
x AS (SELECT q.i, q.item_id, c.r, c.doc_id, sum(c.c)::BIGINT AS score FROM q JOIN c USING (t) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
