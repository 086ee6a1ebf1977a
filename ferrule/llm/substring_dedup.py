"""Operator 3: substring dedup with fixed-block anchors.

A window is ``window`` consecutive words of one document.  Every word covered by a
window whose word sequence also starts in a document with a smaller id is removed.

1. **Anchors.** Documents are cut into order-preserving id chunks.  Each chunk
   hashes its non-overlapping reference blocks of ``B = (window + 1) // 2`` words
   (a window of ``2B - 1`` words holds a whole block, wherever it starts) and its
   rolling probes of ``B`` words.  Both meet by hash bucket: one sorted, packed row
   per (chunk, bucket), each distinct hash once per chunk however often it occurs.
   Back go two bit lists: probes that hit a block of an earlier chunk, blocks hit by
   a probe of a later chunk.  Repeats inside a chunk are found in the chunk itself.
2. **Extension.** Only windows around a hit, on either side, are hashed whole
   (96 bits) and meet again by bucket; those that an earlier chunk holds come back.
   Adjacent windows join to maximal exact repeats.
3. The words of the repeats go; the rest is joined by one space.

No pair of documents is ever built: a passage shared by any number of documents
costs one entry per chunk.  Work and shuffle grow with the words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .words import U, Words

WINDOW = 13
CHUNK_BYTES = 4 << 20
#: Words per hash bucket, about.
BUCKET_WORDS = 2 << 20

_PACK = "chunk long, ids binary, sizes binary, body binary"
_OUT = "doc_id long, n_words long, n_removed long, kept string, spans string"


def _z(a: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a if isinstance(a, bytes) else a.tobytes())


def _uz(b: bytes, dtype=None):
    raw = zstandard.ZstdDecompressor().decompress(b)
    return raw if dtype is None else np.frombuffer(raw, dtype)


def _planes(a: np.ndarray) -> bytes:
    """Sorted unsigned integers as differences, byte plane by byte plane."""
    d = np.diff(a, prepend=a.dtype.type(0))
    return _z(np.ascontiguousarray(d.view(np.uint8).reshape(-1, a.dtype.itemsize).T))


def _unplanes(b: bytes, dtype) -> np.ndarray:
    raw = _uz(b, np.uint8)
    size = np.dtype(dtype).itemsize
    return np.cumsum(np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel(), dtype=dtype)


def _packer(bounds, sub, lo, hi):
    def pack(batches):
        for batch in batches:
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            num = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            chunk = np.where(known, common.ordered_chunks(num, bounds, sub, lo, hi), -1)
            texts = batch.column(1)
            for c in np.unique(chunk):
                rows = np.flatnonzero(chunk == c)
                raw = [x or b"" for x in texts.take(pa.array(rows)).cast(pa.binary()).to_pylist()]
                sizes = np.fromiter(map(len, raw), np.int64, len(raw))
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([int(c)], pa.int64()), "ids": pa.array([num[rows].tobytes()], pa.binary()),
                    "sizes": pa.array([sizes.tobytes()], pa.binary()), "body": pa.array([_z(b"".join(raw))], pa.binary())})

    return pack


def _unpack(t: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Ids and texts of a chunk, by id."""
    ids, texts = [], []
    for i, s, b in zip(t["ids"].to_pylist(), t["sizes"].to_pylist(), t["body"].to_pylist()):
        ids.append(np.frombuffer(i, np.int64))
        ends = np.cumsum(np.frombuffer(s, np.int64))
        body = _uz(b)
        texts += [body[e - n: e] for e, n in zip(ends.tolist(), np.frombuffer(s, np.int64).tolist())]
    num = np.concatenate(ids)
    order = np.argsort(num, kind="stable")
    return num[order], [texts[i] for i in order]


class _Chunk:
    """Words, probes and blocks of one chunk of documents."""

    def __init__(self, t: pa.Table, block: int):
        self.ids, texts = _unpack(t)
        self.words = Words(texts)
        self.h = self.words.hashes()
        self.at, probe = self.words.windows(self.h, block)
        self.uniq, self.back, times = np.unique(probe, return_inverse=True, return_counts=True)
        self.is_block_at = (self.at - self.words.first[self.words.doc[self.at]]) % block == 0
        self.is_block = np.zeros(len(self.uniq), bool)
        self.is_block[self.back[self.is_block_at]] = True
        self.twice = self.is_block & (times > 1)

    def buckets(self, bits: int):
        """(bucket, slice of uniq) of each bucket with an entry; bucket = top bits."""
        return _buckets(self.uniq, bits)


def _buckets(sorted_u64: np.ndarray, bits: int):
    if not len(sorted_u64):
        return
    b = (sorted_u64 >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(sorted_u64), np.int64)
    cut = np.flatnonzero(np.diff(b)) + 1
    for lo, hi in zip(np.append(0, cut), np.append(cut, len(b))):
        yield int(b[lo]), slice(int(lo), int(hi))


def _rows(names: list[str], types: list, rows: list) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)


def _anchor_rows(block: int, bits: int):
    def fn(t: pa.Table) -> pa.Table:
        chunk = t["chunk"][0].as_py()
        rows = []
        if chunk >= 0:
            c = _Chunk(t, block)
            low = ((c.uniq >> U(32 - bits)) & U(0xFFFFFFFF)).astype(np.uint32)
            rows = [(b, chunk, _planes(low[s]), np.packbits(c.is_block[s]).tobytes()) for b, s in c.buckets(bits)]
        return _rows(["bucket", "chunk", "vals", "flags"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()], rows)

    return fn


def _anchor_hits(t: pa.Table) -> pa.Table:
    """Of one bucket: which probes hit a block of an earlier chunk, which blocks a later probe."""
    t = t.sort_by("chunk")
    chunks = t["chunk"].to_pylist()
    vals = [_unplanes(v, np.uint32) for v in t["vals"].to_pylist()]
    flags = [np.unpackbits(np.frombuffer(f, np.uint8), count=len(v)).astype(bool) for f, v in zip(t["flags"].to_pylist(), vals)]
    size = [len(v) for v in vals]
    at = np.repeat(np.arange(len(chunks)), size)
    val, flag = np.concatenate(vals), np.concatenate(flags)
    order = np.argsort(val, kind="stable")
    v = val[order]
    head = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
    seg = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(v))))
    c, f = at[order], flag[order]
    first = np.minimum.reduceat(np.where(f, c, len(chunks)), head)
    last = np.maximum.reduceat(c, head)
    hit, hitten = np.empty(len(v), bool), np.empty(len(v), bool)
    hit[order] = first[seg] < c
    hitten[order] = f & (last[seg] > c)
    rows, lo = [], 0
    bucket = t["bucket"][0].as_py()
    for chunk, n in zip(chunks, size):
        a, b = hit[lo: lo + n], hitten[lo: lo + n]
        lo += n
        if a.any() or b.any():
            rows.append((chunk, bucket, np.packbits(a).tobytes(), np.packbits(b).tobytes()))
    return _rows(["chunk", "bucket", "hit", "hitten"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()], rows)


def _extend(block: int, window: int, bits: int, bits2: int):
    def fn(packs: pa.Table, replies: pa.Table) -> pa.Table:
        names, types = ["bucket", "chunk", "vals", "more"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        if not packs.num_rows or packs["chunk"][0].as_py() < 0:
            return _rows(names, types, [])
        chunk = packs["chunk"][0].as_py()
        c = _Chunk(packs, block)
        hit, hitten = c.twice.copy(), c.twice.copy()
        got = {b: (q, r) for b, q, r in zip(replies["bucket"].to_pylist(), replies["hit"].to_pylist(), replies["hitten"].to_pylist())}
        for b, s in c.buckets(bits):
            if b in got:
                for to, raw in zip((hit, hitten), got[b]):
                    to[s] |= np.unpackbits(np.frombuffer(raw, np.uint8), count=s.stop - s.start).astype(bool)
        near = np.zeros(len(c.h) + 1, np.int64)
        near[c.at + 1] = hit[c.back] | (hitten[c.back] & c.is_block_at)
        near = np.cumsum(near)
        at, one = c.words.windows(c.h, window)
        cand = near[at + window - block + 1] > near[at]
        _, two = c.words.windows(c.h, window, second=True)
        one, first = np.unique(one[cand], return_index=True)
        more = (two[cand][first] >> U(32)).astype(np.uint32)
        rows = [(b, chunk, _planes(one[s]), more[s].tobytes()) for b, s in _buckets(one, bits2)]
        return _rows(names, types, rows)

    return fn


def _earlier(t: pa.Table) -> pa.Table:
    """Of one bucket: the window hashes of each chunk that an earlier chunk holds too."""
    t = t.sort_by("chunk")
    chunks = t["chunk"].to_pylist()
    vals = [_unplanes(v, np.uint64) for v in t["vals"].to_pylist()]
    val = np.concatenate(vals)
    more = np.concatenate([np.frombuffer(m, np.uint32) for m in t["more"].to_pylist()])
    size = np.array([len(v) for v in vals])
    at = np.repeat(np.arange(len(chunks)), size)
    order = np.lexsort((at, more, val))
    v, m = val[order], more[order]
    again = np.append(False, (v[1:] == v[:-1]) & (m[1:] == m[:-1]))
    found = np.zeros(len(v), bool)
    found[order] = again
    rows = []
    for i, chunk in enumerate(chunks):
        lo = int(size[:i].sum())
        s = np.flatnonzero(found[lo: lo + size[i]]) + lo
        if len(s):
            rows.append((chunk, _planes(val[s]), more[s].tobytes()))
    return _rows(["chunk", "vals", "more"], [pa.int64(), pa.binary(), pa.binary()], rows)


def _cover(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """Positions covered by the windows that start at ``first``."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, first, 1)
    np.add.at(d, first + width, -1)
    return np.cumsum(d)[:n] > 0


def _remove(window: int):
    names = ["doc_id", "n_words", "n_removed", "kept", "spans"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def fn(packs: pa.Table, replies: pa.Table) -> pa.Table:
        if not packs.num_rows:
            return _rows(names, types, [])
        chunk = packs["chunk"][0].as_py()
        ids, texts = _unpack(packs)
        w = Words(texts)
        gone = np.zeros(len(w.start), bool)
        if chunk >= 0 and len(gone) >= window:
            h = w.hashes()
            at, one = w.windows(h, window)
            _, two = w.windows(h, window, second=True)
            two = (two >> U(32)).astype(np.uint32)
            dup = np.zeros(len(at), bool)
            if len(at):
                order = np.argsort(one, kind="stable")
                v, doc = one[order], ids[w.doc[at[order]]]
                head = np.append(True, v[1:] != v[:-1])
                top = np.maximum.accumulate(np.where(head, np.arange(len(v)), 0))
                dup[order] = (doc > doc[top]) & (two[order] == two[order][top])
                if replies.num_rows:
                    val = np.concatenate([_unplanes(x, np.uint64) for x in replies["vals"].to_pylist()])
                    more = np.concatenate([np.frombuffer(x, np.uint32) for x in replies["more"].to_pylist()])
                    by = np.argsort(val, kind="stable")
                    val, more = val[by], more[by]
                    i = np.minimum(np.searchsorted(val, one), len(val) - 1)
                    dup |= (val[i] == one) & (more[i] == two)
            gone = _cover(at[dup], window, len(gone))
        n_gone = np.add.reduceat(np.append(gone, False).astype(np.int64), np.minimum(w.first[:-1], len(gone))) if len(texts) else []
        kept, spans = [], []
        for i, text in enumerate(texts):
            lo, hi = int(w.first[i]), int(w.first[i + 1])
            if lo == hi:
                kept.append("")
                spans.append("")
                continue
            own = text.split()
            g = gone[lo:hi]
            if g.any():
                edge = np.flatnonzero(np.diff(np.concatenate(([0], g.view(np.int8), [0]))))
                spans.append(",".join(f"{a}:{b}" for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist())))
                own = [own[j] for j in np.flatnonzero(~g).tolist()]
            else:
                spans.append("")
            kept.append(b" ".join(own).decode("utf-8", "replace"))
        n_gone = np.where(w.count > 0, n_gone, 0)
        doc = pa.array(ids, pa.int64(), mask=np.full(len(ids), chunk < 0))
        return pa.table([doc, pa.array(w.count, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, pa.string())], names=names)

    return fn


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   chunk_bytes: int = CHUNK_BYTES, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept, spans)``, a row per input row.

    ``kept`` is the text left (words joined by one space), ``spans`` the removed
    maximal word ranges ``start:end``.  A null or empty text has no word; a row with a
    null id is returned whole and is no reference for others; rows that share an id
    are not each other's reference; a text shorter than ``window`` words keeps all.
    Extra columns are ignored.  Memory of a task: one chunk (``chunk_bytes`` of text)
    or one bucket (``bucket_words`` hashes).
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    stat = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    n_chunks = max(1, math.ceil(stat["b"] / chunk_bytes))
    bounds = common.id_bounds(src, "id", n_chunks)
    sub = math.ceil(n_chunks / (len(bounds) + 1))
    lo, hi = float(stat["lo"] or 0), float(stat["hi"] or 0) + 1
    block = (window + 1) // 2
    words = stat["b"] / 5
    bits = min(24, max(0, math.ceil(math.log2(max(1.0, words / bucket_words)))))
    packs = src.mapInArrow(_packer(bounds, sub, lo, hi), _PACK)
    hits = common.save(
        packs.groupBy("chunk").applyInArrow(_anchor_rows(block, bits), "bucket long, chunk long, vals binary, flags binary")
        .groupBy("bucket").applyInArrow(_anchor_hits, "chunk long, bucket long, hit binary, hitten binary"), "anchor-hits")
    seen = common.save(
        packs.groupBy("chunk").cogroup(hits.groupBy("chunk"))
        .applyInArrow(_extend(block, window, bits, bits), "bucket long, chunk long, vals binary, more binary")
        .groupBy("bucket").applyInArrow(_earlier, "chunk long, vals binary, more binary"), "anchor-seen")
    return packs.groupBy("chunk").cogroup(seen.groupBy("chunk")).applyInArrow(_remove(window), _OUT)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``; kept text reported as its SHA-256."""
    out = remove_repeats(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


#: The contract over all windows of the table, for DuckDB.
ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM d WHERE len(w) >= 13),
x AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS s FROM p),
m AS (SELECT s, min(doc_id) AS least FROM x GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT DISTINCT x.doc_id, unnest(range(x.i, x.i + 13)) AS j FROM x JOIN m USING (s) WHERE x.doc_id > m.least),
l AS (SELECT doc_id, list(j) AS gone FROM g GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w) AS n, coalesce(len(gone), 0) AS r,
      CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda v, i: NOT list_contains(gone, i)) END AS kept
      FROM d LEFT JOIN l USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, r::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
