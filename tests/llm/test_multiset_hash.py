"""Operator 12 against the same sums in plain Python."""

import base64
import hashlib
import struct
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from ferrule.llm import common
from ferrule.llm import multiset_hash as mh

from .helpers import docs, odd_rows, text


def xx(*parts):
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p if isinstance(p, bytes) else p.encode(), h)
    return h


def vector(t):
    equal, like = [0] * mh.EQUAL, [0] * mh.LIKE
    for p in (t or "").split("\n"):
        if not p.strip(" \t\n\x0b\x0c\r"):
            continue
        for s in range(mh.EQUAL // 2):
            h = xx(struct.pack("<i", s), p)
            equal[2 * s] += h & 0xFFFFFFFF
            equal[2 * s + 1] += h >> 32
        w = p.split(" ")
        for run, n in Counter(tuple(w[i: i + 3]) for i in range(len(w))).items():
            h = xx(*run)
            for k, v in enumerate((h, xx(struct.pack("<Q", h)))):
                for b in range(64):
                    like[64 * k + b] += n if v >> b & 1 else -n
    return [x % 2 ** 32 for x in equal + like]


def printed(v):
    return base64.b64encode(b"".join(struct.pack(">I", x) for x in v)).decode()


def cosine(a, b):
    if a == b:
        return 1.0
    a, b = ([x - 2 ** 32 if x >= 2 ** 31 else x for x in v[mh.EQUAL:]] for v in (a, b))
    norm = (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
    return min(1.0, max(0.0, sum(x * y for x, y in zip(a, b)) / norm)) if norm else 0.0


def plain(rows):
    """Distinct (id, text) in descending order, copies side by side."""
    def tie(i, t):
        flag = b"\x01\x00\x00\x00" if i is None else b"\x00\x00\x00\x00"
        h = xx(flag, *([] if i is None else [struct.pack("<q", i)]), t)
        return h - 2 ** 64 if h >= 2 ** 63 else h
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, tie(*r)), reverse=True)
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        n = len(t)
        edited = t[: n - n // 2] + nxt[: n // 2]
        a, b = vector(t), vector(edited)
        out.append((i, n, hashlib.sha256(edited.encode()).hexdigest(), printed(a), printed(b), round(cosine(a, b), 9), round(cosine(a, vector(nxt)), 9)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()), key=repr)


def test_query(spark, sf_dir):
    """Every document of the smallest table."""
    small = sf_dir.replace("sf0.01", "sf0.001")
    rows = [(r.doc_id, r.text) for r in common.table(spark, small, "documents").collect()]
    assert got(mh.op12_fingerprints(spark, small)) == plain(rows)


def test_odd_rows(spark):
    rows = [(i, t) for i, t, *_ in odd_rows()]
    rows += [(10, "a b\n\n c\nd"), (11, "d\na b\n c"), (12, "ü" * 7 + "\nß x"), (12, "same id"), (None, None), (None, "x y z\n" * 5), (13, "w " * 40_000), (14, "x y\n" * 300)]
    rows += [(20, "copy\nof one"), (20, "copy\nof one"), (20, "copy\nof one"), (21, "copy\nof one")]
    table = docs(spark, rows).select("*", *[F.lit(1).alias(c) for c in ("h1", "n", "copies", "next", "like", "kind", "t", "vector", "prefix")])
    out = mh.edited_fingerprints(table)
    assert got(out) == plain(rows)
    prints = {(r.doc_id, r.n_chars): r.fingerprint for r in out.collect()}
    assert prints[10, 9] == prints[11, 8]  # the same paragraphs in another order
    assert prints[20, 11] == prints[21, 11]


def test_one_and_none(spark):
    assert mh.edited_fingerprints(docs(spark, [])).collect() == []
    assert got(mh.edited_fingerprints(docs(spark, [(1, "abc\ndef ghi")]))) == plain([(1, "abc\ndef ghi")])


def test_insert_and_delete(spark):
    """A vector with a paragraph put in and another taken out is that of the new text."""
    old, new = text(50, 1) + "\n" + text(20, 2) + "\n" + text(30, 3), text(30, 3) + "\n" + text(50, 1) + "\n" + text(9, 4)
    v = {"old": old, "new": new, "out": text(20, 2), "in": text(9, 4)}
    vs = mh.vectors(spark.createDataFrame(list(v.items()), "k string, text string"), ["k"])
    row = vs.groupBy().pivot("k", list(v)).agg(F.first("vector"))
    row = row.select(mh.plus(mh.minus(F.col("old"), F.col("out")), F.col("in")).alias("made"), "new", F.col("old")).first()
    assert row.made == row.new == vector(new) and row.old == vector(old)


def test_narrow_lanes_come_back(spark):
    lanes = [0, 1, (1 << 31) - 1, 1 << 31, (1 << 32) - 1]
    df = spark.createDataFrame([(lanes,)], "v array<long>").select(mh.narrow(F.col("v")).alias("n"))
    assert df.dtypes == [("n", "array<int>")]
    assert df.select(mh.widened(F.col("n"))).first()[0] == lanes
