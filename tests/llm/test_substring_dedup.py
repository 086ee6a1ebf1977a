"""Substring dedup against a plain window set."""

import hashlib
import re

from ferrule.llm import substring_dedup as sd

from .helpers import clashing, docs, odd_rows, text, words

W = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=13):
    least = {}
    split = [(i, W.findall(t or "")) for i, t, *_ in rows]
    for i, w in split:
        if i is not None:
            for j in range(len(w) - window + 1):
                k = tuple(w[j: j + window])
                least[k] = min(least.get(k, i), i)
    out = []
    for i, w in split:
        gone = set()
        if i is not None:
            for j in range(len(w) - window + 1):
                if least[tuple(w[j: j + window])] < i:
                    gone |= set(range(j, j + window))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=repr)


def run(spark, rows, **o):
    got = sd.remove_repeats(docs(spark, rows), **o).select("doc_id", "n_words", "n_removed", "kept").collect()
    return sorted([tuple(r) for r in got], key=repr)


def test_repeats_across_and_inside_chunks(spark):
    p, q = words(40, 11), words(13, 12)
    rows = [(i * 3, " ".join(words(60, i) + (p if i % 2 else q) + words(i, 90 + i) + p[i % 20:] + words(5, 70 + i))) for i in range(30)]
    rows += [(1, " ".join(p)), (200, " ".join(p[:12])), (201, " ".join(q)), (202, " ".join(["same"] * 50)), (203, " ".join(["same"] * 20))]
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, chunk_bytes=2000, bucket_words=200) == want


def test_small_windows(spark):
    rows = [(i, " ".join("ab"[(i * j) % 2] for j in range(9 + i))) for i in range(12)]
    for window in (3, 4, 5):
        assert run(spark, rows, window=window, chunk_bytes=60, bucket_words=20) == brute(rows, window)


def test_odd_rows(spark):
    rows = odd_rows()
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    got = sd.remove_repeats(clashing(docs(spark, rows))).count()
    assert got == len(rows)


def test_spans_name_the_removed_words(spark):
    p = text(20, 5)
    got = {r.doc_id: r for r in sd.remove_repeats(docs(spark, [(1, p), (2, "x y " + p + " z")])).collect()}
    assert (got[2].spans, got[2].kept, got[1].spans) == ("2:22", "x y z", "")


def test_digest(spark):
    out = sd.remove_repeats(docs(spark, [(1, "a  b\tc")])).first()
    assert out.kept == "a b c" and hashlib.sha256(out.kept.encode()).hexdigest()
