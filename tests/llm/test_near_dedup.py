"""BagMinHash near-dedup: estimates, classes against brute force, odd rows."""

import random
from collections import Counter

import numpy as np

from ferrule.llm import near_dedup as nd
from ferrule.llm.graph import components

from .helpers import clashing, docs, odd_rows, words


def bag(t, k=5):
    w = (t or "").split()
    return Counter(tuple(w[i: i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    low = sum((a & b).values())
    return low / (sum(a.values()) + sum(b.values()) - low) if low else 0.0


def brute(rows, t=0.8):
    rows = [r for r in rows if r[0] is not None]
    bags = [bag(r[1]) for r in rows]
    cls = {r[0]: r[0] for r in rows}

    def root(x):
        while cls[x] != x:
            x = cls[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(bags[i], bags[j]) >= t:
                a, b = root(rows[i][0]), root(rows[j][0])
                cls[max(a, b)] = min(a, b)
    return {r[0]: root(r[0]) for r in rows}


def family(n, edits, seed, start):
    r = random.Random(seed)
    base = words(120, seed)
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            at = r.randrange(len(w))
            w[at: at + 1] = r.choice([[], [w[at] + "x"], [w[at], f"n{r.randrange(4)}"]])
        out.append((start + i, " ".join(w)))
    r.shuffle(out)
    return out


def test_signature_estimates_weighted_jaccard():
    n, m = 4000, 64
    key = np.arange(6, dtype=np.uint64) + np.uint64(77)
    a, b = np.array([1, 5, 2, 7, 3, 0]), np.array([1, 2, 9, 7, 0, 4])
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    got = []
    for salt in range(40):
        k = nd.mix(key + np.uint64(salt * 1000))
        doc = np.repeat([0, 1], 6)
        w = np.concatenate((a, b))
        ok = w > 0
        s = nd.bag_min_hash(doc[ok], np.concatenate((k, k))[ok], w[ok], 2, m)
        got.append((s[0] == s[1]).mean())
    assert abs(np.mean(got) - want) < 4 * (want * (1 - want) / (40 * m)) ** 0.5, (np.mean(got), want, n)


def test_classes_match_all_pairs(spark):
    rows = family(60, 8, 1, 100) + family(40, 3, 2, 300) + family(25, 14, 3, 20) + [(i, " ".join(words(50, i))) for i in range(500, 540)]
    rows += [(1000 + i, rows[i][1]) for i in range(10)] + [(2000 + i, " ".join(["spam"] * (30 + i))) for i in range(12)] + [(3000, "a b"), (3001, "a  b"), (3002, "a c")]
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(docs(spark, rows)).collect()}
    assert got == brute(rows)


def test_keep_one_keeps_the_least_of_each_class(spark):
    rows = family(20, 4, 9, 10) + [(1, "alone in the world of words today")]
    kept = {r.doc_id for r in nd.keep_one(docs(spark, rows)).collect()}
    assert kept == set(brute(rows).values())


def test_odd_rows(spark):
    rows = odd_rows()
    got = sorted(((r.doc_id, r.class_id) for r in nd.near_duplicates(docs(spark, rows)).collect()), key=repr)
    assert got == sorted([(None, None), (1, 1), (2, 2), (3, 3), (4, 4), (4, 4), (5, 5), (6, 6), (7, 7)], key=repr)
    assert nd.near_duplicates(docs(spark, [])).count() == 0
    assert nd.keep_one(clashing(docs(spark, rows))).count() == len(rows)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


def test_rows_that_share_an_id(spark):
    """Whatever the order of the rows, an id is the row with the least hash of its words."""
    a, b = " ".join(words(40, 1)), " ".join(words(40, 2))
    rows = [(5, a), (7, a + " x"), (7, b), (9, b), (9, b), (11, None), (11, a)]
    seen = set()
    for seed in range(4):
        some = list(rows)
        random.Random(seed).shuffle(some)
        df = docs(spark, some).repartition(3)
        seen.add(tuple(sorted((r.doc_id, r.class_id) for r in nd.near_duplicates(df).collect())))
    assert len(seen) == 1 and len(next(iter(seen))) == len(rows)
    assert dict(next(iter(seen)))[11] == 5


def test_scratch_tables_go(spark):
    """Only what the result reads is left in the shared folder."""
    import os
    from ferrule.llm import common
    base = common.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(base))
    out = nd.near_duplicates(docs(spark, family(30, 3, 1, 0)))
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(base)) - before}
    assert left == {"bag-copies", "bag-classes"} and out.count() == 30
