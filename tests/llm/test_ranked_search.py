"""Operator 13 against a plain scorer; the query itself has SQL."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from ferrule.llm import ranked_search as rs

from .helpers import docs, odd_rows, text, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return TERM.findall((t or "").translate(FOLD))


def plain(items, rows, k=10):
    own = [Counter(terms(t)) for _, t in rows]
    size = [sum(c.values()) for c in own]
    n_docs, n_terms = sum(s > 0 for s in size), sum(size)
    df = Counter(t for c in own for t in c)
    out = []
    for item, text_ in items:
        found = []
        for (doc, _), c, n in zip(rows, own, size):
            s = 0
            for t in set(terms(text_)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 90 + (90 * n * n_docs) // n_terms
                    s += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                found.append((-s, doc is None, doc or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def fixture():
    r = random.Random(5)
    pool = words(60, 3) + ["Étude", "ßtraße", "x1", "naïve", "a-b", "Q"]
    rows = [(i, " ".join(r.choices(pool, k=r.randint(1, 80)))) for i in range(150)]
    rows += [(7, rows[3][1]), (None, rows[4][1]), (None, "alone term"), *[(i, t) for i, t, *_ in odd_rows()]]
    rows += [(1000 + i, "twin twin lines") for i in range(30)]  # equal scores
    items = [(i, " ".join(r.choices(pool, k=r.randint(1, 12)))) for i in range(20)]
    return items + [(3, "twin"), (None, "alone étude ÉTUDE"), (50, ""), (51, None), (52, "!?"), (53, "nowhere-to-be-found")], rows


def test_small_shards_and_bundles(spark):
    items, rows = fixture()
    table = docs(spark, rows).select("*", *[F.lit(1).alias(c) for c in ("id", "shard", "term", "score", "rank")]).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("row", F.lit(1))
    want = plain(items, rows)
    for owners, bundle, shard_docs, shard_postings in ((4, 256, 16384, 1 << 21), (3, 5, 7, 100), (1, 4, 64, 20)):
        assert got(rs.ranked_search(asked, table, owners=owners, bundle=bundle, shard_docs=shard_docs, shard_postings=shard_postings)) == want


def test_long_text_and_empty_tables(spark):
    items = [(1, "one two"), (2, text(5, 1))]
    rows = [(1, "one " * 50_000 + "two"), (2, text(2000, 1))]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(rs.ranked_search(asked, docs(spark, rows))) == plain(items, rows)
    assert rs.ranked_search(asked.limit(0), docs(spark, rows)).collect() == []
    assert rs.ranked_search(asked, docs(spark, [])).collect() == []
    assert rs.ranked_search(asked, docs(spark, [(1, None), (2, "!")])).collect() == []
