"""Language id (5), decontamination (6), PII (9), quality (10), token output (1)."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferrule.llm import common, decontamination as dc, langid, pii, quality, tokens

from .helpers import clashing, docs, odd_rows, text, words


# --- language id -------------------------------------------------------------------------

def plain_profile(s):
    c = Counter()
    for w in "".join(ch if ch.isalpha() else " " for ch in s.lower()).split():
        p = "\0" + w + "\0"
        c.update(w)
        c.update(p[i: i + 2] for i in range(len(p) - 1))
        c.update(p[i: i + 3] for i in range(len(p) - 2))
    return c


def name(g):
    return "".join(chr((g >> (18 * i)) & ((1 << 18) - 1)) for i in range((g >> 54) - 1, -1, -1))


def test_gram_counts():
    texts = ["Éa b-c, xyz! 12", "", "日本語 text", "....", "İstanbul ß", text(300, 3)]
    d, g, t = langid.gram_counts([x.encode() for x in texts])
    for i, x in enumerate(texts):
        assert {name(int(a)): int(b) for k, a, b in zip(d, g, t) if k == i} == dict(plain_profile(x))


def test_out_of_place_distance(spark):
    train = {"a": "aba abab bab", "b": "xyx yxyx xyyx", "c": "aab bba aabb"}
    rows = [(i, t, k) for i, (k, t) in enumerate(train.items())]
    found = langid.profiles(docs(spark, rows).select("text", "lang"), 20)
    order = lambda c: sorted(c, key=lambda g: (-c[g], len(g), g))[:20]
    prof = {k: {g: i for i, g in enumerate(order(plain_profile(t)))} for k, t in train.items()}
    assert {k: {name(g): r for g, r in v.items()} for k, v in found.items()} == prof
    tests = ["abab aab", "xy", "bba", "qq"]
    got = {r.doc_id: r for r in langid.identify(docs(spark, list(enumerate(tests))), found, k=20).collect()}
    for i, t in enumerate(tests):
        own = order(plain_profile(t))
        dist = {k: sum(abs(r - p[g]) if g in p else 20 for r, g in enumerate(own)) for k, p in prof.items()}
        best = min(dist, key=lambda k: (dist[k], k))
        assert (got[i].lang_pred, got[i].score) == (best, pytest.approx(1 - dist[best] / (20 * len(own))))


def test_held_out_accuracy(spark, sf_dir):
    from ferrule.llm.catalog import QUERIES
    got = QUERIES["op5_langid"](spark, sf_dir).join(common.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    r = got.where("held_out AND lang_pred <> 'und'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.count("*").alias("n")).first()
    assert r.n > 150 and r.a > 0.97


def test_langid_odd_rows(spark):
    d = docs(spark, odd_rows())
    found = langid.profiles(d.select("text", "lang"))
    got = langid.identify(clashing(d), found).collect()
    und = sorted((r.doc_id for r in got if r.lang_pred == "und"))
    assert len(got) == len(odd_rows()) and und == [1, 2, 3, 7] and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in langid.identify(d, {}).collect()} == {"und"}
    assert langid.identify(docs(spark, []), found).count() == 0 and langid.profiles(docs(spark, []).select("text", "lang")) == {}


# --- decontamination ---------------------------------------------------------------------

QUESTION = "If John Smith buys 12 apples at 3 dollars each and then Mary takes 12 apples away from him, how many apples are left over for John Smith to sell?"
CASES = {
    "copy": (QUESTION, True), "lower": (QUESTION.lower().replace("john", "John").replace("smith", "Smith").replace("mary", "Mary"), True),
    "other": ("If Peter Jones buys 40 apples at 9 dollars each and then Susan takes 40 apples away from him, how many apples are left over for Peter Jones to sell?", True),
    "inconsistent": ("If Peter Jones buys 40 apples at 9 dollars each and then Susan takes 41 apples away from him, how many apples are left over for Anna Jones to sell?", False),
    "part": ("and then Mary takes 12 apples away from him, how many apples are left over for", True),
    "short": ("apples are left over for him", False), "clean": (text(300, 4), False)}


def test_templates(spark):
    rows = [(i, text(30, i) + ".\n" + t + " " + text(30, 50 + i)) for i, (t, _) in enumerate(CASES.values())]
    items = spark.createDataFrame([(7, QUESTION), (8, text(40, 99)), (9, None), (None, QUESTION), (10, "")], "item_id long, text string")
    got = {r.doc_id: r for r in dc.contamination(docs(spark, rows), items).collect()}
    assert {k: got[i].contaminated for i, k in enumerate(CASES)} == {k: v for k, (_, v) in CASES.items()}
    assert got[0].exact and not got[2].exact and list(got[2].items) == [7] and got[2].coverage == pytest.approx(1.0)
    several = {r.doc_id: r.contaminated for r in dc.contamination(docs(spark, rows), items, block_words=10).collect()}
    assert several == {i: r.contaminated for i, r in got.items()}
    kept = {r.doc_id for r in dc.drop_contaminated(docs(spark, rows), items).collect()}
    assert kept == {i for i, r in got.items() if not r.contaminated}


def test_verbatim_runs_are_judged_on_their_own(spark):
    edited = QUESTION.replace("takes 12", "takes 13")
    long = QUESTION + " " + " ".join(words(60, 5))
    far = "If Peter Jones buys 40 apples at 9 dollars each and"
    rows = [(0, edited), (1, "and then Mary takes 12 apples away from him, how " + text(20, 6) + ". " + far), (2, CASES["inconsistent"][0])]
    got = {r.doc_id: r for r in dc.contamination(docs(spark, rows), spark.createDataFrame([(1, long)], "item_id long, text string")).collect()}
    assert [got[i].contaminated for i in range(3)] == [True, True, False] and got[0].exact and got[1].exact
    assert dc.contamination(docs(spark, rows[:1]), spark.createDataFrame([(1, QUESTION)], "item_id long, text string")).first().exact


def test_items_without_literal_words_and_short_items(spark):
    items = ["Compute 12 + 7 * 3 - 4", "Anna Berg, Carl Diaz, Emma Falk, Gina Holt, Ivan Jung", "Name the capital of France"]
    rows = [(0, "so compute 12 + 7 * 3 - 4 now"), (1, "so compute 12 - 7 + 3 * 4 now"), (2, "so compute 12 + 7 * 3 - 5 now"), (3, "at last " + items[1] + " came"),
            (4, "at last Anna Berg, Carl Diaz, Emma Falk"), (5, "He had to Name the capital\nof France then"), (6, "name the capital of\nFrance")]
    got = {r.doc_id: list(r.items) for r in dc.contamination(docs(spark, rows), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    assert got == {0: [0], 1: [], 2: [], 3: [1], 4: [], 5: [2], 6: [2]}


def test_every_planted_passage_is_found(spark, sf_dir):
    """Against plain substring search over whole texts."""
    d, b = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    items = [r.text for r in b.collect()]
    want = {r.doc_id for r in d.collect() if any(t in (r.text or "") for t in items)}
    got = {r.doc_id for r in dc.contamination(d, b).where("contaminated").collect()}
    assert want and got == want


def test_decontamination_odd_rows(spark):
    d = docs(spark, odd_rows())
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contamination(d, none).where("contaminated").count() == 0
    some = spark.createDataFrame([(1, text(40, 3))], "item_id long, text string")
    got = dc.contamination(clashing(d), some).collect()
    assert len(got) == len(odd_rows()) and [r.doc_id for r in got if r.contaminated] == [4, 4]
    assert dc.drop_contaminated(clashing(d), some).columns == clashing(d).columns
    assert dc.contamination(docs(spark, []), some).count() == 0


# --- PII -----------------------------------------------------------------------------------

BASE = [("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")), ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
        ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")), ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))]


def plain(t):
    out = []
    for kind, p in BASE:
        for m in p.finditer(t):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_equal_the_patterns():
    r = np.random.default_rng(5)
    alphabet = list("ab1234567890.@+- ()%_é\n") + ["4111 1111 1111 1111", "a@b.c", "1.2.3.4", "+1 (202) 555-0199"]
    for _ in range(3000):
        t = "".join(r.choice(alphabet, r.integers(1, 60)))
        assert pii.base_spans(t) == plain(t), t
    assert pii.base_spans("1" * 200_000 + "a" * 200_000 + "+" * 1000) == []


def test_base_spans_of_documents(spark, sf_dir):
    got = {r.id: [(s.start, s.end, s.kind) for s in r.found if s.base] for r in pii.find_pii(common.table(spark, sf_dir, "documents")).collect()}
    want = {r.doc_id: plain(r.text or "") for r in common.table(spark, sf_dir, "documents").collect()}
    assert got == want and any(want.values())


def test_pii_digest(spark, sf_dir):
    import hashlib

    from ferrule.llm.catalog import QUERIES
    got = {r.doc_id: r for r in QUERIES["op9_pii"](spark, sf_dir).collect()}
    for r in common.table(spark, sf_dir, "documents").collect():
        base, x = plain(r.text or ""), got[r.doc_id]
        line = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
        assert x.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(k == kind for *_, k in base) for kind in pii.KINDS]
        assert set(line.split(",")) <= set(x.spans.split(",")) or not line


@pytest.mark.parametrize("t, part, kind", [
    ("mail john dot doe (at) example [dot] com now", "john dot doe (at) example [dot] com", "email"), ("write to bob at gmail dot com", "bob at gmail dot com", "email"),
    ("ｊohn＠exаmple.com", "ｊohn＠exаmple.com", "email"), ("so jo​hn@example.com", "jo​hn@example.com", "email"),
    ("call plus one two zero two five five five oh one nine nine ok", "plus one two zero two five five five oh one nine nine", "phone"),
    ("card four double one one 1111 one one one one one one one one ok", "four double one one 1111 one one one one one one one one", "card"),
    ("ip one nine two dot one six eight dot one dot one", "one nine two dot one six eight dot one dot one", "ip"), ("é host 192․168․1․1 up", "192․168․1․1", "ip"),
    ("٤١١١ ١١١١ ١١١١ ١١١١", "٤١١١ ١١١١ ١١١١ ١١١١", "card")])
def test_disguises_map_back_to_the_source(t, part, kind):
    base = pii.base_spans(t)
    added = [(t[a:b], k) for a, b, k in pii.added_spans(t, base)]
    assert (part, kind) in added


_LONG = " dot ".join(f"part{i}" for i in range(30))


@pytest.mark.parametrize("t, part, kind", [
    ("๔๑๑๑ ๑๑๑๑ ๑๑๑๑ ๑๑๑๑", "๔๑๑๑ ๑๑๑๑ ๑๑๑๑ ๑๑๑๑", "card"), ("call +১ ২০২ ৫৫৫ ০১৯৯ ok", "+১ ২০২ ৫৫৫ ০১৯৯", "phone"), ("ip 𝟏𝟗𝟐.𝟏𝟔𝟖.𝟏.𝟏 up", "𝟏𝟗𝟐.𝟏𝟔𝟖.𝟏.𝟏", "ip"),
    ("write bob at host.com soon", "bob at host.com", "email"), ("card 4111 1111 1111 111 one ok", "4111 1111 1111 111 one", "card"),
    (f"mail {_LONG} at host dot com now", f"{_LONG} at host dot com", "email"), (f"mail bob [at] {_LONG} dot com now", f"bob [at] {_LONG} dot com", "email"),
    ("x at john dot doe at gmail dot com", "john dot doe at gmail dot com", "email")])
def test_prefilters_let_every_disguise_through(t, part, kind):
    assert (part, kind) in [(t[a:b], k) for a, b, k in pii.added_spans(t, pii.base_spans(t))]


def test_site_names_and_long_runs():
    for t in ("look at example.com today", "see us at www.example.com", "meet at noon.later on", "a dot b at c dot d"):
        assert pii.added_spans(t, pii.base_spans(t)) == []
    assert pii.added_spans("a dot " * 100_000 + "a at b", []) == []  # linear


def test_plain_text_adds_nothing():
    for t in ("look at the dot on one page", "meet at noon dot or not", "one two three go", text(500, 1), "a@b.co 1.2.3.4 +1 202 555 0199"):
        assert pii.added_spans(t, pii.base_spans(t)) == []


def test_pii_odd_rows(spark):
    got = pii.find_pii(clashing(docs(spark, odd_rows()))).collect()
    assert len(got) == len(odd_rows()) and not any(r.found for r in got)
    assert pii.find_pii(docs(spark, [])).count() == 0


# --- quality -------------------------------------------------------------------------------

def test_features_of_odd_texts():
    x = quality.features([b"", b"  \n", b"AB cd! 12", ("a b " * 5000).encode(), "é".encode()])
    assert np.isfinite(x).all() and list(x[0]) == [1] + [0] * (len(quality.FEATURES) - 1)


def test_sites_shrink(spark):
    """A sparse site stays near the global rate, a large one follows its own rows."""
    good, bad = [text(60, i) for i in range(300)], [" ".join(w.upper() + "!!" for w in words(60, i)) for i in range(300)]
    rows = [(i, good[i], "en", "big") for i in range(250)] + [(1000 + i, bad[i], "en", "worse") for i in range(250)] + [(2000, good[251], "en", "tiny"), (2001, None, None, None), (2002, "", "en", "tiny")]
    d = docs(spark, rows)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)] + [(1000 + i, 0, 0) for i in range(100)] + [(None, 1, 0), (5, None, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(d, labels)
    got = {r.doc_id: r for r in quality.classify(d, model).collect()}
    assert len(got) == len(rows) and all(got[i].keep for i in range(250)) and not any(got[1000 + i].keep for i in range(250)) and got[2000].keep
    assert got[1].site_rate > 0.9 and got[1001].site_rate < 0.1 and abs(got[2000].site_rate - model.rate) < 0.35
    n, total = 250, sum(got[i].evidence for i in range(250))
    host = {r.host: r.host_rate for r in model.sites.collect()}["big"]
    assert got[1].site_rate == pytest.approx(min((total - got[1].evidence + model.path_strength * host) / (n - 1 + model.path_strength), 1 - 1e-4), abs=1e-9)
    kept = {r.doc_id for r in quality.keep_good(clashing(d), labels).collect()}
    assert kept == {i for i, r in got.items() if r.keep}


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    d = docs(spark, odd_rows())
    assert quality.classify(d, quality.train(d, none)).count() == len(odd_rows())
    e = docs(spark, [])
    assert quality.classify(e, quality.train(e, none)).count() == 0


def test_held_out_quality(spark, sf_dir):
    d, lb = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    model = quality.train(d, lb.where("doc_id % 4 <> 1"))
    r = quality.classify(d, model).withColumnRenamed("quality", "p").join(lb.where("doc_id % 4 = 1"), "doc_id")
    r = r.agg(F.avg((F.col("keep") == (F.col("quality") == 1)).cast("double")).alias("a"), F.count("*").alias("n")).first()
    assert r.n > 50 and r.a > 0.97


# --- token output ----------------------------------------------------------------------------

def test_feistel_is_a_keyed_permutation():
    for n in (1, 2, 3, 17, 1000, 65537):
        p = tokens.feistel(np.arange(n), n, 5)
        assert sorted(p.tolist()) == list(range(n))
    assert (tokens.feistel(np.arange(1000), 1000, 5) != tokens.feistel(np.arange(1000), 1000, 6)).sum() > 900
    p = tokens.feistel(np.arange(100_000), 100_000, 1)
    assert abs(np.corrcoef(p, np.arange(100_000))[0, 1]) < 0.02


def test_round_trip_and_layout(spark, tmp_path):
    rows = odd_rows() + [(10 + i, text(300 + 40 * i, i)) for i in range(12)]
    d = docs(spark, rows)
    out = tokens.training_order(clashing(d), seq_len=128, shard_rows=50, slice_bytes=20_000)
    got = out.collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    assert {r.slot: (r.doc_id, r.seq, bytes(r.tokens)) for r in tokens.training_order(d.repartition(5), seq_len=128, shard_rows=50).collect()} == {r.slot: (r.doc_id, r.seq, bytes(r.tokens)) for r in got}
    enc, by = tokens.encoder(tokens.VOCABULARY), {}
    for r in got:
        assert len(r.tokens) == 256 and r.shard == r.slot // 50 and r.byte_offset == r.slot % 50 * 256
        by.setdefault(r.doc_id, {}).setdefault(r.seq, []).append(np.frombuffer(r.tokens, np.uint16)[: r.n_tokens])
    for i, t, *_ in rows:
        if t:
            ids = np.concatenate([by[i][s][0] for s in sorted(by[i])])
            assert enc.decode(ids[:-1].tolist()) == t and ids[-1] == tokens.END
    assert {len(v) for v in by[4].values()} == {2} and not {1, 2} & set(by)
    uri = f"file://{tmp_path}/shards"
    made = sorted(tokens.write_shards(out, uri).collect())
    assert [(r.first_slot, r.records) for r in made] == [(r.shard * 50, min(50, len(got) - r.shard * 50)) for r in made]
    names = sorted(p.name for p in (tmp_path / "shards").iterdir())
    assert names == [f"shard-{i:08d}.bin" for i in range(len(made))]
    raw = b"".join((tmp_path / "shards" / n).read_bytes() for n in names)
    assert raw == b"".join(bytes(r.tokens) for r in sorted(got, key=lambda r: r.slot))
    assert sorted(tokens.write_shards(out, uri).collect()) == made  # a resumed run


def test_query_writes_the_shards(spark, sf_dir):
    """Every record of the registered query lies in a shard file, where its row says."""
    from pathlib import Path

    from ferrule.llm.catalog import QUERIES
    got = QUERIES["op1_training_order"](spark, sf_dir).collect()
    want = {r.slot: bytes(r.tokens) for r in tokens.training_order(common.table(spark, sf_dir, "documents")).collect()}
    files = {f: Path(f.removeprefix("file://")).read_bytes() for f in {r.file for r in got}}
    assert {r.slot: files[r.file][r.byte_offset: r.byte_offset + 2 * tokens.SEQ_LEN] for r in got} == want
    assert sum(map(len, files.values())) == 2 * tokens.SEQ_LEN * len(want) and "tokens" not in got[0]


def test_rerun_with_another_key_replaces_full_shards(spark, tmp_path):
    d, uri = docs(spark, [(i, text(400, i)) for i in range(6)]), f"file://{tmp_path}/shards"
    for key in (1, 2):
        got = tokens.training_shards(d, uri, seq_len=64, shard_rows=20, key=key).collect()
        want = b"".join(bytes(r.tokens) for r in sorted(tokens.training_order(d, seq_len=64, shard_rows=20, key=key).collect(), key=lambda r: r.slot))
        assert b"".join(p.read_bytes() for p in sorted((tmp_path / "shards").iterdir())) == want and len(got) > 40
    before = {p.name: p.stat().st_ino for p in (tmp_path / "shards").iterdir()}
    tokens.training_shards(d, uri, seq_len=64, shard_rows=20, key=2).collect()
    assert {p.name: p.stat().st_ino for p in (tmp_path / "shards").iterdir()} == before  # same content: left alone


def test_tokens_empty(spark):
    assert tokens.training_order(docs(spark, [])).count() == 0
    assert tokens.training_order(docs(spark, [(1, None), (2, "")])).count() == 0


def test_slots_are_the_permuted_plain_numbering(spark):
    """Every slot is the Feistel image of the sequence's place in the order of the ids (null first)."""
    rows = [(i * 7 % 101, text(i * 13 % 90, i)) for i in range(101)] + [(None, text(40, 500)), (200, None), (201, "")]
    out = tokens.training_order(docs(spark, rows).repartition(4), seq_len=16, shard_rows=9, key=3, slice_bytes=300).collect()
    enc, place, want = tokens.encoder(tokens.VOCABULARY), 0, {}
    total = sum(-(-(len(enc.encode_ordinary(t)) + 1) // 16) for _, t in rows if t)
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        if t:
            for seq in range(-(-(len(enc.encode_ordinary(t)) + 1) // 16)):
                want[i, seq] = int(tokens.feistel(np.array([place]), total, 3)[0])
                place += 1
    assert {(r.doc_id, r.seq): r.slot for r in out} == want and len(out) == total == place
    assert all(r.shard == r.slot // 9 and r.byte_offset == r.slot % 9 * 32 for r in out)


def test_decontamination_by_blocks(spark):
    """Any number of blocks gives the same rows: repeated and null ids stay rows of their own, items that share an id count once."""
    from ferrule.llm import decontamination
    qs = [text(30, 900 + i) for i in range(6)]
    items = spark.createDataFrame([(1, qs[0]), (2, qs[1]), (2, qs[2]), (3, qs[3]), (4, qs[4])], "item_id long, text string")
    rows = [(1, "intro " + qs[0]), (1, text(40, 1)), (None, qs[3] + " and " + qs[1]), (None, text(40, 2)), (2, qs[1] + " then " + qs[2]), (3, None), (4, qs[5])]
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    one = key(decontamination.contamination(docs(spark, rows), items))
    many = key(decontamination.contamination(docs(spark, rows), items, block_words=40))
    clean = [(i, text(20, i)) for i in range(10, 40)]  # slices with and without a hit in one task
    assert len(key(decontamination.contamination(docs(spark, clean + rows + clean).coalesce(1), items, block_words=40))) == len(rows) + 60
    assert one == many and [(r[0], r[2]) for r in one if r[5]] == [(1, [1]), (2, [2]), (None, [2, 3])] and len(one) == len(rows)
