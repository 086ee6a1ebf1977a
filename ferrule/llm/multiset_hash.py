"""Operator 12: document fingerprints by a homomorphic multiset hash (DataFrame functions only).

A text is the multiset of its paragraphs (lines that aren't blank).  Each paragraph is
hashed to a wide vector, and a text's vector is the sum of its paragraphs' vectors, lane
by lane modulo 2^32:

* ``EQUAL`` lanes add up 32-bit halves of ``EQUAL / 2`` hashes of the whole paragraph: two
  texts with the same paragraphs in any order agree, others don't;
* ``LIKE`` lanes add up +1 or -1 for each run of three words of the paragraph (shorter at
  its end), by a bit of the run's hash: the inner product of two texts' lanes estimates
  that of their counts of runs, so the cosine tells how alike the texts are (standard
  error about ``LIKE ** -0.5``).

Sums commute, so paragraphs go in with ``plus`` and out with ``minus`` without the rest of
the text.  The hashes are xxhash64: they tell texts apart, they don't withstand someone who
looks for collisions.

Bits are counted sixteen bits a lane, four lanes in a long, over blocks of at most 64
paragraphs times 256 words, so no lane runs over; then the blocks' vectors are added.
A text of any length is read by one generator row by row and summed as it goes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import number_rows
from . import common

EQUAL, LIKE = 8, 128
WIDTH = EQUAL + LIKE
_SEEDS = range(EQUAL // 2)
MODULUS = 1 << 32
_PARAGRAPHS, _RUNS = 64, 256  # of a block; their product stays below 2^15
_ONES, _LOW, _QUARTER = 0x0001000100010001, MODULUS - 1, 0xFFFF
_WORD = r"[^\x20\x09-\x0D]"


def _and(c: Column, mask: int) -> Column:
    return c.bitwiseAND(F.lit(mask).cast("long"))


def vectors(rows: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """``keys`` and ``vector`` (array of ``WIDTH`` lanes, 0 to 2^32 - 1): the sum over the
    paragraphs of all rows that share the keys.  Keys whose texts are null or blank get the
    zero vector.  Null keys are keys."""
    keys = list(keys)
    x = rows.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # The empty paragraph in front keeps keys without any other; it adds nothing.
    x = x.select(*keys, F.posexplode(F.split(F.concat(F.lit("\n"), F.col("_text")), "\n")).alias("_p", "_par"))
    x = x.where((F.col("_p") == 0) | F.col("_par").rlike(_WORD))
    x = x.select(*keys, "_p", F.split("_par", " ").alias("_words"), *[F.xxhash64(F.lit(s), F.col("_par")).alias(f"_e{s}") for s in _SEEDS])
    x = x.select("*", F.posexplode("_words").alias("_i", "_word"))
    x = x.withColumn("_h0", F.xxhash64("_word", F.get("_words", F.col("_i") + 1), F.get("_words", F.col("_i") + 2))).withColumn("_h1", F.xxhash64("_h0"))
    return _sums(x, keys)


def _sums(x: DataFrame, keys: list[str]) -> DataFrame:
    """Runs (``_p``, ``_i``, ``_h0``, ``_h1``, ``_e0``...) to vectors by ``keys``, less the empty paragraph of each."""
    # As SQL text: built column by column, these few hundred sums would keep the driver busy for seconds.
    packed = [F.expr(f"sum(shiftrightunsigned(_h{w}, {j}) & {_ONES}L) AS p{w}_{j}") for w in range(2) for j in range(16)]
    halves = [F.expr(f"sum(IF(_i = 0, shiftrightunsigned(_e{i // 2}, {32 * (i % 2)}) & {_LOW}L, 0L)) AS e{i}") for i in range(EQUAL)]
    x = x.groupBy(*keys, F.expr(f"_p div {_PARAGRAPHS} AS _b1"), F.expr(f"_i div {_RUNS} AS _b2")).agg(F.expr("count(1) AS n"), *packed, *halves)
    # The empty paragraph in the first block, one run and its hashes, comes off again.
    x = x.select("*", F.expr("IF(_b1 = 0 AND _b2 = 0, 1L, 0L) AS _none"))
    equal = [f"e{i} - _none * (shiftrightunsigned(xxhash64({i // 2}, ''), {32 * (i % 2)}) & {_LOW}L)" for i in range(EQUAL)]
    runs = ["xxhash64('')", "xxhash64(xxhash64(''))"]
    like = [f"2 * ((shiftrightunsigned(p{w}_{b % 16}, {b // 16 * 16}) & {_QUARTER}L) - _none * (shiftrightunsigned({runs[w]}, {b}) & 1L)) - (n - _none)"
            for w in range(2) for b in range(64)]
    x = x.select(*keys, F.expr("array(" + ", ".join(f"({c}) & {_LOW}L" for c in equal + like) + ") AS _vector"))
    # A row per block: one, but for long texts.
    x = x.groupBy(*keys).agg(F.collect_list("_vector").alias("_blocks"))
    rest = F.slice("_blocks", F.lit(2), F.size("_blocks"))
    return x.select(*keys, F.aggregate(rest, F.get("_blocks", F.lit(0)), plus).alias("vector"))


def plus(a: Column, b: Column) -> Column:
    """Vector of the paragraphs of both (insertion)."""
    return F.zip_with(a, b, lambda x, y: _and(x + y, _LOW))


def minus(a: Column, b: Column) -> Column:
    """Vector without the paragraphs of ``b`` (deletion)."""
    return F.zip_with(a, b, lambda x, y: _and(x - y, _LOW))


def narrow(vector: Column) -> Column:
    """Lanes as signed 32-bit numbers (those of 2^31 and more less 2^32)."""
    half = F.lit(MODULUS // 2)
    return F.transform(vector, lambda x: F.when(x >= half, x - F.lit(MODULUS)).otherwise(x).cast("int"))


def widened(vector: Column) -> Column:
    """Lanes from 0 to 2^32 - 1 again."""
    return F.transform(vector, lambda x: _and(x.cast("long"), _LOW))


def fingerprint(vector: Column) -> Column:
    """A vector as text: base64 of its lanes, 32 bits each, most significant byte first."""
    return F.translate(F.base64(F.unhex(F.array_join(F.transform(vector, lambda x: F.lpad(F.hex(x), 8, "0")), ""))), "\r\n", "")


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the ``LIKE`` lanes, 0 to 1: 1 for equal vectors; 0 where one is without words."""
    def signed(v: Column) -> Column:
        half = F.lit(MODULUS // 2)
        return F.transform(F.slice(v, EQUAL + 1, LIKE), lambda x: F.when(x >= half, x - F.lit(MODULUS)).otherwise(x).cast("double"))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    x, y = signed(a), signed(b)
    norms = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when(a == b, F.lit(1.0)).when(norms > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(x, y) / norms))).otherwise(F.lit(0.0))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text: the last floor(n/2) code points give way to as many first ones (or all)
    of the next document, in descending order of the id, null ids last, among equal ids by
    a hash of the text; after the last document comes the first.  Returns ``(doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_doc_id)`` for
    every row; of equal rows (id and text) all but the last are followed by their like.
    Only the paragraphs from the cut on are hashed anew: the edited vector is the text's
    minus the removed plus the inserted paragraphs.  A null text is empty; an empty text has
    the zero vector; other columns are ignored; an empty table gives an empty result.

    Rows travel by a 128-bit hash of id and text, equal rows once: the texts to their own
    key, their first halves from there to the row that they follow.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    ident = F.col(id_col).cast("long")
    x = docs.select(ident.alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text").alias("h1"), F.xxhash64(F.lit(1), F.col("doc_id").isNull(), "doc_id", "text").alias("h2"))
    # Order: keys only.
    light = x.groupBy("h1", "h2", "doc_id").agg(F.count(F.lit(1)).alias("copies"), F.max(F.char_length("text")).alias("n"))
    placed = common.save(number_rows(light, [], ["doc_id", "h1", "h2"], "pos", total="total"), "multiset-order")
    follows = F.when(F.col("pos") == 0, F.col("total") - 1).otherwise(F.col("pos") - 1)
    own = placed.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("n").alias("a_n"), "copies", follows.alias("next"))
    pairs = own.join(placed.select("pos", "h1", "h2"), F.col("next") == F.col("pos")) \
        .select("a1", "a2", "a_n", F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.lit(1).cast("long").alias("times"), F.lit(False).alias("like"))
    again = placed.where("copies > 1").select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("n").alias("a_n"), F.col("h1").alias("g1"), F.col("h2").alias("g2"),
                                              (F.col("copies") - 1).alias("times"), F.lit(True).alias("like"))
    asks = common.save(pairs.unionByName(again), "multiset-pairs")
    # Texts: each once, by its own key; the halves that others need go on from there.
    whole = x.groupBy("h1", "h2").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    given = whole.select(F.col("h1").alias("w1"), F.col("h2").alias("w2"), F.col("doc_id").alias("next_doc_id"), F.col("text").alias("w_text")) \
        .join(asks, (F.col("w1") == F.col("g1")) & (F.col("w2") == F.col("g2"))) \
        .select("a1", "a2", "g1", "g2", "times", "like", "next_doc_id", F.expr("left(w_text, int(a_n div 2))").alias("prefix"))
    rows = whole.join(given, (F.col("h1") == F.col("a1")) & (F.col("h2") == F.col("a2")))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("head", F.expr("left(text, int(n_chars - n_chars div 2))"))
    rows = rows.withColumn("open", F.char_length(F.substring_index("head", "\n", -1)))  # of the paragraph that is cut
    at = F.char_length("head") - F.col("open")
    meta = ["h1", "h2", "like", "g1", "g2", "times", "doc_id", "next_doc_id", "n_chars", "edited_sha256"]
    parts = F.array(F.struct(F.lit("kept").alias("kind"), F.expr("left(head, int(char_length(head) - open))").alias("t")),
                    F.struct(F.lit("removed").alias("kind"), F.substring("text", at + 1, F.char_length("text")).alias("t")),
                    F.struct(F.lit("inserted").alias("kind"), F.concat(F.expr("right(head, open)"), F.col("prefix")).alias("t")))
    rows = rows.withColumn("edited_sha256", F.sha2(F.concat("head", "prefix"), 256)).select(*meta, F.explode(parts).alias("part")) \
        .select(*meta, "part.kind", "part.t")
    by_kind = vectors(rows, [*meta, "kind"], "t")
    one = by_kind.groupBy(*meta).agg(*[F.first(F.when(F.col("kind") == k, F.col("vector")), ignorenulls=True).alias(k) for k in ("kept", "removed", "inserted")])
    one = one.withColumn("vector", plus(F.col("kept"), F.col("removed")))
    one = one.select(*meta, "vector", plus(minus(F.col("vector"), F.col("removed")), F.col("inserted")).alias("edited"))
    # Lanes as signed 32-bit numbers: half the bytes on disk and in the shuffle.
    one = common.save(one.withColumns({c: narrow(F.col(c)) for c in ("vector", "edited")}), "multiset-vectors")
    nexts = one.where("not like").select(F.col("h1").alias("n1"), F.col("h2").alias("n2"), F.col("vector").alias("next_vector"))
    out = one.join(nexts, (F.col("g1") == F.col("n1")) & (F.col("g2") == F.col("n2"))).withColumns({c: widened(F.col(c)) for c in ("vector", "edited", "next_vector")})
    out = out.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("vector")).alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"),
                     likeness(F.col("vector"), F.col("edited")).alias("near_edited"), likeness(F.col("vector"), F.col("next_vector")).alias("near_next"), "next_doc_id", "times")
    # Equal rows again, ten thousand in an array at most.
    cols = [c for c in out.columns if c != "times"]
    out = out.select(*cols, "times", F.explode(F.expr("sequence(0L, (times - 1) div 10000)")).alias("t"))
    return out.select(*cols, F.explode(F.expr("sequence(1L, least(10000L, times - t * 10000))")).alias("copy")).drop("copy")


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` and their edited texts."""
    return edited_fingerprints(common.table(spark, sf_dir, "documents"))
