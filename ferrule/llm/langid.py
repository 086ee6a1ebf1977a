"""Operator 5: language identification by rank-order n-gram profiles.

A profile is the ranked list of the ``K`` most frequent letter n-grams (n = 1..3, words
padded with a boundary).  Language profiles come from the counts of all training
texts; a document's own profile is compared to each by the out-of-place distance:
the sum of rank differences, ``K`` for an n-gram that the language's profile lacks.
The least distance wins, ties go to the smaller name.  The score is one minus that
distance over its largest possible value.

Counting is vectorised over batches: letters get dense numbers, an n-gram of a
document is one integer, and a sort per batch counts them.  Training counts are
added up in Spark; only the profiles (``K`` rows per language) reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

K, N_MAX = 300, 3
#: Languages that a profile table may hold: K rows each are broadcast.
MAX_LANGS = 1000
_BITS = 18  # every letter lies below U+40000
_SLICE = 1 << 20
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(1 << _BITS)), bool, 1 << _BITS))
    return _LETTER[0]


def gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, gram, count) of all n-grams, by document and gram.  A gram is its length and
    its letters as 18-bit code points; 0 stands for the boundary of a word."""
    chars = [b"\x00\x00\x00\x00" + t.decode("utf-8", "replace").lower().encode("utf-32-le", "replace") + b"\x00\x00\x00\x00" for t in texts]
    size = np.fromiter((len(c) // 4 for c in chars), np.int64, len(chars))
    cp = np.frombuffer(b"".join(chars) + b"\x00\x00\x00\x00", np.uint32)
    letter = _letters()
    ok = letter[np.minimum(cp, (1 << _BITS) - 1)] & (cp < 1 << _BITS)
    doc = np.append(np.repeat(np.arange(len(texts)), size), len(texts))
    keep = ok | np.append(True, ok[:-1])  # letters and one boundary after each word
    keep[0] = True
    keep |= np.append(True, doc[1:] != doc[:-1])
    c, d = np.where(ok, cp, 0)[keep], doc[keep]
    # Dense letter numbers in code point order, 0 for the boundary.
    seen = np.zeros(1 << _BITS, bool)
    seen[c] = True
    seen[0] = True
    alphabet = np.flatnonzero(seen)
    dense = np.zeros(1 << _BITS, np.int64)
    dense[alphabet] = np.arange(len(alphabet))
    a, n = dense[c], len(alphabet)
    one = np.flatnonzero(a > 0)
    two = np.flatnonzero((a[:-1] > 0) | ((a[1:] > 0) & (d[:-1] == d[1:])))
    two = two[d[two] == d[np.minimum(two + 1, len(d) - 1)]] if len(two) else two
    three = np.flatnonzero(a[1:-1] > 0) if len(a) > 2 else np.zeros(0, np.int64)
    space = n + n * n + n * n * n
    codes = [d[one] * space + a[one],
             d[two] * space + n + a[two] * n + a[two + 1],
             d[three + 1] * space + n + n * n + (a[three] * n + a[three + 1]) * n + a[three + 2]]
    code = np.concatenate(codes)
    if not len(code):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if space * (len(texts) + 1) < 1 << 32:
        code = code.astype(np.uint32)
    code.sort()
    head = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    times = np.diff(np.append(head, len(code)))
    code = code[head].astype(np.int64)
    which, code = code // space, code % space
    size = 1 + (code >= n).astype(np.int64) + (code >= n + n * n)
    code -= np.where(size == 3, n + n * n, np.where(size == 2, n, 0))
    gram = size << (3 * _BITS)
    gram |= alphabet[code % n]
    gram |= np.where(size > 1, alphabet[code // n % n], 0) << _BITS
    gram |= np.where(size > 2, alphabet[code // (n * n) % n], 0) << (2 * _BITS)
    return which, gram, times


def _top(doc: np.ndarray, gram: np.ndarray, times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` most frequent grams of each document with their rank from 0."""
    order = np.argsort((doc << 32) - times, kind="stable")
    doc, gram = doc[order], gram[order]
    first = np.append(True, doc[1:] != doc[:-1])
    rank = np.arange(len(doc)) - np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
    top = rank < k
    return doc[top], gram[top], rank[top]


def _train(batches):
    for part, texts in common.text_slices(batches, "text", _SLICE):
        names = part.column(1).dictionary_encode()
        own = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        doc, gram, times = gram_counts(texts)
        if not len(doc):
            continue
        order = np.lexsort((gram, own[doc]))
        who, g, t = own[doc][order], gram[order], times[order]
        head = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (g[1:] != g[:-1])))
        yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(who[head])), pa.array(g[head]), pa.array(np.add.reduceat(t, head))], names=["lang", "gram", "times"])


def profiles(texts: DataFrame, k: int = K, max_langs: int = MAX_LANGS) -> dict[str, dict[int, int]]:
    """``{lang: {gram: rank}}`` from rows ``(text, lang)`` with a language."""
    counts = texts.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang").mapInArrow(_train, "lang string, gram long, times long") \
        .groupBy("lang", "gram").agg(F.sum("times").alias("times"))
    w = Window.partitionBy("lang").orderBy(F.desc("times"), "gram")
    rows = counts.withColumn("rank", F.row_number().over(w) - 1).where(F.col("rank") < k).select("lang", "gram", "rank").limit(k * max_langs + 1).collect()
    if len(rows) > k * max_langs:
        raise ValueError(f"more than {max_langs} languages")
    out: dict[str, dict[int, int]] = {}
    for r in rows:
        out.setdefault(r["lang"], {})[r["gram"]] = r["rank"]
    return out


def _predict(found: dict[str, dict[int, int]], k: int):
    langs = sorted(found)
    known = np.array(sorted({g for p in found.values() for g in p}), np.int64)
    ranks = np.full((len(langs), len(known) + 1), -1, np.int64)
    for i, name in enumerate(langs):
        for g, r in found[name].items():
            ranks[i, np.searchsorted(known, g)] = r

    def run(batches):
        for part, texts in common.text_slices(batches, "text", _SLICE):
            n = len(texts)
            doc, gram, rank = _top(*gram_counts(texts), k)
            size = np.bincount(doc, minlength=n)
            names, score = np.full(n, "und", object), np.zeros(n)
            if langs and len(doc):
                at = np.minimum(np.searchsorted(known, gram), len(known) - 1)
                at = np.where(known[at] == gram, at, len(known))
                far = np.empty((len(langs), n))
                for i in range(len(langs)):
                    r = ranks[i, at]
                    far[i] = np.bincount(doc, np.where(r >= 0, np.abs(r - rank), k), minlength=n)
                best = far.argmin(axis=0)
                some = size > 0
                names[some] = np.array(langs, object)[best[some]]
                score[some] = 1 - far.min(axis=0)[some] / (k * size[some])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(np.clip(score, 0, 1))],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, found: dict[str, dict[int, int]], id_col: str = "doc_id", text_col: str = "text", held_out=None, k: int = K) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` per row; ``und`` with score 0 for a text that is
    null or has no letter (or when nothing was learned).  Ids are only passed on."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.lit(None).cast("boolean") if held_out is None else held_out).alias("held_out"), F.col(text_col).alias("text"))
    return src.mapInArrow(_predict(found, k), "doc_id long, held_out boolean, lang_pred string, score double")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: learned from texts whose crc32(doc_id) mod 4 is not 2 (a null id
    is neither learned from nor held out), predicted for all."""
    docs = common.table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    found = profiles(docs.where(fold != 2).select("text", "lang"))
    return identify(docs, found, held_out=F.coalesce(fold == 2, F.lit(False)))
