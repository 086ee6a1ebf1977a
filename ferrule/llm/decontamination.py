"""Operator 6: benchmark decontamination by template canonicalisation.

Words of documents and benchmark items become template tokens: numbers ``<num>`` (digits
or spelled), the unit after a number ``<unit>``, a capitalised word inside a sentence
``<name>``, any other word its lower-case form without surrounding punctuation.  Windows
of ``window`` template tokens (a shorter item: all its tokens) that hold enough literal
tokens are hashed; a document's windows are joined by hash to the items' windows.  So are
the windows of plain lower-case values, whatever they hold, with the operators between
them: items of numbers, names or units alone, and short items that a capital or a line
break reads in another way, are found word for word.  Hits
on one alignment (same distance between document and item) are taken together if
their slots are consistent: every number, name or unit of the item stands for one value of
the document throughout, and different values stay different, so an exact copy counts
and so does the same question with other numbers or names, but not a mere likeness of
form.  Adjacent hits make a run, and each run is judged on its own for verbatim text: a
run in the item's own values counts, and of a run with other values the stretches of
``window`` tokens that are the item's own, slots among them.  A document is contaminated
by an item if one run or stretch is verbatim, or if consistent alignments and verbatim
stretches cover ``coverage`` of it.

The items go to the documents' tasks in blocks of at most ``block_words`` words (the
bound of what is broadcast); a larger benchmark takes one pass over the documents per
block.  Documents are never shuffled.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .words import U, Words, mix, window_hash

WINDOW, MIN_LITERAL, COVERAGE = 8, 4, 0.5
BLOCK_WORDS = 400_000

# Units, and numbers in words.
UNITS = frozenset("""mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce
ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
% percent dollar dollars euro euros cent cents usd eur mph kmh degree degrees celsius fahrenheit watt watts volt volts hz gb mb kb""".split())
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen
nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split())
_NUMBER = re.compile(r"[+-]?[$€£]?[0-9][0-9.,:/]*(?:st|nd|rd|th)?")
_GLUED = re.compile(r"([+-]?[$€£]?[0-9][0-9.,]*)([A-Za-z%]+)")
_OPERATOR = re.compile(r"[-+*/=<>^×÷±−]+")
_EDGE = re.compile(r"^[^\w$€£+%-]+|[^\w%]+$")

LITERAL, NUM, UNIT, NAME, SKIP = 0, 1, 2, 3, 4


def _kind(word: bytes) -> tuple[int, str, bool, bool]:
    """(kind, value, could be a unit, closes a sentence) of a word alone."""
    s = word.decode("utf-8", "replace")
    bare = _EDGE.sub("", s)
    ends = s.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":", "…")
    low = bare.lower()
    if not any(c.isalnum() or c == "%" for c in bare):
        return SKIP, s if _OPERATOR.fullmatch(s) else "", False, ends
    if _NUMBER.fullmatch(bare) or low in NUMBER_WORDS:
        return NUM, low, False, ends
    m = _GLUED.fullmatch(bare)
    if m and m[2].lower() in UNITS:
        return NUM, low, False, ends
    if bare[0].isupper() and (len(bare) == 1 or not bare.isupper()):
        return NAME, low, low in UNITS, ends
    return LITERAL, low, low in UNITS, ends


class _Tokens:
    """Template tokens of a batch: kind, hash (literal: of the value; slot: of its type),
    value hash, text and first token of each text."""

    def __init__(self, texts: list[bytes], known: dict[int, tuple]):
        w = Words(texts)
        n = len(w.start)
        h, at, back = np.unique(w.hashes(), return_index=True, return_inverse=True)
        if len(known) > 500_000:
            known.clear()
        got = []
        for x, a, b in zip(h.tolist(), w.start[at].tolist(), w.end[at].tolist()):
            g = known.get(x)
            if g is None:
                kind, value, unit, ends = _kind(w.blob[a:b])
                g = known[x] = (kind, _hash(value), unit, ends)
            got.append(g)
        m = len(got)
        kind = np.fromiter((g[0] for g in got), np.int8, m)[back]
        value = np.fromiter((g[1] for g in got), np.uint64, m)[back]
        unit = np.fromiter((g[2] for g in got), bool, m)[back]
        ends = np.fromiter((g[3] for g in got), bool, m)[back]
        # A capital opens a sentence after a closing word, a line break or at the start.
        start = np.ones(n, bool)
        if n > 1:
            start[1:] = ends[:-1] | (w.doc[1:] != w.doc[:-1]) | (w.buf[w.start[1:] - 1] == 10)
        kind = np.where((kind == NAME) & start, LITERAL, kind)
        keep = kind != SKIP
        # Operators since the token before (only compared inside a window).
        signs = np.cumsum(np.where(keep | (value == _NOTHING), U(0), value))[keep]
        kind, value, unit, doc = kind[keep], value[keep], unit[keep], w.doc[keep]
        after = np.append(False, (kind[:-1] == NUM) & (doc[1:] == doc[:-1])) if len(kind) else np.zeros(0, bool)
        kind = np.where(after & unit & (kind != NUM), UNIT, kind).astype(np.int8)
        self.kind, self.value, self.doc = kind, value, doc
        self.signed = value + mix(np.diff(signs, prepend=signs[:1]))
        self.form = np.where(kind == LITERAL, value, _SLOT[kind])
        self.first = np.searchsorted(doc, np.arange(len(texts) + 1))
        self.literal = np.append(0, np.cumsum(kind == LITERAL))

    def windows(self, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(first token, hash) of the windows of k tokens with ``least`` literals."""
        n = len(self.form)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero((self.doc[: n - k + 1] == self.doc[k - 1:]) & (self.literal[k:] - self.literal[:-k] >= least))
        return at, window_hash(self.form, k)[at]


    def plain_windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first token, hash) of the windows of k values and the operators between them."""
        n = len(self.value)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1:])
        h = mix(self.value * U(0x9E3779B97F4A7C15) + U(k))
        if k > 1:
            h = mix(h[: n - k + 1] + window_hash(self.signed, k - 1)[1:])
        return at, h[at]


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "replace"), digest_size=8).digest(), "little")


_NOTHING = U(_hash(""))
_SLOT = np.array([0] + [_hash(f"<{i}>") for i in (NUM, UNIT, NAME)] + [0], np.uint64)


class Index:
    """Windows and tokens of one block of items."""

    def __init__(self, ids: list[int], texts: list[bytes], window: int, least: int):
        t = _Tokens(texts, {})
        self.ids, self.kind, self.value, self.first = ids, t.kind, t.value, t.first
        size = np.diff(t.first)
        self.by_size: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]] = {}
        for k in {window, *[int(s) for s in size if 0 < s < window]}:
            for plain in (False, True):
                at, h = t.plain_windows(k) if plain else t.windows(k, min(least, (k + 1) // 2))
                mine = (size[t.doc[at]] == k) if k < window else np.ones(len(at), bool)
                order = np.argsort(h[mine], kind="stable")
                if mine.any():
                    self.by_size[k, plain] = (h[mine][order], at[mine][order])
        self.item = t.doc

    def hits(self, t: _Tokens, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document token, item token, window length) of every pair of equal windows."""
        out = []
        for (k, plain), (h, at) in self.by_size.items():
            pos, own = t.plain_windows(k) if plain else t.windows(k, min(least, (k + 1) // 2))
            lo, hi = np.searchsorted(h, own), np.searchsorted(h, own, side="right")
            n = hi - lo
            some = np.flatnonzero(n)
            n = n[some]
            into = np.repeat(lo[some], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out.append((np.repeat(pos[some], n), at[into], np.full(len(into), k)))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _consistent(kind, a, b) -> bool:
    """One document value per item value and back, by slot type."""
    slots = kind != LITERAL
    pairs = set(zip(kind[slots].tolist(), a[slots].tolist(), b[slots].tolist()))
    return len({(k, x) for k, x, _ in pairs}) == len(pairs) == len({(k, y) for k, _, y in pairs})


def _verbatim(kind, cover, same, need: int) -> tuple[list[int], bool]:
    """Item tokens in verbatim stretches of ``need`` tokens, and whether one counts alone:
    a whole run of adjacent tokens, or a stretch that holds a slot of the item."""
    out, exact = [], False
    for run in np.split(np.arange(len(cover)), np.flatnonzero(np.diff(cover) != 1) + 1):
        whole = same[run].all()
        for part in [run] if whole else np.split(run, np.flatnonzero(np.diff(same[run])) + 1):
            if len(part) >= need and same[part[0]]:
                out += cover[part].tolist()
                exact |= bool(whole or (kind[cover[part]] != LITERAL).any())
    return out, exact


def _matches(t: _Tokens, index: Index, window: int, least: int, coverage: float):
    """Per document: ``[(item id, share covered, exact)]`` of the items that contaminate it."""
    pos, at, k = index.hits(t, least)
    found: dict[int, dict[int, tuple[float, bool]]] = {}
    if not len(pos):
        return found
    doc, item, off = t.doc[pos], index.item[at], pos - at
    order = np.lexsort((at, off, item, doc))
    pos, at, k, doc, item, off = (x[order] for x in (pos, at, k, doc, item, off))
    head = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (off[1:] != off[:-1])))
    best: dict[tuple[int, int], list] = {}
    for a, b in zip(head.tolist(), np.append(head[1:], len(pos)).tolist()):
        cover = np.unique((at[a:b, None] + np.arange(k[a: b].max())).ravel()) if k[a] == k[a:b].max() else at[a:b]
        cover = cover[cover < index.first[item[a] + 1]]
        mine, theirs = index.value[cover], t.value[cover + off[a]]
        s = best.setdefault((int(doc[a]), int(item[a])), [set(), False])
        own, exact = _verbatim(index.kind, cover, mine == theirs, min(window, int(index.first[item[a] + 1] - index.first[item[a]])))
        s[0].update(cover.tolist() if _consistent(index.kind[cover], mine, theirs) else own)
        s[1] |= exact
    for (d, i), (cover, exact) in best.items():
        size = int(index.first[i + 1] - index.first[i])
        share = len(cover) / size
        if exact or share >= coverage:
            known = found.setdefault(d, {}).get(index.ids[i], (0.0, False))  # items may share an id
            found[d][index.ids[i]] = (max(known[0], share), known[1] or exact)
    return found


_ROW = "doc_id long, text string, items array<long>, coverage double, exact boolean"


def _scan(index: Index, window: int, least: int, coverage: float):
    """Rows of ``_ROW`` with what this block of items adds to them."""
    def run(batches):
        known: dict[int, tuple] = {}
        for part, texts in common.text_slices(batches):
            found = _matches(_Tokens(texts, known), index, window, least, coverage)
            ids, cover, exact = (part.column(i).to_pylist() for i in (2, 3, 4))
            for i, got in found.items():
                ids[i] = sorted({*ids[i], *got})
                cover[i] = max(cover[i], *[s for s, _ in got.values()])
                exact[i] = exact[i] or any(e for _, e in got.values())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ids, pa.list_(pa.int64())), pa.array(cover, pa.float64()), pa.array(exact, pa.bool_())],
                                             names=["doc_id", "text", "items", "coverage", "exact"])

    return run


def _drop(index: Index, window: int, least: int, coverage: float, text_col: str):
    def run(batches):
        known: dict[int, tuple] = {}
        for part, texts in common.text_slices(batches, text_col):
            found = _matches(_Tokens(texts, known), index, window, least, coverage)
            keep = np.ones(len(texts), bool)
            keep[list(found)] = False
            yield part.filter(pa.array(keep))

    return run


def item_blocks(items: DataFrame, id_col: str, text_col: str, window: int, least: int, block_words: int):
    """Indexes over the items, of at most ``block_words`` words each (or one item)."""
    src = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    ids, texts, size = [], [], 0
    for r in src.toLocalIterator():
        n = len(r["text"].split())
        if ids and size + n > block_words:
            yield Index(ids, texts, window, least)
            ids, texts, size = [], [], 0
        ids.append(r["id"])
        texts.append(r["text"].encode("utf-8", "replace"))
        size += n
    if ids:
        yield Index(ids, texts, window, least)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, least: int = MIN_LITERAL, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, n_items, items, coverage, exact, contaminated)``, a row per document row.

    ``items`` lists the ids of the items that contaminate it (ascending), ``coverage`` is the
    largest share of one that is covered, ``exact`` whether one run or stretch is verbatim.  Null
    texts hold nothing; items without id or text are left out; an empty benchmark contaminates
    nothing.  Every block of items adds to the rows as they pass, so the result doesn't depend
    on the number of blocks, and rows that share an id stay rows of their own.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.array().cast("array<long>").alias("items"),
                       F.lit(0.0).alias("coverage"), F.lit(False).alias("exact"))
    for ix in item_blocks(items, item_id, item_text, window, least, block_words):
        rows = rows.mapInArrow(_scan(ix, window, least, coverage), _ROW)
    return rows.select("doc_id", F.size("items").cast("long").alias("n_items"), "items", "coverage", "exact", (F.size("items") > 0).alias("contaminated"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents`` against whole ``benchmark``."""
    return contamination(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW, least: int = MIN_LITERAL,
                      coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pipeline stage: documents that no item contaminates, with all their columns."""
    for ix in item_blocks(items, "item_id", "text", window, least, block_words):
        docs = docs.mapInArrow(_drop(ix, window, least, coverage, text_col), docs.schema)
    return docs
