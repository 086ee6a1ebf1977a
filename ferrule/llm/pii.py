"""Operator 9: personal data with offset-preserving deobfuscation.

Base kinds (email, ip, card, phone) are found in the text as it stands.  Then the
text passes through transducers, each of which rewrites it and carries, for every
character it writes, the source range it stands for:

* characters: zero-width characters go, homoglyphs (full-width forms, digits of any
  script, Cyrillic and Greek look-alikes) become the ASCII they imitate;
* spelled digits ("one", "double five", "oh") in a run, "plus" before one, "dot" or
  "point" between them;
* disguised addresses: "name at host dot tld", "name (at) host [dot] tld".

The base detectors run on what comes out, and each span is mapped back to source
offsets.  A span is added when it needed a rewriting and meets no base span of its
kind, or holds more than the base spans that it meets (a disguise in the middle of an
address leaves its plain end as a base span).  Each text is handled alone, whole, in one pass; the transducers only run on
texts that hold something for them.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that starts inside a digit run also fails or succeeds at its start, so the
# look-behind changes no match and keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(t: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each '@' (linear in the text)."""
    out, done, at = [], 0, t.find("@")
    while at >= 0:
        lo = at
        while lo > done and t[lo - 1] in _LOCAL:
            lo -= 1
        m = _DOMAIN.match(t, at + 1) if lo < at else None
        if m:
            out.append((lo, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = t.find("@", max(at + 1, done))
    return out


def base_spans(t: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base kinds in ``t``, code points, end exclusive."""
    out = []
    if "@" in t:
        out += [(a, b, "email") for a, b in _emails(t)]
    if _DIGIT.search(t):
        if "." in t:
            out += [(m.start(), m.end(), "ip") for m in _IP.finditer(t) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 12:
                d = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), m.end(), "card"))
        if "+" in t:
            out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# Look-alike letters of other scripts and the ASCII they imitate.
_LOOKALIKE = {"а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t",
              "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "ո": "n", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K",
              "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "α": "a", "ο": "o", "ρ": "p", "ν": "v", "υ": "u", "ι": "i",
              "κ": "k", "τ": "t", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
              "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-", "−": "-"}
# Characters without width.
_NO_WIDTH = "­​‌‍⁠﻿"
# Digit words.
_DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

_DECIMALS = "".join(c for c in map(chr, range(128, 1 << 16)) if unicodedata.decimal(c, None) is not None)
# Everything that _fold rewrites; above U+FFFF more than that, as one range (many are slow there).
_ODD = re.compile("[" + re.escape(_NO_WIDTH + "".join(_LOOKALIKE) + _DECIMALS) + f"！-～{chr(1 << 16)}-{chr(sys.maxunicode)}]")
_WORD = "(?:" + "|".join(_DIGIT_WORDS) + ")"
_PIECE = rf"(?:(?:double|triple)[ ]+)?{_WORD}(?![A-Za-z])|[0-9]+"
_SPELLED = re.compile(rf"(?<![A-Za-z0-9])(?:plus[ ]+)?(?:{_PIECE})(?:(?:[ ,-]+|[ ]+(?:dot|point)[ ]+)(?:{_PIECE}))+", re.I)
_SPELLED_AT = re.compile(rf"\b{_WORD}[ ,-]+(?:(?:dot|point)[ ]+)?(?:{_PIECE})|[0-9][ ,-]+(?:(?:dot|point)[ ]+)?(?:(?:double|triple)[ ]+)?{_WORD}(?![A-Za-z])", re.I)
_TOKEN = re.compile(rf"(?P<times>double|triple)[ ]+(?P<rep>{_WORD})|(?P<one>{_WORD})|(?P<num>[0-9]+)|(?P<plus>plus)[ ]+|[ ]+(?P<dot>dot|point)[ ]+|(?P<gap>[ ,-]+)", re.I)
_AT = r"(?:[ ]*[\[({<][ ]*at[ ]*[\])}>][ ]*|[ ]+at[ ]+|@)"
_DOT = r"(?:[ ]*[\[({<][ ]*(?:dot|\.)[ ]*[\])}>][ ]*|[ ]+dot[ ]+|\.)"
_NAME, _LABEL = "[A-Za-z0-9_%+-]++", "[A-Za-z0-9-]++"
# A maximal run of names joined by any at or dot, and the parts of an address in it.
_JOINED = re.compile(rf"(?<![A-Za-z0-9._%+-]){_NAME}(?:(?:{_AT}|{_DOT}){_NAME})++", re.I)
_SEPARATOR = re.compile(_AT, re.I)
_HOST = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL})++", re.I)
_DOTTED = re.compile(_DOT, re.I)
_LAST = re.compile(r"[A-Za-z0-9-]+$")
# Last labels that a bare "dot" or "at" may lead to (a sentence has them too).
_TOP = frozenset("com org net edu gov mil info biz io co uk de fr es it nl eu ru cn jp br au ca ch".split())
# Words before "at" a plain site name ("look at example.com").
_BEFORE_SITE = frozenset("""a an and are available be been check find found go here him her hosted is it its live look looked looking me more not now on online
or out page published read see shop site start that them there this to up us visit was website were work works you""".split())
_HINT = re.compile(rf"[\[({{<][ ]*(?:at|dot|\.)[ ]*[\])}}>]|[ ]dot[ ]|[ ]at[ ]+(?:{_LABEL}\.)+(?:{'|'.join(sorted(_TOP))})(?![A-Za-z0-9-])", re.I)


class _Tape:
    """A rewritten text with the source range of each of its characters."""

    def __init__(self, text: str, lo: list[int], hi: list[int]):
        self.text, self.lo, self.hi = text, lo, hi

    def rewrite(self, pieces: list[tuple[int, int, list[tuple[int, int, str]]]]) -> "_Tape":
        """Replace ranges: (start, end, [(from, to, out)]) in order; the rest is copied."""
        text, lo, hi, at = [], [], [], 0
        for a, b, parts in pieces:
            text.append(self.text[at:a])
            lo += self.lo[at:a]
            hi += self.hi[at:a]
            for p, q, out in parts:
                text.append(out)
                lo += [self.lo[p]] * len(out)
                hi += [self.hi[q - 1]] * len(out)
            at = b
        text.append(self.text[at:])
        return _Tape("".join(text), lo + self.lo[at:], hi + self.hi[at:])


def _fold(t: _Tape) -> _Tape:
    pieces = []
    for m in _ODD.finditer(t.text):
        c, a = m[0], m.start()
        if c in _NO_WIDTH:
            pieces.append((a, a + 1, []))
        elif c in _LOOKALIKE:
            pieces.append((a, a + 1, [(a, a + 1, _LOOKALIKE[c])]))
        elif "！" <= c <= "～":
            pieces.append((a, a + 1, [(a, a + 1, chr(ord(c) - 0xFEE0))]))
        elif (d := unicodedata.decimal(c, None)) is not None:
            pieces.append((a, a + 1, [(a, a + 1, str(d))]))
    return t.rewrite(pieces) if pieces else t


def _spelled(t: _Tape) -> _Tape:
    pieces = []
    for m in _SPELLED.finditer(t.text):
        if not _SPELLED_AT.search(m[0]):
            continue
        parts = []
        for x in _TOKEN.finditer(t.text, m.start(), m.end()):
            a, b = x.span()
            if x["times"]:
                parts.append((a, b, _DIGIT_WORDS[x["rep"].lower()] * (2 if x["times"].lower() == "double" else 3)))
            elif x["one"]:
                parts.append((a, b, _DIGIT_WORDS[x["one"].lower()]))
            elif x["num"]:
                parts.append((a, b, x["num"]))
            elif x["plus"]:
                parts.append((a, b, "+"))
            elif x["dot"]:
                parts.append((a, b, "."))
            # gaps between digits go
        pieces.append((m.start(), m.end(), parts))
    return t.rewrite(pieces) if pieces else t


def _is_address(name: str, at: str, host: str) -> bool:
    """Whether a disguised address is meant, not a sentence with "at" and "dot" in it."""
    joints = [d[0] for d in _DOTTED.finditer(host)]
    bare_at, last = at.strip().lower() == "at", joints[-1].strip().lower()
    if last != "dot" and not (bare_at and all(d == "." for d in joints)):
        return True
    if _LAST.search(host)[0].lower() not in _TOP:
        return False
    return last == "dot" or not (name.lower() in _BEFORE_SITE or host.lower().startswith("www."))


def _addresses(t: _Tape) -> _Tape:
    """At and dot disguises: every run of names joined by them, whole."""
    pieces = []
    for run in _JOINED.finditer(t.text):
        start = run.start()
        for s in _SEPARATOR.finditer(t.text, run.start(), run.end()):
            if s.start() < start:
                continue
            lo, start = start, s.end()
            host = _HOST.match(t.text, s.end(), run.end())
            if not host or lo == s.start() or lo > run.start() and t.text[lo - 1] in _LOCAL:
                continue
            dots = [(d.start(), d.end(), ".") for a, b in ((lo, s.start()), host.span()) for d in _DOTTED.finditer(t.text, a, b)]
            inner = [x for x in [(*s.span(), "@"), *dots] if t.text[x[0]: x[1]] != x[2]]
            if not inner or not _is_address(t.text[lo: s.start()], s[0], host[0]):
                continue
            at, parts = lo, []
            for a, b, out in sorted(inner):
                parts += [(i, i + 1, t.text[i]) for i in range(at, a)] + [(a, b, out)]
                at = b
            parts += [(i, i + 1, t.text[i]) for i in range(at, host.end())]
            pieces.append((lo, host.end(), parts))
            start = host.end()
    return t.rewrite(pieces) if pieces else t


def added_spans(t: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans that only a rewriting shows, mapped back to the source."""
    odd, digits, hint = _ODD.search(t), _SPELLED_AT.search(t), _HINT.search(t)
    if not (odd or digits or hint):
        return []
    tape = _Tape(t, list(range(len(t))), list(range(1, len(t) + 1)))
    if odd:
        tape = _fold(tape)
    if digits or odd:
        tape = _spelled(tape)
    if hint or odd:
        tape = _addresses(tape)
    taken = {k: [(a, b) for a, b, kind in base if kind == k] for k in KINDS}
    out = []
    for a, b, kind in base_spans(tape.text):
        lo, hi = tape.lo[a], max(tape.hi[a:b])
        near = [(x, y) for x, y in taken[kind] if x < hi and lo < y]
        if t[lo:hi] != tape.text[a:b] and all(lo <= x and y <= hi and (x, y) != (lo, hi) for x, y in near):
            out.append((lo, hi, kind))
            taken[kind].append((lo, hi))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_()), ("text", pa.string())])


def _detect(batches):
    for part, texts in common.text_slices(batches):
        rows = []
        for raw in texts:
            t = raw.decode("utf-8", "replace")
            base = base_spans(t)
            both = [(*s, True) for s in base] + [(*s, False) for s in added_spans(t, base)]
            both.sort(key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
            rows.append([{"start": a, "end": b, "kind": k, "base": x, "text": t[a:b]} for a, b, k, x in both])
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(_SPAN))], names=["id", "found"])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, found)``: per row the spans ``{start, end, kind, base, text}`` by start, then
    kind; ``base`` is false for what the method adds.  A null text is empty; every input
    row gives one row, ids may be null or repeat; other columns are ignored."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInArrow(_detect, "id long, found array<struct<start:long,end:long,kind:string,base:boolean,text:string>>")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``.  ``n_<kind>`` count the base spans, ``n_added`` the others."""
    x = find_pii(common.table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return x.select(
        F.col("id").alias("doc_id"),
        *[count(k) for k in KINDS],
        F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: ~s["base"])).cast("long").alias("n_added"))
