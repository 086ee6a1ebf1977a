"""Operator 2 [native]: licence scan of headers and licence files, inherited along paths.

DataFrame functions only.

1. **Units.** A document is cut at line breaks and sentence ends; every unit of the
   whole text is a possible header.
2. **Weights.** Terms are the runs of a-z and 0-9 of the lower-case text.  The inverse
   document frequency of the templates' terms is counted over all documents; any other
   term has that of an unseen one.
3. **Candidates.** The essential terms of a template are its heaviest ones, as many as
   needed so that the rest could not reach the threshold alone; a unit without an essential
   term of any template has a cosine below the threshold to all of them and is left out.
4. **Cosine.** Sparse TF-IDF vectors of the candidate units are joined term by term to
   the templates (a fixed table); a document's own licence is its best unit's.
5. **Inheritance.** A document is a licence file of its directory if its name says so or
   if licence units make up most of it.  Every directory takes the licence file of its
   nearest ancestor (itself first): directories are joined to their path prefixes, and
   documents without a licence of their own to their directory.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

THRESHOLD, FILE_SHARE = 0.8, 0.5

# Licence ids and their short notices.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]
_FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
_NOT_TERM = "[^a-z0-9]+"


def _terms(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for t in "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split():
        out[t] = out.get(t, 0) + 1
    return out


def _split(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _NOT_TERM), lambda x: x != "")


def _units(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"([.!?])[ \t\n\r]+", "$1\n"), "\n")


def _local(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small fixed table as literals."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def scan(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", templates=None, threshold: float = THRESHOLD,
         file_share: float = FILE_SHARE) -> DataFrame:
    """``(doc_id, path, licence, score, basis, from_dir)``, a row per document row.

    ``basis`` is ``header`` (own unit), ``file`` (the document is a licence file), ``ancestor``
    (inherited; ``from_dir`` names the directory and ``score`` is its file's) or null.  Null and
    empty texts have no unit, a null path inherits nothing, ties go to the higher cosine,
    then the alphabetically first licence; a directory's best file wins by cosine, share,
    then licence name.  Extra columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    bags = [_terms(t) for _, t in templates]
    vocab = sorted({t for b in bags for t in b})
    src = docs.select(F.col(id_col).alias("id"), path.alias("path"), F.col(text_col).alias("text"))
    words = F.array(*[F.lit(t) for t in vocab])
    df = src.select(F.explode(F.array_intersect(F.split(F.lower("text"), _NOT_TERM), words)).alias("t")).groupBy("t").count().collect()  # len(vocab) rows
    seen = {r["t"]: r["count"] for r in df}
    n = docs.count()
    unseen = math.log(1.0 + n) + 1.0
    idf = {t: math.log((1.0 + n) / (1.0 + seen.get(t, 0))) + 1.0 for t in vocab}
    essential: set[str] = set()
    rows = []
    for i, b in enumerate(bags):
        norm = math.sqrt(sum((c * idf[t]) ** 2 for t, c in sorted(b.items())))
        rest = 0.0
        for t, c in sorted(b.items(), key=lambda x: (x[1] * idf[x[0]], x[0])):
            rest += (c * idf[t]) ** 2
            if math.sqrt(rest) >= (threshold - 1e-9) * norm:
                essential.add(t)
        rows += [(i, templates[i][0], t, c * idf[t] / norm) for t, c in sorted(b.items())]
    tpl = _local(spark, rows, ["tpl", "licence", "term", "weight"])
    known = _local(spark, sorted(idf.items()), ["k", "idf"])
    needed = F.array(*[F.lit(t) for t in sorted(essential)])
    low = F.lower("text")
    maybe = F.lit(False)
    for t in sorted(essential):
        maybe = maybe | low.contains(t)
    units = F.when(maybe, F.filter(F.transform(_units(F.col("text")), _split), lambda u: F.arrays_overlap(u, needed)))
    size = F.when(maybe, F.size(_split(F.col("text")))).otherwise(0)
    base = common.save(src.select(F.monotonically_increasing_id().alias("rid"), "id", "path", F.coalesce(units, F.array().cast("array<array<string>>")).alias("units"),
                                  size.alias("size")), "licence-units")
    unit = base.where(F.size("units") > 0).select("rid", F.posexplode("units").alias("u", "terms"))
    term = unit.select("rid", "u", F.explode("terms").alias("term")).groupBy("rid", "u", "term").agg(F.count(F.lit(1)).alias("tf"))
    term = term.join(F.broadcast(known), F.col("term") == F.col("k"), "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unseen))).drop("k", "idf")
    term = common.save(term, "licence-terms")
    norm = term.groupBy("rid", "u").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.sum("tf").alias("terms"))
    dot = term.join(F.broadcast(tpl), "term").groupBy("rid", "u", "tpl", "licence").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    cos = dot.join(norm, ["rid", "u"]).select("rid", "u", "licence", "terms", F.round(F.col("dot") / F.col("norm"), 6).alias("score")).where(F.col("score") >= threshold)
    # Best first: higher score, then alphabetically first licence.
    best = cos.groupBy("rid", "u").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("b"), F.max("terms").alias("terms"))
    own = common.save(best.groupBy(F.col("rid").alias("r")).agg(F.min("b").alias("b"), F.sum("terms").alias("in_units"))
                      .select("r", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"), "in_units"), "licence-own")
    x = base.join(own, base["rid"] == own["r"], "left").withColumn("dir", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    x = x.withColumn("is_file", F.col("licence").isNotNull() & (F.coalesce(F.col("path").rlike(_FILE_NAME), F.lit(False)) | (F.col("in_units") >= F.col("size") * file_share)))
    x = common.save(x.select("id", "path", "dir", "licence", "score", "is_file", F.col("in_units") / F.greatest("size", F.lit(1))).toDF("id", "path", "dir", "licence", "score", "is_file", "share"), "licence-docs")
    files = x.where("is_file AND path IS NOT NULL").groupBy(F.col("dir").alias("f_dir")).agg(F.min(F.struct((-F.col("score")).alias("s"), (-F.col("share")).alias("h"), F.col("licence").alias("l"))).alias("f")) \
        .select("f_dir", F.col("f.l").alias("f_licence"), (-F.col("f.s")).alias("f_score"))
    files = common.save(files, "licence-files")
    dirs = x.where("path IS NOT NULL").select("dir").distinct()
    parts = F.split("dir", "/")
    up = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")) \
        .select("dir", "depth", F.array_join(F.slice(F.split("dir", "/"), F.lit(1), F.col("depth")), "/").alias("a"))
    near = common.save(up.join(files, up["a"] == files["f_dir"]).groupBy("dir").agg(F.max(F.struct("depth", "f_dir", "f_licence", "f_score")).alias("m"))
                       .select(F.col("dir").alias("d"), F.col("m.f_dir").alias("f_dir"), F.col("m.f_licence").alias("f_licence"), F.col("m.f_score").alias("f_score")), "licence-dirs")
    y = x.join(near, (x["dir"] == near["d"]) & x["path"].isNotNull() & x["licence"].isNull(), "left")
    basis = F.when(F.col("is_file"), "file").when(F.col("licence").isNotNull(), "header").when(F.col("f_licence").isNotNull(), "ancestor")
    return y.select(F.col("id").alias("doc_id"), "path", F.coalesce("licence", "f_licence").alias("licence"), F.coalesce("score", "f_score").alias("score"),
                    basis.alias("basis"), F.when(F.col("licence").isNull(), F.col("f_dir")).alias("from_dir"))


def document_path(doc_id: str = "doc_id", source: str = "source", lang: str = "lang") -> Column:
    """``documents`` has no path; source, language and thousand of ids stand for directories."""
    text = F.col(doc_id).cast("string")
    return F.concat_ws("/", F.coalesce(F.col(source), F.lit("_")), F.coalesce(F.col(lang), F.lit("_")), F.floor(F.col(doc_id) / 1000).cast("string"), F.concat(text, F.lit(".txt")))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``."""
    return scan(common.table(spark, sf_dir, "documents"), document_path())


def _oracle() -> str:
    values = ", ".join(f"({i}, '{a}', '{t}', {c})" for i, (a, text) in enumerate(TEMPLATES) for t, c in sorted(_terms(text).items()))
    return rf"""
WITH tv(tpl, licence, term, c) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
  concat_ws('/', coalesce(source, '_'), coalesce(lang, '_'), floor(doc_id / 1000)::BIGINT::VARCHAR, doc_id::VARCHAR || '.txt') AS path FROM documents),
n AS (SELECT count(*)::DOUBLE AS n FROM d),
w AS (SELECT rid, unnest(list_distinct(string_split_regex(lower(text), '[^a-z0-9]+'))) AS term FROM d),
f AS (SELECT v.term, ln((1 + n) / (1 + count(w.rid))) + 1 AS idf FROM (SELECT DISTINCT term FROM tv) v CROSS JOIN n LEFT JOIN w USING (term) GROUP BY v.term, n),
tn AS (SELECT tpl, sqrt(sum((c * idf) ** 2)) AS norm FROM tv JOIN f USING (term) GROUP BY tpl),
tw AS (SELECT tpl, licence, term, c * idf / norm AS weight FROM tv JOIN f USING (term) JOIN tn USING (tpl)),
u AS (SELECT rid, unnest(string_split(regexp_replace(text, '([.!?])[ \t\n\r]+', '\1' || chr(10), 'g'), chr(10))) AS s FROM d),
v AS (SELECT rid, row_number() OVER () AS u, s FROM u),
t AS (SELECT rid, u, term, count(*) AS tf FROM (SELECT rid, u, unnest(string_split_regex(lower(s), '[^a-z0-9]+')) AS term FROM v) WHERE term <> '' GROUP BY ALL),
x AS (SELECT t.*, tf * coalesce(idf, ln(1 + n) + 1) AS w FROM t CROSS JOIN n LEFT JOIN f USING (term)),
m AS (SELECT u, sqrt(sum(w * w)) AS norm, sum(tf) AS terms FROM x GROUP BY u),
c AS (SELECT x.rid, x.u, licence, terms, round(sum(w * weight) / m.norm, 6) AS score FROM x JOIN tw USING (term) JOIN m USING (u) GROUP BY x.rid, x.u, tpl, licence, terms, m.norm HAVING round(sum(w * weight) / m.norm, 6) >= {THRESHOLD}),
b AS (SELECT rid, u, terms, row_number() OVER (PARTITION BY u ORDER BY score DESC, licence) AS r, score, licence FROM c),
o AS (SELECT rid, sum(terms) AS in_units, first(licence ORDER BY score DESC, licence) AS licence, max(score) AS score FROM b WHERE r = 1 GROUP BY rid),
y AS (SELECT d.rid, doc_id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, o.licence, o.score, in_units, len(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda q: q <> '')) AS size FROM d LEFT JOIN o USING (rid)),
z AS (SELECT *, licence IS NOT NULL AND in_units >= size * {FILE_SHARE} AS is_file FROM y),
g AS (SELECT dir AS f_dir, first(licence ORDER BY score DESC, in_units / greatest(size, 1) DESC, licence) AS f_licence, max(score) AS f_score FROM z WHERE is_file GROUP BY dir),
h AS (SELECT dir, f_dir, f_licence, f_score, row_number() OVER (PARTITION BY dir ORDER BY length(f_dir) DESC) AS r FROM (SELECT DISTINCT dir FROM z) JOIN g ON dir = f_dir OR starts_with(dir, f_dir || '/'))
SELECT doc_id, path, coalesce(licence, f_licence) AS licence, coalesce(score, f_score)::DOUBLE AS score,
  CASE WHEN is_file THEN 'file' WHEN licence IS NOT NULL THEN 'header' WHEN f_licence IS NOT NULL THEN 'ancestor' END AS basis,
  CASE WHEN licence IS NULL THEN f_dir END AS from_dir
FROM z LEFT JOIN h ON z.dir = h.dir AND h.r = 1
"""


ORACLE = _oracle()
