"""License scan by diagonal voting.

Every rolling word k-gram of every document is joined to the positions at
which a template has the same k-gram.  A hit votes for its diagonal: position
in the document minus position in the template.  A diagonal that holds all of
a phrase's k-grams is an exact place of the phrase.  For templates, the
diagonals from one on to MERGE_WITHIN further are one span, which bridges a few
inserted or missing words and bounds the span's length.  A span is verified by
the share of the template's k-grams it holds: distinct positions in the
template, so a k-gram that the text repeats counts once.  Of verified spans that
overlap by their diagonals the best one counts (ties: the first).

The join compares the k-gram's hash and then its words, so a hash collision
cannot add a vote.  Templates are a parameter of a few hundred words; their
positions are broadcast only within ``BROADCAST_POSITIONS``, beyond it the
join shuffles.  Documents are read and split into words once: k-grams without a
vote collapse to one row per document before the shuffle, and it carries the
number of words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 2
MERGE_WITHIN = 3  # words between diagonals of one span
VERIFY_SHARE = 0.75  # of a template's k-grams
BROADCAST_POSITIONS = 100_000

#: Fixed base phrases and labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: The method's own templates and labels, by words as the scan reads them.
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("this work is licensed under a creative commons attribution", "cc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def scan_words(text: F.Column) -> F.Column:
    """Words of a text, A-Z lower-cased; null counts as empty."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, _SEPARATORS), "")


def template_positions(spark: SparkSession, base=BASE, templates=TEMPLATES, k: int = K) -> DataFrame:
    """One row per template k-gram: template, label, is_base, n_words, n_grams, tpos, w0.."""
    rows = []
    for number, (phrase, label, is_base) in enumerate(
            [(*b, True) for b in base] + [(*t, False) for t in templates]):
        ws = phrase.split()
        if len(ws) < k:
            raise ValueError(f"a phrase needs at least {k} words: {phrase!r}")
        rows += [(number, label, is_base, len(ws), len(ws) - k + 1, i, *ws[i:i + k])
                 for i in range(len(ws) - k + 1)]
    found = spark.createDataFrame(rows, "template int, label string, is_base boolean, n_template int, n_grams int, "
                                  "tpos int, " + ", ".join(f"w{i} string" for i in range(k)))
    found = found.withColumn("gram", F.xxhash64(*[F.col(f"w{i}") for i in range(k)]))
    return F.broadcast(found) if len(rows) <= BROADCAST_POSITIONS else found


_ROW = ["row", "doc_id", "n_words"]
_TEMPLATE = ["template", "label", "is_base", "n_template", "n_grams"]


def _votes(docs: DataFrame, id_col: str, text_col: str, base, templates, k: int) -> DataFrame:
    """Distinct (row, template, diagonal, tpos), and for every row one or more
    without a template."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                           scan_words(F.col(text_col)).alias("words"))
    rolled = F.arrays_zip(*[(F.slice("words", i + 1, F.greatest(F.size("words") - i, F.lit(0))) if i
                             else F.col("words")).alias(f"w{i}") for i in range(k)])
    grams = numbered.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), F.posexplode_outer(rolled).alias("pos", "g"))
    grams = grams.select(*_ROW, "pos", *[F.col(f"g.w{i}").alias(f"v{i}") for i in range(k)])
    grams = grams.withColumn("doc_gram", F.xxhash64(*[F.col(f"v{i}") for i in range(k)]))
    positions = template_positions(docs.sparkSession, base, templates, k)
    equal = F.col("doc_gram") == F.col("gram")
    for i in range(k):
        equal &= F.col(f"v{i}") == F.col(f"w{i}")
    hits = grams.join(positions, equal, "left").select(*_ROW, *_TEMPLATE, (F.col("pos") - F.col("tpos")).alias("diagonal"), "tpos")
    return hits.distinct()


def _spans(votes: DataFrame, k: int, merge_within: int, verify_share: float) -> DataFrame:
    """The votes, with one of them marked (``is_span``) for each verified span:
    first_word, end_word, share."""
    place = Window.partitionBy("row", "template")
    ahead = place.orderBy("diagonal").rangeBetween(0, merge_within)
    around = place.orderBy("diagonal").rangeBetween(-merge_within, merge_within)
    same = Window.partitionBy("row", "template", "diagonal")
    at = F.col("diagonal") + F.col("tpos")
    voted = votes.withColumn("held", F.size(F.collect_set("tpos").over(ahead))).withColumn("lo", F.min(at).over(ahead)).withColumn(
        "hi", F.max(at).over(ahead) + k).withColumn("votes", F.count("tpos").over(same)).withColumn("head", F.min("tpos").over(same))
    # A span begins with its own diagonal's votes; of those around it the best counts.
    rank = F.struct(F.col("held").alias("held"), (-F.col("diagonal")).alias("first"))
    voted = voted.withColumn("best", F.max(rank).over(around) == rank)
    exact = F.col("is_base") & (F.col("votes") == F.col("n_grams"))
    verified = ~F.col("is_base") & (F.col("held") >= verify_share * F.col("n_grams")) & F.col("best")
    is_span = F.coalesce((F.col("tpos") == F.col("head")) & (exact | verified), F.lit(False))
    return voted.select(
        *_ROW, *_TEMPLATE, is_span.alias("is_span"),
        F.when(F.col("is_base"), F.col("diagonal")).otherwise(F.col("lo")).alias("first_word"),
        F.when(F.col("is_base"), F.col("diagonal") + F.col("n_template")).otherwise(F.col("hi")).alias("end_word"),
        F.when(F.col("is_base"), F.lit(1.0)).otherwise(F.col("held") / F.col("n_grams")).alias("share"))


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, templates=TEMPLATES,
                  k: int = K, merge_within: int = MERGE_WITHIN, verify_share: float = VERIFY_SHARE) -> DataFrame:
    """One row per verified span: row, doc_id, label, is_base, first_word,
    end_word, share; ``row`` numbers the input rows."""
    found = _spans(_votes(docs, id_col, text_col, base, templates, k), k, merge_within, verify_share)
    return found.filter("is_span").select("row", "doc_id", "label", "is_base", "first_word", "end_word", "share")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, templates=TEMPLATES,
                 k: int = K, merge_within: int = MERGE_WITHIN, verify_share: float = VERIFY_SHARE) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score.

    n_base counts all places of base phrases, first_word and last_word are the
    smallest and largest of their starts.  labels adds the verified templates'
    labels; score is the best verified share (1 with a base phrase, 0 without
    any span).  Null and empty texts have no words and no labels.  Repeated
    rows each get their row; null ids stay null; an empty table gives an empty
    result; other columns are not read.
    """
    spans = _spans(_votes(docs, id_col, text_col, base, templates, k), k, merge_within, verify_share)
    span = F.col("is_span")
    place = F.when(span & F.col("is_base"), F.col("first_word"))

    def joined(which: F.Column) -> F.Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")

    return spans.groupBy(*_ROW).agg(
        F.count(place).alias("n_base"), F.min(place).cast("long").alias("first_word"), F.max(place).cast("long").alias("last_word"),
        joined(span & F.col("is_base")).alias("base_labels"), joined(span).alias("labels"),
        F.coalesce(F.max(F.when(span, F.col("share"))), F.lit(0.0)).alias("score")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _oracle() -> str:
    """The same votes in SQL, with the words listed once per document."""
    rows = []
    for number, (phrase, label, is_base) in enumerate(
            [(*b, True) for b in BASE] + [(*t, False) for t in TEMPLATES]):
        ws = phrase.split()
        rows += [f"({number}, '{label}', {is_base}, {len(ws)}, {len(ws) - 1}, {i}, '{ws[i]}', '{ws[i + 1]}')"
                 for i in range(len(ws) - 1)]
    return rf"""
WITH t(template, label, is_base, n_template, n_grams, tpos, w0, w1) AS (VALUES {', '.join(rows)}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(len(words) - 1)) AS pos FROM d),
v AS (SELECT doc_id, pos, t.* FROM p JOIN t ON words[pos + 1] = w0 AND words[pos + 2] = w1),
g AS (SELECT DISTINCT doc_id, template, label, is_base, n_grams, pos - tpos AS diagonal, tpos FROM v),
b AS (SELECT doc_id, label, true AS is_base, diagonal AS first_word, 1.0 AS share FROM g WHERE is_base
      GROUP BY doc_id, template, label, n_grams, diagonal HAVING count(*) = n_grams),
h AS (SELECT a.doc_id, a.template, a.label, a.diagonal, count(DISTINCT z.tpos) / a.n_grams AS share
      FROM (SELECT DISTINCT doc_id, template, label, n_grams, diagonal FROM g WHERE NOT is_base) a
      JOIN g z ON z.doc_id = a.doc_id AND z.template = a.template AND z.diagonal BETWEEN a.diagonal AND a.diagonal + {MERGE_WITHIN}
      GROUP BY a.doc_id, a.template, a.label, a.n_grams, a.diagonal),
s AS (SELECT doc_id, label, is_base, first_word, share FROM b UNION ALL
      SELECT doc_id, label, false, diagonal, share FROM h WHERE share >= {VERIFY_SHARE}),
a AS (SELECT doc_id, count(*) FILTER (WHERE is_base) AS n_base, min(first_word) FILTER (WHERE is_base) AS first_word,
             max(first_word) FILTER (WHERE is_base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE is_base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM s GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN a USING (doc_id)
"""


ORACLE_SQL = _oracle()
