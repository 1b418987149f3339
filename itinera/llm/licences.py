"""Licence scan with a positional rare-token index.

A template is a licence notice whose first words are its mandatory key phrase.
Inverse document frequencies of the template words come from all documents; the
index posts each template under the two rarest words of its key phrase, with
their positions.  In a file the rarest word is looked up, the second one must
stand at its relative position, the key phrase is verified word by word, and
the rest of the template is scored by the share of matching idf weight.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.llm.common import WORD, table, words_of

# Label, number of key-phrase words, the notice, and whether it is
# one of the base phrases.
TEMPLATES = [
    ("gpl", 4, "gnu general public license", True),
    ("apache", 2, "apache license", True),
    ("cc-by", 2, "cc by", True),
    ("mit", 2, "mit license", True),
    ("gpl", 12, "this program is free software you can redistribute it and or modify it under the terms of the "
                "gnu general public license as published by the free software foundation", False),
    ("lgpl", 5, "gnu lesser general public license as published by the free software foundation", False),
    ("agpl", 5, "gnu affero general public license as published by the free software foundation", False),
    ("apache", 4, "licensed under the apache license version 2 0", False),
    ("mit", 6, "permission is hereby granted free of charge to any person obtaining a copy of this software and "
               "associated documentation files to deal in the software without restriction", False),
    ("bsd", 8, "redistribution and use in source and binary forms with or without modification are permitted "
               "provided that the following conditions are met", False),
    ("isc", 6, "permission to use copy modify and or distribute this software for any purpose with or without fee "
               "is hereby granted", False),
    ("mpl", 3, "mozilla public license version 2 0", False),
    ("epl", 3, "eclipse public license version 2 0", False),
    ("cc-by-nc", 3, "cc by nc 4 0", False),
    ("cc-by-sa", 3, "cc by sa 4 0", False),
    ("cc-by-nd", 3, "cc by nd 4 0", False),
    ("cc0", 3, "cc0 1 0 universal", False),
    ("cc-by", 3, "creative commons attribution 4 0 international license", False),
    ("unlicense", 7, "this is free and unencumbered software released into the public domain", False),
    ("bsl", 3, "boost software license version 1 0", False),
]
VOCABULARY = sorted({w for _, _, t, _ in TEMPLATES for w in t.split()})


def document_frequencies(docs: DataFrame) -> tuple[dict[str, int], int]:
    """In how many documents each template word occurs, and the number of documents
    (at most len(VOCABULARY) + 1 rows)."""
    known = F.array_intersect(words_of(F.col("text")), F.lit(VOCABULARY))
    rows = (docs.select(F.explode(F.concat(known, F.array(F.lit("")))).alias("w"))
            .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect())
    df = {r["w"]: r["n"] for r in rows}
    return df, df.pop("", 0)


def index(df: dict[str, int], n_docs: int) -> list[dict]:
    """Templates with their idf weights and the positions of the two rarest key words."""
    idf = {w: math.log((1 + n_docs) / (1 + df.get(w, 0))) + 1 for w in VOCABULARY}
    out = []
    for label, n_key, text, base in TEMPLATES:
        words = text.split()
        order = sorted(range(n_key), key=lambda j: (-idf[words[j]], j))
        out.append({"label": label, "base": base, "words": words, "key": " ".join(words[:n_key]), "n_key": n_key,
                    "rare": words[order[0]], "at": order[0], "next": words[order[1]], "next_at": order[1],
                    "idf": [idf[w] for w in words]})
    return out


def hits(words: Column, postings: list[dict]) -> Column:
    """All verified placements: array of (label, base, start, cover)."""
    rare = sorted({p["rare"] for p in postings})
    kind = "array<struct<label:string,base:boolean,start:int,cover:double>>"
    posted = F.array(*[F.struct(
        F.lit(p["label"]).alias("label"), F.lit(p["base"]).alias("base"), F.lit(p["key"]).alias("key"),
        F.lit(p["n_key"]).alias("n_key"), F.lit(p["rare"]).alias("rare"), F.lit(p["at"]).alias("at"),
        F.lit(p["next"]).alias("next"), F.lit(p["next_at"]).alias("next_at"), F.lit(p["words"]).alias("words"),
        F.lit(p["idf"]).alias("idf")) for p in postings])

    def cover(t, start):
        seen = F.slice(words, start + 1, F.size(t["words"]))
        same = F.zip_with(F.zip_with(t["words"], seen, lambda a, b: F.coalesce(a == b, F.lit(False))), t["idf"],
                          lambda ok, w: F.when(ok, w).otherwise(0.0))
        total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
        return F.round(total(same) / total(t["idf"]), 6)

    def placed(o):
        fits = F.filter(posted, lambda t: (t["rare"] == o["w"]) & (o["i"] >= t["at"])
                        & (F.get(words, o["i"] - t["at"] + t["next_at"]) == t["next"])
                        & (F.array_join(F.slice(words, o["i"] - t["at"] + 1, t["n_key"]), " ") == t["key"]))
        return F.transform(fits, lambda t: F.struct(
            t["label"].alias("label"), t["base"].alias("base"), (o["i"] - t["at"]).alias("start"),
            cover(t, o["i"] - t["at"]).alias("cover")))

    places = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                      lambda o: o["w"].isin(rare))
    return F.when(F.arrays_overlap(words, F.lit(rare)), F.flatten(F.transform(places, placed))).otherwise(
        F.array().cast(kind))


def scan(docs: DataFrame, postings: list[dict] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row.

    Null and empty texts have no words, no labels and score 0; repeated rows give
    a row each; an empty table gives no rows; only doc_id and text are read.
    score is the best share of a verified template's idf weight found in place.
    """
    postings = postings or index(*document_frequencies(docs))
    got = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    got = got.select("doc_id", F.size("words").cast("long").alias("n_words"), hits(F.col("words"), postings).alias("hits"))
    got = got.select("doc_id", "n_words", "hits", F.filter("hits", lambda h: h["base"]).alias("base"))
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda h: h["label"]))), ",")
    starts = F.transform("base", lambda h: h["start"])
    return got.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        labels("base").alias("base_labels"), labels("hits").alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["cover"])), F.lit(0.0)).alias("score"))


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    templates = ",\n".join(
        f"({i}, '{label}', {n}, {t.split()!r}, {str(b).lower()})" for i, (label, n, t, b) in enumerate(TEMPLATES))
    return rf"""
WITH t(tid, label, n_key, tw, base) AS (VALUES {templates}),
d AS (SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '{WORD}') AS w FROM documents),
df AS (SELECT x, count(*) AS n FROM (SELECT DISTINCT rid, unnest(w) AS x FROM d) GROUP BY x),
vocab AS (SELECT DISTINCT unnest(tw) AS x FROM t),
idf AS (SELECT x, ln((1 + (SELECT count(*) FROM d)) / (1 + coalesce(n, 0))) + 1 AS v FROM vocab LEFT JOIN df USING (x)),
pos AS (SELECT rid, unnest(range(1, len(w) + 1)) AS s FROM d),
key AS (SELECT pos.rid, pos.s, t.tid, t.label, t.base, t.tw, d.w
        FROM pos JOIN d USING (rid) JOIN t ON d.w[pos.s] = t.tw[1]
        WHERE d.w[pos.s : pos.s + t.n_key - 1] = t.tw[1 : t.n_key]),
cov AS (SELECT rid, s, tid, sum(CASE WHEN ok THEN v ELSE 0 END) / sum(v) AS cover
        FROM (SELECT rid, s, tid, unnest(tw) AS x,
                     unnest(list_transform(range(1, len(tw) + 1), lambda j: coalesce(w[s + j - 1] = tw[j], false))) AS ok
              FROM key) JOIN idf USING (x) GROUP BY ALL),
agg AS (SELECT rid, count(*) FILTER (WHERE base) AS n_base, min(s - 1) FILTER (WHERE base) AS first_word,
          max(s - 1) FILTER (WHERE base) AS last_word,
          string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
          string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(round(cover, 6)) AS score
        FROM key JOIN cov USING (rid, s, tid) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN agg USING (rid)
"""


OP4_SQL = _sql()
