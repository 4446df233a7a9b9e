"""License scans by a positional index of rare tokens. DataFrame functions only.

Templates are word sequences: the notices by which licences are granted, and short licence phrases. Each has mandatory
key phrases, with their places in it. IDF comes from the document counts of all template words over the
whole table. The index holds, for each template, postings (template, position) of its words of highest IDF.

A file's words that are in the index are, by that choice, its licence words of highest IDF. Each of their
occurrences is looked up, and every posting gives the place where its template would start; sorted,
places on which two postings agree lie side by side (one posting is enough for a template with a single rare word).
There the mandatory phrases are verified word by word. All of it happens within the row, so there is no shuffle and nothing
depends on how many files share a phrase; the work is in proportion to the file's words and postings.
The count of documents has one row for each template word.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column

#: What stands between words, after lower-casing.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases and labels that the contract fixes.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Further phrases, each sufficient for its label.
MORE = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license version 2 0": "apache-2.0",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "isc license": "isc",
}
_GNU = "program is free software you can redistribute it and or modify it under the terms of the gnu {} as published by the free software foundation either version {} of the license or at your option any later version"
#: Notices of licences, in words as files have them after lower-casing: text, label, mandatory phrases.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so", "mit", ["permission is hereby granted free of charge", "to deal in the software without restriction"]),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "bsd", ["redistribution and use in source and binary forms", "are permitted provided that the following conditions are met"]),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2.0", ["apache license version 2 0", "except in compliance with the license"]),
    (_GNU.format("general public license", 2), "gpl-2", ["under the terms of the gnu general public license", "either version 2 of the license"]),
    (_GNU.format("general public license", 3), "gpl-3", ["under the terms of the gnu general public license", "either version 3 of the license"]),
    (_GNU.format("affero general public license", 3), "agpl", ["under the terms of the gnu affero general public license"]),
    ("library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "lgpl", ["under the terms of the gnu lesser general public license"]),
    ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", "mpl", ["subject to the terms of the mozilla public license"]),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "isc", ["permission to use copy modify and or distribute this software for any purpose", "this permission notice appear in all copies"]),
    ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "bsl", ["to any person or organization obtaining a copy", "covered by this license"]),
    ("this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose", "zlib", ["without any express or implied warranty", "permission is granted to anyone to use this software for any purpose"]),
    ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", "unlicense", ["free and unencumbered software released into the public domain"]),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by", ["licensed under a creative commons attribution 4 0 international license"]),
]
#: Index words of a template: at most so many, of at least this part of the highest IDF among its words.
INDEXED, RARE = 4, 0.5
#: A vote is template * SPAN + start.
SPAN = 1 << 40


def words_of(text: str = "text") -> Column:
    lower = F.translate(F.coalesce(column(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, GAP), "")  # an empty string stands before a leading gap and after a trailing one


def literal(values, kind: str = "string") -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def idf_of(docs: DataFrame, text_col: str, vocabulary: list[str]) -> dict[str, float]:
    """IDF of each template word over all documents. The result has a row for each template word at most."""
    found = docs.select(F.explode(F.array_intersect(words_of(text_col), literal(vocabulary))).alias("w")).groupBy("w").count().collect()
    n, df = docs.count() if found else 1, {r["w"]: r["count"] for r in found}
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1 for w in vocabulary}


class Template:
    def __init__(self, text: str, label: str, must: Iterable[str] = (), base: bool = False):
        self.words, self.label, self.base = text.split(" "), label, base
        self.must = []
        for phrase in must or [text]:
            w = phrase.split(" ")
            self.must.append((next(i for i in range(len(self.words)) if self.words[i : i + len(w)] == w), w))

    def rare(self, idf: dict[str, float]) -> list[str]:
        """Its index words."""
        best = sorted(set(self.words), key=lambda w: (-idf[w], w))
        return [w for w in best[:INDEXED] if idf[w] >= RARE * idf[best[0]]]


TEMPLATES = [*(Template(p, label, base=True) for p, label in BASE.items()), *(Template(p, label) for p, label in MORE.items()), *(Template(*x) for x in NOTICES)]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[Template] = TEMPLATES) -> DataFrame:
    """One row for each row of docs: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of base phrases; labels has the base labels and those of further templates.
    score: the largest share, by IDF, of a template's words that stand in their places, over all places on
    which its postings agree; 1 where a template's mandatory phrases are there, 0 where none is near.

    * A null or empty text has no words: counts 0, places null, labels empty, score 0. Texts of any length are scanned whole.
    * Rows are scanned one by one: repeated rows give equal results, ids may be null, an empty table gives none.
    * Only the id and the text are read; other columns don't matter.
    """
    idf = idf_of(docs, text_col, sorted({w for t in templates for w in t.words}))
    postings: dict[str, list[int]] = {}  # as votes of an occurrence at place 0
    for k, t in enumerate(templates):
        rare = t.rare(idf)
        for i, w in enumerate(t.words):
            if w in rare:
                postings.setdefault(w, []).append(k * SPAN - i)
    index = F.create_map(*[x for w, p in sorted(postings.items()) for x in (F.lit(w), literal(p, "bigint"))])
    needed = literal([min(2, len(t.rare(idf))) for t in templates], "int")
    one = lambda t: F.struct(literal(t.words).alias("words"), literal([idf[w] for w in t.words], "double").alias("idf"), F.array(*[F.struct(F.lit(i).alias("at"), literal(w).alias("words")) for i, w in t.must]).alias("must"))
    about = F.array(*[one(t) for t in templates])

    rows = docs.select(column(id_col).alias("doc_id"), words_of(text_col).alias("words"))
    rare_words = sorted(postings)
    places = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("p"), w.alias("w"))), lambda x: x["w"].isin(rare_words))
    votes = F.flatten(F.transform(places, lambda x: F.filter(F.transform(index[x["w"]], lambda y: y + x["p"]), lambda v: F.pmod(v, F.lit(SPAN)) < F.lit(SPAN // 2))))  # a start before the text's first word is left out
    near = F.arrays_overlap("words", literal(rare_words))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), F.when(near, F.col("words")).alias("words"), F.when(near, F.array_sort(votes)).alias("votes"))

    def agreed(v: Column, i: Column) -> Column:
        """True at the first vote of a place, or the second, whichever is enough for its template."""
        last, second = F.get("votes", i - 1).eqNullSafe(v), F.get("votes", i - 2).eqNullSafe(v)
        return F.when(F.element_at(needed, (F.floor(v / SPAN) + 1).cast("int")) == 1, ~last).otherwise(last & ~second)

    def checked(v: Column) -> Column:
        k, start = F.floor(v / SPAN).cast("int"), F.pmod(v, F.lit(SPAN)).cast("int")
        t = F.element_at(about, k + 1)
        same = F.zip_with(t["words"], F.slice("words", start + 1, F.size(t["words"])), lambda a, b: a.eqNullSafe(b))
        share = F.aggregate(F.zip_with(same, t["idf"], lambda e, x: F.when(e, x).otherwise(0.0)), F.lit(0.0), lambda a, b: a + b) / F.aggregate(t["idf"], F.lit(0.0), lambda a, b: a + b)
        ok = F.forall(t["must"], lambda m: F.slice("words", start + m["at"] + 1, F.size(m["words"])) == m["words"])
        return F.struct(k.alias("k"), start.alias("start"), ok.alias("ok"), share.alias("share"))

    empty = F.array().cast("array<struct<k:int,start:int,ok:boolean,share:double>>")
    rows = rows.select("doc_id", "n_words", F.coalesce(F.transform(F.filter("votes", agreed), checked), empty).alias("places"))
    full = F.filter("places", lambda x: x["ok"])
    bases = [k for k, t in enumerate(templates) if t.base]
    rows = rows.select("doc_id", "n_words", F.array_distinct(F.transform(full, lambda x: x["k"])).alias("kinds"), F.transform(F.filter(full, lambda x: x["k"].isin(bases)), lambda x: x["start"]).alias("base"), F.array_max(F.transform("places", lambda x: x["share"])).alias("share"))
    names = literal([t.label for t in templates])
    label = lambda kinds: F.array_join(F.array_sort(F.array_distinct(F.transform(kinds, lambda k: F.element_at(names, k + 1)))), ",")
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"),
        F.array_max("base").cast("long").alias("last_word"),
        label(F.filter("kinds", lambda k: k.isin(bases))).alias("base_labels"),
        label(F.col("kinds")).alias("labels"),
        F.when(F.size("kinds") > 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.coalesce("share", F.lit(0.0)))).alias("score"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
