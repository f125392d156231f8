"""Licence recognition by sentences and rules.

A text is normalised and cut into pieces where a sentence may end or a line break.
Joins of neighbouring pieces that have the length of a known sentence are looked up in
one map from sentences to identifiers, so sentences are known however their lines are
wrapped, and the work does not grow with how many are known. The rest is cut into
sentences, and the sequence of identifiers is matched against ordered rules. A rule
uses up the identifiers it matches. Expressions only, and no shuffle: the tables are
small and fixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import LOWER, UPPER, Names

# Known licence sentences in normal form, as their licences state
# them, each with its identifier.
SENTENCES = {
    "licensed under the apache license version 2.0": "Apache2Ref",
    "licensed under the apache license version 2.0 the license": "Apache2Ref",
    "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license": "Apache2Grant",
    "you may not use this file except in compliance with the license": "Apache2Comply",
    "you may obtain a copy of the license at http www.apache.org licenses license-2.0": "Apache2Copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "Apache2AsIs",
    "see the license for the specific language governing permissions and limitations under the license": "Apache2See",
    "released under the mit license": "MitRef",
    "licensed under the mit license": "MitRef",
    "this project is licensed under the mit license": "MitRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MitPermit",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MitAsIs",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BsdEndorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BsdAsIs",
    "this work is licensed under the gnu general public license version 3": "Gpl3Ref",
    "licensed under the gnu general public license version 3": "Gpl3Ref",
    "licensed under the gnu general public license version 2": "Gpl2Ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Gpl3Later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "Gpl2Later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GplNoWarranty",
    "see the gnu general public license for more details": "GplDetails",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "Mpl2Ref",
    "licensed under cc by 4.0": "CcByRef",
    "licensed under cc by-sa 4.0": "CcBySaRef",
    "licensed under cc by-nc 4.0": "CcByNcRef",
    "this work is licensed under a creative commons attribution 4.0 international license": "CcByRef",
    "this is free and unencumbered software released into the public domain": "UnlicenseRef",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "IscPermit",
    "spdx-license-identifier apache-2.0": "Apache2Ref",
    "spdx-license-identifier mit": "MitRef",
    "spdx-license-identifier gpl-3.0-only": "Gpl3Ref",
}

# Licence and the sequence of identifiers that states it; the first
# rules are tried first and use up what they match.
RULES = [
    ("Apache-2.0", "Apache2Ref Apache2Comply Apache2Copy Apache2AsIs Apache2See"),
    ("Apache-2.0", "Apache2Grant Apache2Copy Apache2AsIs Apache2See"),
    ("BSD-3-Clause", "BsdGrant BsdSource BsdBinary BsdEndorse BsdAsIs"),
    ("BSD-2-Clause", "BsdGrant BsdSource BsdBinary BsdAsIs"),
    ("MIT", "MitPermit MitNotice MitAsIs"),
    ("GPL-3.0-or-later", "Gpl3Later GplNoWarranty GplDetails"),
    ("GPL-2.0-or-later", "Gpl2Later GplNoWarranty GplDetails"),
    ("GPL-3.0-or-later", "Gpl3Later"),
    ("GPL-2.0-or-later", "Gpl2Later"),
    ("ISC", "IscPermit"),
    ("Apache-2.0", "Apache2Ref"),
    ("MIT", "MitRef"),
    ("GPL-3.0-only", "Gpl3Ref"),
    ("GPL-2.0-only", "Gpl2Ref"),
    ("MPL-2.0", "Mpl2Ref"),
    ("CC-BY-4.0", "CcByRef"),
    ("CC-BY-SA-4.0", "CcBySaRef"),
    ("CC-BY-NC-4.0", "CcByNcRef"),
    ("Unlicense", "UnlicenseRef"),
]

# A sentence with one of these may speak of a licence.
CUE = "licens|copyright|warrant|redistribut|permission|public domain|free software"
UNKNOWN = "?"
# A sentence goes on in the next line if that begins with a small letter.
WRAPPED = r"\r?\n[ \t]*(?:[#*/;]+[ \t]*)?([a-z(])"
EDGES = r"^[ .-]+|[ .-]+$"

# A known sentence may go on over any line break and over ';' and ':'. Marks stand
# for them until the known sentences are found: a break after which the sentence
# goes on in unknown text, one that ends it there, and a ':' within a line.
ON, END, COLON = "\x01", "\x02", "\x03"
MARKS = ON + END + COLON
LINES = [
    (f"[{MARKS}]", " "),
    (WRAPPED, f"{ON}$1"),
    (r"\r?\n[ \t]*(?:(?:[#*/;%]+|--+)[ \t]*)?", END),
    (rf"([{ON}{END}]\(?[0-9a-zA-Z]{{1,2}}\))[ \t]+", f"$1{ON}"),
    (rf"([.!?])[ \t{ON}{END}]+", "$1\n"),
    (rf";[ \t{ON}{END}]+", END),
    (r":[ \t]+", COLON),
]
KEPT_NOISE = rf"[^a-z0-9.\n{MARKS}-]+"
# What lies between two pieces, and what of it a sentence may go on across.
BETWEEN = rf"[ .\n{MARKS}-]*[\n{MARKS}][ .\n{MARKS}-]*"
GAP = f"[ {MARKS}]+"
LENGTHS = sorted({len(sentence) for sentence in SENTENCES})
MOST_PIECES = max(len(sentence.split()) for sentence in SENTENCES)


def marked(text: Column) -> Column:
    """Text in small letters, with the marks and with a line end after a sentence."""
    for pattern, new in LINES:
        text = F.regexp_replace(text, pattern, new)
    return F.regexp_replace(F.translate(text, UPPER, LOWER), KEPT_NOISE, " ")


def gaps(text: Column) -> Column:
    """What lies before and after each piece of a marked text."""
    return F.concat(F.array(F.lit(END)), F.regexp_extract_all(text, F.lit(BETWEEN), F.lit(0)), F.array(F.lit(END)))


def pieces(text: Column, between: Column) -> Column:
    """The pieces of a marked text with its gaps, as structs: ``plain`` without the blanks, dots and
    dashes around it, what comes ``after`` it, whether a sentence may go on from the
    piece before (``joins``), and whether one may begin here (``opens``)."""

    def piece(part: Column, i: Column) -> Column:
        plain = F.regexp_replace(F.regexp_replace(part, EDGES, ""), " +", " ")
        gap = F.get(between, i)
        return F.struct(
            plain.alias("plain"), F.get(between, i + 1).alias("after"), gap.rlike(f"^{GAP}$").alias("joins"), gap.rlike(f"[\n{ON}{END}]").alias("opens")
        )

    return F.transform(F.split(text, BETWEEN), piece)


def known_places(cut: Column) -> Column:
    """Known sentences among the pieces, as structs (size, first, n, id), longest first.
    From each piece on the next ones are counted together, as many as the words of the
    longest known sentence; only joins of a known length are put together."""
    table = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    lengths = F.array(*[F.lit(n) for n in LENGTHS])
    start = F.struct(F.lit(-1).alias("size"), F.lit(0).alias("n"), F.lit(True).alias("live"), F.array().cast("array<struct<size:int,n:int>>").alias("hits"))

    def further(held: Column, piece: Column) -> Column:
        size, n = held["size"] + 1 + F.length(piece["plain"]), held["n"] + 1
        live = held["live"] & ((held["n"] == 0) | piece["joins"]) & (held["size"] < LENGTHS[-1])
        hit = F.array(F.struct(size.alias("size"), n.alias("n")))
        return F.struct(
            size.alias("size"), n.alias("n"), live.alias("live"),
            F.when(live & F.array_contains(lengths, size), F.concat(held["hits"], hit)).otherwise(held["hits"]).alias("hits"),
        )

    def starting(i: Column) -> Column:
        hits = F.aggregate(F.slice(cut, i + 1, F.lit(MOST_PIECES)), start, further)["hits"]

        def looked_up(hit: Column) -> Column:
            joined = F.array_join(F.transform(F.slice(cut, i + 1, hit["n"]), lambda x: x["plain"]), " ")
            return F.struct(hit["size"].alias("size"), i.alias("first"), hit["n"].alias("n"), F.try_element_at(table, joined).alias("id"))

        return F.filter(F.transform(hits, looked_up), lambda c: c["id"].isNotNull())

    found = F.flatten(F.transform(cut, lambda piece, i: F.when(piece["plain"] != "", starting(i)).otherwise(F.array().cast(PLACES))))
    # Of equally long ones the first in the text comes first.
    order = lambda a, b: F.when(a["size"] != b["size"], b["size"] - a["size"]).otherwise(a["first"] - b["first"])
    return F.array_sort(found, order)


PLACES = "array<struct<size:int,first:int,n:int,id:string>>"


def taken_places(cut: Column, places: Column) -> Column:
    """Of the known sentences, longer ones first, those that leave each other room. One
    that begins within a line counts if it follows on another."""

    def taken(held: Column, c: Column) -> Column:
        clash = F.exists(held, lambda a: (c["first"] < a["first"] + a["n"]) & (a["first"] < c["first"] + c["n"]))
        opens = F.get(cut, c["first"])["opens"] | F.exists(held, lambda a: a["first"] + a["n"] == c["first"])
        return F.when(~clash & opens, F.concat(held, F.array(c))).otherwise(held)

    return F.aggregate(places, F.array().cast(PLACES), taken)


def named(cut: Column, held: Column) -> Column:
    """Text again, with ``<identifier>`` on a line of its own for each known sentence."""

    def written(piece: Column, i: Column) -> Column:
        own = F.filter(held, lambda a: (a["first"] <= i) & (i < a["first"] + a["n"]))
        name = F.when(F.get(own, F.lit(0))["first"] == i, F.concat(F.lit("\n<"), F.get(own, F.lit(0))["id"], F.lit(">\n"))).otherwise("")
        return F.when(F.size(own) > 0, name).otherwise(F.concat(piece["plain"], piece["after"]))

    return F.array_join(F.transform(cut, written), "")


def identifiers(text: Column) -> Column:
    """Identifiers of the sentences that speak of a licence, in order, from text with
    the known ones named: ``?`` for any other."""
    known = F.lit("<")
    cut = F.split(F.translate(text, END + ON + COLON, "\n  "), "\n")
    cues = F.filter(cut, lambda s: s.startswith(known) | s.rlike(CUE) & ~s.rlike("^[ .-]*copyright"))
    return F.transform(cues, lambda s: F.when(s.startswith(known), F.translate(s, "<>", "")).otherwise(F.lit(UNKNOWN)))


def token(name: str) -> str:
    return f"<{name}>"


def scanned(docs: DataFrame) -> DataFrame:
    """Documents with four columns added (columns of these names are replaced):

    - ``licenses``: licences found, in the order of the rules, comma-joined;
    - ``sentence_ids``: the identifiers in order, space-joined, ``?`` for a
      sentence that speaks of a licence but is not known;
    - ``n_unknown``: how many identifiers no rule has used up, ``?`` included;
    - ``status``: ``licensed``, ``unknown`` (only such sentences) or ``none``.

    A null or empty text has none. A text without any cue is not cut up at all.
    """
    has_cue = F.col("text").rlike(f"(?i){CUE}")
    rows = docs.drop("licenses", "sentence_ids", "n_unknown", "status")
    taken = Names(rows, "licenses", "sentence_ids", "n_unknown", "status")
    plain, between, cut, places, ids, *left = taken.new("plain", "between", "cut", "places", "ids", *[f"left{i}" for i in range(len(RULES) + 1)])
    # Each step is a column of its own: within a function over an array, an expression
    # would be computed again for each element.
    steps = {
        between: lambda: gaps(F.col(plain)),
        cut: lambda: pieces(F.col(plain), F.col(between)),
        places: lambda: known_places(F.col(cut)),
    }
    rows = rows.withColumn(plain, F.when(has_cue, marked(F.col("text"))))
    for name, step in steps.items():
        rows = rows.withColumn(name, F.when(F.col(plain).isNotNull(), step()))
    rows = rows.withColumn(places, taken_places(F.col(cut), F.col(places)))
    named_ids = F.when(F.col(plain).isNotNull(), identifiers(named(F.col(cut), F.col(places))))
    rows = rows.withColumn(ids, F.coalesce(named_ids, F.array().cast("array<string>")))
    rows = rows.withColumn(left[0], F.array_join(F.transform(ids, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), ""))
    found = []
    for (license_id, sequence), before, after in zip(RULES, left, left[1:]):
        needle = F.lit("".join(map(token, sequence.split())))
        found.append(F.when(F.contains(F.col(before), needle), F.lit(license_id)))
        rows = rows.withColumn(after, F.replace(F.col(before), needle, F.lit("|")))
    # What is used up leaves a bar, so that its neighbours don't become one.
    names = F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull()))
    rest = F.regexp_count(left[-1], F.lit("<")).cast("long")
    rows = rows.withColumns({"licenses": F.array_join(names, ","), "sentence_ids": F.array_join(ids, " "), "n_unknown": rest})
    status = F.when(F.col("licenses") != "", "licensed").when(F.col("n_unknown") > 0, "unknown").otherwise("none")
    return rows.withColumn("status", status).drop(plain, between, cut, places, ids, *left)
