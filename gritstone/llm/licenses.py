"""License scan: fixed phrases, and an exact set-similarity join of text blocks with license templates.

Words are the runs of digits, letters a to z and characters beyond ASCII, A to Z lower-cased. Blocks are lines and
paragraphs (maximal runs of lines that hold words). A template names the kind of block it is sought in; a block meets it if it holds at
least THRESHOLD of the template's different words, wherever they stand and whatever else the block holds.

Of each block only the words that some template has are kept. These are ordered by how many blocks of the corpus
hold them, the rarest first. A block and a template that meet share a word among their first ``size - need + 1``
words (prefix filter); the block must be long enough (length filter); and from the place of a shared word on enough words must be left
on both sides (positional filter). Pairs found so are verified on the whole sets, so nothing is missed and nothing else is found.
A template whose words are part of those of another one met by the same block is not reported for that block.

All steps are DataFrame functions. The text is read once: what is kept of it is written to the shared folder. Words of templates
are the only thing held in a plan or sent to the driver, and their number does not follow the data. Null texts count as empty, which have no labels and
score 0. Repeated rows each get their result; an empty table gives an empty one. Columns of the names in ADDED are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from math import ceil
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from gritstone.llm.store import stored

THRESHOLD = 0.95
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLANK = r"\n[\x00-\x2F\x3A-\x60\x7B-\x7F]*\n"
ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    label: str
    kind: str  # line or paragraph
    text: str

    @property
    def words(self) -> list[str]:
        return sorted({w for w in re.split(GAP, self.text.translate(str.maketrans(ascii_uppercase, ascii_lowercase))) if w})


#: Usual short notices, and standard paragraphs of well-known licenses.
TEMPLATES = [
    Template("apache-2.0", "line", "Licensed under the Apache License, Version 2.0"),
    Template("mit", "line", "Released under the MIT License"),
    Template("bsd", "line", "Released under the BSD License"),
    Template("gpl-2.0", "line", "licensed under the GNU General Public License, version 2"),
    Template("gpl-3.0", "line", "licensed under the GNU General Public License, version 3"),
    Template("lgpl-3.0", "line", "licensed under the GNU Lesser General Public License, version 3"),
    Template("agpl-3.0", "line", "licensed under the GNU Affero General Public License, version 3"),
    Template("mpl-2.0", "line", "subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by-4.0", "line", "Licensed under CC BY 4.0"),
    Template("cc-by-sa-4.0", "line", "Licensed under CC BY-SA 4.0"),
    Template("cc-by-nc-4.0", "line", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-nd-4.0", "line", "Licensed under CC BY-ND 4.0"),
    Template("cc-by-nc-sa-4.0", "line", "Licensed under CC BY-NC-SA 4.0"),
    Template("cc-by-nc-nd-4.0", "line", "Licensed under CC BY-NC-ND 4.0"),
    Template("cc0-1.0", "line", "Creative Commons Zero CC0 1.0 public domain dedication"),
    Template("mit", "paragraph", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions:"""),
    Template("isc", "paragraph", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    Template("bsd", "paragraph", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:"""),
    Template("apache-2.0", "paragraph", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at"""),
    Template("gpl", "paragraph", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""),
    Template("mpl-2.0", "paragraph", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at"""),
    Template("unlicense", "paragraph", "This is free and unencumbered software released into the public domain."),
]


def lowered(text: Column) -> Column:
    """A to Z in lower case. Other letters may change too, which no result shows, but none becomes an ASCII letter: the two that would are replaced."""
    text = F.coalesce(text, F.lit(""))
    for letter in ("\u212a", "\u0130"):
        text = F.replace(text, F.lit(letter), F.lit("\u0138"))
    return F.lower(text)


def _words_in(spaced: Column) -> Column:
    """Words of a part of a spaced text: each has a space on either side."""
    return ((F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("long")


def phrase_places(spaced: Column, n_words: Column, phrase: str) -> Column:
    """Struct (n, first, last) of the places of a phrase in `` w0  w1  w2 ``; null if it is not there."""
    needle = " " + phrase.replace(" ", "  ") + " "
    size = len(phrase.split())
    n = ((F.length(spaced) - F.length(F.replace(spaced, F.lit(needle), F.lit("")))) / len(needle)).cast("long")
    first = _words_in(F.substring_index(spaced, needle, 1))
    last = n_words - size - _words_in(F.substring_index(spaced, needle, -1))
    return F.when(spaced.contains(needle), F.struct(n.alias("n"), first.alias("first"), last.alias("last")))


def kept_words(blocks: Column, known: Column, least: int) -> Column:
    """Of each block the different words that are in ``known``, the text's template words, where they are enough for any template."""
    kept = F.filter(F.transform(blocks, lambda b: F.array_intersect(F.split(b, GAP), known)), lambda w: F.size(w) >= least)
    return F.when(F.size(known) >= least, kept).otherwise(F.array().cast("array<array<string>>"))


def needed(words: list[str], threshold: float) -> int:
    return ceil(threshold * len(words) - 1e-9)


def by_kind(templates: list[Template]) -> dict[str, list[Template]]:
    return {kind: [t for t in templates if t.kind == kind and t.words] for kind in ("line", "paragraph")}


def read_once(frame: DataFrame, text: str, keep: list[str], templates: list[Template], threshold: float) -> DataFrame:
    """row (id), kept (struct), n_words, places (one struct per phrase), line and paragraph (arrays of word arrays)."""
    kinds, low, spaced = by_kind(templates), F.col("low"), F.col("spaced")
    blocks = {"line": F.split(low, "\n"), "paragraph": F.split(low, BLANK)}
    known, found = {}, {}
    for kind, some in kinds.items():
        vocabulary = F.array(*[F.lit(w) for w in sorted({w for t in some for w in t.words})]).cast("array<string>")
        known[f"known_{kind}"] = F.array_intersect(F.split(F.trim(spaced), "  "), vocabulary)
        least = min((needed(t.words, threshold) for t in some), default=1)
        found[kind] = kept_words(blocks[kind], F.col(f"known_{kind}"), least)
    bare = F.trim(F.regexp_replace(low, GAP, "  "))
    return stored(
        frame.select(F.struct(*([F.col(f"`{c}`") for c in keep] or [F.lit(0).alias("none")])).alias("kept"),
                     lowered(F.col(f"`{text}`")).alias("low"))
        .withColumn("spaced", F.concat(F.lit(" "), bare, F.lit(" ")))
        .withColumn("n_words", F.when(spaced == "  ", F.lit(0).cast("long")).otherwise(_words_in(spaced)))
        .withColumns(known)
        .select(F.monotonically_increasing_id().alias("row"), "kept", "n_words",
                F.array(*[phrase_places(spaced, F.col("n_words"), p) for p in PHRASES]).alias("places"),
                *[words.alias(kind) for kind, words in found.items()]),
        "license-blocks")


def ordered_words(blocks: DataFrame, known: list[str]) -> list[str]:
    """The words of the templates, those in the fewest blocks first; ties by the word."""
    counts = {r["word"]: r["n"] for r in blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(known, key=lambda w: (counts.get(w, 0), w))  # at most as many rows as the templates have words


def met_templates(scanned: DataFrame, kind: str, templates: list[Template], threshold: float) -> DataFrame:
    """(row, block, label, template, containment) of every block of the kind that meets a template."""
    spark = scanned.sparkSession
    blocks = scanned.where(F.size(kind) > 0).select("row", F.posexplode(kind).alias("block", "words"))
    order = ordered_words(blocks, sorted({w for t in templates for w in t.words}))
    rank = {w: k for k, w in enumerate(order)}
    sides = []
    for number, t in enumerate(templates):
        words = sorted(t.words, key=rank.get)
        need = needed(words, threshold)
        covered = [k for k, other in enumerate(templates) if set(other.words) < set(words)]
        sides += [(number, t.label, words, covered, need, at, w) for at, w in enumerate(words[: len(words) - need + 1])]
    prefixes = stored(spark.createDataFrame(
        sides, "template int, label string, all array<string>, covered array<int>, need int, there int, word string"), "license-templates")
    least = min(needed(t.words, threshold) for t in templates)
    sorted_blocks = blocks.select("row", "block", F.array_intersect(F.array(*[F.lit(w) for w in order]), "words").alias("words"))
    probes = sorted_blocks.select("row", "block", "words", F.posexplode(F.slice("words", 1, F.size("words") - least + 1)).alias("here", "word"))
    left = F.least(F.size("words") - F.col("here"), F.size("all") - F.col("there"))  # this word and those after it
    pairs = probes.join(prefixes, "word").where((F.size("words") >= F.col("need")) & (left >= F.col("need")))
    shared = F.size(F.array_intersect("words", "all"))
    return (
        pairs.where(shared >= F.col("need"))
        .groupBy("row", "block", "template", "label", "covered").agg(F.max(shared / F.size("all")).alias("containment"))
    )


def reported(met: DataFrame) -> DataFrame:
    """(row, labels, score): the templates met by each row, less those that are part of another one met by the same block."""
    block = met.groupBy("row", "block").agg(
        F.collect_list(F.struct("template", "label", "containment")).alias("met"), F.flatten(F.collect_set("covered")).alias("part"))
    own = block.select("row", F.explode(F.filter("met", lambda m: ~F.array_contains("part", m["template"]))).alias("m"))
    return own.groupBy("row").agg(F.collect_set("m.label").alias("found"), F.max("m.containment").alias("best"))


def find_licenses(frame: DataFrame, text: str = "text", templates: list[Template] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Every row's columns but the text, with n_words, n_base, first_word, last_word, base_labels, labels and score.

    ``score`` is 1 where a phrase stands, else the largest containment among the templates met, else 0. Labels are sorted and
    joined by commas; ``base_labels`` come from the phrases, ``labels`` from both.
    """
    keep = [c for c in frame.columns if c != text and c.lower() not in ADDED]
    scanned = read_once(frame, text, keep, templates, threshold)
    met = [met_templates(scanned, kind, some, threshold) for kind, some in by_kind(templates).items() if some]
    base = F.filter(F.array(*[F.when(F.get("places", k).isNotNull(), F.lit(label)) for k, label in enumerate(PHRASES.values())]),
                    lambda label: label.isNotNull())
    rows = scanned.select("row", "kept", "n_words", "places", base.alias("base"))
    if met:
        found = reduce(DataFrame.unionAll, [reported(m) for m in met]).groupBy("row").agg(
            F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"), F.max("best").alias("best"))
        rows = rows.join(found, "row", "left")
    else:
        rows = rows.withColumns({"found": F.lit(None).cast("array<string>"), "best": F.lit(None).cast("double")})
    there = F.filter("places", lambda p: p.isNotNull())
    total = F.aggregate(there, F.lit(0).cast("long"), lambda n, p: n + p["n"])
    labels = F.array_sort(F.array_union("base", F.coalesce("found", F.array().cast("array<string>"))))
    return rows.select(
        *(["kept.*"] if keep else []), "n_words", total.alias("n_base"),
        F.array_min(F.transform(there, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(there, lambda p: p["last"])).alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(total > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def _sql_rows() -> str:
    quote = lambda w: "'" + w.replace("'", "''") + "'"
    return ", ".join(f"({k}, {quote(t.kind)}, {quote(t.label)}, [{', '.join(map(quote, t.words))}], {needed(t.words, THRESHOLD)})"
                     for k, t in enumerate(TEMPLATES))


_SQL_PHRASES = ", ".join(f"({p.split()!r}, '{label}')" for p, label in PHRASES.items())
ORACLE_SQL = rf"""
WITH tpl(id, kind, label, ws, need) AS (VALUES {_sql_rows()}), phr(ph, label) AS (VALUES {_SQL_PHRASES}),
d AS (SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}') AS low FROM documents),
w AS (SELECT rid, doc_id, list_filter(string_split_regex(low, '{GAP}'), lambda x: x <> '') AS ws FROM d),
spot AS (SELECT rid, label, i - 1 AS place FROM w, phr, unnest(range(1, len(ws) - len(ph) + 2)) t(i)
  WHERE list_has_all(ws, ph) AND list_slice(ws, i, i + len(ph) - 1) = ph),
base AS (SELECT rid, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list_distinct(list(label)) AS bl FROM spot GROUP BY rid),
b AS (SELECT rid, 'line' AS kind, unnest(string_split(low, chr(10))) AS t FROM d
  UNION ALL SELECT rid, 'paragraph', unnest(string_split_regex(low, '{BLANK}')) FROM d),
k AS (SELECT row_number() OVER () AS bid, rid, kind, list_distinct(string_split_regex(t, '{GAP}')) AS bw FROM b),
m AS (SELECT bid, rid, id, label, tpl.ws AS ws, len(list_intersect(tpl.ws, bw)) / len(tpl.ws) AS c
  FROM k JOIN tpl USING (kind) WHERE len(list_intersect(tpl.ws, bw)) >= need),
o AS (SELECT * FROM m WHERE NOT EXISTS (FROM m x WHERE x.bid = m.bid AND len(x.ws) > len(m.ws) AND list_has_all(x.ws, m.ws))),
f AS (SELECT rid, list_distinct(list(label)) AS fl, max(c) AS best FROM o GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(bl), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bl, []), coalesce(fl, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN base USING (rid) LEFT JOIN f USING (rid)
"""
