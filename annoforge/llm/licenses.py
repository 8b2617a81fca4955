"""License notices in texts, by an exact set-similarity join of text blocks with notice templates.

Words are lower-cased runs of ASCII letters, digits and characters beyond ASCII. A template of k words belongs to the
stride of the least power of two that is k or more; block b of a stride s is the words from b * s to (b + 2) * s of a
text, so that every stretch of up to s words lies whole in a block. A template is found in a block that holds at least
THRESHOLD per cent of its different words; it gives way where a found template with all its words and more overlaps it.

The join: words of templates are ordered by how often all documents hold them, rarest first. A block that holds
alpha of a template's m words shares with it one of its m - alpha + 1 rarest, and one of the block's own b - alpha + 1
rarest (prefix filter); it has alpha words at least (length filter); and its first shared word leaves alpha words in
both (positional filter). Pairs that pass are verified on the full sets. Only blocks around a template's rare words
are ever made, and only of words that some template of the stride has.

Templates are an argument, not data: they do not grow with the corpus, and go to the workers once. Texts are read in
slices and held as one 32-bit code a word.

Results: a null or empty text has no words, no labels and score 0. Each input row gives one output row, whatever its
id; other columns are left out. Repeated rows and ties do not matter: a text is looked at by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from annoforge.llm import pieces
from annoforge.llm.shared import bounded_batches, cut, named, scope, small, table, tidy

#: Per cent of a template's words that a block must hold; words of the shortest stride; bytes split at a time.
THRESHOLD, LEAST_STRIDE, SLICE_BYTES = 90, 8, 1 << 20
#: Phrases and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Public license notices and statements, by label.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


@cache
def _kept_bytes() -> np.ndarray:
    """Bytes of words by their lower case, all else 0."""
    out = np.zeros(256, np.uint8)
    for b in range(256):
        c = chr(b).lower() if b < 0x80 else ""
        out[b] = b if b >= 0x80 else ord(c) if c.isalnum() else 0
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the words, each word's start in them, each text's first word."""
    low = _kept_bytes()[data]
    inside = low > 0
    start = inside.copy()
    start[1:] &= ~inside[:-1] | pieces.text_starts(len(data), offsets)[1:]
    counted = np.concatenate([[0], np.cumsum(start, dtype=np.int32)])
    return low[inside], np.flatnonzero(start[inside]), counted[offsets]


def split(text: str) -> list[str]:
    """Words of one short text."""
    data = np.frombuffer(text.encode(), np.uint8)
    kept, at, _ = words(data, np.array([0, len(data)]))
    return [w.tobytes().decode() for w in np.split(kept, at[1:])] if len(at) else []


class Library:
    """Templates and phrases as codes of their words."""

    def __init__(self, templates: list[tuple[str, str]], phrases: list[tuple[str, str]], threshold: int):
        if not 0 < threshold <= 100:
            raise ValueError("threshold must be over 0 and at most 100 per cent")
        self.texts = [split(t) for _, t in templates]
        self.labels = [label for label, _ in templates]
        self.sets = [sorted(set(t)) for t in self.texts]
        if not all(self.sets):
            raise ValueError("a template holds no word")
        self.alphas = [(len(s) * threshold + 99) // 100 for s in self.sets]
        self.strides = [max(LEAST_STRIDE, 1 << (len(t) - 1).bit_length()) for t in self.texts]
        self.phrases = [(split(p), label) for p, label in phrases]
        self.codes = {w: i for i, w in enumerate(sorted({w for t in [*self.sets, *(p for p, _ in self.phrases)] for w in t}))}

    def order(self, counts: dict[int, int]) -> None:
        """Place words by how often documents hold them; then prefixes of templates are known."""
        by_count = sorted(self.codes.values(), key=lambda c: (counts.get(c, 0), c))
        self.rank = np.zeros(len(by_count), np.int32)
        self.rank[by_count] = np.arange(len(by_count))
        self.ordered = [sorted(int(self.rank[self.codes[w]]) for w in s) for s in self.sets]
        self.rare = {s: np.zeros(len(self.rank) + 1, bool) for s in set(self.strides)}  # the last place stands for other words
        self.own = {s: np.zeros(len(self.rank) + 1, bool) for s in set(self.strides)}
        for ranks, a, s in zip(self.ordered, self.alphas, self.strides, strict=True):
            self.rare[s][ranks[: len(ranks) - a + 1]] = True
            self.own[s][ranks] = True
        self.least = {s: min(a for a, t in zip(self.alphas, self.strides, strict=True) if t == s) for s in set(self.strides)}

    def template_rows(self) -> list[tuple]:
        """(template, label, stride, alpha, words, templates that it gives way to)."""
        over = [[j for j, t in enumerate(self.sets) if set(s) < set(t)] for s in self.sets]
        return [(i, *x) for i, x in enumerate(zip(self.labels, self.strides, self.alphas, self.ordered, over, strict=True))]


TEMPLATE_SCHEMA = "template int, label string, stride int, alpha int, ranks array<int>, over array<int>"


class Reader:
    """Codes of the words of texts, by a library; -1: in no template and no phrase."""

    def __init__(self, library: Library):
        self.library = library
        self.known = {w.encode(): c for w, c in library.codes.items()}

    def codes(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the bounds of each text's words."""
        data, offsets = pieces.utf8(column)
        out, n = [], np.zeros(len(column), np.int64)
        for text, begin, own in pieces.slices(data, offsets, SLICE_BYTES):
            kept, at, bounds = words(data[begin : begin + int(own[-1])], own)
            n[text : text + len(bounds) - 1] += np.diff(bounds)
            if len(at):
                which, distinct = pieces.distinct_pieces(kept, at, pa.large_binary())
                out.append(np.array([self.known.get(w, -1) for w in distinct.to_pylist()], np.int32)[which])
        return np.concatenate(out) if out else np.zeros(0, np.int32), np.concatenate([[0], np.cumsum(n)])

    def phrase_places(self, codes: np.ndarray) -> list[np.ndarray]:
        """Word numbers where each phrase starts."""
        found = []
        for phrase, _ in self.library.phrases:
            own = [self.library.codes[w] for w in phrase]
            at = np.flatnonzero(codes == own[0])
            for k, c in enumerate(own[1:], 1):
                at = at[at + k < len(codes)]
                at = at[codes[at + k] == c]
            found.append(at)
        return found

    def blocks(self, codes: np.ndarray) -> list[dict]:
        """Blocks of one text around rare words of templates: stride, block, and the ranks of its words in order."""
        library, out = self.library, []
        ranks = np.append(library.rank, len(library.rank))[codes]  # -1 reads the last place
        for s, rare in library.rare.items():
            at = np.flatnonzero(rare[ranks])
            own = library.own[s]
            for b in np.unique(np.concatenate([at // s, at // s - 1])).tolist():
                if b >= 0:
                    held = np.unique(ranks[b * s : (b + 2) * s])
                    held = held[own[held]]
                    if len(held) >= library.least[s]:
                        out.append({"stride": s, "block": b, "ranks": held.tolist()})
        return out


def word_counts(docs: DataFrame, library: Library, text_col: str) -> dict[int, int]:
    """How often all texts hold each word of the library."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, total = Reader(library), np.zeros(len(library.codes), np.int64)
        for batch in batches:
            codes, _ = reader.codes(batch.column(0))
            total += np.bincount(codes[codes >= 0], minlength=len(total))
            tidy()
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["code", "n"])

    return dict(map(tuple, docs.select(named(text_col)).mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n")).collect()))


def read(docs: DataFrame, library: Library, id_col: str, text_col: str) -> DataFrame:
    """(key, id, n_words, n_base, first_word, last_word, base, blocks): one row per row of docs, whose key is its own."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = "key bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base array<string>, blocks array<struct<stride:int,block:bigint,ranks:array<int>>>"
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, key = Reader(library), TaskContext.get().partitionId() << 36
        for batch in batches:
            codes, bounds = reader.codes(batch.column(1))
            rows = []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                part = codes[lo:hi]
                row = {"key": key, "n_words": hi - lo, "n_base": 0, "base": [], "blocks": []}
                key += 1
                if (part >= 0).any():
                    places = reader.phrase_places(part)
                    starts = np.concatenate(places)
                    if len(starts):
                        row |= {"n_base": len(starts), "first_word": int(starts.min()), "last_word": int(starts.max()), "base": sorted({label for at, (_, label) in zip(places, library.phrases, strict=True) if len(at)})}
                    row["blocks"] = reader.blocks(part)
                rows.append(row)
            if rows:
                out = pa.RecordBatch.from_pylist(rows, kinds)
                yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], ["id", *kinds.names])
            tidy()

    return docs.select(named(id_col), named(text_col)).mapInArrow(run, f"id {kind}, {schema}")


def joined(blocks: DataFrame, templates: DataFrame) -> DataFrame:
    """(key, template, label, from, to, over, containment) of blocks (key, stride, block, ranks) that hold a template."""
    m, b = F.size("ranks"), F.size("held")
    prefix = templates.select("template", "stride", "alpha", m.alias("m"), F.posexplode(F.slice("ranks", F.lit(1), m - F.col("alpha") + 1)).alias("i", "rank"))
    prefix = small(prefix, F.lit(24))
    at = blocks.select("key", "stride", "block", F.col("ranks").alias("held"), F.posexplode("ranks").alias("j", "rank"))
    met = at.join(prefix, ["stride", "rank"]).where((b >= F.col("alpha")) & (F.col("j") <= b - F.col("alpha")))
    first = met.groupBy("key", "stride", "block", "template", "alpha", "m", "held").agg(F.min("i").alias("i"), F.min("j").alias("j"))
    likely = first.where(F.least(F.col("m") - F.col("i"), b - F.col("j")) >= F.col("alpha"))
    full = small(templates.select("template", "label", "ranks", "over"), 4 * m + 4 * F.size("over") + 24)
    shared = F.size(F.array_intersect("held", "ranks"))
    found = likely.join(full, "template").withColumn("shared", shared).where("shared >= alpha")
    begin = F.col("block") * F.col("stride")
    return found.select("key", "template", "label", begin.alias("from"), (begin + 2 * F.col("stride")).alias("to"), "over", (F.col("shared") / F.col("m")).alias("containment"))


def standing(hits: DataFrame, unit: int) -> DataFrame:
    """hits without those that give way: a hit of a template in their `over` overlaps them. Hits meet in units of
    words that are as long as the longest block, so that no text's hits meet all of each other."""
    near = hits.withColumn("unit", F.explode(F.sequence(F.floor(F.col("from") / unit), F.floor((F.col("to") - 1) / unit))))
    wider = near.select("key", "unit", "template", F.col("from").alias("other_from"), F.col("to").alias("other_to"))
    asked = near.select("key", "unit", "from", F.col("template").alias("own"), "to", F.explode("over").alias("template"))
    beaten = asked.join(wider, ["key", "unit", "template"]).where("other_from < to and from < other_to").select("key", "from", F.col("own").alias("template")).distinct()
    return hits.join(beaten, ["key", "from", "template"], "left_anti")


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the id, n_words, places of phrases (n_base, first_word, last_word), base_labels, labels
    of phrases and templates, score (1 with a phrase, else the greatest containment), and notices: the blocks found as
    (label, from, to, containment) in words."""
    bounded_batches(docs.sparkSession)
    library = Library(templates, phrases, threshold)
    library.order(word_counts(docs, library, text_col))
    with scope() as held:
        rows = held.keep(cut(read(docs, library, id_col, text_col), "license-rows"))
        known = docs.sparkSession.createDataFrame(library.template_rows(), TEMPLATE_SCHEMA)
        hits = cut(joined(rows.select("key", F.inline("blocks")), known), "license-hits")
        notice = F.struct("label", F.col("from"), F.col("to"), "containment")
        told = standing(hits, 2 * max(library.strides)).groupBy("key").agg(F.array_sort(F.collect_set(notice)).alias("notices"))
        found = held.keep(cut(told, "license-notices"))
    out = rows.join(found, "key", "left").withColumn("notices", F.coalesce("notices", F.array().cast(found.schema["notices"].dataType)))
    labels = F.array_sort(F.array_union("base", F.transform("notices", lambda h: h["label"])))
    last_word = F.col("n_words")
    notices = F.transform("notices", lambda h: h.withField("to", F.least(h["to"], last_word)))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("notices", lambda h: h["containment"])), F.lit(0.0)))
    return out.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"), notices.alias("notices"))


def op13_licenses(spark, sf_dir: str) -> DataFrame:
    """License phrases and notices of every text of documents."""
    return scan_licenses(table(spark, sf_dir, "documents")).drop("notices")


def oracle() -> str:
    """The same by counting the words of every template in every block."""
    library = Library(TEMPLATES, PHRASES, THRESHOLD)
    q = lambda s: "'" + s + "'"
    held = ", ".join(f"({i}, {q(label)}, {s}, {a}, {len(ws)}, [{', '.join(map(q, ws))}], {[j for j, t in enumerate(library.sets) if set(ws) < set(t)]}::INT[])" for i, (label, s, a, ws) in enumerate(zip(library.labels, library.strides, library.alphas, library.sets, strict=True)))
    phrases = ", ".join(f"({q(label)}, [{', '.join(map(q, p))}])" for p, label in library.phrases)
    return rf"""
WITH t(id, label, s, alpha, m, ws, over) AS (VALUES {held}),
p(label, ws) AS (VALUES {phrases}),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
e AS (SELECT doc_id, unnest(w) AS x, unnest(range(len(w))) AS pos FROM w),
base AS (SELECT doc_id, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list(DISTINCT label) AS labels FROM (
  SELECT e.doc_id, e.pos, p.label FROM e JOIN p ON p.ws[1] = e.x JOIN w ON w.doc_id = e.doc_id WHERE list_slice(w.w, e.pos + 1, e.pos + len(p.ws)) = p.ws) GROUP BY doc_id),
tw AS (SELECT id, s, alpha, m, label, over, unnest(ws) AS x FROM t),
b AS (SELECT e.doc_id, tw.id, tw.label, tw.s, tw.over, pos // s - d AS block, count(DISTINCT e.x) AS n, any_value(m) AS m FROM e JOIN tw ON tw.x = e.x, range(2) r(d) WHERE pos // s - d >= 0 GROUP BY ALL HAVING count(DISTINCT e.x) >= any_value(alpha)),
h AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM b o WHERE o.doc_id = b.doc_id AND list_contains(b.over, o.id) AND o.block * o.s < (b.block + 2) * b.s AND b.block * b.s < (o.block + 2) * o.s)),
g AS (SELECT doc_id, max(n / m) AS score, list(DISTINCT label) AS labels FROM h GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, base.lo::BIGINT AS first_word, base.hi::BIGINT AS last_word, coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(g.labels, [])))), ','), '') AS labels, CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(g.score, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN g USING (doc_id)
"""


OP13_SQL = oracle()
