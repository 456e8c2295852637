"""License scans: an exact set-similarity join of text blocks with templates.

A template is a set of words; a block is a run of words, twice as long as the
template, starting at each multiple of the template's length, so every run of
the template's length lies in one whole block.  A block matches if it contains
at least ``THRESHOLD`` of the template's words.  Nearly all blocks are ruled
out without a comparison, and none that matches is lost:

  * template words are ordered by how many documents of the corpus hold them,
    rarest first, so a matching block must hold two of the first
    ``n - need + 2`` words (prefix filter); those alone are looked up;
  * words that stand at h of those first p places leave at most ``h + n - p``
    shared words; too few and the block is dropped (positional filter);
  * a block with fewer distinct words than ``need`` is passed over (length).

The corpus counts take one pass that sums only the templates' words, some
hundreds at most, whatever the corpus holds.  Templates are a small fixed
table, so they travel with the task and no block is shuffled.

Notices of one family differ by a word or two ("Lesser", "ShareAlike"), so a
block of one contains enough of its siblings too.  All are listed as blocks; the
labels name, of overlapping blocks of sibling templates, those that hold most.

Phrases are a plainer rule beside the join: places where a phrase's words
stand one after the other.  Their labels always stay.

Defined results
  * null and empty texts: no words, no labels, score 0, null places;
  * a text shorter than a block is one block; the last block may be short;
  * ties: labels are distinct and sorted, siblings that hold equally much all stay;
  * score is the best containment found, of a template or, wholly, of a phrase;
  * repeated rows and null doc_ids: each row is scanned alone; an empty table
    gives no rows; other columns are not used.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .tokens import slices

THRESHOLD = 0.8

#: Phrases and the label of each (fixed values).
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Notices and the label of each; texts of public licenses and notices (fixed values).
TEMPLATES = (
    ("mit", "released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"),
    ("proprietary", "All rights reserved"),
)
FOUND = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, blocks array<struct<start:long,words:long,label:string,containment:double>>"

#: Words are digits, small letters and bytes beyond ASCII; capitals become small, all else parts words.
FOLD = bytes(b if b > 127 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def document_counts(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """In how many documents each template word stands."""
    wanted = frozenset(w for _, t in templates for w in words_of(t))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[bytes] = Counter()
        for batch in batches:
            for rows in slices(batch, "text"):
                for text in rows["text"].to_pylist():
                    sums.update(wanted.intersection(words_of(text)))
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in sums], pa.string()), pa.array(list(sums.values()), pa.int64())], names=["word", "n"])

    summed = _rows(docs).select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"].encode(): r["n"] for r in summed.collect()}


class Matcher:
    """Finds every block of a word list that contains enough of a template."""

    def __init__(self, counts: dict[bytes, int], templates=TEMPLATES, threshold: float = THRESHOLD):
        self.templates = []
        self.prefix: dict[bytes, list[int]] = {}  # word -> templates that have it among their first places
        for k, (label, text) in enumerate(templates):
            order = sorted(set(words_of(text)), key=lambda w: (counts.get(w, 0), w))
            need = max(1, math.ceil(threshold * len(order) - 1e-9))
            first = order[: len(order) - need + min(2, need)]
            self.templates.append((label, frozenset(order), need, len(words_of(text)), len(first)))
            for word in first:
                self.prefix.setdefault(word, []).append(k)
        self.words = frozenset(self.prefix)
        #: Templates of another label that share so much that a block of one is likely one of the other.
        self.siblings = [
            {j for j, (other, theirs, *_) in enumerate(self.templates) if other != label and len(own & theirs) >= threshold * min(len(own), len(theirs))}
            for label, own, *_ in self.templates
        ]

    def matches(self, words: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(first word, words, template, template words held) of every block that contains enough of a template."""
        present = self.words.intersection(words)
        if not present:
            return []
        held: dict[tuple[int, int], set[bytes]] = {}  # (template, block) -> prefix words in it
        for at, word in enumerate(words):
            if word in present:
                for k in self.prefix[word]:
                    block = at // self.templates[k][3]
                    for b in (block, block - 1):
                        if b >= 0:
                            held.setdefault((k, b), set()).add(word)
        found = []
        for (k, b), prefix in sorted(held.items()):
            label, template, need, step, places = self.templates[k]
            if len(prefix) + len(template) - places < need:
                continue
            own = set(words[b * step : (b + 2) * step])
            if len(own) >= need and (shared := len(own & template)) >= need:
                found.append((b * step, min(len(words), (b + 2) * step) - b * step, k, shared))
        return found

    def __call__(self, words: list[bytes]) -> list[tuple[int, int, str, float]]:
        """(first word, words, label, containment) of every block that contains enough of a template."""
        return self.named(self.matches(words))

    def named(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, str, float]]:
        return [(at, n, self.templates[k][0], shared / len(self.templates[k][1])) for at, n, k, shared in matches]

    def labels(self, matches: list[tuple[int, int, int, int]]) -> set[str]:
        """Labels of blocks, but of those that overlap a block of a sibling template which says more, or as much in fewer words."""
        own, held, beaten = sorted(matches), [], set()
        for i, (start, _, k, shared) in enumerate(own):
            held = [h for h in held if own[h][0] + own[h][1] > start]  # at most two of each template
            for h in held:
                other, theirs = own[h][2], own[h][3]
                if other in self.siblings[k]:
                    ours, them = ((n, n / len(self.templates[t][1])) for n, t in ((shared, k), (theirs, other)))
                    if ours != them:
                        beaten.add(i if ours < them else h)
            held.append(i)
        return {self.templates[m[2]][0] for i, m in enumerate(own) if i not in beaten}


def phrase_places(words: list[bytes], phrases=PHRASES) -> list[tuple[int, str]]:
    """(first word, label) of each place where a phrase stands, in one pass over the words."""
    first: dict[bytes, list[tuple[list[bytes], str]]] = {}
    for phrase, label in phrases:
        want = phrase.encode().split()
        first.setdefault(want[0], []).append((want, label))
    if first.keys().isdisjoint(words):
        return []
    return [(at, label) for at, word in enumerate(words) if word in first for want, label in first[word] if words[at : at + len(want)] == want]


def scanned(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """One row a document: phrase places, labels, and every matching block."""
    counts = document_counts(docs, templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(counts, templates, threshold)
        schema = pa.schema(
            [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
            + [("blocks", pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("label", pa.string()), ("containment", pa.float64())])))]
        )
        for batch in batches:
            for rows in slices(batch, "text"):
                columns: list[list] = [[] for _ in range(8)]
                for text in rows["text"].to_pylist():
                    words = words_of(text)
                    places, matches = phrase_places(words, phrases), match.matches(words)
                    blocks = match.named(matches)
                    base = {label for _, label in places}
                    starts = [at for at, _ in places]
                    values = (
                        len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | match.labels(matches))),
                        max((b[3] for b in blocks), default=0.0) if not places else 1.0, [dict(zip(("start", "words", "label", "containment"), b, strict=True)) for b in blocks],
                    )
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([rows["doc_id"], *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]], schema=schema)

    return _rows(docs).mapInArrow(scan, FOUND)


def query(spark, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents")).drop("blocks")
