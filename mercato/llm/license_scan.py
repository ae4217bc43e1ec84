"""License scan by diagonal voting (operator 2).

All rolling k-word hashes of every text are joined in Spark to the positions at
which license templates hold the same k words.  A match of text position p and
template position t votes for the diagonal p - t; votes are summed by (text,
template, diagonal), diagonals at most GAP apart are merged (words inserted or
left out), and a merged run of enough votes is a candidate span.  Each span is
verified on the words themselves: the share of the template that the span holds
in order must reach COVERED, the words that tell licenses apart (nc, sa, nd, lesser,
affero, the version, the license's name) must be the template's own, and of
templates that claim the same words the best one stays.

Base labels are places where a fixed phrase's words stand consecutively.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the whole text, A-Z folded.  Equal
texts are scanned once.

Defined results.  Null or empty text: no words, no labels, score 0, null
first_word and last_word.  Repeated rows give equal results.  Null ids are kept.
A very long text is scanned whole.  An empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm import vectext as V
from mercato.llm.shared import BitFilter, written

#: Phrases and labels of the base.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Public license notices: (label, text).
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                 "compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
              "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
              "option) any later version."),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
              "Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2."),
    ("lgpl-2", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library "
               "General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("lgpl-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("lgpl-3", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("lgpl-3", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
               "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
               "your option) any later version."),
    ("agpl-3", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
               "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
               "your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc0", "Licensed under CC0 1.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 3.0 Unported License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivs 3.0 Unported License."),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License."),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License."),
]

GRAM_WORDS = 3
GAP = 2
COVERED = 0.8
#: Parts of a license, by the first part of its label: words that say it -> part.
PARTS = {
    "cc": {("nc",): "nc", ("noncommercial",): "nc", ("non", "commercial"): "nc", ("sa",): "sa", ("sharealike",): "sa",
           ("share", "alike"): "sa", ("nd",): "nd", ("noderivatives",): "nd", ("noderivs",): "nd", ("no", "derivatives"): "nd",
           ("no", "derivs"): "nd"},
    **dict.fromkeys(("gpl", "lgpl", "agpl"), {("lesser",): "lesser", ("affero",): "affero", ("library", "general"): "library"}),
}
#: License names; a template that holds one asks for it.
NAMES = frozenset("mit apache gnu creative cc cc0 mozilla".split())
FILTER_LOG_BITS = 23

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(_FOLD))


def _hashed(text: str, k: int) -> np.ndarray:
    """Hashes of the k-word runs of a short text."""
    block = next(V.blocks(pa.array([text])))
    return V.grams(V.words(block, V.ALNUM, V.FOLDED), k)[1]


def _content(block: V.Block) -> np.ndarray:
    return V.span_hashes(block.data, block.offsets[:-1], block.offsets[1:]).view(np.int64)


def _id_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))


def base_places(docs: DataFrame, id_col: str, text_col: str, phrases: dict[str, str]) -> DataFrame:
    """(_id, content, n_words, n_base, first_word, last_word, base: labels) of every row."""
    id_type = docs.schema[id_col].dataType
    known = [(len(words_of(p)), _hashed(p, len(words_of(p)))[0], label) for p, label in phrases.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in V.blocks(b.column("_text")):
                w = V.words(block, V.ALNUM, V.FOLDED)
                rows, starts = [], []
                labels: list[list[str]] = [[] for _ in range(block.rows)]
                grams = {k: V.grams(w, k) for k in {k for k, _, _ in known}}
                for k, h, label in known:
                    pos = grams[k][0][grams[k][1] == h]
                    rows.append(w.row[pos])
                    starts.append(pos - w.first[w.row[pos]])
                    for r in np.unique(w.row[pos]):
                        labels[r].append(label)
                row, start = np.concatenate(rows), np.concatenate(starts)
                n = np.bincount(row, minlength=block.rows)
                low, high = np.full(block.rows, np.iinfo(np.int64).max), np.full(block.rows, -1)
                np.minimum.at(low, row, start)
                np.maximum.at(high, row, start)
                none = n == 0
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").slice(block.first, block.rows), pa.array(_content(block)), pa.array(w.counts()), pa.array(n),
                     pa.array(low, mask=none), pa.array(high, mask=none), pa.array(labels, pa.list_(pa.string()))],
                    names=["_id", "content", "n_words", "n_base", "first_word", "last_word", "base"])

    fields = [T.StructField("_id", id_type)] + [T.StructField(c, T.LongType()) for c in
                                               ("content", "n_words", "n_base", "first_word", "last_word")]
    return _id_text(docs, id_col, text_col).mapInArrow(run, T.StructType([*fields, T.StructField("base", T.ArrayType(T.StringType()))]))


def rolling_hashes(docs: DataFrame, text_col: str, k: int = GRAM_WORDS) -> DataFrame:
    """(content, pos, h) of every k-word run of every text; a task hashes a text
    that it meets again once only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for block in V.blocks(b.column("_text")):
                name = _content(block)
                fresh = np.zeros(block.rows, bool)
                for i, x in enumerate(name.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[i] = True
                w = V.words(block, V.ALNUM, V.FOLDED)
                pos, h = V.grams(w, k)
                use = fresh[w.row[pos]]
                pos, h = pos[use], h[use]
                row = w.row[pos]
                yield pa.RecordBatch.from_arrays([pa.array(name[row]), pa.array((pos - w.first[row]).astype(np.int32)),
                                                  pa.array(h.view(np.int64))], names=["content", "pos", "h"])

    return docs.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(run, "content long, pos int, h long")


def template_positions(spark: SparkSession, templates: list[tuple[str, str]], k: int) -> DataFrame:
    rows = [(i, t, int(h)) for i, (_, text) in enumerate(templates) for t, h in enumerate(_hashed(text, k).view(np.int64))]
    return spark.createDataFrame(rows, "template int, t int, h long")


def candidate_spans(hashes: DataFrame, positions: DataFrame, lengths: list[int], k: int) -> DataFrame:
    """(content, template, start, end): merged diagonals with enough votes."""
    votes = (hashes.join(F.broadcast(positions), "h")        # as long as the template list
             .withColumn("diagonal", F.col("pos") - F.col("t"))
             .groupBy("content", "template", "diagonal")
             .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("t").alias("ts")))
    order = Window.partitionBy("content", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > GAP, F.lit(True))
    merged = (votes.withColumn("run", F.sum(fresh.cast("int")).over(order))
              .groupBy("content", "template", "run")
              .agg(F.min("lo").alias("start"), (F.max("hi") + k).alias("end"), F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts")))
    held = F.size(F.array_distinct(F.flatten(F.transform("ts", lambda t: F.sequence(t, t + (k - 1))))))
    length = F.element_at(F.array(*[F.lit(n) for n in lengths]), F.col("template") + 1)
    # A word that differs takes k runs with it, so half the template is asked for here.
    return merged.filter(held * 2 >= length).select("content", "template", "start", "end")


def _aligned(template: list[str], span: list[str]) -> list[int]:
    """Places in the span of a longest common subsequence with the template; of the
    longest ones, one that starts last."""
    codes: dict[str, int] = {}
    a = np.array([codes.setdefault(w, len(codes)) for w in template])
    own = np.array([codes.get(w, -1) for w in span], np.int64)
    # Length and start in one number, so that no table of a long span is held.
    big = len(span) + 1
    best, stop = np.zeros(len(a) + 1, np.int64), 0
    for i, code in enumerate(own):
        before = best[:-1]
        longer = np.where(a == code, np.where(before < big, i, before) + big, 0)
        new = best.copy()
        new[1:] = np.maximum(new[1:], longer)
        new = np.maximum.accumulate(new)
        if new[-1] > best[-1]:
            stop = i + 1
        best = new
    first = int(best[-1] % big)
    rows = [np.zeros(len(a) + 1, np.int64)]
    for code in own[first:stop]:
        new = rows[-1].copy()
        new[1:] = np.maximum(new[1:], rows[-1][:-1] + (a == code))
        rows.append(np.maximum.accumulate(new))
    out, i, j = [], len(rows) - 1, len(a)
    while i and j and rows[i][j]:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append(first + i)
    return out[::-1]


def deciding(label: str, words: list[str]) -> set[str]:
    """The parts and, where the label names a version, the versions that the words name."""
    parts = PARTS.get(label.split("-")[0], {})
    out = {parts[run] for i in range(len(words)) for run in (tuple(words[i:i + 1]), tuple(words[i:i + 2])) if run in parts}
    if re.search(r"-\d", label):
        for i, w in enumerate(words):
            m = re.fullmatch(r"(?:version|v)(\d*)", w)
            if m:
                digits = [m.group(1)] if m.group(1) else []
                for x in words[i + 1:]:
                    if not x.isdigit():
                        break
                    digits.append(x)
                while digits and digits[-1] == "0":
                    digits.pop()
                out |= {".".join(digits)} - {""}
    return out


def best_spans(own: list[str], found: list[tuple[int, int, int]], templates: list[tuple[str, str]], split: list[list[str]],
               covered: float) -> dict[str, float]:
    """label -> share of the verified spans (template, start, end) of a text.  Of spans that
    claim half of the same words the one with the larger share stays, then the longer one."""
    passing = []
    for i, start, end in found:
        label, low = templates[i][0], max(0, start - GAP)
        at = [low + p for p in _aligned(split[i], own[low:end + GAP])]
        if len(at) < covered * len(split[i]):
            continue
        if NAMES.intersection(split[i]) <= {own[p] for p in at} and deciding(label, split[i]) == deciding(label, own[at[0]:at[-1] + 1]):
            passing.append((-len(at) / len(split[i]), -len(at), i, at[0], label, set(at)))
    best: dict[str, float] = {}
    taken: list[tuple[str, set[int]]] = []
    for share, _, _, _, label, at in sorted(passing, key=lambda p: p[:4]):
        if all(label == other or 2 * len(at & held) < min(len(at), len(held)) for other, held in taken):
            taken.append((label, at))
            best[label] = max(-share, best.get(label, 0.0))
    return best


def verified(docs: DataFrame, text_col: str, spans: DataFrame, templates: list[tuple[str, str]], covered: float) -> DataFrame:
    """(content, label, score): the best verified span of each label."""
    wanted = spans.groupBy("content").agg(F.collect_list(F.struct("template", "start", "end")).alias("spans"))
    bits = BitFilter(wanted, "content", FILTER_LOG_BITS)
    split = [words_of(t) for _, t in templates]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for block in V.blocks(b.column("_text")):
                name = _content(block)
                at = []
                for i in np.flatnonzero(bits.may_hold(name)):
                    if int(name[i]) not in seen:
                        seen.add(int(name[i]))
                        at.append(i)
                if at:
                    text = b.column("_text").slice(block.first, block.rows).take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([pa.array(name[at]), text], names=["content", "text"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for content, text, found in zip(*(b.column(c).to_pylist() for c in ("content", "text", "spans")), strict=True):
                best = best_spans(words_of(text), [(s["template"], s["start"], s["end"]) for s in found], templates, split, covered)
                out += [(content, label, share) for label, share in best.items()]
            cols = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.float64())],
                                             names=["content", "label", "score"])

    rows = docs.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(texts, "content long, text string")
    one = rows.groupBy("content").agg(F.any_value("text").alias("text"))
    return one.join(wanted, "content").mapInArrow(check, "content long, label string, score double")


def license_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES,
                   templates: list[tuple[str, str]] = TEMPLATES, k: int = GRAM_WORDS, covered: float = COVERED) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.
    The score is the best verified share of a template; a base phrase scores 1."""
    spark = docs.sparkSession
    lengths = [len(words_of(t)) for _, t in templates]
    if min(lengths) < k:
        raise ValueError("a template is shorter than a rolling window")
    spans = written(candidate_spans(rolling_hashes(docs, text_col, k), template_positions(spark, templates, k), lengths, k), "spans")
    found = (verified(docs, text_col, spans, templates, covered).groupBy("content")
             .agg(F.collect_set("label").alias("more"), F.max("score").alias("score")))
    rows = base_places(docs, id_col, text_col, phrases).join(found, "content", "left")
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    more = F.coalesce(F.col("more"), F.array().cast("array<string>"))
    return rows.select(F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word", joined(F.col("base")).alias("base_labels"),
                       joined(F.concat("base", more)).alias("labels"),
                       F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"))
