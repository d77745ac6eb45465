"""License scan: TF-IDF cosine of headers and files to templates, then inheritance along directories.

Header candidates are runs of consecutive lines of a file (lines without words do not count), of up
to twice the words of the longest notice, however many lines these take; they are compared with the notices ``TEMPLATES``. Whole files are compared
with the licence texts ``TEXTS``. Words are runs of a-z and 0-9, lower-cased; a word weighs term
frequency x idf, with document frequencies over all files; a word that no template of the kind has
counts as one that no file has. A candidate whose cosine to a template reaches the threshold has
that license.

Only candidates that can reach it are expanded; no other is lost:
- a header needs a word of a template's prefix, its heaviest words such that the rest alone stays
  below; a file needs one of a licence text's prefix, its rarest words of that kind, and as much
  of the text's weight in the words they share;
- the weights of a run's words, each occurrence apart, bound its cosine from above by sums over
  its lines; and a run whose first or last line shares no word is never better than without it.

A file is a licence file if it matches as a whole, or if half of its words lie in license lines:
lines that match alone, and runs that no run overlapping them surpasses. Its license holds for its
directory. A file without a license of its own takes that of the nearest directory above it.
Besides, an SPDX line names a license by itself, known or not: it stands before notices, whose words
differ too little between identifiers. Only DataFrame functions.
"""

from __future__ import annotations

import json
import math
import operator
from collections import Counter
from collections.abc import Mapping
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import stored

#: Notices by which licenses are recognised.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License, version 3"],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License, version 2.1"],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License, version 3"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "All-Rights-Reserved": ["All rights reserved."],
}
#: Full licence texts, with which whole files are compared: one file each, named by its license.
TEXTS = {p.stem: [p.read_text("utf-8")] for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
THRESHOLD = 0.75
#: An SPDX line and its first identifier.
_SPDX = r"SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9][A-Za-z0-9.+-]*)"
_APART = "[^a-z0-9]+"


def _words(text: Column) -> Column:
    """Words in order; ASCII, so that lower-casing depends on no language."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.split(F.translate(text, letters, letters.lower()), _APART)


def _template_words(text: str) -> list[str]:
    plain = "".join(x if x.isascii() and x.isalnum() else " " for x in text.lower())
    return plain.split()


class _Templates:
    """Templates of one kind: ``rows`` (license, template, word, weight as part of a unit vector),
    ``idf`` of their words, and ``prefix``, words of which every match has one.

    What is left beside the prefix are the lightest words, or with ``rare`` the most common ones.
    """

    def __init__(self, templates: Mapping[str, list[str]], counts: Mapping[str, int], threshold: float, rare: bool = False):
        n = counts.get("", 0)
        vocabulary = sorted({w for texts in templates.values() for text in texts for w in _template_words(text)})
        self.idf = {w: math.log((1 + n) / (1 + counts.get(w, 0))) + 1 for w in vocabulary}
        self.unseen = math.log(1 + n) + 1
        # a little room for rounding
        self.low = (threshold - 1e-6) * (1 - 1e-9)
        self.threshold, self.rows, prefix = threshold, [], set()
        #: Words of the longest template.
        self.longest = max((len(_template_words(text)) for texts in templates.values() for text in texts), default=0)
        for license_, texts in templates.items():
            for k, text in enumerate(texts):
                weights = {w: n * self.idf[w] for w, n in Counter(_template_words(text)).items()}
                norm = math.sqrt(sum(x * x for x in weights.values()))
                self.rows += [(license_, k, w, x / norm) for w, x in sorted(weights.items())]
                rest = 0.0
                for w, x in sorted(weights.items(), key=lambda item: (self.idf[item[0]] if rare else item[1], item[0])):
                    rest += (x / norm) ** 2
                    if math.sqrt(rest) >= self.low:
                        prefix.add(w)
        self.prefix = sorted(prefix)

    def shares(self, words: Column) -> Column:
        """Whether distinct ``words`` have so much of a template that they can match it."""
        squares: dict[tuple[str, int], dict[str, float]] = {}
        for license_, k, w, x in self.rows:
            squares.setdefault((license_, k), {})[w] = x * x
        mass = lambda held: F.aggregate(F.array_intersect(words, _strings(held)), F.lit(0.0), lambda sum_, w: sum_ + F.try_element_at(_literal_map(held), w))
        return reduce(operator.or_, (mass(held) >= self.low**2 for held in squares.values()), F.lit(False))

    def near(self, candidates: DataFrame) -> DataFrame:
        """``(id, license, score)`` of the best template that reaches the threshold, for candidates
        (id, text)."""
        spark = candidates.sparkSession
        words = candidates.select("id", F.explode(_words(F.col("text"))).alias("word")).where("word != ''").groupBy("id", "word").agg(F.count("*").alias("tf"))
        known = spark.createDataFrame([(w, float(x)) for w, x in self.idf.items()], "word string, idf double")
        weighted = words.join(F.broadcast(known), "word", "left").withColumn("weight", F.col("tf") * F.coalesce("idf", F.lit(self.unseen)))
        norms = weighted.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
        unit = spark.createDataFrame(self.rows, "license string, template int, word string, unit double")
        dots = weighted.join(F.broadcast(unit), "word").groupBy("id", "license", "template").agg(F.sum(F.col("weight") * F.col("unit")).alias("dot"))
        near = dots.join(norms, "id").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= self.threshold)
        best = near.groupBy("id").agg(F.min(F.struct(-F.col("score"), "license")).alias("best"))
        return best.select("id", F.col("best.license").alias("license"), (-F.col("best.col1")).alias("score"))


def _strings(words) -> Column:
    """An array literal; words have no blanks."""
    words = list(words)
    return F.split(F.lit(" ".join(words)), " ") if words else F.array().cast("array<string>")


def _literal_map(values: Mapping[str, float]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "map<string,double>")


def _runs(files: DataFrame, headers: _Templates) -> DataFrame:
    """``(path, file, start, sizes, text, id)``: runs of lines that may match a header, with the
    number of words in each line."""
    cue = "(?i)(?<![a-z0-9])(?:" + "|".join(headers.prefix) + ")(?![a-z0-9])"
    held = files.where(F.col("text").rlike(cue)).withColumn("file", F.monotonically_increasing_id())
    lines = held.select("path", "file", F.posexplode(F.filter(F.split("text", "\n"), lambda x: x.rlike("[A-Za-z0-9]"))).alias("line", "text"))
    lines = lines.withColumn("words", F.array_remove(_words(F.col("text")), ""))
    most: dict[str, float] = {}
    for _, _, w, x in headers.rows:
        most[w] = max(most.get(w, 0.0), x * headers.idf[w])
    total = lambda value: F.aggregate("words", F.lit(0.0), lambda sum_, w: sum_ + value(w))
    gain = total(lambda w: F.coalesce(F.try_element_at(_literal_map(most), w), F.lit(0.0)))
    cost = total(lambda w: F.coalesce(F.try_element_at(_literal_map({w: x * x for w, x in headers.idf.items()}), w), F.lit(headers.unseen**2)))
    line = F.struct("text", F.size("words").alias("size"), F.col("text").rlike(cue).alias("cue"), gain.alias("gain"), cost.alias("cost"))
    lines = lines.select("path", "file", "line", line.alias("own"))
    before = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("before", F.sum("own.size").over(before) - F.col("own.size"))
    ahead = Window.partitionBy("file").orderBy("before").rangeBetween(0, 2 * headers.longest)
    starts = lines.withColumn("ahead", F.collect_list("own").over(ahead)).where("own.gain > 0")
    runs = starts.select("path", "file", F.col("line").alias("start"), "ahead", F.explode(F.sequence(F.lit(1), F.size("ahead"))).alias("n"))
    runs = runs.where("ahead[n - 1].gain > 0").withColumn("run", F.slice("ahead", 1, F.col("n")))
    summed = lambda name: F.aggregate("run", F.lit(0.0), lambda sum_, x: sum_ + x[name])
    may = F.exists("run", lambda x: x["cue"]) & (summed("gain") >= headers.low * F.sqrt(summed("cost")) * (1 - 1e-9))
    text = F.array_join(F.transform("run", lambda x: x["text"]), "\n")
    runs = runs.where(may).select("path", "file", "start", F.transform("run", lambda x: x["size"]).alias("sizes"), text.alias("text"))
    return stored(runs.withColumn("id", F.monotonically_increasing_id()), "runs")


def _headers(files: DataFrame, headers: _Templates) -> DataFrame:
    """``(path, license, score, license_words)`` of files with a header."""
    runs = _runs(files, headers)
    hits = runs.drop("text").join(headers.near(runs), "id")
    lines = hits.select("*", F.size("sizes").alias("n"), F.posexplode("sizes").alias("k", "size")).withColumn("line", F.col("start") + F.col("k"))
    first = Window.partitionBy("file", "line").orderBy(F.desc("score"), "n", "start")
    lines = lines.withColumn("best", F.row_number().over(first) == 1)
    whole = F.min("best").over(Window.partitionBy("id"))
    covered = lines.withColumn("counts", (F.col("n") == 1) | whole).groupBy("path", "line").agg(
        F.min(F.struct(-F.col("score"), "license")).alias("best"), F.coalesce(F.max(F.when(F.col("counts"), F.col("size"))), F.lit(0)).alias("size")
    )
    found = covered.groupBy("path").agg(F.min("best").alias("best"), F.sum("size").alias("license_words"))
    return found.select("path", F.col("best.license").alias("license"), (-F.col("best.col1")).alias("score"), "license_words")


def _named(files: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with files that have SPDX lines: of these the first identifier counts, with score 1."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(_SPDX))
    tagged = files.where("path IS NOT NULL").where(F.contains("text", F.lit("SPDX-License-Identifier:"))).select("path", lines.alias("lines")).where(F.size("lines") > 0)
    words = F.aggregate("lines", F.lit(0), lambda total, x: total + F.size(F.array_remove(_words(x), "")))
    tagged = tagged.select("path", F.regexp_extract(F.get("lines", F.lit(0)), _SPDX, 1).alias("tag"), words.alias("tag_words"))
    tagged = tagged.groupBy("path").agg(F.min("tag").alias("tag"), F.max("tag_words").alias("tag_words"))
    both = found.join(tagged, "path", "full")
    score = F.when(F.col("tag").isNotNull(), F.lit(1.0)).otherwise(F.col("score"))
    return both.select("path", F.coalesce("tag", "license").alias("license"), score.alias("score"), F.greatest("license_words", "tag_words").cast("long").alias("license_words"))


def _wholes(files: DataFrame, texts: _Templates) -> DataFrame:
    """``(path, license, score)`` of files that are a licence text."""
    words = _words(F.col("text"))
    held = files.where(F.arrays_overlap(words, _strings(texts.prefix))).where(texts.shares(words))
    held = stored(held.withColumn("id", F.monotonically_increasing_id()), "wholes")
    hits = held.select("path", "id").join(texts.near(held), "id").groupBy("path").agg(F.min(F.struct(-F.col("score"), "license")).alias("best"))
    return hits.select("path", F.col("best.license").alias("license"), (-F.col("best.col1")).alias("score"))


def scanned(files: DataFrame, templates: Mapping[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD, full_texts: Mapping[str, list[str]] = TEXTS) -> DataFrame:
    """``(path, own_license, score, is_license_file, license, license_path)`` for every row of
    ``files`` (path, text).

    ``own_license`` is that of the licence text which the whole file matches, else the identifier of
    its first SPDX line, else that of the header of highest cosine (of equals: the first by name),
    with ``score`` rounded to six digits.
    ``license`` is the own one, else the nearest inherited; ``license_path`` is the file it comes
    from; of several licence files in a directory the one of highest score counts, then the first
    path. Defined cases: a null or empty text has no license of its own; a null path inherits
    nothing and gives nothing; very long texts are read whole; repeated rows each give a row, and rows with one path share the best
    of their lines; an empty table gives an empty table; other columns are ignored.
    """
    files = files.select("path", "text")
    vocabulary = sorted({w for kind in (templates, full_texts) for texts in kind.values() for text in texts for w in _template_words(text)})
    present = F.array_intersect(_words(F.col("text")), _strings(vocabulary))
    total = F.lit("")  # no word is empty: this entry counts the files
    seen = files.select(F.explode(F.array_append(F.coalesce(F.array_remove(present, ""), F.array().cast("array<string>")), total)).alias("word"))
    counts = {row["word"]: row["n"] for row in seen.groupBy("word").agg(F.count("*").alias("n")).collect()}

    by_line = _named(files, _headers(files, _Templates(templates, counts, threshold)))
    by_file = _wholes(files, _Templates(full_texts, counts, threshold, rare=True))
    own = by_line.join(by_file.select("path", F.struct("license", "score").alias("whole")), "path", "full")
    pick = lambda name: F.when(F.col("whole").isNotNull(), F.col(f"whole.{name}")).otherwise(F.col(name))
    own = own.select("path", pick("license").alias("own_license"), pick("score").alias("score"), "license_words", F.col("whole").isNotNull().alias("whole"))
    hit_files = files.join(own, "path", "left_semi").select("path", F.size(F.array_remove(_words(F.col("text")), "")).alias("file_words"))
    hit_files = hit_files.groupBy("path").agg(F.max("file_words").alias("file_words"))
    by_lines = F.coalesce(2 * F.col("license_words") >= F.col("file_words"), F.lit(False))
    own = stored(own.join(hit_files, "path").withColumn("is_license_file", F.col("whole") | by_lines).drop("whole"), "own")

    parent = F.regexp_replace("path", "/?[^/]*$", "")
    holders = own.where("is_license_file").groupBy(parent.alias("directory")).agg(F.min(F.struct(-F.col("score"), "path", "own_license")).alias("holder"))
    holders = holders.select("directory", F.col("holder.own_license").alias("inherited"), F.col("holder.path").alias("from_path"))
    # the directories above a file, the nearest last: its path up to each slash
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    all_files = files.select("path").withColumn("row", F.monotonically_increasing_id())
    paths = files.where("path IS NOT NULL").select("path").distinct().join(own.select("path"), "path", "left_anti")
    nearest = (
        paths.select("path", F.posexplode(above).alias("depth", "directory"))
        .join(holders, "directory")
        .groupBy("path")
        .agg(F.max(F.struct("depth", "inherited", "from_path")).alias("nearest"))
    )
    out = all_files.join(own, "path", "left").join(nearest, "path", "left")
    return out.select(
        "path",
        "own_license",
        "score",
        F.coalesce("is_license_file", F.lit(False)).alias("is_license_file"),
        F.coalesce("own_license", "nearest.inherited").alias("license"),
        F.when(F.col("own_license").isNotNull(), F.col("path")).otherwise(F.col("nearest.from_path")).alias("license_path"),
    )


def document_path(shard: int = 64) -> Column:
    """Documents as files: a directory per source, in it one per ``shard`` consecutive ids."""
    name = lambda x: F.coalesce(x.cast("string"), F.lit("none"))
    return F.concat_ws("/", name(F.col("source")), name(F.floor(F.col("doc_id") / shard)), name(F.col("doc_id")))
