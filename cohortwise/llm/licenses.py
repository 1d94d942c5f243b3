"""Licence texts in documents: a trained paragraph classifier, confirmed against templates (DataFrame and Spark ML functions only)."""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.session import materialize, sized, small_table

UNKNOWN = "unknown"
# Sentences by which licence families are known.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "This project is licensed under the terms of the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "Licensed under the GNU General Public License, version 2."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License."),
    ("AGPL", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
# Words of a window; longer paragraphs are cut into windows that overlap by half.
PARAGRAPH_WORDS = 60
# With the pattern of a line's number, if lines have one.
_NUMBER = r"\d+\t"
_EMPTY_LINES = r"(?:^|\n)%s[^\p{L}\p{N}\n]*(?=\n|$)"
# The number of a line and comment marks that are made of letters.
_LINE_START = r"(?i)^%s(?:\s*(?:dnl|rem|c)\s)?"
# A prediction is confirmed when a template of the family shares this part of its words (and pairs of words) with the paragraph.
CONFIRM = 0.7
# What all background paragraphs weigh together, at most, and how many of them each template's settings among their words weigh.
BACKGROUND = 2000
SURROUNDINGS = 8
# Background cells that hold this share of the paragraphs meet every template, others one, dealt by hash, with as much more weight.
EVERY_SHARE = 0.001
# Share of background paragraphs that may pass for a licence, from which the threshold of the unknown class is calibrated.
FALSE_SHARE = 0.001


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^a-z0-9]+"), "")


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", only: set[str] | None = None) -> DataFrame:
    """(doc_id, part, words, lines) for every paragraph of every text, and for each line of those of several lines.

    A paragraph ends at a line without letters and digits, such as an empty
    line of a comment. Comment marks are not words. Longer ones are cut into
    windows that overlap by half; ``lines`` has the line of each word. With
    ``only``, what holds none of these words is left out as early as it can be.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Each line is led by its number, so that paragraphs know theirs once the text is cut.
    numbered = F.array_join(F.transform(F.split(text, "\n"), lambda t, i: F.concat(i.cast("string"), F.lit("\t"), t)), "\n")
    blocks = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.split(numbered, _EMPTY_LINES % _NUMBER)).alias("block"))
    if only is not None:
        blocks = blocks.filter(F.exists(words(F.col("block")), lambda w: w.isin(sorted(only))))

    def of_line(line: Column) -> Column:
        number = F.substring_index(line, "\t", 1).cast("int")
        return F.transform(words(F.regexp_replace(line, _LINE_START % _NUMBER, "")), lambda w: F.struct(number.alias("line"), w.alias("word")))

    lined = blocks.select("doc_id", F.transform(F.split("block", "\n"), of_line).alias("each"))
    cut = lined.select("doc_id", F.explode(_units()).alias("all")).filter(F.size("all") > 0)
    parts = cut.select("doc_id", F.posexplode(F.transform(_starts(), lambda k: F.slice("all", k + 1, PARAGRAPH_WORDS))).alias("part", "some"))
    # Inlined, so that words are taken out of their pairs with lines once and not wherever they are used.
    found = parts.select("doc_id", "part", F.inline(F.array(F.struct(F.col("some.word").alias("words"), F.col("some.line").alias("lines")))))
    return found if only is None else found.filter(F.exists("words", lambda w: w.isin(sorted(only))))


def _units() -> Column:
    """A paragraph of several lines as a whole and each of its lines, from the lines' words in ``each``."""
    return F.when(F.size("each") > 1, F.concat(F.array(F.flatten("each")), F.col("each"))).otherwise(F.col("each"))


def _starts() -> Column:
    """Where the windows of the words in ``all`` start, from 0."""
    half = PARAGRAPH_WORDS // 2
    last = F.greatest(F.ceil((F.size("all") - PARAGRAPH_WORDS) / half), F.lit(0)).cast("int")
    return F.sequence(F.lit(0), last * half, F.lit(half))


def anchors(templates=TEMPLATES, confirm: float = CONFIRM) -> set[str]:
    """Words of which every paragraph that can be confirmed holds at least one.

    A confirmed paragraph lacks at most ``1 - confirm`` of some template's
    words, so of each template more than that share of its words (the longest
    ones) is taken. Whatever holds none of them is of the unknown class.
    """
    found: set[str] = set()
    for _, text in templates:
        own = sorted(set("".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()), key=lambda w: (-len(w), w))
        found |= set(own[: int(len(own) * (1 - confirm)) + 2])
    return found


def vocabulary(templates=TEMPLATES) -> list[str]:
    """The templates' words, and pairs of words as they follow each other."""
    found: set[str] = set()
    for _, text in templates:
        own = "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()
        found |= {*own, *(f"{a} {b}" for a, b in zip(own, own[1:]))}
    return sorted(found)


def _known(word_list: Column, terms: list[str]) -> Column:
    """The words, null where they are not among the ``terms``."""
    return F.transform(word_list, lambda w: F.when(w.isin([t for t in terms if " " not in t]), w))


def _following(known: Column, terms: list[str]) -> Column:
    """The pair with the next word at each place, null where it is not among the ``terms``."""
    pairs = F.transform(known, lambda w, i: F.when(w.isNotNull(), F.concat(w, F.lit(" "), F.get(known, i + 1))))
    return F.transform(pairs, lambda p: F.when(p.isin([t for t in terms if " " in t]), p))


def _each_once(known: Column, following: Column) -> Column:
    return F.sort_array(F.array_distinct(F.array_compact(F.concat(known, following))))


def held(word_list: Column, terms: list[str]) -> Column:
    """Which of the ``terms``, words and pairs of words, these words hold, each once and in order."""
    pairs = [t for t in terms if " " in t]
    firsts = sorted({t.split(" ")[0] for t in pairs})
    following = F.transform(word_list, lambda w, i: F.when(w.isin(firsts), F.concat(w, F.lit(" "), F.get(word_list, i + 1))))
    return _each_once(F.filter(word_list, lambda w: w.isin([t for t in terms if " " not in t])), F.filter(following, lambda p: p.isin(pairs)))


def held_cells(docs: DataFrame, terms: list[str], text_col: str = "text") -> DataFrame:
    """(held, first, n): how many windows of all ``paragraphs`` hold the same terms, by half.

    A paragraph and its lines are of the same half, dealt by a hash of its text. Terms are looked up before windows are cut.
    """
    blocks = docs.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), _EMPTY_LINES % "")).alias("block"))
    known = F.transform(F.split("block", "\n"), lambda line: _known(words(F.regexp_replace(line, _LINE_START % "", "")), terms))
    lined = blocks.select((F.pmod(F.xxhash64("block"), F.lit(2)) == 0).alias("first"), known.alias("each"))
    cut = lined.select("first", F.explode(_units()).alias("all")).filter(F.size("all") > 0)
    paired = cut.select("first", "all", _following(F.col("all"), terms).alias("following"))

    def window(start: Column) -> Column:
        return _each_once(F.slice("all", start + 1, PARAGRAPH_WORDS), F.slice("following", start + 1, PARAGRAPH_WORDS - 1))

    parts = paired.select("first", F.explode(F.transform(_starts(), window)).alias("held"))
    return parts.groupBy("held", "first").agg(F.count(F.lit(1)).alias("n"))


class LicenseClassifier:
    """Sparse logistic regression on the templates' words and pairs of words, with a calibrated threshold for the unknown class."""

    def __init__(self, terms: list[str], model, families: list[str], threshold: float):
        self.terms, self.model, self.families, self.threshold = terms, model, families, threshold

    @staticmethod
    def _features(table: DataFrame, terms: list[str]) -> DataFrame:
        return CountVectorizerModel.from_vocabulary(terms, inputCol="held", outputCol="features").transform(table)

    @classmethod
    def train(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> LicenseClassifier:
        """Learn families from template sentences, whole, with one word left out and between other words, and the unknown class from all paragraphs of the corpus.

        Paragraphs that hold the same terms are one cell with a count, which trains as its rows would. Those with two
        anchor words are left out, as they may be licence texts. Half of the others
        train the class and surround the templates, the other half sets the threshold.
        """
        spark, terms = docs.sparkSession, vocabulary(templates)
        families = [UNKNOWN, *sorted({f for f, _ in templates})]
        seeds = small_table(spark, [(k, float(families.index(f)), t) for k, (f, t) in enumerate(templates)], "k int, label double, text string")
        seeds = seeds.select("k", "label", words(F.col("text")).alias("words"))
        gap = seeds.select("label", "words", F.explode(F.sequence(F.lit(0), F.size("words"))).alias("gap"))
        table = gap.select("label", held(F.filter("words", lambda w, i: i != F.col("gap")), terms).alias("held"), F.lit(2.0).alias("weight"))
        cells = materialize(held_cells(docs, terms, text_col), "cells")
        plain = cells.filter(F.size(F.filter("held", lambda t: t.isin(sorted(anchors(templates))))) < 2)
        rows = {r["first"]: r["n"] for r in plain.groupBy("first").agg(F.sum("n").alias("n")).collect()}
        if some := rows.get(True, 0):
            host, count = plain.filter("first"), len(templates)
            large = F.col("n") >= EVERY_SHARE * some
            met = F.when(large, F.sequence(F.lit(0), F.lit(count - 1))).otherwise(F.array(F.pmod(F.xxhash64("held"), F.lit(count)).cast("int")))
            met = host.select("held", F.when(large, F.col("n")).otherwise(F.col("n") * count).alias("n"), F.explode(met).alias("k"))
            own = seeds.select("k", "label", held(F.col("words"), terms).alias("own"))
            share = F.col("n") * (2.0 * min(SURROUNDINGS, some) / some)
            mixed = met.join(F.broadcast(own), "k").select("label", F.array_union("own", "held").alias("held"), share.alias("weight"))
            unknown = host.select(F.lit(0.0).alias("label"), "held", (F.col("n") * (min(BACKGROUND, some) / some)).alias("weight"))
            table = table.unionByName(mixed).unionByName(unknown)
        table = sized(materialize(table, "licences"))
        regression = LogisticRegression(maxIter=40, regParam=1e-3, elasticNetParam=0.5, family="multinomial", weightCol="weight")
        self = cls(terms, regression.fit(cls._features(table, terms)), families, 0.5)
        if rest := rows.get(False, 0):
            scored = self._rated(plain.filter(~F.col("first"))).select("probability", "n")
            self.threshold = _quantile(materialize(scored, "scored"), 1 - FALSE_SHARE, rest, 0.5)
        return self

    def _rated(self, table: DataFrame) -> DataFrame:
        """Add ``probability`` of being a licence of any family, and ``chances``, those of each family, to rows with what they hold."""
        out = self.model.transform(self._features(table, self.terms)).withColumn("__p", vector_to_array("probability"))
        out = out.drop("probability", "rawPrediction", "prediction", "features", "held")
        names = F.array(*[F.lit(f) for f in self.families[1:]])
        chances = F.map_from_arrays(names, F.slice("__p", 2, len(self.families)))
        # Inlined, so that a filter of the probability does not run the model again.
        return out.select("*", F.inline(F.array(F.struct((1 - F.col("__p")[0]).alias("probability"), chances.alias("chances"))))).drop("__p")

    def _scored(self, table: DataFrame) -> DataFrame:
        """The same for rows with words."""
        return self._rated(table.withColumn("held", held(F.col("words"), self.terms)))


def _quantile(scored: DataFrame, share: float, rows: int, least: float) -> float:
    """The interpolated quantile of ``probability`` over lines that stand for ``n`` rows each, ``rows`` in all, at least ``least``.

    Each round counts the rows of some thousand steps and goes on with the step that has the wanted rank, until it holds one value.
    """
    position = share * (rows - 1)
    above = scored.filter(F.col("probability") > least).agg(F.sum("n")).first()[0] or 0
    if rows - above > math.ceil(position):
        return least

    def at(rank: int) -> float:
        low, high, before, steps = 0.0, 1.0, 0, 4096
        while low < high:
            step = F.least(F.floor((F.col("probability") - low) / (high - low) * steps), F.lit(steps - 1))
            part = scored.filter(F.col("probability").between(low, high)).groupBy(step.alias("step"))
            for r in part.agg(F.sum("n").alias("n"), F.min("probability").alias("low"), F.max("probability").alias("high")).orderBy("step").collect():
                low, high = r["low"], r["high"]
                if before + r["n"] > rank:
                    break
                before += r["n"]
        return low

    low, high = at(math.floor(position)), at(math.ceil(position))
    return max(least, low + (high - low) * (position - math.floor(position)))


def _pairs(word_list: Column) -> Column:
    return F.array_union(word_list, F.zip_with(word_list, F.slice(word_list, 2, F.greatest(F.size(word_list), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b)))


def scan(docs: DataFrame, classifier: LicenseClassifier, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """Licence passages: doc_id, line, part, family, probability, similarity, paragraph (the window's words).

    A passage is reported when a window is a licence of any family with a probability above
    the calibrated threshold and a template confirms which one, sharing
    ``CONFIRM`` of its words and pairs of words (the most, if several do; the likelier family among equals). Windows are those of whole
    paragraphs, whatever their line ends, and of single lines; ``line`` is where
    the passage starts in the best of its windows. Null and empty texts have no
    paragraphs; repeated rows give their rows once.
    """
    marked = classifier._scored(paragraphs(docs, id_col, text_col, only=anchors(templates))).filter(F.col("probability") >= classifier.threshold)
    # The templates are a fixed list, so each window meets them as one array.
    each = [F.struct(F.lit(f).alias("family"), _pairs(words(F.lit(t))).alias("template"), F.size(words(F.lit(t))).alias("n")) for f, t in templates]
    met = marked.withColumn("own", _pairs(F.col("words"))).select("*", F.inline(F.array(*each))).withColumn("chance", F.element_at("chances", F.col("family")))
    shared = F.size(F.array_intersect("own", "template")) / F.size(F.array_distinct("template"))
    near = met.withColumn("similarity", shared).filter(F.col("similarity") >= CONFIRM)
    following = F.zip_with("words", F.slice("words", 2, PARAGRAPH_WORDS), lambda a, b: F.array_contains("template", F.concat_ws(" ", a, b)).cast("int"))
    near = near.withColumn("hits", following)
    # The passage starts where as many words as the template has hold most of its pairs.
    held = F.transform("hits", lambda h, i: h * F.aggregate(F.slice("hits", i + 1, F.col("n")), F.lit(0), lambda s, x: s + x))
    near = near.withColumn("held", held)
    start = F.array_position("held", F.array_max("held")).cast("int") - 1
    near = near.withColumn("line", F.get("lines", F.greatest(start, F.lit(0))))
    best = F.max(F.struct("similarity", "chance", (-F.col("part")).alias("part"), "family", "probability", F.concat_ws(" ", "words").alias("paragraph"))).alias("best")
    one = near.groupBy("doc_id", "line").agg(best)
    return one.select("doc_id", "line", (-F.col("best.part")).alias("part"), "best.family", "best.probability", "best.similarity", "best.paragraph")
