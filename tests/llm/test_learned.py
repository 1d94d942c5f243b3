"""Licence scan, language identification and quality: held-out accuracy, planted cases, odd rows."""

import collections
import math
import zlib

import pytest
from cohortwise.llm import langid, licenses, quality
from cohortwise.llm.queries import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def more(spark):
    import os

    if not os.path.isdir(SF):
        pytest.skip("needs the given tables")
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def scanner(more):
    return licenses.LicenseClassifier.train(more)


def test_licences_planted_and_given(spark, more, scanner):
    planted = [(k, f"Some words before.\n{text}\nand after.", family) for k, (family, text) in enumerate(licenses.TEMPLATES)]
    planted += [(1000, "filler " * 300 + "Licensed under the Apache License, Version 2.0. " + "filler " * 300, "Apache-2.0")]
    rows = spark.createDataFrame(planted, "doc_id long, text string, family string").select("doc_id", "text", F.col("family").alias("want"))
    found = {(r["doc_id"], r["family"]) for r in licenses.scan(rows, scanner).collect()}
    missed = [(k, f) for k, _, f in planted if (k, f) not in found]
    assert not missed, missed
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    want = {(r["doc_id"], n, f) for r in more.collect() for n, line in enumerate(r["text"].split("\n")) for t, f in lines.items() if t in line}
    got = {(r["doc_id"], r["line"], r["family"]) for r in licenses.scan(more, scanner).collect()}
    assert want == got, (want - got, got - want)


WRAPPED = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell",
    "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "GPL": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "LGPL": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either",
}


def test_licences_in_wrapped_lines(spark, scanner):
    every = list(WRAPPED.items())
    for family, text in licenses.TEMPLATES:
        cut = text.split()
        every.append((family, "\n".join(" ".join(cut[k : k + 4]) for k in range(0, len(cut), 4))))
    marks = (("", ""), ("/*\n", " * "), ("", "# "), ("", "// "), ("", "dnl "))
    rows = [(f"{n} {k}", "int main;\n\n" + top + "\n".join(mark + line for line in text.split("\n")) + "\n\nend", family, 2 + bool(top)) for n, (top, mark) in enumerate(marks) for k, (family, text) in enumerate(every)]
    found = {(r["doc_id"], r["family"], r["line"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string, family string, at int"), scanner).collect()}
    missed = [(k, f, at) for k, _, f, at in rows if (k, f, at) not in found]
    assert not missed, missed


def test_licences_leave_others_alone(spark, scanner, odd, empty):
    texts = ["He has a license to drive under the bridge.", "The general public may redistribute flyers.", "MIT opened a new building; version 2.0 of it.", "permission was granted", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert licenses.scan(rows, scanner).count() == 0
    assert licenses.scan(odd, scanner).count() == 0 and licenses.scan(empty, scanner).count() == 0
    plan = licenses.scan(odd, scanner)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_confirmed_paragraph_has_an_anchor():
    marks = licenses.anchors()
    for _, text in licenses.TEMPLATES:
        own = set("".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split())
        assert len(own & marks) > len(own) * (1 - licenses.CONFIRM)


def test_licences_learn_from_every_paragraph(spark):
    words = "the of this and software public under file may for".split()
    texts = [f"a{n} " + " ".join(words[(n * 7 + k) % 10] for k in range(n % 4)) + f" b{n}" for n in range(9000)] + [None, "", "...", "the license of the software, a licence\n\nc the public\nrem file of"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    terms = licenses.vocabulary()

    def plain(word_list):
        own = set(word_list) | {f"{a} {b}" for a, b in zip(word_list, word_list[1:])}
        return tuple(sorted(own & set(terms)))

    rows = licenses.paragraphs(docs).select("words").collect()
    want = collections.Counter(plain(r["words"]) for r in rows)
    cells = licenses.held_cells(docs, terms).collect()
    got = collections.Counter()
    for r in cells:
        got[tuple(r["held"])] += r["n"]
    assert got == want and sum(got.values()) == len(rows) > 9000
    assert 0.4 < sum(r["n"] for r in cells if r["first"]) / len(rows) < 0.6
    whole = licenses.paragraphs(docs).select(licenses.held(F.col("words"), terms).alias("held")).groupBy("held").count().collect()
    assert {tuple(r["held"]): r["count"] for r in whole} == dict(want)


def test_licence_threshold_is_the_quantile_of_all_rows(spark):
    rows = [(round((k % 701) / 701, 6), 1 + k % 3) for k in range(5000)] + [(0.9, 400), (0.9000000001, 1)]
    table = spark.createDataFrame(rows, "probability double, n long").cache()
    every = sorted(p for p, n in rows for _ in range(n))
    for share in (0.0, 0.1, 0.5, 0.9, 0.999, 1.0):
        at = share * (len(every) - 1)
        low, high = every[math.floor(at)], every[math.ceil(at)]
        want = max(0.5, low + (high - low) * (at - math.floor(at)))
        assert licenses._quantile(table, share, len(every), 0.5) == pytest.approx(want, abs=1e-12)


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_languages_held_out(spark, more):
    got = {r["doc_id"]: r for r in QUERIES["op4_language_id"](spark, SF).collect()}
    rows = more.collect()
    assert len(got) == len(rows) and all(got[r["doc_id"]]["held_out"] == is_held_out(r["doc_id"]) for r in rows)
    test = [r for r in rows if is_held_out(r["doc_id"])]
    right = sum(got[r["doc_id"]]["lang_pred"] == r["lang"] for r in test)
    assert right >= 0.95 * len(test)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_languages_odd_rows(odd, empty, more):
    model = langid.train(more)
    got = [(r["id"], r["lang_pred"], r["score"]) for r in langid.identify(odd, model).collect()]
    assert len(got) == odd.count()
    assert {(i, p, s) for i, p, s in got if i in (1, 2, 6)} == {(i, "und", 0.0) for i in (1, 2, 6)}
    assert {p for i, p, _ in got if i in (4, 5)} <= set(model.classes)
    assert langid.identify(empty, model).count() == 0
    assert langid.train(empty) is None
    assert {r["lang_pred"] for r in langid.identify(odd, None).collect()} == {"und"}


def test_quality_held_out(spark, more):
    got = {r["doc_id"]: r for r in QUERIES["op5_quality_classifier"](spark, SF).collect()}
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if is_held_out(r["doc_id"])]
    assert len(got) == more.count()
    right = sum(got[r["doc_id"]]["predicted"] == r["quality"] for r in labels)
    assert right >= 0.93 * len(labels)
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())


def test_quality_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, None), (8, 1), (8, 0), (None, 1)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    scored = quality.score(odd, model)
    assert scored.count() == odd.count() and scored.filter("score BETWEEN 0 AND 1").count() == odd.count()
    assert quality.drop_poor(odd, model, threshold=0).columns == odd.columns
    assert quality.drop_poor(odd, model, threshold=0).exceptAll(odd).count() == 0
    assert quality.score(empty, model).count() == 0 and quality.train(empty, labels) is None
    assert quality.train(odd, labels.limit(0)) is None


def test_quality_learns_from_all_passages(spark, monkeypatch):
    texts = [(k, f"{k} " + "word " * 1500 + "junk in the second third " + "end " * 1500) for k in range(12)] + [(12, "x" * 3000)]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in texts], "doc_id long, quality int")
    seen, plain = set(), quality.encode_passages
    monkeypatch.setattr(quality, "encode_passages", lambda some: seen.update(some) or plain(some))
    quality.train(rows, labels)
    monkeypatch.undo()
    kept = {t.encode() for k, t in texts if not is_held_out(k)}
    assert seen == kept


def test_a_text_in_slices_scores_as_at_once():
    model = quality.GatedAttention.fresh()
    for text in (b"", b"abc", b"some words. " * 300_000):
        assert model.score_text(text) == pytest.approx(float(model.score(*quality.encode_passages([text]))[0]), abs=1e-4)


def test_samples_keep_every_label_when_rows_repeat(spark):
    """Labels with few ids over many rows, and one document thousands of times, don't crowd others out."""
    ids = spark.range(4000).select((F.col("id") % 5).alias("doc_id"), F.lit(1).alias("quality"))
    labels = ids.unionByName(spark.range(100, 4100).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality")))
    dealt = labels.select(F.col("quality").alias("label"), F.xxhash64("doc_id").alias("deal"), F.lit(1).cast("long").alias("size"))
    got = {r["label"]: r["count"] for r in langid.first_by_hash(dealt, 50, 1 << 20).groupBy("label").count().collect()}
    assert got == {0: 50, 1: 5}
    few = langid.first_by_hash(dealt, 50, 7)
    assert {r["label"]: r["count"] for r in few.groupBy("label").count().collect()} == {0: 7, 1: 5}
    own = [(1, "aa aa aa " * 30, "aa")] * 3000 + [(k, f"ein kleiner text {k} und noch einer", "de") for k in range(40)] + [(k, f"the small text {k} and one more", "en") for k in range(40, 80)]
    docs = spark.createDataFrame(own, "doc_id long, text string, lang string")
    seen = {}

    class Recorded(langid.ByteConvNet):
        def fit(self, grid, target, **more):
            seen.update(zip(*[x.tolist() for x in __import__("numpy").unique(target, return_counts=True)]))
            return self

    plain = langid.ByteConvNet
    langid.ByteConvNet = Recorded
    try:
        model = langid.train(docs, rows=60)
    finally:
        langid.ByteConvNet = plain
    kept = {label: sum(not is_held_out(k) for k, _, lang in set(own) if lang == label) for label in ("de", "en")}
    assert model.classes == ["aa", "de", "en"]
    assert seen[0] == 2 and seen[1] == min(20, kept["de"]) and seen[2] == min(20, kept["en"])


def test_languages_learn_from_whole_texts(spark):
    long = "".join(f"wort{k} " for k in range(4000))
    docs = spark.createDataFrame([(1, long, "de"), (2, "short text", "en"), (3, "texte court", "fr")], "doc_id long, text string, lang string")
    rows = []

    class Recorded(langid.ByteConvNet):
        def fit(self, grid, target, **more):
            rows.append(len(grid))
            return self

    plain = langid.ByteConvNet
    langid.ByteConvNet = Recorded
    try:
        langid.train(docs)
    finally:
        langid.ByteConvNet = plain
    sizes = [len(t) for k, t in ((1, long), (2, "short text"), (3, "texte court")) if not is_held_out(k)]
    assert rows == [sum(-(-n // langid.WINDOW) for n in sizes)]


def test_languages_need_a_letter(spark):
    docs = spark.createDataFrame([(1, "½ ² ① 7"), (2, "Ⅷ"), (3, "ʰ"), (None, "wort")], "doc_id long, text string")
    model = langid.ByteConvNet.fresh(["de", "en"])
    got = {r["id"]: r["lang_pred"] for r in langid.identify(docs, model).collect()}
    assert got[1] == got[2] == "und" and got[3] in model.classes
    assert [r[0] for r in docs.select(langid.held_out("doc_id")).collect()].count(None) == 0


def plain_language(model, text):
    """The network place by place, without tables or batches."""
    import numpy as np

    total, weights = np.zeros(len(model.classes)), 0
    for start in range(0, max(len(text), 1), langid.WINDOW):
        window = text[start : start + langid.WINDOW].ljust(langid.WINDOW, b"\0")
        pooled = []
        for width, one in zip(langid.WIDTHS, model.filters):
            places = range(langid.WINDOW - max(langid.WIDTHS) + 1)
            pooled.append(np.max([sum(model.embedding[window[p + i]] @ one[i] for i in range(width)) for p in places], axis=0))
        logits = np.maximum(np.concatenate(pooled) + model.bias, 0) @ model.weights + model.offset
        e = np.exp(logits - logits.max())
        size = sum(b != 0 for b in window)
        total, weights = total + np.log(e / e.sum() + 1e-9) * size, weights + size
    e = np.exp(total / weights - (total / weights).max())
    return model.classes[int(e.argmax())], float(e.max() / e.sum())


def test_language_scores_equal_a_plain_network(spark, more):
    model = langid.train(more)
    rows = [(1, "Das ist ein Text."), (2, "the " * 150 + "end"), (3, "où est passé l'été ?")]
    got = {r["id"]: r for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for i, text in rows:
        name, score = plain_language(model, text.encode())
        assert got[i]["lang_pred"] == name and got[i]["score"] == pytest.approx(score, abs=1e-4)


def plain_quality(model, text):
    """Passage by passage: counts of byte pairs and kinds, gate, weighted mean, logistic."""
    import numpy as np

    w, b, v, u, a, c, d = (p.astype(float) for p in model.params)
    hidden, gates = [], []
    for start in range(0, max(len(text), 1), quality.PASSAGE):
        passage = text[start : start + quality.PASSAGE]
        x = np.zeros(quality.BUCKETS + quality.CLASSES)
        for p, q in zip(passage, passage[1:]):
            at = ((p * 256 + q) * 2654435761 % (1 << 32)) >> (32 - quality.BUCKETS.bit_length() + 1)
            x[at] += at > 0
        for byte in passage:
            x[quality.BUCKETS + int(quality._KIND[byte])] += 1
        x /= max(len(passage), 1)
        x = np.sqrt(x)
        x[quality.BUCKETS :] *= 2
        h = np.tanh(x @ w + b)
        hidden.append(h)
        gates.append(float(np.exp((np.tanh(h @ v) / (1 + np.exp(-(h @ u)))) @ a)[0]))
    z = sum(g * h for g, h in zip(gates, hidden)) / sum(gates)
    return 1 / (1 + np.exp(-(z @ c + d)[0]))


def test_quality_scores_equal_a_plain_network(spark, more):
    model = quality.train(more, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(1, "A plain text. With 2 sentences!"), (2, "x!x!x! " * 400), (3, ""), (4, "Ünï\tcode\n" * 90)]
    got = {r["id"]: r["score"] for r in quality.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert all(got[i] == pytest.approx(plain_quality(model, t.encode()), abs=1e-4) for i, t in rows)
