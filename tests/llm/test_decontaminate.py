import random
import re
from itertools import combinations

import pytest
from cohortwise.llm import decontaminate as d


def words(text):
    return [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]


def brute(docs, items):
    """All alignments, word by word. Eleven of thirteen words in at most three runs leave four in a row, so alignments without these are passed over."""
    found = set()
    for i, text in docs:
        ws = words(text)
        four = {}
        for p in range(len(ws) - 3):
            four.setdefault(tuple(ws[p : p + 4]), []).append(p)
        for k, item in items:
            own = words(item)
            for shift in {p - j for j in range(len(own) - 3) for p in four.get(tuple(own[j : j + 4]), ())}:
                close = [
                    j
                    for j in range(max(0, -shift), min(len(own), len(ws) - shift) - d.WINDOW + 1)
                    if sum(own[j + x] != ws[j + shift + x] for x in range(d.WINDOW)) <= d.SUBSTITUTIONS
                ]
                if close:
                    a, b = min(close), max(close) + d.WINDOW
                    found.add((str(i), str(k), a + shift, b + shift, a, b, sum(own[j] != ws[j + shift] for j in range(a, b))))
    return sorted(found)


def result(docs, items):
    return sorted((str(r[0]), str(r[1]), *r[2:]) for r in d.overlaps(docs, items).collect())


def test_masks_hit_every_window_with_two_substitutions():
    for gone in combinations(range(d.WINDOW), d.SUBSTITUTIONS):
        assert any(all(p + o not in gone for o in m) for m in d.MASKS for p in range(d.WINDOW - m[-1]))


@pytest.mark.parametrize("limit", [d.BROADCAST_WORDS, -1])
def test_planted_passages(spark, monkeypatch, limit):
    monkeypatch.setattr(d, "BROADCAST_WORDS", limit)
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(500)}"
    items = [(k, " ".join(word() for _ in range(rng.choice([5, 12, 13, 14, 20, 45])))) for k in range(25)]
    items += [(100, items[5][1]), (101, None), (102, ""), (None, "all of these words belong to an item that has no number of its own here")]
    rows = []
    for i in range(60):
        ws = [word() for _ in range(rng.randrange(40))]
        for _ in range(rng.randrange(3)):
            own = (rng.choice(items)[1] or "").split()
            own = [word() if rng.random() < 0.08 else w.upper() + rng.choice(["", ",", "."]) for w in own]
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = own[rng.randrange(4) :]
        rows.append((i, " ".join(ws)))
    rows += [(None, items[-1][1]), (7, items[3][1]), (7, items[3][1]), (90, None), (91, ""), (92, " ".join(items[4][1:]) * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    assert result(docs, table) == brute(rows, items)


def test_documents(spark, docs, sf, odd, empty):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert result(docs, benchmark) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in benchmark.collect()])
    assert result(odd, benchmark) == [] and result(empty, benchmark) == [] and result(docs, benchmark.limit(0)) == []


def test_stage(spark, odd):
    item = spark.createDataFrame([(1, "ein kleiner Text mit genug Wörtern für ein Fenster von 13 Wörtern und noch mehr")], "item_id long, text string")
    kept = d.drop_contaminated(odd, item)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in odd.collect() if r["doc_id"] not in (4, 5))


def test_plan_has_no_python(spark, docs, sf):
    plan = d.overlaps(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
