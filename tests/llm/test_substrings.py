import hashlib
import random

import pytest
from cohortwise.llm import substrings


def brute(rows, n=13):
    """Windows of every document in the order of ids; a window that an earlier id also starts goes."""
    words = [(i, (t or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ")) for i, t in rows]
    words = [(i, [w for w in ws if w]) for i, ws in words]
    first = {}
    for i, ws in words:
        if i is not None:
            for k in range(len(ws) - n + 1):
                key = tuple(ws[k : k + n])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, ws in words:
        gone = [False] * len(ws)
        if i is not None:
            for k in range(len(ws) - n + 1):
                if first[tuple(ws[k : k + n])] < i:
                    gone[k : k + n] = [True] * n
        kept = " ".join(w for w, g in zip(ws, gone) if not g)
        out.append((str(i), len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(table):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(table).collect())


def test_documents(docs, odd, empty):
    assert result(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert result(odd) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert result(empty) == []


@pytest.mark.parametrize("seed", range(3))
def test_planted_passages(spark, seed, monkeypatch):
    monkeypatch.setattr(substrings, "COMBINE_BYTES", [500, 1 << 23, 3000][seed])
    monkeypatch.setattr(substrings, "HASH_BYTES", [100, 1 << 20, 1000][seed])
    rng = random.Random(seed)
    shared = [[rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(rng.choice([7, 12, 13, 14, 20, 60]))] for _ in range(12)]
    rows = []
    for i in range(150):
        ws = []
        for _ in range(rng.randrange(6)):
            ws += rng.choice(shared)[rng.randrange(3) :] if rng.random() < 0.6 else [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(15))]
        rows.append((rng.choice([i, -i, i * 10**12]), rng.choice([" ", "\n", " \t "]).join(ws)))
    rows += [(7000 + i, "the same very long line of words that comes again and again in a third of all documents") for i in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(table) == brute(rows)


def test_only_ascii_white_space_parts_words(spark):
    rows = [(1, "a b c \x1c d\x85e"), (2, "ä\x0bö\x0cü\r\nß")]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
