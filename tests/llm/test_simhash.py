import random

import numpy as np
import pytest
import xxhash
from cohortwise.llm import simhash
from cohortwise.llm.components import components
from cohortwise.llm.skew import left_join_hot


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    marks = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(m >> b & 1 for m in marks) > len(marks))


def classes(marks, radius=4):
    """Smallest index reachable over links, by brute force."""
    marks = np.array(marks, np.uint64)
    near = np.bitwise_count(marks[:, None] ^ marks[None]) <= radius
    label = np.arange(len(marks))
    while True:
        new = np.where(near, label[None], len(marks)).min(1)
        if (new == label).all():
            return label
        label = new


def test_fingerprints(docs, odd):
    for table in (docs, odd):
        got = sorted((r["id"] is None, r["id"] or 0, r["fp"] & (2**64 - 1)) for r in simhash.fingerprints(table).collect())
        assert got == sorted((r["doc_id"] is None, r["doc_id"] or 0, plain_fingerprint(r["text"])) for r in table.collect())


def test_components_of_documents(docs):
    rows = sorted((r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect())
    label = classes([f for _, f in rows])
    got = {r["id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: rows[k][0] for (i, _), k in zip(rows, label)}


@pytest.mark.parametrize("blocks,dense", [(1, 256), (3, 256), (3, 4)])
def test_links_reach_what_brute_force_reaches(spark, blocks, dense):
    rng = random.Random(blocks * 100 + dense)
    marks = set()
    for _ in range(12):  # clouds of fingerprints a few bits apart, and lone ones
        centre = rng.getrandbits(64)
        marks |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(20)}
    marks |= {rng.getrandbits(64) for _ in range(200)}
    marks |= {0, 1, 2**64 - 1, 2**63}
    marks = sorted(marks)
    signed = [(m - 2**64 if m >= 2**63 else m,) for m in marks]
    edges = simhash.link(spark.createDataFrame(signed, "fp long"), blocks=blocks, dense=dense)
    root = {r["node"]: r["root"] for r in components(edges).collect()}
    label = classes(marks)
    got = [root.get(s, s) for (s,) in signed]
    groups = {}
    for k, g in zip(label, got):
        groups.setdefault(int(k), set()).add(g)
    assert all(len(g) == 1 for g in groups.values()) and len(set(got)) == len(groups)


def test_odd_rows(odd, empty):
    got = [tuple(r) for r in simhash.near_duplicates(odd).collect()]
    assert len(got) == odd.count()
    assert {(i, c) for i, f, c in got if f == 0 and i is not None} == {(1, 1), (2, 1)}
    assert {c for i, _, c in got if i in (4, 5)} == {4}
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()) == sorted({c for i, _, c in got if i is not None and i == c})
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(30)], [(0, i) for i in range(1, 300)] + [(500, 501)]])
def test_components(spark, edges):
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: (500 if n >= 500 else 0) for e in edges if e[0] != e[1] for n in e}
    assert got == want


def test_hot_join(spark):
    left = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN -1L WHEN id % 7 = 0 THEN NULL ELSE id END AS k", "id")
    right = spark.createDataFrame([(-1, "hot"), (1, "one")], "k long, v string")
    got = sorted((str(r["k"]), r["id"], str(r["v"])) for r in left_join_hot(left, right, "k").collect())
    assert got == sorted((str(r["k"]), r["id"], str(r["v"])) for r in left.join(right, "k", "left").collect())
