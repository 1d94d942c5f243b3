import hashlib
import os
import random
import sys
import zlib
from collections import defaultdict

import pytest
from cohortwise.llm import trie
from cohortwise.llm.contraction import subtree_totals
from cohortwise.llm.queries import ORACLES, QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle import compare, duck  # noqa: E402


def brute_totals(rows):
    up = {n: p for n, p, *_ in rows}
    out = defaultdict(lambda: [0, 0])
    for n, _, a, b in rows:
        at = n
        while at is not None:
            out[at][0] += a or 0
            out[at][1] += b or 0
            at = up[at]
    return {n: tuple(v) for n, v in out.items()}


def shapes():
    rng = random.Random(5)
    chain = [(i, i - 1 if i else None, i, 1) for i in range(70)]
    star = [(0, None, 1, 1)] + [(i, 0, i, 1) for i in range(1, 500)]
    deal = [(i * 7 + 3, None if i == 0 else rng.randrange(max(0, i - 4), i) * 7 + 3, rng.randrange(100), rng.choice([1, None])) for i in range(200)]
    broom = [(i, i - 1 if i else None, 1, 1) for i in range(40)] + [(100 + i, 39, 2, 1) for i in range(80)] + [(300 + i, 30, 3, 1) for i in range(5)]
    forest = [(i, None if i % 3 == 0 else i - 1, i, 1) for i in range(90)]
    return {"chain": chain, "star": star, "random": deal, "broom": broom, "forest": forest, "one": [(9, None, 4, 5)], "none": []}


@pytest.mark.parametrize("shape", sorted(shapes()))
def test_contraction_equals_walking_up(spark, shape):
    rows = shapes()[shape]
    tree = spark.createDataFrame(rows, "node long, parent long, a long, b long")
    got = {r["node"]: (r["a"], r["b"]) for r in subtree_totals(tree, ["a", "b"]).collect()}
    assert got == brute_totals(rows)


def test_a_circle_fails(spark):
    tree = spark.createDataFrame([(1, 2, 1), (2, 1, 1)], "node long, parent long, a long")
    with pytest.raises(RuntimeError):
        subtree_totals(tree, ["a"], max_rounds=3)


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        kids = [p for p in below if len(p) == len(prefix) + 1]
        leaves = sum(1 for p in below if not any(q[:-1] == p for q in members if q))
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(prefix))))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(convs), len(prefix), parent, len(convs), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_query_equals_sql(spark, sf):
    assert compare(QUERIES["op12_prefix_trie"](spark, sf), duck(sf), ORACLES["op12_prefix_trie"]) == ""


def test_odd_conversations_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "", None, "bb"])) for c in range(0, 60) for t in range(rng.randrange(1, 12))]
    rows += [(61, None, "user", "x"), (61, 0, "user", "y"), (61, 0, "user", "y"), (61, 0, None, None), (62, 5, "user", "a")]
    rows += [(None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(c, 0, "user", "hello") for c in range(100, 140)] + [(c, 1, "assistant", "same") for c in range(100, 140)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert trie_rows(trie.prefix_trie(frame)) == brute_trie(rows)


def test_one_long_conversation_and_other_columns(spark, monkeypatch):
    """Sums in slices and digests in slabs give the same; columns with names of ours don't clash."""
    monkeypatch.setattr(trie, "SLICE", 7)
    monkeypatch.setattr(trie, "SLAB", 5)
    rows = [(10, i, "user", f"t{i % 4}") for i in range(80)] + [(15, i, "user", f"t{i % 4}") for i in range(80)] + [(c, 0, "user", "x") for c in range(200, 260)]
    frame = spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA + ", prefix string, pos int, node int")
    assert trie_rows(trie.prefix_trie(frame)) == brute_trie(rows)


def test_no_conversations(spark):
    assert trie_rows(trie.prefix_trie(spark.createDataFrame([], SCHEMA))) == []
    assert trie_rows(trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))) == []
