import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from cohortwise.llm import resample
from cohortwise.llm.queries import QUERIES
from hypothesis import given, settings
from hypothesis import strategies as st

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def grams(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = _WORD.findall(lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def bucket(gram):
    return zlib.crc32(gram.encode()) % 10_000


def brute(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, grams(text)[1]))
    for text in target:
        t.update(map(bucket, grams(text)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        words, found = grams(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in map(bucket, found)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    eligible = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(eligible[: 25 * len(eligible) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


@given(st.text(alphabet=st.sampled_from("aB 1é-\x7f\n漢\0zZ@[`{"), max_size=50))
@settings(max_examples=300, deadline=None)
def test_spans_are_the_runs_of_words(text):
    words, found = grams(text)
    n, buckets = resample.features(text.encode(), [resample.gram_pattern(1), resample.gram_pattern(2)], 10_000)
    assert n == len(words) and buckets.tolist() == [bucket(g) for g in found]


def test_longer_runs():
    _, buckets = resample.features(b"a b c d", [resample.gram_pattern(3)], 1 << 20)
    assert buckets.tolist() == [zlib.crc32(g) % (1 << 20) for g in (b"a b c", b"b c d")]


def test_query_equals_brute_force(spark, sf, docs):
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = QUERIES["op13_importance_resampling"](spark, sf).collect()
    assert sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in got), key=str) == brute(rows, target)


def test_odd_rows(spark, odd):
    target = spark.createDataFrame([(1, "wort text"), (2, None)], "item_id long, text string")
    got = resample.resample(odd, target).collect()
    want = brute([(r["doc_id"], r["text"]) for r in odd.collect()], ["wort text", None])
    # Two equal rows share their score, so either may have the better rank.
    assert sorted((tuple(r[c] for c in ("id", "n_features", "weight", "score", "rank")) for r in got), key=str) == want


@pytest.mark.parametrize("parts", ["1", "9"])
def test_ranks_do_not_depend_on_partitions(spark, parts):
    docs = [(i % 37, f"w{i % 5} " * (15 + i % 11)) for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    target = spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = resample.resample(frame, target).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = brute(docs, ["w1 w2 w3"])
    assert sorted((r["score"], r["rank"]) for r in got if r["rank"]) == sorted((r[3], r[4]) for r in want if r[4])


def test_empty_tables(spark, empty, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resample.resample(empty, none).collect() == []
    assert resample.resample(docs, none).count() == docs.count()
