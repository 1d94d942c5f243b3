import random
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from cohortwise.llm import pack
from hypothesis import given, settings
from hypothesis import strategies as st


@lru_cache
def slow():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return slow()


@given(st.text(max_size=300))
@settings(max_examples=200, deadline=None)
def test_ids_equal_tokenizers(text):
    for t in (text, text + "<|endoftext|>" + text):
        assert pack._encoder(None, None)(t).tolist() == slow().encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 100_000, " " * 100_000, "\n \t" * 30_000, "^" * 50_000, "1" * 70_000, "é\u200d" * 20_000])
def test_ids_of_very_long_runs(text):
    assert pack._encoder(None, None)(text).tolist() == slow().encode(text, add_special_tokens=False).ids


def check_places(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_documents(docs, odd, empty, tokenizer):
    for table in (docs, odd):
        rows = pack.pack_documents(table).collect()
        found = defaultdict(list)
        for r in rows:
            found[r["id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        want = defaultdict(list)
        for d in table.collect():
            ids = np.array(tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [0], "<u4")
            stops = list(range(len(ids), 0, -2048))[::-1]
            for n, (a, b) in enumerate(zip([0, *stops[:-1]], stops)):
                want[d["doc_id"]].append((n, a, b - a, zlib.crc32(ids[a:b].tobytes())))
        assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
        bins = check_places(rows, 2048)
        assert bins <= 1.02 * sum(r["length"] for r in rows) / 2048 + 1
    assert pack.pack_documents(empty).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_bins_against_item_by_item(seed):
    """Runs over a histogram place as many bins as the same rules applied to one piece after the other."""
    rng = random.Random(seed)
    top = [40, 100, 100, 60, 33, 100][seed]
    sizes = [rng.randint(1, top) for _ in range(400)] + [rng.randint(34, 50) for _ in range(50 * (seed % 2))]
    histogram = {n: sizes.count(n) for n in set(sizes)}
    placed = pack.plan_bins(histogram, 100)
    bins = defaultdict(list)
    ranks = defaultdict(list)
    for length, rank, count, each, at, offset in placed:
        ranks[length] += range(rank, rank + count)
        for k in range(count):
            bins[at + k // each].append((offset + k % each * length, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= 100
    large = sorted((n for n in sizes if 3 * n > 100), reverse=True)
    gaps = []
    while large:
        a = large.pop(0)
        fit = next((k for k, b in enumerate(large) if a + b <= 100), None)
        gaps.append(100 - a - (large.pop(fit) if fit is not None else 0))
    for n in sorted((n for n in sizes if 3 * n <= 100), reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(100 - n)
        else:
            gaps[gaps.index(fit)] -= n
    assert len(bins) == len(gaps)


def test_sequences_hold_their_ids(docs):
    packed = pack.pack_documents(docs, ids=True)
    total = {r["sequence_id"]: r["length"] for r in packed.groupBy("sequence_id").agg({"length": "sum"}).withColumnRenamed("sum(length)", "length").collect()}
    assert {r["sequence_id"]: len(r["ids"]) for r in pack.sequences(packed).collect()} == total
