import hashlib
from functools import lru_cache

import pytest
from cohortwise.llm import subwords
from cohortwise.llm.queries import QUERIES
from hypothesis import given, settings
from hypothesis import strategies as st


@lru_cache
def model():
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@lru_cache
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def by_words(text):
    words, counts = subwords.cut_words([text.encode()])
    return [i for w in words.to_pylist() for i in library().encode(w.decode()[1:]) or [library().piece_to_id("▁")]], counts


@given(st.text(alphabet=st.sampled_from("ab ▁\n\té漢\0́😀.1<s>"), max_size=60))
@settings(max_examples=400, deadline=None)
def test_words_give_the_ids_of_the_whole_text(text):
    ids, _ = by_words(text)
    assert ids == library().encode(text)


def test_this_model_can_be_cut():
    assert subwords.separable(model())


def test_query_equals_the_library(spark, sf, docs):
    got = {r["doc_id"]: r for r in QUERIES["op11_sentencepiece"](spark, sf).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library().encode(r["text"] or "")
        assert got[r["doc_id"]]["n_tokens"] == len(ids)
        assert got[r["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(library().decode(ids).encode()).hexdigest()


def expected(rows):
    out = []
    for r in rows:
        ids = library().encode(r["text"] or "")
        out.append((r["doc_id"], ids, library().decode(ids)))
    return sorted(out, key=str)


@pytest.mark.parametrize("cut", [True, False])
def test_odd_rows(spark, odd, cut, monkeypatch):
    if not cut:  # a model that can't be cut has whole texts for words
        monkeypatch.setattr(subwords, "separable", lambda m: False)
    got = sorted([(r["id"], r["pieces"], r["decoded"]) for r in subwords.encode(odd).collect()], key=str)
    assert got == expected(odd.collect())


def test_text_in_slices(spark, odd, monkeypatch):
    """A text of more words than a slice is put together and decoded slice by slice."""
    assert subwords.SLICE > 1000
    text = ("alpha  beta\ngamma ▁ δέλτα " * 130_000).strip()
    frame = spark.createDataFrame([("x", text), ("y", " "), ("z", "  ")], "doc_id string, text string")
    got = {r["id"]: r for r in subwords.encode(frame).collect()}
    for name, said in (("x", text), ("y", " "), ("z", "  ")):
        ids = library().encode(said)
        assert got[name]["pieces"] == ids and got[name]["decoded"] == library().decode(ids)


def test_empty_table(empty):
    assert subwords.encode(empty).collect() == []


def test_each_distinct_word_is_segmented_once(spark):
    frame = spark.createDataFrame([(i, "eins zwei drei eins") for i in range(50)], "id long, text string").repartition(7)
    uses = subwords.word_uses(frame, True, 5).collect()
    assert sum(r["n"] for r in uses) == 3 * 7 and len({r["block"] for r in uses}) == 7
    seen = []
    plain = subwords.processor(model())

    class Counted:
        def encode(self, texts, **more):
            seen.extend(texts)
            return plain.encode(texts, **more)

        def piece_to_id(self, piece):
            return plain.piece_to_id(piece)

    import pyarrow as pa

    rows = sorted([(r["bucket"], r["block"], r["n"], bytes(r["codes"]), bytes(r["lengths"]), bytes(r["words"])) for r in uses])
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["bucket", "block", "n", "codes", "lengths", "words"])
    for blocks, counts, codes, words in subwords._by_bucket(iter([batch.slice(0, 4), batch.slice(4)])):
        assert len(blocks) == len(counts) == len(codes) and sum(counts) == len(words)
        Counted().encode([w.decode()[1:] for w in words.dictionary_encode().dictionary.to_pylist()])
    assert sorted(seen) == ["drei", "eins", "zwei"]


def test_different_rows_at_the_second_read_raise(spark):
    real = subwords.word_orders

    def other(rows, cut):
        return real(spark.createDataFrame([(1, "ganz anders")], "id long, text string").coalesce(1), cut)

    frame = spark.createDataFrame([(1, "eins zwei")], "doc_id long, text string").coalesce(1)
    subwords.word_orders = other
    try:
        with pytest.raises(Exception, match="read again"):
            subwords.encode(frame).collect()
    finally:
        subwords.word_orders = real
