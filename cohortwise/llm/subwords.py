"""SentencePiece ids of whole texts, with each distinct marked word segmented once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.arrow import pieces

MARK = "▁"
# Words of a text whose ids are put together and decoded at once.
SLICE = 1 << 19
CHANGED = "the documents were not the same when they were read again; pass a written table"
# Bytes of text in a block.
BLOCK_BYTES = 16 << 20
# Buckets of words for each shuffle partition.
BUCKETS = 4
# Bits for a block's number within its partition.
BLOCK_BITS = 32


@lru_cache(maxsize=4)
def processor(model: bytes):
    """The library's processor for a serialized model."""
    import sentencepiece

    made = sentencepiece.SentencePieceProcessor()
    made.LoadFromSerializedProto(model)
    return made


@lru_cache(maxsize=4)
def separable(model: bytes) -> bool:
    """Whether a text may be cut before every run of marks: no piece holds a mark behind another
    character, and spaces become marks one by one, with one more in front of the text."""
    made = processor(model)
    if any(MARK in made.id_to_piece(i).lstrip(MARK) for i in range(made.get_piece_size()) if not made.is_control(i) and not made.is_unknown(i)):
        return False
    return all(made.normalize(t) == MARK + t.replace(" ", MARK) for t in ("a", " a", "a  b ", "  ", " a▁ b\t\n", "Aé①ﬁ"))


def cut_words(texts: list[bytes], cut: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All texts as consecutive words, and the number of words of each text.

    A word is a run of marks (as spaces) with what follows up to the next run. A
    text that is not empty has one mark more in front, an empty one no word.
    Without ``cut`` a whole text is one word.
    """
    mark = MARK.encode()
    marked = [b" " + t.replace(mark, b" ") if cut else t for t in texts if t]
    data = b"".join(marked)
    begins = np.zeros(len(marked), np.int64)
    np.cumsum([len(t) for t in marked[:-1]], out=begins[1:])
    if cut and marked:
        space = np.frombuffer(data, np.uint8) == 32
        space[1:] &= ~space[:-1].copy()
        space[begins] = True
        starts = np.flatnonzero(space)
    else:
        starts = begins
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)]
    )
    counts = np.zeros(len(texts), np.int64)
    counts[[i for i, t in enumerate(texts) if t]] = np.diff(np.searchsorted(starts, np.append(begins, len(data) + 1)))
    return words, counts


def _packed(codes: np.ndarray) -> bytes:
    """Numbers as four planes of bytes, compressed; the upper ones are nearly empty."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * count, codec="zstd", asbytes=True), np.uint8).reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch], cut: bool) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, pa.Array, np.ndarray]]:
    """(rows, block, words of each text, distinct words, each word's number among them); frequent words have small numbers."""
    part = TaskContext.get().partitionId()
    for number, (batch, texts) in enumerate(pieces(batches, limit=BLOCK_BYTES)):
        words, counts = cut_words(texts, cut)
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        # Frequent words first, equally frequent ones in their own order, which packs well.
        alphabet = np.argsort(pc.sort_indices(coded.dictionary).to_numpy())
        order = np.lexsort((alphabet, -np.bincount(codes, minlength=len(coded.dictionary))))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        yield batch, (part << BLOCK_BITS) | number, counts, coded.dictionary.take(pa.array(order)), rank[codes]


def word_uses(rows: DataFrame, cut: bool, buckets: int) -> DataFrame:
    """The distinct words of each block of ``rows`` (id, text), packed by a hash of the word: (bucket, block, n, codes, lengths, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, _, words, _ in _blocks(batches, cut):
            listed = words.to_pylist()
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in listed), np.int32, len(listed))
            order = np.argsort(bucket, kind="stable")
            out = []
            for at in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if listed else []:
                own = [listed[i] for i in at]
                lengths = np.fromiter(map(len, own), np.int64, len(own))
                out.append((bucket[at[0]], block, len(own), _packed(np.diff(at, prepend=0)), _packed(lengths), pa.compress(b"".join(own), codec="zstd", asbytes=True)))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "n", "codes", "lengths", "words"])

    return rows.mapInArrow(run, "bucket int, block bigint, n bigint, codes binary, lengths binary, words binary")


def word_orders(rows: DataFrame, cut: bool) -> DataFrame:
    """(block, ids, counts, distinct, bytes, codes): the texts of each block as the packed numbers of their words."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block, counts, words, codes in _blocks(batches, cut):
            ids = pa.ListArray.from_arrays(pa.array([0, len(batch)], pa.int32()), batch.column(0))
            size = pc.sum(pc.binary_length(words)).as_py() or 0
            columns = [pa.array([block], pa.int64()), ids, pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([len(words)]), pa.array([size], pa.int64()), pa.array([_packed(codes)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "ids", "counts", "distinct", "bytes", "codes"])

    return rows.mapInArrow(run, f"block bigint, ids array<{kind}>, counts array<bigint>, distinct bigint, bytes bigint, codes binary")


def segment(uses: DataFrame, model: bytes, parts: int, cut: bool = True) -> DataFrame:
    """The table of distinct words: each is segmented once, and its ids go to all blocks that use it.

    Uses of a word have one bucket, and a block names a word once, so no word is hot. Columns: of (the block), n, bytes, codes, sizes,
    pieces, packed for the words of one block and bucket.
    """
    shared = uses.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = processor(shared.value)
        alone = [made.piece_to_id(MARK)]  # of a word that is one mark
        for blocks, counts, codes, words in _by_bucket(batches):
            coded = words.dictionary_encode()
            distinct, numbers = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
            # The library puts the first mark in front by itself, except in front of nothing.
            found = made.encode([w.decode()[1 if cut else 0 :] for w in distinct], num_threads=1)
            found = [ids or alone for ids in found] if cut else found
            sizes, lengths = np.array([len(ids) for ids in found], np.int64), np.array([len(w) for w in distinct])
            flat, edges = np.array([i for ids in found for i in ids], np.uint32), np.concatenate(([0], np.cumsum(sizes)))
            out = []
            for block, n, code, one in zip(blocks, counts, codes, np.split(numbers, np.cumsum(counts)[:-1])):
                out.append((block, n, int(lengths[one].sum()), code, _packed(sizes[one]), _packed(_gather(flat, edges, one))))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["of", "n", "bytes", "codes", "sizes", "pieces"])

    together = uses.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return together.mapInArrow(run, "of bigint, n bigint, bytes bigint, codes binary, sizes binary, pieces binary")


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int], list[bytes], pa.Array]]:
    """(blocks, words of each, their packed codes, all words) of one bucket after the other; a very large one comes in several parts."""
    now, held, size = None, [], 0

    def joined() -> tuple:
        lengths = np.concatenate([_unpacked(z, n).astype(np.int64) for _, n, _, z, _ in held])
        ends = np.concatenate(([0], np.cumsum(lengths)))
        sums = np.add.reduceat(lengths, np.cumsum([0] + [n for _, n, *_ in held[:-1]]))
        data = b"".join(pa.decompress(w, int(k), codec="zstd", asbytes=True) for (*_, w), k in zip(held, sums))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        return [b for b, *_ in held], [n for _, n, *_ in held], [c for _, _, c, *_ in held], words

    for batch in batches:
        for bucket, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (bucket != now or size > BLOCK_BYTES):
                yield joined()
                held, size = [], 0
            now = bucket
            held.append(rest)
            size += len(rest[-1])
    if held:
        yield joined()


def _dictionary(found: pa.Table, distinct: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a block's words, one word behind the other, and where each word's ids begin."""
    codes, sizes, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for n, c, z, p in zip(*(found.column(k).to_pylist() for k in ("n", "codes", "sizes", "pieces"))):
        codes.append(np.cumsum(_unpacked(c, n).astype(np.int64)))
        sizes.append(_unpacked(z, n).astype(np.int64))
        flat.append(_unpacked(p, int(sizes[-1].sum())))
    codes, sizes, flat = (np.concatenate(x) for x in (codes, sizes, flat))
    if len(codes) != distinct or len(np.unique(codes)) != distinct or sum(found.column("bytes").to_pylist()) != size:
        raise RuntimeError(CHANGED)
    order = np.argsort(codes)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    return _gather(flat, edges, order), np.concatenate(([0], np.cumsum(sizes[order])))


def encode(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """(id, pieces, decoded) for every row: the ids the library gives for the whole text, and the text it decodes from them.

    Texts are cut into marked words in blocks of some megabytes (or one longer text). Every block names its
    distinct words; these are brought together from all blocks and each is segmented once. Its ids go back to
    the blocks, where the texts, which moved as word numbers only, are put together by position.

    ``docs`` is read twice, so pass a table that is the same both times; a difference raises. A model whose pieces can
    cross a mark, or whose normaliser does more than mark spaces, has whole texts for words. Null
    text counts as empty, with no ids. Repeated rows each get a row; other columns are not read; an empty table
    gives no rows. Without ``decode`` the decoded text is null.
    """
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    with open(model_path, "rb") as file:
        model = file.read()
    cut = separable(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = segment(word_uses(rows, cut, BUCKETS * parts), model, parts, cut)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def assemble(block: pa.Table, found: pa.Table) -> pa.Table:
        made = processor(shared.value)
        if len(block) != 1:
            raise RuntimeError(CHANGED)
        counts = block.column("counts")[0].as_py()
        flat, edges = _dictionary(found, block.column("distinct")[0].as_py(), block.column("bytes")[0].as_py())
        codes = _unpacked(block.column("codes")[0].as_py(), sum(counts))
        ends = np.cumsum(counts).tolist()
        out, texts = [], []
        for start, stop in zip([0, *ends], ends):
            parts, said = [np.zeros(0, np.int32)], []
            for k in range(start, stop, SLICE):
                parts.append(_gather(flat, edges, codes[k : min(k + SLICE, stop)]).astype(np.int32))
                if decode:
                    said.append(made.decode(parts[-1].tolist()))
            out.append(np.concatenate(parts))
            # Every slice starts with a mark, which decoding takes off.
            texts.append(" ".join(said) if decode else None)
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in out]))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out)))
        ids = pa.concat_arrays([chunk.flatten() for chunk in block.column("ids").chunks])
        return pa.table([ids, lists, pa.array(texts, pa.string())], ["id", "pieces", "decoded"])

    grouped = word_orders(rows, cut).groupBy("block").cogroup(found.groupBy("of"))
    return grouped.applyInArrow(assemble, f"id {kind}, pieces array<int>, decoded string")


def _gather(flat: np.ndarray, edges: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The lists of these numbers, one behind the other."""
    codes = codes.astype(np.int64)
    sizes = edges[codes + 1] - edges[codes]
    ends = np.cumsum(sizes)
    return flat[np.arange(sizes.sum()) + np.repeat(edges[codes] - (ends - sizes), sizes)]
