"""Language identification with a byte convolutional network, trained here in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.llm.arrow import pieces
from cohortwise.session import materialize

UNKNOWN = "und"
# Bytes of a window; the last window of a text is filled up with zeros.
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
# The sample that training may use, documented bounds: labelled rows, each with its whole text, and bytes of all of them.
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 16 << 20
# Windows seen in training, over all passes, if there are fewer than so many; else each is seen once.
LEARN_WINDOWS = 40_000
# More labels than this are no languages.
MOST_LABELS = 1000
_LETTER = regex.compile(r"\p{L}")


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned from; a row without an id is not among them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts as zero-filled windows, and the text that each window belongs to."""
    counts = [max(1, -(-len(t) // WINDOW)) for t in texts]
    filled = b"".join(t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts))
    return np.frombuffer(filled, np.uint8).reshape(-1, WINDOW), np.repeat(np.arange(len(texts)), counts)


@dataclass
class ByteConvNet:
    """Embedding, filters of several widths, rectified maximum over the window, softmax."""

    classes: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # one per width: width x EMBEDDING x FILTERS
    bias: np.ndarray
    weights: np.ndarray  # all filters x classes
    offset: np.ndarray
    _tables: list = field(default_factory=list, repr=False)

    @classmethod
    def fresh(cls, classes: list[str], seed: int = 7) -> ByteConvNet:
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        filters = [rng.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS)).astype("f4") for w in WIDTHS]
        embedding = rng.normal(0, 1, (256, EMBEDDING)).astype("f4")
        return cls(classes, embedding, filters, np.zeros(n, "f4"), rng.normal(0, n**-0.5, (n, len(classes))).astype("f4"), np.zeros(len(classes), "f4"))

    def _responses(self, grid: np.ndarray) -> np.ndarray:
        """Every filter at every place, windows x places x filters.

        A filter's response is a sum over its bytes, so responses to each pair
        of bytes are tabled once and a place needs one look-up per two bytes.
        """
        if not self._tables:
            taps = np.zeros((max(WIDTHS), 256, len(self.bias)), "f4")
            for k, (width, one) in enumerate(zip(WIDTHS, self.filters)):
                taps[:width, :, k * FILTERS : (k + 1) * FILTERS] = np.einsum("be,wef->wbf", self.embedding, one)
            self._tables = [(taps[i][:, None] + taps[i + 1][None]).reshape(65536, -1) for i in range(0, max(WIDTHS), 2)]
        code = grid[:, :-1].astype(np.int32) * 256 + grid[:, 1:]
        places = grid.shape[1] - max(WIDTHS) + 1
        out = self._tables[0][code[:, :places]]
        for i, table in enumerate(self._tables[1:], 1):
            out += table[code[:, 2 * i : 2 * i + places]]
        return out

    def logits(self, grid: np.ndarray) -> np.ndarray:
        pooled = np.concatenate([self._responses(grid[k : k + 64]).max(1) for k in range(0, len(grid), 64)])
        return np.maximum(pooled + self.bias, 0) @ self.weights + self.offset

    def fit(self, grid: np.ndarray, target: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 3e-3, seed: int = 7) -> ByteConvNet:
        """Adam on the cross-entropy, classes weighted evenly. Only the place of each maximum gets a gradient."""
        rng = np.random.default_rng(seed)
        share = 1 / np.maximum(np.bincount(target, minlength=len(self.classes)), 1)
        cost = (share / (share[target].mean()))[target]
        params = [self.embedding, *self.filters, self.bias, self.weights, self.offset]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(grid))
            for k in range(0, len(order), batch):
                at = order[k : k + batch]
                step += 1
                self._tables = []
                grads = self._gradients(grid[at], target[at], cost[at])
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self._tables = []
        return self

    def _gradients(self, grid: np.ndarray, target: np.ndarray, cost: np.ndarray) -> list[np.ndarray]:
        places = grid.shape[1] - max(WIDTHS) + 1
        seen = self.embedding[grid]
        best, tops = [], []
        for width, one in zip(WIDTHS, self.filters):
            out = sum(seen[:, i : i + places] @ one[i] for i in range(width))
            best.append(out.argmax(1))
            tops.append(out.max(1))
        pooled = np.concatenate(tops, 1) + self.bias
        hidden = np.maximum(pooled, 0)
        scores = softmax(hidden @ self.weights + self.offset)
        scores[np.arange(len(grid)), target] -= 1
        scores *= cost[:, None] / len(grid)
        scores = scores.astype("f4")
        back = (scores @ self.weights.T) * (pooled > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_filters = []
        for k, (width, one) in enumerate(zip(WIDTHS, self.filters)):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            d_one = np.zeros_like(one)
            for i in range(width):
                bytes_ = grid[np.arange(len(grid))[:, None], best[k] + i]
                d_one[i] = np.einsum("nfe,nf->ef", self.embedding[bytes_], g)
                np.add.at(d_embedding, bytes_, g[:, :, None] * one[i].T[None])
            d_filters.append(d_one)
        return [d_embedding, *d_filters, back.sum(0), hidden.T @ scores, scores.sum(0)]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def first_by_hash(rows: DataFrame, quota: int, byte_quota: int) -> DataFrame:
    """Of each label of (label, deal, size) the first rows by ``deal``, a hash: at most ``quota``, and no more
    bytes than ``byte_quota`` (but one row at least). Repeated rows count once.

    Of a label with many more rows, only those whose hash is small enough for
    about four times the quota are ranked, so no task sees more than that. Should a label
    come out short for that reason, it is ranked again with a larger share.
    """
    rows = materialize(rows.select("label", "deal", "size").distinct(), "dealt")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().orderBy("label").limit(MOST_LABELS + 1).collect()}
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} different labels")
    steps, factor = 1 << 40, 4
    while True:
        share = F.lit(0)
        for label, count in counts.items():
            share = F.when(F.col("label") == label, F.lit(min(steps, steps * (factor * quota + 64) // count))).otherwise(share)
        few = rows.filter(F.pmod(F.xxhash64("deal"), F.lit(steps)) < share)
        order = Window.partitionBy("label").orderBy("deal")
        ranked = few.withColumns({"rank": F.row_number().over(order), "upto": F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))})
        ranked = materialize(ranked.filter(F.col("rank") <= quota), "ranked")
        found = {r["label"]: r["count"] for r in ranked.groupBy("label").count().collect()}
        if all(found.get(label, 0) >= min(quota, count) for label, count in counts.items()):
            return ranked.filter((F.col("upto") <= byte_quota) | (F.col("rank") == 1)).drop("upto")
        factor *= 16


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES
) -> ByteConvNet | None:
    """Fit on a sample of at most ``rows`` labelled rows that are not held out (None if there are none).

    The sample takes rows in the order of a hash of id and text, as many of each label as fit evenly, with the
    whole text of each, up to ``size`` bytes in all; repeated rows count once. Rows are
    chosen from their hashes alone; only the chosen ones' bytes leave their place.
    """
    known = docs.filter(~held_out(id_col) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.length(text_col) > 0))
    known = known.select(F.col(label_col).alias("label"), F.xxhash64(id_col, text_col).alias("deal"), F.col(text_col).cast("binary").alias("raw"))
    narrow = known.select("label", "deal", F.octet_length("raw").cast("long").alias("size"))
    classes = sorted(r[0] for r in narrow.select("label").distinct().limit(MOST_LABELS + 1).collect())
    if not classes:
        return None
    chosen = first_by_hash(narrow, max(1, rows // len(classes)), size // len(classes))
    picked = known.join(F.broadcast(chosen), ["label", "deal"]).groupBy("label", "rank").agg(F.min("raw").alias("raw"))
    pairs = [(bytes(r["raw"]), classes.index(r["label"])) for r in sorted(picked.collect(), key=lambda r: (r["label"], r["rank"]))]
    grid, owner = windows([raw for raw, _ in pairs])
    # Of a long text all windows are learned from; the work stays near that of LEARN_WINDOWS windows seen a few times.
    epochs = max(1, min(4, LEARN_WINDOWS // len(grid)))
    return ByteConvNet.fresh(classes).fit(grid, np.array([n for _, n in pairs])[owner], epochs=epochs)


def identify(docs: DataFrame, model: ByteConvNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row from all windows of its whole text.

    The classes' log-probabilities are averaged over the windows, weighted by
    the bytes of text in each; score is the probability of the winner (the first
    by name among equals). Null texts and texts without a letter, and all texts
    when there is no model, are ``und`` with score 0. Repeated rows each get a
    row; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch, texts in pieces(batches, limit=1 << 20):
            spoken = np.array([net is not None and bool(_LETTER.search(t.decode())) for t in texts])
            names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if spoken.any():
                grid, owner = windows([t for t, ok in zip(texts, spoken) if ok])
                weight = np.count_nonzero(grid, 1)[:, None]
                firsts = np.flatnonzero(np.diff(owner, prepend=-1))
                sums = np.add.reduceat(np.log(softmax(net.logits(grid)) + 1e-9) * weight, firsts, axis=0)
                chances = softmax(sums / np.add.reduceat(weight, firsts, axis=0))
                names[spoken] = np.array(net.classes, object)[chances.argmax(1)]
                scores[spoken] = chances.max(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["id", "lang_pred", "score"])

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, lang_pred string, score double")
