"""Document quality by attention-based multiple-instance learning, trained here in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.arrow import pieces
from cohortwise.llm.langid import first_by_hash, held_out

# A passage is this many bytes; the last one of a text may be shorter. An empty text is one empty passage.
PASSAGE = 512
# Byte pairs are counted in so many hashed buckets; CLASSES more hold shares of kinds of bytes.
BUCKETS = 512
CLASSES = 8
HIDDEN = 24
ATTENTION = 12
# Documented bounds of the labelled rows that training may use, each with its whole text, and of all their bytes.
SAMPLE_ROWS = 4000
SAMPLE_BYTES = 32 << 20
# Passages of one text that are encoded at once.
SLICE = 2048
THRESHOLD = 0.3

_KIND = np.zeros(256, np.uint8)
for _kind, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t\n\v\f\r", b".,;:'\"?!-()", bytes(range(128, 256))), 1):
    _KIND[list(_bytes)] = _kind


def encode_passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, and the text each belongs to."""
    counts = np.array([max(1, -(-len(t) // PASSAGE)) for t in texts])
    owner = np.repeat(np.arange(len(texts)), counts)
    filled = b"".join(t.ljust(n * PASSAGE, b"\0") for t, n in zip(texts, counts.tolist()))
    grid = np.frombuffer(filled, np.uint8).reshape(-1, PASSAGE)
    n = len(grid)
    pair = grid[:, :-1].astype(np.uint32) * 256 + grid[:, 1:]
    bucket = (pair * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    bucket[grid[:, 1:] == 0] = 0
    at = np.arange(n, dtype=np.uint32)[:, None]
    pairs = np.bincount((bucket + at * BUCKETS).ravel(), minlength=n * BUCKETS).reshape(n, BUCKETS).astype("f4")
    pairs[:, 0] = 0
    kinds = np.bincount((_KIND[grid] + at * CLASSES).ravel(), minlength=n * CLASSES).reshape(n, CLASSES).astype("f4")
    size = np.maximum(np.count_nonzero(grid, 1), 1).astype("f4")[:, None]
    kinds[:, 0] -= PASSAGE - np.count_nonzero(grid, 1)
    return np.concatenate((np.sqrt(pairs / size), np.sqrt(np.maximum(kinds, 0) / size) * 2), 1), owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class GatedAttention:
    """Passage encoder, gated attention over a document's passages, logistic score of the weighted sum."""

    params: list[np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 11) -> GatedAttention:
        rng = np.random.default_rng(seed)
        n = BUCKETS + CLASSES

        def some(a: int, b: int) -> np.ndarray:
            return rng.normal(0, a**-0.5, (a, b)).astype("f4")

        return cls([some(n, HIDDEN), np.zeros(HIDDEN, "f4"), some(HIDDEN, ATTENTION), some(HIDDEN, ATTENTION), some(ATTENTION, 1), some(HIDDEN, 1), np.zeros(1, "f4")])

    def _forward(self, x: np.ndarray, owner: np.ndarray) -> tuple:
        w, b, v, u, a, c, d = self.params
        h = np.tanh(x @ w + b)
        t, g = np.tanh(h @ v), _sigmoid(h @ u)
        e = np.exp(np.clip((t * g) @ a, -20, 20))
        firsts = np.flatnonzero(np.diff(owner, prepend=-1))
        alpha = e / np.add.reduceat(e, firsts)[owner]
        z = np.add.reduceat(alpha * h, firsts)
        return h, t, g, alpha, z, _sigmoid(z @ c + d)[:, 0], firsts

    def score(self, x: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return self._forward(x, owner)[5]

    def score_text(self, text: bytes) -> float:
        """One text of any length, a slice of passages at a time; attention runs over all of them."""
        w, b, v, u, a, c, d = self.params
        up, down = np.zeros((1, HIDDEN)), 0.0
        for start in range(0, max(len(text), 1), SLICE * PASSAGE):
            h = np.tanh(encode_passages([text[start : start + SLICE * PASSAGE]])[0] @ w + b)
            e = np.exp(np.clip((np.tanh(h @ v) * _sigmoid(h @ u)) @ a, -20, 20)).astype(float)
            up, down = up + e.T @ h, down + e.sum()
        return float(_sigmoid(up / down @ c + d)[0, 0])

    def fit(self, rows: int, gradients: Callable[[np.ndarray], list[np.ndarray]], epochs: int = 8, batch: int = 32, rate: float = 3e-3, seed: int = 11) -> GatedAttention:
        """Adam on the logistic loss of whole documents; attention is learned from document labels alone.

        ``gradients`` gives the sums over the documents of these numbers.
        """
        rng = np.random.default_rng(seed)
        first, second = [np.zeros_like(p) for p in self.params], [np.zeros_like(p) for p in self.params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(rows)
            for k in range(0, len(order), batch):
                at = order[k : k + batch]
                grads = [(g / len(at)).astype("f4") for g in gradients(at)]
                grads[0] = grads[0] + np.float32(1e-4) * self.params[0]
                step += 1
                for p, g, m, q in zip(self.params, grads, first, second):
                    m += 0.1 * (g - m)
                    q += 0.001 * (g * g - q)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(q / (1 - 0.999**step)) + 1e-8)
        return self

    def gradients(self, texts: list[bytes], target: np.ndarray) -> list[np.ndarray]:
        """Sums over documents, from all their passages."""
        return self._gradients(*encode_passages(texts), np.asarray(target, "f4"))

    def _gradients(self, x: np.ndarray, owner: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        w, _, v, u, a, c, _ = self.params
        h, t, g, alpha, z, p, firsts = self._forward(x, owner)
        back = (p - target).astype("f4")[:, None]
        dz = (back @ c.T)[owner]
        d_alpha = (dz * h).sum(1, keepdims=True)
        d_logit = alpha * (d_alpha - np.add.reduceat(alpha * d_alpha, firsts)[owner])
        d_gate = d_logit @ a.T
        dt, dg = d_gate * g * (1 - t * t), d_gate * t * g * (1 - g)
        dh = (alpha * dz + dt @ v.T + dg @ u.T) * (1 - h * h)
        return [x.T @ dh, dh.sum(0), h.T @ dt, h.T @ dg, (t * g).T @ d_logit, z.T @ back, back.sum(0)]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> GatedAttention | None:
    """Fit on at most ``rows`` labelled rows that are not held out, in the order of a hash (None if there are none).

    Each label gets half of the rows and of the ``size`` bytes as far as it has enough, every row with all passages of its
    text. Rows are chosen from hashes and lengths alone; only the chosen documents' bytes leave their
    place. The loss is not reweighted, so scores are a little low where
    one label is rare, which the threshold allows for. A document with several
    labels counts with each; repeated labels and repeated rows count once.
    """
    known = labels.filter(~held_out(id_col) & F.col(label_col).isin(0, 1)).select(F.xxhash64(id_col).alias("doc"), F.col(label_col).cast("int").alias("label"))
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    thin = docs.filter(F.col(id_col).isNotNull()).select(F.xxhash64(id_col).alias("doc"), raw.alias("raw"))
    sizes = thin.select("doc", F.xxhash64("doc", "raw").alias("deal"), F.octet_length("raw").cast("long").alias("size"))
    chosen = first_by_hash(sizes.join(known.distinct(), "doc"), rows // 2, size // 2)
    own = thin.withColumn("deal", F.xxhash64("doc", "raw"))
    picked = own.join(F.broadcast(chosen), "deal").groupBy("deal", "label").agg(F.min("raw").alias("raw"))
    found = sorted(picked.collect(), key=lambda r: (r["deal"], r["label"]))
    if not found:
        return None
    texts, target, model = [bytes(r["raw"]) for r in found], np.array([r["label"] for r in found], "f4"), GatedAttention.fresh()
    return model.fit(len(texts), lambda at: model.gradients([texts[i] for i in at], target[at]))


def score(docs: DataFrame, model: GatedAttention | None, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """(id, score) for every row, or with ``keep`` (row, score) with a struct of all columns.

    All passages of the whole text take part; long texts are encoded in slices of passages
    and attention runs over all of them. Null text counts as empty, which is one
    empty passage. Without a model every score is 0.5.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch, texts in pieces(batches, limit=1 << 20):
            if net is None:
                scores = np.full(len(texts), 0.5)
            elif len(texts) == 1:
                scores = np.array([net.score_text(texts[0])])
            else:
                scores = net.score(*encode_passages(texts)).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], batch.schema.names[:1] + ["score"])

    if keep:
        rows = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
        return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, score double")


def drop_poor(docs: DataFrame, model: GatedAttention | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``, all columns as given."""
    return score(docs, model, id_col, text_col, keep=True).filter(F.col("score") >= threshold).select("row.*")
